"""DuckDB SQL of the opN queries that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def suffix_dedup(length: int = 100) -> str:
    """Texts as hex digits; every string of `length` bytes with its first place."""
    n = 2 * length
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, {n}) AS g
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {length} + 1)) AS i FROM d)),
firsts AS (SELECT doc_id, i, min((doc_id, i)) OVER (PARTITION BY g) AS f FROM s),
gone AS (SELECT doc_id, i FROM firsts WHERE f < (doc_id, i)),
runs AS (SELECT doc_id, i, sum(CASE WHEN i <= p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS k
         FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000000) + {length} AS p FROM gone)),
spans AS (SELECT doc_id, min(i) AS a, max(i) + {length} AS b FROM runs GROUP BY doc_id, k),
edges AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
cuts AS (SELECT e.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head,
                max(b) AS tail, sum(b - a) AS n_removed, count(*) AS n_spans
         FROM edges e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cuts USING (doc_id)"""


def _case(column: str, weights: dict[str, int]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {w}" for k, w in weights.items())
    return f"CAST(CASE {column} {whens} ELSE 1 END AS BIGINT)" if whens else "CAST(1 AS BIGINT)"


def mix(weights: dict[str, dict[str, int]], share: float, max_epochs: int, seed: int) -> str:
    levels = ["domain", "lang", "source"]
    sql = f"""
WITH slim AS (
  SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens,
         coalesce('d' || (TRY_CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) % 4), '') AS domain,
         coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
l0 AS (SELECT CAST(least(floor(sum(n_tokens) * CAST({share} AS DOUBLE)), sum(n_tokens) * {max_epochs}) AS BIGINT) AS budget FROM slim)"""
    for k in range(1, 4):
        keys, parent = ", ".join(levels[:k]), levels[:k - 1]
        part = f"PARTITION BY {', '.join(parent)}" if parent else ""
        join = f"JOIN l{k - 1} USING ({', '.join(parent)})" if parent else "CROSS JOIN l0"
        sql += f""",
n{k} AS (SELECT {keys}, CAST(sum(n_tokens) AS BIGINT) AS tokens, CAST(sum(n_tokens) * {max_epochs} AS BIGINT) AS cap,
                {_case(levels[k - 1], weights.get(levels[k - 1], {}))} AS weight FROM slim GROUP BY {keys}),
s{k} AS (SELECT *, coalesce(CAST(sum(cap) OVER w AS BIGINT), 0) AS cap_before, coalesce(CAST(sum(weight) OVER w AS BIGINT), 0) AS w_before,
                CAST(sum(weight) OVER ({part}) AS BIGINT) AS w_all
         FROM n{k} {join} WINDOW w AS ({part} ORDER BY CASE WHEN weight > 0 THEN cap / weight ELSE 'infinity' END, {levels[k - 1]}
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f{k} AS (SELECT *, weight > 0 AND cap * (w_all - w_before) <= weight * (budget - cap_before) AS is_full FROM s{k}),
l{k} AS (SELECT {keys}, tokens, CASE WHEN is_full THEN cap WHEN weight = 0 THEN 0
                ELSE weight * (budget - coalesce(CAST(sum(cap) FILTER (is_full) OVER ({part}) AS BIGINT), 0))
                     // CAST(sum(weight) FILTER (NOT is_full) OVER ({part}) AS BIGINT) END AS budget FROM f{k})"""
    return sql + f""",
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
                budget - CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END * tokens AS rest FROM l3),
placed AS (SELECT s.*, whole, rest, sum(n_tokens) OVER (PARTITION BY domain, lang, source
                  ORDER BY md5('{seed}:' || whole || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))
                  RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far
           FROM slim s JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n_tokens, CAST(whole + CASE WHEN rest > 0 AND so_far <= rest THEN 1 ELSE 0 END AS BIGINT) AS epochs
FROM placed WHERE whole > 0 OR (rest > 0 AND so_far <= rest)"""


def decontaminate(window: int = 10) -> str:
    words = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), "
             "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
    return f"""
WITH d AS (SELECT doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
p AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i
            FROM (SELECT item_id, w, least({window}, len(w)) AS k FROM b WHERE len(w) > 0))),
t AS (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
      FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM p))),
m AS (SELECT doc_id, i, k, item_id FROM t JOIN p USING (k, g)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS j FROM m) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""


def chat(extra: str) -> str:
    """`extra` is the text of both turns of conversation -7."""
    escaped = lambda x: f"replace(replace({x}, '\\', '\\\\'), '<|', '<\\|')"
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -7, 0, 'user', '{extra}' UNION ALL SELECT -7, 1, 'assistant', '{extra}'),
p AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev FROM c),
n AS (SELECT *, length({escaped('text')}) + CASE WHEN prev = role THEN 8 ELSE 16 + length({escaped('role')})
             + CASE WHEN prev IS NULL THEN 0 ELSE 7 END END AS size FROM p)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) + 7 AS BIGINT) AS formatted_chars
FROM n GROUP BY conv_id"""


def quality(min_words: int, host_margin: float, symbols: float, lines: float, chars: tuple[float, float]) -> str:
    rules = ("symbols", "dup_lines", "word_length")
    prior = ", ".join(f"avg({r} / n) AS m_{r}, var_pop({r} / n) AS v_{r}" for r in rules)
    size = lambda r: f"greatest(m_{r} * (1 - m_{r}) / v_{r} - 1, 0)"
    bad = ", ".join(f"CASE WHEN v_{r} > 1e-12 THEN ({r} + m_{r} * {size(r)}) / (n + {size(r)}) ELSE m_{r} END > m_{r} * (1 + {host_margin}) AS bad_{r}"
                    for r in rules)
    dropped = " OR ".join(f"(fail_{r} AND bad_{r})" for r in rules)
    return f"""
WITH d AS (SELECT doc_id, coalesce(CAST(source AS VARCHAR), '') AS host, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l
           FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT j) AS n FROM (
          SELECT doc_id, unnest(range(i, i + 8)) AS j FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY 1),
f AS (SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
             CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (doc_id)),
j AS (SELECT *, n_words < {min_words} OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             n_symbols > {symbols} * n_words AS fail_symbols, n_dup_lines > {lines} * n_lines AS fail_dup_lines,
             n_words > 0 AND (word_chars / n_words < {chars[0]} OR word_chars / n_words > {chars[1]}) AS fail_word_length FROM f),
h AS (SELECT host, count(*) AS n, {', '.join(f'CAST(sum(CAST(fail_{r} AS INT)) AS BIGINT) AS {r}' for r in rules)} FROM j GROUP BY host),
v AS (SELECT host, {bad} FROM h, (SELECT {prior} FROM h))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({dropped}) AS kept
FROM j JOIN v USING (host)"""


def divergence(min_docs: int, top_terms: int, scale: int) -> str:
    share = lambda count, size, v: f"1 + ({scale}::HUGEINT * ({count} + 1)) // ({size} + {v})"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                     '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT r) >= {min_docs}),
l AS (SELECT lang, count(*) AS v, sum(n) AS size FROM kept GROUP BY 1),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY 1, 2, 3),
dense AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
                 sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS size
          FROM g JOIN kept k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT lang, source, term, dense.n, {share('dense.n', 'dense.size', 'v')} AS p, {share('lang_n', 'l.size', 'v')} AS q
      FROM dense JOIN l USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM p a JOIN p b USING (lang, term) WHERE a.source != b.source GROUP BY 1, 2, 3),
parts AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
          UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= {top_terms}"""
