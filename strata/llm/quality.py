"""Quality rules with host-level verdicts (operator 9).

Features of a text: its words (runs of non-blank characters), their code
points, symbols, repeated lines, and words inside 8-word windows that occur
twice or more.  A document fails outright if it has fewer than `min_words`
words or repeated windows cover more than 30 % of them.

Soft rules (too many symbols, too many repeated lines, words too short or too
long) are weak evidence in one document, so they only count together with the
document's host: for every rule the failures are added up by host, each
host's rate is shrunk towards the rate of all hosts by a beta prior fitted to
the hosts' rates (method of moments), and a host whose shrunk rate is over the
prior's mean by more than `host_margin` of it is judged bad under that rule.  A document is dropped if it fails
a rule under which its host is bad; a clean document stays whatever its host.

Hosts come to one row each before anything is joined, so a host with a third
of all documents is one row in the prior and a plain equi-join otherwise.

Null and empty texts have no words (and fail outright).  Documents with a null
host form one host.  Repeated rows count as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.session import materialize

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
#: Failed above: symbols a word, repeated lines as a share of lines with a
#: word; outside: mean code points of a word.
MAX_SYMBOLS_PER_WORD, MAX_DUP_LINES, WORD_CHARS = 0.5, 0.3, (2.0, 25.0)
RULES = ("symbols", "dup_lines", "word_length")


def _mixed_pairs(hashes: Column, distance: int) -> Column:
    """hash(h[i], h[i + distance]) for all i that have both."""
    rest = F.slice(hashes, F.lit(1 + distance), F.greatest(F.size(hashes) - distance, F.lit(0)))
    return F.zip_with(F.slice(hashes, F.lit(1), F.size(rest)), rest, lambda a, b: F.xxhash64(a, b))


def features(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    The hashes of 8-word windows are made of two 4-word ones, those of 2-word
    ones, and so on.  Only texts in which two of them are equal go through the
    sort that finds which.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    step = docs.withColumn("_w", F.filter(F.split(text, BLANK), lambda w: w != "")) \
        .withColumn("_l", F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    step = step.withColumn("_h", F.transform("_w", lambda w: F.xxhash64(w)))
    distance = 1
    while distance < WINDOW:
        step = step.withColumn("_h", _mixed_pairs(F.col("_h"), distance))
        distance *= 2
    ordered = F.sort_array(F.transform("_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    step = step.withColumn("_s", F.when(F.size(F.array_distinct("_h")) < F.size("_h"), ordered)
                           .otherwise(F.slice(ordered, 1, 0)))
    none = F.array(F.lit(None).cast("struct<h:bigint,i:int>"))
    sides = F.zip_with(F.concat(none, "_s"), F.concat(F.slice("_s", F.lit(2), F.size("_s")), none),
                       lambda a, b: F.struct(a["h"].alias("a"), b["h"].alias("b")))
    near = F.filter(F.zip_with("_s", sides, lambda s, n: F.when(
        (s["h"] == n["a"]) | (s["h"] == n["b"]), s["i"])), lambda i: i.isNotNull())
    step = step.withColumn("_p", F.when(F.size("_s") > 0, F.sort_array(near)).otherwise(F.array().cast("array<int>")))
    gaps = F.zip_with(F.slice("_p", F.lit(2), F.size("_p")), F.slice("_p", F.lit(1), F.greatest(F.size("_p") - 1, F.lit(0))),
                      lambda b, a: F.least(b - a, F.lit(WINDOW)))
    covered = F.when(F.size("_p") > 0, F.aggregate(gaps, F.lit(WINDOW), lambda n, g: n + g)).otherwise(0)
    return (step.withColumn("n_words", F.size("_w").cast("long"))
            .withColumn("word_chars", F.length(F.array_join("_w", "")).cast("long"))
            .withColumn("n_symbols", F.regexp_count(text, F.lit(SYMBOLS)).cast("long"))
            .withColumn("n_lines", F.size("_l").cast("long"))
            .withColumn("n_dup_lines", (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"))
            .withColumn("n_repeat_words", covered.cast("long"))
            .drop("_w", "_l", "_h", "_s", "_p"))


def host_verdicts(failures: DataFrame, host_margin: float) -> DataFrame:
    """(host, bad_<rule>): hosts whose shrunk failure rate is over the fitted
    prior's mean by more than the margin (a share of that mean).

    `failures` has a host and a boolean fail_<rule> a document.  With m and v
    the mean and variance of the hosts' rates, the prior is
    beta(m s, (1 - m) s), s = m (1 - m) / v - 1 (at least 0; where the rates do
    not vary, every host gets the mean).
    """
    hosts = materialize(failures.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.col(f"fail_{r}").cast("long")).alias(r) for r in RULES]),
        failures.sparkSession)
    rate = {r: F.col(r) / F.col("n") for r in RULES}
    prior = hosts.agg(*[F.avg(rate[r]).alias(f"m_{r}") for r in RULES],
                      *[F.var_pop(rate[r]).alias(f"v_{r}") for r in RULES]).first()
    bad = []
    for r in RULES:
        m, v = prior[f"m_{r}"] or 0.0, prior[f"v_{r}"] or 0.0
        if v > 1e-12:
            s = max(m * (1 - m) / v - 1, 0.0)
            shrunk = (F.col(r) + m * s) / (F.col("n") + s)
        else:
            shrunk = F.lit(m)
        bad.append((shrunk > m * (1 + host_margin)).alias(f"bad_{r}"))
    return hosts.select("host", *bad)


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text", min_words: int = 20,
          host_margin: float = 0.1) -> DataFrame:
    """All columns of `docs` but the text, with features, base_failed and kept.

    A document goes if it fails outright, or fails a rule of which its host is
    bad; one that fails no rule stays whatever its host.  Columns of `docs` with
    the names of the results are replaced.
    """
    added = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    own = [c for c in docs.columns if c not in (*added, text_col)]
    rows = docs.select(F.struct(*own).alias("row"), F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"),
                       F.col(text_col).alias("_text"))
    n = F.col("n_words")
    mean = F.col("word_chars") / n
    judged = materialize(
        features(rows, "_text").drop("_text")
        .withColumn("base_failed", (n < min_words) | (100 * F.col("n_repeat_words") > 30 * n))
        .withColumn("fail_symbols", (F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n))
        .withColumn("fail_dup_lines", F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
        .withColumn("fail_word_length", F.when(n > 0, (mean < WORD_CHARS[0]) | (mean > WORD_CHARS[1])).otherwise(False)),
        docs.sparkSession)
    verdicts = host_verdicts(judged.select("host", *[f"fail_{r}" for r in RULES]), host_margin)
    dropped = F.lit(False)
    for r in RULES:
        dropped = dropped | (F.col(f"fail_{r}") & F.col(f"bad_{r}"))
    return judged.join(verdicts, "host").withColumn("kept", ~F.col("base_failed") & ~dropped).select("row.*", *added)
