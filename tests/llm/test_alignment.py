"""Cross-tokenizer alignment against plain loops over whole texts."""

import copy
import hashlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from strata.llm import alignment as al
from strata.llm import queries

A, B = f"{queries.TOKENIZERS}/byte_bpe_50k.json", f"{queries.TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def encode():
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    names = al.byte_alphabet()

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def both(text):
        if not text:
            return [], []
        x = [(i, bytes(names[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        whole = (" " + text).encode()
        return (x, y) if b"".join(t for _, t in x) == b"".join(t for _, t in y) == whole else ([], [])

    return both


def spans(side):
    at, out = 0, []
    for i, t in side:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def plain(docs, encode):
    linked, rows, count = [], [], Counter()
    for _, text in docs:
        a, b = map(spans, encode(text))
        pairs, j = Counter(), 0
        for i, s, e in a:
            while j and b[j - 1][2] > s:
                j -= 1
            while j < len(b) and b[j][1] < e:
                if b[j][2] > s:
                    pairs[i, b[j][0]] += 1
                j += 1
        groups = []
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s < hi) for side in (a, b)))
        linked.append(pairs)
        count.update(set(pairs))
        rows.append((len(a), len(b), len(cuts), sum(pairs.values()),
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    return sorted(((d, *r[:4], sum(m for p, m in pairs.items() if count[p] == best[p[0]]),
                    sum(m * count[p] for p, m in pairs.items()), r[4])
                   for (d, _), r, pairs in zip(docs, rows, linked)), key=repr)


ODD = [(1, None), (2, ""), (3, " "), (4, "plain words, and more words"), (4, "plain words, and more words"),
       (None, "plain words"), (5, "  two  blanks \n\n\ttabs end "), (6, "<|endoftext|> </s><s> <unk> <0x41> <pad>"),
       (7, "Ärger über die Größe à côté où ñandú"), (8, "日本語のテキスト、 全角　空白 です"), (9, "emoji 👩‍👩‍👧 and ﬁ ligature ½ ²"),
       (10, "nbsp here   line\u0085next zero​width"), (11, "it's we'll 123 456,789.00 a1b2 x"), (12, "▁ fake ▁mark a▁b"),
       (13, "NUL\0in text"), (14, "combining é å ŋ x"), (15, "word " * 400 + "end")]


def collect(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_odd_texts_and_extra_columns(spark, encode):
    df = spark.createDataFrame([(*d, "x", 0, 1) for d in ODD], "doc_id long, text string, docs string, n_a int, n long")
    assert collect(al.align(df, A, B)) == plain(ODD, encode)


def test_many_shards_and_pieces(spark, encode):
    docs = ODD + [(100 + k, f"the shared passage number {k} of {k % 7} things") for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert collect(al.align(df, A, B, shard_bytes=400, piece_bytes=100)) == plain(docs, encode)


def test_no_rows_and_only_empty_rows(spark):
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert collect(al.align(df.limit(0), A, B)) == []
    assert collect(al.align(df, A, B)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_a_text_that_a_side_cannot_spell_has_no_tokens():
    sides = al.byte_side(A), al.piece_side(B)
    lossy = copy.copy(sides[1])
    lossy.encode = lambda words: [ids[:-1] if "bad" in w else ids for w, ids in zip(words, sides[1].encode(words))]
    data, off = al._blank_first(np.frombuffer(b"good onebad textlast one", np.uint8), np.array([0, 8, 16, 24]))
    a, b = al.tokens(data, off, (sides[0], lossy))
    assert set(a["doc"]) == set(b["doc"]) == {0, 2}
    for frame in (a, b):
        assert [(x.start, x.end) for x in frame.itertuples()][0] == (0, 5)
        assert frame[frame.doc == 2]["start"].min() == 18 and frame["end"].max() == 27


def test_query_equals_plain(spark, encode):
    docs = duckdb.sql("SELECT doc_id, text FROM read_parquet('/root/testdata/sf0.001/documents.parquet')").fetchall()
    assert collect(queries.op12_alignment(spark, "/root/testdata/sf0.001")) == plain(docs, encode)
