import hashlib
import random
from itertools import groupby

from pyspark.sql import functions as F

from strata.llm import chat

NASTY = ["", "\\", "<|", "<|end|>", "<\\|", "\\### Assistant: </turn> ok", "<", "|end|>", "a\nb\r\n", "é漢😀", "<|next|><|text|>",
         "\\\\<|role|>x", "$1", "plain text"]


def rows(seed):
    r = random.Random(seed)
    out = []
    for c in range(60):
        for t in range(r.randint(1, 9)):
            text = None if r.random() < .1 else "".join(r.choice(NASTY) for _ in range(r.randint(0, 3)))
            out.append((c, t, r.choice(["user", "assistant", "system", "we<|ird\\", None]), text))
    out += [(61, 3, "assistant", "same"), (61, 3, "assistant", "same"), (61, None, "user", "first"),
            (None, 1, "user", "x"), (None, 0, "assistant", "y")]
    r.shuffle(out)
    return out


def test_round_trip_and_loss(spark):
    data = rows(1)
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").repartition(5)
    out = chat.format_chats(df).select("*", chat.read_turns(F.col("formatted")).alias("back"),
                                       chat.masked_text(F.col("formatted"), F.col("loss")).alias("masked")).collect()
    by = {}
    for c, t, role, text in data:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    assert {r.conv_id for r in out} == set(by) and len(out) == len(by)
    for r in out:
        want = [x[1:] for x in sorted(by[r.conv_id])]
        assert [(x.role, x.text) for x in r.back] == want
        assert r.masked == "".join(t for role, t in want if role == "assistant")
        assert [(m.role, list(m.texts)) for m in r.messages] == [
            (k, [t for _, t in g]) for k, g in groupby(want, key=lambda x: x[0])]
        assert r.formatted.count("<|end|>") == len(r.messages)
        for s in r.loss:
            assert "<|" not in r.formatted[s.start:s.start + s.length]


def test_contract_digests(spark):
    df = spark.createDataFrame([(-7, 0, "user", NASTY[5]), (-7, 1, "assistant", NASTY[5])],
                               "conv_id long, turn long, role string, text string")
    r = chat.digest(chat.format_chats(df)).first()
    t = NASTY[5]
    assert r.turns_sha256 == hashlib.sha256(f"user\n{t}\nassistant\n{t}\n".encode()).hexdigest()
    assert (r.n_turns, r.loss_chars) == (2, len(t))
    assert r.loss_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_long_conversation_extra_columns_and_empty_table(spark):
    df = spark.range(3000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"),
                                  F.lit("ab").alias("text"), F.lit(0).alias("start"), F.lit("z").alias("lead"))
    r = chat.digest(chat.format_chats(df)).first()
    assert (r.n_turns, r.loss_chars) == (3000, 6000)
    assert chat.digest(chat.format_chats(df.limit(0))).collect() == []
