"""The opN queries: each operator on its whole table, with digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import alignment, chat, decontam, divergence, jaccard, langid, licenses, lm, mixing, quality, simhash, sql, suffix_dedup, toxicity


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(doc_id: str, n: int) -> Column:
    """crc32(doc_id as text) mod n; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(n))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(read(spark, sf_dir, "documents").select("doc_id", "text"), length=100)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def mix_levels() -> dict[str, Column]:
    """Domain, language, source; the domain is the source's number modulo 4."""
    number = F.regexp_extract("source", r"(\d+)$", 1).try_cast("int")
    return {"domain": F.concat(F.lit("d"), F.pmod(number, F.lit(4)).cast("string")),
            "lang": F.col("lang"), "source": F.col("source")}


MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
               "lang": {"en": 4, "de": 3, "fr": 2, "es": 2},
               "source": {"src0": 2}}


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mixing.mix(docs, mix_levels(), MIX_WEIGHTS, budget_share=0.6, max_epochs=4, seed=42).select(
        "doc_id", "domain", "lang", "source", "n_tokens", "epochs")


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.decontaminate(read(spark, sf_dir, "documents").select("doc_id", "text"),
                                 read(spark, sf_dir, "benchmark"), window=10)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), max_distance=3, shingle_words=3)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = docs.withColumn("held_out", remainder("doc_id", 3) == 1)
    model = langid.learn(held.where(~F.col("held_out")))
    return langid.identify(held.drop("lang"), model).select(
        "doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    model = toxicity.learn(docs, labels)
    return toxicity.score(docs.withColumn("held_out", remainder("doc_id", 5) == 0), model)


#: Both turns of the conversation that op7 adds.
EXTRA_TURN = "\\### Assistant: </turn> ok"


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(EXTRA_TURN).alias("text"))
    return chat.digest(chat.format_chats(turns.unionByName(extra)))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return quality.judge(docs, host_col="source", min_words=20, host_margin=HOST_MARGIN).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


#: Bad hosts fail a rule this much oftener than the prior's mean.
HOST_MARGIN = 0.1


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", remainder("doc_id", 7) == 2)
    return lm.score(docs, F.col("held_out"))


def op11_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_groups(read(spark, sf_dir, "documents").select("doc_id", "text"), percent=85, shingle_words=4)


#: Folder of the vocabulary files, the same on every executor.
TOKENIZERS = "/opt/tokenizers"


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read(spark, sf_dir, "documents").select("doc_id", "text"),
                           f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(read(spark, sf_dir, "documents").select("text", "lang", "source"), min_docs=3, top_terms=200)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_licenses": op2_licenses,
    "op3_toxicity": op3_toxicity,
    "op4_mix_sources": op4_mix_sources,
    "op5_decontaminate": op5_decontaminate,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_language": op8_language,
    "op9_quality": op9_quality,
    "op10_lm_score": op10_lm_score,
    "op11_jaccard": op11_jaccard,
    "op12_alignment": op12_alignment,
    "op13_divergence": op13_divergence,
}

#: The models and hashes of the others have no SQL form.
ORACLE: dict[str, str] = {
    "op1_suffix_dedup": sql.suffix_dedup(100),
    "op4_mix_sources": sql.mix(MIX_WEIGHTS, 0.6, 4, 42),
    "op5_decontaminate": sql.decontaminate(10),
    "op7_chat": sql.chat(EXTRA_TURN),
    "op13_divergence": sql.divergence(3, 200, divergence.SCALE),
    "op9_quality": sql.quality(20, HOST_MARGIN, quality.MAX_SYMBOLS_PER_WORD, quality.MAX_DUP_LINES, quality.WORD_CHARS),
}
