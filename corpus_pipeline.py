"""Corpus preparation: five stages, each a table of documents for the next.

language ID -> SimHash near-duplicates -> repeated passages -> benchmark
decontamination -> mixing.  Every stage takes (spark, docs, sf_dir) and
returns a DataFrame; `run` writes each stage's rows as Parquet in the shared
folder and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontam, langid, mixing, queries, simhash, suffix_dedup
from strata.session import scratch_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts without a language: null, or without a letter."""
    model = langid.learn(docs.where(queries.remainder("doc_id", 3) != 1))
    return langid.identify(docs, model).where(F.col("lang_pred") != langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of every group of near-duplicates."""
    return simhash.simhash_dedup(docs, max_distance=3, shingle_words=3)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated strings of 100 bytes and more out of the texts."""
    out = suffix_dedup.suffix_dedup(docs, length=100)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    return out.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten consecutive words of a benchmark item."""
    items = queries.read(spark, sf_dir, "benchmark")
    return decontam.decontaminate(docs, items, window=10).where("n_hit = 0").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Selects documents to the target weights; `epochs` is how often each is read."""
    return mixing.mix(docs, queries.mix_levels(), queries.MIX_WEIGHTS, budget_share=0.6, max_epochs=4, seed=42)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("passages", passages),
          ("benchmark", benchmark), ("mixture", mixture)]

#: Language models, SimHash and suffix buckets have no SQL form; the tests
#: hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
