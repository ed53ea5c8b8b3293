"""Incremental CSV ingest with Structured Streaming.

The raw layer is append-only: a directory receives CSV files; each run of
the ingest picks up only files it has not seen (the file-source log in the
checkpoint), stamps ``ingestion_timestamp`` and appends to a parquet table.
``trigger(availableNow=True)`` processes everything present in bounded
micro-batches and stops, so a scheduled job and a long-running stream share
one code path.  A restarted or retried run resumes from the checkpoint:
files are committed exactly once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.sources.feeds import FEED_COLUMNS

CSV_OPTIONS = {
    "header": "true",
    "encoding": "ISO-8859-1",
    # keep text exactly as written (Spark trims on write by default)
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}


def feed_schema(feed: str) -> StructType:
    """Declared all-text schema of a raw feed (streaming sources need one)."""
    return StructType([StructField(c, StringType(), True) for c in FEED_COLUMNS[feed]])


def write_csv_files(df: DataFrame, path: str, split_by: str | None = None,
                    mode: str = "append") -> None:
    """Drop ``df`` as CSV files into ``path`` (one folder per ``split_by``
    value when given, e.g. one per day, as a source system would)."""
    w = df
    if split_by:
        # one task per value, except that AQE splits a value holding a large
        # share of the rows (REBALANCE) instead of writing it from one task
        w = df.hint("rebalance", split_by)
    writer = w.write.mode(mode).options(**CSV_OPTIONS)
    if split_by:
        writer = writer.partitionBy(split_by)
    writer.csv(path)


def csv_stream(spark: SparkSession, path: str, schema: StructType,
               max_files_per_trigger: int | None = None, **options) -> DataFrame:
    """Streaming DataFrame over a CSV directory with a declared schema."""
    reader = spark.readStream.schema(schema).options(**CSV_OPTIONS).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # files may sit in split folders (day=...): read them recursively
    return reader.option("recursiveFileLookup", "true").csv(path)


def stamp(df: DataFrame) -> DataFrame:
    """Ingest stamp: the micro-batch clock, equal within one batch."""
    return df.withColumn("ingestion_timestamp", F.current_timestamp())


def raw_feed_stream(spark: SparkSession, path: str, feed: str, **kw) -> DataFrame:
    return stamp(csv_stream(spark, path, feed_schema(feed), **kw))


def deduplicated(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Each key once, however often a source delivers it.

    A key is remembered until the watermark (the latest event time less
    ``delay``) has passed its event time by ``delay``; a repeat that comes even
    later is behind the watermark and dropped for that.  So the state holds the
    keys of about two delays, not of all time.  A *new* row behind the watermark
    is lost: choose a delay longer than a source's lateness.  Rows without an
    event time never expire and are not dropped as late.
    """
    timed = stream.withColumn("_event_time", F.col(event_time).cast("timestamp")).withWatermark("_event_time", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_event_time")


def write_incremental(stream: DataFrame, target: str, checkpoint: str,
                      partition_by: Sequence[str] = (), available_now: bool = True):
    """Append a stream to a parquet table, resumable from ``checkpoint``.

    Returns the started query; with ``available_now`` it stops by itself
    after the data present at start has been committed.  A stream may have
    columns that earlier ones lacked: ``read_table`` merges the files' schemas.
    """
    w = (stream.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", target))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query and surface its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def read_table(spark: SparkSession, target: str, merge_schema: bool = True) -> DataFrame:
    return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(target)
