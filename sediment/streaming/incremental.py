"""Incremental landing -> bronze with Structured Streaming.

The scheduled (daily) run only has to process landing files that arrived since the last
run.  A file-source stream with ``trigger(availableNow=True)`` does exactly that: the
checkpoint remembers which files were consumed, each run processes the new ones in bounded
micro-batches (``maxFilesPerTrigger``) and stops.  The Parquet file sink commits every batch
exactly once, so a run that dies half-way is resumed, not duplicated.

The sink is an append-only *record log* per feed (flattened records plus landing time and
source file).  The current bronze table is the newest record per key over that log
(``current_bronze``), the same rule the batch builder applies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sediment.operators.merge import newest_rows
from sediment.plans.bronze import LOG_META, landing_log
from sediment.schemas import BRONZE_KEYS, FEEDS, envelope
from sediment.sources.landing import DOCUMENTS, document_name

LOG_COLUMNS = ("_landed_at", "_source_file")


def landing_stream(spark: SparkSession, landing_dir: str, feed: str, layout: str = "lines",
                   max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming frame of landing documents of one feed (explicit schema, as in batch)."""
    if feed not in FEEDS:
        raise ValueError(f"unknown feed {feed!r}")
    reader = (spark.readStream.schema(envelope(feed))
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("columnNameOfCorruptRecord", "_corrupt_record"))
    if layout == "document":
        reader = (reader.option("multiLine", "true").option("pathGlobFilter", f"{feed}_{DOCUMENTS}")
                  .option("recursiveFileLookup", "true"))  # as scan_feed does
        path = landing_dir
    elif layout == "lines":
        path = f"{landing_dir.rstrip('/')}/feed={feed}"
    else:
        raise ValueError("layout must be 'document' or 'lines'")
    file = F.col("_metadata.file_name")
    return reader.json(path).select("ingestion_timestamp", "data", "_corrupt_record",
                                    (document_name(file) if layout == "document" else file).alias("source_file"))


def ingest_new_landing(spark: SparkSession, landing_dir: str, log_dir: str,
                       checkpoint_dir: str, feed: str, layout: str = "lines",
                       max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start an ``availableNow`` run that appends records of not-yet-seen landing files."""
    docs = landing_stream(spark, landing_dir, feed, layout, max_files_per_trigger)
    return (landing_log(docs, feed).writeStream.format("parquet")
            .option("path", log_dir).option("checkpointLocation", checkpoint_dir)
            .outputMode("append").trigger(availableNow=True).start())


def quarantined(spark: SparkSession, log_dir: str, feed: str) -> DataFrame:
    """``(feed, source_file, reason, raw)`` of the documents that gave no record, or only part."""
    return spark.read.parquet(log_dir).where("_reason IS NOT NULL").select(
        F.lit(feed).alias("feed"), F.col("_source_file").alias("source_file"),
        F.col("_reason").alias("reason"), F.col("_raw").alias("raw"))


def current_bronze(spark: SparkSession, log_dir: str, feed: str) -> DataFrame:
    """The bronze table as of now: newest landing of every record in the feed's log."""
    log = spark.read.parquet(log_dir).where("_is_record")
    return newest_rows(log, BRONZE_KEYS[feed], list(LOG_COLUMNS)).drop(*LOG_META)
