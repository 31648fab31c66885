"""Incremental bronze tables and user roles: a run rewrites only the buckets its records fall in.

Each feed has one stream per landing zone (``trigger(availableNow)``), whose batches are merged
into a table partitioned by ``_bucket``, a hash of the record's key:

* a batch is parsed once, into scratch; its distinct buckets (at most ``buckets`` numbers) are read
  from the table by partition pruning, merged with the batch (the newest landing of a key wins)
  and written back by dynamic partition overwrite.  All other buckets are left as they are.
* Rows without a key are no records of one entity; those of a batch keep a partition of their own.
* Unusable documents of a batch go to ``quarantine/<feed>/batch=<n>``.
* ``user_roles`` holds, per feed and bucket, the role mask of every identity among the bucket's
  current records.  Masks merge by OR, so the user dimension is folded from these small tables,
  and a record whose users changed takes its former users' roles away with its bucket's state.

Merging is idempotent: a batch that is repeated after a failure writes the same rows.  Spark
moves the new files of one bucket after the other into place; should the process die in between,
the repeated batch finds a bucket's former or new files, and the streams' landing files remain the
source from which a table can be rebuilt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sediment.operators.joins import file_bytes
from sediment.operators.merge import latest_per_key, newest_of_placed, placed
from sediment.operators.roles import (COMMIT_ROLES, GRAIN, ISSUE_ROLES, OWNER_ROLE, role_masks,
                                      roles_of)
from sediment.plans.bronze import LOG_META, landing_log
from sediment.schemas import BRONZE_KEYS, FEEDS
from sediment.session import drop_path, path_exists, scratch_path
from sediment.sources.landing import has_files
from sediment.sources.tables import write_parquet
from sediment.streaming.incremental import LOG_COLUMNS, landing_stream

BUCKETS = 64
#: Tasks write the buckets of the rows they read if a file of one task and bucket has so many bytes.
FILE_BYTES = 4 << 20
ROLE_SOURCES = {"repositories": OWNER_ROLE, "commits": COMMIT_ROLES, "issues": ISSUE_ROLES}


def _keyed(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def bucket_of(keys: Sequence[str], buckets: int, batch_id: int) -> Column:
    return F.when(_keyed(keys), F.pmod(F.xxhash64(*keys), F.lit(buckets))).otherwise(
        F.lit(buckets + batch_id)).cast("int")


def _overwrite_buckets(df: DataFrame, path: str, *by: str) -> None:
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*by).parquet(path))


def _write_from_scan(df: DataFrame, path: str, writers: int) -> None:
    """``_overwrite_buckets`` by the tasks that read the rows, each with a file open for every bucket:
    the rows are neither shuffled nor sorted."""
    conf, name = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    former = conf.get(name)
    conf.set(name, str(writers))
    try:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_bucket").parquet(path))
    finally:
        conf.set(name, former)


def read_buckets(spark: SparkSession, path: str, touched: Sequence[int] | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if touched is None else table.where(F.col("_bucket").isin(list(touched)))


def _bytes(reads: Sequence[DataFrame]) -> int:
    return sum(file_bytes(df) or 0 for df in reads)


def upsert(batch: DataFrame, path: str, feed: str, batch_id: int, buckets: int = BUCKETS,
           stored: bool = False) -> list[int]:
    """Merge flattened records (with ``_landed_at`` and ``_source_file``) into a bucketed table; the
    touched buckets.  Of a batch read from stored files whole rows are not shuffled by key, and to their
    buckets only if the files that the reading tasks would write were smaller than ``FILE_BYTES``."""
    spark, keys = batch.sparkSession, BRONZE_KEYS[feed]
    place, newest = (placed, newest_of_placed) if stored else (lambda df: df, latest_per_key)
    parts = [batch]
    touched = sorted(r[0] for r in batch.select(bucket_of(keys, buckets, batch_id)).distinct().collect())
    rows = place(batch).withColumn("_bucket", bucket_of(keys, buckets, batch_id))
    if touched:
        if path_exists(spark, path):
            parts.append(read_buckets(spark, path, [b for b in touched if b < buckets]))
            rows = place(parts[1]).unionByName(rows)
        merged = newest(rows, keys, list(LOG_COLUMNS))
        if stored and _bytes(parts) >= FILE_BYTES * len(touched) * rows.rdd.getNumPartitions():
            _write_from_scan(merged, path, len(touched))
        else:
            _overwrite_buckets(merged, path, "_bucket")
        spark.catalog.refreshByPath(path)
    return touched


def refresh_roles(spark: SparkSession, table: str, state: str, feed: str, touched: Sequence[int]) -> None:
    """Role masks of the touched buckets, from their current records."""
    rows = read_buckets(spark, table, touched)
    users = roles_of(rows, ROLE_SOURCES[feed], keep=("_bucket",))
    masks = role_masks(users, (*GRAIN, "_bucket"))
    # A row without identity marks every touched bucket, so that one left without users is replaced.
    marks = spark.createDataFrame([(b,) for b in touched], "_bucket int")
    out = masks.unionByName(marks, allowMissingColumns=True).withColumn("feed", F.lit(feed))
    _overwrite_buckets(out, state, "feed", "_bucket")
    spark.catalog.refreshByPath(state)


def _base(work: str) -> str:
    return work.rstrip("/")


def ingest(spark: SparkSession, landing_dir: str, work: str, feed: str, layout: str = "lines",
           buckets: int = BUCKETS, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start an ``availableNow`` run that merges not-yet-seen landing files of one feed."""
    base = _base(work)
    docs = landing_stream(spark, landing_dir, feed, layout, max_files_per_trigger)

    def merge(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        stored = write_parquet(batch, scratch_path(own, f"batch-{feed}"))
        try:
            log = own.read.schema(batch.schema).parquet(stored)
            bad = log.where("_reason IS NOT NULL").select(
                F.lit(feed).alias("feed"), F.col("_source_file").alias("source_file"),
                F.col("_reason").alias("reason"), F.col("_raw").alias("raw"))
            if not bad.isEmpty():
                write_parquet(bad, f"{base}/quarantine/{feed}/batch={batch_id}")
            records = log.where("_is_record").drop(*[c for c in LOG_META if c not in LOG_COLUMNS])
            touched = upsert(records, f"{base}/bronze/{feed}", feed, batch_id, buckets, stored=True)
            if touched and feed in ROLE_SOURCES:
                refresh_roles(own, f"{base}/bronze/{feed}", f"{base}/user_roles/{feed}", feed, touched)
        finally:
            drop_path(own, stored)

    return (landing_log(docs, feed).writeStream.foreachBatch(merge)
            .option("checkpointLocation", f"{base}/checkpoints/{feed}")
            .trigger(availableNow=True).start())


def bronze_table(spark: SparkSession, work: str, feed: str) -> DataFrame:
    """The current bronze table of a feed."""
    return read_buckets(spark, f"{_base(work)}/bronze/{feed}").drop("_bucket", *LOG_COLUMNS)


def user_identities(spark: SparkSession, work: str) -> DataFrame:
    """Every identity with its roles over all feeds, as ``role_masks`` gives them."""
    paths = [f"{_base(work)}/user_roles/{f}" for f in ROLE_SOURCES]
    parts = [spark.read.parquet(p) for p in paths if path_exists(spark, p)]
    out = parts[0].select(*GRAIN, "_mask")
    for p in parts[1:]:
        out = out.unionByName(p.select(*GRAIN, "_mask"))
    return out.where("user_id IS NOT NULL").groupBy(*GRAIN).agg(F.bit_or("_mask").alias("_mask"))


def daily(spark: SparkSession, landing_dir: str, work: str, layout: str = "lines",
          feeds: Sequence[str] = FEEDS, buckets: int = BUCKETS) -> dict[str, str]:
    """New landing files into the bronze tables, then the silver tables; ``{table: path}``.

    The user dimension is folded from the role state; the other tables are built from the current
    bronze tables.  Feeds without landing files keep their tables; silver tables whose inputs do
    not exist yet are left out.
    """
    from sediment.plans import silver
    from sediment.plans.run import build_silver

    for feed in feeds:
        if has_files(spark, landing_dir, feed, layout):
            ingest(spark, landing_dir, work, feed, layout, buckets).awaitTermination()
    base = _base(work)
    frames = {f: bronze_table(spark, work, f) for f in FEEDS if path_exists(spark, f"{base}/bronze/{f}")}
    ready = [t for t, (_, needs) in silver.BUILDERS.items() if t != "dim_users" and set(needs) <= set(frames)]
    out = build_silver(spark, frames, f"{base}/silver", ready)
    if set(frames) & set(ROLE_SOURCES):
        users = silver.dim_users_of(user_identities(spark, work))
        out["dim_users"] = write_parquet(users, f"{base}/silver/dim_users")
    return out
