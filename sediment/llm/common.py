"""Helpers shared by the training-data operators.

Everything here is distributed: tables that cut lineage are written under the folder the
cluster names in ``spark.checkpoint.dir``, and ranks are computed per value bucket with bucket
offsets, so no sort or window ever holds a whole table or a whole hot group in one task.
"""

from __future__ import annotations

import math
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.session import drop_path, scratch_path

ARROW_ROWS = 512
ARROW_BYTES = 32 << 20
LINKS_PER_FILE = 200_000


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows and bytes of an Arrow batch: texts may be long, and a batch is held in
    memory (a single longer row is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, rows)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts lineage, survives lost
    executors, and gives the planner a table of known size."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path, compression="zstd")
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing still to be computed reads."""
    for t in tables:
        drop_path(t.sparkSession, t.scratch)


def with_places(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__file`` and ``__row``, which tell any two rows apart: a hash of the Parquet
    file's path and the row's number in it, the same in every scan however it is split.  Rows that
    are not read straight from Parquet are written first."""
    place = [F.xxhash64("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    try:
        return docs.select("*", *place)
    except AnalysisException:
        return written(docs, "places").select("*", *place)


def doc_crc(col: Column) -> Column:
    """crc32 of an id's decimal text, unsigned; a null id counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def stratified_rank(df: DataFrame, strata: list[str], bucket: Column, order: list[Column],
                    out: str, few: bool = False) -> DataFrame:
    """Add ``out``: each row's rank from 1 in its stratum, in the order of (bucket, order).

    ``bucket`` must be non-decreasing in that order and must spread the rows of a stratum
    evenly; rows are ranked inside (stratum, bucket) and offset by the counts of the lower
    buckets.  A hot stratum is so spread over all its buckets.  The strata are compared
    null-safely.  Rows that tie in every order column must be interchangeable.  ``few``: the
    caller knows that there are few (stratum, bucket) pairs, so their offsets are broadcast.
    """
    b = f"__b_{uuid.uuid4().hex[:6]}"
    keys = [*strata, b]
    rows = df.withColumn(b, bucket)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    lower = Window.partitionBy(*strata) if strata else Window.partitionBy(F.lit(0))
    lower = lower.orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    right = {k: f"{k}__r" for k in keys}
    offsets = counts.select(
        *[F.col(k).alias(right[k]) for k in keys],
        F.coalesce(F.sum("__n").over(lower), F.lit(0)).alias("__below"))
    if few:
        offsets = F.broadcast(offsets)
    local = rows.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    on = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(right[k]))
        on = c if on is None else on & c
    return (local.join(offsets, on)
            .withColumn(out, F.col("__below") + F.col("__rn"))
            .drop(b, "__rn", "__below", *right.values()))


def bucket_count(rows: int) -> int:
    """Buckets so that both their number and the rows of each grow with the root of the rows."""
    return max(1, math.isqrt(max(0, rows - 1)) + 1)


def components(links: DataFrame, name: str) -> DataFrame:
    """Connected components of ``links(a, b)``: (node, label), the label its smallest node.

    Minimum labels travel along links and through labels (pointer jumping), so the number of
    rounds grows with the logarithm of a component's diameter; hub nodes are folded by partial
    aggregation.  Every round is a written table of as many files as its links need
    (``LINKS_PER_FILE``).  Nodes without links are not returned.
    """
    links = written(links.select("a", "b"), f"{name}-all")
    parts = 1 + 2 * links.count() // LINKS_PER_FILE
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = written(both.where("a != b").distinct().coalesce(parts), f"{name}-edges")
    labels = written(edges.groupBy(F.col("a").alias("node"))
                     .agg(F.least(F.col("a"), F.min("b")).alias("label")).coalesce(parts),
                     f"{name}-label")
    discard(links)
    while True:
        near = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        now = labels.select("node", "label")
        mine = now.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        up = now.select(F.col("node").alias("low"), F.col("label").alias("top"))
        nxt = mine.join(up, "low").select("node", F.least("low", "top").alias("label"),
                                          (F.least("low", "top") != F.col("label")).alias("moved"))
        nxt = written(nxt.coalesce(parts), f"{name}-label")
        discard(labels)
        labels = nxt
        if nxt.where("moved").isEmpty():
            discard(edges)
            return nxt.select("node", "label")
