"""Data-quality checks that return their findings as tables (one row per check), never as
log lines: a failed check is a row with ``passed = false``, not an absent entry."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The declared quality limits.
MAX_NULL_SHARE = 0.1
MIN_ROWS = 1


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_count, row_count)`` for each column, from a single pass.

    All counters are computed by one aggregate (partial per task), then unpivoted; an empty
    table gives zeros rather than NULL sums.
    """
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).cast("bigint").alias("_rows"),
                  *[F.count_if(F.col(c).isNull()).cast("bigint").alias(f"_n{i}")
                    for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)",
                           "_rows AS row_count")


def thresholds(df: DataFrame, columns: Sequence[str] | None = None,
               max_null_share: float = MAX_NULL_SHARE, min_rows: int = MIN_ROWS) -> DataFrame:
    """Null share per column against ``max_null_share`` and the row floor ``min_rows``."""
    share = F.when(F.col("row_count") > 0, F.col("null_count") / F.col("row_count"))
    return (null_counts(df, columns)
            .withColumn("null_share", share.cast("double"))
            .withColumn("passed", F.coalesce((F.col("null_share") <= max_null_share)
                                             & (F.col("row_count") >= min_rows), F.lit(False))))


def missing_tables(spark: SparkSession, expected: Sequence[tuple[str, str]],
                   summary: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """Expected ``(layer, table_name)`` pairs left-joined to a summary of what exists.

    ``summary`` has ``layer, table_name, row_count``.  A table that is absent, or has fewer
    than ``min_rows`` rows, fails.  The expected list is a handful of names (a literal frame).
    """
    want = spark.createDataFrame(list(expected), "layer string, table_name string")
    have = summary.select("layer", "table_name", "row_count")
    j = want.join(have, ["layer", "table_name"], "left")
    return j.select("layer", "table_name",
                    F.col("row_count").isNotNull().alias("found"),
                    F.coalesce(F.col("row_count"), F.lit(0)).cast("bigint").alias("row_count"),
                    F.coalesce(F.col("row_count") >= min_rows, F.lit(False)).alias("passed"))


def layer_summary(summary: DataFrame) -> DataFrame:
    """Per layer: number of tables and total rows, from a ``(layer, table_name, row_count)`` frame."""
    return summary.groupBy("layer").agg(
        F.count(F.lit(1)).cast("bigint").alias("tables"),
        F.sum("row_count").cast("bigint").alias("total_rows"))
