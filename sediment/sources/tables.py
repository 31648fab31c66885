"""Parquet and catalog sinks, and the table summary.

A table is replaced as a whole (snappy Parquet).  The new files are written beside the old ones
and take their place by two renames once they are complete, so a failing job leaves the former
table as it was; should the process die between the renames, the former table is found beside
its place under ``<path>.old-*``.  A written table is also where lineage is cut, so a lost
executor later costs a re-read of Parquet, not a recomputation of the chain.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.session import drop_path, dropping_shuffles, move_path, path_exists


def write_parquet(df: DataFrame, path: str, options: Mapping[str, str] | None = None) -> str:
    spark, tag, path = df.sparkSession, uuid.uuid4().hex[:12], path.rstrip("/")
    fresh, former = f"{path}.new-{tag}", f"{path}.old-{tag}"
    try:
        with dropping_shuffles(spark):
            df.write.option("compression", "snappy").options(**(options or {})).parquet(fresh)
    except Exception:
        drop_path(spark, fresh)
        raise
    if path_exists(spark, path):
        move_path(spark, path, former)
    move_path(spark, fresh, path)
    drop_path(spark, former)
    spark.catalog.refreshByPath(path)
    return path


def ensure_schema(spark: SparkSession, schema: str, location: str | None = None) -> None:
    """``CREATE SCHEMA IF NOT EXISTS`` (optionally placed at a shared location)."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{loc}")


def save_table(df: DataFrame, name: str, schema: str = "silver", path: str | None = None) -> str:
    """Create-or-replace a catalog table from a frame, Parquet format.

    The built-in catalog refuses ``CREATE OR REPLACE TABLE ... AS``.  With ``path`` the files
    are written there first (external table) and the catalog entry is made anew; without, a
    table of another name is written and renamed.  Either way a failing job changes nothing.
    """
    spark, full = df.sparkSession, f"{schema}.{name}"
    if path:
        write_parquet(df, path)
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.catalog.createTable(full, path=path, source="parquet")
        return full
    fresh = f"{full}__{uuid.uuid4().hex[:8]}"
    df.write.format("parquet").saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {full}")
    return full


def save_bucketed(df: DataFrame, name: str, schema: str, path: str, keys: Sequence[str], buckets: int) -> str:
    """Write ``df`` at ``path`` as a catalog table bucketed and sorted by ``keys``, one file for each
    bucket: the rows are shuffled once here, and joins of equally bucketed tables need no exchange."""
    full = f"{schema}.{name}"
    (df.repartition(buckets, *keys).write.format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(full))
    return full


def table_summary(tables: Mapping[str, DataFrame] | Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """``(table_name, row_count, column_count)`` for each table, as one union of aggregates.

    Each branch is a global count (partial counts per task, one tiny final step).  A table
    that cannot be read is the caller's to catch when building the mapping.
    """
    items = list(tables.items()) if isinstance(tables, Mapping) else list(tables)
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count",
                     F.lit(len(df.columns)).cast("bigint").alias("column_count"))
             for name, df in items]
    return reduce(DataFrame.unionByName, parts)


FOOTER_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def footer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``(table_name, row_count)`` of Parquet tables from their footers: no column is read
    (``PushedAggregation``).

    The settings it needs are those of a session of its own, which shares nothing but the context.
    A table whose files hold no row counts NULL there.
    """
    own = spark.newSession()
    for k, v in FOOTER_CONF.items():
        own.conf.set(k, v)
    parts = [own.read.parquet(p).agg(F.count(F.lit(1)).alias("n"))
             .select(F.lit(name).alias("table_name"), F.col("n").alias("row_count"))
             for name, p in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def footer_summary(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """``table_summary`` of Parquet tables by path, from their footers (one row per table)."""
    rows = [(r["table_name"], r["row_count"] or 0, len(spark.read.parquet(paths[r["table_name"]]).columns))
            for r in footer_counts(spark, paths).collect()]
    return spark.createDataFrame(rows, "table_name string, row_count bigint, column_count bigint")


def write_clustered(df: DataFrame, path: str, key: str, row_group_bytes: int = 16 << 20) -> str:
    """Write a Parquet table for point reads on ``key``: files and rows ascend by it, so that files,
    row groups and pages are told apart by their bounds, and every row group has a Bloom filter.

    A key that repeats very often is spread by the rest of the row.
    """
    rest = [c for c in df.columns if c != key][:1]
    rows = df.repartitionByRange(key, *rest).sortWithinPartitions(key)
    return write_parquet(rows, path, {
        "parquet.block.size": str(row_group_bytes), f"parquet.bloom.filter.enabled#{key}": "true"})


def catalog_tables(spark: SparkSession, schema: str) -> tuple[dict[str, DataFrame], list[str]]:
    """Readable tables of a catalog schema by name, and the names that could not be resolved.

    A table that fails to resolve is reported, not fatal: the others are still summarised.
    """
    if not spark.catalog.databaseExists(schema):
        return {}, []
    good, bad = {}, []
    for t in spark.catalog.listTables(schema):
        if t.isTemporary:   # session views are listed too; they are not tables of the schema
            continue
        try:
            good[t.name] = spark.read.table(f"{schema}.{t.name}")
        except AnalysisException:
            bad.append(t.name)
    return good, bad


def catalog_summary(spark: SparkSession, schema: str) -> DataFrame:
    """``table_summary`` of every table in ``schema``; unresolvable tables get NULL counts."""
    good, bad = catalog_tables(spark, schema)
    empty = spark.createDataFrame([(n, None, None) for n in bad],
                                  "table_name string, row_count bigint, column_count bigint")
    return table_summary(good).unionByName(empty) if good else empty
