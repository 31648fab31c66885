"""Layer drivers: bronze -> silver, and landing -> bronze -> silver -> checks in one session.

Each silver table is written once (Parquet, optionally registered in the catalog); the next
consumer reads the written table, so lineage is cut at every layer boundary.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sediment.operators.joins import file_bytes
from sediment.plans.bronze import build_bronze
from sediment.plans.jobs import DEFAULT_PARALLEL, run_writes
from sediment.plans.quality import missing_tables
from sediment.plans.silver import (BUILDERS, dim_repo_permissions_from_merge,
                                   dim_repositories_from_merge, repo_merge)
from sediment.schemas import BRONZE_TABLES, FEEDS, SILVER_TABLES
from sediment.session import drop_path, dropping_shuffles, path_exists, scratch_path
from sediment.sources.landing import list_landing, scan_feed, envelope_report
from sediment.sources.tables import ensure_schema, footer_summary, save_table, write_parquet

MERGED = {"dim_repositories": dim_repositories_from_merge,
          "dim_repo_permissions": dim_repo_permissions_from_merge}
#: Silver tables are built side by side from stored bronze tables of so many bytes in all at most.
SIDE_BY_SIDE_BYTES = 128 << 20


def build_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], silver_dir: str,
                 tables: Sequence[str] = SILVER_TABLES, schema: str | None = None,
                 on_error: str = "raise", loaded_at: Column | None = None,
                 max_parallel: int = DEFAULT_PARALLEL) -> dict[str, str]:
    """Build the requested silver tables from bronze frames; ``{table: path}`` of written ones.

    The tables are independent jobs and run side by side (``max_parallel``); from stored bronze tables
    of more than ``SIDE_BY_SIDE_BYTES``, one after the other, so that only one table's shuffle files
    are on disk at a time.  With ``schema`` each table is also registered as ``schema.table``
    (external, at its path).
    ``on_error="skip"`` logs a failing table (also one whose input is missing) and goes on.
    """
    if schema:
        ensure_schema(spark, schema)
    if sum(file_bytes(df) or 0 for df in bronze.values()) > SIDE_BY_SIDE_BYTES:
        max_parallel = 1
    shared = list(MERGED) if set(MERGED) <= set(tables) else []
    frames: dict[str, Callable[[], DataFrame]] = {}
    for name in tables:
        builder, inputs = BUILDERS[name]
        frames[name] = (lambda b=builder, i=inputs:
                        b(*[bronze[x] for x in i], loaded_at=loaded_at))

    def write(name: str):
        path = f"{silver_dir.rstrip('/')}/{name}"
        if schema:
            return lambda: (save_table(frames[name](), name, schema, path), path)[1]
        return lambda: write_parquet(frames[name](), path)
    with dropping_shuffles(spark):
        done = run_writes({name: write(name) for name in tables if name not in shared}, on_error, max_parallel)
        if shared:
            # Both dimensions come from one full outer merge: run the join once, write it under the
            # checkpoint root (a lineage cut), and derive both tables from the written copy.  The copy
            # comes last, so that it does not lie beside the shuffle files of the facts.
            merge_path = scratch_path(spark, "repo_merge")
            frames.update({name: (lambda b=b: b(spark.read.parquet(merge_path), loaded_at))
                           for name, b in MERGED.items()})
            try:
                if run_writes({"repo_merge": lambda: write_parquet(
                        repo_merge(bronze["repositories"], bronze["repo_details"]), merge_path,
                        {"compression": "zstd"})}, on_error):
                    done |= run_writes({name: write(name) for name in shared}, on_error, max_parallel)
            finally:
                drop_path(spark, merge_path)
    return {name: done[name] for name in tables if name in done}


def layered_summary(spark: SparkSession, landing_dir: str | None, bronze: Mapping[str, str],
                    silver: Mapping[str, str], layout: str = "document",
                    landed: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """``(layer, table_name, row_count, column_count)`` for landing feeds and written tables.

    Landing rows are the number of landed records per feed: those that ``build_bronze`` observed
    (``landed``), else one parse of the feed's files; pass ``landing_dir=None`` to summarise only the written Parquet tables,
    whose counts come from their footers.
    """
    parts = []
    if landed is not None:
        parts.append(spark.createDataFrame(
            [("landing", f, int(landed.get(f, {}).get("items", 0)), None) for f in FEEDS],
            "layer string, table_name string, row_count bigint, column_count bigint"))
    elif landing_dir is not None:
        parts.append(reduce(DataFrame.unionByName, [
            envelope_report(scan_feed(spark, landing_dir, f, layout), f)
            .select(F.lit("landing").alias("layer"), F.col("feed").alias("table_name"),
                    F.col("items").alias("row_count"),
                    F.lit(None).cast("bigint").alias("column_count"))
            for f in FEEDS]))
    for layer, paths in (("bronze", bronze), ("silver", silver)):
        if paths:
            s = footer_summary(spark, paths)
            parts.append(s.select(F.lit(layer).alias("layer"), "table_name", "row_count",
                                  "column_count"))
    if not parts:
        return spark.createDataFrame([], "layer string, table_name string, row_count bigint, "
                                         "column_count bigint")
    return reduce(DataFrame.unionByName, parts)


def run_layers(spark: SparkSession, landing_dir: str, work_dir: str, layout: str = "document",
               tables: Sequence[str] = SILVER_TABLES, on_error: str = "raise",
               loaded_at: Column | None = None) -> DataFrame:
    """Landing -> bronze -> silver, then the presence / row-count check of every artifact.

    A landing zone without files is an error, whatever ``on_error``.  Returns ``(layer, table_name, found, row_count, passed)`` per expected table.
    """
    work = work_dir.rstrip("/")
    bronze = build_bronze(spark, landing_dir, f"{work}/bronze", layout, on_error=on_error,
                          loaded_at=loaded_at)
    frames = {t: spark.read.parquet(p) for t, p in bronze.items()}
    silver = build_silver(spark, frames, f"{work}/silver", tables, on_error=on_error,
                          loaded_at=loaded_at)
    summary = layered_summary(spark, None, bronze, silver)
    expected = ([("bronze", t) for t in BRONZE_TABLES] + [("silver", t) for t in tables])
    return missing_tables(spark, expected, summary)


def existing_tables(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, str]:
    """``{table: path}`` of the tables that exist under a layer's directory."""
    paths = {t: f"{base.rstrip('/')}/{t}" for t in names}
    return {t: p for t, p in paths.items() if path_exists(spark, p)}


def landing_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """Landing files per routed feed (unknown names under ``''``), contents unread."""
    return (list_landing(spark, landing_dir).groupBy("feed")
            .agg(F.count(F.lit(1)).cast("bigint").alias("files"),
                 F.sum("length").cast("bigint").alias("bytes")))


def layer_checks(spark: SparkSession, landing_dir: str, work_dir: str, layout: str = "document",
                 max_null_share: float = 0.1) -> DataFrame:
    """The layer-by-layer verification as one table ``(layer, check_name, passed, detail)``.

    landing: there are documents, and every one is well formed and carries time and payload (all
    files, not a sample); bronze / silver: every expected table exists with rows; quality: the
    repository dimension's key, name and stars are within the null-share limit.  Each check is a
    row, so a failure is reported next to the successes.  Nothing is written or rebuilt.  In the
    ``document`` layout the number of files per feed is reported too, and files whose name
    belongs to no feed (``files:``) fail.
    """
    from sediment.plans.quality import thresholds

    landing = reduce(DataFrame.unionByName,
                     [envelope_report(scan_feed(spark, landing_dir, f, layout), f) for f in FEEDS])
    landing_rows = landing.select(
        F.lit("landing").alias("layer"), F.concat(F.lit("envelope:"), "feed").alias("check_name"),
        ((F.col("documents") > 0)
         & ((F.col("malformed") + F.col("without_timestamp") + F.col("without_data")) == 0))
        .alias("passed"),
        F.col("documents").alias("detail"))
    bronze, silver = (existing_tables(spark, f"{work_dir.rstrip('/')}/{layer}", names)
                      for layer, names in (("bronze", BRONZE_TABLES), ("silver", SILVER_TABLES)))
    expected = [("bronze", t) for t in BRONZE_TABLES] + [("silver", t) for t in SILVER_TABLES]
    tables = missing_tables(spark, expected, layered_summary(spark, None, bronze, silver)).select(
        "layer", F.concat(F.lit("table:"), "table_name").alias("check_name"), "passed",
        F.col("row_count").alias("detail"))
    parts = [landing_rows, tables]
    if layout == "document":
        parts.append(landing_files(spark, landing_dir).select(
            F.lit("landing").alias("layer"), F.concat(F.lit("files:"), "feed").alias("check_name"),
            (F.col("feed") != "").alias("passed"), F.col("files").alias("detail")))
    if "dim_repositories" in silver:
        dim = spark.read.parquet(silver["dim_repositories"])
        parts.append(thresholds(dim, ["repo_id", "repo_name", "stars"], max_null_share).select(
            F.lit("quality").alias("layer"),
            F.concat(F.lit("nulls:dim_repositories."), "column_name").alias("check_name"),
            "passed", F.col("null_count").alias("detail")))
    return reduce(DataFrame.unionByName, parts)
