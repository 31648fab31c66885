"""Counts from footers, and point reads that skip row groups."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sediment.sources.tables import (footer_counts, footer_summary, table_summary, write_clustered,
                                     write_parquet)


def test_counts_come_from_footers(spark, tmp_path):
    paths = {n: write_parquet(spark.range(k).select("id", F.lit("x").alias("s")).repartition(3), str(tmp_path / n))
             for n, k in (("a", 1000), ("b", 0))}
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    plan = footer_counts(spark, paths)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedAggregation: [COUNT(*)]") == 2 and "ReadSchema: struct<count(*):bigint>" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    want = table_summary({n: spark.read.parquet(p) for n, p in paths.items()})
    assert sorted(map(tuple, footer_summary(spark, paths).collect())) == sorted(map(tuple, want.collect()))


def test_point_reads_skip_row_groups(spark, tmp_path):
    n = 60_000
    rows = spark.range(n).select((F.col("id") * 7919 % n).alias("issue_id"), F.sha2(F.col("id").cast("string"), 256).alias("body"))
    rows = rows.unionByName(spark.range(500).select(F.lit(None).cast("bigint").alias("issue_id"), F.lit("n").alias("body")))
    path = write_clustered(rows, str(tmp_path / "t"), "issue_id", row_group_bytes=64 << 10)
    files = glob.glob(path + "/*.parquet")
    groups = [pq.ParquetFile(f).metadata.row_group(i) for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    hit = [g for g in groups if g.column(0).statistics.has_min_max
           and g.column(0).statistics.min <= 41 and g.column(0).statistics.max >= 3]
    assert len(groups) > 8 and len(hit) == 1
    found = spark.read.parquet(path).where(F.col("issue_id").isin([3, 41, n + 5]))
    assert sorted(r["issue_id"] for r in found.collect()) == [3, 41]
    plan = found._jdf.queryExecution().executedPlan()
    assert "PushedFilters: [In(issue_id" in plan.toString()
    # What the scan gave on: whole row groups or pages, not the table.
    text = found._jdf.queryExecution().executedPlan()
    while text.children().nonEmpty():
        text = text.children().head()
    read = text.metrics().get("numOutputRows").get().value()
    assert 0 < read <= max(g.num_rows for g in hit)


def test_clustered_table_keeps_every_row(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "k bigint, v string")
    path = write_clustered(rows, str(tmp_path / "t"), "k")
    assert sorted(map(tuple, spark.read.parquet(path).collect()), key=repr) == sorted(map(tuple, rows.collect()), key=repr)
