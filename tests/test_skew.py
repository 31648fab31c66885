"""Hot keys: one key holds a third of all rows.  Thresholds are lowered so that local data
counts as skewed; the final adaptive plan must show the skewed join split, and results must
stay exact."""

import pytest
from pyspark.sql import functions as F

from sediment.operators.joins import fanout_left_join, hot_keys, left_join_keys

SKEW_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def final_plan(df, capsys):
    df.collect()   # test-sized data; executing the frame itself makes its adaptive plan final
    df.explain()
    return capsys.readouterr().out


def test_hot_fact_key_is_split(skew_conf, capsys):
    spark = skew_conf
    n = 30000
    facts = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"),
        F.col("id").alias("v"), F.repeat(F.lit("x"), 20).alias("pad"))
    dims = spark.range(1000).select(F.col("id").alias("dk"), (F.col("id") * 2).alias("w"))
    out = left_join_keys(facts, dims, ["k"], ["dk"], ["w"])
    plan = final_plan(out, capsys)
    assert "skew=true" in plan
    assert out.count() == n and out.where("w IS NULL").count() == 0


def test_hot_dimension_key_is_split_in_fanout(skew_conf, capsys):
    spark = skew_conf
    # The owner 1 holds a third of all repositories.
    repos = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 500).alias("owner_id"),
        F.col("id").alias("repo_id"), F.repeat(F.lit("y"), 20).alias("pad"))
    prs = spark.range(600).select((F.col("id") % 700).alias("author_id"), F.col("id").alias("pr"))
    prs = prs.unionByName(spark.range(600, 900).select(F.lit(None).cast("bigint").alias("author_id"),
                                                       F.col("id").alias("pr")))
    assert [tuple(r) for r in hot_keys(repos, "owner_id", 100).collect()] == [(1, 3012)]
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")  # it is split without that
    out = fanout_left_join(prs, repos, "author_id", "owner_id", ["repo_id"], hot_rows=200)
    per_task = out.where("author_id = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 5 and max(r["count"] for r in per_task) < 1000
    nulls = out.where("author_id IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(nulls) > 1
    plan = final_plan(out, capsys).split("== Initial Plan ==")[0]
    assert plan.count("Range (0, 600") == 1 and plan.count("SortMergeJoin") == 1  # the fact is read once
    expected = left_join_keys(prs, repos, ["author_id"], ["owner_id"], ["repo_id"])
    assert out.count() == expected.count()
    assert out.exceptAll(expected).count() == 0


def test_null_keys_spread_in_full_outer_merge(skew_conf):
    from sediment.operators.merge import merge_coalesce
    spark = skew_conf
    # A third of the rows on each side has a NULL key: they must not all meet in one task.
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id"))
                                    .cast("bigint").alias("k"), F.col("id").alias("a"))
    right = spark.range(1500, 4500).select(F.when(F.col("id") % 3 == 0, F.lit(None))
                                           .otherwise(F.col("id")).cast("bigint").alias("k"),
                                           F.col("id").alias("a"))
    out = merge_coalesce(left, right, ["k"], ["k", "a"])
    per_task = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1
    l, r = left.where("k IS NOT NULL"), right.where("k IS NOT NULL")
    matched = l.join(r, "k").count()
    assert out.count() == left.count() + right.count() - matched


def test_null_keys_spread_in_left_join(skew_conf):
    spark = skew_conf
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 100).cast("bigint")
        .alias("k"), F.col("id").alias("v"))
    dims = spark.range(100).select(F.col("id").alias("dk"), F.col("id").alias("w"))
    out = left_join_keys(facts, dims, ["k"], ["dk"], ["w"])
    per_task = out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 1
    assert out.count() == 3000 and out.where("k IS NULL AND w IS NOT NULL").count() == 0
