"""Bucketed facts and repositories: no exchange in the join, hot keys dealt, same rows."""

import pytest
from pyspark.sql import functions as F

from sediment.operators.colocate import colocated, colocated_left_join, join_columns
from sediment.operators.joins import left_join_keys
from sediment.plans import silver
from sediment.plans.catalog import _no_stamps, _own_schema
from sediment.session import scratch_path
from sediment.sources import driver_tables as dt

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def schema(spark):
    name = _own_schema(spark)
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def test_join_of_stored_tables_has_no_exchange(spark, schema, capsys):
    b = dt.bronze_inputs(spark, SF)
    path = scratch_path(spark, "colocated")
    issues, repos = silver.store_colocated(b["issues"], b["repositories"], "issues", "issue_id", schema, path, 8)
    got = _no_stamps(silver.fact_issues(issues, repos, join=colocated_left_join))
    got.explain("simple")
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    want = _no_stamps(silver.fact_issues(b["issues"], b["repositories"]))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_hot_and_missing_keys_are_dealt(spark, schema):
    """A third of the facts name one repository, a third none."""
    n = 6000
    facts = spark.range(n).select(
        F.col("id").alias("fact"),
        F.when(F.col("id") % 3 == 0, "o").when(F.col("id") % 6 == 1, "").when(F.col("id") % 3 == 2, F.concat(F.lit("o"), F.col("id") % 50)).alias("a"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise("r").alias("b"))
    dim = spark.createDataFrame([("o", "hot", 1), ("o", "hot", 2), (None, "r", 3), ("", "r", 4)]
                                + [(f"o{i}", "r", 10 + i) for i in range(0, 40)], "x string, y string, v int")
    f, d = colocated(facts, dim, ["a", "b"], ["x", "y"], "fact", hot_rows=100)
    keys = join_columns(2)
    assert max(r["count"] for r in f.groupBy(*keys).count().collect()) < 200
    loads = f.repartition(16, *keys).groupBy(F.spark_partition_id()).count().collect()
    assert len(loads) == 16 and max(r["count"] for r in loads) < 3 * n / 16
    got = colocated_left_join(f, d, ["a", "b"], ["x", "y"], {"v": "v"})
    want = left_join_keys(facts, dim, ["a", "b"], ["x", "y"], {"v": "v"})
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_empty_sides_and_plain_tables(spark):
    facts = spark.createDataFrame([], "fact long, a string")
    dim = spark.createDataFrame([("x", 1)], "k string, v int")
    f, d = colocated(facts, dim, ["a"], ["k"], "fact")
    assert colocated_left_join(f, d, ["a"], ["k"], ["v"]).isEmpty() and d.count() == 1
    one = spark.createDataFrame([(1, "x"), (2, None)], "fact long, a string")
    f, d = colocated(one, dim.limit(0), ["a"], ["k"], "fact")
    assert sorted(r["v"] is None for r in colocated_left_join(f, d, ["a"], ["k"], ["v"]).collect()) == [True, True]
    with pytest.raises(ValueError):
        colocated_left_join(one, dim, ["a"], ["k"], ["v"])
