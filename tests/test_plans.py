"""Plan checks: one scan per source, pruned read schemas, pushed filters, no Python on the row
path, bounded broadcasts only."""

import re

import pytest

from sediment.plans import silver
from sediment.sources import driver_tables as dt
from sediment.operators.feeds import children_of, maybe_in, top_k, top_k_per_group
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df, capsys, mode="formatted"):
    df.explain(mode)
    return capsys.readouterr().out


@pytest.fixture()
def bronze(spark):
    return dt.bronze_inputs(spark, SF)


def test_dim_users_scans_each_source_once(spark, bronze, capsys):
    p = plan(silver.dim_users(bronze["repositories"], bronze["commits"], bronze["issues"]), capsys)
    scans = re.findall(r"Scan parquet [^\n]*", p)
    assert len([s for s in scans if "Scan parquet" in s]) > 0
    for table in ("documents", "conversations", "orders", "lineitem"):
        assert p.count(f"/{table}.parquet") == 1, table


def test_repository_text_is_pruned_from_fact_join(spark, bronze, capsys):
    p = plan(silver.fact_issues(bronze["issues"], bronze["repositories"]), capsys)
    docs = [line for line in p.splitlines() if "ReadSchema" in line and "doc_id" in line]
    assert docs and all("text" not in line for line in docs)


def test_key_filter_reaches_scan(spark, bronze, capsys):
    p = plan(silver.dim_repositories(bronze["repositories"], bronze["repo_details"]), capsys)
    assert "PushedFilters: [IsNotNull(doc_id)]" in p


def test_no_python_evaluation(spark, bronze, capsys):
    for df in (silver.fact_commits(bronze["commits"], bronze["repositories"]),
               silver.fact_pull_requests(bronze["issues"], bronze["repositories"])):
        p = plan(df, capsys)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_topk_plans(spark, bronze, capsys):
    p = plan(top_k(bronze["repositories"], 10, [F.desc("stars"), F.asc("repo_id")]), capsys)
    assert "TakeOrderedAndProject" in p
    p = plan(top_k_per_group(bronze["issues"], ["user_id"], [F.desc("created_at"),
                                                              F.asc("issue_id")], 5), capsys)
    assert "WindowGroupLimit" in p


def test_only_bounded_parents_are_broadcast(spark, bronze, capsys):
    p = plan(children_of(bronze["issues"], bronze["repositories"], ["user_id"], ["owner_id"], 10,
                         [F.desc("stars"), F.asc("repo_id")]), capsys)
    assert "BroadcastExchange" in p


def test_unbounded_parents_filter_children_below_the_shuffle(spark, bronze, capsys):
    wide = bronze["issues"].select("issue_id", "user_id", "body")
    p = plan(children_of(wide, bronze["repositories"].where("stars > 1000"), ["user_id"], ["owner_id"]), capsys, "simple")
    lines = p.splitlines()
    semi = [i for i, x in enumerate(lines) if "LeftSemi" in x]
    assert "SortMergeJoin" in lines[semi[0]] and "BroadcastHashJoin" in lines[semi[1]]
    between = [x for x in lines[semi[0]:semi[1]] if "Exchange hashpartitioning(user_id" in x]
    assert len(between) == 1 and "bitmap_construct_agg" in p  # the children are filtered before it


@pytest.mark.parametrize("bits", [64, 1 << 15, (1 << 20) + 7])
def test_bit_filter_loses_no_child(spark, bits):
    parents = spark.range(0, 3000, 3).select(F.col("id").cast("int").alias("a"), F.concat(F.lit("r"), "id").alias("b"))
    parents = parents.union(parents).union(spark.sql("SELECT CAST(NULL AS INT), 'r1'"))
    rows = spark.range(6000).select(F.col("id").alias("x"), F.concat(F.lit("r"), "id").alias("y"), F.lit(1).alias("_pk"))
    rows = rows.union(spark.sql("SELECT CAST(NULL AS BIGINT), 'r1', 1"))
    near = maybe_in(rows, [F.col("x"), F.col("y")], parents.distinct(), bits)
    kept = {r["x"] for r in near.collect()}
    assert near.columns == rows.columns and kept >= set(range(0, 3000, 3))
    if bits > 1 << 16:
        assert len(kept) < 1100
    got = children_of(rows, parents, ["x", "y"], ["a", "b"], bits=bits)
    assert sorted(r["x"] for r in got.collect()) == list(range(0, 3000, 3))
    assert children_of(rows, parents.limit(0), ["x", "y"], ["a", "b"], bits=bits).isEmpty()


def test_bit_filter_is_bounded(spark):
    with pytest.raises(ValueError):
        maybe_in(spark.range(1), [F.col("id")], spark.range(1), 1 << 28)


def test_null_spreading_keeps_column_pruning(spark, bronze, capsys):
    # The permissions dimension uses no description: the text column must not be read,
    # even though the merge spreads NULL-keyed rows with an extra join key.
    p = plan(silver.dim_repo_permissions(bronze["repositories"], bronze["repo_details"]), capsys)
    docs = [line for line in p.splitlines() if "ReadSchema" in line and "doc_id" in line]
    assert docs and all("text" not in line for line in docs)


def test_roles_fold_in_a_hash_aggregate(spark, bronze, capsys):
    from sediment.operators.roles import role_aggregate, role_union
    p = plan(role_aggregate(role_union(bronze["repositories"], bronze["commits"], bronze["issues"])), capsys)
    top = p[:p.index("\n\n")]
    assert "HashAggregate" in top and "ObjectHashAggregate" not in top and "SortAggregate" not in top


@pytest.fixture()
def stored(spark, bronze, tmp_path):
    from sediment.sources.tables import write_parquet
    return {t: spark.read.parquet(write_parquet(bronze[t], str(tmp_path / t)))
            for t in ("issues", "repositories")}


def test_small_dimension_leaves_the_fact_unshuffled(spark, stored, capsys):
    p = plan(silver.fact_issues(stored["issues"], stored["repositories"]).where("state = 'open'"), capsys)
    assert "BroadcastHashJoin" in p and "Exchange hashpartitioning" not in p
    assert "EqualTo(state,open)" in p


def test_large_dimension_is_shuffled(spark, stored, capsys, monkeypatch):
    from sediment.operators import joins
    monkeypatch.setattr(joins, "BROADCAST_FILE_BYTES", 0)
    p = plan(silver.fact_issues(stored["issues"], stored["repositories"]).where("state = 'open'"), capsys)
    assert "SortMergeJoin" in p and "EqualTo(state,open)" in p


def test_newest_rows_groups_narrow_columns_only(spark, tmp_path, capsys):
    from sediment.operators.merge import latest_per_key, newest_rows
    from sediment.sources.tables import write_parquet
    rows = [(k, f"2024-01-0{d}", f"f{d}", "x" * 50) for k in range(40) for d in range(1, 1 + k % 3)]
    rows += [(None, "2024-01-01", "f1", "a"), (None, "2024-01-01", "f1", "a")]
    df = spark.createDataFrame(rows, "id int, day string, file string, body string")
    log = spark.read.parquet(write_parquet(df, str(tmp_path / "log")))
    newest = newest_rows(log, ["id"], ["day", "file"])
    want = latest_per_key(log, ["id"], ["day", "file"])
    assert sorted(map(repr, newest.collect())) == sorted(map(repr, want.collect()))
    p = plan(newest, capsys)
    assert all("body" not in line for line in p.splitlines() if "Aggregate" in line or "functions=" in line)
    once = spark.read.parquet(write_parquet(df.dropDuplicates(["id"]), str(tmp_path / "once")))
    assert "Aggregate" not in plan(newest_rows(once, ["id"], ["day", "file"]), capsys)


def test_many_replaced_rows_are_marked_not_shuffled(spark, tmp_path, capsys, monkeypatch):
    from sediment.operators import merge as M

    path = str(tmp_path / "log")
    rows = spark.range(5000).selectExpr("IF(id % 7 = 0, NULL, id % 1500) AS id", "id div 1500 AS day",
                                        "'f' AS file", "CAST(id % 4 AS STRING) AS v", "repeat('x', 50) AS wide")
    rows.unionAll(rows.where("day = 3 AND id < 300").withColumn("v", F.lit("9"))).repartition(3).write.parquet(path)
    log = spark.read.parquet(path)
    for small in (10 ** 6, 5, 0):  # broadcast by place, as marks, shuffled
        got = M.newest_of_placed(M.placed(log), ["id"], ["day", "file"], small)
        want = M.latest_per_key(log, ["id"], ["day", "file"])
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    distinct = spark.range(90000).selectExpr("id % 45000 AS id", "id div 45000 AS day", "'f' AS file", "'x' AS wide")
    distinct.coalesce(1).write.parquet(path + "2")
    log = spark.read.parquet(path + "2")
    for newest in (M.newest_rows(log, ["id"], ["day", "file"], 5),
                   M.newest_of_placed(M.placed(log), ["id"], ["day", "file"], 5)):
        assert newest.agg(F.count("id"), F.min("day"), F.count_distinct("id")).first()[:] == (45000, 1, 45000)
        lines = plan(newest, capsys).split("\n")
        assert any("bitmap_construct_agg" in x for x in lines)
        assert "BroadcastHashJoin LeftOuter" in next(x for x in lines if "Join" in x)  # the join of the wide rows
