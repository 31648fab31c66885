"""Bucketed incremental tables: equal to a full rebuild, touching only the buckets they must."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sediment.plans import silver
from sediment.plans.bronze import build_bronze
from sediment.schemas import BRONZE_KEYS
from sediment.streaming import tables as T
from sediment.streaming.incremental import LOG_COLUMNS


def write(folder, name, feed, records, ts):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        json.dump({"ingestion_timestamp": ts, "data": {feed: records}}, f, indent=1)


def issue(i, title, user, assignee=None):
    own = {"id": i, "title": title, "user": {"id": user, "login": f"u{user}", "type": "User"}}
    if assignee:
        own["assignee"] = {"id": assignee, "login": f"u{assignee}", "type": "User"}
    return own


def rows(df):
    return sorted(map(tuple, df.drop("bronze_ingestion_timestamp", "silver_ingestion_timestamp").collect()), key=repr)


def run(spark, landing, work, feeds=("issues",)):
    for feed in feeds:
        T.ingest(spark, landing, work, feed, "document", buckets=8).awaitTermination()


def rebuilt(spark, landing, tmp, feeds=("issues",)):
    paths = build_bronze(spark, landing, f"{tmp}/rebuilt", feeds=list(feeds))
    return {f: spark.read.parquet(p) for f, p in paths.items()}


@pytest.fixture()
def zone(tmp_path):
    return str(tmp_path / "landing"), str(tmp_path / "work"), str(tmp_path)


def test_overlapping_landings_equal_a_rebuild(spark, zone):
    landing, work, tmp = zone
    write(landing, "issues_a_20240101_000000.json", "issues",
          [issue(i, "old", i % 5, 100 + i) for i in range(40)] + [{"title": "no key"}], "2024-01-01T00:00:00")
    run(spark, landing, work)
    assert rows(T.bronze_table(spark, work, "issues")) == rows(rebuilt(spark, landing, tmp)["issues"])
    write(landing, "issues_b_20240201_000000.json", "issues",
          [issue(i, "new", i % 7) for i in range(30, 60)] + [{"title": "no key"}], "2024-02-01T00:00:00")
    # Late: an older landing of a record must not win.
    write(landing + "/late", "issues_c_20231201_000000.json", "issues", [issue(35, "older", 1)], "2023-12-01T00:00:00")
    run(spark, landing, work)
    want = rebuilt(spark, landing, tmp)["issues"]
    got = T.bronze_table(spark, work, "issues")
    assert rows(got) == rows(want) and got.where("issue_id IS NULL").count() == 2
    # Former assignees of replaced records are gone from the users too.
    users = silver.dim_users_of(T.user_identities(spark, work))
    empty = {f: spark.createDataFrame([], s) for f, s in (
        ("repos", "owner_id long, owner_login string, owner_type string, owner_url string"),
        ("commits", ", ".join(f"{p}_{c}" for p in ("author", "committer") for c in (
            "id long", "login string", "type string", "html_url string", "email string", "name string"))))}
    assert rows(users) == rows(silver.dim_users(empty["repos"], empty["commits"], want))
    assert users.where("user_id = 135").isEmpty() and not users.where("user_id = 120").isEmpty()


def test_only_touched_buckets_are_read_and_written(spark, zone):
    landing, work, _ = zone
    write(landing, "issues_a_20240101_000000.json", "issues", [issue(i, "x", 1) for i in range(200)], "2024-01-01T00:00:00")
    run(spark, landing, work)
    base = f"{work}/bronze/issues"
    before = {d: sorted(os.listdir(f"{base}/{d}")) for d in os.listdir(base) if d.startswith("_bucket=")}
    assert len(before) == 8
    write(landing, "issues_b_20240201_000000.json", "issues", [issue(7, "y", 2)], "2024-02-01T00:00:00")
    run(spark, landing, work)
    after = {d: sorted(os.listdir(f"{base}/{d}")) for d in os.listdir(base) if d.startswith("_bucket=")}
    changed = {d for d in after if before.get(d) != after[d]}
    own = spark.range(1).select(F.pmod(F.xxhash64(F.lit(7).cast("long")), F.lit(8))).first()[0]
    assert changed == {f"_bucket={own}"}
    roles = f"{work}/user_roles/issues/feed=issues"
    assert len([d for d in os.listdir(roles) if d.startswith("_bucket=")]) == 8

    plan = T.read_buckets(spark, base, [own])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = T.read_buckets(spark, base, [own])
    assert len(read.select(F.col("_metadata.file_path")).distinct().collect()) == len(after[f"_bucket={own}"]) - sum(
        f.endswith(".crc") for f in after[f"_bucket={own}"])


def test_a_repeated_batch_changes_nothing(spark, zone):
    _, work, _ = zone
    batch = spark.createDataFrame(
        [(1, "a"), (2, "b"), (None, "c")], "issue_id long, title string").withColumns(
        {LOG_COLUMNS[0]: F.lit("2024-01-01").cast("timestamp"), LOG_COLUMNS[1]: F.lit("f")})
    once = T.upsert(batch, f"{work}/t", "issues", 0, 4)
    first = rows(spark.read.parquet(f"{work}/t"))
    assert T.upsert(batch, f"{work}/t", "issues", 0, 4) == once
    assert rows(spark.read.parquet(f"{work}/t")) == first and len(first) == 3
    T.upsert(batch, f"{work}/t", "issues", 1, 4)
    assert len(rows(spark.read.parquet(f"{work}/t"))) == 4  # a row without key, landed again
    assert T.upsert(batch.limit(0), f"{work}/t", "issues", 2, 4) == []


def test_daily_runs_build_the_silver_tables(spark, zone):
    landing, work, tmp = zone
    feeds = ("repositories", "commits", "issues")
    url = "https://github.com/u1/r1/issues/1"
    write(landing, "repositories_20240101_000000.json", "repositories",
          [{"id": 1, "name": "r1", "stargazers_count": 5, "owner": {"id": 1, "login": "u1"}}], "2024-01-01T00:00:00")
    write(landing, "commits_u1_r1_20240101_000000.json", "commits",
          [{"sha": "s", "commit": {"message": "fix: x"}, "author": {"id": 3, "login": "u3"}}], "2024-01-01T00:00:00")
    write(landing, "issues_u1_r1_20240101_000000.json", "issues",
          [{**issue(1, "t", 2), "html_url": url}, issue(2, "t", 4)], "2024-01-01T00:00:00")
    out = T.daily(spark, landing, work, "document", buckets=4)
    assert set(out) == {"dim_users", "fact_commits", "fact_issues", "fact_pull_requests"}  # no details landed yet
    write(landing, "issues_u1_r1_20240201_000000.json", "issues", [{**issue(1, "t2", 9), "html_url": url}], "2024-02-01T00:00:00")
    out = T.daily(spark, landing, work, "document", buckets=4)
    frames = rebuilt(spark, landing, tmp, feeds)
    assert rows(spark.read.parquet(out["fact_issues"])) == rows(silver.fact_issues(frames["issues"], frames["repositories"]))
    users = silver.dim_users(frames["repositories"], frames["commits"], frames["issues"])
    assert rows(spark.read.parquet(out["dim_users"])) == rows(users)
    assert BRONZE_KEYS["issues"] == ["issue_id"]


def test_unusable_documents_go_to_quarantine(spark, zone):
    landing, work, _ = zone
    write(landing, "issues_a_20240101_000000.json", "issues", [issue(1, "x", 1)], "2024-01-01T00:00:00")
    with open(f"{landing}/issues_b_20240101_000000.json", "w") as f:
        f.write('{"data": {"iss')
    run(spark, landing, work)
    bad = spark.read.parquet(f"{work}/quarantine/issues")
    assert [r["reason"] for r in bad.collect()] == ["malformed"]
    assert T.bronze_table(spark, work, "issues").count() == 1


def test_large_batches_are_written_by_the_tasks_that_read_them(spark, tmp_path, monkeypatch):
    rows = spark.range(3000).selectExpr("IF(id % 50 = 0, NULL, id % 1000) AS issue_id", "concat('t', id) AS title",
                                        "timestamp'2024-01-01' + make_dt_interval(id div 1000) AS _landed_at",
                                        "'f' AS _source_file")
    stored = [str(tmp_path / f"batch{i}") for i in (0, 1)]
    rows.where("id < 1500").repartition(3).write.parquet(stored[0])
    rows.where("id >= 1500").repartition(3).write.parquet(stored[1])
    direct, was = [], T._write_from_scan
    monkeypatch.setattr(T, "_write_from_scan", lambda *a: (direct.append(1), was(*a)))

    def table(name, least):
        monkeypatch.setattr(T, "FILE_BYTES", least)
        for i, path in enumerate(stored):
            T.upsert(spark.read.parquet(path), f"{tmp_path}/{name}", "issues", i, 4, stored=True)
        return sorted(map(tuple, spark.read.parquet(f"{tmp_path}/{name}").select(
            "issue_id", "title", "_landed_at", "_bucket").collect()), key=repr)
    shuffled = table("a", 1 << 40)
    assert not direct and table("b", 1) == shuffled and len(direct) == 2
    assert len(shuffled) == 980 + 60 and all(r[0] is not None or r[3] >= 4 for r in shuffled)
