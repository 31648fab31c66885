"""Silver builders on small hand-made bronze frames: merge cases, joins, role grain, fault
regressions and algebraic identities."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from sediment.operators.joins import left_join_keys, fanout_left_join
from sediment.operators.merge import latest_per_key, merge_coalesce
from sediment.plans import silver

#: Rows of a key from which it is dealt over several join keys, by case.
HOT = {1: 10_000, 16: 60}

REPO_SCHEMA = ("repo_id bigint, repo_name string, full_name string, description string, "
               "html_url string, clone_url string, language string, stars bigint, watchers bigint, "
               "forks bigint, open_issues bigint, size bigint, created_at string, updated_at string, "
               "pushed_at string, default_branch string, owner_id bigint, owner_login string, "
               "owner_type string, owner_url string, license_name string, license_key string, "
               "topics array<string>, archived boolean, disabled boolean, private boolean, "
               "fork boolean, bronze_ingestion_timestamp timestamp")
REPO_COLS = [c.split()[0] for c in REPO_SCHEMA.split(", ")]


def repos(spark, rows):
    full = []
    for r in rows:
        d = {c: None for c in REPO_COLS}
        d.update(r)
        full.append(tuple(d[c] for c in REPO_COLS))
    return spark.createDataFrame(full, REPO_SCHEMA)


ISSUE_SCHEMA = ("issue_id bigint, node_id string, issue_number bigint, title string, body string, "
                "state string, locked boolean, assignee_id bigint, assignee_login string, "
                "assignee_type string, assignee_html_url string, user_id bigint, user_login string, "
                "user_type string, user_html_url string, labels array<string>, milestone_id bigint, "
                "milestone_title string, milestone_description string, milestone_state string, "
                "comments_count bigint, created_at string, updated_at string, closed_at string, "
                "author_association string, active_lock_reason string, pull_request string, "
                "html_url string, url string, bronze_ingestion_timestamp timestamp")
ISSUE_COLS = [c.split()[0] for c in ISSUE_SCHEMA.split(", ")]


def issues(spark, rows):
    full = []
    for r in rows:
        d = {c: None for c in ISSUE_COLS}
        d.update(r)
        full.append(tuple(d[c] for c in ISSUE_COLS))
    return spark.createDataFrame(full, ISSUE_SCHEMA)


@pytest.fixture()
def merge_inputs(spark):
    left = repos(spark, [
        {"repo_id": 1, "repo_name": "only-left", "stars": 5},
        {"repo_id": 2, "repo_name": "both-left", "language": None, "stars": 20000},
        {"repo_id": None, "repo_name": "null-key-left"},
        {"repo_id": 4, "repo_name": "dup"}, {"repo_id": 4, "repo_name": "dup2"},
    ])
    right = repos(spark, [
        {"repo_id": 2, "repo_name": "both-right", "language": "Java", "archived": True},
        {"repo_id": 3, "repo_name": "only-right", "private": True},
        {"repo_id": None, "repo_name": "null-key-right"},
    ])
    return left, right


def test_merge_left_wins_and_fills(spark, merge_inputs):
    left, right = merge_inputs
    out = {r.repo_name: r for r in
           merge_coalesce(left, right, ["repo_id"], silver.REPO_COLUMNS).collect()}
    assert out["both-left"].language == "Java" and out["both-left"].archived is True
    assert "only-right" in out and "only-left" in out
    # NULL keys never match: both NULL-keyed rows pass through alone; duplicates are kept
    assert "null-key-left" in out and "null-key-right" in out
    assert merge_coalesce(left, right, ["repo_id"], silver.REPO_COLUMNS).count() == 7


def test_full_outer_count_identity(spark, merge_inputs):
    left, right = merge_inputs
    l, r = left.where("repo_id IS NOT NULL"), right.where("repo_id IS NOT NULL")
    matched = l.join(r, "repo_id").count()
    merged = merge_coalesce(l, r, ["repo_id"], ["repo_id"]).count()
    assert merged == l.count() + r.count() - matched


def test_dim_repositories_filters_null_keys_and_defaults(spark, merge_inputs):
    left, right = merge_inputs
    rows = {r.repo_id: r for r in silver.dim_repositories(left, right).collect()}
    assert None not in rows and set(rows) == {1, 2, 3, 4}
    r3 = rows[3]
    assert r3.description == "No description available" and r3.language == "Unknown"
    assert r3.stars == 0 and r3.created_at == "1900-01-01T00:00:00Z" and r3.private is True
    assert r3.default_branch == "main" and r3.license_key == "none" and r3.owner_type == "User"
    assert rows[2].popularity_category == "Very Popular" and rows[2].language_category == "Java"
    assert len(silver.dim_repositories(left, right).columns) == 31


def test_dim_repositories_load_time_is_greatest_typed(spark):
    import datetime as dt
    l = repos(spark, [{"repo_id": 1, "bronze_ingestion_timestamp": dt.datetime(2024, 1, 1)}])
    r = repos(spark, [{"repo_id": 1, "bronze_ingestion_timestamp": dt.datetime(2024, 3, 1)},
                      {"repo_id": 2}])
    out = {x.repo_id: x.bronze_ingestion_timestamp
           for x in silver.dim_repositories(l, r).collect()}
    assert out[1] == dt.datetime(2024, 3, 1) and out[2] == dt.datetime(1900, 1, 1)
    assert dict(silver.dim_repositories(l, r).dtypes)["bronze_ingestion_timestamp"] == "timestamp"


def test_dim_repo_permissions_keeps_null_keys(spark, merge_inputs):
    left, right = merge_inputs
    out = silver.dim_repo_permissions(left, right)
    assert out.where("repo_id IS NULL").count() == 2
    assert len(out.columns) == 29


def test_durations_fixed_for_iso_text(spark):
    r = repos(spark, [{"repo_id": 1, "created_at": "2024-01-01T00:00:00Z",
                       "updated_at": "2024-01-01T00:01:40Z", "pushed_at": "2024-01-01T00:00:00Z"}])
    row = silver.dim_repo_permissions(r, r.limit(0)).first()
    assert row.repository_age_seconds == 100 and row.last_activity_seconds == -100


def test_pull_request_fanout(spark):
    rs = repos(spark, [{"repo_id": i, "repo_name": f"r{i}", "owner_id": 3, "owner_login": "u3"}
                       for i in range(3)] + [{"repo_id": 9, "owner_id": 1, "owner_login": "u1"}])
    iss = issues(spark, [
        {"issue_id": 100, "user_id": 0, "pull_request": "{}"},   # owns 0 -> 1 row
        {"issue_id": 101, "user_id": 1, "pull_request": "{}"},   # owns 1 -> 1 row
        {"issue_id": 102, "user_id": 3, "pull_request": "{}"},   # owns 3 -> 3 rows
        {"issue_id": 103, "user_id": 3},                         # not a pull request
        {"issue_id": 104, "user_id": None, "pull_request": "{}"},  # NULL author -> 1 row
    ])
    out = silver.fact_pull_requests(iss, rs)
    counts = {r.pr_id: r["count"] for r in out.groupBy("pr_id").count().collect()}
    assert counts == {100: 1, 101: 1, 102: 3, 104: 1}
    assert out.where("pr_id = 100").first().body == ""
    assert len(out.columns) == 41
    plain = silver.fact_pull_requests(iss, rs, hot_rows=1)
    assert sorted(map(tuple, out.drop("silver_ingestion_timestamp").collect()), key=str) == \
        sorted(map(tuple, plain.drop("silver_ingestion_timestamp").collect()), key=str)


def test_salted_join_equals_plain_join_with_hot_key(spark):
    left = spark.range(0, 2000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    left = left.unionByName(spark.createDataFrame([(None, -1)], "k bigint, v bigint"))
    right = spark.range(0, 3000).select(
        F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id") % 11).alias("rk"),
        F.col("id").alias("w"))
    plain = left_join_keys(left, right, ["k"], ["rk"], ["w"])
    for buckets in (1, 16):
        fan = fanout_left_join(left, right, "k", "rk", ["w"], hot_rows=HOT[buckets])
        assert plain.count() == fan.count()
        assert plain.exceptAll(fan).count() == 0 and fan.exceptAll(plain).count() == 0


def test_fact_commits_url_join_and_repo_name(spark):
    rs = repos(spark, [{"repo_id": 5, "repo_name": "r", "owner_login": "o", "stars": 1}])
    cm = spark.createDataFrame(
        [("a", "https://github.com/o/r/commit/a", "fix", None),
         ("b", "https://github.com/o/zz/commit/b", "doc", True),
         (None, "https://github.com/o/r/commit/c", "x", None)],
        "commit_sha string, html_url string, message string, verification_verified boolean")
    for c in silver.COMMIT_COLUMNS + ["bronze_ingestion_timestamp"]:
        if c not in cm.columns:
            cm = cm.withColumn(c, F.lit(None).cast("string"))
    out = {r.commit_sha: r for r in silver.fact_commits(cm, rs).collect()}
    assert set(out) == {"a", "b"}                       # NULL sha filtered
    assert out["a"].repo_id == 5 and out["a"].repo_name == "r"
    assert out["b"].repo_id is None and out["b"].repo_name is None   # joined side, not extracted
    assert out["a"].commit_type == "Bug Fix" and out["b"].verification_status == "Verified"
    assert len(silver.fact_commits(cm, rs).columns) == 37


def test_fact_issues_left_count_identity(spark):
    rs = repos(spark, [{"repo_id": i, "repo_name": f"r{i}", "owner_login": "o"} for i in range(5)])
    iss = issues(spark, [{"issue_id": i, "html_url": f"https://github.com/o/r{i % 7}/issues/{i}",
                          "state": ["open", "closed", "x"][i % 3], "comments_count": i}
                         for i in range(40)])
    out = silver.fact_issues(iss, rs)
    assert out.count() == iss.count()   # right key unique -> left rows preserved
    assert len(out.columns) == 46
    total = out.groupBy("activity_level").count().agg(F.sum("count")).first()[0]
    assert total == 40


def test_dim_users_grain(spark):
    rs = repos(spark, [{"repo_id": 1, "owner_id": 1, "owner_login": "u1", "owner_type": "User",
                        "owner_url": "h1"}])
    iss = issues(spark, [{"issue_id": 1, "user_id": 1, "user_login": "u1", "user_type": "User",
                          "user_html_url": "h1", "assignee_id": 1, "assignee_login": "u1",
                          "assignee_type": "User", "assignee_html_url": "h1"}])
    cm = spark.createDataFrame(
        [(2, "u2", "User", "h2", "e", "N", 2, "u2", "User", "h2", "e", "N"),
         (3, "u3", "User", "h3", "e1", "N", 3, "u3", "User", "h3", "e2", "N")],
        "author_id bigint, author_login string, author_type string, author_html_url string, "
        "author_email string, author_name string, committer_id bigint, committer_login string, "
        "committer_type string, committer_html_url string, committer_email string, "
        "committer_name string")
    rows = silver.dim_users(rs, cm, iss).collect()
    by = {(r.user_id, r.user_email): r for r in rows}
    assert by[(1, "No email available")].primary_role == "Repository Owner"
    assert by[(1, "No email available")].user_activity_level == "Multi-role User"
    assert by[(1, "No email available")].user_roles == ["assignee", "issue_user", "owner"]
    assert by[(2, "e")].primary_role == "Active Contributor"
    assert {k for k in by if k[0] == 3} == {(3, "e1"), (3, "e2")}   # different e-mails: two rows


def test_latest_per_key_hot_key_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, i, f"v{i}") for i in range(500)] + [(2, 1, "a"), (None, 1, "n1"), (None, 2, "n2")],
        "k bigint, ts bigint, v string")
    out = {(r.k, r.v) for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert out == {(1, "v499"), (2, "a"), (None, "n1"), (None, "n2")}


def test_silver_table_sink(spark, tmp_path):
    from sediment.sources.tables import ensure_schema, save_table
    ensure_schema(spark, "silver_t", str(tmp_path / "silver_t.db"))
    df = spark.createDataFrame([Row(a=1), Row(a=2)])
    save_table(df, "x", "silver_t", str(tmp_path / "x"))
    save_table(df.union(df), "x", "silver_t", str(tmp_path / "x"))   # replace, not append
    assert spark.read.table("silver_t.x").count() == 4


def test_catalog_summary_reports_broken_tables(spark, tmp_path):
    import shutil
    from sediment.sources.tables import catalog_summary, ensure_schema, save_table
    ensure_schema(spark, "silver_s", str(tmp_path / "silver_s.db"))
    df = spark.createDataFrame([Row(a=1, b=2)])
    save_table(df, "ok", "silver_s", str(tmp_path / "ok"))
    save_table(df, "gone", "silver_s", str(tmp_path / "gone"))
    spark.sql("ALTER TABLE silver_s.gone SET LOCATION 'file:/nonexistent/sediment/gone'")
    rows = {r.table_name: (r.row_count, r.column_count)
            for r in catalog_summary(spark, "silver_s").collect()}
    assert rows["ok"] == (1, 2)
    assert "gone" in rows


def test_build_silver_shared_merge_equals_standalone(spark, merge_inputs, tmp_path):
    from sediment.plans.run import build_silver
    left, right = merge_inputs
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")
    paths = build_silver(spark, {"repositories": left, "repo_details": right},
                         str(tmp_path / "silver"), tables=["dim_repositories", "dim_repo_permissions"],
                         loaded_at=stamp)
    for name, fn in (("dim_repositories", silver.dim_repositories),
                     ("dim_repo_permissions", silver.dim_repo_permissions)):
        built = spark.read.parquet(paths[name])
        direct = fn(left, right, loaded_at=stamp)
        assert built.columns == direct.columns
        assert built.exceptAll(direct).count() == 0 and direct.exceptAll(built).count() == 0


def test_pull_requests_by_url(spark):
    rs = repos(spark, [{"repo_id": 1, "repo_name": "r", "owner_id": 9, "owner_login": "o"},
                       {"repo_id": 2, "repo_name": "s", "owner_id": 9, "owner_login": "o"}])
    iss = issues(spark, [
        {"issue_id": 1, "user_id": 9, "pull_request": "{}", "html_url": "https://github.com/o/r/pull/1"},
        {"issue_id": 2, "user_id": 9, "pull_request": "{}", "html_url": "https://github.com/x/y/pull/2"}])
    by_url = {r.pr_id: r.repo_id for r in silver.fact_pull_requests(iss, rs, repo_by="url").collect()}
    assert by_url == {1: 1, 2: None}
    by_owner = silver.fact_pull_requests(iss, rs).count()
    assert by_owner == 4    # each pull request fans out to both repositories of owner 9
    with pytest.raises(ValueError):
        silver.fact_pull_requests(iss, rs, repo_by="name")


def test_missing_times_default_only_in_repository_dimension(spark):
    r = repos(spark, [{"repo_id": 1}])
    t1 = silver.dim_repositories(r, r.limit(0)).first()
    t3 = silver.dim_repo_permissions(r, r.limit(0)).first()
    assert t1.created_at == "1900-01-01T00:00:00Z" and t1.pushed_at == "1900-01-01T00:00:00Z"
    assert t3.created_at is None and t3.repository_age_seconds is None


def test_run_writes_raise_and_skip():
    from sediment.plans.jobs import run_writes

    def boom():
        raise RuntimeError("x")
    ok = {"a": lambda: "pa", "b": boom, "c": lambda: "pc"}
    assert run_writes(ok, on_error="skip") == {"a": "pa", "c": "pc"}
    with pytest.raises(RuntimeError):
        run_writes(ok, on_error="raise")


def test_catalog_summary_ignores_session_views(spark, tmp_path):
    from sediment.sources.tables import catalog_summary, ensure_schema, save_table
    ensure_schema(spark, "silver_v", str(tmp_path / "silver_v.db"))
    save_table(spark.createDataFrame([Row(a=1)]), "t", "silver_v", str(tmp_path / "t"))
    spark.createDataFrame([Row(b=1)]).createOrReplaceTempView("some_session_view")
    assert [r.table_name for r in catalog_summary(spark, "silver_v").collect()] == ["t"]


def test_search_many_equals_separate_searches(spark):
    from functools import reduce
    from sediment.operators.feeds import CONFIGURED_SEARCHES, search_filter, search_many
    rs = repos(spark, [{"repo_id": i, "language": lang, "stars": stars}
                       for i, (lang, stars) in enumerate(
                           [("Python", 1001), ("python", 1000), ("Java", 5000), ("JavaScript", 2000),
                            (None, 9000), ("Go", 9000), ("Java", None), ("javascript", 1001)])])
    one_pass = search_many(rs).select("search", "repo_id")
    separate = reduce(lambda a, b: a.unionByName(b), [
        search_filter(rs, language=lang, min_stars=floor).select(
            F.lit(name).alias("search"), "repo_id")
        for name, lang, floor in CONFIGURED_SEARCHES])
    assert sorted(map(tuple, one_pass.collect())) == sorted(map(tuple, separate.collect()))
    assert one_pass.count() == 4
