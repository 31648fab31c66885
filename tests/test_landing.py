"""Landing fixtures: API-written documents (one indented JSON object per file) with the edge
cases of the ingestion layer, scanned by directory, routed by anchored name, flattened."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sediment.plans.bronze import bronze_feed, build_bronze
from sediment.sources.landing import (envelope_report, feed_records, list_landing, route_feed,
                                      scan_feed, write_envelopes)


def account(i, login=None):
    return {"id": i, "login": login or f"u{i}", "type": "User",
            "html_url": f"https://github.com/{login or f'u{i}'}"}


def commit(sha, owner="o", repo="r", author=1, committer=2, msg="fix it"):
    return {"sha": sha, "node_id": f"N{sha}", "html_url": f"https://github.com/{owner}/{repo}/commit/{sha}",
            "comments_url": "c", "commit": {
                "message": msg, "url": "u", "comment_count": 0,
                "author": {"name": "A", "email": "a@x", "date": "2024-01-01T00:00:00Z"},
                "committer": {"name": "C", "email": "c@x", "date": "2024-01-01T00:01:00Z"},
                "tree": {"sha": "t"}, "verification": {"verified": True, "reason": "valid"}},
            "author": account(author), "committer": account(committer),
            "parents": [{"sha": "p", "url": "x"}]}


def issue(i, assignee=None, milestone=None, pr="absent", labels=None):
    d = {"id": i, "node_id": f"I{i}", "number": i, "title": "t", "body": None, "state": "open",
         "locked": False, "comments": 3, "created_at": "2024-01-01T00:00:00Z",
         "updated_at": None, "closed_at": None, "author_association": "NONE",
         "active_lock_reason": None, "html_url": f"https://github.com/o/r/issues/{i}",
         "url": "u", "assignee": assignee, "user": account(7), "milestone": milestone,
         "labels": labels if labels is not None else []}
    if pr != "absent":
        d["pull_request"] = pr
    return d


def repo(i, name="r", owner=1, stars=5):
    return {"id": i, "name": name, "full_name": f"u{owner}/{name}", "description": " d ",
            "html_url": f"https://github.com/u{owner}/{name}", "clone_url": "c", "language": "Python",
            "stargazers_count": stars, "watchers_count": 1, "forks_count": 2,
            "open_issues_count": 3, "size": 4, "created_at": "2024-01-01T00:00:00Z",
            "updated_at": "2024-01-02T00:00:00Z", "pushed_at": "2024-01-03T00:00:00Z",
            "default_branch": "main", "owner": account(owner), "license": None,
            "topics": ["a"], "archived": False, "disabled": False, "private": False, "fork": False}


def land(dirpath, name, payload, ts="2024-06-01T00:00:00", raw=None):
    with open(os.path.join(dirpath, name), "w", encoding="utf-8") as f:
        if raw is not None:
            f.write(raw)
        else:
            json.dump({"ingestion_timestamp": ts, "data": payload}, f, indent=2)


@pytest.fixture()
def landing(tmp_path):
    d = str(tmp_path / "landing")
    os.makedirs(d)
    land(d, "repositories_20240601_000000.json", {"repositories": [repo(1), repo(2, "s")]})
    land(d, "repo_details_u1_r_20240601_000000.json", repo(1))
    land(d, "commits_o_r_20240601_000000.json", {"commits": [commit("a"), commit("b")]})
    land(d, "commits_o_s_20240601_000001.json", {"commits": [commit("c")]})
    land(d, "commits_x_awesome-repositories_20240601_000000.json", {"commits": [commit("d")]})
    # every assignee and milestone null, no pull_request field in any record
    land(d, "issues_o_r_20240601_000000.json", {"issues": [issue(10), issue(11)]})
    land(d, "issues_x_commits-tool_20240601_000000.json",
         {"issues": [issue(12, pr=None), issue(13, pr={"url": "p"}, assignee=account(3),
                                                 milestone={"id": 9, "title": "m"},
                                                 labels=[{"name": "bug"}])]})
    land(d, "issues_o_empty_20240601_000000.json", {"issues": []})
    land(d, "issues_bad_20240601_000000.json", None, raw="{ not json")
    land(d, "commits_noenv_20240601_000000.json", None, raw=json.dumps({"other": 1}))
    land(d, "README.json", None, raw=json.dumps({"readme": True}))
    return d


def test_route_is_anchored(spark):
    names = ["commits_x_awesome-repositories_1.json", "issues_x_commits-tool_1.json",
             "repositories_1.json", "repo_details_a_b_1.json", "README.json", "my_issues_1.json"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(route_feed("n")).collect()] == [
        "commits", "issues", "repositories", "repo_details", "", ""]


def test_list_landing_reads_no_content(spark, landing):
    files = {r.file_name: r.feed for r in list_landing(spark, landing).collect()}
    assert files["README.json"] == ""
    assert files["commits_x_awesome-repositories_20240601_000000.json"] == "commits"
    assert len(files) == 11


def test_two_files_of_one_feed_are_both_kept(spark, landing):
    recs = feed_records(scan_feed(spark, landing, "commits"), "commits")
    assert sorted(r.rec.sha for r in recs.collect()) == ["a", "b", "c", "d"]


def test_inference_traps_do_not_fail(spark, landing):
    rows = {r.issue_id: r for r in bronze_feed(spark, landing, "issues").collect()}
    assert set(rows) == {10, 11, 12, 13}
    assert rows[10].assignee_id is None and rows[10].milestone_id is None
    assert rows[10].pull_request is None and rows[12].pull_request is None  # absent / JSON null
    assert rows[13].pull_request is not None and rows[13].assignee_id == 3
    assert rows[13].milestone_id == 9 and len(rows[13].labels) == 1
    assert rows[10].labels == []


def test_envelope_report_flags_bad_files(spark, landing):
    issues = envelope_report(scan_feed(spark, landing, "issues"), "issues").first()
    assert issues.documents == 4 and issues.malformed == 1 and issues.items == 4
    assert issues.partial == 0          # "{ not json": nothing of it could be read
    commits = envelope_report(scan_feed(spark, landing, "commits"), "commits").first()
    assert commits.without_data == 1 and commits.without_timestamp == 1 and commits.items == 4


def test_missing_directory_is_empty(spark, tmp_path):
    assert scan_feed(spark, str(tmp_path / "nope"), "issues").count() == 0
    assert list_landing(spark, str(tmp_path / "nope")).count() == 0


def test_repo_details_star_feed(spark, landing):
    rows = bronze_feed(spark, landing, "repo_details").collect()
    assert len(rows) == 1 and rows[0].repo_id == 1 and rows[0].owner_login == "u1"
    assert rows[0].license_name is None


def test_newest_landing_wins(spark, tmp_path):
    d = str(tmp_path / "l")
    os.makedirs(d)
    old, new = issue(1), issue(1)
    old["title"], new["title"] = "old", "new"
    land(d, "issues_o_r_20240101_000000.json", {"issues": [old]}, ts="2024-01-01T00:00:00")
    land(d, "issues_o_r_20240201_000000.json", {"issues": [new, issue(2)]}, ts="2024-02-01T00:00:00")
    rows = {r.issue_id: r.title for r in bronze_feed(spark, d, "issues").collect()}
    assert rows == {1: "new", 2: "t"}
    both = bronze_feed(spark, d, "issues", latest=False).count()
    assert both == 3


def test_lines_layout_roundtrip_and_multiline_trap(spark, tmp_path):
    src = spark.createDataFrame([(i, i // 3) for i in range(10)], "id bigint, page bigint")
    recs = src.select(F.struct(F.col("id"), F.lit("t").alias("title")).alias("rec"), "page")
    d = str(tmp_path / "spark_landing")
    write_envelopes(recs, "issues", d, ["page"], F.lit("2024-01-01T00:00:00"))
    got = feed_records(scan_feed(spark, d, "issues", layout="lines"), "issues")
    assert sorted(r.rec.id for r in got.collect()) == list(range(10))
    # Reading JSON Lines as multi-line documents silently keeps only each file's first line.
    trap = (spark.read.option("multiLine", "true").schema("data struct<issues array<struct<id bigint>>>")
            .json(f"{d}/feed=issues").select(F.explode("data.issues")).count())
    assert trap < 10


def test_build_bronze_writes_four_tables(spark, landing, tmp_path):
    out = build_bronze(spark, landing, str(tmp_path / "bronze"))
    counts = {t: spark.read.parquet(p).count() for t, p in out.items()}
    assert counts == {"repositories": 2, "repo_details": 1, "commits": 4, "issues": 4}
    widths = {t: len(spark.read.parquet(p).columns) for t, p in out.items()}
    assert widths == {"repositories": 28, "repo_details": 28, "commits": 26, "issues": 30}


def test_scheduled_run_requires_input(spark, tmp_path):
    empty = str(tmp_path / "empty")
    os.makedirs(empty)
    with pytest.raises(FileNotFoundError):
        build_bronze(spark, empty, str(tmp_path / "b"), require_input=True)
    assert build_bronze(spark, empty, str(tmp_path / "b2"), require_input=False) == {}


def test_wrong_typed_field_keeps_record_and_flags_file(spark, tmp_path):
    d = str(tmp_path / "l")
    os.makedirs(d)
    bad = issue(1)
    bad["comments"] = "many"          # string where a number belongs
    land(d, "issues_o_r_20240601_000000.json", {"issues": [bad, issue(2)]})
    rows = {r.issue_id: r for r in bronze_feed(spark, d, "issues").collect()}
    report = envelope_report(scan_feed(spark, d, "issues"), "issues").first()
    assert report.malformed == 1 and report.partial == 1
    # the document's other fields survive; only the bad field is NULL
    assert rows[1].comments_count is None and rows[1].title == "t"
    assert rows[2].comments_count == 3


def test_reland_large_documents_as_lines(spark, tmp_path):
    from sediment.sources.landing import reland_as_lines
    d = str(tmp_path / "docs")
    os.makedirs(d)
    land(d, "issues_o_r_20240101_000000.json", {"issues": [issue(i) for i in range(120)]},
         ts="2024-01-01T00:00:00")
    land(d, "issues_o_s_20240201_000000.json", {"issues": [issue(i) for i in range(200, 230)]},
         ts="2024-02-01T00:00:00")
    out = str(tmp_path / "lines")
    reland_as_lines(spark, d, out, "issues", page_size=50)
    docs = scan_feed(spark, out, "issues", layout="lines")
    sizes = sorted(r[0] for r in docs.select(F.size("data.issues")).collect())
    assert sizes == [20, 30, 50, 50]
    before = {r.issue_id for r in bronze_feed(spark, d, "issues").collect()}
    after = {r.issue_id for r in bronze_feed(spark, out, "issues", layout="lines").collect()}
    assert before == after and len(after) == 150
    stamps = {r[0] for r in docs.select("ingestion_timestamp").collect()}
    assert stamps == {"2024-01-01T00:00:00", "2024-02-01T00:00:00"}


def test_feed_without_files_keeps_its_table(spark, landing, tmp_path):
    out = str(tmp_path / "bronze")
    build_bronze(spark, landing, out)
    before = spark.read.parquet(f"{out}/issues").count()
    with pytest.raises(FileNotFoundError):
        build_bronze(spark, str(tmp_path / "wrong"), out)
    build_bronze(spark, str(tmp_path / "wrong"), out, require_input=False)
    assert spark.read.parquet(f"{out}/issues").count() == before > 0


def test_failed_write_keeps_the_old_table(spark, tmp_path):
    from pyspark.sql import functions as F
    from sediment.sources.tables import save_table, write_parquet
    path = str(tmp_path / "t")
    write_parquet(spark.range(5), path)
    broken = spark.range(5).select(F.raise_error(F.lit("boom")).cast("long").alias("id"))
    with pytest.raises(Exception, match="boom"):
        write_parquet(broken, path)
    assert spark.read.parquet(path).count() == 5
    write_parquet(spark.read.parquet(path).where("id > 1"), path)  # a table may feed its successor
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["t"]
    spark.sql("CREATE SCHEMA IF NOT EXISTS sediment_t")
    save_table(spark.range(4), "m", "sediment_t")
    with pytest.raises(Exception, match="boom"):
        save_table(broken, "m", "sediment_t")
    assert spark.read.table("sediment_t.m").count() == 4
    save_table(spark.range(2), "m", "sediment_t")
    assert spark.read.table("sediment_t.m").count() == 2
    spark.sql("DROP SCHEMA sediment_t CASCADE")


def test_sub_directories_are_listed_and_read(spark, landing, tmp_path):
    import shutil
    deep = tmp_path / "deep" / "2024" / "06"
    shutil.copytree(landing, deep)
    top = str(tmp_path / "deep")
    for feed in ("issues", "commits"):
        listed = list_landing(spark, top).where(f"feed = '{feed}'").count()
        assert scan_feed(spark, top, feed).select("source_file").distinct().count() == listed > 0


def test_unusable_documents_are_quarantined(spark, landing, tmp_path):
    from sediment.plans.bronze import quarantined
    out = str(tmp_path / "bronze")
    build_bronze(spark, landing, out)
    report = [envelope_report(scan_feed(spark, landing, f), f, by_file=True)
              for f in ("repositories", "repo_details", "commits", "issues")]
    bad = {r.source_file for df in report for r in df.where("malformed + without_data > 0").collect()}
    got = quarantined(spark, out).collect()
    assert bad and {r.source_file for r in got} == bad and all(r.raw for r in got)


def test_page_is_needed_for_array_feeds(spark, tmp_path):
    recs = spark.createDataFrame([((1,),)], "rec struct<id long>")
    with pytest.raises(ValueError, match="page"):
        write_envelopes(recs, "issues", str(tmp_path / "l"), [], "x")


def test_checks_write_nothing(spark, landing, tmp_path):
    from sediment.plans.run import layer_checks, run_layers
    work = str(tmp_path / "w")
    got = layer_checks(spark, landing, work)
    assert not (tmp_path / "w").exists() and not any(r.passed for r in got.where("layer <> 'landing'").collect())
    run_layers(spark, landing, work)
    files = {r.check_name: r for r in layer_checks(spark, landing, work).collect() if "files:" in r.check_name}
    want = {r.feed: r.n for r in list_landing(spark, landing).groupBy("feed").agg(F.count("*").alias("n")).collect()}
    assert {k[6:]: r.detail for k, r in files.items()} == want and all(r.passed == (k != "files:")
                                                                       for k, r in files.items())
    wrong = layer_checks(spark, str(tmp_path / "nothing"), work).collect()
    assert not any(r.passed for r in wrong if r.layer == "landing")
    assert all(r.detail > 0 for r in wrong if r.check_name == "table:issues")


def test_skip_mode_skips_only_what_fails(spark, landing, tmp_path):
    from sediment.plans.run import build_silver
    out = str(tmp_path / "bronze")
    paths = build_bronze(spark, landing, out)
    frames = {t: spark.read.parquet(p) for t, p in paths.items() if t != "repo_details"}
    got = build_silver(spark, frames, str(tmp_path / "silver"), on_error="skip")
    assert set(got) == {"dim_users", "fact_commits", "fact_issues", "fact_pull_requests"}
    with pytest.raises(KeyError):
        build_silver(spark, frames, str(tmp_path / "silver2"))


def test_landed_lines_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    import sediment.sources.landing as L

    monkeypatch.setattr(L, "PAGES_PER_FILE", 10)
    d = str(tmp_path / "l")
    recs = spark.range(1000).select(F.struct(F.col("id"), F.repeat(F.lit("text "), 100).alias("title")).alias("rec"),
                                    (F.col("id") / 10).cast("int").alias("page"))
    write_envelopes(recs.coalesce(1), "issues", d, ["page"], F.lit("2024-01-01T00:00:00"))
    files = [f for f in os.listdir(f"{d}/feed=issues") if f.startswith("part-")]
    assert len(files) >= 10 and all(f.endswith(".json.gz") for f in files)
    assert sum(os.path.getsize(f"{d}/feed=issues/{f}") for f in files) < 500 * 1000 / 4
    assert feed_records(scan_feed(spark, d, "issues", "lines"), "issues").count() == 1000
