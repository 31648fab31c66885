"""The document sink, the drift-tolerant scan and the observed counts."""

import json
import os

import pytest
from pyspark.sql import functions as F

from sediment.plans.bronze import build_bronze
from sediment.plans.run import layered_summary
from sediment.schemas import FEEDS
from sediment.sources import landing as L


def test_documents_get_their_names(spark, tmp_path):
    base = str(tmp_path / "landing")
    docs = [("issues_a b%c=d_20240101.json", '{\n "ingestion_timestamp": "2024-01-01T00:00:00",\n "data": {"issues": []}\n}'),
            ("commits_x_awesome-repositories_1.json", "{}"), ("notes.json", "[]"), ("issues_é_2.json", '{"cut')]
    assert L.write_documents(spark.createDataFrame(docs, "file_name string, value string"), base) == 4
    assert sorted(f for f in os.listdir(base) if not f.startswith(".")) == sorted(n for n, _ in docs)
    for name, value in docs:
        with open(f"{base}/{name}", encoding="utf8") as f:
            assert f.read().rstrip("\n") == value
    # Landed again, a document replaces the former one; nothing hidden is left behind.
    L.write_documents(spark.createDataFrame([(docs[2][0], "[1]")], "file_name string, value string"), base)
    with open(f"{base}/notes.json") as f:
        assert f.read() == "[1]\n"
    assert not [d for d in os.listdir(base) if d.startswith(".landing")]
    with pytest.raises(ValueError):
        L.write_documents(spark.createDataFrame([("a/b.json", "x")], "file_name string, value string"), base)


def test_documents_land_without_a_driver_call_each(spark, tmp_path, monkeypatch):
    client, calls = type(spark.sparkContext._gateway._gateway_client), []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda self, *a, **k: (calls.append(1), send(self, *a, **k))[1])
    docs = spark.range(800).select(F.concat(F.lit("notes_"), F.col("id"), F.lit(".json")).alias("file_name"),
                                   F.col("id").cast("string").alias("value"))
    assert L.write_documents(docs, str(tmp_path / "landing")) == 800
    assert len(calls) < 800
    assert spark.read.text(str(tmp_path / "landing")).agg(F.sum(F.col("value").cast("int"))).first()[0] == 799 * 400


@pytest.mark.parametrize("mounted", [True, False])
def test_names_that_repeat_and_names_that_are_taken(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(L, "_land_in_tasks", lambda docs, base, tag: L._land_by_driver(
            docs, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(
                spark.sparkContext._jsc.hadoopConfiguration()), base, tag))
    base = str(tmp_path / "landing")
    spark.createDataFrame([("x",)], "value string").coalesce(1).write.text(base)  # Hadoop's client leaves checksums
    part = next(f for f in os.listdir(base) if f.startswith("part-"))
    docs = [(part, "another, longer"), ("b.json", None), (None, "x")]
    assert L.write_documents(spark.createDataFrame(docs, "file_name string, value string"), base) == 3
    assert sorted(r[0] for r in spark.read.text(f"{base}/{part}").collect()) == ["another, longer"]
    with open(f"{base}/b.json") as f:
        assert f.read() == "\n"
    assert os.path.exists(f"{base}/{L.NO_NAME}")
    docs = spark.createDataFrame([("c.json", "1"), ("d.json", "2"), ("c.json", "3")], "file_name string, value string")
    assert L.write_documents(docs.repartition(3), base) == 2
    assert sorted(r[0] for r in spark.read.text(f"{base}/c.json").collect()) == ["1", "3"]
    assert not [f for f in os.listdir(base) if f.startswith(".landing")]


def test_report_of_every_file(spark, tmp_path):
    base = str(tmp_path)
    good = json.dumps({"ingestion_timestamp": "2024-01-01T00:00:00", "data": {"issues": [{"id": 1}, {"id": 2}]}}, indent=1)
    docs = [("issues_o_commits-tool_1.json", good), ("commits_o_repositories_1.json", good.replace("issues", "commits")
                                                        .replace('"id": 1', '"sha": "1"').replace('"id": 2', '"sha": "2"')),
            ("issues_o_r_2.json", good[:60]), ("issues_o_r_3.json", '{"ingestion_timestamp": "x"}'), ("other_1.json", good)]
    L.write_documents(spark.createDataFrame(docs, "file_name string, value string"), base)
    got = {r["file_name"]: tuple(r)[1:] for r in L.file_report(spark, base).collect()}
    assert got == {"issues_o_commits-tool_1.json": ("issues", 1, 0, 0, 0, 2),
                   "commits_o_repositories_1.json": ("commits", 1, 0, 0, 0, 2),
                   "issues_o_r_2.json": ("issues", 1, 1, 1, 1, 0), "issues_o_r_3.json": ("issues", 1, 0, 0, 1, 0),
                   "other_1.json": ("", None, None, None, None, None)}


DETAIL = {"id": 1, "name": "a", "owner": {"id": 5, "login": "x"}, "topics": ["t"], "private": False}


def drift(spark, base, records, feed="repo_details"):
    lines = [json.dumps({"ingestion_timestamp": "2024-01-01T00:00:00",
                         "data": r if feed == "repo_details" else {feed: r}}) for r in records]
    spark.createDataFrame([(x,) for x in [*lines, "not json"]], "value string").coalesce(1).write.text(f"{base}/feed={feed}")
    found = L.variant_records(L.scan_variant(spark, base, feed, "lines"), feed)
    return found, {(r["path"], r["type_seen"], r["type_wanted"]): r["records"] for r in L.schema_drift(found, feed).collect()}


def test_drift_names_more_less_and_other(spark, tmp_path):
    records = [DETAIL, {**DETAIL, "size": "big", "new": {"deep": {"er": 1}}}, {**DETAIL, "size": None, "owner": {"id": "5"}},
               {**DETAIL, "topics": "t", "description": {"a": 1}, "fork": 1}]
    found, got = drift(spark, str(tmp_path), records)
    assert found.count() == 4
    odd = {k: n for k, n in got.items() if k[1] is not None}
    assert odd == {("size", "STRING", "BIGINT"): 1, ("new", "OBJECT", None): 1, ("owner.id", "STRING", "BIGINT"): 1,
                   ("topics", "STRING", "ARRAY"): 1, ("fork", "BIGINT", "BOOLEAN"): 1}
    # Null is present; fields of an absent object are not named, the object is.
    assert got["size", None, "BIGINT"] == 2 and got["owner.login", None, "STRING"] == 1
    assert got["license", None, "OBJECT"] == 4 and ("license.key", None, "STRING") not in got
    assert ("id", None, "BIGINT") not in got


def test_variant_records_keep_what_the_schema_drops(spark, tmp_path):
    found, got = drift(spark, str(tmp_path), [[{"id": 1, "comments": "many", "reactions": {"+1": 3}}, {"id": 2}], []], "issues")
    rows = found.select(F.try_variant_get("rec", "$.id", "bigint"), F.try_variant_get("rec", "$.comments", "bigint"),
                        F.try_variant_get("rec", "$.reactions['+1']", "bigint")).collect()
    assert sorted(map(tuple, rows)) == [(1, None, 3), (2, None, None)]
    assert got["reactions", "OBJECT", None] == 1 and got["comments", "STRING", "BIGINT"] == 1


def test_observed_counts_replace_the_second_parse(spark, tmp_path):
    base = str(tmp_path / "landing")
    docs = [(f"issues_o_{i}.json", json.dumps({"ingestion_timestamp": "2024-01-01T00:00:00",
                                               "data": {"issues": [{"id": j} for j in range(i)]}})) for i in range(5)]
    docs += [("issues_o_bad.json", "{"), ("commits_o_1.json", '{"ingestion_timestamp": "x"}')]
    L.write_documents(spark.createDataFrame(docs, "file_name string, value string"), base)
    landed = {}
    bronze = build_bronze(spark, base, str(tmp_path / "bronze"), landed=landed)
    for feed in ("issues", "commits"):
        want = L.envelope_report(L.scan_feed(spark, base, feed), feed).drop("feed").first().asDict()
        assert landed[feed] == want
    by_parse = layered_summary(spark, base, bronze, {})
    observed = layered_summary(spark, None, bronze, {}, landed=landed)
    assert sorted(map(tuple, observed.collect()), key=repr) == sorted(map(tuple, by_parse.collect()), key=repr)
    plan = observed._jdf.queryExecution().executedPlan().toString()
    assert "FileScan json" not in plan and "FileScan json" in by_parse._jdf.queryExecution().executedPlan().toString()
    assert set(landed) <= set(FEEDS)


@pytest.mark.parametrize("mounted", [True, False])
def test_gzipped_documents_are_read_under_their_names(spark, tmp_path, monkeypatch, mounted):
    if not mounted:
        monkeypatch.setattr(L, "_land_in_tasks", lambda docs, base, tag, *more: L._land_by_driver(
            docs, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(
                spark.sparkContext._jsc.hadoopConfiguration()), base, tag, *more))
    base = str(tmp_path / "landing")
    good = json.dumps({"ingestion_timestamp": "2024-01-01T00:00:00", "data": {"issues": [
        {"id": i, "title": "text " * 200} for i in range(50)]}}, indent=1)
    docs = [("issues_o_r_1.json", good), ("issues_é_2.json", good[:60]), ("other_1.json", good)]
    frame = spark.createDataFrame(docs, "file_name string, value string")
    assert L.write_documents(frame, base) == 3
    plain = {tuple(r) for r in L.file_report(spark, base).collect()}
    variants = L.scan_variant(spark, base, "issues").selectExpr("source_file", "cast(doc AS string)").collect()
    # A document replaces its former one, in whichever form that is.
    assert L.write_documents(frame, base, compression="gzip") == 3
    files = [f for f in os.listdir(base) if not f.startswith(".")]
    assert sorted(files) == sorted(f"{n}.gz" for n, _ in docs)
    assert os.path.getsize(f"{base}/issues_o_r_1.json.gz") < len(good) / 10
    assert {tuple(r) for r in L.file_report(spark, base).collect()} == plain
    assert {r[0] for r in L.scan_feed(spark, base, "issues").select("source_file").collect()} == {n for n, _ in docs[:2]}
    assert sorted(L.scan_variant(spark, base, "issues").selectExpr("source_file", "cast(doc AS string)").collect(), key=str
                  ) == sorted(variants, key=str)
    tables = build_bronze(spark, base, str(tmp_path / "bronze"))
    assert spark.read.parquet(tables["issues"]).count() == 50
    assert L.write_documents(frame.limit(1), base) == 1
    assert sorted(f for f in os.listdir(base) if not f.startswith(".")) == sorted(
        ["issues_o_r_1.json", "issues_é_2.json.gz", "other_1.json.gz"])


def test_rows_of_a_name_meet_without_a_shuffle_of_their_text(spark, tmp_path):
    base = str(tmp_path / "landing")
    docs = spark.range(40).repartition(4).selectExpr("concat('n', id % 10, '.json') AS file_name",
                                                     "concat(id, repeat(' ', 1000)) AS value")
    assert L.write_documents(docs, base, compression="gzip") == 10
    assert len([f for f in os.listdir(base) if not f.startswith(".")]) == 10
    got = spark.read.text(base, pathGlobFilter="*.gz").selectExpr("cast(trim(value) AS int) AS n", "_metadata.file_name AS f")
    assert sorted((r.f, r.n) for r in got.collect()) == sorted((f"n{i % 10}.json.gz", i) for i in range(40))
