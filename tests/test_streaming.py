"""Incremental landing -> bronze: each landing file is consumed once; newest landing wins."""

import json
import os

from sediment.streaming.incremental import current_bronze, ingest_new_landing


def write_doc(d, name, issues, ts):
    with open(os.path.join(d, name), "w") as f:
        json.dump({"ingestion_timestamp": ts, "data": {"issues": issues}}, f, indent=2)


def test_available_now_runs_are_incremental(spark, tmp_path):
    landing, log, ckpt = (str(tmp_path / x) for x in ("landing", "log", "ckpt"))
    os.makedirs(landing)
    write_doc(landing, "issues_o_r_20240101_000000.json",
              [{"id": 1, "title": "old"}, {"id": 2, "title": "two"}], "2024-01-01T00:00:00")
    ingest_new_landing(spark, landing, log, ckpt, "issues", layout="document").awaitTermination()
    assert spark.read.parquet(log).count() == 2

    # Nothing new: a second run appends nothing.
    ingest_new_landing(spark, landing, log, ckpt, "issues", layout="document").awaitTermination()
    assert spark.read.parquet(log).count() == 2

    write_doc(landing, "issues_o_r_20240201_000000.json", [{"id": 1, "title": "new"}],
              "2024-02-01T00:00:00")
    ingest_new_landing(spark, landing, log, ckpt, "issues", layout="document").awaitTermination()
    assert spark.read.parquet(log).count() == 3
    rows = {r.issue_id: r.title for r in current_bronze(spark, log, "issues").collect()}
    assert rows == {1: "new", 2: "two"}
