"""The pipeline stage by stage against brute force, each on what its predecessor kept."""

import corpus_pipeline as P
import pytest
from helpers import DOCS, deduped_lines, near_components, odd_rows
from test_dedup import _contained
from test_tokens_packing import check_packing

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.select(P.COLUMNS).collect()), key=repr)


def test_stages_are_those_asked_for():
    assert [name for name, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert P.ORACLE_SQL is None


def test_each_stage_matches_brute_force(spark):
    from sediment.llm.common import table, written

    docs = table(spark, SF, "documents")
    stage = dict(P.STAGES)
    kept = written(stage["quality"](spark, docs, SF), "t1")
    assert kept.columns == docs.columns and set(rows(kept)) <= set(rows(docs))
    labels = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    ids = {r["doc_id"] for r in kept.collect()}
    wrong = [i for i, y in labels.items() if (i in ids) != bool(y)]
    assert len(wrong) <= 0.1 * len(labels)

    lines = written(stage["line_dedup"](spark, kept, SF), "t2")
    want = deduped_lines([(r["doc_id"], r["text"]) for r in kept.collect()])
    assert lines.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in lines.collect()} == {i: v[2] for i, v in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())

    near = written(stage["near_dedup"](spark, lines, SF), "t3")
    roots = near_components({r["doc_id"]: r["text"] for r in lines.collect()}, 5, 80)
    assert rows(near) == [r for r in rows(lines) if roots[r[0]] == r[0]]

    clean = written(stage["decontamination"](spark, near, SF), "t4")
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    hit = {d for d, *_ in _contained([(r["doc_id"], r["text"]) for r in near.collect()], items)}
    assert hit and rows(clean) == [r for r in rows(near) if r[0] not in hit]

    packed = stage["packing"](spark, clean, SF).collect()
    used, least = check_packing(rows(clean), packed, 4096)
    assert used <= least + 1
    again = P.run(spark, SF).collect()
    narrow = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted(tuple(r[c] for c in narrow) for r in again) == sorted(tuple(r[c] for c in narrow) for r in packed)


@pytest.mark.parametrize("data", [odd_rows(), []])
def test_odd_and_empty_documents_pass_every_stage(spark, data):
    docs = spark.createDataFrame([(*r, 1) for r in data], DOCS + ", score int")
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        if name == "packing":
            assert out.select("doc_id").distinct().count() == len({r[0] for r in data})
        else:
            assert out.columns == P.COLUMNS and out.count() <= len(data)
        if name == "near_dedup" and data:  # of the three rows "one two" one stays
            kept = sorted((r["text"], r["doc_id"]) for r in out.where("text = 'one two'").collect())
            assert kept == [("one two", 5)] and out.count() == len(data) - 2


def test_null_and_repeated_ids_are_judged_by_row(spark):
    rows = [(None, "one two three four five six seven", "en", "a", 1), (None, "one two three four five six seven", "en", "b", 1),
            (3, "a text of its own, said by nobody else", "en", "a", 1), (3, "another text that has the same id", "en", "a", 1)]
    near = dict(P.STAGES)["near_dedup"](spark, spark.createDataFrame(rows, DOCS), SF)
    assert near.count() == 3 and near.where("doc_id = 3").count() == 2
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("length(text) > 60").first()["text"]
    docs = [(None, f"before {item} after", "en", "a", 1), (None, "clean", "en", "a", 1), (3, item, "en", "a", 1), (3, "clean too", "en", "a", 1)]
    clean = dict(P.STAGES)["decontamination"](spark, spark.createDataFrame(docs, DOCS), SF)
    assert sorted(r["text"] for r in clean.collect()) == ["clean", "clean too"]
