"""Near-dedup, line dedup and decontamination against brute force."""

import hashlib
import random

import numpy as np
import pytest
from helpers import DOCS, corpus, deduped_lines, near_components, odd_rows, shingle_set, words
from hypothesis import given, settings
from hypothesis import strategies as st

from sediment.llm import decontam, line_dedup, near_dedup
from sediment.llm.mph import MinimalPerfectHash


@pytest.mark.parametrize("seed,n,percent", [(1, 4, 80), (2, 5, 80)])
def test_near_duplicates_match_all_pairs(spark, seed, n, percent):
    rows = corpus(seed)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), n, percent).collect()
    want = near_components({r[0]: r[1] for r in rows}, n, percent)
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {r[0]: len(shingle_set(r[1], n)) for r in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_a_crowd_linked_through_its_centre_only(spark):
    """Copies that are near their original but not each other: hubs alone would not do."""
    rng = random.Random(5)
    base = words(rng, 400)
    rows = [(99, " ".join(base))]
    for i in range(40):
        own = list(base)
        for at in rng.sample(range(400), 9):
            own[at] = f"y{i}_{at}"
        rows.append((i, " ".join(own)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80)
    want = near_components(dict(rows), 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == want


def test_small_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", 2)
    rows = corpus(9, 90)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, DOCS), 4, 80).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == near_components({r[0]: r[1] for r in rows}, 4, 80)


def test_signature_estimates_similarity_with_less_variance():
    rng = np.random.default_rng(3)
    for j in (0.5, 0.8):
        off = []
        for _ in range(150):
            u = rng.integers(0, 2**63, 300, dtype=np.uint64)
            both, rest = int(300 * j), (300 - int(300 * j)) // 2
            a, b = np.sort(u[:both + rest]), np.sort(np.concatenate((u[:both], u[both + rest:])))
            x = near_dedup.signatures([a, b])
            off.append((x[0] == x[1]).mean() - both / 300)
        assert abs(np.mean(off)) < 0.02
        assert np.std(off) < 1.1 * (j * (1 - j) / near_dedup.SLOTS) ** 0.5


def test_signature_depends_on_the_set_only():
    small = np.array([5, 9], np.uint64)
    alone = near_dedup.signatures([small])[0]
    beside = near_dedup.signatures([np.arange(1000, dtype=np.uint64), small])[1]
    assert (alone == beside).all()


def test_near_odd_rows(spark):
    got = near_dedup.contract(spark.createDataFrame(odd_rows(), DOCS)).collect()
    assert len(got) == len(odd_rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[6]["component_id"] == 5 and not by[6]["kept"]
    assert all(by[i]["component_id"] == i and by[i]["n_shingles"] == 0 for i in (1, 2, 3, 7))
    lone = [r for r in got if r["doc_id"] is None]
    assert len(lone) == 2 and all(r["component_id"] is None and r["kept"] for r in lone)


def components_by_row(rows, n=4, percent=80):
    """Components of rows linked by near texts or one doc_id: the smallest doc_id of each row's."""
    root = near_components(dict(enumerate(t for _, t in rows)), n, percent)
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            if a is not None and a == b and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    low = {}
    for i, (a, _) in enumerate(rows):
        if a is not None:
            low[root[i]] = min(low.get(root[i], a), a)
    return [low.get(root[i]) for i in range(len(rows))]


def near_texts(seed):
    rng = random.Random(seed)
    a, b = words(rng, 80), words(rng, 80)
    return " ".join(a), " ".join(b), " ".join([*a, "more"]), " ".join([*b, "more"])


@pytest.mark.parametrize("turned", [False, True])
def test_one_id_with_several_texts(spark, turned):
    a, b, near_a, near_b = near_texts(1)
    for rows in ([(1, None), (1, a), (2, near_a)], [(1, None), (1, a), (2, None), (2, near_a)],
                 [(1, a), (1, b), (2, near_a), (3, near_b)], [(5, a), (2, near_a), (2, b), (1, near_b), (7, "")],
                 [(None, a), (3, near_a), (None, near_b), (None, b), (None, "  ")]):
        rows = rows[::-1] if turned else rows
        df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        got = near_dedup.contract(df).collect()
        want = list(zip([i for i, _ in rows], components_by_row(rows), strict=True))
        assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)


def test_random_ids_and_texts(spark):
    rng = random.Random(11)
    rows = [(rng.choice([None, *range(25)]), t) for _, t, *_ in corpus(12, 70)]
    got = near_dedup.contract(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = list(zip([i for i, _ in rows], components_by_row(rows), strict=True))
    assert sorted(((r["doc_id"], r["component_id"]) for r in got), key=repr) == sorted(want, key=repr)


def test_slots_asked_for():
    """No pair at the threshold is left out with more than the stated chance."""
    assert near_dedup.agreement(80) == 51 and near_dedup.agreement(80, 1e-4) == 61


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    """Blocks of a few long sets lose nothing."""
    monkeypatch.setattr(near_dedup, "BLOCK_BYTES", 4000)
    rng = random.Random(5)
    base = words(rng, 400)
    rows = [(99, " ".join(base))]
    for i in range(25):
        own = list(base)
        for at in rng.sample(range(400), 9):
            own[at] = f"y{i}_{at}"
        rows.append((i, " ".join(own)))
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 4, 80)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == near_components(dict(rows), 4, 80)


def test_survivors(spark, tmpdir_factory_path):
    """One row of each component stays, whatever its id."""
    a, b, near_a, near_b = near_texts(2)
    rows = [(4, a, "x"), (4, a, "y"), (9, near_a, "z"), (None, b, "p"), (None, b, "q"), (None, near_b, "r"),
            (5, None, "s"), (5, None, "t"), (None, "", "u"), (8, "alone in this", "v"), (None, "alone too", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark string").coalesce(1)
    df.write.parquet(f"{tmpdir_factory_path}/docs")
    for docs in (df, spark.read.parquet(f"{tmpdir_factory_path}/docs")):
        got = near_dedup.survivors(docs)
        assert got.columns == docs.columns
        assert sorted(r["mark"] for r in got.collect()) == ["p", "s", "t", "u", "v", "w", "x"]


def test_lines_of_one_id_in_many_rows(spark):
    line = "a line that is long enough to be counted, " * 2
    rows = [(1, f"{line}\nown {i}") for i in range(4)] + [(2, line)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["n_dropped"] for r in got.collect()} == {0}
    more = rows + [(i, line) for i in range(3, 6)]
    got = line_dedup.dedup_lines(spark.createDataFrame(more, "doc_id long, text string")).collect()
    assert [r["n_dropped"] for r in got if r["doc_id"] == 5] == [0] and sum(r["n_dropped"] for r in got) == 7


def test_line_digests_that_share_their_first_half():
    import pyarrow as pa

    n = 50
    t = pa.table({"h": np.arange(n) // 2, "f": np.arange(n) * 7, "n": np.where(np.arange(n) % 3 == 0, 9, 1),
                  "holder": np.arange(n)})
    arrays = line_dedup._arrays(5)((pa.scalar(0),), t)
    probes = pa.table({"doc_id": np.full(n, 1000), "h": t.column("h"), "f": t.column("f")})
    got = line_dedup._probe(5)(probes, arrays)
    assert got.column("f").to_pylist() == [i * 7 for i in range(n) if i % 3 == 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=300))
def test_minimal_perfect_hash(keys):
    own = np.array(keys, np.uint64)
    hashed = MinimalPerfectHash.build(own)
    assert sorted(hashed.slots(own).tolist()) == list(range(len(keys)))
    again = MinimalPerfectHash(hashed.sizes, hashed.words)
    assert (again.slots(own) == hashed.slots(own)).all()


def test_lines_match_brute_force(spark, monkeypatch):
    rows = corpus(4, 150)
    want = deduped_lines([(r[0], r[1]) for r in rows])
    assert sum(v[1] for v in want.values()) > 10
    for shard, probe in ((line_dedup.SHARD_LINES, line_dedup.PROBE_ROWS), (50, 20)):
        monkeypatch.setattr(line_dedup, "SHARD_LINES", shard)
        monkeypatch.setattr(line_dedup, "PROBE_ROWS", probe)
        got = line_dedup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect()
        assert {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in got} == want
        assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_lines_odd_rows(spark):
    df = spark.createDataFrame([(*r, 9, 9) for r in odd_rows()], DOCS + ", n_lines int, h int")
    got = line_dedup.dedup_lines(df, min_docs=2).collect()
    assert len(got) == len(odd_rows()) and "h" in got[0].asDict()
    assert {r["n_lines"] for r in got if r["text"] is None} == {1}
    # Twice in one document is one document.
    assert next(r for r in got if r["doc_id"] == 8)["n_dropped"] == 0
    digests = line_dedup.contract(df).collect()
    assert {r["kept_sha256"] for r in digests if r["doc_id"] in (1, 2)} == {hashlib.sha256(b"").hexdigest()}


def test_line_kept_in_largest_id_and_forty_code_points(spark):
    short, exact = "é" * 39, "é" * 40
    rows = [(i, f"{short}\n \t{exact}\r\nown {i}") for i in range(5)] + [(9, "x")]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[4] == rows[4][1] and got[0] == f"{short}\nown 0" and got[9] == "x"


def _contained(docs, items, n=5, percent=80):
    import regex

    def cut(t):
        return [w for w in regex.split(r"[^\p{L}\p{N}]+", (t or "").lower()) if w]

    out = set()
    for i, t in items:
        own = cut(t)
        k = min(n, len(own))
        if not k:
            continue
        item = {tuple(own[j:j + k]) for j in range(len(own) - k + 1)}
        for d, text in docs:
            w = cut(text)
            held = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)}
            if len(item & held) * 100 >= percent * len(item):
                out.add((d, i, len(item), len(item & held)))
    return out


@pytest.mark.parametrize("broadcast", [8 << 20, -1])
def test_contained_items_match_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(decontam, "BROADCAST_BYTES", broadcast)
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, rng.randrange(1, 60)))) for i in range(40)] + [(90, "?!"), (91, None), (92, "")]
    docs = []
    for d in range(60):
        own = words(rng, rng.randrange(0, 300))
        if d % 2:
            item = rng.choice(items[:40])[1].split()
            for _ in range(rng.randrange(0, 1 + len(item) // 8)):
                item[rng.randrange(len(item))] = "changed"
            at = rng.randrange(len(own) + 1)
            own[at:at] = [w.upper() + "," for w in item]
        docs.append((d, " ".join(own)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, "..")]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"),
                                spark.createDataFrame(items, "item_id long, text string"))
    want = _contained([d for d in docs if d[0] is not None], items)
    assert len(want) > 10 and {tuple(r) for r in got.collect()} == want


def test_clean_keeps_the_rest(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f g", "x"), (2, "other words", "y"), (None, "a b c d e f", "z"), (None, "no item", "q"),
         (2, "b c d e f", "r"), (None, None, "s")], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, "b c d e f"), (8, None)], "item_id long, text string")
    assert sorted(r["item_id"] for r in decontam.clean(docs, bench).collect()) == ["q", "s", "y"]
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontam.clean(docs, none).count() == 6


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    bench = spark.createDataFrame([(7, "b c d e f")], "item_id long, text string")
    assert near_dedup.contract(docs).count() == 0
    assert line_dedup.contract(docs).count() == 0
    assert decontam.contract(docs, bench).count() == 0
