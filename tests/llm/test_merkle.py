"""The Merkle manifest against a plain tree, and its sweeps against the tree's shape."""

import random
import zlib
from hashlib import sha256

import pytest
from helpers import DOCS, corpus, odd_rows

from sediment.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    i, text, lang, source, n = row
    said = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h(*map(said, (i, source, lang, n, text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][k:k + 2]) for k in range(0, len(out[-1]), 2)])
    return out


def proof(tree, at):
    out = []
    for level in tree[:-1]:
        out.append((at & 1, level[at ^ 1] if at ^ 1 < len(level) else None))
        at >>= 1
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = [levels([leaf(r) for r in groups[g]]) for g in order]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, (g, t) in enumerate(zip(order, trees, strict=True)):
        for at, r in enumerate(groups[g]):
            path = proof(t, at) + proof(top, k)
            i, text, lang, source, n = r
            hit = zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 0 and n is not None
            got = leaf((i, text, lang, source, n + 1)) if hit else leaf(r)
            for side, sibling in path:
                got = h(got) if sibling is None else h(sibling, got) if side else h(got, sibling)
            root = top[-1][0]
            out.append((i, leaf(r), t[-1][0], root, h(*[s for _, s in path if s]), got, got == root))
    return sorted(out, key=repr)


def run(spark, rows, levels=merkle.LEVELS):
    return sorted(map(tuple, merkle.contract(spark.createDataFrame(rows, DOCS), levels).collect()), key=repr)


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest(spark, levels):
    """One tier, and many tiers of small segments."""
    rng = random.Random(5)
    rows = [(i * 7, t, rng.choice(["de", "en", "en", "én", None, f"x{i}"]), s, n)
            for i, t, _, s, n in corpus(4, 45)]
    got = run(spark, rows, levels)
    assert got == brute(rows)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)


@pytest.mark.parametrize("rows", [odd_rows(), [], [(7, "only", "en", "a", 4)],
                                  [(1, None, None, None, None)] * 5])
def test_odd_rows(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_other_columns_play_no_part(spark):
    from pyspark.sql import functions as F

    rows = corpus(6, 12)
    more = ["grp", "seg", "place", "nodes", "digest", "row", "note", "proof", "__part"]
    docs = spark.createDataFrame(rows, DOCS).select("*", *[F.lit("x").alias(c) for c in more])
    assert sorted(map(tuple, merkle.contract(docs).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 1024])
def test_sweeps_of_a_segment(n):
    leaves = [h(str(i)) for i in range(n)]
    segment = merkle.Segment(n, n)
    known = segment.forward(leaves)
    tree = levels(leaves)
    assert known == {(lv, i): d for lv, row in enumerate(tree) for i, d in enumerate(row)}
    labels = [segment.label(*node) for node in known]
    assert labels == sorted(labels)  # children come before their parents
    said = segment.backward(known, "")
    for at, got in enumerate(said):
        want = "".join("," if s is None else f"{'RL'[side]}{s}," for side, s in proof(tree, at))
        assert got == want


def test_queue_stays_small(monkeypatch):
    """At most two messages a level wait in the forward sweep."""
    most = []
    send = merkle.LabelQueue.send
    monkeypatch.setattr(merkle.LabelQueue, "send",
                        lambda self, *a: (send(self, *a), most.append(len(self.heap)))[0])
    merkle.Segment(1024, 1024).forward(["0" * 64] * 1024)
    assert max(most) <= 2 * merkle.LEVELS
