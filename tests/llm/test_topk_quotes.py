"""Exact search and quotation linking against brute force."""

import math
import random

import numpy as np
import pytest

from sediment.llm import quotes, topk

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(rows, k=5, every=50):
    own = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v, _ in rows
           if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in {(i, tuple(v)) for i, v in own if i % every == 0}:
        found = sorted((-sum(x * y for x, y in zip(a, v, strict=True)), i)
                       for i, v in own if i != q and len(v) == len(a))[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(found)}
    return out


@pytest.mark.parametrize("shard", [8192, 40])
def test_top_k_is_exact(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "LEAF_ROWS", 8)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6).astype("f4")], 0) for i in range(400)]
    rows += [(i + 400, rows[50][1], 0) for i in range(30)]  # ties and copies
    rows += [(1000, None, 1), (1001, [1.0, None, 2.0, 0.0, 0.0, 0.0], 1), (None, [1.0] * 6, 0),
             (1050, [float("nan")] * 6, 0), (1100, [float("inf")] + [0.0] * 5, 0), (1150, [], 0),
             (2000, [1.0, 2.0], 0), (2001, [3.0, 4.0], 0)]
    got = topk.contract(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute(rows)


def test_tree_opens_only_what_it_must():
    rng = np.random.default_rng(2)
    points = np.floor(rng.normal(size=(5000, 2)) * 256)
    tree = topk.KdTree.build(points)
    assert sorted(tree.order.tolist()) == list(range(5000))
    queries = points[:20]
    bounds = tree.bounds(queries)
    for node, (a, b) in enumerate(tree.span):
        assert (bounds[:, node] >= (queries @ points[tree.order[a:b]].T).max(axis=1) - 1e-6).all()
    again = topk.KdTree.load(tree.dump(), 2)
    for name in ("low", "high", "child", "span"):
        assert (getattr(again, name) == getattr(tree, name)).all()


def test_one_id_in_very_many_rows(spark, monkeypatch):
    """Rows are dealt by place, so a repeated id does not fill one shard; no query meets its own id."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 60)
    rng = np.random.default_rng(5)
    rows = [(50, [float(x) for x in rng.integers(-3, 4, size=3)], 0) for _ in range(600)]
    rows += [(i, [float(x) for x in rng.integers(-3, 4, size=3)], 0) for i in range(51, 151)]
    got = topk.contract(spark.createDataFrame(rows, VECTORS))
    one = {r for r in map(tuple, got.collect()) if r[0] != 50}
    assert one == {r for r in brute(rows) if r[0] != 50}
    sizes = topk.with_places(topk.written(topk.quantised(spark.createDataFrame(rows, VECTORS)), "t")).groupBy(
        topk.F.pmod(topk.F.xxhash64("__file", "__row"), topk.F.lit(12))).count().collect()
    assert max(r["count"] for r in sizes) < 200


def test_no_vectors(spark):
    assert topk.contract(spark.createDataFrame([], VECTORS)).count() == 0


CHATS = "conv_id long, turn int, role string, text string"


def chat_rows():
    first = "The plan is to meet at noon.\nBring the red folder with you."
    second = "I cannot come at noon, is two o'clock fine?"
    return [
        (1, 0, "user", first), (1, 1, "assistant", second + "\n\nOn Monday, A wrote:\n> The plan is to meet at NOON.\n> Bring the red folder, with you."),
        (1, 2, "user", "Unrelated remark > not a quote"),
        (1, 3, "assistant", "> > The plan is to meet at noon.\n> I cannot come at noon, is two o'clock fine?\nTwo is fine."),
        (1, 4, "user", "> something that nobody said\nWho said this?"),
        (1, 5, "user", ">Unrelated remark > not a quote\n>> Two is fine.\nAgreed"),
        (2, 0, "user", "> The plan is to meet at noon.\nother conversation"),
        (None, 0, "user", "x y z"), (None, 1, "user", "> x y z\nanswer"), (3, None, "user", "> x"),
        (4, 0, "user", None), (4, 1, "user", ""), (4, 2, "user", "> "), (4, 0, "user", None),
    ]


def test_quotes_are_linked_and_removed(spark):
    got = quotes.contract(spark.createDataFrame(chat_rows(), CHATS)).collect()
    assert len(got) == len(chat_rows())
    by = {(r["conv_id"], r["turn"]): r for r in got}
    assert [by[1, t]["reply_to"] for t in range(6)] == [None, 0, None, 1, None, 2]
    assert [by[1, t]["depth"] for t in range(6)] == [0, 1, 0, 2, 0, 1]
    assert [by[1, t]["thread"] for t in range(6)] == [0, 0, 2, 0, 4, 2]
    assert by[1, 1]["body"] == "I cannot come at noon, is two o'clock fine?"
    assert by[1, 3]["body"] == "Two is fine." and by[1, 2]["body"] == "Unrelated remark > not a quote"
    assert by[1, 4]["n_quoted"] == 1 and by[2, 0]["reply_to"] is None
    assert by[None, 1]["reply_to"] == 0 and by[3, None]["reply_to"] is None
    order = sorted((r["position"], r["turn"]) for r in got if r["conv_id"] == 1)
    assert [t for _, t in order] == [0, 1, 3, 2, 5, 4] and [p for p, _ in order] == list(range(6))


def test_long_reply_chain(spark):
    rng = random.Random(1)
    rows = [(9, 0, "user", "message zero starts it")]
    for t in range(1, 40):
        rows.append((9, t, "user", f"> {rows[-1][3].splitlines()[-1]}\nmessage {t} {rng.random()}"))
    got = quotes.contract(spark.createDataFrame(rows, CHATS)).collect()
    assert {r["turn"]: r["depth"] for r in got} == {t: t for t in range(40)}
    assert all(r["thread"] == 0 for r in got)


def test_messages_without_quotes_keep_their_order(spark):
    rows = [(c, t, "user", f"text {c} {t}") for c in range(3) for t in range(30)]
    got = quotes.contract(spark.createDataFrame(rows, CHATS)).collect()
    assert all(r["position"] == r["turn"] and r["reply_to"] is None for r in got)
    assert quotes.contract(spark.createDataFrame([], CHATS)).count() == 0


def test_quotes_match_the_oracle(spark):
    """The SQL of the registered query, on conversations that do quote."""
    import duckdb
    import pandas as pd

    from sediment.llm.queries import ORACLE

    rng = random.Random(3)
    lines = [f"sentence number {i} of the talk" for i in range(12)] + ["", "a > b", "On Monday, B wrote:"]
    rows = chat_rows()
    for conv in range(10, 16):
        for turn in range(12):
            text = [rng.choice(("", "", "> ", ">> ", "> > ", " >")) + rng.choice(lines) for _ in range(rng.randrange(6))]
            rows.append((conv, turn, rng.choice(("user", "assistant")), "\n".join(text)))
    conversations = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype(
        {"conv_id": "Int64", "turn": "Int32"})
    con = duckdb.connect()
    con.register("conversations", conversations)
    cur = con.execute(ORACLE["op4_quote_threads"])
    names = [d[0] for d in cur.description]
    want = sorted(map(repr, cur.fetchall()))
    got = quotes.contract(spark.createDataFrame(rows, CHATS)).select(names).collect()
    assert sorted(repr(tuple(r)) for r in got) == want


def test_partial_and_rewrapped_quotes(spark):
    rows = [
        (1, 0, "user", "We will paint the old barn red in May. After that we may mend the long fence by the road."),
        (1, 1, "assistant", "I have no paint for the old barn at all."),
        (1, 2, "user", "> After that we may mend the long fence\nWhich fence?"),
        (1, 3, "assistant", "> We will paint the old\n> barn red in May. After that\n> we may mend\nNot in May."),
        (1, 4, "user", "> We will paint\nWho?"),
    ]
    by = {r["turn"]: r for r in quotes.contract(spark.createDataFrame(rows, CHATS)).collect()}
    # Three words of a longer line are no unit: the quote is removed, the message not linked.
    assert [by[t]["reply_to"] for t in range(5)] == [None, None, 0, 0, None]
    assert by[3]["body"] == "Not in May." and by[4]["body"] == "Who?"


def test_latest_earlier_holder_across_blocks(spark, monkeypatch):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", 4)
    rng = random.Random(4)
    asked = {(c, u, rng.randrange(60)) for c in (None, 1) for u in "abc" for _ in range(25)}
    held = {(c, u, rng.randrange(60)) for c in (None, 1) for u in "abd" for _ in range(7)}
    got = quotes.latest_before(spark.createDataFrame(sorted(asked, key=repr), "conv_id long, u string, turn int"),
                               spark.createDataFrame(sorted(held, key=repr), "conv_id long, u string, orig int"))
    want = {(c, u, t, max(o)) for c, u, t in asked if (o := [x for d, v, x in held if (d, v) == (c, u) and x < t])}
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_many_quoted_lines_and_a_hot_unit(spark):
    """One message of very many quoted lines, and one short line held and quoted by every message."""
    runs = "\n".join(f"{'>' * (1 + i % 2)} line {i}" for i in range(100_000))
    rows = [(1, 0, "user", "line 0"), (1, 1, "user", runs)]
    rows += [(2, t, "user", "> ok\nok") for t in range(20_000)]
    got = quotes.link(quotes.parse(spark.createDataFrame(rows, CHATS))).collect()
    assert len(got) == 20_000 and all(r["reply_to"] == r["turn"] - 1 for r in got)
