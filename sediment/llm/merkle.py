"""Merkle dataset manifest by time-forward processing.

Every row is a leaf: the SHA-256 of its fields, each written as its UTF-8 byte count, a colon and
its value (``-`` for null).  The leaves of a group (``lang``) ascend by doc_id; level by level
every two consecutive digests (as hex text) are hashed into one, a last lone one by itself, until
one is left, the group's subroot.  The subroots, ordered by group, give the root likewise.

1. Leaves are range-sorted by (group, doc_id) and written; a place in its group is the rows of
   the earlier ranges plus the row number in its own.  A hot group is so dealt over many tasks.
2. Forward sweep.  Nodes carry labels that rise from children to parents: (last leaf below,
   level).  A priority queue ordered by label delivers child digests to parents.  Its external
   part is Spark's sort: segments of 2^LEVELS neighbouring nodes of a group are sorted by place
   and swept by one task each, and the digest of a segment's top, a message to a label beyond
   the segment, is written and sorted into the segment of the next tier.  Inside a segment the
   queue is a heap of at most two messages a level.  A tier climbs LEVELS levels, so four tiers
   hold 2^40 rows of one group.
3. Reversed sweep, from the top tier down and by falling labels: a node's message is its proof
   suffix (the siblings from its own level to the root); it delivers to each child that child's
   sibling followed by its own suffix.  Suffixes of segment tops are again sorted into the
   segments of the tier below as their first row.  What the leaves receive are their proofs.

Defined cases: a null group is a group of its own and comes first; null doc_ids come first; rows
that repeat a doc_id follow each other in the order of their leaves, and rows equal in all fields
are interchangeable; null and empty texts differ (``-`` and ``0:``); a group of one row has its
leaf for subroot, one group's subroot is the root; an empty table gives no rows; other columns
play no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.llm.common import doc_crc, small_batches, written

LEVELS = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 7


def leaf(**changed: Column) -> Column:
    """A row's leaf digest, with some fields replaced."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        said = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(said.cast("binary"), F.lit("-").cast("binary")))
    return F.sha2(F.concat(*parts), 256)


def digest(*hexes: str) -> str:
    return sha256("".join(hexes).encode()).hexdigest()


class LabelQueue:
    """Messages to labelled nodes, delivered by rising label and, of one label, sender."""

    def __init__(self):
        self.heap = []

    def send(self, label: tuple, sender: int, message) -> None:
        heapq.heappush(self.heap, (label, sender, message))

    def next_label(self):
        return self.heap[0][0] if self.heap else None

    def receive(self, label: tuple) -> list:
        out = []
        while self.heap and self.heap[0][0] == label:
            out.append(heapq.heappop(self.heap)[2])
        return out


def height(nodes: int) -> int:
    """Levels from ``nodes`` nodes to the one that is left."""
    return max(0, nodes - 1).bit_length()


class Segment:
    """Up to 2^LEVELS neighbouring nodes of one group that has ``group_nodes`` of them."""

    def __init__(self, group_nodes: int, size: int, levels: int = LEVELS):
        self.size = size
        self.top = min(height(group_nodes), levels)

    def label(self, level: int, index: int) -> tuple[int, int]:
        """(last leaf below, level): rises from children to parents."""
        return (min((index + 1) << level, self.size) - 1, level)

    def forward(self, leaves: list[str]) -> dict[tuple[int, int], str]:
        """Digests by (level, index), in the order in which the sweep meets the nodes."""
        queue, known = LabelQueue(), {}
        for place, value in enumerate(leaves):
            known[0, place] = value
            if self.top:
                queue.send(self.label(1, place >> 1), place, value)
            while queue.heap and queue.next_label()[0] <= place:
                label = queue.next_label()
                level = label[1]
                index = place >> level
                value = digest(*queue.receive(label))
                known[level, index] = value
                if level < self.top:
                    queue.send(self.label(level + 1, index >> 1), index, value)
        return known

    def backward(self, known: dict[tuple[int, int], str], suffix: str) -> list[str]:
        """Each leaf's proof: steps from its own level to the root.

        A step is ``L`` or ``R`` and the digest of the sibling on that side, or nothing for a
        node hashed by itself; every step ends in a comma.
        """
        queue, proofs = LabelQueue(), [""] * self.size
        queue.send((-(self.size - 1), -self.top), 0, suffix)
        for level, index in reversed(known):
            end, _ = self.label(level, index)
            own, = queue.receive((-end, -level))
            if level == 0:
                proofs[index] = own
                continue
            left, right = 2 * index, 2 * index + 1
            sides = [(left, known.get((level - 1, right)), "R"), (right, known[level - 1, left], "L")]
            for child, sibling, side in sides:
                if (level - 1, child) in known:
                    step = "," if sibling is None else f"{side}{sibling},"
                    queue.send((-self.label(level - 1, child)[0], 1 - level), child, step + own)
        return proofs


def _segments(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list[tuple]]:
    """Sorted rows -> the rows of each segment (equal in the first two columns)."""
    held = []
    for batch in batches:
        for row in zip(*[batch.column(i).to_pylist() for i in range(columns)], strict=True):
            if held and held[-1][:2] != row[:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


UP = "grp string, seg long, nodes long, digest string"


def _up(levels: int):
    """(grp, seg, place, nodes, digest) -> (grp, seg, nodes, digest of the segment's top)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for rows in _segments(batches, 5):
            segment = Segment(rows[0][3], len(rows), levels)
            known = segment.forward([r[4] for r in rows])
            out.append((*rows[0][:2], rows[0][3], known[segment.top, 0]))
            if len(out) >= 4096:
                yield _batch(out, UP)
                out = []
        yield _batch(out, UP)
    return run


NODE = ["grp", "seg", "place", "nodes", "digest", "row", "note"]
DOWN = "grp string, place long, digest string, row long, note string, subroot string, proof string"


def _down(levels: int):
    """NODE columns, subroot, proof -> DOWN; the first row of a segment (place -1) is the message
    from above."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _segments(batches, len(NODE) + 2):
            (*_, subroot, suffix), own = rows[0], rows[1:]
            segment = Segment(own[0][3], len(own), levels)
            proofs = segment.backward(segment.forward([r[4] for r in own]), suffix)
            yield _batch([(r[0], r[2], r[4], r[5], r[6], subroot, p)
                          for r, p in zip(own, proofs, strict=True)], DOWN)
    return run


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = [c.strip().split(" ") for c in schema.split(",")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    kind = {"string": pa.string(), "long": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array(c, kind[k]) for c, (_, k) in zip(columns, kinds, strict=True)],
                                      [n for n, _ in kinds])


def _sorted_segments(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("grp", "seg").sortWithinPartitions("grp", "seg", "place")


def _places(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with each row's ``place`` (from 0) in its ``grp`` and the group's ``nodes``, written.

    Rows are range-sorted by (grp, order); equal rows are told apart by their place in the
    scan, so that copies of one row do not stay in one range.
    """
    rows = (df.withColumn("__scan", F.monotonically_increasing_id())
            .repartitionByRange("grp", *order, "__scan").sortWithinPartitions("grp", *order, "__scan")
            .drop("__scan").withColumn("__at", F.monotonically_increasing_id()))
    rows = written(rows.select("*", F.shiftright("__at", 33).alias("__part")), f"merkle-{name}")
    # One row per group and range that it reaches.
    counts = rows.groupBy("grp", "__part").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("low"))
    every = Window.partitionBy("grp")
    earlier = every.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(counts.select(
        F.col("grp").alias("g"), F.col("__part").alias("p"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("low")).alias("shift"),
        F.sum("n").over(every).alias("nodes")), f"merkle-{name}-offsets")
    placed = rows.join(offsets, rows["grp"].eqNullSafe(offsets["g"]) & (rows["__part"] == offsets["p"]))
    return placed.withColumn("place", F.col("__at") + F.col("shift")).drop("g", "p", "shift", "__at", "__part")


def _tiers(base: DataFrame, name: str, levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The forward sweep: nodes of every tier (from ``base``), and (grp, digest) of the subroots."""
    tiers, done = [base.withColumn("seg", F.shiftright("place", levels)).select(NODE)], None
    while True:
        up = written(_sorted_segments(tiers[-1].select("grp", "seg", "place", "nodes", "digest"))
                     .mapInArrow(_up(levels), UP), f"merkle-{name}-up")
        ended = up.where(F.col("nodes") <= 1 << levels).select("grp", "digest")
        done = ended if done is None else done.union(ended)
        rest = up.where(F.col("nodes") > 1 << levels)
        if rest.isEmpty():
            return tiers, done
        tiers.append(rest.select(
            "grp", F.shiftright("seg", levels).alias("seg"), F.col("seg").alias("place"),
            F.shiftright(F.col("nodes") + ((1 << levels) - 1), levels).alias("nodes"), "digest",
            F.lit(None).cast("long").alias("row"), F.lit(None).cast("string").alias("note")))


def _proofs(tiers: list[DataFrame], tops: DataFrame, name: str, levels: int) -> DataFrame:
    """The reversed sweep: DOWN columns of the first tier's nodes.

    ``tops``: (grp, subroot, proof) of every group, which enter the tier that a group ends in.
    """
    sent = None
    for at in reversed(range(len(tiers))):
        ends = tiers[at].where((F.col("nodes") <= 1 << levels) & (F.col("place") == 0)).select(F.col("grp").alias("g"))
        first = tops.join(ends, tops["grp"].eqNullSafe(ends["g"]), "left_semi").select(
            "grp", F.lit(0).cast("long").alias("seg"), "subroot", "proof")
        if sent is not None:
            first = first.union(sent.select("grp", F.col("place").alias("seg"), "subroot", "proof"))
        messages = first.withColumn("place", F.lit(-1).cast("long"))
        rows = tiers[at].unionByName(messages, allowMissingColumns=True).select(*NODE, "subroot", "proof")
        sent = _sorted_segments(rows).mapInArrow(_down(levels), DOWN)
        if at:
            sent = written(sent, f"merkle-{name}-down")
    return sent


def manifest(docs: DataFrame, group: str = "lang", changed: Column | None = None,
             levels: int = LEVELS) -> DataFrame:
    """One row per input row: grp, doc_id, place (in its group), leaf, changed (the leaf with
    ``changed`` for n_chars, null where that is the same), subroot, root and proof.

    The proof lists the siblings from the leaf to the root, see ``Segment.backward``.
    """
    small_batches(docs.sparkSession)
    other = leaf(n_chars=changed) if changed is not None else F.lit(None).cast("string")
    rows = docs.select(F.col(group).cast("string").alias("grp"), F.col("doc_id").cast("long").alias("row"),
                       leaf().alias("digest"), other.alias("note"))
    rows = rows.withColumn("note", F.when(F.col("note") != F.col("digest"), F.col("note")))
    tiers, subroots = _tiers(_places(written(rows, "merkle-leaves"), ["row", "digest"], "leaves"), "leaves", levels)
    # The upper tree: one group, whose nodes are the subroots; their note names the group.
    named = subroots.select(F.lit("").alias("grp"), F.lit(None).cast("long").alias("row"), "digest",
                            F.col("grp").alias("note"))
    upper, ended = _tiers(_places(named, ["note"], "roots"), "roots", levels)
    root = ended.select(F.col("grp"), F.col("digest").alias("subroot"), F.lit("").alias("proof"))
    # One digest, or none for an empty table.
    value = F.lit(next((r["subroot"] for r in root.collect()), None)).cast("string")
    tops = written(_proofs(upper, root, "roots", levels).select(
        F.col("note").alias("grp"), F.col("digest").alias("subroot"), "proof"), "merkle-tops")
    return _proofs(tiers, tops, "leaves", levels).select(
        "grp", F.col("row").alias("doc_id"), "place", F.col("digest").alias("leaf"),
        F.col("note").alias("changed"), "subroot", value.alias("root"), "proof")


def steps(proof: Column) -> Column:
    every = F.split(proof, ",")
    return F.slice(every, F.lit(1), F.size(every) - 1)


def folded(value: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(steps(proof), value, lambda got, step: F.sha2(
        F.when(step.startswith("L"), F.concat(F.substring(step, 2, 64), got))
        .when(step.startswith("R"), F.concat(got, F.substring(step, 2, 64)))
        .otherwise(got).cast("binary"), 256))


def contract(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest of ``documents`` by lang, checked after tampering with the n_chars of the
    documents whose decimal doc_id has a crc32 that 7 divides (a null id's is 0)."""
    chars = F.col("n_chars").cast("long")
    changed = F.when(doc_crc(F.col("doc_id")) % TAMPER_EVERY == 0, chars + 1).otherwise(chars)
    out = manifest(docs, changed=changed, levels=levels).withColumn(
        "folded_root", folded(F.coalesce("changed", "leaf"), F.col("proof")))
    siblings = F.regexp_replace("proof", "[LR,]", "")
    return out.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
