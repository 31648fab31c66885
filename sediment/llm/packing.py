"""Sequence packing by minimum bin slack.

Documents are encoded, given an end id, and only those longer than a sequence are cut.  All that
matters for packing is how many pieces there are of each length, a table of at most ``capacity``
rows.  From it the fullest bins are found one kind at a time: the longest length left is placed,
a bitset subset-sum over the other lengths (as often as pieces are left) finds the fullest total
that fits, and that combination is removed as many times as the counts allow.  Removing a
combination so often leaves some length with fewer pieces than the combination uses, so there are
few kinds (thousands, however many pieces), each of at most 90 different lengths.

Every piece then finds its place from its rank among the pieces of its length.  Ranks are counted
in buckets of at most about BUCKET pieces, by a hash of the piece, so a length that a third of
all pieces share is ranked in many tasks.  Only the length table (proven bound: ``capacity``
rows) reaches the driver; the bucket offsets are broadcast while there are at most FEW of them.

Defined cases: a null or empty text is one piece holding the end id; rows that repeat are packed
each; null ids are an id like others; an empty table gives no rows; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import small_batches, stratified_rank, written
from sediment.llm.tokens import encoder

CAPACITY = 4096
END = 1
BUCKET = 8192
FEW = 200_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cut(vocab: str, capacity: int, end: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocab)
        for batch in batches:
            owner, piece, start, pieces = [], [], [], []
            for row, ids in enumerate(coder.encode(batch.column(1), end)):
                for n, at in enumerate(range(0, len(ids), capacity)):
                    owner.append(row)
                    piece.append(n)
                    start.append(at)
                    pieces.append(ids[at:at + capacity])
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()), pa.array([len(x) for x in pieces], pa.int64()),
                pa.array([zlib.crc32(x.astype("<u4", copy=False).tobytes()) for x in pieces], pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([x.view(np.int32) for x in pieces], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return run


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocab: str = "word_bpe_49k.json",
           end: int = END, with_ids: bool = False) -> DataFrame:
    """One row per piece of every document, in no order; with_ids adds the ids themselves."""
    small_batches(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(_cut(vocab, capacity, end, with_ids),
                        PIECES + (", ids array<int>" if with_ids else "")))


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination with the longest length left: length to how often.

    Bit t of the set is on if a total of t can be reached.  Lengths are offered from long to
    short, each as often as pieces are left and fit, in doubling groups; the walk back takes of
    every group what the total needs.  Offering stops once the bin can be filled.
    """
    first = max(counts)
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == first), room // length)
        group = 1
        while left > 0 and not reach >> room & 1:
            times = min(group, left)
            steps.append((length, times, reach))
            reach |= reach << (length * times) & mask
            left -= times
            group *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {first: 1}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + times
            total -= length * times
    return chosen


def patterns(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(how many sequences, their contents by length) until no piece is left."""
    counts = {k: n for k, n in counts.items() if n > 0}
    out = []
    while counts:
        chosen = fullest(counts, capacity)
        times = min(counts[k] // n for k, n in chosen.items())
        out.append((times, chosen))
        for k, n in chosen.items():
            counts[k] -= times * n
            if not counts[k]:
                del counts[k]
    return out


def _places(kinds: list[tuple[int, dict[int, int]]]) -> dict[str, np.ndarray]:
    """For each (length, first rank) that a kind of sequence takes: where those pieces go."""
    rows, taken, sequence = [], {}, 0
    for times, chosen in kinds:
        offset = 0
        for length in sorted(chosen, reverse=True):
            first = taken.get(length, 0)
            rows.append((length, first, chosen[length], sequence, offset))
            taken[length] = first + times * chosen[length]
            offset += length * chosen[length]
        sequence += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "copies", "sequence", "offset"), table.T, strict=True))


RANK_BITS = 40  # ranks of one length stay below


def _place(places: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = (places["length"] << RANK_BITS) + places["first"]
        for batch in batches:
            own = batch.column(batch.schema.get_field_index("length")).to_numpy()
            rank = batch.column(batch.schema.get_field_index("__rank")).to_numpy() - 1
            entry = np.searchsorted(starts, (own << RANK_BITS) + rank, side="right") - 1
            inside, copies = rank - places["first"][entry], places["copies"][entry]
            sequence = places["sequence"][entry] + inside // copies
            offset = places["offset"][entry] + inside % copies * own
            keep = [n for n in batch.schema.names if n != "__rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in keep), pa.array(sequence), pa.array(offset)],
                [*keep, "sequence_id", "offset"])
    return run


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (a written table of pieces, see ``pieces``) with sequence_id and offset."""
    spark = cut.sparkSession
    by_length = cut.groupBy("length").count().collect()  # at most ``capacity`` rows
    counts = {r["length"]: r["count"] for r in by_length}
    places = _places(patterns(counts, capacity))
    buckets = {k: -(-n // BUCKET) for k, n in counts.items()}
    by_length = spark.createDataFrame([(k, n) for k, n in buckets.items()], "__length long, __buckets long")
    columns = [c for c in cut.columns if c not in ("sequence_id", "offset")]
    # The leading key of the rank: a hash, shifted to be positive, whose range the buckets share.
    lead = F.shiftrightunsigned(F.xxhash64("doc_id", "piece"), 33)
    order = [lead, *[F.col(c) for c in ("doc_id", "piece", "start", "ids_crc32")]]
    small_batches(spark)
    rows = cut.select(columns).join(F.broadcast(by_length), F.col("length") == F.col("__length"))
    ranked = stratified_rank(rows, ["length"], F.floor(lead * F.col("__buckets") / F.lit(1 << 31)), order,
                             "__rank", few=sum(buckets.values()) <= FEW).drop("__length", "__buckets")
    kinds = {f.name: f.dataType.simpleString() for f in ranked.schema.fields if f.name != "__rank"}
    schema = ", ".join(f"`{k}` {v}" for k, v in kinds.items()) + ", sequence_id long, offset long"
    return ranked.mapInArrow(_place(places), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed ids, one row per sequence, from pieces that carry ``ids``."""
    return (packed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("__p"))
            .select("sequence_id", F.col("__p.doc_id").alias("doc_ids"),
                    F.flatten("__p.ids").alias("ids")))


def contract(docs: DataFrame) -> DataFrame:
    return pack(written(pieces(docs), "pieces")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
