"""MinHash near-dedup with SuperMinHash signatures.

1. A document's set: the distinct 64-bit hashes of its word shingles (words are runs without
   ASCII white space, A-Z lower-cased; a text of fewer words is one shingle).  Rows with equal
   sets (128-bit digest) form a numbered class; all that follows is about classes.
2. Every set gets a SuperMinHash signature: each element draws one permutation of the slots, and
   the value it offers the j-th slot of its permutation lies in [j, j + 1).  Slots so compete over
   ranks that are correlated within an element, which lowers the variance against independent
   hashes, and a document stops at the first round in which all its slots are held by lower ones.
3. Signatures are cut into BANDS bands of ROWS slots; classes that agree in a band are candidates.
   A pair at the threshold of 0.8 is missed with probability (1 - 0.8^4)^24 < 4e-6.
4. Candidates are verified on their full sets.  First every band group offers the pairs of its
   members with one hub, and verified links are merged into components, which leaves most groups
   with one component.  The members of the groups left are compared in blocks of bounded rows and
   bytes, inside tasks: first on whole signatures, in the first band that a pair shares, where
   pairs that agree in fewer slots than all but one in 10^9 pairs at the threshold are left out
   (``agreement``, by the binomial distribution: 51 of 96 slots at 0.8); then the members with
   such a partner bring their sets, and the pairs are verified.  A verified link joins its
   components, so that a block returns at most as many links as it has members.  No group emits
   its pairs.  What may be missed are only pairs by the chances named here and in step 3.
5. Components by minimum label and pointer jumping over the verified links and over the links
   between the classes of one doc_id, which joins the components of all its texts.

Defined cases: null, empty or blank texts have an empty set, linked with nothing but their own
doc_id's other rows; rows that repeat a doc_id count as one document (of each its own
n_shingles); a row with a null doc_id may link others, takes its component's smallest doc_id,
and is kept, with a null component, if there is none; an empty table gives no rows; other
columns play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.bytehash import BASE, blanks, range_hashes
from sediment.llm.common import components, discard, small_batches, with_places, written
from sediment.llm.mph import mix

BANDS, ROWS = 24, 4
SLOTS = BANDS * ROWS
GROUP_BYTES = 4 << 20
ROUND_ELEMENTS = 1 << 19
BLOCK_MEMBERS = 1024
BLOCK_BYTES = 8 << 20
CHUNK_PAIRS = 1 << 16
BLOCK_ROWS = ("band long, lo int, hi int, block int, rep long, n long, label long, "
              "bands array<long>, slots binary")

_U = np.uint64


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each word of the bytes."""
    edge = np.diff(np.concatenate(([True], blanks(data), [True])).astype(np.int8))
    start, stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    return start, range_hashes(data, start, stop - start, fold=True)[0]


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    joined = b"\n".join(texts)
    start, hashes = _word_hashes(np.frombuffer(joined, np.uint8))
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(start, ends)
    if len(hashes) >= words:
        run = np.zeros(len(hashes) - words + 1, np.uint64)
        for k in range(words):
            run = run * _U(0xD6E8FEB86659FD93) + hashes[k:len(hashes) - words + 1 + k]
        run = mix(run)
    out, first = [], 0
    for last in upto:
        n = last - first
        if n >= words:
            own = np.sort(run[first:last - words + 1])
            out.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            out.append(np.frombuffer(xxhash.xxh3_64_digest(hashes[first:last].tobytes()), np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        first = last
    return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each non-empty set: one row of ``slots`` values, rank above fraction."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), slots), np.iinfo(np.uint64).max, np.uint64)
    if not len(sets):
        return out
    owner = np.repeat(np.arange(len(sets)), sizes)
    element = np.concatenate(sets)
    flat = out.reshape(-1)
    # Round 0 needs no permutation yet: an element's first slot is uniform.
    swaps = []
    for j in range(slots):
        if not len(element):
            break
        draw = mix(element + _U((j + 1) * BASE & (2 ** 64 - 1)))
        pick = j + (((draw >> _U(48)) * _U(slots - j)) >> _U(16)).astype(np.int64)
        if j == 0:
            slot = pick
        else:
            if j == 1:  # few documents are left by now: lay out their permutations
                order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32),
                                (len(element), 1))
                row = np.arange(len(element))
                order[row, swaps[0]] = 0
                order[row, 0] = swaps[0]
            slot = order[row, pick].astype(np.int64)
            order[row, pick] = order[row, j]
            order[row, j] = slot
        value = (_U(j) << _U(48)) | (draw & _U((1 << 48) - 1))
        np.minimum.at(flat, owner * slots + slot, value)
        # A document is done when every slot is held from this round or an earlier one.
        done = out.max(axis=1) < _U(j + 1) << _U(48)
        live = ~done[owner]
        element, owner = element[live], owner[live]
        if j == 0:
            swaps = [slot[live]]
        else:
            order = order[live]
            row = np.arange(len(element))
    return out


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= GROUP_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _texts(column: pa.Array) -> list[bytes]:
    return [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in column]


SIGNED = "n long, digest binary, bands array<long>, slots binary"


def _sign(words: int, names: list[str]):
    """text, doc_id, ... -> doc_id, ..., n, set digest, band hashes, low bytes of the signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups(_texts(batch.column(0))):
                sets = shingle_sets(group, words)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                bands = np.zeros((len(full), BANDS), np.int64)
                slots = np.zeros((len(full), SLOTS), np.uint8)
                # Bounded memory: a slice of the sets at a time.
                cuts = np.searchsorted(np.cumsum(n[full]), np.arange(0, n.sum() + 1, ROUND_ELEMENTS))
                for a, b in zip([*cuts, len(full)], [*cuts[1:], len(full), len(full)], strict=False):
                    if a < b:
                        values = signatures([sets[i] for i in full[a:b]]).reshape(-1, BANDS, ROWS)
                        key = np.arange(BANDS, dtype=np.uint64)[None, :] + _U(1)
                        for r in range(ROWS):
                            key = mix(key * _U(BASE) + values[:, :, r])
                        bands[a:b] = key.view(np.int64)
                        slots[a:b] = (values & _U(255)).astype(np.uint8).reshape(-1, SLOTS)
                ends = np.zeros(len(group) + 1, np.int32)
                ends[1:] = np.cumsum((n > 0) * BANDS)
                ids = batch.column(1).slice(at, len(group))
                digest = [_digest(s, i) for s, i in zip(sets, ids.to_pylist(), strict=True)]
                signed = np.full(len(group), None, object)
                signed[full] = [x.tobytes() for x in slots]
                yield pa.RecordBatch.from_arrays(
                    [*[c.slice(at, len(group)) for c in batch.columns[1:]], pa.array(n),
                     pa.array(digest, pa.binary()), pa.ListArray.from_arrays(ends, pa.array(bands.reshape(-1))),
                     pa.array(signed, pa.binary())], [*names, "n", "digest", "bands", "slots"])
                at += len(group)
    return run


def _digest(own: np.ndarray, doc_id: int | None) -> bytes | None:
    """The digest of a set; empty sets are told apart by their doc_id."""
    if len(own):
        return xxhash.xxh3_128_digest(own.tobytes())
    return None if doc_id is None else xxhash.xxh3_128_digest(f"empty {doc_id}")


def _sets(words: int):
    """text -> digest and sorted shingles of the sets that are not empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(_texts(batch.column(0))):
                sets = [s for s in shingle_sets(group, words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(s, None) for s in sets], pa.binary()),
                     pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "shingles"])
    return run


def _verify(percent: int):
    """Keep the pairs with 100 * intersection >= percent * union, on the full sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                at = np.searchsorted(p, q)
                both = int(np.count_nonzero(p[np.minimum(at, len(p) - 1)] == q))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
    return run


def _components(docs: DataFrame, words: int, percent: int, extra: str = "",
                by_id: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, classes).  rows: doc_id, the ``extra`` columns, n and digest of every row; classes:
    digest, root (equal in the classes of one component), component_id (its smallest doc_id) and
    alone (whether the component is one row).  ``by_id``: rows of one doc_id are linked too."""
    small_batches(docs.sparkSession)
    names = [c.split(" ")[0] for c in extra.split(", ")] if extra else []
    # Which rows to read again for a set: those of a doc_id, or of a text without one.
    who = F.coalesce("doc_id", F.xxhash64("text"))
    source = docs.select("text", F.col("doc_id").cast("long").alias("doc_id"), *names).withColumn("who", who)
    schema = ", ".join(["doc_id long", *extra.split(", ")]) if extra else "doc_id long"
    signed = written(source.mapInArrow(_sign(words, ["doc_id", *names, "who"]), f"{schema}, who long, {SIGNED}"),
                     "near-signed")
    classes = signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("who").alias("who"), F.min("doc_id").alias("low"), (F.count(F.lit(1)) == 1).alias("one"),
        F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("slots").alias("slots"))
    # The number is fixed by being written.
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "near-classes")
    links = _links(source, classes, words, percent)

    if by_id:
        # Rows of one doc_id with different sets.
        ids = signed.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
            F.min("digest").alias("low"), F.max("digest").alias("high")).where("low != high")
        ids = written(ids.select(F.col("doc_id").alias("id"), "low"), "near-ids")
        same = signed.join(ids, signed["doc_id"] == ids["id"]).where("digest != low").select("digest", "low").distinct()
        number = classes.select("digest", "rep")
        same = (same.join(number.withColumnRenamed("rep", "b"), "digest").drop("digest")
                .join(number.select(F.col("digest").alias("low"), F.col("rep").alias("a")), "low"))
        links = links.union(same.select("a", "b"))
    label = components(links, "near")
    label = (label.join(classes.select(F.col("rep").alias("node"), "low"), "node"))
    lowest = label.groupBy(F.col("label").alias("l")).agg(F.min("low").alias("lowest"))
    label = label.join(lowest, label["label"] == lowest["l"]).select("node", "label", "lowest")
    root = classes.join(label, classes["rep"] == label["node"], "left").select(
        "digest", F.coalesce("label", "rep").alias("root"),
        F.when(F.col("label").isNull(), F.col("low")).otherwise(F.col("lowest")).alias("component_id"),
        (F.col("label").isNull() & F.col("one")).alias("alone"))
    return signed.select("doc_id", *names, "n", "digest"), written(root, "near-roots")


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per input row."""
    rows, classes = _components(docs, words, percent)
    out = rows.join(classes, "digest", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
                      .alias("kept"))


def survivors(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stay when of each component one row does: that of the smallest
    doc_id (nulls last), of its rows the first one.  Rows with empty sets all stay; rows that
    share a doc_id only are no copies."""
    placed = with_places(docs)
    rows, classes = _components(placed, words, percent, "__file long, __row long", by_id=False)
    joined = rows.where("n > 0").join(classes.where("NOT alone"), "digest")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__file", "__row")
    first = joined.groupBy("root").agg(F.min(order).alias("first"))
    gone = joined.join(first, "root").where(
        (F.col("__file") != F.col("first.__file")) | (F.col("__row") != F.col("first.__row")))
    gone = written(gone.select(F.col("__file").alias("f"), F.col("__row").alias("r")), "near-gone")
    left = placed.join(gone, (F.col("__file") == F.col("f")) & (F.col("__row") == F.col("r")), "left_anti")
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


def agreement(percent: int, miss: float = 1e-9) -> int:
    """The least number of slots such that a pair at the threshold agrees in fewer with a chance
    of at most ``miss``."""
    p, below = percent / 100, 0.0
    for k in range(SLOTS):
        below += math.comb(SLOTS, k) * p ** k * (1 - p) ** (SLOTS - k)
        if below > miss:
            return k
    return SLOTS


def _blocks(inner):
    """Sorted rows -> ``inner`` of whole blocks; a block is a run of equal (band, lo, hi)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last block read so far: it may go on in the next batch
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            keys = [t.column(i).to_numpy() for i in range(3)]
            other = np.logical_or.reduce([k != k[-1] for k in keys])
            last = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
            held = t.slice(last)
            if last:
                yield inner(t.slice(0, last).combine_chunks())
        if held is not None and held.num_rows:
            yield inner(held.combine_chunks())
    return run


def _likely(t: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The pairs of rows that are to be verified, as (first row of the block, rows, rows), in
    chunks of bounded size, ascending in the first row number."""
    least = agreement(percent)
    band, lo, hi, block, _, n, label = (t.column(i).to_numpy() for i in range(7))
    bands = t.column(7).combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    slots = np.frombuffer(b"".join(t.column(8).to_pylist()), np.uint8).reshape(-1, SLOTS)
    new = np.flatnonzero((band[1:] != band[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])) + 1
    for a, b in zip([0, *new.tolist()], [*new.tolist(), len(band)], strict=True):
        own, step = int(np.argmax(bands[a] == band[a])), max(1, CHUNK_PAIRS // (b - a))
        for first in range(a, b - 1, step):
            x, y = np.arange(first, min(first + step, b))[:, None], np.arange(first, b)[None, :]
            keep = (x < y) & (label[x] != label[y])
            if lo[a] != hi[a]:
                keep &= block[x] != block[y]
            x, y = (i + first for i in np.nonzero(keep))
            keep = np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent
            x, y = x[keep], y[keep]
            keep = np.argmax(bands[x] == bands[y], axis=1) == own
            x, y = x[keep], y[keep]
            keep = (slots[x] == slots[y]).sum(axis=1) >= least
            if keep.any():
                yield a, x[keep], y[keep]


def _partnered(percent: int):
    """The rows of blocks that have a likely partner."""
    def inner(t: pa.Table) -> pa.RecordBatch:
        rows = np.zeros(t.num_rows, bool)
        for _, x, y in _likely(t, percent):
            rows[x] = rows[y] = True
        out = t.filter(pa.array(rows)).combine_chunks()
        return pa.RecordBatch.from_arrays([c.combine_chunks() for c in out.columns], t.column_names)
    return _blocks(inner)


def _join_components(percent: int):
    """Blocks of rows with their sets (last column) -> verified links that join components."""
    def inner(t: pa.Table) -> pa.RecordBatch:
        rep, label = t.column(4).to_numpy(), t.column(6).to_numpy()
        sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t.column(9)]
        found, block, root = [np.zeros((2, 0), np.int64)], -1, {}

        def find(v: int) -> int:
            while root.setdefault(v, v) != v:
                root[v] = v = root[root[v]]
            return v

        for start, x, y in _likely(t, percent):
            if start != block:
                block = start
                root.clear()
            cut = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1])))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(x)], strict=True):
                own, i = sets[x[a]], int(x[a])
                others = [j for j in y[a:b].tolist() if find(int(label[j])) != find(int(label[i]))]
                if not others:
                    continue
                sizes = np.array([len(sets[j]) for j in others])
                every = np.concatenate([sets[j] for j in others])
                at = np.minimum(np.searchsorted(own, every), len(own) - 1)
                both = np.add.reduceat((own[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
                good = 100 * both >= percent * (len(own) + sizes - both)
                for j in np.array(others)[good].tolist():
                    p, q = find(int(label[i])), find(int(label[j]))
                    if p != q:
                        root[p] = q
                        found.append(np.sort(np.array([[rep[i]], [rep[j]]]), axis=0))
        both = np.concatenate(found, axis=1)
        return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], ["a", "b"])
    return _blocks(inner)


def _links(source: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified links (a, b) between classes, by number, that span every component."""
    member = classes.select("n", "rep", F.explode("bands").alias("band"))
    shared = member.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("mass")).where("size > 1")
    member = written(member.join(shared, "band"), "near-members")
    wanted = written(classes.join(member.select("rep").distinct(), "rep").select(
        "rep", "digest", F.col("who").alias("whose")), "near-wanted")
    found = (source.join(wanted, source["who"] == wanted["whose"], "left_semi").select("text")
             .mapInArrow(_sets(words), "digest binary, shingles binary"))
    # Of rows that give one set, one is kept before sets are moved any further.
    sets = written(found.dropDuplicates(["digest"]).join(wanted.select("rep", "digest"), "digest")
                   .select("rep", "shingles"), "near-sets")

    def verified(pairs: DataFrame) -> DataFrame:
        held = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
        to = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
        return written(pairs.join(held, "a").join(to, "b").select("a", "b", "x", "y")
                       .mapInArrow(_verify(percent), "a long, b long"), "near-links")

    hub = member.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("hub"))
    star = member.join(hub, "band").where(F.col("rep") != F.col("hub.rep")).where(
        F.expr(f"least(n, hub.n) * 100 >= greatest(n, hub.n) * {percent}"))
    first = verified(star.select(F.col("hub.rep").alias("a"), F.col("rep").alias("b")).distinct())

    label = components(first, "near-hubs")
    tagged = member.join(label, member["rep"] == label["node"], "left").select(
        "band", "rep", "n", "size", "mass", F.coalesce("label", "rep").alias("label"))
    mixed = tagged.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    left = tagged.join(mixed.where("lo != hi").select("band"), "band")
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK_MEMBERS, F.col("mass") * 8 / BLOCK_BYTES)).cast("int")
    left = left.withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    left = left.select("band", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
                       "block", "rep", "n", "label")
    full = classes.select(F.col("rep").alias("r"), "bands", "slots")
    ready = _in_blocks(left.join(full, left["rep"] == full["r"]).drop("r"))
    likely = written(ready.mapInArrow(_partnered(percent), BLOCK_ROWS), "near-likely")
    held = sets.withColumnRenamed("rep", "r")
    verified_rest = _in_blocks(likely.join(held, likely["rep"] == held["r"]).drop("r"))
    second = written(verified_rest.mapInArrow(_join_components(percent), "a long, b long"), "near-links")
    discard(member, wanted, sets, likely)
    return first.union(second)


def _in_blocks(rows: DataFrame) -> DataFrame:
    return rows.repartition("band", "lo", "hi").sortWithinPartitions("band", "lo", "hi")


def contract(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, words=4, percent=80)
