"""Line dedup through a sharded minimal perfect hash.

A line's key is the line without surrounding ASCII white space, A-Z lower-cased.  Keys of at
least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines
except in the largest doc_id that holds them.

1. Documents are cut into lines; each document gives the distinct 128-bit digests of its long
   keys (64 bits to hash, 64 bits of fingerprint), written as a table, once per doc_id.
2. Digests are folded (map side first) to document count and largest holder,
   and dealt into shards by digest.  Each shard builds a minimal perfect hash over its distinct digests and
   three arrays in slot order: 32-bit fingerprints, saturated counts and, for the slots at or
   over ``min_docs`` only, the holders.
3. The documents' digests go to their shard and probe the arrays: no join on lines.  A shard
   gets as many probe groups as its rows need, each with a copy of the arrays, so a line that
   stands in a third of all documents is probed in many tasks.
4. The few digests to drop return to their document, whose text is rebuilt without them.

Every probed digest is in its shard's hash, so the slot is right by construction.  Digests of a
shard that agree in their first 64 bits are hashed by a mixture of both halves that tells them
apart; the fingerprint guards against digests of other tables.

Defined cases: a null or empty text is one empty line; a null doc_id is a document that can
never be the holder while another id is; rows that share a doc_id count as one document, null
ones too, and those of the largest doc_id all keep the line; other columns are passed on (``n_chars`` follows the text,
columns named n_lines or n_dropped are replaced); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import discard, small_batches, written
from sediment.llm.mph import MinimalPerfectHash, mix

BLANK = b" \t\n\x0b\x0c\r"
SHARD_LINES = 400_000
PROBE_ROWS = 400_000
NO_HOLDER = np.iinfo(np.int64).min


def digest(line: bytes, min_chars: int) -> bytes | None:
    """The 128-bit digest of a line's key, or None for a key that is too short."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


def _line_digests(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, owner, found = batch.column(0), [], []
            for row, text in enumerate(batch.column(1)):
                own = {digest(x, min_chars) for x in text.as_buffer().to_pybytes().split(b"\n")}
                own.discard(None)
                owner.extend([row] * len(own))
                found.extend(own)
            halves = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), ids.take(pa.array(owner, pa.int64()))],
                ["h", "f", "doc_id"])
    return run


def _keys(h: np.ndarray, f: np.ndarray, seed: int) -> np.ndarray:
    """What the perfect hash is built over: the first half, with a seed mixed with the second."""
    return h.astype(np.uint64) if not seed else mix(h.astype(np.uint64) + mix(f.astype(np.uint64) + np.uint64(seed)))


def _arrays(min_docs: int):
    """One shard's digests to its perfect hash and arrays."""
    top = np.iinfo(np.uint8).max if min_docs <= 255 else np.iinfo(np.uint32).max
    kind = np.uint8 if min_docs <= 255 else np.uint32

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        h, f, n, seed = t.column("h").to_numpy(), t.column("f").to_numpy(), t.num_rows, 0
        while len(np.unique(_keys(h, f, seed))) < n:  # digests are distinct, so some seed does
            seed += 1
        hashed = MinimalPerfectHash.build(_keys(h, f, seed))
        slot = hashed.slots(_keys(h, f, seed))
        prints, counts = np.zeros(n, np.uint32), np.zeros(n, kind)
        prints[slot] = f.astype(np.uint32)
        full = t.column("n").to_numpy()
        counts[slot] = np.minimum(full, top)
        holder = t.column("holder").fill_null(NO_HOLDER).to_numpy()
        frequent = full >= min_docs
        by_slot = np.argsort(slot[frequent], kind="stable")
        held = holder[frequent].astype(np.int64)[by_slot]
        return pa.table({
            "shard": pa.array([key[0].as_py()], pa.int32()), "seed": pa.array([seed], pa.int64()), "sizes": [hashed.sizes.tobytes()], "bits": [hashed.words.tobytes()],
            "prints": [prints.tobytes()], "counts": [counts.tobytes()], "holders": [held.tobytes()],
            "probes": pa.array([int(full.sum())], pa.int64())})
    return run


ARRAYS = ("shard int, seed long, sizes binary, bits binary, prints binary, counts binary, holders binary, "
          "probes long")


def _probe(min_docs: int):
    kind = np.uint8 if min_docs <= 255 else np.uint32

    def run(lines: pa.Table, arrays: pa.Table) -> pa.Table:
        none = pa.table({"doc_id": pa.array([], pa.int64()), "h": pa.array([], pa.int64()),
                         "f": pa.array([], pa.int64())})
        if not lines.num_rows:
            return none
        get = lambda c, k: np.frombuffer(arrays.column(c)[0].as_py(), k)
        hashed = MinimalPerfectHash(get("sizes", np.int64), get("bits", np.uint64))
        counts, prints = get("counts", kind), get("prints", np.uint32)
        frequent = counts >= min_docs
        holders = np.zeros(len(counts), np.int64)
        holders[frequent] = get("holders", np.int64)
        h, f = lines.column("h").to_numpy(), lines.column("f").to_numpy()
        slot = hashed.slots(_keys(h, f, arrays.column("seed")[0].as_py()))
        known = prints[slot] == f.astype(np.uint32)
        ids = lines.column("doc_id")
        own = np.array(ids.fill_null(NO_HOLDER + 1).combine_chunks())
        drop = known & frequent[slot] & (own != holders[slot])
        return lines.select(["doc_id", "h", "f"]).filter(pa.array(drop))
    return run


def _rebuild(min_chars: int, at: int, lines_at: int, drops_at: int):
    """Texts without their dropped lines; columns: ..., text at ``at``, drops last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drops in zip(batch.column(at), batch.column(drops_at), strict=True):
                lines = (text.as_buffer().to_pybytes() if text.is_valid else b"").split(b"\n")
                n_lines.append(len(lines))
                if drops.is_valid:
                    gone = set(drops.as_py())
                    lines = [x for x in lines if digest(x, min_chars) not in gone]
                    texts.append(b"\n".join(lines).decode())
                else:
                    texts.append(text.as_py())
                n_dropped.append(n_lines[-1] - len(lines))
            columns = batch.columns[:drops_at]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                [*batch.schema.names[:drops_at], "n_lines", "n_dropped"])
    return run


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int) -> DataFrame:
    """(doc_id, h, f): the line digests that each document loses."""
    spark = docs.sparkSession
    small_batches(spark)
    lines = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                F.coalesce(F.col("text"), F.lit("")).alias("text"))
                    .mapInArrow(_line_digests(min_chars), "h long, f long, doc_id long")
                    .dropDuplicates(["h", "f", "doc_id"]), "lines")
    shards = max(1, -(-lines.count() // SHARD_LINES))
    shard = F.pmod("h", F.lit(shards)).cast("int")
    folded = lines.groupBy("h", "f").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("holder"))
    arrays = written(folded.withColumn("shard", shard).groupBy("shard")
                     .applyInArrow(_arrays(min_docs), ARRAYS), "line-arrays")
    # How many groups probe a shard; as many rows as there are shards.
    groups = arrays.select("shard", (F.floor(F.col("probes") / PROBE_ROWS) + 1).alias("groups"))
    # Broadcast: two numbers for every SHARD_LINES lines.
    probes = (lines.withColumn("shard", shard).join(F.broadcast(groups), "shard")
              .withColumn("part", F.pmod(F.xxhash64("doc_id", "f"), "groups")).drop("groups"))
    copies = arrays.withColumn("part", F.explode(F.sequence(
        F.lit(0), F.floor(F.col("probes") / PROBE_ROWS)))).withColumn("part", F.col("part").cast("long"))
    found = (probes.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part"))
             .applyInArrow(_probe(min_docs), "doc_id long, h long, f long"))
    drops = written(found, "line-drops")
    discard(lines, arrays)
    return drops


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """The documents with their texts rebuilt, plus n_lines (before) and n_dropped."""
    spark = docs.sparkSession
    drops = dropped_lines(docs, min_chars, min_docs)
    drops = drops.groupBy(F.col("doc_id").alias("__id")).agg(F.collect_set(
        F.unhex(F.concat(*[_le_hex(c) for c in ("h", "f")]))).alias("__drops"))
    rows = docs.drop("n_lines", "n_dropped")
    joined = rows.join(drops, rows["doc_id"].cast("long").eqNullSafe(F.col("__id")), "left").drop("__id")
    plain = [f for f in joined.schema.fields if f.name != "__drops"]
    at = [f.name for f in plain].index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain)
    small_batches(spark)
    out = joined.mapInArrow(_rebuild(min_chars, at, 0, len(plain)),
                            schema + ", n_lines long, n_dropped long")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.char_length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out


def _le_hex(c: str):
    """The hex digits of a long's bytes, least significant first, as the digest had them."""
    digits = F.lpad(F.hex(F.col(c)), 16, "0")
    return F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])


def contract(docs: DataFrame) -> DataFrame:
    out = dedup_lines(docs.select("doc_id", "text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(text.cast("binary"), 256).alias("kept_sha256"))
