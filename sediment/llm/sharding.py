"""Proportional stratified interleaving into shards.

Rows of each source are shuffled by a seeded digest and ranked; a row's fractional rank
(rank - 1/2) / rows of its source places it in one global order in which every stretch matches
the sources' mixture.  The order is cut into shards whose row counts differ by one at most, so
each shard holds its proportional share of every source, give or take one row.

All native: the shuffle order is an md5 digest, whose leading digits deal a source's rows into
equal buckets; ranks are bucket-local row numbers plus the counts of lower buckets.  A source
that holds a third of all rows is ranked in as many tasks as it has buckets.  Fractional ranks
that very many rows share (1/2, if most sources have one row) are measured, at most a thousand
of them, and their rows are dealt into buckets of their own by the digest.

Defined cases: a null source is a stratum of its own; null texts count 0 bytes; null ids are
shuffled as the empty id; rows that repeat in id, size and text are interchangeable; an empty
table gives no rows; columns not asked for in ``keep`` play no part, whatever their names, and
kept columns named like an output column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import bucket_count, stratified_rank, written

ROW_BYTES = 16
DIGITS = 7
SHARED_ROWS = 10_000
OUTPUT = ("size", "text_crc32", "stratum", "shard", "slot")


def interleave(docs: DataFrame, shards: int, seed: str = "mix", source: str = "source",
               keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns plus size, text_crc32, stratum, shard (from 0) and slot (from 0)."""
    if shards < 1 or "doc_id" not in keep:
        raise ValueError("shards must be positive, and keep must hold doc_id")
    keep = tuple(c for c in keep if c not in OUTPUT)
    total = docs.count()
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        *[F.col(c) for c in keep],
        F.col(source).alias("stratum"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
              .cast("binary")).alias("__o"))
    n = bucket_count(total)
    digest = F.conv(F.substring("__o", 1, DIGITS), 16, 10).cast("long")
    tie = [F.col("__o"), F.col("doc_id"), F.col("size"), F.col("text_crc32")]
    ranked = stratified_rank(rows, ["stratum"], F.floor(digest * n / F.lit(16 ** DIGITS)), tie, "__rank")
    sizes = rows.groupBy(F.col("stratum").alias("__s")).agg(F.count(F.lit(1)).alias("__of"))
    ranked = ranked.join(sizes, F.col("stratum").eqNullSafe(F.col("__s"))).withColumn(
        "__f", (F.col("__rank") * 2 - 1) / (F.col("__of") * 2))
    ranked = written(ranked, "shard-ranks")
    least = max(SHARED_ROWS, total // 1000)
    shared = ranked.groupBy("__f").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    shared = sorted(r["__f"] for r in shared.select("__f").collect())  # fewer than a thousand
    place = F.floor(F.col("__f") * n)
    if shared:
        hot, own = F.array(*map(F.lit, shared)), F.col("__f").isin(shared)
        below = F.size(F.filter(hot, lambda x: x < F.col("__f"))) * 2 + own.cast("int")
        place = F.struct(place.alias("a"), below.alias("b"),
                         F.when(own, F.floor(digest * n / F.lit(16 ** DIGITS))).otherwise(0).alias("c"))
    placed = stratified_rank(ranked, [], place, [F.col("__f"), *tie], "__pos")
    at = F.col("__pos") - 1
    # Integer arithmetic: position p lies in the shard s with s * total <= p * shards.
    shard = F.expr(f"cast((__pos - 1) * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"cast(((shard * {total}L) + {shards - 1}) div {shards} as long)")
    return (placed.withColumn("shard", shard).withColumn("slot", at - first)
            .select(*keep, "size", "text_crc32", "stratum", "shard", "slot"))


def write_shards(docs: DataFrame, path: str, shards: int, seed: str = "mix") -> None:
    """Write the documents as one folder per shard, rows in slot order within each task."""
    (interleave(docs, shards, seed, keep=tuple(docs.columns))
     .repartition(shards, "shard").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))


def contract(docs: DataFrame) -> DataFrame:
    """Forty shards under the law ``rows``: counts at most one apart."""
    out = interleave(docs, 40, keep=("doc_id",))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"), "stratum")
