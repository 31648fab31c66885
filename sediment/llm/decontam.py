"""Benchmark decontamination: size-partitioned MinHash containment search.

An item is found in a document when at least ``threshold`` of its distinct word shingles stand in
the document, anywhere and in any order.  Jaccard similarity is useless for a short item inside a
long document, so the search is asymmetric:

1. Items are partitioned by size (powers of two of their number of shingles).  Each keeps a
   bottom-k MinHash sketch: its k shingles of smallest hash, k set by the largest size u of its
   partition to floor((1 - threshold) * u) + 1 (all, if it has fewer).  A document that contains
   the item misses at most (1 - threshold) of its shingles, so it holds at least one of any k:
   the sketch search has no false negatives, and the sketch is a fifth of the item.
2. Every shingle of every whole document probes the sketches (an equi-join on the hash; the
   planner broadcasts the sketch table if its files are small, else shuffles).  Pairs that meet
   are candidates, provided the document has enough words for the partition's smallest item.
3. Candidates are verified on the shingles themselves, as text: distinct shared shingles against
   the item's.  The items' shingles are broadcast if they are measured at ``BROADCAST_BYTES`` or
   less.  Beyond that both sides are shuffled, and as a shingle may stand in a third of all
   documents, documents are dealt by their key over ``DEALS`` copies of the items' shingles.

All DataFrame functions; no Python runs on the executors.

Words: maximal runs of letters and digits, lower-cased.  Items of fewer than ``words`` words are
one shingle of all their words, looked for among the documents' shingles of that length; items
without words are found nowhere.

Defined cases: null and empty texts contain nothing; null ids are dropped from the result, which
consists of pairs of ids (``clean`` judges texts, with any id); rows that repeat an id count as one
document or item holding all their shingles; an empty benchmark or corpus gives no pairs; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import written

WORDS = 5
THRESHOLD_PERCENT = 80
DEALS = 16
BROADCAST_BYTES = 8 << 20


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _positions(n: int) -> Column:
    """0 .. number of shingles of n words in ``w``, less one; none for shorter texts."""
    last = F.size("w") - F.lit(n)
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _hashed(n: int) -> Column:
    """Shingle hashes from word hashes ``h``."""
    return F.transform(_positions(n), lambda i: F.xxhash64(
        *[F.element_at("h", i + (k + 1)) for k in range(n)]))


def _spelled(n: int) -> Column:
    return F.transform(_positions(n), lambda i: F.array_join(F.slice("w", i + 1, n), " "))


def _words(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.select(key.alias(name), word_array(F.col("text")).alias("w")).where(
        F.col(name).isNotNull() & (F.size("w") > 0))


def _by_length(df: DataFrame, lengths: list[int], build, name: str) -> DataFrame:
    out = None
    for n in lengths:
        part = df.select("*", F.lit(n).alias("k"), F.explode(build(n)).alias(name))
        out = part if out is None else out.union(part)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, words: int = WORDS,
                 percent: int = THRESHOLD_PERCENT, key: Column | None = None) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of the documents that contain an item.  ``key``: what
    tells documents apart, in place of doc_id."""
    key = F.col("doc_id").cast("long") if key is None else key
    items = _words(benchmark, F.col("item_id").cast("long"), "item_id").withColumn("k", F.least(F.size("w"), F.lit(words)))
    lengths = sorted(r["k"] for r in items.select("k").distinct().collect())  # at most ``words``
    if not lengths:
        none = docs.select(key.alias("doc_id")).where("false")
        return none.select("doc_id", *[F.lit(0).cast("long").alias(c) for c in ("item_id", "n_item", "n_shared")])
    shingle = None
    for n in lengths:
        own = items.where(F.col("k") == n).select("item_id", "k", F.explode(_spelled(n)).alias("shingle"))
        shingle = own if shingle is None else shingle.union(own)
    shingle = shingle.distinct()
    sizes = shingle.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    shingle = written(shingle.join(sizes, "item_id"), "bench-shingles")

    # Bottom-k sketches by size partition [low, 2 * low).
    low = F.expr("shiftleft(1L, cast(floor(log2(n_item)) AS int))")
    hashes = F.transform(F.split("shingle", " "), lambda x: F.xxhash64(x))
    hashed = (shingle.select("item_id", "k", "n_item", low.alias("low"), hashes.alias("h"))
              .withColumn("s", _one_hash(lengths)))
    k = F.floor((F.lit(100 - percent) * (F.col("low") * 2 - 1)) / 100).cast("int") + 1
    sketch = (hashed.groupBy("item_id", "k", "n_item", "low")
              .agg(F.array_sort(F.collect_set("s")).alias("all"))
              .select("item_id", "k", "low", F.explode(F.slice("all", F.lit(1), k)).alias("s")))
    sketch = written(sketch, "bench-sketch")

    source = _words(docs, key, "doc_id")
    longest = F.size("w") - F.lit(min(lengths)) + 1
    probes = _by_length(source.select("doc_id", longest.alias("most"),
                                      F.transform("w", lambda x: F.xxhash64(x)).alias("h"), "w"),
                        lengths, _hashed, "s").select("doc_id", "most", "k", "s")
    met = probes.join(sketch, ["k", "s"]).where(F.expr(f"most * 100 >= low * {percent}"))
    candidates = written(met.select("doc_id", "item_id").distinct(), "bench-candidates")

    wanted = candidates.select("doc_id").distinct()
    texts = source.join(wanted, "doc_id", "left_semi")
    held = _by_length(texts, lengths, _spelled, "shingle").select("doc_id", "k", "shingle")
    own, on = shingle.select("item_id", "k", "n_item", "shingle"), ["k", "shingle"]
    size = own.agg(F.sum(F.octet_length("shingle") + 64)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        own = F.broadcast(own)
    else:
        held = held.withColumn("deal", F.pmod(F.xxhash64("doc_id"), F.lit(DEALS)).cast("int"))
        own = own.withColumn("deal", F.explode(F.sequence(F.lit(0), F.lit(DEALS - 1)))).hint("merge")
        on = [*on, "deal"]
    shared = (held.join(own, on)
              .select("doc_id", "item_id", "n_item", "k", "shingle").distinct()
              .groupBy("doc_id", "item_id", "n_item").agg(F.count(F.lit(1)).alias("n_shared")))
    return (shared.where(F.expr(f"n_shared * 100 >= n_item * {percent}"))
            .join(candidates, ["doc_id", "item_id"], "left_semi")
            .select("doc_id", "item_id", "n_item", "n_shared"))


def _one_hash(lengths: list[int]) -> Column:
    """The hash of one shingle of k words from their hashes ``h``, as the documents' are made."""
    out = F.lit(None).cast("long")
    for n in lengths:
        out = F.when(F.col("k") == n, F.xxhash64(*[F.element_at("h", i + 1) for i in range(n)])).otherwise(out)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that contain no item, unchanged.

    Each text is judged by itself, whatever its doc_id (null or repeated): it is known by two
    64-bit hashes, so equal texts are looked at once.
    """
    text = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), "text").alias("b"))
    found = contaminated(docs, benchmark, key=text).select("doc_id.a", "doc_id.b").distinct()
    found = written(found.select(F.col("a").alias("__a"), F.col("b").alias("__b")), "bench-hits")
    same = (F.xxhash64(docs["text"]) == F.col("__a")) & (F.xxhash64(F.lit(1), docs["text"]) == F.col("__b"))
    return docs.join(found, same, "left_anti")


def contract(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(docs, benchmark).withColumn(
        "containment", F.col("n_shared") / F.col("n_item"))
