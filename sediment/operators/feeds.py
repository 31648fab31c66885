"""Feed selection: the search, sort, cap and child-feed choices of the ingestion step,
expressed over landed data instead of API request parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The search's star floor and page sizes (per run: repositories, top repos with
# child feeds, commits / issues per repository).
MIN_STARS = 1000
# The configured searches: (name, language, star floor).
CONFIGURED_SEARCHES = [("python_repos", "python", 1000), ("javascript_repos", "javascript", 1000),
                       ("java_repos", "java", 1000)]
REPOSITORIES_PER_RUN = 50
TOP_REPOSITORIES = 10
CHILDREN_PER_REPOSITORY = 50


def search_filter(df: DataFrame, *, min_stars: int | None, language: str | None = None,
                  language_col: str = "language", stars_col: str = "stars",
                  state: str | None = None, state_col: str = "state") -> DataFrame:
    """Conjunctive search: ``lower(language) = x AND stars > min_stars [AND state = s]``.

    ``min_stars=None`` asks for no floor.  The star floor and the state are pushed into the
    Parquet scan; ``lower(language)`` is evaluated above it.
    """
    cond = F.lit(True)
    if language is not None:
        cond = cond & (F.lower(F.col(language_col)) == language.lower())
    if min_stars is not None:
        cond = cond & (F.col(stars_col) > min_stars)
    if state is not None:
        cond = cond & (F.col(state_col) == state)
    return df.where(cond)


def search_many(df: DataFrame, searches=CONFIGURED_SEARCHES, language_col: str = "language",
                stars_col: str = "stars") -> DataFrame:
    """All configured searches in one pass: one output row per (record, matching search).

    The lowest star floor and the set of languages are filtered first (the floor reaches the
    scan); what is left is tested against every search inside one projection, so the table is
    scanned once instead of once per search.
    """
    lang, stars = F.lower(F.col(language_col)), F.col(stars_col)
    near = df.where((stars > min(floor for _, _, floor in searches))
                    & lang.isin(*{x.lower() for _, x, _ in searches}))
    hits = F.array_compact(F.array(*[
        F.when((lang == x.lower()) & (stars > floor), F.lit(name)) for name, x, floor in searches]))
    return near.withColumn("search", F.explode(hits))


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, k: int, order: Sequence[str | Column]) -> DataFrame:
    """Sort + limit; planned as TakeOrderedAndProject (per-partition top-k, then a k-way merge).

    ``order`` must end in a unique column so the cut is deterministic.
    """
    return df.orderBy(*_order(order)).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                    k: int) -> DataFrame:
    """At most ``k`` rows per group by ``order`` (with a unique tie-break column last).

    ``row_number() <= k`` is planned with a WindowGroupLimit below the exchange, so every map
    task keeps at most ``k`` rows per group before shuffling; a hot group cannot flood a task.
    """
    w = Window.partitionBy(*group).orderBy(*_order(order))
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


#: Bits of the filter of unbounded parent keys (2 MB): of the children of other parents, one in
#: seventeen passes it at a million parents.
FILTER_BITS = 1 << 24
_MOST_BITS = 1 << 27  # 16 MB, the most that is broadcast


def _bit_place(keys: Sequence[Column], bits: int, block: str, bit: str) -> list[Column]:
    at = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    return [F.bitmap_bucket_number(at).alias(block), F.bitmap_bit_position(at).alias(bit)]


def key_bitmaps(keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """``(_block, _bitmap)``: one bit for the hash of every row, in bitmaps of 4 KB; at most
    ``bits / 8`` bytes however many rows there are."""
    places = keys.select(*_bit_place([F.col(c) for c in keys.columns], bits, "_block", "_bit")).distinct()
    return places.repartition("_block").groupBy("_block").agg(F.bitmap_construct_agg("_bit").alias("_bitmap"))


def maybe_in(df: DataFrame, columns: Sequence[Column], keys: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose ``columns`` may stand in ``keys``: none that does is lost, and rows
    of other keys pass if they share a bit with one.  ``df`` is not shuffled."""
    if not 0 < bits <= _MOST_BITS:
        raise ValueError(f"bits must be from 1 to {_MOST_BITS}")
    typed = [c.cast(f.dataType) for c, f in zip(columns, keys.schema.fields, strict=True)]
    placed = df.select("*", *_bit_place(typed, bits, "_own_block", "_own_bit"))
    maps = F.broadcast(key_bitmaps(keys, bits))
    byte = F.conv(F.hex(F.expr("substring(_bitmap, cast(_own_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    is_set = byte.bitwiseAND(F.expr("shiftleft(1, cast(_own_bit % 8 as int))")) != 0
    return placed.join(maps, (F.col("_own_block") == F.col("_block")) & is_set, "left_semi").drop("_own_block", "_own_bit")


def children_of(children: DataFrame, parents: DataFrame, child_keys: Sequence[str],
                parent_keys: Sequence[str], top: int | None = None,
                order: Sequence[str | Column] = (), bits: int | None = FILTER_BITS) -> DataFrame:
    """Child records whose parent is in ``parents`` (left semi join).

    With ``top`` only the first ``top`` parents by ``order`` count; they are selected here, so
    their keys are bounded and broadcast.  Otherwise parents grow with the data: children pass a
    broadcast bit filter of the parent keys (``bits``; None for none) before they are shuffled.
    """
    if top is not None:
        parents = top_k(parents, top, order)
    keys = parents.select(*[F.col(p).alias(f"_pk{i}") for i, p in enumerate(parent_keys)]).distinct()
    if top is not None:
        keys = F.broadcast(keys)
    elif bits is not None:
        children = maybe_in(children, [F.col(c) for c in child_keys], keys, bits)
    cond = None
    for i, ck in enumerate(child_keys):
        c = children[ck] == keys[f"_pk{i}"]
        cond = c if cond is None else cond & c
    return children.join(keys, cond, "left_semi")
