"""Merging and de-duplication operators.

``merge_coalesce`` is the full-outer "left wins" merge of two versions of one entity
(repository search hits and repository details).  ``latest_per_key`` keeps the newest landing
of every record when landing files pile up run after run.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH_FLOOR = "1900-01-01 00:00:00"
#: So many replaced rows, by their places, are broadcast at most.
SMALL_LOSERS = 1_000_000
#: Of a log of so many rows the replaced ones are broadcast as marks at most: one bit a row, 32 MB.
MARKED_ROWS, BLOCK_ROWS = 1 << 28, 1 << 15
PLACE = ("_file", "_row")


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def merge_coalesce(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   columns: Sequence[str] | Mapping[str, str],
                   greatest: Iterable[str] = (), drop_null_keys: bool = False) -> DataFrame:
    """Full outer equi-join on ``keys``; each output column is ``COALESCE(left.c, right.c)``.

    ``columns`` lists the source columns, or maps source column -> output name.  Columns in
    ``greatest`` take the later of both sides instead (a missing side counts as 1900-01-01).
    NULL keys never match, so a NULL-keyed row passes through alone; with ``drop_null_keys``
    such rows are removed *before* the join, where the filter reaches the Parquet scan, which
    is equivalent to filtering the coalesced key afterwards.
    """
    if not isinstance(columns, Mapping):
        columns = {c: c for c in columns}
    greatest = set(greatest)
    if drop_null_keys:
        left, right = left.where(_not_null(keys)), right.where(_not_null(keys))
    needed = list(dict.fromkeys([*keys, *columns]))
    # NULL keys never match, but they all hash to one shuffle partition, and adaptive
    # execution cannot split a full outer join.  The extra join key ``_spread`` is 0 for keyed
    # rows (so they join on the key alone) and a hash of the first output column otherwise,
    # which spreads NULL-keyed rows without changing any match.  It reads one column that is
    # read anyway, is deterministic (a retried task repeats it) and lets filters pass.
    first = next((c for c in columns if c not in keys), keys[0])
    spread = F.when(_not_null(keys), F.lit(0).cast("bigint")).otherwise(F.xxhash64(F.col(first)))
    l = left.select(*needed, spread.alias("_spread")).alias("l")
    r = right.select(*needed, spread.alias("_spread")).alias("r")
    cond = F.col("l._spread") == F.col("r._spread")
    for k in keys:
        cond = cond & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    joined = l.join(r, cond, "full_outer")
    out = []
    for src, name in columns.items():
        if src in greatest:
            floor = F.lit(EPOCH_FLOOR).cast("timestamp")
            expr = F.greatest(F.coalesce(F.col(f"l.{src}"), floor),
                              F.coalesce(F.col(f"r.{src}"), floor))
        else:
            expr = F.coalesce(F.col(f"l.{src}"), F.col(f"r.{src}"))
        out.append(expr.alias(name))
    return joined.select(*out)


def placed(log: DataFrame) -> DataFrame:
    """Rows of stored files with their place (file, row number)."""
    return log.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))


def without_places(rows: DataFrame, places: DataFrame, n: int, landed: int, small: int = SMALL_LOSERS) -> DataFrame:
    """Placed ``rows`` but those at ``places``, of which there are ``n`` among ``landed`` rows.

    Up to ``small`` places are broadcast.  Beyond that they are marked in bitmaps, one bit for a row
    of a file, 4 KB for a block of 32,768 rows, which are broadcast for up to ``MARKED_ROWS`` rows;
    only a larger log, or ``small`` 0, shuffles the wide rows.
    """
    if n <= small:
        return rows.join(F.broadcast(places), list(PLACE), "left_anti")
    if not small or landed > MARKED_ROWS:
        return rows.join(places, list(PLACE), "left_anti")
    block, bit = (F.col("_row") / BLOCK_ROWS).cast("bigint"), F.col("_row") % BLOCK_ROWS
    marks = places.withColumn("_bit", bit).groupBy(F.col("_file").alias("_mf"), block.alias("_mb")).agg(
        F.expr("bitmap_construct_agg(_bit)").alias("_marks"))
    byte = F.conv(F.hex(F.substring(F.col("_marks"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("getbit(_byte, cast(_row % 8 as int))")
    joined = rows.join(F.broadcast(marks), (F.col("_file") == F.col("_mf")) & (block == F.col("_mb")), "left")
    return joined.withColumn("_byte", byte).where(F.col("_marks").isNull() | (marked == 0)).select(*rows.columns)


def newest_rows(log: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                small: int = SMALL_LOSERS) -> DataFrame:
    """``latest_per_key`` for a log stored as files: the wide rows are not grouped.

    Winners are found on the key, the order columns and the row's place (file, row number),
    which also breaks ties; only those columns are read and shuffled.  If every key stands once
    the log is returned as it is; else the rows that lost are taken out by their places
    (``without_places``).  Rows without a key all stay.  Runs two jobs on the narrow columns.
    """
    rows = placed(log)
    narrow = rows.where(_not_null(keys)).select(*keys, *order_by, *PLACE)
    best = narrow.groupBy(*keys).agg(F.max(F.struct(*order_by, *PLACE)).alias("_b"), F.count(F.lit(1)).alias("_n"))
    landed, lost = best.agg(F.sum("_n"), F.sum(F.col("_n") - 1)).first()
    if not lost:
        return log
    winners = best.where("_n > 1").select(*[F.col(f"_b.{c}").alias(c) for c in PLACE])
    again = best.where("_n > 1").select(*keys)
    losers = narrow.join(again, list(keys), "left_semi").select(*PLACE).join(winners, list(PLACE), "left_anti")
    return without_places(rows, losers, lost, landed, small).select(*log.columns)


def newest_of_placed(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str],
                     small: int = SMALL_LOSERS) -> DataFrame:
    """``latest_per_key`` of placed rows, row for row: those that a newer one replaces are found on
    narrow columns and taken out by their places; only keys whose newest rows are equal in
    ``order_by`` are told apart on whole rows."""
    columns = [c for c in rows.columns if c not in PLACE]
    narrow = rows.where(_not_null(keys)).select(*keys, F.struct(*order_by).alias("_o"), *PLACE)
    best = narrow.groupBy(*keys).agg(F.max("_o").alias("_b"), F.count(F.lit(1)).alias("_n"))
    landed = best.where("_n > 1").select(*keys, "_b")
    again = narrow.join(landed, list(keys))
    equal = again.where("_o <=> _b").groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")
    losers = again.where("NOT (_o <=> _b)").select(*PLACE)
    total = rows.select(F.count(F.lit(1))).first()[0]
    lost, ties = losers.count(), equal.count()
    kept = without_places(rows, losers, lost, total, small) if lost else rows
    kept = kept.select(*columns)
    if not ties:
        return kept
    if ties > small:
        return latest_per_key(kept, keys, order_by)
    equal = F.broadcast(equal)
    return kept.join(equal, list(keys), "left_anti").select(*columns).unionAll(
        latest_per_key(kept.join(equal, list(keys), "left_semi").select(*columns), keys, order_by))


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one with the largest ``order_by`` tuple.

    For frames that are not stored; ``newest_rows`` serves stored logs, without grouping wide
    rows.  Implemented as ``max(struct(order..., rest...))`` per key: a sort aggregate with a
    map-side step, so a key landed millions of times leaves each task once.  Remaining ties are
    broken by the rest of the row, which makes the choice deterministic.  Rows whose key is NULL
    are not records of one entity and pass through unchanged.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by], *[F.col(c) for c in rest])
    latest = (df.where(_not_null(keys)).groupBy(*keys).agg(F.max(packed).alias("_latest"))
              .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in (*order_by, *rest)]))
    return latest.select(*df.columns).unionAll(df.where(~_not_null(keys)))
