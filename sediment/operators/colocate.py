"""Facts and a dimension stored side by side, so that joining them shuffles neither.

Both sides get the same join columns when they are written, and the tables are bucketed by them:
``_j0 .. _jn`` (the key, with NULL for an empty string) and ``_deal``.  One key may hold a third of
all facts, and a bucket is one task's work, so the facts of a hot key (``hot_keys``: measured, at
most 1,000 of them) are dealt by their own key over as many deals as they fill, and the dimension
rows of that key stand once in each of its deals.  Facts without a key are dealt by their own key
too; dimension rows without one can match nothing and are left out of the joined copy.

Hashes are deterministic, so a task that is repeated after the loss of an executor deals alike.
A key that two 64-bit hashes confuse with a hot one is dealt as well, on both sides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.operators.joins import HOT_ROWS, hot_keys, join_key

DEAL = "_deal"


def join_columns(n: int) -> list[str]:
    return [*[f"_j{i}" for i in range(n)], DEAL]


def _all_set(names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in names:
        cond = cond & F.col(c).isNotNull()
    return cond


def colocated(facts: DataFrame, dim: DataFrame, fact_keys: Sequence[str], dim_keys: Sequence[str],
              row_key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Both sides with the join columns.  ``row_key``: the column that tells facts apart."""
    names = join_columns(len(fact_keys))[:-1]
    f = facts.withColumns({n: join_key(facts, k) for n, k in zip(names, fact_keys, strict=True)})
    d = dim.withColumns({n: join_key(dim, k) for n, k in zip(names, dim_keys, strict=True)}).where(_all_set(names))
    f = f.withColumn("_h", F.when(_all_set(names), F.xxhash64(*names)))
    hot = [(r["k"], -(-r["n"] // max(1, hot_rows))) for r in hot_keys(f, "_h", hot_rows).collect()]
    deals = F.broadcast(facts.sparkSession.createDataFrame(hot, "_hk bigint, _deals bigint"))
    own = F.xxhash64(row_key)
    f = f.join(deals, F.col("_h") == F.col("_hk"), "left").withColumn(
        DEAL, F.when(F.col("_h").isNull(), own).when(F.col("_deals").isNotNull(), F.pmod(own, F.col("_deals")))
        .otherwise(F.lit(0).cast("bigint")))
    d = d.join(deals, F.xxhash64(*names) == F.col("_hk"), "left").withColumn(
        DEAL, F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(F.col("_deals"), F.lit(1)) - 1)))
    return f.drop("_h", "_hk", "_deals"), d.drop("_hk", "_deals")


def colocated_left_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                        right_keys: Sequence[str], right_cols: Sequence[str] | dict) -> DataFrame:
    """``left_join_keys`` over the stored tables, whose join columns stand for the keys."""
    if not isinstance(right_cols, dict):
        right_cols = {c: c for c in right_cols}
    names = join_columns(len(left_keys))
    for df in (left, right):
        if not set(names) <= set(df.columns):
            raise ValueError(f"a colocated table has the columns {names}")
    r = right.select(*[F.col(n).alias(f"_r{n}") for n in names],
                     *[F.col(src).alias(f"_rc_{dst}") for src, dst in right_cols.items()])
    cond = F.lit(True)
    for n in names:
        cond = cond & (left[n] == r[f"_r{n}"])
    return left.join(r, cond, "left").select(
        *[left[c] for c in left.columns if c not in names],
        *[F.col(f"_rc_{dst}").alias(dst) for dst in right_cols.values()])
