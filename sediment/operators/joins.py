"""Left outer joins that attach a dimension to a fact.

A dimension is broadcast if its size is known to be small: a plain read of files (projected or
filtered), whose bytes the file listing gives, of at most ``BROADCAST_FILE_BYTES``.  The fact is
then not shuffled at all.  Repositories grow with the data, so beyond that, and for a dimension
of unknown size, both sides are shuffled: adaptive execution measures the shuffled dimension and
may still broadcast it, and its skew handling splits oversized partitions of the fact (the
streamed, left side).

``fanout_left_join`` covers the case AQE cannot split in a left join: a hot key on the
*dimension* side (one owner holding a third of all repositories).  Hot keys are measured, and only
their rows are dealt over several join keys; the fact is read once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Compressed file bytes of a dimension that is broadcast; in memory it may be several times that.
BROADCAST_FILE_BYTES = 16 << 20
_PLAIN = {"Project", "Filter", "LogicalRelation"}


def file_bytes(df: DataFrame) -> int | None:
    """Bytes of the files behind a plain (projected, filtered) read; None for any other frame."""
    plan = df._jdf.queryExecution().optimizedPlan()
    node = plan
    while node.nodeName() in _PLAIN:
        children = node.children()
        if children.isEmpty():
            return int(str(plan.stats().sizeInBytes()))
        node = children.head()
    return None


def _eq(left: DataFrame, right: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str]) -> Column:
    cond = None
    for lk, rk in zip(lkeys, rkeys):
        c = left[lk] == right[rk]  # plain equality: NULL keys never match
        cond = c if cond is None else cond & c
    return cond


def join_key(df: DataFrame, name: str) -> Column:
    """A join key; empty strings, which name nothing, never match."""
    c = F.col(name)
    return F.nullif(c, F.lit("")) if df.schema[name].dataType.simpleString() == "string" else c


def left_join_keys(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                   right_keys: Sequence[str], right_cols: Sequence[str] | dict) -> DataFrame:
    """``left LEFT JOIN right ON left.k_i = right.k_i``; adds ``right_cols`` (renamed if a dict).

    Unmatched left rows get NULLs; every left column is kept as is.  An empty string is no key
    (a URL of another host gives one), on either side.
    """
    if not isinstance(right_cols, dict):
        right_cols = {c: c for c in right_cols}
    tags = {rk: f"_rk{i}" for i, rk in enumerate(right_keys)}
    r = right.select(*[join_key(right, rk).alias(tags[rk]) for rk in right_keys],
                     *[F.col(src).alias(f"_rc_{dst}") for src, dst in right_cols.items()])
    lk = [f"_lk{i}" for i in range(len(left_keys))]
    l = left.withColumns({name: join_key(left, k) for name, k in zip(lk, left_keys)})
    size = file_bytes(right)
    if size is not None and size <= BROADCAST_FILE_BYTES:
        joined = l.join(F.broadcast(r), _eq(l, r, lk, list(tags.values())), "left")
    else:
        # Fact rows without a key never match, yet would all hash to one partition: an extra
        # join key, 0 for keyed rows and a hash of the first column that is no key (a fact's id)
        # otherwise, spreads them.  It is deterministic, so filters pass it and a retried task
        # repeats it.
        spread = next((c for c in left.columns if c not in left_keys), left.columns[0])
        has_key = F.lit(True)
        for name in lk:
            has_key = has_key & F.col(name).isNotNull()
        l = l.withColumn("_spread", F.when(has_key, F.lit(0).cast("bigint"))
                         .otherwise(F.xxhash64(F.col(spread))))
        r = r.withColumn("_spread", F.lit(0).cast("bigint"))
        cond = _eq(l, r, lk, list(tags.values())) & (l["_spread"] == r["_spread"])
        joined = l.join(r, cond, "left")
    return joined.select(*[l[c] for c in left.columns],
                         *[F.col(f"_rc_{dst}").alias(dst) for dst in right_cols.values()])


#: Rows of one dimension key that one task may meet.
HOT_ROWS = 10_000
#: At most so many keys hold more than a thousandth of all rows each; twice as many are looked at.
_HOT_SHARE, _CANDIDATES, _TRACKED = 1000, 2000, 10_000


def hot_keys(df: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """``(key, n)``: keys that hold more than ``rows`` rows, and more than a thousandth of all.

    Candidates come from a mergeable frequent-items sketch (``approx_top_k``: one small state per
    task, and its error, under a four-thousandth of the rows, cannot hide such a key among
    2,000); their rows are then counted exactly.  At most 1,000 keys result.
    """
    keys = df.select(F.col(key).alias("k")).where("k IS NOT NULL")
    found = keys.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(k, {_CANDIDATES}, {_TRACKED})").alias("top")).first()
    least = max(rows, found["n"] // _HOT_SHARE)
    likely = [t["item"] for t in found["top"] or [] if t["count"] > least]
    counted = keys.where(F.col("k").isin(likely)) if likely else keys.limit(0)
    return counted.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)


def fanout_left_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     right_cols: Sequence[str] | dict, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Same result as ``left_join_keys`` on one key, robust to a hot key on the right side.

    One left join on (key, deal).  The right rows of a hot key (``hot_keys``) are dealt by a hash of
    their content, ``hot_rows`` to a deal or so, and the left rows of that key, which is told by a
    broadcast of at most 1,000 keys, are replicated to all its deals; a replica that meets none is
    dropped, as its row has a partner in another deal.  All other rows are shuffled once, as in a
    plain join; left rows without a key are dealt by a hash.  Hashes are deterministic, so a task
    repeated after the loss of an executor deals alike.
    """
    if not isinstance(right_cols, dict):
        right_cols = {c: c for c in right_cols}
    hot = [(r["k"], -(-r["n"] // max(1, hot_rows))) for r in hot_keys(right, right_key, hot_rows).collect()]
    kind = right.schema[right_key].dataType.simpleString()
    deals = left.sparkSession.createDataFrame(hot, f"_hk {kind}, _deals bigint")
    r = right.select(F.col(right_key).alias("_rk0"),
                     *[F.col(src).alias(f"_rc_{dst}") for src, dst in right_cols.items()])
    spread = next((c for c in left.columns if c != left_key), left_key)
    none = F.array(F.when(F.col(left_key).isNull(), F.xxhash64(spread)).otherwise(F.lit(0).cast("bigint")))
    if hot:
        known = F.broadcast(deals)
        r = r.join(known, r["_rk0"] == known["_hk"], "left").withColumn("_deal", F.coalesce(
            F.pmod(F.xxhash64(*r.columns), F.col("_deals")), F.lit(0).cast("bigint"))).drop("_hk", "_deals")
        l = left.join(known, left[left_key] == known["_hk"], "left").withColumn("_deal", F.explode(
            F.when(F.col("_deals").isNotNull(), F.sequence(F.lit(0).cast("bigint"), F.col("_deals") - 1)).otherwise(none)))
    else:
        r = r.withColumn("_deal", F.lit(0).cast("bigint"))
        l = left.withColumns({"_deal": none[0], "_deals": F.lit(None).cast("bigint")})
    r = r.withColumn("_hit", F.lit(True))
    joined = l.join(r, (l[left_key] == r["_rk0"]) & (l["_deal"] == r["_deal"]), "left")
    return joined.where("_deals IS NULL OR _hit").select(
        *[l[c] for c in left.columns], *[F.col(f"_rc_{dst}").alias(dst) for dst in right_cols.values()])
