"""Identity resolution: user ids that belong to one person.

Two ids are linked when identities of both carry the same login or the same e-mail address
(trimmed, lower case; blank ones link nobody).  A value used by more than ``max_ids`` distinct ids
is no one's own (a no-reply address, a renamed login) and links nobody: the rule is measured on the
data, and it bounds every group of linked ids.  Of a hot value each task passes on its ``max_ids + 1``
smallest ids alone, which tell that it is hot; the others are not shuffled by value.

Components are found by contraction with alternating large-star and small-star steps: every node
connects its larger (smaller) neighbours to the smallest node it knows of, until only stars are
left.  Each step is a partial aggregation and a join over the links; the number of rounds grows
with the square of the logarithm of the nodes at most.  Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sediment.session import drop_path, scratch_path
from sediment.sources.tables import write_parquet

MAX_IDS = 20
LINKING = ("user_login", "user_email")


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = write_parquet(df, scratch_path(df.sparkSession, name))
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _value(name: str) -> Column:
    text = F.lower(F.trim(F.col(name)))
    return F.when(text != "", text)


def shared_values(identities: DataFrame, id_col: str = "user_id", linking=LINKING) -> DataFrame:
    """``(kind, value, ids, lowest)``: how many distinct ids use a value that more than one uses."""
    pairs = _pairs(identities, id_col, linking)
    return pairs.groupBy("kind", "value").agg(F.count(F.lit(1)).alias("ids"), F.min("id").alias("lowest")).where(
        "ids > 1")


def _pairs(identities: DataFrame, id_col: str, linking) -> DataFrame:
    each = F.array(*[F.struct(F.lit(name).alias("kind"), _value(name).alias("value")) for name in linking])
    rows = identities.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.inline(each))
    return rows.where("value IS NOT NULL").distinct()


def links(identities: DataFrame, id_col: str = "user_id", linking=LINKING,
          max_ids: int = MAX_IDS) -> DataFrame:
    """``(u, v)`` with u > v: every id of a shared value to the smallest id of that value."""
    out, _ = _stored(_to_lowest(_pairs(identities, id_col, linking), max_ids), "identity-links")
    return out


def _to_lowest(pairs: DataFrame, max_ids: int) -> DataFrame:
    value = Window.partitionBy("kind", "value")
    # Planned as WindowGroupLimit below the exchange: a task sends a value at most max_ids + 1 times.
    few = pairs.withColumn("rank", F.row_number().over(value.orderBy("id"))).where(F.col("rank") <= max_ids + 1)
    known = few.select("id", F.count(F.lit(1)).over(value).alias("n"), F.min("id").over(value).alias("v"))
    return known.where((F.col("n") <= max_ids) & (F.col("id") != F.col("v"))).select(
        F.col("id").alias("u"), "v").distinct()


def contract(edges: DataFrame) -> DataFrame:
    """``(u, root)`` of every node of ``edges(u, v)`` but the roots: the smallest node of its component."""
    spark = edges.sparkSession
    low, high = F.least("u", "v"), F.greatest("u", "v")
    edges = edges.where("u != v").select(high.alias("u"), low.alias("v")).distinct()
    edges, path = _stored(edges, "identity-stars")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            return edges.select("u", F.col("v").alias("root"))
        seen = tuple(state)
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # Large star: larger neighbours to the smallest node in sight.
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: a node's smaller neighbours, and itself, to the smallest of them.
        best = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(best, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(best.select("u", F.col("m").alias("v"))).distinct())
        edges, last = _stored(small, "identity-stars")
        drop_path(spark, path)
        path = last


def people(identities: DataFrame, max_ids: int = MAX_IDS) -> DataFrame:
    """``(user_id, person_id)`` of the ids that belong to a person with a smaller id."""
    return contract(links(identities, max_ids=max_ids)).select(
        F.col("u").alias("user_id"), F.col("root").alias("person_id"))
