"""Disk that a run holds besides its tables: shuffle files go with the write that made them, and large
silver tables are built one after the other."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from sediment.plans import run as R
from sediment.session import DROP_SHUFFLES, dropping_shuffles
from sediment.sources.landing import write_envelopes
from sediment.sources.tables import write_parquet


def shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {name for i in range(blocks.size()) if (name := blocks.apply(i).name()).startswith("shuffle_")}


def left(spark, before, seconds=10):
    """Shuffle files that are new and stay; they are removed soon after a write, not within it."""
    until = time.time() + seconds
    while (new := shuffles(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return new


@pytest.mark.parametrize("sink", ["parquet", "envelopes"])
def test_shuffle_files_go_as_a_write_ends(spark, tmp_path, sink):
    grouped = spark.range(10000).groupBy(F.col("id") % 100).agg(F.max("id").alias("n"))  # held until the end
    before, former = shuffles(spark), spark.conf.get(DROP_SHUFFLES)
    if sink == "parquet":
        write_parquet(grouped, str(tmp_path / "t"))
    else:
        records = spark.range(500).selectExpr("named_struct('id', id) AS rec", "id div 50 AS page")
        write_envelopes(records, "issues", str(tmp_path / "l"), ["page"], F.lit("2024-01-01T00:00:00"))
    assert not left(spark, before)
    assert spark.conf.get(DROP_SHUFFLES) == former
    assert sink != "parquet" or spark.read.parquet(str(tmp_path / "t")).count() == grouped.count() == 100
    # Run again all the same, a frame that was made inside computes its shuffles anew.
    with dropping_shuffles(spark):
        inside = spark.range(1000).groupBy(F.col("id") % 10).count()
        assert [len(inside.collect()) for _ in range(2)] == [10, 10]


def test_the_setting_outlives_no_thread(spark):
    former, inside, go = spark.conf.get(DROP_SHUFFLES), threading.Barrier(3), threading.Event()

    def user(last):
        with dropping_shuffles(spark):
            inside.wait()
            if last:
                go.wait()
    threads = [threading.Thread(target=user, args=(last,)) for last in (False, True)]
    for t in threads:
        t.start()
    inside.wait()
    threads[0].join()
    assert spark.conf.get(DROP_SHUFFLES) == "true"  # the other thread is still inside
    go.set()
    threads[1].join()
    assert spark.conf.get(DROP_SHUFFLES) == former
    with pytest.raises(ZeroDivisionError), dropping_shuffles(spark):
        1 / 0
    assert spark.conf.get(DROP_SHUFFLES) == former


def test_large_silver_tables_are_written_one_by_one(spark, tmp_path, monkeypatch):
    from sediment.sources import driver_tables as dt

    bronze = {t: spark.read.parquet(write_parquet(df, str(tmp_path / "bronze" / t)))
              for t, df in dt.bronze_inputs(spark, "/root/testdata/sf0.001").items()}
    lock, now, most, order = threading.Lock(), set(), [], []

    def watched(df, path, *options):
        with lock:
            now.add(path)
            most.append(len(now))
            order.append(path.rpartition("/")[2].partition("-")[0])
        try:
            return write_parquet(df, path, *options)
        finally:
            with lock:
                now.remove(path)
    monkeypatch.setattr(R, "write_parquet", watched)
    stamp = F.lit("2024-01-01").cast("timestamp")
    beside = R.build_silver(spark, bronze, str(tmp_path / "a"), loaded_at=stamp)
    assert max(most) > 1
    most.clear(), order.clear()
    monkeypatch.setattr(R, "SIDE_BY_SIDE_BYTES", 0)
    single = R.build_silver(spark, bronze, str(tmp_path / "b"), loaded_at=stamp)
    assert max(most) == 1 and order.index("repo_merge") > order.index("fact_issues")
    assert list(single) == list(beside) == list(R.SILVER_TABLES)
    for t in single:
        a, b = (spark.read.parquet(x[t]) for x in (beside, single))
        assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()
