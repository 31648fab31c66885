"""Token ids in ORC: run-length encoded integers, row indexes, Bloom filters on document ids.

``write_tokens`` range-partitions the texts by doc_id, so part files and the rows in them ascend,
and writes one row per document: its ids as an integer list (bit-packed by ORC's run-length
encoding), its token count, and the tokens before it in its part file.  Every stripe carries a
row index (minimum and maximum of doc_id per ROW_STRIDE rows) and Bloom filters on doc_id.

``read_tokens`` reads stripes in parallel; a filter on doc_id is pushed to the reader, which
skips files, stripes and row groups by those indexes.  ``starts`` adds each document's place in
the whole sequence: the counts of the earlier part files (one number per file) plus its own.

Defined cases: a null text is empty and holds the end id alone; null doc_ids come first; rows
that repeat a doc_id follow each other in the order of their texts; an empty table gives files
without rows; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sediment.llm.common import small_batches
from sediment.llm.tokens import encoder
from sediment.session import scratch_path

END = 0
ROW_STRIDE = 1000
SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"
OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(32 << 20),
    "orc.row.index.stride": str(ROW_STRIDE),
    "orc.row.batch.size": "64",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _encode(vocab: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder, part, before = encoder(vocab), TaskContext.get().partitionId(), 0
        for batch in batches:
            found = list(coder.encode(batch.column(1), END))
            counts = np.fromiter(map(len, found), np.int64, len(found))
            ends = np.cumsum(counts)
            flat = np.concatenate(found).view(np.int32) if found else np.zeros(0, np.int32)
            ids = pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), pa.array(flat))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(found), part, np.int32)),
                 pa.array(before + ends - counts), pa.array(counts), ids],
                ["doc_id", "part", "before", "n_tokens", "ids"])
            before += int(ends[-1]) if len(ends) else 0
    return run


def write_tokens(docs: DataFrame, path: str, vocab: str = "byte_bpe_50k.json") -> None:
    """Encode every whole text and write the ids as ORC, in ascending doc_id order."""
    small_batches(docs.sparkSession)
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(_encode(vocab), SCHEMA)
     .write.options(**OPTIONS).orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    spark.conf.set("spark.sql.orc.columnarReaderBatchSize", 128)  # lists may be long
    return spark.read.schema(SCHEMA).orc(path)


def starts(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``start``: the ids of all documents before each."""
    parts = tokens.groupBy(F.col("part").alias("__part")).agg(F.sum("n_tokens").alias("__sum"))
    # One row per part file.
    earlier = Window.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("__part", F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__off"))
    return (tokens.join(F.broadcast(offsets), F.col("part") == F.col("__part"))
            .withColumn("start", F.col("__off") + F.col("before")).drop("__part", "__off"))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column(3)
        flat = ids.values.to_numpy().astype("<u4", copy=False)
        at = ids.offsets.to_numpy()
        crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.diff(at).astype(np.int64)), pa.array(crc, pa.int64())],
            ["doc_id", "start", "said", "n_tokens", "ids_crc32"])


def contract(docs: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    path = scratch_path(spark, "llm-tokens") + ".orc"
    write_tokens(docs, path)
    small_batches(spark)
    back = starts(read_tokens(spark, path)).select("doc_id", "start", "n_tokens", "ids")
    return (back.mapInArrow(_digest, "doc_id long, start long, said long, n_tokens long, ids_crc32 long")
            .select("doc_id", "start", "n_tokens", "ids_crc32"))
