"""The corpus pipeline: documents through the training-data operators, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that ``run`` writes as Parquet and
reads again as the next stage's documents.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sediment.llm import decontam, line_dedup, near_dedup, packing, quality
from sediment.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores at one half or more stay."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(COLUMNS), model).where("score >= 0.5").select(COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines that stand in many documents stay in one of them only."""
    return line_dedup.dedup_lines(docs.select(COLUMNS)).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five words, 0.8) one row stays: the first of the smallest
    doc_id.  Rows are told apart by their place, so null and repeated ids are judged too."""
    return near_dedup.survivors(docs.select(COLUMNS), words=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text contains a benchmark item go, whatever their doc_id."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as pieces placed in sequences."""
    return packing.contract(docs)


STAGES = [
    ("quality", reject_low_quality),
    ("line_dedup", drop_lines),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack),
]
#: A compressor's output sizes decide the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
