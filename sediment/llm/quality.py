"""Compression classifier for quality.

Two zstandard dictionaries are built, one from good and one from bad labelled text.  A text is
compressed in blocks with either; text like that of a dictionary gets smaller with it.  The
normalised difference of the compressed sizes, (bad - good) / larger, is the evidence.  With the
gain of the good dictionary over none and the share that plain compression leaves (which tell
repetition and noise, that neither dictionary can hold), their squares and products, it is
calibrated to a probability by logistic regression.

Training takes a bounded sample of the labelled documents: SAMPLE rows of each label, chosen by
a hash of the id; of each at most SAMPLE_BLOCKS blocks go into a dictionary.  Half of the sample
makes the dictionaries, the other half calibrates, so calibration sees texts that are not in
them.  Scoring reads every whole text, in the tasks that read the table.

Defined cases: null, empty and blank texts get the share of good labels in the sample; null ids
never serve for training; a label that is null or neither 0 nor 1 is ignored; of rows that repeat
a doc_id in labels one label (the greatest) counts; with no label of some class every score is
the share of good labels (1/2 without labels); other columns play no part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sediment.llm.common import doc_crc, small_batches, written
from sediment.llm.logistic import fit_logistic, predict

SAMPLE = 1500
SAMPLE_BLOCKS = 16
BLOCK = 1024
DICTIONARY = 112_640
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray | None
    base: float
    span: np.ndarray | None = None


def blocks(text: bytes) -> list[bytes]:
    """The whole text in blocks of equal size, at most BLOCK."""
    if not text:
        return []
    n = -(-len(text) // BLOCK)
    size = -(-len(text) // n)
    return [text[i:i + size] for i in range(0, len(text), size)]


def features(good: bytes, bad: bytes) -> Callable[[bytes], list[float] | None]:
    """Text to evidence; None for a text without content."""
    def packer(dictionary: bytes | None):
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if data:
            data.precompute_compress(level=LEVEL)
            return zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_dict_id=False)
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    plain, as_good, as_bad = packer(None), packer(good), packer(bad)

    def run(text: bytes) -> list[float] | None:
        if not text.strip():
            return None
        parts = blocks(text)
        p, g, b = (sum(len(c.compress(x)) for x in parts) for c in (plain, as_good, as_bad))
        share = p / len(text)
        return [(b - g) / max(b, g), (p - g) / p, share]
    return run


def expand(x: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The evidence, held within what calibration saw (texts that are in a dictionary lie far
    outside), with its squares and products."""
    n, x = x.shape[1], np.clip(x, *span)
    return np.column_stack([x, *(x[:, i] * x[:, j] for i in range(n) for j in range(i, n))])


def _sampled(labels: DataFrame, column: str, usable: Column, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids of each class, in the order of a hash of the id."""
    clean = (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1) & usable)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max(column).cast("int").alias("label")))
    parts = [clean.where(F.col("label") == v).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
             for v in (0, 1)]
    return parts[0].union(parts[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, column: str, usable: Column,
                    rows: int) -> DataFrame:
    """(doc_id, label, text) of a sample of at most 2 * rows labelled documents."""
    chosen = _sampled(labels, column, usable, rows)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Broadcast: at most 2 * rows ids and labels.
    return own.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")


def _dictionary_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        label, out = [], []
        for y, t in zip(batch.column(1), batch.column(2), strict=True):
            parts = blocks(t.as_buffer().to_pybytes()) if t.is_valid else []
            step = max(1, -(-len(parts) // SAMPLE_BLOCKS))
            for x in parts[::step]:
                label.append(y.as_py())
                out.append(x)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(out, pa.binary())],
                                         ["label", "block"])


def _evidence(good: bytes, bad: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = features(good, bad)
        for batch in batches:
            rows = [(y.as_py(), x) for y, t in zip(batch.column(1), batch.column(2), strict=True)
                    if t.is_valid and (x := of(t.as_buffer().to_pybytes())) is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([y for y, _ in rows], pa.int32()),
                 pa.array([x for _, x in rows], pa.list_(pa.float64()))], ["label", "x"])
    return run


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; of too little text, the text itself."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def train(docs: DataFrame, labels: DataFrame, column: str = "quality",
          usable: Column | None = None, rows: int = SAMPLE) -> Model:
    """Fit on a bounded sample: at most 2 * rows documents, SAMPLE_BLOCKS blocks of each."""
    small_batches(docs.sparkSession)
    sample = written(labelled_sample(docs, labels, column, F.lit(True) if usable is None else usable,
                                     rows), "quality-sample")
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2))
    got = (sample.where(half == 0).mapInArrow(_dictionary_blocks, "label int, block binary")
           .orderBy("label", F.xxhash64("block"), "block").collect())
    texts = {v: [bytes(r["block"]) for r in got if r["label"] == v] for v in (0, 1)}
    counts = {r["label"]: r["count"] for r in labels.where(
        F.col(column).isin(0, 1) & (F.lit(True) if usable is None else usable)).groupBy(
        F.col(column).cast("int").alias("label")).count().collect()}
    base = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    if not texts[0] or not texts[1]:
        return Model(b"", b"", None, base)
    good, bad = _dictionary(texts[1]), _dictionary(texts[0])
    seen = (sample.where(half == 1).mapInArrow(_evidence(good, bad), "label int, x array<double>")
            .orderBy("label", "x").collect())
    if len({r["label"] for r in seen}) < 2:
        return Model(good, bad, None, base)
    x, y = np.array([r["x"] for r in seen]), np.array([r["label"] for r in seen])
    span = np.stack([x.min(axis=0), x.max(axis=0)])
    return Model(good, bad, fit_logistic(expand(x, span), y, base, ridge=1e-3), base, span)


def _score(model: Model, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = features(model.good, model.bad) if model.weights is not None else lambda _: None
        for batch in batches:
            found = [of(t.as_buffer().to_pybytes()) if t.is_valid else None for t in batch.column(at)]
            out = np.full(len(found), model.base)
            known = [i for i, x in enumerate(found) if x is not None]
            if known:
                out[known] = predict(model.weights, expand(np.array([found[i] for i in known]), model.span))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)],
                                             [*batch.schema.names, "score"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column score (which replaces one of that name)."""
    small_batches(docs.sparkSession)
    rows = docs.drop("score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(_score(model, rows.columns.index("text")), schema + ", score double")


def contract(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labels are learnt from documents whose crc32(doc_id) mod 3 is not 1."""
    model = train(docs, labels, "quality", F.pmod(doc_crc(F.col("doc_id")), F.lit(3)) != 1)
    held = F.pmod(doc_crc(F.col("doc_id")), F.lit(3)) == 1
    return score(docs.select("doc_id", "text"), model).select(
        "doc_id", held.alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
