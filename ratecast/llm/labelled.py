"""What the two classifiers share: a bounded labelled sample, the held-out rule, calibration, the scoring pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ratecast.llm.bytes_hash import blocks
from ratecast.llm.common import released

#: Bound of the sample that a model is fitted on (rows of ``labels``, the first by a hash of doc_id).
MAX_FIT_DOCS = 6000
#: Texts whose features a task holds at once, and bytes of them hashed at once (a longer text alone).
SLICE_TEXTS, SLICE_BYTES = 256, 1 << 19
#: One text -> sorted distinct feature numbers of each text of a block: (owner, feature).
Features = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def text_features(texts: list, features: Features) -> Iterator[np.ndarray]:
    """The features of every text, in order."""
    for _, data, offsets in blocks(((t or "").encode() for t in texts), SLICE_BYTES):
        owner, value = features(data, offsets)
        yield from np.split(value, np.searchsorted(owner, np.arange(1, len(offsets) - 1)))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most SLICE_TEXTS."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE_TEXTS):
            yield b.slice(at, SLICE_TEXTS)


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, features: Features,
               max_docs: int = MAX_FIT_DOCS) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and labels of at most ``max_docs`` labelled documents outside the held-out fifth.

    Rows without a label or an id are not used; a document labelled twice has
    its larger label. Only feature numbers reach the driver, never texts.
    """
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = [f.astype("<i4").tobytes() for f in text_features(b.column("text").to_pylist(), features)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), pa.array(found, pa.binary())],
                                             names=["doc_id", "label", "found"])

    rows = (docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_docs rows
            .select("doc_id", "label", "text").mapInArrow(released(run), "doc_id long, label int, found binary").collect())
    rows.sort(key=lambda r: (r["doc_id"], r["found"]))
    return [np.frombuffer(r["found"], "<i4") for r in rows], np.array([r["label"] for r in rows], np.int8)


def platt(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(a, b) so that 1 / (1 + exp(-(a * margin + b))) is the share of label 1, by Newton steps."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -30, 30)))
        g = np.array([((p - target) * margins).sum(), (p - target).sum()])
        v = p * (1 - p)
        h = np.array([[(v * margins * margins).sum(), (v * margins).sum()], [(v * margins).sum(), v.sum()]]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def scored(docs: DataFrame, features: Features, score: Callable[[list[np.ndarray]], np.ndarray], threshold: float, *carry: str) -> DataFrame:
    """``doc_id, text, held_out, score, predicted`` and the columns to carry along; one pass without a shuffle."""
    docs = docs.select("doc_id", "text", F.struct(*[F.col(c) for c in carry] or [F.lit(0)]).alias("carried"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            s = score(list(text_features(b.column("text").to_pylist(), features)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*b.schema.names, "score"])

    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    return (docs.mapInArrow(released(run), schema).withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
            .select("doc_id", "text", "held_out", "score", "predicted", *[f"carried.{c}" for c in carry]))
