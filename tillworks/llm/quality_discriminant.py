"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance that is shrunk first towards the pooled one, then towards a multiple of the identity. The score
is the logistic of the difference of the classes' log densities, whose Mahalanobis distances come from Cholesky factors that are worked
out once and sent to the tasks.

Cases: a null text is empty, and an empty text has a score like any other (all its statistics are 0); without labels of both classes
every score is 0.5; repeated labels of a document count once each way; columns besides the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.text import chunks, small_batches, span_hashes, spans_of

STATISTICS = ("words", "word_length", "symbols", "capitals", "digits", "marks", "lines", "distinct", "top_word", "repeated_pairs")
SHRINK_POOLED = 0.1
SHRINK_IDENTITY = 0.01

_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in "#*$%&|<>"]] = 4
_KIND[[ord(c) for c in "!?.,;:"]] = 5


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return (sums[bounds[1:]] - sums[bounds[:-1]]).astype(np.float64)


def statistics(column: pa.Array) -> np.ndarray:
    """One row per text: the transformed statistics, all 0 for an empty text."""
    out = []
    for _, data, bounds in chunks(column):
        kind = _KIND[data]
        starts, ends = spans_of(kind != 1, bounds)
        first = np.searchsorted(starts, bounds)
        words = span_hashes(data, starts, ends)
        n = np.diff(first).astype(np.float64)
        least = np.maximum(n, 1)
        chars = np.maximum(_per_text(kind != 1, bounds), 1)
        distinct, top, pairs = np.zeros(len(n)), np.zeros(len(n)), np.zeros(len(n))
        for i in range(len(n)):
            own = words[first[i]:first[i + 1]]
            if len(own):
                count = np.unique(own, return_counts=True)[1]
                distinct[i], top[i] = len(count), count.max()
                both = own[:-1] * np.uint64(3) + own[1:]
                pairs[i] = len(both) - len(np.unique(both))
        rows = np.column_stack([
            np.log1p(n), np.log1p(chars / least) * (n > 0), np.sqrt(_per_text(kind == 4, bounds) / chars), np.sqrt(_per_text(kind == 2, bounds) / chars),
            np.sqrt(_per_text(kind == 3, bounds) / chars), np.sqrt(_per_text(kind == 5, bounds) / chars),
            np.sqrt(_per_text(data == 10, bounds) / least), np.log1p(n) - np.log1p(distinct), np.sqrt(top / least), np.sqrt(pairs / least)])
        out.append(rows)
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


@dataclass(frozen=True)
class Discriminant:
    """Class 1 against class 0: means, inverse Cholesky factors of the shrunk covariances, half their log determinants, log odds."""

    means: tuple[np.ndarray, np.ndarray]
    factors: tuple[np.ndarray, np.ndarray]
    half_logs: tuple[float, float]
    log_odds: float

    def score(self, x: np.ndarray) -> np.ndarray:
        density = []
        for mean, factor, half in zip(self.means, self.factors, self.half_logs):
            z = (x - mean) @ factor.T
            density.append(-0.5 * (z * z).sum(axis=1) - half)
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_odds, -500, 500)))


def fit(moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pooled: float = SHRINK_POOLED, identity: float = SHRINK_IDENTITY) -> Discriminant | None:
    """``moments``: class -> (rows, sum, sum of outer products). None unless both classes have rows."""
    if set(moments) != {0, 1}:
        return None
    means = {k: s / n for k, (n, s, _) in moments.items()}
    scatter = {k: o - n * np.outer(means[k], means[k]) for k, (n, _, o) in moments.items()}
    total = sum(n for n, _, _ in moments.values())
    common = (scatter[0] + scatter[1]) / total
    scale = np.trace(common) / len(common)
    eye = np.eye(len(common)) * max(scale, 1e-6)
    factors, halves = [], []
    for k in (0, 1):
        own = (1 - pooled) * scatter[k] / moments[k][0] + pooled * common
        root = np.linalg.cholesky((1 - identity) * own + identity * eye)
        factors.append(np.linalg.inv(root))
        halves.append(float(np.log(np.diag(root)).sum()))
    return Discriminant((means[0], means[1]), tuple(factors), tuple(halves), float(np.log(moments[1][0] / moments[0][0])))


def with_vectors(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, x): the statistics of every row."""
    small_batches(docs.sparkSession)
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1))
            offsets = pa.array(np.arange(0, x.size + 1, len(STATISTICS), dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(x.ravel()))], names=["id", "x"])

    return docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(run, f"id {kind}, x array<double>")


def learn(labelled: DataFrame, **options) -> Discriminant | None:
    """``labelled``: (x, label). All rows count; each task sends sums per class, which Spark adds up."""
    d = len(STATISTICS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            y = batch.column(1).to_numpy()
            for k in (0, 1):
                own = x[y == k]
                if len(own):
                    part = np.concatenate(([len(own)], own.sum(axis=0), (own.T @ own).ravel()))
                    total[k] = total[k] + part if k in total else part
        for k, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), k)), pa.array(np.arange(len(part))), pa.array(part)], names=["k", "i", "v"])

    rows = labelled.select("x", F.col("label").cast("bigint")).mapInArrow(sums, "k bigint, i bigint, v double")
    found: dict[int, np.ndarray] = {}
    for r in rows.groupBy("k", "i").agg(F.sum("v").alias("v")).collect():  # two classes of 1 + d + d * d numbers
        found.setdefault(r["k"], np.zeros(1 + d + d * d))[r["i"]] = r["v"]
    return fit({k: (v[0], v[1:1 + d], v[1 + d:].reshape(d, d)) for k, v in found.items()}, **options)


def scored(vectors: DataFrame, model: Discriminant | None) -> DataFrame:
    """(id, score) of (id, x)."""
    held = vectors.sparkSession.sparkContext.broadcast(model)
    kind = vectors.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(STATISTICS))
            score = held.value.score(x) if held.value is not None else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["id", "score"])

    return vectors.select("id", "x").mapInArrow(run, f"id {kind}, score double")
