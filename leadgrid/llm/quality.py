"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

Every whole text becomes a short vector of statistics (lengths, shares of byte classes,
repetition of words and lines). Random cosines of the standardised vector approximate a
Gaussian kernel; ridge weights solve the normal equations, whose sums are taken per partition
and added in a tree. Raw scores of the training rows are counted on a fixed grid and made
monotone by pooling adjacent violators, which turns a score into the share of label 1.

Nothing but the text enters a score. All labelled training rows are used; what reaches the
driver has the size of the model, not of the data.

Null text is empty and scored as such. Labels that are null, or of an id without a document,
teach nothing; an id with several labels teaches each. Rows without an id are scored. If
the training rows have no label, or one value only, every score is 0.5 or that value. An
empty table yields an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import batched, crc_part, id_and_bytes, rows_of, tree_sum
from leadgrid.session import written

N_STATS = 22
_SYMBOLS = (b"#", b"$", b"%", b"&", b"*", b"|", b"!", b"<", b"{", b"@", b".")
_CELLS = pa.schema([("cells", pa.binary())])
_STATS = pa.schema([("key", pa.int64()), ("stats", pa.binary())])
_GRID = 512


def _byte_classes() -> np.ndarray:
    kinds = np.zeros(256, np.int64)  # other punctuation
    for kind, (a, b) in enumerate(((0x41, 0x5B), (0x61, 0x7B), (0x30, 0x3A), (0x80, 0x100)), 1):
        kinds[a:b] = kind
    kinds[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5
    return kinds


_CLASSES = _byte_classes()


def statistics(body: bytes) -> np.ndarray:
    """Statistics of a text; zeros for an empty one."""
    out = np.zeros(N_STATS)
    size = len(body)
    if not size:
        return out
    counts = np.bincount(np.frombuffer(body, np.uint8), minlength=256)
    classes = np.bincount(_CLASSES, counts, 6)
    words = body.split()
    lines = body.split(b"\n")
    n = max(1, len(words))
    distinct = set(words)
    out[0] = math.log1p(size)
    out[1] = math.log1p(len(words))
    out[2] = math.log1p(sum(map(len, words)) / n)
    out[3] = math.log1p(len(words) / len(lines))
    out[4] = len(distinct) / n
    out[5] = len(set(lines)) / len(lines)
    out[6:11] = classes[[0, 1, 3, 4, 5]] / size
    out[11:] = [math.log1p(100 * counts[s[0]] / n) for s in _SYMBOLS]
    return out


@dataclass(frozen=True)
class Model:
    """Everything that scores a text. ``curve`` maps the grid of raw scores to calibrated ones."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    low: float
    high: float
    curve: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -5, 5)
        z = np.cos(x @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([z, x, np.ones((len(x), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def cell(self, raw: np.ndarray) -> np.ndarray:
        """Place on the grid, from 0 to _GRID - 1."""
        return np.clip((raw - self.low) / (self.high - self.low), 0, 1) * (_GRID - 1)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.cell(self.raw(stats)), np.arange(_GRID), self.curve)


def isotonic(n: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """Rising curve nearest to the shares ``positive / n``, by pooling adjacent violators; empty cells between
    filled ones are interpolated."""
    filled = np.flatnonzero(n > 0)
    blocks: list[list[float]] = []
    for i in filled:
        blocks.append([float(n[i]), float(positive[i]), 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            a, b, c = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a, blocks[-1][1] + b, blocks[-1][2] + c]
    values = np.concatenate([np.full(int(c), b / a) for a, b, c in blocks])
    return np.interp(np.arange(len(n)), filled, values)


def stats_table(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, stats): the statistics of every text as packed doubles."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((k, statistics(b).tobytes()) for k, b in rows_of(batches, "key", "body")), _STATS)
    return id_and_bytes(docs, key, text).mapInArrow(scan, "key long, stats binary")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("stats").to_pylist()), "<f8").reshape(-1, N_STATS)


def _partition_sums(rows: DataFrame, vector) -> np.ndarray:
    """Tree sum over partitions of ``vector(stats, labels)``."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = vector(_matrix(batch), batch.column("label").to_numpy())
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary())], schema=_CELLS)
    return tree_sum(rows.mapInArrow(scan, "cells binary"))


def fit(training: DataFrame, features: int = 256, gamma: float = 0.05, ridge: float = 1e-4, seed: int = 7) -> Model:
    """Model from rows (stats, label double). Three passes over the small table of statistics."""
    def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.concatenate([[len(x), y.sum()], x.sum(axis=0), (x * x).sum(axis=0)])

    sums = _partition_sums(training, moments)
    random = np.random.default_rng(seed)
    directions = random.normal(0, math.sqrt(2 * gamma), (N_STATS, features))
    phases = random.uniform(0, 2 * math.pi, features)
    width = features + N_STATS + 1
    plain = Model(np.zeros(N_STATS), np.ones(N_STATS), directions, phases, np.zeros(width), 0.0, 1.0,
                  np.full(_GRID, 0.5))
    if not len(sums):
        return plain
    n, positive = sums[0], sums[1]
    mean = sums[2:2 + N_STATS] / n
    scale = np.sqrt(np.maximum(sums[2 + N_STATS:] / n - mean ** 2, 0))
    scale = np.where(scale > 1e-9, scale, 1.0)
    if positive in (0, n):
        return Model(mean, scale, directions, phases, np.zeros(width), 0.0, 1.0, np.full(_GRID, positive / n))
    base = Model(mean, scale, directions, phases, np.zeros(width), 0.0, 1.0, plain.curve)

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = base.features(x)
        return np.concatenate([(z.T @ z).ravel(), z.T @ y])

    sums = _partition_sums(training, normal)
    gram = sums[:width * width].reshape(width, width) / n
    weights = np.linalg.solve(gram + ridge * np.eye(width), sums[width * width:] / n)
    scored = Model(mean, scale, directions, phases, weights, -0.5, 1.5, plain.curve)

    def counts(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        cell = np.rint(scored.cell(scored.raw(x))).astype(int)
        return np.concatenate([np.bincount(cell, minlength=_GRID), np.bincount(cell, y, _GRID)])

    sums = _partition_sums(training, counts)
    return Model(mean, scale, directions, phases, weights, -0.5, 1.5, isotonic(sums[:_GRID], sums[_GRID:]))


def _training(stats: DataFrame, labels: DataFrame, key: str, label: str, held_out: Column) -> DataFrame:
    known = labels.select(F.col(key).cast("long").alias("_key"), F.col(label).cast("double").alias("label")) \
                  .where("label IS NOT NULL")
    return stats.where(~held_out).join(known, F.col("key") == F.col("_key")).select("stats", "label")


def is_held_out(key: str) -> Column:
    """Rows that teach nothing: crc32 of the id as text leaves 1 modulo 3."""
    return crc_part(key, 3) == 1


def quality_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
                   label: str = "quality") -> DataFrame:
    """Per document: held_out, score, predicted (1 from a score of 0.5 on)."""
    stats = written(stats_table(docs, key, text), "stats")
    model = fit(written(_training(stats, labels, key, label, is_held_out("key")), "training"))
    schema = pa.schema([("key", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(model.score(_matrix(batch)))], schema=schema)

    return stats.mapInArrow(score, "key long, score double").select(
        F.col("key").alias(key), is_held_out("key").alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
              label: str = "quality", least: float = 0.5) -> DataFrame:
    """The documents, all columns, whose score is at least ``least``; texts are not shuffled."""
    stats = stats_table(docs, key, text)
    model = fit(written(_training(stats, labels, key, label, is_held_out("key")), "training"))

    @F.pandas_udf("double")
    def score(bodies: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack([statistics(b) for b in bodies])) if len(bodies) else [], dtype=float)

    body = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.where(score(body) >= least)
