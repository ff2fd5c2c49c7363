"""Toxicity classifier with a counterfactual penalty on identity terms.

A text is the set of its words and of their first four and five letters. A logistic model over
the telling ones of these features is fitted to labelled texts by Newton steps, whose sums are
taken per partition and added in a tree. The loss has three parts:

* log-loss of the labelled texts, each class weighted up to its size;
* a small ridge;
* counterfactuals: in every labelled sentence that names an identity term, the term is swapped
  for each other term of its group, the neutral one included; ``counterfactual`` times the mean
  square of the change in score is added. A group that is mostly named in toxic texts then
  carries no weight of its own, and its neutral mentions are left alone.

Features are chosen in rounds by a score test against the model so far, so that words that
come with an explained passage (a toxic text with a thousand near copies) do not crowd out others.

What is learned comes from a sample: about ``per_class`` labelled ids of each class, those with
the smallest hashes, all of a smaller class. Equal texts with equal labels count once. The sample
is found by its ids, so texts are not shuffled; what reaches the driver has the size of the model.
Every text is scored whole.

Null text is empty; a text without a chosen feature has the score of the intercept. Labels that
are null, or of an id without a document, teach nothing; an id with both labels teaches both. Rows
without an id are scored. Without labels every score is 0.5, with one value only it is that value.
An empty table yields an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import batched, crc_part, fold_words, id_and_bytes, rows_of, tree_sum
from leadgrid.session import written

# Identity terms by group; the first of each is neutral.
IDENTITY = {
    "gender": ["people", "women", "men", "girls", "boys", "female", "male"],
    "religion": ["people", "muslims", "christians", "jews", "hindus", "buddhists", "atheists"],
    "origin": ["people", "africans", "asians", "europeans", "americans", "immigrants", "refugees"],
    "orientation": ["people", "gay", "lesbian", "straight", "bisexual", "transgender", "queer"],
    "colour": ["people", "black", "white", "brown"],
    "ability": ["people", "deaf", "blind", "disabled", "autistic"],
    "age": ["people", "old", "young", "elderly", "teenagers"],
}
_SENTENCE = re.compile(rb"[.!?\n]+")
_FLUSH = 200_000  # features that a task holds before it emits their sums
_CELLS = pa.schema([("cells", pa.binary())])
_SUMS = pa.schema([("feature", pa.string()), ("gradient", pa.float64()), ("variance", pa.float64())])


def word_features(word: bytes) -> list[str]:
    """The word, and its first four and five letters."""
    letters = word.decode("utf-8", "replace").lower()
    return ["=" + letters] + [f"{n}{letters[:n]}" for n in (4, 5) if len(letters) >= n]


def text_features(words: Sequence[bytes]) -> set[str]:
    return {f for w in set(words) for f in word_features(w)}


@dataclass(frozen=True)
class Model:
    """Weights by feature, the last weight being the intercept. ``constant`` replaces the score."""

    features: tuple[str, ...] = ()
    weights: np.ndarray = field(default_factory=lambda: np.zeros(1))
    constant: float | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "place", {f: i for i, f in enumerate(self.features)})
        object.__setattr__(self, "known", {})

    def places(self, words: Sequence[bytes]) -> set[int]:
        """Places of the features that a text has. What a word stands for is remembered."""
        known, out = self.known, set()
        if len(known) > _FLUSH:
            known.clear()
        for word in set(words):
            mine = known.get(word)
            if mine is None:
                mine = known[word] = tuple(self.place[f] for f in word_features(word) if f in self.place)
            if mine:
                out.update(mine)
        return out

    def raw(self, places: set[int]) -> float:
        return float(self.weights[-1] + sum(self.weights[i] for i in sorted(places)))

    def score(self, words: Sequence[bytes]) -> float:
        return self.constant if self.constant is not None else float(logistic(self.raw(self.places(words))))


def logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def swaps(sentence: Sequence[bytes], groups: Sequence[Sequence[bytes]]) -> Iterator[list[bytes]]:
    """The sentence with every term of a group replaced by each other term of that group."""
    words = set(sentence)
    for group in groups:
        for term in words.intersection(group):
            for other in group:
                if other != term:
                    yield [other if w == term else w for w in sentence]


def training_sample(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, held_out_part: int,
                    parts: int, per_class: int) -> tuple[DataFrame, dict[int, float]]:
    """Distinct texts (body, label) of the sample, and the weight of each class."""
    known = labels.select(F.col(key).cast("long").alias("_id"), F.col(label).cast("int").alias("label")) \
                  .where("_id IS NOT NULL AND label IN (0, 1)")
    known = written(known.where(crc_part("_id", parts) != held_out_part).distinct(), "toxic-labels")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.create_map(*[F.lit(x) for c, n in sizes.items() for x in (c, min(1.0, per_class / n))]) if sizes else None
    place = (F.xxhash64("_id", F.lit("sample")).cast("double") + 2.0 ** 63) / 2.0 ** 64
    # About twice ``per_class`` short rows, whose size Spark knows when it plans the join.
    chosen = written(known.where(place <= share[F.col("label")]) if sizes else known, "toxic-sample-ids")
    bodies = id_and_bytes(docs, key, text).join(chosen, F.col("key") == F.col("_id")).select("body", "label")
    sample = bodies.withColumn("_hash", F.xxhash64("body")).dropDuplicates(["_hash", "label"]).drop("_hash")
    return written(sample, "toxic-sample"), {c: max(1.0, n / per_class) for c, n in sizes.items()}


def telling(sample: DataFrame, model: Model, weight: Mapping[int, float], most: int, least_z: float) -> list[str]:
    """New features whose gradient is largest beside its deviation, given the model's scores; over the whole sample."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, list[float]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            yield from batched(((f, g, h) for f, (g, h) in sums.items()), _SUMS, 1 << 16)
            sums.clear()

        for body, label in rows_of(batches, "body", "label"):
            words = fold_words(body)
            p = model.score(words)
            g, h = weight[label] * (label - p), weight[label] * p * (1 - p)
            for f in text_features(words):
                cell = sums.setdefault(f, [0.0, 0.0])
                cell[0] += g
                cell[1] += h
            if len(sums) > _FLUSH:
                yield from flushed()
        yield from flushed()

    sums = sample.mapInArrow(scan, "feature string, gradient double, variance double").groupBy("feature") \
                 .agg(F.sum("gradient").alias("g"), F.sum("variance").alias("h"))
    # Rounded, so that the order of the sums does not decide between equals.
    z = F.round(F.abs(F.col("g")) / F.sqrt(F.col("h") + 1.0), 6)
    new = sums.withColumn("z", z).where(F.col("z") >= least_z)
    new = new.join(sums.sparkSession.createDataFrame([(f,) for f in model.features], "feature string"), "feature", "left_anti")
    return [r["feature"] for r in new.orderBy(F.desc("z"), "feature").limit(most).collect()]


def _sums_over(sample: DataFrame, vector) -> np.ndarray:
    """Tree sum of ``vector(bodies, labels)`` over partitions."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = vector(batch)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()], pa.binary())], schema=_CELLS)
    return tree_sum(sample.mapInArrow(scan, "cells binary"))


def counterfactual_squares(sample: DataFrame, model: Model, groups: Sequence[Sequence[bytes]]) -> np.ndarray:
    """Mean of the outer products of the changes in features over all swaps; the intercept never changes."""
    width = len(model.features) + 1
    terms = frozenset(t for g in groups for t in g)

    def add(batch: pa.RecordBatch) -> np.ndarray:
        total = np.zeros(width * width + 1)
        squares = total[:-1].reshape(width, width)
        for body in batch.column("body").to_pylist():
            for part in _SENTENCE.split(body):
                words = fold_words(part)
                if terms.isdisjoint(words):
                    continue
                own = model.places(words)
                for swapped in swaps(words, groups):
                    other = model.places(swapped)
                    total[-1] += 1
                    at = np.array(sorted(own ^ other), np.int64)
                    if len(at):
                        change = np.array([1.0 if i in other else -1.0 for i in at.tolist()])
                        squares[np.ix_(at, at)] += np.outer(change, change)
        return total

    sums = _sums_over(sample, add)
    return sums[:-1].reshape(width, width) / max(1.0, sums[-1]) if len(sums) else np.zeros((width, width))


def newton(sample: DataFrame, model: Model, weight: Mapping[int, float], squares: np.ndarray, ridge: float,
           counterfactual: float, max_steps: int = 12) -> Model:
    """The model with weights that minimise the loss; steps are halved while they raise it."""
    width = len(model.features) + 1
    packed = written(sample.mapInArrow(_packer(model), "places binary, label int"), "toxic-features")

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def add(batch: pa.RecordBatch) -> np.ndarray:
            total = np.zeros(1 + 1 + width + width * width)
            lists = [np.frombuffer(b, "<i4") for b in batch.column("places").to_pylist()]
            labels = batch.column("label").to_numpy().astype(float)
            weigh = np.array([weight[int(c)] for c in labels])
            for a in range(0, len(lists), 2048):
                x = np.zeros((len(lists[a:a + 2048]), width))
                x[:, -1] = 1
                for i, own in enumerate(lists[a:a + 2048]):
                    x[i, own] = 1
                y, w, raw = labels[a:a + 2048], weigh[a:a + 2048], x @ weights
                p = logistic(raw)
                total[0] += w.sum()
                total[1] += (w * (np.logaddexp(0, raw) - y * raw)).sum()
                total[2:2 + width] += x.T @ (w * (p - y))
                total[2 + width:] += (x.T @ (x * (w * p * (1 - p))[:, None])).ravel()
            return total
        sums = _sums_over(packed, add)
        n, penalty = sums[0], ridge * np.r_[np.ones(width - 1), 0.0]
        # The ridge is that of one observation, so it fades as the sample grows.
        loss = sums[1] / n + (penalty * weights ** 2).sum() / (2 * n) + counterfactual * weights @ squares @ weights
        gradient = sums[2:2 + width] / n + penalty * weights / n + 2 * counterfactual * squares @ weights
        hessian = sums[2 + width:].reshape(width, width) / n + np.diag(penalty) / n + 2 * counterfactual * squares
        return loss, gradient, hessian

    weights = model.weights
    loss, gradient, hessian = at(weights)
    size = 1.0
    for _ in range(max_steps):
        step = np.linalg.solve(hessian + 1e-9 * np.eye(width), gradient)
        now = at(weights - size * step)
        while now[0] > loss + 1e-12 and size > 1e-3:
            size /= 2
            now = at(weights - size * step)
        gain = loss - now[0]
        weights, (loss, gradient, hessian), size = weights - size * step, now, min(1.0, 2 * size)
        if gain < 1e-5 * max(loss, 1e-3):
            break
    # Rounded, so that reruns agree though sums are added in another order.
    return Model(model.features, np.round(weights, 6))


def _packer(model: Model):
    schema = pa.schema([("places", pa.binary()), ("label", pa.int32())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((np.array(sorted(model.places(fold_words(b))), "<i4").tobytes(), c)
                            for b, c in rows_of(batches, "body", "label")), schema)
    return pack


def fit(sample: DataFrame, weight: Mapping[int, float], identity: Mapping[str, Sequence[str]] = IDENTITY,
        counterfactual: float = 5.0, ridge: float = 1.0, rounds: int = 3, per_round: int = 192, least_z: float = 4.0) -> Model:
    """Model of a sample (body, label)."""
    counts = {r["label"]: r["n"] * weight[r["label"]] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return Model(constant=float(next(iter(counts), 0.5)))
    groups = [[t.lower().encode() for t in g] for g in identity.values()]
    model = Model(weights=np.array([np.log(counts[1] / counts[0])]))
    for _ in range(rounds):
        new = telling(sample, model, weight, per_round, least_z)
        if not new:
            break
        model = Model(model.features + tuple(new), np.r_[model.weights[:-1], np.zeros(len(new)), model.weights[-1]])
        squares = counterfactual_squares(sample, model, groups)
        model = newton(sample, model, weight, squares, ridge, counterfactual)
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                    parts: int = 4, held_out_part: int = 2, threshold: float = 0.3, per_class: int = 20_000, **options) -> DataFrame:
    """Per document: held_out, score, predicted (1 from ``threshold`` on). Ids whose CRC-32 as text leaves
    ``held_out_part`` modulo ``parts`` teach nothing."""
    model = fit(*training_sample(docs, labels, key, text, label, held_out_part, parts, per_class), **options)
    schema = pa.schema([("key", pa.int64()), ("score", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((k, model.score(fold_words(b))) for k, b in rows_of(batches, "key", "body")), schema)

    return id_and_bytes(docs, key, text).mapInArrow(score, "key long, score double").select(
        F.col("key").alias(key), (crc_part("key", parts) == held_out_part).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
