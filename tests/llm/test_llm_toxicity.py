"""Toxicity: held-out accuracy, the counterfactual penalty, the fit itself, awkward rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrid.llm import toxicity
from leadgrid.llm.common import fold_words

GROUPS = {"religion": ["people", "muslims", "christians", "jews"], "ability": ["people", "deaf", "blind"]}
INSULTS = ["scum", "morons", "trash", "idiots"]
PLAIN = ["went", "to", "the", "market", "and", "bought", "fresh", "bread", "today", "with", "friends", "near", "river", "again"]


def sentence(rng, term, insult):
    words = rng.sample(PLAIN, 8)
    if term:
        words.insert(rng.randint(0, 8), term)
    if insult:
        words.insert(rng.randint(0, 8), rng.choice(INSULTS))
    return " ".join(words) + ". "


def biased(seed, n=900):
    """Insults are half as often named as toxic texts; one group is named in toxic texts almost only."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        toxic = i % 3 == 0
        term = rng.choice(["muslims", "muslims", "muslims", "deaf"]) if toxic else rng.choice([None, None, None, "christians", "people", "blind"])
        rows.append((sentence(rng, None, False) + sentence(rng, term, toxic and rng.random() < 0.6) + sentence(rng, None, False), int(toxic)))
    return rows


def sample(spark, rows):
    return spark.createDataFrame([(t.encode(), y) for t, y in rows], "body binary, label int")


@pytest.fixture(scope="module")
def models(spark):
    df = sample(spark, biased(1)).cache()
    return {c: toxicity.fit(df, {0: 1.0, 1: 1.0}, identity=GROUPS, counterfactual=c) for c in (0.0, 20.0)}


def neutral(seed):
    rng = random.Random(seed)
    return [sentence(rng, t, False) for t in ("muslims", "christians", "jews", "deaf", "blind", "people") for _ in range(30)]


def test_neutral_mentions_are_left_alone(models):
    marked = {c: np.mean([m.score(fold_words(t.encode())) >= 0.3 for t in neutral(5)]) for c, m in models.items()}
    assert marked[0.0] >= 0.3 and marked[20.0] <= 0.05
    rng = random.Random(6)
    insults = [sentence(rng, rng.choice(["jews", "blind", "people", None]), True) for _ in range(100)]
    assert np.mean([models[20.0].score(fold_words(t.encode())) >= 0.3 for t in insults]) >= 0.95


def test_swapping_a_term_hardly_moves_the_score(models):
    groups = [[t.encode() for t in g] for g in GROUPS.values()]

    def moves(model):
        out = []
        for text in neutral(7):
            words = fold_words(text.encode())
            out += [abs(model.raw(model.places(s)) - model.raw(model.places(words))) for s in toxicity.swaps(words, groups)]
        return np.mean(out)
    assert moves(models[20.0]) < 0.1 * moves(models[0.0])


def test_newton_finds_the_minimum(spark):
    rows = biased(3, 300)
    df = sample(spark, rows)
    start = toxicity.Model(("=scum", "=muslims", "5trash", "=deaf", "=christians"), np.zeros(6))
    groups = [[t.encode() for t in g] for g in GROUPS.values()]
    squares = toxicity.counterfactual_squares(df, start, groups)
    weight = {0: 2.0, 1: 1.0}
    got = toxicity.newton(df, start, weight, squares, 1.0, 0.3)
    x = np.zeros((len(rows), 6))
    x[:, -1] = 1
    for i, (t, _) in enumerate(rows):
        x[i, sorted(start.places(fold_words(t.encode())))] = 1
    y, w = np.array([c for _, c in rows]), np.array([weight[c] for _, c in rows])
    changes = []
    for t, _ in rows:
        for s in t.split("."):
            words = fold_words(s.encode())
            for other in toxicity.swaps(words, groups):
                change = np.zeros(6)
                for sign, ws in ((1, other), (-1, words)):
                    for i in start.places(ws):
                        change[i] += sign
                changes.append(change)
    mean = np.mean([np.outer(c, c) for c in changes], axis=0)
    assert squares == pytest.approx(mean)
    p = 1 / (1 + np.exp(-x @ got.weights))
    gradient = (x.T @ (w * (p - y)) + np.r_[got.weights[:-1], 0]) / w.sum() + 2 * 0.3 * mean @ got.weights
    assert np.abs(gradient).max() < 1e-3


def test_swaps_replace_every_mention():
    found = list(toxicity.swaps([b"deaf", b"people", b"deaf"], [[b"people", b"deaf", b"blind"], [b"old", b"young"]]))
    assert sorted(found) == sorted([[b"people"] * 3, [b"blind", b"people", b"blind"], [b"deaf"] * 3, [b"deaf", b"blind", b"deaf"]])


def test_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    got = toxicity.toxicity_scores(docs, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == docs.count()
    cells = {(r["toxic"], r["predicted"]): r["count"] for r in
             got.where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()}
    assert cells[1, 1] >= 0.85 * (cells[1, 1] + cells.get((1, 0), 0)) > 80
    assert cells.get((0, 1), 0) <= 0.01 * cells[0, 0]


def test_awkward_rows(spark):
    rows = [(None, None), (1, ""), (2, "a b"), (2, "other text"), (2, "a b"), (3, "x " * 200_000), (4, "�\x00 é")]
    docs = spark.createDataFrame([(i, t, 1.0, True, "l") for i, t in rows], "doc_id long, text string, score double, held_out boolean, label string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity_scores(docs, labels).collect()} == {0.5}
    same = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, None), (77, 0), (None, 0)], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity_scores(docs, same).collect()} == {1.0}
    both = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0)], "doc_id long, toxic int")
    got = toxicity.toxicity_scores(docs, both).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.toxicity_scores(docs.limit(0), both).count() == 0


def test_copies_teach_once_and_the_sample_is_bounded(spark):
    docs = spark.createDataFrame([(i, "same text" if i % 2 else f"text {i}") for i in range(400)], "doc_id long, text string")
    labels = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    found, weight = toxicity.training_sample(docs, labels, "doc_id", "text", "toxic", 2, 4, 60)
    sizes = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    assert found.where("body = cast('same text' as binary)").count() == 1
    assert sizes[1] <= 40 and 10 < sizes[0] < 80 and weight[1] == 1.0 and 4 < weight[0] < 7
