"""Hard-negative mining against brute force over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadgrid.llm import hardneg, queries

SCHEMA = "vec_id long, embedding array<double>, label long, key string, row int, vector double"


def cut(score):
    return max(-2 ** 63 + 1, min(2 ** 63 - 1, score))


def brute(rows, every, k=5, scale=256):
    limit = int(np.finfo(np.float64).max)
    kept = [(i, [max(-limit, min(limit, math.floor(scale * x) if math.isfinite(scale * x) else int(math.copysign(limit, x)))) for x in v], c)
            for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, x, label in kept:
        if a % every:
            continue
        scored = sorted((-cut(sum(p * q for p, q in zip(x, y))), i, c) for i, y, c in kept if i != a and len(x) == len(y))
        for s, positive, _ in [t for t in scored if t[2] == label][:k]:
            window = [(i, -n) for n, i, c in scored if c != label and 80 * -s <= 100 * -n <= 100 * -s][:k]
            out += [(a, positive, r, i, -s, n) for r, (i, n) in enumerate(window, 1)]
    return sorted(out)


def mined(spark, rows, every, **options):
    df = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hardneg.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect())


def crowd(seed, n=260, dim=6):
    rng = random.Random(seed)
    centers = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    rows = []
    for i in range(n):
        c = rng.randrange(5)
        rows.append((rng.choice([i, i, i, rng.randrange(n)]), [x + rng.gauss(0, 0.4) for x in centers[c]],
                     rng.choice([c, c, rng.randrange(5)])))
    # One label holds a third of all rows; some rows are equal, so scores tie.
    return rows + [(1000 + i, centers[0], i % 2) for i in range(12)] + [(2000 + i, centers[1], 4) for i in range(130)]


AWKWARD = [(None, [1.0] * 6, 1), (3000, None, 1), (3005, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (3010, [math.inf] * 6, 2),
           (3015, [math.nan] * 6, 2), (3020, [1.0] * 6, None), (3025, [], 1), (3030, [], 2), (3035, [1.0, 2.0], 1), (3040, [2.0, 1.0], 2),
           (3045, [1.0, 1.0], 1), (3050, [0.0] * 6, 1), (3055, [-0.0] * 6, 2)]


@pytest.mark.parametrize("options", [{}, {"shard_rows": 40, "anchor_rows": 9, "fan_in": 2}])
def test_hard_negatives_equal_brute_force(spark, options):
    rows = crowd(1) + AWKWARD
    want = brute(rows, 5)
    assert mined(spark, rows, 5, **options) == want and len(want) > 300


def test_huge_components_are_exact(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1e30, 3.0, -1e12, 0.0]), rng.choice([5.0, 1e9, 1e308])], i % 3) for i in range(40)]
    assert mined(spark, rows, 4) == brute(rows, 4)
    rows = [(i, [float(rng.randrange(2 ** 20)), float(rng.randrange(2 ** 20))], i % 3) for i in range(40)]
    assert mined(spark, rows, 4) == brute(rows, 4)


def test_no_rows_no_anchors_one_label(spark):
    assert mined(spark, [], 5) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)], 5) == []
    assert mined(spark, [(5, [1.0], 1), (6, [1.0], 1), (7, [0.9], 1)], 5) == []
    assert mined(spark, [(5, [1.0], 1), (6, [1.0], 1), (7, [0.9], 2)], 5) == [(5, 6, 1, 7, 65536, 58880)]


def test_index_leaves_postings_out_and_grows(spark):
    rng = np.random.default_rng(3)
    cells = np.floor(256 * rng.normal(0, 0.125, (500, 64)))
    cells[:50] *= 0.1
    shard = hardneg.Shard(np.arange(500), np.zeros(500, np.int64), cells, np.argsort(-(cells ** 2).sum(axis=0)))
    query = np.floor(256 * rng.normal(0, 0.125, 64))
    rest = np.sqrt(np.r_[np.cumsum((query ** 2)[::-1])[::-1], 0.0])
    before = None
    for threshold in (40_000, 20_000, 5_000):
        shard.extend(threshold, rest)
        assert before is None or (shard.depth >= before).all()
        before = shard.depth
        at, score = shard.join(query, rest, threshold, np.ones(500, bool))
        exact = query @ shard.columns
        assert at.tolist() == np.flatnonzero(exact >= threshold).tolist() and (score == exact[at]).all()
        if threshold >= 20_000:
            assert shard.depth.mean() < 64 and (shard.depth[:50] == 0).all()  # short rows are never met


def test_the_query_relabels(spark):
    sf = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.op12_hard_negatives(spark, sf).collect())
    rows = [(r["vec_id"], r["embedding"], None if r["label"] is None else (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert got == brute(rows, 100)
