"""Merkle manifests against a plain recomputation."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from leadgrid.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars int, text string, n long, rank string, leaf int, payload string, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes):
    """Root, and for each node its steps (left, right)."""
    steps, of = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i in range(len(steps)):
            run = of[i] // 3 * 3
            steps[i].append(("".join(nodes[run:of[i]]), "".join(nodes[of[i] + 1:run + 3])))
            of[i] //= 3
        nodes = [sha(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
    return nodes[0], steps


def brute(rows):
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        own = sorted(sources[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = (own, *grow([leaf_of(r) for r in own]))
    if not names:
        return []
    root, above = grow([trees[n][1] for n in names])
    out = []
    for name, upper in zip(names, above):
        own, subroot, steps = trees[name]
        for row, lower in zip(own, steps):
            i, text = row[0], row[4]
            if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            h = leaf_of((*row[:4], text))
            for left, right in lower + upper:
                h = sha(left, h, right)
            out.append((i, leaf_of(row), subroot, root, sha(*(a + b for a, b in lower + upper)), h, h == root))
    return sorted(out, key=repr)


def proven(spark, rows, **options):
    df = spark.createDataFrame([(*r, 1, "x", 2, "y", "z") for r in rows], SCHEMA)
    out = merkle.merkle_manifest(df, claimed=merkle.without_line_breaks(), **options).drop("steps")
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    names = [None, "", "a", "Z", "é", "\U0001F600", "ﬀ", "b"]
    ids = rng.sample(range(-500, 5000), sum(sizes))
    rows = []
    for name, size in zip(names, sizes):
        for _ in range(size):
            rows.append((ids.pop(), name, rng.choice([None, "de", ""]), rng.choice([None, 0, -7, 123]),
                         rng.choice([None, "", "one\ntwo\n", "é\n" * rng.randint(0, 9), "plain"])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("sizes", [[1], [2], [3, 1], [4, 3, 10], [1, 2, 3, 4, 9, 10, 27, 28], [0, 100, 0, 1, 1, 1, 1, 1]])
@pytest.mark.parametrize("depth", [2, 6])
def test_manifest_equals_recomputation(spark, sizes, depth):
    rows = rows_of(sizes)
    assert proven(spark, rows, depth=depth) == brute(rows)


def test_nulls_ties_repeated_rows_and_long_texts(spark):
    rows = rows_of([5, 0, 8]) + [(None, "a", "x", 1, "t\n"), (None, "a", "x", 1, "t\n"), (None, None, None, None, None),
                                 (7, "a", "x", 1, "one\n"), (7, "a", "x", 2, "two\n"), (7, "a", "x", 2, "two\n"),
                                 (8, "a", None, None, "line\n" * 200_000)]
    assert proven(spark, rows, depth=2) == brute(rows)
    assert proven(spark, []) == []


def test_a_hot_source_over_many_partitions(spark):
    rows = rows_of([3, 0, 900, 2]) + [(1, "b", "x", 1, "same\n")] * 400
    names = ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("false", "29")):
        spark.conf.set(n, v)
    try:
        assert proven(spark, rows, depth=3) == brute(rows)
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)


def test_other_fan_outs_fold_to_the_root(spark):
    df = spark.createDataFrame(rows_of([40, 3, 0, 9]), "doc_id long, source string, lang string, n_chars int, text string")
    for fan_out in (2, 5):
        got = merkle.merkle_manifest(df, fan_out=fan_out, depth=2)
        assert got.where(~F.col("verified")).count() == 0 and got.select("root").distinct().count() == 1
        assert got.select("proof_sha256").distinct().count() == 52


def test_a_block_is_rolled_up_in_one_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("string").alias("source"), (F.col("id") * 0 + 50).alias("n"), F.col("id").alias("rank"),
                                 F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"), F.col("id").alias("payload"))
    plan = merkle.rolled_up(df, "source", 3, 4, 0)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
