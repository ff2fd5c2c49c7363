"""Keyed tables in a store: only the buckets of the keys of a batch are read and replaced."""

import hashlib
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leadgrid.sources import keyed, tables
from leadgrid.streaming.store import Store

KIND = "k long, x string, y int"


@pytest.fixture
def people(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    base = spark.createDataFrame([(i, f"p{i}", i) for i in range(400)], KIND)
    keyed.create(store, "people", base, ["k"], 32)
    return store, base


def bytes_of(store):
    return {f: hashlib.sha256(f.read_bytes()).hexdigest() for f in Path(store.path, "people").rglob("*.parquet")}


def test_an_update_of_one_key_leaves_the_other_files_unread_and_unchanged(spark, people):
    store, base = people
    only = keyed.read(store, "people", base, base.where("k = 7").select("k"))
    assert {Path(f).parent.name for f in only.inputFiles()} != {Path(f).parent.name for f in keyed.read(store, "people", base).inputFiles()}
    near = {r["k"] for r in only.collect()}
    before = bytes_of(store)
    mine = {f for f in before if any(f.samefile(Path(n.removeprefix("file://"))) for n in only.inputFiles())}
    # Junk in all other files: reading any of them would fail.
    kept = {f: f.read_bytes() for f in before if f not in mine}
    for f in kept:
        f.write_bytes(b"junk")
    keyed.upsert(store, "people", base, spark.createDataFrame([(7, "new")], "k int, x string"), ["k"])
    assert all(f.read_bytes() == b"junk" for f in kept)
    for f, data in kept.items():
        f.write_bytes(data)
    assert {f: h for f, h in bytes_of(store).items() if f in kept} == {f: before[f] for f in kept}
    now = {r["k"]: (r["x"], r["y"]) for r in keyed.read(store, "people", base).collect()}
    assert now == {i: (f"p{i}" if i != 7 else "new", i) for i in range(400)} and 7 in near and len(near) < 60


def test_batches_give_what_the_whole_table_would(spark, people):
    store, base = people
    now, rng = base, random.Random(5)
    for _ in range(4):
        ks = rng.sample(range(600), 25)
        new = spark.createDataFrame([(k, None if k % 5 == 0 else f"n{rng.random()}") for k in ks], "k int, x string")
        now = spark.createDataFrame(tables.upsert(now, new, ["k"]).collect(), KIND)
        keyed.upsert(store, "people", base, new, ["k"])
        assert rows(keyed.read(store, "people", base)) == rows(now)
    assert len(list(Path(store.path, "manifest").glob("*.json"))) <= 2


def test_a_batch_that_comes_again_changes_nothing(spark, people):
    store, base = people
    new = spark.createDataFrame([(3, "a", 1), (3, "b", 2), (900, "c", 1)], "k int, x string, at int")
    keyed.upsert(store, "people", base, new, ["k"], "at", number=5)
    keyed.upsert(store, "people", base, new.withColumn("x", F.lit("other")), ["k"], "at", number=5)
    keyed.upsert(store, "people", base, new.limit(0), ["k"], "at")
    got = {r["k"]: r["x"] for r in keyed.read(store, "people", base).where("k in (3, 900)").collect()}
    assert got == {3: "b", 900: "c"}
    with pytest.raises(Exception, match="repeated"):
        keyed.upsert(store, "people", base, new.drop("at"), ["k"])
    assert keyed.read(store, "people", base).count() == 401


def test_patch_stamps_known_rows_and_adds_none(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    base = spark.createDataFrame([(i, i, None) for i in range(50)] + [(None, 9, None)], "k int, y int, updated_at date")
    keyed.create(store, "t", base, ["k"], 8)
    stamp = F.lit("2024-05-01").cast("date")
    changes = spark.createDataFrame([(4, None), (5, 55), (77, 1), (None, 3)], "k long, y int")
    keyed.patch(store, "t", base, changes, "k", stamp)
    assert rows(keyed.read(store, "t", base)) == rows(tables.patch(base, changes.withColumn("k", F.col("k").cast("int")), "k", stamp))
    with pytest.raises(ValueError):
        keyed.create(store, "t", base, ["k"], 8)


def test_an_empty_table_takes_updates(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    base = spark.createDataFrame([], KIND)
    keyed.create(store, "people", base, ["k"], 4)
    keyed.upsert(store, "people", base, spark.createDataFrame([(1, "a", 2)], KIND), ["k"])
    assert rows(keyed.read(store, "people", base)) == [(1, "a", 2)]
