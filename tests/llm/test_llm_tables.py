"""Top-k search, archives, mixing, sharding and the trained operators."""

import gzip
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from leadgrid.llm import langid, mixing, quality, queries, shards, topk, warc
from leadgrid.session import fresh_path

SF = "/root/testdata/sf0.01"


# --- top k

def brute_top(rows, k, every):
    cells = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in cells:
        if q % every == 0:
            scored = [(-max(-2 ** 63 + 1, min(2 ** 63 - 1, sum(x * y for x, y in zip(a, b)))), i)
                      for i, b in cells if i != q and len(a) == len(b)]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"shard_rows": 16, "query_rows": 5, "fan_in": 2}])
def test_top_k_equals_brute_force(spark, options):
    rng = random.Random(2)
    rows = [(rng.choice([i, i, -i]), [rng.choice([-0.5, 0.0, 0.01, 0.25]) for _ in range(3)]) for i in range(150)]
    rows += [(500, None), (505, [1.0, None, 2.0]), (510, [float("nan")] * 3), (515, [float("inf"), 1.0, 1.0]),
             (None, [1.0, 1.0, 1.0]), (520, [1.0, 2.0]), (525, [2.0, 1.0]), (530, []), (535, []), (540, [1e30, 1.0, 1.0]),
             (545, [-1e30, 1.0, 0.0]), (5, [0.25, 0.25, 0.25]), (5, [-0.5, 0.25, 0.25]), (6, [0.25, 0.25, 0.25])]
    rows += [(10, [0.5, 0.5, 0.5])] * 30
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                               "vec_id long, embedding array<double>, key int, vector string")
    got = topk.top_k(df, F.col("vec_id") % 5 == 0, k=7, **options)
    assert sorted(tuple(r) for r in got.collect()) == brute_top(rows, 7, 5)


def test_top_k_of_nothing(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(empty, F.col("vec_id") % 20 == 0).count() == 0


# --- archives

PAGES = [(1, "http://a/1", "<p>same</p>"), (7, "http://a/7", "<p>same</p>"), (3, None, "<p>same</p>"),
         (4, "http://b/ \r\nX: y", "é" * 5000), (5, "http://b", None), (6, "http://c", ""), (None, "http://n", "none"),
         (8, "http://d", "twice"), (8, "http://d", "twice"), (None, "http://n", "<p>same</p>")]


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", b"y") for r in rows],
                                 "page_id long, url string, html string, refers_to string, body binary")


def test_archive_round_trip(spark):
    root = fresh_path(spark, "warc-test")
    manifest = warc.write_archive(pages(spark, PAGES), root, file_bytes=200, shard_bytes=3000).collect()
    got = warc.read_archive(spark, root).collect()
    assert sum(m["records"] for m in manifest) == len(PAGES) == len(got)
    payload = {(p or -1, h or "") for p, _, h in PAGES}
    top = {h: max(i or -1 for i, x in payload if x == h) for _, h in payload}
    want = sorted((i, len(h.encode()), warc.base32_sha1(h.encode()), "response" if i == top[h] else "revisit",
                   None if i == top[h] else top[h]) for p, _, x in PAGES for i, h in [(p or -1, x or "")])
    assert sorted(((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"])
                   for r in got), key=repr) == sorted(want, key=repr)
    texts = {r["page_id"]: bytes(r["payload"]).decode() for r in got if r["record_type"] == "response"}
    assert texts[4] == "é" * 5000 and texts[7] == "<p>same</p>"
    store, base = fs.FileSystem.from_uri(root)
    names = {m["name"] for m in manifest}
    assert len(names) == len(manifest) > 1
    for m in manifest:
        with store.open_input_stream(f"{base}/{m['name']}", compression=None) as source:
            data = source.read()
        assert len(data) == m["bytes"] and gzip.decompress(data).count(b"WARC/1.1\r\n") == m["records"]


def test_archive_is_the_same_in_every_run(spark):
    rows = [(i, f"http://h/{i}", f"page {i % 37} " * 50) for i in range(400)]
    files = []
    for parts in (1, 7):
        root = fresh_path(spark, "warc-test")
        manifest = warc.write_archive(pages(spark, rows).repartition(parts), root, file_bytes=4000, shard_bytes=40_000)
        files.append(sorted((m["name"], m["sha256"]) for m in manifest.collect()))
        again = spark.read.parquet(f"{root}/manifest")
        assert again.count() == len(files[-1])
    assert files[0] == files[1] and len(files[0]) > 5


def test_archive_without_small_revisits_and_of_nothing(spark):
    root = fresh_path(spark, "warc-test")
    warc.write_archive(pages(spark, PAGES), root, revisit_bytes=100)
    assert {r["record_type"] for r in warc.read_archive(spark, root).collect()} == {"response"}
    root = fresh_path(spark, "warc-test")
    assert warc.write_archive(pages(spark, []), root).count() == 0
    assert warc.read_archive(spark, root).count() == 0


# --- mixing

def mixed_rows():
    rng = random.Random(3)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([1, 5, 30, 200]))),
             rng.choice(["a", "b", "b", "b", "b", "c", "d", None])) for i in range(3000)]
    return rows + [(None, "no id", "a"), (7, rows[7][1], rows[7][2]), (9000, None, "a"), (9001, "", "only empty"),
                   (9002, "tiny source", "z")]


def mixed(spark, rows):
    return spark.createDataFrame([(*r, 5, "x", 1.0) for r in rows],
                                 "doc_id long, text string, source string, size long, place string, u double")


def test_mix_meets_its_targets(spark):
    rows = mixed_rows()
    got = mixing.mix(mixed(spark, rows)).collect()
    assert len(got) == len(rows)
    total = sum(len((t or "").split()) for _, t, _ in rows)
    by_source = {}
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    names = sorted((s for s in by_source if s is not None)) + [None]
    own = {s: sum(r["size"] for r in by_source[s]) for s in names}
    target, capped = {}, set()
    while True:  # reshare until none is above three times its size
        free = [s for s in names if s not in capped]
        rest = total - sum(3 * own[s] for s in capped)
        weight = {s: names.index(s) % 3 + 1 for s in free}
        target = {s: 3 * own[s] if s in capped else rest * weight[s] / sum(weight.values()) for s in names}
        above = {s for s in free if target[s] > 3 * own[s]}
        if not above:
            break
        capped |= above
    for s in names:
        assert by_source[s][0]["target"] == pytest.approx(target[s])
        assert sum(r["taken"] for r in by_source[s]) == pytest.approx(target[s], rel=0.01, abs=8)
    for s in names:
        lacking(by_source[s])
    again = mixing.mix(mixed(spark, rows).repartition(5)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def lacking(mine):
    """What a source lacks: nothing that was left would have fitted."""
    gap = mine[0]["target"] - sum(r["taken"] for r in mine)
    share = mine[0]["target"] / max(1, mine[0]["source_size"])
    left = [r["size"] for r in mine if r["copies"] == math.floor(share) and share % 1]
    assert -1e-6 <= gap and (not left or gap < min(left))
    return gap


@pytest.mark.parametrize("seed", range(3))
def test_small_sources_are_filled_as_far_as_a_document_fits(spark, seed):
    rng = random.Random(seed)
    rows = [(100 * s + i, "w " * (20_000 if i == 0 and s < 4 else rng.choice([3, 50, 700])), f"s{s}") for s in range(12) for i in range(10)]
    got = mixing.mix(mixed(spark, rows)).collect()
    for s in {r["source"] for r in got}:
        lacking([r for r in got if r["source"] == s])
    text = queries.ORACLES["op8_mix_sources"]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    want = sorted((r[0], r[4]) for r in con.sql(text).fetchall())
    assert sorted((r["doc_id"], r["taken"]) for r in got) == want


def test_inclusion_weights_make_unequal_probabilities(spark):
    rows = [(i, "w " * (1 + i % 7), "only" if i % 3 else "other", [0.0, 1.0, 4.0, 40.0, None][i % 5]) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, pull double")
    got = mixing.mix(df, weight=lambda place: F.lit(1.0), inclusion=F.col("pull")).collect()
    pull = {i: w or 0.0 for i, _, _, w in rows}
    for source in ("only", "other"):
        mine = [r for r in got if r["source"] == source]
        assert sum(r["taken"] for r in mine) == pytest.approx(mine[0]["target"], rel=0.01)
        low, high = 0.0, 10.0
        for _ in range(60):  # the scale at which the expected words are the target
            c = (low + high) / 2
            words = sum(r["size"] * min(3, c * pull[r["doc_id"]]) for r in mine)
            low, high = (c, high) if words < mine[0]["target"] else (low, c)
        for w in (0.0, 1.0, 4.0, 40.0):
            mean = np.mean([r["copies"] for r in mine if pull[r["doc_id"]] == w])
            assert mean == pytest.approx(min(3, c * w), abs=0.08)
    assert mixing.repeat_by_mix(df, weight=lambda place: F.lit(1.0), inclusion=F.col("pull")).count() == sum(r["copies"] for r in got)


def test_repeated_rows_are_the_mix(spark):
    rows = mixed_rows()
    df = mixed(spark, rows)
    out = mixing.repeat_by_mix(df)
    assert out.columns == df.columns
    copies = mixing.mix(df).agg(F.sum("copies")).first()[0]
    assert out.count() == copies


def test_mix_of_nothing(spark):
    assert mixing.mix(mixed(spark, [])).count() == 0
    assert mixing.repeat_by_mix(mixed(spark, [])).count() == 0


# --- sharding

def test_shards(spark):
    rows = [(i, f"text é {i}") for i in range(4000)] + [(None, None), (None, "x"), (3, "text é 3"), (5000, "")]
    df = spark.createDataFrame([(*r, 9, "s") for r in rows], "doc_id long, text string, shard int, slot string")
    weights = [1.0] * 15 + [3.0]
    got = shards.shard_documents(df, weights).collect()
    assert len(got) == len(rows)
    per_shard, of_key = {}, {}
    for r in got:
        body = (r["text"] or "").encode()
        assert r["size"] == len(body) + 1 and r["text_crc32"] == zlib.crc32(body)
        assert r["grown_shard"] in (r["shard"], 16)
        assert of_key.setdefault(r["doc_id"], r["shard"]) == r["shard"]
        per_shard.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in per_shard.values())
    heavy = len(per_shard.pop(15))
    assert 500 < heavy < 850 and all(150 < len(s) < 300 for s in per_shard.values())
    assert 100 < sum(r["grown_shard"] == 16 for r in got) < 400
    assert shards.shard_documents(df.limit(0), weights).count() == 0


# --- trained operators

def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "labels"))
    got = quality.quality_scores(docs, labels)
    assert got.count() == docs.count()
    judged = got.where("held_out").join(labels, "doc_id")
    right = judged.where("predicted = quality").count()
    assert right >= 0.97 * judged.count() > 50
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == got.where("predicted = 1").count()


def test_quality_without_labels_and_with_awkward_rows(spark):
    docs = spark.createDataFrame([(None, None, 1.0), (1, "", 2.0), (2, "a b", None), (2, "a b", None), (3, "x" * 200_000, 0.0)],
                                 "doc_id long, text string, score double")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, labels).collect()} == {0.5}
    same = spark.createDataFrame([(1, 1), (2, 1), (3, None), (77, 0)], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, same).collect()} == {1.0}
    assert quality.quality_scores(docs.limit(0), same).count() == 0


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(1)
    n = rng.integers(0, 5, 40)
    positive = rng.binomial(n, np.linspace(0.1, 0.9, 40))
    curve = quality.isotonic(n, positive)
    assert (np.diff(curve) >= -1e-12).all()
    filled = n > 0
    # Min-max formula of isotonic regression.
    want = [max(min(positive[a:b + 1].sum() / n[a:b + 1].sum() for b in range(i, 40) if n[a:b + 1].sum())
                for a in range(i + 1) if n[a:i + 1].sum()) for i in np.flatnonzero(filled)]
    assert curve[filled] == pytest.approx(want)


def test_random_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    n, gamma, width = quality.N_STATS, 0.05, 8192
    model = quality.Model(np.zeros(n), np.ones(n), rng.normal(0, math.sqrt(2 * gamma), (n, width)),
                          rng.uniform(0, 2 * math.pi, width), np.zeros(1), 0, 1, np.zeros(1))
    x = rng.normal(0, 1, (6, n))
    z = model.features(x)[:, :width]
    distance = ((x[:, None] - x) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-gamma * distance)).max() < 0.06


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs)
    judged = got.where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert judged.where("lang_pred = lang").count() >= 0.97 * judged.count() > 100
    assert all(0 <= r["score"] <= 1 for r in got.collect())


def test_language_of_awkward_rows(spark):
    rows = [(i, "the cat and the dog", "en") for i in range(20)] + [(100 + i, "der Hund und die Katze", "de") for i in range(20)]
    rows += [(None, "the dog", None), (200, None, "en"), (201, "", "de"), (202, "12 -- !", "en"), (203, "und die Katze", None),
             (203, "und die Katze", None), (204, "the cat " * 20_000, None)]
    df = spark.createDataFrame([(*r, "u", 1.0) for r in rows],
                               "doc_id long, text string, lang string, lang_pred string, score double")
    got = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert len(got) == len(rows) - 1
    assert [got[i]["lang_pred"] for i in (None, 200, 201, 202, 203, 204)] == ["en", "und", "und", "und", "de", "en"]
    assert langid.identify(df.limit(0)).count() == 0
    unknown = langid.identify(df.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}


@pytest.mark.parametrize("repeated", [1, 2, 3, 4])
def test_language_sample_counts_repeated_rows_once(spark, repeated):
    rows = [(repeated, "the cat and the dog", "en")] * 60 + [(repeated, f"the dog {i}", "en") for i in range(30)]
    rows += [(100 + i, "der Hund und die Katze", "de") for i in range(20)]
    df = spark.createDataFrame([(i, t.encode(), n) for i, t, n in rows], "key long, body binary, lang string")
    _, found = langid.learn(df, 100, 5, 1.1, 0.01)  # more centroids than texts: one for each text taken
    assert {n: len([c for c in found if c[0] == n]) for n in ("de", "en")} == {"de": 5, "en": 5}


def test_rejection_by_distance(spark):
    rows = [(i, f"the cat {w} and the dog", "en") for i, w in enumerate(["sat", "ran", "ate", "hid"] * 10)]
    rows.append((1000, "zxq vvkj qqzx xxjk", None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.identify(df).collect()}
    assert got[1000]["rejected"] and got[1000]["lang_pred"] == "en" and not got[1]["rejected"]


def test_ngrams_of_long_texts_cross_the_steps(monkeypatch):
    text = ("abc déf " * 50).encode()
    whole = langid.ngram_counts(text)
    monkeypatch.setattr(langid, "_STEP", 16)
    assert (langid.ngram_counts(text) == whole).all()
