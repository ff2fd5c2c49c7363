"""The pipeline's stages against plain versions, and the registered queries."""

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from leadgrid.llm import decontam, mixing, quality, queries, simhash

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_stage_decisions_take_effect(spark, stages):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good, single, clean, mix, sharded = stages
    scores = quality.quality_scores(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(good) == sorted(r["doc_id"] for r in scores if r["score"] >= 0.5)
    groups = simhash.near_duplicates(good).collect()  # ids are unique here
    assert ids(single) == sorted({r["component_id"] for r in groups})
    hits = decontam.decontaminate(single, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert ids(clean) == sorted(r["doc_id"] for r in hits if not r["contaminated"])
    copies = mixing.mix(clean).collect()
    assert ids(mix) == sorted(r["doc_id"] for r in copies for _ in range(r["copies"]))
    assert ids(sharded) == ids(mix)
    for df in (good, single, clean, mix):
        assert df.columns == docs.columns
    assert 0 < sharded.count() and good.count() < docs.count()


def near(spark, rows):
    df = spark.createDataFrame([(*r, 5, 1.0, "g", b"s") for r in rows],
                               "doc_id long, text string, source string, n_chars int, hash double, group string, sketch binary")
    out = simhash.keep_first(df)
    assert out.columns == df.columns
    return sorted(((r["doc_id"], r["text"], r["source"]) for r in out.collect()), key=repr)


def test_near_duplicates_lose_no_text(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(60)) for w in "xyz")
    edited = a.replace("x30", "changed")
    rows = [(1, a, "s"), (7, edited, "copy"), (7, b, "clean"), (9, c, "s"), (9, c, "s"), (9, c, "t"), (None, c, "copy"), (None, a, "copy"),
            (3, None, "s"), (4, "", "copy"), (None, None, "copy"), (None, "only here without an id of its own", "n"),
            (None, "only here without an id of its own", "n")]
    got = near(spark, rows)
    assert [(i, t) for i, t, _ in got] == sorted([(1, a), (7, b), (9, c), (3, None), (None, "only here without an id of its own")], key=repr)
    assert near(spark, list(reversed(rows))) == got
    assert near(spark, []) == []


def test_stages_take_awkward_tables(spark, tmp_path):
    docs = spark.createDataFrame([(None, None, "a"), (1, "", None), (1, "a b c", "a"), (1, "a b c", "a"), (2, "word " * 50_000, "b"), (None, "d e", "b")],
                                 "doc_id long, text string, source string").selectExpr(
        "doc_id", "text", "'en' AS lang", "source", "cast(length(text) AS bigint) AS n_chars")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, str(tmp_path))
            assert name == "sharding" or out.columns == docs.columns
            assert out.count() >= (0 if rows is not docs else 1)


def test_exact_copies_go(stages):
    texts = [r["text"] for r in stages[1].collect()]
    assert len(texts) == len(set(texts))


def test_pipeline_equals_its_stages(spark, stages):
    assert sorted(map(repr, corpus_pipeline.run(spark, SF).collect())) == sorted(map(repr, stages[-1].collect()))


def test_every_operator_has_its_query():
    names = list(queries.QUERIES)
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    assert set(names) | {"pipeline"} <= set(entry_module.queries())
    assert set(queries.ORACLES) <= set(entry_module.oracle_sql())
