"""Every registered query against its SQL twin on the smallest data set."""

import pytest
import verify

import __spark_entry__ as entry_module

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry_module.oracle_sql()
QUERIES = entry_module.queries()


@pytest.fixture(scope="module")
def con():
    return verify.connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    result = verify.compare(QUERIES[name](spark, FOLDER), con, ORACLES[name])
    assert result.startswith("ok"), result


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry_module.entry(spark).count() == 1


def test_registry_is_complete():
    assert len(QUERIES) > 190
    assert set(ORACLES) <= set(QUERIES)


def test_decoded_titles_equal_sql_whatever_they_hold(spark, tmp_path):
    titles = ["a &lt;b&gt; &#39;c&#39;", "&quot;q&quot; &nbsp; &eacute;", "x&amp", "&amp;lt; &amp;amp; &&amp;&", "&lt &#039; &#x27; &LT; &ltx;", "&#39;9; &#399;", None, ""]
    pages = [(n, None if c is None else f"<title>{c}</title>") for n, c in enumerate(titles)]
    spark.createDataFrame(pages, "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    result = verify.compare(QUERIES["decode_entities"](spark, str(tmp_path)), verify.connect(str(tmp_path)), ORACLES["decode_entities"])
    assert result == f"ok {len(titles)} rows", result
