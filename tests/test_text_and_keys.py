"""Text and key helpers on hand-made rows with nulls, blanks and odd spellings."""

import re
from html import unescape
from html.entities import html5

from pyspark.sql import functions as F

from leadgrid.functions import bands, keys, text


def C():  # columns need a running session
    return F.col("c")


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr.alias("x")).first()["x"]


def test_whitespace_includes_unicode_blanks(spark):
    assert one(spark, " a  b\t\nc ", text.normalize_space(C())) == "a b c"
    assert one(spark, None, text.normalize_space(C())) == ""


def test_norm_domain_spellings(spark):
    expr = keys.norm_domain(C())
    for raw in ("https://www.X.mx/a", "x.mx:80", " X.MX ", "http://x.mx"):
        assert one(spark, raw, expr) == "x.mx"
    for junk in ("me@x.mx", "..", "", None, "localhost", "x..mx", "-x.mx", "wa.me+52"):
        assert one(spark, junk, expr) is None


def test_norm_domain_sql_function_agrees(spark):
    keys.register_sql_functions(spark)
    df = spark.createDataFrame([(v,) for v in ("HTTPS://WWW.a-b.Com/x", "bad", None, "a.b:1")], "c string")
    same = df.select(keys.norm_domain(C()).alias("a"), F.expr("norm_domain(c)").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in same)


def test_domain_from_website(spark):
    expr = keys.domain_from_website(C())
    assert one(spark, "https://user@WWW.Acme.com:8080/about?x=1", expr) == "acme.com"
    assert one(spark, "acme.com/jobs", expr) == "acme.com"
    assert one(spark, "https://[broken-ipv6", expr) is None
    assert one(spark, "", expr) is None


def test_email_domain_and_safe_int(spark):
    assert one(spark, "A@B.com@c", keys.email_domain(C())) == "b.com@c"
    assert one(spark, "none", keys.email_domain(C())) is None
    assert one(spark, "18 employees", keys.safe_int(C())) == 18
    assert one(spark, "about 1,234 or 5", keys.safe_int(C())) == 1234
    assert one(spark, "many", keys.safe_int(C())) is None


def test_timestamps(spark):
    assert one(spark, "2024-05-01", keys.normalize_timestamp(C())) == "2024-05-01T00:00:00+00:00"
    assert one(spark, "yesterday", keys.normalize_timestamp(C())) == "yesterday"
    assert one(spark, "yesterday", keys.parse_timestamp(C())) is None
    assert one(spark, "2024-05-01T10:00:00Z", F.date_format(keys.parse_timestamp(C()), "HH:mm")) == "10:00"


def test_country_and_category_survive_bad_json(spark):
    assert one(spark, '{"addressCountry": " mx "}', keys.country_code_from_address(C())) == "MX"
    assert one(spark, "{broken", keys.country_code_from_address(C())) is None
    assert one(spark, "{broken", F.size(keys.parse_category(C()))) in (0, 1)
    assert one(spark, "[1, 2]", F.size(keys.parse_category(C()))) == 0
    assert one(spark, None, F.size(keys.parse_category(C()))) == 0


def test_terms_match_inside_words_unless_asked(spark):
    assert one(spark, "Transport and Support", text.matched_terms(C(), ["port", "sea"])) == ["port"]
    assert one(spark, "Transport and Support", text.matched_terms(C(), ["port"], word=True)) == []
    assert one(spark, "by port.", text.matched_terms(C(), ["port"], word=True)) == ["port"]
    assert one(spark, None, text.matched_terms(C(), ["port"])) == []


def test_evidence_rules(spark):
    quotes = F.array(F.lit("crédito"))
    assert one(spark, "Ofrecemos crédito.", text.evidence_is_exact(quotes, C(), F.lit("b2b")))
    assert not one(spark, "Ofrecemos crÃ©dito.", text.evidence_is_exact(quotes, C(), F.lit("b2b")))
    assert one(spark, "", text.evidence_is_exact(quotes, C(), F.lit("unclear")))
    both = F.array(F.lit("uno"), F.lit("dos"))
    assert not one(spark, "solo uno", text.evidence_is_exact(both, C(), F.lit("mixed")))


def test_extracted_evidence_is_part_of_the_source(spark):
    source = "We sell tools. You own outbound sales and cold email.\n• Lunch is free • Build the pipeline daily!"
    found = one(spark, source, text.extract_evidence(C(), ["outbound", "pipeline", "absent"], 12))
    assert found[0] == "You own outbound sales and cold email."
    assert all(text_part.strip() in " ".join(source.split()) or text_part in source for text_part in found)
    assert one(spark, source, F.size(text.extract_evidence(C(), ["outbound", "pipeline"], 1))) == 1


def test_evidence_windows_without_sentences(spark):
    source = "x" * 300 + " hunter " + "y" * 500
    found = one(spark, source, text.extract_evidence(C(), ["hunter"], 12))
    assert len(found) == 2 and all("hunter" in f for f in found)


def test_fragments_by_length(spark):
    source = "Short. This sentence is long enough to be kept as fragment! &amp; also this other one is kept &lt;here&gt;."
    assert one(spark, source, text.split_fragments(C())) == [
        "This sentence is long enough to be kept as fragment!", "& also this other one is kept <here>."]


def test_patterns_ignore_case_even_after_a_plain_group(spark):
    assert one(spark, "INFO desk", text.pattern_label(C(), [("hit", "(?:info|id)")])) == "hit"
    assert one(spark, "x", text.pattern_labels(C(), [("a", "X"), ("b", "y"), ("c", ".")]), "string") == ["a", "c"]


def test_word_edges_are_the_same_on_every_java(spark):
    given = ["çleç", "le", "a le.", "ale", "le_", "élé", "LE9", "le é"]
    df = spark.createDataFrame([(c,) for c in given], "c string")
    for rx in (r"\ble\b", r"(?i)\ble\b", r"le\B", r"\Ble", r"\\b|\ble"):
        got = df.select(F.get(text.pattern_labels(C(), [("hit", rx)]), F.lit(0)).alias("a"), text.any_pattern(C(), [rx]).alias("b"),
                        text.pattern_label(C(), [("hit", rx)]).alias("c")).collect()
        expected = [bool(re.search(rx, c, re.ASCII | re.IGNORECASE)) for c in given]
        assert [r["b"] for r in got] == [r["a"] == "hit" for r in got] == [r["c"] == "hit" for r in got] == expected, rx
    assert one(spark, "çleç", text.any_pattern(C(), [r"(?U)\ble\b"])) is False
    assert one(spark, "ç le ç", text.any_pattern(C(), [r"(?U)\ble\b"])) is True


def test_fragments_with_all_entities(spark):
    source = "Das ist ein l&auml;ngerer Satz, der ganz erhalten bleiben soll."
    assert one(spark, source, text.split_fragments(C(), decode=text.decode_entities)) == [
        "Das ist ein längerer Satz, der ganz erhalten bleiben soll."]


def test_entities(spark):
    assert one(spark, "a &amp;lt; b", text.decode_basic_entities(C())) == "a &lt; b"
    assert one(spark, "caf&eacute; &#39;x&#39;", text.decode_entities(C())) == "café 'x'"


def test_every_entity_as_browsers_read_it(spark):
    names = [f"&{n}" for n in html5] + [f"a&{n.rstrip(';')}b &{n.rstrip(';')}" for n in html5]
    numbers = [f"&#{n};&#x{n:X} &#X{n:x};" for n in (*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFF, 0x10FFFF, 0x110000, 10**9, 10**40)]
    odd = [None, "", "&", "&&amp;amp;&", "x &unknown; y", "&ampamp;", "&notit; &notin;", "&#; &#x; &#xg", "&#0000065;&#x00041", "a&\n&lt b", "&" + "q" * 40 + ";",
           "&eacute;" * 3000, "&\u00e9;&\U0001F600;", "no entity \U0001F600"]
    given = [*names, *numbers, *odd]
    df = spark.createDataFrame(list(enumerate(given)), "n int, c string").select("n", text.decode_entities(C()).alias("x"))
    assert "Python" not in df._jdf.queryExecution().toString()
    got = {r["n"]: r["x"] for r in df.collect()}
    assert [(c, got[n]) for n, c in enumerate(given) if got[n] != (c if c is None else unescape(c))] == []


def test_html(spark):
    page = "<title> A &amp; B </title><script>var x</script><nav>menu</nav><p>Hello&nbsp;<b>you</b></p>"
    assert one(spark, page, text.strip_html(C())) == "A & B Hello you"
    assert one(spark, page, text.strip_html(C(), min_chars=200)) is None
    assert one(spark, page, text.html_title(C())) == "A & B"
    long = "x" * 31
    assert one(spark, f'<meta name="description" content="short"><meta property="og:description" content="{long}">',
               text.meta_description(C())) == long


def test_buckets_and_bands(spark):
    for n, label in ((None, None), (0, "0"), (1, "1-2"), (2, "1-2"), (3, "3-10"), (50, "11-50"), (51, "50+")):
        assert one(spark, n, bands.count_bucket(C()), "int") == label
    for n, label in ((0, "0-1"), (1, "0-1"), (5, "2-5"), (6, "6-15"), (50, "16-50"), (51, "50+")):
        assert one(spark, n, bands.team_route(C()), "int") == label
    assert one(spark, -2.5, bands.round_half_up(C()), "double") == -2
    assert one(spark, 2.5, bands.round_half_up(C()), "double") == 3
    assert one(spark, 5.0, bands.bounce_band(C()), "double") == "red"


def test_top_key_and_midpoint(spark):
    assert one(spark, {"b": 3, "a": 3, "c": 1}, keys.top_key(C()), "map<string,int>") == "a"
    assert one(spark, "11-50", keys.headcount_midpoint(C())) == 30
    assert one(spark, "a lot", keys.headcount_midpoint(C())) is None
