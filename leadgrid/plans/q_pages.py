"""Queries over crawled pages, file sources and the profile queue."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions.keys import domain_from_website
from leadgrid.functions.text import strip_html
from leadgrid.operators import crawl, pages
from leadgrid.plans import vocab
from leadgrid.plans.q_text import _strip_sql
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import hits, quoted
from leadgrid.session import fresh_path
from leadgrid.sources import files, provider, tables


@query("profileable", f"""SELECT page_id, CASE WHEN length(body) = 0 THEN 'no_clean_text' WHEN length(body) < 300 THEN 'thin_text' END AS reason
    FROM (SELECT page_id, {_strip_sql('html')} AS body FROM pages UNION ALL SELECT -1 - page_id, '' FROM pages)""")
def profileable(t):
    # Every page once more without any text.
    bodies = t("pages").select("page_id", strip_html(F.col("html")).alias("body"))
    bodies = bodies.unionByName(t("pages").select((-1 - F.col("page_id")).alias("page_id"), F.lit("  ").alias("body")))
    return bodies.select("page_id", pages.profileable(F.col("body")).alias("reason"))


_CATS = "concat_ws(',', " + ", ".join(f"CASE WHEN regexp_matches(body, '(?i){rx}') THEN '{n}' END" for n, rx in vocab.PAGE_CATEGORIES) + ")"


@query("page_categories", f"SELECT page_id, {_CATS} AS categories FROM (SELECT page_id, {_strip_sql('html')} AS body FROM pages)")
def page_categories(t):
    got = pages.page_categories(strip_html(F.col("html")), vocab.PAGE_CATEGORIES)
    return t("pages").select("page_id", F.array_join(got, ",").alias("categories"))


@query("crawl_is_enough", f"""SELECT page_id, page_id % 5 <> 0 AND length(trim(body)) >= 300 AND regexp_matches(body, '(?i){vocab.PAGE_CATEGORIES[0][1]}')
    AND regexp_matches(body, '(?i){vocab.PAGE_CATEGORIES[1][1]}') AS enough FROM (SELECT page_id, {_strip_sql('html')} AS body FROM pages)""")
def crawl_is_enough(t):
    rows = t("pages").select("page_id", strip_html(F.col("html")).alias("body"))
    return rows.select("page_id", pages.crawl_is_enough(
        F.col("page_id") % 5 != 0, F.col("body"), pages.page_categories(F.col("body"), vocab.PAGE_CATEGORIES)).alias("enough"))


_KEY = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(url, '#.*$', ''),
    '([?&])(?:utm_[^=&#]*|_ga|gclid|fbclid|ref)=[^&#]*', '\1', 'g'), '&{2,}', '&', 'g'), '\?&+', '?', 'g'), '[?&]+$', '')"""


@query("same_page_key", f"SELECT page_id, {_KEY} AS page_key FROM pages QUALIFY row_number() OVER (PARTITION BY {_KEY} ORDER BY page_id) = 1")
def same_page_key(t):
    return pages.distinct_pages(t("pages").select("page_id", "url"), "url", "page_id", (*pages.TRACKING, "ref")) \
        .select("page_id", "page_key")


def _replaced(steps) -> str:
    out = "html"
    for pattern, text in steps:
        out = f"regexp_replace({out}, '{pattern}', {text}, 'g')"
    return out


# Tags with quotes of either kind, then images by the order of their attributes, links, and what ends a line.
_MD = _replaced([
    ("(?is)<(?:script|style|noscript)[^>]*>.*?</(?:script|style|noscript)>|(?s)<!--.*?-->", "' '"), ("[\\t\\n\\r\\f ]+", "' '"),
    ("(?i)\\b(src|alt|href) *= *''([^''<>]*)''", "'\\1=\"\\2\"'"),
    ('(?i)<img[^>]*alt="([^"]*)"[^>]*src="([^" ]*)"[^>]*>', "'![\\1](\\2)'"),
    ('(?i)<img[^>]*src="([^" ]*)"[^>]*alt="([^"]*)"[^>]*>', "'![\\2](\\1)'"), ('(?i)<img[^>]*src="([^" ]*)"[^>]*>', "'![](\\1)'"),
    ("(?i)</?(?:b|strong|i|em|u|span|small|font|mark)(?: [^>]*)?>", "' '"),
    ('(?i)<a [^>]*href="([^" ]*)"[^>]*>([^<]*)</a>', "'[\\2](\\1)'"),
    ("(?i)</?(?:p|div|li|ul|ol|h[1-6]|tr|table|article|section|nav|footer|header|title|br|body|head)[^>]*>", "chr(10)"), ("<[^>]+>", "' '")])
_HOST = r"regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#:]+)', 1), '^www\.', '')"


def markdown(t):
    return t("pages").select("page_id", domain_from_website(F.col("url")).alias("site"), F.col("url").alias("path"),
                             pages.page_markdown(F.col("html")).alias("markdown"))


@query("evidence_links", f"""WITH m AS (SELECT page_id, {_MD} AS md FROM pages),
    a AS (SELECT page_id, regexp_extract_all(md, '!\\[([^\\]]*)\\]\\(([^)\\s]*)\\)', 1) AS alt, regexp_extract_all(md, '!\\[([^\\]]*)\\]\\(([^)\\s]*)\\)', 2) AS src,
      regexp_extract_all(md, '(?:^|[^!])\\[([^\\]]+)\\]\\(([^)\\s]*)\\)', 1) AS tx, regexp_extract_all(md, '(?:^|[^!])\\[([^\\]]+)\\]\\(([^)\\s]*)\\)', 2) AS hr FROM m),
    l AS (SELECT page_id, list_transform(list_zip(tx, hr), lambda z: z[1] || '>' || z[2]) AS z FROM a)
    SELECT page_id, len(alt)::INTEGER AS n_images, array_to_string(alt[1:5], '|') AS first_images,
      array_to_string(list_filter(l.z, lambda q: len({hits('q', ('tion', 'ander', 'the'))}) > 0 OR regexp_matches(lower(q), '\\.pdf([?#]|$)')), '|') AS links
    FROM a JOIN l USING (page_id)""")
def evidence_links(t):
    rows = markdown(t).select("page_id", pages.evidence_links(F.col("markdown"), ("tion", "ander", "the")).alias("e"))
    return rows.select(
        "page_id", F.size("e.visual_assets").alias("n_images"),
        F.array_join(F.transform(F.slice("e.visual_assets", 1, 5), lambda x: x["alt"]), "|").alias("first_images"),
        F.array_join(F.transform("e.evidence_links", lambda x: F.concat(x["text"], F.lit(">"), x["url"])), "|").alias("links"))


_USEFUL = (("offer", r"that|sch|que"), ("proof", r"\d{2}"))
_LEGAL = ("/fr/", "/de/")
_LINES = rf"""raw AS (SELECT page_id, {_HOST} AS site, len({hits('url', _LEGAL)}) > 0 AS is_legal, unnest(string_split_regex({_MD}, '\r?\n')) AS r,
      unnest(range(len(string_split_regex({_MD}, '\r?\n')))) AS pos FROM pages),
    vis AS (SELECT * EXCLUDE (r), trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(r, '!\[([^\]]*)\]\(([^)\s]*)\)', 'Image: \1 ', 'g'),
      '\[([^\]]*)\]\(mailto:([^)?\s]*)[^)]*\)', '\1 \2', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '^[\s#>*]+|[*_`]{{2,}}', ' ', 'g'), chr(160), ' '), '\s+', ' ', 'g')) AS line FROM raw),
    lines AS (SELECT *, starts_with(line, 'Image:') AS is_image FROM vis WHERE line <> '' AND NOT list_contains(['inicio', 'home', 'menu', 'menú', 'nombre', 'mensaje', 'enviar', 'name', 'message', 'send',
      'submit', 'search', 'buscar', 'login', 'leer más', 'read more', 'the'], lower(line)) AND line <> 'Image:')"""


def useful_lines(t):
    return pages.page_lines(markdown(t), "site", "page_id", "markdown", (*pages.NOISE, "the"), _LEGAL)


@query("page_lines", f"WITH {_LINES} SELECT page_id, pos::INTEGER AS pos, site, is_legal, is_image, line FROM lines")
def page_lines(t):
    return useful_lines(t)


@query("clean_page_lines", rf"""WITH {_LINES},
    p AS (SELECT *, CASE WHEN is_legal THEN 2 WHEN regexp_matches(line, '(?i)that|sch|que') OR regexp_matches(line, '\d{{2}}') THEN 0 ELSE 1 END AS rank FROM lines),
    f AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY site, lower(line) ORDER BY rank, page_id, pos) = 1),
    g AS (SELECT *, row_number() OVER (PARTITION BY site, is_image, is_legal AND NOT is_image ORDER BY rank, page_id, pos) AS rn,
      sum(length(line) + 1) OVER (PARTITION BY site, is_image, is_legal AND NOT is_image ORDER BY rank, page_id, pos) AS used FROM f),
    h AS (SELECT * FROM g WHERE CASE WHEN is_image THEN rn <= 5 WHEN is_legal THEN used <= 500 ELSE true END),
    i AS (SELECT *, sum(length(line) + 1) OVER (PARTITION BY site ORDER BY rank, page_id, pos) AS total FROM h)
    SELECT site, string_agg(line, chr(10) ORDER BY rank, page_id, pos) AS clean_text, count(*)::INTEGER AS n_lines FROM i WHERE total <= 3000 GROUP BY 1""")
def clean_page_lines(t):
    return pages.clean_page_lines(useful_lines(t), "site", "page_id", 3000, 500, 5, _USEFUL)


_ANCHOR = r"""<a [^>]*href="([^" ]*)"[^>]*>([^<]*)</a>"""


@query("internal_proof_links", f"""WITH a AS (SELECT page_id, {_HOST} AS host, regexp_extract_all(html, '(?i){_ANCHOR}', 1) AS hr, regexp_extract_all(html, '(?i){_ANCHOR}', 2) AS tx FROM pages),
    l AS (SELECT page_id, host, unnest(hr) AS href, unnest(tx) AS txt, unnest(range(len(hr))) AS place FROM a),
    k AS (SELECT *, CASE WHEN len({hits("href || ' ' || txt", ('tion', 'ich'))}) > 0 THEN 0 ELSE 1 END AS rank FROM l
      WHERE (starts_with(lower(href), '/') OR regexp_replace(regexp_extract(lower(href), '^https?://([^/?#:]+)', 1), '^www\\.', '') = host)
        AND NOT regexp_matches(lower(href), '\\.(?:svg|png|jpe?g|gif|webp|css|js|ico|zip|mp4)(?:[?#]|$)')),
    u AS (SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY page_id, href ORDER BY rank, place) = 1),
    v AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY rank, place) AS rn FROM u)
    SELECT p.page_id, coalesce((SELECT string_agg(href, ' ' ORDER BY rn) FROM v WHERE v.page_id = p.page_id AND rn <= 3), '') AS links FROM pages p""")
def internal_proof_links(t):
    rx = "(?i)" + _ANCHOR
    anchors = F.transform(F.arrays_zip(F.regexp_extract_all("html", F.lit(rx), F.lit(1)), F.regexp_extract_all("html", F.lit(rx), F.lit(2))),
                          lambda x: F.struct(x["0"].alias("href"), x["1"].alias("text")))
    rows = t("pages").select("page_id", domain_from_website(F.col("url")).alias("host"), anchors.alias("links"))
    best = pages.internal_proof_links(F.col("links"), F.col("host"), 3, ("tion", "ich"))
    return rows.select("page_id", F.array_join(best, " ").alias("links"))


@query("size_percentiles", """SELECT lang, count(*) AS n, quantile_cont(length(text), 0.5)::DOUBLE AS median, quantile_cont(length(text), 0.9)::DOUBLE AS p90, max(length(text))::INTEGER AS largest
    FROM documents GROUP BY 1""")
def size_percentiles(t):
    out = pages.size_percentiles(t("documents"), ["lang"], F.length("text"))
    return out


@query("recall_gate", f"""WITH b AS (SELECT page_id, html, {_strip_sql('html')} AS body FROM pages),
    e AS (SELECT page_id, list_distinct(regexp_extract_all(html, '[A-Z][a-z]+')) AS want, list_distinct(regexp_extract_all(body, '[A-Z][a-z]+')) AS got,
      regexp_matches(html, '(?i)that') AS s1, regexp_matches(body, '(?i)that') AS s2 FROM b),
    r AS (SELECT CASE WHEN len(want) = 0 THEN 1.0 ELSE len(list_intersect(want, got)) / len(want) END AS er, CASE WHEN s1 AND NOT s2 THEN 0.0 ELSE 1.0 END AS sr FROM e)
    SELECT count(*) AS pages, floor(avg(er) * 10000 + 0.5)::BIGINT AS entity_bp, floor(avg(sr) * 10000 + 0.5)::BIGINT AS signal_bp, avg(er) >= 0.5 AND avg(sr) >= 0.9 AS passed FROM r""")
def recall_gate(t):
    words = F.lit(r"[A-Z][a-z]+")
    rows = t("pages").select("html", strip_html(F.col("html")).alias("body"))
    entity = pages.recall(F.regexp_extract_all("body", words, F.lit(0)), F.regexp_extract_all("html", words, F.lit(0)))
    signal = pages.recall(pages.page_categories(F.col("body"), [("that", "that")]), pages.page_categories(F.col("html"), [("that", "that")]))
    out = pages.recall_gate(rows, entity, signal, 0.5, 0.9)
    return out.select("pages", F.floor(F.col("entity_recall") * 10000 + 0.5).alias("entity_bp"),
                      F.floor(F.col("signal_recall") * 10000 + 0.5).alias("signal_bp"), "passed")


@query("attempt_state", "SELECT crawl_id, NOT ok AND coalesce(crawl_attempts, 1) < 3 AS retry, coalesce(crawl_attempts, 1)::INTEGER AS attempts FROM crawl_log")
def attempt_state(t):
    state = crawl.attempt_state(F.col("ok"), F.col("crawl_attempts"), 3)
    return t("crawl_log").select("crawl_id", state["retry"].alias("retry"), state["attempts"].alias("attempts"))


# --- profile queue ------------------------------------------------------------------

# Every document as five sites: its text in queue and crawl, the same with a thin text and with none in the
# crawl, one that only the queue knows, and one that only the crawl knows.
KINDS = ("both", "thin", "none", "queue", "crawl")


def sites(t):
    docs = t("documents").select("doc_id", F.explode(F.array(*[F.lit(k) for k in KINDS])).alias("kind"), "text", "lang")
    return docs.withColumn("site", F.concat(F.lit("co"), F.col("doc_id").cast("string"), F.lit("-"), "kind"))


def queue_before(t):
    """Stand-in queue: some sites profiled, some with another text, some unknown."""
    body = F.expr("CASE WHEN kind = 'thin' THEN lang ELSE text END")
    return sites(t).where("kind <> 'crawl'").select(
        F.col("site").alias("domain"),
        F.expr("CASE doc_id % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'not_profileable' ELSE 'processing' END").alias("profile_status"),
        F.lit(None).cast("string").alias("profileability_reason"), F.lit(True).alias("source_crawl_ok"), F.lit(0).alias("source_clean_chars"),
        F.when(F.col("doc_id") % 2 == 0, F.sha2(body, 256)).alias("current_source_hash"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("p")).alias("profiled_source_hash"), _stamp("2024-01-01").alias("source_crawled_at"),
        F.lit(True).alias("needs_review"), _stamp("2024-01-02").alias("claimed_at"), F.lit("boom").alias("last_error"), _stamp("2024-01-03").alias("updated_at"))


def _stamp(day):
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def crawls_now(t):
    return sites(t).where("kind <> 'queue'").select(
        F.col("site").alias("domain"), (F.col("doc_id") % 7 != 0).alias("ok"),
        F.expr("CASE kind WHEN 'none' THEN NULL WHEN 'thin' THEN lang ELSE text END").alias("clean_text"),
        _stamp("2024-01-01").alias("crawled_at"))


QUEUE_SQL = """s AS (SELECT 'co' || doc_id || '-' || kind AS id, * FROM (SELECT doc_id, text, lang, unnest(['both', 'thin', 'none', 'queue', 'crawl']) AS kind FROM documents)),
    q AS (SELECT id, CASE doc_id % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'not_profileable' ELSE 'processing' END AS st,
      CASE WHEN doc_id % 2 = 0 THEN sha256(CASE WHEN kind = 'thin' THEN lang ELSE text END) END AS h, CASE WHEN doc_id % 3 = 0 THEN 'p' END AS ph FROM s WHERE kind <> 'crawl'),
    c AS (SELECT id, doc_id % 7 <> 0 AS ok, coalesce(CASE kind WHEN 'none' THEN NULL WHEN 'thin' THEN lang ELSE text END, '') AS body FROM s WHERE kind <> 'queue'),
    d AS (SELECT *, length(trim(body)) AS n, CASE WHEN length(trim(body)) > 0 THEN sha256(body) END AS nh FROM c),
    j AS (SELECT coalesce(q.id, d.id) AS site, q.id IS NOT NULL AS old, d.id IS NOT NULL AS hit, q.*, d.*, h IS DISTINCT FROM nh AS changed FROM q FULL JOIN d ON q.id = d.id),
    after AS (SELECT site AS domain, CASE WHEN NOT hit THEN st WHEN n < 300 THEN 'not_profileable' WHEN NOT old THEN 'pending' WHEN changed AND ph IS NULL THEN 'pending'
        WHEN changed THEN 'stale' WHEN st = 'not_profileable' THEN 'pending' ELSE st END AS profile_status,
      CASE WHEN hit AND n = 0 THEN 'no_clean_text' WHEN hit AND n < 300 THEN 'thin_text' END AS profileability_reason, CASE WHEN hit THEN nh ELSE h END AS current_source_hash,
      CASE WHEN hit AND (changed OR NOT old) THEN false ELSE true END AS needs_review, CASE WHEN hit AND (changed OR NOT old) THEN NULL ELSE 'boom' END AS last_error,
      CASE WHEN hit AND (changed OR NOT old OR NOT ok) THEN DATE '2024-03-01' ELSE DATE '2024-01-03' END AS updated_on FROM j)"""


def queue_after(df):
    return df.select("domain", "profile_status", "profileability_reason", "current_source_hash", "needs_review", "last_error",
                     F.to_date("updated_at").alias("updated_on"))


@query("sync_profile_queue", f"WITH {QUEUE_SQL} SELECT * FROM after")
def sync_profile_queue(t):
    return queue_after(crawl.sync_profile_queue(queue_before(t), crawls_now(t), _stamp("2024-03-01")))


# --- sources and sinks -----------------------------------------------------------------

@query("read_items", "SELECT doc_id, lang, n_chars FROM documents")
def read_items(t):
    path = fresh_path(t.spark, "items")
    tables.write_json(t("documents").select("doc_id", "lang", "n_chars"), path)
    return files.read_items(t.spark, path, "doc_id bigint, lang string, n_chars bigint")


@query("read_jsonl_glob", "SELECT doc_id, source FROM documents")
def read_jsonl_glob(t):
    path = fresh_path(t.spark, "verdicts")
    tables.write_json(t("documents").select("doc_id", "source"), path)
    return files.read_jsonl_glob(t.spark, f"{path}/*.json", "doc_id bigint, source string")


@query("read_lead_csv", "SELECT lead_id::VARCHAR AS lead_id, email, job_title, company_industry FROM leads")
def read_lead_csv(t):
    path = fresh_path(t.spark, "leads")
    tables.write_csv(t("leads").select(F.col("lead_id").alias("Lead_ID"), "email", "job_title", F.col("company_industry").alias(" Company_Industry ")), path)
    return files.read_lead_csv(t.spark, path)


TERMS_A_FILE = 250_000


@query("load_terms", """SELECT min_by(term, event_id) AS term FROM (SELECT event_id, trim(CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END || user_id % 20) AS term FROM events)
    WHERE term <> '' GROUP BY lower(term)""")
def load_terms(t):
    terms = t("events").select(F.col("event_id").alias("place"), F.concat(F.expr(
        "CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE event_type END"), F.col("user_id") % 20).alias("term"))
    # Files in order, each of a bounded number of terms, with the comments and blank lines that word lists have.
    path = fresh_path(t.spark, "terms")
    in_order = terms.repartitionByRange(terms.count() // TERMS_A_FILE + 1, "place").sortWithinPartitions("place")
    in_order.select(F.explode(F.array(F.lit("# note"), F.lit(""), F.concat(F.lit(" "), "term"))).alias("value")).write.text(path)
    return files.term_rows(t.spark.read.text(path)).select("term")


@query("flatten_person_results", """SELECT id, CASE WHEN id % 7 = 0 OR email IS NULL OR contains(email, '*') THEN '' ELSE email END AS email, title AS job_title,
    'co' || company_id AS company_domain, 'Spark; ' || email_status AS company_technologies FROM (SELECT * REPLACE (CASE WHEN id % 5 = 0 THEN 'x***@co' ELSE email END AS email) FROM contacts)""")
def flatten_person_results(t):
    nested = t("contacts").select(
        F.struct(F.col("id").cast("string").alias("first_name"), "last_name", "linkedin_url", F.col("title").alias("current_job_title"), F.struct(
            F.expr("CASE WHEN id % 5 = 0 THEN 'x***@co' ELSE email END").alias("email"), F.expr("id % 7 <> 0").alias("revealed")).alias("email")).alias("person"),
        F.struct(F.lit("n").alias("name"), F.concat(F.lit("co"), "company_id").alias("domain"), F.lit("i").alias("industry"), F.lit(5).alias("headcount"),
                 F.struct(F.lit("").alias("state"), F.lit("MX").alias("country")).alias("location"),
                 F.array(F.lit("Spark"), F.col("email_status")).alias("technologies")).alias("company"))
    return provider.flatten_person_results(nested).select(
        F.col("first_name").cast("bigint").alias("id"), "email", "job_title", "company_domain", "company_technologies")


@query("flatten_company_results", """SELECT lower(c_name) AS domain, CASE WHEN c_custkey % 3 >= c_custkey % 2 THEN CASE WHEN c_custkey % 3 = c_custkey % 2 THEN 'a' ELSE 'b' END ELSE 'a' END AS industry,
    CASE c_nationkey % 3 WHEN 0 THEN 5 WHEN 1 THEN 30 END AS headcount, CASE WHEN c_custkey % 2 = 0 THEN 'https://l.example/company/' || c_custkey ELSE '' END AS linkedin_url FROM customer""")
def flatten_company_results(t):
    raw = t("customer").select(
        F.col("c_name").alias("domain"), F.col("c_name").alias("name"),
        F.create_map(F.lit("a"), F.col("c_custkey") % 2, F.lit("b"), F.col("c_custkey") % 3).alias("industry_groups"),
        F.expr("CASE c_nationkey % 3 WHEN 0 THEN '1-10' WHEN 1 THEN '11-50' ELSE 'many' END").alias("employees"),
        F.struct(F.lit("MX").alias("country")).alias("address"),
        F.array(F.lit("https://x.example/u"), F.expr("CASE WHEN c_custkey % 2 = 0 THEN concat('https://l.example/company/', c_custkey) ELSE 'https://l.example/in/a' END")).alias("social_urls"),
        F.lit("text").alias("description"))
    return provider.flatten_company_results(raw, "finder").select("domain", "industry", "headcount", "linkedin_url")


@query("rebuild", "SELECT lang, source, count(*) AS n FROM documents GROUP BY 1, 2")
def rebuild(t):
    path = fresh_path(t.spark, "rebuilt")
    counts = t("documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    for _ in range(2):  # a rebuild replaces, it never appends
        tables.rebuild(counts, path, ["lang"])
    return t.spark.read.parquet(path).select("lang", "source", "n")


@query("write_json", "SELECT doc_id, lang, source FROM documents")
def write_json(t):
    path = fresh_path(t.spark, "json")
    tables.write_json(t("documents").select("doc_id", "lang", "source"), path)
    return t.spark.read.schema("doc_id bigint, lang string, source string").json(path)


@query("write_csv", "SELECT doc_id, text, lang || ' | ' || source AS tags FROM documents")
def write_csv(t):
    path = fresh_path(t.spark, "csv")
    tables.write_csv(t("documents").select("doc_id", "text", F.array("lang", "source").alias("tags")), path)
    return t.spark.read.schema("doc_id bigint, text string, tags string").csv(
        path, header=True, multiLine=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
