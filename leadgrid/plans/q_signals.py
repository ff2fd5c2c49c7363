"""Queries over job postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions import text
from leadgrid.operators import signals
from leadgrid.plans import vocab
from leadgrid.plans.q_text import _CHUNKS, _DECODE, _FOLD
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import hits, quoted, sp, strip

LOCATIONS = (("north", r"must be based in the north"), ("south", r"que.{0,20}que"))


def score(col):
    return text.score_fragment(col, [(3, vocab.POSITIVE), (2, vocab.TARGETS), (-2, vocab.LOW_VALUE)], folded=True)


RULES = signals.SignalRules(
    workspace="main", source="board", positive=vocab.POSITIVE, negative=vocab.NEGATIVE, hidden=vocab.HIDDEN,
    locations=LOCATIONS, targets=vocab.TARGETS, markets=vocab.MARKETS, selling_abroad=("that.{0,80}with",),
    recruiter_names=("holding 7",), recruiter_patterns=(r"\bzzz\b",), home_countries=("EN", "FR"),
    fragment_score=score, excerpt_chars=600, evidence_limit=3)


def raw_postings(t):
    """Stand-in postings under the raw provider's field names."""
    return t("postings").select(
        F.col("raw_id").alias("id"), F.col("url").alias("link"), F.lit("").alias("title"), F.col("title").alias("jobTitle"),
        F.col("company_name").alias("companyName"), F.col("company_website").alias("companyWebsite"),
        F.col("employees").alias("companyEmployeesCount"), F.concat("description", F.lit("\n ")).alias("descriptionText"),
        F.struct(F.col("location").alias("addressCountry")).alias("companyAddress"), F.col("title").alias("companyDescription"),
        F.array(F.col("location"), F.lit("Trade")).alias("industries"), "location",
        F.col("posted_at").alias("postedAt"), F.col("doc_id").alias("arrival"))


def normalized(t):
    return signals.normalize_job(raw_postings(t), RULES)


_WHOLE = f"{sp('title')} || ' ' || {sp('description')}"
_HIDDEN = f"len({hits(sp('description'), vocab.HIDDEN)}) > 0"
# The normalized rows, from the stand-in postings; ``arrival`` is the document number.
JOBS = f"""jobs0 AS (SELECT *, {hits(_WHOLE, vocab.POSITIVE)} AS pos, {hits(_WHOLE, vocab.NEGATIVE)} AS neg, {_HIDDEN} AS hid FROM postings),
jobs AS (SELECT doc_id AS arrival, CASE WHEN raw_id <> '' THEN raw_id ELSE 'hash:' || substr(sha256(url || '|' || {sp('title')} || '|' ||
      {sp('company_name')} || '|' || substr({strip('description')}, 1, 500)), 1, 24) END AS source_job_id, {sp('title')} AS role_title,
    nullif({sp('company_name')}, '') AS company_name,
    lower(split_part(split_part(company_website, '://www.', 2), '/', 1)) AS company_domain,
    CASE WHEN length(posted_at) = 10 THEN posted_at || 'T00:00:00+00:00' ELSE posted_at END AS posted_at, {strip('description')} AS body, location, url, title AS raw_title,
    CASE WHEN hid THEN 'low' WHEN len(pos) >= 2 THEN 'high' WHEN len(pos) = 1 THEN 'medium' WHEN len(neg) > 0 THEN 'low' ELSE 'review' END AS priority,
    list_concat(list_transform(pos[1:8], lambda x: 'positive:' || x), list_transform(neg[1:8], lambda x: 'negative:' || x),
      CASE WHEN hid THEN ['hidden_employer'] ELSE [] END) AS reasons, pos, neg, hid, employees FROM jobs0)"""


def _window(w: str) -> str:
    at = f"strpos(lower(body), '{w}')"
    return f"CASE WHEN {at} > 0 THEN {strip(f'substr(body, greatest(1, {at} - 240), {at} + {len(w)} + 360 - greatest(1, {at} - 240))')} END"


_LINES = f"list_filter({_CHUNKS.format('body')}, lambda x: x <> '')"
# Header, then three exact fragments or windows with a positive term, or else the start of the text.
EXCERPTS = f"""ev0 AS (SELECT arrival, list_concat(list_transform(list_filter({_LINES}, lambda x: len(list_filter({quoted(vocab.POSITIVE)},
      lambda w: contains(lower(x), w))) > 0), lambda x: substr(x, 1, 900)), list_filter([{', '.join(map(_window, vocab.POSITIVE))}],
      lambda x: x IS NOT NULL AND x <> '')) AS items FROM jobs),
    ev1 AS (SELECT arrival, items, list_transform(items, lambda x: {_FOLD}) AS ks FROM ev0),
    ev AS (SELECT arrival, list_filter(items, lambda x, i: list_position(ks, {_FOLD}) = i)[1:3] AS items FROM ev1),
    head AS (SELECT arrival, body, items, 'Role: ' || role_title || chr(10) || 'Company: ' || coalesce(company_name, '') AS h FROM jobs JOIN ev USING (arrival)),
    excerpts AS (SELECT arrival, substr(h || chr(10) || CASE WHEN len(items) > 0 THEN array_to_string(list_transform(items, lambda x: '- ' || x), chr(10))
      ELSE substr({sp('body')}, 1, greatest(0, 600 - length(h) - 2)) END, 1, 600) AS analysis_excerpt FROM head)"""


@query("prefilter", f"WITH {JOBS} SELECT arrival, priority, array_to_string(reasons, ',') AS reasons FROM (SELECT arrival, reasons, "
       "CASE WHEN len(pos) >= 2 THEN 'high' WHEN len(pos) = 1 THEN 'medium' WHEN len(neg) > 0 THEN 'low' ELSE 'review' END AS priority "
       "FROM (SELECT * REPLACE (list_filter(reasons, lambda r: r <> 'hidden_employer') AS reasons) FROM jobs))")
def prefilter(t):
    whole = text.normalize_space(F.concat_ws(" ", "title", "description"))
    got = signals.prefilter(whole, vocab.POSITIVE, vocab.NEGATIVE)
    return t("postings").select(F.col("doc_id").alias("arrival"), got["priority"].alias("priority"),
                                F.array_join(got["reasons"], ",").alias("reasons"))


@query("normalize_job", f"""WITH {JOBS}, {EXCERPTS} SELECT arrival, analysis_excerpt, source_job_id, role_title, company_name, company_domain, posted_at,
    sha256(body) AS description_hash, TRY_CAST(replace(regexp_extract(coalesce(employees, ''), '\\d[\\d,]*'), ',', '') AS BIGINT) AS company_employee_count,
    upper(location) AS company_address_country_code, location || ', Trade' AS company_industries, priority AS prefilter_priority,
    array_to_string(reasons, ',') AS prefilter_reasons, CASE WHEN hid THEN 'hidden' ELSE 'unreviewed' END AS employer_confidence,
    CASE WHEN hid THEN 'hold' ELSE 'review' END AS campaign_action,
    CASE WHEN regexp_matches(lower({sp('body')}), 'must be based in the north') THEN 'north'
      WHEN regexp_matches(lower({sp('body')}), 'que.{{0,20}}que') THEN 'south' END AS job_location_requirement FROM jobs JOIN excerpts USING (arrival)""")
def normalize_job(t):
    return normalized(t).select(
        "arrival", "analysis_excerpt", "source_job_id", "role_title", "company_name", "company_domain", "posted_at", "description_hash",
        "company_employee_count", "company_address_country_code", "company_industries", "prefilter_priority",
        F.array_join("prefilter_reasons", ",").alias("prefilter_reasons"), "employer_confidence", "campaign_action",
        "job_location_requirement")


@query("dedupe_richest", f"""
    SELECT lang, source, doc_id, length(text) AS n_text FROM documents
    QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY length(text) DESC, doc_id) = 1""")
def dedupe_richest(t):
    kept = signals.dedupe_richest(t("documents").select("lang", "source", "doc_id", "text"), ["lang", "source"], "text", "doc_id")
    return kept.select("lang", "source", "doc_id", F.length("text").cast("bigint").alias("n_text"))


@query("is_clean_high", f"""WITH {JOBS} SELECT arrival, priority = 'high' AND len(neg) = 0 AS clean FROM jobs""")
def is_clean_high(t):
    return normalized(t).select("arrival", signals.is_clean_high(
        F.col("prefilter_priority"), F.col("prefilter_reasons")).alias("clean"))


_DIMENSIONS = """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'no_fit' WHEN 3 THEN 'excluded' ELSE 'unreviewed' END AS fit,
    CASE p_partkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'no_signal' ELSE 'unreviewed' END AS signal_fit,
    CASE WHEN p_size % 3 = 0 THEN 'high' WHEN p_size % 3 = 1 THEN 'no_fit' ELSE 'medium' END AS account_fit,
    CASE WHEN p_size % 7 = 0 THEN 'foreign' WHEN p_size % 7 = 1 THEN 'uncertain' ELSE 'home' END AS region,
    CASE WHEN p_size % 5 = 0 THEN 'hidden' WHEN p_size % 2 = 0 THEN 'likely' ELSE 'verified' END AS employer,
    CASE WHEN p_size % 11 = 0 THEN 'exclude' WHEN p_size % 11 = 1 THEN 'hold' ELSE 'contact' END AS action, p_partkey % 3 = 0 AS review FROM part"""


@query("pipeline_status", f"""WITH d AS ({_DIMENSIONS}), gate AS (SELECT *,
      action = 'exclude' OR signal_fit = 'no_signal' OR account_fit = 'no_fit' OR region = 'foreign' AS excluded,
      action = 'contact' AND account_fit IN ('high', 'medium') AND region = 'home' AND employer <> 'hidden' AND NOT review AS open FROM d)
    SELECT p_partkey, CASE WHEN excluded THEN 'not_fit' WHEN signal_fit = 'high' AND open THEN 'ready_for_contact' WHEN signal_fit = 'high' THEN 'qualified'
      WHEN fit NOT IN ('high', 'medium') THEN 'not_fit' WHEN review THEN 'qualified' ELSE 'ready_for_contact' END AS status FROM gate""")
def pipeline_status(t):
    rows = t.spark.sql(_DIMENSIONS.replace("FROM part", "FROM {part}"), part=t("part"))
    status = signals.pipeline_status(*[F.col(c) for c in (
        "fit", "signal_fit", "account_fit", "region", "employer", "action", "review")])
    return rows.select("p_partkey", status.alias("status"))


@query("freshness", """SELECT event_id, event_type FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 7 DAY AND ts <= TIMESTAMP '2024-01-20 00:00:00'""")
def freshness(t):
    as_of = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    return signals.freshness(t("events"), "ts", as_of, 7 * 86400).select("event_id", "event_type")


# Scored fragments of a text, ranked by score and place.
_FRAGS = f"""list_filter(list_transform({_CHUNKS.format(_DECODE.format('body'))}, lambda x: trim(x, ' -–—•●▪◦')), lambda x: length(x) BETWEEN 35 AND 900)"""
_SCORE = f"""3 * len({hits('fragment', vocab.POSITIVE)}) + 2 * len({hits('fragment', vocab.TARGETS)}) - 2 * len({hits('fragment', vocab.LOW_VALUE)})"""


def _ranked(source: str) -> str:
    return f"""frags AS (SELECT arrival, unnest(f) AS fragment, unnest(range(len(f))) AS place FROM (SELECT arrival, {_FRAGS} AS f FROM {source})),
    uniq AS (SELECT *, {_SCORE} AS score FROM frags QUALIFY row_number() OVER (PARTITION BY arrival, lower(fragment) ORDER BY place) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY arrival ORDER BY score DESC, place) AS rn FROM uniq),
    best3 AS (SELECT arrival, string_agg(fragment, ' | ' ORDER BY rn) AS best FROM ranked WHERE rn <= 3 GROUP BY arrival)"""


@query("top_fragments", f"""WITH docs AS (SELECT doc_id AS arrival, text AS body FROM documents), {_ranked('docs')}
    SELECT doc_id, best FROM documents LEFT JOIN best3 ON arrival = doc_id""")
def top_fragments(t):
    best = signals.top_fragments(F.col("text"), score, 3)
    return t("documents").select("doc_id", F.nullif(F.array_join(best, " | "), F.lit("")).alias("best"))


@query("review_queue", f"""WITH {JOBS} SELECT source_job_id, priority AS prefilter_priority, posted_at FROM jobs
    ORDER BY CASE priority WHEN 'high' THEN 0 WHEN 'medium' THEN 1 WHEN 'review' THEN 2 WHEN 'low' THEN 3 ELSE 9 END,
      coalesce(posted_at, ''), source_job_id LIMIT 40""")
def review_queue(t):
    return signals.review_queue(normalized(t), 40).select("source_job_id", "prefilter_priority", "posted_at")


@query("review_packet", f"""WITH {JOBS}, {EXCERPTS} SELECT source_job_id, role_title, company_name, company_domain, priority AS prefilter_priority,
    analysis_excerpt, length(body)::INTEGER AS description_chars, sha256(body) AS description_hash FROM jobs JOIN excerpts USING (arrival)""")
def review_packet(t):
    return signals.review_packet(normalized(t)).select(
        "source_job_id", "role_title", "company_name", "company_domain", "prefilter_priority", "analysis_excerpt",
        "source_integrity.description_chars", "source_integrity.description_hash")


@query("prefilter_distribution", f"""WITH {JOBS} SELECT priority AS prefilter_priority, count(*) AS postings, count(nullif(body, '')) AS with_text,
    count(company_domain) AS with_domain, 0::BIGINT AS with_logo FROM jobs GROUP BY 1""")
def prefilter_distribution(t):
    return signals.prefilter_distribution(normalized(t))


_KEYED = f"""clean AS (SELECT *, coalesce('name:' || lower(company_name), 'domain:' || company_domain, 'job:' || lower(source_job_id)) AS company_key,
    regexp_replace(lower({sp(_DECODE.format('body'))}), '\\n', ' ', 'g') AS flat FROM jobs WHERE priority = 'high' AND len(neg) = 0)"""


@query("company_review", f"""WITH {JOBS}, {_KEYED}, {_ranked('clean')},
    prim AS (SELECT company_key, source_job_id, company_name, company_domain, location FROM clean
      QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY length(body) DESC, posted_at DESC, arrival) = 1),
    about AS (SELECT company_key, substr(about, 1, 1200) AS company_description FROM (SELECT *, {sp('raw_title')} AS about FROM clean)
      QUALIFY row_number() OVER (PARTITION BY company_key ORDER BY length(about) DESC, posted_at DESC, arrival) = 1),
    grp AS (SELECT company_key, count(*) AS job_count, bool_or(hid) AS flag_hidden_employer, max(posted_at) AS latest_posted_at, sum(length(body))::BIGINT AS description_chars_total,
      bool_or(regexp_matches(flat, 'that.{{0,80}}with')) AS flag_selling_abroad,
      concat_ws(', ', CASE WHEN bool_or(regexp_matches(flat, 'the\\b')) THEN 'north' END, CASE WHEN bool_or(regexp_matches(flat, '\\ble\\b')) THEN 'south' END,
        CASE WHEN bool_or(regexp_matches(flat, 'that.{{0,80}}with')) THEN 'gap' END) AS market_mentions,
      (SELECT string_agg(x, ', ' ORDER BY lower(x)) FROM (SELECT DISTINCT unnest(flatten(list(pos))) AS x)) AS outbound_terms FROM clean GROUP BY 1),
    brief0 AS (SELECT company_key, role_title || ': ' || best AS brief, posted_at, arrival FROM clean JOIN best3 USING (arrival)),
    brief1 AS (SELECT * FROM brief0 QUALIFY row_number() OVER (PARTITION BY company_key, lower(brief) ORDER BY posted_at DESC, arrival) = 1),
    brief2 AS (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY posted_at DESC, arrival) AS rn FROM brief1),
    briefs AS (SELECT company_key, substr(string_agg(brief, chr(10) || chr(10) ORDER BY rn), 1, 5000) AS description_brief FROM brief2 WHERE rn <= 4 GROUP BY 1),
    tgt0 AS (SELECT c.company_key, c.posted_at, f.* FROM frags f JOIN clean c USING (arrival) WHERE len({hits('fragment', vocab.TARGETS)}) > 0),
    tgt1 AS (SELECT * FROM tgt0 QUALIFY row_number() OVER (PARTITION BY company_key, lower(fragment) ORDER BY posted_at DESC, arrival, place) = 1),
    tgt2 AS (SELECT *, row_number() OVER (PARTITION BY company_key ORDER BY posted_at DESC, arrival, place) AS rn FROM tgt1),
    tgts AS (SELECT company_key, substr(string_agg(fragment, chr(10) ORDER BY rn), 1, 2200) AS target_evidence FROM tgt2 WHERE rn <= 3 GROUP BY 1),
    rev AS (SELECT *, coalesce(contains(lower(company_name), 'holding 7'), false) AS flag_recruiter,
      upper(location) NOT IN ('EN', 'FR') AS flag_foreign_source, company_domain IS NULL AS flag_missing_domain FROM grp JOIN prim USING (company_key))
    SELECT company_key, source_job_id, company_name, company_domain, job_count, latest_posted_at, description_chars_total, company_description,
      flag_selling_abroad, market_mentions, outbound_terms, flag_hidden_employer, flag_recruiter, flag_foreign_source, flag_missing_domain,
      concat_ws(' | ', CASE WHEN flag_selling_abroad THEN 'may sell abroad; check where the company is based' END,
        CASE WHEN flag_hidden_employer THEN 'employer may be hidden' END,
        CASE WHEN flag_recruiter THEN 'recruiter or recruiting source; confirm the employer' END,
        CASE WHEN flag_foreign_source THEN 'source names country ' || upper(location) || '; headquarters unverified' END,
        CASE WHEN flag_missing_domain THEN 'domain missing' END,
        CASE WHEN job_count > 1 THEN job_count || ' postings merged; check differences' END) AS automatic_warnings,
      description_brief, target_evidence FROM rev LEFT JOIN about USING (company_key) LEFT JOIN briefs USING (company_key)
      LEFT JOIN tgts USING (company_key)""")
def company_review(t):
    return signals.company_review(normalized(t), RULES).select(
        "company_key", "source_job_id", "company_name", "company_domain", "job_count", "latest_posted_at",
        "description_chars_total", "company_description", "flag_selling_abroad", "market_mentions", "outbound_terms",
        "flag_hidden_employer", "flag_recruiter", "flag_foreign_source", "flag_missing_domain", "automatic_warnings",
        "description_brief", "target_evidence")


@query("review_members", f"""WITH {JOBS}, {_KEYED} SELECT company_key, posted_at, arrival, role_title, url AS job_url, source_job_id,
    sha256(body) AS description_hash, location FROM clean""")
def review_members(t):
    return signals.review_members(normalized(t))


_WORD_LIST = "regexp_extract_all(lower({0}), '[\\p{{L}}\\p{{N}}_]+')"


@query("term_join", f"""WITH d AS (SELECT DISTINCT array_to_string(w, ' ') AS term FROM (
      SELECT {_WORD_LIST.format('line')} AS w FROM (SELECT unnest(string_split_regex(text, '[.\n]')) AS line FROM benchmark)
      UNION ALL SELECT [word] FROM (SELECT unnest({_WORD_LIST.format('text')}) AS word FROM benchmark)) WHERE len(w) > 0),
    t AS (SELECT doc_id, ' ' || array_to_string({_WORD_LIST.format('text')}, ' ') || ' ' AS flat FROM documents)
    SELECT doc_id, term FROM t JOIN d ON contains(flat, ' ' || term || ' ')""")
def term_join(t):
    lines = t("benchmark").select(F.explode(F.split("text", r"[.\n]")).alias("term"))
    words = t("benchmark").select(F.explode(signals.folded_words(F.col("text"))).alias("term"))
    return signals.term_join(t("documents"), "doc_id", "text", lines.unionByName(words), "term")


@query("search_grid", """SELECT c_custkey, keyword, 'https://jobs.example/search?keywords=' || replace(keyword, ' ', '+') || '&location=' ||
    replace(c_name, '#', '%23') || '&f_TPR=r604800' AS url FROM customer, (SELECT unnest(['cold calling', 'SDR', 'new business']) AS keyword)""")
def search_grid(t):
    grid = signals.search_grid(t("customer").select("c_name"), "c_name", ["cold calling", "SDR", "new business", "sdr", " "], 604800)
    return grid.select(F.regexp_extract("c_name", r"(\d+)$", 1).cast("bigint").alias("c_custkey"), "keyword", "url")


@query("ordered_distinct", """SELECT o_custkey, string_agg(o_orderpriority, ',' ORDER BY first_at) AS priorities FROM (
    SELECT o_custkey, o_orderpriority, min(o_orderkey) AS first_at FROM orders GROUP BY 1, 2) GROUP BY 1""")
def ordered_distinct(t):
    out = signals.ordered_distinct(t("orders"), ["o_custkey"], "o_orderpriority", "o_orderkey", "priorities")
    return out.select("o_custkey", F.array_join("priorities", ",").alias("priorities"))


@query("first_seen", "SELECT user_id, props, min(event_id) AS first_at FROM events GROUP BY 1, 2")
def first_seen(t):
    return signals.first_seen(t("events"), ["user_id"], "props", "event_id")


@query("cost_estimate", """SELECT c_mktsegment, n, n / 1000.0::DOUBLE AS estimated_cost, n / 1000.0::DOUBLE > 0.3 AS over_budget
    FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1)""")
def cost_estimate(t):
    spend = t("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    cost = signals.cost_estimate(F.col("n"), F.lit("0.001"), F.lit(0.3))
    return spend.select("c_mktsegment", "n", cost["estimated_cost"].alias("estimated_cost"), cost["over_budget"].alias("over_budget"))


@query("run_ledger", """SELECT 'run-1' AS run_id, 'succeeded' AS status, 7 AS keyword_count, count(*) AS harvested_count,
    count(DISTINCT (lang, source)) AS unique_count, count(*) / 1000.0::DOUBLE AS estimated_cost, 0.5::DOUBLE AS actual_cost, '{}' AS config_snapshot FROM documents""")
def run_ledger(t):
    return signals.run_ledger(t("documents"), "run-1", 7, ["lang", "source"], 0.001, "{}", 0.5)
