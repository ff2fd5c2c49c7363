"""Queries over company and lead lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions.keys import norm_domain
from leadgrid.operators import lists
from leadgrid.plans.q_entity import COMPANY, build
from leadgrid.plans.q_rules import SEGMENTS, segments
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import bucket, nd, rate, rnd


def keyed(t):
    return t("list_companies").withColumn("domain", norm_domain(F.col("domain"))).where("domain IS NOT NULL")


LC = f"lc AS (SELECT * REPLACE ({nd('domain')} AS domain) FROM list_companies WHERE {nd('domain')} IS NOT NULL)"


@query("load_list_with_meta", r"""
    SELECT row_id, regexp_replace(trim(lower(domain)), '^www\.', '') AS domain, name, TRY_CAST(meta_staff AS INTEGER) AS staff_linkedin,
      company_size, coalesce(CASE WHEN TRY_CAST(meta_staff AS INTEGER) IS NULL THEN meta_staff END, '') AS loose_staff,
      coalesce(nullif(industry, ''), '') AS meta_industry FROM list_companies WHERE contains(domain, '.')""")
def load_list_with_meta(t):
    raw = t("list_companies").select("domain", "name", F.col("meta_staff").alias("staff_linkedin"),
                                     F.col("company_size").alias("staff_reported"), "industry",
                                     F.col("row_id").cast("string").alias("row_id"))
    out = lists.load_list_with_meta(raw, ["name", "staff_linkedin", "company_size"], {"staff_reported": "company_size"}, ["staff_linkedin"])
    return out.select(F.col("meta")["row_id"].cast("bigint").alias("row_id"), "domain", "name", "staff_linkedin", "company_size",
                      F.coalesce(F.try_element_at("meta", F.lit("staff_linkedin")), F.lit("")).alias("loose_staff"),
                      F.coalesce(F.try_element_at("meta", F.lit("industry")), F.lit("")).alias("meta_industry"))


@query("dedupe_last", "SELECT user_id, event_type, max(event_id) AS event_id FROM events GROUP BY 1, 2")
def dedupe_last(t):
    return lists.dedupe_last(t("events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], "event_id")


@query("dedupe_first", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1")
def dedupe_first(t):
    return lists.dedupe_first(t("events").select("user_id", "event_id"), ["user_id"], "event_id")


@query("denylist", f"WITH {LC} SELECT row_id, domain FROM lc WHERE domain NOT IN ('co3.example.com', 'co12.example.com')")
def denylist(t):
    return lists.denylist(keyed(t), ["co3.example.com", "co12.example.com"]).select("row_id", "domain")


@query("filter_places", """SELECT lpad(c_custkey::VARCHAR, 5, '0') AS zip, c_name AS city FROM customer
    WHERE c_mktsegment = 'BUILDING' AND contains(c_name, '00001') AND c_acctbal >= 1000 AND c_custkey < 100000""")
def filter_places(t):
    places = t("customer").select(F.col("c_custkey").cast("string").alias("zip"), F.col("c_name").alias("city"),
                                  F.col("c_mktsegment").alias("state"), F.col("c_acctbal").alias("population"))
    # The same places again under codes that are too long.
    places = places.unionByName(places.withColumn("zip", F.concat(F.lit("9"), F.lpad("zip", 5, "0"))))
    return lists.filter_places(places, "building", "00001", 1000).select("zip", "city")


_BAD = r"regexp_matches(coalesce(job_title, ''), '(?i)\bintern(ship)?\b|\bassistant\b|\bcoordinator\b|\bstudent\b|\bpart.time\b|\bretired\b|\btrainee\b')"
_ROLE = "lower(split_part(email, '@', 1)) IN ('info', 'contact', 'hello', 'hi', 'sales', 'team', 'support', 'admin', 'noreply', 'no-reply', 'office', 'marketing')"
_FAKE = r"""(first_name = '' OR last_name = '' OR (upper(first_name) = first_name AND length(first_name) > 2) OR regexp_matches(first_name, '\d')
    OR regexp_matches(last_name, '\d') OR lower(first_name) IN ('admin', 'info', 'contact', 'test', 'user', 'n/a', 'na')
    OR lower(last_name) IN ('admin', 'info', 'contact', 'test', 'user', 'n/a', 'na'))"""


@query("bad_title", f"SELECT lead_id, {_BAD} AS bad FROM leads")
def bad_title(t):
    return t("leads").select("lead_id", lists.bad_title(F.col("job_title")).alias("bad"))


@query("role_mailbox", f"SELECT lead_id, {_ROLE} AS shared FROM leads")
def role_mailbox(t):
    return t("leads").select("lead_id", lists.role_mailbox(F.col("email")).alias("shared"))


@query("fake_name", f"SELECT lead_id, {_FAKE} AS fake FROM leads")
def fake_name(t):
    return t("leads").select("lead_id", lists.fake_name(F.col("first_name"), F.col("last_name")).alias("fake"))


@query("duplicate_emails", """SELECT count(nullif(email, '')) - count(DISTINCT lower(nullif(email, ''))) AS duplicate_emails, count(*) AS total FROM leads""")
def duplicate_emails(t):
    return lists.duplicate_emails(t("leads"))


_DOM = "nullif(lower(CASE WHEN company_domain <> '' THEN company_domain ELSE split_part(email, '@', 2) END), '')"


@query("domain_concentration", f"""WITH d AS (SELECT {_DOM} AS d, count(*) AS n FROM leads GROUP BY 1)
    SELECT count(d) AS domains, sum(n)::BIGINT AS total, count(*) FILTER (WHERE d IS NOT NULL AND n > 5) AS over_concentrated,
      {rate('sum(n)', 'count(d)')} AS avg_per_domain FROM d""")
def domain_concentration(t):
    return lists.domain_concentration(t("leads"))


TITLES, INDUSTRIES = ["Chief Officer", "Sales Director"], ["software"]
_CARD = f"""base AS (SELECT count(*) AS n, count(*) FILTER (WHERE lower(email_status) IN ('ok', 'verified', 'valid')) AS verified,
      count(*) FILTER (WHERE email_status <> '') AS has_status,
      count(*) FILTER (WHERE job_title <> '' AND (contains(lower(job_title), 'chief officer') OR contains(lower(job_title), 'sales director')
        OR contains('chief officer', split_part(lower(job_title), ' ', 1)) OR contains('sales director', split_part(lower(job_title), ' ', 1)))) AS titled,
      count(*) FILTER (WHERE {_BAD}) AS bad, count(*) FILTER (WHERE {_ROLE}) AS "role", count(*) FILTER (WHERE {_FAKE}) AS fake,
      count(*) FILTER (WHERE contains(lower(company_industry), 'software') AND (company_headcount = 0 OR company_headcount BETWEEN 10 AND 200)) AS icp,
      count(nullif(email, '')) - count(DISTINCT lower(nullif(email, ''))) AS dupes, count(DISTINCT {_DOM}) AS domains FROM leads),
    many AS (SELECT count(*) FILTER (WHERE n > 5) AS over_concentrated FROM (SELECT {_DOM} AS d, count(*) AS n FROM leads GROUP BY 1) WHERE d IS NOT NULL),
    pct AS (SELECT *, verified / n * 100.0::DOUBLE AS pv, dupes / n * 100.0::DOUBLE AS pd, "role" / n * 100.0::DOUBLE AS pr, bad / n * 100.0::DOUBLE AS pb FROM base, many),
    score AS (SELECT *, floor(pv + 0.5)::BIGINT AS verification, greatest(0, floor(100 - pd * 20 + 0.5))::BIGINT AS duplicate_emails,
      (CASE WHEN n / domains < 2 THEN 100 WHEN n / domains < 5 THEN 60 ELSE 30 END)::BIGINT AS duplicate_domains,
      floor(titled / n * 100.0::DOUBLE + 0.5)::BIGINT AS title_relevance, greatest(0, floor(100 - pb * 10 + 0.5))::BIGINT AS bad_titles,
      (CASE WHEN pr < 5 THEN 100 WHEN pr < 15 THEN floor(100 - (pr - 5) * 5 + 0.5) ELSE 0 END)::BIGINT AS role_mailboxes,
      floor(icp / n * 100.0::DOUBLE + 0.5)::BIGINT AS icp_fit, floor((n - fake) / n * 100.0::DOUBLE + 0.5)::BIGINT AS names FROM pct),
    card AS (SELECT *, floor((verification * 2 + duplicate_emails + duplicate_domains + title_relevance * 1.5 + bad_titles + role_mailboxes + icp_fit * 2 + names) / 10.5::DOUBLE + 0.5)::BIGINT AS overall FROM score)"""


def scorecard(t):
    return lists.list_scorecard(t("leads"), TITLES, INDUSTRIES, (10, 200))


@query("list_scorecard", f"""WITH {_CARD} SELECT verification, duplicate_emails, duplicate_domains, title_relevance, bad_titles, role_mailboxes,
    icp_fit, names, overall, over_concentrated, CASE WHEN overall >= 93 THEN 'A+' WHEN overall >= 90 THEN 'A' WHEN overall >= 80 THEN 'B' WHEN overall >= 70 THEN 'C'
      WHEN overall >= 60 THEN 'D' ELSE 'F' END AS grade FROM card""")
def list_scorecard(t):
    return scorecard(t).select("verification", "duplicate_emails", "duplicate_domains", "title_relevance", "bad_titles",
                               "role_mailboxes", "icp_fit", "names", "overall", "over_concentrated", "grade")


_P1 = "printf('%.1f', floor({0} * 10 + 0.5) / 10)"


@query("list_issues", f"""WITH {_CARD}, all_issues AS (
    SELECT 1 AS o, 'no verification column: verify before sending' AS issue FROM card WHERE has_status = 0
    UNION ALL SELECT 2, (n - verified) || ' emails unverified' FROM card WHERE has_status > 0 AND verification < 100
    UNION ALL SELECT 3, dupes || ' duplicate emails (' || {_P1.format('pd')} || '%)' FROM card WHERE dupes > 0
    UNION ALL SELECT 4, "role" || ' leads on shared mailboxes (' || {_P1.format('pr')} || '%)' FROM card WHERE "role" > 0
    UNION ALL SELECT 5, bad || ' bad titles (' || {_P1.format('pb')} || '%)' FROM card WHERE bad > 0
    UNION ALL SELECT 6, over_concentrated || ' domains with more than 5 leads' FROM card WHERE over_concentrated > 0
    UNION ALL SELECT 7, (n - icp) || ' leads outside the profile' FROM card WHERE icp_fit < 80
    UNION ALL SELECT 8, fake || ' rows with doubtful names' FROM card WHERE fake > n * 0.05)
    SELECT (row_number() OVER (ORDER BY o) - 1)::INTEGER AS place, issue FROM all_issues ORDER BY o LIMIT 5""")
def list_issues(t):
    return lists.list_issues(scorecard(t))


@query("bucket_counts", f"SELECT bucket, reason, count(*) AS n FROM ({SEGMENTS}) GROUP BY 1, 2")
def bucket_counts(t):
    return lists.bucket_counts(segments(t), ["bucket", "reason"])


@query("top_n", "SELECT p_type, p_brand, count(*) AS n FROM part GROUP BY 1, 2 ORDER BY n DESC, p_type, p_brand LIMIT 20")
def top_n(t):
    return lists.top_n(t("part"), ["p_type", "p_brand"], 20)


@query("ads_by_domain", """SELECT 'co' || c_custkey AS domain, max(strftime(o_orderdate, '%Y-%m-%d')) AS ads_last_shown,
    string_agg(DISTINCT nullif(CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END, ''), ',' ORDER BY nullif(CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END, '')) AS formats,
    count(o_orderkey) > 0 AS ads_runs FROM (FROM (SELECT c_custkey FROM customer) UNION ALL SELECT -s_suppkey FROM supplier) LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def ads_by_domain(t):
    ads = t("orders").select(
        F.concat(F.lit("co"), "o_custkey").alias("domain"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm").alias("last_shown"),
        F.expr("CASE o_orderstatus WHEN 'P' THEN '' ELSE o_orderstatus END").alias("format"))
    # Suppliers stand for the companies that never advertised.
    firms = t("customer").select("c_custkey").union(t("supplier").select(-F.col("s_suppkey")))
    out = lists.ads_by_domain(firms.select(F.concat(F.lit("co"), "c_custkey").alias("domain")), ads)
    return out.withColumn("formats", F.nullif("ads_formats", F.lit(""))).drop("ads_formats")


@query("work_order", """SELECT row_id, relevance, CASE WHEN relevance = 'A' THEN 0 WHEN relevance IS NULL THEN 1 WHEN relevance = 'B' THEN 2 WHEN relevance = 'C' THEN 3 ELSE 4 END AS place
    FROM list_companies ORDER BY place, row_id""")
def work_order(t):
    return lists.work_order(t("list_companies"), "row_id").select(
        "row_id", "relevance", lists.relevance_order(F.col("relevance")).alias("place"))


_PLAN = f"""{LC}, plan AS (SELECT domain, min(CASE WHEN relevance = 'A' THEN 0 WHEN relevance IS NULL THEN 1 WHEN relevance = 'B' THEN 2 ELSE 3 END) AS priority,
    max(sales_count) AS sales_count_known, max(marketing_count) AS marketing_count_known,
    CASE WHEN count(*) = count(sales_count) THEN 'skip' WHEN count(sales_count) > 0 THEN 'copy' ELSE 'count' END AS sales_count_todo,
    CASE WHEN count(*) = count(marketing_count) THEN 'skip' WHEN count(marketing_count) > 0 THEN 'copy' ELSE 'count' END AS marketing_count_todo
    FROM lc WHERE domain <> 'co3.example.com' GROUP BY 1)"""
_DEPTS = ["sales_count", "marketing_count"]


@query("department_plan", f"WITH {_PLAN} SELECT * FROM plan")
def department_plan(t):
    return lists.department_plan(keyed(t), _DEPTS, ["co3.example.com"])


@query("department_totals", f"""WITH {_PLAN}, s AS (SELECT count(*) AS domains, count(*) FILTER (WHERE sales_count_todo <> 'skip' OR marketing_count_todo <> 'skip') AS with_work,
    count(*) FILTER (WHERE sales_count_todo = 'count') AS sales_count_count, count(*) FILTER (WHERE sales_count_todo = 'copy') AS sales_count_copy,
    count(*) FILTER (WHERE marketing_count_todo = 'count') AS marketing_count_count, count(*) FILTER (WHERE marketing_count_todo = 'copy') AS marketing_count_copy FROM plan)
    SELECT *, sales_count_count + marketing_count_count AS calls, {rnd('(sales_count_count + marketing_count_count) / 95.0::DOUBLE', 1)} AS eta_minutes FROM s""")
def department_totals(t):
    return lists.department_totals(lists.department_plan(keyed(t), _DEPTS, ["co3.example.com"]), _DEPTS)


_CELLS = """count(*) FILTER (WHERE m = '0') AS m_0, count(*) FILTER (WHERE m = '1-2') AS m_1_2, count(*) FILTER (WHERE m = '3-10') AS m_3_10,
    count(*) FILTER (WHERE m = '11-50') AS m_11_50, count(*) FILTER (WHERE m = '50+') AS m_50_plus"""


@query("team_matrix", f"""WITH {LC}, c AS (SELECT coalesce({bucket('max(sales_count)')}, 'unknown') AS sales_bucket, {bucket('max(marketing_count)')} AS m, min(relevance) AS rel FROM lc GROUP BY domain)
    SELECT 'all' AS cut, sales_bucket, {_CELLS}, count(*) AS total FROM c GROUP BY 2 UNION ALL SELECT 'all', 'total', {_CELLS}, count(*) FROM c
    UNION ALL SELECT 'A', sales_bucket, {_CELLS}, count(*) FROM c WHERE rel = 'A' GROUP BY 2
    UNION ALL SELECT 'A', 'total', {_CELLS}, count(*) FROM c WHERE rel = 'A'""")
def team_matrix(t):
    rows = keyed(t)
    cut = lists.team_matrix(rows, relevance="A").select(F.lit("A").alias("cut"), "*")
    return lists.team_matrix(rows).select(F.lit("all").alias("cut"), "*").unionByName(cut)


_SCELLS = """count(*) FILTER (WHERE s = 0) AS s_0, count(*) FILTER (WHERE s IN (1, 2)) AS s_1_2, count(*) FILTER (WHERE s BETWEEN 3 AND 10) AS s_3_10,
    count(*) FILTER (WHERE s BETWEEN 11 AND 50) AS s_11_50, count(*) FILTER (WHERE s > 50) AS s_50_plus"""


@query("vertical_matrix", f"""WITH {LC}, fit AS (SELECT DISTINCT {nd('domain')} AS domain FROM profiles WHERE outbound_fit IN ('high', 'medium') AND is_b2b
      UNION SELECT 'orphan' || s_suppkey || '.example.com' FROM supplier),
    known AS (SELECT domain, min(niche) AS vertical, max(sales_count) AS s FROM lc GROUP BY 1)
    SELECT coalesce(vertical, 'no list') AS vertical, count(*) AS total, {_SCELLS} FROM fit LEFT JOIN known USING (domain) GROUP BY 1""")
def vertical_matrix(t):
    fit = t("profiles").where("outbound_fit IN ('high', 'medium') AND is_b2b").select(norm_domain(F.col("domain")).alias("domain")).distinct()
    orphans = t("supplier").select(F.concat(F.lit("orphan"), "s_suppkey", F.lit(".example.com")).alias("domain"))
    return lists.vertical_matrix(fit.unionByName(orphans), keyed(t))


_FIELDS = ("industry", "employees_on_linkedin", "sales_count", "linkedin_url", "revenue_range")


@query("field_coverage", f"""WITH {COMPANY}, fit AS (SELECT * FROM company WHERE is_b2b AND outbound_fit IN ('high', 'medium'))
    """ + " UNION ALL ".join(f"SELECT '{f}' AS field, {rnd(rate(f'count({f})', 'count(*)', 100), 2)} AS pct FROM fit" for f in _FIELDS))
def field_coverage(t):
    return lists.field_coverage(build(t)[0].where("is_b2b AND outbound_fit IN ('high', 'medium')"), _FIELDS)


@query("relevance_distribution", f"""SELECT coalesce(relevance, 'none') AS relevance, count(*) AS n,
    {rnd(rate('count(*)', '(SELECT count(*) FROM list_companies)', 100), 2)} AS pct FROM list_companies GROUP BY 1""")
def relevance_distribution(t):
    return lists.relevance_distribution(t("list_companies"))


@query("undercount_suspects", f"""SELECT row_id, reconciled, {bucket('reconciled')} AS reconciled_bucket FROM (
    SELECT *, greatest(sales_count, alt_sales_count) AS reconciled FROM list_companies WHERE sales_count = 0 AND staff_linkedin > 50)""")
def undercount_suspects(t):
    return lists.undercount_suspects(t("list_companies")).select("row_id", "reconciled", "reconciled_bucket")


@query("inflated_counts", """SELECT row_id, coalesce(staff_linkedin > 3 * (coalesce(sales_count, 0) + coalesce(marketing_count, 0)), false) AS inflated,
    coalesce(sales_count > 60, false) AS review FROM list_companies
    WHERE staff_linkedin > 3 * (coalesce(sales_count, 0) + coalesce(marketing_count, 0)) OR sales_count > 60""")
def inflated_counts(t):
    return lists.inflated_counts(t("list_companies"), 3, 60).select("row_id", "inflated", "review")


@query("enrichment_funnel", """WITH f AS (SELECT coalesce(contains(email, '@'), false) AS had, coalesce(linkedin_url IS NOT NULL AND id % 3 = 0, false) AS found,
      CASE email_status WHEN 'verified' THEN 'ok' WHEN 'invalid' THEN 'invalid' ELSE 'skip' END AS v FROM contacts)
    SELECT count(*) AS total, count(*) FILTER (WHERE had) AS already_had, count(*) FILTER (WHERE NOT had AND found) AS hits,
      count(*) FILTER (WHERE NOT had AND NOT found) AS misses, count(*) FILTER (WHERE (had OR found) AND v = 'ok') AS valid,
      count(*) FILTER (WHERE (had OR found) AND v = 'invalid') AS invalid, count(*) FILTER (WHERE (had OR found) AND v = 'skip') AS unchecked,
      count(*) FILTER (WHERE (had OR found) AND v <> 'invalid') AS final FROM f""")
def enrichment_funnel(t):
    rows = t("contacts").select(
        "email", F.expr("CASE WHEN linkedin_url IS NOT NULL AND id % 3 = 0 THEN 'x@y' END").alias("found_email"),
        F.expr("CASE email_status WHEN 'verified' THEN 'ok' WHEN 'invalid' THEN 'invalid' END").alias("verdict"))
    return lists.enrichment_funnel(rows)


@query("capped_count", """SELECT least(count(*), 10001) AS total_matching, count(*) > 10000 AS is_minimum, least(count(*), 50000) AS exportable_rows,
    count(*) > 50000 AS export_capped FROM contacts WHERE email_status <> 'invalid'""")
def capped_count(t):
    return lists.capped_count(t("contacts").where("email_status <> 'invalid'"), 10000)


@query("multi_niche", f"""WITH {LC}, d AS (SELECT domain, count(*) AS n, count(DISTINCT niche) AS k FROM lc GROUP BY 1)
    SELECT sum(n)::BIGINT AS "rows", count(*) AS domains, count(*) FILTER (WHERE k >= 2) AS multi_niche FROM d""")
def multi_niche(t):
    return lists.multi_niche(keyed(t))


@query("assign_batches", """SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_no,
    (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 80 AS batch_id FROM orders""")
def assign_batches(t):
    return lists.assign_batches(t("orders").select("o_orderkey", "o_orderdate"), [F.asc("o_orderdate"), F.asc("o_orderkey")], 80) \
        .select("o_orderkey", "row_no", "batch_id")


@query("shard", f"""WITH {LC} SELECT domain, (('0x' || substr(md5(domain), 1, 8))::BIGINT % 7)::BIGINT AS shard, count(*) AS n FROM lc GROUP BY 1, 2""")
def shard(t):
    return keyed(t).groupBy("domain", lists.shard(F.col("domain"), 7).alias("shard")).agg(F.count(F.lit(1)).alias("n"))


@query("stratified_sample", """SELECT doc_id, lang, stratum FROM (SELECT *, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 3000 THEN 'medium' ELSE 'long' END AS stratum FROM documents)
    QUALIFY row_number() OVER (PARTITION BY lang, stratum ORDER BY md5(doc_id::VARCHAR), doc_id) <= 5""")
def stratified_sample(t):
    stratum = F.when(F.col("n_chars") < 500, "short").when(F.col("n_chars") < 3000, "medium").otherwise("long")
    return lists.stratified_sample(t("documents").select("doc_id", "lang", stratum.alias("stratum")), ["lang", "stratum"], "doc_id", 5)


@query("split_search", """WITH f AS (SELECT o_orderstatus, o_orderpriority, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_orderstatus) AS w FROM orders GROUP BY 1, 2)
    SELECT o_orderstatus, CASE WHEN w > (SELECT count(*) / 3.0 FROM orders) THEN o_orderpriority END AS o_orderpriority, sum(n)::BIGINT AS n,
      sum(n) <= (SELECT count(*) / 3.0 FROM orders) AS fits FROM f GROUP BY 1, 2""")
def split_search(t):
    orders = t("orders")
    cap = orders.agg((F.count(F.lit(1)) / 3).alias("cap")).scalar()
    return lists.split_search(orders, cap, "o_orderstatus", "o_orderpriority")


@query("union_lenses", """WITH r AS (SELECT 0 AS p, 'urgent' AS lens, o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'
    UNION ALL SELECT 1, 'open', o_custkey FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 2, 'all', c_custkey FROM customer),
    f AS (SELECT k, min(p) AS p FROM r GROUP BY 1)
    SELECT lens, count(DISTINCT k) AS found, (SELECT count(*) FROM f WHERE f.p = r.p) AS added FROM r GROUP BY lens, r.p""")
def union_lenses(t):
    orders = t("orders").withColumn("k", F.col("o_custkey"))
    return lists.union_lenses({"urgent": orders.where("o_orderpriority = '1-URGENT'"), "open": orders.where("o_orderstatus = 'O'"),
                               "all": t("customer").select(F.col("c_custkey").alias("k"))}, "k")


@query("overlap", """WITH a AS (SELECT DISTINCT lead FROM sends), b AS (SELECT DISTINCT lead FROM replies WHERE label = 'positive_soft')
    SELECT (SELECT count(*) FROM a) AS size_a, (SELECT count(*) FROM b) AS size_b, (SELECT count(*) FROM (FROM a INTERSECT FROM b)) AS both,
      (SELECT count(*) FROM (FROM a UNION FROM b)) AS either, (SELECT count(*) FROM (FROM b EXCEPT FROM a)) AS gain""")
def overlap(t):
    out = lists.overlap(t("sends"), t("replies").where("label = 'positive_soft'"), "lead")
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in out.columns])


@query("known_vs_new", f"""WITH {LC} SELECT DISTINCT {nd('domain')} AS domain, CASE WHEN {nd('domain')} IN (SELECT domain FROM lc) THEN 'known' ELSE 'new' END AS status
    FROM companies WHERE {nd('domain')} IS NOT NULL""")
def known_vs_new(t):
    fresh = t("companies").select(norm_domain(F.col("domain")).alias("domain")).where("domain IS NOT NULL")
    return lists.known_vs_new(fresh, keyed(t), "domain")


@query("lookalike", """WITH seed AS (SELECT * FROM embeddings WHERE label = 3),
    dims AS (SELECT i, avg(embedding[i]::DOUBLE) AS m FROM seed, (SELECT unnest(range(1, (SELECT max(len(embedding)) + 1 FROM embeddings))) AS i) GROUP BY 1),
    cent AS (SELECT list(m ORDER BY i) AS c FROM dims)
    SELECT vec_id, floor(s * 10000 + 0.5)::BIGINT AS score, CASE WHEN s >= 0.2 THEN 'A' WHEN s >= 0.1 THEN 'B' ELSE 'C' END AS relevance FROM (
      SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], c) AS s FROM embeddings, cent WHERE label <> 3 AND label % 4 IN (0, 1)
        AND vec_id % 300 BETWEEN 20 AND 250) ORDER BY s DESC, vec_id LIMIT 50""")
def lookalike(t):
    seeds = t("embeddings").where("label = 3").select("vec_id")
    firms = t("embeddings").withColumns({"country": F.concat(F.lit("c"), F.col("label") % 4), "headcount": F.col("vec_id") % 300})
    out = lists.lookalike(firms, seeds, "vec_id", "embedding", 50, ((0.2, "A"), (0.1, "B")), ["c0", "c1"], (20, 250))
    return out.select("vec_id", F.floor(F.col("score") * 10000 + 0.5).alias("score"), "relevance")
