"""Queries over the canonical company and contact build."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions.keys import norm_domain
from leadgrid.operators import entity
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import nd
from leadgrid.session import written

LC = f"lc AS (SELECT {nd('domain')} AS nd, * FROM list_companies WHERE {nd('domain')} IS NOT NULL)"
BEST = """best AS (SELECT * FROM lc QUALIFY row_number() OVER (
    PARTITION BY nd ORDER BY staff_linkedin DESC NULLS LAST, updated_at DESC NULLS LAST, row_id) = 1)"""
AGG = """agg AS (SELECT nd, max(staff_linkedin) AS employees_on_linkedin, max(sales_count) AS sales_count,
    max(marketing_count) AS marketing_count, list_sort(list(DISTINCT niche)) AS niches,
    list_sort(list(DISTINCT source)) AS sources FROM lc GROUP BY nd)"""
FILL = r"""fill AS (SELECT nd, max(meta_linkedin) AS li, max(meta_revenue_range) AS rr,
    nullif(max(CASE WHEN regexp_full_match(meta_staff, '[0-9]+') THEN TRY_CAST(meta_staff AS INTEGER) END), 0) AS st
    FROM lc GROUP BY nd)"""
REGISTRY = f"""reg AS (SELECT {nd('domain')} AS nd, * FROM companies WHERE {nd('domain')} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {nd('domain')} ORDER BY updated_at DESC NULLS LAST, id) = 1)"""
PROFILES = f"""prof AS (SELECT {nd('domain')} AS nd, * FROM profiles WHERE {nd('domain')} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {nd('domain')} ORDER BY updated_at DESC NULLS LAST, profile_id) = 1)"""
# The whole build, written as unions of keys and lookups rather than as outer joins.
COMPANY = f"""{LC}, {BEST}, {AGG}, {FILL}, {REGISTRY}, {PROFILES},
keys AS (SELECT nd FROM agg UNION SELECT nd FROM reg UNION SELECT nd FROM prof),
crawled AS (SELECT DISTINCT {nd('domain')} AS nd FROM crawl_log WHERE ok),
company0 AS (SELECT k.nd AS domain, coalesce(b.name, r.name) AS name, r.website, coalesce(b.meta_description, r.description, r.description_short) AS description,
    coalesce(nullif(b.meta_linkedin, ''), f.li, r.linkedin_url) AS linkedin_url,
    coalesce(nullif(b.meta_linkedin, ''), f.li) IS NOT NULL OR r.linkedin_url IS NOT NULL AS has_linkedin,
    coalesce(a.employees_on_linkedin, f.st) AS employees_on_linkedin, r.employee_count,
    coalesce(b.company_size, r.size_bucket) AS size_bucket, coalesce(nullif(b.industry, ''), r.industry) AS industry,
    coalesce(b.meta_revenue_range, f.rr) AS revenue_range, b.meta_founded_year AS founded_year, coalesce(b.meta_country, r.hq_country) AS hq_country,
    coalesce(b.meta_state, r.hq_state) AS hq_state, coalesce(b.meta_city, r.hq_city) AS hq_city,
    a.sales_count, b.sales_bucket, a.marketing_count, b.marketing_bucket,
    list_sort(list_concat(coalesce(a.sources, []), CASE WHEN r.nd IS NULL THEN [] ELSE ['directory'] END,
      CASE WHEN p.nd IS NULL THEN [] ELSE ['crawl'] END)) AS sources, a.niches,
    p.business_model, p.is_b2b, p.outbound_fit, p.what_they_sell, p.primary_customer,
    coalesce(p.profile_status = 'accepted', false) AS classified,
    coalesce(p.source_crawl_ok, false) OR c.nd IS NOT NULL AS crawled
  FROM keys k LEFT JOIN agg a ON a.nd = k.nd LEFT JOIN best b ON b.nd = k.nd LEFT JOIN fill f ON f.nd = k.nd
  LEFT JOIN reg r ON r.nd = k.nd LEFT JOIN prof p ON p.nd = k.nd LEFT JOIN crawled c ON c.nd = k.nd),
contact AS (SELECT * FROM (SELECT ct.*, coalesce(
    (SELECT {nd('co.domain')} FROM companies co WHERE co.id = ct.company_id),
    {nd("CASE WHEN contains(ct.email, '@') THEN split_part(ct.email, '@', 2) END")}) AS company_domain FROM contacts ct) x
  WHERE company_domain IN (SELECT domain FROM company0)),
company AS (SELECT c.*, coalesce(n.n, 0) AS n_contacts, coalesce(n.li, 0) AS linkedin_contacts, n.n IS NOT NULL AS has_contacts
  FROM company0 c LEFT JOIN (SELECT company_domain, count(*) AS n, count(linkedin_url) AS li FROM contact GROUP BY 1) n
  ON n.company_domain = c.domain)"""

WIDE = ("domain", "name", "website", "description", "linkedin_url", "has_linkedin", "employees_on_linkedin",
        "employee_count", "size_bucket", "industry", "revenue_range", "founded_year", "hq_country", "hq_state", "hq_city",
        "sales_count", "sales_bucket", "marketing_count", "marketing_bucket", "business_model", "is_b2b", "outbound_fit", "what_they_sell", "primary_customer",
        "classified", "crawled")


def build(t, store=None):
    return entity.canonical_tables(t("list_companies"), t("companies"), t("profiles"), t("crawl_log"), t("contacts"), store)


def joined(col):
    return F.array_join(F.coalesce(col, F.array().cast("array<string>")), ",").alias(col)


@query("agg_by_domain", f"""WITH {LC}, {AGG} SELECT * EXCLUDE (niches, sources),
    array_to_string(niches, ',') AS niches, array_to_string(sources, ',') AS sources FROM agg""")
def agg_by_domain(t):
    out = entity.agg_by_domain(t("list_companies"))
    return out.withColumns({c: F.array_join(c, ",") for c in ("niches", "sources")})


@query("best_row_per_key", f"WITH {LC}, {BEST} SELECT nd, row_id, staff_linkedin, updated_at FROM best")
def best_row_per_key(t):
    rows = entity.with_domain(t("list_companies")).select("nd", "row_id", "staff_linkedin", "updated_at")
    return entity.best_row_per_key(rows, "nd", "row_id")


@query("latest_per_key", f"WITH {PROFILES} SELECT nd, profile_id, updated_at FROM prof")
def latest_per_key(t):
    rows = entity.with_domain(t("profiles")).select("nd", "profile_id", "updated_at")
    return entity.latest_per_key(rows, "nd", "profile_id")


@query("agg_with_best", f"""WITH {LC}, {BEST}, {AGG} SELECT nd, employees_on_linkedin, agg.sales_count,
    agg.marketing_count, best.name, best.company_size FROM agg JOIN best USING (nd)""")
def agg_with_best(t):
    return entity.agg_with_best(t("list_companies"), ["name", "company_size"]).drop("niches", "sources")


@query("fill_from", f"""WITH {LC}, {BEST}, {FILL} SELECT nd, coalesce(b.meta_linkedin, li) AS linkedin_url,
    coalesce(b.meta_revenue_range, rr) AS revenue_range, coalesce(b.staff_linkedin, st) AS employees_on_linkedin
    FROM best b JOIN fill USING (nd)""")
def fill_from(t):
    rows = entity.with_domain(t("list_companies")).select(
        "nd", "row_id", "staff_linkedin", "updated_at", "meta_linkedin", "meta_revenue_range")
    base = entity.best_row_per_key(rows, "nd", "row_id").select(
        "nd", F.col("meta_linkedin").alias("linkedin_url"), F.col("meta_revenue_range").alias("revenue_range"),
        F.col("staff_linkedin").alias("employees_on_linkedin"))
    return entity.fill_from(base, "nd", entity.meta_fillers(t("list_companies")),
                            ["linkedin_url", "revenue_range", "employees_on_linkedin"])


@query("merge_sources", f"""WITH {COMPANY} SELECT {', '.join(WIDE)}, array_to_string(sources, ',') AS sources,
    coalesce(array_to_string(niches, ','), '') AS niches FROM company0""")
def merge_sources(t):
    out = entity.canonical_company(t("list_companies"), t("companies"), t("profiles"), t("crawl_log"))
    return out.select(*WIDE, joined("sources"), joined("niches"))


@query("mark_exists", f"""SELECT id, {nd('domain')} AS domain, coalesce({nd('domain')} IN (
    SELECT {nd('domain')} FROM crawl_log WHERE ok), false) AS crawled FROM companies""")
def mark_exists(t):
    base = t("companies").select("id", norm_domain(F.col("domain")).alias("domain"))
    crawls = t("crawl_log").where("ok").select(norm_domain(F.col("domain")).alias("domain"))
    return entity.mark_exists(base, "domain", crawls, "crawled")


@query("relink_contacts", f"WITH {COMPANY} SELECT id, company_domain, email, linkedin_url FROM contact")
def relink_contacts(t):
    return build(t)[1].select("id", "company_domain", "email", "linkedin_url")


@query("backfill_contact_signals", f"WITH {COMPANY} SELECT domain, n_contacts, linkedin_contacts, has_contacts FROM company")
def backfill_contact_signals(t):
    return build(t)[0].select("domain", "n_contacts", "linkedin_contacts", "has_contacts")


@query("outbound_ready", f"""WITH {COMPANY} SELECT domain, name, outbound_fit, n_contacts FROM company c
    WHERE is_b2b IS TRUE AND outbound_fit IN ('high', 'medium') AND has_contacts
      AND EXISTS (SELECT 1 FROM contact ct WHERE ct.company_domain = c.domain AND ct.email IS NOT NULL)""")
def outbound_ready(t):
    return entity.outbound_ready(*build(t, written)).select("domain", "name", "outbound_fit", "n_contacts")


_COUNTS = """count(*) AS total_companies, count(CASE WHEN has_linkedin THEN 1 END) AS with_linkedin_url,
    count(CASE WHEN employees_on_linkedin >= 1 THEN 1 END) AS with_employee_headcount, count(CASE WHEN linkedin_contacts >= 1 THEN 1 END) AS with_linkedin_contacts,
    count(CASE WHEN has_contacts THEN 1 END) AS with_any_contact, count(CASE WHEN crawled THEN 1 END) AS crawled,
    count(CASE WHEN classified THEN 1 END) AS classified, count(CASE WHEN is_b2b THEN 1 END) AS b2b,
    count(CASE WHEN outbound_fit = 'high' OR outbound_fit = 'medium' THEN 1 END) AS outbound_fit_ok"""


@query("coverage", f"WITH {COMPANY} SELECT {_COUNTS} FROM company")
def coverage(t):
    return entity.coverage(build(t)[0])


@query("coverage_report", f"""WITH {COMPANY}, wide AS (SELECT {_COUNTS} FROM company)
    SELECT metric, value FROM (UNPIVOT wide ON COLUMNS(*) INTO NAME metric VALUE value)
    UNION ALL SELECT 'contacts', count(*) FROM contact UNION ALL SELECT 'with_email', count(email) FROM contact
    UNION ALL SELECT 'with_linkedin', count(linkedin_url) FROM contact
    UNION ALL SELECT 'outbound_ready', count(*) FROM company c WHERE is_b2b IS TRUE AND outbound_fit IN ('high', 'medium')
      AND domain IN (SELECT company_domain FROM contact WHERE email IS NOT NULL)""")
def coverage_report(t):
    company, contact = build(t, written)
    # Both tables are stored once and then reported on, as a rebuild does.
    return entity.coverage_report(company, written(contact.select("company_domain", "email", "linkedin_url"), "contact"))


@query("report_union", """SELECT 'orders' AS metric, count(*) AS value FROM orders
    UNION ALL SELECT 'customers', count(*) FROM customer UNION ALL SELECT 'open_orders', count(*) FROM orders WHERE o_orderstatus = 'O'""")
def report_union(t):
    orders = t("orders").agg(F.count(F.lit(1)).alias("orders"),
                             F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"))
    return entity.report_union([orders, t("customer").agg(F.count(F.lit(1)).alias("customers"))])


@query("union_sources", """SELECT row_id, array_to_string(list_sort(list_distinct([source, niche, 'atlas'])), ',') AS sources
    FROM list_companies""")
def union_sources(t):
    merged = entity.union_sources(F.array("source", "niche"), F.array(F.lit("atlas"), F.col("source")))
    return t("list_companies").select("row_id", F.array_join(merged, ",").alias("sources"))


@query("match_registry", f"""
    WITH c AS (SELECT name_key, min(domain) AS domain FROM (SELECT trim(regexp_replace(lower(name), '[^a-z0-9]+', ' ', 'g')) AS name_key,
        {nd('domain')} AS domain FROM companies) GROUP BY 1)
    SELECT c_custkey, coalesce(l.domain, r.domain) AS domain,
      CASE WHEN l.name_key IS NOT NULL THEN 'legal_name' WHEN r.name_key IS NOT NULL THEN 'trade_name' END AS matched_by
    FROM customer LEFT JOIN (SELECT * FROM c WHERE domain IS NOT NULL) l
        ON l.name_key = CASE WHEN c_custkey % 2 = 0 THEN 'supplier ' || lpad(c_custkey::VARCHAR, 9, '0') END
      LEFT JOIN (SELECT * FROM c WHERE domain IS NOT NULL) r ON r.name_key = 'supplier ' || lpad((c_custkey // 3)::VARCHAR, 9, '0')""")
def match_registry(t):
    firms = t("companies").select("name", norm_domain(F.col("domain")).alias("domain")).where("domain IS NOT NULL")
    registry = t("customer").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 2 = 0 THEN concat('SUPPLIER - ', lpad(c_custkey, 9, '0')) END").alias("legal_name"),
        F.expr("concat('Supplíer#', lpad(c_custkey div 3, 9, '0'))").alias("trade_name"))
    return entity.match_registry(registry, firms, "c_custkey").select("c_custkey", "domain", "matched_by")


@query("join_crawl_registry", f"""
    WITH {PROFILES}, {REGISTRY}, crawl AS (SELECT {nd('domain')} AS nd, crawl_id FROM crawl_log
      QUALIFY row_number() OVER (PARTITION BY {nd('domain')} ORDER BY crawled_at DESC, crawl_id) = 1)
    SELECT nd, crawl_id, profile_id, reg.id FROM crawl JOIN prof USING (nd) JOIN reg USING (nd)""")
def join_crawl_registry(t):
    def newest(name, id_col, time_col="updated_at"):
        rows = entity.with_domain(t(name)).select("nd", id_col, time_col)
        return entity.latest_per_key(rows, "nd", id_col, time_col).select("nd", id_col)
    return entity.join_crawl_registry(newest("crawl_log", "crawl_id", "crawled_at"),
                                      newest("profiles", "profile_id"), newest("companies", "id"))


@query("lead_master", f"""
    WITH rows AS (SELECT 'company' AS record_type, 'domain:' || {nd('domain')} AS master_key, 'domain' AS basis, {nd('domain')} AS source_id
        FROM companies WHERE {nd('domain')} IS NOT NULL
      UNION ALL SELECT 'person', coalesce('email:' || lower(email), 'linkedin:' || linkedin_url,
        'name:' || lower(first_name) || ' ' || lower(last_name) || '@' || 'co' || company_id),
        CASE WHEN email IS NOT NULL THEN 'email' WHEN linkedin_url IS NOT NULL THEN 'linkedin' ELSE 'name' END,
        lpad(id::VARCHAR, 20, '0') FROM contacts)
    SELECT master_key, record_type, basis, source_id, n_rows FROM (SELECT *, count(*) OVER (PARTITION BY master_key) AS n_rows,
      row_number() OVER (PARTITION BY master_key ORDER BY source_id) AS rn FROM rows) WHERE rn = 1""")
def lead_master(t):
    firms = t("companies").select(norm_domain(F.col("domain")).alias("domain")).where("domain IS NOT NULL")
    people = t("contacts").withColumn("company_domain", F.concat(F.lit("co"), F.col("company_id")))
    return entity.lead_master(firms, people)
