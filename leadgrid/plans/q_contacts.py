"""Queries over people."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions.keys import norm_domain
from leadgrid.operators import contacts
from leadgrid.plans import vocab
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import hits, nd

RANKS = {"small": vocab.SMALL_BUYERS, "leaders": vocab.SALES_LEADERS, "words": vocab.SALES_WORDS}
NOW = "1999-06-01 00:00:00"


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def _rank(small: str) -> str:
    def has(words):
        return f"len({hits('title', words)}) > 0"
    a, b = has(vocab.SMALL_BUYERS), has(vocab.SALES_LEADERS)
    return (f"CASE WHEN title = '' THEN 0 WHEN ({small}) AND {a} OR NOT ({small}) AND {b} THEN 100 "
            f"WHEN {a} OR {b} THEN 70 WHEN {has(vocab.SALES_WORDS)} THEN 30 ELSE 0 END")


@query("title_rank", f"SELECT id, {_rank('company_id % 2 = 0')} AS title_rank FROM contacts")
def title_rank(t):
    rank = contacts.title_rank(F.col("title"), F.col("company_id") % 2 == 0, *RANKS.values())
    return t("contacts").select("id", rank.alias("title_rank"))


CANDIDATES = f"""cand AS (SELECT *, CASE WHEN email <> '' AND email_status = 'verified' THEN 'email' WHEN linkedin_url IS NOT NULL THEN 'linkedin' END AS channel
    FROM contacts WHERE NOT do_not_contact AND NOT coalesce(last_contacted_at > TIMESTAMP '{NOW}' - INTERVAL 90 DAY, false))"""


@query("choose_contact", f"""WITH {CANDIDATES} SELECT company_id, id, channel, {_rank('false')} AS title_rank FROM cand WHERE channel IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY channel, title_rank DESC, id) = 1""")
def choose_contact(t):
    people = contacts.contact_candidates(t("contacts"), at(NOW), 90, ["Verified"])
    rank = contacts.title_rank(F.col("title"), F.lit(False), *RANKS.values())
    return contacts.choose_contact(people, ["company_id"], rank, "id").select("company_id", "id", "channel", "title_rank")


MATCHED = f"""{CANDIDATES}, firm AS (SELECT {nd('domain')} AS nd, * FROM companies WHERE {nd('domain')} IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY {nd('domain')} ORDER BY id) = 1),
    sig AS (SELECT row_id, {nd('domain')} AS nd, CASE WHEN row_id % 10 = 0 THEN 0 WHEN row_id % 3 = 0 THEN staff_linkedin END AS n FROM list_companies),
    placed AS (SELECT row_id, CASE WHEN NOT f.do_not_contact THEN f.id END AS company_id, coalesce(coalesce(nullif(n, 0), f.employee_count) <= 20, false) AS small
      FROM sig LEFT JOIN firm f USING (nd)),
    ranked AS (SELECT *, {_rank('true')} AS rs, {_rank('false')} AS rl FROM cand WHERE channel IS NOT NULL),
    matched AS (SELECT p.row_id, p.company_id, p.small, r.id AS contact_id, r.channel FROM placed p LEFT JOIN ranked r ON r.company_id = p.company_id
      QUALIFY row_number() OVER (PARTITION BY p.row_id ORDER BY r.channel, CASE WHEN small THEN rs ELSE rl END DESC, r.id) = 1)"""


def matched(t):
    domain = norm_domain(F.col("domain"))
    signals = t("list_companies").select(
        "row_id", domain.alias("company_domain"),
        F.expr("CASE WHEN row_id % 10 = 0 THEN 0 WHEN row_id % 3 = 0 THEN staff_linkedin END").alias("company_employee_count"))
    firms = t("companies").withColumn("domain", domain).where("domain IS NOT NULL")
    return contacts.match_contacts(signals, firms, t("contacts"), at(NOW), 90, ["verified"], RANKS, "row_id")


@query("match_contacts", f"""WITH {MATCHED} SELECT row_id, company_id, contact_id, coalesce(channel, 'unmatched') AS outcome,
    CASE WHEN company_id IS NULL THEN NULL WHEN small THEN 'founder_or_ceo' ELSE 'sales_leader' END AS buyer_role_hint FROM matched""")
def match_contacts(t):
    return matched(t).select("row_id", "company_id", "contact_id", "outcome", "buyer_role_hint")


@query("match_outcomes", f"""WITH {MATCHED} SELECT count(*) AS signals, count(*) FILTER (WHERE channel = 'email') AS email,
    count(*) FILTER (WHERE channel = 'linkedin') AS linkedin, count(*) FILTER (WHERE channel IS NULL) AS unmatched FROM matched""")
def match_outcomes(t):
    return contacts.match_outcomes(matched(t))


@query("cap_per_company", """SELECT company_id, id, seniority FROM contacts
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY seniority, id) <= 3""")
def cap_per_company(t):
    return contacts.cap_per_company(t("contacts").select("company_id", "id", "seniority"), "company_id",
                                    [F.asc("seniority"), F.asc("id")], 3)


# Rounds over all rows: an undecided row that is first for each of its keys is kept, rows that share a key with it go.
@query("dedupe_either_key", """WITH RECURSIVE s(round, id, linkedin_url, email, k1, k2, st) AS (
      SELECT 0, id, linkedin_url, email, nullif(linkedin_url, ''), nullif(email, ''),
        CASE WHEN nullif(linkedin_url, '') IS NULL AND nullif(email, '') IS NULL THEN 'kept' ELSE 'open' END FROM contacts
      UNION ALL
      SELECT round + 1, id, linkedin_url, email, k1, k2, CASE WHEN st <> 'open' THEN st WHEN wins THEN 'kept'
        WHEN (k1 IS NOT NULL AND bool_or(wins) OVER (PARTITION BY k1)) OR (k2 IS NOT NULL AND bool_or(wins) OVER (PARTITION BY k2)) THEN 'gone' ELSE 'open' END
      FROM (SELECT *, st = 'open' AND (k1 IS NULL OR id = first1) AND (k2 IS NULL OR id = first2) AS wins FROM (
        SELECT *, min(CASE WHEN st = 'open' THEN id END) OVER (PARTITION BY k1) AS first1,
          min(CASE WHEN st = 'open' THEN id END) OVER (PARTITION BY k2) AS first2, bool_or(st = 'open') OVER () AS more FROM s) WHERE more))
    SELECT id, linkedin_url, email FROM s WHERE st = 'kept' AND round = (SELECT max(round) FROM s)""")
def dedupe_either_key(t):
    people = t("contacts").select("id", "linkedin_url", "email")
    return contacts.dedupe_either_key(people, "id", ["linkedin_url", "email"])


@query("suppress_contacted", """SELECT c_custkey AS lead FROM customer WHERE c_custkey NOT IN (
    SELECT lead FROM sends WHERE sent_at > TIMESTAMP '2024-02-15 12:00:00' - INTERVAL 20 DAY)""")
def suppress_contacted(t):
    leads = t("customer").select(F.col("c_custkey").alias("lead"))
    return contacts.suppress_contacted(leads, t("sends"), "lead", at("2024-02-15 12:00:00"), 20)


@query("pending", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def pending(t):
    done = t("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return contacts.pending(t("customer").select("c_custkey", "c_name"), done, ["c_custkey"])


@query("unused_angle", """SELECT DISTINCT lead, campaign_id % 10 AS angle FROM replies r
    WHERE NOT EXISTS (SELECT 1 FROM sends s WHERE s.lead = r.lead AND s.campaign_id % 10 = r.campaign_id % 10)""")
def unused_angle(t):
    angle = (F.col("campaign_id") % 10).alias("angle")
    return contacts.unused_angle(t("replies").select("lead", angle).distinct(), t("sends").select("lead", angle))


@query("merge_personalization", """SELECT o_orderkey AS lead_id,
    max(CASE WHEN l_returnflag = 'A' THEN l_linestatus || l_linenumber END) AS line_A, max(CASE WHEN l_returnflag = 'N' THEN l_linestatus || l_linenumber END) AS line_N,
    max(CASE WHEN l_returnflag = 'R' THEN l_linestatus || l_linenumber END) AS line_R, max(CASE WHEN l_returnflag = 'A' THEN l_quantity END) AS value_A,
    max(CASE WHEN l_returnflag = 'N' THEN l_quantity END) AS value_N, max(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS value_R
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""")
def merge_personalization(t):
    lines = t("lineitem").select(F.col("l_orderkey").alias("lead_id"), F.col("l_returnflag").alias("variant"),
                                 F.concat("l_linestatus", "l_linenumber").alias("line"), F.col("l_quantity").alias("value"))
    leads = t("orders").select(F.col("o_orderkey").alias("lead_id"))
    return contacts.merge_personalization(leads, lines, "lead_id", ["A", "N", "R"], ["line", "value"])


@query("engagers", """SELECT lead AS person, 'co' || lead % 40 AS person_domain, count(*) AS total, count(DISTINCT campaign_id) AS targets,
    max(ts) AS last_at FROM mail_events WHERE ts BETWEEN TIMESTAMP '2024-01-25' - INTERVAL 10 DAY AND TIMESTAMP '2024-01-25'
    AND 'co' || lead % 40 NOT IN (SELECT 'co' || s_suppkey FROM supplier WHERE s_suppkey % 7 = 0) GROUP BY 1, 2""")
def engagers(t):
    seen = t("mail_events").select(F.col("lead").alias("person"), F.concat(F.lit("co"), F.col("lead") % 40).alias("person_domain"),
                                   F.col("campaign_id").alias("target"), "ts")
    inside = t("supplier").where("s_suppkey % 7 = 0").select(F.concat(F.lit("co"), "s_suppkey").alias("person_domain"))
    return contacts.engagers(seen, inside, at("2024-01-25 00:00:00"), 10)


_REQ = """req AS (SELECT c_custkey AS rid, CASE WHEN c_custkey % 4 = 0 THEN 'P' || c_custkey || '@co' || c_custkey // 3 || '.example.com' END AS email,
    CASE WHEN c_custkey % 3 = 0 THEN 'https://linkedin.example/in/u' || c_custkey END AS linkedin_url, 'First' || c_custkey % 977 AS first_name,
    'Last' || c_custkey AS last_name, 'co' || c_custkey AS domain, CASE WHEN c_custkey % 2 = 0 THEN '+1' || c_custkey END AS phone FROM customer)"""


@query("enrich_people", f"""WITH {_REQ}, ppl AS (SELECT *, 'co' || company_id AS domain FROM contacts),
    e AS (SELECT lower(email) AS k, min(id) AS p FROM ppl WHERE email <> '' GROUP BY 1),
    l AS (SELECT lower(linkedin_url) AS k, min(id) AS p FROM ppl WHERE linkedin_url <> '' GROUP BY 1),
    n0 AS (SELECT lower(first_name) AS f, lower(last_name) AS s, domain AS d, id FROM ppl WHERE last_name <> ''
      UNION SELECT lower(first_name), lower(last_name), lower(split_part(email, '@', 2)), id FROM ppl WHERE last_name <> '' AND contains(email, '@')),
    rn AS (SELECT rid, lower(first_name) AS f, lower(last_name) AS s, domain AS d FROM req
      UNION SELECT rid, lower(first_name), lower(last_name), lower(split_part(email, '@', 2)) FROM req WHERE contains(email, '@')),
    n AS (SELECT rid AS k, min(id) AS p FROM rn JOIN n0 USING (f, s, d) GROUP BY 1),
    h AS (SELECT phone AS k, min(id) AS p FROM ppl WHERE phone <> '' GROUP BY 1)
    SELECT rid, coalesce(e.p, l.p, n.p, h.p) AS person_id, CASE WHEN e.p IS NOT NULL THEN 'email' WHEN l.p IS NOT NULL THEN 'linkedin'
      WHEN n.p IS NOT NULL THEN 'name' WHEN h.p IS NOT NULL THEN 'phone' END AS resolved_by, coalesce(e.p, l.p, n.p, h.p) IS NOT NULL AS success
    FROM req LEFT JOIN e ON e.k = lower(req.email) LEFT JOIN l ON l.k = lower(req.linkedin_url)
      LEFT JOIN n ON n.k = req.rid LEFT JOIN h ON h.k = req.phone""")
def enrich_people(t):
    sql = _REQ[len("req AS ("):-1].replace("c_custkey // 3", "c_custkey div 3").replace("FROM customer", "FROM {customer}")
    requests = t.spark.sql(sql, customer=t("customer"))
    people = t("contacts").withColumn("domain", F.concat(F.lit("co"), "company_id"))
    return contacts.enrich_people(requests, people, "rid").select("rid", "person_id", "resolved_by", "success")


@query("contact_per_persona", """WITH p AS (SELECT id, company_id, unnest(list_filter([
        CASE WHEN contains(lower(title), 'founder') OR contains(lower(title), 'ceo') THEN 'owner' END,
        CASE WHEN contains(lower(title), 'sales') AND NOT contains(lower(title), 'coordinator') THEN 'sales_lead' END,
        CASE WHEN contains(lower(title), 'marketing') THEN 'marketing_lead' END], lambda x: x IS NOT NULL)) AS persona, last_contacted_at FROM contacts)
    SELECT company_id, persona, id FROM p QUALIFY row_number() OVER (PARTITION BY company_id, persona ORDER BY last_contacted_at DESC NULLS LAST, id) = 1""")
def contact_per_persona(t):
    personas = {"owner": (("founder", "CEO"), ()), "sales_lead": (("sales",), ("coordinator",)), "marketing_lead": (("marketing",), ())}
    people = t("contacts").select("id", "company_id", "title", "last_contacted_at")
    best = contacts.contact_per_persona(people, "company_id", personas, [F.desc_nulls_last("last_contacted_at"), F.asc("id")])
    return best.select("company_id", "persona", "id")


FIELDS = {
    "job_titles": ("substring", "title"), "seniority": ("alias", "seniority"), "email_status": ("in", "email_status"),
    "exclude_titles": ("not_substring", "title"), "require_email": ("present", "email"), "revenue_min": ("min", "revenue"),
    "revenue_max": ("max", "revenue"), "exclude_companies": ("not_in", "company_id"), "email_address": ("equals", "email"),
    "blocked": ("flag", "do_not_contact"), "employees_min": ("overlap_min", ("lo", "hi")), "employees_max": ("overlap_max", ("lo", "hi")),
}


@query("contact_search", """SELECT id, company_id, title FROM (SELECT *, company_id % 50 AS lo, CASE WHEN company_id % 4 <> 0 THEN company_id % 50 + 20 END AS hi FROM contacts)
    WHERE (contains(lower(title), 'sales') OR contains(lower(title), 'founder')) AND seniority IN ('C-Suite', 'VP', 'Director') AND email_status IN ('verified', 'catch_all')
      AND NOT contains(lower(title), 'coordinator') AND email <> '' AND revenue BETWEEN 20000 AND 400000 AND company_id NOT IN (5, 6) AND NOT do_not_contact
      AND coalesce(hi, lo) >= 30 AND lo <= 45 AND id % 2 = 1
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY id) <= 2""")
def contact_search(t):
    people = t("contacts").withColumn("lo", F.col("company_id") % 50) \
        .withColumn("hi", F.expr("CASE WHEN company_id % 4 <> 0 THEN company_id % 50 + 20 END"))
    filters = {"job_titles": ["Sales", "Founder"], "seniority": ["C-Team", "VP", "Director"], "email_status": ["verified", "catch_all"],
               "exclude_titles": ["coordinator"], "require_email": True, "revenue_min": 20000, "revenue_max": 400000,
               "exclude_companies": [5, 6], "blocked": False, "employees_min": 30, "employees_max": 45}
    return contacts.contact_search(people, filters, FIELDS, where="id % 2 = 1", max_per_company=2, company="company_id",
                                   order=[F.asc("id")]).select("id", "company_id", "title")


@query("decision_makers", """SELECT id, company_id, title FROM contacts WHERE (seniority IN ('C-Suite', 'VP', 'Director') OR contains(title, 'Head')) AND email <> ''
    QUALIFY row_number() OVER (PARTITION BY company_id ORDER BY id) <= 2""")
def decision_makers(t):
    return contacts.decision_makers(t("contacts"), "company_id", [F.asc("id")], 2, True).select("id", "company_id", "title")


@query("colleagues", """SELECT id, split_part(email, '@', 2) AS mail_domain, count(*) OVER (PARTITION BY split_part(email, '@', 2)) AS total FROM contacts
    WHERE split_part(email, '@', 2) IN ('mail.example.net', 'co7.example.com') AND email_status = 'verified'""")
def colleagues(t):
    return contacts.colleagues(t("contacts"), ["mail.example.net", "co7.example.com"]).select("id", "mail_domain", "total")


@query("signal_search", """SELECT o_orderkey AS signal_id, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS amount FROM orders
    WHERE (o_orderkey % 100) / 100 >= 0.5 AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderstatus = 'F' AND contains(lower(o_orderpriority), 'high')
      AND o_orderkey % 3 <> 0 AND o_totalprice >= 100000 ORDER BY o_orderdate DESC, o_orderkey LIMIT 50""")
def signal_search(t):
    facts = t("orders").select(
        F.col("o_orderkey").alias("signal_id"), F.expr("CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END").alias("amount"),
        (F.col("o_orderkey") % 100 / 100).alias("confidence"), F.col("o_orderdate").alias("announced_at"),
        F.col("o_orderstatus").alias("region"), F.col("o_orderpriority").alias("name"))
    return contacts.signal_search(facts, at("1996-01-01 00:00:00"), 0.5, "F", "High", min_amount=100000, limit=50) \
        .select("signal_id", "amount")


@query("include_exclude", """SELECT id, title, seniority FROM contacts WHERE lower(seniority) IN ('vp', 'director') AND contains(lower(title), 'sales')
    AND lower(email_status) <> 'invalid' AND NOT contains(lower(title), 'intern') AND company_id % 500 BETWEEN 20 AND 400
    AND id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""")
def include_exclude(t):
    people = t("contacts").withColumn("headcount", F.col("company_id") % 500)
    exported = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id"))
    return contacts.include_exclude(people, {"seniority": ["VP", "Director"], "title": ["sales"]},
                                    {"email_status": ["invalid"], "title": ["intern"]}, False, (20, 400), exported) \
        .select("id", "title", "seniority")
