"""Domain tables derived from the supplied tables.

Each text is plain SQL that Spark and DuckDB read alike, so a query and its SQL twin
start from the same rows. ``{name}`` marks a table; everything after it is up to the
operators. All of them grow with the data: nothing is sampled or cut off.
"""

from __future__ import annotations

import re

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_SQL = {
    # One list row per customer; three rows share one company domain, spelled in four ways.
    "list_companies": """
        SELECT c_custkey AS row_id, lower(c_mktsegment) AS niche,
          CASE WHEN c_custkey % 97 = 0 THEN concat('info@co', k, '.example.com')
               WHEN c_custkey % 4 = 0 THEN concat('https://www.Co', k, '.example.com/about')
               WHEN c_custkey % 4 = 1 THEN concat('co', k, '.example.com:80')
               WHEN c_custkey % 4 = 2 THEN concat(' CO', k, '.EXAMPLE.COM ')
               ELSE concat('co', k, '.example.com') END AS domain,
          c_name AS name,
          CASE c_nationkey % 3 WHEN 0 THEN 'atlas' WHEN 1 THEN 'harbor' ELSE 'registry' END AS source,
          CASE WHEN c_acctbal > 6500 THEN 'A' WHEN c_acctbal > 3500 THEN 'B'
               WHEN c_acctbal > 500 THEN 'C' END AS relevance,
          CASE c_nationkey % 4 WHEN 0 THEN '1-10' WHEN 1 THEN '11-50' WHEN 2 THEN '51-200' END AS company_size,
          CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(floor(abs(c_acctbal) / 40) AS INTEGER) END AS staff_linkedin,
          CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(CAST(floor(abs(c_acctbal) * 100) AS BIGINT) % 70 AS INTEGER) END AS sales_count,
          CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 60 AS INTEGER) END AS marketing_count,
          CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) % 90 AS INTEGER) END AS alt_sales_count,
          CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 3 = 0 END AS ads_runs,
          CASE WHEN c_custkey % 4 = 1 THEN concat('https://linkedin.example/company/', CAST(c_custkey AS STRING)) END AS meta_linkedin,
          CASE WHEN c_custkey % 5 = 2 THEN concat(CAST(c_nationkey AS STRING), 'M') END AS meta_revenue_range,
          CASE WHEN c_custkey % 3 = 1 THEN concat('about ', c_name) END AS meta_description,
          CASE WHEN c_custkey % 4 = 2 THEN CAST(1950 + c_nationkey AS STRING) END AS meta_founded_year,
          CASE WHEN c_custkey % 5 = 3 THEN 'MX' END AS meta_country, CASE WHEN c_custkey % 5 = 3 THEN concat('state ', CAST(c_nationkey AS STRING)) END AS meta_state,
          CASE WHEN c_custkey % 6 = 3 THEN concat('city ', CAST(c_nationkey AS STRING)) END AS meta_city,
          CASE c_custkey % 4 WHEN 0 THEN '1-2' WHEN 1 THEN '3-10' WHEN 2 THEN '0' END AS sales_bucket,
          CASE c_custkey % 3 WHEN 0 THEN '1-2' WHEN 1 THEN '50+' END AS marketing_bucket,
          CASE c_custkey % 8 WHEN 0 THEN CAST(c_nationkey AS STRING) WHEN 1 THEN 'n/a' WHEN 2 THEN '0' END AS meta_staff,
          CASE c_custkey % 6 WHEN 0 THEN 'Freight and Cargo' WHEN 1 THEN 'Software and Data' WHEN 2 THEN 'Warehouse Storage'
               WHEN 3 THEN '' WHEN 4 THEN 'Ocean Shipping' END AS industry,
          DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS updated_at
        FROM (SELECT *, CAST(CAST(floor(c_custkey / 3) AS BIGINT) AS STRING) AS k FROM {customer}) c
    """,
    "companies": """
        SELECT s_suppkey AS id, s_name AS name,
          CASE WHEN s_suppkey % 53 = 0 THEN 'not a domain'
               WHEN s_suppkey % 3 = 0 THEN concat('http://www.co', CAST(s_suppkey * 5 AS STRING), '.example.com/')
               ELSE concat('co', CAST(s_suppkey * 5 AS STRING), '.example.com') END AS domain,
          concat('https://co', CAST(s_suppkey * 5 AS STRING), '.example.com') AS website,
          CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE concat('supplies ', n_name) END AS description,
          CASE WHEN s_suppkey % 8 = 0 THEN concat('from ', n_name) END AS description_short,
          CASE s_suppkey % 5 WHEN 0 THEN '11-50' WHEN 1 THEN '201-500' END AS size_bucket,
          CASE WHEN s_suppkey % 3 = 0 THEN 'Wholesale' END AS industry,
          CASE WHEN s_suppkey % 2 = 1 THEN concat('region ', CAST(n_regionkey AS STRING)) END AS hq_state,
          CASE WHEN s_suppkey % 7 = 1 THEN concat('town ', CAST(s_suppkey AS STRING)) END AS hq_city,
          CASE WHEN s_suppkey % 2 = 0 THEN concat('https://linkedin.example/company/s', CAST(s_suppkey AS STRING)) END AS linkedin_url,
          CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE CAST(floor(abs(s_acctbal) / 25) AS INTEGER) END AS employee_count,
          n_name AS hq_country, s_suppkey % 13 = 0 AS do_not_contact,
          DATE '2024-02-01' + CAST(s_suppkey % 100 AS INTEGER) AS updated_at
        FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey
    """,
    # Four profile rows per domain; the newest one counts.
    "profiles": """
        SELECT p_partkey AS profile_id,
          concat(CASE WHEN p_partkey % 3 = 0 THEN 'www.' ELSE '' END, 'co', CAST(CAST(floor(p_partkey / 4) AS BIGINT) AS STRING), '.example.com') AS domain,
          CASE p_size % 6 WHEN 0 THEN 'b2b' WHEN 1 THEN 'mixed' WHEN 2 THEN 'b2c' WHEN 3 THEN 'noncommercial' WHEN 4 THEN 'unclear' END AS business_model,
          CASE p_size % 6 WHEN 0 THEN TRUE WHEN 1 THEN TRUE WHEN 2 THEN FALSE WHEN 3 THEN p_size % 4 = 1 END AS is_b2b,
          CASE p_size % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' ELSE 'unclear' END AS outbound_fit,
          CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_size % 3 = 0 END AS b2b_line_present,
          CASE p_size % 5 WHEN 0 THEN 'strong' WHEN 1 THEN 'plausible' WHEN 2 THEN 'weak' WHEN 3 THEN 'not_applicable' ELSE 'unclear' END AS sales_economics,
          CASE p_size % 3 WHEN 0 THEN 'companywide' WHEN 1 THEN 'none' ELSE 'b2b_line_only' END AS outbound_scope,
          CASE p_partkey % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'low' END AS confidence,
          CASE WHEN p_size % 7 = 0 THEN 'company' WHEN p_size % 7 = 1 THEN 'government' WHEN p_size % 7 = 2 THEN 'planet' END AS entity_type,
          CASE p_partkey % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'needs_review' WHEN 2 THEN 'pending' WHEN 3 THEN 'accepted' ELSE 'stale' END AS profile_status,
          CASE WHEN p_size % 4 = 0 THEN NULL ELSE concat('sells ', p_name) END AS what_they_sell,
          CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_type END AS primary_customer,
          p_size % 3 <> 0 AS source_crawl_ok,
          DATE '2024-03-01' + CAST(p_size AS INTEGER) AS updated_at
        FROM {part}
    """,
    "crawl_log": """
        SELECT p_partkey AS crawl_id,
          concat('CO', CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS STRING), '.example.com') AS domain,
          p_size % 3 <> 0 AS ok, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size % 5 END AS crawl_attempts,
          DATE '2024-03-01' + CAST(p_size AS INTEGER) AS crawled_at
        FROM {part}
    """,
    # Two rows share one e-mail address; a third of the people sit at one mail host.
    "contacts": """
        SELECT o_orderkey AS id, o_custkey AS company_id,
          concat('First', CAST(o_orderkey % 977 AS STRING)) AS first_name,
          CASE WHEN o_orderkey % 41 = 0 THEN '' ELSE concat('Last', CAST(o_custkey AS STRING)) END AS last_name,
          CASE WHEN o_orderkey % 6 = 0 THEN NULL
               WHEN o_orderkey % 3 = 0 THEN concat('p', CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING), '@mail.example.net')
               ELSE concat('P', CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING), '@co', CAST(CAST(floor(o_custkey / 3) AS BIGINT) AS STRING), '.example.com') END AS email,
          CASE o_orderstatus WHEN 'F' THEN 'verified' WHEN 'O' THEN 'catch_all' ELSE 'invalid' END AS email_status,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Founder and CEO' WHEN '2' THEN 'Head of Sales'
               WHEN '3' THEN 'Sales Coordinator' WHEN '4' THEN 'Marketing Intern' ELSE '' END AS title,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'C-Suite' WHEN '2' THEN 'VP' WHEN '3' THEN 'Director' WHEN '4' THEN 'Staff' ELSE 'Other' END AS seniority,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('https://linkedin.example/in/u', CAST(CAST(floor(o_orderkey / 3) AS BIGINT) AS STRING)) END AS linkedin_url,
          CASE WHEN o_orderkey % 5 = 0 THEN concat('+1', CAST(o_custkey AS STRING)) END AS phone,
          o_orderkey % 17 = 0 AS do_not_contact, o_orderdate AS last_contacted_at, o_totalprice AS revenue
        FROM {orders}
    """,
    "sends": """
        SELECT event_id, 'main' AS workspace, user_id AS lead, concat('u', CAST(user_id AS STRING), '@co', CAST(user_id AS STRING), '.example.com') AS lead_email,
          CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS campaign_id, CAST(1 + event_id % 4 AS INTEGER) AS step, ts AS sent_at,
          value
        FROM {events} WHERE event_type = 'view'
    """,
    "replies": """
        SELECT event_id, 'main' AS workspace, user_id AS lead, concat('u', CAST(user_id AS STRING), '@co', CAST(user_id AS STRING), '.example.com') AS lead_email,
          CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS campaign_id, ts AS replied_at,
          CASE event_type WHEN 'purchase' THEN CASE CAST(floor(value) AS BIGINT) % 3 WHEN 0 THEN 'positive_interested' WHEN 1 THEN 'positive_soft' ELSE 'positive_referral' END
               WHEN 'signup' THEN 'unsubscribe' WHEN 'error' THEN 'bounce'
               ELSE CASE CAST(floor(value) AS BIGINT) % 4 WHEN 0 THEN 'ooo' WHEN 1 THEN 'negative_hostile' WHEN 2 THEN 'neutral_question' ELSE 'other' END END AS label,
          value / 100 AS confidence
        FROM {events} WHERE event_type <> 'view'
    """,
    "mail_events": """
        SELECT event_id, ts, user_id AS lead, CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS campaign_id,
          CASE event_type WHEN 'view' THEN 'sent' WHEN 'purchase' THEN 'opened' WHEN 'click' THEN 'replied'
               WHEN 'error' THEN 'bounced' ELSE 'clicked' END AS kind
        FROM {events}
    """,
    "inbox_stats": """
        SELECT l_suppkey AS campaign_id, l_partkey % 400 + l_suppkey AS inbox_id,
          concat('box', CAST(l_partkey % 400 + l_suppkey AS STRING), '@send', CAST(l_partkey % 5 AS STRING), '.example.com') AS email,
          CAST(l_quantity AS BIGINT) AS sent, CAST(CASE WHEN l_returnflag = 'R' THEN floor(l_tax * 50) ELSE 0 END AS BIGINT) AS replies,
          CAST(CASE WHEN l_linestatus = 'F' THEN floor(l_discount * 20) ELSE 0 END AS BIGINT) AS bounces, l_shipdate AS day
        FROM {lineitem}
    """,
    "inboxes": """
        SELECT p_partkey AS inbox_id, concat('box', CAST(p_partkey AS STRING), '@send.example.com') AS email,
          CASE p_size % 4 WHEN 0 THEN 'gmail' WHEN 1 THEN 'outlook' WHEN 2 THEN NULL ELSE 'custom' END AS type,
          CASE WHEN p_size % 6 = 2 THEN 'smtp.google.example' WHEN p_size % 6 = 4 THEN 'smtp.outlook.example' ELSE 'mx.host.example' END AS smtp_host,
          CASE p_size % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'PAUSED' END AS warmup_status,
          CASE p_size % 5 WHEN 0 THEN '100%' WHEN 1 THEN '80%' WHEN 2 THEN '55' WHEN 3 THEN '49' END AS reputation,
          p_size AS warmup_sent, p_size % 11 = 0 AS is_blocked, CASE WHEN p_size % 8 = 0 THEN NULL ELSE p_size % 7 END AS daily_sent,
          p_size % 13 <> 0 AS smtp_ok, p_size % 17 <> 0 AS imap_ok, CASE WHEN p_size % 2 = 0 THEN 'active' ELSE 'reserve' END AS tag
        FROM {part}
    """,
    "txt_records": """
        SELECT concat('co', CAST(s_suppkey AS STRING), '.example.com') AS domain, concat('co', CAST(s_suppkey AS STRING), '.example.com') AS name,
          CASE s_suppkey % 4 WHEN 0 THEN 'v=spf1 include:mail.example -all' WHEN 1 THEN 'v=spf1 include:mail.example ~all' ELSE 'site-check=1' END AS value FROM {supplier}
        UNION ALL
        SELECT concat('co', CAST(s_suppkey AS STRING), '.example.com'), concat('google._domainkey.co', CAST(s_suppkey AS STRING), '.example.com'),
          CASE WHEN s_suppkey % 3 = 0 THEN 'v=DKIM1; k=rsa; p=MIG' ELSE '' END FROM {supplier}
        UNION ALL
        SELECT concat('co', CAST(s_suppkey AS STRING), '.example.com'), concat('_dmarc.co', CAST(s_suppkey AS STRING), '.example.com'),
          CASE s_suppkey % 5 WHEN 0 THEN 'v=DMARC1; p=none' WHEN 1 THEN 'v=DMARC1; p=reject' WHEN 2 THEN 'v=DMARC1;' ELSE '' END FROM {supplier}
    """,
    # A posting per document. The rare company names repeat, so companies have many postings.
    "postings": """
        SELECT doc_id, 'main' AS workspace, source AS feed,
          CASE WHEN doc_id % 50 = 0 THEN '' ELSE CAST(doc_id AS STRING) END AS raw_id,
          CASE WHEN doc_id % 9 = 0 THEN '' ELSE concat(source, ' Holding ', CAST(doc_id % 5 AS STRING)) END AS company_name,
          CASE WHEN doc_id % 4 = 0 THEN NULL ELSE concat('https://www.', source, CAST(doc_id % 5 AS STRING), '.example.com/jobs') END AS company_website,
          concat('Role  ', lang, ' ', CAST(doc_id % 17 AS STRING)) AS title,
          concat('https://jobs.example/', CAST(doc_id AS STRING)) AS url,
          CASE WHEN doc_id % 3 = 0 THEN concat(CAST(n_chars AS STRING), ' employees') WHEN doc_id % 3 = 1 THEN '1,234 staff' END AS employees,
          CASE WHEN doc_id % 5 = 0 THEN '2024-02-30x' ELSE concat('2024-0', CAST(1 + doc_id % 9 AS STRING), '-1', CAST(doc_id % 10 AS STRING)) END AS posted_at,
          lang AS location, text AS description
        FROM {documents}
    """,
    "leads": """
        SELECT o_orderkey AS lead_id,
          CASE WHEN o_orderkey % 29 = 0 THEN 'info@co1.example.com' WHEN o_orderkey % 31 = 0 THEN ''
               ELSE concat('Lead', CAST(CAST(floor(o_orderkey / 2) AS BIGINT) AS STRING), '@co', CAST(o_custkey AS STRING), '.example.com') END AS email,
          CASE WHEN o_orderkey % 19 = 0 THEN 'JOHN' WHEN o_orderkey % 23 = 0 THEN '' WHEN o_orderkey % 37 = 0 THEN 'test' ELSE 'Ana' END AS first_name,
          CASE WHEN o_orderkey % 43 = 0 THEN 'R2' ELSE 'Diaz' END AS last_name,
          CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'Chief Officer' WHEN '2' THEN 'Sales Director' WHEN '3' THEN 'Sales Coordinator' WHEN '4' THEN 'Internal Auditor' ELSE '' END AS job_title,
          CASE WHEN o_orderkey % 3 = 0 THEN concat('co', CAST(o_custkey AS STRING), '.example.com') ELSE '' END AS company_domain,
          CASE o_custkey % 4 WHEN 0 THEN 'Software' WHEN 1 THEN 'Retail Trade' WHEN 2 THEN 'Software Services' ELSE '' END AS company_industry,
          CASE WHEN o_custkey % 6 = 0 THEN 0 ELSE CAST(o_custkey % 300 AS INTEGER) END AS company_headcount,
          CASE o_orderstatus WHEN 'F' THEN 'Verified' WHEN 'O' THEN 'ok' ELSE '' END AS email_status
        FROM {orders}
    """,
}


def _needs(sql: str) -> tuple[str, ...]:
    return tuple(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


STANDINS = {name: (_needs(sql), sql) for name, sql in _SQL.items()}


def with_standins(sql: str) -> str:
    """Prefix ``sql`` with a CTE for every stand-in it mentions."""
    used = [n for n in STANDINS if re.search(rf"\b{n}\b", sql)]
    ctes = [f"{n} AS ({re.sub(r'[{}]', '', STANDINS[n][1]).strip()})" for n in used]
    if not ctes:
        return sql.strip()
    body = sql.strip()
    if body[:15].lower() == "with recursive ":
        return "WITH RECURSIVE " + ",\n".join(ctes) + ",\n" + body[15:]
    if body[:5].lower() == "with ":
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
