"""Queries over validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.operators import validate
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import nd, rate, rnd, sp
from leadgrid.session import fresh_path
from leadgrid.sources import keyed, tables
from leadgrid.streaming.store import Store

# The profile constraints in words of their own: each expression is true for a row that breaks the rule.
_ACCEPTED = "coalesce(profile_status, '') = 'accepted'"
_BREAKS = {
    "business_model_value": "business_model NOT IN ('b2b', 'b2c', 'mixed', 'noncommercial', 'unclear')",
    "entity_type_value": "entity_type NOT IN ('company', 'government', 'education', 'nonprofit', 'media_or_directory', 'unclear')",
    "confidence_value": "confidence NOT IN ('high', 'medium', 'low')",
    "sales_economics_value": "sales_economics NOT IN ('strong', 'plausible', 'weak', 'not_applicable', 'unclear')",
    "outbound_fit_value": "outbound_fit NOT IN ('high', 'medium', 'low', 'unclear')",
    "outbound_scope_value": "outbound_scope NOT IN ('companywide', 'b2b_line_only', 'none', 'unclear')",
    "status_value": "profile_status NOT IN ('pending', 'processing', 'needs_review', 'accepted', 'failed', 'not_profileable', 'stale')",
    "b2b_consistency": """CASE WHEN business_model IN ('b2b', 'mixed') THEN is_b2b IS DISTINCT FROM true
        WHEN business_model IN ('b2c', 'noncommercial') THEN is_b2b IS DISTINCT FROM false
        WHEN business_model = 'unclear' THEN is_b2b IS NOT NULL WHEN business_model IS NULL THEN false ELSE true END""",
    "accepted_complete": f"{_ACCEPTED} AND (business_model IS NULL OR outbound_fit IS NULL OR confidence IS NULL)",
    "b2b_line": f"{_ACCEPTED} AND business_model IN ('b2b', 'mixed') AND b2b_line_present IS DISTINCT FROM true",
    "noncommercial_economics": f"{_ACCEPTED} AND business_model = 'noncommercial' AND sales_economics <> 'not_applicable'",
    "noncommercial_fit": f"{_ACCEPTED} AND business_model = 'noncommercial' AND outbound_fit <> 'low'",
    "scope_needs_line": f"{_ACCEPTED} AND outbound_scope IN ('companywide', 'b2b_line_only') AND b2b_line_present IS DISTINCT FROM true",
    "no_scope_no_line": f"{_ACCEPTED} AND outbound_scope = 'none' AND b2b_line_present IS DISTINCT FROM false",
}
_BROKEN = ", ".join(f"CASE WHEN {broken} THEN '{n}' END" for n, broken in _BREAKS.items())


@query("validate_profiles", f"SELECT profile_id, concat_ws(',', {_BROKEN}) AS errors FROM profiles")
def validate_profiles(t):
    return validate.validate_profiles(t("profiles")).select("profile_id", F.array_join("errors", ",").alias("errors"))


@query("constraint_report", " UNION ALL ".join(
    [f"SELECT '{n}' AS rule, count(*) FILTER (WHERE {broken}) AS violations FROM profiles" for n, broken in _BREAKS.items()] +
    ["SELECT 'unique_domain', count(*) FROM (SELECT domain FROM (SELECT lower(domain) AS domain FROM profiles) GROUP BY 1 HAVING count(*) > 1)",
     "SELECT 'crawl_exists', count(*) FROM profiles WHERE lower(domain) NOT IN (SELECT lower(domain) FROM crawl_log)"]))
def constraint_report(t):
    crawls = t("crawl_log").select(F.lower("domain").alias("domain"))
    return validate.constraint_report(t("profiles").withColumn("domain", F.lower("domain")), validate.PROFILE_RULES,
                                      {"unique_domain": ["domain"]}, {"crawl_exists": ("domain", crawls)})


_DECISION = """SELECT doc_id, CAST(doc_id + CASE WHEN doc_id % 40 = 0 THEN 1000000000 ELSE 0 END AS STRING) AS source_job_id,
    CASE doc_id % 7 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'great' WHEN 3 THEN 'no_fit' END AS fit,
    CASE doc_id % 3 WHEN 0 THEN 'high' WHEN 1 THEN 'low' END AS signal_fit, CASE WHEN doc_id % 5 = 0 THEN 'maybe' ELSE 'high' END AS account_fit,
    CASE WHEN doc_id % 11 = 0 THEN 'foreign' ELSE 'home' END AS company_region_fit, CAST(NULL AS STRING) AS prospecting_scope,
    'likely' AS employer_confidence, CASE WHEN doc_id % 2 = 0 THEN 'contact' END AS campaign_action,
    CASE WHEN doc_id % 13 = 0 THEN 1.5 ELSE (doc_id % 10) / 10 END AS fit_confidence,
    CASE WHEN doc_id % 17 = 0 THEN 'not a list' WHEN doc_id % 17 = 1 THEN '["national", "b"]' END AS prospecting_markets,
    CASE WHEN doc_id % 6 = 0 THEN 'an invented quote' WHEN doc_id % 6 <> 1 THEN upper(substr(text, 3, 30)) END AS quote, text FROM documents"""


@query("validate_decisions", f"""WITH d0 AS ({_DECISION.replace('upper(substr(text, 3, 30))', 'substr(text, 3, 30)')}),
    d AS (SELECT * REPLACE (coalesce(fit, 'unreviewed') AS fit, coalesce(signal_fit, 'unreviewed') AS signal_fit, coalesce(campaign_action, 'review') AS campaign_action),
      doc_id % 40 <> 0 AS known, fit_confidence < 0.8 AS review FROM d0),
    e AS (SELECT *, concat_ws(',', CASE WHEN fit = 'great' THEN 'invalid_fit' END, CASE WHEN account_fit = 'maybe' THEN 'invalid_account_fit' END,
      CASE WHEN NOT known THEN 'unknown_source' END, CASE WHEN fit_confidence > 1 THEN 'confidence_range' END,
      CASE WHEN known AND quote IS NOT NULL AND NOT contains(replace(lower({sp('text')}), 'ß', 'ss'), replace(lower({sp('quote')}), 'ß', 'ss')) THEN 'ungrounded_quote' END,
      CASE WHEN (fit IN ('high', 'medium') OR signal_fit = 'high') AND quote IS NULL THEN 'missing_evidence' END,
      CASE WHEN prospecting_markets = 'not a list' THEN 'list_prospecting_markets' END) AS errors FROM d)
    SELECT doc_id, errors, review AS needs_human_review, CASE WHEN errors <> '' THEN NULL WHEN company_region_fit = 'foreign' THEN 'not_fit'
      WHEN signal_fit = 'high' THEN CASE WHEN campaign_action = 'contact' AND account_fit = 'high' AND NOT review THEN 'ready_for_contact' ELSE 'qualified' END
      WHEN fit NOT IN ('high', 'medium') THEN 'not_fit' WHEN review THEN 'qualified' ELSE 'ready_for_contact' END AS pipeline_status FROM e""")
def validate_decisions(t):
    rows = t.spark.sql(_DECISION.replace("FROM documents", "FROM {documents}").replace("upper(substr(text, 3, 30))", "lower(substr(text, 3, 30))"),
                       documents=t("documents"))
    decisions = rows.withColumn("evidence_quotes", F.when(F.col("quote").isNotNull(), F.array("quote"))) \
        .withColumn("needs_human_review", F.lit(None).cast("boolean")).drop("quote", "text")
    sources = t("documents").select(F.col("doc_id").cast("string").alias("source_job_id"), F.col("text").alias("description_text"))
    return validate.validate_decisions(decisions, sources).select(
        "doc_id", F.array_join("errors", ",").alias("errors"), "needs_human_review", "pipeline_status")


_RUNS = """SELECT concat('co', CAST(p_partkey % 100000 AS STRING)) AS domain, p_type AS source_hash, 1 AS pass_number,
    CASE p_size % 5 WHEN 0 THEN 'b2b' WHEN 1 THEN 'mixed' WHEN 2 THEN 'b2c' WHEN 3 THEN 'noncommercial' ELSE 'unclear' END AS label FROM part
    UNION ALL SELECT concat('co', CAST(p_partkey % 100000 AS STRING)), p_type, 2,
    CASE (p_size + p_partkey % 2) % 5 WHEN 0 THEN 'b2b' WHEN 1 THEN 'mixed' WHEN 2 THEN 'b2c' WHEN 3 THEN 'noncommercial' ELSE 'unclear' END FROM part WHERE p_partkey % 9 <> 0"""


@query("blind_consensus", f"""WITH r AS ({_RUNS}), w AS (SELECT a.domain, a.source_hash, a.label AS first, b.label AS second FROM (SELECT * FROM r WHERE pass_number = 1) a
      LEFT JOIN (SELECT * FROM r WHERE pass_number = 2) b USING (domain, source_hash)),
    x AS (SELECT *, (first IN ('b2b', 'mixed') AND second IN ('b2c', 'noncommercial')) OR (second IN ('b2b', 'mixed') AND first IN ('b2c', 'noncommercial')) AS crossing FROM w)
    SELECT domain, source_hash, first, second, CASE WHEN second IS NULL THEN 'pending' WHEN crossing THEN 'needs_review' ELSE 'accepted' END AS status,
      CASE WHEN second IS NULL THEN NULL WHEN first = second THEN 'consensus' WHEN crossing THEN 'disagreement' ELSE 'stronger_model' END AS decision_method,
      CASE WHEN second IS NOT NULL AND NOT crossing THEN second END AS label FROM x""")
def blind_consensus(t):
    return validate.blind_consensus(t.spark.sql(_RUNS.replace("FROM part", "FROM {part}"), part=t("part")))


@query("consensus_fields", """SELECT p_partkey, concat_ws(',', 'p_type', CASE WHEN p_size % 2 = 0 THEN 'p_brand' END) AS same FROM part""")
def consensus_fields(t):
    left = F.struct("p_type", "p_brand")
    right = F.struct("p_type", F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("p_brand"))
    return t("part").select("p_partkey", F.array_join(validate.consensus_fields(left, right, ["p_type", "p_brand"]), ",").alias("same"))


def _verdicts(t):
    labels = t("documents").join(t("labels"), "doc_id").select(
        F.concat(F.lit("co"), "doc_id").alias("domain"), "lang", F.expr("CASE WHEN quality = 1 THEN 'b2b' ELSE 'b2c' END").alias("label"))
    checks = t("documents").where("doc_id % 3 <> 0").select(
        F.concat(F.lit("co"), "doc_id").alias("domain"), F.expr("CASE WHEN n_chars % 4 = 0 THEN 'b2c' ELSE 'b2b' END").alias("verify_label"))
    return labels, checks


_VERDICTS = """l AS (SELECT 'co' || doc_id AS domain, lang, CASE WHEN quality = 1 THEN 'b2b' ELSE 'b2c' END AS label FROM documents JOIN labels USING (doc_id)),
    v AS (SELECT 'co' || doc_id AS domain, CASE WHEN n_chars % 4 = 0 THEN 'b2c' ELSE 'b2b' END AS verify_label FROM documents WHERE doc_id % 3 <> 0)"""


@query("attach_verifier", f"WITH {_VERDICTS} SELECT domain, label, verify_label, label = verify_label AS verify_agree FROM l LEFT JOIN v USING (domain)")
def attach_verifier(t):
    return validate.attach_verifier(*_verdicts(t)).drop("lang")


@query("subcat_agree", f"""WITH {_VERDICTS}, w AS (FROM v UNION ALL SELECT 'co' || doc_id, '?' FROM documents WHERE doc_id % 3 = 0)
    SELECT domain, verify_label AS subcat_verify, label AS classified,
    CASE WHEN label IS NOT NULL THEN label = verify_label END AS subcat_agree FROM w LEFT JOIN l USING (domain)""")
def subcat_agree(t):
    labels, checks = _verdicts(t)
    blank = t("documents").where("doc_id % 3 = 0").select(F.concat(F.lit("co"), "doc_id").alias("domain"), F.lit(" ").alias("verify_label"))
    checks = checks.unionByName(blank)
    return validate.subcat_agree(checks.withColumn("subcat", F.lit("?")), labels.withColumnRenamed("label", "subcat"))


@query("agreement_rate", f"""WITH {_VERDICTS}, j AS (SELECT lang, label, label = verify_label AS a FROM l LEFT JOIN v USING (domain))
    SELECT lang, label, count(a) AS verified, count(*) FILTER (WHERE a) AS agreed, {rnd(rate('count(*) FILTER (WHERE a)', 'count(a)', 100), 2)} AS agreement_pct FROM j GROUP BY 1, 2""")
def agreement_rate(t):
    return validate.agreement_rate(validate.attach_verifier(*_verdicts(t)), ["lang", "label"])


@query("evidence_failures", """WITH d AS (SELECT *, contains(text, 'the') AS a, contains(text, 'tion') AND contains(text, 'nt') AS b FROM documents JOIN labels USING (doc_id))
    SELECT 'co' || doc_id || ':classify' AS failure FROM d WHERE NOT a AND quality = 1 UNION ALL SELECT 'co' || doc_id || ':verify' FROM d WHERE NOT b AND toxic = 1""")
def evidence_failures(t):
    rows = t("documents").join(t("labels"), "doc_id").select(
        F.concat(F.lit("co"), "doc_id").alias("domain"), "text", F.array(F.lit("the")).alias("q1"), F.array(F.lit("tion"), F.lit("nt")).alias("q2"),
        F.expr("CASE WHEN quality = 1 THEN 'b2b' ELSE 'unclear' END").alias("l1"), F.expr("CASE WHEN toxic = 1 THEN 'b2b' ELSE 'unclear' END").alias("l2"))
    return validate.evidence_failures(rows, {"classify": ("q1", "l1"), "verify": ("q2", "l2")}, "text")


# --- tables ---------------------------------------------------------------------

@query("scan_table", "SELECT c_custkey, c_mktsegment FROM customer")
def scan_table(t):
    return tables.scan_table(t.spark, t.path("customer"), ["c_custkey", "c_mktsegment"])


@query("check_columns", "SELECT r_regionkey, r_name FROM region")
def check_columns(t):
    return tables.check_columns(t("region"), ["r_regionkey"], ["r_name"])


@query("queue_filter", "SELECT profile_id FROM profiles WHERE profile_status IN ('pending', 'stale') AND outbound_fit = 'high' AND business_model IS NOT NULL AND entity_type IS NULL")
def queue_filter(t):
    return tables.queue_filter(t("profiles"), {"profile_status": ["pending", "stale"]}, {"outbound_fit": "high"},
                               ["entity_type"], ["business_model"]).select("profile_id")


_UPSERT = f"""WITH u AS (SELECT {nd('domain')} AS domain, employee_count AS n FROM companies
      QUALIFY row_number() OVER (PARTITION BY {nd('domain')} ORDER BY id DESC) = 1),
    b AS (SELECT {nd('domain')} AS domain, max(name) AS name, max(staff_linkedin) AS n, max(source) AS source FROM list_companies GROUP BY 1)
    SELECT coalesce(b.domain, u.domain) AS domain, b.name, CASE WHEN u.domain IS NOT NULL THEN u.n ELSE b.n END AS n, b.source
    FROM (SELECT * FROM b WHERE domain IS NOT NULL) b FULL JOIN (SELECT * FROM u WHERE domain IS NOT NULL) u ON b.domain = u.domain"""


def upsert_rows(t):
    """A table with one row a domain, and updates that give every domain twice."""
    from leadgrid.operators.entity import with_domain
    base = with_domain(t("list_companies")).groupBy(F.col("nd").alias("domain")).agg(
        F.max("name").alias("name"), F.max("staff_linkedin").alias("n"), F.max("source").alias("source"))
    # Every company twice: its older row has the smaller id and must not win.
    now = with_domain(t("companies")).where("nd IS NOT NULL").select(F.col("nd").alias("domain"), F.col("employee_count").alias("n"), "id")
    updates = now.unionByName(now.select("domain", F.lit(-1).alias("n"), (F.col("id") - 1_000_000_000).alias("id")))
    return base.where("domain IS NOT NULL"), updates


@query("upsert", _UPSERT)
def upsert(t):
    return tables.upsert(*upsert_rows(t), ["domain"], "id")


@query("upsert_stored", _UPSERT)
def upsert_stored(t):
    base, updates = upsert_rows(t)
    store = Store(t.spark, fresh_path(t.spark, "keyed"))
    keyed.create(store, "companies", base, ["domain"], 16)
    keyed.upsert(store, "companies", base, updates, ["domain"], "id")
    return keyed.read(store, "companies", base)


_PATCH = """SELECT c_custkey, CASE WHEN n IS NULL THEN c_acctbal ELSE mx END AS c_acctbal, CASE WHEN n IS NULL THEN DATE '2024-01-01' ELSE DATE '2024-06-01' END AS updated_at
    FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_totalprice) AS mx FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) ON o_custkey = c_custkey"""


def patch_rows(t):
    base = t("customer").select("c_custkey", "c_acctbal", F.lit("2024-01-01").cast("date").alias("updated_at"))
    changes = t("orders").where("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_totalprice").alias("c_acctbal"))
    return base, changes


@query("patch", _PATCH)
def patch(t):
    return tables.patch(*patch_rows(t), "c_custkey", F.lit("2024-06-01").cast("date"))


@query("patch_stored", _PATCH)
def patch_stored(t):
    base, changes = patch_rows(t)
    store = Store(t.spark, fresh_path(t.spark, "keyed"))
    keyed.create(store, "customers", base, ["c_custkey"], 16)
    keyed.patch(store, "customers", base, changes, "c_custkey", F.lit("2024-06-01").cast("date"))
    return keyed.read(store, "customers", base)
