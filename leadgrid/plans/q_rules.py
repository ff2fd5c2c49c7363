"""Queries over rule classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions.bands import count_bucket
from leadgrid.operators import rules
from leadgrid.plans import vocab
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import bucket, hits


def _has(expr, terms):
    return f"len({hits(expr, terms)}) > 0"


_TEXT = "concat_ws(' ', lower(name), lower(coalesce(industry, '')), niche)"
_CASES = " ".join(f"WHEN {_has(_TEXT, terms)} THEN '{bucket_}'" for bucket_, terms, _ in vocab.SEGMENT_RULES)
SEGMENTS = f"""SELECT row_id, bucket, CASE WHEN bucket = 'warehousing' AND {_has(_TEXT, ('freight', 'machinery'))}
    THEN 'storage with transport' WHEN bucket = 'review' THEN 'no strong signal' ELSE {
    "CASE bucket " + " ".join(f"WHEN '{b}' THEN '{r}'" for b, _, r in vocab.SEGMENT_RULES) + " END"} END AS reason
    FROM (SELECT *, CASE {_CASES} ELSE 'review' END AS bucket FROM list_companies)"""


def segments(t):
    return rules.classify_company(
        t("list_companies").select("row_id", "name", "industry", "niche"), vocab.SEGMENT_RULES,
        ["name", "industry", "niche"], {"warehousing": (("freight", "machinery"), "storage with transport")})


@query("classify_company", SEGMENTS)
def classify_company(t):
    return segments(t).select("row_id", "bucket", "reason")


@query("industry_bucket", f"""
    SELECT row_id, coalesce(CASE WHEN niche = 'building' THEN niche END, CASE {' '.join(
        f"WHEN {_has('industry', terms)} THEN '{label}'" for label, terms in vocab.INDUSTRY_RULES)} ELSE 'Other' END) AS vertical
    FROM list_companies""")
def industry_bucket(t):
    existing = F.when(F.col("niche") == "building", F.col("niche")).otherwise(F.lit("  "))
    return t("list_companies").select("row_id", rules.industry_bucket(
        existing, F.col("industry"), vocab.INDUSTRY_RULES).alias("vertical"))


@query("specialist_ensemble", f"""
    WITH s AS ({" UNION ALL ".join(
        f"SELECT row_id, {i} AS ord, '{a}' AS agent, '{b}' AS bucket, {c}::DOUBLE AS confidence, "
        f"{hits('industry', terms)} AS found FROM list_companies" for i, (a, b, c, terms) in enumerate(vocab.SPECIALISTS))}),
    best AS (SELECT * FROM s WHERE len(found) > 0 QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY confidence DESC, ord) = 1)
    SELECT row_id, coalesce(bucket, 'review') AS bucket, coalesce(confidence, 0.2::DOUBLE) AS confidence, coalesce(agent, 'manager') AS agent,
      coalesce(array_to_string(found[1:3], ', '), 'no specialist matched') AS evidence FROM list_companies LEFT JOIN best USING (row_id)""")
def specialist_ensemble(t):
    return rules.specialist_ensemble(t("list_companies").select("row_id", "industry"), vocab.SPECIALISTS, ["industry"]) \
        .drop("industry")


@query("is_transport", f"""SELECT row_id, {_has("concat_ws(' ', industry, niche)", ('freight', 'cargo', 'shipping', 'machinery'))} AS transport
    FROM list_companies""")
def is_transport(t):
    return t("list_companies").select("row_id", rules.is_transport(
        ["industry", "niche"], ("freight", "cargo", "shipping", "machinery")).alias("transport"))


@query("is_b2b", """SELECT profile_id, CASE WHEN business_model IN ('b2b', 'mixed') THEN true
    WHEN business_model IN ('b2c', 'noncommercial') THEN false END AS b2b FROM profiles""")
def is_b2b(t):
    return t("profiles").select("profile_id", rules.is_b2b(F.col("business_model")).alias("b2b"))


ANGLES = {"0-1": "before_hiring", "2-5": "prospecting_function", "6-15": "standardize", "16-50": "segments", "50+": "blind_spots"}


@query("route_by_team_size", """
    SELECT row_id, CASE WHEN ads_runs AND sales_count BETWEEN 2 AND 50 THEN 'paid_demand' WHEN sales_count <= 1 THEN 'before_hiring'
      WHEN sales_count <= 5 THEN 'prospecting_function' WHEN sales_count <= 15 THEN 'standardize' WHEN sales_count <= 50 THEN 'segments'
      WHEN sales_count > 50 THEN 'blind_spots' END AS angle FROM list_companies""")
def route_by_team_size(t):
    return t("list_companies").select("row_id", rules.route_by_team_size(
        F.col("sales_count"), F.col("ads_runs"), ANGLES, "paid_demand", ["2-5", "6-15", "16-50"]).alias("angle"))


@query("priority_tier", f"""
    SELECT row_id, CASE WHEN relevance = 'A' AND s IN ('1-2', '3-10') AND m IN ('0', '1-2') THEN 1
      WHEN relevance = 'A' AND s = '0' AND m = '0' THEN 2
      WHEN relevance IN ('B', 'C') AND (s IN ('1-2', '3-10') AND m IN ('0', '1-2') OR s = '0' AND m = '0') THEN 3
      WHEN s IN ('11-50', '50+') AND m IN ('11-50', '50+') THEN 3 END AS tier, coalesce(ads_runs, false) AS advertiser
    FROM (SELECT *, {bucket('sales_count')} AS s, {bucket('marketing_count')} AS m FROM list_companies)""")
def priority_tier(t):
    rows = t("list_companies").withColumn("s", count_bucket(F.col("sales_count"))) \
                              .withColumn("m", count_bucket(F.col("marketing_count")))
    return rows.select("row_id", rules.priority_tier(F.col("relevance"), F.col("s"), F.col("m")).alias("tier"),
                       F.coalesce("ads_runs", F.lit(False)).alias("advertiser"))


@query("assign_persona", """
    SELECT row_id, concat_ws(',', 'owner', CASE WHEN sales_count >= 1 THEN 'sales_lead' END,
      CASE WHEN marketing_count >= 1 THEN 'marketing_lead' END) AS personas FROM list_companies""")
def assign_persona(t):
    got = rules.assign_persona(count_bucket(F.col("sales_count")), count_bucket(F.col("marketing_count")))
    return t("list_companies").select("row_id", F.array_join(got, ",").alias("personas"))


@query("persona_titles", """SELECT id, (contains(lower(title), 'sales') OR contains(lower(title), 'ceo'))
    AND NOT contains(lower(title), 'coordinator') AS persona FROM contacts""")
def persona_titles(t):
    return t("contacts").select("id", rules.persona_titles(F.col("title"), ["sales", "CEO"], ["Coordinator"]).alias("persona"))


@query("pain_segment", """SELECT row_id, CASE WHEN relevance = 'A' THEN 'core' WHEN company_size = '1-10' THEN 'tiny'
    WHEN source = 'atlas' THEN 'imported' ELSE 'unassigned' END AS segment FROM list_companies""")
def pain_segment(t):
    attributes = F.create_map(F.lit("fit"), F.col("relevance"), F.lit("size"), F.col("company_size"),
                              F.lit("via"), F.col("source"))
    found = rules.pain_segment(attributes, [("fit", "A", "core"), ("size", "1-10", "tiny"), ("via", "atlas", "imported")])
    return t("list_companies").select("row_id", found.alias("segment"))
