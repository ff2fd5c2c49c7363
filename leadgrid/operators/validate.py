"""Constraint checks: error arrays per row, violation counts per rule, consensus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.bands import is_true, ratio, round_half_up
from leadgrid.functions.text import evidence_is_exact, quote_is_grounded
from leadgrid.operators.signals import pipeline_status

# What each dimension of a decision may say.
DECISION_VALUES = {
    "fit": ("unreviewed", "high", "medium", "no_fit", "excluded"),
    "signal_fit": ("unreviewed", "high", "medium", "low", "no_signal"),
    "account_fit": ("unreviewed", "high", "medium", "low", "no_fit"),
    "company_region_fit": ("unreviewed", "home", "foreign", "uncertain"),
    "prospecting_scope": ("unknown", "national", "regional", "international", "mixed"),
    "employer_confidence": ("unreviewed", "verified", "likely", "hidden", "uncertain"),
    "campaign_action": ("review", "contact", "hold", "exclude"),
}
# Fields that must be lists of texts.
DECISION_LISTS = ("prospecting_markets", "outbound_motions")
DECISION_DEFAULTS = {"prospecting_scope": "unknown", "campaign_action": "review"}

# Row constraints of a company profile. As in a database, a rule that
# evaluates to null holds.
PROFILE_RULES = {
    "business_model_value": "business_model IN ('b2b', 'b2c', 'mixed', 'noncommercial', 'unclear')",
    "entity_type_value": "entity_type IN ('company', 'government', 'education', 'nonprofit', 'media_or_directory', 'unclear')",
    "confidence_value": "confidence IN ('high', 'medium', 'low')",
    "sales_economics_value": "sales_economics IN ('strong', 'plausible', 'weak', 'not_applicable', 'unclear')",
    "outbound_fit_value": "outbound_fit IN ('high', 'medium', 'low', 'unclear')",
    "outbound_scope_value": "outbound_scope IN ('companywide', 'b2b_line_only', 'none', 'unclear')",
    "status_value": "profile_status IN ('pending', 'processing', 'needs_review', 'accepted', 'failed', 'not_profileable', 'stale')",
    "b2b_consistency": """(business_model IS NULL AND is_b2b IS NULL) OR (business_model IN ('b2b', 'mixed') AND is_b2b IS TRUE)
        OR (business_model IN ('b2c', 'noncommercial') AND is_b2b IS FALSE) OR (business_model = 'unclear' AND is_b2b IS NULL)""",
    "accepted_complete": """profile_status <> 'accepted' OR (business_model IS NOT NULL AND outbound_fit IS NOT NULL AND confidence IS NOT NULL)""",
    "b2b_line": "profile_status <> 'accepted' OR business_model NOT IN ('b2b', 'mixed') OR b2b_line_present IS TRUE",
    "noncommercial_economics": "profile_status <> 'accepted' OR business_model <> 'noncommercial' OR sales_economics = 'not_applicable'",
    "noncommercial_fit": "profile_status <> 'accepted' OR business_model <> 'noncommercial' OR outbound_fit = 'low'",
    "scope_needs_line": "profile_status <> 'accepted' OR outbound_scope NOT IN ('companywide', 'b2b_line_only') OR b2b_line_present IS TRUE",
    "no_scope_no_line": "profile_status <> 'accepted' OR outbound_scope <> 'none' OR b2b_line_present IS FALSE",
}


def row_errors(rules: Mapping[str, str | Column]) -> Column:
    """Names of the broken rules of a row."""
    checks = [F.when(~F.coalesce(F.expr(r) if isinstance(r, str) else r, F.lit(True)), F.lit(n))
              for n, r in rules.items()]
    return F.array_except(F.array(*checks), F.array(F.lit(None).cast("string")))


def validate_profiles(df: DataFrame, rules: Mapping[str, str | Column] = PROFILE_RULES) -> DataFrame:
    """Adds ``errors``; pass extra rules (evidence count, hash format) as needed."""
    return df.withColumn("errors", row_errors(rules))


def evidence_rules(evidence: str = "evidence", source: str = "clean_text") -> dict[str, Column]:
    """At most two quotes, each a literal part of the source."""
    quotes = F.coalesce(F.col(evidence), F.array().cast("array<string>"))
    return {"evidence_count": F.size(quotes) <= 2,
            "evidence_literal": evidence_is_exact(quotes, F.col(source), F.lit("b2b"))}


def hash_rule(column: str) -> dict[str, Column]:
    return {f"{column}_format": F.col(column).rlike("^[0-9a-f]{64}$")}


def evidence_failures(df: DataFrame, layers: Mapping[str, tuple[str, str]], source: str) -> DataFrame:
    """Failures as rows named ``key:layer``; ``layers`` maps a layer to (quotes, label) columns."""
    broken = [F.when(~evidence_is_exact(F.col(q), F.col(source), F.col(label)), F.concat(F.col("domain"), F.lit(f":{layer}")))
              for layer, (q, label) in layers.items()]
    return df.select(F.explode(F.array(*broken)).alias("failure")).where(F.col("failure").isNotNull())


def validate_decisions(decisions: DataFrame, sources: DataFrame) -> DataFrame:
    """Check review decisions against their postings and gate them.

    Rows are not refused one by one: each gets an ``errors`` array, the effective review flag
    and the pipeline status. ``sources`` has one row per source_job_id.
    """
    filled = decisions.withColumns({
        c: F.coalesce(c, F.lit(DECISION_DEFAULTS.get(c, "unreviewed"))) for c in DECISION_VALUES})
    known = sources.select("source_job_id", F.coalesce("description_text", F.lit("")).alias("_source"))
    joined = filled.join(known, "source_job_id", "left")
    quotes = F.coalesce("evidence_quotes", F.array().cast("array<string>"))
    positive = F.col("fit").isin("high", "medium") | F.col("signal_fit").isin("high", "medium")
    rules: dict[str, str | Column] = {f"invalid_{c}": F.col(c).isin(*v) for c, v in DECISION_VALUES.items()}
    rules["unknown_source"] = F.col("_source").isNotNull()
    rules["confidence_range"] = is_true(F.col("fit_confidence").between(0, 1))
    rules["ungrounded_quote"] = F.col("_source").isNull() | F.forall(quotes, lambda q: quote_is_grounded(q, F.col("_source")))
    rules["missing_evidence"] = ~positive | (F.size(quotes) > 0)
    rules |= {f"list_{c}": _is_list(decisions, c) for c in DECISION_LISTS if c in decisions.columns}
    checked = joined.withColumn("errors", row_errors(rules)).withColumn(
        "needs_human_review", F.coalesce("needs_human_review", F.col("fit_confidence") < 0.8))
    status = pipeline_status(*[F.col(c) for c in ("fit", "signal_fit", "account_fit", "company_region_fit",
                                                  "employer_confidence", "campaign_action", "needs_human_review")])
    return checked.withColumn("pipeline_status", F.when(F.size("errors") == 0, status)).drop("_source")


def _is_list(df: DataFrame, col: str) -> Column:
    """Null, an array, or text that is a JSON array."""
    if dict(df.dtypes)[col].startswith("array"):
        return F.lit(True)
    text = F.trim(F.col(col).cast("string"))
    return F.col(col).isNull() | (text.startswith("[") & F.from_json(text, "array<string>").isNotNull())


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the error column, rejected rows with it)."""
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def blind_consensus(runs: DataFrame) -> DataFrame:
    """Two independent passes per (domain, source hash) to one verdict.

    Equal labels are accepted; labels on different sides of the commercial border need
    review; other differences are settled by the second, stronger pass.
    """
    wide = runs.groupBy("domain", "source_hash").agg(
        F.max(F.when(F.col("pass_number") == 1, F.col("label"))).alias("first"),
        F.max(F.when(F.col("pass_number") == 2, F.col("label"))).alias("second"))

    def side(col: str) -> Column:
        return F.when(F.col(col).isin("b2b", "mixed"), "business").when(F.col(col).isin("b2c", "noncommercial"), "consumer")
    waiting = F.col("first").isNull() | F.col("second").isNull()
    agree = F.col("first") == F.col("second")
    crossing = is_true(side("first") != side("second"))
    return wide.withColumns({
        "status": F.when(waiting, "pending").when(crossing, "needs_review").otherwise("accepted"),
        "decision_method": F.when(waiting, None).when(agree, "consensus").when(crossing, "disagreement").otherwise("stronger_model"),
        "label": F.when(~waiting & ~crossing, F.col("second"))})


def consensus_fields(left: Column, right: Column, fields: Sequence[str]) -> Column:
    """Fields on which two profile structs say the same (null equals null)."""
    same = [F.when(left[f].eqNullSafe(right[f]), F.lit(f)) for f in fields]
    return F.array_except(F.array(*same), F.array(F.lit(None).cast("string")))


def subcat_agree(verifications: DataFrame, labels: DataFrame) -> DataFrame:
    """Verifier against classifier by domain; null where the classifier said nothing. A blank verdict counts as none."""
    verdict = F.coalesce(F.nullif(F.trim("verify_label"), F.lit("")), "subcat").alias("subcat_verify")
    return verifications.select("domain", verdict).join(
        labels.select("domain", F.col("subcat").alias("classified"), F.lit(True).alias("_has")), "domain", "left") \
        .withColumn("subcat_agree", F.when(F.col("_has"), F.col("classified").eqNullSafe(F.col("subcat_verify")))).drop("_has")


def attach_verifier(labels: DataFrame, verifications: DataFrame) -> DataFrame:
    """Every label with its verification, where there is one."""
    return labels.join(verifications, "domain", "left").withColumn(
        "verify_agree", F.when(F.col("verify_label").isNotNull(), F.col("label") == F.col("verify_label")))


def agreement_rate(df: DataFrame, by: Sequence[str], agree: str = "verify_agree") -> DataFrame:
    """Percent of verified rows on which the verifier agreed."""
    return df.groupBy(*by).agg(F.count(agree).alias("verified"), F.count_if(agree).alias("agreed")) \
             .withColumn("agreement_pct", round_half_up(ratio(F.col("agreed"), F.col("verified"), 100.0), 2))


def constraint_report(df: DataFrame, rules: Mapping[str, str], unique: Mapping[str, Sequence[str]] | None = None,
                      foreign: Mapping[str, tuple[str, DataFrame]] | None = None) -> DataFrame:
    """Violations per rule, per unique key and per foreign key.

    All row rules are counted in one pass; ``foreign`` maps a name to (column, parent table).
    """
    one = df.agg(*[F.count_if(~F.coalesce(F.expr(r), F.lit(True))).alias(n) for n, r in rules.items()])
    out = one.unpivot([], list(rules), "rule", "violations")
    for name, keys in (unique or {}).items():
        dupes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        out = out.unionByName(dupes.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    for name, (column, parent) in (foreign or {}).items():
        orphans = df.where(F.col(column).isNotNull()).join(parent.select(column).distinct(), column, "left_anti")
        out = out.unionByName(orphans.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("rule"), "violations"))
    return out
