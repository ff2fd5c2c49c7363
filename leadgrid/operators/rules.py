"""Rule classification of companies. Vocabularies are arguments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.bands import first_match, is_true, team_route
from leadgrid.functions.text import any_term, matched_terms, normalize_text

Rule = tuple[str, Sequence[str], str]


def joined_text(*cols: Column) -> Column:
    return F.concat_ws(" ", *[normalize_text(c) for c in cols])


def classify_company(df: DataFrame, rules: Sequence[Rule], fields: Sequence[str],
                     refine: Mapping[str, tuple[Sequence[str], str]] | None = None,
                     default: tuple[str, str] = ("review", "no strong signal")) -> DataFrame:
    """Adds ``bucket`` and ``reason``: the first (bucket, terms, reason) rule that hits.

    ``refine`` maps a bucket to (terms, reason): extra terms that change only the reason.
    """
    text = F.col("_text")
    steps = []
    for bucket, terms, reason in rules:
        why = F.lit(reason)
        if refine and bucket in refine:
            more, better = refine[bucket]
            why = F.when(any_term(text, more, folded=True), F.lit(better)).otherwise(why)
        steps.append((any_term(text, terms, folded=True), F.struct(F.lit(bucket).alias("bucket"), why.alias("reason"))))
    fallback = F.struct(F.lit(default[0]).alias("bucket"), F.lit(default[1]).alias("reason"))
    out = df.withColumn("_text", joined_text(*[F.col(f) for f in fields])) \
            .withColumn("_hit", first_match(steps, fallback))
    return out.withColumn("bucket", F.col("_hit.bucket")).withColumn("reason", F.col("_hit.reason")) \
              .drop("_text", "_hit")


def industry_bucket(existing: Column, text: Column, rules: Sequence[tuple[str, Sequence[str]]],
                    other: str = "Other") -> Column:
    """An existing non-blank vertical wins; else the first rule that hits; else ``other``."""
    kept = F.nullif(F.trim(existing), F.lit(""))
    found = first_match([(any_term(text, terms), F.lit(label)) for label, terms in rules], F.lit(other))
    return F.coalesce(kept, found)


def specialist_ensemble(df: DataFrame, specialists: Sequence[tuple[str, str, float, Sequence[str]]],
                        fields: Sequence[str]) -> DataFrame:
    """Every specialist (name, bucket, confidence, terms) scores a row; the most confident
    one wins and the earliest wins a tie. Evidence is the first three terms found."""
    text = F.lower(F.concat_ws(" ", *[F.coalesce(F.col(f), F.lit("")) for f in fields]))
    order = sorted(range(len(specialists)), key=lambda i: -specialists[i][2])
    steps = []
    for i in order:
        name, bucket, confidence, terms = specialists[i]
        evidence = F.array_join(F.slice(matched_terms(F.col("_text"), terms), 1, 3), ", ")
        steps.append((any_term(F.col("_text"), terms, folded=True), _verdict(name, bucket, confidence, evidence)))
    nobody = _verdict("manager", "review", 0.2, F.lit("no specialist matched"))
    return df.withColumn("_text", text).withColumn("_best", first_match(steps, nobody)) \
             .select("*", "_best.*").drop("_text", "_best")


def _verdict(agent: str, bucket: str, confidence: float, evidence: Column) -> Column:
    return F.struct(F.lit(bucket).alias("bucket"), F.lit(float(confidence)).alias("confidence"),
                    F.lit(agent).alias("agent"), evidence.alias("evidence"))


def is_transport(fields: Sequence[str], terms: Sequence[str]) -> Column:
    """Any keyword in the concatenated fields."""
    return any_term(F.concat_ws(" ", *[F.coalesce(F.col(f), F.lit("")) for f in fields]), terms)


def is_b2b(model: Column) -> Column:
    """b2b and mixed are true, b2c and noncommercial false, anything else unknown."""
    return F.when(model.isin("b2b", "mixed"), True).when(model.isin("b2c", "noncommercial"), False)


def route_by_team_size(sales_count: Column, runs_ads: Column, angles: Mapping[str, str],
                       ads_angle: str, ads_routes: Sequence[str]) -> Column:
    """Primary angle by team-size route; advertisers on an eligible route get ``ads_angle``."""
    route = team_route(sales_count)
    by_size = first_match([(route == k, F.lit(v)) for k, v in angles.items()], F.lit(None).cast("string"))
    return F.when(is_true(runs_ads) & route.isin(*ads_routes), F.lit(ads_angle)).otherwise(by_size)


def priority_tier(relevance: Column, sales_bucket: Column, marketing_bucket: Column) -> Column:
    """1: best relevance, a real sales team and little marketing. 2: best relevance, no team
    seen at all. 3: the same cells at lower relevance, and large teams with structured
    marketing. Null: none of these."""
    small_team = sales_bucket.isin("1-2", "3-10")
    little_marketing = marketing_bucket.isin("0", "1-2")
    empty = (sales_bucket == "0") & (marketing_bucket == "0")
    large = sales_bucket.isin("11-50", "50+") & marketing_bucket.isin("11-50", "50+")
    best = F.coalesce(relevance == "A", F.lit(False))
    return F.when(best & small_team & little_marketing, 1).when(best & empty, 2) \
            .when(relevance.isin("B", "C") & ((small_team & little_marketing) | empty), 3) \
            .when(large, 3)


def assign_persona(sales_bucket: Column, marketing_bucket: Column) -> Column:
    """Buyer personas worth looking for: owner always, the others where the team exists."""
    present = ["1-2", "3-10", "11-50", "50+"]
    return F.array_compact(F.array(
        F.lit("owner"),
        F.when(sales_bucket.isin(*present), F.lit("sales_lead")),
        F.when(marketing_bucket.isin(*present), F.lit("marketing_lead"))))


def persona_titles(title: Column, include: Sequence[str], exclude: Sequence[str]) -> Column:
    """Title belongs to a persona: any included word and none of the excluded ones."""
    return any_term(title, include) & ~any_term(title, exclude)


def pain_segment(attributes: Column, rules: Sequence[tuple[str, str, str]],
                 default: str = "unassigned") -> Column:
    """First (attribute, value, segment) rule that the attribute map satisfies."""
    steps = [(F.coalesce(F.try_element_at(attributes, F.lit(k)) == v, F.lit(False)), F.lit(s))
             for k, v, s in rules]
    return first_match(steps, F.lit(default))
