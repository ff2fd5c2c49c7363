"""Provider results to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.keys import headcount_midpoint, top_key

DESCRIPTION_CHARS = 500


def revealed_email(email: Column, revealed: Column) -> Column:
    """Empty unless the address is revealed and not masked."""
    return F.when(F.coalesce(revealed, F.lit(True)) & ~F.contains(email, F.lit("*")), email).otherwise("")


def flatten_person_results(df: DataFrame) -> DataFrame:
    """Nested (person, company) search results to the flat lead row."""
    def text(path: str) -> Column:
        return F.coalesce(F.col(path), F.lit(""))
    return df.select(
        text("person.first_name").alias("first_name"), text("person.last_name").alias("last_name"),
        F.coalesce(revealed_email(F.col("person.email.email"), F.col("person.email.revealed")), F.lit("")).alias("email"),
        text("person.linkedin_url").alias("linkedin_url"), text("person.current_job_title").alias("job_title"),
        text("company.name").alias("company_name"), text("company.domain").alias("company_domain"),
        text("company.industry").alias("company_industry"),
        F.coalesce("company.headcount", F.lit(0)).alias("company_headcount"),
        F.coalesce(F.nullif("company.location.state", F.lit("")), F.col("company.location.country"), F.lit("")).alias("company_location"),
        F.concat_ws("; ", "company.technologies").alias("company_technologies"))


def flatten_company_results(df: DataFrame, source: str) -> DataFrame:
    """Provider companies to rows: top industry, headcount midpoint, company page, short text."""
    page = F.try_element_at(F.filter("social_urls", lambda u: F.contains(u, F.lit("/company"))), F.lit(1))
    return df.select(
        F.lower("domain").alias("domain"), F.coalesce("name", F.lit("")).alias("company_name"),
        F.coalesce(top_key(F.col("industry_groups")), F.lit("")).alias("industry"),
        F.coalesce("employees", F.lit("")).alias("headcount_range"), headcount_midpoint(F.col("employees")).alias("headcount"),
        F.coalesce("address.country", F.lit("")).alias("location_country"), F.coalesce(page, F.lit("")).alias("linkedin_url"),
        F.substring(F.coalesce("description", F.lit("")), 1, DESCRIPTION_CHARS).alias("description"),
        F.lit(source).alias("source"))
