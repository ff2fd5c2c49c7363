"""One canonical company per domain, and the people linked to it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.bands import is_true
from leadgrid.functions.keys import email_domain, name_key, norm_domain
from leadgrid.operators.grouping import best_per_key, computed_once, lookup_join, newest_struct

FIT = ("high", "medium")


def with_domain(df: DataFrame, source: str = "domain", out: str = "nd") -> DataFrame:
    """Rows whose normalized domain is valid, keyed by it (computed once)."""
    return computed_once(df, out, norm_domain(F.col(source))).where(F.col(out).isNotNull())


def distinct_sorted(col: str) -> Column:
    """Distinct values of a small vocabulary, sorted, without nulls."""
    return F.sort_array(F.collect_set(col))


def agg_by_domain(lists: DataFrame) -> DataFrame:
    """Largest counts and the sets of niches and sources per domain."""
    return with_domain(lists).groupBy("nd").agg(
        F.max("staff_linkedin").alias("employees_on_linkedin"),
        F.max("sales_count").alias("sales_count"),
        F.max("marketing_count").alias("marketing_count"),
        distinct_sorted("niche").alias("niches"), distinct_sorted("source").alias("sources"))


def best_row_per_key(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Representative row: highest staff, then newest, then smallest id."""
    return best_per_key(df, [key], [F.desc_nulls_last("staff_linkedin"),
                                    F.desc_nulls_last("updated_at"), F.asc(id_col)])


def latest_per_key(df: DataFrame, key: str, id_col: str, time_col: str = "updated_at") -> DataFrame:
    """Newest row per key; the smallest id wins a tie."""
    return best_per_key(df, [key], [F.desc_nulls_last(time_col), F.asc(id_col)])


def agg_with_best(lists: DataFrame, carried: Sequence[str], more: Sequence[Column] = ()) -> DataFrame:
    """Group aggregates plus the representative row's ``carried`` columns, and ``more`` aggregates.

    One shuffle: the representative is a ``max_by`` in the same aggregation, not a join.
    """
    best = newest_struct(carried, F.col("staff_linkedin"), F.col("updated_at"), -F.col("row_id"))
    return with_domain(lists).groupBy("nd").agg(
        F.max("staff_linkedin").alias("employees_on_linkedin"),
        F.max("sales_count").alias("sales_count"),
        F.max("marketing_count").alias("marketing_count"),
        distinct_sorted("niche").alias("niches"), distinct_sorted("source").alias("sources"),
        best.alias("_best"), *more).select("*", "_best.*").drop("_best")


def fill_from(base: DataFrame, key: str, fillers: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill null ``columns`` of ``base`` from ``fillers`` (one row per key)."""
    right = fillers.select(key, *[F.col(c).alias(f"_fill_{c}") for c in columns])
    joined = base.join(right, key, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_fill_{c}")) for c in columns}
    return joined.withColumns(filled).drop(*[f"_fill_{c}" for c in columns])


def meta_fillers(lists: DataFrame) -> DataFrame:
    """Best known value of each fillable field over all rows of a domain.

    Text takes the greatest string; staff only digit strings above zero.
    """
    return with_domain(lists).groupBy("nd").agg(*_fillers(""))


def _fillers(prefix: str) -> list[Column]:
    staff = F.when(F.col("meta_staff").rlike("^[0-9]+$"), F.col("meta_staff").try_cast("int"))
    return [F.max("meta_linkedin").alias(f"{prefix}linkedin_url"),
            F.max("meta_revenue_range").alias(f"{prefix}revenue_range"),
            F.nullif(F.max(staff), F.lit(0)).alias(f"{prefix}employees_on_linkedin")]


def merge_sources(base: DataFrame, other: DataFrame, key: str, spec: Mapping[str, str]) -> DataFrame:
    """Full outer merge of two one-row-per-key tables.

    ``spec`` says per column who wins: ``keep`` base then other, ``prefer`` other then base,
    ``or`` boolean or, ``union`` sorted union of arrays. Columns not named are kept.
    """
    left, right = set(base.columns) - {key}, set(other.columns) - {key}
    mine = base.select(key, *[F.col(c).alias(f"_l_{c}") for c in left])
    theirs = other.select(key, *[F.col(c).alias(f"_r_{c}") for c in right])
    joined = mine.join(theirs, key, "full_outer")
    types = {**dict(other.dtypes), **dict(base.dtypes)}
    out = [F.col(key)]
    for c in [*base.columns, *[c for c in other.columns if c not in base.columns]]:
        if c == key:
            continue
        lc = F.col(f"_l_{c}") if c in left else F.lit(None).cast(types[c])
        rc = F.col(f"_r_{c}") if c in right else F.lit(None).cast(types[c])
        out.append(_merged(lc, rc, spec.get(c, "keep"), types[c]).alias(c))
    return joined.select(*out)


def _merged(left: Column, right: Column, how: str, kind: str) -> Column:
    if how == "keep":
        return F.coalesce(left, right)
    if how == "prefer":
        return F.coalesce(right, left)
    if how == "or":
        return is_true(left) | is_true(right)
    if how == "union":
        empty = F.array().cast(kind)
        return union_sources(F.coalesce(left, empty), F.coalesce(right, empty))
    raise ValueError(f"unknown merge rule {how}")


def union_sources(left: Column, right: Column) -> Column:
    """Sorted distinct union of two arrays."""
    return F.sort_array(F.array_union(left, right))


def mark_exists(base: DataFrame, key: str, others: DataFrame, out: str) -> DataFrame:
    """Set ``out`` where the key occurs in ``others``; an earlier true stays."""
    seen = others.select(key).distinct().withColumn("_seen", F.lit(True))
    joined = base.join(seen, key, "left")
    before = is_true(F.col(out)) if out in base.columns else F.lit(False)
    return joined.withColumn(out, before | F.col("_seen").isNotNull()).drop("_seen")


def link_domains(contacts: DataFrame, companies: DataFrame) -> DataFrame:
    """People keyed by domain: their company's by id, else their e-mail domain."""
    by_id = companies.select(F.col("id").alias("company_id"), norm_domain(F.col("domain")).alias("_by_id"))
    return lookup_join(contacts, by_id, ["company_id"], "id") \
        .withColumn("company_domain", F.coalesce("_by_id", norm_domain(email_domain(F.col("email"))))) \
        .where(F.col("company_domain").isNotNull()).drop("_by_id")


def relink_contacts(contacts: DataFrame, companies: DataFrame, company: DataFrame) -> DataFrame:
    """Linked people whose domain is a known company."""
    linked = link_domains(contacts, companies)
    known = company.select(F.col("domain").alias("company_domain"))
    return linked.join(known, "company_domain", "left_semi")


def backfill_contact_signals(company: DataFrame, contact: DataFrame) -> DataFrame:
    """Number of people and of people with LinkedIn, back on the company."""
    counts = contact.groupBy(F.col("company_domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("n_contacts"), F.count("linkedin_url").alias("linkedin_contacts"))
    joined = company.join(counts, "domain", "left")
    return joined.withColumn("has_contacts", F.col("n_contacts").isNotNull()) \
        .withColumn("n_contacts", F.coalesce("n_contacts", F.lit(0))) \
        .withColumn("linkedin_contacts", F.coalesce("linkedin_contacts", F.lit(0)))


def outbound_ready(company: DataFrame, contact: DataFrame) -> DataFrame:
    """B2B companies of good fit that have at least one person with an e-mail address."""
    reachable = contact.where(F.col("email").isNotNull()).select(F.col("company_domain").alias("domain"))
    return company.where(is_true(F.col("is_b2b")) & F.col("outbound_fit").isin(*FIT)
                         & F.col("has_contacts")).join(reachable, "domain", "left_semi")


COVERAGE = {
    "total_companies": "true",
    "with_linkedin_url": "has_linkedin",
    "with_employee_headcount": "employees_on_linkedin > 0",
    "with_linkedin_contacts": "linkedin_contacts > 0",
    "with_any_contact": "has_contacts",
    "crawled": "crawled",
    "classified": "classified",
    "b2b": "is_b2b",
    "outbound_fit_ok": "outbound_fit IN ('high', 'medium')",
}


def coverage(company: DataFrame) -> DataFrame:
    """Nine conditional counts in one pass."""
    return company.agg(*[F.count_if(F.expr(rule)).alias(name) for name, rule in COVERAGE.items()])


def coverage_report(company: DataFrame, contact: DataFrame) -> DataFrame:
    """The same figures, and those of the people, as (metric, value) rows."""
    people = contact.agg(F.count(F.lit(1)).alias("contacts"), F.count("email").alias("with_email"),
                         F.count("linkedin_url").alias("with_linkedin"))
    ready = outbound_ready(company, contact).agg(F.count(F.lit(1)).alias("outbound_ready"))
    return report_union([coverage(company), people, ready])


def report_union(reports: Sequence[DataFrame]) -> DataFrame:
    """One-row reports as a single list of (metric, value) rows."""
    rows = [r.unpivot([], r.columns, "metric", "value") for r in reports]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


# --- the whole build ---------------------------------------------------------

MERGE_COMPANIES = {"has_linkedin": "or", "employee_count": "prefer", "sources": "union"}
MERGE_PROFILES = {"business_model": "prefer", "is_b2b": "prefer", "outbound_fit": "prefer",
                  "what_they_sell": "prefer", "primary_customer": "prefer", "classified": "or",
                  "crawled": "or", "sources": "union"}


CARRIED = ["name", "company_size", "industry", "meta_linkedin", "meta_revenue_range", "meta_description",
           "meta_founded_year", "meta_country", "meta_state", "meta_city", "sales_bucket", "marketing_bucket"]


def company_from_lists(lists: DataFrame) -> DataFrame:
    """Companies known from lists, gaps filled from any row of the domain: one scan, one aggregation."""
    base = agg_with_best(lists, CARRIED, _fillers("_fill_"))
    linkedin = F.coalesce(F.nullif("meta_linkedin", F.lit("")), "_fill_linkedin_url")
    return base.select(
        F.col("nd").alias("domain"), "name", F.col("meta_description").alias("description"),
        linkedin.alias("linkedin_url"), linkedin.isNotNull().alias("has_linkedin"),
        F.coalesce("employees_on_linkedin", "_fill_employees_on_linkedin").alias("employees_on_linkedin"),
        F.col("company_size").alias("size_bucket"), F.nullif("industry", F.lit("")).alias("industry"),
        F.coalesce("meta_revenue_range", "_fill_revenue_range").alias("revenue_range"),
        F.col("meta_founded_year").alias("founded_year"), F.col("meta_country").alias("hq_country"),
        F.col("meta_state").alias("hq_state"), F.col("meta_city").alias("hq_city"),
        "sales_count", "sales_bucket", "marketing_count", "marketing_bucket", "sources", "niches")


def company_from_registry(companies: DataFrame) -> DataFrame:
    newest = latest_per_key(with_domain(companies), "nd", "id")
    return newest.select(
        F.col("nd").alias("domain"), "name", "website",
        F.coalesce("description", "description_short").alias("description"), "linkedin_url",
        F.col("linkedin_url").isNotNull().alias("has_linkedin"), "employee_count", "size_bucket", "industry",
        "hq_country", "hq_state", "hq_city", F.array(F.lit("directory")).alias("sources"))


def company_from_profiles(profiles: DataFrame) -> DataFrame:
    newest = latest_per_key(with_domain(profiles), "nd", "profile_id")
    return newest.select(
        F.col("nd").alias("domain"), "business_model", "is_b2b", "outbound_fit", "what_they_sell",
        "primary_customer", (F.col("profile_status") == "accepted").alias("classified"),
        F.col("source_crawl_ok").alias("crawled"), F.array(F.lit("crawl")).alias("sources"))


def canonical_company(lists: DataFrame, companies: DataFrame, profiles: DataFrame,
                      crawls: DataFrame) -> DataFrame:
    """One row per domain over all sources. Every merge side has one row per key, so the
    full outer joins cannot skew, and all of them share the hash partitioning on domain."""
    merged = merge_sources(company_from_lists(lists), company_from_registry(companies),
                           "domain", MERGE_COMPANIES)
    merged = merge_sources(merged, company_from_profiles(profiles), "domain", MERGE_PROFILES)
    crawled = crawls.where("ok").select(norm_domain(F.col("domain")).alias("domain"))
    merged = mark_exists(merged, "domain", crawled, "crawled")
    return merged.withColumns({c: is_true(F.col(c)) for c in ("has_linkedin", "classified")})


def canonical_tables(lists: DataFrame, companies: DataFrame, profiles: DataFrame, crawls: DataFrame, contacts: DataFrame,
                     store: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(company with contact signals, contact).

    Lazy, unless ``store`` writes the company table and reads it back: then the people are
    matched against the stored table instead of a second build.
    """
    company = canonical_company(lists, companies, profiles, crawls)
    linked = link_domains(contacts, companies)
    # The left join drops unknown domains by itself: counting needs no second company build.
    full = backfill_contact_signals(company, linked)
    if store:
        full = company = store(full, "company")
    known = company.select(F.col("domain").alias("company_domain"))
    return full, linked.join(known, "company_domain", "left_semi")


# --- registries and the lead layer -------------------------------------------

def match_registry(registry: DataFrame, company: DataFrame, row_id: str) -> DataFrame:
    """Link a registry entity to a company by legal name, else by trade name."""
    named = best_per_key(company.select(name_key(F.col("name")).alias("_nk"), "domain")
                         .where("_nk IS NOT NULL"), ["_nk"], [F.asc("domain")])
    legal = named.select(F.col("_nk").alias("_legal"), F.col("domain").alias("_by_legal"))
    trade = named.select(F.col("_nk").alias("_trade"), F.col("domain").alias("_by_trade"))
    keyed = registry.withColumn("_legal", name_key(F.col("legal_name"))) \
                    .withColumn("_trade", name_key(F.col("trade_name")))
    joined = lookup_join(lookup_join(keyed, legal, ["_legal"], row_id), trade, ["_trade"], row_id)
    return joined.withColumn("domain", F.coalesce("_by_legal", "_by_trade")) \
        .withColumn("matched_by", F.when(F.col("_by_legal").isNotNull(), "legal_name")
                    .when(F.col("_by_trade").isNotNull(), "trade_name")) \
        .drop("_legal", "_trade", "_by_legal", "_by_trade")


def join_crawl_registry(crawls: DataFrame, labels: DataFrame, registry: DataFrame) -> DataFrame:
    """Crawl, classification and registry of the same domain; one row per domain on each side."""
    return crawls.join(labels, "nd").join(registry, "nd")


def lead_master(company: DataFrame, people: DataFrame) -> DataFrame:
    """Companies and people in one layer, one row per master key.

    A person's key is the e-mail address, else LinkedIn, else name at domain; a company's is
    its domain. ``basis`` says which one it was.
    """
    firms = company.select(
        F.lit("company").alias("record_type"), F.concat(F.lit("domain:"), F.col("domain")).alias("master_key"),
        F.lit("domain").alias("basis"), F.col("domain").alias("source_id"))
    email = F.nullif(F.lower(F.trim("email")), F.lit(""))
    linkedin = F.nullif(F.lower(F.trim("linkedin_url")), F.lit(""))
    named = F.concat(F.lower("first_name"), F.lit(" "), F.lower("last_name"), F.lit("@"), F.col("company_domain"))
    persons = people.select(
        F.lit("person").alias("record_type"),
        F.coalesce(F.concat(F.lit("email:"), email), F.concat(F.lit("linkedin:"), linkedin),
                   F.concat(F.lit("name:"), named)).alias("master_key"),
        F.when(email.isNotNull(), "email").when(linkedin.isNotNull(), "linkedin").otherwise("name").alias("basis"),
        F.lpad(F.col("id").cast("string"), 20, "0").alias("source_id"))
    both = firms.unionByName(persons.where("master_key IS NOT NULL"))
    return both.groupBy("master_key").agg(
        F.min_by(F.struct("record_type", "basis", "source_id"), F.struct("source_id")).alias("_first"),
        F.count(F.lit(1)).alias("n_rows")).select("master_key", "_first.*", "n_rows")
