"""Company and lead lists: load, clean, score, count, order, split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.bands import count_bucket, is_true, ratio, round_half_up
from leadgrid.functions.text import any_term
from leadgrid.operators.grouping import best_k_per_key, best_per_key, global_row_number

# Local parts of shared mailboxes.
ROLE_MAILBOXES = ("info", "contact", "hello", "hi", "sales", "team", "support", "admin",
                  "noreply", "no-reply", "office", "marketing")
# Words that mark a title as irrelevant, and placeholder names.
BAD_TITLES = (r"\bintern(ship)?\b", r"\bassistant\b", r"\bcoordinator\b", r"\bstudent\b",
              r"\bpart.time\b", r"\bretired\b", r"\btrainee\b")
PLACEHOLDER_NAMES = ("admin", "info", "contact", "test", "user", "n/a", "na")
# Grades by lowest score, and the weight of each dimension.
GRADES = ((93, "A+"), (90, "A"), (80, "B"), (70, "C"), (60, "D"))
WEIGHTS = {"verification": 2.0, "duplicate_emails": 1.0, "duplicate_domains": 1.0, "title_relevance": 1.5,
           "bad_titles": 1.0, "role_mailboxes": 1.0, "icp_fit": 2.0, "names": 1.0}
# Work order of relevance; no relevance comes right after the best.
RELEVANCE_ORDER = {"A": 0, "B": 2, "C": 3}
RELEVANCE_NULL, RELEVANCE_OTHER = 1, 4
VERIFIED = ("ok", "verified", "valid")
EXPORT_MAX = 50_000
BUCKETS = ("0", "1-2", "3-10", "11-50", "50+")


# --- loading -------------------------------------------------------------------

def load_list_with_meta(df: DataFrame, known: Sequence[str], aliases: Mapping[str, str],
                        ints: Sequence[str], domain_col: str = "domain") -> DataFrame:
    """Known columns to typed fields, every other non-empty value into the ``meta`` map.

    An integer that does not parse goes to ``meta``. Rows without a domain are left out.
    """
    domain = F.regexp_replace(F.trim(F.lower(F.col(domain_col))), r"^www\.", "")
    source_of = {aliases.get(c, c): c for c in df.columns if c != domain_col}
    out, loose = [domain.alias("domain")], []
    for name in known:
        raw = F.nullif(F.col(source_of[name]), F.lit("")) if name in source_of else F.lit(None).cast("string")
        out.append((raw.try_cast("int") if name in ints else raw).alias(name))
        if name in ints and name in source_of:
            loose += [F.lit(source_of[name]), F.when(raw.isNotNull() & raw.try_cast("int").isNull(), raw)]
    for name, raw in source_of.items():
        if name not in known:
            loose += [F.lit(raw), F.nullif(F.col(raw), F.lit(""))]
    meta = F.map_filter(F.create_map(*loose), lambda _, v: v.isNotNull()) if loose \
        else F.create_map().cast("map<string,string>")
    return df.where(F.contains(domain, F.lit("."))).select(*out, meta.alias("meta"))


def dedupe_last(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The last row to arrive wins."""
    return best_per_key(df, keys, [F.desc(arrival)])


def dedupe_first(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """The first row to arrive wins."""
    return best_per_key(df, keys, [F.asc(arrival)])


def denylist(df: DataFrame, domains: Sequence[str], key: str = "domain") -> DataFrame:
    """Without aggregator domains; done before joins and counts, where they would be hot keys."""
    return df.where(~is_true(F.col(key).isin(*domains)))


def filter_places(df: DataFrame, state: str | None = None, city: str | None = None,
                  min_population: int | None = None) -> DataFrame:
    """Places with five-digit codes by state, part of the city name and population.

    Short codes are padded; longer ones are no codes and drop out.
    """
    df = df.where(F.length("zip") <= 5).withColumn("zip", F.lpad("zip", 5, "0"))
    if state:
        df = df.where(F.upper("state") == state.upper())
    if city:
        df = df.where(F.contains(F.lower("city"), F.lit(city.lower())))
    if min_population is not None:
        df = df.where(F.col("population") >= min_population)
    return df


# --- row checks ----------------------------------------------------------------

def bad_title(title: Column, patterns: Sequence[str] = BAD_TITLES) -> Column:
    return F.coalesce(title, F.lit("")).rlike("(?i)" + "|".join(patterns))


def role_mailbox(email: Column, mailboxes: Sequence[str] = ROLE_MAILBOXES) -> Column:
    return is_true(F.lower(F.split_part(email, F.lit("@"), F.lit(1))).isin(*mailboxes))


def fake_name(first: Column, last: Column, placeholders: Sequence[str] = PLACEHOLDER_NAMES) -> Column:
    """A part is missing, shouted, numbered or a placeholder."""
    first, last = F.coalesce(first, F.lit("")), F.coalesce(last, F.lit(""))
    shouted = (F.upper(first) == first) & (F.length(first) > 2)
    return (first == "") | (last == "") | shouted | first.rlike(r"\d") | last.rlike(r"\d") \
        | F.lower(first).isin(*placeholders) | F.lower(last).isin(*placeholders)


# --- scorecard -----------------------------------------------------------------

def lead_domain() -> Column:
    given = F.nullif(F.col("company_domain"), F.lit(""))
    return F.nullif(F.lower(F.coalesce(given, F.split_part("email", F.lit("@"), F.lit(2)))), F.lit(""))


def duplicate_emails(df: DataFrame) -> DataFrame:
    """Rows beyond the first per address; blank addresses are no duplicates."""
    email = F.nullif(F.lower("email"), F.lit(""))
    return df.agg((F.count(email) - F.count_distinct(email)).alias("duplicate_emails"),
                  F.count(F.lit(1)).alias("total"))


def domain_concentration(df: DataFrame, many: int = 5) -> DataFrame:
    """Domains, average leads per domain (over all rows) and domains with more than ``many``."""
    per = df.groupBy(lead_domain().alias("_d")).agg(F.count(F.lit(1)).alias("n"))
    known = F.col("_d").isNotNull()
    return per.agg(F.count("_d").alias("domains"), F.sum("n").alias("total"),
                   F.count_if(known & (F.col("n") > many)).alias("over_concentrated")) \
              .withColumn("avg_per_domain", ratio(F.col("total"), F.col("domains")))


def list_scorecard(df: DataFrame, titles: Sequence[str] = (), industries: Sequence[str] = (),
                   headcount: tuple[int, int | None] = (0, None)) -> DataFrame:
    """One row: eight scores 0–100 (−1 where not applicable), the weighted total and a grade.

    Leads are first combined per domain, so the second aggregation sees one row per domain;
    the distinct addresses are counted apart and joined as a scalar.
    """
    title = F.lower(F.coalesce("job_title", F.lit("")))
    status = F.lower(F.coalesce("email_status", F.lit("")))
    low, high = headcount
    fits = is_true(any_term(F.col("company_industry"), industries)) if industries else F.lit(True)
    heads = F.coalesce("company_headcount", F.lit(0))
    sized = (heads == 0) | ((heads >= low) & (heads <= high if high is not None else F.lit(True)))
    first_word = F.split_part(title, F.lit(" "), F.lit(1))
    wanted = F.lit(False)
    for t in titles:
        wanted = wanted | F.contains(title, F.lit(t.lower())) | F.contains(F.lit(t.lower()), first_word)
    counted = {
        "n": F.lit(True), "verified": status.isin(*VERIFIED), "has_status": status != "",
        "titled": (title != "") & wanted, "bad": bad_title(F.col("job_title")), "role": role_mailbox(F.col("email")),
        "icp": fits & sized, "fake": fake_name(F.col("first_name"), F.col("last_name"))}
    per = df.groupBy(lead_domain().alias("_d")).agg(*[F.count_if(c).alias(n) for n, c in counted.items()])
    email = F.nullif(F.lower("email"), F.lit(""))
    dupes = df.agg((F.count(email) - F.count_distinct(email)).alias("dupes"))
    total = per.agg(F.count("_d").alias("domains"),
                    F.count_if(F.col("_d").isNotNull() & (F.col("n") > 5)).alias("over_concentrated"),
                    *[F.sum(n).alias(n) for n in counted]).withColumn("dupes", dupes.scalar())

    def share(name: str) -> Column:
        return ratio(F.col(name), F.col("n"), 100.0)
    average = ratio(F.col("n"), F.col("domains"))
    role = share("role")
    scores = {
        "verification": F.when(F.col("has_status") > 0, round_half_up(share("verified"))).otherwise(0),
        "duplicate_emails": F.greatest(F.lit(0), round_half_up(100 - share("dupes") * 20)),
        "duplicate_domains": F.when(average < 2, 100).when(average < 5, 60).otherwise(30),
        "title_relevance": round_half_up(share("titled")) if titles else F.lit(-1),
        "bad_titles": F.greatest(F.lit(0), round_half_up(100 - share("bad") * 10)),
        "role_mailboxes": F.when(role < 5, 100).when(role < 15, round_half_up(100 - (role - 5) * 5)).otherwise(0),
        "icp_fit": round_half_up(share("icp")) if industries or low > 0 else F.lit(-1),
        "names": round_half_up(ratio(F.col("n") - F.col("fake"), F.col("n"), 100.0)),
    }
    scored = total.withColumns({k: v.cast("bigint") for k, v in scores.items()})
    weight = sum(F.when(F.col(k) >= 0, w).otherwise(0.0) for k, w in WEIGHTS.items())
    points = sum(F.when(F.col(k) >= 0, F.col(k) * w).otherwise(0.0) for k, w in WEIGHTS.items())
    scored = scored.withColumn("overall", round_half_up(points / weight))
    grade = F.lit("F")
    for lowest, letter in reversed(GRADES):
        grade = F.when(F.col("overall") >= lowest, letter).otherwise(grade)
    return scored.withColumn("grade", grade)


def list_issues(scorecard: DataFrame, most: int = 5) -> DataFrame:
    """Up to ``most`` ranked problems as text rows of one scorecard."""
    def pct(name: str) -> Column:
        return F.format_string("%.1f", round_half_up(ratio(F.col(name), F.col("n"), 100.0), 1))

    def line(condition: Column, *parts: Column | str) -> Column:
        return F.when(condition, F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))
    n = F.col("n")
    found = F.array_compact(F.array(
        line(F.col("has_status") == 0, "no verification column: verify before sending"),
        line((F.col("has_status") > 0) & (F.col("verification") < 100), n - F.col("verified"), " emails unverified"),
        line(F.col("dupes") > 0, F.col("dupes"), " duplicate emails (", pct("dupes"), "%)"),
        line(F.col("role") > 0, F.col("role"), " leads on shared mailboxes (", pct("role"), "%)"),
        line(F.col("bad") > 0, F.col("bad"), " bad titles (", pct("bad"), "%)"),
        line(F.col("over_concentrated") > 0, F.col("over_concentrated"), " domains with more than 5 leads"),
        line((F.col("icp_fit") >= 0) & (F.col("icp_fit") < 80), n - F.col("icp"), " leads outside the profile"),
        line(F.col("fake") > n * 0.05, F.col("fake"), " rows with doubtful names")))
    return scorecard.select(F.posexplode(F.slice(found, 1, most)).alias("place", "issue"))


# --- counts and matrices ---------------------------------------------------------

def bucket_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, most common first."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *[F.asc(k) for k in keys])


def top_n(df: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` most common keys."""
    return bucket_counts(df, keys).limit(n)


def ads_by_domain(domains: DataFrame, ads: DataFrame) -> DataFrame:
    """Does each domain advertise, since when last, in which formats (sorted, by comma)."""
    per = ads.groupBy("domain").agg(
        F.max(F.substring("last_shown", 1, 10)).alias("ads_last_shown"),
        F.array_join(F.sort_array(F.collect_set(F.nullif("format", F.lit("")))), ",").alias("ads_formats"),
        F.lit(True).alias("_seen"))
    return domains.select("domain").distinct().join(per, "domain", "left") \
        .withColumn("ads_runs", F.col("_seen").isNotNull()).drop("_seen")


def relevance_order(col: Column) -> Column:
    out = F.when(col.isNull(), RELEVANCE_NULL)
    for label, rank in RELEVANCE_ORDER.items():
        out = out.when(col == label, rank)
    return out.otherwise(RELEVANCE_OTHER)


def work_order(df: DataFrame, *tie: str) -> DataFrame:
    """Best relevance, then none given, then the rest."""
    return df.orderBy(relevance_order(F.col("relevance")), *[F.asc(c) for c in tie])


def department_plan(df: DataFrame, counts: Sequence[str], banned: Sequence[str] = ()) -> DataFrame:
    """Per domain: priority and, per count column, whether to copy a known value, count it
    anew or skip it because every row has it."""
    per = denylist(df, banned).where(F.col("domain").isNotNull()).groupBy("domain").agg(
        F.min(relevance_order(F.col("relevance"))).alias("priority"),
        *[F.max(c).alias(f"{c}_known") for c in counts],
        *[F.max(F.col(c).isNull()).alias(f"_{c}_null") for c in counts])
    todo = {f"{c}_todo": F.when(~F.col(f"_{c}_null"), "skip").when(F.col(f"{c}_known").isNotNull(), "copy")
            .otherwise("count") for c in counts}
    return per.withColumns(todo).drop(*[f"_{c}_null" for c in counts])


def department_totals(plan: DataFrame, counts: Sequence[str], per_minute: float = 95.0) -> DataFrame:
    """Calls needed, values to copy and the time that the calls take."""
    sums = [F.count_if(F.col(f"{c}_todo") == what).alias(f"{c}_{what}") for c in counts for what in ("count", "copy")]
    todo = F.lit(False)
    for c in counts:
        todo = todo | (F.col(f"{c}_todo") != "skip")
    out = plan.agg(F.count(F.lit(1)).alias("domains"), F.count_if(todo).alias("with_work"), *sums)
    calls = sum(F.col(f"{c}_count") for c in counts)
    return out.withColumn("calls", calls).withColumn("eta_minutes", round_half_up(calls / per_minute, 1))


def _bucket_columns(prefix: str) -> dict[str, str]:
    return {b: prefix + b.replace("-", "_").replace("+", "_plus") for b in BUCKETS}


def team_matrix(df: DataFrame, key: str = "domain", relevance: str | None = None) -> DataFrame:
    """Sales bucket × marketing bucket over distinct companies, with totals both ways.

    ``relevance`` cuts to the companies whose best list row has it.
    """
    per = df.groupBy(key).agg(F.max("sales_count").alias("s"), F.max("marketing_count").alias("m"),
                              *([F.min("relevance").alias("best")] if relevance else []))
    per = per.where(F.col("best") == relevance) if relevance else per
    cells = per.select(F.coalesce(count_bucket(F.col("s")), F.lit("unknown")).alias("sales_bucket"),
                       count_bucket(F.col("m")).alias("m"))
    marks = [F.count_if(F.col("m") == b).alias(name) for b, name in _bucket_columns("m_").items()]
    out = cells.rollup("sales_bucket").agg(F.grouping("sales_bucket").alias("_g"), *marks,
                                           F.count(F.lit(1)).alias("total"))
    return out.withColumn("sales_bucket", F.when(F.col("_g") == 1, "total").otherwise(F.col("sales_bucket"))).drop("_g")


def vertical_matrix(fit: DataFrame, lists: DataFrame, key: str = "domain") -> DataFrame:
    """Vertical × sales bucket of fitting companies; those on no list have a row of their own."""
    known = lists.groupBy(key).agg(F.min("niche").alias("vertical"), F.max("sales_count").alias("s"))
    rows = fit.select(key).join(known, key, "left")
    marks = [F.count_if(count_bucket(F.col("s")) == b).alias(name) for b, name in _bucket_columns("s_").items()]
    return rows.groupBy(F.coalesce("vertical", F.lit("no list")).alias("vertical")).agg(
        F.count(F.lit(1)).alias("total"), *marks)


def field_coverage(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Percent of rows with a value, per field."""
    one = df.agg(*[round_half_up(ratio(F.count(f), F.count(F.lit(1)), 100.0), 2).alias(f) for f in fields])
    return one.unpivot([], list(fields), "field", "pct")


def relevance_distribution(df: DataFrame) -> DataFrame:
    """Count and percent per relevance, with none given as a class of its own."""
    per = df.groupBy(F.coalesce("relevance", F.lit("none")).alias("relevance")).agg(F.count(F.lit(1)).alias("n"))
    total = per.agg(F.sum("n").alias("total"))
    return per.withColumn("pct", round_half_up(ratio(F.col("n"), total.scalar(), 100.0), 2))


def undercount_suspects(df: DataFrame, staff_over: int = 50) -> DataFrame:
    """No sales team counted, yet many staff: reconcile with the other count and re-bucket."""
    sales = F.greatest("sales_count", "alt_sales_count")
    return df.where((F.col("sales_count") == 0) & (F.col("staff_linkedin") > staff_over)) \
             .withColumn("reconciled", sales).withColumn("reconciled_bucket", count_bucket(sales))


def inflated_counts(df: DataFrame, factor: int = 3, sales_over: int = 100) -> DataFrame:
    """Provider staff far above the people counted, or an implausible sales team."""
    counted = F.coalesce("sales_count", F.lit(0)) + F.coalesce("marketing_count", F.lit(0))
    inflated = F.col("staff_linkedin") > counted * factor
    return df.withColumn("inflated", is_true(inflated)).withColumn("review", is_true(F.col("sales_count") > sales_over)) \
             .where("inflated OR review")


def enrichment_funnel(df: DataFrame) -> DataFrame:
    """Had an address, found one, missed; then valid, invalid, unchecked; then final."""
    had, found = F.contains(F.coalesce("email", F.lit("")), F.lit("@")), F.contains(F.coalesce("found_email", F.lit("")), F.lit("@"))
    any_mail = had | found
    verdict = F.coalesce("verdict", F.lit("skip"))
    return df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(had).alias("already_had"), F.count_if(~had & found).alias("hits"),
        F.count_if(~had & ~found).alias("misses"), F.count_if(any_mail & (verdict == "ok")).alias("valid"),
        F.count_if(any_mail & (verdict == "invalid")).alias("invalid"),
        F.count_if(any_mail & (verdict == "skip")).alias("unchecked"),
        F.count_if(any_mail & (verdict != "invalid")).alias("final"))


def capped_count(df: DataFrame, cap: int) -> DataFrame:
    """Count, exact up to ``cap``, then "at least"; and how many rows one export may write."""
    total = F.col("_n")
    return df.agg(F.count(F.lit(1)).alias("_n")).select(
        F.least(total, F.lit(cap + 1).cast("bigint")).alias("total_matching"),
        (total > cap).alias("is_minimum"), F.least(total, F.lit(EXPORT_MAX).cast("bigint")).alias("exportable_rows"),
        (total > EXPORT_MAX).alias("export_capped"))


def multi_niche(df: DataFrame, key: str = "domain") -> DataFrame:
    """Rows, unique domains, and domains that occur in two or more niches."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("niche").alias("a"), F.max("niche").alias("b"))
    return per.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("domains"),
                   F.count_if(F.col("a") != F.col("b")).alias("multi_niche"))


# --- batches, shards, samples ------------------------------------------------------

def assign_batches(df: DataFrame, order: Sequence[Column], size: int) -> DataFrame:
    """Consecutive batches of ``size`` rows in a total order."""
    numbered = global_row_number(df, order, "row_no")
    return numbered.withColumn("batch_id", F.floor((F.col("row_no") - 1) / size))


def shard(key: Column, n: int) -> Column:
    """Stable shard number of a key: disjoint and complete for any ``n``."""
    return F.pmod(F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def stratified_sample(df: DataFrame, stratum: Sequence[str], key: str, n: int) -> DataFrame:
    """The same ``n`` rows per stratum on every run: those with the smallest key hash."""
    return best_k_per_key(df.withColumn("_h", F.md5(F.col(key).cast("string"))), stratum,
                          [F.asc("_h"), F.asc(key)], n).drop("_h")


def split_search(df: DataFrame, cap: int | Column, outer: str, inner: str) -> DataFrame:
    """Disjoint slices that stay under a provider's cap: by ``outer``, and where that is
    over the cap by ``inner`` as well. ``fits`` is false where even that is too large."""
    fine = df.groupBy(outer, inner).agg(F.count(F.lit(1)).alias("n"))
    whole = fine.groupBy(outer).agg(F.sum("n").alias("whole"))
    joined = fine.join(whole, outer)
    kept = F.when(F.col("whole") <= cap, F.lit(None).cast("string")).otherwise(F.col(inner).cast("string"))
    return joined.groupBy(outer, kept.alias(inner)).agg(F.sum("n").alias("n")).withColumn("fits", F.col("n") <= cap)


# --- sets ---------------------------------------------------------------------------

def union_lenses(lenses: Mapping[str, DataFrame], key: str) -> DataFrame:
    """What each search lens found and what it added to the lenses before it."""
    rows = None
    for place, (name, df) in enumerate(lenses.items()):
        part = df.select(key, F.lit(place).alias("place"), F.lit(name).alias("lens"))
        rows = part if rows is None else rows.unionByName(part)
    found = rows.where(F.col(key).isNotNull()).groupBy("place", "lens").agg(F.count_distinct(key).alias("found"))
    added = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("place").alias("place")) \
        .groupBy("place").agg(F.count(F.lit(1)).alias("added"))
    return found.join(added, "place", "left").select("lens", "found", F.coalesce("added", F.lit(0)).alias("added"))


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Sizes of A, B, both and either, in one shuffle, and what B adds to A."""
    both = a.select(key, F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(
        b.select(key, F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    per = both.where(F.col(key).isNotNull()).groupBy(key).agg(F.max("in_a").alias("a"), F.max("in_b").alias("b"))
    return per.agg(F.sum("a").alias("size_a"), F.sum("b").alias("size_b"),
                   F.sum(F.col("a") * F.col("b")).alias("both"), F.count(F.lit(1)).alias("either")) \
              .withColumn("gain", F.col("either") - F.col("size_a"))


def known_vs_new(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Each distinct key with whether it was known."""
    seen = known.select(key).distinct().withColumn("_seen", F.lit(True))
    return df.select(key).distinct().join(seen, key, "left") \
             .select(key, F.when(F.col("_seen"), "known").otherwise("new").alias("status"))


# --- similarity ------------------------------------------------------------------------

def lookalike(vectors: DataFrame, seeds: DataFrame, id_col: str, vector: str, k: int,
              cuts: Sequence[tuple[float, str]] = ((0.6, "A"), (0.3, "B")), countries: Sequence[str] = (),
              headcount: tuple[int, int] | None = None) -> DataFrame:
    """The ``k`` rows most like the centroid of the seeds, seeds left out, of the given
    ``countries`` (column country) and ``headcount`` range (column headcount).

    The centroid has one number per dimension and enters the scan as a scalar subquery, so
    vectors are scored in place and only the best ``k`` per task travel.
    """
    chosen = vectors.join(seeds.select(id_col).distinct(), id_col, "left_semi")
    per_dim = chosen.select(F.posexplode(vector).alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    centroid = per_dim.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "m"))), lambda e: e["m"]).alias("c"))
    others = vectors.join(seeds.select(id_col).distinct(), id_col, "left_anti")
    if countries:
        others = others.where(F.col("country").isin(*countries))
    if headcount:
        others = others.where(F.col("headcount").between(*headcount))
    others = others.withColumn("_c", centroid.scalar())

    def dot(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    v, c = F.col(vector), F.col("_c")
    scored = others.withColumn("score", dot(v, c) / F.sqrt(dot(v, v) * dot(c, c))).drop("_c")
    relevance = F.lit("C")
    for lowest, label in reversed(list(cuts)):
        relevance = F.when(F.col("score") >= lowest, label).otherwise(relevance)
    return scored.orderBy(F.desc("score"), F.asc(id_col)).limit(k).withColumn("relevance", relevance)
