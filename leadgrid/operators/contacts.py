"""People: search, rank, choose, cap, deduplicate, suppress, enrich."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.bands import is_true, seniority_alias
from leadgrid.functions.keys import email_domain
from leadgrid.functions.text import any_term, blank_to_null, normalize_text
from leadgrid.operators.grouping import best_k_per_key, best_per_key, lookup_join
from leadgrid.operators.rules import persona_titles
from leadgrid.session import cut_lineage

SMALL_COMPANY = 20


def title_rank(title: Column, small: Column, small_buyers: Sequence[str], sales_leaders: Sequence[str],
               sales_words: Sequence[str]) -> Column:
    """100 for the primary buyer, 70 for the other buyer, 30 for a sales word, else 0.

    Small companies are bought for by their owner, others by the head of sales.
    """
    folded = normalize_text(title)
    owner, leader = any_term(folded, small_buyers, True), any_term(folded, sales_leaders, True)
    small = is_true(small)
    return F.when(folded == "", 0).when((small & owner) | (~small & leader), 100) \
            .when((small & leader) | (~small & owner), 70) \
            .when(any_term(folded, sales_words, True), 30).otherwise(0)


def contact_candidates(contacts: DataFrame, as_of: Column, recontact_days: int,
                       verified: Sequence[str]) -> DataFrame:
    """People who may be written to now, with their channel.

    A verified address gives ``email``; else a LinkedIn page gives ``linkedin``. Contact
    exactly ``recontact_days`` ago is allowed again.
    """
    cutoff = as_of - F.make_dt_interval(F.lit(recontact_days))
    recent = is_true(F.col("last_contacted_at") > cutoff)
    by_mail = blank_to_null(F.col("email")).isNotNull() & normalize_text(F.col("email_status")).isin(
        *[v.lower() for v in verified])
    channel = F.when(by_mail, "email").when(blank_to_null(F.col("linkedin_url")).isNotNull(), "linkedin")
    return contacts.where(~is_true(F.col("do_not_contact")) & ~recent) \
                   .withColumn("channel", channel).where(F.col("channel").isNotNull())


def choose_contact(candidates: DataFrame, key: Sequence[str], rank: Column, arrival: str) -> DataFrame:
    """One person per key: mail beats LinkedIn, then title rank, then first to arrive."""
    return best_per_key(candidates.withColumn("title_rank", rank), key,
                        [F.asc("channel"), F.desc("title_rank"), F.asc(arrival)])


def match_contacts(signals: DataFrame, companies: DataFrame, contacts: DataFrame, as_of: Column,
                   recontact_days: int, verified: Sequence[str], ranks: Mapping[str, Sequence[str]],
                   signal_id: str = "source_job_id") -> DataFrame:
    """Signal to company by domain to the best person.

    The choice depends on the signal only through the small-company flag, so the best person
    is picked once per (company, flag) and then joined: signals are never multiplied by the
    people of a company. A head count of zero falls through to the company's.
    """
    firms = best_per_key(companies.select("id", "domain", "employee_count", "do_not_contact"), ["domain"], [F.asc("id")]) \
        .select(F.col("id").alias("company_id"), F.col("domain").alias("company_domain"),
                F.col("employee_count").alias("_firm_count"), is_true(F.col("do_not_contact")).alias("_blocked"))
    people = contact_candidates(contacts, as_of, recontact_days, verified)
    best = None
    for small in (True, False):
        rank = title_rank(F.col("title"), F.lit(small), ranks["small"], ranks["leaders"], ranks["words"])
        chosen = choose_contact(people, ["company_id"], rank, "id").select(
            "company_id", F.lit(small).alias("_small"), F.col("id").alias("contact_id"),
            F.col("channel").alias("contact_channel"), F.col("email_status").alias("contact_email_status"))
        best = chosen if best is None else best.unionByName(chosen)
    employees = F.coalesce(F.nullif("company_employee_count", F.lit(0)), F.col("_firm_count"))
    placed = lookup_join(signals, firms, ["company_domain"], signal_id) \
        .withColumn("company_id", F.when(~is_true(F.col("_blocked")), F.col("company_id"))) \
        .withColumn("_small", is_true(employees <= SMALL_COMPANY))
    out = lookup_join(placed, best, ["company_id", "_small"], signal_id)
    hint = F.when(F.col("company_id").isNotNull(),
                  F.when(F.col("_small"), "founder_or_ceo").otherwise("sales_leader"))
    return out.withColumn("buyer_role_hint", hint) \
        .withColumn("outcome", F.coalesce("contact_channel", F.lit("unmatched"))) \
        .withColumn("pipeline_status", F.when(F.col("contact_id").isNotNull(), "ready_for_copy")
                    .otherwise("ready_for_contact")) \
        .drop("_firm_count", "_blocked", "_small")


def match_outcomes(matched: DataFrame) -> DataFrame:
    """How many signals found a person, by channel."""
    return matched.agg(F.count(F.lit(1)).alias("signals"), *[
        F.count_if(F.col("outcome") == o).alias(o) for o in ("email", "linkedin", "unmatched")])


def cap_per_company(df: DataFrame, key: str, order: Sequence[Column], k: int) -> DataFrame:
    """At most ``k`` people per company; the limit is applied before the shuffle too."""
    return best_k_per_key(df, [key], order, k)


def dedupe_either_key(df: DataFrame, order: str, keys: Sequence[str]) -> DataFrame:
    """Drop a row when any of its keys was seen on an earlier *kept* row.

    A dropped row registers nothing, so the outcome is the sequential one; it is reached in rounds
    instead of one pass in order. Per round, a row that no earlier undecided row shares a key with
    is kept. A row with exactly one such row gets the opposite of that row's decision: chains of these
    are settled by pointer doubling, so a chain of n rows takes about log2(n) steps. Rows that
    share a key with a kept row are dropped. Rows without keys stay. Each round decides at least the
    earliest undecided row and, on real data, nearly all of them. ``order`` must be unique.

    Hot keys: equal key sets collapse to their first row with a map-side minimum, the first two rows
    per key come from a group limit before the exchange, kept keys are unique on their side of
    each join, and the joins are semi and anti joins, whose large side adaptive execution may split.
    """
    blank_safe = {k: F.nullif(F.col(k), F.lit("")) for k in keys}
    narrow = df.select(order, *[blank_safe[k].alias(f"_k{i}") for i, k in enumerate(keys)])
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = F.coalesce(*names).isNotNull()
    kept = narrow.where(~keyed).select(order)
    undecided = cut_lineage(narrow.where(keyed).groupBy(*names).agg(F.min(order).alias(order)))
    while not undecided.isEmpty():
        winners = undecided.join(_settled(undecided, order, names), order, "left_semi")
        kept = kept.unionByName(winners.select(order))
        rest = undecided
        for name in names:
            rest = rest.join(winners.where(F.col(name).isNotNull()).select(name), name, "left_anti")
        undecided = cut_lineage(rest.select(order, *names))
    return df.join(kept, order, "left_semi")


def _settled(undecided: DataFrame, order: str, names: Sequence[str]) -> DataFrame:
    """``order`` of the rows that are kept for sure: those that nothing blocks, and every second row of the chains
    that start at one."""
    tops = None
    for name in names:
        pair = best_k_per_key(undecided.where(F.col(name).isNotNull()).select(name, order), [name], [F.col(order)], 2) \
            .groupBy(name).agg(F.min(order).alias("_first"), F.max(order).alias("_second"))
        rows = pair.select(F.explode(F.array(
            F.struct(F.col("_first").alias(order), F.when(F.lit(False), F.col("_first")).alias("_by")),
            F.struct(F.when(F.col("_second") != F.col("_first"), F.col("_second")).alias(order), F.col("_first").alias("_by")))).alias("_r")) \
            .select("_r.*").where(F.col(order).isNotNull())
        tops = rows if tops is None else tops.unionByName(rows)
    # A row among the first two of each of its keys is blocked by the rows named and no others.
    own = sum(F.col(n).isNotNull().cast("int") for n in names)
    blocked = tops.groupBy(order).agg(F.count(F.lit(1)).alias("_seen"), F.min("_by").alias("_to"), F.max("_by").alias("_last"))
    simple = undecided.join(blocked, order).where((F.col("_seen") == own) & F.col("_to").eqNullSafe(F.col("_last")))
    # ``_flip`` is true where a row's decision is the opposite of that of the row it points to.
    links = cut_lineage(simple.select(order, "_to", F.col("_to").isNotNull().alias("_flip")))
    while True:
        ahead = links.where("_to IS NOT NULL").select(F.col(order).alias("_at"), F.col("_to").alias("_next"), F.col("_flip").alias("_turn"))
        if links.join(ahead, F.col("_to") == F.col("_at"), "left_semi").isEmpty():
            break
        joined = links.join(ahead, F.col("_to") == F.col("_at"), "left")
        links = cut_lineage(joined.select(order, F.coalesce("_next", "_to").alias("_to"),
                                          (F.col("_flip") != F.coalesce("_turn", F.lit(False))).alias("_flip")))
    # Where a chain ends at a row that several rows block, it waits for that row.
    roots = links.where("_to IS NULL").select(order)
    ends = links.where("_to IS NOT NULL AND NOT _flip").join(roots.select(F.col(order).alias("_root")), F.col("_to") == F.col("_root"), "left_semi")
    return roots.unionByName(ends.select(order))


def suppress_contacted(leads: DataFrame, sends: DataFrame, key: str, as_of: Column, days: int,
                       time_col: str = "sent_at") -> DataFrame:
    """Leads without a send in the last ``days``; the cut is pushed to the scan of sends."""
    recent = sends.where(F.col(time_col) > as_of - F.make_dt_interval(F.lit(days))).select(key).distinct()
    return leads.join(recent, key, "left_anti")


def pending(target: DataFrame, done: DataFrame, key: Sequence[str]) -> DataFrame:
    """Work not done yet."""
    return target.join(done.select(*key).distinct(), list(key), "left_anti")


def unused_angle(offers: DataFrame, sends: DataFrame, lead: str = "lead", angle: str = "angle") -> DataFrame:
    """Offers whose (lead, angle) was never sent."""
    return pending(offers, sends, [lead, angle])


def merge_personalization(leads: DataFrame, lines: DataFrame, key: str, variants: Sequence[str],
                          slots: Sequence[str]) -> DataFrame:
    """One column per slot and variant, filled from the per-variant lines of a lead."""
    wide = lines.groupBy(key).agg(*[
        F.max(F.when(F.col("variant") == v, F.col(s))).alias(f"{s}_{v}") for v in variants for s in slots])
    return leads.join(wide, key, "left")


def engagers(engagements: DataFrame, insiders: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """People who engaged within ``days``, without those employed by the watched companies,
    one row each, most active first. ``insiders`` holds the watched companies' domains."""
    window = engagements.where((F.col("ts") >= as_of - F.make_dt_interval(F.lit(days))) & (F.col("ts") <= as_of))
    outside = window.join(insiders.select("person_domain").distinct(), "person_domain", "left_anti")
    return outside.groupBy("person", "person_domain").agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct("target").alias("targets"),
        F.max("ts").alias("last_at")).orderBy(F.desc("total"), F.asc("person"))


def _person_keys() -> Column:
    """(place, key) of every way a person can be found, best first; a name needs all its parts."""
    clean = lambda c: F.lower(F.trim(c))
    named = F.when((F.col("first_name") != "") & (F.col("last_name") != ""),
                   F.concat_ws("|", clean("first_name"), clean("last_name")))
    found = [("email", 0, clean("email")), ("linkedin", 1, clean("linkedin_url")),
             ("name", 2, F.concat(named, F.lit("|"), F.col("domain"))),
             ("name", 2, F.concat(named, F.lit("|"), email_domain(F.col("email")))),
             ("phone", 3, F.regexp_replace("phone", r"[^0-9+]", ""))]
    keys = [F.when(key != "", F.struct(F.lit(place).alias("place"), F.concat(F.lit(f"{kind}:"), key).alias("key")))
            for kind, place, key in found]
    return F.array_distinct(F.array_compact(F.array(*keys)))


def enrich_people(requests: DataFrame, people: DataFrame, request_id: str, limit: int = 1) -> DataFrame:
    """Resolve people by e-mail, else LinkedIn, else name at company or e-mail domain, else phone.

    Keys are rows on both sides, so people are read and joined once; a key offers its
    ``limit`` smallest ids at most. Of a request's keys the best kind that answers counts, and
    gives up to ``limit`` people. ``resolved_by`` names it; ``success`` says if any answered.
    """
    book = people.select(F.explode(_person_keys()).alias("_k"), "id").select(F.col("_k.key").alias("_key"), "id").distinct()
    book = best_k_per_key(book, ["_key"], [F.asc("id")], limit)
    asked = requests.select(request_id, F.explode(_person_keys()).alias("_k")).select(request_id, "_k.place", F.col("_k.key").alias("_key"))
    # At most ``limit`` people for each of five keys are gathered.
    hits = asked.join(book, "_key").groupBy(request_id).agg(
        F.min("place").alias("_best"), F.collect_set(F.struct("place", "id")).alias("_all"))
    ids = F.slice(F.sort_array(F.transform(F.filter("_all", lambda h: h["place"] == F.col("_best")), lambda h: h["id"])), 1, limit)
    answers = hits.select(request_id, "_best", F.explode(ids).alias("person_id"))
    by = F.element_at(F.array(*[F.lit(k) for k in ("email", "linkedin", "name", "phone")]), F.col("_best") + 1)
    return requests.join(answers, request_id, "left").withColumn("resolved_by", F.when(F.col("_best").isNotNull(), by)) \
        .withColumn("success", F.col("_best").isNotNull()).drop("_best")


def contact_per_persona(people: DataFrame, company: str, personas: Mapping[str, tuple[Sequence[str], Sequence[str]]],
                        order: Sequence[Column], title: str = "title") -> DataFrame:
    """The best contact of each company for each persona (name: included and excluded title words)."""
    fits = F.array_compact(F.array(*[F.when(persona_titles(F.col(title), include, exclude), F.lit(name))
                                     for name, (include, exclude) in personas.items()]))
    return best_per_key(people.withColumn("persona", F.explode(fits)), [company, "persona"], order)


# --- search -------------------------------------------------------------------

# Filter kinds: how a value is turned into a predicate on the named column(s).
def _substring(col: str, values: Any) -> Column:
    terms = [values] if isinstance(values, str) else list(values)
    return any_term(F.col(col), terms)


def _overlap_min(cols: Sequence[str], value: Any) -> Column:
    return F.coalesce(F.col(cols[1]), F.col(cols[0])) >= value


def _overlap_max(cols: Sequence[str], value: Any) -> Column:
    return F.coalesce(F.col(cols[0]), F.col(cols[1])) <= value


FILTER_KINDS = {
    "substring": _substring,
    "in": lambda col, values: F.col(col).isin(*values),
    "alias": lambda col, values: seniority_alias(F.col(col)).isin(*values),
    "not_in": lambda col, values: ~F.coalesce(F.col(col).isin(*values), F.lit(False)),
    "not_substring": lambda col, values: ~is_true(_substring(col, values)),
    "equals": lambda col, value: F.lower(col) == str(value).lower(),
    "flag": lambda col, value: F.col(col) == bool(value),
    "present": lambda col, value: blank_to_null(F.col(col)).isNotNull() if value else F.lit(True),
    "min": lambda col, value: F.col(col) >= value,
    "max": lambda col, value: F.col(col) <= value,
    "overlap_min": _overlap_min,
    "overlap_max": _overlap_max,
}


def contact_search(df: DataFrame, filters: Mapping[str, Any], fields: Mapping[str, tuple[str, Any]],
                   where: str | None = None, max_per_company: int | None = None,
                   company: str = "domain", order: Sequence[Column] = ()) -> DataFrame:
    """Rows that satisfy every filter.

    ``fields`` declares the filters: name to (kind, column). ``where`` is an extra SQL
    predicate. All of it becomes plain predicates that Spark pushes to the scan.
    """
    unknown = [f for f in filters if f not in fields]
    if unknown:
        raise ValueError(f"unknown filters: {', '.join(unknown)}")
    for name, value in filters.items():
        kind, column = fields[name]
        df = df.where(FILTER_KINDS[kind](column, value))
    if where:
        df = df.where(where)
    return cap_per_company(df, company, order, max_per_company) if max_per_company else df


def decision_makers(df: DataFrame, domain: str, order: Sequence[Column], k: int,
                    require_email: bool = False) -> DataFrame:
    """Senior people per company: level C-Team, VP or Director, or a title with "Head"."""
    senior = seniority_alias(F.col("seniority")).isin("C-Team", "VP", "Director") \
        | F.contains("title", F.lit("Head"))
    df = df.where(senior)
    if require_email:
        df = df.where(blank_to_null(F.col("email")).isNotNull())
    return cap_per_company(df, domain, order, k)


def colleagues(df: DataFrame, domains: Sequence[str], statuses: Sequence[str] | None = ("verified",)) -> DataFrame:
    """People at the given mail domains with the total of each domain."""
    found = df.withColumn("mail_domain", email_domain(F.col("email"))).where(F.col("mail_domain").isin(*domains))
    if statuses:
        found = found.where(F.col("email_status").isin(*statuses))
    # At most one row per requested domain, so the totals are small by construction.
    totals = found.groupBy("mail_domain").agg(F.count(F.lit(1)).alias("total"))
    return found.join(F.broadcast(totals), "mail_domain")


def signal_search(df: DataFrame, since: Column | None = None, min_confidence: float = 0.5,
                  region: str | None = None, name: str | None = None, has_amount: bool = False,
                  min_amount: float | None = None, limit: int | None = None) -> DataFrame:
    """Funding or acquisition facts, newest first; an amount floor implies an amount."""
    df = df.where(F.col("confidence") >= min_confidence)
    if since is not None:
        df = df.where(F.col("announced_at") >= since)
    if region:
        df = df.where(F.col("region") == region)
    if name:
        df = df.where(any_term(F.col("name"), [name]))
    if has_amount or min_amount is not None:
        df = df.where(F.col("amount").isNotNull())
    if min_amount is not None:
        df = df.where(F.col("amount") >= min_amount)
    return df.orderBy(F.desc("announced_at"), F.asc("signal_id")).limit(limit) if limit else df


def include_exclude(df: DataFrame, include: Mapping[str, Sequence[str]], exclude: Mapping[str, Sequence[str]],
                    exact_titles: bool = False, headcount: tuple[int | None, int | None] = (None, None),
                    exported: DataFrame | None = None, key: str = "id") -> DataFrame:
    """Include and exclude lists per field, a head-count range, and no repeat exports."""
    for name, values in include.items():
        hit = F.lower(name).isin(*[v.lower() for v in values])
        df = df.where(hit if name != "title" or exact_titles else any_term(F.col(name), values))
    for name, values in exclude.items():
        df = df.where(~any_term(F.col(name), values) if name == "title"
                      else ~is_true(F.lower(name).isin(*[v.lower() for v in values])))
    low, high = headcount
    if low is not None:
        df = df.where(F.col("headcount") >= low)
    if high is not None:
        df = df.where(F.col("headcount") <= high)
    return df.join(exported.select(key).distinct(), key, "left_anti") if exported is not None else df
