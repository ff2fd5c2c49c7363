"""Job postings as buying signals: normalize, prefilter, dedupe, review."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions import keys, text
from leadgrid.operators.grouping import best_k_per_key, computed_once, first_seen
from leadgrid.session import written

# Queue order of the review priorities; anything else comes last.
PRIORITY_ORDER = {"high": 0, "medium": 1, "review": 2, "low": 3}
PRIORITY_LAST = 9


@dataclass(frozen=True)
class SignalRules:
    """Vocabularies and limits of one posting workflow."""

    workspace: str
    source: str
    positive: Sequence[str]
    negative: Sequence[str]
    hidden: Sequence[str] = ()
    locations: Sequence[tuple[str, str]] = ()
    targets: Sequence[str] = ()
    markets: Sequence[tuple[str, str]] = ()
    selling_abroad: Sequence[str] = ()
    recruiter_names: Sequence[str] = ()
    recruiter_patterns: Sequence[str] = ()
    home_countries: Sequence[str] = ()
    fragment_score: Callable[[Column], Column] | None = None
    excerpt_chars: int = 6000
    evidence_limit: int = 12


def prefilter(body: Column, positive: Sequence[str], negative: Sequence[str], shown: int = 8) -> Column:
    """Review priority and its reasons; never a decision about fit.

    Two positive terms are high, one is medium, else any negative is low, else review.
    """
    n_good, n_bad = text.term_count(body, positive), text.term_count(body, negative)
    priority = F.when(n_good >= 2, "high").when(n_good == 1, "medium") \
                .when(n_bad > 0, "low").otherwise("review")
    reasons = F.concat(F.slice(text.matched_terms(body, positive, prefix="positive:"), 1, shown),
                       F.slice(text.matched_terms(body, negative, prefix="negative:"), 1, shown))
    return F.struct(priority.alias("priority"), reasons.alias("reasons"))


def _pick(df: DataFrame, *names: str) -> Column:
    """First non-blank of the raw fields that the source has."""
    found = [text.blank_to_null(F.col(n).cast("string")) for n in names if n in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def _as_text(df: DataFrame, *names: str) -> DataFrame:
    """The named columns as JSON text where they are objects."""
    kinds = dict(df.dtypes)
    return df.withColumns({n: F.to_json(n) for n in names if kinds.get(n, "").startswith(("struct", "map"))})


def normalize_job(df: DataFrame, rules: SignalRules) -> DataFrame:
    """Raw provider postings to signal rows, one projection after another, no shuffle.

    ``raw_payload`` keeps the posting as it came, as JSON.
    """
    payload = F.to_json(F.struct(*[c for c in df.columns if c != "arrival"]))
    df = _as_text(df.withColumn("_payload", payload), "companyAddress")
    body = [text.strip_space(F.col(n)) for n in ("descriptionText", "description", "jobDescription") if n in df.columns]
    industries = F.lit(None).cast("string")
    if "industries" in df.columns:
        industries = F.array_join("industries", ", ") if dict(df.dtypes)["industries"].startswith("array") \
            else F.col("industries")
    raw = df.select(
        _pick(df, "id", "jobId").alias("_id"),
        _pick(df, "link", "url", "jobUrl").alias("job_url"),
        _pick(df, "title", "jobTitle").alias("role_title"),
        _pick(df, "companyName", "company").alias("company_name"),
        F.coalesce(*[F.nullif(b, F.lit("")) for b in body]).alias("description_text"),
        _pick(df, "companyWebsite").alias("company_website"),
        _pick(df, "companyLinkedinUrl").alias("company_linkedin_url"),
        _pick(df, "companyLogo").alias("company_logo_url"),
        _pick(df, "companyDescription").alias("company_description"),
        _pick(df, "companyEmployeesCount").alias("_employees"),
        _pick(df, "companyAddress").alias("_address"),
        text.blank_to_null(industries).alias("company_industries"),
        _pick(df, "jobFunction").alias("job_function"),
        _pick(df, "seniorityLevel").alias("seniority"),
        _pick(df, "employmentType").alias("employment_type"),
        _pick(df, "location").alias("location"),
        keys.normalize_timestamp(_pick(df, "postedAt")).alias("posted_at"),
        "_payload", *([F.col("arrival")] if "arrival" in df.columns else []))
    title, body_text = F.coalesce("role_title", F.lit("")), F.coalesce("description_text", F.lit(""))
    whole = text.normalize_space(F.concat_ws(" ", title, body_text))
    flat = text.normalize_space(body_text)
    judged = computed_once(raw, "_pre", prefilter(whole, rules.positive, rules.negative)).withColumns({
        "_warn": text.source_warnings(body_text, rules.hidden),
        "_evidence": text.extract_evidence(body_text, rules.positive, rules.evidence_limit)})
    hidden = F.size("_warn") > 0
    return judged.select(
        F.lit(rules.workspace).alias("workspace"), F.lit(rules.source).alias("source"),
        keys.surrogate_id(F.col("_id"), F.col("job_url"), title, F.col("company_name"), body_text).alias("source_job_id"),
        "job_url", "role_title", "job_function", "seniority", "employment_type", "location",
        (text.pattern_label(F.lower(flat), rules.locations) if rules.locations else F.lit(None).cast("string"))
        .alias("job_location_requirement"),
        "posted_at", "description_text", keys.content_hash(body_text).alias("description_hash"),
        text.excerpt(title, F.col("company_name"), body_text, F.col("_evidence"), rules.excerpt_chars)
        .alias("analysis_excerpt"),
        "company_name", keys.domain_from_website(F.col("company_website")).alias("company_domain"),
        "company_website", "company_linkedin_url", "company_logo_url",
        keys.safe_int(F.col("_employees")).alias("company_employee_count"), "company_industries",
        keys.country_code_from_address(F.col("_address")).alias("company_address_country_code"),
        F.lit(None).cast("string").alias("company_hq_country"), F.lit("unreviewed").alias("company_region_fit"),
        F.when(hidden, "low").otherwise(F.col("_pre.priority")).alias("prefilter_priority"),
        F.concat("_pre.reasons", "_warn").alias("prefilter_reasons"),
        F.lit("unreviewed").alias("fit"), F.lit("unreviewed").alias("signal_fit"),
        F.lit("unreviewed").alias("account_fit"), F.lit("unknown").alias("prospecting_scope"),
        F.array().cast("array<string>").alias("prospecting_markets"),
        F.array().cast("array<string>").alias("outbound_motions"),
        F.when(hidden, "hidden").otherwise("unreviewed").alias("employer_confidence"),
        F.when(hidden, "hold").otherwise("review").alias("campaign_action"),
        F.lit(True).alias("needs_human_review"), F.lit("not_started").alias("copy_status"),
        F.lit(None).cast("string").alias("email_subject"), F.lit(None).cast("string").alias("email_1_body"),
        F.lit(None).cast("string").alias("email_2_body"), F.lit("ready_for_analysis").alias("pipeline_status"),
        "company_description", F.col("_payload").alias("raw_payload"), *(["arrival"] if "arrival" in df.columns else []))


def dedupe_richest(df: DataFrame, keys_: Sequence[str], text_col: str, arrival: str) -> DataFrame:
    """Per key the row with the longest text; the first one to arrive wins a tie."""
    rest = [c for c in df.columns if c not in keys_]
    order = F.struct(F.length(F.coalesce(text_col, F.lit(""))), -F.col(arrival))
    return df.groupBy(*keys_).agg(F.max_by(F.struct(*rest), order).alias("_best")) \
             .select(*keys_, "_best.*").select(*df.columns)


def is_clean_high(priority: Column, reasons: Column) -> Column:
    """High priority without any negative reason."""
    return (priority == "high") & ~F.contains(F.concat_ws("\n", F.lit(""), reasons), F.lit("\nnegative:"))


def pipeline_status(fit: Column, signal: Column, account: Column, region: Column, employer: Column,
                    action: Column, review: Column, home_region: str = "home",
                    foreign_region: str = "foreign") -> Column:
    """Gate over six dimensions; exclusions first, then the signal, then the legacy fit."""
    good = ["high", "medium"]
    out = (action == "exclude") | (signal == "no_signal") | (account == "no_fit") | (region == foreign_region)
    contactable = (action == "contact") & account.isin(*good) & (region == home_region) \
        & employer.isin("verified", "likely") & ~review
    legacy = F.when(~fit.isin(*good), "not_fit").when(review, "qualified").otherwise("ready_for_contact")
    return F.when(out, "not_fit") \
            .when(signal.isin(*good), F.when(contactable, "ready_for_contact").otherwise("qualified")) \
            .otherwise(legacy)


def freshness(df: DataFrame, time_col: str, as_of: Column, seconds: int) -> DataFrame:
    """Rows of the last ``seconds`` before ``as_of``; the bound is pushed to the scan."""
    return df.where((F.col(time_col) >= as_of - F.make_dt_interval(secs=F.lit(seconds)))
                    & (F.col(time_col) <= as_of))


def top_fragments(col: Column, score: Callable[[Column], Column], limit: int = 3) -> Column:
    """Best distinct fragments of one text by score; the earlier one wins a tie.

    ``score`` gets the fragment in lower case. Texts stay in their row: no shuffle.
    """
    return best_fragments(text.split_fragments(col), score, limit)


def best_fragments(fragments: Column, score: Callable[[Column], Column], limit: int) -> Column:
    """The same over fragments that are split already."""
    scored = F.transform(fragments, lambda x, i: F.struct(
        text.let(F.lower(x), lambda low: -score(low)).alias("s"), i.alias("i"), x.alias("x")))
    ranked = F.transform(F.sort_array(scored), lambda e: e["x"])
    return F.slice(text.distinct_folded(ranked), 1, limit)


def review_queue(df: DataFrame, n: int) -> DataFrame:
    """Next ``n`` postings to review: by priority, then oldest first."""
    order = F.lit(PRIORITY_LAST)
    for label, rank in PRIORITY_ORDER.items():
        order = F.when(F.col("prefilter_priority") == label, rank).otherwise(order)
    return df.orderBy(order, F.coalesce("posted_at", F.lit("")), "source_job_id").limit(n)


def review_packet(df: DataFrame) -> DataFrame:
    """Compact packet per posting with proof that the full source is kept."""
    shown = ["source_job_id", "job_url", "role_title", "company_name", "company_domain", "company_website",
             "company_linkedin_url", "company_employee_count", "company_industries",
             "company_address_country_code", "company_hq_country", "company_region_fit", "location",
             "job_location_requirement", "posted_at", "prefilter_priority", "prefilter_reasons", "analysis_excerpt"]
    body = F.coalesce("description_text", F.lit(""))
    return df.select(*shown, F.struct(
        F.length(body).alias("description_chars"),
        F.coalesce("description_hash", keys.content_hash(body)).alias("description_hash"),
        F.lit(True).alias("full_source_retained")).alias("source_integrity"))


def prefilter_distribution(df: DataFrame) -> DataFrame:
    """Postings per priority, with how many have text, domain and employer logo."""
    return df.groupBy("prefilter_priority").agg(
        F.count(F.lit(1)).alias("postings"), F.count("description_text").alias("with_text"),
        F.count("company_domain").alias("with_domain"), F.count("company_logo_url").alias("with_logo"))


# --- one review row per company ----------------------------------------------

def company_review_key(name: Column, domain: Column, linkedin: Column, job: Column) -> Column:
    """Company name, else domain, else LinkedIn, else the posting itself."""
    def part(prefix: str, col: Column) -> Column:
        return F.concat(F.lit(prefix), F.nullif(text.normalize_text(col), F.lit("")))
    return F.coalesce(part("name:", name), part("domain:", domain), part("linkedin:", linkedin), part("job:", job))


def review_members(df: DataFrame) -> DataFrame:
    """Every posting behind a review row: its title, place, url, id and hash.

    Kept as rows, since one company may own a third of all postings and its lists would
    not fit one cell; ordered by ``posted_at`` descending, then arrival.
    """
    clean = df.where(is_clean_high(F.col("prefilter_priority"), F.col("prefilter_reasons")))
    return clean.select(_company_key().alias("company_key"), "posted_at", "arrival", "role_title", "location",
                        "job_url", "source_job_id", "description_hash")


def _company_key() -> Column:
    return company_review_key(*[F.col(c) for c in ("company_name", "company_domain", "company_linkedin_url", "source_job_id")])


def company_review(df: DataFrame, rules: SignalRules) -> DataFrame:
    """One row per company over its clean high-priority postings.

    Each posting is decoded and split once and becomes a narrow row, which is stored: no text is
    read or shuffled again. Everything else is an aggregate of bounded size: counts, flags, the
    longest posting, the four best briefs and three target quotes (distinct first, then best k
    per key). The unbounded lists are ``review_members``.
    """
    rows = written(_review_rows(df, rules), "review-rows")
    newest_first = F.struct(F.col("_posted"), -F.col("arrival"))
    grouped = rows.groupBy("company_key").agg(
        F.max_by(F.struct(*REVIEW_SHOWN), F.struct("_chars", F.col("_posted"), -F.col("arrival"))).alias("_primary"),
        F.count(F.lit(1)).alias("job_count"), F.max("_posted").alias("latest_posted_at"),
        F.sum("_chars").alias("description_chars_total"),
        F.substring(F.max_by("_about", F.struct(F.length("_about"), newest_first)), 1, 1200).alias("company_description"),
        F.max("_abroad").alias("flag_selling_abroad"), F.max("_hidden").alias("flag_hidden_employer"),
        F.max("_recruiter").alias("_recruiter"),
        *[F.max(F.array_contains("_markets", label)).alias(f"_m_{i}") for i, (label, _) in enumerate(rules.markets)],
        *[F.max(F.array_contains("prefilter_reasons", f"positive:{t}")).alias(f"_t_{i}") for i, t in enumerate(rules.positive)])
    markets = F.array_compact(F.array(*[F.when(F.col(f"_m_{i}"), F.lit(label))
                                        for i, (label, _) in enumerate(rules.markets)]))
    # Sorted here, where the vocabulary is known: by folded spelling.
    by_name = sorted(enumerate(rules.positive), key=lambda e: e[1].casefold())
    found = F.array_compact(F.array(*[F.when(F.col(f"_t_{i}"), F.lit(t)) for i, t in by_name]))
    country = F.upper(text.normalize_space(F.col("_primary.company_address_country_code")))
    industry = F.lower(F.coalesce("_primary.company_industries", F.lit("")))
    away = (country != "") & ~country.isin(*rules.home_countries or [""])
    base = grouped.select(
        "company_key", "_primary.*", "job_count", "latest_posted_at", "description_chars_total",
        "company_description", "flag_selling_abroad",
        F.array_join(markets, ", ").alias("market_mentions"),
        F.array_join(found, ", ").alias("outbound_terms"), "flag_hidden_employer",
        (F.col("_recruiter") | text.any_term(F.col("_primary.company_name"), rules.recruiter_names)
         | industry.contains("staffing") | industry.contains("recruit")).alias("flag_recruiter"),
        (away & (country != UNREADABLE_COUNTRY)).alias("flag_foreign_source"),
        F.col("_primary.company_domain").isNull().alias("flag_missing_domain"),
        F.when(away, country).alias("_country"))
    base = base.withColumn("automatic_warnings", F.concat_ws(
        " | ",
        F.when(F.col("flag_selling_abroad"), "may sell abroad; check where the company is based"),
        F.when(F.col("flag_hidden_employer"), "employer may be hidden"),
        F.when(F.col("flag_recruiter"), "recruiter or recruiting source; confirm the employer"),
        F.when(F.col("_country") == UNREADABLE_COUNTRY, "country code of the source cannot be read; headquarters unverified"),
        F.when(F.col("flag_foreign_source"), F.concat(
            F.lit("source names country "), F.col("_country"), F.lit("; headquarters unverified"))),
        F.when(F.col("flag_missing_domain"), "domain missing"),
        F.when(F.col("job_count") > 1, F.concat("job_count", F.lit(" postings merged; check differences"))))).drop("_country")
    lines = rows.where(F.col("_brief").isNotNull())
    briefs = _joined_best(lines, text.normalize_text(F.col("_brief")), "_brief", 4, "\n\n", 5000, "description_brief", F.lit(0))
    quotes = rows.select("company_key", "_posted", "arrival", F.posexplode("_targets").alias("_pos", "fragment"))
    targets = _joined_best(quotes, F.lower("fragment"), "fragment", 3, "\n", 2200, "target_evidence", F.col("_pos"))
    return base.join(briefs, "company_key", "left").join(targets, "company_key", "left")


REVIEW_SHOWN = ["company_name", "company_domain", "company_website", "company_linkedin_url", "company_logo_url",
                "company_employee_count", "company_industries", "company_address_country_code", "source_job_id"]
# Fixed value: the code that a source gives when it has no country.
UNREADABLE_COUNTRY = "OO"


def _review_rows(df: DataFrame, rules: SignalRules) -> DataFrame:
    """Narrow rows of the clean postings: flags, the "title: best fragments" brief, and the first
    three distinct fragments that name a target customer (a company shows no more)."""
    body = F.coalesce("description_text", F.lit(""))
    clean = df.where(is_clean_high(F.col("prefilter_priority"), F.col("prefilter_reasons"))) \
              .withColumn("company_key", _company_key()) \
              .withColumn("_decoded", text.decode_entities(body))
    split = computed_once(clean, "_frags", text.split_fragments(F.col("_decoded"), decode=lambda c: c)) \
        .withColumn("_flat", text.normalize_text(F.col("_decoded")))
    best = best_fragments(F.col("_frags"), rules.fragment_score or F.length, 3)
    targets = F.filter("_frags", lambda x: text.let(F.lower(x), lambda low: text.any_term(low, rules.targets, folded=True)))
    return split.withColumn("_best", best).select(
        "company_key", *REVIEW_SHOWN, "arrival", "prefilter_reasons",
        F.coalesce("posted_at", F.lit("")).alias("_posted"), F.length(body).alias("_chars"),
        text.normalize_space(F.col("company_description")).alias("_about"),
        text.any_pattern(F.col("_flat"), rules.selling_abroad or ["$^"]).alias("_abroad"),
        text.any_term(F.col("_flat"), rules.hidden).alias("_hidden"),
        text.any_pattern(F.col("_flat"), rules.recruiter_patterns or ["$^"]).alias("_recruiter"),
        text.pattern_labels(F.col("_flat"), rules.markets).alias("_markets"),
        F.when(F.size("_best") > 0, F.concat(F.coalesce(F.nullif(text.normalize_space(F.col("role_title")), F.lit("")),
                                                        F.lit("untitled")),
                                             F.lit(": "), F.array_join("_best", " | "))).alias("_brief"),
        F.slice(text.distinct_folded(targets), 1, 3).alias("_targets"))


def _joined_best(rows: DataFrame, key: Column, value: str, k: int, glue: str, longest: int,
                 out: str, position: Column) -> DataFrame:
    """Distinct values per company, the first k in reading order, joined to one string."""
    place = F.struct("_posted", -F.col("arrival"), -position)
    firsts = rows.groupBy("company_key", key.alias("_k")).agg(
        F.max(place).alias("_at"), F.max_by(value, place).alias("_v"))
    top = best_k_per_key(firsts, ["company_key"], [F.desc("_at"), F.asc("_k")], k, rank_as="_n")
    # At most k entries per company are collected.
    return top.groupBy("company_key").agg(F.sort_array(F.collect_list(F.struct("_n", "_v"))).alias("_all")) \
        .select("company_key", F.substring(F.array_join(F.transform("_all", lambda e: e["_v"]), glue), 1, longest).alias(out))


# --- dictionaries and grids --------------------------------------------------

# Letters, digits and underscores make a word.
WORD = r"[\p{L}\p{N}_]+"


def folded_words(col: Column) -> Column:
    """Words of a text in lower case: runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(WORD), F.lit(0))


# Words of a phrase's beginning that are hashed: the most of these that it has.
PREFIXES = (2, 4, 8)


def prefix_hash(words: Column, at: Column, size: int) -> Column:
    """Hash of the ``size`` words from a place on; words behind the end are passed over."""
    return F.xxhash64(*[F.get(words, at + i) for i in range(size)])


def term_join(texts: DataFrame, id_col: str, text_col: str, terms: DataFrame, term_col: str,
              broadcast_bytes: int = 16 << 20) -> DataFrame:
    """One (id, term) row for every dictionary term whose words stand in a text one after the other.

    Single words meet the distinct words of each text in an equi-join. A phrase is filed under the hash of its first two words and that of its first two, four or
    eight, as many as it has. A text has these hashes at each place; places meet phrases by the first, with the
    other as a condition, so that a few numbers are exchanged for a place, however long the phrases
    are. What met is compared word by word with the text, read again by its id. Phrases of at most
    ``broadcast_bytes`` are sent to every task instead, and nothing is exchanged for a place.
    Terms without a word match nothing; terms that differ in case or punctuation only are one.
    """
    words = terms.select(folded_words(F.col(term_col)).alias("_w")).where(F.size("_w") > 0).distinct()
    # Written, so that its size is known when the joins are planned, and its words are extracted once.
    dictionary = written(words.select(F.array_join("_w", " ").alias("term"), "_w", F.size("_w").alias("_n")), "terms")
    flat = texts.select(F.col(id_col), folded_words(F.col(text_col)).alias("_w"))
    single = flat.select(id_col, F.explode(F.array_distinct("_w")).alias("term")) \
                 .join(dictionary.where("_n = 1").select("term"), "term").select(id_col, "term")

    def of_length(pick) -> Column:
        """``pick`` of the longest prefix that a phrase of ``_n`` words has."""
        return F.coalesce(*[F.when(F.col("_n") >= size, pick(size)) for size in reversed(PREFIXES)])

    heads = dictionary.where("_n > 1").select("term", "_n", prefix_hash(F.col("_w"), F.lit(0), 2).alias("_start"),
                                              of_length(lambda size: prefix_hash(F.col("_w"), F.lit(0), size)).alias("_head"))
    at_word = flat.select(id_col, "_w", F.posexplode("_w").alias("_at", "_word"))

    def spelled(at: Column, n: Column) -> Column:
        return F.array_join(F.slice("_w", at + 1, n), " ")

    size = dictionary.agg(F.sum(F.octet_length("term") + 32)).first()[0] or 0
    if size <= broadcast_bytes:
        # Every task has the whole dictionary: nothing is exchanged, and words are compared where they are.
        here = at_word.withColumn("_h2", prefix_hash(F.col("_w"), F.col("_at"), 2))
        found = here.join(F.broadcast(heads), (F.col("_h2") == F.col("_start")) & (spelled(F.col("_at"), F.col("_n")) == F.col("term")))
        return single.unionByName(found.select(id_col, "term").distinct())
    places = at_word.select(id_col, "_at", *[prefix_hash(F.col("_w"), F.col("_at"), n).alias(f"_h{n}") for n in PREFIXES])
    met = places.join(heads, (F.col("_h2") == F.col("_start")) & (of_length(lambda n: F.col(f"_h{n}")) == F.col("_head")))
    # The places of a text that met a phrase are few beside its words.
    found = met.groupBy(F.col(id_col).alias("_id")).agg(F.collect_set(F.struct("_at", "_n", "term")).alias("_met"))
    read = texts.select(id_col, text_col).join(found, F.col(id_col).eqNullSafe(F.col("_id"))) \
                .select(id_col, folded_words(F.col(text_col)).alias("_w"), "_met")
    same = F.filter("_met", lambda m: spelled(m["_at"], m["_n"]) == m["term"])
    phrases = read.select(id_col, F.explode(F.array_distinct(F.transform(same, lambda m: m["term"]))).alias("term"))
    return single.unionByName(phrases.distinct())


def search_grid(places: DataFrame, place_col: str, keywords: Sequence[str], seconds: int,
                base: str = "https://jobs.example/search") -> DataFrame:
    """One encoded search address per place and keyword; no join, each row is expanded."""
    unique = list({k.strip().lower(): k.strip() for k in reversed(list(keywords)) if k.strip()}.values())[::-1]
    rows = places.select(place_col, F.explode(F.array(*[F.lit(k) for k in unique])).alias("keyword"))
    return rows.withColumn("url", F.concat(
        F.lit(base + "?keywords="), F.url_encode("keyword"), F.lit("&location="), F.url_encode(place_col),
        F.lit(f"&f_TPR=r{seconds}")))


def ordered_distinct(df: DataFrame, keys_: Sequence[str], value: str, order: str, out: str) -> DataFrame:
    """Distinct values of a small vocabulary per key, in order of first appearance.

    Repeats are removed before anything is gathered. For values without a small vocabulary
    use ``first_seen``, which keeps them as rows.
    """
    firsts = first_seen(df, keys_, value, order)
    return firsts.groupBy(*keys_).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("first_at", value))), lambda e: e[value]).alias(out))


# --- runs and cost -----------------------------------------------------------

def cost_estimate(rows: Column, unit_price: Column, budget: Column) -> Column:
    """Estimated cost with four decimals, and whether it must be refused."""
    cost = F.round(rows.cast("decimal(20,0)") * unit_price.cast("decimal(12,6)"), 4).cast("double")
    return F.struct(cost.alias("estimated_cost"), (cost > budget).alias("over_budget"))


def run_ledger(df: DataFrame, run_id: str, keyword_count: int, job_key: Sequence[str],
               unit_price: float, config: str, actual_cost: float | None = None,
               status: str = "succeeded") -> DataFrame:
    """One row describing a load: how much came in, how much was new, what it cost."""
    return df.agg(F.count(F.lit(1)).alias("harvested_count"),
                  F.count_distinct(*[F.col(k) for k in job_key]).alias("unique_count")).select(
        F.lit(run_id).alias("run_id"), F.lit(status).alias("status"),
        F.lit(keyword_count).alias("keyword_count"), "harvested_count", "unique_count",
        cost_estimate(F.col("harvested_count"), F.lit(unit_price), F.lit(0.0))["estimated_cost"].alias("estimated_cost"),
        F.lit(actual_cost).cast("double").alias("actual_cost"), F.lit(config).alias("config_snapshot"))
