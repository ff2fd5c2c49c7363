"""Sending and replies: sync, state, rates, inboxes, domains, verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrid.functions.bands import is_true, ratio, round_half_up
from leadgrid.functions.keys import email_domain, epoch_micros, send_key
from leadgrid.functions.text import blank_to_null, normalize_space, quote_regex, strip_html
from leadgrid.operators.grouping import best_per_key

# Reply labels that count as positive, and those left out of the net.
POSITIVE_LABELS = ("positive_interested", "positive_soft", "positive_referral")
EXCLUDED_LABELS = ("ooo", "bounce")
# Provider spellings of the two mail directions.
SENT_TYPES, RECEIVED_TYPES = ("sent", "SENT", "1"), ("received", "RECEIVED", "2")
# Flags of the delivery audit.
LOW_REPLY_MIN_SENT, LOW_REPLY_PCT = 200, 1.0
HIGH_BOUNCE_MIN_SENT, HIGH_BOUNCE_PCT = 50, 3.0
FLEET_REPLY_MIN, FLEET_BOUNCE_MAX = 1.0, 2.0
WARMUP_DONE = 30


# --- sync and rendering ----------------------------------------------------------

def _body_text(df: DataFrame) -> Column:
    return F.col("body.text") if dict(df.dtypes)["body"].startswith("struct") else F.col("body")


def sync_events(events: DataFrame, workspace: str) -> tuple[DataFrame, DataFrame]:
    """Provider mail events as (sends, replies). Two projections of one scan; the send key
    is derived from the event, so loading twice changes nothing."""
    kind = F.col("email_type").cast("string")
    when = F.coalesce("timestamp_email", "timestamp_created")
    lead = F.lower(F.coalesce(F.nullif("lead", F.lit("")), "to_address_email_list", F.lit("")))
    sender = F.lower(F.coalesce("from_address_email", F.lit("")))
    step = F.coalesce(F.nullif("step", F.lit(0)), F.lit(1))
    sent = events.where(kind.isin(*SENT_TYPES)).withColumn("_when", when)
    sends = sent.select(
        send_key(F.lit(workspace), lead, F.col("campaign_id"), step, epoch_micros(sent, "_when")).alias("send_id"),
        F.lit(workspace).alias("workspace"), lead.alias("lead_email"), email_domain(lead).alias("lead_domain"),
        "campaign_id", step.alias("sequence_step"), when.alias("sent_at"))
    replies = events.where(kind.isin(*RECEIVED_TYPES)).select(
        F.lit(workspace).alias("workspace"), sender.alias("lead_email"), email_domain(sender).alias("lead_domain"),
        "campaign_id", when.alias("replied_at"), _body_text(events).alias("body"), F.col("id").alias("reply_id"))
    return sends, replies


def campaign_to_angle(sends: DataFrame, campaigns: DataFrame, angles: DataFrame) -> DataFrame:
    """Campaign name and angle of a send from the provider's campaign id."""
    return sends.join(campaigns.select("campaign_id", "campaign_name", "angle_id"), "campaign_id", "left") \
                .join(angles.select("angle_id", "angle_slug"), "angle_id", "left")


def render_template(template: Column, slots: Mapping[str, Column]) -> Column:
    """Fill ``{{slot}}`` placeholders from columns; a null fills as empty."""
    for name, value in slots.items():
        template = F.replace(template, F.lit("{{" + name + "}}"), F.coalesce(value.cast("string"), F.lit("")))
    return template


def clean_subject(subject: Column) -> Column:
    """Long dashes become plain ones."""
    return F.replace(F.replace(subject, F.lit("—"), F.lit(" - ")), F.lit("–"), F.lit(" - "))


def scope_slots(template: Column, slots: Sequence[str], variant: Column, campaign: Column) -> Column:
    """Make slot names unique per variant and campaign."""
    suffix = F.concat(F.lit("_"), F.lower(variant), F.lit("_"), campaign.cast("string"))
    for name in slots:
        template = F.replace(template, F.lit("{{" + name + "}}"), F.concat(F.lit("{{" + name), suffix, F.lit("}}")))
    return template


def split_custom_fields(df: DataFrame, core: Sequence[str]) -> DataFrame:
    """Core columns stay; the other non-empty ones go to a ``custom_fields`` map."""
    extra = [c for c in df.columns if c not in core]
    pairs = [x for c in extra for x in (F.lit(c), F.nullif(F.col(c).cast("string"), F.lit("")))]
    fields = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs \
        else F.create_map().cast("map<string,string>")
    return df.select(*core, fields.alias("custom_fields"))


def slot_fallback(rich: Column, standard: Column, generic: str) -> Column:
    """Never blank: rich, else standard, else generic; with the level that was used."""
    a, b = blank_to_null(rich), blank_to_null(standard)
    return F.struct(F.coalesce(a, b, F.lit(generic)).alias("text"),
                    F.when(a.isNotNull(), "rich").when(b.isNotNull(), "standard").otherwise("generic").alias("level"))


# --- contact state ----------------------------------------------------------------

def last_contact(sends: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Latest send per workspace and lead: one row per key leaves each map task."""
    return best_per_key(sends.select("workspace", "lead_email", "sent_at", "event_id", *columns),
                        ["workspace", "lead_email"], [F.desc("sent_at"), F.desc("event_id")])


def first_inbound(messages: DataFrame, key: str, turn: str, inbound: Column, body: str,
                  longest: int = 5000) -> DataFrame:
    """First inbound message per thread, HTML stripped and cut."""
    first = messages.where(inbound).groupBy(key).agg(
        F.min(turn).alias(turn), F.min_by(body, turn).alias("_body"))
    return first.select(key, turn, strip_html(F.col("_body"), (), longest).alias("reply_body"))


# --- rates -------------------------------------------------------------------------

def reply_label_guard(label: Column, confidence: Column, least: float = 0.7) -> Column:
    """An unsure label counts as ``other``."""
    return F.when(is_true(confidence < least), "other").otherwise(label)


def reply_rates(sends: DataFrame, replies: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Per campaign: label histogram, net replies and the rates on sent and on net."""
    sent = sends.groupBy(key).agg(F.count(F.lit(1)).alias("sent"))
    per_label = replies.groupBy(key, "label").agg(F.count(F.lit(1)).alias("n"))
    # One row per label: the vocabulary bounds what is gathered.
    got = per_label.groupBy(key).agg(
        F.sum("n").alias("total_replies"),
        F.sum(F.when(F.col("label").isin(*EXCLUDED_LABELS), F.col("n")).otherwise(0)).alias("excluded"),
        F.sum(F.when(F.col("label").isin(*POSITIVE_LABELS), F.col("n")).otherwise(0)).alias("positive"),
        F.sum(F.when(F.col("label") == "negative_hostile", F.col("n")).otherwise(0)).alias("hostile"),
        F.sum(F.when(F.col("label") == "unsubscribe", F.col("n")).otherwise(0)).alias("unsubscribed"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "n")))).alias("buckets"))
    out = sent.join(got, key, "full_outer")
    counts = ["sent", "total_replies", "excluded", "positive", "hostile", "unsubscribed"]
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    net = F.col("total_replies") - F.col("excluded")
    return out.withColumns({
        "net_replies": net, "positive_reply_rate": ratio(F.col("positive"), F.col("sent")),
        "positive_share": ratio(F.col("positive"), net), "hostile_rate": ratio(F.col("hostile"), F.col("sent")),
        "unsubscribe_rate": ratio(F.col("unsubscribed"), F.col("sent"))})


def _with_flags(df: DataFrame) -> DataFrame:
    """Rates for show (two decimals) and flags on the exact rates."""
    reply = ratio(F.col("replies"), F.col("sent"), 100.0)
    bounce = ratio(F.col("bounces"), F.col("sent"), 100.0)
    return df.withColumns({
        "reply_rate_pct": round_half_up(reply, 2), "bounce_rate_pct": round_half_up(bounce, 2),
        "flag_low_reply": (F.col("sent") >= LOW_REPLY_MIN_SENT) & (reply < LOW_REPLY_PCT),
        "flag_high_bounce": (F.col("sent") >= HIGH_BOUNCE_MIN_SENT) & (bounce > HIGH_BOUNCE_PCT)})


def _totals(df: DataFrame, *keys: Column | str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("sent", "replies", "bounces")])


def campaign_performance(stats: DataFrame) -> DataFrame:
    """Reply and bounce percent per campaign with flags, largest first."""
    return _with_flags(_totals(stats, "campaign_id")).orderBy(F.desc("sent"), F.asc("campaign_id"))


def inbox_performance(stats: DataFrame, top: int = 50) -> DataFrame:
    """The same per inbox, over the ``top`` campaigns with sends, and which campaigns used it."""
    active = _totals(stats, "campaign_id").where("sent > 0").orderBy(F.desc("sent"), F.asc("campaign_id")).limit(top)
    rows = stats.join(F.broadcast(active.select("campaign_id")), "campaign_id", "left_semi")
    per = rows.groupBy("inbox_id").agg(
        *[F.sum(c).alias(c) for c in ("sent", "replies", "bounces")], F.min("email").alias("email"),
        # At most ``top`` campaigns exist, so the set is small.
        F.array_join(F.sort_array(F.collect_set("campaign_id")), "|").alias("campaigns"))
    return _with_flags(per).withColumn("domain", F.coalesce(email_domain(F.col("email")), F.lit("")))


def fleet_summary(campaigns: DataFrame) -> DataFrame:
    """Totals and rates of the fleet, pass or fail, and how many campaigns fail."""
    total = campaigns.agg(F.count(F.lit(1)).alias("campaigns"), *[F.sum(c).alias(c) for c in ("sent", "replies", "bounces")],
                          F.count_if("flag_low_reply").alias("failing_reply"), F.count_if("flag_high_bounce").alias("failing_bounce"))
    reply, bounce = ratio(F.col("replies"), F.col("sent"), 100.0), ratio(F.col("bounces"), F.col("sent"), 100.0)
    return total.withColumns({
        "reply_pct": round_half_up(reply, 2), "bounce_pct": round_half_up(bounce, 2),
        "reply_verdict": F.when(reply >= FLEET_REPLY_MIN, "PASS").otherwise("FAIL"),
        "bounce_verdict": F.when(bounce <= FLEET_BOUNCE_MAX, "PASS").otherwise("FAIL")})


def lookup_type(stats: DataFrame, inboxes: DataFrame) -> DataFrame:
    """Inbox statistics with the inbox type; unknown inboxes say so."""
    kinds = inboxes.select("inbox_id", inbox_type(F.col("type"), F.col("smtp_host")).alias("inbox_type"))
    return stats.join(kinds, "inbox_id", "left").withColumn("inbox_type", F.coalesce("inbox_type", F.lit("unknown")))


def inbox_type_compare(stats: DataFrame, inboxes: DataFrame) -> DataFrame:
    """Per type and in total: inboxes, sends, replies, bounces, rates; best and worst type.

    The facts are combined per inbox before the lookup: a busy inbox is one row by then, and
    counting distinct inboxes is counting rows.
    """
    per_box = lookup_type(_totals(stats, "inbox_id"), inboxes)
    out = per_box.rollup("inbox_type").agg(
        F.grouping("inbox_type").alias("_g"), F.count(F.lit(1)).alias("inboxes"),
        *[F.sum(c).alias(c) for c in ("sent", "replies", "bounces")])
    reply, bounce = ratio(F.col("replies"), F.col("sent"), 100.0), ratio(F.col("bounces"), F.col("sent"), 100.0)
    out = out.withColumns({
        "inbox_type": F.when(F.col("_g") == 1, "TOTAL").otherwise(F.col("inbox_type")),
        "reply_pct": round_half_up(reply, 2), "bounce_pct": round_half_up(bounce, 2),
        "elevated_bounce": (F.col("_g") == 0) & (F.col("sent") > 500) & (bounce > 3)})
    # A handful of types: the window runs over the finished report.
    types = Window.partitionBy("_g")
    place = F.row_number().over(types.orderBy(F.desc("_r"), F.asc("inbox_type")))
    last = F.row_number().over(types.orderBy(F.asc("_r"), F.asc("inbox_type")))
    ranked = out.withColumn("_r", reply).withColumn("is_best", (place == 1) & (F.col("_g") == 0)) \
                .withColumn("is_worst", (last == 1) & (F.col("_g") == 0))
    return ranked.drop("_g", "_r")


def daily_analytics(events: DataFrame, kinds: Sequence[str] = ("sent", "opened", "clicked", "replied", "bounced")) -> DataFrame:
    """Events per day and kind, with rates on sent, one decimal."""
    per = events.groupBy(F.to_date("ts").alias("day")).agg(
        *[F.count_if(F.col("kind") == k).alias(k) for k in kinds])
    return per.withColumns({f"{k}_rate": round_half_up(ratio(F.col(k), F.col("sent"), 100.0), 1)
                            for k in kinds if k != "sent"})


def angle_performance(sends: DataFrame, replies: DataFrame, angle: str = "angle", segment: str = "segment") -> DataFrame:
    """Sends, replying leads and positive rate per workspace, angle and segment.

    Replies are reduced to one row per lead and campaign before the join, so a chatty lead
    does not multiply sends.
    """
    said = replies.groupBy("workspace", "lead", "campaign_id").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("label").isin(*POSITIVE_LABELS)).alias("positive"))
    per = sends.groupBy("workspace", "lead", "campaign_id", angle, segment).agg(F.count(F.lit(1)).alias("sends"))
    joined = per.join(said, ["workspace", "lead", "campaign_id"], "left")
    return joined.groupBy("workspace", angle, segment).agg(
        F.sum("sends").alias("sends"), F.count(F.lit(1)).alias("leads"),
        F.count_if(F.col("n").isNotNull()).alias("replied"), F.count_if(is_true(F.col("positive"))).alias("positive")) \
        .withColumn("positive_rate", round_half_up(ratio(F.col("positive"), F.col("leads"), 100.0), 2))


def reply_drop(sends: DataFrame, replies: DataFrame, weeks: int = 4) -> DataFrame:
    """Per campaign and for the fleet, weeks whose reply rate fell under half of the mean of
    the four calendar weeks before, or by more than 30 % against the week before. Weeks without
    any event count neither for nor against.

    Both facts are counted per campaign and week first; the window runs over those counts.
    """
    week = lambda c: F.date_trunc("week", c).cast("date")
    facts = sends.select("campaign_id", week(F.col("sent_at")).alias("week"), F.lit(1).alias("s"), F.lit(0).alias("r")) \
        .unionByName(replies.select("campaign_id", week(F.col("replied_at")).alias("week"), F.lit(0).alias("s"), F.lit(1).alias("r")))
    per = facts.groupBy("week", "campaign_id").agg(F.sum("s").alias("s"), F.sum("r").alias("r"))
    fleet = per.groupBy("week").agg(F.lit(None).cast("bigint").alias("campaign_id"), F.sum("s").alias("s"), F.sum("r").alias("r"))
    both = per.withColumn("level", F.lit("campaign")).unionByName(fleet.withColumn("level", F.lit("fleet"))) \
        .withColumn("rate", ratio(F.col("r"), F.col("s"), 100.0))
    both = both.withColumn("_n", F.floor(F.datediff("week", F.lit("1970-01-05").cast("date")) / 7))
    series = Window.partitionBy("level", "campaign_id").orderBy("_n")
    before = F.avg("rate").over(series.rangeBetween(-weeks, -1))
    previous = F.avg("rate").over(series.rangeBetween(-1, -1))
    return both.select("level", "campaign_id", "week", F.col("s").alias("sent"), F.col("r").alias("replies"),
                       is_true(F.col("rate") < before * 0.5).alias("real_drop"),
                       is_true(F.col("rate") < previous * 0.7).alias("week_drop"))


# --- inboxes and domains -------------------------------------------------------------

def inbox_type(kind: Column, host: Column) -> Column:
    kind, host = F.upper(F.coalesce(kind, F.lit(""))), F.coalesce(host, F.lit(""))
    google = kind.contains("GMAIL") | kind.contains("GOOGLE") | (kind == "G_SUITE") | host.contains("google")
    office = kind.contains("OUTLOOK") | kind.contains("OFFICE365") | kind.contains("MICROSOFT") | host.contains("outlook")
    return F.when(google, "G Suite / Gmail").when(office, "Office365 / Outlook").otherwise("SMTP")


def inbox_health(df: DataFrame) -> DataFrame:
    """Connection failed, blocked, warming, active or healthy; and the reputation."""
    warm = is_true(F.col("warmup_status").isin("ACTIVE", "ENABLED"))
    raw = F.coalesce(F.col("reputation"), F.lit(""))
    score = F.regexp_replace(raw, r"\D", "").try_cast("int")
    reputation = F.when(raw == "", F.when(warm, "unknown").otherwise("n/a")) \
        .when(raw.contains("100") | (score >= 80), "good").when(score >= 50, "fair").otherwise("bad")
    broken = ~is_true(F.col("smtp_ok")) | ~is_true(F.col("imap_ok"))
    health = F.when(broken, "connection_failed").when(is_true(F.col("is_blocked")), "blocked") \
        .when(warm & (F.coalesce("warmup_sent", F.lit(0)) < WARMUP_DONE), "warming").when(~warm, "active").otherwise("healthy")
    return df.withColumns({"warmup": F.when(warm, "on").otherwise("off"), "reputation_band": reputation,
                           "health_status": health, "connection_failed": broken})


def inbox_health_counts(health: DataFrame) -> DataFrame:
    return health.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("warmup") == "on").alias("warmup_on"),
        F.count_if(F.col("warmup") == "off").alias("warmup_off"), F.count_if("is_blocked").alias("blocked"),
        F.count_if("connection_failed").alias("connection_failed"),
        *[F.count_if(F.col("reputation_band") == b).alias(f"reputation_{b}") for b in ("good", "fair", "bad")])


def least_used_inboxes(df: DataFrame, tag: str, n: int) -> DataFrame:
    """The ``n`` connected, unblocked inboxes with a tag among their ``tags`` and the fewest sends today."""
    return df.where(is_true(F.array_contains("tags", tag)) & is_true(F.col("smtp_ok")) & ~is_true(F.col("is_blocked"))) \
             .orderBy(F.coalesce("daily_sent", F.lit(0)), "inbox_id").limit(n)


def domain_auth(txt: DataFrame, selector: str = "google") -> DataFrame:
    """SPF, DKIM and DMARC state per domain from its TXT records, with notes."""
    own = F.col("name") == F.col("domain")
    dkim_name = F.col("name") == F.concat(F.lit(f"{selector}._domainkey."), F.col("domain"))
    dmarc_name = F.col("name") == F.concat(F.lit("_dmarc."), F.col("domain"))
    value = F.regexp_replace("value", r'^"|"$', "")
    per = txt.groupBy("domain").agg(
        F.min(F.when(own & value.contains("v=spf1"), value)).alias("spf_record"),
        F.max(dkim_name & (value.contains("v=DKIM1") | value.contains("p="))).alias("dkim_present"),
        F.min(F.when(dmarc_name & value.contains("v=DMARC1"), value)).alias("dmarc_record"))
    policy = F.nullif(F.regexp_extract(F.coalesce("dmarc_record", F.lit("")), r"p=(\w+)", 1), F.lit(""))
    out = per.withColumns({
        "spf_present": F.col("spf_record").isNotNull(), "spf_strict": is_true(F.col("spf_record").contains("-all")),
        "dmarc_present": F.col("dmarc_record").isNotNull()})
    out = out.withColumn("dmarc_policy", F.when(F.col("dmarc_present"), F.coalesce(policy, F.lit("unknown"))).otherwise(""))
    return out.withColumn("notes", F.concat_ws(
        "; ", F.when(~F.col("spf_present"), "SPF missing").when(~F.col("spf_strict"), "SPF loose"),
        F.when(~F.col("dkim_present"), "DKIM missing"),
        F.when(~F.col("dmarc_present"), "DMARC missing").when(F.col("dmarc_policy") == "none", "DMARC not enforced")))


def auth_gaps(auth: DataFrame) -> DataFrame:
    return auth.agg(F.count(F.lit(1)).alias("domains"), F.count_if(~F.col("spf_present")).alias("missing_spf"),
                    F.count_if(~F.col("dkim_present")).alias("missing_dkim"),
                    F.count_if(~F.col("dmarc_present")).alias("missing_dmarc"),
                    F.count_if(F.col("dmarc_policy") == "none").alias("policy_none"))


# --- verdicts --------------------------------------------------------------------------

def campaign_verdict(rate: Column, baseline: Column) -> Column:
    """Twice the baseline is kept, under half is killed, anything else iterates."""
    return F.when(rate >= baseline * 2, "keep").when(rate < baseline * 0.5, "kill").otherwise("iterate")


def experiment_verdict(arms: DataFrame, min_sends: int = 500) -> DataFrame:
    """Control against variant: lift of the positive rate, and what to do with it.

    Needs enough sends per arm; a variant that bounces twice as much, or at all when the control
    never does, is disqualified; a test that changed several things is never adopted.
    """
    def arm(name: str, col: str) -> Column:
        return F.sum(F.when(F.col("arm") == name, F.col(col)).otherwise(0)).alias(f"{name}_{col}")
    wide = arms.groupBy("experiment_id").agg(
        *[arm(a, c) for a in ("control", "variant") for c in ("sent", "positive", "bounces")],
        F.max("combined").alias("combined"))
    rate = {a: ratio(F.col(f"{a}_positive"), F.col(f"{a}_sent")) for a in ("control", "variant")}
    bounce = {a: ratio(F.col(f"{a}_bounces"), F.col(f"{a}_sent")) for a in ("control", "variant")}
    lift = F.when(rate["control"] > 0, rate["variant"] / rate["control"] - 1)
    verdict = F.when((F.col("control_sent") < min_sends) | (F.col("variant_sent") < min_sends), "too_small") \
        .when((bounce["variant"] > 0) & (bounce["variant"] >= bounce["control"] * 2), "disqualified") \
        .when(lift.isNull(), "inconclusive").when(lift < 0, "loser") \
        .when(F.col("combined") & (lift >= 0.1), "split_follow_up") \
        .when(lift >= 0.2, "adopt").when(lift >= 0.1, "replicate").otherwise("inconclusive")
    return wide.withColumn("lift_pct", round_half_up(lift * 100, 2)).withColumn("verdict", verdict)


def bounce_triage(pct: Column, hard_share: Column) -> Column:
    """Over 5 % stop; over 3 % it is the list if mostly hard, else the reputation."""
    return F.when(pct > 5, "stop").when((pct > 3) & (hard_share > 0.5), "list_problem") \
            .when(pct > 3, "reputation").otherwise("ok")


def _apart(terms: Sequence[str]) -> list[list[str]]:
    """Terms in groups in which none is part of another, so that one match hides no other."""
    groups: list[list[str]] = []
    for term in dict.fromkeys(terms):
        home = next((g for g in groups if not any(term in o or o in term for o in g)), None)
        groups.append([term]) if home is None else home.append(term)
    return groups


def spam_terms(df: DataFrame, id_col: str, text_col: str, rules: Sequence[tuple[str, str, Sequence[str]]]) -> DataFrame:
    """One row per finding: banned words (also inside hyphen compounds), phrases, categories
    from ``rules`` (kind, severity, terms), and style faults.

    Each text is tested once against the literals; nothing is joined.
    """
    flat = F.lower(normalize_space(F.col(text_col)))
    text = F.coalesce(F.col(text_col), F.lit(""))

    def finding(kind: str, severity: str, term: str) -> Column:
        return F.struct(F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), F.lit(term).alias("term"))
    def found_words(kind: str, severity: str, terms: Sequence[str]) -> Column:
        # All words of a group in one pass over the text.
        either = "|".join(map(quote_regex, terms))
        hits = F.regexp_extract_all("_flat", F.lit(rf"(?<![a-z0-9])(?:{either})(?![a-z0-9])"), F.lit(0))
        return F.transform(F.array_distinct(hits), lambda t: F.struct(
            F.lit(kind).alias("kind"), F.lit(severity).alias("severity"), t.alias("term")))
    tests = []
    for kind, severity, terms in rules:
        if kind == "word":
            tests += [found_words(kind, severity, group) for group in _apart(terms)]
        else:
            tests += [F.array(F.when(F.contains("_flat", F.lit(t)), finding(kind, severity, t))) for t in terms]
    style = {"all_caps": r"(?<![A-Za-z])[A-Z]{4,}(?![A-Za-z])", "em_dash": "—", "many_exclamations": "!!+",
             "silence_close": r"(?i)(take silence|no reply as|no response means|don.t hear back)"}
    tests += [F.array(F.when(F.col("_text").rlike(rx), finding("style", "low", name))) for name, rx in style.items()]
    none = F.lit(None).cast("struct<kind:string,severity:string,term:string>")
    found = df.select(id_col, flat.alias("_flat"), text.alias("_text")) \
        .select(id_col, F.explode(F.array_except(F.concat(*tests), F.array(none))).alias("f"))
    return found.select(id_col, "f.*")
