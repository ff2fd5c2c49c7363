"""Queries over sends, replies, inboxes and domains."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.functions import bands, keys
from leadgrid.operators import delivery
from leadgrid.plans import vocab
from leadgrid.plans.registry import query
from leadgrid.plans.sqltext import rate, rnd, sp


def mail_events(t):
    """Stand-in events in the provider's shape: mixed type codes, body as a struct."""
    kind = F.expr("CASE WHEN kind = 'sent' THEN CASE event_id % 3 WHEN 0 THEN 'sent' WHEN 1 THEN 'SENT' ELSE '1' END "
                  "WHEN kind = 'replied' THEN CASE event_id % 2 WHEN 0 THEN 'received' ELSE '2' END ELSE 'other' END")
    return t("mail_events").select(
        F.col("event_id").cast("string").alias("id"), kind.alias("email_type"),
        F.expr("CASE WHEN event_id % 2 = 0 THEN concat('L', lead, '@Co', lead, '.example.com') END").alias("lead"),
        F.expr("concat('alt', lead, '@x.example.com')").alias("to_address_email_list"),
        F.expr("concat('R', lead, '@Co', lead, '.example.com')").alias("from_address_email"), "campaign_id",
        F.expr("CAST(event_id % 3 AS INT)").alias("step"),
        F.expr("CASE WHEN event_id % 5 <> 0 THEN ts END").alias("timestamp_email"), F.col("ts").alias("timestamp_created"),
        F.struct(F.concat(F.lit("body "), "event_id").alias("text")).alias("body"))


@query("sync_events", """SELECT 'send' AS kind, CASE WHEN event_id % 2 = 0 THEN 'l' || lead || '@co' || lead || '.example.com' ELSE 'alt' || lead || '@x.example.com' END AS lead_email,
      CASE WHEN event_id % 2 = 0 THEN 'co' || lead || '.example.com' ELSE 'x.example.com' END AS lead_domain, greatest(event_id % 3, 1)::INTEGER AS step, ts AS at, NULL AS body
    FROM mail_events WHERE kind = 'sent'
    UNION ALL SELECT 'reply', 'r' || lead || '@co' || lead || '.example.com', 'co' || lead || '.example.com', NULL, ts, 'body ' || event_id FROM mail_events WHERE kind = 'replied'""")
def sync_events(t):
    sends, replies = delivery.sync_events(mail_events(t), "main")
    return sends.select(F.lit("send").alias("kind"), "lead_email", "lead_domain", F.col("sequence_step").alias("step"),
                        F.col("sent_at").alias("at"), F.lit(None).cast("string").alias("body")).unionByName(
        replies.select(F.lit("reply").alias("kind"), "lead_email", "lead_domain", F.lit(None).cast("int").alias("step"),
                       F.col("replied_at").alias("at"), "body"))


@query("send_key", """SELECT event_id, sha256('main|' || lead_email || '|' || campaign_id || '|' || step || '|' || epoch_us(sent_at)) AS send_id FROM sends""")
def send_key(t):
    sends = t("sends")
    return sends.select("event_id", keys.send_key(F.col("workspace"), F.col("lead_email"), F.col("campaign_id"), F.col("step"),
                                                  keys.epoch_micros(sends, "sent_at")).alias("send_id"))


@query("campaign_to_angle", """SELECT event_id, campaign_id, 'campaign ' || s_suppkey AS campaign_name, 'angle-' || n_nationkey AS angle_slug
    FROM (SELECT event_id, campaign_id FROM sends UNION ALL SELECT -1 - event_id, -1 - campaign_id FROM sends)
    LEFT JOIN supplier ON s_suppkey = campaign_id LEFT JOIN nation ON n_nationkey = s_nationkey""")
def campaign_to_angle(t):
    campaigns = t("supplier").select(
        F.col("s_suppkey").alias("campaign_id"), F.concat(F.lit("campaign "), "s_suppkey").alias("campaign_name"), F.col("s_nationkey").alias("angle_id"))
    angles = t("nation").select(F.col("n_nationkey").alias("angle_id"), F.concat(F.lit("angle-"), "n_nationkey").alias("angle_slug"))
    sends = t("sends").select("event_id", "campaign_id")
    # The same sends again under campaigns that nobody knows.
    sends = sends.unionByName(sends.select((-1 - F.col("event_id")).alias("event_id"), (-1 - F.col("campaign_id")).alias("campaign_id")))
    return delivery.campaign_to_angle(sends, campaigns, angles).select("event_id", "campaign_id", "campaign_name", "angle_slug")


@query("render_template", """SELECT lead_id, 'Hi ' || first_name || ', about ' || company_industry || ' at {{city}}' AS body, 'A - B - ' || first_name AS subject,
    '{{value_line_b_' || lead_id || '}} {{other}}' AS scoped FROM leads""")
def render_template(t):
    body = delivery.render_template(F.lit("Hi {{first_name}}, about {{industry}} at {{city}}"),
                                    {"first_name": F.col("first_name"), "industry": F.col("company_industry")})
    subject = delivery.clean_subject(F.concat(F.lit("A—B–"), "first_name"))
    scoped = delivery.scope_slots(F.lit("{{value_line}} {{other}}"), ["value_line"], F.lit("B"), F.col("lead_id"))
    return t("leads").select("lead_id", body.alias("body"), subject.alias("subject"), scoped.alias("scoped"))


@query("split_custom_fields", """SELECT lead_id, email, coalesce(nullif(job_title, ''), '') AS title, coalesce(nullif(company_domain, ''), '') AS domain,
    ((job_title <> '')::INTEGER + (company_domain <> '')::INTEGER)::INTEGER AS n_fields FROM leads""")
def split_custom_fields(t):
    out = delivery.split_custom_fields(t("leads").select("lead_id", "email", "job_title", "company_domain"), ["lead_id", "email"])
    get = lambda k: F.coalesce(F.try_element_at("custom_fields", F.lit(k)), F.lit(""))
    return out.select("lead_id", "email", get("job_title").alias("title"), get("company_domain").alias("domain"),
                      F.size("custom_fields").alias("n_fields"))


@query("slot_fallback", """SELECT row_id, coalesce(nullif(industry, ''), meta_revenue_range, 'a company like yours') AS text,
    CASE WHEN industry <> '' THEN 'rich' WHEN meta_revenue_range IS NOT NULL THEN 'standard' ELSE 'generic' END AS level FROM list_companies""")
def slot_fallback(t):
    slot = delivery.slot_fallback(F.col("industry"), F.col("meta_revenue_range"), "a company like yours")
    return t("list_companies").select("row_id", slot["text"].alias("text"), slot["level"].alias("level"))


@query("last_contact", """SELECT workspace, lead_email, campaign_id, step, sent_at FROM sends
    QUALIFY row_number() OVER (PARTITION BY workspace, lead_email ORDER BY sent_at DESC, event_id DESC) = 1""")
def last_contact(t):
    return delivery.last_contact(t("sends"), ["campaign_id", "step"]).drop("event_id")


@query("first_inbound", f"""SELECT conv_id, turn, substr({sp("replace(replace(replace(replace(replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&')")}, 1, 5000) AS reply_body
    FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1""")
def first_inbound(t):
    return delivery.first_inbound(t("conversations"), "conv_id", "turn", F.col("role") == "user", "text")


@query("reply_label_guard", "SELECT event_id, CASE WHEN confidence < 0.7 THEN 'other' ELSE label END AS label FROM replies")
def reply_label_guard(t):
    return t("replies").select("event_id", delivery.reply_label_guard(F.col("label"), F.col("confidence")).alias("label"))


REPLY = f"""r AS (SELECT campaign_id, count(*) AS total_replies, count(*) FILTER (WHERE label IN ('ooo', 'bounce')) AS excluded,
      count(*) FILTER (WHERE label LIKE 'positive%') AS positive, count(*) FILTER (WHERE label = 'negative_hostile') AS hostile,
      count(*) FILTER (WHERE label = 'unsubscribe') AS unsubscribed FROM replies GROUP BY 1),
    s AS (SELECT campaign_id, count(*) AS sent FROM sends GROUP BY 1),
    rs AS (SELECT campaign_id, coalesce(sent, 0) AS sent, coalesce(total_replies, 0) AS total_replies, coalesce(excluded, 0) AS excluded, coalesce(positive, 0) AS positive,
      coalesce(hostile, 0) AS hostile, coalesce(unsubscribed, 0) AS unsubscribed FROM s FULL JOIN r USING (campaign_id))"""


@query("reply_rates", f"""WITH {REPLY}, h AS (SELECT campaign_id, string_agg(label || '=' || n, ',' ORDER BY label) AS histogram FROM (
      SELECT campaign_id, label, count(*) AS n FROM replies GROUP BY 1, 2) GROUP BY 1)
    SELECT rs.*, total_replies - excluded AS net_replies, {rate('positive', 'sent')} AS positive_reply_rate, {rate('positive', '(total_replies - excluded)')} AS positive_share,
      {rate('hostile', 'sent')} AS hostile_rate, {rate('unsubscribed', 'sent')} AS unsubscribe_rate, histogram FROM rs LEFT JOIN h USING (campaign_id)""")
def reply_rates(t):
    out = delivery.reply_rates(t("sends"), t("replies"))
    histogram = F.array_join(F.transform(F.map_entries("buckets"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return out.withColumn("histogram", histogram).drop("buckets")


_FLAGGED = f"""SELECT *, {rnd(rate('replies', 'sent', 100), 2)} AS reply_rate_pct, {rnd(rate('bounces', 'sent', 100), 2)} AS bounce_rate_pct,
    sent >= 200 AND {rate('replies', 'sent', 100)} < 1 AS flag_low_reply, sent >= 50 AND {rate('bounces', 'sent', 100)} > 3 AS flag_high_bounce FROM"""
_SUMS = "sum(sent)::BIGINT AS sent, sum(replies)::BIGINT AS replies, sum(bounces)::BIGINT AS bounces"


@query("campaign_performance", f"{_FLAGGED} (SELECT campaign_id, {_SUMS} FROM inbox_stats GROUP BY 1)")
def campaign_performance(t):
    return delivery.campaign_performance(t("inbox_stats"))


@query("inbox_performance", f"""WITH top AS (SELECT campaign_id FROM inbox_stats GROUP BY 1 HAVING sum(sent) > 0 ORDER BY sum(sent) DESC, campaign_id LIMIT 20)
    {_FLAGGED} (SELECT inbox_id, {_SUMS}, min(email) AS email, string_agg(DISTINCT campaign_id::VARCHAR, '|' ORDER BY campaign_id::VARCHAR) AS campaigns, split_part(min(email), '@', 2) AS domain
      FROM inbox_stats WHERE campaign_id IN (SELECT campaign_id FROM top) GROUP BY 1)""")
def inbox_performance(t):
    out = delivery.inbox_performance(t("inbox_stats"), 20)
    return out.withColumn("campaigns", F.array_join(F.sort_array(F.split("campaigns", r"\|")), "|"))


@query("fleet_summary", f"""WITH c AS ({_FLAGGED} (SELECT campaign_id, {_SUMS} FROM inbox_stats GROUP BY 1)),
    f AS (SELECT count(*) AS campaigns, {_SUMS}, count(*) FILTER (WHERE flag_low_reply) AS failing_reply, count(*) FILTER (WHERE flag_high_bounce) AS failing_bounce FROM c)
    SELECT *, {rnd(rate('replies', 'sent', 100), 2)} AS reply_pct, {rnd(rate('bounces', 'sent', 100), 2)} AS bounce_pct,
      CASE WHEN {rate('replies', 'sent', 100)} >= 1 THEN 'PASS' ELSE 'FAIL' END AS reply_verdict, CASE WHEN {rate('bounces', 'sent', 100)} <= 2 THEN 'PASS' ELSE 'FAIL' END AS bounce_verdict FROM f""")
def fleet_summary(t):
    return delivery.fleet_summary(delivery.campaign_performance(t("inbox_stats")))


_TYPE = """CASE WHEN upper(coalesce(type, '')) LIKE '%GMAIL%' OR contains(smtp_host, 'google') THEN 'G Suite / Gmail'
    WHEN upper(coalesce(type, '')) LIKE '%OUTLOOK%' OR contains(smtp_host, 'outlook') THEN 'Office365 / Outlook' ELSE 'SMTP' END"""


@query("inbox_type", f"SELECT inbox_id, {_TYPE} AS inbox_type FROM inboxes")
def inbox_type(t):
    return t("inboxes").select("inbox_id", delivery.inbox_type(F.col("type"), F.col("smtp_host")).alias("inbox_type"))


_TYPED = f"typed AS (SELECT s.*, coalesce(inbox_type, 'unknown') AS inbox_type FROM all_stats s LEFT JOIN (SELECT inbox_id, {_TYPE} AS inbox_type FROM inboxes) USING (inbox_id))"


# Every figure once more for an inbox that is on no list.
_STATS = "all_stats AS (FROM inbox_stats UNION ALL SELECT * REPLACE (-inbox_id AS inbox_id) FROM inbox_stats)"


def all_stats(t):
    stats = t("inbox_stats")
    return stats.unionByName(stats.withColumn("inbox_id", -F.col("inbox_id")))


@query("lookup_type", f"WITH {_STATS}, {_TYPED} SELECT inbox_id, campaign_id, inbox_type, sum(sent)::BIGINT AS sent FROM typed GROUP BY 1, 2, 3")
def lookup_type(t):
    per = all_stats(t).groupBy("inbox_id", "campaign_id").agg(F.sum("sent").alias("sent"))
    return delivery.lookup_type(per, t("inboxes"))


@query("inbox_type_compare", f"""WITH {_STATS}, {_TYPED}, c AS (SELECT inbox_type, count(DISTINCT inbox_id) AS inboxes, {_SUMS} FROM typed GROUP BY 1),
    a AS (SELECT *, {rate('replies', 'sent')} AS rr, false AS tot FROM c UNION ALL SELECT 'TOTAL', sum(inboxes)::BIGINT, {_SUMS}, 0, true FROM c)
    SELECT inbox_type, inboxes, sent, replies, bounces, {rnd(rate('replies', 'sent', 100), 2)} AS reply_pct, {rnd(rate('bounces', 'sent', 100), 2)} AS bounce_pct,
      NOT tot AND sent > 500 AND {rate('bounces', 'sent', 100)} > 3 AS elevated_bounce,
      NOT tot AND row_number() OVER (PARTITION BY tot ORDER BY rr DESC, inbox_type) = 1 AS is_best, NOT tot AND row_number() OVER (PARTITION BY tot ORDER BY rr, inbox_type) = 1 AS is_worst FROM a""")
def inbox_type_compare(t):
    return delivery.inbox_type_compare(all_stats(t), t("inboxes"))


_KINDS = ("opened", "clicked", "replied", "bounced")


@query("daily_analytics", f"""WITH d AS (SELECT ts::DATE AS day, {', '.join(f"count(*) FILTER (WHERE kind = '{k}') AS {k}" for k in ('sent', *_KINDS))} FROM mail_events GROUP BY 1)
    SELECT *, {', '.join(f"{rnd(rate(k, 'sent', 100), 1)} AS {k}_rate" for k in _KINDS)} FROM d""")
def daily_analytics(t):
    return delivery.daily_analytics(t("mail_events"))


@query("angle_performance", f"""WITH s AS (SELECT workspace, lead, campaign_id, campaign_id % 7 AS angle, lead % 5 AS segment, count(*) AS sends FROM sends GROUP BY ALL),
    j AS (SELECT s.*, (SELECT count(*) FROM replies r WHERE r.lead = s.lead AND r.campaign_id = s.campaign_id) AS n,
      (SELECT count(*) FROM replies r WHERE r.lead = s.lead AND r.campaign_id = s.campaign_id AND label LIKE 'positive%') AS p FROM s),
    g AS (SELECT workspace, angle, segment, sum(sends)::BIGINT AS sends, count(*) AS leads, count(*) FILTER (WHERE n > 0) AS replied, count(*) FILTER (WHERE p > 0) AS positive FROM j GROUP BY 1, 2, 3)
    SELECT *, {rnd(rate('positive', 'leads', 100), 2)} AS positive_rate FROM g""")
def angle_performance(t):
    sends = t("sends").withColumn("angle", F.col("campaign_id") % 7).withColumn("segment", F.col("lead") % 5)
    return delivery.angle_performance(sends, t("replies"))


@query("reply_drop", f"""WITH f AS (SELECT campaign_id, date_trunc('week', sent_at)::DATE AS week, 1 AS s, 0 AS r FROM sends
      UNION ALL SELECT campaign_id, date_trunc('week', replied_at)::DATE, 0, 1 FROM replies),
    p AS (SELECT 'campaign' AS level, campaign_id, week, sum(s)::BIGINT AS sent, sum(r)::BIGINT AS replies FROM f GROUP BY ALL
      UNION ALL SELECT 'fleet', NULL, week, sum(s)::BIGINT, sum(r)::BIGINT FROM f GROUP BY week),
    q AS (SELECT *, {rate('replies', 'sent', 100)} AS rr FROM p),
    w AS (SELECT *, avg(rr) OVER (PARTITION BY level, campaign_id ORDER BY week RANGE BETWEEN INTERVAL 28 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS mean4,
      avg(rr) OVER (PARTITION BY level, campaign_id ORDER BY week RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 7 DAY PRECEDING) AS prev FROM q)
    SELECT level, campaign_id, week, sent, replies, coalesce(rr < mean4 * 0.5, false) AS real_drop, coalesce(rr < prev * 0.7, false) AS week_drop FROM w""")
def reply_drop(t):
    return delivery.reply_drop(t("sends"), t("replies"))


_HEALTH = """h AS (SELECT inbox_id, CASE WHEN NOT smtp_ok OR NOT imap_ok THEN 'connection_failed' WHEN is_blocked THEN 'blocked'
      WHEN warmup_status = 'ACTIVE' AND warmup_sent < 30 THEN 'warming' WHEN coalesce(warmup_status, '') <> 'ACTIVE' THEN 'active' ELSE 'healthy' END AS health_status,
    CASE reputation WHEN '100%' THEN 'good' WHEN '80%' THEN 'good' WHEN '55' THEN 'fair' WHEN '49' THEN 'bad'
      ELSE CASE WHEN warmup_status = 'ACTIVE' THEN 'unknown' ELSE 'n/a' END END AS reputation_band,
    CASE WHEN warmup_status = 'ACTIVE' THEN 'on' ELSE 'off' END AS warmup, is_blocked, NOT smtp_ok OR NOT imap_ok AS failed FROM inboxes)"""


@query("inbox_health", f"WITH {_HEALTH} SELECT inbox_id, health_status, reputation_band, warmup FROM h")
def inbox_health(t):
    return delivery.inbox_health(t("inboxes")).select("inbox_id", "health_status", "reputation_band", "warmup")


@query("inbox_health_counts", f"""WITH {_HEALTH} SELECT count(*) AS total, count(*) FILTER (WHERE warmup = 'on') AS warmup_on, count(*) FILTER (WHERE warmup = 'off') AS warmup_off,
    count(*) FILTER (WHERE is_blocked) AS blocked, count(*) FILTER (WHERE failed) AS connection_failed, count(*) FILTER (WHERE reputation_band = 'good') AS reputation_good,
    count(*) FILTER (WHERE reputation_band = 'fair') AS reputation_fair, count(*) FILTER (WHERE reputation_band = 'bad') AS reputation_bad FROM h""")
def inbox_health_counts(t):
    return delivery.inbox_health_counts(delivery.inbox_health(t("inboxes")))


@query("least_used_inboxes", """SELECT inbox_id, coalesce(daily_sent, 0) AS sent_today FROM inboxes WHERE tag = 'active' AND smtp_ok AND NOT is_blocked
    ORDER BY coalesce(daily_sent, 0), inbox_id LIMIT 25""")
def least_used_inboxes(t):
    tagged = t("inboxes").withColumn("tags", F.array(F.lit("all"), "tag"))
    return delivery.least_used_inboxes(tagged, "active", 25).select("inbox_id", F.coalesce("daily_sent", F.lit(0)).alias("sent_today"))


_AUTH = """a AS (SELECT domain, bool_or(contains(value, 'v=spf1')) AS spf_present, bool_or(contains(value, '-all')) AS spf_strict,
      bool_or(starts_with(name, 'google._domainkey') AND contains(value, 'v=DKIM1')) AS dkim_present, bool_or(contains(value, 'v=DMARC1')) AS dmarc_present,
      CASE WHEN bool_or(contains(value, 'v=DMARC1; p=none')) THEN 'none' WHEN bool_or(contains(value, 'v=DMARC1; p=reject')) THEN 'reject'
        WHEN bool_or(contains(value, 'v=DMARC1')) THEN 'unknown' ELSE '' END AS dmarc_policy FROM txt_records GROUP BY 1)"""


@query("domain_auth", f"""WITH {_AUTH} SELECT *, concat_ws('; ', CASE WHEN NOT spf_present THEN 'SPF missing' WHEN NOT spf_strict THEN 'SPF loose' END,
    CASE WHEN NOT dkim_present THEN 'DKIM missing' END, CASE WHEN NOT dmarc_present THEN 'DMARC missing' WHEN dmarc_policy = 'none' THEN 'DMARC not enforced' END) AS notes FROM a""")
def domain_auth(t):
    return delivery.domain_auth(t("txt_records")).drop("spf_record", "dmarc_record")


@query("auth_gaps", f"""WITH {_AUTH} SELECT count(*) AS domains, count(*) FILTER (WHERE NOT spf_present) AS missing_spf, count(*) FILTER (WHERE NOT dkim_present) AS missing_dkim,
    count(*) FILTER (WHERE NOT dmarc_present) AS missing_dmarc, count(*) FILTER (WHERE dmarc_policy = 'none') AS policy_none FROM a""")
def auth_gaps(t):
    return delivery.auth_gaps(delivery.domain_auth(t("txt_records")))


@query("campaign_verdict", f"""WITH {REPLY} SELECT campaign_id, CASE WHEN {rate('positive', 'sent')} >= 1.6 THEN 'keep' WHEN {rate('positive', 'sent')} < 0.4 THEN 'kill' ELSE 'iterate' END AS verdict FROM rs""")
def campaign_verdict(t):
    rates = delivery.reply_rates(t("sends"), t("replies"))
    return rates.select("campaign_id", delivery.campaign_verdict(F.col("positive_reply_rate"), F.lit(0.8)).alias("verdict"))


@query("experiment_verdict", f"""WITH e AS (SELECT campaign_id // 2 AS experiment_id, sum(sent) FILTER (WHERE campaign_id % 2 = 0) AS cs, sum(sent) FILTER (WHERE campaign_id % 2 = 1) AS vs,
      sum(replies) FILTER (WHERE campaign_id % 2 = 0) AS cp, sum(replies) FILTER (WHERE campaign_id % 2 = 1) AS vp, sum(bounces) FILTER (WHERE campaign_id % 2 = 0) AS cb,
      sum(bounces) FILTER (WHERE campaign_id % 2 = 1) AS vb FROM inbox_stats GROUP BY 1),
    e2 AS (FROM e UNION ALL SELECT -1 - experiment_id, cs, vs, cp, vp, 0, vb FROM e),
    l AS (SELECT *, {rate('vp', 'vs')} / nullif({rate('cp', 'cs')}, 0) - 1 AS lift FROM e2)
    SELECT experiment_id, {rnd('lift * 100', 2)} AS lift_pct, CASE WHEN cs < 500 OR vs < 500 THEN 'too_small' WHEN vb > 0 AND {rate('vb', 'vs')} >= 2 * {rate('cb', 'cs')} THEN 'disqualified'
      WHEN lift IS NULL THEN 'inconclusive' WHEN lift < 0 THEN 'loser' WHEN experiment_id % 4 = 0 AND lift >= 0.1 THEN 'split_follow_up' WHEN lift >= 0.2 THEN 'adopt'
      WHEN lift >= 0.1 THEN 'replicate' ELSE 'inconclusive' END AS verdict FROM l""")
def experiment_verdict(t):
    arms = t("inbox_stats").select(
        F.expr("campaign_id div 2").alias("experiment_id"), F.expr("CASE WHEN campaign_id % 2 = 0 THEN 'control' ELSE 'variant' END").alias("arm"),
        "sent", F.col("replies").alias("positive"), "bounces", F.expr("(campaign_id div 2) % 4 = 0").alias("combined"))
    # The same experiments again, with controls that never bounced.
    clean = arms.select((-1 - F.col("experiment_id")).alias("experiment_id"), "arm", "sent", "positive",
                        F.when(F.col("arm") == "variant", F.col("bounces")).otherwise(0).alias("bounces"),
                        (F.expr("(-1 - experiment_id) % 4") == 0).alias("combined"))
    arms = arms.unionByName(clean)
    return delivery.experiment_verdict(arms).select("experiment_id", "lift_pct", "verdict")


_PER_INBOX = f"(SELECT inbox_id, {rate('sum(bounces)', 'sum(sent)', 100)} AS pct, (inbox_id % 10) / 10 AS hard FROM inbox_stats GROUP BY 1)"


def per_inbox(t):
    return t("inbox_stats").groupBy("inbox_id").agg(bands.ratio(F.sum("bounces"), F.sum("sent"), 100.0).alias("pct"))


@query("bounce_triage", f"""SELECT inbox_id, CASE WHEN pct > 5 THEN 'stop' WHEN pct > 3 AND hard > 0.5 THEN 'list_problem'
    WHEN pct > 3 THEN 'reputation' ELSE 'ok' END AS triage FROM {_PER_INBOX}""")
def bounce_triage(t):
    return per_inbox(t).select("inbox_id", delivery.bounce_triage(F.col("pct"), F.col("inbox_id") % 10 / 10).alias("triage"))


@query("health_bands", f"""SELECT inbox_id, CASE WHEN pct < 1 THEN 'excellent' WHEN pct < 2 THEN 'normal' WHEN pct <= 3 THEN 'yellow' WHEN pct <= 5 THEN 'red' ELSE 'stop' END AS band,
      CASE WHEN 100 - pct * 8 > 90 THEN 'great' WHEN 100 - pct * 8 >= 80 THEN 'acceptable' WHEN 100 - pct * 8 >= 70 THEN 'yellow' ELSE 'red' END AS placement
    FROM {_PER_INBOX}""")
def health_bands(t):
    return per_inbox(t).select("inbox_id", bands.bounce_band(F.col("pct")).alias("band"),
                               bands.placement_band(100 - F.col("pct") * 8).alias("placement"))


_FLAT = f"lower({sp('text')})"
_SPAM = " UNION ALL ".join(
    [f"SELECT doc_id, '{kind}' AS kind, '{sev}' AS severity, '{term}' AS term FROM d WHERE " +
     (f"regexp_matches(flat, '(^|[^a-z0-9]){term}($|[^a-z0-9])')" if kind == "word" else f"contains(flat, '{term}')")
     for kind, sev, terms in vocab.SPAM_RULES for term in terms] +
    [f"SELECT doc_id, 'style', 'low', '{name}' FROM d WHERE regexp_matches(text, '{rx}')" for name, rx in (
        ("all_caps", "(^|[^A-Za-z])[A-Z]{4,}($|[^A-Za-z])"), ("em_dash", "—"), ("many_exclamations", "!!+"),
        ("silence_close", "(?i)(take silence|no reply as|no response means|don.t hear back)"))])


@query("spam_terms", f"WITH d AS (SELECT doc_id, text, {_FLAT} AS flat FROM documents) {_SPAM}")
def spam_terms(t):
    return delivery.spam_terms(t("documents"), "doc_id", "text", vocab.SPAM_RULES)
