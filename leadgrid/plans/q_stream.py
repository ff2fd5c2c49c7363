"""Streaming queries: each runs its stream to the end and returns the table it wrote."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadgrid.plans.q_pages import QUEUE_SQL, crawls_now, queue_after, queue_before
from leadgrid.plans.registry import query
from leadgrid.plans.standins import STANDINS
from leadgrid.plans.sqltext import rate, rnd
from leadgrid.session import fresh_path
from leadgrid.streaming import jobs
from leadgrid.streaming.store import Store


def stream(t, name):
    """Streaming twin of a table or of a stand-in over one table."""
    needs, sql = STANDINS.get(name, ((name,), None))
    source = jobs.read_stream(t.spark, t.folder, f"{needs[0]}.parquet")
    return t.spark.sql(sql, **{needs[0]: source}) if sql else source


def restream(df, name):
    """Write a derived batch table and read it back as a stream."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def keyed(source, name, rule):
    """A stream folded into a keyed table, to the end."""
    return jobs.current(jobs.to_keyed(source, name, rule), source.schema)


@query("stream_dedupe_postings", """SELECT user_id, event_type, props, min(ts) AS first_at FROM events GROUP BY 1, 2, 3""")
def stream_dedupe_postings(t):
    return keyed(stream(t, "events").select("user_id", "event_type", "props", "ts"), "postings",
                 jobs.postings("ts", ["user_id", "event_type", "props"])).withColumnRenamed("ts", "first_at")


@query("stream_richest_postings", """SELECT lang, source, doc_id, length(text)::BIGINT AS n_text FROM documents
    QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY length(text) DESC, doc_id) = 1""")
def stream_richest_postings(t):
    loads = jobs.to_table(stream(t, "documents").select("doc_id", "lang", "source", "text"), "richest")
    out = jobs.stream_richest_postings(loads, ["lang", "source"], "text", "doc_id")
    return out.select("lang", "source", "doc_id", F.length("text").cast("bigint").alias("n_text"))


def twice(df):
    """The load, and the same rows again."""
    return df.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")


@query("stream_replies", "SELECT event_id, label, replied_at FROM replies")
def stream_replies(t):
    return keyed(twice(stream(t, "replies")), "replies", jobs.replies("event_id")).select("event_id", "label", "replied_at")


@query("stream_sends", """SELECT min(event_id) AS event_id, lead_email, campaign_id, step, sent_at,
    sha256('main|' || lead_email || '|' || campaign_id || '|' || step || '|' || epoch_us(sent_at)) AS send_id FROM sends GROUP BY ALL""")
def stream_sends(t):
    loads = jobs.with_send_id(twice(stream(t, "sends")))
    return keyed(loads, "sends", jobs.sends()).select("event_id", "lead_email", "campaign_id", "step", "sent_at", "send_id")


def _spans(step_days: int) -> str:
    """Windows of seven days, every ``step_days``, the running ones included."""
    spans = f"generate_series(0, {7 // step_days - 1})" if step_days < 7 else "[0]"
    return f"""WITH e AS (SELECT *, unnest({spans}) AS back FROM mail_events),
    w AS (SELECT make_timestamp(((epoch_us(ts) // (86400000000 * {step_days})) - back) * 86400000000 * {step_days}) AS window_start, * FROM e),
    g AS (SELECT window_start, window_start + INTERVAL 7 DAY AS window_end, campaign_id, count(*) FILTER (WHERE kind = 'sent') AS sent,
      count(*) FILTER (WHERE kind = 'replied') AS replies, count(*) FILTER (WHERE kind = 'bounced') AS bounces FROM w GROUP BY 1, 2, 3)
    SELECT *, {rnd(rate('replies', 'sent', 100), 2)} AS reply_pct, {rnd(rate('bounces', 'sent', 100), 2)} AS bounce_pct FROM g"""


@query("weekly_rates", _spans(7))
def weekly_rates(t):
    return jobs.weekly_rates(jobs.to_panes(stream(t, "mail_events"), "weekly"))


@query("trailing_rates", _spans(1))
def trailing_rates(t):
    return jobs.trailing_rates(jobs.to_panes(stream(t, "mail_events"), "trailing"))


@query("contact_state", """SELECT workspace, lead_email, campaign_id, step, sent_at AS last_at FROM sends
    QUALIFY row_number() OVER (PARTITION BY workspace, lead_email ORDER BY sent_at DESC, campaign_id DESC, step DESC) = 1
      AND sent_at > (SELECT max(sent_at) FROM sends) - INTERVAL 7 DAY""")
def contact_state(t):
    leads = keyed(stream(t, "sends"), "touch", jobs.touches(7))
    live = jobs.live_contacts(leads, leads.agg(F.max("sent_at")).scalar(), 7)
    return live.select("workspace", "lead_email", "campaign_id", "step", F.col("sent_at").alias("last_at"))


@query("late_replies", """WITH r AS (SELECT r.event_id AS reply_event, arg_max(s.event_id, (s.sent_at, s.event_id)) AS send_event, max(s.sent_at) AS sent_at,
      any_value(r.replied_at) AS replied_at FROM replies r JOIN sends s ON r.lead = s.lead AND r.campaign_id = s.campaign_id AND r.replied_at >= s.sent_at GROUP BY 1)
    SELECT s.event_id, s.lead, s.campaign_id, r.reply_event FROM sends s LEFT JOIN r ON r.send_event = s.event_id
      AND r.replied_at <= r.sent_at + INTERVAL 21 DAY""")
def late_replies(t):
    sends, replies = stream(t, "sends"), stream(t, "replies")
    stores = [jobs.to_keyed(loads, name, jobs.earliest(["event_id", time], time, moves=False)) for loads, name, time in
              ((sends, "sends", "sent_at"), (replies, "replies", "replied_at"))]
    found = jobs.refresh_late_replies(Store(t.spark, fresh_path(t.spark, "earned")), *stores, sends.schema, replies.schema, 21)
    return found.select("event_id", "lead", "campaign_id", "reply_event")


@query("freshness_stream", """SELECT event_id, event_type FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-20' - INTERVAL 7 DAY AND TIMESTAMP '2024-01-20'""")
def freshness_stream(t):
    fresh = jobs.freshness_stream(stream(t, "events"), "ts", F.lit("2024-01-20 00:00:00").cast("timestamp_ntz"))
    return jobs.to_table(fresh.select("event_id", "event_type"), "fresh")


@query("sync_profile_queue_stream", f"WITH {QUEUE_SQL} SELECT * FROM after")
def sync_profile_queue_stream(t):
    now = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    store, queue, crawls = Store(t.spark, fresh_path(t.spark, "queue")), queue_before(t), twice(restream(crawls_now(t), "crawls"))
    jobs.open_queue(store, queue)
    jobs.fold(crawls, store, fresh_path(t.spark, "queue-checkpoint"),
              lambda at, batch, number: jobs.sync_queue(at, batch, number, queue.schema, now))
    return queue_after(store.read("queue", queue.schema))
