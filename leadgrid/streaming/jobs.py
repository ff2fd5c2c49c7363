"""The incremental behaviours as Structured Streaming jobs.

Every job folds the batches of a stream into a ``Store``, whose partitions are spans of days or hash
buckets. A batch reads and replaces only the partitions that it touches, however old they are, so no
row is judged by when it arrived and no load reads all history:

* keyed tables (postings, replies, sends, contact touches) keep one row per key under the span of
  that row; an index of keys and spans finds copies that were stored under another span;
* rates keep counts per campaign and day, from which spans of any length are added up;
* replies to sends are refreshed for the spans whose sends or replies have changed;
* the profile queue is replaced in the buckets of the domains that were crawled.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StructType

from leadgrid.functions.bands import ratio, round_half_up
from leadgrid.functions.keys import epoch_micros, send_key
from leadgrid.operators.crawl import sync_profile_queue
from leadgrid.operators.grouping import best_per_key
from leadgrid.operators.signals import dedupe_richest
from leadgrid.session import fresh_path, is_folder, written
from leadgrid.streaming.store import PART, Store


def instants(df: DataFrame, col: str) -> DataFrame:
    """``col`` as instants: wall-clock times are read as UTC."""
    if dict(df.dtypes)[col] != "timestamp_ntz":
        return df
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(col))
    return df.withColumn(col, local.cast("timestamp"))


def wall_clock(col: str) -> Column:
    """An instant as UTC wall-clock time."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(col).cast("timestamp_ntz")).alias(col)


def read_stream(spark: SparkSession, folder: str, file_name: str) -> DataFrame:
    """Stream over a Parquet table in a folder, one file or a folder of files; schema taken from it."""
    path = os.path.join(folder, file_name)
    source = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_folder(spark, path):
        return source.parquet(path)
    # Spark streams folders or patterns; as a pattern the name stands for the one file.
    return source.option("basePath", folder).parquet(os.path.join(folder, f"{{{file_name}}}"))


def run_once(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that is available now and stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


# --- loads ------------------------------------------------------------------------------

def append_loads(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Append everything that is available to a Parquet table, row for row, and read the table."""
    run_once(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def to_table(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream to the end into a new table in the shared folder and read it."""
    spark = stream.sparkSession
    return append_loads(stream, fresh_path(spark, name), fresh_path(spark, f"{name}-checkpoint"))


def stream_richest_postings(loads: DataFrame, key: Sequence[str], text_col: str, arrival: str) -> DataFrame:
    """Richest posting per key over all loads."""
    return dedupe_richest(loads, key, text_col, arrival)


# --- keyed tables -------------------------------------------------------------------------

_DAY = 86_400_000_000  # microseconds
_INDEX = StructType().add("key_hash", "long").add("span", "string")


def span_part(df: DataFrame, time_col: str, days: int) -> Column:
    """The span of so many UTC days that holds a time, counted since 1970, as the name of a partition."""
    return F.coalesce(F.floor(epoch_micros(df, time_col) / F.lit(_DAY * days)).cast("string"), F.lit("none"))


@dataclass(frozen=True)
class Keyed:
    """Which row of a key counts: the first in ``order``, a function of the columns.

    Rows are stored by spans of ``span_days`` days. ``moves``: copies of a key can fall into different
    spans. It is false where the time is part of the key; then no index is needed. With ``expire_days``
    rows go once their whole span lies that far behind the newest one.
    """

    keys: Sequence[str]
    time_col: str
    order: Callable[[Sequence[str]], list[Column]]
    moves: bool = True
    expire_days: int | None = None
    span_days: int = 7

    def expired(self, spans: set[str]) -> Callable[[str], bool]:
        """Which spans have expired once these are stored."""
        if self.expire_days is None:
            return lambda span: False
        first = max((int(p) for p in spans if p != "none"), default=0) * self.span_days - self.expire_days
        return lambda span: span == "none" or (int(span) + 1) * self.span_days <= first


def earliest(keys: Sequence[str], time_col: str, moves: bool = True) -> Keyed:
    """The earliest row per key; equal times are settled by content."""
    return Keyed(keys, time_col, lambda columns: [F.asc_nulls_last(time_col), F.xxhash64(*columns)], moves)


def postings(time_col: str, key: Sequence[str] = ("workspace", "source", "source_job_id")) -> Keyed:
    """First posting per key; weekly loads overlap and old postings come late."""
    return earliest(key, time_col)


def replies(id_col: str = "reply_id", time_col: str = "replied_at") -> Keyed:
    """Replies once per provider id."""
    return earliest([id_col], time_col)


def sends(time_col: str = "sent_at") -> Keyed:
    """Sends once under the key that ``with_send_id`` makes; the time is part of it."""
    return earliest(["send_id"], time_col, moves=False)


def with_send_id(loads: DataFrame, time_col: str = "sent_at") -> DataFrame:
    """Sends with a key made of their own fields, so that a repeated load adds nothing."""
    return loads.withColumn("send_id", send_key(F.col("workspace"), F.col("lead_email"), F.col("campaign_id"), F.col("step"),
                                                epoch_micros(loads, time_col)))


def touches(expire_days: int = 90) -> Keyed:
    """Latest touch per lead. It goes once it has expired, as does any send that comes later still."""
    newest = [F.desc("sent_at"), F.desc("campaign_id"), F.desc("step")]
    return Keyed(["workspace", "lead_email"], "sent_at", lambda columns: [*newest, F.xxhash64(*columns)], True, expire_days)


def keep_best(store: Store, batch: DataFrame, number: int, keyed: Keyed, buckets: int = 16) -> None:
    """Fold a batch into the table ``current`` of one row per key.

    Read and replaced are the spans of the batch's rows, and those under which the index knows their
    keys: a key's stored row and its new ones meet, and the best stays under its own span. The
    spans of a batch are listed on the driver, one string for each.
    """
    schema, base = batch.schema, store.snapshot(number)
    fresh = batch.withColumn(PART, span_part(batch, keyed.time_col, keyed.span_days))
    fresh = written(best_per_key(fresh, keyed.keys, keyed.order(batch.columns)), "fresh")
    hashed = fresh.select(F.xxhash64(*keyed.keys).alias("key_hash"), F.col(PART).alias("span"))
    bucket = F.pmod(F.col("key_hash"), F.lit(buckets)).cast("string")
    # Some spans and at most ``buckets`` numbers.
    spans, touched = map(set, hashed.agg(F.collect_set("span"), F.collect_set(bucket)).first())
    changes = {}
    if keyed.moves:
        index = base.read("index", _INDEX, touched)
        if touched & base.parts("index"):
            met = index.join(hashed.select("key_hash"), "key_hash", "left_semi")
            spans |= set(met.agg(F.collect_set("span")).first()[0])
        # An entry that is out of date costs a read and changes nothing.
        known = index.unionByName(hashed.withColumn(PART, bucket)).distinct()
    expired = keyed.expired(spans | base.parts("current"))
    gone = sorted(p for p in spans if expired(p))
    best = fresh
    if spans & base.parts("current"):
        best = best_per_key(base.read("current", schema, spans).unionByName(fresh), keyed.keys, keyed.order(batch.columns))
    changes["current"] = (best.where(~F.col(PART).isin(gone)), spans)
    if keyed.moves:
        changes["index"] = (known.where(~F.col("span").isin(gone)), touched)
    store.commit(number, base, changes, drop=lambda table, part: table == "current" and expired(part))


def fold(stream: DataFrame, store: Store, checkpoint: str, into: Callable[[Store, DataFrame, int], None]) -> None:
    """Fold everything that is available into the store, each batch once."""
    def apply(batch: DataFrame, number: int) -> None:
        at = Store(batch.sparkSession, store.path)
        if not at.applied(number):
            into(at, batch, number)

    run_once(stream.writeStream.foreachBatch(apply), checkpoint)


def ingest(stream: DataFrame, store: Store, checkpoint: str, keyed: Keyed) -> DataFrame:
    """Fold a stream into a keyed table and read it."""
    fold(stream, store, checkpoint, lambda at, batch, number: keep_best(at, batch, number, keyed))
    return current(store, stream.schema)


def to_keyed(stream: DataFrame, name: str, keyed: Keyed) -> Store:
    """Run a stream to the end into a new store in the shared folder."""
    spark = stream.sparkSession
    store = Store(spark, fresh_path(spark, name))
    ingest(stream, store, fresh_path(spark, f"{name}-checkpoint"), keyed)
    return store


def current(store: Store, schema: StructType) -> DataFrame:
    """The row of every key."""
    return store.read("current", schema).drop(PART)


def live_contacts(leads: DataFrame, as_of: Column, expire_days: int = 90) -> DataFrame:
    """Latest touch (a row per lead) of the leads touched in the last ``expire_days``; others count as never touched."""
    return leads.where(F.col("sent_at") > as_of - F.make_dt_interval(F.lit(expire_days)))


# --- rates --------------------------------------------------------------------------------

PANES = StructType().add("day", "long").add("campaign_id", "long").add("sent", "long").add("replies", "long").add("bounces", "long")


def count_panes(store: Store, batch: DataFrame, number: int) -> None:
    """Add a batch of events (ts, kind, campaign_id) to the counts per campaign and UTC day.

    Events count however late they come: only the weeks of the batch are read and replaced.
    """
    day = F.floor(epoch_micros(batch, "ts") / F.lit(_DAY))
    new = batch.where("ts IS NOT NULL").groupBy(day.alias("day"), F.col("campaign_id").cast("long").alias("campaign_id")).agg(
        F.count_if(F.col("kind") == "sent").alias("sent"), F.count_if(F.col("kind") == "replied").alias("replies"),
        F.count_if(F.col("kind") == "bounced").alias("bounces"))
    new = written(new.withColumn(PART, F.floor(F.col("day") / 7).cast("string")), "panes")
    weeks = {r[PART] for r in new.select(PART).distinct().collect()}
    base = store.snapshot(number)
    both = base.read("panes", PANES, weeks).unionByName(new)
    counts = both.groupBy(PART, "day", "campaign_id").agg(*[F.sum(c).alias(c) for c in ("sent", "replies", "bounces")])
    store.commit(number, base, {"panes": (counts, weeks)})


def to_panes(events: DataFrame, name: str) -> DataFrame:
    """Counts per campaign and day of a whole stream."""
    spark = events.sparkSession
    store = Store(spark, fresh_path(spark, name))
    fold(events, store, fresh_path(spark, f"{name}-checkpoint"), count_panes)
    return store.read("panes", PANES)


def span_rates(panes: DataFrame, days: int = 7, step: int = 7) -> DataFrame:
    """Reply and bounce rates per campaign and span of ``days`` days, one every ``step`` days, from counts per day.

    Spans start at multiples of ``step`` since 1970; those of the running days are included.
    """
    # The spans that hold a day start at the last multiple of the step, and up to a span before.
    start = F.floor(F.col("day") / step) * step
    backs = [F.lit(b) for b in range(0, days, step)]
    spans = panes.withColumn("start", F.explode(F.array(*[start - b for b in backs]))).where(F.col("day") < F.col("start") + days)
    counted = spans.groupBy("start", "campaign_id").agg(*[F.sum(c).alias(c) for c in ("sent", "replies", "bounces")])

    def midnight(day: Column) -> Column:
        return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(day.cast("int"))

    return counted.select(
        midnight(F.col("start")).alias("window_start"), midnight(F.col("start") + days).alias("window_end"),
        "campaign_id", "sent", "replies", "bounces", round_half_up(ratio(F.col("replies"), F.col("sent"), 100.0), 2).alias("reply_pct"),
        round_half_up(ratio(F.col("bounces"), F.col("sent"), 100.0), 2).alias("bounce_pct"))


def weekly_rates(panes: DataFrame) -> DataFrame:
    """Rates per campaign and calendar span of seven days."""
    return span_rates(panes, 7, 7)


def trailing_rates(panes: DataFrame, days: int = 7) -> DataFrame:
    """Rates over the last ``days`` days, one span per day."""
    return span_rates(panes, days, 1)


# --- profile queue ------------------------------------------------------------------------

def domain_part(buckets: int) -> Column:
    return F.pmod(F.xxhash64("domain"), F.lit(buckets)).cast("string")


def open_queue(store: Store, queue: DataFrame, buckets: int = 64) -> None:
    """Store a queue as it stands before the first batch."""
    store.commit(-1, store.snapshot(-1), {"queue": (queue.withColumn(PART, domain_part(buckets)), map(str, range(buckets)))})


def sync_queue(store: Store, crawls: DataFrame, number: int, schema: StructType, now: Column, buckets: int = 64) -> None:
    """The queue after a batch of crawls: only the buckets of the crawled domains are read and replaced.

    A batch number that comes again changes nothing (``fold``).
    """
    parts = [r[PART] for r in crawls.select(domain_part(buckets).alias(PART)).distinct().collect()]
    base = store.snapshot(number)
    after = sync_profile_queue(base.read("queue", schema, parts).drop(PART), crawls, now)
    store.commit(number, base, {"queue": (after.withColumn(PART, domain_part(buckets)), parts)})


# --- replies and postings ---------------------------------------------------------------

def late_replies(sends: DataFrame, replies: DataFrame, days: int = 21, lead: str = "lead",
                 campaign: str = "campaign_id") -> DataFrame:
    """Sends (event_id, sent_at) with the replies (event_id, replied_at) that they earned, over all loads.

    A reply belongs to the latest send of its lead and campaign before it, if that lies at
    most ``days`` back; a send without replies stays with a null ``reply_event``. One pass in
    order of time finds the send, so no pairs are formed; a lead's events in one campaign are
    a short sequence. Events without a lead or campaign meet nothing.
    """
    def side(df: DataFrame, time_col: str, is_reply: int) -> DataFrame:
        return df.where(F.col(lead).isNotNull() & F.col(campaign).isNotNull()).select(
            F.col(lead).alias("lead"), F.col(campaign).alias("campaign"), F.col(time_col).alias("at"),
            F.lit(is_reply).alias("is_reply"), "event_id")
    order = Window.partitionBy("lead", "campaign").orderBy("at", "is_reply", "event_id") \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    send = F.last(F.when(F.col("is_reply") == 0, F.struct(F.col("event_id").alias("id"), F.col("at"))),
                  ignorenulls=True).over(order)
    earned = side(sends, "sent_at", 0).unionByName(side(replies, "replied_at", 1)).withColumn("send", send) \
        .where((F.col("is_reply") == 1) & (F.col("at") <= F.col("send.at") + F.expr(f"INTERVAL {int(days)} DAYS"))) \
        .select(F.col("send.id").alias("_send"), F.col("event_id").alias("reply_event"), F.col("at").alias("replied_at"))
    return sends.join(earned, F.col("event_id") == F.col("_send"), "left").drop("_send")


def refresh_late_replies(results: Store, sends: Store, replies: Store, send_schema: StructType, reply_schema: StructType,
                         days: int = 21, span_days: int = 7) -> DataFrame:
    """Bring the table ``earned`` up to date with two keyed stores, and read it.

    The manifest of the results names the versions it was made from, so the spans whose sends or replies
    have changed are known. A change in a span concerns sends of that span and of the ``days`` before
    it, and these need the replies and sends of the ``days`` after them: a load reads the spans around
    its own, months old or new, and no others. Both stores have spans of ``span_days`` days.
    """
    base, at = results.snapshot(), {"sends": sends.snapshot(), "replies": replies.snapshot()}
    notes = {(f"seen-{name}", p): v for name, now in at.items() for (t, p), v in now.versions.items() if t == "current"}
    before = {k: v for k, v in base.versions.items() if k[0].startswith("seen-")}
    changed = {k[1] for k in set(notes) | set(before) if notes.get(k) != before.get(k)}
    reach = range(-(-days // span_days) + 1)
    wanted = {str(int(p) - back) for p in changed if p != "none" for back in reach} | (changed & {"none"})
    around = {str(int(p) + ahead) for p in wanted if p != "none" for ahead in reach} | (changed & {"none"})
    earned = late_replies(at["sends"].read("current", send_schema, around),
                          at["replies"].read("current", reply_schema, around).drop(PART), days)
    number = 0 if base.number is None else base.number + 1
    results.commit(number, base, {"earned": (earned.where(F.col(PART).isin(sorted(wanted))), wanted)}, notes)
    return results.read("earned", earned.schema).drop(PART)


def freshness_stream(postings: DataFrame, time_col: str, as_of: Column, days: int = 7) -> DataFrame:
    """Only postings of the last ``days`` before ``as_of``."""
    return postings.where(F.col(time_col).between(as_of - F.make_dt_interval(F.lit(days)), as_of))
