"""Streaming jobs over several small batches."""

import datetime
import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from leadgrid.operators import crawl
from leadgrid.session import fresh_path
from leadgrid.streaming import jobs
from leadgrid.streaming.store import PART, Snapshot, Store


def feed(spark, path, records, schema):
    spark.createDataFrame(records, schema).coalesce(1).write.mode("append").parquet(path)


def day(n):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n - 1)


@pytest.fixture
def places(spark):
    """Paths of a source, a store and a checkpoint."""
    return [fresh_path(spark, n) for n in ("src", "store", "cp")]


def ingest(spark, places, loads, schema, keyed, prepare=lambda df: df):
    src, path, cp = places
    for load in loads:
        feed(spark, src, load, schema)
        jobs.ingest(prepare(spark.readStream.schema(schema).parquet(src)), Store(spark, path), cp, keyed)
    whole = prepare(spark.createDataFrame([], schema)).schema
    return jobs.current(Store(spark, path), whole)


@pytest.fixture
def reads(monkeypatch):
    """Which partitions of which table were read."""
    seen, plain = [], Snapshot.read

    def read(self, table, schema, parts=None):
        found = plain(self, table, schema, parts)
        files = {f.split(f"{PART}=")[1].split("/")[0] for f in found.inputFiles()} if self.versions else set()
        seen.append((table, files))
        return found

    monkeypatch.setattr(Snapshot, "read", read)
    return seen


REPLIES = "reply_id string, replied_at timestamp, body string"


def test_late_and_repeated_replies_are_kept_once(spark, places):
    # An old reply comes last, and one that came long ago comes again under another time.
    loads = [[("a", day(1), "x")], [("b", day(200), "y")], [("old", day(40), "late"), ("c", day(201), "z"), ("a", day(300), "x"), ("c", day(201), "z")],
             [("b", day(90), "earlier"), (None, None, "no id"), (None, None, "no id")]]
    got = ingest(spark, places, loads, REPLIES, jobs.replies())
    assert rows(got.select("reply_id", "body")) == [("a", "x"), ("b", "earlier"), ("c", "z"), ("old", "late"), (None, "no id")]


def test_a_load_reads_the_spans_it_touches_only(spark, places, reads):
    loads = [[(str(n), day(n), "x") for n in range(1, 200)]]
    ingest(spark, places, loads, REPLIES, jobs.replies())
    reads.clear()
    got = ingest(spark, places, [[("new", day(150), "y"), ("7", day(151), "later copy"), ("90", day(20), "earlier copy")]], REPLIES, jobs.replies())
    # The load is read by the second of these; the others read the whole table.
    spans = [{int(p) for p in ps} for t, ps in reads if t == "current"]
    assert sorted(map(len, spans))[0] == 5 and {(day(n) - datetime.datetime(1970, 1, 1)).days // 7 for n in (150, 151, 20, 7, 90)} in spans
    assert got.count() == 200
    assert rows(got.where("reply_id in ('7', '90')").select("reply_id", "body")) == [("7", "x"), ("90", "earlier copy")]


def test_late_and_repeated_postings_and_sends(spark, places):
    schema = "workspace string, source string, source_job_id string, seen timestamp, text string"
    loads = [[("w", "s", "1", day(100), "long text")], [("w", "s", "2", day(3), "t")], [("w", "s", "1", day(2), "short"), ("w", "s", "1", day(300), "again")]]
    got = ingest(spark, places, loads, schema, jobs.postings("seen"))
    assert rows(got.select("source_job_id", "text")) == [("1", "short"), ("2", "t")]
    table = spark.createDataFrame([r for load in loads for r in load], schema)
    richest = jobs.stream_richest_postings(table.withColumn("n", F.lit(1)), ["source_job_id"], "text", "n")
    assert rows(richest.select("source_job_id", "text")) == [("1", "long text"), ("2", "t")]
    schema = "workspace string, lead_email string, campaign_id long, step int, sent_at timestamp"
    loads = [[("w", "a", 1, 1, day(90))], [("w", "a", 1, 1, day(2))], [("w", "a", 1, 1, day(90)), ("w", "a", 1, 2, day(90)), ("w", "a", 1, 2, None)]]
    more = [fresh_path(spark, n) for n in ("src", "store", "cp")]
    assert ingest(spark, more, loads, schema, jobs.sends(), jobs.with_send_id).count() == 4


def test_a_batch_that_failed_or_comes_again_changes_nothing(spark, places):
    src, path, _ = places
    feed(spark, src, [("a", day(5), "x"), ("b", day(6), "y")], REPLIES)
    first, second = (spark.createDataFrame(r, REPLIES) for r in ([("a", day(5), "x")], [("a", day(1), "earlier"), ("b", day(60), "y")]))
    store = Store(spark, path)
    jobs.keep_best(store, first, 0, jobs.replies())
    jobs.keep_best(store, second, 1, jobs.replies())
    once = rows(jobs.current(store, first.schema))
    # The first batch of a new checkpoint is number 0, which the store has seen.
    jobs.fold(spark.readStream.schema(REPLIES).parquet(src), store, fresh_path(spark, "cp"), lambda at, b, n: jobs.keep_best(at, b, n, jobs.replies()))
    assert rows(jobs.current(store, first.schema)) == once
    # Files of a batch that never wrote its manifest are not seen, and are replaced when it comes again.
    third = spark.createDataFrame([("c", day(7), "z")], REPLIES)
    third.withColumn(PART, F.lit("2800")).write.partitionBy(PART).parquet(f"{path}/current/store_batch=2")
    assert rows(jobs.current(store, first.schema)) == once
    jobs.keep_best(store, third, 2, jobs.replies())
    assert len(rows(jobs.current(store, first.schema))) == 3


def test_send_ids_do_not_follow_the_session_time_zone(spark):
    df = spark.createDataFrame([("w", "a", 1, 1, day(2))], "workspace string, lead_email string, campaign_id long, step int, sent_at timestamp") \
              .withColumn("wall", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")).cache()
    df.count()
    found = set()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/Mexico_City"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for col in ("sent_at", "wall"):
                found.add((col, jobs.with_send_id(df, col).first()["send_id"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(found) == 2


EVENTS = "ts timestamp, kind string, campaign_id long"


def panes(spark, places, loads):
    src, path, cp = places
    for load in loads:
        feed(spark, src, load, EVENTS)
        jobs.fold(spark.readStream.schema(EVENTS).parquet(src), Store(spark, path), cp, jobs.count_panes)
    return Store(spark, path).read("panes", jobs.PANES)


def test_rates_hold_the_running_spans_and_later_events(spark, places):
    got = panes(spark, places, [[(day(5), "sent", 1), (day(6), "sent", 1)], [(day(7), "replied", 1), (day(12), "sent", 1)]])
    assert sorted((r["sent"], r["replies"], r["reply_pct"]) for r in jobs.weekly_rates(got).collect()) == [(1, 0, 0.0), (2, 1, 50.0)]


@pytest.mark.parametrize("rates, spans", [(jobs.weekly_rates, 1), (jobs.trailing_rates, 7)])
def test_rates_add_a_load_that_is_months_old(spark, places, reads, rates, spans):
    loads = [[(day(5), "sent", 1), (day(5), "sent", 1)], [(day(200), "sent", 1)], [(day(201), "sent", 2), (None, "sent", 3)],
             [(day(5), "replied", 1), (day(40), "sent", 1), (day(40), "bounced", 1)]]
    kept = panes(spark, places, loads)
    assert kept.count() == 4  # a row a campaign and day, whatever the spans
    assert [len(files) for t, files in reads] == [0, 0, 1, 1, 3]  # the read above sees three weeks
    got = [(r["campaign_id"], r["sent"], r["replies"], r["bounces"]) for r in rates(kept).collect()]
    assert sorted(got) == sorted([(1, 2, 1, 0), (1, 1, 0, 0), (2, 1, 0, 0), (1, 1, 0, 1)] * spans)


def test_folders_do_not_pile_up(spark, places):
    src, path, cp = places
    store = Store(spark, path)
    for n in range(50):
        jobs.count_panes(store, spark.createDataFrame([(day(12 + n % 5), "sent", 1)], EVENTS), n)
    kept = store.read("panes", jobs.PANES)
    assert kept.agg(F.sum("sent")).first()[0] == 50
    assert len({os.path.dirname(f) for f in kept.inputFiles()}) <= 2
    assert len(os.listdir(f"{path}/panes")) <= 2 and len([f for f in os.listdir(f"{path}/manifest") if f.endswith(".json")]) == 2


def test_contact_state_keeps_one_row_a_lead_and_expires(spark, places):
    schema = "workspace string, lead_email string, campaign_id long, step int, sent_at timestamp"
    loads = [[("w", "a", 1, 1, day(1)), ("w", "b", 1, 1, day(2))],
             [("w", "a", 2, 1, day(20)), ("w", "b", 9, 1, day(1)), ("w", "c", 3, 1, day(19)), ("w", "none", 1, 1, None)]]
    leads = ingest(spark, places, loads, schema, jobs.touches(90))
    everyone = jobs.live_contacts(leads, F.lit(day(21)), 90)
    assert rows(everyone.select("lead_email", "campaign_id")) == [("a", 2), ("b", 1), ("c", 3)] and leads.count() == 3
    assert rows(jobs.live_contacts(leads, F.lit(day(21)), 10).select("lead_email")) == [("a",), ("c",)]
    leads = ingest(spark, places, [[("w", "d", 1, 1, day(200)), ("w", "late", 1, 1, day(30))]], schema, jobs.touches(90))
    assert rows(leads.select("lead_email")) == [("d",)]
    snapshot = Store(spark, places[1]).snapshot()
    assert len(snapshot.parts("current")) == 1


def test_the_queue_reads_the_buckets_of_its_crawls_only(spark, places, reads):
    src, path, cp = places
    queue = spark.createDataFrame([(f"d{i}", "accepted", None, True, 1, "h", "h", day(1), True, day(1), "boom", day(1)) for i in range(300)],
                                  crawl.QUEUE_SCHEMA)
    store, now = Store(spark, path), F.lit(day(9)).cast("timestamp")
    jobs.open_queue(store, queue)
    schema = "domain string, ok boolean, clean_text string, crawled_at timestamp"
    feed(spark, src, [("d1", True, "long text " * 50, day(3)), ("d1", True, "long text " * 50, day(3)), ("fresh", True, "long text " * 50, day(3))], schema)
    crawls = spark.readStream.schema(schema).parquet(src)
    for checkpoint in (cp, fresh_path(spark, "cp")):  # the second run repeats batch 0
        jobs.fold(crawls, store, checkpoint, lambda at, b, n: jobs.sync_queue(at, b, n, queue.schema, now))
    assert len(reads) == 1 and len(reads[0][1]) <= 2
    after = store.read("queue", queue.schema)
    assert after.count() == 301
    assert rows(after.where("updated_at > '2024-01-05'").select("domain", "profile_status")) == [("d1", "stale"), ("fresh", "pending")]
    whole = crawl.sync_profile_queue(queue, spark.read.parquet(src), now)
    assert rows(after.select(*whole.columns)) == rows(whole)


def test_late_replies_are_refreshed_around_a_load(spark, reads):
    send_schema, reply_schema = ("event_id long, lead long, campaign_id long, {} timestamp".format(t) for t in ("sent_at", "replied_at"))
    rng = random.Random(1)
    sends = [(i, rng.randrange(4), rng.randrange(2), day(rng.randrange(1, 250))) for i in range(300)] + [(999, None, 1, day(5))]
    replies = [(1000 + i, rng.randrange(4), rng.randrange(2), day(rng.randrange(1, 280))) for i in range(300)]
    stores = [Store(spark, fresh_path(spark, n)) for n in ("sends", "replies", "earned")]
    schemas = [spark.createDataFrame([], s).schema for s in (send_schema, reply_schema)]
    # Most rows, then a late send, then a reply that is months late and a new one.
    late_send, late_reply = [(5000, 1, 1, day(60))], [(6000, 1, 1, day(61)), (6001, 2, 0, day(279))]
    for number, (s, r) in enumerate([(sends, replies), (late_send, []), ([], late_reply)]):
        for store, load, schema, time in zip(stores, (s, r), schemas, ("sent_at", "replied_at")):
            jobs.keep_best(store, spark.createDataFrame(load, schema), number, jobs.earliest(["event_id"], time))
        reads.clear()
        found = jobs.refresh_late_replies(stores[2], stores[0], stores[1], *schemas)
        if number == 1:
            assert all(len(files) <= 7 for table, files in reads if table == "current")
    whole = jobs.late_replies(spark.createDataFrame(sends + late_send, schemas[0]), spark.createDataFrame(replies + late_reply, schemas[1]))
    assert rows(found.select(*whole.columns)) == rows(whole)
    assert 6000 in {r["reply_event"] for r in found.collect()}


def test_each_reply_belongs_to_the_latest_send_before_it(spark):
    schema = "event_id long, lead long, campaign_id long, {} timestamp"
    sends = spark.createDataFrame([(1, 1, 1, day(1)), (2, 1, 1, day(5)), (3, 2, 1, day(1)), (4, None, 1, day(1))], schema.format("sent_at"))
    replies = spark.createDataFrame([(10, 1, 1, day(6)), (11, 1, 1, day(7)), (12, 2, 1, day(23)), (13, 9, 1, day(2)), (14, None, 1, day(2)),
                                     (15, 1, 1, day(5))], schema.format("replied_at"))
    got = rows(jobs.late_replies(sends, replies, 21).select("event_id", "reply_event"))
    assert got == [(1, None), (2, 10), (2, 11), (2, 15), (3, None), (4, None)]


def test_a_stream_reads_a_table_that_is_one_file_or_a_folder(spark, tmp_path):
    table = spark.createDataFrame([(n, "ab"[n % 2]) for n in range(60)], "id int, kind string").repartition(3)
    table.write.parquet(str(tmp_path / "files.parquet"))
    table.write.partitionBy("kind").parquet(str(tmp_path / "kinds.parquet"))
    table.toPandas().to_parquet(tmp_path / "one.parquet")
    for name in ("files", "kinds", "one"):
        got = jobs.to_table(jobs.read_stream(spark, str(tmp_path), f"{name}.parquet"), "whole")
        assert rows(got.select("id", "kind")) == rows(table), name
