"""Operators on hand-made rows: the behaviours that must not change."""

import datetime
import json
import random
import tracemalloc

import pytest
import verify
from conftest import rows
from pyspark.sql import functions as F

from leadgrid.operators import contacts, crawl, delivery, entity, grouping, lists, pages, rules, signals, validate
from leadgrid.plans import q_pages
from leadgrid.plans.q_signals import RULES
from leadgrid.plans.registry import REGISTRY
from leadgrid.session import fresh_path
from leadgrid.sources import files, json_items, tables


def ntz(text):
    return F.lit(text).cast("timestamp_ntz")


# --- postings ------------------------------------------------------------------

BASIC = signals.SignalRules("main", "board", positive=["outbound", "cold call", "cold calling"], negative=["retail store"],
                            hidden=["our client is looking"], locations=[("north", "must be based in the north")])


def posting(spark, **given):
    schema = ("id string, jobId string, link string, title string, jobTitle string, companyName string, companyWebsite string, "
              "companyEmployeesCount string, descriptionText string, companyAddress string, industries array<string>, postedAt string")
    names = [p.split()[0] for p in schema.split(", ")]
    return spark.createDataFrame([tuple(given.get(n) for n in names)], schema)


def test_normalize_job_priorities(spark):
    def job(**given):
        return signals.normalize_job(posting(spark, **given), BASIC).first()
    both = job(id="1", title="SDR", descriptionText="You do cold calling.", companyWebsite="https://www.x.com/about", companyEmployeesCount="18 employees")
    assert both["prefilter_priority"] == "high" and both["company_domain"] == "x.com" and both["company_employee_count"] == 18
    assert job(id="1", descriptionText="outbound")["prefilter_priority"] == "medium"
    only_bad = job(id="1", descriptionText="Work in a retail store")
    assert (only_bad["prefilter_priority"], only_bad["fit"]) == ("low", "unreviewed")
    assert job(id="1", descriptionText="Nothing")["prefilter_priority"] == "review"
    hidden = job(id="1", descriptionText="Our client is looking for outbound cold calling. Must be based in the north.")
    assert (hidden["prefilter_priority"], hidden["employer_confidence"], hidden["campaign_action"]) == ("low", "hidden", "hold")
    assert hidden["job_location_requirement"] == "north" and hidden["company_region_fit"] == "unreviewed"
    assert "hidden_employer" in hidden["prefilter_reasons"]


def test_normalize_job_without_id_or_text(spark):
    out = signals.normalize_job(posting(spark, jobTitle="SDR", id=" "), BASIC)
    row = out.first()
    assert row["source_job_id"].startswith("hash:") and len(row["source_job_id"]) == 29
    assert row["description_text"] is None and row["role_title"] == "SDR"
    assert len(out.columns) >= 41


def test_richest_posting_wins_and_first_wins_ties(spark):
    df = spark.createDataFrame([("a", "short", 1), ("a", "much longer", 2), ("a", "same length", 3), ("b", None, 4)], "k string, t string, n int")
    assert rows(signals.dedupe_richest(df, ["k"], "t", "n")) == [("a", "much longer", 2), ("b", None, 4)]


def test_company_review_merges_postings(spark):
    base = dict(companyName="Acme", descriptionText="The that tion outbound pipeline heon. " * 3)
    raw = posting(spark, id="1", title="A", postedAt="2024-01-01", **base).unionByName(
        posting(spark, id="2", title="B", postedAt="2024-02-01", companyName="ACME ", descriptionText="the that tion heon")).withColumn(
        "arrival", F.monotonically_increasing_id())
    row = signals.company_review(signals.normalize_job(raw, RULES), RULES).collect()
    assert len(row) == 1 and row[0]["job_count"] == 2 and row[0]["source_job_id"] == "1"
    assert row[0]["latest_posted_at"].startswith("2024-02-01") and row[0]["flag_missing_domain"]
    assert "2 postings merged" in row[0]["automatic_warnings"]


@pytest.mark.parametrize("given,status", [
    (("no_fit", "high", "unreviewed", "unreviewed", "likely", "review", True), "qualified"),
    (("high", "high", "high", "home", "verified", "contact", False), "ready_for_contact"),
    (("high", "high", "high", "foreign", "verified", "exclude", False), "not_fit"),
    (("high", "low", "high", "home", "verified", "contact", False), "ready_for_contact"),
    (("unreviewed", "unreviewed", "high", "home", "verified", "contact", False), "not_fit")])
def test_status_gate(spark, given, status):
    cols = [F.lit(v) for v in given]
    assert spark.range(1).select(signals.pipeline_status(*cols).alias("s")).first()["s"] == status


def test_term_join_equals_a_padded_contains(spark):
    random.seed(3)
    texts = spark.createDataFrame([(i, "".join(random.choice("abc -") for _ in range(40))) for i in range(60)], "id int, t string")
    terms = spark.createDataFrame([("".join(random.choice("ABC ") for _ in range(random.randint(1, 6))),) for _ in range(80)], "term string")
    def padded(c):
        return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(c), "[^a-z]+", " ")), F.lit(" "))
    flat, spelled = texts.select("id", padded("t").alias("p")), terms.select(padded("term").alias("q")).distinct().where("trim(q) <> ''")
    want = rows(flat.join(spelled, F.contains("p", "q")).select("id", F.trim("q").alias("term")))
    assert rows(signals.term_join(texts, "id", "t", terms, "term")) == want


# --- people ----------------------------------------------------------------------

RANKS = {"small": ["founder"], "leaders": ["head of sales"], "words": ["sales"]}
PEOPLE = "id string, company_id int, title string, email string, email_status string, linkedin_url string, do_not_contact boolean, last_contacted_at timestamp_ntz"


def people(spark, *given):
    df = spark.createDataFrame([g[:-1] + (None,) for g in given], PEOPLE)
    days = {g[0]: g[-1] for g in given}
    pairs = [F.lit(x) for k, v in days.items() if v for x in (k, v)]
    return df.withColumn("last_contacted_at", F.try_element_at(F.create_map(*pairs), F.col("id")).cast("timestamp_ntz")) if pairs else df


def test_verified_mail_beats_linkedin_and_rank(spark):
    df = people(spark, ("a", 1, "Founder", None, None, "l", False, None), ("b", 1, "Clerk", "x@y", "Verified", None, False, None))
    found = contacts.contact_candidates(df, ntz("2024-06-01"), 90, ["verified"])
    best = contacts.choose_contact(found, ["company_id"], contacts.title_rank(F.col("title"), F.lit(True), *RANKS.values()), "id").collect()
    assert [(r["id"], r["channel"]) for r in best] == [("b", "email")]


def test_recent_or_blocked_people_are_left_out(spark):
    df = people(spark, ("a", 1, "", "x@y", "verified", None, True, None), ("b", 1, "", "x@y", "verified", None, False, "2024-05-31"),
                ("c", 1, "", "x@y", "verified", None, False, "2024-03-03"), ("d", 1, "", "x@y", "verified", None, False, "2024-03-04"))
    found = contacts.contact_candidates(df, ntz("2024-06-01"), 90, ["verified"])
    assert [r["id"] for r in found.collect()] == ["c"]  # exactly 90 days ago is allowed


def test_title_rank(spark):
    def rank(title, small):
        return spark.range(1).select(contacts.title_rank(F.lit(title), F.lit(small), *RANKS.values()).alias("r")).first()["r"]
    assert [rank("Founder", True), rank("Founder", False), rank("Founder", None)] == [100, 70, 70]
    assert [rank("Head of Sales", None), rank("Sales rep", True), rank("", True), rank("Cook", True)] == [100, 30, 0, 0]


def greedy(records):
    seen, kept = [set(), set()], []
    for n, *ks in records:
        if any(k and k in s for k, s in zip(ks, seen)):
            continue
        for k, s in zip(ks, seen):
            if k:
                s.add(k)
        kept.append(n)
    return kept


@pytest.mark.parametrize("seed,size,span", [(1, 200, 40), (2, 300, 400), (3, 120, 6)])
def test_dedupe_either_key_equals_sequential_pass(spark, seed, size, span):
    random.seed(seed)
    records = [(i, random.choice([None, "", *[f"l{k}" for k in range(span)]]), random.choice([None, *[f"e{k}" for k in range(span)]]))
               for i in range(size)]
    df = spark.createDataFrame(records, "n int, li string, em string")
    assert sorted(r["n"] for r in contacts.dedupe_either_key(df, "n", ["li", "em"]).collect()) == greedy(records)


def test_dedupe_either_key_chain_and_hot_key(spark):
    chain = [(i, f"l{i // 2}", f"e{(i + 1) // 2}") for i in range(12)]
    hot = [(100 + i, "hot", f"h{i}") for i in range(50)]
    df = spark.createDataFrame(chain + hot, "n int, li string, em string")
    assert sorted(r["n"] for r in contacts.dedupe_either_key(df, "n", ["li", "em"]).collect()) == greedy(chain + hot)


def test_suppress_and_kept_are_the_whole(spark):
    leads = spark.createDataFrame([(i,) for i in range(20)], "lead int")
    sends = spark.createDataFrame([(i % 7, f"2024-01-{i + 1:02d}") for i in range(14)], "lead int, day string").withColumn("sent_at", F.col("day").cast("timestamp_ntz"))
    kept = contacts.suppress_contacted(leads, sends, "lead", ntz("2024-01-14"), 5)
    gone = leads.join(sends.where(F.col("sent_at") > ntz("2024-01-09")), "lead", "left_semi")
    assert kept.count() + gone.count() == 20


def test_unknown_search_filter_is_refused(spark):
    with pytest.raises(ValueError):
        contacts.contact_search(spark.range(1), {"nope": 1}, {})


# --- entity ------------------------------------------------------------------------

def test_merge_rules(spark):
    base = spark.createDataFrame([("a", "A", 1, True, ["x"]), ("b", None, None, None, None)], "k string, name string, n int, flag boolean, tags array<string>")
    other = spark.createDataFrame([("b", "B", 2, False, ["z", "y"]), ("c", "C", 3, None, ["y"]), ("a", "ZZ", 9, False, ["x", "w"])], base.schema)
    out = entity.merge_sources(base, other, "k", {"n": "prefer", "flag": "or", "tags": "union"})
    assert rows(out) == [("a", "A", 9, True, ["w", "x"]), ("b", "B", 2, False, ["y", "z"]), ("c", "C", 3, False, ["y"])]


def test_best_row_prefers_staff_then_newest(spark):
    df = spark.createDataFrame([("k", 1, None, "2024-02-02"), ("k", 2, 5, "2024-01-01"), ("k", 3, 5, "2024-01-02"), ("k", 4, 5, "2024-01-02")],
                               "nd string, row_id int, staff_linkedin int, updated_at string")
    assert entity.best_row_per_key(df, "nd", "row_id").first()["row_id"] == 3


def test_lead_master_is_unique(spark):
    firms = spark.createDataFrame([("x.mx",)], "domain string")
    folk = spark.createDataFrame([(1, "A@x.mx", "l", "a", "b", "x.mx"), (2, "a@X.mx", None, "c", "d", "x.mx"), (3, None, None, "e", "f", "x.mx"), (4, None, None, None, "f", None)],
                                 "id int, email string, linkedin_url string, first_name string, last_name string, company_domain string")
    out = entity.lead_master(firms, folk)
    assert rows(out.select("master_key", "basis", "n_rows")) == [
        ("domain:x.mx", "domain", 1), ("email:a@x.mx", "email", 2), ("name:e f@x.mx", "name", 1)]


# --- rules ---------------------------------------------------------------------------

def test_company_rules_first_hit_and_refined_reason(spark):
    df = spark.createDataFrame([("Big Warehouse", None), ("Warehouse and Truck", ""), ("Ocean line", None), ("Logistics", None)], "name string, industry string")
    out = rules.classify_company(df, [("store", ["warehouse"], "storage"), ("sea", ["ocean"], "sea")], ["name", "industry"],
                                 {"store": (["truck"], "storage with trucks")})
    assert [(r["bucket"], r["reason"]) for r in out.collect()] == [
        ("store", "storage"), ("store", "storage with trucks"), ("sea", "sea"), ("review", "no strong signal")]


def test_specialist_tie_goes_to_the_earliest(spark):
    df = spark.createDataFrame([("truck warehouse",), ("nothing",)], "name string")
    out = rules.specialist_ensemble(df, [("a", "A", 0.8, ["truck"]), ("b", "B", 0.8, ["warehouse"]), ("c", "C", 0.5, ["truck"])], ["name"])
    assert [(r["bucket"], r["confidence"]) for r in out.collect()] == [("A", 0.8), ("review", 0.2)]


# --- lists ------------------------------------------------------------------------------

LEADS = ("email string, first_name string, last_name string, job_title string, company_domain string, company_industry string, "
         "company_headcount int, email_status string")


def test_scorecard_edges(spark):
    df = spark.createDataFrame([("a@x.mx", "Ana", "Diaz", "Intern", "", "Software", 0, ""), ("", "JOHN", "R2", "Internal Auditor", "", "", 500, ""),
                                ("A@x.mx", "Eva", "Paz", "", "", "", 20, None)], LEADS)
    card = lists.list_scorecard(df, (), ["software"], (10, 100)).first()
    assert card["verification"] == 0 and card["dupes"] == 1 and card["title_relevance"] == -1
    assert card["bad"] == 1 and card["fake"] == 1 and card["icp"] == 1 and card["domains"] == 1
    issues = [r["issue"] for r in lists.list_issues(lists.list_scorecard(df)).collect()]
    assert issues[0].startswith("no verification column") and len(issues) <= 5


def test_load_list_keeps_unknown_values(spark):
    df = spark.createDataFrame([("www.X.mx", "n", "12", "blue"), ("nodot", "m", "1", "x"), ("y.mx", "", "twelve", "")],
                               "domain string, name string, staff string, color string")
    out = lists.load_list_with_meta(df, ["name", "staff_linkedin"], {"staff": "staff_linkedin"}, ["staff_linkedin"])
    assert rows(out) == [("x.mx", "n", 12, {"color": "blue"}), ("y.mx", None, None, {"staff": "twelve"})]


def test_batches_and_shards_cover_everything(spark):
    df = spark.range(1003).withColumn("k", F.col("id") % 3)
    got = lists.assign_batches(df, [F.asc("k"), F.asc("id")], 100)
    assert got.agg(F.max("row_no"), F.count_distinct("row_no"), F.max("batch_id")).first()[:] == (1003, 1003, 10)
    first = got.orderBy("row_no").select("k", "id").collect()
    assert [tuple(r) for r in first] == sorted(((i % 3), i) for i in range(1003))
    shards = df.groupBy(lists.shard(F.col("id"), 4).alias("s")).count()
    assert shards.agg(F.sum("count")).first()[0] == 1003 and shards.count() == 4


def test_lenses_and_overlap(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,)], "k int"), spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert rows(lists.union_lenses({"a": a, "b": b}, "k")) == [("a", 2, 2), ("b", 2, 1)]
    assert lists.overlap(a, b, "k").first()[:] == (2, 2, 1, 3, 1)


# --- delivery -----------------------------------------------------------------------------

def test_campaign_flags_at_the_bounds(spark):
    df = spark.createDataFrame([(1, 199, 1, 0), (2, 200, 1, 0), (3, 200, 2, 0), (4, 49, 1, 9), (5, 50, 1, 2), (6, 1000, 20, 30), (7, 0, 0, 0)],
                               "campaign_id int, sent bigint, replies bigint, bounces bigint")
    out = {r["campaign_id"]: (r["flag_low_reply"], r["flag_high_bounce"]) for r in delivery.campaign_performance(df).collect()}
    assert out == {1: (False, False), 2: (True, False), 3: (False, False), 4: (False, False), 5: (False, True), 6: (False, False), 7: (False, False)}


def test_inbox_reputation(spark):
    df = spark.createDataFrame([("100%", "ACTIVE"), ("80%", None), ("49", None), ("", "ACTIVE"), (None, None), ("55", None)], "reputation string, warmup_status string") \
        .withColumns({"smtp_ok": F.lit(True), "imap_ok": F.lit(True), "is_blocked": F.lit(False), "warmup_sent": F.lit(10)})
    assert [r["reputation_band"] for r in delivery.inbox_health(df).collect()] == ["good", "good", "bad", "unknown", "n/a", "fair"]


def test_spam_terms_in_compounds(spark):
    df = spark.createDataFrame([(1, "A cash-cycle idea"), (2, "cashier"), (3, "Act now!! — FREE")], "id int, t string")
    out = delivery.spam_terms(df, "id", "t", [("word", "high", ["cash"]), ("phrase", "low", ["act now"])])
    assert rows(out.select("id", "term")) == [(1, "cash"), (3, "act now"), (3, "all_caps"), (3, "em_dash"), (3, "many_exclamations")]


def test_sync_accepts_plain_bodies(spark):
    df = spark.createDataFrame([("1", "2", None, "", "A@x.mx", 7, None, None, None, "hello")],
                               "id string, email_type string, lead string, to_address_email_list string, from_address_email string, campaign_id int, step int, "
                               "timestamp_email timestamp_ntz, timestamp_created timestamp_ntz, body string")
    sends, replies = delivery.sync_events(df, "w")
    assert sends.count() == 0 and replies.first()["body"] == "hello" and replies.first()["lead_domain"] == "x.mx"


# --- validation and tables --------------------------------------------------------------------

def test_profile_rules(spark):
    df = spark.createDataFrame([("accepted", "b2b", True, False, "strong", "high", "companywide", "high", "government"),
                                ("accepted", "noncommercial", False, False, "not_applicable", "medium", "none", "high", None),
                                ("pending", None, None, None, None, None, None, None, None)],
                               "profile_status string, business_model string, is_b2b boolean, b2b_line_present boolean, sales_economics string, outbound_fit string, "
                               "outbound_scope string, confidence string, entity_type string")
    got = [set(r["errors"]) for r in validate.validate_profiles(df).collect()]
    assert got == [{"b2b_line", "scope_needs_line"}, {"noncommercial_fit"}, set()]


def test_evidence_and_hash_rules(spark):
    df = spark.createDataFrame([(["one", "two", "three"], "one two three", "f" * 64), (["no"], "yes", "xyz")], "evidence array<string>, clean_text string, h string")
    out = validate.validate_profiles(df, {**validate.evidence_rules(), **validate.hash_rule("h")})
    assert [r["errors"] for r in out.collect()] == [["evidence_count"], ["evidence_literal", "h_format"]]


def test_upsert_twice_is_upsert_once(spark):
    base = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, x string, y int")
    new = spark.createDataFrame([(2, None), (3, "c")], "k int, x string")
    once = tables.upsert(base, new, ["k"])
    assert rows(once) == [(1, "a", 10), (2, None, 20), (3, "c", None)]
    assert rows(tables.upsert(once, new, ["k"])) == rows(once)
    with pytest.raises(ValueError):
        tables.upsert(base, new.withColumnRenamed("x", "zz"), ["k"])


def test_check_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing"):
        tables.check_columns(df, ["a", "c"], ["b"])
    with pytest.raises(ValueError, match="not allowed"):
        tables.check_columns(df, ["a"], [])
    assert tables.check_columns(df, ["a"], ["b"]) is df


def test_profile_queue_is_idempotent(spark):
    queue = spark.createDataFrame([], crawl.QUEUE_SCHEMA)
    crawls = spark.createDataFrame([("a", True, "x" * 400, None), ("b", None, "  ", None), ("c", True, "y" * 30, None)],
                                   "domain string, ok boolean, clean_text string, crawled_at timestamp")
    now, later = F.lit("2024-01-01").cast("timestamp"), F.lit("2024-02-02").cast("timestamp")
    once = crawl.sync_profile_queue(queue, crawls, now)
    state = {r["domain"]: (r["profile_status"], r["profileability_reason"]) for r in once.collect()}
    assert state == {"a": ("pending", None), "b": ("not_profileable", "no_clean_text"), "c": ("not_profileable", "thin_text")}
    assert rows(crawl.sync_profile_queue(once, crawls, later)) == rows(once)
    done = once.withColumn("profiled_source_hash", F.col("current_source_hash")).withColumn("profile_status", F.when(F.col("domain") == "a", "accepted").otherwise(F.col("profile_status"))) \
        .withColumn("needs_review", F.lit(True))
    changed = crawl.sync_profile_queue(done, crawls.withColumn("clean_text", F.concat("clean_text", F.lit("!"))), later).where("domain = 'a'").first()
    assert (changed["profile_status"], changed["needs_review"]) == ("stale", False)
    assert str(changed["updated_at"]).startswith("2024-02-02")


def test_attempts(spark):
    def state(ok, n):
        return tuple(spark.range(1).select(crawl.attempt_state(F.lit(ok), F.lit(n).cast("int"), 2).alias("s")).first()["s"])
    assert [state(False, None), state(False, 2), state(True, None)] == [(True, 1), (False, 2), (False, 1)]


# --- pages ----------------------------------------------------------------------------------

BAKERY = "\n".join([
    "https://[half open", "## Ovens and mixers", "* [Ask us](mailto:desk@oven.test?subject=x)", "", "+3 degrees", "Phone",
    "![Deck oven](https://img.oven.test/deck.webp)", "Menu", "[Catalogue](https://oven.test/cat.pdf)", "**CE** marked since 1998", "Search"])


def lines_of(spark, *sites):
    df = spark.createDataFrame(list(sites), "site string, page int, path string, md string")
    return pages.page_lines(df, "site", "page", "md")


def test_visible_lines(spark):
    noise = ("menu", "phone", "search")
    df = spark.createDataFrame([("oven.test", 1, "/", BAKERY)], "site string, page int, path string, md string")
    kept = [r["line"] for r in pages.page_lines(df, "site", "page", "md", noise=noise).orderBy("pos").collect()]
    assert kept == ["https://[half open", "Ovens and mixers", "Ask us desk@oven.test", "+3 degrees", "Image: Deck oven", "Catalogue", "CE marked since 1998"]


def test_page_context_limits(spark):
    terms = "\n".join(f"Clause {i} of the notice." for i in range(250)) + "\nCE marked since 1998"
    gallery = "\n".join(f"![Loaf {i}](https://img.oven.test/{i}.webp)" for i in range(9))
    lines = lines_of(spark, ("oven.test", 3, "/gallery", gallery), ("oven.test", 2, "/privacy", terms), ("oven.test", 1, "/", "We bake.\nCE marked since 1998"))
    row = pages.clean_page_lines(lines, "site", "page", 1500, 300, 4).first()
    text = row["clean_text"].split("\n")
    assert len(row["clean_text"]) <= 1500 and row["n_lines"] == len(text)
    assert sum(x.startswith("Image:") for x in text) == 4 and text[:2] == ["We bake.", "CE marked since 1998"]
    assert text.count("CE marked since 1998") == 1 and sum(len(x) + 1 for x in text if x.startswith("Clause")) <= 300
    tiny = pages.clean_page_lines(lines, "site", "page", 12, 300, 4).first()
    assert tiny["clean_text"] == "We bake."


def test_markdown_of_any_attribute_order_and_quotes(spark):
    html = """<div><img src='a.png' alt='One'> <img alt="Two" src="b.png"><img src="c.png"></div><a class='x' href='/p'><b>Bold</b> text</a>"""
    got = spark.createDataFrame([(html,)], "h string").select(pages.page_markdown(F.col("h")).alias("m")).first()["m"]
    for part in ("![One](a.png)", "![Two](b.png)", "![](c.png)", "Bold", "](/p)"):
        assert part in got
    seen = spark.createDataFrame([(got,)], "md string").select(pages.evidence_links(F.col("md")).alias("e")).first()["e"]
    assert [(v["alt"], v["url"]) for v in seen["visual_assets"]] == [("One", "a.png"), ("Two", "b.png"), ("", "c.png")]


def test_proof_links_stay_on_the_host(spark):
    links = [("/team", "Team"), ("https://www.oven.test/projects/mill", "Mill"), ("https://oven.test/style.css", "Projects"),
             ("https://other.test/projects", "Projects"), ("/team", "Team again")]
    df = spark.createDataFrame([(links,)], "l array<struct<href:string,text:string>>")
    got = df.select(pages.internal_proof_links(F.col("l"), F.lit("oven.test"), 5, ["project"]).alias("k")).first()["k"]
    assert got == ["https://www.oven.test/projects/mill", "/team"]


def test_enough_needs_offer_audience_and_text(spark):
    def enough(ok, n, cats):
        return spark.range(1).select(pages.crawl_is_enough(F.lit(ok), F.lit("x" * n), F.array(*[F.lit(c) for c in cats])).alias("e")).first()["e"]
    assert enough(True, 400, ["offer", "audience", "proof"])
    assert not enough(True, 400, ["offer", "proof"]) and not enough(True, 299, ["offer", "audience"]) and not enough(None, 400, ["offer", "audience"])


def test_tracking_parameters_do_not_make_a_page(spark):
    df = spark.createDataFrame([(1, "https://x.mx/a?utm_source=1&p=2#top"), (2, "https://x.mx/a?p=2&gclid=9"), (3, "https://x.mx/a?p=3")], "n int, url string")
    assert rows(pages.distinct_pages(df, "url", "n").select("n", "page_key")) == [(1, "https://x.mx/a?p=2"), (3, "https://x.mx/a?p=3")]


# --- files ------------------------------------------------------------------------------------

def test_read_items_all_shapes(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": "1"},\n {"id": "2"}]')
    (tmp_path / "b.json").write_text('{"id": "3"}\n{"id": "4"}\n')
    (tmp_path / "c.json").write_text("")
    got = files.read_items(spark, str(tmp_path), "id string", "mixed")
    assert sorted(r["id"] for r in got.collect()) == ["1", "2", "3", "4"]


def test_read_items_odd_files(spark, tmp_path):
    (tmp_path / "mark and blank.json").write_bytes(b"\xef\xbb\xbf \n[{\"id\": \"a,]\\\"[{\"} , {\"id\": \"b\", \"x\": [{}, [1]]}]\n")
    (tmp_path / "crlf.json").write_bytes(b"\xef\xbb\xbf{\"id\": \"c\"}\r\n\r\n{\"id\": \"\xc3\xa9\"}")
    (tmp_path / "cut.json").write_text('[{"id": "d"}, {"id": "lost')
    (tmp_path / "none.json").write_text(" [ ] ")
    (tmp_path / "other.txt").write_text('{"id": "no"}')
    got = files.read_items(spark, str(tmp_path), "id string", "mixed")
    assert sorted((r["id"] or "") for r in got.collect()) == ["", 'a,]"[{', "b", "c", "d", "é"]


@pytest.mark.parametrize("block", [1, 2, 3, 7, 1 << 20])
def test_items_whatever_the_blocks(block):
    items = [{"id": i, "text": '\\"],[{' * (i % 3) + "é\\", "more": [[], {"a": [i]}]} for i in range(30)]

    def cut(data, start=0):
        return (data[i:i + block] for i in range(start, len(data), block))

    whole = json.dumps(items, ensure_ascii=False, indent=1).encode()
    assert [json.loads(x) for x in json_items.array_items(cut(whole))] == items
    lines = "\n".join(json.dumps(x) for x in items).encode() + b"\n"
    for piece in (1, 5, 64, 1000, len(lines)):
        bounds = [(a, min(len(lines), a + piece)) for a in range(0, len(lines), piece)]
        got = [x for a, b in bounds for x in json_items.line_items(cut(lines, max(0, a - 1)), a, b)]
        assert [json.loads(x) for x in got] == items


def test_a_long_array_is_read_in_bounded_memory():
    """300 MB of array, made while it is read: never more than a few blocks are held."""
    item = json.dumps({"id": "x" * 1000}).encode() + b",\n"
    block = item * (json_items.BLOCK_BYTES // len(item))
    tracemalloc.start()
    n = sum(1 for _ in json_items.array_items(b for part in ([b"["], *[[block]] * 75, [b"1]"]) for b in part))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 75 * (len(block) // len(item)) + 1 and peak < 4 * json_items.BLOCK_BYTES


def test_long_files_are_cut_and_read_in_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(json_items, "PIECE_BYTES", 4096)
    (tmp_path / "a.json").write_text("\n".join(json.dumps({"id": i}) for i in range(5000)))
    (tmp_path / "b.json").write_text(json.dumps([{"id": i} for i in range(5000, 6000)]))
    got = files.read_items(spark, str(tmp_path), "id int", "mixed").select("id", F.spark_partition_id().alias("part"))
    read = got.collect()
    assert sorted(r["id"] for r in read) == list(range(6000))
    assert len({r["part"] for r in read}) > 3


def test_terms_file(spark, tmp_path):
    path = tmp_path / "terms.txt"
    path.write_text("# note\nSDR\n\n cold call \nsdr\nBDR\n")
    assert files.load_terms(spark, str(path)) == ["SDR", "cold call", "BDR"]


def test_terms_of_several_files_come_in_the_order_of_their_names(spark, tmp_path):
    (tmp_path / "part-0.txt").write_text("SDR\n")
    (tmp_path / "part-1.txt").write_text("# note\nsdr\ncold call\n" * 50)
    (tmp_path / "part-2.txt").write_text("COLD CALL\nBDR\n" * 10)
    assert files.load_terms(spark, str(tmp_path)) == ["SDR", "cold call", "BDR"]


def test_a_long_word_list_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(q_pages, "TERMS_A_FILE", 100)
    paths = []
    monkeypatch.setattr(q_pages, "fresh_path", lambda *a: paths.append(fresh_path(*a)) or paths[-1])
    folder = "/root/testdata/sf0.001"
    query = REGISTRY["load_terms"]
    result = verify.compare(query(spark, folder), verify.connect(folder), query.sql)
    assert result.startswith("ok"), result
    assert len(spark.read.text(paths[0]).inputFiles()) > 5


def test_lead_csv(spark, tmp_path):
    path = tmp_path / "leads.csv"
    path.write_text('Email , First_Name,note\n"a@x.mx","Ana ""A"", x","two\nlines"\nb@x.mx,Bo\n')
    got = files.read_lead_csv(spark, str(path))
    assert got.columns == ["email", "first_name", "note"]
    assert rows(got) == [("a@x.mx", 'Ana "A", x', "two\nlines"), ("b@x.mx", "Bo", "")]


# --- scale properties -----------------------------------------------------------------------------

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_group_limit_runs_before_the_exchange(spark):
    df = spark.range(1000).withColumn("k", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    plan = plan_of(grouping.best_k_per_key(df, ["k"], [F.asc("id")], 3))
    assert plan.count("WindowGroupLimit") == 2
    assert rows(grouping.best_k_per_key(df, ["k"], [F.asc("id")], 2000).groupBy("k").count().where("count > 1")) == [(0, 334)]


def test_rows_without_key_are_spread(spark):
    left = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.col("id") % 50))
    right = spark.range(40).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = grouping.lookup_join(left, right, ["k"], "id")
        assert "hashpartitioning(k" in plan_of(out) and plan_of(out).count("_spread") > 2
        assert all("_spread" in line for line in plan_of(out).split("\n") if "hashpartitioning" in line)
        assert rows(out) == rows(left.join(right, "k", "left"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_k_keeps_exactly_the_best(spark):
    df = spark.range(6000).withColumn("k", F.lit(1))
    got = grouping.best_k_per_key(df, ["k"], [F.desc("id")], 1500)
    assert got.agg(F.min("id"), F.count("*")).first()[:] == (4500, 1500)


def test_no_nested_loop_or_cross_product_in_any_query(spark):
    import __spark_entry__ as entry_module
    folder = "/root/testdata/sf0.001"
    for name, run in entry_module.queries().items():
        plan = plan_of(run(spark, folder))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


# --- posting fidelity and verdicts ----------------------------------------------------------------

def _rules(**more):
    return signals.SignalRules(workspace="w", source="s", positive=("beta", "Alpha", "cold call"), negative=("retail",), **more)


def test_postings_keep_their_text_address_and_payload(spark):
    raw = [("1", "Rep", "\u00a0\n Alpha beta.\n\n", ("mx",))]
    df = spark.createDataFrame(raw, "id string, title string, descriptionText string, companyAddress struct<addressCountry:string>")
    row = signals.normalize_job(df, _rules()).first()
    assert row["description_text"] == "Alpha beta." and row["company_address_country_code"] == "MX"
    assert '"addressCountry":"mx"' in row["raw_payload"] and '"id":"1"' in row["raw_payload"]


def test_review_reads_entities_unreadable_countries_and_folded_order(spark):
    text_ = "We need beta and Alpha people who can cold call caf&eacute; owners today&#33;"
    raw = [("1", "Rep", text_, "Ovens", '{"addressCountry": "OO"}', 1)]
    df = spark.createDataFrame(raw, "id string, title string, descriptionText string, companyName string, companyAddress string, arrival long")
    rules = _rules(home_countries=("MX",), targets=("owners",))
    row = signals.company_review(signals.normalize_job(df, rules), rules).first()
    assert row["outbound_terms"] == "Alpha, beta, cold call"
    assert not row["flag_foreign_source"] and "cannot be read" in row["automatic_warnings"]
    assert "café owners today!" in row["target_evidence"] and row["target_evidence"] in row["description_brief"]


def test_terms_are_whole_words_and_phrases(spark):
    docs = spark.createDataFrame([(1, "Cold-call the SDR team"), (2, "sdrs call cold"), (3, None)], "id int, t string")
    terms = spark.createDataFrame([("sdr",), ("Cold call",), ("call",), ("call the sdr team now",), (" ",), (None,)], "term string")
    got = rows(signals.term_join(docs, "id", "t", terms, "term"))
    assert got == [(1, "call"), (1, "cold call"), (1, "sdr"), (2, "call")]


def test_reply_drop_counts_calendar_weeks(spark):
    when = lambda m, d: datetime.datetime(2024, m, d)
    sends = [(1, when(1, 2))] * 10 + [(1, when(6, 4))] * 10
    replies = [(1, when(1, 3))] * 5 + [(1, when(6, 5))]
    got = delivery.reply_drop(spark.createDataFrame(sends, "campaign_id long, sent_at timestamp"),
                              spark.createDataFrame(replies, "campaign_id long, replied_at timestamp"))
    assert not got.where("real_drop OR week_drop").count()


def test_a_control_without_bounces_disqualifies(spark):
    arms = spark.createDataFrame([(1, "control", 1000, 50, 0, False), (1, "variant", 1000, 90, 400, False)],
                                 "experiment_id int, arm string, sent int, positive int, bounces int, combined boolean")
    assert delivery.experiment_verdict(arms).first()["verdict"] == "disqualified"


def test_upsert_of_repeated_keys(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    twice = spark.createDataFrame([("a", 5, 1), ("a", 7, 2), ("c", 9, 1)], "k string, n int, at int")
    assert rows(tables.upsert(base, twice, ["k"], "at")) == [("a", 7), ("b", 2), ("c", 9)]
    with pytest.raises(Exception, match="repeated"):
        tables.upsert(base, twice.drop("at"), ["k"]).collect()


def test_blank_verdicts_and_long_codes(spark):
    checks = spark.createDataFrame([("a", " ", "x"), ("b", "y", "x")], "domain string, verify_label string, subcat string")
    labels = spark.createDataFrame([("a", "x"), ("b", "x")], "domain string, subcat string")
    assert rows(validate.subcat_agree(checks, labels).select("domain", "subcat_agree")) == [("a", True), ("b", False)]
    places = spark.createDataFrame([("123", "A"), ("123456", "B")], "zip string, city string")
    assert rows(lists.filter_places(places)) == [("00123", "A")]


def test_enrichment_gives_up_to_a_limit(spark):
    people = [(i, None, None, "Ana", "Diaz", "x.test", None) for i in (3, 1, 2)] + [(9, "ana@x.test", None, "Ana", "Diaz", None, None)]
    cols = "id long, email string, linkedin_url string, first_name string, last_name string, domain string, phone string"
    book = spark.createDataFrame(people, cols)
    ask = spark.createDataFrame([(1, None, None, "ana", "DIAZ", "x.test", None), (2, "ANA@x.test", None, "", "", None, None), (3, None, None, "", "", None, "")],
                                cols.replace("id long", "rid long"))
    got = rows(contacts.enrich_people(ask, book, "rid", 3).select("rid", "person_id", "resolved_by", "success"))
    assert got == [(1, 1, "name", True), (1, 2, "name", True), (1, 3, "name", True), (2, 9, "email", True), (3, None, None, False)]


def test_removed_intermediate_tables(spark):
    import leadgrid.session as session
    held = session._WRITTEN.pop(spark.sparkContext.applicationId, [])
    kept = session.written(spark.range(3), "gone")
    assert kept.count() == 3
    session.remove_intermediate(spark)
    with pytest.raises(Exception):
        spark.read.parquet(kept.inputFiles()[0]).count()
    session._WRITTEN[spark.sparkContext.applicationId] = held


def sequential_dedupe(records, n_keys):
    seen, kept = [set() for _ in range(n_keys)], []
    for r in sorted(records):
        keyed = [(s, k) for s, k in zip(seen, r[1:]) if k]
        if not any(k in s for s, k in keyed):
            kept.append(r[0])
            for s, k in keyed:
                s.add(k)
    return kept


def test_either_key_dedupe_settles_a_chain_in_few_rounds(spark, monkeypatch):
    steps, cut = [], contacts.cut_lineage
    monkeypatch.setattr(contacts, "cut_lineage", lambda df: steps.append(1) or cut(df))
    n = 4096
    chain = spark.range(n).select("id", F.concat(F.lit("a"), F.floor((F.col("id") + 1) / 2).cast("string")).alias("email"),
                                  F.concat(F.lit("b"), F.floor(F.col("id") / 2).cast("string")).alias("profile"))
    got = [r["id"] for r in contacts.dedupe_either_key(chain, "id", ["email", "profile"]).orderBy("id").collect()]
    assert got == list(range(0, n, 2)) and len(steps) <= 20


@pytest.mark.parametrize("seed", range(3))
def test_either_key_dedupe_is_sequential_where_chains_meet(spark, seed):
    rng = random.Random(seed)
    records = [(i, *[rng.choice([None, "", str(rng.randrange(n))]) for n in (60, 25, 90)]) for i in range(160)]
    df = spark.createDataFrame(records, "id long, a string, b string, c string")
    got = sorted(r["id"] for r in contacts.dedupe_either_key(df, "id", ["a", "b", "c"]).collect())
    assert got == sequential_dedupe(records, 3)


def test_term_join_exchanges_numbers_only(spark):
    docs = spark.createDataFrame([(1, "one two three four five six seven"), (2, "two three"), (2, "three four five"), (None, "six seven"), (3, None)],
                                 "id long, t string")
    terms = spark.createDataFrame([(x,) for x in ("Two three", "three four five", "one two three four five six seven", "seven eight", "six", "", "...",
                                                  "one two three four five six eight")], "term string")
    want = [(1, "one two three four five six seven"), (1, "six"), (1, "three four five"), (1, "two three"), (2, "three four five"), (2, "two three"),
            (None, "six")]
    assert rows(signals.term_join(docs, "id", "t", terms, "term")) == sorted(want, key=repr)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = signals.term_join(docs, "id", "t", terms, "term", broadcast_bytes=0)  # as for a large dictionary
        assert rows(large) == sorted(want, key=repr)
        plan = large._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "Broadcast" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
