"""Crawl attempts and the profile queue that follows the crawls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.functions.bands import is_true
from leadgrid.operators.grouping import best_per_key
from leadgrid.operators.pages import profileable

QUEUE_SCHEMA = """domain string, profile_status string, profileability_reason string, source_crawl_ok boolean,
    source_clean_chars int, current_source_hash string, profiled_source_hash string, source_crawled_at timestamp,
    needs_review boolean, claimed_at timestamp, last_error string, updated_at timestamp"""


def attempt_state(ok: Column, attempts: Column, max_attempts: int) -> Column:
    """(retry, attempts): failures are retried until the limit, successes never."""
    tries = F.coalesce(attempts, F.lit(1)).cast("int")
    return F.struct((~is_true(ok) & (tries < max_attempts)).alias("retry"), tries.alias("attempts"))


def sync_profile_queue(queue: DataFrame, crawls: DataFrame, now: Column) -> DataFrame:
    """Queue after a batch of crawls (domain, ok, clean_text, crawled_at).

    A changed text makes a profiled row stale and any other pending, and clears review,
    claim and error; text that cannot be profiled wins over everything; ``updated_at`` moves
    only when something did. Applying the same batch twice changes nothing more. The newest
    crawl of a domain counts, so both sides have one row per domain.
    """
    text = F.coalesce("clean_text", F.lit(""))
    fresh = best_per_key(crawls, ["domain"], [F.desc_nulls_last("crawled_at"), F.asc(F.sha2(text, 256))]).select(
        "domain", F.coalesce("ok", F.lit(False)).alias("n_ok"), F.length(F.trim(text)).alias("n_chars"),
        F.when(F.length(F.trim(text)) > 0, F.sha2(text, 256)).alias("n_hash"),
        profileable(F.col("clean_text")).alias("n_reason"), F.col("crawled_at").alias("n_at"), F.lit(True).alias("hit"))
    j = queue.withColumn("old", F.lit(True)).join(fresh, "domain", "full_outer")
    hit, old = is_true(F.col("hit")), is_true(F.col("old"))
    changed = ~F.col("current_source_hash").eqNullSafe(F.col("n_hash"))
    moved = changed | ~F.col("source_crawl_ok").eqNullSafe(F.col("n_ok")) | ~F.col("source_crawled_at").eqNullSafe(F.col("n_at"))
    status = F.when(F.col("n_reason").isNotNull(), "not_profileable").when(~old, "pending") \
        .when(changed, F.when(F.col("profiled_source_hash").isNull(), "pending").otherwise("stale")) \
        .when(F.col("profile_status") == "not_profileable", "pending").otherwise(F.col("profile_status"))

    def after(value: Column, name: str) -> Column:
        return F.when(hit, value).otherwise(F.col(name)).alias(name)

    def reset(name: str, empty: Column) -> Column:
        return after(F.when(changed | ~old, empty).otherwise(F.col(name)), name)
    none_ts = F.lit(None).cast(dict(queue.dtypes)["claimed_at"])
    return j.select(
        "domain", after(status, "profile_status"), after(F.col("n_reason"), "profileability_reason"),
        after(F.col("n_ok"), "source_crawl_ok"), after(F.col("n_chars"), "source_clean_chars"),
        after(F.col("n_hash"), "current_source_hash"), "profiled_source_hash", after(F.col("n_at"), "source_crawled_at"),
        reset("needs_review", F.lit(False)), reset("claimed_at", none_ts), reset("last_error", F.lit(None).cast("string")),
        after(F.when(moved | ~old, now).otherwise(F.col("updated_at")), "updated_at"))
