"""Mixing sources to target weights: Pareto order sampling of documents.

Every source gets a target of words: its weight's share of the total, at most ``cap`` times
its own words, the excess reshared by weight until no source is above. Within a source every
document gets its expected copies, ``min(cap, c * w)``: ``w`` is its inclusion weight (1 unless
given) and ``c`` makes the expected words the target. The whole part of that are certain copies.
The fractions are inclusion probabilities of a fixed-size Pareto sample: documents are ranked by
the odds of a random number divided by the odds of their probability, and taken from the smallest
on while their words fit. The document that ends a round leaves a gap; further rounds take, in the same
order, documents that fit what is left, until none does. A source then lacks less than its smallest
document that was not taken, however few or unequal its documents are.

Random numbers are digits of the MD5 of the id, so reruns agree. Running sums are taken per
(source, bucket of the rank) and offset by the sums of the buckets before: no task
holds a whole source, however large. They yield one row of cut points per source, by which
each document's copies follow without another shuffle. Only id, source and size are shuffled.

Null text has size 0; null is a source of its own, last in order. Rows that repeat an id share
a random number and are told apart by size; rows equal in both share their result. A null or
negative inclusion weight counts as 0: such a document is never taken, and a source falls short
of its target if all others at ``cap`` copies do not reach it. An empty table yields an empty
result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrid.session import written

# Buckets of the logarithm of the rank: at most one in 1,600 documents of a source meets in one.
STEPS = 400
# Type of the ends of a source's rounds (``_new_cut``).
CUTS = "array<struct<most:double,place:struct<q:double,key:{key},size:bigint>>>"
# Digits of the MD5 that make the random number, and the number of their values.
_DIGITS = 13
_RANGE = float(16 ** _DIGITS)


def word_count(text: str) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def random_unit(key: Column) -> Column:
    """A number in (0, 1) fixed by the id."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(_RANGE)


def period_weight(place: Column) -> Column:
    """1, 2, 3, repeating, by place from 0."""
    return (F.pmod(place, F.lit(3)) + 1).cast("double")


def source_targets(sizes: DataFrame, weight: Callable[[Column], Column], cap: float) -> DataFrame:
    """(source, source_size, target): one row per source, all words shared by weight under the cap.

    Taken by rising ``cap * size / weight``, a source is capped when its cap is below its
    share of what the capped sources before it leave; the others share the rest.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = totals.withColumn("weight", weight(F.row_number().over(by_name) - 1)) \
                     .withColumn("limit", F.col("source_size") * F.lit(float(cap)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = weighted.withColumn("left", total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) \
                    .withColumn("weights_left", F.sum("weight").over(rest)) \
                    .withColumn("capped", F.col("limit") * F.col("weights_left") <= F.col("left") * F.col("weight"))
    free = Window.partitionBy()
    spread = level.withColumn("open", total - F.sum(F.when(F.col("capped"), F.col("limit")).otherwise(0.0)).over(free)) \
                  .withColumn("open_weight", F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("weight"))).over(free))
    share = F.when(F.col("capped"), F.col("limit")).otherwise(F.col("open") * F.col("weight") / F.col("open_weight"))
    return spread.select("source", "source_size", share.alias("target"))


def running(rows: DataFrame, amount: str, out: str) -> DataFrame:
    """Running sum of ``amount`` per source in Pareto order, without a task per source."""
    buckets = rows.groupBy("source", "bucket").agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select(F.col("source").alias("_source"), F.col("bucket").alias("_bucket"),
                             F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("source", "bucket").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_inside", F.sum(amount).over(inside)) \
               .join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))) \
               .withColumn(out, F.col("_inside") + F.col("_before")).drop("_inside", "_source", "_bucket", "_before")


def _narrow(key: str, text: str, source: str, inclusion: Column | None) -> list[Column]:
    weight = F.lit(1.0) if inclusion is None else F.greatest(F.coalesce(inclusion.cast("double"), F.lit(0.0)), F.lit(0.0))
    return [F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"),
            weight.alias("w")]


def scales(slim: DataFrame, targets: DataFrame, cap: float, equal: bool, max_rounds: int = 50) -> DataFrame:
    """The targets with ``c``: expected copies are min(cap, c * w).

    With ``equal`` weights the first value is right. Otherwise documents that reach the cap leave the
    rest to the others, which raises ``c``; rounds go on until no document joins the capped ones.
    """
    def rescaled(plan: DataFrame) -> DataFrame:
        full = F.col("c") * F.col("w") >= cap
        sums = _beside(slim, plan.select(F.col("source").alias("_source"), "c")).groupBy(F.col("source").alias("_source")).agg(
            F.sum(F.when(full, F.col("size")).otherwise(0)).alias("full"),
            F.sum(F.when(full, 0.0).otherwise(F.col("size") * F.col("w"))).alias("open"))
        higher = (F.col("target") - F.col("full") * cap) / F.col("open")
        return written(_beside(plan, sums).withColumn("c", F.when(F.col("open") > 0, F.greatest(F.col("c"), higher))
                                                      .otherwise(F.col("c"))).select(*plan.columns, "full"), "mix-plan")

    words = slim.groupBy(F.col("source").alias("_source")).agg(F.sum(F.col("size") * F.col("w")).alias("weighted"))
    plan = written(_beside(targets, words).withColumn(
        "c", F.when(F.col("weighted") > 0, F.col("target") / F.col("weighted")).otherwise(0.0)).drop("weighted"), "mix-plan")
    before = None
    for _ in range(0 if equal else max_rounds):
        plan = rescaled(plan.drop("full"))
        full = plan.agg(F.sum("full")).first()[0]
        if full == before:
            break
        before = full
    return plan.drop("full")


def cut_points(slim: DataFrame, weight: Callable[[Column], Column], cap: float, equal: bool) -> DataFrame:
    """One row per source: target, scale, and the places in Pareto order where its sample ends."""
    slim = written(slim, "mix")
    plan = scales(slim, source_targets(slim, weight, cap), cap, equal)
    certain = with_copies(slim, plan, cap).groupBy(F.col("source").alias("_source")) \
        .agg(F.sum(F.col("whole") * F.col("size")).alias("certain"))
    plan = written(_beside(plan, certain).withColumn("wanted", F.col("target") - F.col("certain")).drop("certain"), "mix-plan")
    # The first round takes documents of any size.
    plan = plan.withColumn("gap", F.col("wanted")).withColumn("cuts", F.lit(None).cast(CUTS.format(key=slim.schema["key"].dataType.simpleString())))
    most, cuts = F.lit(float("inf")), _new_cut()
    while True:
        rows = with_copies(slim, plan, cap).where((F.col("p") > 0) & (F.col("size") <= most) & ~_sampled()) \
            .withColumn("bucket", F.floor(F.log("q") * STEPS))
        taken = running(rows, "size", "cum").where(F.col("cum") <= F.col("gap")).groupBy(F.col("source").alias("_source")) \
            .agg(F.sum("size").alias("got"), F.max("place").alias("cut"), F.first(most).alias("most"))
        taken = written(taken, "mix-round")
        if taken.isEmpty():  # nothing fits any more
            # The plan was written, so that its size is known when documents are joined to it: one row per
            # source is broadcast, and no source's documents meet in one task.
            return plan
        plan = _beside(plan, taken).withColumn("cuts", F.when(F.col("cut").isNull(), F.col("cuts")).otherwise(cuts)) \
            .withColumn("gap", F.col("gap") - F.coalesce(F.col("got"), F.lit(0)))
        plan = written(plan.drop("got", "cut", "most"), "mix-plan")
        most, cuts = F.col("gap"), F.concat(F.coalesce("cuts", F.array().cast(plan.schema["cuts"].dataType)), _new_cut())


def _new_cut() -> Column:
    """Where a round ended: the largest size it took into account, and the place of the last document it took."""
    return F.array(F.struct("most", F.col("cut").alias("place")))


def _sampled() -> Column:
    return F.coalesce(F.exists("cuts", lambda c: (F.col("size") <= c["most"]) & (F.col("place") <= c["place"])), F.lit(False))


def with_copies(rows: DataFrame, plan: DataFrame, cap: float) -> DataFrame:
    """Rows (key, source, size, w) beside their source's plan, with certain copies, inclusion
    probability ``p``, rank ``q`` and place in Pareto order. The plan has one row per source."""
    expected = F.least(F.lit(float(cap)), F.col("c") * F.col("w"))
    odds = F.col("u") / (1 - F.col("u"))
    return _beside(rows, plan.withColumnRenamed("source", "_source")) \
        .withColumn("whole", F.floor(expected)).withColumn("p", expected - F.col("whole")) \
        .withColumn("u", random_unit(F.col("key"))) \
        .withColumn("q", F.when(F.col("p") > 0, odds / (F.col("p") / (1 - F.col("p"))))) \
        .withColumn("place", F.struct("q", "key", "size"))


def _beside(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    return rows.join(by_source, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _copies() -> Column:
    return (F.col("whole") + F.when((F.col("p") > 0) & _sampled(), 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weight: Callable[[Column], Column] = period_weight, cap: float = 3.0,
        inclusion: Column | None = None) -> DataFrame:
    """Per document: size, source_size, target of its source, copies, and taken = copies * size.

    ``weight`` gives a source's weight by its place in order; ``inclusion`` is a document's
    relative inclusion weight, an expression over its columns.
    """
    slim = docs.select(*_narrow(key, text, source, inclusion))
    placed = with_copies(slim, cut_points(slim, weight, cap, inclusion is None), cap).withColumn("copies", _copies())
    return placed.select(F.col("key").alias(key), "source", "size", "source_size", "target", "copies",
                         (F.col("copies") * F.col("size")).alias("taken"))


def repeat_by_mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                  weight: Callable[[Column], Column] = period_weight, cap: float = 3.0,
                  inclusion: Column | None = None) -> DataFrame:
    """The mix itself: every row as often as its copies say, in the columns given. Texts are not shuffled
    unless the table of sources is too large to broadcast."""
    plan = cut_points(docs.select(*_narrow(key, text, source, inclusion)), weight, cap, inclusion is None)
    rows = docs.select(F.struct("*").alias("_doc"), *_narrow(key, text, source, inclusion))
    placed = with_copies(rows, plan, cap)
    return placed.select("_doc", F.explode(F.array_repeat(F.lit(1), _copies().cast("int"))).alias("_copy")).select("_doc.*")
