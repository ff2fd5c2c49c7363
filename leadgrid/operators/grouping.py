"""Group-wise building blocks that stay even when one key holds a third of all rows.

* a winner that is computed beside other aggregates is a ``max_by``/``min_by``: combined on
  the map side, so a hot key ships one row per map task;
* the best row or the best k rows per key filter ``row_number`` directly, which lets Spark place a
  WindowGroupLimit before the exchange: at most k rows per key and map task are shuffled;
* a global numbering ranks inside range partitions and adds partition offsets, so no
  single task ever sees all rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrid.session import cut_lineage

# Above this k Spark no longer plants the group limit before the exchange.
GROUP_LIMIT_MAX = 1000
# monotonically_increasing_id keeps the partition above and the place below this bit.
PARTITION_BITS = 33


def best_k_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                   rank_as: str | None = None) -> DataFrame:
    """First ``k`` rows of each key in ``order``; the order must end in a unique column.

    The result is the same for every ``k``. Above Spark's own bound for the group limit a first
    round over input partitions does what the limit does below it.
    """
    if k > GROUP_LIMIT_MAX:
        # Best k inside sub-groups of input partitions first, so a hot key is cut in parallel.
        salted = df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(64)))
        inner = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = salted.withColumn("_rn", F.row_number().over(inner)).where(F.col("_rn") <= k) \
                   .drop("_rn", "_salt")
    window = Window.partitionBy(*keys).orderBy(*order)
    name = rank_as or "_rn"
    ranked = df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= k)
    return ranked if rank_as else ranked.drop("_rn")


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``."""
    return best_k_per_key(df, keys, order, 1)


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters test.

    A filter on a plain projection is pushed below it and evaluates the expression a second
    time; a generated column stays where it is.
    """
    raw = df.withColumn("_raw", value)
    return raw.select(*df.columns, F.explode_outer(F.array("_raw")).alias(name))


def lookup_join(left: DataFrame, right: DataFrame, keys: Sequence[str], row_id: str, spread: int = 256) -> DataFrame:
    """Left join to a table with one row per key, where many left rows may lack the key.

    Rows without a key match nothing, yet a plain join would send all of them to one task.
    Here they are spread by ``row_id`` over ``spread`` partitions of their own. A hot key that
    is present is left to adaptive execution, which splits the left side of a left join.
    """
    lacks = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False))
    salt = F.when(lacks, F.pmod(F.xxhash64(row_id), F.lit(spread))).otherwise(F.lit(0))
    # Always 0, yet no literal: the optimizer would drop a constant from the hash keys.
    zero = F.pmod(F.xxhash64(*keys), F.lit(1))
    return left.withColumn("_spread", salt.cast("int")) \
               .join(right.withColumn("_spread", zero.cast("int")), [*keys, "_spread"], "left").drop("_spread")


def newest_struct(columns: Sequence[str], *order: Column) -> Column:
    """Aggregate that keeps ``columns`` of the row with the greatest ``order`` (nulls lowest)."""
    return F.max_by(F.struct(*columns), F.struct(*order))


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_no") -> DataFrame:
    """1-based position of every row in a total order, without one task seeing all rows.

    Rows are range-partitioned by the full order (which must be unique, so that no key is
    hot) and sorted within each partition; a row's place in its partition is stored with it
    by a checkpoint, which fixes the layout. The offset of a partition comes from the counts
    of those before it: a table with one row per partition. One shuffle in all.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order) \
               .withColumn("_id", F.monotonically_increasing_id())
    ranged = cut_lineage(ranged).withColumn("_part", F.shiftright("_id", PARTITION_BITS))
    counts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = F.col("_id").bitwiseAND(F.lit((1 << PARTITION_BITS) - 1))
    # One row per partition: its size is bounded by the partition count.
    return ranged.join(F.broadcast(offsets), "_part") \
                 .withColumn(out, within + F.col("_off") + 1).drop("_part", "_id", "_off")


def first_seen(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Distinct (keys, value) with the first position at which each value was seen."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value) \
             .agg(F.min(order).alias("first_at"))
