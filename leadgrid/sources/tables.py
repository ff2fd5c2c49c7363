"""Table access and sinks: projection scans, upsert, patch, rebuild."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Whole table, only the named columns; filters and columns reach the Parquet scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def upsert(base: DataFrame, updates: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Insert new keys and overwrite only the columns that ``updates`` provides.

    Both sides hold one row per key, so the full outer join cannot skew. Of updates that repeat
    a key the one with the largest ``order`` counts; without ``order`` a repeated key fails the
    job. A provided null overwrites. The result is a new table: write it to a fresh path and swap.
    """
    given = [c for c in updates.columns if c not in keys and c != order]
    unknown = [c for c in given if c not in base.columns]
    if unknown:
        raise ValueError(f"unknown columns {unknown}")
    row = F.struct(*given)
    one = F.max_by(row, order) if order else F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("an update key is repeated"))).otherwise(F.any_value(row))
    fresh = updates.groupBy(*keys).agg(one.alias("_row")) \
        .select(*keys, *[F.col(f"_row.{c}").alias(f"_u_{c}") for c in given], F.lit(True).alias("_hit"))
    joined = base.join(fresh, list(keys), "full_outer")
    out = [F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
           for c in base.columns]
    return joined.select(*out)


def patch(base: DataFrame, changes: DataFrame, key: str, updated_at: Column) -> DataFrame:
    """Update the named columns of existing rows by key and stamp them; adds no rows."""
    given = [c for c in changes.columns if c != key]
    fresh = changes.select(key, *[F.col(c).alias(f"_u_{c}") for c in given], F.lit(True).alias("_hit"))
    joined = base.join(fresh, key, "left")
    updates = {c: F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)) for c in given}
    updates["updated_at"] = F.when(F.col("_hit"), updated_at).otherwise(F.col("updated_at"))
    return joined.withColumns(updates).drop("_hit", *[f"_u_{c}" for c in given])


def check_columns(df: DataFrame, required: Sequence[str], allowed: Sequence[str]) -> DataFrame:
    """The same frame, or an error before any action when the header is wrong."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    extra = [c for c in df.columns if c not in set(allowed) | set(required)]
    if extra:
        raise ValueError(f"columns not allowed: {', '.join(extra)}")
    return df


def queue_filter(df: DataFrame, status: Mapping[str, Sequence[str]] | None = None,
                 equal: Mapping[str, object] | None = None, is_null: Sequence[str] = (),
                 not_null: Sequence[str] = ()) -> DataFrame:
    """Rows of a work queue by status list, equality, null and not-null; all pushed down."""
    for name, values in (status or {}).items():
        df = df.where(F.col(name).isin(*values))
    for name, value in (equal or {}).items():
        df = df.where(F.col(name) == value)
    for name in is_null:
        df = df.where(F.col(name).isNull())
    for name in not_null:
        df = df.where(F.col(name).isNotNull())
    return df


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a derived table completely."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header and quotes where needed; array columns are joined with a bar."""
    flat = [F.array_join(F.col(n), " | ").alias(n) if kind.startswith("array") else F.col(n)
            for n, kind in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
