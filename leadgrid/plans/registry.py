"""Registry of runnable queries and their independent SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from leadgrid.plans.standins import STANDINS, TABLES, with_standins

# Tables whose queries are CPU-heavy per row, and the setting that spreads them over so many partitions.
# It is for runs on a few unsplit files, such as the bench; on a cluster it stays unset.
TEXT_TABLES = ("documents", "pages", "conversations")
TEXT_PARTITIONS = "spark.leadgrid.textPartitions"


class Tables:
    """Lazy access to the parquet tables and to the domain tables derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.parquet(self.path(name))
            parts = self.spark.conf.get(TEXT_PARTITIONS, None) if name in TEXT_TABLES else None
            return df.repartition(int(parts)) if parts else df
        needs, sql = STANDINS[name]
        return self.spark.sql(sql, **{n: self(n) for n in needs})


@dataclass(frozen=True)
class Query:
    run: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Tables(spark, folder))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query. ``sql`` may name stand-in tables; they are added as CTEs."""
    def register(run):
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, with_standins(sql) if sql else None)
        return run
    return register
