"""Keyed tables kept in a store of hash buckets: an update reads and replaces the buckets of its keys only.

A bucket holds the rows whose key hashes to it, one row per key, so buckets are even whatever the
keys are. The number of buckets is chosen when the table is created and kept in the store; take so
many that a bucket is a file or a few. A batch that comes again changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.session import written
from leadgrid.sources import tables
from leadgrid.streaming.store import PART, Snapshot, Store


def create(store: Store, table: str, rows: DataFrame, keys: Sequence[str], buckets: int = 256) -> None:
    """First batch of a table: ``rows`` hold one row per key."""
    if store.snapshot().parts(table):
        raise ValueError(f"{table} is there already")
    number = _next(store)
    parts = [str(b) for b in range(buckets)]
    store.commit(number, store.snapshot(), {table: (rows.withColumn(PART, _bucket(keys, buckets)), parts)},
                 {(_note(table), "buckets"): buckets})


def read(store: Store, table: str, like: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """The table, its columns those of ``like``; with ``keys`` (the key columns, any rows) only the buckets of these."""
    now = store.snapshot()
    parts = None if keys is None else _parts(keys.withColumn(PART, _bucket(keys.columns, _buckets(now, table))))
    return now.read(table, like.schema, parts).drop(PART)


def upsert(store: Store, table: str, like: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: str | None = None, number: int | None = None) -> None:
    """``tables.upsert`` in place; ``number`` is that of the batch, by default the next one."""
    _replace(store, table, like, updates, keys, number, lambda old, new: tables.upsert(old, new, keys, order))


def patch(store: Store, table: str, like: DataFrame, changes: DataFrame, key: str, updated_at: Column,
          number: int | None = None) -> None:
    """``tables.patch`` in place: rows of known keys change, none is added. ``changes`` hold one row per key."""
    _replace(store, table, like, changes, [key], number, lambda old, new: tables.patch(old, new, key, updated_at))


def _replace(store: Store, table: str, like: DataFrame, updates: DataFrame, keys: Sequence[str], number: int | None,
             apply: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    number = _next(store) if number is None else number
    if store.applied(number):
        return
    base = store.snapshot(before=number)
    # Keys take the table's types first: equal numbers of another width would hash to another bucket.
    typed = updates.withColumns({k: F.col(k).cast(like.schema[k].dataType) for k in keys})
    new = written(typed.withColumn(PART, _bucket(keys, _buckets(base, table))), "updates")
    touched = _parts(new)
    if not touched:
        return
    old = base.read(table, like.schema, touched).drop(PART)
    rows = apply(old, new.drop(PART)).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in like.schema])
    store.commit(number, base, {table: (rows.withColumn(PART, _bucket(keys, _buckets(base, table))), touched)})


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("string")


def _parts(rows: DataFrame) -> list[str]:
    """Buckets of the rows; as many as there are buckets at most."""
    return [r[PART] for r in rows.select(PART).distinct().collect()]


def _buckets(base: Snapshot, table: str) -> int:
    return base.versions[(_note(table), "buckets")]


def _note(table: str) -> str:
    return f"{table}#"


def _next(store: Store) -> int:
    last = store.snapshot().number
    return 0 if last is None else last + 1
