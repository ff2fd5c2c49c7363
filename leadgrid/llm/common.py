"""Helpers shared by the corpus operators.

Texts travel to Python as UTF-8 bytes: lower-casing A-Z and the word classes used here are
then plain byte tables, since every byte of a multi-byte character is 0x80 or above.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _fold(byte: int) -> int:
    if 0x41 <= byte <= 0x5A:
        return byte + 32
    return byte if 0x30 <= byte <= 0x39 or 0x61 <= byte <= 0x7A or byte >= 0x80 else 0x20


# Lower-cases A-Z and blanks every byte that is no digit, a-z or part of a multi-byte character.
WORD_TABLE = bytes(map(_fold, range(256)))


def fold_words(text: bytes) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(WORD_TABLE).split()


def space_words(text: bytes) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return text.lower().split()


def utf8(text: str) -> Column:
    """The text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")


def id_and_bytes(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Only the id (``key``) and the bytes (``body``) of each row, whatever else the table holds."""
    return docs.select(F.col(key).cast("long").alias("key"), utf8(text).alias("body"))


def rows_of(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Values of the named columns, row by row."""
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


def batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def crc_part(key: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def tree_sum(parts: DataFrame, fan_in: int = 64) -> np.ndarray:
    """Sum of equally long vectors of doubles, given as rows (cells binary); empty without rows.

    Two rounds of groups of rows, then at most ``fan_in`` vectors reach the driver.
    """
    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<f8") for c in table.column("cells").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "cells": pa.array([total.tobytes()], pa.binary())})

    rows = parts.select(F.pmod(F.xxhash64(F.spark_partition_id()), F.lit(fan_in * fan_in)).alias("part"), "cells")
    for width in (fan_in * fan_in, fan_in):
        rows = rows.withColumn("part", F.pmod(F.col("part"), F.lit(width))).groupBy("part") \
                   .applyInArrow(add, "part long, cells binary")
    held = [np.frombuffer(bytes(r["cells"]), "<f8") for r in rows.collect()]
    return sum(held) if held else np.zeros(0)
