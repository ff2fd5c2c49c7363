"""Benchmark decontamination: one Aho-Corasick automaton over normalised item windows.

Items (questions and answers) and documents are lower-cased (A-Z) and reduced to words.
Every run of ``window`` item words is a pattern; a shorter item is one pattern. Each
document is scanned once; matches are mapped back to words and to byte offsets of the
original text.

Usually one automaton holds all patterns, and the job is one scan of the documents without a
shuffle. Nothing relies on a small benchmark: beyond ``block_patterns`` patterns there are
several automata, each for one scan that returns the documents with hits only, and the hits
of a document are merged by (id, hash of the text). A task never holds two automata.

Null texts have no words: such a document is clean, such an item has no pattern. Items are
told apart by their id; an item id that repeats contributes the patterns of all its rows. Items
without an id count as one item, whose name is missing in the list of ids. Repeated documents yield a row each; an empty benchmark leaves every
document clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import WORD_TABLE, batched, fold_words, id_and_bytes, rows_of
from leadgrid.session import written

# A run of hit words: words first..end-1, bytes start..stop-1 of the original text.
Run = tuple[int, int, int, int]

_RUN = pa.list_(pa.struct([(n, pa.int64()) for n in ("first", "end", "start", "stop")]))
_RUN_SQL = "array<struct<first: bigint, end: bigint, start: bigint, stop: bigint>>"
_PAIRS = pa.schema([("pattern", pa.binary()), ("item", pa.string())])
_HITS = pa.schema([("key", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("runs", _RUN),
                   ("items", pa.list_(pa.string()))])
HITS = f"key long, text_hash long, n_words long, runs {_RUN_SQL}, items array<string>"
_RESULT = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()),
                     ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", _RUN)])
RESULT = ("key long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
          f"spans {_RUN_SQL}")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def item_patterns(benchmark: DataFrame, item: str, text: str, window: int) -> DataFrame:
    """(pattern, items): every window of item words, with the ids of the items that hold it."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for name, body in rows_of(batches, "item", "body"):
                words = fold_words(body)
                for i in range(max(1, len(words) - window + 1) if words else 0):
                    yield b" ".join(words[i:i + window]), name
        yield from batched(rows(), _PAIRS)

    named = benchmark.select(
        F.col(item).cast("string").alias("item"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("body"))
    return named.mapInArrow(cut, "pattern binary, item string").groupBy("pattern") \
                .agg(F.transform(F.collect_set(F.struct("item")), lambda x: x["item"]).alias("items"))  # keeps the null


def build_automaton(patterns: list[tuple[bytes, list[str | None]]]) -> ahocorasick.Automaton:
    """Patterns as keys between blanks, so that only whole words match."""
    automaton = ahocorasick.Automaton()
    for pattern, items in patterns:
        automaton.add_word(f" {pattern.decode('latin-1')} ", (pattern.count(b" ") + 1, tuple(items)))
    if patterns:
        automaton.make_automaton()
    return automaton


def hit_words(body: bytes, automaton: ahocorasick.Automaton) -> tuple[int, list[Run], set[str | None]]:
    """Number of words, runs of hit words, and the items that occur."""
    words = body.translate(WORD_TABLE).split()
    found: list[tuple[int, int]] = []
    items: set[str | None] = set()
    if words and len(automaton):
        flat = f" {b' '.join(words).decode('latin-1')} "
        at = last = 0
        for end, (length, names) in automaton.iter(flat):  # ends never decrease
            last += flat.count(" ", at, end)  # blanks before the closing one: words so far
            at = end
            found.append((last - length, last))
            items.update(names)
    if not found:
        return len(words), [], items
    places = [m.span() for m in _WORD.finditer(body)]
    return len(words), joined([(a, b, places[a][0], places[b - 1][1]) for a, b in found]), items


def joined(runs: list[Run]) -> list[Run]:
    """Overlapping and adjacent runs as one."""
    out: list[Run] = []
    for first, end, start, stop in sorted(runs):
        if out and first <= out[-1][1]:
            a, b, c, d = out[-1]
            out[-1] = (a, max(b, end), c, max(d, stop))
        else:
            out.append((first, end, start, stop))
    return out


def _report(key: int, n_words: int, runs: list[Run], items: set[str | None]) -> tuple:
    hit = sum(end - first for first, end, _, _ in runs)
    digest = hashlib.sha256(",".join(sorted(items - {None})).encode()).hexdigest()
    return key, n_words, hit, len(items), digest, hit > 0, _structs(runs)


def _structs(runs: list[Run]) -> list[dict[str, int]]:
    return [dict(zip(("first", "end", "start", "stop"), r, strict=True)) for r in runs]


def _scan(patterns, only_hits: bool):
    """Scan of all documents with one automaton; the full report, or the hits of those that have any."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = build_automaton(patterns.value)

        def rows():
            for key, body, text_hash in rows_of(batches, "key", "body", "text_hash"):
                n_words, runs, items = hit_words(body, automaton)
                if not only_hits:
                    yield _report(key, n_words, runs, items)
                elif runs:
                    yield key, text_hash, n_words, _structs(runs), list(items)

        yield from batched(rows(), _HITS if only_hits else _RESULT)
    return scan


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for key, n_words, runs, items in rows_of(batches, "key", "n_words", "runs", "items"):
            flat = [tuple(r.values()) for r in runs or ()]
            yield _report(key, n_words, joined(flat), set(items or ()))
    yield from batched(rows(), _RESULT)


def pattern_blocks(benchmark: DataFrame, item: str, text: str, window: int, block_patterns: int) -> list[Broadcast]:
    """All patterns in broadcasts of about ``block_patterns`` patterns of at most ``window`` words."""
    patterns = item_patterns(benchmark, item, text, window).persist()
    blocks = max(1, -(-patterns.count() // block_patterns))
    block_of = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
    held = [benchmark.sparkSession.sparkContext.broadcast(
        [(bytes(r["pattern"]), list(r["items"])) for r in patterns.where(block_of == block).collect()])
        for block in range(blocks)]
    patterns.unpersist()
    return held


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
               item_text: str = "text", window: int = 10, block_patterns: int = 50_000) -> DataFrame:
    """The documents, all columns, that hold no window of any item; texts are not shuffled."""
    for number, held in enumerate(pattern_blocks(benchmark, item, item_text, window, block_patterns)):
        if number:  # one automaton at a time
            docs = written(docs, "clean")
        docs = docs.where(~_contains(held)(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))
    return docs


def _contains(held: Broadcast):
    @F.pandas_udf("boolean")
    def contains(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = build_automaton(held.value)
        for bodies in batches:
            yield pd.Series([bool(hit_words(b, automaton)[1]) for b in bodies], dtype=bool)
    return contains


def decontaminate(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", window: int = 10,
                  block_patterns: int = 50_000) -> DataFrame:
    """Per document: words, hit words, items found and the spans of hits (words, original bytes)."""
    held = pattern_blocks(benchmark, item, item_text, window, block_patterns)
    rows = id_and_bytes(docs, key, text).withColumn("text_hash", F.xxhash64("body"))
    if len(held) == 1:
        return rows.mapInArrow(_scan(held[0], False), RESULT).withColumnRenamed("key", key)
    hits = reduce(DataFrame.unionByName, [rows.mapInArrow(_scan(h, True), HITS) for h in held])
    merged = hits.groupBy("key", "text_hash").agg(F.flatten(F.collect_list("runs")).alias("runs"),
                                                  F.flatten(F.collect_list("items")).alias("items")) \
                 .withColumnRenamed("key", "_key").withColumnRenamed("text_hash", "_hash")
    plain = rows.mapInArrow(_count_words, "key long, text_hash long, n_words long")
    return plain.join(merged, F.col("key").eqNullSafe(F.col("_key")) & (F.col("text_hash") == F.col("_hash")), "left") \
                .select("key", "n_words", "runs", "items").mapInArrow(_merge, RESULT).withColumnRenamed("key", key)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((k, h, len(fold_words(b))) for k, b, h in rows_of(batches, "key", "body", "text_hash"))
    yield from batched(rows, pa.schema([("key", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64())]))
