"""Language identification by the nearest of several centroids per language.

A text becomes a hashed vector of its letter n-grams (1 to 3 bytes of lower-cased UTF-8, other
bytes blank), with logarithmic counts, inverse document frequencies and unit length. The
frequencies are counted over all training texts, per partition and added in a tree. Of each
language at most ``per_language`` distinct training rows, those with the smallest hashes of id
and text, are clustered into ``clusters`` centroids by spherical k-means; a language is one small task. A
text gets the language of the centroid with the largest cosine. ``rejected`` marks texts whose
distance to it is beyond all distances seen in its cluster, with a margin.

Null texts and texts without a letter are ``und`` with score 0, as is every text when there
is nothing to learn from. Rows without a language or an id teach nothing and are predicted like all.
A tie goes to the first language in order. An empty table yields an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import crc_part, rows_of, tree_sum, utf8
from leadgrid.operators.grouping import best_k_per_key
from leadgrid.session import written

BITS = 13
DIM = 1 << BITS
_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_ASCII_LETTER = re.compile(rb"[A-Za-z]")
_LETTER = re.compile(r"[^\W\d_]")
_CENTROIDS = pa.schema([("lang", pa.string()), ("vector", pa.binary()), ("reach", pa.float64())])
_RESULT = pa.schema([("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])
_STEP = 1 << 16


def has_letter(body: bytes) -> bool:
    return bool(_ASCII_LETTER.search(body) or _LETTER.search(body.decode("utf-8", "ignore")))


def ngram_counts(body: bytes) -> np.ndarray:
    """Hashed counts of the n-grams of a whole text; blanks between words count once."""
    data = np.frombuffer(b" " + b" ".join(body.translate(_LETTERS).split()) + b" ", np.uint8)
    out = np.zeros(DIM, np.int64)
    for a in range(0, len(data), _STEP):
        x = data[a:a + _STEP + 2].astype(np.uint32)  # two bytes on, for the n-grams across the step
        own = min(_STEP, len(x))
        gram = x * np.uint32(0x9E3779B1)
        for n in (1, 2, 3):
            if n > 1:
                gram = (gram[:-1] ^ (x[n - 1:] * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35)
            out += np.bincount(gram[:own] >> np.uint32(32 - BITS), minlength=DIM)
    return out


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.log1p(counts) * idf
    size = np.sqrt((v * v).sum(axis=-1, keepdims=True))
    return v / np.where(size > 0, size, 1)


def document_frequencies(rows: DataFrame) -> tuple[float, np.ndarray]:
    """Number of texts and, per n-gram, of texts with it; over all rows (body)."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIM + 1)
        for (body,) in rows_of(batches, "body"):
            total[:-1] += ngram_counts(body) > 0
            total[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["cells"])
    total = tree_sum(rows.select("body").mapInArrow(scan, "cells binary"))
    return (total[-1], total[:-1]) if len(total) else (0.0, np.zeros(DIM))


def spherical_clusters(vectors: np.ndarray, clusters: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids, first spread by farthest choice, and the cluster of each vector."""
    chosen = [int((vectors @ vectors.mean(axis=0)).argmax())]
    while len(chosen) < min(clusters, len(vectors)):
        chosen.append(int((vectors @ vectors[chosen].T).max(axis=1).argmin()))
    centers = vectors[chosen]
    for _ in range(rounds):
        own = (vectors @ centers.T).argmax(axis=1)
        means = [vectors[own == c].mean(axis=0) if (own == c).any() else centers[c] for c in range(len(centers))]
        centers = np.stack([m / max(np.linalg.norm(m), 1e-12) for m in means])
    return centers, (vectors @ centers.T).argmax(axis=1)


def learn(rows: DataFrame, clusters: int, per_language: int, margin: float, slack: float) -> tuple[np.ndarray, list[tuple]]:
    """(idf, [(language, centroid, reach)]) from training rows (key, lang, body)."""
    n, frequency = document_frequencies(rows)
    idf = np.log((1 + n) / (1 + frequency)) + 1
    # The sample is chosen by hashes alone: the last one that each language takes. Rows that repeat count once.
    hashed = rows.withColumn("h", F.xxhash64("key", "body"))
    hashes = written(hashed.select("lang", "h").distinct(), "language-hashes")
    sizes = written(hashes.groupBy(F.col("lang").alias("_lang")).agg(F.count(F.lit(1)).alias("n")), "languages")
    # About four times the sample passes this bound, so a large language sends no more to be ranked.
    share = F.lit(4.0 * per_language) / F.col("n")
    bound = F.when(share < 1, (share * 2.0 ** 64 - 2.0 ** 63).cast("long")).otherwise(F.lit(2 ** 63 - 1))
    few = hashes.join(sizes, F.col("lang") == F.col("_lang")).where(F.col("h") <= bound).select("lang", "h")
    last = best_k_per_key(few, ["lang"], [F.col("h")], per_language).groupBy("lang").agg(F.max("h").alias("last")) \
        .withColumnRenamed("lang", "_lang")
    # Written, so that its size is known: texts are not shuffled to meet one row per language.
    sample = hashed.join(written(last, "languages"), F.col("lang") == F.col("_lang")).where(F.col("h") <= F.col("last")) \
                   .dropDuplicates(["lang", "h"])

    def cluster(key: tuple, table: pa.Table) -> pa.Table:
        vectors = np.stack([vector(ngram_counts(b), idf) for b in table.column("body").to_pylist()])
        centers, own = spherical_clusters(vectors, clusters)
        reach = [float((1 - vectors[own == c] @ centers[c]).max(initial=0)) * margin + slack for c in range(len(centers))]
        return pa.table([[key[0].as_py()] * len(centers), [c.astype("<f8").tobytes() for c in centers], reach],
                        schema=_CENTROIDS)

    found = sample.select("lang", "body").groupBy("lang").applyInArrow(cluster, "lang string, vector binary, reach double")
    # A few centroids per language.
    learned = sorted((r["lang"], bytes(r["vector"]), r["reach"]) for r in found.collect())
    return idf, [(name, np.frombuffer(cells, "<f8"), reach) for name, cells, reach in learned]


def is_held_out(key: str) -> Column:
    """Rows that teach nothing: crc32 of the id as text is divisible by 5."""
    return crc_part(key, 5) == 0


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", clusters: int = 4,
             per_language: int = 400, margin: float = 1.1, slack: float = 0.01) -> DataFrame:
    """Per document: held_out, lang_pred, score (cosine of the nearest centroid), rejected."""
    named = docs.select(F.col(key).cast("long").alias("key"), F.col(lang).cast("string").alias("lang"),
                        utf8(text).alias("body"))
    training = named.where(F.col("key").isNotNull() & F.col("lang").isNotNull() & ~is_held_out("key"))
    idf, centroids = learn(training, clusters, per_language, margin, slack)
    names = [c[0] for c in centroids]
    centers = np.stack([c[1] for c in centroids]) if centroids else np.zeros((0, DIM))
    reach = np.array([c[2] for c in centroids])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, bodies = batch.column("key").to_pylist(), batch.column("body").to_pylist()
            for a in range(0, len(keys), 256):
                part = bodies[a:a + 256]
                rows = [(k, "und", 0.0, False) for k in keys[a:a + 256]]
                known = [i for i, b in enumerate(part) if names and has_letter(b)]
                if known:
                    cosine = vector(np.stack([ngram_counts(part[i]) for i in known]), idf) @ centers.T
                    best = cosine.argmax(axis=1)
                    for i, c, row in zip(known, best.tolist(), cosine, strict=True):
                        rows[i] = (rows[i][0], names[c], float(np.clip(row[c], 0, 1)), bool(1 - row[c] > reach[c]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(
                    zip(*rows, strict=True), _RESULT, strict=True)], schema=_RESULT)

    found = named.select("key", "body").mapInArrow(predict, "key long, lang_pred string, score double, rejected boolean")
    return found.select(F.col("key").alias(key), is_held_out("key").alias("held_out"), "lang_pred", "score", "rejected")
