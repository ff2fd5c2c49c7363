"""Sharding by weighted rendezvous hashing of stable record keys.

Every shard scores a key by ``-weight / ln(u)``, ``u`` being digits of the MD5 of "key:shard";
the highest score wins. The score of a shard depends on the key and that shard alone, so a new
shard takes rows only into itself, about its weight's share, and a lost one gives up only its own.

Slots number the rows of a shard from 0 without gaps, in order of the key's MD5. They are
counted per (shard, bucket of the MD5) and offset by the counts of the buckets before, which
need the keys alone: no task holds a whole shard, and rows are shuffled once, into their buckets.

Null text has no bytes: size 1, CRC 0. A null key counts as the empty key. Equal keys share a
shard; their rows get different slots. An empty table yields an empty result. Other columns
are kept; of the names added here, the operator's own values win.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadgrid.llm.common import utf8

# Hexadecimal digits of the MD5 that make a number, its range, and the digits of a bucket.
_DIGITS, _BUCKET_DIGITS = 13, 3
_RANGE = float(16 ** _DIGITS)


def _unit(data: Column) -> Column:
    digits = F.substring(F.md5(data.cast("binary")), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(_RANGE)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the winning shard; of equal scores the larger number wins."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    scores = [F.struct((F.lit(-float(w)) / F.log(_unit(F.concat(text, F.lit(f":{i}"))))).alias("score"),
                       F.lit(i).alias("shard")) for i, w in enumerate(weights)]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return best["shard"]


def shard_documents(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with size (bytes + 1), text_crc32, shard, slot, and the shard under ``grown`` weights.

    ``grown`` defaults to the same weights and one more shard of mean weight.
    """
    more = list(grown) if grown is not None else [*weights, sum(weights) / len(weights)]
    body = utf8(text)
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary"))
    bucket = F.substring("_digest", 1, _BUCKET_DIGITS)
    counts = docs.select(rendezvous(F.col(key), weights).alias("shard"), digest.alias("_digest")) \
                 .groupBy("shard", bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rows = docs.withColumns({
        "size": (F.octet_length(body) + 1).cast("long"), "text_crc32": F.crc32(body),
        "shard": rendezvous(F.col(key), weights), "grown_shard": rendezvous(F.col(key), more), "_digest": digest,
    }).withColumn("_bucket", bucket)
    inside = Window.partitionBy("shard", "_bucket").orderBy("_digest", key, "text_crc32", "size")
    placed = rows.withColumn("_inside", F.row_number().over(inside) - 1)
    return placed.join(offsets, ["shard", "_bucket"]) \
                 .withColumn("slot", (F.col("_inside") + F.col("_before")).cast("long")) \
                 .select(*[c for c in docs.columns if c not in ("size", "text_crc32", "shard", "slot", "grown_shard")],
                         "size", "text_crc32", "shard", "slot", "grown_shard")
