"""Hard negatives by threshold joins over inverted indexes with norm bounds.

For an anchor, its positives are the ``k_positive`` other rows of its label with the highest
inner products. A positive with score p opens a window: rows of other labels with scores from
``low * p`` to ``p``; the best ``k_negative`` of them are its hard negatives.

Rows are packed into shards, anchors into blocks; a task joins one block with one shard. The
shard has an inverted index: a posting list (row, value) per dimension, dimensions by falling
energy. Three bounds follow from the inequality of Cauchy and Schwarz:

* index: with threshold t, the dimensions of a row from that place on where the norm of the rest
  times the longest anchor's is below t are left out; a row left out whole is never met;
* accumulation: a row whose partial score, plus the norms of both rests multiplied, is
  below the anchor's own threshold is dropped;
* check: rows that survive get the products of the dimensions that the index left out.

A join starts with a high threshold. Anchors whose windows are full, or whose threshold has
reached the bottom of their windows (or 0), are done; the others go on with a lower threshold, over an
index extended for it. Positives are found the same way, their window reaching down without
end. The lists of all shards are merged in a tree of fan-in ``fan_in``.

Components become ``floor(scale * x)``; scores are exact integers. Bounds carry a margin for
rounding. Where sums could leave the whole numbers of a double, scores are computed with
Python integers, without bounds, and cut off at the range of a long.

Rows with a null id or label, a null vector, or one with a null or non-finite component, take no
part. Vectors of different lengths are not compared. An anchor never meets rows of its own
id; rows that repeat an id are rows of their own, as candidates and as anchors. Ties go to the
smaller id. An anchor without positives, or a window without rows, yields nothing, as does
a negative positive score. An empty table yields an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.session import written

_LONG = np.iinfo(np.int64)
_PACK = "block long, dim int, ids binary, labels binary, cells binary"
_PACK_SCHEMA = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("labels", pa.binary()),
                          ("cells", pa.binary())])
# A found row of window ``slot`` of the anchor at place ``at`` of its block.
_FOUND = np.dtype([("at", "<i4"), ("slot", "<i4"), ("id", "<i8"), ("score", "<i8")])
_LIST = "a_block long, dim int, node long, found binary"
_LIST_SCHEMA = pa.schema([("a_block", pa.int64()), ("dim", pa.int32()), ("node", pa.int64()), ("found", pa.binary())])
# Dimensions whose products are added between two prunings.
_STRIDE = 8
# Thresholds of a join: shares of the way from the bottom (0) to the top of an anchor's windows.
_STEPS = (0.75, 0.5, 0.25, 0.0)
# Cells keep the smallest of these types that holds all their whole numbers.
_KINDS = (("<i2", 2 ** 15 - 1), ("<f4", 2 ** 24), ("<f8", np.inf))


def usable(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, vector, row) of the rows that take part; ``row`` tells rows of one id apart."""
    finite = F.forall(F.col(vector).cast("array<double>"),
                      lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    named = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"),
                           F.col(vector).alias("vector"), finite.alias("_finite"))
    return named.where("key IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND _finite").drop("_finite") \
                .withColumn("row", F.monotonically_increasing_id())


def pack(rows: DataFrame, blocks: int, scale: float) -> DataFrame:
    """One row per (block, length): ids, labels and scaled, floored vectors by rising id."""
    def pack_block(keys: tuple, table: pa.Table) -> pa.Table:
        ids, order = table.column("key").to_numpy(), np.lexsort((table.column("row").to_numpy(), table.column("key").to_numpy()))
        dim = keys[1].as_py()
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        limit = np.finfo(np.float64).max
        cells = np.clip(np.floor(scale * flat.astype(np.float64).reshape(len(ids), dim)), -limit, limit)[order]
        labels = table.column("label").to_numpy()[order]
        kind = next(k for k, most in _KINDS if np.abs(cells).max(initial=0) <= most)
        return pa.table([[keys[0].as_py()], [dim], [ids[order].astype("<i8").tobytes()], [labels.astype("<i8").tobytes()],
                         [cells.astype(kind).tobytes()]], schema=_PACK_SCHEMA)

    return rows.withColumn("block", F.pmod(F.xxhash64("key", "row"), F.lit(blocks))).withColumn("dim", F.size("vector")) \
               .groupBy("block", "dim").applyInArrow(pack_block, _PACK)


class Shard:
    """Rows with an inverted index that grows as thresholds fall."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, cells: np.ndarray, order: np.ndarray):
        self.ids, self.labels = ids, labels
        self.columns = np.ascontiguousarray(cells[:, order].T)  # posting values by dimension
        squares = np.cumsum((self.columns ** 2)[::-1], axis=0)[::-1]
        # rest[d] is the norm of the dimensions from d on.
        self.rest = np.sqrt(np.vstack([squares, np.zeros((1, len(ids)))])) * (1 + 1e-9)
        self.depth = np.zeros(len(ids), np.int64)  # indexed dimensions of each row

    def extend(self, threshold: float, anchor_rest: np.ndarray) -> None:
        """Index every row down to the dimension from which the rest cannot reach the threshold."""
        reach = self.rest * anchor_rest[:, None] >= threshold - 1
        self.depth = np.maximum(self.depth, reach[:-1].sum(axis=0))

    def join(self, query: np.ndarray, query_rest: np.ndarray, threshold: float, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the allowed rows that reach the threshold."""
        rows = np.flatnonzero(allowed & (self.depth > 0))
        score = np.zeros(len(rows))
        for d in range(0, len(query), _STRIDE):
            stop = min(d + _STRIDE, len(query))
            part = self.columns[d:stop, rows]
            if (self.depth[rows] < stop).any():  # postings left out are no part of the sum yet
                part = np.where(np.arange(d, stop)[:, None] < self.depth[rows], part, 0.0)
            score += query[d:stop] @ part
            at = np.maximum(np.minimum(self.depth[rows], stop), 0)
            open_ = score + query_rest[at] * self.rest[at, rows] >= threshold - 1
            rows, score = rows[open_], score[open_]
        left = np.flatnonzero(self.depth[rows] < len(query))
        if len(left):
            tail = np.arange(len(query))[:, None] >= self.depth[rows[left]]
            score[left] += query @ np.where(tail, self.columns[:, rows[left]], 0.0)
        met = score >= threshold
        return rows[met], score[met].astype(np.int64)


def _exact(query: np.ndarray, columns: np.ndarray) -> np.ndarray:
    whole = np.vectorize(int, otypes=[object])
    if not len(query):
        return np.zeros(columns.shape[1], np.int64)
    scores = whole(query).dot(whole(columns))
    return np.array([max(_LONG.min + 1, min(_LONG.max, s)) for s in scores], np.int64)


def lowest(score: int, low: tuple[int, int]) -> int:
    """Smallest integer n with ``low[1] * n >= low[0] * score``."""
    return -((-low[0] * score) // low[1])


def fill_windows(shard: Shard, anchors: dict, windows: list[list[tuple[int, int]]], same: bool, k: int) -> np.ndarray:
    """Best ``k`` rows of each window (bottom, top) of each anchor, in one shard.

    ``same`` takes rows of the anchor's label, else rows of other labels.
    """
    cells, rests = anchors["cells"], anchors["rest"]
    n, dim = len(anchors["ids"]), shard.columns.shape[0]
    largest = float(np.abs(cells).max(initial=0)) * float(np.abs(shard.columns).max(initial=0)) * max(1, dim)
    longest = rests.max(axis=0) if n else np.zeros(dim + 1)
    full = rests[:, 0] * shard.rest[0].max(initial=0) if n else np.zeros(0)
    bounded = 0 < dim and largest < 2 ** 53
    out = []
    # Bottom and top of an anchor's windows; from an open window's bottom on the norms exclude nothing.
    bottom = np.array([max(0.0, min((w[0] for w in ws), default=0.0)) for ws in windows])
    top = np.array([min(0.6 * f, max((w[1] for w in ws), default=-1.0)) for f, ws in zip(full, windows, strict=True)])
    live = [a for a in range(n) if windows[a]]
    for step in _STEPS:
        if not live:
            break
        threshold = bottom + step * np.maximum(top - bottom, 0.0) if step else bottom
        if bounded:
            shard.extend(min(threshold[a] for a in live), longest)
        waiting = []
        for a in live:
            allowed = ((shard.labels == anchors["labels"][a]) == same) & (shard.ids != anchors["ids"][a])
            partial = bounded and threshold[a] > 0
            if partial:
                at, scores = shard.join(cells[a], rests[a], threshold[a], allowed)
            else:  # the norms exclude nothing
                at = np.flatnonzero(allowed)
                scores = (cells[a] @ shard.columns[:, at]).astype(np.int64) if bounded else _exact(cells[a], shard.columns[:, at])
            # Places rise with ids, so of equal scores the smaller id comes first.
            best = np.argsort(~scores, kind="stable")
            at, scores = at[best], scores[best]
            found, filled = [], True
            for slot, (lo, hi) in enumerate(windows[a]):
                inside = np.flatnonzero((scores <= hi) & (scores >= lo))[:k]
                filled &= len(inside) == k or threshold[a] <= lo or lo > hi
                found.append((slot, inside))
            if partial and not filled:
                waiting.append(a)
                continue
            for slot, inside in found:
                rows = np.empty(len(inside), _FOUND)
                rows["at"], rows["slot"], rows["id"], rows["score"] = a, slot, shard.ids[at[inside]], scores[inside]
                out.append(rows)
        live = waiting
    return np.concatenate(out) if out else np.empty(0, _FOUND)


def best_found(found: np.ndarray, k: int) -> np.ndarray:
    """The best ``k`` rows of each window: higher score, then smaller id."""
    found = found[np.lexsort((found["id"], ~found["score"], found["slot"], found["at"]))]
    new = np.r_[True, (found["at"][1:] != found["at"][:-1]) | (found["slot"][1:] != found["slot"][:-1])] if len(found) else []
    first = np.flatnonzero(new)
    rank = np.arange(len(found)) - np.repeat(first, np.diff(np.r_[first, len(found)]))
    return found[rank < k]


def _unpacked(row: dict, prefix: str = "") -> dict:
    ids, blob, dim = np.frombuffer(row[prefix + "ids"], "<i8"), row[prefix + "cells"], row["dim"]
    kind = next((k for k, _ in _KINDS if len(blob) == len(ids) * dim * np.dtype(k).itemsize), "<f8")
    return {"ids": ids, "labels": np.frombuffer(row[prefix + "labels"], "<i8"),
            "cells": np.frombuffer(blob, kind).astype(np.float64).reshape(len(ids), dim)}


def _tile(k: int, same: bool, low: tuple[int, int]):
    """Join of one block of anchors with one shard. Without ``a_found`` the windows are open."""
    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                anchors, rows = _unpacked(row, "a_"), _unpacked(row)
                # Dimensions by falling energy of the shard; any order is right.
                order = np.argsort(-(rows["cells"] ** 2).sum(axis=0), kind="stable")
                anchors["cells"] = np.ascontiguousarray(anchors["cells"][:, order])
                squares = np.cumsum((anchors["cells"] ** 2)[:, ::-1], axis=1)[:, ::-1]
                anchors["rest"] = np.sqrt(np.hstack([squares, np.zeros((len(squares), 1))])) * (1 + 1e-9)
                windows: list[list[tuple[int, int]]] = [[] for _ in anchors["ids"]]
                if row["a_found"] is None:
                    windows = [[(_LONG.min, _LONG.max)] for _ in anchors["ids"]]
                else:
                    for at, _, _, score in np.frombuffer(row["a_found"], _FOUND).tolist():
                        windows[at].append((lowest(score, low), score))
                found = fill_windows(Shard(rows["ids"], rows["labels"], rows["cells"], order), anchors, windows, same, k)
                yield _list_row(row["a_block"], row["dim"], row["block"], best_found(found, k))
    return tile


def _list_row(block: int, dim: int, node: int, found: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((block, dim, node, found.tobytes()), _LIST_SCHEMA,
                                                                            strict=True)], schema=_LIST_SCHEMA)


def _merge(k: int) -> Callable[[tuple, pa.Table], pa.Table]:
    def merge(keys: tuple, table: pa.Table) -> pa.Table:
        found = np.empty(0, _FOUND)
        for blob in table.column("found").to_pylist():
            found = best_found(np.concatenate([found, np.frombuffer(blob, _FOUND)]), k)
        return pa.Table.from_batches([_list_row(keys[0].as_py(), keys[1].as_py(), int(keys[2].as_py()), found)])
    return merge


def search(blocks: DataFrame, shards: DataFrame, n_blocks: int, n_shards: int, k: int, same: bool,
           low: tuple[int, int], fan_in: int) -> DataFrame:
    """(a_block, dim, node, found): one merged list per block of anchors (a_block, ..., a_found)."""
    every = shards.withColumn("a_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    tiles = every.join(blocks.withColumnRenamed("dim", "a_dim").withColumnRenamed("a_block", "_block"),
                       (F.col("a_block") == F.col("_block")) & (F.col("dim") == F.col("a_dim"))).drop("_block", "a_dim")
    # One tile per task, however the join was done.
    lists = tiles.repartition(n_shards * n_blocks, "a_block", "block").mapInArrow(_tile(k, same, low), _LIST)
    nodes = n_shards
    while nodes > 1:
        nodes = -(-nodes // fan_in)
        lists = lists.withColumn("node", F.floor(F.col("node") / fan_in)) \
                     .groupBy("a_block", "dim", "node").applyInArrow(_merge(k), _LIST)
    return lists


def hard_negatives(vectors: DataFrame, is_anchor: Column, key: str = "vec_id", vector: str = "embedding",
                   label: str = "label", k_positive: int = 5, k_negative: int = 5, low: tuple[int, int] = (80, 100),
                   scale: float = 256.0, shard_rows: int = 8192, anchor_rows: int = 4096, fan_in: int = 8) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on the id column ``key``; ``low`` is the bottom of a window as a
    fraction of its positive's score.
    """
    rows = written(usable(vectors, key, vector, label), "vectors")
    named = rows.withColumnRenamed("key", "_key").withColumn(key, F.col("_key"))
    marked = named.withColumn("_anchor", is_anchor).select(F.col("_key").alias("key"), "label", "vector", "row", "_anchor")
    n, n_anchors = marked.agg(F.count(F.lit(1)), F.count_if("_anchor")).first()
    n_shards, n_blocks = max(1, -(-n // shard_rows)), max(1, -(-n_anchors // anchor_rows))
    shards = written(pack(rows, n_shards, scale), "shards")
    packed = pack(marked.where("_anchor").drop("_anchor"), n_blocks, scale)
    blocks = written(packed.select(F.col("block").alias("a_block"), "dim", *[F.col(c).alias(f"a_{c}") for c in ("ids", "labels", "cells")]),
                     "anchors")
    positives = written(search(blocks.withColumn("a_found", F.lit(None).cast("binary")), shards, n_blocks, n_shards,
                               k_positive, True, low, fan_in), "positives")
    opened = blocks.join(positives.select(F.col("a_block").alias("_block"), F.col("dim").alias("_dim"), F.col("found").alias("a_found")),
                         (F.col("a_block") == F.col("_block")) & (F.col("dim") == F.col("_dim"))).drop("_block", "_dim")
    opened = written(opened, "windows")
    found = search(opened, shards, n_blocks, n_shards, k_negative, False, low, fan_in)
    both = found.select(F.col("a_block").alias("_block"), F.col("dim").alias("_dim"), "found").join(
        opened, (F.col("a_block") == F.col("_block")) & (F.col("dim") == F.col("_dim"))).select("a_ids", "a_found", "found")
    return both.mapInArrow(_spell, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows and found rows of a block of anchors as rows."""
    for batch in batches:
        for row in batch.to_pylist():
            ids = np.frombuffer(row["a_ids"], "<i8")
            positive, found = np.frombuffer(row["a_found"], _FOUND), np.frombuffer(row["found"], _FOUND)
            # Positives stand by anchor in order of their slots, as do the found rows by (anchor, slot).
            first = np.searchsorted(positive["at"], np.arange(len(ids)))
            mine = positive[first[found["at"]] + found["slot"]]
            new = np.r_[True, (found["at"][1:] != found["at"][:-1]) | (found["slot"][1:] != found["slot"][:-1])] if len(found) else []
            start = np.flatnonzero(new)
            rank = np.arange(len(found)) - np.repeat(start, np.diff(np.r_[start, len(found)])) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[found["at"]]), pa.array(mine["id"]), pa.array(rank.astype(np.int32)), pa.array(found["id"]),
                 pa.array(mine["score"]), pa.array(found["score"])],
                names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"])
