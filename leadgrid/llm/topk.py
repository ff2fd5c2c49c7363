"""Exact top-k by inner product: tiled matrix products, selection per tile, a merge tree of lists.

Vectors are packed into shards of about ``shard_rows`` rows, queries into blocks of about
``query_rows``. Each pair (query block, shard) is one tile: a matrix product, and a partial
selection of the best k columns of each row. The lists of a query block are merged in a tree
of fan-in ``fan_in``. A task holds one shard and one query block, whatever the table's size;
shards travel once per query block, which is the price of an exact search.

Components become ``floor(scale * x)`` and scores are integers: products of doubles while
every partial sum stays below 2**53, else exact integers, cut off at the range of a long.

Vectors that are null, or hold a null or a non-finite component, and rows without an id take
no part. Rows that repeat an id are rows of their own, as candidates and as queries: each query
row has its list. A query never meets its own id. Vectors of different lengths are not compared.
Ties go to the smaller id.
A query without candidates has no rows, nor has an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadgrid.session import written

_LONG = np.iinfo(np.int64)
_FILLER = _LONG.min  # the score of a place without a candidate
_PACK = "block long, dim int, ids binary, cells binary"
_LIST = "q_block long, dim int, node long, q_ids binary, ids binary, scores binary"
_PACK_SCHEMA = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("ids", pa.binary()), ("cells", pa.binary())])
_LIST_SCHEMA = pa.schema([("q_block", pa.int64()), ("dim", pa.int32()), ("node", pa.int64()), ("q_ids", pa.binary()),
                          ("ids", pa.binary()), ("scores", pa.binary())])
_TOP_SCHEMA = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, vector, row) of the rows that take part; ``row`` tells rows of one id apart."""
    finite = F.forall(F.col(vector).cast("array<double>"),
                      lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vectors.where(F.col(key).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(key).cast("long").alias("key"), F.col(vector).alias("vector"), finite.alias("_finite")) \
        .where("_finite").drop("_finite").withColumn("row", F.monotonically_increasing_id())


def pack(rows: DataFrame, blocks: int, scale: float) -> DataFrame:
    """One row per (block, length): sorted ids and the matrix of scaled, floored components."""
    def pack_block(keys: tuple, table: pa.Table) -> pa.Table:
        ids = table.column("key").to_numpy()
        # A block that is packed again, after the loss of an executor, has the same order.
        order = np.lexsort((table.column("row").to_numpy(), ids))
        flat = table.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        dim = keys[1].as_py()
        cells = np.floor(scale * flat.astype(np.float64).reshape(len(ids), dim))[order]
        # Half the size where single precision holds the whole numbers exactly.
        kind = "<f4" if np.abs(cells).max(initial=0) <= 2 ** 24 else "<f8"
        return pa.table([[keys[0].as_py()], [dim], [ids[order].astype("<i8").tobytes()],
                         [cells.astype(kind).tobytes()]], schema=_PACK_SCHEMA)

    return rows.withColumn("block", F.pmod(F.xxhash64("key", "row"), F.lit(blocks))).withColumn("dim", F.size("vector")) \
               .groupBy("block", "dim").applyInArrow(pack_block, _PACK)


def products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through Python integers where doubles could round."""
    bound = float(np.abs(queries).max(initial=0)) * float(np.abs(shard).max(initial=0)) * max(1, queries.shape[1])
    if bound < 2 ** 53:
        return (queries @ shard.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    exact = whole(queries).dot(whole(shard).T)
    return np.clip(exact, _FILLER + 1, _LONG.max).astype(np.int64)


def tile_top(q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, shard: np.ndarray, k: int,
             rows: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Best k candidates of each query in one tile; short lists end in fillers."""
    top_ids = np.zeros((len(q_ids), k), np.int64)
    top = np.full((len(q_ids), k), _FILLER, np.int64)
    for at in range(0, len(q_ids), rows):
        scores = products(queries[at:at + rows], shard)
        for r, line in enumerate(scores, at):
            line[ids == q_ids[r]] = _FILLER
            picked = np.arange(len(line))
            if len(line) > k:
                picked = np.flatnonzero(line >= np.partition(line, len(line) - k)[len(line) - k])
            # Ids ascend, so of equal scores the smaller id comes first.
            best = picked[np.argsort(~line[picked], kind="stable")[:k]]
            top_ids[r, :len(best)] = ids[best]
            top[r, :len(best)] = line[best]
    return top_ids, top


def merge_top(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Best k of each row of concatenated lists: higher score, then smaller id; fillers last."""
    # The complement of a score sorts it downwards without overflow.
    order = np.lexsort((ids, ~scores), axis=1)[:, :k]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)


def top_k(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 20,
          scale: float = 64.0, shard_rows: int = 8192, query_rows: int = 2048, fan_in: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best candidates of each query row.

    ``is_query`` is a condition on the id column ``key``.
    """
    rows = written(usable(vectors, key, vector), "vectors")
    named = rows.withColumnRenamed("key", key)
    n, n_queries = named.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    chosen = named.where(is_query).withColumnRenamed(key, "key")
    shards, q_blocks = max(1, -(-n // shard_rows)), max(1, -(-n_queries // query_rows))
    left = pack(chosen, q_blocks, scale).select(F.col("block").alias("q_block"), F.col("dim").alias("q_dim"),
                                                F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))
    right = pack(rows, shards, scale).withColumn("q_block", F.explode(
        F.sequence(F.lit(0).cast("long"), F.lit(q_blocks - 1).cast("long"))))
    tiles = right.join(left, (right["q_block"] == left["q_block"]) & (F.col("dim") == F.col("q_dim"))) \
                 .select(left["q_block"], "dim", F.col("block").alias("node"), "q_ids", "q_cells", "ids", "cells")
    # One tile per task, however the join was done.
    lists = tiles.repartition(shards * q_blocks, "q_block", "node").mapInArrow(_tile(k), _LIST)
    nodes = shards
    while nodes > 1:
        nodes = -(-nodes // fan_in)
        lists = lists.withColumn("node", F.floor(F.col("node") / fan_in)) \
                     .groupBy("q_block", "dim", "node").applyInArrow(_merge(k), _LIST)
    return lists.mapInArrow(_unpack(k), "query_id long, rank int, vec_id long, score long")


def _matrix(cells: bytes, rows: int, dim: int) -> np.ndarray:
    if not dim:
        return np.zeros((rows, 0))
    return np.frombuffer(cells, "<f4" if len(cells) == 4 * rows * dim else "<f8").reshape(rows, dim).astype(np.float64)


def _tile(k: int):
    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dim = row["dim"]
                q_ids, ids = np.frombuffer(row["q_ids"], "<i8"), np.frombuffer(row["ids"], "<i8")
                found = tile_top(q_ids, _matrix(row["q_cells"], len(q_ids), dim), ids,
                                 _matrix(row["cells"], len(ids), dim), k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], f.type) for v, f in zip(
                        (row["q_block"], dim, row["node"], row["q_ids"], found[0].tobytes(), found[1].tobytes()),
                        _LIST_SCHEMA, strict=True)], schema=_LIST_SCHEMA)
    return tile


def _lists(value: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(value["q_ids"], "<i8"), np.frombuffer(value["ids"], "<i8").reshape(-1, k),
            np.frombuffer(value["scores"], "<i8").reshape(-1, k))


def _merge(k: int):
    def merge(keys: tuple, table: pa.Table) -> pa.Table:
        ids = scores = None
        for row in table.to_pylist():
            q_ids, more_ids, more = _lists(row, k)  # every list of a query block has the same queries
            if ids is None:
                ids, scores = more_ids, more
            else:
                ids, scores = merge_top(np.hstack([ids, more_ids]), np.hstack([scores, more]), k)
        return pa.table([[keys[0].as_py()], [keys[1].as_py()], [int(keys[2].as_py())], [q_ids.tobytes()],
                         [np.ascontiguousarray(ids).tobytes()], [np.ascontiguousarray(scores).tobytes()]],
                        schema=_LIST_SCHEMA)
    return merge


def _unpack(k: int):
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                q_ids, ids, scores = _lists(row, k)
                held = scores > _FILLER
                at, rank = np.nonzero(held)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[at]), pa.array((rank + 1).astype(np.int32)), pa.array(ids[held]),
                     pa.array(scores[held])], schema=_TOP_SCHEMA)
    return unpack
