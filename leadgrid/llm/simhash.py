"""SimHash near-duplicates by multi-index hashing, and their connected components.

A fingerprint has a bit set where over half the XXH64 hashes of a text's features have it.
Two fingerprints within ``distance`` bits agree up to ``r = distance // segments`` bits in at
least one of their segments. Each distinct fingerprint enters its segment tables under a small
Hamming ball: itself, for r = 1 also each value with one more bit set (of two values one bit
apart the smaller reaches the larger), for r = 2 each value with one bit flipped (two values two
bits apart share a value between them). Fingerprints that meet under a key are compared over
all 64 bits. Longer sketches are filed in the same way by segments of their own, r = 2, and
compared over all their bits: no other feature decides which sketches meet.

Copies collapse before any table is built: a node is a distinct fingerprint with its smallest
document. Keys are spread by hash; a task gets about 250,000 entries and emits at most a
spanning forest of the links it verified, never the pairs of a group. Under a crowded key a
pivot links all fingerprints near it, and only those that are not near it are compared further,
so a tight cluster costs little more than its size.

Null text is empty; empty texts have the fingerprint zero and link like any other. Rows that
repeat an id are one document. Rows without an id link nothing; their component is that of
their fingerprint among the rows with ids, else null. An empty table yields an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import batched, id_and_bytes, rows_of, space_words, utf8
from leadgrid.llm.components import stars
from leadgrid.session import written

SEED = 42
_CHUNK = 65536
_CROWD = 64
_ENTRIES = 250_000
_PRINT_SCHEMA = pa.schema([("key", pa.int64()), ("fp", pa.int64()), ("sketch", pa.binary())])
_ROW_SCHEMA = pa.schema([("key", pa.int64()), ("hash", pa.int64()), ("sketch", pa.binary())])
_BLOB_SCHEMA = pa.schema([("bucket", pa.int64()), ("blob", pa.binary())])


def _entry(sketch_words: int) -> np.dtype:
    """A fingerprint filed under a key, or a sketch of that many 64-bit words."""
    filed = ("sketch", "<u8", (sketch_words,)) if sketch_words else ("fp", "<u8")
    return np.dtype([("key", "<u4"), filed, ("node", "<i8")])


def sketch(body: bytes, shingle: int, words: int) -> bytes:
    """SimHash of the distinct word shingles: how often one repeats says nothing about the sets' similarity."""
    return simhash(set(shingles(space_words(body), shingle)), words)


def shingles(words: list[bytes], n: int) -> Iterator[bytes]:
    """Runs of ``n`` words, repeats included; fewer words make one run."""
    for i in range(max(1, len(words) - n + 1) if words else 0):
        yield b" ".join(words[i:i + n])


def simhash(features: Iterable[bytes], words: int = 1) -> bytes:
    """SimHash of the features, 64 bits for each word; zeros without features.

    The first word's votes are the XXH64 hashes with the seed SEED, those of each further word the same
    hashes mixed anew, so that a feature is hashed once.
    """
    votes, n = np.zeros((words, 64), np.int64), 0
    features = iter(features)
    while part := list(islice(features, _CHUNK)):
        n += len(part)
        hashes = np.array([xxhash.xxh64_intdigest(f, SEED) for f in part], dtype=np.uint64)
        for w in range(words):
            bits = (_mixed(hashes, w) if w else hashes).astype(">u8").view(np.uint8)
            votes[w] += np.unpackbits(bits.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > n, axis=1).tobytes() if n else bytes(8 * words)


def _mixed(hashes: np.ndarray, word: int) -> np.ndarray:
    """The hashes moved by a multiple of an odd constant, then mixed by shifts and odd products (modulo 2**64)."""
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int, sketch_words: int = 0) -> DataFrame:
    """(key, fp, sketch): fp is the SimHash of the word shingles, repeats included. With ``sketch_words`` the
    sketch is that of the distinct shingles, of so many 64-bit words, whose first is fp."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for doc, body in rows_of(batches, "key", "body"):
                bits = sketch(body, shingle, sketch_words) if sketch_words else simhash(shingles(space_words(body), shingle))
                yield doc, int.from_bytes(bits[:8], "big", signed=True), bits if sketch_words else b""
        yield from batched(rows(), _PRINT_SCHEMA)

    return id_and_bytes(docs, key, text).mapInArrow(scan, "key long, fp long, sketch binary")


def segment_bounds(segments: int, width: int = 64) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment of ``width`` bits."""
    edges = [width * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def ball(values: np.ndarray, bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, key) of every key under which a segment value is filed."""
    keys, index = [values], [np.arange(len(values))]
    for bit in range(bits if radius else 0):
        mask = np.uint64(1 << bit)
        chosen = np.flatnonzero(values & mask == 0) if radius == 1 else index[0]
        keys.append(values[chosen] ^ mask)
        index.append(chosen)
    return np.concatenate(index), np.concatenate(keys)


def _entries(distance: int, segments: int, buckets: int):
    """Distinct fingerprints to packed entries by bucket; a bucket serves one segment."""
    radius, entry = distance // segments, _entry(0)

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, node = batch.column("fp").to_numpy().view(np.uint64), batch.column("node").to_numpy()
            for s, (first, bits) in enumerate(segment_bounds(segments)):
                values = (fp >> np.uint64(first)) & np.uint64((1 << bits) - 1)
                index, keys = ball(values, bits, radius)
                bucket = (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) % np.uint64(buckets)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
                for b in range(buckets):
                    chosen = order[ends[b]:ends[b + 1]]
                    if len(chosen):
                        packed, at = np.empty(len(chosen), entry), index[chosen]
                        packed["key"], packed["fp"], packed["node"] = keys[chosen], fp[at], node[at]
                        yield _blob(s * buckets + b, packed)
    return file


def _blob(bucket: int, packed: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([packed.tobytes()], pa.binary())],
                                      schema=_BLOB_SCHEMA)


def segment_values(sketch: np.ndarray, first: int, bits: int) -> np.ndarray:
    """The ``bits`` bits from ``first`` on of each sketch (rows of 64-bit words)."""
    word, shift = divmod(first, 64)
    values = sketch[:, word] >> np.uint64(shift)
    if shift + bits > 64:
        values = values | sketch[:, word + 1] << np.uint64(64 - shift)
    return values & np.uint64((1 << bits) - 1)


def _sketches(segments: int, top: int, sketch_words: int):
    """Distinct sketches to the buckets that hold a key of theirs; a bucket is a segment and the ``top``
    highest bits of its keys. A ball meets ``top + 1`` buckets, and is spelled out only there."""
    kind = np.dtype([("sketch", "<u8", (sketch_words,)), ("node", "<i8")])

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = np.empty(batch.num_rows, kind)
            packed["node"] = batch.column("node").to_numpy()
            packed["sketch"] = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), "<u8").reshape(-1, sketch_words)
            for s, (first, bits) in enumerate(segment_bounds(segments, 64 * sketch_words)):
                high = segment_values(packed["sketch"], first, bits) >> np.uint64(bits - top)
                index, bucket = ball(high, top, 2)
                order = np.argsort(bucket, kind="stable")
                ends = np.searchsorted(bucket[order], np.arange((1 << top) + 1))
                for b in np.flatnonzero(np.diff(ends)).tolist():
                    yield _blob(s << top | b, packed[index[order[ends[b]:ends[b + 1]]]])
    return kind, file


def sketch_entries(packed: np.ndarray, bucket: int, segments: int, top: int) -> np.ndarray:
    """Entries of a bucket: a sketch whose own value lies in it under that value and each value with one
    lower bit flipped, another under the one value in it."""
    words = packed["sketch"].shape[1]
    first, bits = segment_bounds(segments, 64 * words)[bucket >> top]
    values, low = segment_values(packed["sketch"], first, bits), bits - top
    here = np.uint64(bucket & (1 << top) - 1)
    home = np.flatnonzero(values >> np.uint64(low) == here)
    away = np.flatnonzero(values >> np.uint64(low) != here)
    index, keys = ball(values[home], low, 2)
    at = np.concatenate([home[index], away])
    entries = np.empty(len(at), _entry(words))
    entries["key"] = np.concatenate([keys, here << np.uint64(low) | values[away] & np.uint64((1 << low) - 1)])
    entries["sketch"], entries["node"] = packed["sketch"][at], packed["node"][at]
    return entries


class Forest:
    """Union-find that keeps only the links that join two trees."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def links(self) -> list[tuple[int, int]]:
        return [(x, self.root(x)) for x in self.parent if self.root(x) != x]


def near_pairs(entries: np.ndarray, distance: int, sketch_distance: int) -> Forest:
    """Spanning forest over the entries that share a key and lie within the distance of their kind."""
    entries = entries[np.argsort(entries["key"], kind="stable")]
    node, sketched = entries["node"], "sketch" in entries.dtype.names
    bits = np.ascontiguousarray(entries["sketch" if sketched else "fp"])

    def near(i, j) -> np.ndarray:
        """Which of the pairs (i, j) are near; ``j`` is an array, ``i`` an array as long or one place."""
        apart = np.bitwise_count(bits[i] ^ bits[j])
        return apart.sum(axis=1, dtype=np.int64) <= sketch_distance if sketched else apart <= distance

    forest = Forest()
    starts = np.flatnonzero(np.r_[True, entries["key"][1:] != entries["key"][:-1]])
    sizes = np.diff(np.r_[starts, len(entries)])
    first = np.repeat(starts, sizes)
    ends = first + np.repeat(sizes, sizes)
    here = np.arange(len(entries))
    small = np.repeat(sizes <= _CROWD, sizes)
    pairs = []
    for gap in range(1, int(min(_CROWD, sizes.max(initial=1)))):
        i = here[small & (here + gap < ends)]
        if not len(i):
            break
        i = i[near(i, i + gap)]
        pairs.append(np.stack([node[i], node[i + gap]], 1))
    if pairs:
        for a, b in np.unique(np.concatenate(pairs), axis=0).tolist():
            forest.link(a, b)
    for at, size in zip(starts[sizes > _CROWD].tolist(), sizes[sizes > _CROWD].tolist(), strict=True):
        rest = np.arange(at, at + size)
        while len(rest) > 1:
            pivot, rest = rest[0], rest[1:]
            close = near(pivot, rest)
            linked, rest = rest[close], rest[~close]
            for x in linked.tolist():
                forest.link(int(node[pivot]), int(node[x]))
            for x in rest.tolist() if len(linked) else ():  # one link to the pivot's cluster is enough
                hit = near(x, linked)
                if hit.any():
                    forest.link(int(node[x]), int(node[pivot]))
    return forest


def links(nodes: DataFrame, distance: int, segments: int) -> DataFrame:
    """(a, b) links between nodes (node, fp); connects whatever is within the distance."""
    if not 2 <= segments or distance // segments > 2:
        raise ValueError("take at least two segments, and so many that a ball's radius is at most 2")
    width, entry = 64 // segments + 1, _entry(0)
    buckets = max(1, math.ceil(nodes.count() * (1, width // 2 + 1, width)[distance // segments] / _ENTRIES))

    def compare(table: pa.Table) -> pa.Table:
        return _found(near_pairs(np.concatenate([np.frombuffer(b, entry) for b in table.column("blob").to_pylist()]), distance, 0))

    blobs = nodes.mapInArrow(_entries(distance, segments, buckets), "bucket long, blob binary")
    return blobs.groupBy("bucket").applyInArrow(compare, "a long, b long")


def _found(forest: Forest) -> pa.Table:
    found = forest.links()
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def sketch_links(nodes: DataFrame, distance: int, segments: int, sketch_words: int) -> DataFrame:
    """(a, b) links between nodes (node, sketch); connects whatever is within the distance."""
    if distance // segments > 2:
        raise ValueError("take so many segments that a ball's radius is at most 2")
    bits = 64 * sketch_words // segments
    top = min(bits, math.ceil(math.log2(max(1, nodes.count() * (bits + 1) / _ENTRIES))))
    kind, file = _sketches(segments, top, sketch_words)

    def compare(key: tuple, table: pa.Table) -> pa.Table:
        packed = np.concatenate([np.frombuffer(b, kind) for b in table.column("blob").to_pylist()])
        return _found(near_pairs(sketch_entries(packed, key[0].as_py(), segments, top), 0, distance))

    return nodes.mapInArrow(file, "bucket long, blob binary").groupBy("bucket").applyInArrow(compare, "a long, b long")


def components(prints: DataFrame, distance: int, segments: int, sketch_words: int = 0,
               sketch_distance: int = 0) -> DataFrame:
    """(key, fp, sketch, component_id): components of the links between written ``prints``."""
    nodes = written(prints.groupBy("fp", "sketch").agg(F.min("key").alias("node")), "simhash-nodes")
    known = nodes.where("node IS NOT NULL")
    joined = stars(sketch_links(known, sketch_distance, segments, sketch_words) if sketch_words
                   else links(known, distance, segments))
    # A node without links is its own component.
    placed = nodes.join(joined.withColumnRenamed("a", "node"), "node", "left") \
                  .select(F.col("fp").alias("_fp"), F.col("sketch").alias("_sketch"),
                          F.coalesce("b", "node").alias("component_id"))
    return prints.join(placed, (F.col("fp") == F.col("_fp")) & (F.col("sketch") == F.col("_sketch")), "left") \
                 .drop("_fp", "_sketch")


def simhash_components(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3,
                       distance: int = 2, segments: int = 2) -> DataFrame:
    """Per document: fingerprint (16 hexadecimal digits) and component_id, the smallest id reachable."""
    prints = written(fingerprints(docs, key, text, shingle), "simhash")
    found = components(prints, distance, segments)
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("key").alias(key), digits.alias("fingerprint"), "component_id")


def sketch_bits(similarity: float, bits: int) -> int:
    """Differing bits of sketches of shingle sets of that Jaccard similarity, one deviation added.

    Equal-sized sets of similarity s have the cosine 2s / (1 + s); a bit differs with probability angle / pi.
    """
    p = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return round(bits * p + math.sqrt(bits * p * (1 - p)))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5,
                    similarity: float = 0.8, segments: int = 16, sketch_words: int = 4) -> DataFrame:
    """(key, component_id) of documents whose word shingles are about ``similarity`` alike or more.

    The sketch of the shingles decides, and the tables are searched by its own segments: every
    pair within its distance meets, whatever kind of edit lies between the two.
    """
    prints = written(fingerprints(docs, key, text, shingle, sketch_words), "simhash")
    return components(prints, 0, segments, sketch_words, sketch_bits(similarity, 64 * sketch_words)) \
        .select(F.col("key").alias(key), "component_id")


def near_duplicate_rows(docs: DataFrame, key: str, text: str, shingle: int, similarity: float, segments: int,
                        sketch_words: int) -> tuple[DataFrame, DataFrame]:
    """(key, hash, group) of every row, ``hash`` being that of its text, and (group, first) of every group, the
    row that stays: the smallest id, nulls last, and of one id the text with the smallest hash."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(((k, h, sketch(b, shingle, sketch_words))
                            for k, h, b in rows_of(batches, "key", "hash", "body")), _ROW_SCHEMA)

    hashed = id_and_bytes(docs, key, text).withColumn("hash", F.xxhash64("body"))
    prints = written(hashed.mapInArrow(scan, "key long, hash long, sketch binary"), "sketches")
    row = F.struct(F.col("key").isNull().alias("no_id"), "key", "hash")
    # Nodes get numbers of their own, which the written table fixes: rows without an id link like all others.
    nodes = written(prints.groupBy("sketch").agg(F.min(row).alias("first")).withColumn("node", F.monotonically_increasing_id()), "nodes")
    joined = stars(sketch_links(nodes, sketch_bits(similarity, 64 * sketch_words), segments, sketch_words))
    placed = written(nodes.join(joined.withColumnRenamed("a", "node"), "node", "left")
                     .select("sketch", "first", F.coalesce("b", "node").alias("group")), "groups")
    firsts = placed.groupBy("group").agg(F.min("first").alias("first"))
    return prints.join(placed.select("sketch", "group"), "sketch").drop("sketch"), firsts


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, similarity: float = 0.8,
               segments: int = 16, sketch_words: int = 4) -> DataFrame:
    """The documents, all columns, one row of each near-duplicate group.

    The row with the smallest id stays, rows without an id coming last; of rows that repeat that id, the
    one whose text has the smallest hash; of rows that repeat id and text, the one whose columns have
    the smallest hash. Rows are judged by id and text: another text under the id of a copy stays.
    Texts are shuffled only where id and text repeat.
    """
    rows, firsts = near_duplicate_rows(docs, key, text, shingle, similarity, segments, sketch_words)
    judged = written(
        rows.groupBy("key", "hash", "group").agg(F.count(F.lit(1)).alias("n")).join(firsts, "group")
        .select(F.col("key").alias("_key"), F.col("hash").alias("_hash"), "n",
                (F.col("key").eqNullSafe(F.col("first.key")) & (F.col("hash") == F.col("first.hash"))).alias("stays")), "judged")
    ids = written(judged.groupBy("_key").agg(F.max("stays").alias("some")).where("NOT some AND _key IS NOT NULL").select("_key"), "ids")
    # Ids of which no text stays go by the id alone; only where texts of one id part is the text's hash compared.
    # Written, so that their sizes are known when the joins are planned.
    gone = written(judged.where("NOT stays").select("_key", "_hash").join(ids, "_key", "left_anti"), "copies")
    repeated = written(judged.where("stays AND n > 1").select("_key", "_hash"), "repeated")
    body, number = utf8(text), docs[key].cast("long")
    same = number.eqNullSafe(F.col("_key")) & (F.xxhash64(body) == F.col("_hash"))
    kept = docs.join(ids, number == F.col("_key"), "left_anti").join(gone, same, "left_anti")
    if repeated.isEmpty():
        return kept
    whole = F.struct(*[F.col(c) for c in docs.columns])
    once = kept.join(repeated, same, "left_semi").groupBy(F.col(key).alias("_key"), F.xxhash64(body).alias("_hash")) \
        .agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("_row")).select("_row.*")
    return kept.join(repeated, same, "left_anti").unionByName(once)
