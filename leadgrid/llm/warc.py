"""WARC archives: a deterministic sharded writer with revisit records, and a reader.

Records are range-sorted by id. The ranges come from the ids with the smallest hashes, a
uniform sample of fixed size that is the same in every run, so the same pages give the same
files byte by byte. Each record is a gzip member of its own; a file is closed when its
compressed size passes ``file_bytes``. Headers are regenerated: lengths, record ids and SHA-1
digests follow from the content, the date is a parameter.

Of pages with equal payloads of at least ``revisit_bytes`` bytes the one with the largest id
is the response, the others become revisit records that refer to it.

Files are written under temporary names of each attempt. The manifest of the attempts that
Spark accepts is stored first, then a second job gives the files their final names (a file
that already has it is left), and only then is the final manifest written: readers go by that
manifest and never see a partial archive or a lost attempt's file. Files are reached through
``pyarrow.fs``, so the root may be any store it knows; it must be shared by all executors.

A null payload is empty. Pages that share both the largest id and the payload are all
responses. A null id is smaller than any other and has no id header. Null urls have no target header;
line ends in urls are percent-encoded. An empty table gives an empty archive. Other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadgrid.llm.common import batched, rows_of
from leadgrid.session import written

_LEVEL = 4
_SAMPLE = 1024
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the URL namespace
MANIFEST = "shard int, seq int, temporary string, name string, bytes long, records long, sha256 string"
_MANIFEST_SCHEMA = pa.schema([("shard", pa.int32()), ("seq", pa.int32()), ("temporary", pa.string()),
                              ("name", pa.string()), ("bytes", pa.int64()), ("records", pa.int64()),
                              ("sha256", pa.string())])
RECORD = ("page_id long, url string, record_type string, payload_bytes long, payload_digest string, "
          "refers_to long, payload binary")
_RECORD_SCHEMA = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                            ("refers_to", pa.int64()), ("payload", pa.binary())])


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_urn(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id}/{digest}')}>"


def build_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit (``refers_to`` given) keeps the response's headers, not its payload."""
    digest = base32_sha1(payload)
    block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
             + str(len(payload)).encode() + b"\r\n\r\n")
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", record_urn(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        clean = "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
        head.append(("WARC-Target-URI", clean))
    if page_id is not None:
        head.append(("X-Page-ID", str(page_id)))
    if refers_to is None:
        block += payload
    else:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", record_urn(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in head)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """Fields of a record; digests and lengths are checked against the content."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[:int(fields["Content-Length"])]
    if f"sha1:{base32_sha1(block)}" != fields["WARC-Block-Digest"]:
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != length or base32_sha1(payload) != digest):
        raise ValueError("payload differs from its headers")
    number = {n: int(fields[n]) if n in fields else None for n in ("X-Page-ID", "X-Refers-To-Page-ID")}
    return (number["X-Page-ID"], fields.get("WARC-Target-URI"), kind, length, digest,
            number["X-Refers-To-Page-ID"], payload if kind == "response" else None)


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(_LEVEL, zlib.DEFLATED, 31)  # no time stamp: equal input, equal bytes
    return packer.compress(data) + packer.flush()


class _File:
    """An archive file in the making, under a name of this attempt."""

    def __init__(self, store: fs.FileSystem, root: str, shard: int, seq: int):
        self.shard, self.seq = shard, seq
        self.name = f"part-{shard:06d}-{seq:05d}.warc.gz"
        self.temporary = f".{self.name}.{uuid.uuid4().hex}"
        self.out = store.open_output_stream(f"{root}/{self.temporary}", compression=None)
        self.bytes = self.records = 0
        self.digest = hashlib.sha256()

    def add(self, member: bytes) -> None:
        self.out.write(member)
        self.digest.update(member)
        self.bytes += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        return (self.shard, self.seq, self.temporary, self.name, self.bytes, self.records, self.digest.hexdigest())


def shard_bounds(pages: DataFrame, key: str, rows: int, total_bytes: int, shard_bytes: int) -> list[int]:
    """Ids that divide the pages into about ``total_bytes / shard_bytes`` ranges; the same in every run."""
    shards = max(1, -(-total_bytes // shard_bytes))
    size = _SAMPLE + 16 * shards
    # About twice the sample passes the bound on hashes, so that no task sorts or sends more.
    bound = int(min(1.0, 2 * size / max(1, rows)) * 2 ** 64) - 2 ** 63
    hashed = pages.where(F.col(key).isNotNull()).select(F.col(key).alias("id"), F.xxhash64(key).alias("h")) \
                  .where(F.col("h") <= min(bound, 2 ** 63 - 1))
    sample = sorted(r[0] for r in hashed.orderBy("h", "id").limit(size).collect())  # at most ``size`` ids
    return sorted({sample[len(sample) * i // shards] for i in range(1, shards)}) if sample else []


def with_revisits(pages: DataFrame, key: str, revisit_bytes: int) -> DataFrame:
    """Pages (key, url, body) with ``refers_to``: the largest id of an equal payload, null for responses."""
    digest = F.sha1("body")
    groups = pages.select(key, digest.alias("_digest"), F.octet_length("body").alias("_n")) \
                  .where(F.col("_n") >= revisit_bytes).groupBy("_digest") \
                  .agg(F.max(key).alias("_best"), F.count(F.lit(1)).alias("_pages")).where("_pages > 1") \
                  .select(F.col("_digest").alias("_same"), "_best")
    # Written first, so that its size is known when the join is planned: a small table is
    # broadcast, a large one meets the pages by digest.
    groups = written(groups, "revisits")
    joined = pages.withColumn("_digest", digest).join(groups, F.col("_digest") == F.col("_same"), "left")
    is_revisit = F.col("_best").isNotNull() & ~F.col("_best").eqNullSafe(F.col(key))
    return joined.select(key, "url", "body", F.when(is_revisit, F.col("_best")).alias("refers_to"))


def write_archive(pages: DataFrame, root: str, key: str = "page_id", url: str = "url", payload: str = "html",
                  revisit_bytes: int = 0, date: str = "2020-01-01T00:00:00Z", file_bytes: int = 64 << 20,
                  shard_bytes: int = 32 << 20) -> DataFrame:
    """Write all pages under ``root`` and return the manifest: one row per committed file."""
    spark = pages.sparkSession
    slim = pages.select(F.col(key).cast("long").alias("key"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("body"))
    rows, total = slim.agg(F.count(F.lit(1)), F.sum(F.octet_length("body"))).first()
    bounds = shard_bounds(slim, "key", rows, total or 0, shard_bytes)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:  # number of bounds at or below the id; 0 without an id
        places = np.searchsorted(np.array(bounds, np.int64), ids.fillna(0).astype("int64"), side="right")
        return pd.Series(np.where(ids.isna(), 0, places).astype("int32"))

    ranged = with_revisits(slim, "key", revisit_bytes).withColumn("shard", shard_of("key")) \
        .repartitionById(len(bounds) + 1, "shard") \
        .sortWithinPartitions("shard", F.col("key").asc_nulls_first(), "url", "refers_to", "body")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def files():
            store, base = fs.FileSystem.from_uri(root)
            store.create_dir(base, recursive=True)
            out = None
            for shard_no, page_id, page_url, body, refers_to in rows_of(
                    batches, "shard", "key", "url", "body", "refers_to"):
                if out is not None and (out.shard != shard_no or out.bytes >= file_bytes):
                    seq = out.seq + 1 if out.shard == shard_no else 0
                    yield out.close()
                    out = _File(store, base, shard_no, seq)
                if out is None:
                    out = _File(store, base, shard_no, 0)
                out.add(_gzip(build_record(page_id, page_url, body, refers_to, date)))
            if out is not None:
                yield out.close()
        yield from batched(files(), _MANIFEST_SCHEMA)

    accepted = f"{root}/_accepted"
    ranged.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(accepted)

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for row in batch.to_pylist():
                if store.get_file_info(f"{base}/{row['temporary']}").type != fs.FileType.NotFound:
                    store.move(f"{base}/{row['temporary']}", f"{base}/{row['name']}")
                elif store.get_file_info(f"{base}/{row['name']}").size != row["bytes"]:
                    raise OSError(f"lost {row['name']}")
            yield batch

    spark.read.parquet(accepted).mapInArrow(commit, MANIFEST).write.mode("overwrite").parquet(f"{root}/manifest")
    return spark.read.parquet(f"{root}/manifest")


def read_archive(spark: SparkSession, root: str, with_payload: bool = True, tasks: int | None = None) -> DataFrame:
    """Records of all files in the manifest, checked against their digests; one file per task at a time."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            store, base = fs.FileSystem.from_uri(root)
            for (name,) in rows_of(batches, "name"):
                with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for member in _members(source):
                        fields = parse_record(member)
                        yield fields if with_payload else (*fields[:-1], None)
        yield from batched(records(), _RECORD_SCHEMA, 256)

    files = spark.read.parquet(f"{root}/manifest").select("name")
    return files.repartition(tasks or spark.sparkContext.defaultParallelism, "name").mapInArrow(read, RECORD)


def _members(source, step: int = 1 << 20) -> Iterator[bytes]:
    """Unpacked gzip members of a stream, one at a time."""
    unpacker, out = zlib.decompressobj(31), []
    data = source.read(step)
    while data:
        out.append(unpacker.decompress(data))
        data = unpacker.unused_data
        if unpacker.eof:
            yield b"".join(out)
            unpacker, out = zlib.decompressobj(31), []
        data = data or source.read(step)
    if out:
        raise ValueError("the file ends inside a record")
