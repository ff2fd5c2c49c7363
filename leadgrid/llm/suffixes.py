"""Removal of repeated passages: a distributed merge sort of sampled suffixes with front coding.

A byte goes when it lies in a string of ``length`` bytes that also starts in a document with a
smaller id. Sorting every suffix would move many times the corpus; these steps move a part of it:

1. Sampling. Of the ``length - gram + 1`` grams in a string of ``length`` bytes the one with the
   smallest hash is its anchor. Equal strings have equal anchors at the same place, so
   suffixes need to be sorted at anchors only, about every 16th byte. The strings with the same
   anchor start side by side: a *unit*, up to 80 bytes of text around the anchor.
2. Distinguishing prefixes. Hashes of the anchors' grams go to buckets; only anchors whose
   gram stands in two documents can matter, and go on.
3. Runs. Each group of documents sorts its units by the suffix at the anchor, then the text
   before it. Equal units collapse to the smallest document; the others are covered already. The
   sorted run is front-coded: the common prefix with the unit before, and the rest.
4. Exchange and merge. Runs are split by gram, so that equal anchors meet, and merged by
   LCP loser trees, whose prefix lengths tell equal units and equal grams without comparing.
5. Matches. Under each gram the strings of neighbouring units are told apart by hash and
   compared byte by byte with the first of their hash; a string in a smaller document
   covers it here. Covered ranges return to their documents.

A gram in more than ``crowd`` places of a bucket (a line that every page repeats) would bring
all its surroundings into one task: there each string becomes a unit of its own, spread by
its whole content, equal ones collapsing in every run.

Documents are shuffled once, into groups of about ``group_bytes`` of text; a task holds one
group or one bucket. Group and bucket counts follow from the size of the corpus.

Null text is empty. Rows without an id keep all bytes and cover none. Rows that repeat an id
do not cover each other. Texts shorter than ``length`` stay whole. An empty table yields an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import rows_of, utf8
from leadgrid.llm.losertree import WIDTH, as_strings, as_words, merge_runs, neighbour_lcp

LENGTH, GRAM = 50, 20
_REACH = LENGTH - GRAM  # bytes before an anchor that a string may start
# Key of a unit: suffix at the anchor, its length, text before the anchor, its length + 1.
_SUFFIX, _BEFORE, _USED = 0, LENGTH + 1, LENGTH + 1 + _REACH + 1
_RUN_BYTES = 4 << 20  # text hashed at once; the hashes take some forty times as much memory
_BLOBS = pa.schema([("to", pa.int64()), ("kind", pa.int32()), ("blob", pa.binary())])
_BLOB_SQL = "to long, kind int, blob binary"
_RUN, _COVER = 0, 1
_RESULT = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
                     ("kept_sha256", pa.string()), ("kept", pa.binary())])
RESULT = "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"

_ANCHOR = np.dtype([("key", "<u4"), ("doc", "<i8"), ("group", "<i4"), ("at", "<u4"), ("n", "u1"), ("off", "u1")])
_PLACE = np.dtype([("doc", "<i8"), ("at", "<u4"), ("n", "u1"), ("off", "u1"), ("crowded", "u1")])
_UNIT = np.dtype([("lcp", "u1"), ("doc", "<i8"), ("group", "<i4"), ("slot", "<u4"), ("at", "<u4")])
_RANGE = np.dtype([("slot", "<u4"), ("at", "<u4"), ("n", "<u4")])


def packed(rows: np.ndarray, tail: bytes = b"") -> bytes:
    """A structured array by columns and byte planes, which compress well, and a tail of bytes."""
    planes = [np.ascontiguousarray(rows[n]).view(np.uint8).reshape(len(rows), -1).T.tobytes() for n in rows.dtype.names]
    head = np.array([len(rows)], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + b"".join(planes) + tail)


def unpacked(blob: bytes, dtype: np.dtype) -> tuple[np.ndarray, bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<i8", 1)[0])
    rows, at = np.empty(n, dtype), 8
    for name in dtype.names:
        size = dtype[name].itemsize
        plane = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        rows[name] = np.ascontiguousarray(plane.T).view(dtype[name]).reshape(n)
        at += n * size
    return rows, data[at:]


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x += b
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` bytes along the last axis, by doubling."""
    h, have = data.astype(np.uint64) + np.uint64(1), 1
    while have < width:
        step = min(have, width - have)
        h = _mix(h[..., :h.shape[-1] - step], h[..., step:])
        have += step
    return h


def anchors(text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Units of concatenated documents: (document, first string start, strings, anchor offset, gram hash).

    The anchor of a string is its gram with the smallest hash, the first of equal ones.
    """
    none = np.zeros(0, np.int64)
    if len(text) < LENGTH:
        return none, none, none, none, none.astype(np.uint64)
    grams = rolling(text, GRAM)
    least, place, have = grams, np.arange(len(grams), dtype=np.int32), 1
    while have < _REACH + 1:
        step = min(have, _REACH + 1 - have)
        later = least[step:] < least[:-step]
        least = np.where(later, least[step:], least[:-step])
        place = np.where(later, place[step:], place[:-step])
        have += step
    ends = np.cumsum(sizes)
    inside = np.ones(len(place), bool)
    for end in ends.tolist():
        inside[max(0, end - LENGTH + 1):end] = False
    for start, size in zip((ends - sizes).tolist(), sizes.tolist(), strict=True):
        if size < LENGTH:
            inside[start:start + size] = False
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none, none, none, none, none.astype(np.uint64)
    anchor = place[starts].astype(np.int64)
    new = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    first, count = starts[new], np.diff(np.r_[new, len(starts)])
    doc = np.searchsorted(ends, first, side="right")
    return doc, first - (ends - sizes)[doc], count, anchor[new] - first, grams[anchor[new]]


def _find_anchors(buckets: int):
    """Documents to packed anchors by bucket of the gram's hash."""
    def run(held: list[tuple[int, int, bytes]]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(b) for _, _, b in held], np.int64)
        doc, at, n, off, gram = anchors(np.frombuffer(b"".join(b for _, _, b in held), np.uint8), sizes)
        bucket = (gram >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        rows = np.empty(len(order), _ANCHOR)
        ids, groups = np.array([d for d, _, _ in held], np.int64), np.array([g for _, g, _ in held], np.int32)
        doc = doc[order]
        rows["key"], rows["doc"], rows["group"] = gram[order] & np.uint64(0xFFFFFFFF), ids[doc], groups[doc]
        rows["at"], rows["n"], rows["off"] = at[order], n[order], off[order]
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            if ends[b] < ends[b + 1]:
                yield _blob(b, _RUN, packed(rows[ends[b]:ends[b + 1]]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for doc, group, body in rows_of(batches, "key", "group", "body"):
            if doc is None or len(body) < LENGTH:
                continue
            held.append((doc, group, body))
            size += len(body)
            if size >= _RUN_BYTES:
                yield from run(held)
                held, size = [], 0
        if held:
            yield from run(held)
    return scan


def _blob(to: int, kind: int, blob: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([to], pa.int64()), pa.array([kind], pa.int32()),
                                       pa.array([blob], pa.binary())], schema=_BLOBS)


def _table(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, schema=_BLOBS)


def _shared_grams(crowd: int):
    """Anchors of one bucket to those whose gram stands in two documents, by group."""
    def keep(table: pa.Table) -> pa.Table:
        rows = np.concatenate([unpacked(b, _ANCHOR)[0] for b in table.column("blob").to_pylist()])
        rows = rows[np.argsort(rows["key"], kind="stable")]
        new = np.flatnonzero(np.r_[True, rows["key"][1:] != rows["key"][:-1]])
        sizes = np.diff(np.r_[new, len(rows)])
        shared = np.minimum.reduceat(rows["doc"], new) < np.maximum.reduceat(rows["doc"], new)
        kept = np.repeat(shared, sizes)
        rows, crowded = rows[kept], np.repeat(sizes > crowd, sizes)[kept]
        order = np.lexsort((rows["at"], rows["doc"], rows["group"]))
        rows, crowded = rows[order], crowded[order]
        out = np.empty(len(rows), _PLACE)
        for name in ("doc", "at", "n", "off"):
            out[name] = rows[name]
        out["crowded"] = crowded
        cuts = np.flatnonzero(np.r_[True, rows["group"][1:] != rows["group"][:-1]]) if len(rows) else []
        ends = np.r_[cuts[1:], len(rows)] if len(rows) else []
        return _table([_blob(int(rows["group"][a]), _RUN, packed(out[a:b])) for a, b in zip(cuts, ends, strict=True)])
    return keep


def unit_keys(text: np.ndarray, start: np.ndarray, n: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sort keys of units: rows of WIDTH bytes; ``start`` is where the first string starts in ``text``."""
    keys = np.zeros((len(start), WIDTH), np.uint8)
    tail, at = n - 1 + LENGTH - off, start + off
    padded = np.concatenate([text, np.zeros(LENGTH, np.uint8)])
    for i in range(LENGTH):
        keys[:, _SUFFIX + i] = np.where(i < tail, padded[at + i], 0)
    keys[:, LENGTH] = tail
    for i in range(_REACH):
        keys[:, _BEFORE + i] = np.where(i < off, padded[start + np.minimum(i, off)], 0)
    keys[:, _USED - 1] = off + 1
    return keys


def _sorted_documents(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """Documents of a group in an order that every step finds again: id (null first), then text."""
    pairs = sorted(zip(table.column("key").to_pylist(), table.column("body").to_pylist(), strict=True),
                   key=lambda p: (p[0] is not None, p[0] or 0, p[1]))
    return [k for k, _ in pairs], [b for _, b in pairs]


def _make_runs(buckets: int):
    """A group's documents and shared anchors to front-coded runs by bucket, and ranges covered already."""
    def sort_units(key: tuple, docs: pa.Table, places: pa.Table) -> pa.Table:
        if not len(docs) or not len(places):
            return _table([])
        group = key[0].as_py()
        ids, bodies = _sorted_documents(docs)
        found = np.concatenate([unpacked(b, _PLACE)[0] for b in places.column("blob").to_pylist()])
        text = np.frombuffer(b"".join(bodies), np.uint8)
        sizes = np.array([len(b) for b in bodies], np.int64)
        begins = np.cumsum(sizes) - sizes
        known = sum(i is None for i in ids)
        own = np.array(ids[known:], np.int64)
        low, high = np.searchsorted(own, found["doc"]), np.searchsorted(own, found["doc"], side="right")
        times = high - low  # rows that repeat the id
        found, slot = np.repeat(found, times), np.repeat(low, times) + known
        slot = slot + np.arange(len(slot)) - np.repeat(np.cumsum(times) - times, times)
        at, n, off = (found[c].astype(np.int64) for c in ("at", "n", "off"))
        fits = at + n - 1 + LENGTH <= sizes[slot]
        at, n, off, slot, crowded = (x[fits] for x in (at, n, off, slot, found["crowded"] > 0))
        # Under a crowded gram each string is a unit of its own.
        single = np.repeat(np.flatnonzero(crowded), n[crowded])
        step = np.arange(len(single)) - np.repeat(np.cumsum(n[crowded]) - n[crowded], n[crowded])
        at, slot = np.r_[at[~crowded], at[single] + step], np.r_[slot[~crowded], slot[single]]
        n, off = np.r_[n[~crowded], np.ones(len(single), np.int64)], np.r_[off[~crowded], np.zeros(len(single), np.int64)]
        alone = np.r_[np.zeros(len(at) - len(single), bool), np.ones(len(single), bool)]
        by_place = np.lexsort((at, slot))
        at, slot, n, off, alone = (x[by_place] for x in (at, slot, n, off, alone))
        keys = unit_keys(text, begins[slot] + at, n, off)
        order = np.argsort(as_strings(keys), kind="stable")
        keys, at, slot, n, alone = (x[order] for x in (keys, at, slot, n, alone))
        doc = own[slot - known] if len(slot) else np.zeros(0, np.int64)
        same = neighbour_lcp(as_words(keys)) == WIDTH
        first = np.flatnonzero(~same)
        least = np.repeat(doc[first], np.diff(np.r_[first, len(doc)]))
        smallest = doc == least  # slots ascend by id, so the first of equal units has the smallest
        covered = ~smallest
        ranges = np.empty(int(covered.sum()), _RANGE)
        ranges["slot"], ranges["at"], ranges["n"] = slot[covered], at[covered], n[covered] - 1 + LENGTH
        out = [_blob(group % buckets, _COVER, np.array([group], "<i8").tobytes() + packed(ranges))] if len(ranges) else []
        keys, at, slot, doc, alone = (x[smallest] for x in (keys, at, slot, doc, alone))
        grams = rolling(keys[:, :GRAM], GRAM)[:, 0]
        whole = rolling(keys[:, :LENGTH], LENGTH)[:, 0]
        bucket = (np.where(alone, whole, grams) >> np.uint64(32)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b in range(buckets):
            mine = order[ends[b]:ends[b + 1]]
            if len(mine):
                units = np.empty(len(mine), _UNIT)
                units["lcp"] = lcp = neighbour_lcp(as_words(keys[mine]))
                units["doc"], units["group"], units["slot"], units["at"] = doc[mine], group, slot[mine], at[mine]
                rest = keys[mine, :_USED][np.arange(_USED) >= lcp[:, None]].tobytes()
                out.append(_blob(b, _RUN, packed(units, rest)))
        return _table(out)
    return sort_units


def front_decoded(lcp: np.ndarray, rest: bytes) -> np.ndarray:
    """Keys of a run from their common prefixes and the remaining bytes."""
    keys = np.zeros((len(lcp), WIDTH), np.uint8)
    given = np.arange(_USED) >= lcp[:, None]
    used = np.zeros((len(lcp), _USED), np.uint8)
    used[given] = np.frombuffer(rest, np.uint8)
    rows = np.arange(len(lcp))
    for c in range(_USED):  # a byte not given is that of the last key which gave it
        keys[:, c] = used[np.maximum.accumulate(np.where(given[:, c], rows, 0)), c]
    return keys


def smallest_documents(keys: np.ndarray, doc: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """(unit, string): smallest document that holds the string, for distinct units with their smallest document.

    ``gram`` numbers the units' grams; units alone under their gram need no comparison.
    """
    off, tail = keys[:, _USED - 1].astype(np.int64) - 1, keys[:, LENGTH].astype(np.int64)
    n = tail + off - LENGTH + 1
    out = np.repeat(doc[:, None], _REACH + 1, axis=1)
    many = np.flatnonzero(np.bincount(gram)[gram] > 1)
    if not len(many):
        return out
    column = np.arange(LENGTH + _REACH)
    source = np.where(column < off[many, None], _BEFORE + column, np.minimum(column - off[many, None], LENGTH))
    text = np.take_along_axis(keys[many], np.maximum(source, 0), 1)
    hashes = rolling(text, LENGTH)
    unit, string = np.nonzero(np.arange(_REACH + 1) < n[many, None])
    value = hashes[unit, string]
    order = np.argsort(value, kind="stable")
    unit, string, value = unit[order], string[order], value[order]
    new = np.r_[True, value[1:] != value[:-1]]
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    for a in range(0, len(unit), 1 << 18):  # equal hashes are equal strings, or else all are sorted as strings
        part = np.arange(a, min(a + (1 << 18), len(unit)))
        part = part[lead[part] != part]
        span = np.arange(LENGTH)
        if (text[unit[part, None], string[part, None] + span]
                != text[unit[lead[part], None], string[lead[part], None] + span]).any():
            spelled = np.ascontiguousarray(text[unit[:, None], string[:, None] + span]).view(f"V{LENGTH}").ravel()
            number = np.unique(spelled, return_inverse=True)[1]
            order = np.argsort(number, kind="stable")
            unit, string, number = unit[order], string[order], number[order]
            new = np.r_[True, number[1:] != number[:-1]]
            break
    at = np.flatnonzero(new)
    least = np.minimum.reduceat(doc[many][unit], at)
    out[many[unit], string] = np.repeat(least, np.diff(np.r_[at, len(unit)]))
    return out


def _merge_bucket(table: pa.Table) -> pa.Table:
    """Runs of one bucket to covered ranges by group; ranges found before pass through."""
    out, units, keys, sizes = [], [], [], []
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist(), strict=True):
        if kind == _COVER:
            out.append(_blob(int(np.frombuffer(blob, "<i8", 1)[0]), _COVER, blob[8:]))
            continue
        rows, rest = unpacked(blob, _UNIT)
        units.append(rows)
        lead = rows["lcp"][rows["lcp"] < WIDTH].astype(np.int64)
        keys.append(front_decoded(lead, rest))
        sizes.append(len(lead))
    if not units:
        return _table(out)
    # A key that repeats in its run (a line that fills a document) is merged once and has many places.
    unit, key = np.concatenate(units), np.concatenate(keys)
    lead = np.flatnonzero(unit["lcp"] < WIDTH)
    times = np.diff(np.r_[lead, len(unit)])
    order, lcp = merge_runs(key, unit["lcp"][lead].astype(np.int64), sizes)
    key, lead, times = key[order], lead[order], times[order]
    new = lcp < WIDTH
    distinct, number = np.flatnonzero(new), np.cumsum(new) - 1
    least = np.minimum.reduceat(unit["doc"][lead], distinct)
    gram = np.cumsum(lcp[distinct] < GRAM) - 1
    gram -= gram[0]
    smallest = smallest_documents(key[distinct], least, gram)
    n = key[:, LENGTH].astype(np.int64) + key[:, _USED - 1] - LENGTH
    column = np.arange(_REACH + 2)
    hit = np.zeros((len(lead), _REACH + 3), bool)  # a column without strings on either side
    hit[:, 1:_REACH + 2] = (smallest[number] < unit["doc"][lead, None]) & (column[:_REACH + 1] < n[:, None])
    row, begin = np.nonzero(hit[:, 1:] & ~hit[:, :-1])
    end = np.nonzero(hit[:, :-1] & ~hit[:, 1:])[1]
    repeat = times[row]  # the places of a key follow its first one
    place = np.repeat(lead[row], repeat) + np.arange(repeat.sum()) - np.repeat(np.cumsum(repeat) - repeat, repeat)
    row, begin, end = place, np.repeat(begin, repeat), np.repeat(end, repeat)
    ranges = np.empty(len(row), _RANGE)
    ranges["slot"], ranges["at"], ranges["n"] = unit["slot"][row], unit["at"][row] + begin, end - begin - 1 + LENGTH
    group = unit["group"][row]
    order = np.argsort(group, kind="stable")
    ranges, group = ranges[order], group[order]
    cuts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.zeros(0, int)
    out += [_blob(int(group[a]), _COVER, packed(ranges[a:b]))
            for a, b in zip(cuts, np.r_[cuts[1:], len(group)], strict=True)]
    return _table(out)


def _apply_ranges(with_text: bool):
    """A group's documents without the covered bytes."""
    def cut(docs: pa.Table, covers: pa.Table) -> pa.Table:
        ids, bodies = _sorted_documents(docs)
        sizes = np.array([len(b) for b in bodies], np.int64)
        begins = np.cumsum(sizes) - sizes
        change = np.zeros(int(sizes.sum()) + 1, np.int32)
        for blob in covers.column("blob").to_pylist():
            ranges = unpacked(blob, _RANGE)[0]
            at = begins[ranges["slot"]] + ranges["at"]
            np.add.at(change, at, 1)
            np.add.at(change, at + ranges["n"], -1)
        covered = np.cumsum(change[:-1], dtype=np.int32) > 0
        rows = []
        for key, body, begin in zip(ids, bodies, begins.tolist(), strict=True):
            gone = covered[begin:begin + len(body)]
            removed = int(gone.sum())
            kept = body if not removed else np.frombuffer(body, np.uint8)[~gone].tobytes()
            spans = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum()) if removed else 0
            rows.append((key, len(body), removed, spans, hashlib.sha256(kept).hexdigest(), kept if with_text else None))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)]
                        if rows else [pa.array([], f.type) for f in _RESULT], schema=_RESULT)
    return cut


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = True,
                   group_bytes: int = 8 << 20, crowd: int = 4096) -> DataFrame:
    """Per document: bytes, removed bytes, removed runs, SHA-256 of the kept bytes, and these (``with_text``)."""
    body = utf8(text)
    total = docs.agg(F.sum(F.octet_length(body))).first()[0] or 0
    parts = max(1, -(-total // group_bytes))
    # Rows without an id are spread by their text.
    spread = F.coalesce(F.xxhash64(F.col(key).cast("long")) + F.when(F.col(key).isNotNull(), 0), F.xxhash64(body))
    # Both sides of a cogroup are hashed by their own type: the group is a long, as ``to`` is.
    slim = docs.select(F.col(key).cast("long").alias("key"), F.pmod(spread, F.lit(parts)).cast("long").alias("group"),
                       body.alias("body"))
    grams = slim.mapInArrow(_find_anchors(parts), _BLOB_SQL)
    shared = grams.groupBy("to").applyInArrow(_shared_grams(crowd), _BLOB_SQL)
    runs = slim.groupBy("group").cogroup(shared.groupBy("to")).applyInArrow(_make_runs(parts), _BLOB_SQL)
    covers = runs.groupBy("to").applyInArrow(_merge_bucket, _BLOB_SQL)
    # The documents' shuffle of the runs serves here again.
    return slim.groupBy("group").cogroup(covers.groupBy("to")).applyInArrow(_apply_ranges(with_text), RESULT) \
               .withColumnRenamed("key", key)
