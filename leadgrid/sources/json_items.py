"""JSON files of either kind, read piece by piece in the tasks: streamed arrays, cut files of lines.

Only the bounds of items are found here; Spark parses the items by their schema.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle

# The functions travel by value: executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = "path string, is_array boolean, start long, stop long"
PIECE_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
_BLANK = b" \t\r\n"
_MARK = b"\xef\xbb\xbf"  # byte order mark
# What can change the depth inside an array: whole strings are skipped at once.
_TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+"|[\[\]{},"]', re.S)

Batches = Iterator[pa.RecordBatch]
Reader = Callable[[Batches], Batches]


def open_file(path: str):
    """Random-access file of a path as Spark lists it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    store, name = fs.FileSystem.from_uri(quote(path, safe="/:@"))
    return store.open_input_file(name)


def first_character(source) -> bytes:
    """First character that is no blank; empty for a blank file."""
    source.seek(0)
    head = source.read(3)
    if head == _MARK:
        head = b""
    while True:
        if found := head.lstrip(_BLANK):
            return found[:1]
        if not (head := source.read(BLOCK_BYTES)):
            return b""


def blocks(source, start: int = 0) -> Iterator[bytes]:
    """The file from ``start`` on, in blocks."""
    source.seek(start)
    while block := source.read(BLOCK_BYTES):
        yield block


def array_items(parts: Iterator[bytes]) -> Iterator[bytes]:
    """Items of one JSON array. Holds a block and the item that is open, however long the array is."""
    rest, depth, at, item = b"", 0, 0, 0
    for block in parts:
        # Keep the open item only; ``at`` is where the next token may begin.
        rest, at, item = rest[item:] + block, at - item, 0
        while token := _TOKEN.search(rest, at):
            sign = token[0]
            if sign == b'"':  # the string goes on in the next block
                break
            at = token.end()
            if sign in (b"[", b"{"):
                depth += 1
                if depth == 1:
                    item = at
            elif depth == 1 and sign in (b",", b"]"):
                if value := rest[item:token.start()].strip(_BLANK):
                    yield value
                item = at
                if sign == b"]":
                    return
            elif sign in (b"]", b"}"):
                depth -= 1
        else:
            at = len(rest)
            continue
        at = token.start()
    if depth and (value := rest[item:].strip(_BLANK)):
        yield value


def line_items(parts: Iterator[bytes], start: int, stop: int) -> Iterator[bytes]:
    """Lines that begin in [start, stop). ``parts`` begin one byte before ``start``, unless that is 0."""
    rest, place = b"", max(0, start - 1)
    skipping = start > 0
    for block in parts:
        lines = (rest + block).split(b"\n")
        rest = lines.pop()
        for line in lines:
            begins, place = place, place + len(line) + 1
            if skipping:
                skipping = False
            elif begins >= stop:
                return
            elif value := _item(line, begins):
                yield value
    if not skipping and place < stop and (value := _item(rest, place)):
        yield value


def _item(line: bytes, begins: int) -> bytes:
    return (line if begins else line.removeprefix(_MARK)).strip(_BLANK)


def cut_pieces(piece_bytes: int | None = None) -> Reader:
    """Rows (path, length) of files to their pieces; an array is one piece, a blank file none."""
    piece_bytes = piece_bytes or PIECE_BYTES

    def cut(batches: Batches) -> Batches:
        for batch in batches:
            rows = []
            for path, length in zip(batch.column("path").to_pylist(), batch.column("length").to_pylist(), strict=True):
                with open_file(path) as source:
                    first = first_character(source)
                if first == b"[":
                    rows.append((path, True, 0, length))
                elif first:
                    rows += [(path, False, a, min(length, a + piece_bytes)) for a in range(0, length, piece_bytes)]
            names = ("path", "is_array", "start", "stop")
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema(
                [("path", pa.string()), ("is_array", pa.bool_()), ("start", pa.int64()), ("stop", pa.int64())]))
    return cut


def read_pieces(batch_bytes: int = BLOCK_BYTES) -> Reader:
    """Pieces to the JSON texts of their items, in batches of about ``batch_bytes``."""
    def read(batches: Batches) -> Batches:
        for batch in batches:
            for piece in batch.to_pylist():
                with open_file(piece["path"]) as source:
                    parts = blocks(source, max(0, piece["start"] - 1))
                    found = array_items(parts) if piece["is_array"] else line_items(parts, piece["start"], piece["stop"])
                    yield from _batches(found, batch_bytes)
    return read


def _batches(items: Iterator[bytes], batch_bytes: int) -> Batches:
    held, size = [], 0
    for item in items:
        held.append(item)
        size += len(item)
        if size >= batch_bytes:
            yield _texts(held)
            held, size = [], 0
    if held:
        yield _texts(held)


def _texts(items: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([i.decode("utf-8", "replace") for i in items], pa.string())], ["value"])
