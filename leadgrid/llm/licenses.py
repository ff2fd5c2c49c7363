"""License scan: exact phrases, and an exact set-similarity join of text blocks with templates.

A block is a line, or a window of a longer line: ``2 * w`` words every ``w`` words, ``w`` being
the words of the longest template. The same windows also slide over the words of the whole text,
whatever its line breaks, so that a notice is cut neither by a window's edge nor by a newline. A
block matches a template when it holds at least ``threshold`` of the template's distinct words.

The join is exact. Template words are ordered by their corpus-wide document frequency, rarest
first. With ``need = ceil(threshold * |T|)`` common words required:

* prefix: a match shares a word of the first ``|T| - need + 1`` template words and of the first
  ``|B| - need + 1`` block words;
* length: a block with fewer than ``need`` template words cannot match;
* position: after the first common word at places i and j, at most
  ``1 + min(|T| - i, |B| - j) - 1`` words can be common.

Only words of some template can be common, so blocks are reduced to those first. Templates
are a parameter, a few hundred words; they and their frequencies travel with the task. The
texts are read twice (frequencies, join) and never shuffled.

Null text is empty: no words, no labels, score 0. Rows that repeat yield a row each; an empty
table yields an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadgrid.llm.common import batched, fold_words, id_and_bytes, rows_of

# License names as phrases and as notices.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
TEMPLATES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of this software"],
    "apache-2": ["licensed under the Apache License Version 2.0"],
    "cc-by-nc": ["licensed under CC BY-NC 4.0", "Creative Commons Attribution NonCommercial license"],
    "gpl-3": ["licensed under the GNU General Public License version 3"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted"],
}

RESULT = ("key long, n_words long, n_base long, first_word long, last_word long, "
          "base_labels string, labels string, score double, n_blocks long")
_SCHEMA = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                     ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                     ("labels", pa.string()), ("score", pa.float64()), ("n_blocks", pa.int64())])


def word_frequencies(docs: DataFrame, text: str, words: Sequence[bytes]) -> dict[bytes, int]:
    """In how many texts each of the given words stands; counted over all rows."""
    wanted = frozenset(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = dict.fromkeys(wanted, 0)
        for (body,) in rows_of(batches, "body"):
            for word in wanted.intersection(fold_words(body)):
                seen[word] += 1
        yield pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())},
                                         pa.schema([("word", pa.binary()), ("n", pa.int64())]))

    bodies = id_and_bytes(docs.withColumn("_no_key", F.lit(None).cast("long")), "_no_key", text).select("body")
    counts = bodies.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    found = {bytes(r["word"]): r["n"] for r in counts.collect()}  # one row per template word
    return {w: found.get(w, 0) for w in wanted}


class TemplateIndex:
    """Templates as word lists in global order, with an index over their prefixes."""

    def __init__(self, templates: Sequence[tuple[str, bytes]], frequency: Mapping[bytes, int], threshold: float):
        words = {w for _, t in templates for w in fold_words(t)}
        order = sorted(words, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _ in templates]
        self.sets = [sorted({self.rank[w] for w in fold_words(t)}) for _, t in templates]
        self.need = [math.ceil(threshold * len(s) - 1e-9) for s in self.sets]
        self.prefix: dict[int, list[tuple[int, int]]] = {}
        for t, (ranks, need) in enumerate(zip(self.sets, self.need, strict=True)):
            for i, r in enumerate(ranks[:len(ranks) - need + 1]):
                self.prefix.setdefault(r, []).append((t, i))
        self.window = max((len(fold_words(t)) for _, t in templates), default=1)
        self.rare = frozenset(order[r] for r in self.prefix)

    def matches(self, block: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(template, common words) of each template that the sorted block meets."""
        size, open_ = len(block), {}
        for j, r in enumerate(block):
            for t, i in self.prefix.get(r, ()):
                need = self.need[t]
                if size < need or j > size - need:  # length; place behind the block's prefix
                    continue
                bound = open_.get(t, 0) + 1 + min(len(self.sets[t]) - i - 1, size - j - 1)
                if bound >= need:
                    open_[t] = open_.get(t, 0) + 1
        for t in open_:
            common = len(set(self.sets[t]).intersection(block))
            if common >= self.need[t]:
                yield t, common


def _blocks(lines: list[list[bytes]], width: int) -> Iterator[list[bytes]]:
    for words in lines:
        if len(words) <= 2 * width:
            yield words
        else:
            for at in range(0, len(words) - width, width):
                yield words[at:at + 2 * width]


def scan_text(body: bytes, phrases: Mapping[bytes, str], index: TemplateIndex) -> tuple:
    """Counts, labels and score of one text."""
    lines = [fold_words(line) for line in body.split(b"\n")]
    words = [w for line in lines for w in line]
    flat = b" " + b" ".join(words) + b" "
    starts, base = [], set()
    for phrase, label in phrases.items():
        at = flat.find(b" " + phrase + b" ")
        while at >= 0:
            starts.append(flat.count(b" ", 0, at))
            base.add(label)
            at = flat.find(b" " + phrase + b" ", at + 1)
    labels, score, hits = set(base), 0.0, 0
    if not index.rare.isdisjoint(words):
        wrapped = _blocks([words], index.window) if len(lines) > 1 else ()
        for in_line, blocks in ((1, _blocks(lines, index.window)), (0, wrapped)):
            for block in blocks:
                if index.rare.isdisjoint(block):
                    continue
                found = list(index.matches(sorted({index.rank[w] for w in block if w in index.rank})))
                hits += in_line and bool(found)
                for t, common in found:
                    labels.add(index.labels[t])
                    score = max(score, common / len(index.sets[t]))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else score, hits)


def license_scan(docs: DataFrame, key: str = "doc_id", text: str = "text",
                 phrases: Mapping[str, str] = PHRASES, templates: Mapping[str, Sequence[str]] = TEMPLATES,
                 threshold: float = 0.8) -> DataFrame:
    """Per text: word count, phrase places, labels of phrases and of matching templates, best containment.

    ``score`` is the largest share of a template found in one block, 0 below the threshold
    and 1 where a phrase stands; ``n_blocks`` counts the blocks within lines that meet some template.
    """
    spelled = {b" ".join(fold_words(p.encode())): label for p, label in phrases.items()}
    pairs = [(label, t.encode()) for label, texts in templates.items() for t in texts]
    frequency = word_frequencies(docs, text, [w for _, t in pairs for w in fold_words(t)])
    index = TemplateIndex(pairs, frequency, threshold)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, *scan_text(body, spelled, index)) for k, body in rows_of(batches, "key", "body"))
        yield from batched(rows, _SCHEMA)

    return id_and_bytes(docs, key, text).mapInArrow(scan, RESULT).withColumnRenamed("key", key)
