"""Merging sorted runs of fixed-width keys with LCP-aware loser trees.

Each run comes with the common-prefix length of every key and the key before it. A loser tree
keeps, at each node, the loser and its common prefix with the last key put out. A new key and
a loser with different prefix lengths are decided by these alone; equal lengths are compared
from there on, so a known prefix is never compared again (but for the bytes of its last word).

Many trees run side by side: splitters cut all runs into lanes, and every step moves one key out
of each lane, as array operations over the lanes.
"""

from __future__ import annotations

import numpy as np

WIDTH = 88
_WORDS = WIDTH // 8
_FAN_IN = 64
_LANE = 16


def as_words(keys: np.ndarray) -> np.ndarray:
    """Rows of WIDTH bytes as big-endian numbers, which compare like the bytes."""
    return keys.view(">u8").reshape(len(keys), _WORDS).astype(np.uint64)


def as_strings(keys: np.ndarray) -> np.ndarray:
    return keys.view(f"S{WIDTH}").reshape(len(keys))


def _equal_bytes(diff: np.ndarray) -> np.ndarray:
    """Leading bytes in which two words agree, from their exclusive or (not zero)."""
    return sum((diff < np.uint64(1 << shift)).astype(np.int64) for shift in range(8, 64, 8))


def neighbour_lcp(words: np.ndarray) -> np.ndarray:
    """Common prefix in bytes of each key with the one before; 0 for the first, WIDTH for equal keys."""
    out = np.zeros(len(words), np.int64)
    if len(words) > 1:
        diff = words[1:] ^ words[:-1]
        differs = diff != 0
        first = differs.argmax(axis=1)
        equal = ~differs.any(axis=1)
        at = np.take_along_axis(diff, first[:, None], 1)[:, 0]
        out[1:] = np.where(equal, WIDTH, first * 8 + _equal_bytes(np.where(equal, np.uint64(1), at)))
    return out


def _compare(words: np.ndarray, x: np.ndarray, y: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(x before y, common prefix) of keys whose first ``known`` bytes agree; equal keys keep x first."""
    less, prefix = np.ones(len(x), bool), np.full(len(x), WIDTH, np.int64)
    open_ = np.flatnonzero(known < WIDTH)
    word = known[open_] >> 3
    while len(open_):
        a, b = words[x[open_], word], words[y[open_], word]
        differ = a != b
        done = open_[differ]
        less[done] = a[differ] < b[differ]
        prefix[done] = word[differ] * 8 + _equal_bytes(a[differ] ^ b[differ])
        open_, word = open_[~differ], word[~differ] + 1
        inside = word < _WORDS
        open_, word = open_[inside], word[inside]
    return less, prefix


class _Lanes:
    """Loser trees over the same runs, one per lane; ``start`` and ``end`` are (lane, run) ranges of keys."""

    def __init__(self, words: np.ndarray, lcp: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.words, self.lcp, self.end, self.at = words, lcp, end, start.copy()
        lanes, self.runs = start.shape
        self.loser = np.zeros((lanes, self.runs), np.int64)
        self.prefix = np.zeros((lanes, self.runs), np.int64)
        every = np.arange(lanes)
        front = np.broadcast_to(np.arange(self.runs), (lanes, self.runs)).copy()
        known = np.where(start < end, 0, -1)
        node = self.runs
        while node > 1:
            node //= 2
            winners, prefixes = np.empty((lanes, node), np.int64), np.empty((lanes, node), np.int64)
            for j in range(node):
                won = self._play(every, front[:, 2 * j], known[:, 2 * j], front[:, 2 * j + 1], known[:, 2 * j + 1],
                                 node + j)
                winners[:, j], prefixes[:, j] = won
            front, known = winners, prefixes
        self.winner, self.known = front[:, 0], known[:, 0]

    def _play(self, lanes, run, known, other, other_known, node):
        """The winner of ``run`` against ``other``; the loser is left at the node."""
        swap = other_known > known
        tie = np.flatnonzero((other_known == known) & (known >= 0))
        left = np.where(swap, known, other_known)
        if len(tie):
            x, y = self.at[lanes[tie], run[tie]], self.at[lanes[tie], other[tie]]
            less, prefix = _compare(self.words, x, y, known[tie])
            swap[tie] = ~less | ((prefix == WIDTH) & (other[tie] < run[tie]))
            left[tie] = prefix
        self.loser[lanes, node] = np.where(swap, run, other)
        self.prefix[lanes, node] = left
        return np.where(swap, other, run), np.where(swap, other_known, known)

    def pop(self, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next key of each lane and its common prefix with the one before."""
        run, prefix = self.winner[lanes], self.known[lanes]
        out = self.at[lanes, run]
        self.at[lanes, run] += 1
        following = out + 1
        ended = following >= self.end[lanes, run]
        known = np.where(ended, -1, self.lcp[np.minimum(following, len(self.lcp) - 1)])
        node = (run + self.runs) >> 1
        while self.runs > 1 and node[0] >= 1:
            run, known = self._play(lanes, run, known, self.loser[lanes, node], self.prefix[lanes, node], node)
            node >>= 1
        self.winner[lanes], self.known[lanes] = run, known
        return out, prefix


def _merge_some(keys: np.ndarray, words: np.ndarray, lcp: np.ndarray,
                bounds: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Order of the keys of a few adjacent runs, and the common prefix of neighbours in it."""
    total = bounds[-1][1] - bounds[0][0]
    count = max(1, total // _LANE)
    strings = as_strings(keys)
    sample = np.sort(np.concatenate([strings[a:b:_LANE] for a, b in bounds]))
    splits = np.unique(sample[np.arange(1, count) * len(sample) // count]) if count > 1 else sample[:0]
    runs = 1 << (len(bounds) - 1).bit_length()
    edges = np.zeros((len(splits) + 2, runs), np.int64)
    for r, (a, b) in enumerate(bounds):
        edges[:, r] = a + np.r_[0, np.searchsorted(strings[a:b], splits), b - a]
    start, end = edges[:-1], edges[1:]
    tree = _Lanes(words, lcp, start, end)
    sizes = (end - start).sum(axis=1)
    put = np.r_[0, np.cumsum(sizes)[:-1]]
    stop = put + sizes
    order, prefix = np.empty(total, np.int64), np.empty(total, np.int64)
    live = np.flatnonzero(put < stop)
    seams = put[live]
    while len(live):
        order[put[live]], prefix[put[live]] = tree.pop(live)
        put[live] += 1
        live = live[put[live] < stop[live]]
    # Only the first key of a lane has not met the one before it.
    prefix[0] = 0
    seams = seams[seams > 0]
    pairs = np.stack([order[seams - 1], order[seams]], 1).ravel()
    prefix[seams] = neighbour_lcp(words[pairs])[1::2]
    return order, prefix


def merge_runs(keys: np.ndarray, lcp: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Order that sorts the concatenated runs, and the common prefix of neighbours in that order.

    Equal keys keep the order of their runs. Many runs are merged in rounds.
    """
    order = np.arange(len(keys))
    ends = np.cumsum(sizes)
    runs = [(int(e - s), int(e)) for s, e in zip(sizes, ends, strict=True) if s]
    while len(runs) > 1:
        words, parts, merged = as_words(keys), [], []
        for i in range(0, len(runs), _FAN_IN):
            group = runs[i:i + _FAN_IN]
            parts.append(_merge_some(keys, words, lcp, group))
            merged.append((group[0][0], group[-1][1]))
        step, lcp = (np.concatenate(p) for p in zip(*parts, strict=True))
        keys, order, runs = keys[step], order[step], merged
    return order, lcp
