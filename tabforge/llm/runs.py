"""Periodic runs of words, found as maximal pairs.

The suffixes of each text are sorted by prefix doubling over word numbers, for all texts of a slice at once. Neighbours in that
order have longest common prefixes (LCP), and the LCP intervals form a tree: all suffixes below a node share its ``l`` words.
Going up the tree, two suffixes i < i + p that meet at a node have exactly l words in common, so they cannot be extended to the
right; if the words before them differ, not to the left either. Such a maximal pair with l >= 3 p spells a run that begins
at i, is l + p words long and has period p: nothing is extended or verified afterwards. A run with smallest period q also
shows as pairs of distances 2 q, 3 q, ..., over the same stretch; the smallest distance is its period.

A node keeps its suffixes as sorted positions, and as a class list per left word. The smaller child is looked up in the
larger one. Occurrences of l words within l / 3 of each other lie a period apart, so of those on the right of a suffix all have the
same left word, and of those on its left only the outermost can differ from it: a lookup touches two classes at most, and what it
returns are pairs of the answer. Parts of the tree whose suffixes all have one left word, or lie too far apart, are left out
before any work in Python.

Each task works on whole texts by itself; nothing is shuffled.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import SPACE_BYTE, Words, slices

LEAST = 6  # words of a run
TIMES = 4  # periods of a run
SLICE = 1 << 20
RUN = "struct<start: long, length: long, period: long>"


def _suffixes(ids: np.ndarray, text: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, until no two are equal; ranks are places in the sorted order."""
    n = len(ids)
    ranks, active = np.zeros(n, np.int64), np.arange(n)
    keys, levels, step = text * (int(ids.max(initial=0)) + 1) + ids, [], 1
    while len(active):
        order = np.argsort(keys, kind="stable")
        keys, active = keys[order], active[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        at = np.flatnonzero(new)
        group = np.ones(len(keys), bool)
        old = ranks[active]
        group[1:] = old[1:] != old[:-1]
        offset = np.arange(len(keys))
        begin = np.maximum.accumulate(np.where(group, offset, 0))
        head = np.maximum.accumulate(np.where(new, offset, 0))
        ranks = ranks.copy()
        ranks[active] = old + head - begin
        levels.append(ranks)
        tied = np.repeat(np.diff(np.append(at, len(keys))) > 1, np.diff(np.append(at, len(keys))))
        active = active[tied]
        following = active + step
        second = np.where(following < stop[active], ranks[np.minimum(following, n - 1)] + 1, 0)
        keys = ranks[active] * (n + 1) + second
        step *= 2
    return levels


def _common(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Words that the suffixes a and b have in common, each pair within one text."""
    found = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        x, y = a + found, b + found
        inside = np.maximum(x, y) < stop
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        found += np.where(inside & (levels[k][x] == levels[k][y]), 1 << k, 0)
    return found


def _blocks(ids: np.ndarray, text: np.ndarray, first: np.ndarray) -> list[tuple[list[int], list[int], list[int]]]:
    """Parts of the suffix order that can hold maximal pairs: positions, LCP with the one before, left words."""
    stop = first[text + 1]
    levels = _suffixes(ids, text, stop)
    if len(levels) < 3:
        return []
    # only suffixes that share four words with another can share the LEAST - 1 that a run needs
    _, which, times = np.unique(levels[2], return_inverse=True, return_counts=True)
    some = np.flatnonzero(times[which] > 1)
    some = some[np.argsort(levels[-1][some])]
    lcp = np.zeros(len(some), np.int64)
    lcp[1:] = _common(levels, some[:-1], some[1:], np.where(text[some[:-1]] == text[some[1:]], stop[some[1:]], 0))
    begin = np.flatnonzero(lcp < LEAST - 1)
    if not len(begin):
        return []
    end = np.append(begin[1:], len(some))
    left = np.where(some == first[text[some]], -1, ids[np.maximum(some - 1, 0)])
    lcp[begin] = 0
    longest = np.maximum.reduceat(lcp, begin)
    mixed = np.minimum.reduceat(left, begin) != np.maximum.reduceat(left, begin)
    block = np.repeat(np.arange(len(begin)), end - begin)
    order = np.lexsort((some, block))
    gap = np.full(len(some), len(ids) + 1)
    gap[1:] = np.where(block[order][1:] == block[order][:-1], np.diff(some[order]), len(ids) + 1)
    nearest = np.minimum.reduceat(gap, begin)
    good = np.flatnonzero(mixed & (nearest * (TIMES - 1) <= longest))
    return [(some[a:b].tolist(), lcp[a:b].tolist(), left[a:b].tolist()) for a, b in zip(begin[good].tolist(), end[good].tolist())]


class Node:
    """Suffixes below a node of the LCP-interval tree: sorted positions, whole and by left word."""

    __slots__ = ("spots", "classes")

    def __init__(self, spot: int, left: int):
        self.spots, self.classes = [spot], {left: [spot]}


def _merged(a: Node, b: Node, l: int, left_of: dict[int, int], found: dict[tuple[int, int], int]) -> Node:
    """The union of two children of a node of ``l`` words; their maximal pairs with l >= 3 p go to ``found``."""
    if len(a.spots) < len(b.spots):
        a, b = b, a
    far = l // (TIMES - 1)
    for left, own in b.classes.items():
        for x in own:
            lo, hi = bisect_left(a.spots, x - far), bisect_right(a.spots, x + far)
            if lo == hi:
                continue
            after = bisect_right(a.spots, x, lo, hi)
            near = {left_of[a.spots[lo]], left_of[a.spots[min(after, hi - 1)]]}
            for other in near - {left}:
                members = a.classes[other]
                for y in members[bisect_left(members, x - far) : bisect_right(members, x + far)]:
                    start, p = min(x, y), abs(x - y)
                    stretch = (start, l + p)
                    found[stretch] = min(found.get(stretch, p), p)
    for left, own in b.classes.items():
        members = a.classes.setdefault(left, [])
        for x in own:
            insort(members, x)
            insort(a.spots, x)
    return a


def _runs_of_block(spots: list[int], lcp: list[int], left: list[int], found: dict[tuple[int, int], int]) -> None:
    """Bottom-up over the LCP intervals of neighbours in suffix order."""
    left_of = dict(zip(spots, left))
    opened: list[tuple[int, Node]] = []
    node = Node(spots[0], left[0])
    for x, l, c in zip(spots[1:], lcp[1:], left[1:]):
        while opened and opened[-1][0] >= l:
            depth, below = opened.pop()
            node = _merged(below, node, depth, left_of, found)
        opened.append((l, node))
        node = Node(x, c)
    while opened:
        depth, below = opened.pop()
        node = _merged(below, node, depth, left_of, found)


def find_runs(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(start, length, period) of all runs of the texts whose words are ``ids[first[i]:first[i + 1]]``, by start, then period."""
    found: dict[tuple[int, int], int] = {}
    if len(ids) >= LEAST:
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for block in _blocks(ids, text, first):
            _runs_of_block(*block, found)
    runs = sorted((start, p, length) for (start, length), p in found.items())
    return np.array([(start, length, p) for start, p, length in runs], np.int64).reshape(-1, 3)


def _texts(data: np.ndarray, words: Words, chosen: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One string per text: its ``counts[i]`` words of ``chosen`` (word numbers), joined by one space."""
    start, size = words.start[chosen], (words.end - words.start)[chosen]
    last = np.cumsum(counts)
    spaced = np.ones(len(chosen), np.int64)
    spaced[last[counts > 0] - 1] = 0
    at = np.concatenate(([0], np.cumsum(size + spaced)))
    source = np.repeat(start - at[:-1], size + spaced) + np.arange(at[-1])
    out = np.append(data, np.uint8(0))[source]
    out[(at[1:] - 1)[spaced > 0]] = 0x20
    begins = at[np.concatenate(([0], last))]
    return pa.Array.from_buffers(pa.large_string(), len(counts), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(out.tobytes())])


def periodic_runs(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", tail: Callable[[object, int], tuple[int, int] | None] | None = None
) -> DataFrame:
    """One row per document row: doc_id, runs (start, length, period; by start, then period), collapsed.

    Words stand between white space (space, U+0009 to U+000D) and are compared as they are. A run is a stretch of words with
    smallest period q, at least ``LEAST`` and ``TIMES`` q words long, that no neighbour extends. ``collapsed`` is the text with one
    space between words, without the words that stand behind the first period of a run. ``tail(doc_id, words)`` may name a word
    a and a period p: the words from a on are then first replaced by repeats of the p words at a (a test of the search).

    Missing and empty texts have no words: no runs, an empty ``collapsed``. Repeated rows give equal rows, an empty table none.
    """
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for a, b, data, begins in slices(batch.column(1), SLICE):
                words = Words(data, begins, ~SPACE_BYTE)
                words.data = data  # case counts
                source = np.arange(len(words))
                for row, (own, n) in enumerate(zip(batch.column(0).slice(a, b - a).to_pylist(), words.count.tolist()) if tail else ()):
                    changed = tail(own, n)
                    if changed:
                        at = words.first[row] + changed[0]
                        source[at : words.first[row + 1]] = at + np.arange(words.first[row + 1] - at) % changed[1]
                ids = np.unique(words.hashes(), return_inverse=True)[1][source]
                runs = find_runs(ids, words.first)
                of_text = np.searchsorted(words.first, runs[:, 0], side="right") - 1
                dropped = np.zeros(len(words) + 1, np.int64)
                np.add.at(dropped, runs[:, 0] + runs[:, 2], 1)
                np.add.at(dropped, runs[:, 0] + runs[:, 1], -1)
                kept = np.cumsum(dropped)[:-1] == 0
                counts = np.bincount(words.text_of()[kept], minlength=b - a)
                own = runs - np.stack((words.first[of_text], np.zeros_like(of_text), np.zeros_like(of_text)), axis=1)
                entries = pa.StructArray.from_arrays([pa.array(own[:, i]) for i in range(3)], names=["start", "length", "period"])
                offsets = np.searchsorted(of_text, np.arange(b - a + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.ListArray.from_arrays(pa.array(offsets), entries), _texts(data, words, source[kept], counts).cast(pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    return docs.select(doc_id, text).mapInArrow(run, f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def repeated_tail(doc_id: object, words: int) -> tuple[int, int] | None:
    """A tail of three to ten repeats for a tenth of the ids, by their crc32; none without an id."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return None
    g = h // 10
    a = g % words
    return a, 1 + (words - a) // (3 + g % 8)


def run_summary(found: DataFrame) -> DataFrame:
    """doc_id, n_runs; start, length, period and exponent_milli of the run with most repeats; digests of runs and collapsed text.

    Exponents are compared exactly; ties go to the smaller start, then period. Without runs these four are missing.
    """
    best = F.expr(
        f"aggregate(runs, CAST(NULL AS {RUN}), (b, r) -> CASE WHEN b IS NULL OR r.length * b.period > b.length * r.period THEN r ELSE b END)"
    )
    listed = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.expr("(1000 * _best.length) div _best.period").alias("exponent_milli"), digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
