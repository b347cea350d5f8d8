"""Periodic runs of words in a text, and texts without their repetitions.

A run is a stretch of words with a smallest period q that no neighbouring word
extends. All runs come out of the longest Lyndon words that start at each place
under an order of the words and under its reverse: a run's period is the length
of one of them. Each of these candidates is extended to both sides by the
longest common extension of its two ends, which a suffix tree of the text (to
the right) and one of its reversal (to the left) give in constant time as the
lowest common ancestor of two leaves. The trees are built by Ukkonen's
algorithm; ancestors are least depths of an Euler tour, read from a table of
minima over powers of two.

Before that, words that no long run can hold are set aside, for whole batches
at once: in a run of at least ``least`` words and ``times`` periods every few
words in a row come again a known number of times, close by. What does not is
in no such run. The stretches that remain are searched together, with marks
between them that occur once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.llm.word_ids import slices

LEAST = 6
TIMES = 4


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def occurrences(grams: int, least: int, times: int) -> int:
    """How often any ``grams`` words in a row occur at least in a run of ``least`` words and ``times`` periods."""
    # from a period of 2 * grams on one more start is lost to the end than periods are gained
    return min((max(least, times * q) - grams + 1) // q for q in range(1, 2 * grams + 1))


def suspects(words: np.ndarray, owner: np.ndarray, least: int = LEAST, times: int = TIMES) -> np.ndarray:
    """(begin, end) of the stretches of ``words`` that may hold a run; ``owner`` tells texts apart and never falls.

    Any ``grams`` words in a row of a run occur in it again. Places that do not
    hold to that inside their stretch split it, until all do.
    """
    gauges = [(k, need) for k in (3, 5) if (need := occurrences(k, least, times)) > 1]
    hashed = _mix(words.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    borders = np.flatnonzero(np.diff(owner)) + 1 if len(owner) else np.zeros(0, np.int64)
    bounds = np.stack([np.append(0, borders), np.append(borders, len(words))], 1) if len(words) else np.zeros((0, 2), np.int64)
    while len(bounds):
        bounds = bounds[bounds[:, 1] - bounds[:, 0] >= least]
        sizes = bounds[:, 1] - bounds[:, 0]
        total = int(sizes.sum())
        if not total:
            return bounds[:0]
        number = np.repeat(np.arange(len(bounds)), sizes)
        ends = np.cumsum(sizes)
        at = np.arange(total) + np.repeat(bounds[:, 0] - (ends - sizes), sizes)
        left = np.repeat(ends, sizes) - np.arange(total)  # words from here to the end of the stretch
        salt = _mix(number.astype(np.uint64))
        inside = np.ones(total, bool)
        for k, need in gauges:
            grams = salt.copy()
            for j in range(k):
                grams[: total - j] = grams[: total - j] * np.uint64(0x9E3779B97F4A7C15) + hashed[at[j:]]
            fits = left >= k
            ordered = np.sort(grams[fits])
            # the last of ``need`` equal ones in a row
            often = np.unique(ordered[need - 1 :][ordered[need - 1 :] == ordered[: len(ordered) - need + 1]])
            good = fits.copy()
            if len(often):
                place = np.minimum(np.searchsorted(often, grams), len(often) - 1)
                good &= often[place] == grams
            else:
                good[:] = False
            cover = np.zeros(total + 1, np.int64)
            starts = np.flatnonzero(good)
            cover[starts] += 1
            cover[starts + k] -= 1
            inside &= np.cumsum(cover[:-1]) > 0
        edge = np.zeros(total + 1, bool)
        edge[np.append(0, ends)] = True
        begins = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
        stops = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False)))
        new = np.stack([at[begins], at[stops] + 1], 1)
        if len(new) == len(bounds) and (new == bounds).all():
            return bounds
        bounds = new
    return bounds


class SuffixTree:
    """Ukkonen's tree of a list of numbers whose last occurs once, and is less than all others."""

    def __init__(self, text: list[int]):
        self.text, self.size = text, len(text)
        self._build()

    def _build(self) -> None:
        text, size = self.text, self.size
        start, end, link = [0], [0], [0]  # of the edge to each node; node 0 is the root
        below: list[dict[int, int] | None] = [{}]
        leaf_of = [0] * size
        node = edge = length = waiting = 0  # where the next suffix goes on: at ``node``, ``length`` into the edge
        suffix = 0
        for i, symbol in enumerate(text):
            waiting += 1
            last = 0
            while waiting:
                if not length:
                    edge = i
                first = text[edge]
                child = below[node].get(first)
                if child is None:
                    leaf_of[suffix] = len(start)
                    below[node][first] = len(start)
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    below.append(None)
                    if last:
                        link[last] = node
                    last = 0
                else:
                    begin = start[child]
                    span = (end[child] if end[child] <= i else i + 1) - begin
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[begin + length] == symbol:
                        if last:
                            link[last] = node
                        length += 1
                        break
                    middle = len(start)
                    start.append(begin)
                    end.append(begin + length)
                    link.append(0)
                    below.append({text[begin + length]: child, symbol: middle + 1})
                    below[node][first] = middle
                    start[child] = begin + length
                    leaf_of[suffix] = middle + 1
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    below.append(None)
                    if last:
                        link[last] = middle
                    last = middle
                suffix += 1
                waiting -= 1
                if not node and length:
                    length -= 1
                    edge = i - waiting + 1
                elif node:
                    node = link[node]
        self.start, self.end, self.below, self.leaf_of = start, end, below, leaf_of

    def tour(self) -> SuffixTree:
        """Walk the tree, children in the order of their first numbers, and prepare for common extensions."""
        start, end, below = self.start, self.end, self.below
        depths: list[int] = [0]  # of the nodes of the Euler tour, in numbers from the root
        seen = [0] * len(start)  # the first place of a node in the tour
        stack = [(iter([below[0][s] for s in sorted(below[0])]), 0)]
        while stack:
            children, depth = stack[-1]
            child = next(children, None)
            if child is None:
                stack.pop()
                if stack:
                    depths.append(stack[-1][1])
                continue
            seen[child] = len(depths)
            down = depth + end[child] - start[child]
            depths.append(down)
            inner = below[child]
            if inner is None:
                depths.append(depth)
            else:
                stack.append((iter([inner[s] for s in sorted(inner)]), down))
        self.first = np.array(seen, np.int64)[self.leaf_of]
        table = [np.array(depths, np.int32)]
        step = 1
        while 2 * step <= len(depths):
            table.append(np.minimum(table[-1][:-step], table[-1][step:]))
            step *= 2
        self.minima = table
        self.ranks = np.argsort(np.argsort(self.first))  # of the suffixes
        return self

    def reverse_ranks(self) -> np.ndarray:
        """Ranks of the suffixes where greater numbers come first, but for the last number, which stays the least."""
        below, mark, out = self.below, self.text[-1], np.empty(len(self.start), np.int64)
        place, stack = 0, [0]
        while stack:
            node = stack.pop()
            inner = below[node]
            if inner is None:
                out[node] = place
                place += 1
            else:  # the last one put on the stack is visited first
                stack += [inner[s] for s in sorted(inner) if s != mark]
                if mark in inner:
                    stack.append(inner[mark])
        return out[self.leaf_of]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers that the suffixes at ``a`` and ``b``, which differ, have in common at their beginnings."""
        low, high = np.minimum(self.first[a], self.first[b]), np.maximum(self.first[a], self.first[b])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            at = level == k
            minima = self.minima[k]
            out[at] = np.minimum(minima[low[at]], minima[high[at] - (1 << int(k)) + 1])
        return out


def _next_smaller(ranks: list[int]) -> list[int]:
    """For each place the next one with a smaller rank, or the number of places."""
    size = len(ranks)
    out = [size] * size
    for i in range(size - 1, -1, -1):
        j = i + 1
        while j < size and ranks[j] > ranks[i]:
            j = out[j]
        out[i] = j
    return out


def runs(words: list[int], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``times`` (two or more) periods, in order."""
    size = len(words)
    if size < 2:
        return []
    text = [*words, min(words) - 1]
    right = SuffixTree(text).tour()
    left = SuffixTree([*reversed(words), text[-1]]).tour()
    found = []
    for ranks in (right.ranks, right.reverse_ranks()):
        after = np.array(_next_smaller(ranks.tolist())[:size], np.int64)
        a = np.flatnonzero(after < size)
        b = after[a]
        ahead = right.extension(a, b)
        # the words before a place are, reversed, what follows size - place
        behind = left.extension(size - a, size - b)
        found.append(np.stack([a - behind, b + ahead - (a - behind), b - a], 1))
    every = np.concatenate(found)
    every = every[every[:, 1] >= np.maximum(least, times * every[:, 2])]
    return [tuple(r) for r in np.unique(every, axis=0).tolist()] if len(every) else []


def text_runs(words: np.ndarray, stretches: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Runs of a text's words (numbers from 0) that lie in ``stretches``, by start and period."""
    parts, origin = [], []
    for k, (a, b) in enumerate(stretches.tolist()):
        parts.append(words[a:b])
        parts.append(np.array([-2 - k]))  # occurs once, so no run goes over it
        origin.append(np.arange(a, b + 1))
    joined, place = np.concatenate(parts), np.concatenate(origin)
    out = runs(joined.tolist(), least, times)
    return sorted(((int(place[s]), n, q) for s, n, q in out), key=lambda r: (r[0], r[2]))


SCHEMA = T.StructType(
    [
        T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
        T.StructField("collapsed", T.StringType()),
    ]
)


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, times: int = TIMES) -> DataFrame:
    """(key, runs, collapsed) for each row of ``docs``.

    Words end at the white space of ASCII. ``runs`` holds (start, length,
    period) of every run of at least ``least`` words and ``times`` periods, by
    start and then period. ``collapsed`` has the words that no run holds behind
    its first period, with one blank between them. A null or empty text, or one
    without words, has no runs and an empty ``collapsed``. Each row stands alone,
    so repeated rows and repeated or null keys need no rule. Other columns are
    left out, whatever their names. An empty table gives no rows.
    """
    if least < 2 or times < 2:
        raise ValueError("least and times must be at least 2")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([T.StructField("_key", rows.schema["_key"].dataType), *SCHEMA.fields])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, n in slices(batch.column(1), 4_000_000):
                part = batch.slice(at, n)
                split = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                sizes = np.array([len(w) for w in split], np.int64)
                flat = pa.array([w for words in split for w in words], pa.binary())
                numbers = flat.dictionary_encode().indices.to_numpy().astype(np.int64)
                owner = np.repeat(np.arange(len(split)), sizes)
                stretches = suspects(numbers, owner, least, times)
                of_text = owner[stretches[:, 0]] if len(stretches) else np.zeros(0, np.int64)
                first = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
                found: list[list] = [[] for _ in split]
                for i in np.unique(of_text).tolist():
                    a, b = first[i], first[i + 1]
                    found[i] = text_runs(numbers[a:b], stretches[of_text == i] - a, least, times)
                collapsed = []
                for words, those in zip(split, found):
                    if those:
                        drop = np.zeros(len(words) + 1, np.int64)
                        for start, length, period in those:
                            drop[start + period] += 1
                            drop[start + length] -= 1
                        words = [w for w, d in zip(words, accumulate(drop.tolist())) if not d]
                    collapsed.append(b" ".join(words))
                columns = [
                    part.column(0),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], pa.list_(
                        pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))),
                    pa.array(collapsed, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return rows.mapInArrow(search, schema).withColumnRenamed("_key", key)
