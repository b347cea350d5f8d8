"""Exact Jaccard join on word shingles by T-occurrence search.

A document is its set of distinct shingles, 64-bit hashes of five words in a
row. Documents with equal sets are one class from the start. Two classes can
only be linked if they share one of the first shingles of both, in an order
that puts frequent shingles last: a set of n shingles that must share t of them
has n - t + 1 first ones. Classes that meet so are searched in tasks: an
inverted index of the task's classes is asked for every class. By DivideSkip
the query's short lists are merged and counted, and classes that could still
reach the overlap T are probed for by binary search in its long lists; those
that reach it are links. A task gives a spanning forest of its links, not all
pairs.

First each class is compared with the first class of each shingle it shares.
Shingles whose classes are in one component by then need no more, so a large
group of near copies costs little. The classes of the other shingles, put
together by their first class, are then searched in full, in blocks, so no task
has more than two of them.

Whole sets are wide, so before a search classes go to its groups with a
signature: for each of some buckets of shingles whether their number is odd.
Signatures cannot differ in more buckets than sets differ in shingles, so a
class whose signature is too far from all others of its group has no link there,
and its set is not sent. Of the first classes that are near enough one is
searched with a class, and the others only where that has not joined the two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relaydesk.llm.common import bit_filter, discard, may_hold, meet, meet_counted, shuffled, spread_join, written
from relaydesk.llm.components import components

WORDS = 5
PERCENT = 75
BATCH = 128
# frequent shingles that the order knows; more or fewer change the cost alone
FREQUENT = 100_000
COUNTED_AT_ONCE = 2_000_000
BLOCK = 512
MARKS = 512  # buckets of the shortest signature, a multiple of 64
LONG = 0.2  # the greater, the fewer lists are probed instead of merged
BASE = 0xD6E8FEB86659FD93  # odd


def _mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Shingle sets of texts. Words end at the white space of ASCII; A-Z are lower-cased."""

    def __init__(self, words: int = WORDS):
        self.words = words
        byte = np.arange(256)
        self.white = (byte == 32) | ((byte >= 9) & (byte <= 13))
        lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint64)
        self.values = _mix((lower + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Of the base of the word hash and of its inverse modulo 2**64."""
        if len(self.powers) < n:
            self.powers = np.cumprod(np.full(2 * n, BASE, np.uint64))
            self.inverse = np.cumprod(np.full(2 * n, pow(BASE, -1, 2**64), np.uint64))
        return self.powers[:n], self.inverse[:n]

    def sets(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text its sorted distinct shingles."""
        encoded = [(t or "").encode() for t in texts]
        joined = np.frombuffer(b" ".join(encoded) + b" ", np.uint8)
        starts = np.cumsum([0] + [len(e) + 1 for e in encoded])
        white = self.white[joined]
        begins = ~white
        begins[1:] &= white[:-1]
        closes = ~white
        closes[:-1] &= white[1:]
        begin, close = np.flatnonzero(begins), np.flatnonzero(closes)
        powers, inverse = self._powers(len(joined))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.values[joined] * powers)])
        # the last factor takes the word's place in the batch out
        word = _mix((total[close + 1] - total[begin]) * inverse[begin])
        first = np.searchsorted(begin, starts)
        n, k = len(word), self.words
        rolled = np.zeros(max(0, n - k + 1), np.uint64)
        for j in range(k):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + word[j : n - k + 1 + j] if n >= k else rolled
        rolled = _mix(rolled)
        out = []
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                out.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:  # fewer words: the sequence is one shingle, told from others by its length
                h = np.full(1, b - a, np.uint64)
                for w in word[a:b]:
                    h = h * np.uint64(0x9E3779B97F4A7C15) + w
                out.append(_mix(h ^ np.uint64(0x5851F42D4C957F2D)))
            else:
                out.append(np.zeros(0, np.uint64))
        return out


def class_of(shingles: np.ndarray) -> int | None:
    """A 64-bit name for a set; None for the empty one."""
    if not len(shingles):
        return None
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Shingles that a set of n must share with any set it is linked to."""
    return -(-n * percent // 100)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            yield batch.slice(at, BATCH)


def _survey(words: int):
    """Rows (key, n, class) of documents, and rows (token, times) of shingles that meet again in the task."""

    def survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, held, size, seen = Shingler(words), [], 0, set()
        names = ["key", "n", "class", "token", "times"]

        def again() -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64),) * 2
            tokens, times = tokens[times > 1].view(np.int64), times[times > 1].astype(np.int64)
            nothing = pa.nulls(len(tokens), pa.int64())
            return pa.RecordBatch.from_arrays([nothing, nothing, nothing, pa.array(tokens), pa.array(times)], names)

        for part in _parts(batches):
            sets = shingler.sets(part.column(1).to_pylist())
            classes = [class_of(s) for s in sets]
            nothing = pa.nulls(len(sets), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64()), nothing, nothing],
                names,
            )
            for shingles, name in zip(sets, classes):
                if name is not None and name not in seen:  # copies are one class
                    seen.add(name)
                    held.append(shingles)
                    size += len(shingles)
            if size >= COUNTED_AT_ONCE:
                yield again()
                held, size = [], 0
                seen.clear()
        yield again()

    return survey


def _firsts(words: int, percent: int, frequent):
    """Rows (class, n, tokens): of every document the shingles that a linked class must share one of."""

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        known, times = frequent.value
        for part in _parts(batches):
            names, sizes, tokens = [], [], []
            for shingles in shingler.sets(part.column(0).to_pylist()):
                if not len(shingles):
                    continue
                need = len(shingles) - least_overlap(len(shingles), percent) + 1
                if len(known):
                    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
                    often = np.where(known[at] == shingles, times[at], 0)
                    shingles, sorted_set = shingles[np.argsort(often, kind="stable")], shingles
                else:
                    sorted_set = shingles
                names.append(class_of(sorted_set))
                sizes.append(len(sorted_set))
                tokens.append(shingles[:need].view(np.int64))
            ends = np.cumsum([0] + [len(t) for t in tokens]).astype(np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["class", "n", "tokens"],
            )

    return firsts


def _perhaps_shared(filter_words):
    """A row for each token in the last column that the filter may hold, with the whole numbers before it."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *given, lists = batch.columns
            tokens = lists.flatten().to_numpy()
            kept = np.flatnonzero(may_hold(filter_words.value, tokens))
            owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())[kept]
            columns = [pa.array(column.to_numpy()[owner]) for column in given]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(tokens[kept])], [*batch.schema.names[:-1], "token"])

    return tell


def signature(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of a power of 2 of buckets, two for each shingle at least: whether it has an odd number of them."""
    bits = max(MARKS, 1 << int(2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd)


def _folded(signatures: list[bytes]) -> np.ndarray:
    """Rows of 64-bit words, all as long as the shortest signature: its buckets are sums of the longer ones'."""
    least = min(len(s) for s in signatures)
    out = np.empty((len(signatures), least), np.uint8)
    for i, s in enumerate(signatures):
        np.bitwise_xor.reduce(np.frombuffer(s, np.uint8).reshape(-1, least), axis=0, out=out[i])
    return out.view(np.uint64)


def _plausible(percent: int, one: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """False for sets that differ from the one in too many shingles to be linked with it."""
    apart = np.bitwise_count(others ^ one).sum(axis=1, dtype=np.int64)
    return (100 + percent) * apart <= (100 - percent) * (sizes + n)


def _near_first(percent: int):
    """Of a group that holds its first class, the classes that may be linked with that."""

    def near(table: pa.Table) -> pa.Table:
        names, sizes = table.column("class").to_numpy(), table.column("n").to_numpy()
        first = table.column("first")[0].as_py()
        marks, at = _folded(table.column("signature").to_pylist()), np.flatnonzero(names == first)[0]
        kept = np.flatnonzero(_plausible(percent, marks[at], marks, sizes[at], sizes) & (names != first))
        return table.take(kept).select(["class", "first"])

    return near


def _near_any(percent: int):
    """Of a group of classes, those that may be linked with one in another part."""

    def near(table: pa.Table) -> pa.Table:
        # a block that meets itself has its classes twice
        _, once = np.unique(table.column("class").to_numpy(), return_index=True)
        table = table.take(once)
        parts, sizes = table.column("part").to_numpy(), table.column("n").to_numpy()
        marks, kept = _folded(table.column("signature").to_pylist()), np.zeros(len(parts), bool)
        for i in range(len(parts) - 1):
            found = _plausible(percent, marks[i], marks[i + 1 :], sizes[i], sizes[i + 1 :]) & (parts[i + 1 :] != parts[i])
            kept[i] |= found.any()
            kept[i + 1 :] |= found
        return table.take(np.flatnonzero(kept)).select(["class", "part", "first", "_i", "_j"])

    return near


def _contents(words: int):
    """Rows (class, set): the sorted shingles, eight bytes each."""

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for part in _parts(batches):
            sets = shingler.sets(part.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([class_of(s) for s in sets], pa.int64()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                ["class", "set"],
            )

    return contents


def _marks(words: int):
    """Rows (class, n, signature)."""

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for part in _parts(batches):
            sets = shingler.sets(part.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([class_of(s) for s in sets], pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                ],
                ["class", "n", "signature"],
            )

    return marks


class Index:
    """Inverted lists of some sets; a list holds the places of the sets that have a shingle, in order."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.tokens, self.start = np.unique(flat[order], return_index=True)
        self.owner = owner[order]
        self.end = np.append(self.start[1:], len(flat))

    def linked(self, query: np.ndarray, percent: int = PERCENT) -> np.ndarray:
        """Places of all sets whose similarity with ``query``, itself one of the sets, reaches ``percent``.

        Empty if that is ``query`` alone.
        """
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        need = least_overlap(len(query), percent)
        if len(at) < need:
            return np.zeros(0, np.int64)
        length = self.end[at] - self.start[at]
        if (length > 1).sum() < need:  # too few are shared at all; one that is equal would share every one
            return np.zeros(0, np.int64)
        at = at[np.argsort(-length, kind="stable")]
        # the longest lists, but fewer than the overlap, are probed
        n_long = int(min(need - 1, need / (LONG * np.log2(max(2, length.max())) + 1)))
        long, short = at[:n_long], at[n_long:]
        # all places of the short lists at once, merged by counting
        sizes = self.end[short] - self.start[short]
        ends = np.cumsum(sizes)
        merged = self.owner[np.arange(ends[-1]) + np.repeat(self.start[short] - (ends - sizes), sizes)]
        count = np.bincount(merged, minlength=len(self.sizes))
        places = np.flatnonzero(count >= need - n_long)
        found = count[places]
        for i, t in enumerate(long):
            if not len(places):
                break
            own = self.owner[self.start[t] : self.end[t]]
            probe = np.minimum(np.searchsorted(own, places), len(own) - 1)
            found = found + (own[probe] == places)
            alive = found + (n_long - 1 - i) >= need
            places, found = places[alive], found[alive]
        union = len(query) + self.sizes[places] - found
        return places[100 * found >= percent * union]


def _forest(percent: int):
    """Of a group of classes, the links of a spanning forest."""

    def search(table: pa.Table) -> pa.Table:
        names = table.column("class").to_numpy()
        _, kept = np.unique(names, return_index=True)
        table, names = table.take(kept), names[kept]
        sets = [np.frombuffer(s.as_py(), np.uint64) for s in table.column("set")]
        root = list(range(len(sets)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        if "part" in table.column_names:  # what is linked already
            parts: dict[int, int] = {}
            for i, part in enumerate(table.column("part").to_pylist()):
                root[i] = parts.setdefault(part, i)
        out: list[tuple[int, int]] = []
        if len({find(i) for i in range(len(sets))}) > 1:
            index = Index(sets)
            for i, query in enumerate(sets):
                for j in index.linked(query, percent).tolist():
                    a, b = find(i), find(j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        out.append((int(names[i]), int(names[j])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return search


def class_links(docs: DataFrame, members_of: DataFrame, percent: int, words: int, frequent) -> DataFrame:
    """(a, b): links that connect what is linked. ``docs`` has key and text, ``members_of`` key, n and class."""
    spark = docs.sparkSession
    none = spark.createDataFrame([], "a long, b long")
    firsts = docs.select("text").mapInArrow(_firsts(words, percent, frequent), "class long, n long, tokens array<long>")
    firsts = written(firsts, "first-shingles")
    rows = firsts.select("class", "n", F.explode("tokens").alias("token"))
    times = F.count("*").alias("_times")
    shared = rows.groupBy("token").agg(F.min("class").alias("_a"), F.max("class").alias("_b"), times).where("_a <> _b")
    shared = written(shared.select("token", "_times"), "shared")
    if shared.isEmpty():
        return none
    opened = [firsts, shared]
    # most shingles are in one class alone, and go no farther than this
    words_of = spark.sparkContext.broadcast(bit_filter(shared, "token"))
    rows = firsts.mapInArrow(_perhaps_shared(words_of), "class long, n long, token long")
    members = meet_counted(rows, shared, "token", F.col("class"), "_times").distinct()
    # linked sets differ in size by the similarity at most, which is a step of this scale
    step = F.floor(F.ln(F.col("n").cast("double")) / F.lit(1.0001 * np.log(100 / percent)))
    members = members.withColumn("_step", F.explode(F.array(step, step + 1)))
    members = written(members.select(F.xxhash64("token", "_step").alias("token"), "class"), "members")
    discard(*opened)
    shared = members.groupBy("token").agg(F.min("class").alias("first"), F.max("class").alias("_b"), times)
    shared = written(shared.where("first <> _b").drop("_b"), "shared")
    opened = [members, shared]
    members = written(meet_counted(members, shared, "token", F.col("class"), "_times"), "members")
    discard(*opened)

    # texts of these classes, from the document with the least key of each; a repeated key may give one twice
    wanted = members.select("class").distinct()
    holders = members_of.groupBy("class").agg(F.min("key").alias("key")).join(shuffled(wanted), "class")
    holders = written(holders.select("class", "key"), "holders")

    def texts_of(keys: DataFrame) -> DataFrame:
        return meet(docs, keys, "key", F.col("key")).select("text")

    def sets_of(classes: DataFrame) -> DataFrame:
        keys = written(holders.join(shuffled(classes.distinct()), "class").select("key"), "keys")
        return written(texts_of(keys).mapInArrow(_contents(words), "class long, set binary"), "sets")

    marks = texts_of(holders.select("key")).mapInArrow(_marks(words), "class long, n long, signature binary")
    marks = written(marks, "marks")

    # each class with the first class of each shingle it shares, in blocks that all hold the first class
    groups = _stars(written(members.select("class", "first").where("class <> first").distinct(), "stars"))
    near = _with_sets(groups, marks).groupBy("first", "_block").applyInArrow(_near_first(percent), "class long, first long")
    near = written(near.distinct(), "near")
    discard(groups)
    sets = sets_of(near.select("class").union(near.select("first")))
    found = _star_links(near.groupBy("class").agg(F.min("first").alias("first")), sets, percent)
    parts = _parts_of(found)
    apart = meet(near, parts, "class", F.col("first"), "left").withColumn("part", F.coalesce("part", "class"))
    apart = meet(apart, parts.toDF("first", "_part"), "first", F.col("class"), "left")
    # those searched above and not joined are searched once more, which does no harm
    apart = written(apart.where("part <> coalesce(_part, first)").select("class", "first"), "apart")
    if not apart.isEmpty():
        discard(parts)
        found = written(found.unionByName(_star_links(apart, sets, percent)), "found")
        parts = _parts_of(found)
    discard(near, apart, sets)

    # shingles whose classes are not in one component yet
    placed = meet(members.select("token", "first", "class"), parts, "class", F.col("token"), "left")
    placed = written(placed.withColumn("part", F.coalesce("part", "class")), "placed")
    discard(parts, members)
    split = placed.groupBy("token").agg(F.min("part").alias("_a"), F.max("part").alias("_b"), F.count("*").alias("_n"))
    # two classes have been compared already, as one is the other's first
    split = written(split.where("_n > 2 AND _a <> _b").select("token"), "split")
    if split.isEmpty():
        discard(marks, holders, placed, split)
        return found
    # shingles with the same first class make one group, as those of a passage do
    wide = meet(placed, split, "token", F.col("class")).select("first", "class", "part").distinct()
    wide = written(wide, "wide")
    discard(placed, split)
    sizes = written(wide.groupBy("first").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks")), "sizes")
    dealt = meet(wide, sizes, "first", F.col("class")).withColumn("_block", F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int"))
    # a block meets every other block of its group once
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.select("first", "class", "part", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"))
    blocks = written(dealt, "groups")
    schema = "class long, part long, first long, _i int, _j int"
    near = _with_sets(blocks, marks).groupBy("first", "_i", "_j").applyInArrow(_near_any(percent), schema)
    near = written(near, "near")
    sets = sets_of(near.select("class"))
    more = _with_sets(near, sets).groupBy("first", "_i", "_j").applyInArrow(_forest(percent), "a long, b long")
    more = written(more, "found")
    discard(wide, sizes, blocks, near, sets, marks, holders)
    return found.unionByName(more)


def _stars(stars: DataFrame) -> DataFrame:
    """(class, first, _block) of (class, first): blocks of classes, each of which holds the first one too."""
    sizes = written(stars.groupBy("first").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("_blocks")), "sizes")
    dealt = meet(stars, sizes, "first", F.col("class"))
    dealt = dealt.select("class", "first", F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int").alias("_block"))
    blocks = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block")
    groups = written(dealt.unionByName(sizes.select(F.col("first").alias("class"), "first", blocks)), "groups")
    discard(stars, sizes)
    return groups


def _star_links(stars: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect what is linked of the classes that each first class of (class, first) has."""
    groups = _stars(written(stars, "stars"))
    searched = _with_sets(groups, sets).groupBy("first", "_block").applyInArrow(_forest(percent), "a long, b long")
    found = written(searched, "found")
    discard(groups)
    return found


def _parts_of(found: DataFrame) -> DataFrame:
    return written(components(found).select(F.col("node").alias("class"), F.col("component").alias("part")), "parts")


def _with_sets(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """A class may be in very many groups (a written table), so its rows are dealt out."""
    return spread_join(groups, sets, "class", F.struct(*(c for c in groups.columns if c != "class")))


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(token, times) of all tokens counted more often than some number, the least that leaves FREQUENT of them or fewer."""
    counts = written(counts, "counted")
    # few different numbers: the sum of the first n of them grows with the square of n
    steps = counts.groupBy("times").agg(F.count("*").alias("n")).orderBy(F.desc("times")).toLocalIterator()
    least, total = None, 0
    for row in steps:
        total += row.n
        if total > FREQUENT:
            break
        least = row.times
    found = counts.where(F.col("times") >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    discard(counts)
    tokens = found.column("token").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column("times").to_numpy()[order].astype(np.int64)


def near_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT, words: int = WORDS
) -> DataFrame:
    """(key, n_shingles, component_id) for each row of ``docs``, keys being whole numbers.

    Two rows are linked if ``100 * intersection >= percent * union`` of their
    shingle sets; ``component_id`` is the least key that links lead to. A text
    with fewer than ``words`` words is one shingle. A null text, or one without
    words, has no shingles and is its own component. Rows that repeat a key are
    rows of their own; equal texts are linked. Null keys stay null and lead to
    nothing. Other columns are left out. An empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    surveyed = written(
        rows.mapInArrow(_survey(words), "key long, n long, class long, token long, times long"), "survey"
    )
    again = surveyed.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
    frequent = spark.sparkContext.broadcast(_most_frequent(again))
    members = surveyed.where("token is null").select("key", "n", "class")
    links = class_links(rows.where("key is not null"), members.where("class is not null and key is not null"), percent, words, frequent)
    parts = components(links).select(F.col("node").alias("class"), F.col("component").alias("part"))
    placed = meet(members, written(parts, "parts"), "class", F.col("key"), "left")
    placed = written(placed.select("key", "n", F.coalesce("part", "class").alias("part")), "placed")
    least = written(placed.where("part is not null").groupBy("part").agg(F.min("key").alias("least")), "least")
    return meet(placed, least, "part", F.col("key"), "left").select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.coalesce("least", "key").alias("component_id")
    )
