"""Packing of documents into training sequences with almost no padding.

Documents are turned into ids and cut into full sequences; what is left of
each goes to a window of remainders. A sequence is filled by minimum bin
slack: the longest remainder is set, and subset-sum over the multiset of the
other lengths finds the fill closest to the capacity. Reachable sums are the
bits of one integer, and the counts are read back from the bits before each
step. If a slack is left, a remainder is cut to fill it. What a task has left
at its end, less than one sequence, is cut into powers of two, which need no
padding.

A task packs the rows it reads, so nothing is shuffled, no key can be hot, and
a task holds one window of remainders. A task that runs again on the same rows
gives the same sequences.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.llm.common import per_process
from relaydesk.llm.word_ids import WordIds, slices

WINDOW = 2048
FLUSH_IDS = 2_000_000


def choose(counts: dict[int, int], target: int) -> dict[int, int]:
    """The multiset of lengths, within ``counts``, whose sum is closest below or at ``target``."""
    reach, mask, steps = 1, (1 << (target + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, part = min(counts[length], target // length), 1
        while left > 0:  # 1, 2, 4, ... copies at a time
            part = min(part, left)
            steps.append((reach, length, part))
            reach |= (reach << (length * part)) & mask
            left -= part
            part *= 2
        if reach >> target & 1:
            break
    at, out = reach.bit_length() - 1, defaultdict(int)
    for before, length, part in reversed(steps):
        if not before >> at & 1:
            out[length] += part
            at -= length * part
    return dict(out)


class Packer:
    """Packs pieces as they come; ``emit`` takes (document, start, ids) for each piece of a sequence."""

    def __init__(self, capacity: int, window: int):
        self.capacity, self.window = capacity, window
        self.by_length: dict[int, list] = defaultdict(list)
        self.size = self.total = 0

    def _put(self, doc: int, start: int, ids: np.ndarray) -> None:
        self.by_length[len(ids)].append((doc, start, ids))
        self.size += 1
        self.total += len(ids)

    def _take(self, length: int) -> tuple:
        found = self.by_length[length].pop()
        if not self.by_length[length]:
            del self.by_length[length]
        self.size -= 1
        self.total -= length
        return found

    def _cut(self, length: int) -> tuple:
        """A piece of ``length`` ids; a longer remainder is cut for it, the shortest that will do."""
        doc, start, ids = self._take(min(x for x in self.by_length if x >= length))
        if len(ids) > length:
            self._put(doc, start + length, ids[length:])
        return doc, start, ids[:length]

    def _fill(self, capacity: int) -> list[tuple]:
        """One full sequence; the window holds at least ``capacity`` ids, none in a longer piece."""
        out = [self._take(max(self.by_length))]
        slack = capacity - len(out[0][2])
        for length, n in choose({x: len(p) for x, p in self.by_length.items()}, slack).items():
            out += [self._take(length) for _ in range(n)]
            slack -= length * n
        # all pieces within the slack are taken by now, so any other is long enough to be cut
        return [*out, self._cut(slack)] if slack else out

    def add(self, doc: int, ids: np.ndarray) -> Iterator[list[tuple]]:
        full = len(ids) // self.capacity * self.capacity
        for start in range(0, full, self.capacity):
            yield [(doc, start, ids[start : start + self.capacity])]
        if full < len(ids):
            self._put(doc, full, ids[full:].copy())
        while self.size > self.window and self.total >= self.capacity:
            yield self._fill(self.capacity)

    def close(self) -> Iterator[list[tuple]]:
        while self.total >= self.capacity:
            yield self._fill(self.capacity)
        for bit in reversed(range(self.capacity.bit_length())):
            if self.total >> bit & 1:
                out, left = [], 1 << bit
                while left:
                    length = max((x for x in self.by_length if x <= left), default=left)
                    piece = self._cut(length)
                    out.append(piece)
                    left -= len(piece[2])
                yield out


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    window: int = WINDOW,
    added: bool = False,
) -> DataFrame:
    """Pieces of sequences: key, start, length, ids, doc_tokens, sequence_id, offset.

    ``tokenizer`` is the text of a tokenizer file (its size is that of the
    vocabulary) and no special tokens are added but ``end_id`` after each row.
    With ``added`` the literals of added tokens in a text give their ids, as the
    tokenizers library does it; without, they are split like other text.
    ``ids`` holds four bytes for each id, little-endian. ``capacity`` is a power
    of two. A null text is an empty one, a single ``end_id``. Every row is
    packed for itself: repeated rows and repeated or null keys give pieces of
    their own. Other columns of ``docs`` are left out. An empty table gives none.
    """
    if capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    kind = rows.schema["_key"].dataType
    schema = T.StructType(
        [
            T.StructField("_key", kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    definition = docs.sparkSession.sparkContext.broadcast(tokenizer)
    name = f"word_ids-{added}-{hashlib.sha256(tokenizer.encode()).hexdigest()}"

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_process(name, lambda: WordIds(definition.value, added))
        packer, first = Packer(capacity, window), TaskContext.get().partitionId() << 33
        tail = int(end_id).to_bytes(4, "little")
        keys: dict[int, tuple] = {}  # of the documents in the window
        out: dict[str, list] = {field.name: [] for field in schema}
        number = waiting = seen = 0
        key_type = None

        def add(sequence: list[tuple]) -> None:
            nonlocal number, waiting
            offset = 0
            for doc, start, ids in sequence:
                value, tokens = keys[doc]
                row = (value, start, len(ids), ids.tobytes(), tokens, first + number, offset)
                for column, x in zip(out.values(), row):
                    column.append(x)
                offset += len(ids)
            number += 1
            waiting += offset

        def batch() -> pa.RecordBatch:
            nonlocal waiting
            waiting = 0
            arrays = [pa.array(out["_key"], key_type), *(pa.array(out[c]) for c in list(out)[1:])]
            made = pa.RecordBatch.from_arrays(
                [a.cast(pa.binary()) if c == "ids" else a for c, a in zip(out, arrays)], list(out)
            )
            for column in out.values():
                column.clear()
            return made

        for given in batches:
            key_type = given.column(0).type
            for at, n in slices(given.column(1)):
                flat, bounds = words.encode(given.column(1).slice(at, n))
                content, ends = flat.tobytes(), (4 * bounds).tolist()
                for value, a, b in zip(given.column(0).slice(at, n).to_pylist(), ends[:-1], ends[1:]):
                    ids = np.frombuffer(content[a:b] + tail, dtype="<u4")
                    keys[seen] = (value, len(ids))
                    for sequence in packer.add(seen, ids):
                        add(sequence)
                    seen += 1
                    if waiting >= FLUSH_IDS:
                        yield batch()
                if len(keys) > 8 * window:
                    held = {doc for pieces in packer.by_length.values() for doc, _, _ in pieces}
                    keys = {doc: keys[doc] for doc in held}
        for sequence in packer.close():
            add(sequence)
            if waiting >= FLUSH_IDS:
                yield batch()
        if out["_key"]:
            yield batch()

    return rows.mapInArrow(sequences, schema).withColumnRenamed("_key", key)
