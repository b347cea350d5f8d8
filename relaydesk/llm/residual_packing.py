"""Best-fit packing in a tree: pack locally, send up only what nearly full bins leave over.

Every task encodes its rows and packs them by best fit, longest first, window
by window. Nearly full bins are final where they are. The pieces of underfull
bins are the items of the next round, in which eight neighbouring nodes are
one; there they are packed again, nearly full bins are final, and so on up to
the root, where every bin is.

A node above the leaves never holds its items. Items of one length are alike,
so best fit runs on the counts by length, at most ``capacity`` numbers, and
says how many items of each length every kind of bin takes. Items are numbered
within their length and joined with the places given to these numbers, so
neither a common length nor a round with little to combine fills a task.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.llm.common import BROADCAST_ROWS, per_process, written
from relaydesk.llm.word_ids import WordIds, slices

FAN_IN = 8
# a task's window: as many ids or pieces at most, besides the last slice of texts
WINDOW_IDS = 8_000_000
WINDOW_PIECES = 100_000
# items of one length that a task numbers
NUMBERED = 500_000
# bins of a node and, in a sequence's id, its level and node
BIN_BITS, NODE_BITS = 32, 25


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]], int]]:
    """Bins for ``counts[length]`` items, longest first, each in the fullest bin that has room.

    A bin kind is (number of bins, [(length, items in each)], room left).
    """
    by_room: dict[int, list[list]] = defaultdict(list)
    rooms: list[int] = []
    done: list[tuple[int, list, int]] = []

    def put(bins: int, content: list, room: int) -> None:
        if not bins:
            return
        if not room:
            done.append((bins, content, 0))
            return
        if room not in by_room:
            insort(rooms, room)
        by_room[room].append([bins, content])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):  # new bins
                each = capacity // length
                put(left // each, [(length, each)], capacity - each * length)
                if left % each:
                    put(1, [(length, left % each)], capacity - left % each * length)
                break
            room = rooms[at]
            bins, content = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                del rooms[at]
            each = room // length
            full = min(bins, left // each)
            put(full, [*content, (length, each)], room - each * length)
            left -= full * each
            bins -= full
            if bins and left:  # fewer items than one of these bins has room for
                put(1, [*content, (length, left)], room - left * length)
                left, bins = 0, bins - 1
            put(bins, content, room)
    return done + [(bins, content, room) for room in rooms for bins, content in by_room[room]]


def _slots(kinds: list[tuple[int, list[tuple[int, int]], int]], near: int) -> Iterator[tuple]:
    """(first bin, bins, length, items in each, first item of that length, offset of the first, nearly full)."""
    used: dict[int, int] = defaultdict(int)
    first = 0
    for bins, content, room in kinds:
        offset = 0
        for length, each in content:
            yield first, bins, length, each, used[length], offset, room <= near
            used[length] += bins * each
            offset += each * length
        first += bins


_SLOTS = "node long, first_bin long, bins long, length long, each long, first_item long, offset long, near boolean"


def _plan(capacity: int, near: int):
    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        counts = dict(zip(pdf["length"].tolist(), pdf["n"].tolist()))
        rows = list(_slots(best_fit(counts, capacity), near))
        out = pd.DataFrame(rows, columns=["first_bin", "bins", "length", "each", "first_item", "offset", "near"])
        out.insert(0, "node", pdf["node"].iloc[0])
        return out

    return plan


def _numbered(items: DataFrame, by: list[str], total: int) -> DataFrame:
    """``items`` with ``_item``, from 0 in each group of ``by``; a large group is dealt to several tasks."""
    parts = 1 + total // NUMBERED
    dealt = items.withColumn("_part", F.pmod(F.xxhash64("_row"), F.lit(parts)))
    within = Window.partitionBy(*by, "_part").orderBy("_row")
    numbered = dealt.withColumn("_item", F.row_number().over(within).cast("long") - 1)
    if parts == 1:
        return numbered.drop("_part")
    sizes = dealt.groupBy(*by, "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return numbered.join(sizes, [*by, "_part"]).withColumn("_item", F.col("_item") + F.col("_before")).drop("_part", "_before")


def _rounds(items: DataFrame, capacity: int, near: int) -> list[DataFrame]:
    """Tables (_row, _sequence, _offset) that together hold every row of ``items`` (_row, node, length)."""
    out, level = [], 1
    while True:
        size = items.agg(F.count("*").alias("n"), F.countDistinct("node").alias("nodes")).first()
        if not size.n:
            return out
        root = size.nodes == 1
        counts = items.groupBy("node", "length").agg(F.count("*").alias("n"))
        # one row for each length of a node
        slots = counts.groupBy("node").applyInPandas(_plan(capacity, capacity if root else near), _SLOTS)
        slots = written(slots, "slots")
        index = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins") * F.col("each") - 1))
        places = slots.withColumn("_at", index).select(
            "node",
            "length",
            (F.col("first_item") + F.col("_at")).alias("_item"),
            (F.col("first_bin") + F.floor(F.col("_at") / F.col("each"))).alias("_bin"),
            (F.col("offset") + F.col("_at") % F.col("each") * F.col("length")).alias("_offset"),
            "near",
        )
        placed = _numbered(items, ["node", "length"], size.n).join(places, ["node", "length", "_item"])
        placed = written(placed.select("_row", "node", "length", "_bin", "_offset", "near"), "placed")
        name = F.lit(level << (BIN_BITS + NODE_BITS)) + F.shiftleft("node", BIN_BITS) + F.col("_bin")
        out.append(placed.where("near").select("_row", name.alias("_sequence"), "_offset"))
        if root:
            return out
        items = placed.where("NOT near").select("_row", F.floor(F.col("node") / FAN_IN).alias("node"), "length")
        level += 1


def pack(
    docs: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = 2048,
    end_id: int = 0,
    near: int = 2,
) -> DataFrame:
    """Pieces of sequences of at most ``capacity`` ids: key, piece, start, length, ids, sequence_id, offset.

    A row's ids are those of its text by the tokenizer file ``tokenizer`` (its
    content), literals of added tokens included, and then ``end_id``. Only rows
    with more ids than ``capacity`` are cut, each piece but the last into a whole sequence.
    ``ids`` holds four bytes for each id, little-endian. A bin with at most
    ``near`` places left is final before the root. A null text is an empty one,
    a single ``end_id``. Repeated rows and repeated or null keys are rows of
    their own; ties of length go by the order in which rows were read. Other
    columns of ``docs`` are left out, whatever their names. An empty table gives no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    rows = docs.select(F.col(key).alias("_key"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType(
        [
            T.StructField("_key", rows.schema["_key"].dataType),
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("_row", T.LongType()),
            T.StructField("_sequence", T.LongType()),
            T.StructField("_offset", T.LongType()),
        ]
    )
    definition = docs.sparkSession.sparkContext.broadcast(tokenizer)
    name = f"word_ids-{hashlib.sha256(tokenizer.encode()).hexdigest()}"

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = per_process(name, lambda: WordIds(definition.value))
        node = TaskContext.get().partitionId()
        tail = int(end_id).to_bytes(4, "little")
        window: dict[str, list] = {"_key": [], "piece": [], "start": [], "length": [], "ids": []}
        held = bins = pieces = 0
        key_type = pa.null()

        def pack_window() -> pa.RecordBatch:
            nonlocal held, bins, pieces
            lengths = np.array(window["length"], np.int64)
            by_length: dict[int, np.ndarray] = {}
            order = np.argsort(lengths, kind="stable")
            for rows_of in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                by_length[int(lengths[rows_of[0]])] = rows_of
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            final = np.zeros(len(lengths), bool)
            for first, n, length, each, item, begin, full in _slots(
                best_fit({x: len(r) for x, r in by_length.items()}, capacity), near
            ):
                if full:
                    at = np.arange(n * each)
                    chosen = by_length[length][item + at]
                    sequence[chosen] = (node << BIN_BITS) + bins + first + at // each
                    offset[chosen] = begin + at % each * length
                    final[chosen] = True
            bins += len(lengths)
            kinds = {"_key": key_type, "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids": pa.binary()}
            arrays = [pa.array(window[c], kind) for c, kind in kinds.items()]
            arrays.append(pa.array((node << BIN_BITS) + pieces + np.arange(len(lengths))))
            arrays += [pa.array(x, pa.int64(), mask=~final) for x in (sequence, offset)]
            pieces += len(lengths)
            held = 0
            for column in window.values():
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, schema.names)

        for batch in batches:
            key_type = batch.column(0).type
            for at, n in slices(batch.column(1)):
                flat, bounds = words.encode(batch.column(1).slice(at, n))
                content, ends = flat.tobytes(), (4 * bounds).tolist()
                for value, a, b in zip(batch.column(0).slice(at, n).to_pylist(), ends[:-1], ends[1:]):
                    ids = content[a:b] + tail
                    for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[start : start + 4 * capacity]
                        for column, x in zip(window.values(), (value, piece, start // 4, len(part) // 4, part)):
                            column.append(x)
                    held += len(ids) // 4
                if held >= WINDOW_IDS or len(window["length"]) >= WINDOW_PIECES:
                    yield pack_window()
        if window["length"]:
            yield pack_window()

    pieces = written(rows.mapInArrow(leaves, schema), "pieces")
    left = pieces.where("_sequence is null")
    items = left.select("_row", F.floor(F.shiftright("_row", BIN_BITS) / FAN_IN).alias("node"), "length")
    moves = _rounds(items, capacity, near)
    out = pieces.where("_sequence is not null")
    if moves:
        moved = moves[0]
        for more in moves[1:]:
            moved = moved.unionByName(more)
        # narrow rows with a key of their own each
        side = F.broadcast(moved) if moved.count() <= BROADCAST_ROWS else moved
        out = out.unionByName(left.drop("_sequence", "_offset").join(side, "_row"))
    return out.select(
        F.col("_key").alias(key),
        "piece",
        "start",
        "length",
        "ids",
        F.col("_sequence").alias("sequence_id"),
        F.col("_offset").alias("offset"),
    )
