"""Short codes for vectors: each part of a vector is named by the nearest entry of a codebook.

Components are whole numbers (``floor(scale * x)``) and distances are squared
and exact, so codes, ties and errors are the same wherever they are computed.

Nearest entries are found in a tree over the entries (GNAT). A node has some
split points, far from each other, and every other entry goes below the
closest of them; for each pair of a split point and a child the least and
greatest distance between them is kept. By the triangle inequality a child is
left out for a query if, from any split point, all of its entries are farther
from the query than the best entry so far. That is asked of roots, which are
rounded so that a child is only left out if it is farther for certain; entries
are compared by whole numbers, equal distances by index.

Codebooks are small and go to every task. A round sends back, from each task,
one sum for each entry that it met.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.llm.common import meet, written

SPLITS = 8
LEAF = 6
BLOCK = 4096
# squares and sums of whole numbers up to this are exact in double precision, for parts of up to 512 components
EXACT = 2.0**21
# greater components, after scaling, cannot be told from their neighbours
LARGEST = 2.0**52
# wider than all rounding in what is compared
MARGIN = 2.0**-40


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``a`` to all rows of ``b``, whole numbers held as doubles."""
    width = a.shape[1]
    if width <= 512 and max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= EXACT:
        found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        return found.astype(np.int64)
    # Python's whole numbers have no bound
    left, right = (np.vectorize(int, otypes=[object])(x) if x.size else x.astype(object) for x in (a, b))
    out = np.zeros((len(a), len(b)), object)
    for i in range(width):
        out += (left[:, i][:, None] - right[:, i]) ** 2
    return out


def _roots(distances: np.ndarray, up: bool) -> np.ndarray:
    return np.sqrt(distances.astype(np.float64)) * (1 + MARGIN if up else 1 - MARGIN)


@dataclass
class _Node:
    splits: np.ndarray  # indices of entries
    least: np.ndarray | None = None  # [split, child], rounded down
    greatest: np.ndarray | None = None  # rounded up
    children: list[_Node | None] | None = None


class Gnat:
    """Nearest of some entries, the rows of ``points``."""

    def __init__(self, points: np.ndarray, splits: int = SPLITS, leaf: int = LEAF):
        self.points, self.splits, self.leaf = points, max(2, splits), leaf
        self.compared = self.asked = 0  # entries compared with queries, and without any left out
        self.root = self._node(np.arange(len(points)))

    def _node(self, entries: np.ndarray) -> _Node | None:
        if not len(entries):
            return None
        if len(entries) <= max(self.leaf, self.splits):
            return _Node(entries)
        inside = squared(self.points[entries], self.points[entries])
        chosen = [0]
        far = inside[0].copy()
        while len(chosen) < self.splits:  # the entry farthest from all split points so far
            far[chosen] = -1
            chosen.append(int(np.argmax(far)))
            far = np.minimum(far, inside[chosen[-1]])
        rest = np.setdiff1d(np.arange(len(entries)), chosen)
        home = inside[np.ix_(rest, chosen)].argmin(axis=1)
        count = len(chosen)
        least, greatest = np.full((count, count), np.inf), np.full((count, count), -np.inf)
        children = []
        for child in range(count):
            members = rest[home == child]
            children.append(self._node(entries[members]))
            if len(members):
                ranges = inside[np.ix_(chosen, members)]
                least[:, child] = _roots(ranges.min(axis=1), False)
                greatest[:, child] = _roots(ranges.max(axis=1), True)
        return _Node(entries[chosen], least, greatest, children)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row the index of its nearest entry, the smaller one of equals, and the squared distance."""
        index, best = np.empty(len(queries), np.int64), []
        for at in range(0, len(queries), BLOCK):
            block = queries[at : at + BLOCK]
            found = _Search(self, block)
            found.visit(self.root, np.arange(len(block)))
            index[at : at + len(block)] = found.index
            best.append(found.best)
            self.asked += len(block) * len(self.points)
        return index, np.concatenate(best) if best else np.zeros(0, np.int64)


class _Search:
    def __init__(self, tree: Gnat, queries: np.ndarray):
        self.tree, self.queries = tree, queries
        self.index = np.full(len(queries), -1, np.int64)
        self.best: np.ndarray = np.zeros(len(queries), np.int64)

    def _compare(self, entries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        distances = squared(self.queries[rows], self.tree.points[entries])
        self.tree.compared += distances.size
        if distances.dtype == object and self.best.dtype != object:
            self.best = self.best.astype(object)
        order = np.argsort(entries)
        place = order[distances[:, order].argmin(axis=1)]  # the smallest index of equals
        here, which = distances[np.arange(len(rows)), place], entries[place]
        before, held = self.best[rows], self.index[rows]
        better = ((held < 0) | (here < before) | ((here == before) & (which < held))).astype(bool)
        self.best[rows[better]], self.index[rows[better]] = here[better], which[better]
        return distances

    def visit(self, node: _Node, rows: np.ndarray) -> None:
        distances = self._compare(node.splits, rows)
        if node.children is None:
            return
        low, high = _roots(distances, False), _roots(distances, True)
        home = distances.argmin(axis=1)
        for own in (True, False):  # the child of the closest split point first: it brings the best entry down
            for child, below in enumerate(node.children):
                if below is None:
                    continue
                reach = _roots(self.best[rows], True)[:, None]
                out = (low > node.greatest[:, child] + reach) | (high + reach < node.least[:, child])
                go = ~out.any(axis=1) & ((home == child) == own)
                if go.any():
                    self.visit(below, rows[go])


@dataclass(frozen=True)
class Codebooks:
    """``entries[part]`` has a row for each entry; part p of d components is those from p*d//parts on."""

    dimension: int
    scale: int
    entries: tuple[np.ndarray, ...]

    def cuts(self) -> list[int]:
        parts = len(self.entries)
        return [p * self.dimension // parts for p in range(parts + 1)]

    def digest(self) -> str:
        """Hex SHA-256 of all components, by part, entry and position, with commas between them."""
        return hashlib.sha256(",".join(str(int(x)) for book in self.entries for x in book.ravel()).encode()).hexdigest()


def whole_vectors(vectors: DataFrame, vector: str, scale: int) -> DataFrame:
    """Rows of ``vectors`` whose vector can be coded, with ``_whole``, its components as whole numbers."""
    scaled = F.transform(vector, lambda x: x.cast("double") * scale)
    fits = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST))
    return vectors.where(F.col(vector).isNotNull() & F.coalesce(fits, F.lit(False))).withColumn(
        "_whole", F.transform(scaled, lambda x: F.floor(x).cast("double"))
    )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def _trees(books: Codebooks) -> list[Gnat]:
    return [Gnat(book) for book in books.entries]


def _sums(books: Codebooks):
    """Rows (part, entry, n, sums): for each entry the parts that are nearest to it, added up."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, cuts = _trees(books), books.cuts()
        totals: dict[tuple[int, int], list] = {}
        for batch in batches:
            whole = _matrix(batch.column(0), books.dimension)
            for p, tree in enumerate(trees):
                part = whole[:, cuts[p] : cuts[p + 1]]
                index, _ = tree.nearest(part)
                order = np.argsort(index, kind="stable")
                for rows in np.split(order, np.flatnonzero(np.diff(index[order])) + 1) if len(order) else []:
                    held = totals.setdefault((p, int(index[rows[0]])), [0, [0] * part.shape[1]])
                    held[0] += len(rows)
                    small = np.abs(part[rows]).max(initial=0) * len(rows) < 2**53  # else exact by Python's numbers
                    added = part[rows].sum(0).tolist() if small else [sum(map(int, x)) for x in part[rows].T]
                    held[1] = [a + int(b) for a, b in zip(held[1], added)]
        keys = list(totals)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([p for p, _ in keys], pa.int32()),
                pa.array([e for _, e in keys], pa.int32()),
                pa.array([totals[k][0] for k in keys], pa.int64()),
                pa.array([[str(x) for x in totals[k][1]] for k in keys], pa.list_(pa.string())),
            ],
            ["part", "entry", "n", "sums"],
        )

    return add


def fit(vectors: DataFrame, key: str, vector: str, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> tuple[DataFrame, Codebooks | None]:
    """The rows that can be coded, as a table with ``_whole``, and the codebooks after ``rounds`` rounds.

    Each part's codebook starts as that part of the ``entries`` rows with the
    least keys (null keys last, equal keys by their components). In each round
    every part goes to its nearest entry, and an entry becomes the mean of its
    parts, rounded down; one without parts stays. Left out are rows whose vector
    is null or has a component that is null, not finite or beyond 2**52 after
    scaling, and rows whose vector is not as long as that of the first row.
    There are no codebooks if no row is left.
    """
    rows = whole_vectors(vectors, vector, scale)
    first = rows.orderBy(F.col(key).asc_nulls_last(), "_whole").limit(entries).select("_whole").collect()
    if not first:
        return rows, None
    dimension = len(first[0][0])
    rows = written(rows.where(F.size("_whole") == dimension), "whole")
    if any(len(r[0]) != dimension for r in first):
        first = rows.orderBy(F.col(key).asc_nulls_last(), "_whole").limit(entries).select("_whole").collect()
    start = np.array([r[0] for r in first], np.float64).reshape(len(first), dimension)
    cuts = [p * dimension // parts for p in range(parts + 1)]
    books = Codebooks(dimension, scale, tuple(start[:, a:b] for a, b in zip(cuts, cuts[1:])))
    widest = max(b - a for a, b in zip(cuts, cuts[1:]))
    for _ in range(rounds):
        met = rows.select("_whole").mapInArrow(_sums(books), "part int, entry int, n long, sums array<string>")
        added = met.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i)).cast("decimal(38,0)")).alias(f"s{i}") for i in range(widest))
        )
        new = [book.copy() for book in books.entries]
        for row in added.collect():  # at most parts * entries rows
            width = new[row.part].shape[1]
            new[row.part][row.entry] = [int(row[f"s{i}"]) // row.n for i in range(width)]
        books = Codebooks(dimension, scale, tuple(new))
    return rows, books


def encode(rows: DataFrame, books: Codebooks, columns: list[str]) -> DataFrame:
    """``columns`` of ``rows`` (as :func:`fit` returns them), ``code`` (two hex digits or more a part) and ``error``.

    ``error`` is the squared distance to the entries, added up over parts, as a
    decimal number; null if it has more than 38 digits.
    """
    picked = rows.select(*columns, "_whole")
    schema = T.StructType(
        [*picked.schema.fields[:-1], T.StructField("code", T.StringType()), T.StructField("error", T.StringType())]
    )
    digits = max(2, len(f"{max(len(book) for book in books.entries) - 1:x}"))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, cuts = _trees(books), books.cuts()
        names = np.array([f"{i:0{digits}x}" for i in range(max(len(book) for book in books.entries))], object)
        for batch in batches:
            whole = _matrix(batch.column(batch.num_columns - 1), books.dimension)
            text, error = np.full(len(whole), "", object), np.zeros(len(whole), object)
            for p, tree in enumerate(trees):
                index, best = tree.nearest(whole[:, cuts[p] : cuts[p + 1]])
                text, error = text + names[index], error + best.astype(object)
            columns_out = [batch.column(i) for i in range(batch.num_columns - 1)]
            numbers = pa.array([str(int(e)) for e in error], pa.string())
            yield pa.RecordBatch.from_arrays([*columns_out, pa.array(text.tolist(), pa.string()), numbers], schema.names)

    return picked.mapInArrow(code, schema).withColumn("error", F.expr("try_cast(error AS decimal(38,0))"))


def add_group_error(coded: DataFrame, group: str, out: str) -> DataFrame:
    """``coded`` (a written table) with the sum of ``error`` over rows with an equal ``group``, nulls together."""
    # a name that null shares with no value
    named = coded.withColumn("_group", F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")))
    total = written(named.groupBy("_group").agg(F.sum("error").alias(out)), "totals")
    spread: Column = F.col("code")
    return meet(named, total, "_group", spread, "left").drop("_group")


def compress(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **settings: Any
) -> tuple[DataFrame, Codebooks | None]:
    """(key, code, error, label_error) for each row of ``vectors`` that can be coded, and the codebooks.

    ``settings`` are those of :func:`fit`, which also says what rows are left
    out. Rows that repeat a key are rows of their own; null keys stay null.
    Errors are whole numbers, null if a long cannot hold them. Extra columns are left out, whatever their names.
    An empty table gives no rows and no codebooks.
    """
    plain = vectors.select(F.col(key).alias("key"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    rows, books = fit(plain, "key", "vector", **settings)
    if books is None:
        none = plain.limit(0).select(F.col("key").alias(key), F.lit("").alias("code"))
        return none.withColumns({"error": F.lit(0).cast("long"), "label_error": F.lit(0).cast("long")}), None
    coded = written(encode(rows, books, ["key", "label"]), "coded")
    out = add_group_error(coded, "label", "label_error")
    whole = [F.expr(f"try_cast({c} AS bigint)").alias(c) for c in ("error", "label_error")]
    return out.select(F.col("key").alias(key), "code", *whole), books
