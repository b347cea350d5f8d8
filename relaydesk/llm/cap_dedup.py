"""Near duplicates of embeddings by spherical caps.

Filter directions form product codes: for each of a few tables a vector is
rotated by a random orthonormal matrix and cut into blocks, every block has a
code book of random unit vectors, and a direction is one code of each block. A vector falls into
the caps of all directions whose inner product with it reaches a threshold;
list decoding finds them from the sorted scores of the blocks without going
through all directions. Vectors that share a cap are joined and verified by
their cosine in double precision.

A link is counted in the least cap that both vectors have, so no pair is
counted twice and no list of pairs is made: a task gives, for every vector it
holds, the number of its links and one node of its component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.llm.common import salted, written
from relaydesk.llm.components import components

COSINE = 0.9
BLOCK = 1024


class CapCode:
    """Directions for vectors of one length; the same for every task.

    ``threshold`` is in standard deviations of the inner product of a unit
    vector with a random direction. With the defaults there are 9,216 directions,
    of which a vector of 64 components reaches about 37, and two vectors with a
    cosine of 0.9 share one with a probability of 0.996.
    """

    def __init__(self, size: int, tables: int = 4, blocks: int = 2, codes: int = 48, threshold: float = 2.6, seed: int = 7):
        blocks = max(1, min(blocks, size))
        self.cuts = [size * i // blocks for i in range(blocks + 1)]
        # short vectors could not reach the threshold
        self.codes, self.least = codes, min(threshold / np.sqrt(size), 0.5) * np.sqrt(blocks)
        self.tables = []
        for table in range(tables):
            draw = np.random.default_rng([seed, size, table])
            rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
            books = [draw.standard_normal((codes, b - a)) for a, b in zip(self.cuts, self.cuts[1:])]
            self.tables.append((rotation, [book / np.linalg.norm(book, axis=1, keepdims=True) for book in books]))

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For each unit vector the directions of its caps, in order."""
        per_table = self.codes ** (len(self.cuts) - 1)
        found = [
            [names + i * per_table for names in self._decode(unit, rotation, books)]
            for i, (rotation, books) in enumerate(self.tables)
        ]
        return [np.concatenate(own).astype(np.int32) for own in zip(*found)]

    def _decode(self, unit: np.ndarray, rotation: np.ndarray, books: list[np.ndarray]) -> list[np.ndarray]:
        turned = unit @ rotation
        scores = [turned[:, a:b] @ book.T for a, b, book in zip(self.cuts, self.cuts[1:], books)]
        out = []
        for row in zip(*scores):
            orders = [np.argsort(-s, kind="stable") for s in row]
            ranked = [s[o] for s, o in zip(row, orders)]
            # what the blocks from each one on can add at most
            rest = np.cumsum([0.0] + [r[0] for r in reversed(ranked)])[::-1]
            sums, names = np.zeros(1), np.zeros(1, np.int64)
            for i, (order, values) in enumerate(zip(orders, ranked)):
                # the codes that a partial sum can take are a prefix of the ranked ones
                take = np.searchsorted(-values, -(self.least - rest[i + 1] - sums), side="right")
                at = np.repeat(np.arange(len(sums)), take)
                place = np.arange(len(at)) - np.repeat(np.cumsum(take) - take, take)
                sums, names = sums[at] + values[place], names[at] * self.codes + order[place]
            out.append(np.sort(names))
        return out


def _caps(code: dict):
    def caps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, CapCode] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                vectors = [np.asarray(v) for v in part.column("vector").to_numpy(zero_copy_only=False)]
                lists: list = [None] * len(vectors)
                sizes = np.array([len(v) for v in vectors])
                for size in set(sizes.tolist()):
                    if size not in made:
                        made[size] = CapCode(size, **code)
                    rows = np.flatnonzero(sizes == size)
                    stacked = np.stack([vectors[i] for i in rows]).astype(np.float64)
                    unit = stacked / np.linalg.norm(stacked, axis=1, keepdims=True)
                    for i, names in zip(rows, made[size].decode(unit)):
                        lists[i] = names
                yield part.append_column("caps", pa.array(lists, pa.list_(pa.int32())))

    return caps


def _verify(cosine: float):
    def verify(table: pa.Table) -> pa.Table:
        cap = table.column("cap")[0].as_py()["name"]
        name = table.column("class").to_numpy()
        side = table.column("side").to_numpy()
        copies = table.column("copies").to_numpy().astype(np.float64)
        x = np.stack(table.column("vector").to_numpy()).astype(np.float64)
        norm = np.linalg.norm(x, axis=1)
        linked = (x @ x.T) / np.outer(norm, norm) >= cosine
        np.fill_diagonal(linked, False)
        if side.min() != side.max():  # two blocks: what lies in one of them is another task's
            linked &= side[:, None] != side[None, :]
        near = np.flatnonzero(linked.any(axis=1))
        links, first = np.zeros(len(name)), name.copy()
        if len(near):
            linked = linked[np.ix_(near, near)]
            lists = table.column("caps").take(pa.array(near)).to_pylist()
            lower = [[c for c in own if c < cap] for own in lists]
            known = {c: i for i, c in enumerate(sorted({c for own in lower for c in own}))}
            if known:  # pairs that share a lower cap are counted there
                has = np.zeros((len(near), len(known)), np.float32)
                for i, own in enumerate(lower):
                    has[i, [known[c] for c in own]] = 1
                linked &= (has @ has.T) == 0
            links[near] = linked @ copies[near]
            left = np.ones(len(near), bool)
            while left.any():
                reached = np.zeros(len(near), bool)
                front = np.zeros(len(near), bool)
                front[np.argmax(left)] = True
                while front.any():
                    reached |= front
                    front = linked[front].any(axis=0) & ~reached
                first[near[reached]] = name[near[reached]].min()
                left &= ~reached
        keep = links > 0
        return pa.table(
            {"class": pa.array(name[keep]), "links": pa.array(links[keep].astype(np.int64)), "first": pa.array(first[keep])}
        )

    return verify


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, **code
) -> DataFrame:
    """(key, n_links, component_id, kept) for each row of ``vectors``, keys being whole numbers.

    ``n_links`` counts the other rows found to have a cosine of ``cosine`` or
    more, ``component_id`` is the least key that links lead to, and ``kept``
    tells whether that is the row's own. Vectors that are null, zero or hold a
    null, infinite or undefined component link with nothing, and vectors of
    different lengths not with each other. Equal vectors are one class and
    always found; a link between classes is missed if they share no cap, which
    ``code`` (see :class:`CapCode`) makes as rare as one likes. Rows that repeat
    a key are rows of their own. A null key gives a row without component.
    Other columns are left out, and an empty table gives no rows.
    """
    kind = vectors.schema[embedding].dataType
    element = kind.elementType if isinstance(kind, T.ArrayType) else T.DoubleType()
    vector = F.col(embedding) if isinstance(element, (T.FloatType, T.DoubleType)) else F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(key).cast("long").alias("key"), vector.alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    some = F.exists("vector", lambda v: v != 0)
    good = F.coalesce(finite & some, F.lit(False)) & F.col("key").isNotNull()
    rows = rows.withColumn("name", F.when(good, F.struct(F.xxhash64("vector").alias("a"), F.xxhash64("vector", F.lit(1)).alias("b"))))

    alike = rows.where("name is not null").groupBy("name", "vector").agg(F.min("key").alias("class"), F.count("*").alias("copies"))
    alike = written(alike, "classes")
    bare = T.StructType([f for f in alike.select("class", "copies", "vector").schema] + [T.StructField("caps", T.ArrayType(T.IntegerType()))])
    listed = written(alike.select("class", "copies", "vector").mapInArrow(_caps(code), bare), "caps")

    # vectors of other lengths have caps of their own
    each = listed.withColumn("cap", F.explode("caps")).withColumn("cap", F.struct(F.size("vector").alias("size"), F.col("cap").alias("name")))
    sizes = each.groupBy("cap").agg(F.count("*").alias("_n")).where("_n > 1")
    sizes = sizes.select("cap", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    dealt = salted(each, sizes, "cap", F.col("class"), "inner").withColumn("side", F.pmod(F.xxhash64("class"), F.col("_blocks")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    dealt = dealt.withColumn("_i", F.least("side", "_other")).withColumn("_j", F.greatest("side", "_other"))
    found = dealt.select("cap", "_i", "_j", "side", "class", "copies", "vector", "caps").groupBy("cap", "_i", "_j")
    found = written(found.applyInArrow(_verify(cosine), "class long, links long, first long"), "links")

    counts = found.groupBy("class").agg(F.sum("links").alias("links"))
    parts = components(found.where("class <> first"), "class", "first")
    facts = (
        alike.select("name", "class", "copies")
        .join(counts, "class", "left")
        .join(parts.select(F.col("node").alias("class"), "component"), "class", "left")
        .select("name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "class").alias("component_id"))
    )
    joined = salted(rows.select("key", "name"), written(facts, "facts"), "name", F.col("key"))
    component = F.coalesce("component_id", "key")
    return joined.select(
        F.col("key").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("key"), F.lit(False)).alias("kept"),
    )
