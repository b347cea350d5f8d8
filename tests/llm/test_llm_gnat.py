"""Vector codes against exhaustive search in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest
from compare import differences, sql_session

from relaydesk.llm import gnat_codes, queries
from relaydesk.llm.gnat_codes import Gnat, compress, squared


def nearest(query, entries):
    return min((sum((int(a) - int(b)) ** 2 for a, b in zip(query, e)), i) for i, e in enumerate(entries))


@pytest.mark.parametrize("size", [1, 2, 7, 40, 256])
def test_tree_finds_the_nearest_and_the_smaller_index_of_equals(size):
    draw = np.random.default_rng(size)
    for spread in (1, 3, 200, 2**30):  # the first has very many ties, the last is beyond exact doubles
        entries = draw.integers(-spread, spread + 1, (size, 5)).astype(np.float64)
        queries_ = np.concatenate([draw.integers(-spread, spread + 1, (60, 5)), entries[:20]]).astype(np.float64)
        index, best = Gnat(entries).nearest(queries_)
        for q, i, d in zip(queries_, index, best):
            assert (int(d), int(i)) == nearest(q, entries)


def test_subtrees_are_left_out():
    draw = np.random.default_rng(0)
    centres = draw.integers(-2000, 2000, (16, 16))
    entries = (centres[draw.integers(0, 16, 256)] + draw.integers(-60, 60, (256, 16))).astype(np.float64)
    queries_ = (centres[draw.integers(0, 16, 500)] + draw.integers(-60, 60, (500, 16))).astype(np.float64)
    tree = Gnat(entries)
    index, _ = tree.nearest(queries_)
    assert (index == squared(queries_, entries).argmin(axis=1)).all()
    assert tree.compared < 0.5 * tree.asked


def test_same_entries_and_no_components():
    index, best = Gnat(np.ones((100, 3))).nearest(np.zeros((4, 3)))
    assert index.tolist() == [0] * 4 and best.tolist() == [3] * 4
    index, best = Gnat(np.zeros((9, 0))).nearest(np.zeros((2, 0)))
    assert index.tolist() == [0, 0] and best.tolist() == [0, 0]
    assert len(Gnat(np.ones((5, 2))).nearest(np.zeros((0, 2)))[0]) == 0


def by_hand(rows, parts, entries, rounds, scale=1024):
    """Codes, errors and books of (key, vector, label) rows, by loops over Python's numbers."""
    kept = [
        (k, [math.floor(scale * x) for x in v], g)
        for k, v, g in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    d = len(kept[0][1])
    cut = [p * d // parts for p in range(parts + 1)]
    books = [[v[cut[p] : cut[p + 1]] for _, v, _ in kept[:entries]] for p in range(parts)]
    for _ in range(rounds):
        for p, book in enumerate(books):
            met = {}
            for _, v, _ in kept:
                part = v[cut[p] : cut[p + 1]]
                met.setdefault(nearest(part, book)[1], []).append(part)
            for i, those in met.items():
                book[i] = [sum(x) // len(those) for x in zip(*those)]
    out = []
    for k, v, g in kept:
        found = [nearest(v[cut[p] : cut[p + 1]], book) for p, book in enumerate(books)]
        out.append((k, "".join(f"{i:02x}" for _, i in found), sum(e for e, _ in found), g))
    groups = {}
    for _, _, e, g in out:
        groups[g] = groups.get(g, 0) + e
    return sorted((-1 if k is None else k, c, e, groups[g]) for k, c, e, g in out), books


def coded(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, code string, key int, vector int")
    out, books = compress(frame, **settings)
    assert out.columns == ["vec_id", "code", "error", "label_error"]
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in out.collect()), books


def test_codes_are_those_of_exhaustive_search(spark):
    draw = random.Random(2)
    rows = [(i, [draw.gauss(0, 0.2) for _ in range(10)], draw.choice([None, 0, 1])) for i in range(150)]
    rows += [(i, rows[i][1], 1) for i in range(0, 150, 10)]  # repeated rows
    rows += [(200, None, 0), (201, [None] + [0.0] * 9, 0), (202, [math.nan] + [0.0] * 9, 0), (203, [math.inf] * 10, 1)]
    rows += [(None, [0.5] * 10, None), (-5, [-3.25] * 10, 7)]
    expected, books = by_hand(rows, 4, 20, 3)
    got, found = coded(spark, [(*r, "x", 1, 2) for r in rows], parts=4, entries=20, rounds=3)
    assert got == expected
    assert [b.astype(int).tolist() for b in found.entries] == books
    flat = ",".join(str(x) for book in books for entry in book for x in entry)
    assert found.digest() == hashlib.sha256(flat.encode()).hexdigest()


def test_edges(spark):
    assert coded(spark, []) == ([], None)
    assert coded(spark, [(1, None, 1, "x", 1, 1)]) == ([], None)
    assert coded(spark, [(1, [], 1, "x", 1, 1), (2, [], 1, "x", 1, 1)])[0] == [(1, "00000000", 0, 0), (2, "00000000", 0, 0)]
    # one vector of another length is left out, and one too large to be told from its neighbours
    rows = [(1, [1.0] * 4, 1, "x", 1, 1), (2, [2.0] * 5, 1, "x", 1, 1), (3, [1e300] * 4, 1, "x", 1, 1), (4, [-1e6] * 4, 1, "x", 1, 1)]
    assert [r[0] for r in coded(spark, rows)[0]] == [1, 4]
    # errors beyond a long are null
    far = [(1, [0.0] * 4, 1, "x", 1, 1), (2, [4e9] * 4, 2, "x", 1, 1)]
    assert coded(spark, far, entries=1, rounds=0)[0] == [(1, "00000000", 0, 0), (2, "00000000", None, None)]


def test_query_equals_sql(spark):
    con = sql_session("/root/testdata/sf0.001")
    expected = con.execute(queries.SQL["op12_gnat_codes"]).df()
    assert differences(queries.REGISTRY["op12_gnat_codes"](spark, "/root/testdata/sf0.001").toPandas(), expected) == []
    assert gnat_codes.SPLITS > 1
