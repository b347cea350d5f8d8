import math
import random
import tracemalloc
from collections import Counter

import pyarrow as pa
import pytest

from relaydesk.functions.overlap import PIECE, add_overlap_scores, in_pieces, lcs_length


def _dp(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row
        row = [0]
        for j, y in enumerate(b):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
    return row[-1]


def test_bit_parallel_lcs_equals_the_table():
    rng = random.Random(3)
    for _ in range(200):
        a = [rng.choice("abcde") for _ in range(rng.randint(0, 90))]
        b = [rng.choice("abcdef") for _ in range(rng.randint(0, 90))]
        assert lcs_length(a, b) == _dp(a, b)


def _f(common, h, r):
    p, q = common / h if h else 0, common / r if r else 0
    return 2 * p * q / (p + q) if p + q else 0.0


def _plain(h, r):
    h, r = h.lower().split(), r.lower().split()
    bag = lambda x, n: Counter(tuple(x[i : i + n]) for i in range(len(x) - n + 1))
    common = [sum((bag(h, n) & bag(r, n)).values()) for n in range(1, 5)]
    out = {f"rouge{n}": _f(common[n - 1], max(len(h) - n + 1, 0), max(len(r) - n + 1, 0)) for n in (1, 2)}
    out["rougeL"] = _f(_dp(h, r), len(h), len(r))
    out["bleu4"] = 0.0
    if len(h) >= 4 and len(r) >= 4 and min(common) > 0:
        logs = sum(math.log(common[n - 1] / (len(h) - n + 1)) for n in range(1, 5)) / 4
        out["bleu4"] = (1.0 if len(h) > len(r) else math.exp(1 - len(r) / len(h))) * math.exp(logs)
    return out


def test_scores_against_plain_counts(spark):
    rng = random.Random(4)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "the", "Help", "é"]) for _ in range(n))
    pairs = [(text(rng.randint(0, 25)), text(rng.randint(0, 25))) for _ in range(80)]
    same = text(12)
    pairs += [(same, same), (same, same + " tail words"), (same + " x y", same), ("", ""), ("a", "a"), ("a b c", "a b c")]
    df = spark.createDataFrame([(i, h, r) for i, (h, r) in enumerate(pairs)], "id long, h string, r string")
    positive = 0
    for row in add_overlap_scores(df, "h", "r").collect():
        expected = _plain(row.h, row.r)
        positive += expected["bleu4"] > 0
        assert {k: row[k] for k in expected} == pytest.approx(expected), (row.h, row.r)
    assert positive > 5


def test_subset_of_scores_and_null_texts(spark):
    df = spark.createDataFrame([("a b", None), ("a b", "a b")], "h string, r string")
    out = add_overlap_scores(df, "h", "r", ("rougeL",))
    assert out.columns == ["h", "r", "rougeL"]
    assert [r.rougeL for r in out.collect()] == [0.0, 1.0]


def test_only_a_piece_of_a_batch_becomes_objects():
    rows = [["a"] * 200] * (20 * PIECE)
    column = pa.array(rows)
    tracemalloc.start()
    assert sum(len(r) for r in in_pieces(column)) == 200 * len(rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.start()
    everything = column.to_pylist()
    assert peak < tracemalloc.get_traced_memory()[1] / 5
    tracemalloc.stop()
    assert list(in_pieces(column, 7)) == everything and list(in_pieces(column.slice(0, 0))) == []
