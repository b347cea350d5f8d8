"""Periodic runs against the definition."""

import hashlib
import random
import zlib
from itertools import product

import numpy as np
import pytest

from relaydesk.llm import periodic_runs, queries
from relaydesk.llm.periodic_runs import find_runs, occurrences, runs, suspects, text_runs


def by_definition(words, least, times):
    """Stretches in which words q apart are equal, as long as they go, that have no smaller period."""
    n, out = len(words), []
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            part = words[start : start + length]
            if length >= max(least, times * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                out.append((start, length, q))
    return sorted(out)


def drawn(draw):
    kind, n = draw.randint(0, 3), draw.randint(0, 70)
    words = [draw.randint(0, draw.choice([1, 2, 5, 30])) for _ in range(n)]
    if kind:  # put repetitions in
        for _ in range(kind):
            a, p = draw.randint(0, max(0, n - 1)), draw.randint(1, 9)
            for i in range(a + p, min(n, a + p * draw.randint(2, 7) + draw.randint(0, 3))):
                words[i] = words[i - p]
    return words


def test_all_runs_of_all_short_texts():
    for n in range(9):
        for words in product((0, 1), repeat=n):
            assert sorted(runs(list(words), 2, 2)) == by_definition(list(words), 2, 2)
    for words in product((0, 1, 2), repeat=7):
        assert sorted(runs(list(words), 2, 2)) == by_definition(list(words), 2, 2)


@pytest.mark.parametrize(("least", "times"), [(2, 2), (6, 4), (5, 3), (12, 5)])
def test_runs_of_random_texts(least, times):
    draw = random.Random(least)
    for _ in range(400):
        words = drawn(draw)
        expected = by_definition(words, least, times)
        assert sorted(runs(words, least, times)) == expected
        numbers = np.array(words, np.int64)
        kept = suspects(numbers, np.zeros(len(words), np.int64), least, times)
        assert sorted(text_runs(numbers, kept, least, times) if len(kept) else []) == expected


def test_setting_aside_keeps_texts_apart_and_leaves_little():
    draw = random.Random(1)
    texts = [drawn(draw) for _ in range(300)]
    owner = np.repeat(np.arange(300), [len(t) for t in texts])
    flat = np.array([w for t in texts for w in t], np.int64)
    kept = suspects(flat, owner)
    first = np.cumsum([0] + [len(t) for t in texts])
    for a, b in kept.tolist():
        assert owner[a] == owner[b - 1]
    for i, words in enumerate(texts):
        for start, length, _ in by_definition(words, 6, 4):
            assert any(a <= first[i] + start and first[i] + start + length <= b for a, b in kept.tolist())
    plain = np.array([draw.randint(0, 400) for _ in range(20_000)], np.int64)
    assert len(suspects(plain, np.zeros(len(plain), np.int64))) == 0
    twice = np.concatenate([plain, plain])  # a passage that comes again is no run
    assert len(suspects(twice, np.zeros(len(twice), np.int64))) == 0


def test_every_few_words_of_a_run_come_again():
    for least, times in ((6, 4), (2, 2), (9, 3)):
        for k in (3, 5):
            seen = min(
                min(sum(1 for j in range(n - k + 1) if (j - i) % q == 0) for i in range(n - k + 1))
                for q in range(1, 30)
                if (n := max(least, times * q)) >= k
            )
            assert seen >= occurrences(k, least, times)
    assert occurrences(3, 6, 4) == 3 and occurrences(5, 6, 4) == 2


def test_long_texts():
    assert runs([7] * 30_000) == [(0, 30_000, 1)]
    words = [i % 1000 for i in range(30_000)]
    assert runs(words) == [(0, 30_000, 1000)]
    text = np.array([*range(3000, 5000), *range(1000), *words, *range(2000, 9000)], np.int64)
    kept = suspects(text, np.zeros(len(text), np.int64))
    assert text_runs(text, kept) == [(2000, 31_000, 1000)]


def test_rows_of_every_kind(spark):
    rows = [
        (1, None, "x"),
        (2, "", "x"),
        (3, " \t\r\n", "x"),
        (4, "a " * 7 + "b", "x"),
        (4, "a " * 7 + "b", "x"),
        (None, "p  q\tp q\np q p q tail tail", "x"),
        (5, "x y z " * 4, "x"),
        (6, "x y z " * 3 + "x y", "x"),
    ]
    out = find_runs(spark.createDataFrame(rows, "doc_id long, text string, runs string"))
    assert out.columns == ["doc_id", "runs", "collapsed"]
    got = sorted((-1 if r.doc_id is None else r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    assert got == [
        (-1, [(0, 8, 2)], "p q tail tail"),
        (1, [], ""),
        (2, [], ""),
        (3, [], ""),
        (4, [(0, 7, 1)], "a b"),
        (4, [(0, 7, 1)], "a b"),
        (5, [(0, 12, 3)], "x y z"),
        (6, [], "x y z x y z x y z x y"),
    ]
    assert find_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        find_runs(spark.range(1).selectExpr("id AS doc_id", "'' AS text"), times=1)


def planted(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(8)
    rows = [(i, " ".join(draw.choice(["a", "b", "é", "long one"]) for _ in range(draw.randint(0, 60)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "one two " * 40)]
    rows += [(i, " ".join(f"w{j}" for j in range(draw.randint(1, 200)))) for i in range(403, 600)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in queries.REGISTRY["op11_periodic_runs"](spark, str(tmp_path)).collect()}
    assert len(out) == len(rows)
    many = 0
    for doc_id, text in rows:
        words, row = planted(doc_id, text), out[doc_id]
        found = by_definition(words, 6, 4)
        many += bool(found)
        assert row.n_runs == len(found)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        if best is None:
            assert (row.start, row.length, row.period, row.exponent_milli) == (None,) * 4
        else:
            assert (row.start, row.length, row.period) == best and row.exponent_milli == 1000 * best[1] // best[2]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in sorted(found, key=lambda r: (r[0], r[2])))
        gone = {i for s, n, q in found for i in range(s + q, s + n)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        for column, content in (("runs_sha256", listed), ("collapsed_sha256", kept)):
            assert row[column] == hashlib.sha256(content.encode()).hexdigest()
    assert many > 20
    assert periodic_runs.LEAST == 6 and periodic_runs.TIMES == 4
