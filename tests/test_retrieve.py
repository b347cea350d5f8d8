import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from relaydesk.operators import retrieve, tfidf
from relaydesk.operators.logistic import IntentModel
from relaydesk.operators.reply import nearest_reply
from relaydesk.operators.retrieve import ReplyIndex, add_exemplars
from relaydesk.operators.tfidf import TfidfModel, vocabulary

VOCAB = "battery drain charge screen update app wifi the a is my i x login password broken new old slow".split()


def _terms(text):
    w = re.findall(r"\w\w+", text.lower())
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def _fit(texts, features, sublinear):
    """Plain tf-idf: (sorted terms, idf, function giving {position: weight})."""
    counts = [Counter(_terms(t)) for t in texts]
    tf, df = Counter(), Counter()
    for c in counts:
        tf.update(c)
        df.update(c.keys())
    kept = sorted(sorted(tf, key=lambda t: (-tf[t], t))[:features])
    idf = {t: math.log((1 + len(texts)) / (1 + df[t])) + 1 for t in kept}
    place = {t: i for i, t in enumerate(kept)}

    def weigh(text):
        raw = {place[t]: (1 + math.log(n) if sublinear else n) * idf[t] for t, n in Counter(_terms(text)).items() if t in place}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {t: x / norm for t, x in raw.items()}

    return kept, idf, weigh


def _texts(n, seed, words=8):
    rng = random.Random(seed)
    return [" ".join(rng.choice(VOCAB) for _ in range(rng.randint(0, words))) for _ in range(n)]


@pytest.mark.parametrize("sublinear, way", [(True, "one pass"), (False, "pruned"), (True, "too many words to prune")])
def test_tfidf_matches_plain_counts(spark, sublinear, way, monkeypatch):
    if way != "one pass":
        monkeypatch.setattr(tfidf, "SINGLE_PASS_BYTES", -1)
    if way == "too many words to prune":
        monkeypatch.setattr(tfidf, "MAX_FREQUENT_WORDS", -1)
    texts = [*_texts(60, 1), "", "x", "battery battery battery"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    for features in (1, 12, 10_000):
        assert list(TfidfModel.fit(df, "t", features, sublinear).terms) == _fit(texts, features, sublinear)[0]
    kept, idf, weigh = _fit(texts, 40, sublinear)
    model = TfidfModel.fit(df, "t", 40, sublinear)
    assert list(model.terms) == kept
    assert list(model.idf) == pytest.approx([idf[t] for t in kept])
    unknown = df.unionByName(spark.createDataFrame([(99, "qq ww"), (100, None)], "id long, t string"))
    for row in model.transform(unknown, "t").collect():
        assert dict(zip(row.vec.idx, row.vec.w)) == pytest.approx(weigh(row.t or "")), row.t


def test_vocabulary_cut_breaks_ties_by_term(spark):
    df = spark.createDataFrame([(1, "bb aa cc"), (2, "aa")], "id long, t string")
    assert [r.term for r in vocabulary(df, "t", 3).collect()] == ["aa", "aa cc", "bb"]
    with pytest.raises(ValueError):
        vocabulary(df, "t", 0)


def _replies(spark, texts):
    rows = [(i, t, f"answer {i}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "conv_id long, customer_inquiry string, support_resolution string")


def _exact(kb, queries, k, own):
    _, _, weigh = _fit(kb, 5000, True)
    vectors = [weigh(t) for t in kb]
    out = {}
    for q, text in enumerate(queries):
        v = weigh(text)
        scores = [(i, sum(x * d.get(t, 0.0) for t, x in v.items())) for i, d in enumerate(vectors) if not (own and i == q)]
        best = sorted((s for s in scores if s[1] > 0), key=lambda s: (-round(s[1], 9), s[0]))[:k]
        out[q] = best
    return out


@pytest.mark.parametrize("own", [False, True])
@pytest.mark.parametrize("limit", [10**9, 0])
def test_both_ways_find_the_exact_neighbours(spark, limit, own, monkeypatch):
    monkeypatch.setattr(retrieve, "POSTINGS_PER_PIECE", 7)
    kb = [*_texts(50, 2), "the the the", "the", "the a", "my battery", "my battery", ""]
    # many copies of one message, of which all are answered
    queries = [*kb[:20], *["the is my battery"] * 40, "", "unknown words only"]
    index = ReplyIndex.build(_replies(spark, kb), max_broadcast=limit)
    assert index.fits_broadcast == (limit > 0)
    asked = spark.createDataFrame(list(enumerate(queries)), "id long, t string")
    got = {}
    for row in add_exemplars(asked, "t", index, 3, own="id" if own else None).collect():
        got[row.id] = [(e.kb_id, e.score) for e in row.exemplars]
    expected = _exact(kb, queries, 3, own)
    assert {q: [e[0] for e in v] for q, v in got.items()} == {q: [e[0] for e in v] for q, v in expected.items()}
    for q, found in got.items():
        assert [s for _, s in found] == pytest.approx([s for _, s in expected[q]])


def test_top_one_without_a_known_term_is_the_first_reply(spark):
    index = ReplyIndex.build(_replies(spark, ["battery drain", "screen broken"]))
    asked = spark.createDataFrame([(1, "my screen is broken"), (2, "qqq"), (3, None)], "id long, t string")
    out = nearest_reply(add_exemplars(asked, "t", index, 1), index, "exemplars", "canned")
    assert {r.id: r.reply for r in out.collect()} == {1: "answer 1", 2: "answer 0", 3: "answer 0"}


@pytest.mark.parametrize("limit", [10**9, 0])
def test_large_ids_and_rows_without_an_own_thread(spark, limit):
    big = 2**62 + 1
    replies = spark.createDataFrame(
        [(str(big), "my battery", "a"), (str(big + 1), "my battery", "b")],
        "conversation_id string, customer_inquiry string, support_resolution string",
    )
    index = ReplyIndex.build(replies, key="conversation_id", max_broadcast=limit)
    asked = spark.createDataFrame(
        [(1, big, "my battery"), (2, big + 1, "my battery"), (3, None, "my battery")], "id long, me long, t string"
    )
    got = {r.id: [e.kb_id for e in r.exemplars] for r in add_exemplars(asked, "t", index, 2, own="me").collect()}
    assert got == {1: [big + 1], 2: [big], 3: [big, big + 1]}


def test_empty_reply_table_gives_canned_text(spark):
    index = ReplyIndex.build(_replies(spark, ["x"]).limit(0))
    asked = spark.createDataFrame([(1, "my screen")], "id long, t string")
    found = add_exemplars(asked, "t", index, 3)
    assert found.first().exemplars == []
    assert nearest_reply(found, index, "exemplars", "canned").first().reply == "canned"


def test_scoring_in_place_does_not_shuffle(spark):
    index = ReplyIndex.build(_replies(spark, _texts(20, 3)))
    asked = spark.range(100).select(F.col("id"), F.lit("my battery").alias("t"))
    out = nearest_reply(add_exemplars(asked, "t", index, 1), index, "exemplars", "canned")
    plan = out._jdf.queryExecution().executedPlan().toString()
    # the only exchange over the messages would be a hash partitioning
    assert "hashpartitioning" not in plan.split("Subquery")[0]


def test_regression_minimises_the_stated_objective(spark):
    rng = random.Random(5)
    words = {"a": VOCAB[:8], "b": VOCAB[5:13], "c": VOCAB[10:]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(6)), x) for i, x in enumerate("aaabbc" * 12)]
    df = spark.createDataFrame(rows, "id long, t string, label string")
    model = IntentModel.fit(df, "t", "label")
    _, _, weigh = _fit([r[1] for r in rows], 2500, True)
    x = np.zeros((len(rows), len(model.tfidf.terms)))
    for i, r in enumerate(rows):
        for t, v in weigh(r[1]).items():
            x[i, t] = v
    y = np.array([[r[2] == c for c in model.classes] for r in rows], float)
    weight = (len(rows) / (3 * y.sum(0)))[y.argmax(1)]
    w, b = np.array(model.weights), np.array(model.intercepts)
    z = x @ w.T + b
    p = np.exp(z - z.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    error = (p - y) * weight[:, None]
    assert np.abs(error.T @ x + w).max() < 0.02
    assert np.abs(error.sum(0)).max() < 0.02
    labels = ("c", "never_seen", "b", "a")
    got = model.probabilities(df, "t", labels, "p").orderBy("id").collect()
    order = [model.classes.index(v) if v in model.classes else None for v in labels]
    for row, expected in zip(got, p):
        assert row.p == pytest.approx([0.0 if o is None else expected[o] for o in order], abs=1e-9)


def test_regression_generalises_beyond_the_majority(spark):
    rng = random.Random(6)
    words = {"a": VOCAB[:8], "b": VOCAB[6:14], "c": VOCAB[12:]}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(8)), x) for i, x in enumerate("aaabbc" * 30)]
    df = spark.createDataFrame(rows, "id long, t string, label string")
    model = IntentModel.fit(df.where("id < 120"), "t", "label")
    held = model.probabilities(df.where("id >= 120"), "t", model.classes, "p").collect()
    right = sum(model.classes[max(range(3), key=lambda i: r.p[i])] == r.label for r in held)
    assert right / len(held) > 0.8 > 0.5


def test_nulls_in_a_question_are_told_apart(spark):
    replies = spark.createDataFrame(
        [(55, "the 55 battery drains fast", "answer"), (56, "55 something about wifi", "other")],
        "conv_id long, customer_inquiry string, support_resolution string",
    )
    rows = [(1, "55", None), (2, None, 55), (3, "55", 55), (4, None, None), (5, "", None), (6, "unknown words", 55)]
    messages = spark.createDataFrame(rows, "id long, text string, own long")
    index = ReplyIndex.build(replies)
    ways = [index, index.with_broadcast_limit(0)]
    got = [
        {r.id: [h.kb_id for h in r.exemplars] for r in add_exemplars(messages, "text", way, k=3, own="own").collect()}
        for way in ways
    ]
    assert got[0] == got[1]
    assert got[0][2] == got[0][4] == got[0][5] == got[0][6] == [] and 55 not in got[0][3] and got[0][1]


def test_pairs_of_a_term_are_added_up_where_they_meet(spark):
    index = ReplyIndex.build(_replies(spark, _texts(30, 2)), max_broadcast=0)
    asked = spark.createDataFrame(list(enumerate(_texts(20, 3))), "id long, t string")
    plan = add_exemplars(asked, "t", index, 3)._jdf.queryExecution().optimizedPlan().toString()
    # messages meet their answers; questions and postings were joined to rows for each pair before
    assert plan.count("Join ") == 1 and "kb_weight" not in plan


def test_slices_and_skipped_terms_change_nothing(spark, monkeypatch):
    kb = [f"rare{i % 40} word{i % 7} the is my" for i in range(300)] + ["the", "is"]
    asked = spark.createDataFrame([(i, f"rare{i} rare{i + 1} the is my") for i in range(41)] * 2, "id long, t string")
    whole, cut = (ReplyIndex.build(_replies(spark, kb), max_broadcast=limit) for limit in (10**9, 0))
    monkeypatch.setattr(retrieve, "QUESTIONS_PER_SLICE", 10)
    monkeypatch.setattr(retrieve, "POSTINGS_PER_PIECE", 500)
    rows = [
        sorted((r.id, [(e.kb_id, round(e.score, 9)) for e in r.exemplars]) for r in add_exemplars(asked, "t", index, 2).collect())
        for index in (whole, cut)
    ]
    assert rows[0] == rows[1] and len(rows[0]) == 82


def test_a_task_joins_one_slice_with_one_block(spark, monkeypatch):
    # dealt by a hash, several pairs met in one task, and small ones were put together
    index = ReplyIndex.build(_replies(spark, _texts(60, 2)), max_broadcast=0)
    asked = spark.createDataFrame(list(enumerate(_texts(50, 3))), "id long, t string")
    monkeypatch.setattr(retrieve, "QUESTIONS_PER_SLICE", 10)
    monkeypatch.setattr(retrieve, "POSTINGS_PER_PIECE", -(-index.postings // 3))
    plan = add_exemplars(asked, "t", index, 3)._jdf.queryExecution().executedPlan().toString()
    cells = re.findall(r"Exchange shufflepartitionidpassthrough\(.*?, (\d+)\), REPARTITION_BY_NUM", plan)
    assert cells == ["18", "18"] and plan.count("hashpartitioning(cell") == 0


def _unit_rows(draw, rows, terms, most):
    """Sorted term positions and unit weights; low positions are common."""
    out = []
    for _ in range(rows):
        idx = np.unique((terms * draw.random(draw.integers(1, most)) ** 3).astype(np.int64))
        w = draw.random(len(idx)) + 0.01
        out.append((idx, w / np.sqrt((w * w).sum())))
    return out


@pytest.mark.parametrize("cells", [1 << 23, 5000])
@pytest.mark.parametrize("k", [1, 3])
def test_messages_that_touch_many_replies_are_scored_together(k, cells, monkeypatch):
    monkeypatch.setattr(retrieve, "CELLS", cells)
    draw = np.random.default_rng(k)
    replies = _unit_rows(draw, 700, 80, 12)
    replies += replies[:60]  # ties
    ids = np.sort(draw.choice(10_000, len(replies), replace=False)) + 2**61
    terms = np.concatenate([i for i, _ in replies])
    order = np.argsort(terms, kind="stable")
    start = np.searchsorted(terms[order], np.arange(81))
    place = np.repeat(np.arange(len(replies)), [len(i) for i, _ in replies])[order]
    weight = np.concatenate([w for _, w in replies])[order]
    asked = [*_unit_rows(draw, 150, 80, 40), *replies[:20], (np.zeros(0, np.int64), np.zeros(0))]
    own = [None if i % 2 else str(ids[(i * 7) % len(ids)]) for i in range(len(asked))]
    alone, one = [], lambda i, x, o: retrieve._best(i, x, o, ids, start, place, weight, k)
    sums = retrieve._Sums(ids, start, place, weight)
    got = sums.best([i for i, _ in asked], [w for _, w in asked], own, k, lambda *m: alone.append(m) or one(*m))
    assert 0 < len(alone) < 100
    for (i, w), o, (found, scores) in zip(asked, own, got):
        expected = one(i, w, o)
        assert found == expected[0]
        assert scores == pytest.approx(expected[1], abs=1e-12)


@pytest.mark.parametrize("limit", [10**9, 0])
def test_long_messages_find_what_they_find_alone(spark, limit, monkeypatch):
    kb = _texts(400, 11, 12)
    index = ReplyIndex.build(_replies(spark, kb), max_broadcast=limit)
    asked = spark.createDataFrame(list(enumerate([*_texts(30, 12, 60), *kb[:30], "", "qq"])), "id long, t string")
    found = lambda: {r.id: [(e.kb_id, round(e.score, 9)) for e in r.exemplars] for r in add_exemplars(asked, "t", index, 3, own="id").collect()}
    many = found()
    monkeypatch.setattr(retrieve, "TOGETHER", 0)  # none
    assert many == found() and sum(map(len, many.values())) > 150
