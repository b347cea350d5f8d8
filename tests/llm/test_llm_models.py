"""Toxicity grammar and quality field: rules, brute force and held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from relaydesk.llm import quality, toxicity
from relaydesk.llm.common import held_out, labelled_sample

FOLDER = "/root/testdata/sf0.1"


def test_machine_is_the_parts_in_turn():
    parts = [toxicity.negation(), toxicity.reported_speech(), toxicity.target(), toxicity.threat()]
    following, outputs = toxicity.compose(parts)
    for word in itertools.product(range(8), repeat=4):
        state, states = 0, [0] * len(parts)
        for symbol in word:
            passed = symbol
            for i, part in enumerate(parts):
                states[i], passed = part.step(states[i], passed)
            assert outputs[state][symbol] == passed
            state = following[state][symbol]


def symbols(text):
    return [s for s, _ in toxicity.Matcher(toxicity.Grammar()).matches(text)]


def test_clauses():
    assert symbols("A calm day.") == []
    assert symbols("what an idiot") == [toxicity.INSULT]
    assert symbols("you utter idiot") == [toxicity.DIRECTED]
    assert symbols("idiot you") == [toxicity.INSULT, toxicity.DIRECTED]
    assert symbols("he is not an idiot") == [toxicity.NEGATED]
    assert symbols("it was not so. what an idiot") == [toxicity.INSULT]  # a clause ends the scope
    assert symbols("the paper wrote idiot") == [toxicity.QUOTED]
    assert symbols("I will kill it") == [toxicity.THREAT]
    assert symbols("I will not kill it") == [toxicity.DENIED_HARM]
    assert symbols("they said we kill") == [toxicity.QUOTED_HARM]
    score = toxicity.Matcher(toxicity.Grammar()).score
    assert score("you idiot") > score("an idiot") > score("not an idiot") > score("fine") == score("")


def test_kinds_of_insults():
    assert symbols("this is a stupid plan") == [toxicity.STATED]
    assert symbols("what a stupid worthless plan") == [toxicity.INSULT, toxicity.STATED]
    assert symbols("all calm. Idiot!") == [toxicity.INSULT, toxicity.ADDRESSED]
    assert symbols("idiot") == symbols("idiot.") == [toxicity.INSULT, toxicity.ADDRESSED]
    assert symbols("this is not stupid") == [toxicity.NEGATED]
    clauses = toxicity.Matcher(toxicity.Grammar()).clauses
    assert [s for s, _ in clauses("scum, idiot you. Fine. What an idiot")] == [toxicity.DIRECTED, toxicity.INSULT]


def test_score_is_that_of_the_parts_one_after_the_other():
    draw = np.random.default_rng(8)
    grammar = toxicity.Grammar(words={"idiot": 0.9, "scum": 0.4}, stems={"mor": 0.7}, base=0.01)
    matcher = toxicity.Matcher(grammar)
    words = "idiot scum morons kill will you not said is a day .".split()
    kind = dict(zip(words, [2, 2, 2, 3, 4, 5, 6, 7, 8, 0, 0, 1]))
    lexicon = {"idiot": 0.9, "scum": 0.4, "morons": 0.7, "kill": 1.0}
    parts = [toxicity.negation(), toxicity.reported_speech(), toxicity.target(), toxicity.threat(), toxicity.insult()]
    seen = set()
    for _ in range(2000):
        text = draw.choice(words, size=draw.integers(0, 14)).tolist()
        read = [kind[w] for w in text] + [toxicity.END]
        for part in parts:
            state, out = 0, []
            for symbol in read:
                state, passed = part.step(state, symbol)
                out.append(passed)
            read = out
        left, best, own = 0.99, 0.0, 0.0
        for i, symbol in enumerate(read):
            word = text[i] if i < len(text) else "."
            own = lexicon.get(word, own)  # of the last insult or harm
            best = max(best, toxicity.PRIOR.get(symbol, 0.0) * own)
            seen.add(symbol)
            if word == ".":
                left, best = left * (1 - best), 0.0
        assert np.isclose(matcher.score(" ".join(text)), 1 - left)
    assert seen == set(range(toxicity.SYMBOLS))


def test_scores_of_odd_rows(spark):
    rows = [(1, None, 9.0), (2, "", 9.0), (3, "you idiot", 9.0), (3, "you idiot", 9.0), (None, "fine " * 50_000, 9.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    out = toxicity.score_documents(docs, toxicity.Grammar()).collect()
    assert [r.predicted for r in out] == [0, 0, 1, 1, 0] and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score_documents(docs.limit(0), toxicity.Grammar()).count() == 0


def labelled(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    return read("documents"), read("labels")


def test_sample_is_bounded_and_leaves_held_out_rows_alone(spark):
    docs, labels = labelled(spark)
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None)], labels.schema)
    sample = labelled_sample(docs, labels.unionByName(odd), "toxic", 50)
    assert {r["_label"]: r["count"] for r in sample.groupBy("_label").count().collect()} == {0: 50, 1: 50}
    assert sample.where(held_out(F.col("doc_id"))).count() == 0


def test_toxic_documents_are_found_and_clean_ones_left_alone(spark):
    docs, labels = labelled(spark)
    grammar = toxicity.fit(docs, labels)
    judged = toxicity.score_documents(docs.join(labels, "doc_id").where(held_out(F.col("doc_id"))), grammar)
    n = {(r.toxic, r.predicted): r["count"] for r in judged.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] / (n[1, 1] + n[1, 0]) > 0.85
    assert n.get((0, 1), 0) / n[0, 0] < 0.02


def test_without_labels_the_given_words_stand(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(docs, none) == toxicity.Grammar()
    assert quality.fit(docs, none) is None
    assert quality.score_documents(docs, None).first().score == 0.5


def test_marginals_equal_a_sum_over_all_labellings():
    draw = np.random.default_rng(2)
    counts = np.array([3, 1, 4, 2])
    good, pairs = draw.normal(size=counts.sum()), draw.normal(size=(2, 2))
    share, both, z = quality.marginals(good, pairs, counts)
    at, expected_both = 0, np.zeros((2, 2))
    for d, n in enumerate(counts):
        own, total, seen = good[at : at + n], 0.0, np.zeros(n)
        steps = np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=int(n)):
            weight = np.exp(own @ labels + sum(pairs[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            seen += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                steps[a, b] += weight
        assert np.allclose(share[at : at + n], seen / total) and np.isclose(z[d], np.log(total))
        expected_both += steps / total
        at += n
    assert np.allclose(both, expected_both)


def test_gradient_is_that_of_the_objective():
    draw = np.random.default_rng(5)
    counts, labels = np.array([3, 1, 4, 2, 6]), np.array([1, 0, 0, 1, 1])
    x, theta, by_document = draw.normal(size=(counts.sum(), 5)), draw.normal(size=9), draw.uniform(0.1, 2, 5)
    value, slope = quality.objective(theta, x, counts, labels, by_document, 0.1)
    expected = -0.05 * theta @ theta
    for d, (n, end) in enumerate(zip(counts, np.cumsum(counts))):
        good, pairs = x[end - n : end] @ theta[:5], theta[5:].reshape(2, 2)
        scores = {
            ls: good @ ls + sum(pairs[a, b] for a, b in zip(ls, ls[1:])) for ls in itertools.product((0, 1), repeat=int(n))
        }
        expected += by_document[d] * (scores[(int(labels[d]),) * n] - np.log(np.exp(list(scores.values())).sum()))
    assert np.isclose(value, expected)
    for i, step in enumerate(np.eye(9) * 1e-5):
        up, down = (quality.objective(theta + s, x, counts, labels, by_document, 0.1)[0] for s in (step, -step))
        assert np.isclose(slope[i], (up - down) / 2e-5, rtol=1e-5, atol=1e-7)


def test_score_is_the_mean_of_enumerated_marginals(spark):
    draw = np.random.default_rng(6)
    size = 1 + 3 * quality.FEATURES
    field = quality.Field(
        draw.normal(size=quality.FEATURES), draw.uniform(0.5, 2, quality.FEATURES), draw.normal(size=size), draw.normal(size=(2, 2))
    )
    texts = ["One line.", "a b\n\nC 1!!\nlast line here", "", "\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in quality.score_documents(docs, field).collect()}
    for i, t in enumerate(texts):
        features, length, counts = quality.LineReader().read([t])
        good = field.potentials(features, counts)
        seen, total = np.zeros(len(good)), 0.0
        for ls in itertools.product((0, 1), repeat=len(good)):
            weight = np.exp(good @ ls + sum(field.pairs[a, b] for a, b in zip(ls, ls[1:])))
            seen, total = seen + weight * np.array(ls), total + weight
        assert np.isclose(got[i], np.average(seen / total, weights=length + 1e-9))


def test_training_takes_whole_documents_that_fit_in(spark, monkeypatch):
    rows = [(i, "x y\n" * (i - 1) + "end", i % 2) for i in range(1, 40)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality int")
    taken = {}
    monkeypatch.setattr(quality, "train", lambda features, counts, truth: taken.update(counts=counts, truth=truth))
    quality.fit(docs, labels, lines=100)
    learned = [n for n in range(1, 40) if zlib.crc32(str(n).encode()) % 5]
    expected = [n for i, n in enumerate(learned) if sum(learned[: i + 1]) <= 100]
    assert sorted(taken["counts"].tolist()) == expected
    assert (taken["truth"] == taken["counts"] % 2).all()


def test_line_features_do_not_depend_on_the_batch():
    reader = quality.LineReader()
    texts = ["a b a\n\nB! B! 12", "", "x\ny", "Ünï | codé ###\n"]
    whole, length, counts = reader.read(texts)
    alone = [reader.read([t])[0] for t in texts]
    assert counts.tolist() == [3, 1, 2, 2] and length.tolist() == [5, 0, 8, 0, 1, 1, 14, 0]
    assert np.allclose(whole, np.concatenate(alone))
    distinct, repeated = 11, 12
    assert np.isclose(whole[0, distinct], 2 / 3) and np.isclose(whole[2, repeated], 1 / 3)


def test_quality_of_held_out_documents(spark):
    docs, labels = labelled(spark)
    field = quality.fit(docs, labels)
    judged = quality.score_documents(docs.join(labels, "doc_id").where(held_out(F.col("doc_id"))), field)
    n = {(r.quality, r.predicted): r["count"] for r in judged.groupBy("quality", "predicted").count().collect()}
    assert n[0, 0] / (n[0, 0] + n.get((0, 1), 0)) > 0.95
    assert n.get((1, 0), 0) / n[1, 1] < 0.01
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (2, "", "x"), (3, "a\n" * 3000, "x")], "doc_id long, text string, line_scores string")
    out = quality.score_documents(odd, field).collect()
    assert len(out[0].line_scores) == 1 and len(out[3].line_scores) == 3001
    assert out[0].score == out[1].score == out[2].score and all(0 <= r.score <= 1 for r in out)
    assert quality.score_documents(odd.limit(0), field).count() == 0


@pytest.mark.parametrize("name", ["op1_toxicity", "op7_quality"])
def test_queries_score_every_document(spark, name):
    from relaydesk.llm.queries import REGISTRY

    out = REGISTRY[name](spark, "/root/testdata/sf0.001").toPandas()
    assert len(out) == 200 and out.doc_id.is_unique and out.score.between(0, 1).all()
