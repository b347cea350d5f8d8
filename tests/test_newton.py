"""Newton's method for the regression, against differences of the objective and a dense solution."""

import random

import numpy as np
import pyarrow as pa
import pytest

from relaydesk.operators import newton
from relaydesk.operators.logistic import IntentModel

CLASSES, FEATURES = 3, 7


def drawn(n, seed=0):
    draw = np.random.default_rng(seed)
    out = []
    for i in range(n):
        idx = sorted(draw.choice(FEATURES, draw.integers(0, 5), replace=False).tolist())
        out.append((idx, draw.random(len(idx)).tolist(), int(draw.integers(0, CLASSES)), float(draw.random() + 0.5)))
    return out


def batch(rows):
    idx, w, label, weight = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(idx, pa.list_(pa.int32())), pa.array(w, pa.list_(pa.float64())), pa.array(label, pa.int32()), pa.array(weight)],
        ["idx", "w", "label", "weight"],
    )


def objective(rows, matrix):
    """The stated loss by plain loops."""
    total = 0.0
    for idx, w, label, weight in rows:
        z = [line[-1] + sum(line[i] * v for i, v in zip(idx, w)) for line in matrix]
        total += weight * (np.log(sum(np.exp(z))) - z[label])
    return total


def test_gradient_is_that_of_the_objective():
    rows = drawn(40)
    x = np.random.default_rng(1).normal(size=(CLASSES, FEATURES + 1))
    found = newton.loss_and_gradient(newton.Rows(batch(rows)), x)
    assert found[0] == pytest.approx(objective(rows, x), rel=1e-12)
    for c in range(CLASSES):
        for t in range(FEATURES + 1):
            d = np.zeros_like(x)
            d[c, t] = 1e-6
            slope = (objective(rows, x + d) - objective(rows, x - d)) / 2e-6
            assert found[1:].reshape(x.shape)[c, t] == pytest.approx(slope, abs=1e-6)


def test_product_is_that_of_the_symmetric_hessian():
    rows = newton.Rows(batch(drawn(40)))
    draw = np.random.default_rng(2)
    x, a, b = (draw.normal(size=(CLASSES, FEATURES + 1)) for _ in range(3))
    slope = (newton.loss_and_gradient(rows, x + 1e-6 * a)[1:] - newton.loss_and_gradient(rows, x - 1e-6 * a)[1:]) / 2e-6
    ha, hb = newton.hessian_product(rows, x, a), newton.hessian_product(rows, x, b)
    assert np.abs(ha - slope).max() < 1e-6
    assert hb @ a.ravel() == pytest.approx(ha @ b.ravel(), rel=1e-12)
    assert ha @ a.ravel() > 0


def test_blocks_are_those_of_the_hessian(monkeypatch):
    monkeypatch.setattr(newton, "ROWS_AT_ONCE", 16)
    rows = newton.Rows(batch(drawn(40)))
    draw = np.random.default_rng(2)
    x, a = (draw.normal(size=(CLASSES, FEATURES + 1)) for _ in range(2))
    blocks = newton.hessian(rows, x).reshape(-1, FEATURES + 1, FEATURES + 1)
    found = np.zeros_like(x)
    for block, (c, d) in zip(blocks, newton._class_pairs(CLASSES)):
        found[c] += block @ a[d]
        if c != d:
            found[d] += block.T @ a[c]
    assert np.abs(found.ravel() - newton.hessian_product(rows, x, a)).max() < 1e-12


def test_few_features_take_few_passes(spark, monkeypatch):
    # little penalty and correlated features: conjugate gradients take many steps
    rows = [(list(range(FEATURES)), [1.0 + 0.01 * v for v in range(FEATURES)], c, w) for _, _, c, w in drawn(200)]
    rows += drawn(200, seed=5)
    table = spark.createDataFrame(rows, "idx array<int>, w array<double>, label int, weight double").repartition(9)
    passes, added = [], newton._added
    monkeypatch.setattr(newton, "_added", lambda *a: passes.append(1) or added(*a))
    few = newton.fit(table, CLASSES, FEATURES, 1e-4)
    n = len(passes)
    monkeypatch.setattr(newton, "MAX_HESSIAN", 0)
    many = newton.fit(table, CLASSES, FEATURES, 1e-4)
    assert n <= 24 and n < (len(passes) - n) / 2
    assert np.abs(few - many).max() < 1e-4


@pytest.mark.parametrize("flat", [64, 2])  # sums of tasks added by the driver, or in groups before
def test_fit_ends_where_the_gradient_is_nothing(spark, monkeypatch, flat):
    monkeypatch.setattr(newton, "FLAT", flat)
    rows = drawn(60)
    table = spark.createDataFrame(rows, "idx array<int>, w array<double>, label int, weight double").repartition(9)
    x = newton.fit(table, CLASSES, FEATURES, 0.5)
    ridge = np.full(x.shape, 0.5)
    ridge[:, -1] = 0
    gradient = newton.loss_and_gradient(newton.Rows(batch(rows)), x)[1:].reshape(x.shape) + ridge * x
    assert np.abs(gradient).max() < 1e-8


def test_how_rows_are_dealt_does_not_matter(spark):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("alpha beta gamma delta epsilon".split()) for _ in range(6)), draw.choice("xyz")) for i in range(90)]
    rows += [(90, None, "x"), (91, "", "y"), (92, "unlabelled text", None)]
    frame = spark.createDataFrame(rows, "id long, t string, label string")
    first, second = (IntentModel.fit(frame.repartition(n), "t", "label") for n in (1, 7))
    assert first.classes == second.classes == ("x", "y", "z")
    assert np.abs(np.array(first.weights) - np.array(second.weights)).max() < 1e-8
    assert np.ptp(np.array(first.weights).sum(0)) < 1e-8  # the penalty leaves no shift common to all classes


def test_one_class_or_one_row(spark):
    one = IntentModel.fit(spark.createDataFrame([(1, "some words", "x")], "id long, t string, label string"), "t", "label")
    assert one.classes == ("x",)
    frame = spark.createDataFrame([(2, "other words")], "id long, t string")
    assert one.probabilities(frame, "t", ("x", "y"), "p").first().p == [1.0, 0.0]


def test_rows_without_a_feature_are_the_intercept():
    rows = [([], [], 0, 1.0), ([2, 5], [0.5, 2.0], 1, 1.0), ([], [], 2, 1.0), ([], [], 1, 1.0), ([0], [3.0], 1, 1.0), ([], [], 0, 1.0)]
    matrix = np.random.default_rng(4).normal(size=(CLASSES, FEATURES + 1))
    expected = [[line[-1] + sum(line[i] * v for i, v in zip(idx, w)) for line in matrix] for idx, w, _, _ in rows]
    for some in (rows, rows[:1], rows[2:4], rows[1:2]):
        found = newton.Rows(batch(some)).times(matrix)
        assert np.abs(found - [expected[rows.index(r)] for r in some]).max() < 1e-12
