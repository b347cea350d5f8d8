import pytest
from pyspark.sql import functions as F

from relaydesk.operators import metrics

LABELS = ["a", "b", "c", "d", "e", "f", "g"]
# published counts of a seven-label run
MATRIX = [
    [30, 0, 0, 0, 0, 0, 0],
    [1, 27, 1, 0, 0, 0, 1],
    [0, 0, 22, 0, 1, 0, 5],
    [0, 1, 0, 27, 0, 0, 0],
    [0, 0, 3, 0, 23, 1, 1],
    [1, 0, 0, 0, 0, 26, 1],
    [0, 2, 2, 0, 0, 0, 24],
]


def _expand(spark, rows, schema):
    counted = spark.createDataFrame(rows, f"{schema}, n int").where("n > 0")
    return counted.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("copy")).drop("n", "copy")


@pytest.fixture(scope="module")
def cases(spark):
    rows = [(LABELS[i], LABELS[j], n) for i, row in enumerate(MATRIX) for j, n in enumerate(row)]
    return _expand(spark, rows, "t string, p string")


def test_published_intent_metrics(cases):
    got = metrics.macro_report(cases, "t", "p", LABELS).first()
    assert got.accuracy == pytest.approx(0.895)
    assert got.macro_precision == pytest.approx(0.8992157974300831)
    assert got.macro_recall == pytest.approx(0.8938775510204081)
    assert got.macro_f1 == pytest.approx(0.8950491904408954)
    per = {r.label: r for r in metrics.class_report(cases, "t", "p", LABELS).collect()}
    assert (per["b"].precision, per["b"].recall, per["b"].support) == (pytest.approx(0.9), pytest.approx(0.9), 30)
    assert per["g"].f1 == pytest.approx(0.8)
    matrix = {(r.true_label, r.pred_label): r.n for r in metrics.confusion_matrix(cases, "t", "p", LABELS).collect()}
    assert [[matrix[a, b] for b in LABELS] for a in LABELS] == MATRIX


def test_published_escalation_metrics(spark):
    rows = [(True, True, 33), (False, True, 9), (True, False, 25), (False, False, 133)]
    got = metrics.escalation_report(_expand(spark, rows, "t boolean, p boolean"), "t", "p").first()
    assert (got.true_positives, got.false_positives, got.false_negatives, got.true_negatives) == (33, 9, 25, 133)
    assert got.accuracy == pytest.approx(0.83)
    assert got.precision == pytest.approx(0.7857142857142857)
    assert got.recall == pytest.approx(0.5689655172413793)
    assert got.f1 == pytest.approx(0.66)
    assert got.false_auto_handle_rate_FAHR == pytest.approx(0.43103448275862066)
    assert got.false_escalation_rate_FER == pytest.approx(0.06338028169014084)


def test_small_cases(spark):
    two = spark.createDataFrame([("a", "a"), ("b", "g")], "t string, p string")
    assert metrics.macro_report(two, "t", "p", LABELS).first().accuracy == 0.5
    three = spark.createDataFrame([(True, True), (False, False), (True, False)], "t boolean, p boolean")
    got = metrics.escalation_report(three, "t", "p").first()
    assert (got.true_positives, got.false_negatives, got.false_auto_handle_rate_FAHR) == (1, 1, 0.5)
    for empty_side in (True, False):
        one = spark.createDataFrame([(empty_side, empty_side)], "t boolean, p boolean")
        got = metrics.escalation_report(one, "t", "p").first()
        assert got.false_auto_handle_rate_FAHR == 0.0 and got.false_escalation_rate_FER == 0.0


def test_absent_and_unlisted_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "zz"), ("zz", "a")], "t string, p string")
    per = {r.label: r for r in metrics.class_report(df, "t", "p", ["a", "b"]).collect()}
    assert (per["a"].precision, per["a"].recall, per["a"].support) == (0.5, 0.5, 2)
    assert (per["b"].precision, per["b"].recall, per["b"].f1, per["b"].support) == (0.0, 0.0, 0.0, 0)
    matrix = {(r.true_label, r.pred_label): r.n for r in metrics.confusion_matrix(df, "t", "p", ["a", "b"]).collect()}
    assert matrix == {("a", "a"): 1, ("a", "b"): 0, ("b", "a"): 0, ("b", "b"): 0}


def test_grouped_report_equals_single_reports(spark, cases):
    both = cases.withColumn("system", F.lit("x")).unionByName(
        cases.select("t", F.col("t").alias("p"), F.lit("y").alias("system"))
    )
    got = {r.system: r for r in metrics.macro_report(both, "t", "p", LABELS, by=["system"]).collect()}
    assert got["x"].macro_f1 == pytest.approx(0.8950491904408954)
    assert (got["y"].accuracy, got["y"].macro_f1) == (1.0, 1.0)
    per = metrics.class_report(both, "t", "p", LABELS, by=["system"])
    assert per.count() == 14


def test_counts_and_size_check(spark):
    df = spark.createDataFrame([("x", True), ("x", True), ("y", True)], "intent string, escalate boolean")
    got = {(r.dimension, r.value): r.n for r in metrics.case_counts(df, intent=None, escalate=("true", "false")).collect()}
    assert got == {("intent", "x"): 2, ("intent", "y"): 1, ("escalate", "true"): 3, ("escalate", "false"): 0}
    assert metrics.count_violation(df, 3).isEmpty()
    assert tuple(metrics.count_violation(df, 200).first()) == (3, 200)
