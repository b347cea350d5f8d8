"""Classification and escalation metrics.

Every metric is arithmetic on one small count table, so the rows are read once
and combined before the shuffle. ``by`` adds grouping columns such as ``system``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.functions.text import ratio


def label_counts(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """(by.., true_label, pred_label, n): the only pass over the rows."""
    return df.groupBy(*by, F.col(truth).alias("true_label"), F.col(guess).alias("pred_label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, truth: str, guess: str, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Dense (by.., true_label, pred_label, n); labels outside the list are left out."""
    listed = F.col("true_label").isin(*labels) & F.col("pred_label").isin(*labels)
    cells = F.collect_list(F.when(listed, F.struct("true_label", "pred_label", "n")))  # labels squared at most
    names = F.array(*[F.lit(x) for x in labels])
    grid = F.flatten(
        F.transform(names, lambda t: F.transform(names, lambda p: F.struct(t.alias("true_label"), p.alias("pred_label"))))
    )
    filled = F.transform(
        grid,
        lambda g: F.struct(
            g["true_label"].alias("true_label"),
            g["pred_label"].alias("pred_label"),
            F.aggregate(
                F.col("cells"),
                F.lit(0).cast("long"),
                lambda total, c: total
                + F.when((c["true_label"] == g["true_label"]) & (c["pred_label"] == g["pred_label"]), c["n"]).otherwise(
                    F.lit(0)
                ),
            ).alias("n"),
        ),
    )
    return label_counts(df, truth, guess, by).groupBy(*by).agg(cells.alias("cells")).select(*by, F.inline(filled))


def label_sums(labels: Sequence[str]) -> list[Column]:
    """Aggregates over (true_label, pred_label, n): rows, hits, and per label number hit, true and predicted.

    A row outside the label list still counts as an error of the label on its other side.
    """
    t, p, n = F.col("true_label"), F.col("pred_label"), F.col("n")

    def where(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, n)), F.lit(0))

    sums = [F.coalesce(F.sum(n), F.lit(0)).alias("rows"), where(t == p).alias("right")]
    for i, x in enumerate(labels):
        sums += [
            where((t == x) & (p == x)).alias(f"hit{i}"),
            where(t == x).alias(f"support{i}"),
            where(p == x).alias(f"predicted{i}"),
        ]
    return sums


def label_scores(i: int) -> dict[str, Column]:
    """Scores of label number ``i`` over the columns of ``label_sums``; an empty base gives 0."""
    hit, support, predicted = F.col(f"hit{i}"), F.col(f"support{i}"), F.col(f"predicted{i}")
    return {
        "precision": ratio(hit, predicted),
        "recall": ratio(hit, support),
        "f1": ratio(2 * hit, support + predicted),
        "support": support,
    }


def macro_scores(labels: Sequence[str]) -> dict[str, Column]:
    """Accuracy and plain means over the label list, over the columns of ``label_sums``."""

    def mean(name: str) -> Column:
        return reduce(lambda a, b: a + b, [label_scores(i)[name] for i in range(len(labels))]) / len(labels)

    return {
        "accuracy": ratio(F.col("right"), F.col("rows")),
        "macro_precision": mean("precision"),
        "macro_recall": mean("recall"),
        "macro_f1": mean("f1"),
    }


def class_report(df: DataFrame, truth: str, guess: str, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., label, precision, recall, f1, support) for every listed label."""
    sums = label_counts(df, truth, guess, by).groupBy(*by).agg(*label_sums(labels))
    rows = [
        F.struct(F.lit(x).alias("label"), *[c.alias(name) for name, c in label_scores(i).items()])
        for i, x in enumerate(labels)
    ]
    return sums.select(*by, F.inline(F.array(*rows)))


def macro_report(df: DataFrame, truth: str, guess: str, labels: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., accuracy, macro_precision, macro_recall, macro_f1)."""
    sums = label_counts(df, truth, guess, by).groupBy(*by).agg(*label_sums(labels))
    return sums.select(*by, *[c.alias(name) for name, c in macro_scores(labels).items()])


def escalation_report(df: DataFrame, truth: str, guess: str, by: Sequence[str] = ()) -> DataFrame:
    """Binary counts and rates; the positive class is an escalated message."""
    t, p = F.col(truth), F.col(guess)
    counts = df.groupBy(*by).agg(
        F.count_if(t & p).alias("true_positives"),
        F.count_if(~t & p).alias("false_positives"),
        F.count_if(t & ~p).alias("false_negatives"),
        F.count_if(~t & ~p).alias("true_negatives"),
    )
    tp, fp = F.col("true_positives"), F.col("false_positives")
    fn, tn = F.col("false_negatives"), F.col("true_negatives")
    return counts.select(
        *by,
        ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "true_positives",
        "false_positives",
        "false_negatives",
        "true_negatives",
        ratio(fn, fn + tp).alias("false_auto_handle_rate_FAHR"),
        ratio(fp, fp + tn).alias("false_escalation_rate_FER"),
    )


def case_counts(df: DataFrame, **domains: Sequence[str] | None) -> DataFrame:
    """(dimension, value, n) for several columns in one pass; values of a given domain are always present."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in domains])
    )
    counts = df.select(pairs.alias("x")).groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))
    wanted = [(c, v) for c, values in domains.items() for v in values or ()]
    if not wanted:
        return counts
    zeros = df.sparkSession.createDataFrame([(c, v, 0) for c, v in wanted], "dimension string, value string, n long")
    return counts.unionByName(zeros).groupBy("dimension", "value").agg(F.sum("n").alias("n"))


def count_violation(df: DataFrame, expected: int | Column) -> DataFrame:
    """One row (n, expected) if the number of rows differs from ``expected``, none otherwise."""
    wanted = F.lit(expected) if isinstance(expected, int) else expected
    return df.agg(F.count(F.lit(1)).alias("n")).withColumn("expected", wanted).where(F.col("n") != F.col("expected"))
