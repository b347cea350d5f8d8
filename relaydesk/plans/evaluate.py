"""Evaluation of triage variants on labelled cases, and their comparison.

Cases carry (case key, customer_tweet, true_intent, true_escalate,
gold_reference_reply). Triage keeps those columns, so truth and prediction
stay in one row and nothing has to be joined back.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.functions.overlap import SCORES, add_overlap_scores
from relaydesk.functions.text import ratio
from relaydesk.operators.agreement import agreement
from relaydesk.operators.metrics import label_scores, label_sums, macro_scores
from relaydesk.operators.rubric import STARS, add_rubric, star_counts
from relaydesk.packs.pack import Pack
from relaydesk.plans.triage import System, triage

MODES = ("trivial", "simple", "proposed")
HEADLINE = ("macro_f1", "f1", "false_auto_handle_rate_FAHR", "mean_rougeL", "mean_composite_score")


def scored_predictions(cases: DataFrame, system: System, name: str, own: str | None = None) -> DataFrame:
    """One row per case: truth, prediction, overlap scores and rubric scores under ``system`` = name."""
    predicted = triage(cases, system, "customer_tweet", own)
    with_overlap = add_overlap_scores(predicted, "reply", "gold_reference_reply")
    flat = with_overlap.withColumns({"pred_escalate": F.col("escalation.escalate"), "system": F.lit(name)})
    return add_rubric(
        flat, "customer_tweet", "reply", "gold_reference_reply", "true_escalate", "pred_escalate", "true_intent"
    )


def _facts(scored: DataFrame) -> DataFrame:
    """All that the metrics need, per (system, truth, prediction): the only pass over the cases."""
    t, p = F.col("true_escalate"), F.col("pred_escalate")
    score = F.col("composite_score")
    return scored.groupBy("system", F.col("true_intent").alias("true_label"), F.col("intent").alias("pred_label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(t & p).alias("tp"),
        F.count_if(~t & p).alias("fp"),
        F.count_if(t & ~p).alias("fn"),
        F.count_if(~t & ~p).alias("tn"),
        *[F.sum(m).alias(m) for m in SCORES],
        F.sum(score).alias("composite"),
        F.sum(score * score).alias("composite2"),
        *star_counts(score),
    )


def metric_table(scored: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Long table (system, metric, label, value) of all metrics; ``label`` is '' for scalars."""
    stars = [name for name, _ in STARS]
    sums = ("tp", "fp", "fn", "tn", *SCORES, "composite", "composite2", *stars)
    wide = _facts(scored).groupBy("system").agg(*label_sums(labels), *[F.sum(c).alias(c) for c in sums])
    n, tp, fp, fn, tn = (F.col(c) for c in ("rows", "tp", "fp", "fn", "tn"))
    macro = macro_scores(labels)
    average = F.col("composite") / n
    scalars = {
        "intent_accuracy": macro.pop("accuracy"),
        **macro,
        "escalation_accuracy": ratio(tp + tn, n),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
        "true_positives": tp,
        "false_positives": fp,
        "false_negatives": fn,
        "true_negatives": tn,
        "false_auto_handle_rate_FAHR": ratio(fn, fn + tp),
        "false_escalation_rate_FER": ratio(fp, fp + tn),
        **{f"mean_{m}": F.col(m) / n for m in SCORES},
        "mean_composite_score": average,
        # scores lie in 1..5, so the difference of squares loses nothing that matters
        "std_composite_score": F.sqrt(F.greatest(F.col("composite2") / n - average * average, F.lit(0.0))),
        **{name: F.col(name) for name in stars},
    }

    def entry(metric: str, label: str, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"), F.lit(label).alias("label"), value.cast("double").alias("value")
        )

    entries = [entry(name, "", value) for name, value in scalars.items()]
    for i, x in enumerate(labels):
        entries += [entry(f"class_{name}", x, value) for name, value in label_scores(i).items()]
    return wide.select("system", F.inline(F.array(*entries)))


def compare_systems(scored: Sequence[DataFrame], labels: Sequence[str]) -> DataFrame:
    """One row per system with the five headline metrics."""
    table = metric_table(reduce(DataFrame.unionByName, scored), labels)
    return (
        table.where((F.col("label") == "") & F.col("metric").isin(*HEADLINE))
        .groupBy("system")
        .pivot("metric", list(HEADLINE))
        .agg(F.first("value"))
    )


def benchmark(
    cases: DataFrame,
    replies: DataFrame | None,
    pack: Pack,
    key: str = "id",
    reply_key: str = "conv_id",
    own: str | None = None,
    fit: Sequence[str] = MODES,
) -> list[DataFrame]:
    """Scored predictions of every variant on the same cases; ``fit`` names the variants that learn from them."""
    scored, model = [], None
    for mode in MODES:
        system = System.create(mode, pack, replies, reply_key)
        if mode in fit:
            # the variants that use the regression share it
            system = replace(system, model=model) if model else system.fit(cases, "customer_tweet", "true_intent", key)
            model = system.model
        scored.append(scored_predictions(cases, system, mode, own))
    return scored


def calibration_study(
    rated: DataFrame, message: str, reply: str, gold: str, true_escalate: str, pred_escalate: str, intent: str, rating: str
) -> DataFrame:
    """Agreement of the rubric with given ratings of the same replies."""
    scored = add_rubric(rated, message, reply, gold, true_escalate, pred_escalate, intent)
    return agreement(scored, F.col(rating), F.col("composite_score"))
