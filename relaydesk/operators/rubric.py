"""Five-part rubric score of a reply, row-local."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.functions.text import tokens

# Markers, weights and limits that define the score.
TONE_MARKERS = ("help", "sorry", "glad", "here to help", "dm us", "understand", "safety")
ACTION_MARKERS = ("settings >", "tap", "restart", "press", "support.apple.com", "iforgot", "visit", "go to")
HANDOFF_MARKERS = ("dm us", "support.apple.com")
MISSED_HAZARD_MARKERS = ("bulg", "spark")
CHARGE_HAZARD_MARKERS = ("bulg", "swollen")
WEIGHTS = {
    "correctness_and_grounding": 0.30,
    "brand_tone_empathy": 0.20,
    "clarity_actionability": 0.20,
    "escalation_appropriateness": 0.20,
    "safety_conciseness": 0.10,
}
MAX_CHARS = 350
FEEDBACK = "Grounded response evaluated for %s. Escalation match: %s."
STARS = (("5_stars", 4.5), ("4_stars", 3.5), ("3_stars", 2.5), ("2_stars", 1.5), ("1_star", None))


def _any(text: Column, markers: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(m) for m in markers])


def _count(text: Column, markers: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a + b, [text.contains(m).cast("int") for m in markers])


def _steps(value: Column, *steps: tuple[float, float], otherwise: float | Column) -> Column:
    """Score of the first limit that ``value`` reaches."""
    arms = [F.when(value >= limit, F.lit(float(score))) for limit, score in steps]
    last = otherwise if isinstance(otherwise, Column) else F.lit(float(otherwise))
    return F.coalesce(*arms, last)


def add_rubric(
    df: DataFrame, message: str, reply: str, gold: str, true_escalate: str, pred_escalate: str, intent: str
) -> DataFrame:
    """Append the five scores, ``composite_score`` and ``feedback``."""
    said, out = F.lower(F.col(message)), F.lower(F.col(reply))
    truth, guess = F.col(true_escalate), F.col(pred_escalate)
    prepared = df.withColumns(
        {
            "_gold": F.array_distinct(tokens(F.col(gold), 4)),
            "_out": F.array_distinct(tokens(F.col(reply), 4)),
            "_tone": _count(out, TONE_MARKERS),
            "_action": _count(out, ACTION_MARKERS),
        }
    )
    share = F.size(F.array_intersect("_gold", "_out")) / F.greatest(F.size("_gold"), F.lit(1))
    handoff = F.when(_any(out, HANDOFF_MARKERS), F.lit(3.0)).otherwise(F.lit(2.0))
    missed = F.when(_any(said, MISSED_HAZARD_MARKERS), F.lit(1.0)).otherwise(F.lit(2.0))
    rice = out.contains("rice") & said.contains("rice") & ~out.contains("don't") & ~out.contains("cannot")
    charge = out.contains("charge") & _any(said, CHARGE_HAZARD_MARKERS)
    scored = prepared.withColumns(
        {
            "correctness_and_grounding": _steps(share, (0.40, 5), (0.25, 4), (0.12, 3), otherwise=handoff),
            "brand_tone_empathy": _steps(F.col("_tone"), (3, 5), (1, 4), otherwise=3),
            "clarity_actionability": F.when(
                (F.col("_action") >= 2) | (guess & out.contains("dm us")), F.lit(5.0)
            ).otherwise(_steps(F.col("_action"), (1, 4), otherwise=3)),
            "escalation_appropriateness": F.when(truth == guess, F.lit(5.0)).when(truth, missed).otherwise(F.lit(3.0)),
            "safety_conciseness": F.when(rice | charge, F.lit(1.0))
            .when(F.length(reply) > MAX_CHARS, F.lit(4.0))
            .otherwise(F.lit(5.0)),
        }
    )
    total = reduce(lambda a, b: a + b, [F.lit(w) * F.col(name) for name, w in WEIGHTS.items()])
    return scored.withColumns(
        {
            "composite_score": F.round(total, 2),
            "feedback": F.format_string(
                FEEDBACK,
                F.col(intent),
                F.initcap((truth == guess).cast("string")),
            ),
        }
    ).drop("_gold", "_out", "_tone", "_action")


def star_counts(score: Column) -> list[Column]:
    """One aggregate per star bucket, closed on the left."""
    above = None
    stars = []
    for name, limit in STARS:
        inside = F.lit(True) if limit is None else score >= limit
        stars.append(F.count_if(inside if above is None else inside & (score < above)).alias(name))
        above = limit
    return stars


def rubric_summary(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean, population deviation and the five star counts, per ``by`` group or overall."""
    score = F.col("composite_score")
    return scored.groupBy(*by).agg(
        F.avg(score).alias("mean_composite_score"), F.stddev_pop(score).alias("std_composite_score"), *star_counts(score)
    )
