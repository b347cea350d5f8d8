"""Most frequent label as a baseline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def majority_label(df: DataFrame, label: str, order: str) -> DataFrame:
    """One row (label, n): the most frequent label; on a tie the one seen first by ``order``."""
    return (
        df.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first_seen"))
        .orderBy(F.desc("n"), "first_seen")
        .limit(1)
    )


def predict_majority(messages: DataFrame, training: DataFrame, label: str, order: str, default: str) -> DataFrame:
    """Append ``intent`` and ``intent_confidence``; without training rows the default label."""
    fitted = majority_label(training, label, order).select("label").scalar()
    return messages.withColumns(
        {"intent": F.coalesce(fitted, F.lit(default)), "intent_confidence": F.lit(0.5)}
    )
