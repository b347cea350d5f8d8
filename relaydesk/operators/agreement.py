"""Agreement between two raters.

Pairs are combined to (a, b, n) first, which a hot rating cannot skew. Kappa
and the correlations are moments of that table, so no grid of labels is built.
Ranks come from a running count over the distinct values, done in value ranges
with one total per range, so no task sees all of them.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relaydesk.functions.special import correlation_p_value

RANGES = 200


def discretise(score: Column) -> Column:
    """Nearest whole rating, halves to the even one."""
    return F.bround(score, 0).cast("int")


def pair_counts(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """(a, b, n): distinct pairs with their number; pairs with a missing side are left out.

    Missing values are left out by their count and the keys are made
    non-null. A null filter, written here or inferred from a later join, would
    be pushed below the aggregation, where it computes the scores once more.
    """
    sides = df.select(a.alias("a"), b.alias("b"))
    keys = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("a", "b")]
    counted = sides.groupBy(*keys).agg(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("n"))
    return counted.where(F.col("n") > 0)


def running_ranks(values: DataFrame) -> DataFrame:
    """(v, mean_rank, position) for a table (v, n) of distinct values and their counts.

    ``mean_rank`` is the average of the ranks that the n equal rows share,
    ``position`` the number of distinct smaller values.
    """
    cuts = values.agg(
        F.array_distinct(F.percentile_approx("v", [i / RANGES for i in range(1, RANGES)], 10_000)).alias("cuts")
    ).scalar()
    # as many cuts lie below v as ranges come before its own
    cut = (
        values.withColumn("cuts", cuts)
        .withColumn("range", F.coalesce(F.size(F.filter("cuts", lambda c: c < F.col("v"))), F.lit(0)))
        .drop("cuts")
    )
    totals = cut.groupBy("range").agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("kinds"))
    # at most RANGES rows
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "range",
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("kinds").over(before), F.lit(0)).alias("kinds_before"),
    )
    smaller = Window.partitionBy("range").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    return (
        cut.withColumn("rows_in", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
        .withColumn("kinds_in", F.coalesce(F.count("v").over(smaller), F.lit(0)))
        .join(F.broadcast(offsets), "range")
        .select(
            "v",
            (F.col("rows_before") + F.col("rows_in") + (F.col("n") + 1) / 2).alias("mean_rank"),
            (F.col("kinds_before") + F.col("kinds_in")).alias("position"),
        )
    )


def _kappa(pairs: DataFrame) -> DataFrame:
    labels = pairs.select("n", F.explode(F.array("a", "b")).alias("v")).groupBy("v").agg(F.sum("n").alias("n"))
    place = running_ranks(labels).select("v", F.col("position").cast("double").alias("p"))
    at = pairs.join(place.withColumnRenamed("p", "i"), F.col("a") == F.col("v")).drop("v")
    at = at.join(place.withColumnRenamed("p", "j"), F.col("b") == F.col("v")).drop("v")
    i, j, n = F.col("i"), F.col("j"), F.col("n")
    sums = at.agg(
        F.sum(n * (i - j) * (i - j)).alias("observed"),
        F.sum(n * i).alias("si"),
        F.sum(n * j).alias("sj"),
        F.sum(n * i * i).alias("sii"),
        F.sum(n * j * j).alias("sjj"),
        F.sum(n).alias("rows"),
    )
    expected = F.col("sii") + F.col("sjj") - 2 * F.try_divide(F.col("si") * F.col("sj"), F.col("rows"))
    return sums.select((1 - F.try_divide(F.col("observed"), expected)).alias("kappa"))


def _correlation(pairs: DataFrame, x: Column, y: Column, name: str) -> DataFrame:
    """Correlation of two centred columns of a pair table."""
    sums = pairs.select((F.col("n") * x * y).alias("xy"), (F.col("n") * x * x).alias("xx"), (F.col("n") * y * y).alias("yy"))
    sums = sums.agg(F.sum("xy").alias("xy"), F.sum("xx").alias("xx"), F.sum("yy").alias("yy"))
    return sums.select(F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias(name))


def _pearson(pairs: DataFrame) -> DataFrame:
    n = F.col("n")
    means = pairs.agg(
        F.struct(
            F.try_divide(F.sum(n * F.col("a")), F.sum(n)).alias("a"), F.try_divide(F.sum(n * F.col("b")), F.sum(n)).alias("b")
        )
    ).scalar()
    centred = pairs.select("n", (F.col("a") - means["a"]).alias("x"), (F.col("b") - means["b"]).alias("y"))
    return _correlation(centred, F.col("x"), F.col("y"), "r")


def _spearman(pairs: DataFrame) -> DataFrame:
    def ranks(side: str) -> DataFrame:
        counts = pairs.groupBy(F.col(side).alias("v")).agg(F.sum("n").alias("n"))
        return running_ranks(counts).select(F.col("v").alias(side), F.col("mean_rank").alias(f"rank_{side}"))

    middle = (pairs.agg(F.sum("n")).scalar() + 1) / 2
    ranked = pairs.join(ranks("a"), "a").join(ranks("b"), "b")
    centred = ranked.select("n", (F.col("rank_a") - middle).alias("x"), (F.col("rank_b") - middle).alias("y"))
    return _correlation(centred, F.col("x"), F.col("y"), "rho")


def weighted_kappa(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """One row (kappa): quadratic weights on the position of a label among all labels seen.

    Sum of w * observed over sum of w * expected with w = (i - j)^2 needs only
    the sums of i, j, their squares and their product. Null if neither varies.
    """
    return _kappa(pair_counts(df, a, b))


def pearson(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """One row (r): null unless both sides vary."""
    return _pearson(pair_counts(df, a.cast("double"), b.cast("double")))


def spearman(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """One row (rho): correlation of mean ranks, centred on their known mean (n + 1) / 2."""
    return _spearman(pair_counts(df, a, b))


def agreement(df: DataFrame, human: Column, judge: Column) -> DataFrame:
    """One row with every agreement statistic; no row for an empty input.

    All statistics start from one pair table, which is kept: it stands behind a pass over all texts.
    """
    pairs = pair_counts(df, human.cast("double"), judge.cast("double")).persist(StorageLevel.MEMORY_AND_DISK)
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    whole_a, whole_b = discretise(a), discretise(b)
    whole = pairs.groupBy(whole_a.alias("a"), whole_b.alias("b")).agg(F.sum("n").alias("n"))
    size = F.sum(n)
    basic = pairs.agg(
        size.alias("sample_size"),
        F.try_divide(F.sum(n * F.abs(a - b)), size).alias("mean_absolute_error_MAE"),
        F.try_divide(F.sum(F.when(whole_a == whole_b, n).otherwise(F.lit(0))), size).alias("exact_agreement_rate"),
        F.try_divide(F.sum(F.when(F.abs(whole_a - whole_b) <= 1, n).otherwise(F.lit(0))), size).alias(
            "within_1_point_agreement_rate"
        ),
        F.try_divide(F.sum(n * a), size).alias("human_mean_score"),
        F.try_divide(F.sum(n * b), size).alias("judge_mean_score"),
        # aggregated like the rest, so that the p-values below start from plain columns
        F.max(_kappa(whole).scalar()).alias("quadratic_weighted_kappa"),
        F.max(_pearson(pairs).scalar()).alias("pearson_correlation"),
        F.max(_spearman(pairs).scalar()).alias("spearman_correlation"),
    ).where(F.col("sample_size") > 0)
    return basic.withColumns(
        {
            "pearson_p_value": correlation_p_value("pearson_correlation", "sample_size"),
            "spearman_p_value": correlation_p_value("spearman_correlation", "sample_size"),
        }
    )
