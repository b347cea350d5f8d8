"""Multinomial logistic regression on TF-IDF features.

Fitting is Newton's method over a written feature table. A fitted model is a
small matrix (labels by vocabulary), so scoring is a row-local expression and
never leaves the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.operators import newton
from relaydesk.operators.rules import softmax
from relaydesk.operators.tfidf import TfidfModel, double_array
from relaydesk.session import fresh_dir
from relaydesk.sources.tables import gather

MAX_FEATURES = 2500
# rows of a small table that a task adds up in less time than it takes to start
ROWS_PER_TASK = 1000


@dataclass(frozen=True)
class IntentModel:
    """``weights[c][t]`` and ``intercepts[c]`` for class ``classes[c]``, classes in alphabetical order."""

    tfidf: TfidfModel
    classes: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]

    @classmethod
    def fit(cls, df: DataFrame, text: str, label: str, max_features: int = MAX_FEATURES, c: float = 1.0) -> IntentModel:
        """Minimise the log loss, each class weighted to the same total, plus |weights|^2 / 2c.

        The summed loss has no penalty on intercepts and features are not rescaled.
        """
        known = df.where(F.col(label).isNotNull())
        tfidf = TfidfModel.fit(known, text, max_features, sublinear=True)
        # one row per label
        counts = {r.label: r.n for r in known.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
        classes = tuple(sorted(counts))
        rows = sum(counts.values())
        weight = F.coalesce(*[F.when(F.col(label) == x, F.lit(rows / (len(classes) * counts[x]))) for x in classes])
        number = F.coalesce(*[F.when(F.col(label) == x, F.lit(i)) for i, x in enumerate(classes)])
        features = tfidf.transform(known, text).select(
            F.col("vec.idx").alias("idx"), F.col("vec.w").alias("w"), number.alias("label"), weight.alias("weight")
        )
        # written once: the steps below read features, not texts, also after a lost executor
        path = fresh_dir(df.sparkSession, "features")
        tasks = 1 + rows // ROWS_PER_TASK
        few = tasks < df.sparkSession.sparkContext.defaultParallelism
        (features.repartition(tasks) if few else gather(features, known)).write.parquet(path)
        train = df.sparkSession.read.schema(features.schema).parquet(path)
        matrix = newton.fit(train, len(classes), len(tfidf.terms), 1.0 / c)
        weights = tuple(map(tuple, matrix[:, :-1].tolist()))
        return cls(tfidf, classes, weights, tuple(matrix[:, -1].tolist()))

    def probabilities(self, df: DataFrame, text: str, labels: tuple[str, ...], out: str) -> DataFrame:
        """Append ``out``: array of probabilities in the order of ``labels``; 0 for a label never seen."""
        scored = self.tfidf.transform(df, text, "_features")
        vec = F.col("_features")
        by_class = softmax(F.array(*[self._logit(vec, i) for i in range(len(self.classes))]))
        place = {name: i for i, name in enumerate(self.classes)}
        scored = scored.withColumn("_by_class", by_class)
        ordered = [F.col("_by_class")[place[x]] if x in place else F.lit(0.0) for x in labels]
        return scored.withColumn(out, F.array(*ordered)).drop("_features", "_by_class")

    def _logit(self, vec: Column, i: int) -> Column:
        parts = F.zip_with(vec["idx"], vec["w"], lambda t, w: w * F.get(double_array(self.weights[i]), t))
        return F.aggregate(parts, F.lit(float(self.intercepts[i])), lambda a, x: a + x)
