"""TF-IDF over unigrams and bigrams.

Fitting a large table counts words, then pairs of frequent words, with map-side
combine: what crosses the network is bounded by distinct terms per task.
Weighting is row-local: the vocabulary is capped by ``max_features``, so it
travels as a dictionary, and no document is ever regrouped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaydesk.functions.text import bind, ngrams, tokens, weighted_terms
from relaydesk.sources.tables import plan_bytes

MAX_VOCABULARY = 100_000
MAX_FREQUENT_WORDS = 200_000
SINGLE_PASS_BYTES = 64 * 1024 * 1024


def _statistics(df: DataFrame, terms: Column) -> DataFrame:
    """(term, tf, df) rows, not yet added up: every occurrence, and every distinct term of a row."""
    marked = bind(
        terms,
        lambda t: F.concat(
            F.transform(t, lambda x: F.struct(x.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
            F.transform(
                F.array_distinct(t), lambda x: F.struct(x.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df"))
            ),
        ),
    )
    return df.select(F.inline(marked))


def _total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


def _frequent_words(df: DataFrame, text: str, max_features: int) -> DataFrame | None:
    """(term, tf, df) of the words as frequent as the last of the top ``max_features`` words; kept in memory.

    None for a small table, whose terms are better counted in a single pass.
    """
    if plan_bytes(df) <= SINGLE_PASS_BYTES:
        return None
    words = _total(_statistics(df, tokens(F.col(text), 2))).persist(StorageLevel.MEMORY_AND_DISK)
    last = (
        words.orderBy(F.desc("tf"), "term")
        .limit(max_features)
        .agg(F.count(F.lit(1)).alias("n"), F.min("tf").alias("tf"))
        .first()
    )
    # more than max_features rows only through ties on the last place
    frequent = words if last.n < max_features else words.where(F.col("tf") >= last.tf).persist()
    if frequent is not words:
        frequent.count()
        words.unpersist()
    return frequent


def term_statistics(df: DataFrame, text: str, frequent: DataFrame | None = None) -> DataFrame:
    """(term, tf, df) of all terms, or of the frequent words and of the pairs that can be as frequent.

    A pair is no more frequent than its rarer word, so only pairs of frequent
    words are counted. Rare pairs, which are most of a large corpus and do not
    combine before a shuffle, never leave their task.
    """
    if frequent is None:
        return _total(_statistics(df, weighted_terms(F.col(text))))
    pairs = _statistics(df, bind(tokens(F.col(text), 2), lambda w: ngrams(w, 2)))
    if frequent.count() <= MAX_FREQUENT_WORDS:
        known = F.broadcast(frequent.select(F.col("term").alias("word")))
        for side in (1, -1):
            pairs = pairs.join(known, F.substring_index("term", " ", side) == F.col("word"), "left_semi")
    return frequent.unionByName(_total(pairs))


def _top_terms(df: DataFrame, text: str, max_features: int, frequent: DataFrame | None) -> DataFrame:
    rows = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return top_terms(term_statistics(df, text, frequent), rows, max_features)


def top_terms(statistics: DataFrame, rows: Column | int, max_features: int) -> DataFrame:
    """(term, tf, df, idf) of the ``max_features`` most frequent terms of ``rows`` texts; ties go to the smaller term."""
    return (
        statistics.orderBy(F.desc("tf"), "term")
        .limit(max_features)
        .withColumn("idf", F.log((F.lit(1) + rows).cast("double") / (1 + F.col("df"))) + 1.0)
    )


def vocabulary(df: DataFrame, text: str, max_features: int) -> DataFrame:
    """(term, tf, df, idf) of the ``max_features`` most frequent terms; ties go to the smaller term."""
    if not 0 < max_features <= MAX_VOCABULARY:
        raise ValueError(f"max_features must lie in 1..{MAX_VOCABULARY}")
    return _top_terms(df, text, max_features, _frequent_words(df, text, max_features))


@dataclass(frozen=True)
class TfidfModel:
    """A fitted vocabulary: position of a term is its rank in alphabetical order."""

    terms: tuple[str, ...]
    idf: tuple[float, ...]
    sublinear: bool

    @classmethod
    def fit(cls, df: DataFrame, text: str, max_features: int, sublinear: bool) -> TfidfModel:
        if not 0 < max_features <= MAX_VOCABULARY:
            raise ValueError(f"max_features must lie in 1..{MAX_VOCABULARY}")
        frequent = _frequent_words(df, text, max_features)
        model = cls.of_terms(_top_terms(df, text, max_features, frequent), sublinear)
        if frequent is not None:
            frequent.unpersist()
        return model

    @classmethod
    def of_terms(cls, top: DataFrame, sublinear: bool) -> TfidfModel:
        """The model of a vocabulary (term, idf), whose size bounds what reaches the driver."""
        found = sorted((r.term, r.idf) for r in top.select("term", "idf").collect())
        return cls(tuple(t for t, _ in found), tuple(w for _, w in found), sublinear)

    def transform(self, df: DataFrame, text: str, out: str = "vec") -> DataFrame:
        """Append ``out``: struct of term positions and unit-length weights; no known term gives empty arrays."""
        return self.transform_terms(df.withColumn("_terms", weighted_terms(F.col(text))), "_terms", out).drop("_terms")

    def transform_terms(self, df: DataFrame, terms: str, out: str = "vec") -> DataFrame:
        """As :meth:`transform`, for a column of terms, repeated as often as they occur."""
        if not self.terms:
            empty = F.struct(F.array().cast("array<int>").alias("idx"), F.array().cast("array<double>").alias("w"))
            return df.withColumn(out, empty)
        counted = self._counter.copy({self._counter.inputCol: terms}).transform(df)
        counts = F.unwrap_udt("_counts")
        raw = F.zip_with(counts["indices"], counts["values"], self._weight)
        unit = bind(
            raw,
            lambda w: bind(
                F.sqrt(F.aggregate(w, F.lit(0.0), lambda a, x: a + x * x)),
                lambda norm: F.transform(w, lambda x: x / norm),
            ),
        )
        return counted.withColumn(out, F.struct(counts["indices"].alias("idx"), unit.alias("w"))).drop("_counts")

    @cached_property
    def _counter(self) -> CountVectorizerModel:
        return CountVectorizerModel.from_vocabulary(list(self.terms), inputCol="_terms", outputCol="_counts")

    def _weight(self, position: Column, count: Column) -> Column:
        tf = (1.0 + F.log(count)) if self.sublinear else count
        return tf * F.get(double_array(self.idf), position)


def double_array(values) -> Column:
    """A constant array built by one expression; the optimizer folds it into a literal."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")
