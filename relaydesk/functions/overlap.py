"""ROUGE and BLEU of a reply against a reference text, both in one row: no join, no shuffle.

Counting common n-grams in an Arrow batch took a third of the time of the
same counts written with array functions (23,000 pairs of 330 words: 2.2 s
against 7.0 s on 8 cores), so the counts come from one small UDF; tokens and
ratios stay column expressions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relaydesk.functions.text import ratio, tokens

SCORES = ("rouge1", "rouge2", "rougeL", "bleu4")
PIECE = 256
_HYP, _REF, _COUNTS = "_hyp_tokens", "_ref_tokens", "_common"


def common_ngrams(a: list[str], b: list[str], n: int) -> int:
    """Size of the bag intersection of the n-grams of both sides."""
    left, right = (Counter(zip(*(words[i:] for i in range(n)))) for words in (a, b))
    return sum((left & right).values())


def lcs_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a`` (Hyyro 2004)."""
    where: dict[str, int] = {}
    for i, word in enumerate(a):
        where[word] = where.get(word, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for word in b:
        hit = row & where.get(word, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def in_pieces(column: pa.Array, rows: int = PIECE) -> Iterator[list[str]]:
    """The values of an Arrow column, made Python objects a few rows at a time: these take far more memory than Arrow's."""
    for at in range(0, len(column), rows):
        # through numpy, which makes the strings in less time than to_pylist()
        yield from map(list, column.slice(at, rows).to_numpy(zero_copy_only=False))


def _common(longest: int, with_lcs: bool):
    """UDF giving the common n-gram counts for n = 1..longest, then the LCS length if asked for."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def counts(hyp: pa.Array, ref: pa.Array) -> pa.Array:
        found = []
        for h, r in zip(in_pieces(hyp), in_pieces(ref)):
            row = [common_ngrams(h, r, n) for n in range(1, longest + 1)]
            found.append([*row, lcs_length(h, r)] if with_lcs else row)
        return pa.array(found, pa.list_(pa.int64()))

    return counts


def _grams(words: Column, n: int) -> Column:
    return F.greatest(F.size(words) - (n - 1), F.lit(0))


def _rouge_n(overlap: Column, hyp: Column, ref: Column, n: int) -> Column:
    p, r = ratio(overlap, _grams(hyp, n)), ratio(overlap, _grams(ref, n))
    return ratio(2 * p * r, p + r)


def _bleu4(overlaps: list[Column], hyp: Column, ref: Column) -> Column:
    c, r = F.size(hyp), F.size(ref)
    precisions = [ratio(o, _grams(hyp, n)) for n, o in enumerate(overlaps, 1)]
    logs = reduce(lambda a, b: a + b, [F.log(p) for p in precisions])
    brevity = F.when(c > r, F.lit(1.0)).otherwise(F.exp(1 - ratio(r, c)))
    scored = (c >= 4) & (r >= 4) & (F.least(*overlaps) > 0)
    return F.when(scored, brevity * F.exp(logs / 4)).otherwise(F.lit(0.0))


def add_overlap_scores(df: DataFrame, hyp: str, ref: str, scores: tuple[str, ...] = SCORES) -> DataFrame:
    """Append the asked-for score columns. A null text counts as empty and scores 0."""
    h, r = F.col(_HYP), F.col(_REF)
    longest = 4 if "bleu4" in scores else 2 if "rouge2" in scores else 1 if "rouge1" in scores else 0
    counts = _common(longest, "rougeL" in scores)
    common = [F.col(_COUNTS)[n] for n in range(longest)]
    made = {}
    if "rouge1" in scores:
        made["rouge1"] = _rouge_n(common[0], h, r, 1)
    if "rouge2" in scores:
        made["rouge2"] = _rouge_n(common[1], h, r, 2)
    if "rougeL" in scores:
        # the same mean, with the length put in: 2pr/(p+r) = 2l/(h+r)
        made["rougeL"] = ratio(2 * F.col(_COUNTS)[longest], F.size(h) + F.size(r))
    if "bleu4" in scores:
        made["bleu4"] = _bleu4(common, h, r)
    tokenized = df.withColumns({_HYP: tokens(F.col(hyp)), _REF: tokens(F.col(ref))})
    return tokenized.withColumn(_COUNTS, counts(h, r)).withColumns(made).drop(_HYP, _REF, _COUNTS)
