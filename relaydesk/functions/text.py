"""Cleaning, tokens and n-grams as column expressions. Nothing here shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from relaydesk.functions.regex import NOT_SPACE, SPACE, WORD


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use the result several times in ``body``.

    Inside a lambda a referenced expression would be evaluated again for every
    element, so intermediate arrays are bound to a lambda variable first.
    """
    return F.transform(F.array(value), body)[0]


def keep_if(row: Column, condition: Callable[[Column], Column]) -> Column:
    """Generator of the fields of struct ``row`` for rows that meet ``condition``.

    A filter on computed columns is pushed below their projection and computes
    them again, once per mention. Here the struct is made once and then judged.
    """
    return F.inline(F.filter(F.array(row), condition))


def clean(text: Column, strip_urls: bool = True) -> Column:
    """Drop mentions and (unless told otherwise) links, squeeze white space. Null gives ''."""
    out = F.regexp_replace(F.coalesce(text, F.lit("")), f"@{WORD}+", "")
    if strip_urls:
        out = F.regexp_replace(out, f"https?://{NOT_SPACE}+", "")
    return F.trim(F.regexp_replace(out, f"{SPACE}+", " "))


def tokens(text: Column, min_chars: int = 1) -> Column:
    """Lower-case runs of at least ``min_chars`` word characters. Null gives an empty array."""
    run = f"{WORD}+" if min_chars == 1 else f"{WORD}{{{min_chars},}}"
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(run), F.lit(0))


def ngrams(words: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring words, joined by one space."""
    if n == 1:
        return words
    return bind(
        words,
        lambda w: F.when(
            F.size(w) >= n,
            F.transform(
                F.sequence(F.lit(0), F.size(w) - n),
                lambda i: F.concat_ws(" ", *[w[i + j] for j in range(n)]),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def weighted_terms(text: Column) -> Column:
    """Unigrams and bigrams over words of two or more characters."""
    return bind(tokens(text, 2), lambda w: F.concat(w, ngrams(w, 2)))


def ratio(top: Column, bottom: Column) -> Column:
    """Division where an empty base gives 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
