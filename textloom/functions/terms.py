"""Tokens to terms, all within the row: none of these needs a shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from textloom.fixed_values import FEATURE_TOKEN, NGRAM_RANGE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times in `body`, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_count(text: Column | str) -> Column:
    """White-space separated words; null and blank have none."""
    return F.regexp_count(F.coalesce(_col(text), F.lit("")), F.lit(r"[^\s\p{Z}\x0b\x1c-\x1f\x85]+"))


def feature_tokens(cleaned: Column | str) -> Column:
    """Words of two or more letters in a cleaned text."""
    return F.regexp_extract_all(_col(cleaned), F.lit(FEATURE_TOKEN), F.lit(0))


def ngrams(tokens: Column | str, ngram_range: tuple[int, int] = NGRAM_RANGE) -> Column:
    """All n-grams of the given sizes, adjacent tokens joined by a space."""
    lo, hi = ngram_range

    def grams(t: Column) -> Column:
        parts, longer = [], t
        for n in range(1, hi + 1):
            if n > 1:
                count = F.greatest(F.size(t) - F.lit(n - 1), F.lit(0))
                longer = F.zip_with(
                    F.slice(longer, F.lit(1), count), F.slice(t, F.lit(n), count),
                    lambda a, b: F.concat_ws(" ", a, b),
                )
            if n >= lo:
                parts.append(longer)
        return F.concat(*parts)

    return bind(_col(tokens), grams)


def term_counts(terms: Column | str) -> Column:
    """array<struct<term, tf>>: run lengths of the sorted terms."""

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)),
        )
        return bind(starts, lambda st: F.zip_with(
            st, F.concat(F.slice(st, F.lit(2), n), F.array(n + 1)),
            lambda a, b: F.struct(F.get(s, a - 1).alias("term"), (b - a).alias("tf")),
        ))

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    return bind(_col(terms), lambda t: F.when(F.size(t) > 0, bind(F.sort_array(t), runs)).otherwise(empty))
