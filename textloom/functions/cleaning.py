"""The cleaning chain as column expressions. No step leaves the JVM."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from textloom.fixed_values import (
    EMOTICONS, PRESERVED_WORDS, STOP_WORDS, SYMBOL_RANGES, TAG, TWO_PART_WORDS, URL,
)
from textloom.functions.terms import bind

LONGEST_EMOTICONS_FIRST = sorted(EMOTICONS, key=lambda pair: len(pair[0]), reverse=True)


def replace_emoticons(text: Column) -> Column:
    """Most texts hold no emoticon, so the replacements run only where a part that each of them needs is found. Words put in
    have none of these parts, and spaces around them, so no emoticon arises on the way."""
    def replaced(col: Column, parts: Iterable[str], pairs: list[tuple[str, str]]) -> Column:
        found = reduce(lambda a, b: a | b, [F.contains(col, F.lit(part)) for part in parts])
        return F.when(found, reduce(
            lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(f" {pair[1]} ")), pairs, col)).otherwise(col)

    with_colon = [pair for pair in LONGEST_EMOTICONS_FIRST if ":" in pair[0]]
    others = [pair for pair in LONGEST_EMOTICONS_FIRST if ":" not in pair[0]]
    colons = {pair[0][pair[0].index(":"):][:2] for pair in with_colon}
    text = bind(text, lambda t: replaced(t, sorted(colons), with_colon))
    return bind(text, lambda t: replaced(t, [pair[0] for pair in others], others))


def remove_symbols(text: Column) -> Column:
    return bind(text, lambda t: F.when(
        F.octet_length(t) > F.length(t), F.regexp_replace(t, f"[{SYMBOL_RANGES}]+", " ")).otherwise(t))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, " ")


def remove_tags(text: Column) -> Column:
    """Tags can only end at or before the last '>'. Cutting there first keeps the search linear:
    otherwise each unclosed '<' would scan to the end of the text."""
    tail = F.substring_index(text, ">", -1)
    head = F.left(text, F.length(text) - F.length(tail))
    return F.concat(F.regexp_replace(head, TAG, " "), tail)


def keep_letters(text: Column) -> Column:
    """Letters and single apostrophes, one space between words."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[^a-z']+", " "), "'{2,}", "'"))


def normalise_text(text: Column | str) -> Column:
    """Lower case, emoticons to words, symbols, URLs and tags out, letters only.

    Null and blank give ''. Digits vanish with the other non-letters, so they need no step.
    """
    col = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    steps = [F.lower, replace_emoticons, remove_symbols, remove_urls, remove_tags, keep_letters]
    return reduce(lambda c, step: step(c), steps, col)


TWO_PART_PATTERN = (
    r"\b(?:" + "|".join(f"({a})({b})" for a, b in TWO_PART_WORDS) + r"|(wan)(na)(?= ))\b"
)
TWO_PART_HALVES = " " + "".join(f"${i}" for i in range(1, 17, 2)) + " " + "".join(f"${i}" for i in range(2, 17, 2)) + " "


def _split_apostrophes(text: Column) -> Column:
    """A closing or lone apostrophe, 's 'm 'd, 'll 're 've n't become words of their own."""
    text = F.regexp_replace(text, r"'([a-ce-lo-ru-z])\b", "' $1")
    text = F.regexp_replace(text, "([^'])' ", "$1 ' ")
    text = F.concat(F.lit(" "), text, F.lit(" "))
    text = F.regexp_replace(text, "([^' ])('[smd]?) ", "$1 $2 ")
    return F.regexp_replace(text, "([^' ])('ll|'re|'ve|n't) ", "$1 $2 ")


def _word_parts(normalised: Column | str) -> Column:
    """Words of a normalised text with empty strings at the ends."""
    col = F.col(normalised) if isinstance(normalised, str) else normalised
    text = F.when(F.contains(col, F.lit("'")), _split_apostrophes(col)).otherwise(
        F.concat(F.lit(" "), col, F.lit(" ")))
    return bind(text, lambda t: F.split(_split_words(t), " +"))


def _split_words(text: Column) -> Column:
    """Cannot, 'tis and the like in two. The pattern runs only where one of its words is found."""
    found = reduce(lambda a, b: a | b, [F.contains(text, F.lit(a + b)) for a, b in [*TWO_PART_WORDS, ("wan", "na")]])
    halves = F.when(found, F.regexp_replace(text, TWO_PART_PATTERN, TWO_PART_HALVES)).otherwise(text)
    return F.when(F.contains(text, F.lit("'t")), F.regexp_replace(halves, r" ('t)(is|was)\b", " $1 $2 ")).otherwise(halves)


def tokenise(normalised: Column | str) -> Column:
    """Words of a normalised text, contractions split as a Treebank tokeniser splits them."""
    return F.filter(_word_parts(normalised), lambda t: t != "")


def stop_words(custom: Iterable[str] = ()) -> list[str]:
    """The English list and the caller's words, without the preserved ones."""
    return sorted(set(STOP_WORDS).union(custom) - set(PRESERVED_WORDS))


def remove_stop_words(tokens: Column | str, custom: Iterable[str] = ()) -> Column:
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    stop = stop_words(custom)
    return F.filter(col, lambda t: ~t.isin(stop))


def with_tokens(
    df: DataFrame,
    text_col: str = "text",
    out: str = "tokens",
    remove_stopwords: bool = True,
    min_token_len: int = 2,
    custom_stopwords: Iterable[str] = (),
    fold_negation: bool = False,
) -> DataFrame:
    """Add the cleaned tokens, without lemmas (see `operators.lemma` for those).

    `fold_negation` makes "not" of the token "n't", which terms otherwise drop, as they have letters only.

    The normalised text is a column of its own because array functions with lambdas are evaluated
    outside generated code and would run its regular expressions once per reference.
    """
    stop = stop_words(custom_stopwords)

    def keep(t: Column) -> Column:
        long_enough = F.length(t) >= max(min_token_len, 1)
        return long_enough & ~t.isin(stop) if remove_stopwords else long_enough

    def words(parts: Column) -> Column:
        return F.transform(parts, lambda t: F.when(t == "n't", "not").otherwise(t)) if fold_negation else parts

    return (
        df.withColumn("_normalised", normalise_text(text_col))
        .withColumn(out, F.filter(words(_word_parts("_normalised")), keep))
        .drop("_normalised")
    )


def clean_text(tokens: Column | str) -> Column:
    return F.array_join(tokens, " ")
