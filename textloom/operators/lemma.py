"""Lemmas: suffix rules and irregular forms, worked out once per distinct token.

A base form proposed by a rule counts only if it is in the lexicon: a word list the caller gives, or
the words the corpus itself uses in `min_df` documents or more. Verb forms are tried before noun forms.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from textloom.cluster import fits_broadcast, lookup_join, materialise
from textloom.fixed_values import IRREGULAR_FORMS, NOUN_SUFFIXES, VERB_SUFFIXES
from textloom.functions.term_batches import as_array, lists_of, sizes_of

# A worker holds the table as two Arrow columns, about half as large as the measured rows.
LOOKUP_ROWS = 8_000_000
LOOKUP_BYTES = 256 * 1024 * 1024


def token_frequencies(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """token, df: number of documents using it."""
    distinct = df.select(F.explode_outer(F.array_distinct(tokens_col)).alias("token"))
    return distinct.groupBy("token").agg(F.count("*").alias("df")).where(F.col("token").isNotNull())


def lemma_table(tokens: DataFrame, lexicon: DataFrame | None = None, min_df: int = 2) -> DataFrame:
    """token, lemma for the tokens that change. `tokens` is token, df; `lexicon` has a column token."""
    words = lexicon.select("token").distinct() if lexicon is not None else tokens.where(F.col("df") >= min_df)
    token = F.col("token")
    rules = [(0, *r) for r in VERB_SUFFIXES] + [(1, *r) for r in NOUN_SUFFIXES]
    proposals = F.array(*[
        F.when(token.endswith(old), F.struct(
            F.lit(kind).alias("kind"),
            F.concat(F.left(token, F.length(token) - len(old)), F.lit(new)).alias("lemma"),
        ))
        for kind, old, new in rules
    ])
    proposed = tokens.select("token", F.inline_outer(F.filter(proposals, lambda p: p.isNotNull())))
    known = proposed.join(words.select(F.col("token").alias("lemma")), "lemma", "left_semi")
    by_rule = known.groupBy("token").agg(
        F.min(F.struct("kind", F.length("lemma").alias("length"), "lemma"))["lemma"].alias("lemma"))
    irregular = F.create_map(*[F.lit(w) for pair in IRREGULAR_FORMS.items() for w in pair])
    listed = tokens.select("token", F.try_element_at(irregular, token).alias("lemma")).where(
        F.col("lemma").isNotNull())
    regular = by_rule.where(~token.isin(list(IRREGULAR_FORMS)))
    return regular.unionByName(listed).where(F.col("token") != F.col("lemma"))


def _looked_up(rows: pa.Array, tokens: pa.Array, lemmas: pa.Array, min_token_len: int) -> pa.Array:
    """Each different token of a batch is looked up once; the lists are put together from its numbers."""
    sizes, encoded = sizes_of(rows), rows.flatten().dictionary_encode()
    at = pc.index_in(encoded.dictionary, value_set=tokens)
    words = pc.coalesce(lemmas.take(at), encoded.dictionary)
    long_enough = pc.greater_equal(pc.utf8_length(words), min_token_len).to_numpy(zero_copy_only=False).astype(bool)
    word = encoded.indices.to_numpy(zero_copy_only=False)
    kept = long_enough[word]
    row = np.repeat(np.arange(len(rows)), sizes)
    return lists_of(np.bincount(row[kept], minlength=len(rows)), words.take(pa.array(word[kept])))


def lemmatise(
    df: DataFrame, lemmas: DataFrame, id_col: str = "id", tokens_col: str = "tokens",
    min_token_len: int = 2, **limits: int,
) -> DataFrame:
    """Replace tokens by their lemmas in order, then drop what became too short.

    `lemmas` should be materialised. A table within the limits of a broadcast is looked up in the row, by Arrow batch.
    A larger one is joined: rows are taken apart and put together again by id, and their other columns stay behind.
    """
    if fits_broadcast(lemmas, limits.get("rows", LOOKUP_ROWS), limits.get("size", LOOKUP_BYTES)):
        table = lemmas.select("token", "lemma").toArrow().combine_chunks()
        shared = df.sparkSession.sparkContext.broadcast(tuple(as_array(table.column(c)).cast(pa.string()) for c in table.column_names))

        @F.arrow_udf("array<string>")
        def look_up(rows: pa.Array) -> pa.Array:
            return _looked_up(as_array(rows), *shared.value, min_token_len)

        return df.withColumn(tokens_col, look_up(tokens_col)).select(*df.columns)
    if set(df.columns) - {id_col, tokens_col}:
        slim = lemmatise(df.select(id_col, tokens_col), lemmas, id_col, tokens_col, min_token_len, **limits)
        return df.drop(tokens_col).join(slim, id_col).select(*df.columns)
    others = [c for c in df.columns if c not in (id_col, tokens_col)]
    rows = df.select(id_col, *others, F.posexplode_outer(tokens_col).alias("_pos", "token"))
    found = lookup_join(rows, lemmas, ["token"], id_col, "left", **limits)
    word = F.coalesce("lemma", "token")
    kept = F.when(F.length(word) >= min_token_len, F.struct("_pos", word.alias("t")))
    return (
        found.groupBy(id_col)
        .agg(*[F.any_value(c).alias(c) for c in others], F.sort_array(F.collect_list(kept)).alias("_words"))
        .withColumn(tokens_col, F.transform("_words", lambda x: x["t"]))
        .select(*df.columns)
    )


#: Bytes of a map of lemmas that is sent to the workers; some ten million lemmas take them.
MAP_BYTES = 256 * 1024 * 1024


class LemmaMap:
    """token -> lemma in little memory: the sorted tokens as one string, and of each how many bytes to cut and which
    ending to add. Endings are few, as most lemmas come from suffix rules. Looked up by bisection."""

    def __init__(self, words: bytes, ends: np.ndarray, cuts: np.ndarray, endings: np.ndarray, forms: list[bytes]):
        self.words, self.ends, self.cuts, self.endings, self.forms = words, ends, cuts, endings, forms

    @staticmethod
    def of(lemmas: DataFrame) -> LemmaMap:
        """From (token, lemma), which is measured before it comes to the driver."""
        rows, size = lemmas.agg(
            F.count("*"), F.coalesce(F.sum(F.octet_length("token") + F.octet_length("lemma")), F.lit(0))).first()
        if size + 16 * rows > MAP_BYTES:
            raise ValueError(f"{rows} lemmas of {size} bytes are too many for a stage: clean with operators.lemma.lemmatise")
        table = lemmas.select("token", "lemma").toArrow()
        pairs = sorted((t.encode(), w.encode()) for t, w in zip(*(c.to_pylist() for c in table.columns)))
        forms: dict[bytes, int] = {}
        cuts, endings = np.zeros(len(pairs), np.uint16), np.zeros(len(pairs), np.int32)
        for k, (token, lemma) in enumerate(pairs):
            common = len(os.path.commonprefix([token, lemma]))
            cuts[k], endings[k] = len(token) - common, forms.setdefault(lemma[common:], len(forms))
        return LemmaMap(b"".join(t for t, _ in pairs), np.cumsum([0, *(len(t) for t, _ in pairs)]), cuts, endings, list(forms))

    def __len__(self) -> int:
        return len(self.cuts)

    def get(self, token: str) -> str:
        """Its lemma, else the token."""
        key, low, high = token.encode(), 0, len(self.cuts)
        while low < high:
            mid = (low + high) // 2
            if self.words[self.ends[mid]:self.ends[mid + 1]] < key:
                low = mid + 1
            else:
                high = mid
        if low == len(self.cuts) or self.words[self.ends[low]:self.ends[low + 1]] != key:
            return token
        return (key[:len(key) - self.cuts[low]] + self.forms[self.endings[low]]).decode()


def fit_lemmas(df: DataFrame, tokens_col: str = "tokens", lexicon: DataFrame | None = None, min_df: int = 2) -> DataFrame:
    tokens = materialise(token_frequencies(df, tokens_col))
    return materialise(lemma_table(tokens, lexicon, min_df))
