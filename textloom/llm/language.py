"""Language mixtures: expectation-maximisation over n-gram likelihoods, languages chosen by penalised likelihood."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textloom.llm.common import batch, bounded_batches, chunks, map_batches

#: n-grams are hashed to so many buckets; a model has one number for each bucket and language.
BUCKETS = 1 << 16
#: Distinct texts of a language that the likelihoods are learned from, about, chosen by a hash of the text.
MAX_TRAIN_DOCS = 5_000
#: More languages are refused: the model is broadcast.
MAX_LANGUAGES = 512
UNKNOWN = "und"
CHUNK_CHARS = 400_000

_letters: np.ndarray | None = None


def _letter_codes() -> np.ndarray:
    """For each code point whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, count) of the distinct trigrams of lower-cased letters; runs of anything else are a space.
    A document without letters has none."""
    lowered = [t.lower() for t in texts]
    codes = np.frombuffer("\n".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) + 1 for t in lowered])
    document = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in lowered])
    document = np.concatenate([[0], document])[:len(codes)]
    letter = _letter_codes()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first other character after a letter stands for the run
    keep[0] = True
    keep[ends] = True  # a break between documents
    codes, document, letter = np.where(letter, codes, 32)[keep].astype(np.uint64), document[keep], letter[keep]
    if len(codes) < 3:
        none = np.zeros(0, np.int64)
        return none, none, none
    mixed = codes[:-2] * np.uint64(0x9E3779B97F4A7C15) + codes[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + codes[2:] * np.uint64(
        0x165667B19E3779F9)
    mixed ^= mixed >> np.uint64(29)
    bucket = (mixed * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(48)).astype(np.int64)
    bucket = bucket[letter[1:-1]]
    key, count = np.unique(document[1:-1][letter[1:-1]] * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


@dataclass
class LanguageModel:
    languages: list[str]
    log_likelihood: np.ndarray  # languages x buckets

    def mixtures(self, texts: list[str], rounds: int = 25, penalty: float = 1.0) -> np.ndarray:
        """documents x languages: proportions that add up to 1; zeros without letters.

        All languages start alike. Expectation: how much of each n-gram is each language's, from the likelihoods and
        proportions. Maximisation: the proportions are the shares of the n-grams. Then the languages with the smallest
        part go, as long as log-likelihood minus `penalty` / 2 * log(n-grams) per language doesn't fall.
        """
        n, k = len(texts), len(self.languages)
        result = np.zeros((n, k))
        doc, bucket, count = trigrams(texts)
        if not len(doc) or not k:
            return result
        present, first = np.unique(doc, return_index=True)
        row = np.repeat(np.arange(len(present)), np.diff([*first, len(doc)]))
        like = self.log_likelihood[:, bucket].T.astype(np.float64)
        shift = like.max(axis=1, keepdims=True)
        like = np.exp(like - shift)
        weight = count.astype(np.float64)
        total = np.add.reduceat(weight, first)

        def fit(active: np.ndarray, share: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """EM for the documents `chosen`; shares and log-likelihoods."""
            inside = chosen[row]
            at, lk, w = row[inside], like[inside], weight[inside]
            ids = np.flatnonzero(chosen)
            local = np.searchsorted(ids, at)
            starts = np.searchsorted(local, np.arange(len(ids)))
            share = np.where(active, share, 0.0)[ids]
            share /= share.sum(axis=1, keepdims=True)
            for _ in range(rounds):
                joint = lk * share[local]
                joint *= (w / joint.sum(axis=1))[:, None]
                new = np.add.reduceat(joint, starts, axis=0) / total[ids][:, None]
                moved = np.abs(new - share).max()
                share = new
                if moved < 1e-3:
                    break
            mixed = (lk * share[local]).sum(axis=1)
            return share, np.add.reduceat(w * (np.log(np.maximum(mixed, 1e-300)) + shift[inside][:, 0]), starts)

        active = np.ones((len(present), k), bool)
        share, score = fit(active, np.full((len(present), k), 1.0 / k), np.ones(len(present), bool))
        score = score - penalty / 2 * np.log(total + 1) * active.sum(axis=1)
        going = active.sum(axis=1) > 1
        while going.any():
            least = np.where(active, share, np.inf)
            small = least <= np.maximum(least.min(axis=1, keepdims=True), 0.02)  # many at once while they are tiny
            keeps = active & ~small
            none = ~keeps.any(axis=1)
            best = np.argmax(np.where(active, share, -1), axis=1)
            keeps[none, best[none]] = True
            tried, now = fit(keeps, share, going)
            ids = np.flatnonzero(going)
            now = now - penalty / 2 * np.log(total[ids] + 1) * keeps[ids].sum(axis=1)
            better = now >= score[ids]
            won = ids[better]
            active[won], share[won], score[won] = keeps[won], tried[better], now[better]
            going[ids] = better & (active[ids].sum(axis=1) > 1)
        result[present] = np.where(active, share, 0.0)
        return result


def fit_languages(df: DataFrame, text_col: str = "text", lang_col: str = "lang",
                  max_docs: int = MAX_TRAIN_DOCS, smoothing: float = 0.5) -> LanguageModel:
    """Trigram likelihoods of each language from whole labelled texts; rows with a null text or language are left out.

    Copies of a text in a language count once. Up to about `max_docs` different texts of a language are used, chosen by
    their hash. Tasks count, counts are added by a shuffle, and languages x BUCKETS numbers reach the driver.
    """
    bounded_batches(df.sparkSession)
    rows = df.select(df[text_col].alias("text"), df[lang_col].cast("string").alias("lang")).where(
        "text IS NOT NULL AND lang IS NOT NULL").withColumn("hash", F.xxhash64("text"))
    sizes = rows.select("lang", "hash").distinct().groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return LanguageModel([], np.zeros((0, BUCKETS), "float32"))
    cut = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, max_docs / r["count"]))])
    chosen = rows.where(F.pmod("hash", F.lit(1_000_003)) < cut[F.col("lang")] * 1_000_003).dropDuplicates(
        ["lang", "hash"]).select("text", "lang")

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), object)
            for lang in set(langs):
                own = [t for t, x in zip(texts, langs) if x == lang]
                for start, end in chunks(own, CHUNK_CHARS):
                    _, bucket, n = trigrams(own[start:end])
                    counts[lang] = counts.get(lang, 0) + np.bincount(bucket, n, BUCKETS)
        for lang, total in counts.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(total[at].astype("int64"))],
                names=["lang", "bucket", "n"])

    found = chosen.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toArrow()
    languages = sorted(r["lang"] for r in sizes)
    counts = np.zeros((len(languages), BUCKETS))
    index = {lang: i for i, lang in enumerate(languages)}
    counts[[index[x] for x in found.column("lang").to_pylist()], found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    counts += smoothing
    return LanguageModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype("float32"))


def predict_languages(df: DataFrame, model: LanguageModel, text_col: str = "text", id_col: str = "doc_id",
                      keep: dict[str, Column] | None = None) -> DataFrame:
    """id, `keep` columns, lang_pred, score, mixture (language -> proportion, chosen ones only) of every row.

    lang_pred has the largest proportion, which is the score; of equal ones the first by name. A text that is null or
    has no letter is `und` with score 0 and no mixture, as is everything without a trained language. Other columns of
    `df` are not looked at; repeated rows and null ids give a row each.
    """
    keep = keep or {}
    shared = df.sparkSession.sparkContext.broadcast(model)
    picked = df.select(df[id_col].alias("_id"), df[text_col].alias("_text"), *[c.alias(k) for k, c in keep.items()])
    kept = picked.drop("_text").schema
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(kept)
    for f in (pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()),
              pa.field("mixture", pa.map_(pa.string(), pa.float64()))):
        schema = schema.append(f)

    def task():
        def apply(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [t or "" for t in b.column(1).to_pylist()]
            model = shared.value
            lang, score, mixture = [], [], []
            for start, end in chunks(texts, CHUNK_CHARS):
                for row in model.mixtures(texts[start:end]):
                    best = int(np.argmax(row)) if len(row) else 0
                    top = float(row[best]) if len(row) else 0.0
                    lang.append(model.languages[best] if top > 0 else UNKNOWN)
                    score.append(min(1.0, top))
                    mixture.append([(model.languages[i], float(row[i])) for i in np.flatnonzero(row)])
            return batch(schema, [b.column(0), *b.columns[2:], lang, score, mixture])

        return apply

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return map_batches(picked, task, f"{types}, lang_pred string, score double, mixture map<string,double>"
                       ).withColumnRenamed("_id", id_col)
