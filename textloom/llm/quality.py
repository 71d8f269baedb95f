"""Quality classifier: a generalised additive model with pairwise interactions, fitted by cyclic boosting."""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textloom.cluster import fits_broadcast
from textloom.llm.common import batch, chunks, map_batches, nullable

#: Labelled rows that the model is fitted on, about: those with the smallest hashes of their id.
MAX_TRAIN_ROWS = 20_000

FEATURES = [
    "log_chars", "log_words", "word_length", "distinct_words", "repeated_neighbours", "upper", "digits", "spaces",
    "line_breaks", "full_stops", "commas", "exclamations", "bars", "marks", "other_symbols", "beyond_ascii",
    "distinct_lines", "compressed", "long_words", "short_words",
]

_BYTES = np.arange(256)
_GROUPS = np.stack([np.isin(_BYTES, np.frombuffer(chars, np.uint8)) for chars in (
    bytes(range(65, 91)), bytes(range(48, 58)), b" \t", b"\n\r", b".", b",;:", b"!?", b"|", b"*$&%#~^", b"\"'()[]{}<>/\\=+-_@`",
    bytes(range(128, 256)))]).astype(np.float64)


def features(text: str) -> list[float]:
    """FEATURES of a whole text. An empty one has zeros."""
    data = text.encode("utf-8", "replace")
    if not data:
        return [0.0] * len(FEATURES)
    upper, digits, spaces, breaks, stops, commas, exclaims, bars, marks, other, beyond = (
        _GROUPS @ np.bincount(np.frombuffer(data, np.uint8), minlength=256) / len(data)).tolist()
    tokens, lines = text.split(), text.split("\n")
    n = max(1, len(tokens))
    distinct = set(tokens)
    lengths = list(map(len, distinct))
    m = max(1, len(lengths))
    return [
        np.log1p(len(text)), np.log1p(len(tokens)), (len(text) - text.count(" ")) / n, len(distinct) / n,
        sum(map(eq, tokens, tokens[1:])) / n, upper, digits, spaces, breaks, stops, commas, exclaims, bars, marks, other,
        beyond, len(set(lines)) / len(lines), len(zlib.compress(data, 1)) / len(data),
        sum(x > 15 for x in lengths) / m, sum(x < 4 for x in lengths) / m,
    ]


def _best_cut(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, int]:
    """(gain, cut): bins below `cut` go left. 0, 0 if no cut leaves `least` weight on both sides."""
    if len(g) < 2:
        return 0.0, 0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gt, ht = g.sum(), h.sum()
    gain = gl ** 2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt ** 2 / (ht + 1)
    gain[(hl < least) | (ht - hl < least)] = 0
    at = int(np.argmax(gain))
    return (float(gain[at]), at + 1) if gain[at] > 0 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, least: float) -> np.ndarray:
    """Values per bin of a tree of depth two on one ordered feature."""
    out = np.zeros(len(g))

    def grow(start: int, end: int, depth: int) -> None:
        gain, cut = _best_cut(g[start:end], h[start:end], least) if depth else (0.0, 0)
        if gain:
            grow(start, start + cut, depth - 1)
            grow(start + cut, end, depth - 1)
        else:
            out[start:end] = g[start:end].sum() / (h[start:end].sum() + 1)

    grow(0, len(g), 2)
    return out


def _best_columns(g: np.ndarray, h: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """For each row of sums per bin: what its best cut explains, and the cut; 0 for none."""
    gt, ht = g.sum(1), h.sum(1)
    alone = gt ** 2 / (ht + 1)
    if g.shape[1] < 2:
        return alone, np.zeros(len(g), int)
    gl, hl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1]
    gr, hr = gt[:, None] - gl, ht[:, None] - hl
    both = np.where((hl < least) | (hr < least), -1.0, gl ** 2 / (hl + 1) + gr ** 2 / (hr + 1))
    at = both.argmax(1)
    best = both[np.arange(len(g)), at]
    return np.maximum(best, alone), np.where(best > alone, at + 1, 0)


def _pair_tree(g: np.ndarray, h: np.ndarray, least: float) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree with a cut on the first feature and, in each part, one on the second. All first
    cuts are tried: of an interaction alone, the first cut by itself explains nothing."""
    out = np.zeros_like(g)
    gl, hl = np.cumsum(g, 0), np.cumsum(h, 0)
    low, low_cut = _best_columns(gl, hl, least)  # parts up to each bin; the last is everything
    high, high_cut = _best_columns(gl[-1] - gl[:-1], hl[-1] - hl[:-1], least)
    whole = np.append(low[:-1] + high, low[-1])
    cut = int(whole.argmax())
    parts = [(slice(0, cut + 1), low_cut[cut])] + ([(slice(cut + 1, len(g)), high_cut[cut])] if cut + 1 < len(g) else [])
    for part, second in parts:
        for side in (slice(0, second), slice(second, g.shape[1])) if second else (slice(0, g.shape[1]),):
            out[part, side] = g[part, side].sum() / (h[part, side].sum() + 1)
    return float(whole[cut] - gl[-1].sum() ** 2 / (hl[-1].sum() + 1)), out


@dataclass
class AdditiveModel:
    """A log-odds table per feature and per pair of features; a score adds up one entry of each."""

    intercept: float = 0.0
    cuts: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, x[:, f], "right") for f, c in enumerate(self.cuts)], 1)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if not self.cuts:
            return np.full(len(x), self.intercept)
        b = self.bins(x)
        total = np.full(len(x), self.intercept)
        for f, t in enumerate(self.tables):
            total += t[b[:, f]]
        for i, j, t in self.pairs:
            total += t[b[:, i], b[:, j]]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -50, 50)))


def fit_additive(x: np.ndarray, y: np.ndarray, bins: int = 32, rounds: int = 150, pair_rounds: int = 60, pairs: int = 8,
                 rate: float = 0.1, least: float = 2.0) -> AdditiveModel:
    """Cyclic gradient boosting on the log loss: in each round each feature in turn gets one small tree on its bins,
    which is added to its table, so correlated features share what they explain. Then the pairs whose best tree
    explains most of what is left are boosted in turn likewise. With one class only, a constant."""
    if not len(y):
        return AdditiveModel()
    rows = np.lexsort([*x.T, y])  # the order in which the rows came doesn't matter
    x, y = x[rows], y[rows].astype(np.float64)
    mean = (y.sum() + 0.5) / (len(y) + 1)
    model = AdditiveModel(float(np.log(mean / (1 - mean))))
    if y.min() == y.max():
        return model
    model.cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    b, total = model.bins(x), np.full(len(y), model.intercept)
    for _ in range(rounds):
        for f, t in enumerate(model.tables):
            p = 1 / (1 + np.exp(-total))
            step = rate * _tree(np.bincount(b[:, f], y - p, len(t)), np.bincount(b[:, f], p * (1 - p), len(t)), least)
            t += step
            total += step[b[:, f]]

    def sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        shape = len(model.tables[i]), len(model.tables[j])
        cell = b[:, i] * shape[1] + b[:, j]
        return (np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape),
                np.bincount(cell, p * (1 - p), shape[0] * shape[1]).reshape(shape))

    gains = sorted(((-_pair_tree(*sums(i, j), least)[0], i, j) for i in range(len(b[0])) for j in range(i)))[:pairs]
    model.pairs = [(i, j, np.zeros((len(model.tables[i]), len(model.tables[j])))) for gain, i, j in gains if gain]
    for _ in range(pair_rounds):
        for i, j, t in model.pairs:
            step = rate * _pair_tree(*sums(i, j), least)[1]
            t += step
            total += step[b[:, i], b[:, j]]
    return model


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([features(t or "") for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", text_col: str = "text",
                id_col: str = "doc_id", max_rows: int = MAX_TRAIN_ROWS) -> AdditiveModel:
    """Fitted on whole texts of at most `max_rows` labelled rows, chosen by a hash of id and text; only their features reach
    the driver.

    Rows of `labels` with a null id or label are left out, ids without a document too; a label other than 1 counts as
    0, and repeated rows count as often as they occur, up to that bound. Without rows, every score is 0.5; with one class,
    a constant.
    """
    wanted = labels.select(labels[id_col].alias("id"), (labels[label_col] == 1).cast("int").alias("label")).where(
        "id IS NOT NULL AND label IS NOT NULL")
    # Twice as many as wanted are drawn by their ids; where that is all of them, or copies of an id, the limit decides.
    share = min(1.0, 2 * max_rows / max(1, wanted.count()))
    wanted = wanted.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(
        F.broadcast(wanted) if fits_broadcast(wanted) else wanted, "id").select(
        F.xxhash64("id", "text", "label", F.lit("draw")).alias("draw"), "label", "text")
    schema = pa.schema([pa.field("draw", pa.int64()), pa.field("label", pa.int32()), pa.field("x", pa.list_(pa.float64()))])
    found = map_batches(
        rows, lambda: lambda b: batch(schema, [b.column(0), b.column(1), [features(t or "") for t in b.column(2).to_pylist()]]),
        "draw long, label int, x array<double>").orderBy("draw", "label").limit(max_rows).toArrow()
    x = np.array(found.column("x").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    return fit_additive(x, found.column("label").to_numpy())


def score_quality(df: DataFrame, model: AdditiveModel, threshold: float = 0.3, text_col: str = "text",
                  keep: dict[str, Column] | None = None) -> DataFrame:
    """`keep` columns, score, predicted (1 if score >= threshold, else 0) of every row of `df`.

    Null texts are scored as empty ones. Repeated rows give a row each; other columns of `df` are not looked at.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = df.sparkSession.sparkContext.broadcast(model)
    picked = df.select(df[text_col].alias("_text"), *[c.alias(k) for k, c in (keep or {}).items()])
    kept = picked.drop("_text").schema
    schema = to_arrow_schema(kept).append(pa.field("score", pa.float64())).append(pa.field("predicted", pa.int32()))

    def task():
        def apply(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(0).to_pylist()
            parts = [shared.value.score(_matrix(texts[s:e])) for s, e in chunks([t or "" for t in texts])]
            score = np.concatenate(parts) if parts else np.zeros(0)
            return batch(schema, [*b.columns[1:], score, (score >= threshold).astype("int32")])

        return apply

    types = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in kept)
    return map_batches(picked, task, f"{types}score double, predicted int")


def keep_good(df: DataFrame, model: AdditiveModel, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `df` whose score is at least `threshold`, unchanged, whatever other columns they have."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    at = df.columns.index(text_col)

    def apply(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = b.column(at).to_pylist()
        parts = [shared.value.score(_matrix(texts[s:e])) for s, e in chunks([t or "" for t in texts])]
        return b.filter(pa.array(np.concatenate(parts) >= threshold))

    return map_batches(df, lambda: apply, nullable(df.schema))
