"""Document quality by a generalised additive model with pairwise interactions.

Features of a text are cut into quantile bins. Boosting cycles over the features: each step fits
a shallow tree on one feature's bins to the gradient of the logistic loss and adds a small part of
it to that feature's lookup table. Then the pairs of features whose joint bins explain most of the
remaining gradient get tables of their own, boosted in the same cyclic way (Lou et al., KDD 2013).
The model is the tables; a document's score is the sum of one entry per table.

Features come from one vectorised pass over the text. The tables are learnt from a bounded sample
of labelled rows, drawn by a hash of their id.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendspark.llm import textscan
from spendspark.llm.sampling import smallest_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FEATURES = [
    "log_words",
    "upper_share",
    "symbol_share",
    "exclamation_share",
    "pipe_share",
    "digit_share",
    "comma_stop_per_word",
    "high_share",
    "mean_word",
    "longest_word_log",
    "words_per_line",
    "equal_neighbours",
    "repeated_shingles",
    "repeated_lines",
    "distinct_words",
    "words_with_symbols",
]
# Labelled rows that the tables are learnt from, at most.
SAMPLE_ROWS = 30_000
BINS = 32
ROUNDS = 300
PAIR_ROUNDS = 100
PAIRS = 8
RATE = 0.1
LEAVES = 4
# Weight every leaf's value is shrunk by, in rows.
SHRINK = 5.0
# A leaf has at least so many rows.
LEAST_ROWS = 10


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, features) of whole texts; all zeros for a text without words."""
    n = len(offsets) - 1
    runs = textscan.Runs(data, offsets, ~textscan.IS_SPACE)
    words = np.maximum(runs.count, 1)
    length = runs.end - runs.start
    chars = np.maximum(runs.sums(length), 1)
    hashes = runs.hashes()

    def share(chars_of: str) -> np.ndarray:
        return textscan.class_counts(data, offsets, textscan.byte_table(chars_of)) / chars

    letters = np.maximum(textscan.class_counts(data, offsets, textscan.IS_LETTER), 1)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (runs.doc[1:] == runs.doc[:-1])
    longest = np.zeros(n)
    np.maximum.at(longest, runs.doc, length)
    odd = textscan.range_counts(textscan.byte_table("#*$%&|<>!{}[]=\\^~_")[data], runs.start, runs.end) > 0
    lines = textscan.Runs(data, offsets, ~textscan.IS_BREAK)
    docs, values = textscan.shingles(runs, hashes, 5, whole=False)
    out = np.column_stack(
        [
            np.log1p(runs.count),
            textscan.class_counts(data, offsets, textscan.IS_UPPER) / letters,
            share("#*$%&<>"),
            share("!"),
            share("|"),
            textscan.class_counts(data, offsets, textscan.IS_DIGIT) / chars,
            share(",.") * chars / words,
            textscan.class_counts(data, offsets, textscan.IS_HIGH) / chars,
            chars / words,
            np.log1p(longest),
            runs.count / np.maximum(lines.count, 1),
            runs.sums(same) / words,
            _repeated(docs, values, n),
            _repeated(lines.doc, lines.hashes(), n),
            1.0 - _repeated(runs.doc, hashes, n),
            runs.sums(odd.astype(float)) / words,
        ]
    )
    out[runs.count == 0] = 0.0
    return out


def _repeated(docs: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Per document, the share of values that occur before."""
    total = np.bincount(docs, minlength=n)
    fresh = np.bincount(textscan.distinct(docs, values)[0], minlength=n)
    return (total - fresh) / np.maximum(total, 1)


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = textscan.text_bytes(batch.column(1))
        for lo, hi in textscan.slices(offsets):
            at = offsets[lo : hi + 1]
            x = features(data[at[0] : at[-1]], at - at[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *map(pa.array, x.T)], ["id", *FEATURES]
            )


def text_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of features per document: id and the columns in FEATURES."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_feature_task, f"id {kind}, " + ", ".join(f"{c} double" for c in FEATURES))


@dataclass
class Additive:
    """Bin edges per feature, one lookup table per feature and one per chosen pair."""

    edges: list[np.ndarray]
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(self.edges)])

    def logit(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for i, table in enumerate(self.tables):
            out += table[bins[:, i]]
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            out += table[bins[:, i], bins[:, j]]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.logit(self.bins(np.nan_to_num(x)))))


def _split(gradient: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int) -> list[tuple[int, int]]:
    """Ranges of bins of a shallow tree: each step splits the range that gains most."""
    parts, sums = [(0, len(rows))], [np.append(0.0, np.cumsum(v)) for v in (gradient, weight, rows)]
    while len(parts) < leaves:
        best = (1e-9, 0, 0)
        for k, (lo, hi) in enumerate(parts):
            cut = np.arange(lo + 1, hi)
            if not len(cut):
                continue
            (gl, hl, nl), (gr, hr, nr) = ([s[cut] - s[lo] for s in sums], [s[hi] - s[cut] for s in sums])
            whole = (sums[0][hi] - sums[0][lo]) ** 2 / (sums[1][hi] - sums[1][lo] + SHRINK)
            gain = gl**2 / (hl + SHRINK) + gr**2 / (hr + SHRINK) - whole
            gain[(nl < LEAST_ROWS) | (nr < LEAST_ROWS)] = 0.0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), k, int(cut[at]))
        if not best[2]:
            break
        lo, hi = parts.pop(best[1])
        parts += [(lo, best[2]), (best[2], hi)]
    return parts


def _pair_step(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best four-quadrant tree on joint bins: its gain and its values."""
    cg, ch = (np.pad(v.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for v in (g, h))

    def quadrants(c):
        a = c[1:-1, 1:-1]
        return a, c[1:-1, -1:] - a, c[-1:, 1:-1] - a, c[-1, -1] - c[1:-1, -1:] - c[-1:, 1:-1] + a

    qg, qh = quadrants(cg), quadrants(ch)
    if not qg[0].size:
        return 0.0, np.zeros_like(g)
    gain = sum(x**2 / (y + SHRINK) for x, y in zip(qg, qh, strict=True))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = np.empty_like(g)
    for part, (x, y) in zip(
        [(slice(None, i + 1), slice(None, j + 1)), (slice(None, i + 1), slice(j + 1, None)),
         (slice(i + 1, None), slice(None, j + 1)), (slice(i + 1, None), slice(j + 1, None))],
        zip(qg, qh, strict=True), strict=True,
    ):
        values[part] = x[i, j] / (y[i, j] + SHRINK)
    return float(gain[i, j]), values


def train(x: np.ndarray, label: np.ndarray, rounds: int = ROUNDS, pairs: int = PAIRS) -> Additive:
    """Cyclic boosting; with one class only, or no rows, the model is a constant."""
    x = np.nan_to_num(x)
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) if len(c) else np.zeros(0) for c in x.T]
    positive = (label.sum() + 1.0) / (len(label) + 2.0)
    model = Additive(edges, float(np.log(positive / (1 - positive))), [np.zeros(len(e) + 1) for e in edges])
    if len(np.unique(label)) < 2:
        return model
    bins = model.bins(x)
    logit = model.logit(bins)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-logit))
        return label - p, p * (1 - p)

    counts = [np.bincount(bins[:, i], minlength=len(t)) for i, t in enumerate(model.tables)]
    for _ in range(rounds):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            g, h = (np.bincount(bins[:, i], weights=v, minlength=len(table)) for v in (g, h))
            step = np.zeros(len(table))
            for lo, hi in _split(g, h, counts[i], LEAVES):
                step[lo:hi] = RATE * g[lo:hi].sum() / (h[lo:hi].sum() + SHRINK)
            table += step
            logit += step[bins[:, i]]
    g, h = slopes()
    shape = [len(t) for t in model.tables]
    joint = lambda i, j: bins[:, i] * shape[j] + bins[:, j]

    def histogram(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(joint(i, j), weights=v, minlength=shape[i] * shape[j]).reshape(shape[i], shape[j])

    ranked = sorted(
        ((-_pair_step(histogram(i, j, g), histogram(i, j, h))[0], i, j) for i in range(len(shape)) for j in range(i)),
    )
    model.pairs = [(i, j) for _, i, j in ranked[:pairs]]
    model.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in model.pairs]
    for _ in range(min(rounds, PAIR_ROUNDS)):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            step = RATE * _pair_step(histogram(i, j, g), histogram(i, j, h))[1]
            table += step
            logit += step[bins[:, i], bins[:, j]]
    return model


def fit(feats: DataFrame, labels: DataFrame, learn: Column, label_col: str, id_col: str = "doc_id",
        sample_rows: int = SAMPLE_ROWS) -> Additive:
    """Learn from at most ``sample_rows`` labelled rows where ``learn`` (over ``id``) holds.

    Those with the smallest hashes of their id are used; rows without a label or id are not.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label")).where(
        "id is not null and label is not null"
    )
    rows = feats.join(marked, "id").where(learn)
    drawn = smallest_hashes(rows, sample_rows, F.xxhash64(F.lit(5), "id"), "id", *FEATURES, "label")
    sample = drawn.select(*FEATURES, "label").toPandas()
    return train(sample[FEATURES].to_numpy(dtype=float), sample["label"].to_numpy(dtype=float))


def score(feats: DataFrame, model: Additive) -> DataFrame:
    """(id, score) per row: the probability of label 1.

    A null, empty or blank text has all features 0 and gets the score of that. Every row keeps its
    place: repeated rows score alike, an empty table gives an empty result.
    """
    parts = (model.edges, model.base, model.tables, model.pairs, model.pair_tables)
    sent = feats.sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("double")
    def probability(*columns: pd.Series) -> pd.Series:
        return pd.Series(Additive(*sent.value).probability(np.column_stack([c.to_numpy(dtype=float) for c in columns])))

    return feats.select("id", probability(*FEATURES).alias("score"))
