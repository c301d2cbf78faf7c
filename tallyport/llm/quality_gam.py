"""Quality classifier: an additive model of lookup tables with pairwise interactions.

Features of a text are numbers; each is cut into at most BINS quantile bins. Training goes
round the features in a cycle and fits a shallow tree to the gradient over one feature's
bins at a time, adding its leaves, shrunk, to that feature's table. Then the pair whose
shallow tree over both features lowers the loss most gets a table of its own in the same
way; pairs are ranked again before each of PAIRS is added. A pair's tree has up to two cuts
of each axis, so a band of one feature can meet a band of another. A score is the sum of one bin of each table, looked up for
whole columns at once.

The model is fitted on at most TRAIN_ROWS labelled rows, the ones with the smallest hash of
doc_id. `digest` stores the features of all documents and learns from those rows;
`keep_good` computes the features of the labelled rows to learn, and scores texts where
they lie. Everything else covers all documents.

Defined results: NULL and empty texts have the features of a text without words and get
the score those lead to; labels that are NULL or not 0 or 1 are left out, a doc_id that is labelled
twice counts twice; without labels of both kinds the score is the share of label 1, 0.5
without any; rows that repeat are scored each; an empty table gives an empty result; other
columns are not read by `score` and pass through `keep_good`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyport.llm.common import map_arrow, stored
from tallyport.llm.rule_ledger import measure

TRAIN_ROWS = 20_000
HOLD_OUT = "pmod(crc32(cast(cast(doc_id AS string) AS binary)), 3) = 1"
BINS = 32
ROUNDS = 120
PAIRS = 6
PAIR_ROUNDS = 40
PAIR_BINS = 16
LEAVES = 3
RATE = 0.15
PENALTY = 1.0  # added to a leaf's weight: leaves of few rows stay small

FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "upper", "letters", "digits", "distinct",
    "line_words", "longest_word", "stops", "bangs", "short_lines",
)


def features(text: str) -> tuple[float, ...]:
    """FEATURES of one text; all 0 where there is nothing to count."""
    n_words, chars, symbols, n_lines, dup_lines, repeats, upper, letters = measure(text)
    if not n_words:
        return (0.0,) * len(FEATURES)
    words = text.split()
    lines = text.split("\n")
    return (
        math.log1p(n_words), chars / n_words, symbols / n_words, dup_lines / n_lines, repeats / n_words,
        upper / max(letters, 1), letters / chars, sum(map(text.count, "0123456789")) / chars,
        len(set(words)) / max(len(words), 1), n_words / n_lines, max(map(len, words), default=0),
        (text.count(".") + text.count(",")) / n_words, (text.count("!") + text.count("?")) / n_words,
        sum(1 for line in lines if 0 < len(line) < 20) / len(lines),
    )


@dataclass
class Gam:
    """Tables of an additive model; `edges` cut each feature into bins."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)], 1)

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        if self.tables:
            fine = self.bins(x, self.edges)
            for i, table in enumerate(self.tables):
                total += table[fine[:, i]]
        if self.pairs:
            coarse = self.bins(x, self.coarse)
            for (a, b), table in zip(self.pairs, self.pair_tables):
                total += table[coarse[:, a], coarse[:, b]]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logit(x)))


def quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + PENALTY)


def grow(g: np.ndarray, h: np.ndarray, leaves: int = LEAVES) -> np.ndarray:
    """Leaf values by bin of a tree over one feature: the best cut, then the best cut of a part."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        best = None
        for start, end in parts:
            left_g, left_h = np.cumsum(g[start:end])[:-1], np.cumsum(h[start:end])[:-1]
            if not len(left_g):
                continue
            all_g, all_h = g[start:end].sum(), h[start:end].sum()
            gains = gain(left_g, left_h) + gain(all_g - left_g, all_h - left_h) - gain(all_g, all_h)
            at = int(gains.argmax())
            if gains[at] > 1e-9 and (best is None or gains[at] > best[0]):
                best = (gains[at], start, start + at + 1, end)
        if best is None:
            break
        _, start, cut, end = best
        parts.remove((start, end))
        parts += [(start, cut), (cut, end)]
    out = np.zeros(len(g))
    for start, end in parts:
        out[start:end] = g[start:end].sum() / (h[start:end].sum() + PENALTY)
    return out


@cache
def axis_parts(size: int) -> np.ndarray:
    """Every way of cutting `size` bins once or twice: (way, part, bin), 1 where the bin is in the part."""
    ways = []
    for first in range(1, size):
        for second in range(first, size):
            part = np.zeros((3, size))
            part[0, :first], part[1, first:second], part[2, second:] = 1, 1, 1
            ways.append(part)
    return np.array(ways).reshape(-1, 3, size)


def grow_pair(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """Values by cell of a tree with one or two cuts of each axis, and what it gains: the best of all such trees."""
    rows, columns = axis_parts(g.shape[0]), axis_parts(g.shape[1])
    if not len(rows) or not len(columns):
        return np.zeros(g.shape), 0.0
    sums = lambda t: (rows.reshape(-1, g.shape[0]) @ t @ columns.reshape(-1, g.shape[1]).T).reshape(len(rows), 3, len(columns), 3)
    part_g, part_h = sums(g), sums(h)
    total = gain(part_g, part_h).sum(axis=(1, 3)) - gain(g.sum(), h.sum())
    i, j = np.unravel_index(int(total.argmax()), total.shape)
    values = part_g[i, :, j] / (part_h[i, :, j] + PENALTY)
    return rows[i].T @ values @ columns[j], float(total[i, j])


def fit(x: np.ndarray, y: np.ndarray) -> Gam:
    """Cyclic boosting of the features' tables, then of the best pairs' tables."""
    share = float(y.mean()) if len(y) else 0.5
    if share in (0.0, 1.0) or not len(y):
        return Gam(base=math.log((share + 1e-6) / (1 - share + 1e-6)))
    model = Gam(base=math.log(share / (1 - share)))
    model.edges = [quantile_edges(x[:, i], BINS) for i in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = model.bins(x, model.edges)
    logit = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * grow(
                np.bincount(fine[:, i], g, len(table)), np.bincount(fine[:, i], h, len(table))
            )
            table += step
            logit += step[fine[:, i]]

    model.coarse = [quantile_edges(x[:, i], PAIR_BINS) for i in range(x.shape[1])]
    coarse = model.bins(x, model.coarse)
    size = [len(e) + 1 for e in model.coarse]

    def cells(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = slopes()
        cell, n = coarse[:, a] * size[b] + coarse[:, b], size[a] * size[b]
        return np.bincount(cell, g, n).reshape(size[a], size[b]), np.bincount(cell, h, n).reshape(size[a], size[b])

    def boost(rounds: int) -> None:
        for _ in range(rounds):
            for (a, b), table in zip(model.pairs, model.pair_tables):
                step = RATE * grow_pair(*cells(a, b))[0]
                table += step
                logit[:] += step[coarse[:, a], coarse[:, b]]

    for _ in range(PAIRS):
        left = [(a, b) for a in range(len(size)) for b in range(a) if (a, b) not in model.pairs]
        most, pair = max(((grow_pair(*cells(*p))[1], p) for p in left), default=(0.0, None))
        if most <= 0:
            break
        model.pairs.append(pair)
        model.pair_tables.append(np.zeros((size[pair[0]], size[pair[1]])))
        boost(PAIR_ROUNDS // PAIRS)
    boost(PAIR_ROUNDS - PAIR_ROUNDS // PAIRS)
    return model


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = np.array([features(t.as_py() or "") for t in batch.column(1)]).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(rows[:, i]) for i in range(len(FEATURES)))], names=["doc_id", *FEATURES]
        )


def feature_rows(docs: DataFrame) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{f} double" for f in FEATURES)
    return stored(map_arrow(slim, _feature_batches, schema), "features")


def sample(labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, y) of at most `most` labelled rows that are not held out."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).filter(
        f"y IN (0, 1) AND doc_id IS NOT NULL AND NOT ({HOLD_OUT})"
    )
    return usable.orderBy(F.xxhash64("doc_id"), "doc_id", "y").limit(most)


def train(rows: DataFrame, chosen: DataFrame, most: int = TRAIN_ROWS) -> Gam:
    """Fit on the feature rows that `chosen` labels."""
    found = rows.join(chosen, "doc_id").orderBy("doc_id", "y", *FEATURES).limit(2 * most).toPandas()
    return fit(found[list(FEATURES)].to_numpy(float).reshape(-1, len(FEATURES)), found["y"].to_numpy(float))


def score(rows: DataFrame, model: Gam) -> DataFrame:
    """doc_id, held_out, score, predicted from stored features."""
    shipped = rows.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(i + 1).to_numpy() for i in range(len(FEATURES))], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shipped.value.probability(x))], names=["doc_id", "score"]
            )

    return map_arrow(rows, work, "doc_id long, score double").select(
        "doc_id", F.coalesce(F.expr(HOLD_OUT), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    rows = feature_rows(docs)
    return score(rows, train(rows, sample(labels)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` without the documents that are predicted 0. Texts are scored where they lie."""
    chosen = stored(sample(labels), "sample")
    # At most TRAIN_ROWS ids: the texts that go with them are found without a shuffle.
    ids = F.broadcast(chosen.select(F.col("doc_id").alias("labelled")).distinct())
    learnt = docs.join(ids, F.col("doc_id").cast("long") == F.col("labelled"), "left_semi")
    model = train(feature_rows(learnt), chosen)
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def good(texts):
        x = np.array([features(t or "") for t in texts]).reshape(-1, len(FEATURES))
        return type(texts)(shipped.value.probability(x) >= 0.5)

    return docs.filter(good(F.col("text")))
