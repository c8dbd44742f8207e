"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics of every document are computed once, in parallel. A bounded sample of labelled
rows trains the trees: each statistic is cut into at most ``BINS`` bins at the sample's quantiles,
and each split is found from sums of gradients per bin. The fitted trees are complete binary
trees laid out in flat arrays, so scoring walks all trees for all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, whole_text, without_keys
from .statistics import NAMES, statistics

# The most labelled rows that train a model; which ones is decided by a hash of the identifier.
SAMPLE = 20_000

BINS, DEPTH, TREES = 64, 4, 60
RATE, RIDGE, LEAST_ROWS = 0.15, 1.0, 10

# Scores from here on are predictions of label 1.
ACCEPT = 0.7


@dataclass(frozen=True)
class Trees:
    """Flat trees: node k of a tree has the children 2k+1 and 2k+2; the leaves come last."""

    base: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    cut: np.ndarray  # go right if the value is larger
    leaf: np.ndarray  # (trees, 2**depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(self.feature):
            return np.full(len(x), self.base)
        inner = self.feature.shape[1]
        tree = np.arange(len(self.feature))
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(tree)), dtype=np.int64)
        for _ in range(int(np.log2(inner + 1))):
            right = x[row, self.feature[tree, node]] > self.cut[tree, node]
            node = 2 * node + 1 + right
        return self.base + self.leaf[tree, node - inner].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees for labels 0 and 1. With one class, or no rows, a constant score."""
    rate = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
    base = float(np.log(rate / (1 - rate)))
    inner, count = 2**DEPTH - 1, x.shape[1]
    none = Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if len(np.unique(y)) < 2:
        return none
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(count)]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    margin = np.full(len(y), base)
    features, values, leaves = [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        feature, cut = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(len(y), dtype=np.int64)
        for depth in range(DEPTH):
            start, width = 2**depth - 1, 2**depth
            at = node - start
            best = np.full(width, 1e-6)
            for j in range(count):
                slot = at * BINS + binned[:, j]
                g, h, n = (
                    np.bincount(slot, weights, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    for weights in (grad, hess, None)
                )
                all_g, all_h, all_n = g[:, -1:], h[:, -1:], n[:, -1:]
                gain = g**2 / (h + RIDGE) + (all_g - g) ** 2 / (all_h - h + RIDGE) - all_g**2 / (all_h + RIDGE)
                gain[(n < LEAST_ROWS) | (all_n - n < LEAST_ROWS)] = 0
                gain[:, len(cuts[j]) :] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(width), top] > best
                for k in np.flatnonzero(better):
                    best[k] = gain[k, top[k]]
                    feature[start + k], cut[start + k] = j, cuts[j][top[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        at = node - inner
        g, h = (np.bincount(at, w, inner + 1) for w in (grad, hess))
        leaf = -RATE * g / (h + RIDGE)
        margin += leaf[at]
        features.append(feature)
        values.append(cut)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(values), np.array(leaves))


def text_statistics(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, key, x): the statistics of every row's whole text."""

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 200):
                part = batch.iloc[at : at + 200]
                x = statistics(part["text"].tolist())
                yield pd.DataFrame(
                    {"doc_id": part["doc_id"], "key": part["key"].to_numpy(), "x": list(x)}
                )

    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text")
    ).withColumn("key", F.xxhash64("doc_id", "text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(measure, f"doc_id {kind}, key long, x array<double>")


def fold(of: int, held: int) -> Column:
    """Whether the row is held out: crc32 of the identifier as text, modulo ``of``."""
    out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(of)) == held
    return F.coalesce(out, F.lit(False))


def sampled_labels(labels: DataFrame, id_col: str, label: str, held: Column, most: int) -> DataFrame:
    """Up to ``most`` labelled rows that are not held out, as (doc_id, y)."""
    return (
        labels.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{label}`").cast("double").alias("y"))
        .where("doc_id is not null and y is not null")
        .where(~held)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "y")
        .limit(most)
    )


def _scored(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, sample: int
) -> DataFrame:
    """(doc_id, key, held_out, score) of every row."""
    scratch = Scratch(docs.sparkSession)
    measured = scratch.write(text_statistics(docs, id_col, text_col))
    held = fold(4, 2)
    chosen = sampled_labels(labels, id_col, label, held, sample)
    train = measured.join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "y", "key").limit(sample)
    train = train.select("x", "y").toPandas()  # bounded by ``sample``
    x = np.array(train["x"].tolist()).reshape(len(train), len(NAMES))
    model = fit(x, train["y"].to_numpy(dtype=float))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["x"].tolist()).reshape(len(batch), len(NAMES))
            out = batch[["doc_id", "key", "held_out"]].copy()
            out["score"] = model.score(x)
            yield out

    kind = measured.schema["doc_id"].dataType.simpleString()
    return measured.select("doc_id", "key", held.alias("held_out"), "x").mapInPandas(
        score, f"doc_id {kind}, key long, held_out boolean, score double"
    )


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score and predicted (score of 0.7 or more).

    Trained on at most ``sample`` labelled rows whose crc32(id) modulo 4 is not 2. Null and empty
    texts have statistics of zero and are scored like any other. Without labels, or with one
    class only, every score is the share of label 1 (a half without labels). Repeated rows get
    equal scores; an empty table gives an empty result.
    """
    return _scored(docs, labels, id_col, text_col, label, sample).select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def drop_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is 0.7 or more, with all their columns."""
    scratch = Scratch(docs.sparkSession)
    scored = _scored(docs, labels, "doc_id", "text", "quality", SAMPLE)
    gone = scratch.write(scored.where(F.col("score") < ACCEPT).select("key").distinct())
    return without_keys(docs, gone)
