"""Toxicity classifier with a counterfactual penalty.

A linear model over words and word beginnings. The vocabulary is chosen by how unevenly a term is
spread over toxic and other texts of a bounded labelled sample. For each sample text that names a
group, the names are swapped for another group's; the penalty is the squared change of the margin
that the swap causes. Terms of group names are always part of the vocabulary, so that the penalty
can hold their weights down, and with them the scores of neutral mentions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, whole_text
from .quality import fold, sampled_labels
from .shingles import code_points, mixed, runs, spread_points, word_characters

# The most labelled rows that train a model, and the most terms it looks at.
SAMPLE = 20_000
TERMS = 4_096

# Lengths of word beginnings that count as terms besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)

# Texts of the sample that a term must occur in.
LEAST_TEXTS = 5

RIDGE, COUNTERFACTUAL, STEPS = 0.1, 5.0, 600

# Names of groups that are swapped for one another, by kind. Singular and plural line up.
GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    ("woman", "man"),
    ("women", "men"),
    ("black", "white", "asian", "latino", "arab", "african", "european"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"),
    ("femme", "homme"),
    ("musulman", "chrétien", "juif"),
    ("frau", "mann"),
    ("muslime", "christen", "juden"),
    ("mujer", "hombre"),
    ("musulmán", "cristiano", "judío"),
)
_NEXT = {w: g[(k + 1) % len(g)] for g in GROUPS for k, w in enumerate(g)}
_NAMED = re.compile(r"(?<!\w)(?:" + "|".join(sorted(_NEXT, key=len, reverse=True)) + r")(?!\w)", re.I)


def swapped(text: str) -> str:
    """The text with every group name replaced by the next one of its kind."""
    return _NAMED.sub(lambda m: _NEXT[m[0].lower()], text)


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all terms of the texts, the text each belongs to, and each text's word count."""
    points, begins = code_points([t.lower() for t in texts])
    inside = word_characters()[points]
    starts, ends = runs(inside)
    owner = np.searchsorted(begins, starts, side="right") - 1
    words = np.bincount(owner, minlength=len(texts))
    if not len(starts):
        return np.empty(0, np.uint64), owner, words
    spread = spread_points(points, inside)
    upto = np.concatenate((np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)))
    size = ends - starts
    found, of = [mixed(upto[ends] - upto[starts])], [owner]
    for n in BEGINNINGS:
        long = size > n
        found.append(mixed(upto[starts[long] + n] - upto[starts[long]] + np.uint64(n)))
        of.append(owner[long])
    return np.concatenate(found), np.concatenate(of), words


def group_terms() -> np.ndarray:
    """Hashes of all terms of the group names."""
    return np.unique(terms([" ".join(_NEXT)])[0])


@dataclass(frozen=True)
class Linear:
    """Weights of sorted term hashes, of the text's length, and a constant."""

    vocabulary: np.ndarray
    weights: np.ndarray
    length: float
    constant: float

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Entries (row, column, value) of the texts' terms, and their lengths."""
        return features(texts, self.vocabulary)

    def score(self, texts: list[str]) -> np.ndarray:
        row, column, value, length = self.features(texts)
        margin = np.bincount(row, self.weights[column] * value, len(texts)) if len(row) else np.zeros(len(texts))
        margin += self.length * length + self.constant
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def features(texts: list[str], vocabulary: np.ndarray):
    found, owner, words = terms(texts)
    length = np.log1p(words) / 5
    if not len(vocabulary) or not len(found):
        none = np.empty(0, np.int64)
        return none, none, np.empty(0), length
    # a table over some bits of the hash sorts out nearly all terms at the cost of one look
    known = np.zeros(1 << 18, dtype=bool)
    known[(vocabulary >> np.uint64(46)).astype(np.int64)] = True
    maybe = np.flatnonzero(known[(found >> np.uint64(46)).astype(np.int64)])
    column = np.searchsorted(vocabulary, found[maybe])
    column[column == len(vocabulary)] = 0
    real = vocabulary[column] == found[maybe]
    cell, counts = np.unique(
        owner[maybe[real]] * len(vocabulary) + column[real], return_counts=True
    )
    return cell // len(vocabulary), cell % len(vocabulary), np.log1p(counts), length


def fit(texts_x, y: np.ndarray, swaps, vocabulary: np.ndarray) -> Linear:
    """Logistic regression by accelerated gradient descent on the sample, with a ridge and with
    the mean squared change of the margin under swaps as penalties."""
    row, column, value, length = texts_x
    n, k = len(y), len(vocabulary)
    rate = np.clip(y.mean() if n else 0.5, 0.01, 0.99)
    if len(np.unique(y)) < 2:
        return Linear(vocabulary, np.zeros(k), 0.0, float(np.log(rate / (1 - rate))))
    swap_row, swap_column, swap_value, swap_count = swaps
    w = np.zeros(k + 2)
    w[k + 1] = np.log(rate / (1 - rate))
    ahead = w.copy()

    def curved(v: np.ndarray) -> np.ndarray:
        """An upper bound of the curvature, times v."""
        along = np.bincount(row, v[column] * value, n) + v[k] * length + v[k + 1]
        out = np.empty(k + 2)
        out[:k] = np.bincount(column, along[row] * value, k) / (4 * n) + RIDGE / n * v[:k]
        out[k], out[k + 1] = along @ length / (4 * n), along.sum() / (4 * n)
        if swap_count:
            change = np.bincount(swap_row, v[swap_column] * swap_value, swap_count)
            slopes = np.bincount(swap_column, change[swap_row] * swap_value, k)
            out[:k] += 2 * COUNTERFACTUAL / swap_count * slopes
        return out

    v = np.ones(k + 2) / np.sqrt(k + 2)
    for _ in range(30):  # power iteration for the largest curvature
        v = curved(v)
        bend = np.linalg.norm(v)
        v /= bend
    bend *= 1.2
    speed = 1.0
    for _ in range(STEPS):
        margin = np.bincount(row, ahead[column] * value, n) + ahead[k] * length + ahead[k + 1]
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / n
        slope = np.empty(k + 2)
        slope[:k] = np.bincount(column, error[row] * value, k) + RIDGE / n * ahead[:k]
        slope[k], slope[k + 1] = error @ length, error.sum()
        if swap_count:
            change = np.bincount(swap_row, ahead[swap_column] * swap_value, swap_count)
            slope[:k] += 2 * COUNTERFACTUAL / swap_count * np.bincount(swap_column, change[swap_row] * swap_value, k)
        new = ahead - slope / bend
        faster = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        ahead = new + (speed - 1) / faster * (new - w)
        w, speed = new, faster
    return Linear(vocabulary, w[:k], float(w[k]), float(w[k + 1]))


def _counts(rows: DataFrame) -> DataFrame:
    """(term, texts, toxic): in how many texts of the sample each term occurs."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                found, owner, _ = terms(part["text"].tolist())
                each = pd.DataFrame({"term": found.view(np.int64), "owner": owner}).drop_duplicates()
                each["toxic"] = part["y"].to_numpy()[each["owner"]]
                out = each.groupby("term").agg(texts=("toxic", "size"), toxic=("toxic", "sum"))
                yield out.reset_index()

    found = rows.mapInPandas(count, "term long, texts long, toxic double")
    return found.groupBy("term").agg(F.sum("texts").alias("texts"), F.sum("toxic").alias("toxic"))


def train(rows: DataFrame, most_terms: int = TERMS) -> Linear:
    """A model from a bounded table of (text, y)."""
    totals = rows.agg(F.count(F.lit(1)), F.sum("y")).first()
    n, positive = totals[0], totals[1] or 0.0
    share = positive / n if n else 0.5
    expected = F.col("texts") * share
    uneven = (F.col("toxic") - expected) ** 2 / (expected * (1 - share) + 1)
    listed = (
        _counts(rows)
        .where(F.col("texts") >= LEAST_TEXTS)
        .orderBy(uneven.desc(), "term")
        .limit(most_terms)
        .toPandas()["term"]
    )
    vocabulary = np.union1d(listed.to_numpy(dtype=np.int64).view(np.uint64), group_terms())

    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Per text its features, and the change that swapping group names makes to them."""
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                texts = part["text"].tolist()
                out = pd.DataFrame({"y": part["y"].to_numpy()})
                other = [swapped(t) for t in texts]
                (r, c, v, length), (r2, c2, v2, _) = features(texts, vocabulary), features(other, vocabulary)
                out["length"] = length
                out["columns"], out["values"] = _per_row(r, c, v, len(texts))
                diff = pd.DataFrame({"r": np.concatenate((r, r2)), "c": np.concatenate((c, c2)), "v": np.concatenate((v, -v2))})
                diff = diff.groupby(["r", "c"], as_index=False)["v"].sum()
                diff = diff[diff["v"].abs() > 1e-12]
                out["swap_columns"], out["swap_values"] = _per_row(
                    diff["r"].to_numpy(), diff["c"].to_numpy(), diff["v"].to_numpy(), len(texts)
                )
                yield out

    schema = (
        "y double, length double, columns array<long>, values array<double>, "
        "swap_columns array<long>, swap_values array<double>"
    )
    sample = rows.mapInPandas(entries, schema).toPandas()  # as long as the bounded sample
    swapping = sample[sample["swap_columns"].str.len() > 0]
    return fit(
        (*_flat(sample["columns"], sample["values"]), sample["length"].to_numpy(dtype=float)),
        sample["y"].to_numpy(dtype=float),
        (*_flat(swapping["swap_columns"], swapping["swap_values"]), len(swapping)),
        vocabulary,
    )


def _per_row(row: np.ndarray, column: np.ndarray, value: np.ndarray, n: int) -> tuple[list, list]:
    cuts = np.searchsorted(row, np.arange(1, n))
    return np.split(column, cuts), np.split(value, cuts)


def _flat(columns: pd.Series, values: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(c) for c in columns], dtype=int)
    row = np.repeat(np.arange(len(columns)), sizes)
    if not sizes.sum():
        return row, np.empty(0, np.int64), np.empty(0)
    return row, np.concatenate(columns.tolist()).astype(np.int64), np.concatenate(values.tolist())


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: id, held_out, score and predicted (score of 0.7 or more).

    Trained on at most ``sample`` labelled rows whose crc32(id) modulo 3 is not 1. Null and empty
    texts are scored from the constant alone. Without labels, or with one class only, all scores
    are equal. Repeated rows get equal scores; an empty table gives an empty result.
    """
    scratch = Scratch(docs.sparkSession)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), whole_text(f"`{text_col}`").alias("text")
    )
    held = fold(3, 1)
    chosen = sampled_labels(labels, id_col, label, held, sample)
    # one text per sampled identifier and label, however often the table repeats it
    labelled = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "y")
    train_rows = scratch.write(labelled.agg(F.min("text").alias("text")).select("text", "y"))
    model = train(train_rows)
    scratch.drop(train_rows)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                out = part[["doc_id", "held_out"]].copy()
                out["score"] = model.score(part["text"].tolist())
                yield out

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.select("doc_id", held.alias("held_out"), "text").mapInPandas(
        score, f"doc_id {kind}, held_out boolean, score double"
    )
    return scored.select(
        F.col("doc_id").alias(id_col),
        "held_out",
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )
