"""Quality by Bradley-Terry pairwise ranking.

Of a pair of documents with different labels the one labelled good is preferred. The
chance of a preference is the logistic of the difference of two document scores, a score
being linear in features of the text; so the weights are those of a logistic regression on
feature differences. A document counts as good if its score is above a quantile of the
scores: that at the share of bad labels. The reported score is the logistic of the
distance to this threshold.

Features are shares and means (kinds of characters, repeated words and lines, word and
line lengths), so they compare texts of any length; they are computed over whole texts.
The ranking is learned from a bounded sample: ``PER_LABEL`` documents of each label and
``PAIRS`` preferences among them.

Null and empty texts have the features of an empty text and are scored like others. With
labels of one kind only every score is that label; with none it is 0.5. Repeated label rows
of a document count once; a document labelled both ways is taken as good.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.llm.samples import class_counts, draw, held_out, remainder
from wattweave.llm.texts import per_text

PER_LABEL = 2500
PAIRS = 40_000

_UPPER, _LOWER_CASE, _DIGIT, _SPACE = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = _LOWER_CASE[97:123] = _DIGIT[48:58] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_SIGNS = [c for c in range(33, 127) if not chr(c).isalnum()]


def features(text: str | None) -> np.ndarray:
    text = text if isinstance(text, str) else ""
    raw = text.encode("utf-8")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n = max(1.0, counts.sum())
    words = text.split()
    lines = [line for line in text.split("\n") if line.strip()]
    letters = max(1.0, counts[_UPPER].sum() + counts[_LOWER_CASE].sum())
    distinct = Counter(words)
    n_words = max(1, len(words))
    bare = [w.strip(".,;:") for w in words]
    kinds = [
        counts[_UPPER].sum() / letters,
        counts[_DIGIT].sum() / n,
        counts[_SPACE].sum() / n,
        counts[128:].sum() / n,
        np.log1p(len(words)),
        np.log1p(len(raw) / n_words),
        np.log1p(len(raw) / max(1, len(lines))),
        1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(len(words)) - np.log1p(len(distinct)),
        max(distinct.values(), default=0) / n_words,
        sum(w.isalpha() for w in bare) / n_words,
        sum(w.isupper() for w in bare) / n_words,
        sum(len(w) == 1 for w in bare) / n_words,
        float(not words),
    ]
    return np.concatenate([kinds, np.sqrt(counts[_SIGNS] / n)])


@dataclass
class PairRanker:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def ranks(self, table: np.ndarray) -> np.ndarray:
        return np.clip((table - self.mean) / self.scale, -8, 8) @ self.weights

    def scores(self, table: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.ranks(table) - self.threshold, -500, 500)))


def fit(table: np.ndarray, labels: np.ndarray, share_bad: float, rounds: int = 500, seed: int = 5) -> PairRanker:
    """Weights from preference pairs, threshold from the score quantile at ``share_bad``."""
    width = table.shape[1] if table.ndim == 2 else len(features(""))
    if len(labels) == 0 or labels.all() or not labels.any():
        whole = 0.0 if len(labels) == 0 else (-30.0 if labels.all() else 30.0)
        return PairRanker(np.zeros(width), np.ones(width), np.zeros(width), whole)
    ranker = PairRanker(table.mean(axis=0), table.std(axis=0) + 1e-6, np.zeros(width), 0.0)
    scaled = np.clip((table - ranker.mean) / ranker.scale, -8, 8)
    rng = np.random.default_rng(seed)
    better = rng.choice(np.flatnonzero(labels == 1), PAIRS)
    worse = rng.choice(np.flatnonzero(labels == 0), PAIRS)
    gap = scaled[better] - scaled[worse]
    mean, square = np.zeros(width), np.zeros(width)
    for turn in range(1, rounds + 1):
        lost = 1 / (1 + np.exp(np.clip(gap @ ranker.weights, -500, 500)))
        slope = -(lost @ gap) / len(gap) + 1e-4 * ranker.weights
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        ranker.weights = ranker.weights - 0.03 * mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
    # The sample has other shares of the labels than all labelled rows: weigh them back.
    ranks = ranker.ranks(table)
    order = np.argsort(ranks, kind="stable")
    weight = np.where(labels == 1, (1 - share_bad) / labels.sum(), share_bad / (len(labels) - labels.sum()))[order]
    below = np.cumsum(weight)
    at = int(np.clip(np.searchsorted(below, share_bad - 1e-9), 0, len(order) - 2))
    ranker.threshold = float(ranks[order[at]] + ranks[order[at + 1]]) / 2
    return ranker


def _feature_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"features": [features(t) for t in batch]})

    return per_text(docs, id_col, text_col, run, "features array<double>")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    divisor: int = 3,
    rest: int = 1,
    per_label: int = PER_LABEL,
) -> PairRanker:
    rows = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    rows = rows.where("label in (0, 1)").where(remainder("id", divisor) != rest)
    rows = rows.groupBy("id").agg(F.max("label").alias("label"))
    counts = class_counts(rows)
    drawn = F.broadcast(draw(rows, counts, per_label))  # bounded by per_label
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(drawn, "id")
    found = _feature_rows(texts.select(F.struct("id", "label").alias("of"), "text"), "of", "text").collect()
    found.sort(key=lambda r: (str(r["of"]["id"]), r["features"]))
    table = np.array([r["features"] for r in found], float)
    return fit(table, np.array([r["of"]["label"] for r in found], int), counts.get(0, 0) / max(1, sum(counts.values())))


def score(docs: DataFrame, ranker: PairRanker, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id and its score."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            table = np.array([features(t) for t in batch]).reshape(len(batch), -1)
            yield pd.DataFrame({"score": ranker.scores(table) if len(batch) else np.empty(0)})

    return per_text(docs, id_col, text_col, run, "score double")


def report(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Per document: the id, held_out, score and predicted."""
    found = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return found.select(id_col, held_out(id_col, 3, 1).alias("held_out"), "score", predicted)
