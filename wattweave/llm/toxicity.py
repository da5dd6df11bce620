"""Toxicity by character n-grams scaled with naive Bayes log-count ratios.

A text is lower-cased; its features are the presence of the character n-grams of 3 to 6
characters, hashed to 22 bits. From labelled texts every n-gram gets the log ratio of its
smoothed frequency in toxic and other documents. The n-grams whose ratio is far from
chance are kept, and logistic regression is trained on presence times ratio. A text's
score is the logistic of the sum over its own n-grams, so a long text is not diluted.

The classifier is fitted on a bounded sample, ``per_label`` documents of each label with their
whole texts, and keeps the ``kept`` n-grams farthest from chance; the intercept is then set for the
labels' true shares. Texts stay in the tasks, which count n-grams and look the kept ones up; the driver gets
the kept n-grams and the places of those in each sampled text. Scoring reads every character of every text.

Null and empty texts have no n-grams and get the score of the intercept. With labels of
one kind only every score is that label; with none it is 0.5. Repeated label rows of a
document count once; a document labelled both ways is taken as toxic. N-grams equally far
from chance are taken in the order of their hashes. Repeated documents are scored row by row, an empty
table gives an empty result, and other columns of the tables play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.llm.samples import class_counts, draw, held_out, remainder
from wattweave.llm.texts import column, per_text
from wattweave.session import discard, durable

ORDERS = (3, 4, 5, 6)
BITS = 22
KEPT = 4096
FAR = 4.0
PER_LABEL = 2500
PARTS = 16
CHUNK = 1 << 20
_FACTOR = np.uint32(0x9E3779B1)


def _buckets(text: str, wanted: np.ndarray | None = None) -> np.ndarray:
    """Distinct hashed n-grams of a text; those marked in ``wanted`` only, if given."""
    found = []
    lowered = text.lower()
    for at in range(0, max(1, len(lowered)), CHUNK):
        # chunks overlap, so that every n-gram lies in one of them
        points = np.frombuffer(lowered[at : at + CHUNK + max(ORDERS) - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
        rolled = np.zeros(len(points), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if n > len(points):
                break
            size = len(points) - n + 1
            rolled = (rolled[:size] + points[n - 1 :] + np.uint32(n)) * _FACTOR
            rolled ^= rolled >> np.uint32(15)
            if n in ORDERS:
                hashed = rolled & np.uint32((1 << BITS) - 1)
                found.append(np.unique(hashed if wanted is None else hashed[wanted[hashed]]))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.uint32)


@dataclass
class RatioClassifier:
    buckets: np.ndarray
    weights: np.ndarray
    intercept: float

    def scores(self, texts: Iterator[str | None]) -> np.ndarray:
        weight = np.zeros(1 << BITS, np.float32)
        weight[self.buckets] = self.weights
        wanted = np.zeros(1 << BITS, bool)
        wanted[self.buckets] = True
        sums = [
            float(weight[_buckets(t, wanted)].sum(dtype=np.float64)) if isinstance(t, str) and len(self.buckets) else 0.0
            for t in texts
        ]
        return 1 / (1 + np.exp(-np.clip(np.array(sums, float) + self.intercept, -500, 500)))


def _plain(labels_seen: bool, toxic: bool = False) -> RatioClassifier:
    """Without labels every score is 0.5; with those of one kind it is that label."""
    return RatioClassifier(np.empty(0, np.uint32), np.empty(0), 30.0 * (1 if toxic else -1) if labels_seen else 0.0)


def ngram_counts(sample: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): documents of each label with the n-gram, from rows (label, text).

    A task adds its documents up before it sends anything: at most a row per bucket.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        toxic, clean = np.zeros(1 << BITS, np.int32), np.zeros(1 << BITS, np.int32)
        for batch in batches:
            for label, text in zip(batch["label"], batch["text"]):
                (toxic if label else clean)[_buckets(text)] += 1
        seen = np.flatnonzero((toxic > 0) | (clean > 0))
        for at in range(0, len(seen), CHUNK):
            part = seen[at : at + CHUNK]
            yield pd.DataFrame({"bucket": part.astype(np.int32), "toxic": toxic[part], "clean": clean[part]})

    found = sample.select("label", "text").mapInPandas(count, "bucket int, toxic int, clean int")
    return found.groupBy("bucket").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def far_ratios(counts: DataFrame, n1: int, n0: int, kept: int) -> DataFrame:
    """(bucket, ratio) of the ``kept`` n-grams whose log-count ratio is farthest from chance, in its standard errors."""
    positive, negative = F.col("toxic") + 1.0, F.col("clean") + 1.0
    ratio = F.log(positive) - F.log(F.lit(n1 + 2.0)) - F.log(negative) + F.log(F.lit(n0 + 2.0))
    distance = F.abs(F.col("ratio")) / F.sqrt(1 / positive + 1 / negative)
    rated = counts.withColumn("ratio", ratio).withColumn("distance", distance).where(F.col("distance") > FAR)
    return rated.orderBy(F.desc("distance"), "bucket").limit(kept).select("bucket", "ratio")


def fit(sample: DataFrame, share: float, kept: int = KEPT, rounds: int = 400) -> RatioClassifier:
    """From rows (id, label, text) with labels 0 and 1; ``share`` is that of label 1 among all labelled rows."""
    sizes = class_counts(sample)
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return _plain(n1 + n0 > 0, n1 > 0)
    found = sorted((r["bucket"], r["ratio"]) for r in far_ratios(ngram_counts(sample), n1, n0, kept).collect())
    buckets, ratio = np.array([b for b, _ in found], np.uint32), np.array([r for _, r in found], float)
    shift = float(np.log(share / (1 - share)))
    if not found:
        return RatioClassifier(buckets, ratio, shift)

    def places(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        wanted = np.zeros(1 << BITS, bool)
        wanted[buckets] = True
        for batch in batches:
            yield pd.DataFrame({"places": [np.searchsorted(buckets, _buckets(t, wanted)).astype(np.int32) for t in batch]})

    held = sample.select("id", "label", column(places, "places array<int>", sample["text"]).alias("found"))
    rows = sorted(held.collect(), key=lambda r: (str(r["id"]), r["found"]["places"]))
    labels = np.array([r["label"] for r in rows], float)
    columns = np.concatenate([np.array(r["found"]["places"], int) for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r["found"]["places"]) for r in rows])
    weights, intercept = _logistic(row, columns, ratio[columns], labels, len(buckets), rounds)
    return RatioClassifier(buckets, weights * ratio, float(intercept + shift - np.log(n1 / n0)))


def _logistic(rows, columns, values, labels, width: int, rounds: int, strength: float = 1e-3):
    """Ridge-penalised logistic regression by gradient steps with momentum (Adam)."""
    weights, intercept = np.zeros(width), 0.0
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    n = len(labels)
    for turn in range(1, rounds + 1):
        margin = np.bincount(rows, values * weights[columns], n) + intercept
        error = (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels) / n
        slope = np.append(np.bincount(columns, values * error[rows], width) + strength * weights, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.99 * square + 0.01 * slope**2
        step = 0.02 * mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        weights -= step[:-1]
        intercept -= step[-1]
    return weights, intercept


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    divisor: int = 4,
    rest: int = 2,
    per_label: int = PER_LABEL,
    kept: int = KEPT,
) -> RatioClassifier:
    rows = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    rows = rows.where("label in (0, 1)").where(remainder("id", divisor) != rest)
    rows = rows.groupBy("id").agg(F.max("label").alias("label"))
    counts = class_counts(rows)
    drawn = F.broadcast(draw(rows, counts, per_label))  # bounded by per_label
    texts = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    texts = texts.where(F.col("text").isNotNull()).join(drawn, "id").select("id", "label", "text")
    # written once: the tables are not read again for each step, and few tasks count many texts each
    sample = durable(texts.repartition(PARTS, "id"))
    classifier = fit(sample, counts.get(1, 0) / max(1, sum(counts.values())), kept)
    discard(sample)
    return classifier


def score(
    docs: DataFrame, classifier: RatioClassifier, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: the id and its score."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"score": classifier.scores(batch)})

    return per_text(docs, id_col, text_col, run, "score double")


def report(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3
) -> DataFrame:
    """Per document: the id, held_out, score and predicted."""
    found = score(docs, train(docs, labels, id_col, text_col), id_col, text_col)
    predicted = F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted")
    return found.select(id_col, held_out(id_col, 4, 2).alias("held_out"), "score", predicted)
