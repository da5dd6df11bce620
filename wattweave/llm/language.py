"""Language identification by a byte convolutional network.

A text is lower-cased, cut into windows of ``WINDOW`` bytes that overlap by the widest
filter, and every window goes through filters of several widths over byte vectors, a
rectifier, the maximum over positions and a softmax. The language of a text is the one
with the largest probability averaged over all its windows, weighted by their bytes.

The network is trained in numpy on a bounded sample: ``PER_LANGUAGE`` documents of each
language, up to three windows from each (start, middle and end). Number and languages come
from the labels. Prediction covers every byte of every text.

Null texts and texts without a letter are ``und`` with score 0; so is every text if there
is nothing to learn from. Equal texts get equal results. Rows without an id are predicted
like others and are never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.llm.samples import class_counts, draw, held_out, remainder
from wattweave.llm.texts import per_text

WINDOW = 256
WIDTHS = (2, 3, 4)
OVERLAP = max(WIDTHS) - 1
DIMENSIONS = 8
FILTERS = 8
PER_LANGUAGE = 400
EPOCHS = 8
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


def windows_of(raw: bytes) -> np.ndarray:
    """Windows (n, WINDOW) that together show every filter every position; zeros fill up the last."""
    step = WINDOW - OVERLAP
    count = max(1, -(-(len(raw) - OVERLAP) // step))
    filled = np.zeros(count * step + OVERLAP, np.uint8)
    filled[: len(raw)] = np.frombuffer(raw, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(filled, WINDOW)[::step]


class ByteNetwork:
    def __init__(self, languages: list[str], seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.parts = {"bytes": rng.normal(0, 0.5, (256, DIMENSIONS))}
        for w in WIDTHS:
            self.parts[f"filter{w}"] = rng.normal(0, (w * DIMENSIONS) ** -0.5, (w * DIMENSIONS, FILTERS))
            self.parts[f"bias{w}"] = np.zeros(FILTERS)
        self.parts["out"] = rng.normal(0, 0.2, (FILTERS * len(WIDTHS), len(languages)))
        self.parts["out_bias"] = np.zeros(len(languages))
        self.parts = {k: v.astype(np.float32) for k, v in self.parts.items()}

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> None:
        """Adam on the cross entropy, in small batches; ends early once a pass has almost no loss."""
        rng = np.random.default_rng(seed)
        means = {k: np.zeros_like(v) for k, v in self.parts.items()}
        squares = {k: np.zeros_like(v) for k, v in self.parts.items()}
        turn = 0
        for _ in range(epochs):
            losses = []
            order = rng.permutation(len(windows))
            for at in range(0, len(order), 64):
                some = order[at : at + 64]
                loss, slopes = self._slopes(windows[some], labels[some])
                losses.append(loss)
                turn += 1
                for k, slope in slopes.items():
                    means[k] = 0.9 * means[k] + 0.1 * slope
                    squares[k] = 0.99 * squares[k] + 0.01 * slope**2
                    size = np.sqrt(squares[k] / (1 - 0.99**turn)) + 1e-7
                    self.parts[k] = (self.parts[k] - 0.01 * means[k] / (1 - 0.9**turn) / size).astype(np.float32)
            if np.mean(losses) < 0.01:
                break

    def _slopes(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, dict]:
        parts, n = self.parts, len(windows)
        shown = parts["bytes"][windows]
        pooled, places, patches = [], [], []
        for w in WIDTHS:
            patch = np.lib.stride_tricks.sliding_window_view(shown, w, axis=1).transpose(0, 1, 3, 2)
            patch = patch.reshape(n, WINDOW - w + 1, w * DIMENSIONS)
            found = patch @ parts[f"filter{w}"] + parts[f"bias{w}"]
            place = found.argmax(axis=1)
            places.append(place)
            patches.append(patch[np.arange(n)[:, None], place])
            pooled.append(np.maximum(np.take_along_axis(found, place[:, None], 1)[:, 0], 0))
        hidden = np.concatenate(pooled, axis=1)
        chance = _softmax(hidden @ parts["out"] + parts["out_bias"])
        loss = float(-np.log(chance[np.arange(n), labels] + 1e-9).mean())
        error = chance.copy()
        error[np.arange(n), labels] -= 1
        error /= n
        slopes = {"out": hidden.T @ error, "out_bias": error.sum(axis=0)}
        back = (error @ parts["out"].T) * (hidden > 0)
        slopes["bytes"] = np.zeros_like(parts["bytes"])
        for i, w in enumerate(WIDTHS):
            part = back[:, i * FILTERS : (i + 1) * FILTERS]
            slopes[f"filter{w}"] = np.einsum("nfk,nf->kf", patches[i], part)
            slopes[f"bias{w}"] = part.sum(axis=0)
            to_bytes = (part[:, :, None] * parts[f"filter{w}"].T[None]).reshape(n, FILTERS, w, DIMENSIONS)
            read = windows[np.arange(n)[:, None, None], places[i][:, :, None] + np.arange(w)]
            np.add.at(slopes["bytes"], read.ravel(), to_bytes.reshape(-1, DIMENSIONS))
        return loss, slopes

    def tables(self) -> dict[int, list[np.ndarray]]:
        """For each width, what a pair of bytes (or the odd last byte) adds to the filters.

        A filter over byte vectors is a sum of one table look-up per byte; two bytes are
        looked up at once.
        """
        found = {}
        for w in WIDTHS:
            each = [self.parts["bytes"] @ f for f in self.parts[f"filter{w}"].reshape(w, DIMENSIONS, FILTERS)]
            each[0] = each[0] + self.parts[f"bias{w}"]
            pairs = [(each[k][:, None] + each[k + 1][None]).reshape(65536, FILTERS) for k in range(0, w - 1, 2)]
            found[w] = [np.ascontiguousarray(t, np.float32) for t in pairs + ([each[-1]] if w % 2 else [])]
        return found

    def probabilities(self, windows: np.ndarray, tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Chances (windows, languages)."""
        out = np.empty((len(windows), len(self.languages)), np.float32)
        for at in range(0, len(windows), 128):
            some = windows[at : at + 128]
            single = some.astype(np.int32)
            pair = single[:, :-1] * 256 + single[:, 1:]
            pooled = []
            for w in WIDTHS:
                size = WINDOW - w + 1
                total = np.take(tables[w][0], pair[:, :size], axis=0)
                for k, table in enumerate(tables[w][1:], 1):
                    index = pair if len(table) == 65536 else single
                    total += np.take(table, index[:, 2 * k : 2 * k + size], axis=0)
                pooled.append(total.max(axis=1))
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            out[at : at + 128] = _softmax(hidden @ self.parts["out"] + self.parts["out_bias"])
        return out

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        tables = self.tables()
        for group in _groups(texts, 1_000_000):
            raws = [t.lower().encode("utf-8") if isinstance(t, str) and LETTER.search(t) else None for t in group]
            cut = [windows_of(r) for r in raws if r is not None]
            chance = self.probabilities(np.concatenate(cut), tables) if cut else None
            at, nth = 0, 0
            for raw in raws:
                if raw is None:
                    yield UNKNOWN, 0.0
                    continue
                count = len(cut[nth])
                nth += 1
                weights = np.full(count, WINDOW - OVERLAP, np.float64)
                weights[-1] = max(1, len(raw) - (count - 1) * (WINDOW - OVERLAP))
                mean = np.average(chance[at : at + count].astype(np.float64), axis=0, weights=weights)
                at += count
                best = int(mean.argmax())
                yield self.languages[best], float(min(1.0, mean[best]))


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _groups(texts: list[str | None], limit: int) -> Iterator[list[str | None]]:
    group, total = [], 0
    for text in texts:
        group.append(text)
        total += len(text) if isinstance(text, str) else 0
        if total >= limit:
            yield group
            group, total = [], 0
    if group:
        yield group


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    divisor: int = 4,
    rest: int = 2,
    per_language: int = PER_LANGUAGE,
) -> ByteNetwork | None:
    """Network learned from labelled documents outside the held-out fold; None without any."""
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("label"))
    rows = rows.where(F.col("label").isNotNull() & F.col("text").isNotNull() & (remainder("id", divisor) != rest))
    counts = class_counts(rows)
    if not counts:
        return None
    drawn = draw(rows.select("id", "label"), counts, per_language)
    size = F.length("text")
    starts = [F.lit(1), F.greatest(F.lit(1), (size / 2).cast("int") - WINDOW // 2), F.greatest(F.lit(1), size - WINDOW)]
    spots = F.array(*[F.substring("text", s, F.lit(WINDOW)) for s in starts])
    spots = F.when(size > 3 * WINDOW, spots).otherwise(F.array(F.substring("text", F.lit(1), F.lit(3 * WINDOW))))
    # at most per_language ids of each language: a bounded table
    chosen = rows.join(F.broadcast(drawn.select("id").distinct()), "id", "left_semi").select("id", "label", spots.alias("spots"))
    sample = sorted(chosen.collect(), key=lambda r: (str(r["label"]), str(r["id"])))
    languages = sorted(counts)
    windows, labels = [], []
    for row in sample:
        for spot in row["spots"]:
            if LETTER.search(spot):
                cut = windows_of(spot.lower().encode("utf-8"))
                windows.append(cut)
                labels += [languages.index(row["label"])] * len(cut)
    if not windows:
        return None
    network = ByteNetwork(languages)
    network.train(np.concatenate(windows), np.array(labels))
    return network


SCHEMA = "lang_pred string, score double"


def predictor(network: ByteNetwork | None):
    """Function from batches of texts to lang_pred and score."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(UNKNOWN, 0.0)] * len(batch) if network is None else list(network.predict(list(batch)))
            yield pd.DataFrame(found, columns=["lang_pred", "score"])

    return run


def identify(
    docs: DataFrame, network: ByteNetwork | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: the id, lang_pred and score."""
    return per_text(docs, id_col, text_col, predictor(network), SCHEMA)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per document: the id, held_out, lang_pred and score."""
    found = identify(docs, train(docs, id_col, text_col, lang_col), id_col, text_col)
    return found.select(id_col, held_out(id_col, 4, 2).alias("held_out"), "lang_pred", "score")
