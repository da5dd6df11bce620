"""Alignment of two tokenizers over the same bytes by merge-path partitioning.

A text with a space before it is split by tokenizer A (byte-level BPE) and by tokenizer B (pieces; it puts
that space there itself). The byte offsets where tokens of both end cut the tokens into
groups, and every A token of a group is linked with every B token of it.

The ends of all texts of a batch stand on one axis, those of A beside those of B. Merging two
sorted lists is a walk through a grid; its crossings with evenly spaced diagonals are found by
binary searches, all at once, and cut the walk into pieces of the same number of ends, whatever
the lengths of texts. Pieces are merged independently: each emits the overlaps it sees, runs of
A and B tokens up to a common end. Its last run may be open, and an end of A may be
parted from the same end of B; boundary pieces are stitched into groups.

The count of an id pair is the number of documents that hold it linked. Documents are aligned
once and written with their distinct pairs; Spark counts these pairs with partial sums before the
shuffle. The most frequent pairs, ``HEAVY`` at most, go to all tasks as arrays; a document's
other pairs are joined with their counts. Both ways give the same sums.

Texts that are null or empty, and texts that the tokens of A or B do not give back byte for
byte, have no tokens: zeros and an empty digest. Special tokens in a text are plain text. Texts
are encoded whole; one document is tokenized by one task. Repeated rows count as documents of their
own, each; equal counts all count as best. An empty table gives an empty result. Other columns are not
looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from wattweave.llm.bpe import byte_letters
from wattweave.llm.texts import per_text
from wattweave.session import durable

# Fixed value: the pattern by which a byte-level vocabulary parts a text before its merges.
BYTE_LEVEL_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Ends a piece merges.
PIECE = 1 << 15
#: Characters of the texts that a task tokenizes and aligns at a time (or one text).
BATCH = 1 << 20
#: Pairs that go to all tasks with their counts, at most (17 bytes each).
HEAVY = 1 << 20


class ByteLevel:
    """Tokenizer A. Ids are those of the file's own library; a faster one is used where it gives the same."""

    LONG_SPACE = re.compile(r"\s{500}")

    def __init__(self, path: str):
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        self.plain.no_truncation()
        self.plain.no_padding()
        special = {t.content for t in self.plain.get_added_tokens_decoder().values()}
        values = {letter: byte for byte, letter in enumerate(byte_letters())}
        self.bytes: list[bytes] = [b""] * self.plain.get_vocab_size()
        ranks = {}
        for token, number in self.plain.get_vocab().items():
            if token in special:
                self.bytes[number] = token.encode()
            else:
                self.bytes[number] = bytes(values[c] for c in token)
                ranks[self.bytes[number]] = number
        self.fast = None
        if self._merges_by_id(json.loads(self.plain.to_str())):
            self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _merges_by_id(spec: dict) -> bool:
        """Whether the file is plain byte-level BPE whose merges make tokens in the order of their ids."""
        model, words = spec["model"], spec["pre_tokenizer"] or {}
        made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        plain = spec["normalizer"] is None and words.get("type") == "ByteLevel" and words["use_regex"] and not words["add_prefix_space"]
        return bool(plain and made == sorted(made) and not model["dropout"] and not model["ignore_merges"])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Token ids of each text; its special tokens are plain text.

        Long runs of white space are beyond the stack of the faster library.
        """
        slow = {k for k, text in enumerate(texts) if self.fast is None or self.LONG_SPACE.search(text)}
        quick = ["" if k in slow else text for k, text in enumerate(texts)]
        found = self.fast.encode_ordinary_batch(quick, num_threads=1) if self.fast else [[] for _ in texts]
        for k in slow:
            found[k] = self.plain.encode(texts[k], add_special_tokens=False).ids
        return found


class Pieces:
    """Tokenizer B: pieces with a sign for the space, and bytes for characters it lacks."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            if self.model.is_byte(number):
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            else:
                self.bytes.append(piece.replace("▁", " ").encode("utf-8"))

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def crossings(a: np.ndarray, b: np.ndarray, piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of ``a`` and of ``b`` come before each diagonal of the merge (equal ones: a first)."""
    diagonals = np.append(np.arange(0, len(a) + len(b), piece), len(a) + len(b))
    low, high = np.maximum(diagonals - len(b), 0), np.minimum(diagonals, len(a))
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        first = a[middle] <= b[diagonals[open_] - 1 - middle]
        low[open_] = np.where(first, middle + 1, low[open_])
        high[open_] = np.where(first, high[open_], middle)
    return low, diagonals - low


def merged(a: np.ndarray, b: np.ndarray, at: tuple[int, int], until: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The piece's overlaps, as the numbers of a's and b's ends up to each common end in it."""
    own_a, own_b = a[at[0] : until[0]], b[at[1] : until[1]]
    place = np.searchsorted(own_b, own_a)
    common = np.flatnonzero(place < len(own_b))
    common = common[own_b[place[common]] == own_a[common]]
    return at[0] + common + 1, at[1] + place[common] + 1


def groups(a: np.ndarray, b: np.ndarray, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """For each group, how many of the rising ends ``a`` and ``b`` stand up to its end, from merged pieces.

    A piece's open run goes on until the next common end of the pieces behind it. Where a
    diagonal parts an end of a from the same end of b, that common end belongs to neither
    piece and is found between them.
    """
    cut_a, cut_b = crossings(a, b, piece)
    found_a, found_b = [], []
    for k in range(len(cut_a) - 1):
        until_a, until_b = merged(a, b, (cut_a[k], cut_b[k]), (cut_a[k + 1], cut_b[k + 1]))
        found_a.append(until_a)
        found_b.append(until_b)
        last, behind = cut_a[k + 1] - 1, cut_b[k + 1]
        if last >= 0 and behind < len(b) and a[last] == b[behind]:
            found_a.append(np.array([last + 1]))
            found_b.append(np.array([behind + 1]))
    return np.concatenate([np.empty(0, np.int64), *found_a]), np.concatenate([np.empty(0, np.int64), *found_b])


@dataclass
class Aligned:
    """The tokens of a batch of texts and their groups, laid end to end."""

    a: np.ndarray  # ids
    b: np.ndarray
    n_a: np.ndarray  # tokens of each text
    n_b: np.ndarray
    until_a: np.ndarray  # tokens up to the end of each group
    until_b: np.ndarray
    n_groups: np.ndarray  # groups of each text


class Aligner:
    def __init__(self, byte_level: str, pieces: str, piece: int = PIECE):
        self.first, self.second, self.piece = ByteLevel(byte_level), Pieces(pieces), piece
        self.widths = [np.array([len(t) for t in side.bytes]) for side in (self.first, self.second)]
        self.separated: dict[tuple[int, str], list[str]] = {}

    def align(self, texts: list[str | None]) -> Aligned:
        spaced = [" " + t if t else "" for t in texts]
        a, b = self.first.encode(spaced), self.second.encode([t or "" for t in texts])
        for k, text in enumerate(spaced):
            raw = text.encode("utf-8")
            for side, ids in ((self.first, a[k]), (self.second, b[k])):
                if not text or b"".join(map(side.bytes.__getitem__, ids)) != raw:
                    a[k], b[k] = [], []
                    break
        flat_a = np.array([i for ids in a for i in ids], np.int64)
        flat_b = np.array([i for ids in b for i in ids], np.int64)
        ends_a, ends_b = np.cumsum(self.widths[0][flat_a]), np.cumsum(self.widths[1][flat_b])
        until_a, until_b = groups(ends_a, ends_b, self.piece)
        n_a, n_b = np.array([len(ids) for ids in a], np.int64), np.array([len(ids) for ids in b], np.int64)
        # both sides of a text end at the same byte, so every text ends with a group
        up_to = np.searchsorted(until_a, np.cumsum(n_a), "right")
        return Aligned(flat_a, flat_b, n_a, n_b, until_a, until_b, np.diff(up_to, prepend=0))

    def _with(self, side: int, sign: str) -> list[str]:
        """Every id in decimal with the sign behind it."""
        if (side, sign) not in self.separated:
            self.separated[side, sign] = [f"{i}{sign}" for i in range(len(self.widths[side]))]
        return self.separated[side, sign]

    def written(self, found: Aligned) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each text."""
        n, m = len(self.widths[0]), len(self.widths[1])
        table = self._with(0, ",") + self._with(0, "|") + self._with(1, ",") + self._with(1, ";")
        signs = np.empty(len(found.a) + len(found.b), np.int64)
        starts_a, starts_b = np.append(0, found.until_a[:-1]), np.append(0, found.until_b[:-1])
        group_a = np.repeat(np.arange(len(found.until_a)), found.until_a - starts_a)
        group_b = np.repeat(np.arange(len(found.until_b)), found.until_b - starts_b)
        code_a, code_b = found.a.copy(), found.b + 2 * n
        code_a[found.until_a - 1] += n
        code_b[found.until_b - 1] += m
        signs[np.arange(len(found.a)) + starts_b[group_a]] = code_a
        signs[np.arange(len(found.b)) + found.until_a[group_b]] = code_b
        strings = list(map(table.__getitem__, signs.tolist()))
        ends = np.cumsum(found.n_a + found.n_b).tolist()
        return ["".join(strings[at:end])[:-1] for at, end in zip([0, *ends[:-1]], ends)]

    def links(self, found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times) of all links: an id pair is one number, times its links in the text.

        Within a group equal ids are counted first, so a group gives a row for each pair of
        different ids.
        """
        m = len(self.widths[1])
        starts_a, starts_b = np.append(0, found.until_a[:-1]), np.append(0, found.until_b[:-1])
        p, q = found.until_a - starts_a, found.until_b - starts_b
        text = np.repeat(np.arange(len(found.n_groups)), found.n_groups)
        plain = np.flatnonzero((p == 1) | (q == 1) | (p * q <= 64))
        times_b = np.repeat(q[plain], p[plain])  # of each A token of these groups, links
        a_at = np.arange(p[plain].sum()) - np.repeat(np.cumsum(p[plain]) - p[plain], p[plain]) + np.repeat(starts_a[plain], p[plain])
        b_from = np.repeat(starts_b[plain], p[plain])
        b_at = np.arange(times_b.sum()) - np.repeat(np.cumsum(times_b) - times_b, times_b) + np.repeat(b_from, times_b)
        pair = np.repeat(found.a[a_at], times_b) * m + found.b[b_at]
        owner = np.repeat(np.repeat(text[plain], p[plain]), times_b)
        owners, pairs, times = [owner], [pair], [np.ones(len(pair), np.int64)]
        for g in np.setdiff1d(np.arange(len(p)), plain, assume_unique=True):
            ids_a, n_a = np.unique(found.a[starts_a[g] : found.until_a[g]], return_counts=True)
            ids_b, n_b = np.unique(found.b[starts_b[g] : found.until_b[g]], return_counts=True)
            pairs.append((ids_a[:, None] * m + ids_b).ravel())
            times.append((n_a[:, None] * n_b).ravel())
            owners.append(np.full(len(pairs[-1]), text[g]))
        owner, pair, times = np.concatenate(owners), np.concatenate(pairs), np.concatenate(times)
        space = len(self.widths[0]) * m
        order = np.argsort(owner * space + pair, kind="stable")
        key = (owner * space + pair)[order]
        firsts = np.flatnonzero(np.diff(key, prepend=-1))
        total = np.add.reduceat(times[order], firsts) if len(key) else times
        return key[firsts] // space, key[firsts] % space, total


def _runs(texts: list[str | None]) -> Iterator[list[str | None]]:
    run, total = [], 0
    for text in texts:
        run.append(text)
        total += len(text or "")
        if total >= BATCH:
            yield run
            run, total = [], 0
    if run:
        yield run


_KINDS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"


def aligned(docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, token, group and link counts, the digest of its groups, and its distinct pairs.

    A pair of ids (a, b) is the number ``a * pieces of B + b``; times has the links of each.
    """

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        aligner = Aligner(byte_level, pieces)
        for batch in batches:
            parts = []
            for texts in _runs([t if isinstance(t, str) else None for t in batch]):
                found = aligner.align(texts)
                owner, pair, times = aligner.links(found)
                digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in aligner.written(found)]
                cuts = np.searchsorted(owner, np.arange(1, len(texts)))
                links = np.bincount(owner, weights=times, minlength=len(texts)).astype(np.int64)
                parts.append(
                    pd.DataFrame(
                        {
                            "n_a": found.n_a,
                            "n_b": found.n_b,
                            "n_groups": found.n_groups,
                            "n_links": links,
                            "groups_sha256": digests,
                            "pairs": np.split(pair, cuts),
                            "times": np.split(times, cuts),
                        }
                    )
                )
            yield pd.concat(parts) if parts else pd.DataFrame({c.split()[0]: [] for c in _KINDS.split(", ")})

    return per_text(docs, id_col, text_col, run, _KINDS)


def pair_counts(documents: DataFrame, pieces: int) -> DataFrame:
    """(pair, n, best): the documents that hold a pair, and whether no pair of its A id has more."""
    counts = documents.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n"))
    counts = counts.withColumn("a", F.expr(f"pair div {pieces}"))
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    return counts.join(highest, "a").select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def _threshold(counts: DataFrame, heavy: int) -> int:
    """The least power of two such that at most ``heavy`` pairs are held by so many documents."""
    power = F.floor(F.log2("n")).alias("power")
    sizes = {r["power"]: r["pairs"] for r in counts.groupBy(power).agg(F.count("*").alias("pairs")).collect()}  # 64 rows at most
    total, power = 0, max(sizes, default=0) + 1
    while power > 0 and total + sizes.get(power - 1, 0) <= heavy:
        power -= 1
        total += sizes.get(power, 0)
    return 2**power


def _looked_up(documents: DataFrame, known: DataFrame) -> DataFrame:
    """n_best and count_sum over the known pairs; pairs and times keep those that are not known."""
    found = known.toPandas().sort_values("pair")
    shared = documents.sparkSession.sparkContext.broadcast(
        (found["pair"].to_numpy(np.int64), found["n"].to_numpy(np.int64), found["best"].to_numpy(bool))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, best = shared.value
        for batch in batches:
            columns = dict(zip(batch.schema.names, batch.columns))
            pairs, times = (columns[name].flatten().to_numpy() for name in ("pairs", "times"))
            ends = np.cumsum(np.append(0, columns["pairs"].value_lengths().to_numpy()))
            at = np.searchsorted(codes, pairs)
            hit = at < len(codes)
            hit[hit] = codes[at[hit]] == pairs[hit]
            worth = np.zeros((2, len(pairs)), np.int64)
            worth[0, hit], worth[1, hit] = times[hit] * best[at[hit]], times[hit] * n[at[hit]]
            for name, values in zip(("n_best", "count_sum"), worth):
                columns[name] = pa.array(np.diff(np.append(0, np.cumsum(values))[ends]))
            left = np.append(0, np.cumsum(~hit))[ends].astype(np.int32)
            for name, values in (("pairs", pairs), ("times", times)):
                columns[name] = pa.ListArray.from_arrays(left, pa.array(values[~hit], pa.int64()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    wanted = documents.select("*", F.lit(0).cast("long").alias("n_best"), F.lit(0).cast("long").alias("count_sum"))
    return documents.mapInArrow(run, wanted.schema)


def report(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", heavy: int = HEAVY
) -> DataFrame:
    """Per document: the id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    documents = aligned(docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")), byte_level, pieces, "id", "text")
    documents = durable(documents.withColumn("row", F.monotonically_increasing_id()), compression="zstd")
    counts = durable(pair_counts(documents, len(Pieces(pieces).bytes)))
    least = _threshold(counts, heavy)
    told = _looked_up(documents, counts.where(F.col("n") >= least))
    if least > 1:
        told = durable(told, compression="zstd")
        rest = told.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
        rest = rest.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
        rest = rest.join(counts.where(F.col("n") < least), "pair").groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n")).alias("more"),
        )
        told = told.join(rest, "row", "left").withColumns(
            {
                "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)),
                "count_sum": F.col("count_sum") + F.coalesce("more", F.lit(0)),
            }
        )
    return told.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
