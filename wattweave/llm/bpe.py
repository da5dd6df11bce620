"""Byte-pair encoding and decoding with a pair occurrence index.

The distinct words of a batch are laid out as one chain of symbols. An index maps every
adjacent pair to the positions where it occurs, and a heap holds the ranks of the pairs
that occur at all (the active ranks). The lowest active rank is applied at all its
positions at once; each merge touches only the lists of the two neighbouring pairs. Words
met before are taken from a bounded table of the worker, so the cost follows new words.

Nulls and empty texts have no tokens: zero tokens, empty id list, empty decoded text.
Very long texts are encoded whole. Equal rows give equal results; each row is kept.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import types
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame

from wattweave.llm.texts import per_text

# The white space of Unicode, as in a character class.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{WHITE_SPACE}\p{{L}}\p{{N}}]+"

#: Words whose encodings a worker keeps; beyond it the table starts anew (results stay the same).
WORD_TABLE = 500_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in printable}
    for byte in range(256):
        letters.setdefault(byte, chr(256 + len(letters) - len(printable)))
    return [letters[b] for b in range(256)]


class WordBpe:
    """Encoder for a tokenizer file of words with an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update({i: t for t, i in self.special.items()})
        self.ranks: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for left, right in model["merges"]:
            self.ranks[self.vocab[left], self.vocab[right]] = len(self.made)
            self.made.append(self.vocab[left + right])
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.suffix] for c in letters]
        self.words = regex.compile(WORD_PATTERN)
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None

    def split(self, text: str) -> list[str]:
        """Words of a text, normalised; special tokens stand as themselves."""
        if self.specials is None or not self.specials.search(text):
            return self._words(text)
        found: list[str] = []
        for part in self.specials.split(text):
            found += [part] if part in self.special else self._words(part)
        return found

    def _words(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        # str.lower() treats a final sigma by its place in the word; letters count one by one here
        text = "".join(map(str.lower, text)) if "Σ" in text else text.lower()
        return self.words.findall(text)

    def encode_words(self, words: Iterable[str]) -> dict[str, list[int]]:
        """Token ids of each distinct word."""
        symbols: list[int] = []
        starts: dict[str, int] = {}
        for word in words:
            if word in self.special:
                starts[word] = len(symbols)
                symbols += [self.special[word], -1]
                continue
            raw = word.encode("utf-8")
            starts[word] = len(symbols)
            symbols += [self.inner[b] for b in raw[:-1]]
            symbols += [self.last[raw[-1]], -1]
        self._merge(symbols, nexts := list(range(1, len(symbols) + 1)))
        found = {}
        for word, at in starts.items():
            ids = []
            while symbols[at] != -1:
                ids.append(symbols[at])
                at = nexts[at]
            found[word] = ids
        return found

    def _merge(self, symbols: list[int], nexts: list[int]) -> None:
        """Apply all merges; -1 ends a word, -2 marks a symbol that went into its left neighbour."""
        ranks, made = self.ranks, self.made
        before = list(range(-1, len(symbols) - 1))
        index: dict[tuple[int, int], list[int]] = {}
        for at, pair in enumerate(zip(symbols, symbols[1:])):
            if pair in ranks:
                index.setdefault(pair, []).append(at)
        active = [(ranks[pair], pair) for pair in index]
        heapq.heapify(active)
        while active:
            rank, pair = heapq.heappop(active)
            left, right = pair
            new = made[rank]
            for at in sorted(index.pop(pair, ())):
                after = nexts[at]
                if symbols[at] != left or symbols[after] != right:
                    continue  # one of the two has gone into another merge
                symbols[at], symbols[after] = new, -2
                behind = nexts[at] = nexts[after]
                before[behind] = at
                ahead = before[at]
                if ahead >= 0:
                    pair_ahead = (symbols[ahead], new)
                    if pair_ahead in ranks:
                        if pair_ahead not in index:
                            index[pair_ahead] = []
                            heapq.heappush(active, (ranks[pair_ahead], pair_ahead))
                        index[pair_ahead].append(ahead)
                pair_behind = (new, symbols[behind])
                if pair_behind in ranks:
                    if pair_behind not in index:
                        index[pair_behind] = []
                        heapq.heappush(active, (ranks[pair_behind], pair_behind))
                    index[pair_behind].append(at)

    def encode(self, text: str) -> list[int]:
        words = self.split(text)
        table = self.encode_words(dict.fromkeys(words))
        return [i for word in words for i in table[word]]

    def decode(self, ids: Iterable[int]) -> str:
        """Token texts joined by a space; this vocabulary has no decoder of its own."""
        return " ".join(self.tokens[i] for i in ids)


class _WordTable:
    """Word -> (number of tokens, ids as text, decoded text), grown batch by batch."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.known: dict[str, tuple[int, str, str]] = {}

    def of(self, words: list[str]) -> list[tuple[int, str, str]]:
        known = self.known
        new = [w for w in dict.fromkeys(words) if w not in known]
        if len(known) + len(new) > WORD_TABLE and known:
            known.clear()
            new = list(dict.fromkeys(words))
        for word, ids in self.bpe.encode_words(new).items():
            known[word] = (len(ids), " ".join(map(str, ids)), self.bpe.decode(ids))
        return [known[w] for w in words]


def _kept_table(path: str) -> _WordTable:
    """The word table of this Python worker: Spark gives one worker many tasks, and words come again in them.

    Functions are unpickled for every task, so the table hangs on a module of its own.
    """
    kept = vars(sys.modules.setdefault("wattweave_worker_tables", types.ModuleType("wattweave_worker_tables")))
    key = f"bpe {WORD_TABLE} {path}"
    if key not in kept:
        kept[key] = _WordTable(WordBpe(path))
    return kept[key]


def _chunks(values: list, sizes: Iterable[int], limit: int) -> Iterator[list]:
    """Runs of values whose sizes add up to about the limit."""
    run, total = [], 0
    for value, size in zip(values, sizes):
        run.append(value)
        total += size
        if total >= limit:
            yield run
            run, total = [], 0
    if run:
        yield run


def _digest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, n_tokens, ids_sha256 and decoded_sha256 of its whole text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        table = _kept_table(path)
        for batch in batches:
            rows = []
            texts = [t if isinstance(t, str) else "" for t in batch]
            for chunk in _chunks(texts, map(len, texts), 2_000_000):
                split = [table.bpe.split(t) for t in chunk]
                found = iter(table.of([w for words in split for w in words]))
                for words in split:
                    tokens = [next(found) for _ in words]
                    rows.append(
                        (
                            sum(t[0] for t in tokens),
                            _digest(" ".join([t[1] for t in tokens])),
                            _digest(" ".join([t[2] for t in tokens])),
                        )
                    )
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return per_text(docs, id_col, text_col, run, "n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, its token ids and their decoded text."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = WordBpe(path)
        for batch in batches:
            ids = [bpe.encode(t) if isinstance(t, str) else [] for t in batch]
            yield pd.DataFrame({"ids": ids, "decoded": [bpe.decode(i) for i in ids]})

    return per_text(docs, id_col, text_col, run, "ids array<int>, decoded string")
