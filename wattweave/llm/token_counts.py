"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Every node has a failure link and the number of
pieces that are popped on the way along it, both computed once, breadth first. A word is
then counted in one pass over its bytes: a step that the trie lacks follows failure links
and adds their counts. The result is the number of pieces that greedy longest-match
splitting gives, without building a piece. A byte that no piece begins with counts as one
piece of its own.

Texts are split into words by a pattern first; pieces do not cross words. Null and empty
texts have no words. Texts are counted whole. Words met before come from a bounded table.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterable, Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame

from wattweave.llm.bpe import byte_letters
from wattweave.llm.texts import per_text

# Fixed value: how texts are split before vocabularies of this kind apply.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words whose counts a task keeps; beyond it the table starts anew.
WORD_TABLE = 400_000


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a byte-level tokenizer file, without its special tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    byte_of = {letter: byte for byte, letter in enumerate(byte_letters())}
    special = {t["content"] for t in spec["added_tokens"]}
    return [bytes(byte_of[c] for c in token) for token in spec["model"]["vocab"] if token not in special]


class LongestMatchCounter:
    def __init__(self, pieces: Iterable[bytes]):
        steps: list[dict[int, int]] = [{}]
        ends = [False]
        for piece in [*pieces, *(bytes([b]) for b in range(256))]:
            at = 0
            for byte in piece:
                to = steps[at].get(byte)
                if to is None:
                    to = len(steps)
                    steps[at][byte] = to
                    steps.append({})
                    ends.append(False)
                at = to
            ends[at] = at != 0
        self.steps = steps
        self.fail = [0] * len(steps)
        self.popped = [0] * len(steps)
        waiting = deque([0])
        while waiting:
            at = waiting.popleft()
            for byte, to in steps[at].items():
                if ends[to]:
                    # the whole way here is one piece; matching goes on at the root
                    self.fail[to], self.popped[to] = 0, 1
                else:
                    back, count = self.fail[at], self.popped[at]
                    while byte not in steps[back]:
                        count += self.popped[back]
                        back = self.fail[back]
                    self.fail[to], self.popped[to] = steps[back][byte], count
                waiting.append(to)

    def count(self, word: bytes) -> int:
        steps, fail, popped = self.steps, self.fail, self.popped
        at = total = 0
        for byte in word:
            to = steps[at].get(byte)
            while to is None:
                total += popped[at]
                at = fail[at]
                to = steps[at].get(byte)
            at = to
        while at:
            total += popped[at]
            at = fail[at]
        return total


def token_counts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """Per document: the id, n_words and n_tokens."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = LongestMatchCounter(read_pieces(path))
        words_of = regex.compile(pattern).findall
        known: dict[str, int] = {}
        for batch in batches:
            n_words, n_tokens = [], []
            for text in batch:
                words = words_of(text) if isinstance(text, str) else []
                if len(known) > WORD_TABLE:
                    known.clear()
                for word in words:
                    if word not in known:
                        known[word] = counter.count(word.encode("utf-8"))
                n_words.append(len(words))
                n_tokens.append(sum([known[w] for w in words]))
            yield pd.DataFrame({"n_words": n_words, "n_tokens": n_tokens})

    return per_text(docs, id_col, text_col, run, "n_words long, n_tokens long")
