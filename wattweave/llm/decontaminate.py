"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to words and put into one suffix automaton over words. Streaming the
words of a document through it tracks, at every word, the longest suffix that occurs in
any item. A length of ``window`` or more means that a window of an item ends there; an
item shorter than a window is found by the state of its whole text. Words inside such
occurrences are hit.

Items are handled in blocks of at most ``block_words`` words (or one item, if that has more),
which bounds what the driver and the automaton of a task hold: the hits of a block are
written before the next one is collected, and then merged by document. What is cut is
decided on the merged hits of all blocks, so results do not depend on the block size. A
benchmark of one block is looked for in one lazy pass without a shuffle.

Null and empty texts have no words and no hits; an item without words has no window. Very
long texts are streamed whole. Repeated documents and items count one by one. Columns
other than the id and the text are kept by ``remove`` and not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.llm.texts import column, free_name
from wattweave.session import durable

WINDOW = 10
BLOCK_WORDS = 200_000
#: A run of hit words is cut out from this length on (every window has it, or is a whole item).
MIN_SPAN_WORDS = 1
#: A document whose share of hit words is at least this goes as a whole.
MAX_COVERAGE = 0.5

# Fixed value: what a word is, after A-Z are lower-cased.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}
#: The same in texts that are not lower-cased.
_ANY_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.translate(_LOWER) if not text.isascii() else text.lower()) if isinstance(text, str) else []


class ItemAutomaton:
    """Suffix automaton over the words of many items, with the items of each window."""

    def __init__(self, items: list[tuple[object, str | None]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[str, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.shortest = window
        sequences = []
        for item, text in items:
            words = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            if words:
                sequences.append((item, words))
                self.shortest = min(self.shortest, len(words))
        for _, words in sequences:
            last = 0
            for word in words:
                last = self._extend(last, word)
        #: (state, length) -> items that have the window of that length and state
        self.windows: dict[tuple[int, int], set] = {}
        for item, words in sequences:
            width = min(window, len(words))
            state = length = 0
            for word in words:
                state, length = self._step(state, length, word)
                if length >= width:
                    self.windows.setdefault((self._holder(state, width), width), set()).add(item)
        self.widths = sorted({width for _, width in self.windows})

    def _extend(self, last: int, word: int) -> int:
        nexts, link, length = self.next, self.link, self.length
        known = nexts[last].get(word)
        if known is not None:
            return known if length[known] == length[last] + 1 else self._clone(last, word, known)
        new = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at != -1 and word not in nexts[at]:
            nexts[at][word] = new
            at = link[at]
        if at != -1:
            known = nexts[at][word]
            link[new] = known if length[known] == length[at] + 1 else self._clone(at, word, known)
        return new

    def _clone(self, at: int, word: int, known: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[known]))
        self.length.append(self.length[at] + 1)
        self.link.append(self.link[known])
        self.link[known] = copy
        while at != -1 and self.next[at].get(word) == known:
            self.next[at][word] = copy
            at = self.link[at]
        return copy

    def _step(self, state: int, length: int, word: int) -> tuple[int, int]:
        nexts = self.next
        while state and word not in nexts[state]:
            state = self.link[state]
            length = self.length[state]
        to = nexts[state].get(word)
        return (0, 0) if to is None else (to, length + 1)

    def _holder(self, state: int, width: int) -> int:
        """The state, on the way of suffix links, that stands for the suffix of this width."""
        while self.length[self.link[state]] >= width:
            state = self.link[state]
        return state

    def scan(self, words: list[str]) -> tuple[list[tuple[int, int]], set]:
        """Spans (start, end) of hit words, merged where they touch, and the items found."""
        spans: list[tuple[int, int]] = []
        items: set = set()
        ids = list(map(self.vocab.get, words))
        at, total = 0, len(ids)
        while at < total:
            # A window lies inside a run of words that items know; shorter runs are passed over.
            if ids[at] is None:
                at += 1
                continue
            end = at
            while end < total and ids[end] is not None:
                end += 1
            if end - at >= self.shortest:
                self._scan_run(ids, at, end, spans, items)
            at = end + 1
        return spans, items

    def _scan_run(self, ids: list, start: int, end: int, spans: list, items: set) -> None:
        state = length = 0
        for at in range(start, end):
            state, length = self._step(state, length, ids[at])
            if length < self.shortest:
                continue
            widest = 0
            for width in self.widths:
                if width > length:
                    break
                found = self.windows.get((self._holder(state, width), width))
                if found:
                    items |= found
                    widest = width
            if widest:
                begin = at + 1 - widest
                while spans and spans[-1][1] >= begin:
                    begin = min(begin, spans.pop()[0])
                spans.append((begin, at + 1))


def _n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_ANY_WORD)), F.lit(0)).cast("long")


def _items(benchmark: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, text, n_words) of the items that have words."""
    items = benchmark.select(benchmark[item_col].alias("item"), benchmark[text_col].alias("text"))
    return items.withColumn("n_words", _n_words(F.col("text"))).where("n_words > 0")


def _is_one_block(items: DataFrame, block_words: int) -> bool:
    return (items.agg(F.sum("n_words")).first()[0] or 0) <= block_words


def _blocks(items: DataFrame, block_words: int) -> Iterator[list]:
    """Items in blocks of at most ``block_words`` words; one block at a time is in memory."""
    block, total = [], 0
    for item, text, n_words in items.toLocalIterator():
        if block and total + n_words > block_words:
            yield block
            block, total = [], 0
        block.append((item, text))
        total += n_words
    yield block


def _merged(spans: list[int]) -> list[int]:
    out: list[int] = []
    for start, end in sorted(zip(spans[::2], spans[1::2])):
        if out and start <= out[-1]:
            out[-1] = max(end, out[-1])
        else:
            out += [start, end]
    return out


_HITS = "n_words long, spans array<int>, items array<string>"


def _hits(items: list, window: int, text: Column) -> Column:
    """(n_words, spans, items) of a text, for one block of items."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ItemAutomaton(items, window)
        for batch in batches:
            counts, spans, found = [], [], []
            for text in batch:
                words = words_of(text)
                hit, names = automaton.scan(words)
                counts.append(len(words))
                spans.append([x for span in hit for x in span])
                found.append(sorted(map(str, names)))
            yield pd.DataFrame({"n_words": counts, "spans": spans, "items": found})

    return column(run, _HITS, text)


def _united(spans: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"spans": [_merged(list(s)) for s in batch]})

    return column(run, "spans array<int>", spans)["spans"]


def _hits_of_blocks(texts: DataFrame, items: DataFrame, window: int, block_words: int) -> DataFrame:
    """(row, spans, items) of the rows of (row, text) with a hit, over all blocks.

    Each block's hits are written before the next block is collected, so that the driver and
    a task hold one block.
    """
    parts = []
    for block in _blocks(items, block_words):
        found = texts.select("row", _hits(block, window, texts["text"]).alias("hits")).select("row", "hits.spans", "hits.items")
        parts.append(durable(found.where(F.size("spans") > 0)))
    every = reduce(DataFrame.unionByName, parts).groupBy("row")
    every = every.agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    return every.select("row", _united(F.col("spans")).alias("spans"), F.array_sort(F.array_distinct("items")).alias("items"))


def hit_spans(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: the id, n_words, spans (word positions start, end, start, end, ...) and items.

    Spans are merged and in order; items are the ids, as text, of items with a window in the document.
    """
    items = _items(benchmark, item_col, item_text_col)
    if _is_one_block(items, block_words):
        found = _hits(next(_blocks(items, block_words)), window, docs[text_col])
        return docs.select(docs[id_col], found.alias("__hits")).select(id_col, "__hits.*")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), F.monotonically_increasing_id().alias("row"))
    rows = durable(rows)  # row numbers stay as they are written, whatever is run again
    found = rows.select("id", "row", _n_words(rows["text"]).alias("n_words")).join(
        _hits_of_blocks(rows.select("row", "text"), items, window, block_words), "row", "left"
    )
    return found.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("spans", F.array().cast("array<int>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: the id, n_words, n_hit, n_items, items_sha256 and contaminated."""
    found = hit_spans(docs, benchmark, id_col=id_col, **options)
    hit = F.aggregate(
        F.sequence(F.lit(0), F.size("spans") - 1, F.lit(1)),
        F.lit(0).cast("long"),
        lambda total, k: total + F.when(k % 2 == 0, -F.get("spans", k)).otherwise(F.get("spans", k)),
    )
    return found.select(
        id_col,
        "n_words",
        F.when(F.size("spans") > 0, hit).otherwise(F.lit(0)).cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _long(spans: list[tuple[int, int]], min_span: int) -> list[tuple[int, int]]:
    return [(start, end) for start, end in spans if end - start >= min_span]


def _too_much(text: str, spans: list[tuple[int, int]], max_coverage: float) -> bool:
    return bool(spans) and sum(end - start for start, end in spans) >= max_coverage * len(words_of(text))


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    places = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    kept, at = [], 0
    for start, end in spans:
        kept.append(text[at : places[start][0]].rstrip())
        at = places[end - 1][1]
    return "\n".join([*kept, text[at:].lstrip()])


def cut(text: str, automaton: ItemAutomaton, min_span: int, max_coverage: float) -> str | None:
    """The text without its hit spans; None if too much of it is hit."""
    spans = _long(automaton.scan(words_of(text))[0], min_span)
    if _too_much(text, spans, max_coverage):
        return None
    while spans:
        text = _without(text, spans)  # what is left may touch and form a window: look again
        spans = _long(automaton.scan(words_of(text))[0], min_span)
    return text


def _cut_once(texts: DataFrame, hits: DataFrame, min_span: int, max_coverage: float) -> DataFrame:
    """(row, text) of the rows whose text changes by one cut of the hits; null where too much of it is hit."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, hits in batches:
            clean, changed = [], []
            for text, flat in zip(texts, hits):
                spans = _long(list(zip(flat[::2], flat[1::2])), min_span)
                clean.append(None if _too_much(text, spans, max_coverage) else _without(text, spans))
                changed.append(bool(spans))
            yield pd.DataFrame({"text": pd.Series(clean, dtype=object), "changed": changed})

    both = texts.join(hits, "row")
    both = both.select("row", column(run, "text string, changed boolean", both["text"], both["spans"]).alias("cut"))
    return both.where("cut.changed").select("row", "cut.text")


def _cut_by_blocks(texts: DataFrame, items: DataFrame, window: int, min_span: int, max_coverage: float, block_words: int) -> DataFrame:
    """(row, text) of the rows of (row, text) that change, in the end; null for those that go.

    A round cuts what all blocks together hit. Texts that changed are looked at again, by all
    blocks, until nothing is hit; how much is hit is judged in the first round, on the whole text.
    """
    rounds: list[DataFrame] = []
    while not rounds or not texts.isEmpty():
        hits = _hits_of_blocks(texts, items, window, block_words)
        changed = durable(_cut_once(texts, hits, min_span, float("inf") if rounds else max_coverage))
        rounds.append(changed.withColumn("round", F.lit(len(rounds))))
        texts = changed.where("text is not null")
    last = reduce(DataFrame.unionByName, rounds).groupBy("row").agg(F.max_by(F.struct("text"), "round").alias("last"))
    return last.select("row", "last.text")


def remove(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    min_span: int = MIN_SPAN_WORDS,
    max_coverage: float = MAX_COVERAGE,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents, all columns, with hit spans cut out of the text.

    A run of hit words of at least ``min_span`` words is cut, and what a cut brings together is
    looked at again. A document goes if the share of its words, before any cut, in such runs is
    ``max_coverage`` or more. Other texts stay as they are,
    byte for byte; nulls stay null.
    """
    columns = docs.columns
    items = _items(benchmark, item_col, item_text_col)
    if not _is_one_block(items, block_words):
        row = free_name(columns, "__row")
        docs = durable(docs.withColumn(row, F.monotonically_increasing_id()))
        texts = docs.select(F.col(row).alias("row"), F.col(text_col).alias("text")).where("text is not null")
        cuts = _cut_by_blocks(texts, items, window, min_span, max_coverage, block_words)
        name, of = free_name(columns, "__cut"), free_name(columns, "__of")
        both = docs.join(cuts.select(F.col("row").alias(of), F.col("text").alias(name)), F.col(row) == F.col(of), "left")
        both = both.where(F.col(of).isNull() | F.col(name).isNotNull())
        return both.withColumn(text_col, F.coalesce(name, text_col)).select(*columns)

    block = next(_blocks(items, block_words))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        automaton = ItemAutomaton(block, window)
        for texts in batches:
            clean = [cut(t, automaton, min_span, max_coverage) if isinstance(t, str) else None for t in texts]
            yield pd.DataFrame({"text": pd.Series(clean, dtype=object)})

    name = free_name(columns, "__clean")
    docs = docs.withColumn(name, column(run, "text string", docs[text_col]))
    docs = docs.where(F.col(text_col).isNull() | F.col(f"{name}.text").isNotNull())
    return docs.withColumn(text_col, F.col(f"{name}.text")).select(*columns)
