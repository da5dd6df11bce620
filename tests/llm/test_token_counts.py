import random

import regex
from conftest_llm import DATA, needs_data

from wattweave.llm import token_counts
from wattweave.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/byte_bpe_50k.json"


def greedy(word, pieces, longest):
    count = at = 0
    while at < len(word):
        end = min(len(word), at + longest)
        while end > at + 1 and word[at:end] not in pieces:
            end -= 1
        at, count = end, count + 1
    return count


def test_counts_equal_greedy_splitting():
    pieces = token_counts.read_pieces(PATH)
    known, longest = set(pieces), max(map(len, pieces))
    counter = token_counts.LongestMatchCounter(pieces)
    rng = random.Random(1)
    for _ in range(5000):
        word = rng.choice(pieces) + rng.choice(pieces)[: rng.randint(0, 9)] + bytes(rng.choices(range(256), k=rng.randint(0, 3)))
        assert counter.count(word) == greedy(word, known, longest)


def test_failure_links_cross_several_pieces():
    counter = token_counts.LongestMatchCounter([b"ab", b"abcdefg", b"cd", b"e"])
    assert counter.count(b"abcdef") == 4  # ab cd e f
    assert counter.count(b"abcdefg") == 1
    assert counter.count(b"") == 0
    assert counter.count(b"zz") == 2  # bytes of no piece count one by one


@needs_data()
def test_query_equals_greedy_splitting(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    pieces = token_counts.read_pieces(PATH)
    known, longest = set(pieces), max(map(len, pieces))
    found = {r["doc_id"]: (r["n_words"], r["n_tokens"]) for r in token_counts.token_counts(docs, PATH).collect()}
    for r in docs.collect():
        words = regex.findall(token_counts.PATTERN, r["text"] or "")
        assert found[r["doc_id"]] == (len(words), sum(greedy(w.encode(), known, longest) for w in words))


def test_nulls_empty_long_repeated_and_extra_columns(clashing_docs, docs, monkeypatch):
    monkeypatch.setattr(token_counts, "WORD_TABLE", 2)
    rows = [(1, None), (2, ""), (None, "a b c d"), (4, "word " * 20_000), (5, "x"), (5, "x")]
    found = token_counts.token_counts(clashing_docs(rows), PATH)
    assert found.columns == ["doc_id", "n_words", "n_tokens"]
    counts = sorted((str(r[0]), r[1], r[2]) for r in found.collect())
    assert counts == [("1", 0, 0), ("2", 0, 0), ("4", 20001, 20001), ("5", 1, 1), ("5", 1, 1), ("None", 4, 4)]
    assert token_counts.token_counts(docs([]), PATH).collect() == []
