import hashlib
import random

import pytest
from conftest_llm import DATA, needs_data
from tokenizers import Tokenizer

from wattweave.llm import bpe
from wattweave.llm.queries import TOKENIZERS

PATH = f"{TOKENIZERS}/word_bpe_49k.json"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def own():
    return bpe.WordBpe(PATH)


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_ids_and_decoded_text_equal_the_library(library, own):
    rng = random.Random(5)
    pool = "abcABC'stIVE 019.,!?\n\t\x0b\x1c\x85\xa0éÉßΣσςİıǅ中あ😀́|<>٣²"
    texts = ["", "It's <|startoftext|>WE'LL<|endoftext|> go", "ΟΔΟΣ Σ ΣΑ", "aaaaaaa aaaa", "a" * 3000, "<|endoftext|>" * 3]
    texts += ["".join(rng.choices(pool, k=rng.randint(1, 60))) for _ in range(3000)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == ids
        assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_words_of_one_call_do_not_mix(own):
    words = ["in", "the", "inthe", "thin", "a", "😀"]
    together = own.encode_words(words)
    assert all(together[w] == own.encode_words([w])[w] for w in words)


@needs_data()
def test_query_equals_the_library(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    found = bpe.digests(docs, PATH).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == expected(library, texts[r["doc_id"]])


def test_nulls_empty_long_repeated_and_extra_columns(library, clashing_docs, monkeypatch):
    monkeypatch.setattr(bpe, "WORD_TABLE", 3)
    rows = [(1, None), (2, ""), (None, "hi there"), (4, "So " * 30_000), (5, "twice"), (5, "twice"), (6, " \n")]
    found = bpe.digests(clashing_docs(rows), PATH)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r[0]), *r[1:]) for r in found.collect()) == sorted((str(i), *expected(library, t)) for i, t in rows)
    texts = {r["doc_id"]: (r["ids"], r["decoded"]) for r in bpe.encode(clashing_docs(rows), PATH).collect()}
    assert texts[1] == ([], "") and texts[None][0] == library.encode("hi there", add_special_tokens=False).ids


def test_empty_table(docs):
    assert bpe.digests(docs([]), PATH).collect() == []
