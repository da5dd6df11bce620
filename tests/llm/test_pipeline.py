import pytest
from conftest_llm import DATA, needs_data, sentence
from test_bpe import expected as encoded
from test_bpe import library  # noqa: F401
from test_decontaminate import brute as contamination
from test_line_dedup import brute as line_groups
from test_near_dedup import brute as near_groups

import corpus_pipeline

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture
def folder(spark, tmp_path):
    def make(rows, items):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return make


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def by_hand(rows, items):
    """What each stage leaves of the texts {doc_id: text}; languages are those of the rows."""
    texts = {i: t for i, t, *_ in rows if t and any(c.isalpha() for c in t)}
    yield dict(texts)
    drop = {(d, k) for d, k, *_, kept in line_groups(sorted(texts.items())) if not kept}
    left = {}
    for i, t in texts.items():
        lines = [(k, line) for k, line in enumerate(t.split("\n"))]
        kept = [line for k, line in lines if (i, k) not in drop]
        if len(kept) == len(lines) or any(line.strip(" \t\r") for line in kept):
            left[i] = "\n".join(kept)
    yield dict(left)
    groups = near_groups(sorted(left.items()))
    left = {i: t for i, t in left.items() if groups[i][2]}
    yield dict(left)
    yield {i: (t, contamination(t, items)) for i, t in left.items()}


@needs_data()
def test_stages_equal_brute_force(spark, library):  # noqa: F811
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.limit(120).collect()]
    wanted = [r[0] for r in rows]
    docs = docs.where(docs.doc_id.isin(wanted))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    hand = by_hand(rows, items)
    for name in ("language", "lines", "near_copies"):
        docs = STAGES[name](spark, docs, DATA)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert texts_of(docs) == next(hand), name
        assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    last = next(hand)
    cut = texts_of(STAGES["benchmark"](spark, docs, DATA))
    for i, (text, (n_words, n_hit, *_)) in last.items():
        if n_hit == 0:
            assert cut[i] == text
        elif n_hit * 2 >= n_words:
            assert i not in cut
        else:
            assert contamination(cut[i], items)[1] == 0
    docs = spark.createDataFrame(list(cut.items()), "doc_id long, text string")
    for r in STAGES["tokens"](spark, docs, DATA).collect():
        assert tuple(r[1:]) == encoded(library, cut[r["doc_id"]])


def test_run_with_nulls_copies_and_long_texts(spark, folder, rng):
    a, b, c = (sentence(rng, 60) for _ in range(3))
    passage = sentence(rng, 15)
    rows = [
        (1, a, "en", "s", None),
        (2, a, "en", "s", 3),
        (3, a + " end", "en", "s", 3),
        (4, None, "en", None, None),
        (5, "", None, "s", 0),
        (6, "1234 !!", "en", "s", 7),
        (7, f"{b}\n{passage}\n{c}", "en", "s", 7),
        (8, passage, "en", "s", 7),
        (9, sentence(rng, 20_000), "en", "s", 7),
        (None, sentence(rng, 30), "en", "s", 7),
    ]
    out = corpus_pipeline.run(spark, folder(rows, [(1, passage), (2, None)])).collect()
    assert sorted(str(r["doc_id"]) for r in out) == ["1", "7", "9", "None"]
    assert all(r["n_tokens"] > 0 for r in out)


def test_run_on_empty_tables(spark, folder):
    assert corpus_pipeline.run(spark, folder([], [])).collect() == []


def test_stages_are_as_listed():
    assert list(STAGES) == ["language", "lines", "near_copies", "benchmark", "tokens"]
