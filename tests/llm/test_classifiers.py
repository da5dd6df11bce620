import math
import random

import numpy as np
import pytest
from conftest_llm import edited, needs_data, sentence

from wattweave.llm import language, quality, toxicity
from wattweave.llm.samples import remainder

LARGER = "/root/testdata/sf0.01"


@pytest.fixture
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string")


def accuracy(spark, found, truth):
    rows = found.join(truth, "doc_id").where("held_out and label is not null").collect()
    assert len(rows) > 50
    return np.mean([r["label"] == r["predicted"] for r in rows])


@needs_data()
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    marks = spark.read.parquet(f"{LARGER}/labels.parquet")
    found = language.report(docs).withColumnRenamed("lang_pred", "predicted")
    assert accuracy(spark, found, docs.selectExpr("doc_id", "lang label")) > 0.97
    found = quality.report(docs, marks)
    assert accuracy(spark, found, marks.selectExpr("doc_id", "quality label")) > 0.95
    found = toxicity.report(docs, marks)
    assert accuracy(spark, found, marks.selectExpr("doc_id", "toxic label")) > 0.93


def test_held_out_fold_follows_crc32_of_the_id(spark):
    import zlib

    rows = spark.range(50).select("id", remainder("id", 4).alias("r")).collect()
    assert all(zlib.crc32(str(r["id"]).encode()) % 4 == r["r"] for r in rows)


def test_held_out_labels_are_not_learned_from(docs, labels):
    rng = random.Random(1)
    texts = [(i, sentence(rng, 20), "en" if i % 2 else "xx") for i in range(120)]
    import zlib

    part = lambda i, n: zlib.crc32(str(i).encode()) % n
    first = language.report(docs(texts)).collect()
    changed = [(i, t, "zz" if part(i, 4) == 2 else lang) for i, t, lang in texts]
    assert sorted(language.report(docs(changed)).collect()) == sorted(first)
    marks = [(i, i % 2, i % 2, "t") for i in range(120)]
    for module, n, rest in ((quality, 3, 1), (toxicity, 4, 2)):
        turned = [(i, 1 - q, 1 - t, x) if part(i, n) == rest else (i, q, t, x) for i, q, t, x in marks]
        one = sorted(module.report(docs(texts), labels(marks)).collect())
        assert sorted(module.report(docs(texts), labels(turned)).collect()) == one


def test_language_of_texts_without_letters_and_of_odd_rows(docs, clashing_docs, spark):
    rows = [(i, f"der die und {sentence(random.Random(i), 5)}", "de") for i in range(30)]
    rows += [(50 + i, f"éà que çe {sentence(random.Random(i), 5)}", "fr") for i in range(30)]
    network = language.train(docs(rows))
    odd = [(1, None), (2, ""), (3, "12 34 !?"), (None, "der die und der"), (5, "der die und " * 20_000), (6, "é"), (6, "é")]
    found = {}
    for r in language.identify(clashing_docs(odd), network).collect():
        found[r["doc_id"]] = (r["lang_pred"], 0 <= r["score"] <= 1)
    assert found[1] == found[2] == found[3] == ("und", True)
    assert found[None] == found[5] == ("de", True) and found[6][1]
    assert language.report(docs([])).collect() == []
    unlabelled = docs([(1, "words", None), (2, None, "en")])
    assert [(r["lang_pred"], r["score"]) for r in language.report(unlabelled).collect()] == [("und", 0.0)] * 2


def test_tables_give_the_same_network_as_its_filters():
    network = language.ByteNetwork(["a", "b", "c"])
    raw = bytes(random.Random(3).choices(range(256), k=1000))
    windows = language.windows_of(raw)
    shown = network.parts["bytes"][windows]
    pooled = []
    for w in language.WIDTHS:
        patch = np.stack([shown[:, k : k + language.WINDOW - w + 1] for k in range(w)], axis=2)
        patch = patch.reshape(*patch.shape[:2], -1)
        pooled.append(np.maximum((patch @ network.parts[f"filter{w}"] + network.parts[f"bias{w}"]).max(axis=1), 0))
    plain = np.concatenate(pooled, axis=1) @ network.parts["out"] + network.parts["out_bias"]
    plain = np.exp(plain) / np.exp(plain).sum(axis=1, keepdims=True)
    assert np.allclose(network.probabilities(windows, network.tables()), plain, atol=1e-4)


def test_windows_show_every_run_of_bytes():
    for n in (0, 1, 3, 255, 256, 257, 509, 510, 2000):
        raw = bytes(random.Random(n).choices(range(1, 256), k=n))
        cut = {bytes(w[i : i + 4]) for w in language.windows_of(raw) for i in range(language.WINDOW - 3)}
        assert all(raw[i : i + 4] in cut for i in range(n - 3))


@pytest.mark.parametrize("module", [quality, toxicity])
def test_labels_of_one_kind_none_and_odd_rows(module, docs, labels, clashing_docs):
    rows = [(i, sentence(random.Random(i), 10)) for i in range(20)] + [(20, None), (21, ""), (22, "x " * 50_000)]
    predicted = lambda found: {r["predicted"] for r in found.collect()}
    assert predicted(module.report(docs(rows), labels([(i, 1, 1, "") for i in range(20)]))) == {1}
    assert predicted(module.report(docs(rows), labels([(i, 0, 0, "") for i in range(20)]))) == {0}
    found = module.report(clashing_docs([(None, "a"), (1, "b"), (1, "b")]), labels([(1, None, None, ""), (None, 1, 1, "")]))
    assert [r["score"] for r in found.collect()] == [0.5] * 3
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert module.report(docs([]), labels([])).collect() == []


def test_toxic_words_are_found_in_long_texts(docs, labels):
    rng = random.Random(8)
    rows, marks = [], []
    for i in range(400):
        text, toxic = sentence(rng, rng.choice([5, 50, 400])), i % 3 == 0
        rows.append((i, edited(rng, text, 0) + (" you Scumlord" if toxic else "")))
        marks.append((i, 1, int(toxic), "t"))
    long = sentence(rng, 15_000)
    rows += [(1000, long + " scumlord " + long), (1001, long)]
    found = {r["doc_id"]: r["predicted"] for r in toxicity.report(docs(rows), labels(marks)).collect()}
    assert found[1000] == 1 and found[1001] == 0
    assert np.mean([found[i] == t for i, _, t, _ in marks]) > 0.98


def test_long_labelled_texts_are_learned_from(docs, labels):
    """All labelled texts are far longer than a chunk of the older bound, with the words at their ends."""
    rng = random.Random(4)
    filler = [sentence(rng, 12_000) for _ in range(6)]
    rows, marks = [], []
    for i in range(120):
        text, toxic = filler[i % 6] + " " + sentence(rng, 5), i % 3 == 0
        rows.append((i, text + (" you scumlord" if toxic else "")))
        marks.append((i, 1, int(toxic), "t"))
    assert min(len(text) for _, text in rows) > 50_000
    found = {r["doc_id"]: r["predicted"] for r in toxicity.report(docs(rows), labels(marks)).collect()}
    assert found == {i: int(i % 3 == 0) for i in range(120)}


def test_ratios_equal_a_plain_computation(spark):
    rng = random.Random(5)
    texts = [(i, int(i % 3 == 0), sentence(rng, 30) + (" vile fool" if i % 3 == 0 and rng.random() < 0.9 else "")) for i in range(300)]
    sample = spark.createDataFrame(texts, "id long, label int, text string").repartition(4)
    counts, n1 = {}, 100
    for _, label, text in texts:
        for bucket in toxicity._buckets(text).tolist():
            counts.setdefault(bucket, [0, 0])[1 - label] += 1
    seen = {r["bucket"]: [r["toxic"], r["clean"]] for r in toxicity.ngram_counts(sample).collect()}
    assert seen == counts
    ratio = {b: math.log((t + 1) / (n1 + 2) / ((c + 1) / (200 + 2))) for b, (t, c) in counts.items()}
    far = {b: abs(ratio[b]) / math.sqrt(1 / (t + 1) + 1 / (c + 1)) for b, (t, c) in counts.items()}
    for kept in (10, 4096):
        got = {r["bucket"]: r["ratio"] for r in toxicity.far_ratios(toxicity.ngram_counts(sample), n1, 200, kept).collect()}
        first = sorted((b for b in far if far[b] > toxicity.FAR), key=lambda b: (-round(far[b], 9), b))[:kept]
        assert got.keys() == set(first) and all(abs(got[b] - ratio[b]) < 1e-12 for b in got) and got


def test_chunks_lose_no_ngram(monkeypatch):
    text = sentence(random.Random(1), 400)
    whole = toxicity._buckets(text)
    monkeypatch.setattr(toxicity, "CHUNK", 37)
    assert (toxicity._buckets(text) == whole).all()


def test_pairs_rank_the_better_document_higher():
    rng = np.random.default_rng(2)
    labels = (rng.random(300) < 0.7).astype(int)
    table = rng.normal(size=(300, 5)) + labels[:, None] * np.array([2.0, 0, 0, -2, 0])
    ranker = quality.fit(table, labels, share_bad=float(1 - labels.mean()))
    ranks = ranker.ranks(table)
    assert np.mean(ranks[labels == 1][:, None] > ranks[labels == 0][None]) > 0.97
    below = np.mean(ranks < ranker.threshold)
    assert abs(below - (1 - labels.mean())) < 0.02  # the quantile at the share of bad labels
