import hashlib
import random
import re

import pytest
from conftest_llm import sentence

from wattweave.llm import decontaminate


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(text, items, window=10):
    doc, hit, names = words(text), set(), set()
    for item, body in items:
        ws = words(body)
        width = min(window, len(ws))
        for p in range(len(ws) - width + 1) if width else []:
            for q in range(len(doc) - width + 1):
                if doc[q : q + width] == ws[p : p + width]:
                    hit |= set(range(q, q + width))
                    names.add(str(item))
    joined = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    return len(doc), len(hit), len(names), joined, bool(hit)


@pytest.fixture
def items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string, doc_id long")


def case(seed):
    rng = random.Random(seed)
    small = [sentence(rng, 1) for _ in range(12)]  # few words, so that windows overlap and repeat
    text = lambda n: " ".join(rng.choices(small, k=n))
    benchmark = [(i, text(rng.choice([2, 5, 9, 10, 11, 25]))) for i in range(25)] + [(98, None), (99, " .,"), (100, "solo")]
    docs = [(k, text(rng.randint(0, 60)) + rng.choice(["", " solo", " Solo! "]) + rng.choice([sentence(rng, 5), benchmark[k % 25][1]])) for k in range(40)]
    return benchmark, docs


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 20])
def test_equals_brute_force(docs, items, seed, block_words):
    benchmark, rows = case(seed)
    table = items([(i, t, 1) for i, t in benchmark])
    found = decontaminate.report(docs(rows), table, block_words=block_words)
    assert found.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = {k: brute(t, benchmark) for k, t in rows}
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == expected


def test_nulls_long_repeated_and_extra_columns(clashing_docs, items):
    rng = random.Random(4)
    passage = sentence(rng, 15)
    benchmark = [(1, passage), (1, passage), (2, passage.upper())]
    rows = [(1, None), (2, ""), (None, passage), (3, sentence(rng, 20_000) + " " + passage), (4, passage), (4, passage)]
    found = decontaminate.report(clashing_docs(rows), items([(i, t, 9) for i, t in benchmark])).collect()
    assert sorted((str(r[0]), *r[1:]) for r in found) == sorted((str(k), *brute(t, benchmark)) for k, t in rows)


def test_no_items_and_no_documents(docs, items):
    assert [r["contaminated"] for r in decontaminate.report(docs([(1, "a b")]), items([])).collect()] == [False]
    assert decontaminate.report(docs([]), items([(1, "a b", 1)])).collect() == []


def test_passages_are_cut_and_the_rest_is_kept(clashing_docs, items):
    rng = random.Random(6)
    passage, before, after = sentence(rng, 14), sentence(rng, 40), sentence(rng, 40)
    rows = [(1, f"{before}, {passage}. {after}"), (2, before), (3, passage), (4, None), (5, ""), (6, f"{before}\n{passage.title()}")]
    table = clashing_docs(rows)
    kept = decontaminate.remove(table, items([(1, passage, 1)]))
    assert kept.columns == table.columns
    texts = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert sorted(texts) == [1, 2, 4, 5, 6] and texts[2] == before and texts[4] is None and texts[5] == ""
    for k in (1, 6):
        assert not brute(texts[k], [(1, passage)])[4]
        assert before.split()[0] in texts[k]
    assert words(texts[1]) == words(before) + words(after)


def test_what_a_cut_brings_together_is_looked_at_again(docs, items):
    outer = " ".join(f"o{i}" for i in range(10))
    inner = " ".join(f"i{i}" for i in range(10))
    filler = " ".join(f"f{i}" for i in range(60))
    text = f"{filler} {outer[:14]} {inner} {outer[15:]} {filler}"
    kept = decontaminate.remove(docs([(1, text)]), items([(1, outer, 1), (2, inner, 1)])).collect()
    assert words(kept[0]["text"]) == words(f"{filler} {filler}")


def test_limits(docs, items):
    passage = " ".join(f"p{i}" for i in range(10))
    text = passage + " " + " ".join(f"f{i}" for i in range(15))
    table = items([(1, passage, 1)])
    assert decontaminate.remove(docs([(1, text)]), table, max_coverage=0.4).collect() == []
    assert decontaminate.remove(docs([(1, text)]), table, min_span=11).collect()[0]["text"] == text


def test_what_is_removed_does_not_depend_on_the_blocks(clashing_docs, items):
    numbered = lambda c, n: " ".join(f"{c}{i}" for i in range(n))
    third, other, outer, inner = numbered("a", 15), numbered("b", 15), numbered("o", 10), numbered("i", 10)
    nested = f"{numbered('f', 60)} {outer[:14]} {inner} {outer[15:]} {numbered('g', 60)}"
    rows = [
        (1, f"{third} {numbered('f', 10)} {other} {numbered('g', 10)}"),  # two items of 30 % each: goes
        (2, nested),
        (2, nested),
        (None, f"{third} {numbered('f', 40)}"),
        (3, None),
        (4, ""),
        (5, "Free, of all."),
    ]
    for order in ([third, other, outer, inner], [inner, outer, other, third]):
        table = items([(k, text, 1) for k, text in enumerate(order)])
        docs = clashing_docs(rows)
        texts = []
        for block_words in (decontaminate.BLOCK_WORDS, 20, 1):
            kept = decontaminate.remove(docs, table, block_words=block_words)
            assert kept.columns == docs.columns
            texts.append(sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()))
        assert texts[0] == texts[1] == texts[2]
        assert [i for i, _ in texts[0]] == ["2", "2", "3", "4", "5", "None"]
        assert all(not brute(text, list(enumerate(order)))[4] for _, text in texts[0])


@pytest.mark.parametrize("seed", [1, 2])
def test_removal_by_blocks_equals_removal_by_one(docs, items, seed):
    benchmark, rows = case(seed)
    table = items([(i, t, 1) for i, t in benchmark])
    for options in ({}, {"min_span": 4, "max_coverage": 0.9}):
        one, several = (
            sorted(tuple(r)[:2] for r in decontaminate.remove(docs(rows), table, block_words=n, **options).collect())
            for n in (decontaminate.BLOCK_WORDS, 60)
        )
        assert one == several


def test_one_block_at_a_time(docs, items, monkeypatch):
    """A block's hits are written before the next block is collected, and no plan has two blocks."""
    seen, inner_blocks, inner_durable = [], decontaminate._blocks, decontaminate.durable

    def blocks(*args):
        for block in inner_blocks(*args):
            assert sum(len(words(t)) for _, t in block) <= 20 or len(block) == 1
            seen.append("block")
            yield block

    def durable(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        seen.append("written")
        assert plan.count("ArrowEvalPython") <= 1
        return inner_durable(df)

    monkeypatch.setattr(decontaminate, "_blocks", blocks)
    monkeypatch.setattr(decontaminate, "durable", durable)
    benchmark = items([(k, " ".join(f"w{k}x{i}" for i in range(12)), 1) for k in range(6)])
    rows = docs([(k, f"x {' '.join(f'w{k}x{i}' for i in range(12))} y") for k in range(6)])
    assert [r["n_hit"] for r in decontaminate.report(rows, benchmark, block_words=20).collect()] == [12] * 6
    assert seen == ["written"] + ["block", "written"] * 6
