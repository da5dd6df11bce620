import numpy as np
import pytest
from conftest_llm import DATA, needs_data

from wattweave.llm import ann

SCHEMA = "vec_id long, embedding array<float>, label int, id string, vector string, rank int, shard int"


@pytest.fixture
def vectors(spark):
    return lambda rows: spark.createDataFrame([(i, v, 0, "i", "v", 1, 2) for i, v in rows], SCHEMA)


def brute(rows, k=20, every=20):
    ids = np.array([i for i, _ in rows])
    table = np.array([np.array(v, np.float32) for _, v in rows], float)
    found = {}
    for q in sorted({i for i in ids if i % every == 0}):
        own = np.flatnonzero(ids == q)[0]
        scores = (table * table[own]).sum(axis=1)
        order = [j for j in np.lexsort((ids, -scores)) if ids[j] != q][:k]
        found[q] = [(int(ids[j]), float(scores[j])) for j in order]
    return found


def lists(df):
    found = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return found


def recall(found, expected):
    return np.mean([len({v for v, _ in found[q]} & {v for v, _ in e}) / len(e) for q, e in expected.items()])


@needs_data("embeddings")
@pytest.mark.parametrize(("shard", "block"), [(ann.SHARD, ann.BLOCK), (100, 7)])
def test_recall_ranks_and_scores_on_the_table(spark, shard, block):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    found, expected = lists(ann.nearest(table, shard=shard, block=block)), brute(rows)
    assert recall(found, expected) > 0.95
    by_id = {i: np.array(np.array(v, np.float32), float) for i, v in rows}
    for q, near in found.items():
        assert len(near) == 20 and q not in [v for v, _ in near]
        assert all(abs(by_id[q] @ by_id[v] - s) < 1e-12 for v, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))


def test_vectors_of_many_lengths_are_found_by_inner_product(vectors):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=16) * rng.uniform(0.2, 4)).tolist()) for i in range(900)]
    assert recall(lists(ann.nearest(vectors(rows))), brute(rows)) > 0.9


def test_many_equal_vectors_tie_to_smaller_ids(vectors):
    rng = np.random.default_rng(6)
    same = rng.normal(size=8).tolist()
    rows = [(i, same) for i in range(300)] + [(300 + i, rng.normal(size=8).tolist()) for i in range(300)]
    found, expected = lists(ann.nearest(vectors(rows), shard=64)), brute(rows)
    assert all(found[q] == expected[q] for q in range(0, 300, 20))


def test_fewer_candidates_than_asked_and_tiny_dimensions(vectors):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0]), (20, [0.5])]
    found = lists(ann.nearest(vectors(rows)))
    assert found == {0: [(1, 2.0), (20, 0.5), (2, -1.0)], 20: [(1, 1.0), (0, 0.5), (2, -0.5)]}


def test_rows_that_take_no_part(vectors):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.9, 0.1]), (20, None), (40, []), (60, [0.0, 0.0]), (80, [None, 1.0]), (100, [nan, 1.0]), (120, [1.0, inf]), (140, [1.0]), (None, [1.0, 1.0]), (1, [0.9, 0.1])]
    assert {q: [v for v, _ in near] for q, near in lists(ann.nearest(vectors(rows))).items()} == {0: [1, 1]}


def test_repeated_query_rows_count_once(vectors):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [0.5, 0.5])]
    assert lists(ann.nearest(vectors(rows))) == {0: [(3, 0.5)]}


@pytest.mark.parametrize("size", [1e140, 1e-140, 1e-300])
def test_components_of_any_size(vectors, size):
    """The same neighbours as of vectors near 1, as long as the products are numbers; no crash beyond."""
    rng = np.random.default_rng(8)
    plain = rng.normal(size=(400, 8))
    rows = [(i, v.tolist()) for i, v in enumerate(plain * size)]
    table = vectors(rows).sparkSession.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = lists(ann.nearest(table))
    assert all(len(near) == 20 for near in found.values()) and len(found) == 20
    if size > 1e-300:
        ids = np.arange(400)
        products = plain @ plain.T
        expected = {q: [(int(j), 0) for j in np.lexsort((ids, -products[q])) if j != q][:20] for q in range(0, 400, 20)}
        assert recall(found, expected) > 0.9


def test_products_beyond_the_doubles(vectors):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 1.0]), (2, [-1e200, -1.0]), (3, [1e200, -1e200]), (4, [1.0, 0.0])]
    table = vectors([]).sparkSession.createDataFrame(rows, "vec_id long, embedding array<double>")
    inf = float("inf")
    assert lists(ann.nearest(table)) == {0: [(1, inf), (4, 1e200), (2, -inf), (3, -inf)]}


def test_empty_table(vectors):
    found = ann.nearest(vectors([]))
    assert found.columns == ["query_id", "rank", "vec_id", "score"] and found.collect() == []


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(7)
    table = rng.normal(size=(500, 24))
    coder = ann.BinaryCoder(table, float(np.sqrt((table**2).sum(axis=1).max())), 20)
    index = ann.MultiIndex(coder, np.arange(500), table)
    for q in range(20):
        code = index.codes[q]
        distance = ann._ONES[index.codes ^ code].sum(axis=1)
        for radius in (0, 3, 7, 12, 25):
            assert (index.within(code, radius) == np.flatnonzero(distance <= radius)).all()
