import hashlib
import math
import random

import numpy as np
import pytest
from conftest_llm import DATA, needs_data

from wattweave.llm import clustering
from wattweave.llm.clustering import clusters, displacements, report
from wattweave.sources.views import table


def brute(rows, k=16, rounds=3, width=64):
    """Every distance in every round, in Python's integers."""
    kept = [
        (i, [math.floor(64 * float(c)) for c in v])
        for i, v in rows
        if v is not None and len(v) == width and all(c is not None and math.isfinite(c) for c in v)
    ]
    named = [(hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None]
    centroids = [v for _, v in sorted(named)[:k]]
    if not centroids:
        return []

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        owners = [nearest(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            own = [v for (_, v), o in zip(kept, owners) if o == n]
            if own:
                centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    last = [(i, *nearest(v)) for i, v in kept]
    sums = [sum(d for _, d, o in last if o == n) for n in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, o, d, sums[o], sum(sums), digests[o]) for i, d, o in last), key=str)


def results(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def vectors(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, 0, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, x int, cluster int, near double")

    return make


def around(rng, centres, n, spread, width=64):
    return [[float(np.float32(c + rng.gauss(0, spread))) for c in rng.choice(centres)] for _ in range(n)]


def test_equals_brute_force_with_odd_rows(vectors):
    rng = random.Random(4)
    centres = [[rng.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    rows = list(enumerate(around(rng, centres, 300, 0.3)))
    same = rows[7][1]
    rows += [(500 + k, same) for k in range(80)]  # copies and ties
    rows += [(3, rows[3][1]), (None, rows[4][1]), (901, None), (902, []), (903, same[:63]), (904, [None, *same[1:]])]
    rows += [(905, [float("nan"), *same[1:]]), (906, [float("inf"), *same[1:]]), (907, [0.0] * 64)]
    assert results(report(vectors(rows))) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_fewer_vectors_than_centroids(vectors, n):
    rows = list(enumerate(around(random.Random(n), [[0.0] * 64], n, 1.0)))
    assert results(report(vectors(rows))) == brute(rows)


def test_integers_whose_distance_does_not_fit_take_no_part(vectors):
    rows = list(enumerate(around(random.Random(1), [[0.0] * 64], 30, 1.0)))
    assert results(report(vectors(rows + [(50, [1e30] * 64), (51, [-3e6] * 64)]))) == brute(rows)


def test_bounds_spare_distances_and_stay_exact(vectors, spark):
    rng = random.Random(6)
    centres = [[rng.gauss(0, 3) for _ in range(64)] for _ in range(16)]
    rows = list(enumerate(around(rng, centres, 400, 0.05)))
    found, _ = clusters(vectors(rows))
    assert found.groupBy().sum("evaluated").head()[0] < 0.5 * 400 * 16 * 4
    assert results(report(vectors(rows))) == brute(rows)


def test_displacement_is_the_norm_of_the_sum_not_the_sum_of_norms():
    there, back = np.array([[0, 0]]), np.array([[30, 40]])
    moved = displacements([there, back, there])
    assert moved[:, 0].tolist() == pytest.approx([0, 50, 0])


def test_bounds_hold_in_every_round():
    rng = np.random.default_rng(3)
    x = rng.integers(-50, 50, (200, 8))
    centroids = x[:5].copy()
    state = {"x": x, "cluster": np.zeros(200, int), "near": np.full(200, np.inf), "near_round": np.zeros(200, int)}
    state |= {"far": np.zeros((200, 5)), "far_rounds": np.zeros((200, 5), int), "evaluated": np.zeros(200, int)}
    history = [centroids]
    for _ in range(6):
        state |= clustering.assign(state, history)
        exact = np.sqrt(((x[:, None] - history[-1]) ** 2).sum(axis=2))
        moved = displacements(history)
        every = np.arange(200)
        assert (state["cluster"] == exact.argmin(axis=1)).all()
        assert (state["near"] + moved[state["near_round"], state["cluster"]] >= exact[every, state["cluster"]]).all()
        lower = state["far"] - moved[state["far_rounds"], np.arange(5)]
        lower[every, state["cluster"]] = 0
        assert (lower <= exact).all()
        history.append(history[-1] + rng.integers(-6, 6, (5, 8)))


@needs_data("embeddings")
def test_whole_table(spark):
    vectors = table(spark, DATA, "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.select("vec_id", "embedding").collect()]
    assert results(report(vectors)) == brute(rows)
