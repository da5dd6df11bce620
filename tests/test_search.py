import datetime

import pytest
from pyspark.sql import functions as F

from wattweave.plans import models, search
from wattweave.plans.search import Evolution, evolve, evolve_parameters, linear_scorer, parameters_of

SPACE = {"a": [0, 1, 2, 3, 4, 5, 6, 7], "b": [0, 1, 2, 3, 4, 5, 6, 7]}


def bowl(calls):
    def score(new):
        calls.append(sorted(new))
        return {name: (a - 5) ** 2 + (b - 2) ** 2 + 0.5 for name, (a, b) in new.items()}

    return score


def test_the_seed_decides_everything(spark):
    one, two, other = (evolve(spark, SPACE, bowl([]), Evolution(seed=s)).collect() for s in (1, 1, 2))
    assert one == two != other
    assert [(r.generation, r.slot) for r in one] == [(g, s) for g in range(5) for s in range(10)]


def test_the_best_score_never_rises_and_the_best_stays(spark):
    rows = evolve(spark, SPACE, bowl([]), Evolution(generations=12, seed=3)).collect()
    best = [r.best_score for r in rows]
    assert best == sorted(best, reverse=True) and best[-1] < best[0]
    first = {r.generation: r for r in rows if r.slot == 0}
    for r in rows:
        if r.generation:
            assert first[r.generation].score == min(x.score for x in rows if x.generation < r.generation)


def test_no_candidate_is_scored_twice(spark):
    calls = []
    rows = evolve(spark, SPACE, bowl(calls), Evolution(generations=8)).collect()
    scored = [name for call in calls for name in call]
    assert len(scored) == len(set(scored)) == len({r.candidate for r in rows}) == sum(r.fitted for r in rows)


def test_a_search_goes_on_where_it_broke_off(spark, tmp_path):
    path, calls, again = str(tmp_path / "memo"), [], []
    inner = bowl(calls)

    def breaks(new):
        if len(calls) == 2:
            raise RuntimeError("lost")
        return inner(new)

    with pytest.raises(RuntimeError):
        evolve(spark, SPACE, breaks, memo_path=path)
    rows = evolve(spark, SPACE, bowl(again), memo_path=path).collect()
    plain = evolve(spark, SPACE, bowl([])).collect()
    shown = lambda rows: [(r.generation, r.slot, r.candidate, r.score, r.best_score) for r in rows]
    assert shown(rows) == shown(plain)
    assert not {n for call in calls for n in call} & {n for call in again for n in call}


def test_a_parent_is_the_best_of_its_tournament():
    evolution = Evolution(population=6, tournament=500, crossover=0, mutation=0)
    before = [(k, k) for k in range(6)]
    after = evolution.following(SPACE, 1, before, [3.0, 2.0, 1.0, 1.0, 5.0, 6.0], before[4])
    assert after == [(4, 4)] + [(2, 2)] * 5


def test_children_mix_both_parents_or_draw_anew():
    before, scores = [(0, 0), (7, 7)] * 20, [1.0] * 40
    mixed = Evolution(population=40, tournament=1, crossover=100, mutation=0).following(SPACE, 1, before, scores, (0, 0))
    assert {(0, 7), (7, 0), (0, 0), (7, 7)} == set(mixed)
    fresh = Evolution(population=40, tournament=1, mutation=100).following(SPACE, 1, before, scores, (0, 0))
    assert len(set(fresh)) > 15


def test_options_need_values(spark):
    for space in ({}, {"a": []}):
        with pytest.raises(ValueError):
            evolve(spark, space, bowl([]))


@pytest.fixture(scope="module")
def frame(spark):
    rows = spark.range(900).select(
        (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 5).cast("double").alias("z"),
        (F.col("id") % 4 == 0).alias("is_test"),
    )
    return rows.withColumn("target", F.abs(F.col("x") - 3) * 4 + F.col("z")).cache()


def test_boosted_trees_are_searched_and_fitted_once_each(frame, monkeypatch):
    fits, inner = [], models.fit

    def fit(frame, parameters):
        fits.append((parameters.rounds, parameters.options["maxDepth"]))
        return inner(frame, parameters)

    monkeypatch.setattr(models, "fit", fit)
    space = {"maxDepth": [1, 2, 3], "rounds": [1, 6]}
    best, rows = evolve_parameters(frame, space, Evolution(population=4, generations=3, seed=5))
    rows = rows.collect()
    assert len(fits) == len(set(fits)) == len({r.candidate for r in rows})
    chosen = min(rows, key=lambda r: (r.score, r.candidate))
    assert search.label(space, (best.options["maxDepth"], best.rounds)) == chosen.candidate
    assert models.test_error(inner(frame, best), frame) == pytest.approx(chosen.score)


def test_sampled_candidates_are_fitted(frame):
    drawn = models.sample_candidates({"maxDepth": [1, 2], "rounds": [2, 3]}, 3, seed=1)
    assert {p.rounds for p in drawn.values()} <= {2, 3} and all(set(p.options) == {"maxDepth"} for p in drawn.values())
    scores = models.candidate_scores(frame, drawn).collect()
    assert len(scores) == 3 and all(r.mae >= 0 for r in scores)


def test_names_of_options():
    found = parameters_of({"objective": ["poisson"], "regParam": [0.1]}, ("poisson", 0.1), 7)
    assert found == models.Parameters("poisson", 7, options={"regParam": 0.1})


def test_linear_scores_equal_a_direct_computation(spark):
    import numpy as np

    start = datetime.date(2020, 1, 1)
    rows = [(start + datetime.timedelta(days=k), float(k % 11), float(k % 3), float((k * 37) % 101)) for k in range(800)]
    rows.append((start, None, 1.0, 5.0))
    df = spark.createDataFrame(rows, "date date, x double, w double, y double")
    score = linear_scorer(df, ["x", "w"], "y", test_months=2, digits=6)
    found = score({"one": ("x", 10.0, 4), "two": ("w", 0.0, 24), "none": ("x", 0.0, 0)})
    assert found["none"] == float("inf")
    number = lambda d: d.year * 12 + d.month
    border = max(number(r[0]) for r in rows) - 2
    for name, place, penalty, months in (("one", 1, 10.0, 4), ("two", 2, 0.0, 24)):
        full = [r for r in rows if r[1] is not None]
        train = np.array([(r[place], r[3]) for r in full if border - months < number(r[0]) <= border])
        test = np.array([(r[place], r[3]) for r in full if number(r[0]) > border])
        x, y = train[:, 0] - train[:, 0].mean(), train[:, 1]
        slope = (x * (y - y.mean())).sum() / ((x * x).sum() + penalty)
        guess = y.mean() + slope * (test[:, 0] - train[:, 0].mean())
        assert found[name] == pytest.approx(abs(test[:, 1] - guess).mean(), abs=1e-5)
