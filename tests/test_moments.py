import datetime

import numpy as np
import pytest

from wattweave.operators import moments
from wattweave.operators.moments import Moments, fold_linear_scores, merged
from wattweave.operators.splits import month_folds


@pytest.fixture(scope="module")
def daily(spark):
    rng, start = np.random.default_rng(2), datetime.date(2021, 1, 1)
    rows = []
    for k in range(900):
        x, w = float(rng.normal()), float(rng.integers(0, 9))
        rows.append((start + datetime.timedelta(days=k), x, w, 3 * x - 2 * w + 100 + float(rng.normal())))
    rows += [(start, None, 1.0, 2.0), (None, 1.0, 1.0, 2.0), (start, 1.0, 1.0, None)]
    return spark.createDataFrame(rows, "date date, `x(1)` double, w double, target double").cache()


def of(x, y):
    full = np.column_stack([x, y])
    return Moments(len(full), full.sum(axis=0), full.T @ full)


def test_merged_parts_are_the_moments_of_all_rows():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(60, 3)), rng.normal(size=60)
    whole, parts = of(x, y), merged([of(x[a:b], y[a:b]) for a, b in ((0, 7), (7, 8), (8, 60))])
    assert parts.rows == whole.rows and np.allclose(parts.products, whole.products) and np.allclose(parts.sums, whole.sums)
    intercept, coefficients = parts.solve()
    expected = np.linalg.lstsq(np.column_stack([np.ones(60), x]), y, rcond=None)[0]
    assert np.allclose([intercept, *coefficients], expected)
    assert parts.squared_error(intercept, coefficients) == pytest.approx(((y - intercept - x @ coefficients) ** 2).sum())
    few = whole.of([2])
    assert np.allclose(few.products, of(x[:, [2]], y).products)


def test_a_penalty_shortens_and_equal_features_share():
    x = np.arange(20.0)
    same = of(np.column_stack([x, x]), 4 * x + 1)
    assert np.allclose(same.solve()[1], [2, 2])
    assert abs(same.solve(100.0)[1]).sum() < 4
    assert np.allclose(of(np.ones((5, 1)), np.arange(5.0)).solve()[1], 0)


@pytest.mark.parametrize("penalty", [0.0, 50.0])
def test_folds_equal_fits_on_their_rows(daily, penalty):
    found = fold_linear_scores(daily, ["x(1)", "w"], "target", train_months=4, test_months=2, penalty=penalty).collect()
    rows = month_folds(daily.dropna(), "date", 4, 2).toPandas()
    assert [r.fold_id for r in found] == sorted(rows.fold_id.unique())
    for r in found:
        fold = rows[rows.fold_id == r.fold_id]
        train, test = fold[fold.role == "train"], fold[fold.role == "test"]
        assert (r.train_rows, r.test_rows) == (len(train), len(test))
        x, y = train[["x(1)", "w"]].to_numpy(), train.target.to_numpy()
        c = x - x.mean(axis=0)
        b = np.linalg.solve(c.T @ c + penalty * np.eye(2), c.T @ (y - y.mean()))
        assert np.allclose(r.coefficients, b)
        error = test.target - y.mean() - (test[["x(1)", "w"]].to_numpy() - x.mean(axis=0)) @ b
        assert r.rmse == pytest.approx(float(np.sqrt((error**2).mean())))
        assert r.naive_rmse == pytest.approx(float(np.sqrt(((test.target - y.mean()) ** 2).mean())))


def test_rows_are_read_once_however_many_folds(spark, daily, tmp_path, monkeypatch):
    daily.write.parquet(str(tmp_path / "daily"))
    stored = spark.read.parquet(str(tmp_path / "daily"))
    plans, inner = [], moments.durable
    monkeypatch.setattr(moments, "durable", lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), inner(df))[1])
    scores = fold_linear_scores(stored, ["w"], "target")
    assert scores.count() > 20 and len(plans) == 1 and plans[0].count("FileScan") == 1
    assert "FileScan" not in scores._jdf.queryExecution().executedPlan().toString()


def test_first_fold_and_no_rows(daily):
    assert fold_linear_scores(daily, ["w"], "target", max_folds=1).count() == 1
    assert fold_linear_scores(daily.limit(0), ["w"], "target").collect() == []
