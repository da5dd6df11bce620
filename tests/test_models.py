import datetime

import pytest
from pyspark.sql import functions as F

from wattweave.plans import models

SMALL = models.Parameters(options={"maxIter": 4, "maxDepth": 3})


@pytest.fixture(scope="module")
def table(spark):
    """Fourteen months of daily rows whose target follows two features."""
    day = F.date_add(F.lit(datetime.date(2022, 1, 1)), (F.col("id") % 425).cast("int"))
    return (
        spark.range(1700)
        .select(
            (F.col("id") / 425).cast("int").alias("client_id"),
            day.alias("date"),
            (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).cast("float").alias("strong"),
            F.when(F.col("id") % 3 == 0, "Spot").otherwise("Fixed").alias("product_type"),
            F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("double").alias("noise"),
            (F.col("id") % 2).cast("tinyint").alias("is_consumption"),
            (F.col("id") / 425).cast("int").alias("block"),
            (F.pmod(F.floor(F.col("id") / 2), F.lit(2))).cast("tinyint").alias("is_business"),
            F.lit(0.25).cast("float").alias("sin(hour)"),
        )
        .withColumn("target", (F.col("strong") * 3 + F.when(F.col("product_type") == "Spot", 10).otherwise(0)).cast("float"))
        .withColumn("datetime", F.col("date").cast("timestamp_ntz"))
        .cache()
    )


def test_frame_drops_identifiers(table):
    frame = models.model_frame(table)
    assert not {"client_id", "datetime", "date"} & set(frame.columns)
    assert frame.filter("is_test").count() == table.filter("date >= date'2022-12-01'").count()


@pytest.fixture(scope="module")
def fitted(table):
    frame = models.model_frame(table)
    model, curve = models.fit_with_curve(frame, SMALL)
    return frame, model, curve


def test_beats_the_mean(fitted):
    frame, model, curve = fitted
    test = frame.filter("is_test")
    mean = frame.filter("NOT is_test").agg(F.avg("target")).first()[0]
    naive = test.agg(F.avg(F.abs(F.col("target") - F.lit(mean)))).first()[0]
    error = models.test_error(model, frame)
    assert error < naive / 2
    assert error == pytest.approx(min(row[2] for row in curve), rel=1e-6)


def test_importances_find_the_signal(spark, fitted):
    frame, model, _ = fitted
    importances = models.feature_importances(spark, model, frame)
    table = {r.feature: r for r in importances.collect()}
    assert table["strong"].importance > table["noise"].importance
    assert max(r.importance_perc_cumulative for r in table.values()) == pytest.approx(100)
    assert "strong" not in [r.feature for r in models.weaker_than_noise(importances).collect()]


def test_curve_has_every_round(spark, fitted):
    _, _, curve = fitted
    assert [row[0] for row in curve] == [1, 2, 3, 4]


def test_the_first_trees_are_the_model_of_a_fit_that_stopped_there(spark, table, tmp_path):
    frame = models._plain_names(models.model_frame(table))
    train = frame.filter("NOT is_test")
    encoder = models.Pipeline(stages=models.feature_stages(frame)).fit(train)
    encoded = encoder.transform(frame)
    estimator = models.Parameters(rounds=7, options={"maxDepth": 3}).estimator()
    whole = estimator.fit(encoder.transform(train))
    for rounds in (1, 3, 7, 20):
        shorter = models.first_trees(whole, rounds)
        again = estimator.copy({estimator.maxIter: min(rounds, 7)}).fit(encoder.transform(train))
        assert shorter.getNumTrees == again.getNumTrees == min(rounds, 7)
        both = shorter.transform(encoded).select("prediction").collect(), again.transform(encoded).select("prediction").collect()
        assert both[0] == both[1]
        assert shorter.featureImportances.toArray().tolist() == pytest.approx(
            again.featureImportances.toArray()[: shorter.featureImportances.size].tolist()
        )
    short = models.first_trees(whole, 2)
    models.save_model(models.PipelineModel([*encoder.stages, short]), str(tmp_path / "short"))
    loaded = models.load_model(str(tmp_path / "short"))
    assert loaded.stages[-1].getNumTrees == 2
    assert models.predict(loaded, frame).select("prediction").collect() == short.transform(encoded).select("prediction").collect()


def test_each_model_is_fitted_once(table, monkeypatch):
    fits, inner = [], models.GBTRegressor.fit
    monkeypatch.setattr(models.GBTRegressor, "fit", lambda self, *args: (fits.append(1), inner(self, *args))[1])
    frame = models.model_frame(table).withColumn("target", F.when(F.col("is_test"), F.rand(3) * 1000).otherwise(F.col("target")))
    model, curve = models.fit_with_curve(frame, models.Parameters(rounds=6, options={"maxDepth": 3}))
    best = min(curve, key=lambda row: row[2])[0]
    assert len(fits) == 1 and len(curve) == 6 and model.stages[-1].getNumTrees == best


def test_save_load(spark, fitted, tmp_path):
    frame, model, _ = fitted
    path = models.model_path(str(tmp_path), datetime.date(2024, 1, 31), "consumer", False)
    assert path.endswith("year=2024/month=1/day=31/consumer_not_business")
    assert models.load_model(path) is None
    models.save_model(model, path)
    again = models.load_model(path)
    assert models.test_error(again, frame) == models.test_error(model, frame)


def test_a_broken_save_leaves_the_model_before(spark, fitted, tmp_path, monkeypatch):
    _, model, _ = fitted
    path = str(tmp_path / "model")
    models.save_model(model, path)

    def dies(*_):
        raise RuntimeError("lost")

    other = models.PipelineModel(model.stages[:-1])
    with monkeypatch.context() as patch:
        patch.setattr(models.versions, "publish", dies)
        with pytest.raises(RuntimeError):
            models.save_model(other, path)
    assert len(models.load_model(path).stages) == len(model.stages)
    for _ in range(3):
        models.save_model(other, path, keep=2)
    assert len(models.load_model(path).stages) == len(other.stages)
    assert models.versions.numbers(spark, path) == [3, 4]


def test_segments(table):
    fitted = models.train_segments(table, {"producer": SMALL, "consumer": SMALL}, by_business=False)
    scores = models.segment_scores(table, fitted).collect()
    assert {(r.model_type, r.is_business) for r in scores} == {("producer", None), ("consumer", None)}
    assert all(r.mae < 6 and r.test_rows > 0 for r in scores)


def test_more_categories_than_the_default_bins(spark):
    rows = [(f"name {i % 50}", float(i % 50), i % 4 == 0) for i in range(400)]
    frame = spark.createDataFrame(rows, "county_name string, target double, is_test boolean")
    for parameters in (models.Parameters(rounds=2), models.Parameters("poisson")):
        model = models.fit(frame, parameters)
        names = [r.feature for r in models.feature_importances(spark, model, frame).collect()]
        assert names == ["county_name"] and models.test_error(model, frame) < 12


def test_segments_with_too_few_rows_are_left_out(table):
    some = table.filter("is_consumption = 1").unionByName(table.filter("is_consumption = 0").limit(1))
    fitted = models.train_segments(some, {"producer": SMALL, "consumer": SMALL}, by_business=False)
    assert set(fitted) == {("consumer", None)}


def test_columns_per_model_type(table):
    columns = {"consumer": ["target", "strong"]}
    fitted = models.train_segments(table, {"producer": SMALL, "consumer": SMALL}, by_business=False, columns=columns)
    inputs = {key[0]: model.stages[-2].getInputCols() for key, model in fitted.items()}
    assert inputs["consumer"] == ["strong"] and len(inputs["producer"]) > 1


def test_saved_segments_score_a_table(table, tmp_path):
    fitted = models.train_segments(table, {"producer": SMALL, "consumer": SMALL})
    models.save_segments(fitted, str(tmp_path), datetime.date(2024, 1, 31))
    scored = models.score_segments(table, str(tmp_path), datetime.date(2024, 1, 31))
    assert scored.count() == table.count() and scored.filter("prediction IS NULL").isEmpty()
    assert models.score_segments(table, str(tmp_path / "none"), datetime.date(2024, 1, 31)).count() == 0


def test_folds(table):
    scores = models.fold_scores(table, SMALL, train_months=6, test_months=3, max_folds=1).collect()
    assert [r.fold_id for r in scores] == [202201] and scores[0].mae > 0


def test_candidates(table):
    frame = models.model_frame(table.drop("noise", "sin(hour)", "block"))
    candidates = {
        "stump": models.Parameters(options={"maxIter": 1, "maxDepth": 1}),
        "trees": models.with_options(SMALL, maxDepth=4),
        "poisson": models.Parameters("poisson"),
    }
    best, scores = models.best_parameters(frame, candidates)
    assert scores.count() == 3 and best == candidates["trees"]
    space = {"maxDepth": [2, 3, 4], "stepSize": [0.1, 0.2]}
    drawn = models.sample_candidates(space, 5, seed=1)
    assert drawn == models.sample_candidates(space, 5, seed=1) != models.sample_candidates(space, 5, seed=2)
    with pytest.raises(ValueError):
        models.Parameters("huber").estimator()
