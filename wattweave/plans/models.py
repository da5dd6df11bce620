"""Regressors on the training table: fit, score, compare, keep."""

from __future__ import annotations

import datetime
import random
import warnings
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import partial, reduce
from itertools import accumulate
from operator import or_
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from wattweave.functions.columns import columns_except, quoted, segment
from wattweave.operators.aggregates import below_reference, best_candidate, cumulative_share, mean_absolute_error
from wattweave.operators.splits import first_folds, month_number, month_roles, time_split, year_and_month
from wattweave.plans.training_table import Sources, scoring_table
from wattweave.schemas import MODEL_TYPES, NON_FEATURE_COLUMNS
from wattweave.sources import versions
from wattweave.sources.sinks import day_path

LABEL, PREDICTION, IS_TEST = "target", "prediction", "is_test"
PARALLEL_FITS = 4


@dataclass(frozen=True)
class Parameters:
    """``objective`` l2 fits boosted trees, poisson a generalized linear model.

    ``rounds`` is the largest number of boosting rounds; those after the lowest error on the
    test rows are given up, and a warning says so if that is the last one, as more rounds
    might then do better. ``options`` are passed to the Spark estimator.
    """

    objective: str = "l2"
    seed: int = 42
    rounds: int = 100
    options: dict = field(default_factory=dict)

    def estimator(self):
        if self.objective == "l2":
            settings = {"maxIter": self.rounds, "maxDepth": 5, "stepSize": 0.1, "seed": self.seed} | self.options
            return GBTRegressor(featuresCol="features", labelCol=LABEL, lossType="squared", **settings)
        if self.objective == "poisson":
            settings = {"regParam": 0.01, "maxIter": 25} | self.options
            return GeneralizedLinearRegression(
                featuresCol="features", labelCol=LABEL, family="poisson", link="log", **settings
            )
        raise ValueError(f"objective must be 'l2' or 'poisson', got {self.objective!r}")


def model_frame(df: DataFrame, columns: list[str] | None = None, test_months: int = 3) -> DataFrame:
    """Drop identifiers, mark the test rows (``is_test``), drop the date."""
    data = df.drop(*NON_FEATURE_COLUMNS)
    marked = time_split(data, "date", test_months).withColumn(IS_TEST, F.col("split") == "test").drop("split")
    if columns:
        marked = marked.select([quoted(c) for c in columns] + [IS_TEST])
    return marked.drop("date")


def feature_stages(df: DataFrame, one_hot: bool = False) -> list:
    """Index every text column, then gather all features into one vector.

    Trees take category numbers as categories; a linear model needs ``one_hot``.
    """
    excluded = {LABEL, IS_TEST, "fold_id", "test_start", "role"}
    text = [c for c, kind in df.dtypes if kind == "string" and c not in excluded]
    numbers = columns_except(df, excluded | set(text))
    indexed = [f"{c}__index" for c in text]
    stages = []
    if text:
        stages.append(StringIndexer(inputCols=text, outputCols=indexed, handleInvalid="keep"))
        if one_hot:
            hot = [f"{c}__hot" for c in text]
            stages.append(OneHotEncoder(inputCols=indexed, outputCols=hot, handleInvalid="keep"))
            indexed = hot
    return stages + [VectorAssembler(inputCols=numbers + indexed, outputCol="features", handleInvalid="keep")]


def fit(frame: DataFrame, parameters: Parameters = Parameters()) -> PipelineModel:
    """Fit on the rows that are not test rows; see :func:`fit_with_curve`."""
    return fit_with_curve(frame, parameters)[0]


def fit_with_curve(
    frame: DataFrame, parameters: Parameters = Parameters()
) -> tuple[PipelineModel, list[tuple[int, float, float]]]:
    """Fitted model and (round, train error, test error) of every boosting round.

    Of the boosting rounds, those after the lowest mean absolute error on the test rows
    are given up: rounds depend only on those before, so the model of the first trees is the
    one that a fit up to that round would give. Only the errors per round come to the driver.
    """
    frame = _plain_names(frame)
    train_rows = frame.filter(~F.col(IS_TEST))
    encoder = Pipeline(stages=feature_stages(frame, parameters.objective == "poisson")).fit(train_rows)
    encoded = encoder.transform(frame).select("features", LABEL, IS_TEST).persist(StorageLevel.MEMORY_AND_DISK)
    train, test = encoded.filter(~F.col(IS_TEST)), encoded.filter(F.col(IS_TEST))
    estimator = parameters.estimator()
    if parameters.objective == "l2" and len(encoder.stages) > 1:
        # every category needs a bin of its own, the one for unknown texts included
        most = max(len(labels) for labels in encoder.stages[0].labelsArray) + 1
        estimator = estimator.setMaxBins(max(estimator.getMaxBins(), most))
    fitted, curve = estimator.fit(train), []
    if parameters.objective == "l2":
        curve = _errors_by_round(fitted, train, test)
        best = min(curve, key=lambda row: row[2])[0] if curve else estimator.getMaxIter()
        if curve and best == estimator.getMaxIter() > 1:
            warnings.warn(f"the last of {best} rounds has the lowest test error; allow more rounds", stacklevel=2)
        fitted = first_trees(fitted, best)
    encoded.unpersist()
    return PipelineModel([*encoder.stages, fitted]), curve


def first_trees(model: GBTRegressionModel, rounds: int) -> GBTRegressionModel:
    """The model after the first ``rounds`` rounds of boosting, without another fit."""
    if rounds >= model.getNumTrees:
        return model
    spark = SparkSession.active()
    gateway, ml = spark.sparkContext._gateway, spark._jvm.org.apache.spark.ml.regression
    trees = gateway.new_array(ml.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = model._java_obj.trees()[k], model.treeWeights[k]
    shorter = GBTRegressionModel(ml.GBTRegressionModel(model.uid, trees, weights))
    shorter._resetUid(model.uid)
    return model._copyValues(shorter)


def _errors_by_round(trees, train: DataFrame, test: DataFrame) -> list[tuple[int, float, float]]:
    if test.isEmpty():
        return []
    pairs = zip(trees.evaluateEachIteration(train, "absolute"), trees.evaluateEachIteration(test, "absolute"))
    return [(i, float(a), float(b)) for i, (a, b) in enumerate(pairs, start=1)]


def predict(model: PipelineModel, frame: DataFrame) -> DataFrame:
    return model.transform(_plain_names(frame))


def _plain_names(df: DataFrame) -> DataFrame:
    # ML stages look columns up by name and take dots and brackets for syntax
    return df.withColumnsRenamed({c: c.replace("(", "_of_").replace(")", "") for c in df.columns if "(" in c})


def test_error(model: PipelineModel, frame: DataFrame) -> float:
    """Mean absolute error on the test rows."""
    scored = predict(model, frame.filter(F.col(IS_TEST)))
    return scored.agg(mean_absolute_error(LABEL, PREDICTION)).first()[0]


def segments(by_business: bool = True) -> list[tuple[str, bool | None]]:
    sides = (False, True) if by_business else (None,)
    return [(kind, side) for kind in MODEL_TYPES for side in sides]


def train_segments(
    table: DataFrame,
    parameters: dict[str, Parameters] | None = None,
    by_business: bool = True,
    frame: Callable[..., DataFrame] = model_frame,
    columns: dict[str, list[str]] | None = None,
) -> dict[tuple[str, bool | None], PipelineModel]:
    """One model per segment, each with the parameters and the columns of its model type.

    Segments without enough training rows (see ``_can_be_fitted``) are left out.

    ``frame`` turns the rows of a segment into features, label and ``is_test``. The table is
    read several times per segment: store it first (``training_table.store_training_table``).
    """
    parameters, columns = parameters or {}, columns or {}
    keys = segments(by_business)

    def train(key: tuple[str, bool | None]) -> PipelineModel | None:
        options = {"columns": columns[key[0]]} if key[0] in columns else {}
        data = frame(segment(table, *key), **options)
        return fit(data, parameters.get(key[0], Parameters())) if _can_be_fitted(data) else None

    fitted = zip(keys, _side_by_side(table.sparkSession, train, keys))
    return {key: model for key, model in fitted if model is not None}


def _can_be_fitted(frame: DataFrame) -> bool:
    """Whether there are more training rows than values of any text column, as trees need."""
    text = [c for c, kind in frame.dtypes if kind == "string"]
    sizes = [F.count(F.lit(1)), *[F.count_distinct(quoted(c)) for c in text]]
    rows, *values = frame.filter(~F.col(IS_TEST)).agg(*sizes).first()
    return rows > max(values, default=0)


def _side_by_side(spark: SparkSession, function: Callable, items: list) -> list:
    """Results in order; a few Spark fits run at once, so that small ones fill the cluster."""
    if not items:
        return []
    tasks = [inheritable_thread_target(spark)(partial(function, item)) for item in items]
    with ThreadPool(min(PARALLEL_FITS, len(tasks))) as pool:
        return pool.map(lambda task: task(), tasks)


def segment_scores(
    table: DataFrame, models: dict, frame: Callable[[DataFrame], DataFrame] = model_frame
) -> DataFrame:
    """Test rows and error per segment model."""

    def score(item: tuple) -> tuple:
        (kind, side), model = item
        test = frame(segment(table, kind, side)).filter(F.col(IS_TEST))
        return (kind, side, *predict(model, test).agg(F.count(F.lit(1)), mean_absolute_error(LABEL, PREDICTION)).first())

    rows = _side_by_side(table.sparkSession, score, list(models.items()))
    return table.sparkSession.createDataFrame(
        rows, "model_type string, is_business boolean, test_rows bigint, mae double"
    )


def fold_scores(
    table: DataFrame,
    parameters: Parameters = Parameters(),
    train_months: int = 6,
    test_months: int = 3,
    max_folds: int | None = None,
) -> DataFrame:
    """Fit and score each month fold; ``max_folds=1`` keeps the first one only.

    The months of the folds (never rows) come to the driver, so that each fold is a
    filter on months, which prunes month partitions, and not a join.
    """
    roles = first_folds(month_roles(table, "date", train_months, test_months), max_folds)
    months: dict[int, dict[str, list[int]]] = {}
    for fold_id, role, number in roles.select("fold_id", "role", "month_number").collect():
        months.setdefault(fold_id, {"train": [], "test": []})[role].append(number)

    rows = table.drop(*NON_FEATURE_COLUMNS)
    number = month_number(F.col("date"))
    parts = {"year", "month"} <= set(table.columns)

    def score(fold_id: int) -> tuple[int, float]:
        used = months[fold_id]
        every = used["train"] + used["test"]
        frame = rows
        if parts:  # of a table stored by month, other months are not read
            pairs = [(F.col("year") == y) & (F.col("month") == m) for y, m in map(year_and_month, every)]
            frame = frame.filter(reduce(or_, pairs))
        frame = frame.filter(number.isin(every)).withColumn(IS_TEST, number.isin(used["test"])).drop("date")
        return fold_id, test_error(fit(frame, parameters), frame)

    spark = table.sparkSession
    return spark.createDataFrame(_side_by_side(spark, score, sorted(months)), "fold_id int, mae double")


def feature_importances(spark: SparkSession, model: PipelineModel, frame: DataFrame) -> DataFrame:
    """feature, importance, importance_perc and importance_perc_cumulative, best first."""
    fitted = model.stages[-1]
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    hot = next((s for s in model.stages if isinstance(s, OneHotEncoderModel)), None)
    widths = dict(zip(hot.getOutputCols(), hot.categorySizes)) if hot else {}
    inputs = assembler.getInputCols()
    slots = fitted.featureImportances.toArray() if hasattr(fitted, "featureImportances") else abs(fitted.coefficients.toArray())
    # the slots of a one-hot column count together
    ends = list(accumulate(widths.get(n, 1) for n in inputs))
    scores = [sum(slots[start:end]) for start, end in zip([0, *ends], ends)]
    names = [n.removesuffix("__index").removesuffix("__hot") for n in inputs]
    table = spark.createDataFrame(
        [(n, float(s)) for n, s in zip(names, scores)], "feature string, importance double"
    )
    return cumulative_share(table, "feature", "importance", ranges=1)


def weaker_than_noise(importances: DataFrame) -> DataFrame:
    """Features that matter less than the noise column."""
    return below_reference(importances, "feature", "importance", "noise")


def learning_curve(frame: DataFrame, parameters: Parameters = Parameters()) -> DataFrame:
    """Train and test error of every boosting round."""
    curve = fit_with_curve(frame, parameters)[1]
    return frame.sparkSession.createDataFrame(curve, "iteration int, train double, valid double")


def sample_candidates(
    space: dict[str, list], n: int, seed: int = 42, objectives: tuple[str, ...] = ("l2",)
) -> dict[str, Parameters]:
    """``n`` seeded draws from lists of estimator options; ``rounds`` may be one of them."""
    draw = random.Random(seed)

    def candidate() -> Parameters:
        objective = draw.choice(objectives)
        options = {name: draw.choice(list(values)) for name, values in space.items()}
        rounds = {"rounds": options.pop("rounds")} if "rounds" in options else {}
        return Parameters(objective, seed, options=options, **rounds)

    return {f"candidate {i}": candidate() for i in range(1, n + 1)}


def candidate_scores(frame: DataFrame, candidates: dict[str, Parameters]) -> DataFrame:
    """Test error of each parameter candidate."""
    frame = frame.persist(StorageLevel.MEMORY_AND_DISK)

    def score(item: tuple[str, Parameters]) -> tuple[str, str, float]:
        name, parameters = item
        return name, parameters.objective, test_error(fit(frame, parameters), frame)

    spark = frame.sparkSession
    rows = _side_by_side(spark, score, list(candidates.items()))
    frame.unpersist()
    return spark.createDataFrame(rows, "candidate string, objective string, mae double")


def best_parameters(frame: DataFrame, candidates: dict[str, Parameters]) -> tuple[Parameters, DataFrame]:
    """The candidate with the lowest test error, and the scores of all."""
    scores = candidate_scores(frame, candidates)
    return candidates[best_candidate(scores, "candidate", "mae").first()[0]], scores


def with_options(parameters: Parameters, **options) -> Parameters:
    return replace(parameters, options=parameters.options | options)


def model_path(base: str, run_date: datetime.date, model_type: str, is_business: bool) -> str:
    name = f"{model_type}_{'business' if is_business else 'not_business'}"
    return day_path(base, run_date, name)


def save_model(model: PipelineModel, path: str, keep: int = 2) -> None:
    """Save the model as a new version below ``path``, which readers see once it is whole.

    A save that breaks off leaves the model before in place. The newest ``keep`` versions
    stay, so that a job that is loading one can finish.
    """
    spark = SparkSession.active()
    version = (versions.published(spark, path) or 0) + 1
    model.write().overwrite().save(versions.version_path(path, version))
    versions.publish(spark, path, version)
    versions.prune(spark, path, keep)


def save_segments(fitted: dict[tuple[str, bool], PipelineModel], base: str, run_date: datetime.date) -> None:
    """Save the model of every segment below the day of the run."""
    for (kind, side), model in fitted.items():
        save_model(model, model_path(base, run_date, kind, side))


def score_segments(table: DataFrame, base: str, run_date: datetime.date) -> DataFrame:
    """Rows of the table with the prediction of their segment's saved model, and the segment.

    Segments without a saved model are left out.
    """
    scored = []
    for kind, side in segments():
        model = load_model(model_path(base, run_date, kind, side))
        if model is not None:
            part = predict(model, segment(table, kind, side).drop("date"))
            part = part.select("client_id", "datetime", PREDICTION)
            scored.append(part.withColumns({"model_type": F.lit(kind), "is_business": F.lit(side)}))
    if not scored:
        return table.select("client_id", "datetime").limit(0).withColumns(
            {PREDICTION: F.lit(0.0), "model_type": F.lit(""), "is_business": F.lit(False)}
        )
    return reduce(DataFrame.unionByName, scored)


def load_model(path: str) -> PipelineModel | None:
    """The newest model that was saved whole, or None if there is none at ``path``."""
    version = versions.published(SparkSession.active(), path)
    return None if version is None else PipelineModel.load(versions.version_path(path, version))


def score_interval(
    sources: Sources, path: str, model_type: str, is_business: bool, start, end, **options
) -> DataFrame | None:
    """Load a model, build its feature table for the interval and predict; None without a model."""
    model = load_model(path)
    if model is None:
        return None
    table = scoring_table(sources, start, end, model_type=model_type, is_business=is_business, **options)
    return predict(model, table.drop("date"))
