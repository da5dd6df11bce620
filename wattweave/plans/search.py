"""Search for model parameters by a population that evolves over generations."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wattweave.functions.columns import quoted
from wattweave.operators.moments import merged, moments_by_month, month_moments
from wattweave.operators.splits import month_number
from wattweave.plans import models

Candidate = tuple  # a value for each option, in the order of the space

MEMO = "candidate string, score double"


@dataclass(frozen=True)
class Evolution:
    """How a population evolves.

    In the first generation every slot draws its values. Later, slot 0 holds the best
    candidate so far; any other slot takes two parents, each the best of ``tournament``
    drawn slots of the generation before, mixes their values with a chance of
    ``crossover`` percent (else it is the first parent), and draws each value anew with a
    chance of ``mutation`` percent.

    Every draw is a hash of (seed, generation, slot, what is drawn), so that a search that is run
    again, in whole or from where it broke off, meets the same candidates.
    """

    population: int = 10
    generations: int = 5
    tournament: int = 3
    crossover: int = 80
    mutation: int = 20
    seed: int = 42

    def draw(self, generation: int, slot: int, what: str, n: int) -> int:
        """A number from 0 to n - 1."""
        digest = hashlib.md5(f"{self.seed}|{generation}|{slot}|{what}".encode(), usedforsecurity=False).hexdigest()
        return int(digest[:8], 16) % n

    def first(self, space: dict[str, list]) -> list[Candidate]:
        return [
            tuple(values[self.draw(0, slot, name, len(values))] for name, values in space.items())
            for slot in range(self.population)
        ]

    def following(
        self, space: dict[str, list], generation: int, before: list[Candidate], scores: list[float], best: Candidate
    ) -> list[Candidate]:
        """The population after ``before``, whose candidates have these scores (lower is better)."""

        def parent(slot: int, which: str) -> Candidate:
            drawn = [self.draw(generation, slot, f"{which}{k}", self.population) for k in range(self.tournament)]
            return before[min(drawn, key=lambda s: (scores[s], s))]

        def child(slot: int) -> Candidate:
            first, second = parent(slot, "first"), parent(slot, "second")
            mixed = self.draw(generation, slot, "crossover", 100) < self.crossover
            values = []
            for k, (name, choices) in enumerate(space.items()):
                taken = second if mixed and self.draw(generation, slot, f"side {name}", 2) else first
                anew = self.draw(generation, slot, f"mutation {name}", 100) < self.mutation
                values.append(choices[self.draw(generation, slot, f"value {name}", len(choices))] if anew else taken[k])
            return tuple(values)

        return [best] + [child(slot) for slot in range(1, self.population)]


def label(space: dict[str, list], candidate: Candidate) -> str:
    """``option=value`` of a candidate, joined by commas."""
    return ",".join(f"{name}={value}" for name, value in zip(space, candidate))


class Memo:
    """Scores of the candidates scored so far, in a table at ``path`` if one is given.

    A search that goes on with the table of one that broke off scores nothing twice.
    """

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        self.scores: dict[str, float] = {}
        if path is not None:
            spark.createDataFrame([], MEMO).write.mode("append").parquet(path)
            self.scores = {r["candidate"]: r["score"] for r in spark.read.schema(MEMO).parquet(path).collect()}

    def add(self, scores: dict[str, float]) -> None:
        self.scores |= scores
        if self.path is not None and scores:
            self.spark.createDataFrame(list(scores.items()), MEMO).coalesce(1).write.mode("append").parquet(self.path)


def evolve(
    spark: SparkSession,
    space: dict[str, list],
    score: Callable[[dict[str, Candidate]], dict[str, float]],
    evolution: Evolution = Evolution(),
    memo_path: str | None = None,
) -> DataFrame:
    """One row per (generation, slot): candidate, score, fitted, and best_score up to that generation.

    ``score`` gets the new candidates of a generation, by their label, all at once, and
    returns the score of each; lower is better. A candidate met before is taken from the
    memo, in which case fitted is false. Equal scores rank by label.
    """
    if not space or not all(space.values()):
        raise ValueError("every option needs a value to choose from")
    memo, rows = Memo(spark, memo_path), []
    members: list[Candidate] = []
    seen: dict[str, Candidate] = {}
    for generation in range(evolution.generations):
        if generation == 0:
            members = evolution.first(space)
        else:
            best = min(seen, key=lambda name: (memo.scores[name], name))
            scores = [memo.scores[label(space, member)] for member in members]
            members = evolution.following(space, generation, members, scores, seen[best])
        named = {label(space, member): member for member in members}
        new = {name: member for name, member in named.items() if name not in memo.scores}
        if new:
            memo.add({name: float(value) for name, value in score(new).items()})
        seen |= named
        best_score = min(memo.scores[name] for name in seen)
        for slot, member in enumerate(members):
            name = label(space, member)
            rows.append((generation, slot, name, memo.scores[name], new.pop(name, None) is not None, best_score))
    kinds = "generation int, slot int, candidate string, score double, fitted boolean, best_score double"
    return spark.createDataFrame(rows, kinds)


#: Options of the linear models that :func:`linear_scorer` scores.
LINEAR_OPTIONS = ("feature", "penalty", "months")


def linear_scorer(
    df: DataFrame, features: list[str], label: str, date: str = "date", test_months: int = 3, digits: int = 2
) -> Callable[[dict[str, Candidate]], dict[str, float]]:
    """Score of candidates (feature, penalty, months): ridge on one feature over the last months before the test months.

    The sums of all months are taken in one pass, so candidates are solved without reading
    training rows; one job over the test rows gives the mean absolute errors of a whole
    generation, rounded to ``digits``. A candidate without training rows has an infinite score.
    """
    by_month = moments_by_month(month_moments(df, features, label, date), len(features) + 1)
    border = max(by_month) - test_months
    known = reduce(and_, [quoted(c).isNotNull() for c in (*features, label)])
    test = df.filter((month_number(quoted(date)) > border) & known)

    def score(new: dict[str, Candidate]) -> dict[str, float]:
        errors = {}
        for name, (feature, penalty, months) in new.items():
            used = [m for number, m in by_month.items() if border - months < number <= border]
            if used:
                intercept, (slope,) = merged(used).of([features.index(feature)]).solve(penalty)
                guess = F.lit(intercept) + F.lit(float(slope)) * quoted(feature)
                errors[name] = F.round(F.avg(F.abs(quoted(label) - guess)), digits).alias(f"e{len(errors)}")
        found = test.agg(*errors.values()).first() if errors else []
        return dict.fromkeys(new, float("inf")) | dict(zip(errors, found))

    return score


def parameters_of(space: dict[str, list], candidate: Candidate, seed: int = 42) -> models.Parameters:
    """Model parameters of a candidate: objective and rounds by name, the others as options of the estimator."""
    values = dict(zip(space, candidate))
    fields = {name: values.pop(name) for name in ("objective", "rounds") if name in values}
    return models.Parameters(seed=seed, options=values, **fields)


def evolve_parameters(
    frame: DataFrame, space: dict[str, list], evolution: Evolution = Evolution(), memo_path: str | None = None
) -> tuple[models.Parameters, DataFrame]:
    """The parameters with the lowest test error that a search found, and its rows.

    The frame is that of :func:`models.model_frame`; the new candidates of a generation are fitted side by side.
    """

    def score(new: dict[str, Candidate]) -> dict[str, float]:
        scores = models.candidate_scores(frame, {n: parameters_of(space, c, evolution.seed) for n, c in new.items()})
        return {r["candidate"]: r["mae"] for r in scores.collect()}

    rows = evolve(frame.sparkSession, space, score, evolution, memo_path)
    by_label = _labels(space)
    best = rows.orderBy("score", "candidate").first()["candidate"]
    return parameters_of(space, by_label(best), evolution.seed), rows


def _labels(space: dict[str, list]) -> Callable[[str], Candidate]:
    """The candidate of a label."""

    def candidate(name: str) -> Candidate:
        parts = dict(part.split("=", 1) for part in name.split(","))
        return tuple(next(v for v in values if str(v) == parts[option]) for option, values in space.items())

    return candidate
