"""Linear fits from mergeable sums: one pass over the rows, any set of months afterwards."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add, and_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wattweave.functions.columns import quoted
from wattweave.operators.splits import first_folds, month_number, roles_of_months
from wattweave.session import durable


@dataclass(frozen=True)
class Moments:
    """Rows, sums and sums of products of features and label; adding two is merging their rows."""

    rows: int
    sums: np.ndarray  # of the features, then of the label
    products: np.ndarray  # symmetric

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.rows + other.rows, self.sums + other.sums, self.products + other.products)

    def of(self, places: list[int]) -> Moments:
        """The moments of some of the features (by place) and the label."""
        kept = [*places, len(self.sums) - 1]
        return Moments(self.rows, self.sums[kept], self.products[np.ix_(kept, kept)])

    def solve(self, penalty: float = 0.0) -> tuple[float, np.ndarray]:
        """Intercept and coefficients of least squares; ``penalty`` is added to the centred squares (ridge).

        Where the features do not determine them, the shortest coefficients are taken.
        """
        mean = self.sums / self.rows
        centred = self.products - self.rows * np.outer(mean, mean)
        squares = centred[:-1, :-1] + penalty * np.eye(len(mean) - 1)
        coefficients = np.linalg.lstsq(squares, centred[:-1, -1], rcond=1e-12)[0]
        return float(mean[-1] - mean[:-1] @ coefficients), coefficients

    def squared_error(self, intercept: float, coefficients: np.ndarray) -> float:
        """Sum of squared errors of a linear model over these rows."""
        weights = np.append(-coefficients, 1.0)
        total = self.rows * intercept**2 + weights @ self.products @ weights - 2 * intercept * (weights @ self.sums)
        return max(float(total), 0.0)


def moment_columns(names: list[str]) -> dict[str, Column]:
    """Aggregates for the sums of all columns and of all their products."""
    values = [quoted(name).cast("double") for name in names]
    sums = {f"s{i}": F.sum(v) for i, v in enumerate(values)}
    products = {f"p{i}_{j}": F.sum(values[i] * values[j]) for i in range(len(values)) for j in range(i, len(values))}
    return {"rows": F.count(F.lit(1))} | sums | products


def month_moments(df: DataFrame, features: list[str], label: str, date: str = "date") -> DataFrame:
    """One row per month: month_number and the moments of its rows, written to the shared folder.

    The only pass over the rows. Rows with a null among the columns used are left out.
    """
    names = [*features, label]
    known = reduce(and_, [quoted(c).isNotNull() for c in [date, *names]])
    number = month_number(quoted(date)).alias("month_number")
    grouped = df.filter(known).groupBy(number)
    return durable(grouped.agg(*[column.alias(name) for name, column in moment_columns(names).items()]))


def read_moments(row, size: int) -> Moments:
    """Moments of ``size`` columns from a row made by :func:`moment_columns`."""
    products = np.array([[row[f"p{min(i, j)}_{max(i, j)}"] for j in range(size)] for i in range(size)])
    return Moments(row["rows"], np.array([row[f"s{i}"] for i in range(size)]), products)


def moments_by_month(moments: DataFrame, size: int) -> dict[int, Moments]:
    """Moments by month number; a row per calendar month comes to the driver."""
    return {row["month_number"]: read_moments(row, size) for row in moments.collect()}


def merged(parts: list[Moments]) -> Moments:
    return reduce(add, parts)


def fold_linear_scores(
    df: DataFrame,
    features: list[str],
    label: str,
    date: str = "date",
    train_months: int = 6,
    test_months: int = 3,
    penalty: float = 0.0,
    max_folds: int | None = None,
) -> DataFrame:
    """Linear fit and test error of every month fold, from one pass over the rows.

    Columns: fold_id, train_rows, test_rows, intercept, coefficients, rmse, and naive_rmse
    (of the training rows' mean). Only months, never rows, come to the driver.
    """
    months = month_moments(df, features, label, date)
    by_month = moments_by_month(months, len(features) + 1)
    roles = first_folds(roles_of_months(months.select("month_number"), train_months, test_months), max_folds)
    folds: dict[int, dict[str, list[Moments]]] = {}
    for row in roles.collect():
        folds.setdefault(row["fold_id"], {"train": [], "test": []})[row["role"]].append(by_month[row["month_number"]])

    def score(fold_id: int) -> tuple:
        train, test = (merged(folds[fold_id][role]) for role in ("train", "test"))
        intercept, coefficients = train.solve(penalty)
        none = np.zeros(len(coefficients))
        errors = (test.squared_error(intercept, coefficients), test.squared_error(float(train.sums[-1] / train.rows), none))
        return (fold_id, train.rows, test.rows, intercept, coefficients.tolist(), *[(e / test.rows) ** 0.5 for e in errors])

    kinds = "fold_id int, train_rows long, test_rows long, intercept double, coefficients array<double>, rmse double, naive_rmse double"
    return df.sparkSession.createDataFrame([score(fold_id) for fold_id in sorted(folds)], kinds)
