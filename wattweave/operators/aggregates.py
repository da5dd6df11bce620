"""Group means, shares, errors and table profiles."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattweave.functions.columns import quoted
from wattweave.operators.ordering import running_total

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def group_mean(df: DataFrame, by: list[str], means: list[str], constants: list[str] = ()) -> DataFrame:
    """32-bit mean of each measure per group, and one value of columns constant within it."""
    return df.groupBy(*by).agg(
        *[F.avg(quoted(c)).cast("float").alias(c) for c in means],
        *[F.min(quoted(c)).alias(c) for c in constants],
    )


def distinct_periods(df: DataFrame, ts: str) -> DataFrame:
    """Distinct (year, month) of a time column."""
    return df.select(F.year(quoted(ts)).alias("year"), F.month(quoted(ts)).alias("month")).distinct()


def latest(df: DataFrame, column: str) -> Column:
    """Maximum of a column as a scalar subquery, usable in any expression."""
    return df.agg(F.max(quoted(column))).scalar()


def mean_absolute_error(label: str, prediction: str) -> Column:
    return F.avg(F.abs(quoted(label).cast("double") - quoted(prediction)))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(quoted(a), quoted(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"r{i}").alias("correlation"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: type, rows, non-null and null counts, and whether all are null."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(quoted(c)).alias(f"__n{i}") for i, c in enumerate(df.columns)],
    )
    cells = [
        F.struct(
            F.lit(name).alias("column"),
            F.lit(kind).alias("type"),
            F.col("__rows").alias("rows"),
            F.col(f"__n{i}").alias("non_null"),
        )
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    nulls = F.col("rows") - F.col("non_null")
    return counts.select(F.inline(F.array(*cells))).withColumns({"nulls": nulls, "all_null": F.col("non_null") == 0})


def has_null_column(df: DataFrame) -> Column:
    """Whether some column holds nothing but nulls, as a scalar subquery."""
    return table_profile(df).agg(F.coalesce(F.bool_or("all_null"), F.lit(False))).scalar()


@dataclass
class _Slice:
    """An interval of a column's values that is to hold the ranks around a quantile."""

    column: str
    quantile: float
    count: int  # values in the column
    least: float | None = None  # values outside (least, most) are known not to hold the ranks
    most: float | None = None
    before: int = 0  # values up to ``least``
    among: int = 0  # values in (least, most)
    low: float = 0.0
    high: float = 0.0
    below: int = 0  # values below ``low``

    def ranks(self) -> tuple[int, int]:
        """The first and last wanted rank, from 1; they are the same or neighbours."""
        place = (self.count - 1) * self.quantile
        return math.floor(place) + 1, math.ceil(place) + 1

    def bracket(self) -> Column:
        value, held = quoted(self.column).cast("double"), quoted(self.column).isNotNull()
        if self.least is not None:
            held &= value > F.lit(self.least)
        if self.most is not None:
            held &= value < F.lit(self.most)
        return held

    def holds(self) -> Column:
        return quoted(self.column).cast("double").between(self.low, self.high)


def _sketch(df: DataFrame, slices: list[_Slice], accuracy: int) -> list[tuple[float, float]]:
    """For every slice, an interval that should hold its ranks, sketched from the values of its bracket."""
    margin = 2 / accuracy
    wanted = []
    for k, part in enumerate(slices):
        first, last = part.ranks()
        low, high = (first - 1 - part.before) / part.among - margin, (last - part.before) / part.among + margin
        edges = [min(max(edge, 0.0), 1.0) for edge in (low, high)]
        value = F.when(part.bracket(), quoted(part.column).cast("double"))
        wanted.append(F.percentile_approx(value, edges, accuracy).alias(f"b{k}"))
    return [tuple(edges) for edges in df.agg(*wanted).first()]


def _rank_slices(df: DataFrame, counts: dict[str, int], quantiles: tuple[float, ...], accuracy: int) -> list[_Slice]:
    """An interval with the wanted ranks in it for every quantile of every column with values.

    Ranks outside an interval narrow the bracket to the side that holds them, which leaves out
    at least the interval itself; so the search ends, whatever the sketches say. Usually one
    sketch and one count of all columns do.
    """
    slices = [_Slice(c, q, n, among=n) for c, n in counts.items() if n for q in quantiles]
    open_, unsketched = slices, slices
    while open_:
        if unsketched:
            for part, edges in zip(unsketched, _sketch(df, unsketched, accuracy)):
                part.low, part.high = edges
        seen = []
        for k, part in enumerate(open_):
            value, low, high = quoted(part.column).cast("double"), F.lit(part.low), F.lit(part.high)
            under, over = F.when(value < low, value), F.when(value > high, value)
            cells = [F.count(under), F.max(under), F.count(over), F.min(over)]
            seen.append(F.struct(*[cell.alias(name) for cell, name in zip(cells, ("below", "prior", "above", "next"))]).alias(f"c{k}"))
        found = df.agg(*seen).first()
        missed, unsketched = [], []
        for k, part in enumerate(open_):
            below, prior, above, following = found[f"c{k}"]
            part.below, upto = below, part.count - above
            first, last = part.ranks()
            if below < first and last <= upto:
                continue
            missed.append(part)
            if last <= below:
                part.most, part.among = part.low, below - part.before
                unsketched.append(part)
            elif first > upto:
                part.least, part.before, part.among = part.high, upto, part.before + part.among - upto
                unsketched.append(part)
            elif first <= below:  # the first rank is the value just before the interval
                part.low = prior
            else:
                part.high = following
        open_ = missed
    return slices


def describe(
    df: DataFrame,
    columns: list[str] | None = None,
    quantiles: tuple[float, ...] = (0.25, 0.5, 0.75),
    accuracy: int = 10_000,
    **options,
) -> DataFrame:
    """count, mean, std, min, exact quantiles (linear interpolation) and max per numeric column.

    A mergeable quantile sketch gives for every quantile a narrow interval of values that
    should hold it, and a count shows whether it does; if not, the values on the side of the
    missed ranks are sketched again (``_rank_slices``). Only values in the intervals found
    are put in order, so no pass shuffles or sorts whole columns.
    ``options`` go to ``running_total``.
    """
    columns = [c for c, kind in df.dtypes if kind in NUMERIC] if columns is None else columns
    per_column = [
        F.struct(
            F.count(quoted(c)).alias("count"),
            F.avg(quoted(c)).alias("mean"),
            F.stddev_samp(quoted(c)).alias("std"),
            F.min(quoted(c)).cast("double").alias("min"),
            F.max(quoted(c)).cast("double").alias("max"),
        ).alias(f"m{i}")
        for i, c in enumerate(columns)
    ]
    wide = df.agg(*per_column)
    row = wide.first()
    wide = df.sparkSession.createDataFrame([row], wide.schema)  # one row, so it is not computed again
    moments = wide.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("m")) for i, c in enumerate(columns)]))
    ).select("column", "m.*")
    slices = _rank_slices(df, {c: row[f"m{i}"]["count"] for i, c in enumerate(columns)}, quantiles, accuracy)
    if not slices:
        return moments.select(
            "column", "count", "mean", "std", "min", *[F.lit(None).cast("double").alias(_p(q)) for q in quantiles], "max"
        )

    inside = [part.holds() for part in slices]
    cells = [
        F.struct(F.lit(k).alias("slice"), F.when(held, quoted(part.column).cast("double")).alias("value"))
        for k, (part, held) in enumerate(zip(slices, inside))
    ]
    values = (
        df.filter(reduce(Column.__or__, inside))
        .select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("slice", "value")
        .agg(F.count(F.lit(1)).alias("times"))
    )
    # one row per slice: rows of the slices before it, rows below its values, wanted ranks
    known = df.sparkSession.createDataFrame(
        [(k, part.column, float(part.quantile), part.below, part.count - 1) for k, part in enumerate(slices)],
        "slice int, column string, q double, below bigint, steps bigint",
    )
    sizes = values.groupBy("slice").agg(F.sum("times").alias("held"))
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    wanted = (
        known.join(sizes, on="slice")
        .withColumn("skip", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
        .withColumn("place", F.col("steps") * F.col("q"))
    )
    last = F.col("upto") - F.col("skip") + F.col("below")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((rank > last - F.col("times")) & (rank <= last), F.col("value")))

    low, high, part = F.col("low"), F.col("high"), F.col("place") - F.floor("place")
    exact = (
        running_total(values, ["slice", "value"], "times", "upto", **options)
        .join(F.broadcast(wanted), on="slice")  # columns x quantiles rows
        .groupBy("slice", "column", "q", "place")
        .agg(at_rank(F.floor("place") + 1).alias("low"), at_rank(F.ceil("place") + 1).alias("high"))
        .withColumn("exact", low + (high - low) * part)
        .groupBy("column")
        .agg(*[F.max(F.when(F.col("q") == float(q), F.col("exact"))).alias(_p(q)) for q in quantiles])
    )
    return moments.join(F.broadcast(exact), on="column", how="left").select(
        "column", "count", "mean", "std", "min", *[_p(q) for q in quantiles], "max"
    )


def _p(q: float) -> str:
    return f"p{round(q * 100)}"


def cumulative_share(df: DataFrame, name: str, score: str, **options) -> DataFrame:
    """Scores in descending order with percent of the total and cumulative percent.

    Ties are ordered by name. ``options`` go to ``running_total``.
    """
    total = df.agg(F.sum(quoted(score))).scalar()
    shares = df.withColumn(f"{score}_perc", quoted(score) / total * 100)
    return running_total(
        shares,
        [score, name],
        f"{score}_perc",
        f"{score}_perc_cumulative",
        descending=(score,),
        **options,
    )


def below_reference(df: DataFrame, name: str, score: str, reference: str = "noise") -> DataFrame:
    """Rows whose score is below that of the reference row."""
    bar = df.filter(quoted(name) == reference).agg(F.max(quoted(score))).scalar()
    return df.filter(quoted(score) < bar)


def best_candidate(df: DataFrame, candidate: str, score: str) -> DataFrame:
    """The candidate with the lowest score."""
    return df.agg(F.min_by(quoted(candidate), quoted(score)).alias(candidate), F.min(quoted(score)).alias(score))
