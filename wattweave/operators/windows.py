"""Rolling means over half-open time frames, and prior-period means."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattweave.functions.calendar import epoch_micros
from wattweave.functions.columns import quoted, sql_name
from wattweave.session import durable

BUCKETS_PER_PERIOD = 48
#: Points and expiries that one task handles at once; a bucket of more is cut into parts.
DENSE_ROWS = 200_000
#: A dense bucket is cut into up to so many parts, these again, and so on.
FANOUT = 16
#: Up to so many dense buckets are sent to all tasks; more are joined.
BROADCAST_NODES = 50_000
DAY = datetime.timedelta(days=1)
WEEK = datetime.timedelta(days=7)


def _micros(period: datetime.timedelta) -> int:
    return period // datetime.timedelta(microseconds=1)


def _widths(width: int) -> list[int]:
    """Widths of the levels of a time tree: ``width``, and down to one microsecond by at most ``FANOUT`` parts each.

    Every width divides the one above it, so the parts of a bucket moved by a period are
    those of the bucket it falls on. A width without a small divisor is cut by its smallest one.
    """
    levels = [width]
    while levels[-1] > 1:
        last = levels[-1]
        small = [parts for parts in range(2, FANOUT + 1) if last % parts == 0]
        parts = max(small) if small else next((k for k in range(FANOUT + 1, int(last**0.5) + 1) if last % k == 0), last)
        levels.append(last // parts)
    return levels


def _same(keys: list[str], suffix: str) -> str:
    return " AND ".join(f"{k} <=> {k}{suffix}" for k in keys)


def _start(column: str, width: int) -> str:
    return f"({column} - pmod({column}, {width}L))"


def _dense_nodes(marks: DataFrame, keys: list[str], widths: list[int], limit: int) -> list[DataFrame]:
    """Per level, the (keys, node) of the time tree that hold more than ``limit`` marks; none on the lowest.

    A level is looked at only below the dense nodes of the level above, so a table without a
    dense bucket is counted once. Counts are combined before they are shuffled, and a level
    has at most one dense node for every ``limit`` marks.
    """
    levels: list[DataFrame] = []
    for width in widths[:-1]:
        within = _below(marks, keys, widths, levels).filter(f"__depth = {len(levels)}")
        nodes = within.groupBy(*keys, F.expr(_start("__at", width)).alias("__node")).agg(F.count(F.lit(1)).alias("__marks"))
        nodes = durable(nodes.filter(F.col("__marks") > limit).drop("__marks"))
        if nodes.isEmpty():
            break
        levels.append(nodes)
    return levels


def _below(marks: DataFrame, keys: list[str], widths: list[int], levels: list[DataFrame]) -> DataFrame:
    """With __depth, the number of dense nodes over a mark, and __leaf, the start of the node below them."""
    found = marks.withColumn("__depth", F.lit(0))
    for depth, nodes in enumerate(levels):
        renamed = nodes.selectExpr(*[f"{k} AS {k}_node" for k in keys], "__node")
        side = F.broadcast(renamed) if nodes.count() <= BROADCAST_NODES else renamed
        on = f"{_same(keys, '_node')} AND {_start('__at', widths[depth])} = __node"
        found = found.join(side, F.expr(on), "left").selectExpr(
            *[c for c in found.columns if c != "__depth"], "__depth + IF(__node IS NULL, 0, 1) AS __depth"
        )
    starts = " ".join(f"WHEN {depth} THEN {_start('__at', width)}" for depth, width in enumerate(widths[: len(levels) + 1]))
    return found.withColumn("__leaf", F.expr(f"CASE __depth {starts} END"))


def _around_leaves(
    leaves: DataFrame, totals: DataFrame, keys: list[str], parts: list[str], periods: int, widths: list[int], depth: int
) -> DataFrame:
    """(keys, __depth, __leaf, <part>_mid<i>) of every node: what its frame holds outside the node and its own expiries.

    ``totals`` has that of whole buckets. Down the tree, a node adds to its parent's the
    points of the parts before it and the expiries of the parts behind it. A window sees
    the parts of one node only.
    """
    mids = [f"{p}_mid{i}" for i in range(1, periods + 1) for p in parts]
    level = totals.selectExpr(*keys, "0 AS __depth", f"__bucket * {widths[0]}L AS __leaf", *mids)
    ladder = level
    for d in range(1, depth + 1):
        nodes = leaves.filter(f"__depth >= {d}").groupBy(
            *keys, F.expr(_start("__leaf", widths[d - 1])).alias("__above"), F.expr(_start("__leaf", widths[d])).alias("__node")
        )
        sums = [f"{p}_{kind}" for kind in range(periods + 1) for p in parts]
        nodes = nodes.agg(*[F.sum(c).alias(c) for c in sums])
        over = f"PARTITION BY {', '.join(keys)}, __above ORDER BY __node ROWS BETWEEN"
        added = [
            f"coalesce(sum({p}_0) OVER ({over} UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + "
            f"coalesce(sum({p}_{i}) OVER ({over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) AS {p}_add{i}"
            for i in range(1, periods + 1)
            for p in parts
        ]
        nodes = nodes.selectExpr(*keys, "__above", "__node", *added)
        parents = level.selectExpr(*[f"{k} AS {k}_above" for k in keys], "__leaf", *mids)
        level = nodes.join(parents, F.expr(f"{_same(keys, '_above')} AND __above = __leaf")).selectExpr(
            *keys,
            f"{d} AS __depth",
            "__node AS __leaf",
            *[f"coalesce({p}_mid{i}, 0) + {p}_add{i} AS {p}_mid{i}" for i in range(1, periods + 1) for p in parts],
        )
        ladder = ladder.unionByName(level)
    return ladder


def rolling_mean_by_frame(
    df: DataFrame,
    by: list[str],
    ts: str,
    columns: list[str],
    periods: dict[str, datetime.timedelta],
    rename: Callable[[str, str], str] = "{0}_{1}".format,
) -> DataFrame:
    """Append means over ``(t - period, t]`` with plain range frames.

    One sort per key serves all periods. The cost of a row grows with its frame and a
    key is one task, so this is for short series, such as one forecast run.
    """
    keyed = df.withColumn("__at", epoch_micros(quoted(ts)))
    keys = ", ".join(map(sql_name, by))
    means = [
        f"avg({sql_name(c)}) OVER (PARTITION BY {keys} ORDER BY __at "
        f"RANGE BETWEEN {_micros(period) - 1} PRECEDING AND CURRENT ROW) AS {sql_name(rename(c, label))}"
        for label, period in periods.items()
        for c in columns
    ]
    return keyed.selectExpr(*map(sql_name, df.columns), *means)


def rolling_mean(
    df: DataFrame,
    by: list[str],
    ts: str,
    columns: list[str],
    periods: dict[str, datetime.timedelta],
    rename: Callable[[str, str], str] = "{0}_{1}".format,
    buckets_per_period: int = BUCKETS_PER_PERIOD,
    short_series: bool = False,
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """Means over ``(t - period, t]``, one row per distinct key and time.

    Returns ``by``, ``ts``, ``__copies`` (number of input rows at that key and time)
    and one column per period and measure; ``repeat_rows`` turns it into one row
    per input row. Work per row does not depend on the length of the period and no
    task sees a whole series:

    * ties are added up first (sum and count per measure, combined before the shuffle);
    * time is cut into buckets, a fraction of the shortest period. The frame of a row
      is then the start of its own bucket, the whole buckets before, and the end of the
      bucket one period back;
    * the first part is a running sum within the bucket. Every point is also sent one
      period ahead as an expiry, so the last part is the running sum, from the end of
      the bucket, of the expiries still to come;
    * whole buckets are added over the small table of bucket totals;
    * a bucket with more than ``dense_rows`` points and expiries is the root of a tree: it is
      cut into parts, and those that are still too large again, down to a microsecond. The first and
      last part of a frame are then taken in a node without dense parts, and the sums of
      the nodes beside the way to it join the whole buckets. So no task depends on how a
      key's points lie in time. Rows are counted for this when the function is called; only
      if a bucket has too many are the points written to the shared folder, and counted by level.

    Sums only ever add values of the frame, so nothing cancels.

    ``short_series`` states that a key has few distinct times (an hourly grid, say): after
    ties are added up, plain range frames over the key then do, with one shuffle less.
    """
    if buckets_per_period < 2:
        raise ValueError("a period needs at least two buckets")
    width = min(_micros(p) for p in periods.values()) // buckets_per_period
    spans = {label: _micros(p) // width for label, p in periods.items()}
    for label, period in periods.items():
        if spans[label] * width != _micros(period):
            raise ValueError(f"period {label!r} is no multiple of the bucket width")

    # Wide SQL lists: one expression per measure and part would be slow to build one by one.
    index = range(len(columns))
    sums, counts = [f"__s{i}" for i in index], [f"__n{i}" for i in index]
    parts = sums + counts
    keys = [f"__k{i}" for i in range(len(by))]

    points = (
        df.groupBy(*[quoted(k).alias(a) for k, a in zip(by, keys)], quoted(ts).alias("__ts"))
        .agg(
            F.expr("count(1) AS __copies"),
            *[F.expr(f"sum(CAST({sql_name(c)} AS DOUBLE)) AS {s}") for c, s in zip(columns, sums)],
            *[F.expr(f"count({sql_name(c)}) AS {n}") for c, n in zip(columns, counts)],
        )
        .withColumn("__at", epoch_micros(F.col("__ts")))
        .withColumn("__bucket", F.expr(f"(__at - pmod(__at, {width}L)) DIV {width}L"))
    )

    if short_series:
        spanned = {
            label: f"OVER (PARTITION BY {', '.join(keys)} ORDER BY __at "
            f"RANGE BETWEEN {_micros(period) - 1} PRECEDING AND CURRENT ROW)"
            for label, period in periods.items()
        }
        return points.selectExpr(
            *[f"{a} AS {sql_name(k)}" for k, a in zip(by, keys)],
            f"__ts AS {sql_name(ts)}",
            "__copies",
            *[
                f"try_divide(sum({sums[c]}) {over}, sum({counts[c]}) {over}) AS {sql_name(rename(columns[c], label))}"
                for label, over in spanned.items()
                for c in index
            ],
        )

    # Kind 0 is the point itself, kind i its expiry for the i-th period.
    kinds = [(0, 0, 0)] + [(i, spans[p], _micros(periods[p])) for i, p in enumerate(periods, start=1)]
    rows_at = df.select(*[quoted(k).alias(a) for k, a in zip(by, keys)], epoch_micros(quoted(ts)).alias("__at"))
    counted = rows_at.groupBy(*keys, F.expr(_start("__at", width)).alias("__node")).agg(F.count(F.lit(1)).alias("__rows"))
    crowded = not counted.filter(F.col("__rows") > dense_rows // len(kinds)).isEmpty()
    if crowded:
        points = durable(points)
    marks = ", ".join(
        f"named_struct('__kind', {kind}, '__bucket', __bucket + {buckets}, '__at', __at + {micros})"
        for kind, buckets, micros in kinds
    )
    marked = points.selectExpr(*keys, "__ts", "__copies", *parts, f"inline(array({marks}))")

    levels, widths = [], []
    if crowded:
        widths = _widths(width)
        levels = _dense_nodes(marked.select(*keys, "__at"), keys, widths, dense_rows)
    place = ["__bucket"]
    if levels:
        place = ["__depth", "__leaf"]
        marked = _below(marked, keys, widths, levels)

    leaf = ", ".join([*keys, *place])
    arrived = f"PARTITION BY {leaf} ORDER BY __at RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    pending = f"PARTITION BY {leaf} ORDER BY -__at RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    edges = [f"sum(IF(__kind = 0, {p}, NULL)) OVER ({arrived}) AS {p}_in" for p in parts]
    edges += [
        f"sum(IF(__kind = {i}, {p}, NULL)) OVER ({pending}) AS {p}_out{i}" for i in range(1, len(kinds)) for p in parts
    ]
    rows = marked.selectExpr(*keys, "__ts", "__copies", "__kind", *place, *edges).filter("__kind = 0")

    inner = [
        f"sum({p}) OVER (PARTITION BY {', '.join(keys)} ORDER BY __bucket "
        f"RANGE BETWEEN {spans[label] - 1} PRECEDING AND 1 PRECEDING) AS {p}_mid{i}"
        for i, label in enumerate(periods, start=1)
        for p in parts
    ]
    totals = points.groupBy(*keys, "__bucket").agg(*[F.sum(p).alias(p) for p in parts])
    totals = totals.selectExpr(*keys, "__bucket", *inner)
    if levels:
        by_kind = [F.expr(f"sum(IF(__kind = {kind}, {p}, NULL))").alias(f"{p}_{kind}") for kind, *_ in kinds for p in parts]
        leaves = durable(marked.filter("__depth > 0").groupBy(*keys, *place).agg(*by_kind))
        totals = _around_leaves(leaves, totals, keys, parts, len(periods), widths, len(levels))
    totals = totals.withColumnsRenamed({c: f"{c}_whole" for c in keys + place})
    joined = rows.join(totals, F.expr(_same(keys + place, "_whole")), "left")

    def whole_frame(part: str, i: int) -> str:
        return f"(coalesce({part}_out{i}, 0) + coalesce({part}_mid{i}, 0) + coalesce({part}_in, 0))"

    return joined.selectExpr(
        *[f"{a} AS {sql_name(k)}" for k, a in zip(by, keys)],
        f"__ts AS {sql_name(ts)}",
        "__copies",
        *[
            f"try_divide({whole_frame(sums[c], i)}, {whole_frame(counts[c], i)}) AS {sql_name(rename(columns[c], p))}"
            for i, p in enumerate(periods, start=1)
            for c in index
        ],
    )


def prior_year_month_mean(df: DataFrame, ts: str, columns: list[str], suffix: str = "_monthly_historical") -> DataFrame:
    """Mean of each measure over the same month of all earlier years, per (year, month).

    Rows are reduced to one sum and count per month before anything is ordered, so the
    window sees one row per calendar month. Months without an earlier year are absent.
    """
    monthly = df.groupBy(F.year(quoted(ts)).alias("year"), F.month(quoted(ts)).alias("month")).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.sum(quoted(c).cast("double")).alias(f"__s{i}") for i, c in enumerate(columns)],
        *[F.count(quoted(c)).alias(f"__n{i}") for i, c in enumerate(columns)],
    )
    earlier = Window.partitionBy("month").orderBy("year").rangeBetween(Window.unboundedPreceding, -1)
    return (
        monthly.withColumns(
            {
                f"{c}{suffix}": F.try_divide(F.sum(f"__s{i}").over(earlier), F.sum(f"__n{i}").over(earlier))
                for i, c in enumerate(columns)
            }
            | {"__seen": F.sum("__rows").over(earlier)}
        )
        .filter(F.col("__seen") > 0)
        .select("year", "month", *[quoted(f"{c}{suffix}") for c in columns])
    )


def add_monthly_history(
    df: DataFrame, history: DataFrame, ts: str, columns: list[str], suffix: str = "_monthly_historical"
) -> DataFrame:
    """Join :func:`prior_year_month_mean` on year and month; nulls take the row's own value."""
    means = prior_year_month_mean(history, ts, columns, suffix)
    joined = df.join(F.broadcast(means), on=["year", "month"], how="left")  # one row per calendar month
    return joined.withColumns({f"{c}{suffix}": F.coalesce(quoted(f"{c}{suffix}"), quoted(c)) for c in columns})
