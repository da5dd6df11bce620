"""Linear scores of month folds and an evolving search, over daily order totals per nation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattweave.operators.moments import fold_linear_scores
from wattweave.plans.search import Evolution, evolve, linear_scorer
from wattweave.registry import query
from wattweave.registry.folds import _COMPLETE, _FOLDS
from wattweave.sources.views import table


def daily_orders(spark, folder) -> DataFrame:
    """c_nationkey, date, target (sum of order totals), orders, weekday, month, day."""
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    date = F.col("o_orderdate").cast("date").alias("date")
    daily = table(spark, folder, "orders").join(customers, on="o_custkey").groupBy("c_nationkey", date)
    parts = {"weekday": F.weekday("date") + 1, "month": F.month("date"), "day": F.day("date")}
    return daily.agg(F.sum("o_totalprice").alias("target"), F.count(F.lit(1)).alias("orders")).withColumns(parts)


DAILY = """daily AS (
        SELECT c_nationkey, o_orderdate::DATE AS date, sum(o_totalprice) AS target, count(*)::DOUBLE AS orders,
               isodow(o_orderdate)::DOUBLE AS weekday, month(o_orderdate)::DOUBLE AS month, day(o_orderdate)::DOUBLE AS day
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
    )"""


@query(
    "fold_linear_scores",
    _FOLDS.format(train=6, test=3)
    + f""", {DAILY}, chosen AS (
        SELECT fold_id, role, orders AS x, weekday AS w, target AS y FROM used JOIN daily ON date = d WHERE {_COMPLETE}
    ), centre AS (
        SELECT fold_id, count(*) AS n, avg(x) AS mx, avg(w) AS mw, avg(y) AS my FROM chosen WHERE role = 'train' GROUP BY 1
    ), sums AS (
        SELECT fold_id, sum((x - mx) ^ 2) + 1 AS xx, sum((w - mw) ^ 2) + 1 AS ww, sum((x - mx) * (w - mw)) AS xw,
               sum((x - mx) * (y - my)) AS xy, sum((w - mw) * (y - my)) AS wy
        FROM chosen JOIN centre USING (fold_id) WHERE role = 'train' GROUP BY 1
    ), line AS (
        SELECT fold_id, n, mx, mw, my, (xy * ww - wy * xw) / (xx * ww - xw * xw) AS b, (wy * xx - xy * xw) / (xx * ww - xw * xw) AS c
        FROM sums JOIN centre USING (fold_id)
    )
    SELECT fold_id, n AS train_rows, count(*) AS test_rows, round(my - b * mx - c * mw, 2) AS intercept,
           round(b, 2) AS orders_coefficient, round(c, 2) AS weekday_coefficient,
           round(sqrt(avg((y - (my + b * (x - mx) + c * (w - mw))) ^ 2)), 2) AS rmse,
           round(sqrt(avg((y - my) ^ 2)), 2) AS naive_rmse
    FROM chosen JOIN line USING (fold_id) WHERE role = 'test' GROUP BY fold_id, n, mx, mw, my, b, c
    """,
)
def fold_linear(spark, folder):
    """Daily totals by number of orders and weekday, ridge: every fold solved from the sums of its months."""
    daily = daily_orders(spark, folder)
    scores = fold_linear_scores(daily, ["orders", "weekday"], "target", train_months=6, test_months=3, penalty=1.0)
    return scores.select(
        "fold_id",
        "train_rows",
        "test_rows",
        F.round("intercept", 2).alias("intercept"),
        F.round(F.col("coefficients")[0], 2).alias("orders_coefficient"),
        F.round(F.col("coefficients")[1], 2).alias("weekday_coefficient"),
        F.round("rmse", 2).alias("rmse"),
        F.round("naive_rmse", 2).alias("naive_rmse"),
    )


SPACE = {
    "feature": ["orders", "weekday", "month", "day"],
    "penalty": [0.0, 100.0, 1000.0, 10000.0],
    "months": [3, 6, 12, 24, 48],
}
EVOLUTION = Evolution(population=10, generations=5)


def _draw(generation: int, slot: str, what: str, n: int) -> str:
    digest = f"md5('{EVOLUTION.seed}|{generation}|' || {slot} || '|' || {what})"
    return f"(('0x' || substr({digest}, 1, 8))::BIGINT % {n})"


def _evolution_sql() -> str:
    """Every candidate scored, then the generations one after the other."""
    choices = {name: f"(VALUES {', '.join(f'({i}, {v!r})' for i, v in enumerate(values))})" for name, values in SPACE.items()}
    slots = f"range({EVOLUTION.population}) slots(slot)"
    first = ", ".join(f"{_draw(0, 'slot', repr(name), len(values))} AS {name}_i" for name, values in SPACE.items())
    steps = [f"g0 AS (SELECT slot, {first} FROM {slots})"]
    for g in range(1, EVOLUTION.generations):
        seen = " UNION ALL ".join(f"SELECT * EXCLUDE (slot) FROM g{k}" for k in range(g))
        genes = []
        for name, values in SPACE.items():
            mixed = f"{_draw(g, 'a.s', repr('crossover'), 100)} < {EVOLUTION.crossover} AND {_draw(g, 'a.s', repr('side ' + name), 2)} = 1"
            anew = f"{_draw(g, 'a.s', repr('mutation ' + name), 100)} < {EVOLUTION.mutation}"
            fresh = _draw(g, "a.s", repr("value " + name), len(values))
            genes.append(f"CASE WHEN {anew} THEN {fresh} WHEN {mixed} THEN b.{name}_i ELSE a.{name}_i END AS {name}_i")
        genes_of = ", ".join(f"{name}_i" for name in SPACE)
        picked = _draw(g, "s", "side || k", EVOLUTION.population)
        steps.append(f"""parents{g} AS (
        SELECT s, side, {genes_of}
        FROM (SELECT s, side, {picked} AS slot FROM range(1, {EVOLUTION.population}) r(s), (VALUES ('first'), ('second')) v(side),
                     range({EVOLUTION.tournament}) t(k))
        JOIN g{g - 1} USING (slot) JOIN scores USING ({genes_of})
        QUALIFY row_number() OVER (PARTITION BY s, side ORDER BY score, slot) = 1
    ), g{g} AS (
        SELECT 0 AS slot, {genes_of}
        FROM (SELECT {genes_of} FROM ({seen}) JOIN scores USING ({genes_of}) ORDER BY score, candidate LIMIT 1)
        UNION ALL
        SELECT a.s, {', '.join(genes)} FROM parents{g} a JOIN parents{g} b ON a.s = b.s AND a.side = 'first' AND b.side = 'second'
    )""")
    genes_of = ", ".join(f"{name}_i" for name in SPACE)
    members = " UNION ALL ".join(f"SELECT {g} AS generation, * FROM g{g}" for g in range(EVOLUTION.generations))
    label = " || ',' || ".join(f"'{name}=' || {name}" for name in SPACE)
    return f"""
    WITH {DAILY}, tall AS (
        SELECT date, target AS y, feature, x FROM daily
        UNPIVOT (x FOR feature IN ({', '.join(SPACE['feature'])}))
    ), border AS (
        SELECT date_trunc('month', max(date))::DATE - INTERVAL 2 MONTH AS b FROM daily
    ), candidates AS (
        SELECT *, {label} AS candidate
        FROM {choices['feature']} f(feature_i, feature), {choices['penalty']} p(penalty_i, penalty),
             {choices['months']} m(months_i, months)
    ), centre AS (
        SELECT feature_i, penalty_i, months_i, avg(x) AS mx, avg(y) AS my
        FROM candidates JOIN tall USING (feature), border WHERE date < b AND date >= b - to_months(months) GROUP BY ALL
    ), line AS (
        SELECT feature_i, penalty_i, months_i, mx, my, sum((x - mx) * (y - my)) / (sum((x - mx) ^ 2) + any_value(penalty)) AS slope
        FROM candidates JOIN centre USING ({genes_of}) JOIN tall USING (feature), border
        WHERE date < b AND date >= b - to_months(months) GROUP BY ALL
    ), scores AS (
        SELECT {genes_of}, candidate, round(avg(abs(y - (my + slope * (x - mx)))), 2) AS score
        FROM candidates JOIN line USING ({genes_of}) JOIN tall USING (feature), border WHERE date >= b GROUP BY ALL
    ), {', '.join(steps)}, every AS (
        SELECT generation, slot, candidate, score FROM ({members}) JOIN scores USING ({genes_of})
    )
    SELECT generation::INTEGER AS generation, slot::INTEGER AS slot, candidate, score,
           row_number() OVER (PARTITION BY candidate ORDER BY generation, slot) = 1 AS fitted,
           min(score) OVER (ORDER BY generation RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS best_score
    FROM every
    """


@query("evolved_candidates", _evolution_sql())
def evolved_candidates(spark, folder):
    """Ridge on one feature of the daily totals: feature, penalty and training months are searched for."""
    daily = daily_orders(spark, folder)
    return evolve(spark, SPACE, linear_scorer(daily, SPACE["feature"], "target"), EVOLUTION)
