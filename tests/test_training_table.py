import datetime

import pytest
from pyspark.sql import functions as F

import fixture
from wattweave import schemas
from wattweave.plans.training_table import (
    add_weather_history,
    join_facts,
    join_sources,
    read_sources,
    scoring_table,
    store_sources,
    store_training_table,
    training_table,
)
from wattweave.sources import tables


@pytest.fixture(scope="module")
def paths(tmp_path_factory):
    return fixture.write(tmp_path_factory.mktemp("csv"))


@pytest.fixture(scope="module")
def from_csv(spark, paths):
    return read_sources(spark, paths)


@pytest.fixture(scope="module")
def stored_at(tmp_path_factory):
    return tmp_path_factory.mktemp("raw")


@pytest.fixture(scope="module")
def sources(from_csv, stored_at):
    return store_sources(from_csv, str(stored_at), datetime.date(2024, 1, 31))


@pytest.fixture(scope="module")
def table(sources):
    return training_table(sources, train_months=6, test_months=3).cache()


def test_loaded_schemas(from_csv, spark, paths):
    for name in ("metering", "clients", "gas", "electricity", "forecast", "measured"):
        loaded, wanted = getattr(from_csv, name), getattr(schemas, name.upper())
        assert loaded.dtypes == [(f.name, f.dataType.simpleString()) for f in wanted.fields], name
    stations = tables.read_stations(spark, paths["weather_station_map"])
    unknown = stations.filter("county = -1").first()
    assert unknown.county_name == "Unknown" and stations.count() == 4
    assert stations.filter("county = 0").first().latitude_max == pytest.approx(57.9, abs=1e-5)


def test_unmapped_station_is_its_own_group(sources):
    assert sources.measured.filter("county IS NULL").count() == sources.measured.filter("county = 1").count()


def test_missing_block_is_zero(spark, paths):
    raw = tables.read_csv(spark, paths["gas"]).drop("data_block_id")
    assert tables.shape_gas(raw).select("data_block_id").distinct().first()[0] == 0


def test_gas_mean_uses_wide_prices(spark):
    raw = spark.createDataFrame([("2023-01-01", "0.1", "0.2", "2023-01-01", "1")],
                                "forecast_date string, lowest_price_per_mwh string, highest_price_per_mwh string, origin_date string, data_block_id string")
    assert tables.shape_gas(raw).first().gas_mean_price_per_mhw == (0.1 + 0.2) / 2


def test_electricity_moves_one_day(sources):
    first = sources.electricity.orderBy("datetime").first()
    assert first.datetime == fixture.START + datetime.timedelta(days=1)


def test_schema(table):
    wanted = [(f.name, f.dataType.simpleString()) for f in schemas.TRAINING_TABLE.fields]
    assert table.dtypes == wanted + [("noise", "double")]


def test_rows_equal_brute_force(table, paths):
    want = fixture.expected_rows(paths)
    keys = ["county", "is_business", "is_consumption"]
    codes = {(c, b, k): (c, b, p, k) for c, b, p, k in fixture.SEGMENTS}
    got = {(codes[tuple(r[k] for k in keys)], r.datetime): r.asDict() for r in table.collect()}
    # the interval is open on the left, so nothing is cut here
    assert got.keys() == want.keys() and len(want) > 50
    for key, row in want.items():
        for name, value in row.items():
            if isinstance(value, str):
                assert got[key][name] == value
            else:
                assert got[key][name] == pytest.approx(value, rel=1e-4, abs=1e-4), (key, name)


def test_no_nulls_and_noise(table):
    assert table.filter(" OR ".join(f"`{c}` IS NULL" for c in table.columns)).count() == 0
    assert abs(table.agg(F.avg("noise")).first()[0]) < 0.5


def test_segment_keeps_ids(sources, table):
    part = training_table(sources, model_type="consumer", is_business=True, noise=False)
    whole = table.filter("is_consumption = 1 AND is_business = 1").drop("is_consumption", "is_business", "noise")
    assert part.columns == whole.columns
    assert part.exceptAll(whole).count() == 0 and part.count() == whole.count() > 0


def test_lag_forms_agree(sources):
    many = training_table(sources, noise=False, lags="join").cache()
    for lags in ("before", "after", "counts"):
        one = training_table(sources, noise=False, lags=lags).cache()
        assert one.count() == many.count() and one.exceptAll(many).count() == 0


def test_several_blocks_per_hour_fan_out(sources):
    """Rolling tables are joined without the block: each repeats a row once per block."""
    from dataclasses import replace

    again = sources.measured.withColumn("data_block_id", (F.col("data_block_id") + 100).cast("smallint"))
    doubled = replace(sources, measured=sources.measured.union(again))
    facts = join_facts(sources)
    assert not facts.repeats and join_facts(doubled).repeats
    with_weather = join_sources(sources, facts).filter("temperature_last_7_days IS NOT NULL").count()
    without = join_sources(sources, facts).filter("temperature_last_7_days IS NULL").count()
    assert join_sources(doubled, join_facts(doubled)).count() == 4 * with_weather + without
    with pytest.raises(ValueError, match="repeated keys"):
        training_table(doubled, noise=False, lag_days=2, lags="before")
    noisy = training_table(doubled, lag_days=1, lags="after")
    assert noisy.select("noise").distinct().count() == noisy.count()  # each copy that a join makes of a row has its own
    one = training_table(doubled, noise=False, lag_days=2, lags="after").cache()
    many = training_table(doubled, noise=False, lag_days=2, lags="join").cache()
    assert one.count() == many.count() > training_table(sources, noise=False, lag_days=2).count()
    assert one.distinct().exceptAll(many.distinct()).count() == 0
    counted = training_table(doubled, noise=False, lag_days=2)
    assert counted.count() == many.count() and counted.exceptAll(many).count() == 0


def test_a_constant_block_is_an_error(sources):
    from dataclasses import replace

    constant = replace(sources, gas=sources.gas.withColumn("data_block_id", F.lit(0).cast("smallint")))
    with pytest.raises(ValueError, match="gas has"):
        training_table(constant)


def test_stored_training_table_prunes_months(spark, table, tmp_path):
    stored = store_training_table(table, str(tmp_path), datetime.date(2024, 1, 31))
    assert stored.dtypes == table.dtypes and stored.count() == table.count()
    plan = stored.filter("year = 2022 AND month = 7")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    with pytest.raises(ValueError, match="nothing but nulls"):
        empty = table.withColumn("noise", F.lit(None).cast("double"))
        store_training_table(empty, str(tmp_path / "nulls"), datetime.date(2024, 1, 31))


def test_null_columns_are_found_while_writing(spark, tmp_path, monkeypatch):
    """The refusal needs no second look at the table, and names the columns; an empty table passes."""
    schema = "year int, month int, `a.b` double, c string, d int"
    rows = spark.createDataFrame([(2024, 1, None, "x", None), (2024, 2, None, None, None)], schema)
    stored = store_training_table(rows.limit(0), str(tmp_path / "none"), datetime.date(2024, 1, 31))
    assert stored.columns == rows.columns and stored.count() == 0
    monkeypatch.setattr(type(spark.read), "parquet", lambda *_: pytest.fail("the written table was read"))
    with pytest.raises(ValueError, match="nothing but nulls: a.b, d$"):
        store_training_table(rows, str(tmp_path / "nulls"), datetime.date(2024, 1, 31))


def test_a_large_month_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.lit(2024).alias("year"), F.lit(1).alias("month"), F.xxhash64("id").alias("a"), F.sha2(F.col("id").cast("string"), 256).alias("b")
    )
    limit = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        stored = store_training_table(rows, str(tmp_path), datetime.date(2024, 1, 31))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", limit)
    assert stored.count() == 200_000
    assert stored.select(F.input_file_name()).distinct().count() > 1


def test_scoring_interval(sources):
    start, end = datetime.datetime(2023, 1, 3), datetime.datetime(2023, 1, 12)
    scored = scoring_table(sources, start, end)
    assert "noise" not in scored.columns
    times = scored.agg(F.min("datetime"), F.max("datetime")).first()
    assert start + datetime.timedelta(days=7) < times[0] and times[1] <= end
    with pytest.raises(ValueError):
        training_table(sources, start=start)


def test_large_tables_are_not_broadcast(sources):
    """Beyond the size limit the same joins are shuffled, with the same result."""
    facts = join_facts(sources)
    assert facts.broadcast(2**28) == set(facts.rows) and facts.broadcast(0) == set()
    smallest = min(facts.rows, key=facts.rows.get)
    assert smallest in facts.broadcast(max(facts.rows.values()) * 640)  # the sum counts, not each table
    one, other = (join_sources(sources, facts, 7, limit) for limit in (2**28, 0))
    assert one.exceptAll(other).count() == 0 and one.count() == other.count()


def test_stored_sources(from_csv, sources, stored_at):
    assert (stored_at / "metering" / "run_date=2024-01-31").is_dir()
    for name, df in vars(sources).items():
        assert df.dtypes == getattr(from_csv, name).dtypes and df.count() == getattr(from_csv, name).count()


def test_weather_history(sources, table):
    filled = add_weather_history(table.select("client_id", "datetime", "year", "month", *schemas.MEASURED_MEASURES), sources.measured)
    assert filled.count() == table.count()  # one year of data: every row keeps its own value
    assert filled.filter("temperature_monthly_historical != temperature").count() == 0


def test_chosen_columns(sources):
    part = training_table(sources, columns=["date", "target", "eic_count"])
    assert part.columns == ["date", "target", "eic_count", "noise"]


def test_shuffle_partitions_do_not_matter(spark, sources, table):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        assert training_table(sources).exceptAll(table).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_plan_is_built_in_and_has_no_cross_join(sources):
    plan = training_table(sources)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
