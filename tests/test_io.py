import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

import fixture
from wattweave.functions import columns
from wattweave.schemas import CLIENT_MESSAGE, METERING
from wattweave.sources import sinks, tables, views
from wattweave.streaming import ingest

D = datetime.date


def test_csv_readers(spark, tmp_path):
    paths = fixture.write(tmp_path, days=2)
    assert dict(tables.read_csv_inferred(spark, os.path.dirname(paths["train"]) + "/*").dtypes)["county"] == "int"
    raw = tables.read_csv(spark, paths["train"])
    assert {t for _, t in raw.dtypes} == {"string"}
    narrow = raw.select("county")
    assert "ReadSchema: struct<county:string>" in narrow._jdf.queryExecution().executedPlan().toString()
    assert tables.shape_metering(raw).schema.names == METERING.names


def test_json_lookup(spark, tmp_path, rows):
    path = tmp_path / "map.json"
    path.write_text(json.dumps({"0": "Harju", "11": "Tartu"}))
    assert rows(tables.read_json_lookup(spark, str(path)), "county") == [(0, "Harju"), (11, "Tartu")]


def test_union_and_paths(spark, rows):
    a, b = spark.sql("SELECT 1 AS x, 2 AS y"), spark.sql("SELECT 4 AS y, 3 AS x")
    assert rows(sinks.union_tables(a, b), "x") == [(1, 2), (3, 4)]
    assert sinks.day_path("base", D(2022, 1, 5), "t") == "base/year=2022/month=1/day=5/t"


def days(spark, *dates):
    return spark.createDataFrame([(d, i) for i, d in enumerate(dates)], "date date, v int")


def test_backfill(spark, tmp_path, rows):
    path = str(tmp_path / "lake")
    df = days(spark, D(2021, 9, 1), D(2021, 9, 1), D(2021, 9, 2), D(2021, 9, 3), D(2021, 9, 9))
    sinks.write_daily(df.filter(F.col("date") == F.lit(D(2021, 9, 2))), path)
    done = sinks.backfill_daily(df, path, D(2021, 9, 1), D(2021, 9, 3))
    assert rows(done, "date") == [(D(2021, 9, 1), 2), (D(2021, 9, 3), 1)]
    assert os.path.isdir(f"{path}/year=2021/month=9/day=1") and sinks.read_table(spark, path).count() == 4
    assert sinks.backfill_daily(df, path, D(2021, 9, 1), D(2021, 9, 3)).count() == 0
    assert sinks.read_table(spark, path).count() == 4


def test_write_daily_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "lake")
    sinks.write_daily(days(spark, D(2021, 9, 1), D(2021, 9, 2)), path)
    sinks.write_daily(days(spark, D(2021, 9, 2), D(2021, 9, 2)), path)
    assert sinks.read_table(spark, path).count() == 3


def test_backfill_into_nothing(spark, tmp_path):
    done = sinks.backfill_daily(days(spark, D(2021, 9, 5)), str(tmp_path / "new"), D(2021, 9, 4), D(2021, 9, 5))
    assert sorted(r.rows for r in done.collect()) == [0, 1]


def test_sql_relations(spark):
    views.register(spark.range(3), "three")
    assert views.sql(spark, "SELECT count(*) AS n FROM three").first().n == 3
    assert views.sql(spark, "SELECT sum(id) AS n FROM {t}", t=spark.range(4)).first().n == 6


MESSAGES = [
    {"product_type": 0, "county": 0, "eic_count": 5, "installed_capacity": 1.5, "is_business": 1, "date": "2021-09-01", "data_block_id": 2},
    {"product_type": 9, "county": 7, "eic_count": 6, "installed_capacity": 2.5, "is_business": 0, "date": "2021-09-02", "data_block_id": 3},
]


def _drop(folder, name, messages):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(m) for m in messages))


@pytest.mark.parametrize("start", [ingest.stream_clients, ingest.stream_clients_by_day])
def test_stream_equals_batch_and_restarts(spark, tmp_path, start):
    counties = spark.createDataFrame([(0, "Harju")], "county int, name string")
    inbox, lake, progress = (str(tmp_path / n) for n in ("inbox", "lake", "progress"))
    _drop(inbox, "a.json", MESSAGES)
    for expected in (2, 2):
        start(spark.readStream.text(inbox), counties, lake, progress).awaitTermination()
        assert sinks.read_table(spark, lake).count() == expected
    _drop(inbox, "b.json", [MESSAGES[0] | {"date": "2021-09-03"}])
    start(spark.readStream.text(inbox), counties, lake, progress).awaitTermination()
    got = sinks.read_table(spark, lake).drop("year", "month", "day", "batch")
    batch = ingest.prepare_clients(spark.read.text(inbox), counties)
    assert got.count() == 3 and got.select(batch.columns).exceptAll(batch).count() == 0
    second = got.filter("date = '2021-09-02'").first()
    assert (second.product_type, second.county, second.is_business) == ("General service", "Unknown", False)
    assert dict(got.dtypes)["installed_capacity"] == "float" and dict(got.dtypes)["eic_count"] == "int"


@pytest.mark.parametrize("start", [ingest.stream_clients, ingest.stream_clients_by_day])
def test_a_day_may_arrive_over_several_batches(spark, tmp_path, start):
    counties = spark.createDataFrame([(0, "Harju")], "county int, name string")
    inbox, lake, progress = (str(tmp_path / n) for n in ("inbox", "lake", "progress"))
    for i in range(3):
        _drop(inbox, f"{i}.json", [MESSAGES[0] | {"eic_count": i}])
        start(spark.readStream.text(inbox), counties, lake, progress).awaitTermination()
        start(spark.readStream.text(inbox), counties, lake, progress).awaitTermination()
    assert sorted(r.eic_count for r in sinks.read_table(spark, lake).collect()) == [0, 1, 2]


def test_malformed_records_are_an_error(spark):
    records = spark.createDataFrame([('{"county": 1}',), ("{broken",)], "value string")
    with pytest.raises(Exception, match="MALFORMED"):
        ingest.decode_json(records).collect()


def test_csv_files_of_another_column_order_are_an_error(spark, tmp_path, rows):
    for name, text in (("a", "county,target\n1,10\n"), ("b", "target,county\n20,2\n")):
        (tmp_path / f"{name}.csv").write_text(text)
    with pytest.raises(Exception, match="CSV header"):
        tables.read_csv(spark, str(tmp_path)).collect()
    apart = [tables.read_csv(spark, str(tmp_path / f"{name}.csv")) for name in "ab"]
    assert rows(sinks.union_tables(*apart).select("county", "target"), "county") == [("1", "10"), ("2", "20")]


def test_whole_numbers_in_text(spark):
    text = spark.createDataFrame([("10",), ("10.0",), (None,)], "v string")
    assert [r[0] for r in text.select(columns.whole_number(F.col("v"), "tinyint")).collect()] == [10, 10, None]
    with pytest.raises(Exception, match="not a whole number: 2.7"):
        spark.createDataFrame([("2.7",)], "v string").select(columns.whole_number(F.col("v"), "int")).collect()
    stations = spark.createDataFrame([("24.1", "59.2", "10.0", "Tartu"), ("25.1", "58.2", None, None)], "longitude string, latitude string, county string, county_name string")
    assert sorted(r.county for r in tables.shape_stations(stations).collect()) == [-1, 10]


def test_runs_keep_the_date_columns_of_the_table(spark, tmp_path, rows):
    table = sinks.with_day_parts(days(spark, D(2022, 7, 5)))
    for day in (D(2024, 1, 31), D(2024, 2, 1)):
        sinks.write_run(table, str(tmp_path / "t"), day)
    got = sinks.read_table(spark, str(tmp_path / "t")).select("year", "month", "day", "run_date")
    assert rows(got, "run_date") == [(2022, 7, 5, D(2024, 1, 31)), (2022, 7, 5, D(2024, 2, 1))]


def test_backfill_looks_into_its_interval_only(spark, tmp_path):
    path = str(tmp_path / "lake")
    sinks.write_daily(days(spark, D(2020, 1, 1), D(2021, 9, 1), D(2021, 9, 5)), path)
    done = sinks.written_days(spark, path, D(2021, 9, 1), D(2021, 9, 3))
    assert [r.date for r in done.collect()] == [D(2021, 9, 1)]
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "2021" in plan


def test_ingest_batch(spark, tmp_path, rows):
    counties = spark.createDataFrame([(0, "Harju")], "county int, name string")
    clients = spark.createDataFrame([tuple(m.values()) for m in MESSAGES], CLIENT_MESSAGE)
    clients = clients.withColumn("date", F.to_date("date"))
    done = ingest.ingest_clients(clients, counties, str(tmp_path / "lake"), D(2021, 9, 1), D(2021, 9, 2))
    assert rows(done, "date") == [(D(2021, 9, 1), 1), (D(2021, 9, 2), 1)]


def test_kafka_options():
    options = ingest.kafka_options({"bootstrap_servers": "host:1", "topic": "clients", "group_id": "g"})
    assert options == {
        "kafka.bootstrap.servers": "host:1", "startingOffsets": "earliest", "subscribe": "clients", "kafka.group.id": "g",
    }
