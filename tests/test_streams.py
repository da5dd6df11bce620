import datetime
import json
import os

import pytest
from pyspark.sql import functions as F

from wattweave.schemas import CLIENT_MESSAGE
from wattweave.sources import sinks, versions
from wattweave.streaming import compaction, ingest

D = datetime.date
GOOD = {"product_type": 0, "county": 0, "eic_count": 5, "installed_capacity": 1.5, "is_business": 1, "date": "2021-09-01", "data_block_id": 2}


@pytest.fixture
def counties(spark):
    return spark.createDataFrame([(0, "Harju")], "county int, name string")


def drop(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines))


CASES = [
    (json.dumps(GOOD), None),
    (json.dumps(GOOD | {"county": None, "unknown": 1}), None),
    ("  " + json.dumps(GOOD), None),
    (None, "empty"),
    ("", "empty"),
    ("   ", "empty"),
    ("{broken", "malformed"),
    ("7", "malformed"),
    ("null", "malformed"),
    (json.dumps([GOOD]), "malformed"),
    (json.dumps(GOOD | {"eic_count": "many"}), "malformed"),
    (json.dumps(GOOD | {"date": None}), "no date"),
    ("{}", "no date"),
    (json.dumps(GOOD | {"date": "2021-13-45"}), "bad date"),
    (json.dumps(GOOD | {"date": "soon"}), "bad date"),
    (json.dumps(GOOD | {"eic_count": 2**31}), "out of range: eic_count"),
    (json.dumps(GOOD | {"eic_count": 2**31 - 1}), None),
]


def test_reasons(spark):
    records = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(CASES)], "i int, value string")
    for kind in ("string", "binary"):
        judged = ingest.judge_records(records.repartition(1).sortWithinPartitions("i").withColumn("value", F.col("value").cast(kind)))
        assert [(r.record, r.reason) for r in judged.collect()] == CASES
    assert judged.columns == [*CLIENT_MESSAGE.names, "record", "reason"] and dict(judged.dtypes)["date"] == "date"


def test_bad_records_do_not_stop_the_stream(spark, tmp_path, counties):
    inbox, lake, rejects, progress = (str(tmp_path / n) for n in ("inbox", "lake", "rejects", "progress"))

    def run():
        records = spark.readStream.text(inbox)
        ingest.stream_clients_with_rejects(records, counties, lake, rejects, progress).awaitTermination()

    drop(inbox, "a.json", [GOOD, "{broken", GOOD | {"date": "2021-09-02"}])
    run()
    run()
    drop(inbox, "b.json", [GOOD | {"date": "2021-09-03"}, GOOD | {"date": "x"}])
    run()
    assert sorted(r.date for r in sinks.read_table(spark, lake).collect()) == [D(2021, 9, 1), D(2021, 9, 2), D(2021, 9, 3)]
    assert sorted(r.reason for r in sinks.read_table(spark, rejects).collect()) == ["bad date", "malformed"]
    good = ingest.prepare_clients(spark.createDataFrame([(json.dumps(GOOD),)], "value string"), counties)
    same = sinks.read_table(spark, lake).filter("date = '2021-09-01'").select(good.columns)
    assert same.collect() == good.collect() and same.dtypes == good.dtypes


def test_a_batch_that_broke_between_the_tables_is_repeated(spark, tmp_path, counties, monkeypatch):
    inbox, lake, rejects, progress = (str(tmp_path / n) for n in ("inbox", "lake", "rejects", "progress"))
    drop(inbox, "a.json", [GOOD, "{broken", ""] + [GOOD | {"eic_count": i} for i in range(20)])
    write = ingest.write_daily

    def dies(*args, **options):
        write(*args, **options)
        raise RuntimeError("lost")

    for writer in (dies, write):
        monkeypatch.setattr(ingest, "write_daily", writer)
        query = ingest.stream_clients_with_rejects(spark.readStream.text(inbox), counties, lake, rejects, progress)
        if writer is dies:
            with pytest.raises(Exception, match="lost"):
                query.awaitTermination()
            assert not os.path.exists(rejects) and sinks.read_table(spark, lake).count() == 21
        else:
            query.awaitTermination()
    assert sinks.read_table(spark, lake).count() == 21 and sinks.read_table(spark, rejects).count() == 2


class Lake:
    """A stream into a compacted table."""

    def __init__(self, spark, counties, folder):
        self.spark, self.counties = spark, counties
        self.base, self.inbox, self.progress = (str(folder / n) for n in ("lake", "inbox", "progress"))
        self.sent = []

    def send(self, *counts, day="2021-09-01"):
        for n in counts:
            drop(self.inbox, f"{len(self.sent)}.json", [GOOD | {"eic_count": n, "date": day}])
            self.sent.append(n)
        records = self.spark.readStream.option("maxFilesPerTrigger", 1).text(self.inbox)
        path = compaction.arrived_path(self.base)
        ingest.stream_clients_by_day(records, self.counties, path, self.progress).awaitTermination()

    def compact(self, **options):
        return compaction.compact(self.spark, self.base, self.progress, **options)

    def rows(self):
        return sorted(r.eic_count for r in compaction.read_compacted(self.spark, self.base).collect())

    def files(self):
        return len(compaction.read_compacted(self.spark, self.base).select(F.input_file_name()).distinct().collect())


@pytest.fixture
def lake(spark, counties, tmp_path):
    return Lake(spark, counties, tmp_path)


def test_compaction_between_batches(lake):
    with pytest.raises(FileNotFoundError):
        lake.rows()
    assert lake.compact() == []
    lake.send(1, 2, 3)
    lake.send(4, day="2021-09-02")
    assert lake.rows() == [1, 2, 3, 4] and lake.files() == 4
    assert lake.compact() == [D(2021, 9, 1)]
    assert lake.rows() == [1, 2, 3, 4] and lake.files() == 2
    assert lake.compact() == []
    lake.send(5, 6)
    lake.send(7, 8, day="2021-09-02")
    assert lake.rows() == [1, 2, 3, 4, 5, 6, 7, 8]
    assert lake.compact(least=3) == [D(2021, 9, 2)]
    assert lake.compact() == [D(2021, 9, 1)]
    assert lake.rows() == [1, 2, 3, 4, 5, 6, 7, 8] and lake.files() == 2


def test_replaced_files_go_and_the_rest_stays(spark, lake):
    lake.send(1, 2)
    lake.send(3, day="2021-09-02")
    compaction.remove_replaced(spark, lake.base)
    assert lake.rows() == [1, 2, 3]
    for n in (4, 5):
        lake.compact(least=1)
        lake.send(n)
        compaction.remove_replaced(spark, lake.base)
        assert lake.rows() == list(range(1, n + 1))
    arrived = sinks.read_table(spark, compaction.arrived_path(lake.base))
    assert [r.eic_count for r in arrived.collect()] == [5]
    lake.compact(least=1)
    compaction.remove_replaced(spark, lake.base)
    assert lake.rows() == [1, 2, 3, 4, 5] and versions.numbers(spark, os.path.join(lake.base, "merged")) == [1, 3]


@pytest.mark.parametrize("at", ["write", "publish"])
def test_a_broken_compaction_changes_nothing(lake, monkeypatch, at):
    lake.send(1, 2)
    lake.compact()
    lake.send(3, 4)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if at == "publish":
            patch.setattr(versions, "publish", dies)
        else:
            patch.setattr(compaction, "_manifests", lambda base: dies() if os.path.exists(f"{base}/merged/version=2") else f"{base}/manifest")
        with pytest.raises(RuntimeError):
            lake.compact()
    assert os.path.exists(f"{lake.base}/merged/version=2") and lake.rows() == [1, 2, 3, 4]
    lake.send(5)
    assert lake.rows() == [1, 2, 3, 4, 5]
    assert lake.compact() == [D(2021, 9, 1)]
    assert lake.rows() == [1, 2, 3, 4, 5] and lake.files() == 1


def test_unfinished_batches_wait(spark, lake):
    """What a running batch has written so far is read as before, but not merged."""
    lake.send(1, 2)
    table = sinks.read_table(spark, compaction.arrived_path(lake.base)).filter("batch = 0").drop("batch", "year", "month", "day")
    begun = table.withColumns({"eic_count": F.lit(3), "batch": F.lit(2)})
    sinks.write_daily(begun, compaction.arrived_path(lake.base), within=["batch"])
    lake.compact()
    assert compaction.manifest(spark, lake.base) == {D(2021, 9, 1): (1, 1)} and lake.rows() == [1, 2, 3]


def test_replaced_batches_are_pruned_from_the_scan(spark, lake):
    lake.send(1, 2)
    lake.compact()
    lake.send(3)
    read = [r[0] for r in compaction.read_compacted(spark, lake.base).select(F.input_file_name()).distinct().collect()]
    assert sum("batch=" in f for f in read) == 1 and sum("version=1" in f for f in read) == 1
    plan = compaction.read_compacted(spark, lake.base)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [(") + plan.count("PartitionFilters: [isnotnull") == 2


def test_versions(spark, tmp_path):
    base = str(tmp_path / "v")
    assert versions.published(spark, base) is None and versions.numbers(spark, base) == []
    for n in (1, 2, 3, 4):
        os.makedirs(versions.version_path(base, n))
        if n < 4:
            versions.publish(spark, base, n)
    assert versions.published(spark, base) == 3
    versions.prune(spark, base, keep=2)
    assert versions.numbers(spark, base) == [2, 3, 4]
    with pytest.raises(ValueError):
        versions.prune(spark, base, keep=0)
