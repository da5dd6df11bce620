"""Client records from a stream to daily partitions, with the code of the batch path.

A record that is no client row either stops the job (``decode_json``) or goes to a table of
its own with the reason (``judge_records``, ``stream_clients_with_rejects``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wattweave.functions.columns import map_from_table, narrow_to_32_bits, parse_date, product_name, to_boolean
from wattweave.schemas import CLIENT_MESSAGE, DATE_FORMAT, INGEST_PRODUCT_DEFAULT
from wattweave.sources.sinks import DAY_PARTS, backfill_daily, with_day_parts, write_daily


def kafka_options(config: dict[str, str]) -> dict[str, str]:
    """Options of Spark's Kafka source. Progress lives in the query checkpoint, so a
    restart goes on from the last committed offset and a first run starts at the beginning."""
    options = {
        "kafka.bootstrap.servers": config.get("bootstrap_servers", ""),
        "startingOffsets": config.get("auto_offset_reset", "earliest"),
        "subscribe": config.get("topic", ""),
    }
    if config.get("group_id"):
        options["kafka.group.id"] = config["group_id"]
    return options


def kafka_stream(spark: SparkSession, config: dict[str, str]) -> DataFrame:
    """Binary (key, value) stream; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(config)).load().select("key", "value")


def decode_json(records: DataFrame, schema: T.StructType = CLIENT_MESSAGE, column: str = "value") -> DataFrame:
    """Fields of the JSON objects in a text or binary column; a malformed record is an error."""
    parsed = F.from_json(F.col(column).cast("string"), schema, {"mode": "FAILFAST"})
    return records.select(parsed.alias("__record")).select("__record.*")


REASON = "reason"
RECORD = "record"


def judge_records(records: DataFrame, schema: T.StructType = CLIENT_MESSAGE, column: str = "value") -> DataFrame:
    """Fields of the JSON objects, the text as ``record``, and ``reason``: null if the record is a client row.

    Nothing is dropped and nothing raises. The reasons, of which the first that holds is given:

    * ``empty``: null, or white space only (a null marks a deleted key on a topic);
    * ``malformed``: no JSON object, or a field of another type;
    * ``no date``, ``bad date``: the table is kept by day, so a row needs one;
    * ``out of range: <field>``: a whole number that 32 bits do not hold.

    ``date`` comes out as a date.
    """
    broken = "__broken"
    whole = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    text = F.col(column).cast("string")
    parsed = F.from_json(text, whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken})
    fields = records.select(text.alias(RECORD), parsed.alias("__fields"))
    field = F.col("__fields").getField
    date = F.try_to_timestamp(field("date"), F.lit(DATE_FORMAT)).cast("date")
    longs = [f.name for f in schema.fields if f.dataType == T.LongType()]
    reasons = [
        (F.col(RECORD).isNull() | (F.trim(RECORD) == ""), "empty"),
        (F.col("__fields").isNull() | field(broken).isNotNull() | ~F.ltrim(RECORD).startswith("{"), "malformed"),
        (field("date").isNull(), "no date"),
        (date.isNull(), "bad date"),
        *[(field(c).isNotNull() & field(c).try_cast("int").isNull(), f"out of range: {c}") for c in longs],
    ]
    reason = reduce(lambda rest, rule: F.when(rule[0], rule[1]).otherwise(rest), reversed(reasons), F.lit(None).cast("string"))
    values = [(date if f.name == "date" else field(f.name)).alias(f.name) for f in schema.fields]
    return fields.select(*values, RECORD, reason.alias(REASON))


def normalise_clients(clients: DataFrame, counties: DataFrame) -> DataFrame:
    """Product names, county names and a boolean business flag; numbers narrowed to 32 bits.

    ``clients`` may be a stream; ``counties`` is a table (county, name).
    """
    narrow = narrow_to_32_bits(clients)
    named = map_from_table(narrow, "county", counties, "county", "name")
    return named.withColumns(
        {
            "product_type": product_name(F.col("product_type"), INGEST_PRODUCT_DEFAULT),
            "is_business": to_boolean(F.col("is_business")),
        }
    )


def prepare_clients(records: DataFrame, counties: DataFrame) -> DataFrame:
    """JSON records to normalised client rows, batch or stream."""
    return normalise_clients(parse_date(decode_json(records), "date"), counties)


def stream_clients(records: DataFrame, counties: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the stream to daily partitions, each record once, and stop when it is drained.

    The file sink's commit log and the checkpoint make a restart go on where the last
    run ended.
    """
    rows = with_day_parts(prepare_clients(records, counties))
    return (
        rows.writeStream.format("parquet")
        .partitionBy(*DAY_PARTS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_clients_by_day(records: DataFrame, counties: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """As :func:`stream_clients`, with few files per day and batch.

    Below its day, each micro-batch has a partition of its own (``batch``), so a day may
    arrive over any number of batches, and a batch that is run again after a failure
    replaces what it wrote and nothing else.
    """

    def save(batch: DataFrame, number: int) -> None:
        write_daily(batch.withColumn("batch", F.lit(number)), path, within=["batch"])

    return (
        prepare_clients(records, counties)
        .writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_clients_with_rejects(
    records: DataFrame, counties: DataFrame, path: str, rejects: str, checkpoint: str
) -> StreamingQuery:
    """As :func:`stream_clients_by_day`, and records that are no client rows go to ``rejects``.

    That table holds (record, reason), a partition for each micro-batch with any. Both writes replace what an
    earlier attempt of the same batch wrote, so a batch that broke off between them ends
    with every record in exactly one of the two tables.
    """

    def save(batch: DataFrame, number: int) -> None:
        judged = judge_records(batch)
        good = judged.filter(F.col(REASON).isNull()).drop(RECORD, REASON)
        clients = normalise_clients(good, counties).withColumn("batch", F.lit(number))
        write_daily(clients, path, within=["batch"])
        bad = judged.filter(F.col(REASON).isNotNull()).select(RECORD, REASON).withColumn("batch", F.lit(number))
        write = bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        write.partitionBy("batch").parquet(rejects)

    return (
        records.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_clients(clients: DataFrame, counties: DataFrame, path: str, start, end) -> DataFrame:
    """Batch form: write the missing days of an interval; (date, rows) per day handled."""
    return backfill_daily(normalise_clients(clients, counties), path, start, end)
