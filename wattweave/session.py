"""Session settings and durable (written) tables."""

from __future__ import annotations

import posixpath
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Timestamps are naive everywhere, so the session zone is pinned. AQE splits the
# shuffle partitions of hot join keys at run time and turns joins into broadcasts
# only when the measured size allows it.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The training table has about a hundred columns; compile its stages all the same.
    "spark.sql.codegen.maxFields": "400",
    # Plans here have hundreds of columns; recording the Python line of each is slow.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "wattweave", **conf: str) -> SparkSession:
    """Session with the recommended settings; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = RECOMMENDED_CONF | {key.replace("_", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A temporary folder is used only when the setting is absent and the session is
    local; on a cluster a missing setting is an error.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        folder = tempfile.mkdtemp(prefix="wattweave-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def durable(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    For tables that several later steps read, and where later steps depend on values
    that a re-run task could change, such as the partition number of a row. ``options``
    are those of the Parquet writer.
    """
    path = posixpath.join(shared_dir(df.sparkSession), uuid.uuid4().hex)
    df.write.options(**options).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.durable_path = path
    return written


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``durable`` whose readers are all written themselves.

    Call it only after every table computed from them is in the shared folder: a task that is
    run again reads from there.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.durable_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
