"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Oracles and calendar features read timestamps as UTC wall time.
    "spark.sql.session.timeZone": "UTC",
    # Nanosecond Parquet timestamps arrive as LONG; the bar reader turns them into timestamps.
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # Wall-clock Parquet timestamps are read as TIMESTAMP (UTC), the library's one time type.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # The JVM never compiles methods above 8000 bytecodes; wide feature projections that would exceed it
    # in one generated stage are split into smaller methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Rows go to Python some megabytes at a time, however long they are: a task's memory follows the batch.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}

# Settings fixed when a session starts.
START = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Recording the Python call site of every column expression costs more than planning a wide feature table.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName("tickloom")
    if master:
        builder = builder.master(master)
    for name, value in {**START, **SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary folder only in a local session that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="tickloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tickloom/{name}-{uuid.uuid4().hex}"


_WRITTEN: list[str] = []


def release(spark: SparkSession) -> None:
    """Delete every intermediate table this process has written. What was built on them can't be read any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _WRITTEN:
        path = jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(conf).delete(path, True)


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and later reads prune columns."""
    path = new_path(df.sparkSession, name)
    _WRITTEN.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
