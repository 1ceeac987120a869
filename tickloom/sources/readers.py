"""Readers with declared schemas. NaN becomes NULL at the door."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schema as S
from tickloom.functions.scalars import nan_to_null

CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"
CSV_TIME_READ = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
# Partition column of snapshot tables, a number YYYYMMDD.
SNAPSHOT_DAY = "snapshot_date"


def scan_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    where: str | Column | None = None,
    optional: Iterable[str] = (),
    ingest_order: str | None = None,
) -> DataFrame:
    """Read a table. Nanosecond timestamps, which Spark reads as LONG, become timestamps.

    With ``schema`` the result has exactly those columns and types; names match whatever their case, as
    providers write them, and a column the file lacks raises unless it is among ``optional`` (then NULL).
    ``where`` is a condition on the stored columns; it is applied before NaN becomes NULL, so that it reaches the
    files for every type (a NaN counts as larger than any number there). ``ingest_order`` names a column to be
    added that orders all rows: by file name, then by place in the file.
    """
    return _conform(spark.read.parquet(path), path, schema, where, optional, ingest_order)


def _conform(
    table: DataFrame, path: str, schema: T.StructType | None, where: str | Column | None = None, optional: Iterable[str] = (),
    ingest_order: str | None = None,
) -> DataFrame:
    if ingest_order:
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
        table = table.withColumn(ingest_order, place)
    if where is not None:
        table = table.where(where)
    table = nan_to_null(table)
    if schema is None:
        return table
    kinds: dict[str, list[T.StructField]] = {}
    for f in table.schema:
        kinds.setdefault(f.name.lower(), []).append(f)
    twice = [n for n in schema.names if len(kinds.get(n.lower(), ())) > 1]
    missing = [n for n in schema.names if n.lower() not in kinds and n not in set(optional)]
    if twice or missing:
        raise ValueError(f"{path}: no columns {missing}, several columns {twice}")
    made = [_as_type(field, kinds.get(field.name.lower())).alias(field.name) for field in schema]
    return table.select(*made, *([ingest_order] if ingest_order else []))


def _as_type(field: T.StructField, stored: list[T.StructField] | None) -> Column:
    if stored is None:
        return F.lit(None).cast(field.dataType)
    name, kind = stored[0].name, stored[0].dataType
    if isinstance(field.dataType, T.TimestampType) and isinstance(kind, T.LongType):
        return F.expr(f"timestamp_micros((`{name}` - pmod(`{name}`, 1000)) div 1000)")
    return F.col(f"`{name}`").cast(field.dataType)


def scan_bars(
    spark: SparkSession,
    path: str,
    series_key: str | None = None,
    where: str | Column | None = None,
    ingest_order: str | None = None,
) -> DataFrame:
    """Daily bars; ``series_key`` names the series of a file that holds a single one."""
    optional = ["series_key"] if series_key else []
    bars = scan_parquet(spark, path, S.BAR_SCHEMA, where, optional, ingest_order)
    return bars.withColumn("series_key", F.lit(series_key)) if series_key else bars


def latest_snapshot(spark: SparkSession, folder: str, prefix: str) -> str:
    """Path of the newest ``<prefix>_YYYYMMDD.parquet`` in ``folder``.

    One level of the folder is listed. A snapshot that is a folder counts once its writer has committed it
    (``_SUCCESS``), so one that is still being written is not taken.
    """
    jvm = spark.sparkContext._jvm
    top = jvm.org.apache.hadoop.fs.Path(folder)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    name = re.compile(rf"{re.escape(prefix)}_\d{{8}}\.parquet")
    listed = system.listStatus(top) if system.exists(top) else []
    found = sorted((s.getPath().getName(), i) for i, s in enumerate(listed) if name.fullmatch(s.getPath().getName()))
    for _, i in reversed(found):
        path = listed[i].getPath()
        if listed[i].isFile() or system.exists(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            return path.toString()
    raise FileNotFoundError(f"no {prefix}_YYYYMMDD.parquet in {folder}")


def scan_latest_snapshot(spark: SparkSession, folder: str, prefix: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest snapshot, whether days are files (or folders) of their own or partitions of one table."""
    if _has_partitions(spark, f"{folder}/{prefix}"):
        return scan_latest_partition(spark, f"{folder}/{prefix}", schema)
    return scan_parquet(spark, latest_snapshot(spark, folder, prefix), schema)


def _has_partitions(spark: SparkSession, path: str) -> bool:
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.exists(top) and any(s.getPath().getName().startswith(f"{SNAPSHOT_DAY}=") for s in system.listStatus(top))


def scan_latest_partition(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest day of a table partitioned by ``snapshot_date``.

    The newest day is found by a subquery over the partition column alone; its answer prunes the partitions of the scan when
    the query runs, so files of other days are not read. A table without a row gives none.
    """
    days = spark.read.parquet(path)
    newest = days.agg(F.max(SNAPSHOT_DAY))
    table = days.where(F.col(SNAPSHOT_DAY) == newest.scalar()).drop(SNAPSHOT_DAY)
    return _conform(table, path, schema)


def scan_csv(spark: SparkSession, path: str, series_key: str | None = None) -> DataFrame:
    """Price series with a header line: timestamp and price, and the key unless ``series_key`` gives it.

    A field that does not parse raises when the query runs.
    """
    fields = [f for f in S.PRICE_SCHEMA if f.name != "series_key"]
    if series_key is None:
        fields = list(S.PRICE_SCHEMA)
    reader = spark.read.schema(T.StructType(fields)).option("header", True).option("mode", "FAILFAST")
    table = nan_to_null(reader.option("timestampFormat", CSV_TIME_READ).csv(path))
    if series_key is not None:
        table = table.withColumn("series_key", F.lit(series_key))
    return table.select(*S.PRICE_SCHEMA.names)


def quote_text_schema(schema: T.StructType = S.QUOTE_SCHEMA) -> T.StructType:
    """The schema of quote files, in which times are strings."""
    return T.StructType(
        [T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.TimestampType) else f.dataType) for f in schema]
    )


def quotes_from_text(raw: DataFrame, schema: T.StructType = S.QUOTE_SCHEMA) -> DataFrame:
    return nan_to_null(raw.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]))


def scan_json_quotes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Quotes of a folder: one indented document per file, or with ``lines`` one document per line.

    Files of lines can be split over tasks and suit large histories. A document that does not parse raises when
    the query runs; ``rejected_json_quotes`` lists such documents.
    """
    reader = spark.read.schema(quote_text_schema()).option("multiLine", not lines).option("mode", "FAILFAST")
    return quotes_from_text(reader.json(path))


def rejected_json_quotes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """``file`` and text of the documents that do not parse."""
    return rejected_documents(parsed_documents(spark.read.text(path, wholetext=not lines)))


def parsed_documents(texts: DataFrame) -> DataFrame:
    """Quote documents of text files: ``file``, ``quote`` (a struct of strings and numbers) and, where one does not parse, its ``document``."""
    schema = T.StructType([*quote_text_schema().fields, T.StructField("document", T.StringType())])
    quote = F.from_json("value", schema, {"columnNameOfCorruptRecord": "document"})
    rows = texts.select(F.col("_metadata.file_name").alias("file"), quote.alias("quote"))
    return rows.withColumn("document", F.col("quote.document"))


def rejected_documents(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("document").isNotNull()).select("file", "document")


def accepted_quotes(parsed: DataFrame) -> DataFrame:
    return quotes_from_text(parsed.filter(F.col("document").isNull()).select("quote.*"))


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    if df.isEmpty():
        raise ValueError(f"{what} has no rows")
    return df
