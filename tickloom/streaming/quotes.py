"""Quotes as a stream: every run of the collector drops one JSON file into a folder.

A document that does not parse is no quote: it goes to a table of its own, with the name of its file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.validate import val_quote
from tickloom.sources.readers import accepted_quotes, parsed_documents, rejected_documents


def stream_documents(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """``file``, ``quote`` and ``document`` of the folder's files; stateless, so no watermark is needed."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    return parsed_documents(reader.text(folder, wholetext=True))


def stream_quotes(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """Quotes of the folder's files with their severity; documents that don't parse are left to ``stream_rejected``."""
    return val_quote(accepted_quotes(stream_documents(spark, folder, files_per_batch)))


def stream_rejected(spark: SparkSession, folder: str, files_per_batch: int = 1_000) -> DataFrame:
    """``file`` and text of the documents that don't parse."""
    return rejected_documents(stream_documents(spark, folder, files_per_batch))


def sink_quotes(quotes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet, working off all present files and then stopping; restarts continue from ``checkpoint``."""
    writer = quotes.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


def land_quotes(spark: SparkSession, folder: str, path: str, rejected: str, checkpoint: str, files_per_batch: int = 1_000) -> StreamingQuery:
    """Both outputs from one read of the files: quotes with their severity under ``path``, the rest under ``rejected``.

    Each batch replaces its own partition ``batch``, so one that is repeated after a failure leaves no row twice.
    """

    def land(documents: DataFrame, batch: int) -> None:
        for rows, place in ((val_quote(accepted_quotes(documents)), path), (rejected_documents(documents), rejected)):
            rows.write.mode("overwrite").parquet(f"{place}/batch={batch}")

    writer = stream_documents(spark, folder, files_per_batch).writeStream.foreachBatch(land)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
