"""Incremental ingestion: new documents in, outcomes appended to a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scoreloom.functions.scalars import base_name, decoded_path
from scoreloom.operators.adapters import DEFAULT_ADAPTERS, Adapter
from scoreloom.operators.extract import extract
from scoreloom.operators.registry import Registry
from scoreloom.session import ensure_conf
from scoreloom.sources.scan import SUFFIX, _no_glob, check_directory
from scoreloom.streaming.statistics import write_partials


def document_stream(spark: SparkSession, directory: str, *, max_files: int | None = None) -> DataFrame:
    """New ``*.json`` files below a directory as ``(path, source_filename, content)``.

    Hidden and empty files do not show up in a stream: a batch scan with ``leftovers=False`` sees the same files.
    """
    check_directory(spark, directory)
    reader = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{SUFFIX}")
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    path = decoded_path(F.col("_metadata.file_path"))
    return reader.load(_no_glob(directory)).select(
        path.alias("path"), base_name(path).alias("source_filename"), F.col("value").alias("content")
    )


def ingest(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    *,
    registry: Registry | None = None,
    adapters: Sequence[Adapter] = DEFAULT_ADAPTERS,
    metrics: str = "registry",
    statistics: str | None = None,
) -> StreamingQuery:
    """Start a query that extracts what is there and stops.

    Extraction keeps no state, so there is nothing to expire. Every batch owns one
    directory of the table and overwrites it, which makes a repeated batch harmless. With a folder for ``statistics`` it
    also leaves its partial sums there, for ``stored_statistics``.
    """
    ensure_conf(stream.sparkSession)

    def store(batch: DataFrame, batch_id: int) -> None:
        outcomes = extract(batch, registry=registry, adapters=adapters, metrics=metrics)
        target = f"{table}/batch_id={batch_id}"
        outcomes.write.mode("overwrite").parquet(target)
        if statistics is not None:
            stored = batch.sparkSession.read.schema(outcomes.schema).parquet(target)
            write_partials(stored, statistics, batch_id)

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_outcomes(spark: SparkSession, table: str) -> DataFrame:
    """All outcomes ingested so far; aggregates are computed from here. None if no batch has come yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.parquet(table).drop("batch_id")
    none = spark.createDataFrame([], "path string, source_filename string, content string")
    return extract(none)
