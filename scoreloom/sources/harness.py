"""Scores back into result documents, and per-sample details into tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import ship_with_tasks
from scoreloom.sources.scan import _open, listable, qualified

ship_with_tasks(__name__)

RUN_COLUMNS = ["path", "model_name", "started", "duration", "params"]


def harness_documents(scores: DataFrame, harness: str = "lm_eval") -> DataFrame:
    """One document per run from rows ``(path, model_name, started, duration, params,
    task_name, metric, value, stderr)``.

    ``params`` is a map of strings to doubles. A run has one row per task and metric, so
    the maps built here are as small as the run's task list. Of rows that repeat task and metric
    the greatest value and the greatest standard error count. A run without any value has no
    results. NaN and infinities are written bare, as the harnesses do.
    """
    inside = harness == "lm_eval"
    # one shuffle serves the three groupings and the join below
    scores = scores.repartition("path")
    metric, stderr = F.col("metric"), F.col("stderr")
    entries = F.array(
        F.struct(metric.alias("key"), F.col("value").alias("value")),
        F.struct(_stderr_key(metric, inside).alias("key"), stderr.alias("value")),
    )
    per_task = (
        scores.select(*RUN_COLUMNS[:1], "task_name", F.inline(entries))
        .where(F.col("value").isNotNull())
        .groupBy("path", "task_name", "key")
        .agg(F.max("value").alias("value"))
        .groupBy("path", "task_name")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("key", "value")))).alias("_members"))
    )
    per_run = per_task.groupBy("path").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("task_name", F.map_entries("_members").alias("m"))))).alias("_tasks")
    )
    heads = scores.groupBy("path").agg(
        F.max("model_name").alias("model_name"),
        F.max("started").alias("started"),
        F.max("duration").alias("duration"),
        F.max(F.to_json("params")).alias("_params"),
    )
    results = F.transform_values(
        F.coalesce("_tasks", F.create_map().cast(per_run.schema["_tasks"].dataType)), lambda _, m: F.map_from_entries(m)
    )
    params = F.from_json("_params", "map<string,double>")
    joined = heads.join(per_run, "path", "left")
    # in the results only numbers follow a colon in quotes: those that JSON cannot write
    numbers = F.regexp_replace(F.to_json(F.struct(results.alias("results"))), ':"(NaN|-?Infinity)"', ":$1")
    rest = F.to_json(_layout(harness, params))
    content = F.concat(F.regexp_replace(numbers, r"\}$", ","), F.substring(rest, 2, F.length(rest)))
    return joined.select("path", content.alias("content"))


def _stderr_key(metric: Column, inside: bool) -> Column:
    appended = F.concat(metric, F.lit("_stderr"))
    if not inside:
        return appended
    # before the first comma, if there is one
    return F.when(metric.contains(","), F.regexp_replace(metric, "^([^,]*),", "$1_stderr,")).otherwise(appended)


def _layout(harness: str, params: Column) -> Column:
    """All but the results."""
    if harness == "lm_eval":
        return F.struct(
            F.create_map().cast("map<string,string>").alias("configs"),
            F.struct(params.alias("gen_kwargs")).alias("config"),
            F.col("started").alias("date"),
            F.col("duration").alias("total_evaluation_time_seconds"),
            "model_name",
        )
    if harness == "lighteval":
        return F.struct(
            F.struct(
                F.col("started").alias("start_time"),
                F.col("duration").alias("total_evaluation_time_secondes"),
                F.col("model_name"),
                F.struct(params.alias("generation_parameters")).alias("model_config"),
            ).alias("config_general"),
        )
    raise ValueError(f"unknown harness: {harness}")


def write_documents(docs: DataFrame, directory: str) -> int:
    """Write ``(path, content)`` rows as files of those names below ``directory``.

    Spark's writers name their own files, so the tasks write these. A file is finished
    under another name and then moved, and a retried task writes the same file again.
    On a cluster, a folder of the local file system has to be below ``spark.checkpoint.dir`` or the warehouse, which all
    executors share.
    """
    spark = docs.sparkSession
    root = listable(qualified(spark, directory))
    if root.startswith("file:") and not spark.sparkContext.master.startswith("local") and not _is_shared(spark, root):
        raise ValueError("documents need a file system that all executors share")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                system, target, _ = _open(f"{root.rstrip('/')}/{path.lstrip('/')}")
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(f"{target}.part") as out:
                    out.write(content.encode())
                system.move(f"{target}.part", target)
            yield pd.DataFrame({"n": [len(batch)]})

    written = docs.select("path", "content").mapInPandas(write, "n bigint")
    return written.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def _is_shared(spark: SparkSession, root: str) -> bool:
    """Whether a folder lies in one of those that the driver and all executors reach under the same address."""
    named = (spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir(), spark.conf.get("spark.sql.warehouse.dir", None))
    inside = lambda folder: f"{root.rstrip('/')}/".startswith(f"{qualified(spark, folder).rstrip('/')}/")
    return any(inside(folder) for folder in named if folder)


def write_details(
    samples: DataFrame,
    target: str,
    by: Sequence[str] = ("task_name", "model_name", "rep"),
    *,
    max_rows_per_file: int = 1_000_000,
) -> None:
    """Per-sample rows as Parquet, one directory per run.

    The runs in ``samples`` replace what is stored of them, and all other runs stay: a run may be written again, whole.
    Rows are staged beside the table and take their place when the job is done, so a job that dies
    leaves the table as it was.

    The rebalance hint puts a run's rows together and splits the large ones, so a hot
    run becomes several files instead of one slow task.
    """
    writer = samples.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", max_rows_per_file).partitionBy(*by).parquet(target)
