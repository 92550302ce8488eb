"""Runs grouped by (task, model): repetitions, means and spreads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.functions import exact

GROUP = ["task_name", "model_name"]
METRIC = [*GROUP, "metric"]


def metrics_long(results: DataFrame) -> DataFrame:
    """One row per (run, metric)."""
    return results.select(
        "path", "task_ord", *GROUP, F.explode(F.map_entries("metrics")).alias("_m")
    ).select(
        "path",
        "task_ord",
        *GROUP,
        F.col("_m.key").alias("metric"),
        F.col("_m.value.value").alias("value"),
        F.col("_m.value.stderr").alias("stderr"),
    )


def partial_stats(metrics: DataFrame) -> DataFrame:
    """Exact sums of value and stderr per metric. Such tables of several inputs add up, see ``merged_stats``.

    They combine on the map side, so a hot (task, model) costs a few partial rows per input partition.
    """
    return exact.partial_moments(metrics, METRIC, {"value": F.col("value"), "stderr": F.col("stderr")})


def merged_stats(partials: DataFrame) -> DataFrame:
    return exact.merged(partials, METRIC, ["value", "stderr"])


def finished_stats(partials: DataFrame) -> DataFrame:
    """Mean and spread of value and stderr, each over its own non-null count."""
    found = exact.moments(partials, METRIC, ["value", "stderr"])
    return found.select(
        *METRIC,
        F.col("value_n").alias("n"),
        "value_mean",
        "value_std",
        F.col("stderr_n").alias("n_stderr"),
        "stderr_mean",
        "stderr_std",
    )


def group_stats(metrics: DataFrame) -> DataFrame:
    """Mean and spread of value and stderr, each rounded once, whatever the partitions."""
    return finished_stats(partial_stats(metrics))


def position() -> Column:
    """Order of runs: path first, then place in the document."""
    return F.struct("path", "task_ord")


def partial_durations(results: DataFrame) -> DataFrame:
    """Repetitions and exact sums of the durations per group; such tables add up."""
    return exact.partial_moments(results, GROUP, {"duration": F.col("evaluation_duration_seconds")})


def merged_durations(partials: DataFrame) -> DataFrame:
    return exact.merged(partials, GROUP, ["duration"])


def finished_durations(partials: DataFrame) -> DataFrame:
    found = exact.moments(partials, GROUP, ["duration"])
    return found.select(
        *GROUP, F.col("rows").alias("num_repetitions"), F.col("duration_n").alias("n_durations"), "duration_mean", "duration_std"
    )


def partial_groups(results: DataFrame) -> DataFrame:
    """``partial_stats``, ``partial_durations`` and ``first_run`` in one table and one pass: durations stand as values
    without a metric, and every row has the first run of what it adds up."""
    run = F.struct(
        F.lit(None).cast("string").alias("metric"), F.col("evaluation_duration_seconds").alias("value"), F.lit(None).cast("double").alias("stderr")
    )
    measured = F.transform(
        F.map_entries("metrics"),
        lambda m: F.struct(m["key"].alias("metric"), m["value"]["value"].alias("value"), m["value"]["stderr"].alias("stderr")),
    )
    rows = results.select(*GROUP, "path", "task_ord", "inference_parameters", F.inline(F.concat(F.array(run), measured)))
    alone = F.col("metric").isNull()
    firsts = [
        F.min_by(F.when(alone, F.col("inference_parameters")), position()).alias("inference_parameters"),
        F.min(position()).alias("first_seen"),
    ]
    return exact.partial_moments(rows, METRIC, {"value": F.col("value"), "stderr": F.col("stderr")}, firsts, ["path", "task_ord", "inference_parameters"])


def stats_of(partials: DataFrame) -> DataFrame:
    """What ``group_stats`` gives, from tables of ``partial_groups``."""
    return finished_stats(merged_stats(partials.where("metric is not null")))


def groups_of(partials: DataFrame) -> DataFrame:
    """What ``group_rows`` gives, from tables of ``partial_groups``."""
    runs = partials.where("metric is null")
    firsts = runs.groupBy(*GROUP).agg(
        F.min_by("inference_parameters", "first_seen").alias("inference_parameters"), F.min("first_seen").alias("first_seen")
    )
    named = {c: c.replace("value", "duration") for c in runs.columns if c.startswith("value_")}
    return with_durations(firsts, finished_durations(merged_durations(runs.withColumnsRenamed(named))))


def duration_stats(results: DataFrame) -> DataFrame:
    """Repetitions with mean and spread of the durations per group."""
    return finished_durations(partial_durations(results))


def first_run(results: DataFrame) -> DataFrame:
    """Parameters and position of the first run of each group; the first of several such tables is the first of all."""
    return results.groupBy(*GROUP).agg(
        F.min_by("inference_parameters", position()).alias("inference_parameters"),
        F.min(position()).alias("first_seen"),
    )


def group_rows(results: DataFrame) -> DataFrame:
    """Everything about a group that takes one row, ``first_seen`` giving report order."""
    return with_durations(first_run(results), duration_stats(results))


def with_durations(firsts: DataFrame, durations: DataFrame) -> DataFrame:
    """First runs and durations of the same groups as one row each."""
    return firsts.join(durations, same_group(firsts, durations)).select(
        *(firsts[name] for name in GROUP),
        "inference_parameters",
        "first_seen",
        "num_repetitions",
        F.struct(F.col("duration_mean").alias("mean"), F.col("duration_std").alias("std")).alias("evaluation_duration_seconds"),
    )


def same_group(left: DataFrame, right: DataFrame) -> Column:
    """Join condition in which a missing model name equals a missing model name."""
    return (left["task_name"] == right["task_name"]) & left["model_name"].eqNullSafe(
        right["model_name"]
    )


def grouped(results: DataFrame) -> DataFrame:
    """One nested row per group: parameters, repetitions and aggregate_stats.

    The map of metrics is bounded by the metric names of one task. The runs of a group
    have no such bound and stay flat, see ``runs``.
    """
    groups = group_rows(results)
    per_metric = group_stats(metrics_long(results)).select(
        *GROUP,
        F.struct(
            "metric",
            F.struct(
                F.struct(F.col("value_mean").alias("mean"), F.col("value_std").alias("std")).alias("value"),
                F.struct(F.col("stderr_mean").alias("mean"), F.col("stderr_std").alias("std")).alias("stderr"),
            ).alias("stats"),
        ).alias("_entry"),
    )
    maps = per_metric.groupBy(*GROUP).agg(
        F.map_from_entries(F.sort_array(F.collect_list("_entry"))).alias("metrics")
    )
    return groups.join(maps, same_group(groups, maps), "left").select(
        groups["task_name"],
        groups["model_name"],
        groups["inference_parameters"],
        groups["num_repetitions"],
        F.struct(
            groups["evaluation_duration_seconds"],
            F.coalesce(maps["metrics"], F.create_map().cast(maps.schema["metrics"].dataType)).alias("metrics"),
        ).alias("aggregate_stats"),
        groups["first_seen"],
    )


def runs(results: DataFrame) -> DataFrame:
    """Single runs; ``(path, task_ord)`` is their order within a group."""
    return results.select(
        *GROUP,
        "path",
        "task_ord",
        "source_filename",
        "evaluation_datetime",
        "evaluation_datetime_iso",
        "evaluation_duration_seconds",
        "metrics",
    )


def totals(outcomes: DataFrame) -> DataFrame:
    """One row: accepted documents, with or without rows, and reported rows."""
    accepted = F.col("code").isNull()
    return outcomes.agg(
        F.coalesce(F.sum(F.when(accepted, F.size("rows"))), F.lit(0)).cast("bigint").alias("total_results_parsed"),
        F.count(F.when(accepted, 1)).alias("total_files_parsed"),
    )


def unique_names(results: DataFrame) -> DataFrame:
    """Distinct ``(kind, name)`` rows: tasks, and models that have a name."""
    pairs = F.array(
        F.struct(F.lit("task").alias("kind"), F.col("task_name").alias("name")),
        F.struct(F.lit("model").alias("kind"), F.nullif("model_name", F.lit("")).alias("name")),
    )
    return results.select(F.inline(pairs)).where(F.col("name").isNotNull()).distinct()
