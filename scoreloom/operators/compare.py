"""Models against a baseline model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def compare_models(stats: DataFrame, baseline: str) -> DataFrame:
    """Delta, recovery and z-score of every model against ``baseline``.

    ``stats`` is ``group_stats`` output: the window runs on aggregated rows, one per
    model in each (task, metric). The z-score divides by the root of the summed
    squares of the two mean standard errors and is NULL where either is missing.
    """
    same = W.partitionBy("task_name", "metric")
    of_base = lambda name: F.max(F.when(F.col("model_name") == baseline, F.col(name))).over(same)
    stats = stats.select(
        "*", of_base("value_mean").alias("baseline_mean"), of_base("stderr_mean").alias("baseline_stderr")
    )
    pooled = F.sqrt(F.pow("stderr_mean", F.lit(2)) + F.pow("baseline_stderr", F.lit(2)))
    delta = F.col("value_mean") - F.col("baseline_mean")
    return stats.select(
        "task_name",
        "model_name",
        "metric",
        "value_mean",
        "baseline_mean",
        delta.alias("delta"),
        F.when(F.col("baseline_mean") != 0, 100 * F.col("value_mean") / F.col("baseline_mean")).alias(
            "recovery_pct"
        ),
        F.when(pooled > 0, delta / pooled).alias("z_score"),
    )


def wide(stats: DataFrame, models: Sequence[str], value: str = "value_mean") -> DataFrame:
    """One row per (task, metric), one column per named model."""
    return stats.groupBy("task_name", "metric").pivot("model_name", list(models)).agg(F.first(value))
