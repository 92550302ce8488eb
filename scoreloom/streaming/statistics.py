"""Statistics of everything ingested so far, kept as partial tables that add up exactly.

Every batch leaves the exact sums of its own rows and the first run of each of its groups, in one table. To know the
statistics after a further batch, these small tables are read, never the outcomes of earlier batches; and what they give
is bit for bit what one pass over all outcomes would give.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G


def write_partials(outcomes: DataFrame, folder: str, batch_id: int) -> None:
    """The partial table of one batch; a repeated batch replaces its own."""
    partials = G.partial_groups(X.results(outcomes))
    # a few rows per group of the batch: one file does
    partials.coalesce(1).write.mode("overwrite").parquet(f"{folder}/batch_id={batch_id}")


@dataclass(frozen=True)
class Statistics:
    """What the batches add up to: ``stats`` as from ``group_stats``, ``groups`` as from ``group_rows``."""

    stats: DataFrame
    groups: DataFrame


def stored_statistics(spark: SparkSession, folder: str) -> Statistics | None:
    """Statistics of all batches; None if none has come yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    partials = spark.read.parquet(folder).drop("batch_id")
    return Statistics(G.stats_of(partials), G.groups_of(partials))
