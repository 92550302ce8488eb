"""Which metrics of which task are reported."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import broadcast_if_small, materialize

# Task and metric names as the harnesses print them.
DEFAULT_REGISTRY: dict[str, tuple[str, ...]] = {
    "gsm8k_platinum_cot_llama": ("exact_match,strict-match",),
    "mmlu_cot_llama": ("exact_match,strict_match",),
    "mmlu_pro_chat": ("exact_match,custom-extract",),
    "ifeval": ("inst_level_strict_acc,none",),
    "math_500|0": ("pass@k:k=1&n=1",),
    "aime25|0": ("pass@k:k=1&n=1",),
    "gpqa:diamond|0": ("gpqa_pass@k:k=1&n=1",),
    "lcb:codegeneration_v6": ("codegen_pass@k:k=1&n=1",),
    "mrcr": ("score_gt_16k_le_32k", "AUC"),
}

#: Rows up to which a registry is a literal in the plan; a larger one is joined. Both report the same.
LITERAL_ENTRIES = 1000

REGISTRY_SCHEMA = "task_name string, metric_key string, ord int"

Registry = Mapping[str, Iterable[str]] | DataFrame


def registry_frame(spark: SparkSession, registry: Registry | None = None) -> DataFrame:
    """Registry as rows ``(task_name, metric_key, ord)``."""
    if isinstance(registry, DataFrame):
        return registry
    rows = [
        (task, metric, i)
        for task, metrics in (DEFAULT_REGISTRY if registry is None else registry).items()
        for i, metric in enumerate(metrics)
    ]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def stored_registry(registry: DataFrame) -> DataFrame:
    """The registry as a table in the shared folder: it is read to see how long it is and again to be joined, but made once."""
    return materialize(registry.select("task_name", "metric_key", "ord"), "registry-rows")


def as_mapping(registry: Registry | None) -> dict[str, tuple[str, ...]] | None:
    """Registry as a dictionary that becomes a literal in the plan; None if it is too large for one."""
    if registry is None:
        return dict(DEFAULT_REGISTRY)
    if isinstance(registry, DataFrame):
        rows = registry.select("task_name", "metric_key", "ord").limit(LITERAL_ENTRIES + 1).collect()
        if len(rows) > LITERAL_ENTRIES:
            return None
        found: dict[str, tuple[str, ...]] = {}
        for row in sorted(rows, key=lambda r: (r.task_name, r.ord)):
            found[row.task_name] = (*found.get(row.task_name, ()), row.metric_key)
        return found
    found = {task: tuple(metrics) for task, metrics in registry.items()}
    return found if sum(map(len, found.values())) <= LITERAL_ENTRIES else None


def metrics_by_task(registry: DataFrame) -> DataFrame:
    """``(_name, reported)``: the metrics of each task in order, to be joined with the tasks of documents.

    Broadcast if it is measured to be small; beyond, both sides are shuffled by task name.
    """
    entries = F.sort_array(F.collect_list(F.struct("ord", "metric_key")))
    grouped = registry.groupBy(F.col("task_name").alias("_name")).agg(F.transform(entries, lambda e: e["metric_key"]).alias("reported"))
    return broadcast_if_small(materialize(grouped, "registry"))


def keep_registered(metrics: DataFrame, registry: DataFrame) -> DataFrame:
    """Semi-join of long-form metrics with a registry of any size."""
    pairs = registry.select("task_name", metric_key := "metric_key").withColumnRenamed(metric_key, "metric")
    return metrics.join(pairs, ["task_name", "metric"], "left_semi")
