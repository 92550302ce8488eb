"""The run matrix: configurations, repetitions, seeds, output paths, and what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.scalars import render_nested_params, render_params

CONFIG_SCHEMA = (
    "suite string, suite_ord int, script string, task_label string, task_tag string, task_name string,"
    " harness string, environment string, model_name string, shots int, reps int, max_length int,"
    " max_gen_toks int, think_budget int, strip_reasoning boolean"
)

_QWEN, _LLAMA = "Qwen/Qwen3-8B", "meta-llama/Llama-3.1-8B-Instruct"

# The 13 configurations.
# fmt: off
RUN_CONFIGS = [
    ("reasoning", 1, "gsm8k-platinum", "gsm8k_platinum", "gsm8k_platinum_cot_llama", "gsm8k_platinum_cot_llama",
     "lm_eval", "lm-eval-base", _QWEN, 0, 3, 16384, 8192, 4096, False),
    ("reasoning", 2, "mmlu-pro", "mmlu_pro", "mmlu_pro_chat", "mmlu_pro_chat",
     "lm_eval", "lm-eval-mmlu-pro-fork", _QWEN, 0, 3, 12288, 4096, 2048, False),
    ("reasoning", 3, "ifeval", "ifeval", "ifeval", "ifeval",
     "lm_eval", "lm-eval-base", _QWEN, 0, 3, 10722, 2560, 1280, False),
    ("reasoning", 4, "math-500", "math_500", "math_500", "math_500|0",
     "lighteval", "lighteval-fork", _QWEN, 0, 3, None, 32768, None, True),
    ("reasoning", 5, "aime-25", "aime_25", "aime25", "aime25|0",
     "lighteval", "lighteval-fork", _QWEN, 0, 8, None, 32768, None, True),
    ("reasoning", 6, "gpqa-diamond", "gpqa_diamond", "gpqa:diamond", "gpqa:diamond|0",
     "lighteval", "lighteval-fork", _QWEN, 0, 3, None, 32768, None, True),
    ("instruction", 1, "gsm8k-platinum", "gsm8k_platinum", "gsm8k_platinum_cot_llama", "gsm8k_platinum_cot_llama",
     "lm_eval", "lm-eval-base", _LLAMA, 5, 3, 8192, 4096, None, False),
    ("instruction", 2, "mmlu-cot", "mmlu_cot", "mmlu_cot_llama", "mmlu_cot_llama",
     "lm_eval", "lm-eval-base", _LLAMA, 5, 3, 4096, 1024, None, False),
    ("instruction", 3, "mmlu-pro", "mmlu_pro", "mmlu_pro_chat", "mmlu_pro_chat",
     "lm_eval", "lm-eval-mmlu-pro-fork", _LLAMA, 5, 3, 8192, 2048, None, False),
    ("instruction", 4, "ifeval", "ifeval", "ifeval", "ifeval",
     "lm_eval", "lm-eval-base", _LLAMA, 0, 3, 8192, 1280, None, False),
    ("instruction", 5, "math-500", "math_500", "math_500", "math_500|0",
     "lighteval", "lighteval-fork", _LLAMA, 0, 3, None, 32000, None, False),
    ("long-context", 1, "mrcr", "mrcr", "mrcr", "mrcr",
     "lm_eval", "lm-eval-mrcr-fork", _QWEN, 0, 3, 40960, 4096, 4096, False),
    ("coding", 1, "live-code-bench", "live_code_bench", "lcb:codegeneration_v6", "lcb:codegeneration_v6",
     "lighteval", "lighteval-fork", _QWEN, 0, 3, None, 32768, None, True),
]
# fmt: on

# Sampling and request settings shared by all configurations.
TEMPERATURE, TOP_P, TOP_K = "0.6", "0.9", "50"
SEED_BASE = 1233
REQUESTS = {
    "lm_eval": {"num_concurrent": "128", "max_retries": "3", "timeout": "1200"},
    "lighteval": {"timeout": "3600", "concurrent_requests": "8"},
}


def run_configs(spark: SparkSession) -> DataFrame:
    """The 13 configurations as a table; any table with these columns will do."""
    return spark.createDataFrame(RUN_CONFIGS, CONFIG_SCHEMA)


def expand_runs(configs: DataFrame) -> DataFrame:
    """One row per repetition with its seed and output path."""
    seeded = configs.where(F.col("reps") > 0).withColumn(
        "rep", F.explode(F.sequence(F.lit(1), F.col("reps")))
    ).withColumn("seed", F.col("rep") + F.lit(SEED_BASE))
    return seeded.withColumn("output_path", output_path(F.col("harness"), F.col("task_label")))


def output_path(harness: Column, label: Column) -> Column:
    """File for one harness, directory for the other."""
    stem = F.format_string("results/%s_%d_seed_%d", label, F.col("rep"), F.col("seed"))
    return F.when(harness == "lighteval", stem).otherwise(F.concat(stem, F.lit(".json")))


def read_output_path(path: Column) -> Column:
    """``struct<task_label, rep, seed>`` back from an output path or a file below it."""
    pattern = r"(?:^|/)results/([^/]+)_(\d+)_seed_(\d+)(?:\.json$|/|$)"
    part = lambda i: F.regexp_extract(path, pattern, i)
    return F.when(
        path.rlike(pattern),
        F.struct(
            part(1).alias("task_label"),
            part(2).cast("int").alias("rep"),
            part(3).cast("int").alias("seed"),
        ),
    )


def generation_params(runs: DataFrame) -> DataFrame:
    """Adds the packed parameter strings a harness is started with."""
    text = lambda name: F.col(name).cast("string")
    lm_eval = render_params(
        F.create_map(
            F.lit("do_sample"), F.lit("True"),
            F.lit("temperature"), F.lit(TEMPERATURE),
            F.lit("top_p"), F.lit(TOP_P),
            F.lit("top_k"), F.lit(TOP_K),
            F.lit("max_gen_toks"), text("max_gen_toks"),
            F.lit("thinking_token_budget"), text("think_budget"),
            F.lit("seed"), text("seed"),
        )
    )
    settings = REQUESTS["lighteval"]
    lighteval = render_nested_params(
        F.create_map(
            F.lit("model_name"), F.col("model_name"),
            F.lit("timeout"), F.lit(settings["timeout"]),
            F.lit("concurrent_requests"), F.lit(settings["concurrent_requests"]),
        ),
        "generation_parameters",
        F.create_map(
            F.lit("temperature"), F.lit(TEMPERATURE),
            F.lit("max_new_tokens"), text("max_gen_toks"),
            F.lit("top_p"), F.lit(TOP_P),
            F.lit("seed"), text("seed"),
            F.lit("top_k"), F.lit(TOP_K),
        ),
    )
    return runs.withColumn(
        "parameters", F.when(F.col("harness") == "lighteval", lighteval).otherwise(lm_eval)
    )


# What the harnesses are told besides the request settings.
_CHAT_SETTINGS = {"tokenized_requests": "False", "tokenizer_backend": "None"}
_THINKING = {"enable_thinking": "True", "think_end_token": "</think>"}
_LIGHTEVAL_TASK = "%s@k=1@n=1|0"


def model_args(runs: DataFrame) -> DataFrame:
    """Adds ``model_args``, the string that names model and requests for one harness; NULL for the other.

    ``max_length`` and the two keys of thinking models are left out where a run has none. Server addresses are
    the caller's.
    """
    settings = REQUESTS["lm_eval"] | _CHAT_SETTINGS
    order = ("num_concurrent", "max_retries", "tokenized_requests", "tokenizer_backend", "timeout")
    pairs = [("model", F.col("model_name")), ("max_length", F.col("max_length").cast("string"))]
    pairs += [(key, F.lit(settings[key])) for key in order]
    thinks = F.col("think_budget").isNotNull()
    pairs += [(key, F.when(thinks, value)) for key, value in _THINKING.items()]
    packed = render_params(F.create_map(*(c for key, value in pairs for c in (F.lit(key), value))))
    return runs.withColumn("model_args", F.when(F.col("harness") == "lm_eval", packed))


def task_spec(runs: DataFrame) -> DataFrame:
    """Adds ``task_spec``: the task as each harness is asked for it."""
    spec = F.when(F.col("harness") == "lighteval", F.format_string(_LIGHTEVAL_TASK, "task_tag"))
    return runs.withColumn("task_spec", spec.otherwise(F.col("task_tag")))


def suite_rollup(stats: DataFrame, configs: DataFrame) -> DataFrame:
    """Mean over tasks per suite and model of per-metric group statistics.

    A task may belong to several suites, so this is a join on the task name.
    """
    members = configs.select("suite", "task_name").distinct()
    return (
        stats.join(members, "task_name")
        .groupBy("suite", "model_name")
        .agg(
            F.countDistinct("task_name").alias("n_tasks"),
            F.avg("value_mean").alias("suite_mean"),
        )
    )


def run_gaps(planned: DataFrame, observed: DataFrame, keys: list[str]) -> DataFrame:
    """Runs that are planned but missing, and runs that were not planned.

    Both sides shrink to distinct keys first; one grouping then answers both questions.
    """
    sides = planned.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("o")).unionByName(
        observed.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("o"))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.max("p").alias("p"), F.max("o").alias("o"))
        .where(F.col("p") != F.col("o"))
        .select(*keys, F.when(F.col("p") == 1, "missing").otherwise("unplanned").alias("gap"))
    )


def completeness(planned: DataFrame, observed: DataFrame, keys: list[str], by: list[str]) -> DataFrame:
    """Planned, observed and missing counts per group."""
    sides = planned.select(*keys, F.lit(1).alias("p"), F.lit(0).alias("o")).unionByName(
        observed.select(*keys, F.lit(0).alias("p"), F.lit(1).alias("o"))
    )
    return (
        sides.groupBy(*keys)
        .agg(F.max("p").alias("p"), F.max("o").alias("o"))
        .groupBy(*by)
        .agg(
            F.sum("p").alias("planned"),
            F.sum(F.col("p") * F.col("o")).alias("done"),
            F.sum(F.col("p") * (1 - F.col("o"))).alias("missing"),
            F.sum((1 - F.col("p")) * F.col("o")).alias("unplanned"),
        )
    )
