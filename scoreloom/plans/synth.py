"""Evaluation documents made from plain tables, for queries and tests.

The documents are built with to_json and then go through the real pipeline.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IFEVAL = "ifeval"


def file_path(key: Column, folder: str = "/runs") -> Column:
    """Zero-padded, so that path order is key order."""
    return F.format_string(f"{folder}/%019d.json", key.cast("bigint"))


def event_task(event_type: Column) -> Column:
    """Four event types stand for registered tasks, the fifth for an unregistered one."""
    return (
        F.when(event_type == "click", "gsm8k_platinum_cot_llama")
        .when(event_type == "purchase", "mmlu_cot_llama")
        .when(event_type == "signup", "mmlu_pro_chat")
        .when(event_type == "view", IFEVAL)
        .otherwise("custom_error_task")
    )


def event_metric(event_type: Column) -> Column:
    return (
        F.when(event_type == "click", "exact_match,strict-match")
        .when(event_type == "purchase", "exact_match,strict_match")
        .when(event_type == "signup", "exact_match,custom-extract")
        .otherwise("inst_level_strict_acc,none")
    )


def event_model(user_id: Column) -> Column:
    return F.concat(F.lit("m"), F.pmod(user_id, F.lit(5)).cast("string"))


def epoch(ts: Column) -> Column:
    """Seconds with microseconds, exact in a double of this size."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def variant(value: Column, kind: str) -> Column:
    return value.cast(kind).cast("variant")


def lm_eval_content(
    results: Column,
    *,
    model: Column,
    date: Column | None = None,
    duration: Column | None = None,
    gen_kwargs: Column | None = None,
    keep_nulls: bool = False,
) -> Column:
    """With ``keep_nulls`` a null member of a struct is written as ``null``, like one of a map."""
    config = F.create_map().cast("map<string,string>")
    if gen_kwargs is not None:
        config = F.struct(gen_kwargs.alias("gen_kwargs"))
    fields = [
        results.alias("results"),
        F.create_map().cast("map<string,string>").alias("configs"),
        config.alias("config"),
        model.alias("model_name"),
    ]
    if date is not None:
        fields.append(date.alias("date"))
    if duration is not None:
        fields.append(duration.alias("total_evaluation_time_seconds"))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"} if keep_nulls else None)


def lighteval_content(
    results: Column,
    *,
    model: Column,
    start_time: Column | None = None,
    duration: Column | None = None,
    generation: Column | None = None,
) -> Column:
    header = [model.alias("model_name")]
    if start_time is not None:
        header.append(start_time.alias("start_time"))
    if duration is not None:
        header.append(duration.alias("total_evaluation_time_secondes"))
    if generation is not None:
        header.append(F.struct(generation.alias("generation_parameters")).alias("model_config"))
    return F.to_json(F.struct(F.struct(*header).alias("config_general"), results.alias("results")))


def documents(df: DataFrame, path: Column, content: Column) -> DataFrame:
    return df.select(
        path.alias("path"),
        F.substring_index(path, "/", -1).alias("source_filename"),
        content.alias("content"),
    )


def event_documents(events: DataFrame, **extra: Column) -> DataFrame:
    """One document per event: one task, one metric, the event's value."""
    kind = F.col("event_type")
    results = F.create_map(event_task(kind), F.create_map(event_metric(kind), F.col("value")))
    content = lm_eval_content(results, model=event_model(F.col("user_id")), **extra)
    return documents(events, file_path(F.col("event_id")), content)


def order_documents(orders: DataFrame) -> DataFrame:
    """One document of the second format per order."""
    priority = F.col("o_orderpriority")
    task = (
        F.when(priority == "1-URGENT", "math_500|0")
        .when(priority == "2-HIGH", "aime25|0")
        .when(priority == "3-MEDIUM", "gpqa:diamond|0")
        .when(priority == "4-NOT SPECIFIED", "lcb:codegeneration_v6")
        .otherwise("all")
    )
    metric = (
        F.when(priority == "3-MEDIUM", "gpqa_pass@k:k=1&n=1")
        .when(priority == "4-NOT SPECIFIED", "codegen_pass@k:k=1&n=1")
        .otherwise("pass@k:k=1&n=1")
    )
    model = F.concat(F.lit("c"), F.pmod(F.col("o_custkey"), F.lit(7)).cast("string"))
    content = lighteval_content(
        F.create_map(task, F.create_map(metric, F.col("o_totalprice"))), model=model
    )
    return documents(orders, file_path(F.col("o_orderkey"), "/orders"), content)
