"""Queries over parsed documents. The SQL never sees the JSON."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G
from scoreloom.operators.adapters import DEFAULT_ADAPTERS, Adapter, ParamField
from scoreloom.plans import synth
from scoreloom.plans.catalog import query, table, work_table
from scoreloom.session import materialize, shared_dir
from scoreloom.sources.harness import harness_documents, write_documents
from scoreloom.sources.report import read_report, report_lines, write_report
from scoreloom.sources.scan import scan_documents
from scoreloom.streaming.ingest import ingest
from scoreloom.streaming.statistics import stored_statistics

TASK_SQL = """case event_type when 'click' then 'gsm8k_platinum_cot_llama'
        when 'purchase' then 'mmlu_cot_llama' when 'signup' then 'mmlu_pro_chat'
        when 'view' then 'ifeval' end"""
METRIC_SQL = """case event_type when 'click' then 'exact_match,strict-match'
        when 'purchase' then 'exact_match,strict_match' when 'signup' then 'exact_match,custom-extract'
        when 'view' then 'inst_level_strict_acc,none' end"""
# Scores below 1. The odd divisor also keeps means off the exact ties of rounding.
SCALE = 490.03
RUNS_SQL = f"""with runs as (
    select * replace (value / {SCALE} as value), {TASK_SQL} as task_name, {METRIC_SQL} as metric,
           'm' || (user_id % 5) as model_name,
           lpad(event_id::varchar, 19, '0') || '.json' as source_filename
    from events where event_type <> 'error')
"""


def r6(name: str):
    return F.round(name, 6).alias(name.split(".")[-1])


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work_table(spark, sf_dir, "events").withColumn("value", F.col("value") / SCALE)


def scored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work_table(spark, sf_dir, "orders").withColumn("o_totalprice", F.col("o_totalprice") / SCALE)


def event_results(spark: SparkSession, sf_dir: str, **extra) -> DataFrame:
    docs = synth.event_documents(scored_events(spark, sf_dir), **extra)
    return X.results(X.extract(docs))


@query(
    RUNS_SQL
    + """select task_name, model_name, metric, count(*) as n,
    round(avg(value), 6) as value_mean, round(stddev_samp(value), 6) as value_std
from runs group by all"""
)
def lmeval_group_stats(spark, sf_dir):
    stats = G.group_stats(G.metrics_long(event_results(spark, sf_dir)))
    return stats.select(*G.GROUP, "metric", "n", r6("value_mean"), r6("value_std"))


@query(f"""select task_name, model_name, count(*) as n, round(avg(price), 4) as value_mean,
    round(stddev_samp(price), 4) as value_std
from (select *, o_totalprice / {SCALE} as price, case o_orderpriority when '1-URGENT' then 'math_500|0' when '2-HIGH' then 'aime25|0'
        when '3-MEDIUM' then 'gpqa:diamond|0' when '4-NOT SPECIFIED' then 'lcb:codegeneration_v6' end as task_name,
        'c' || (o_custkey % 7) as model_name from orders)
where task_name is not null group by all""")
def lighteval_group_stats(spark, sf_dir):
    docs = synth.order_documents(scored_orders(spark, sf_dir))
    stats = G.group_stats(G.metrics_long(X.results(X.extract(docs))))
    return stats.select(
        *G.GROUP, "n", F.round("value_mean", 4).alias("value_mean"), F.round("value_std", 4).alias("value_std")
    )


@query(
    RUNS_SQL
    + f"""select 'lm_eval' as framework, task_name, count(*) as n, round(avg(value), 4) as value_mean
from runs group by task_name
union all
select 'lighteval', case o_orderpriority when '1-URGENT' then 'math_500|0' when '2-HIGH' then 'aime25|0'
    when '3-MEDIUM' then 'gpqa:diamond|0' else 'lcb:codegeneration_v6' end as task_name, count(*),
    round(avg(o_totalprice / {SCALE}), 4)
from orders where o_orderpriority <> '5-LOW' group by 2"""
)
def mixed_framework_union(spark, sf_dir):
    docs = synth.event_documents(scored_events(spark, sf_dir)).unionByName(
        synth.order_documents(scored_orders(spark, sf_dir))
    )
    found = X.results(X.extract(docs))
    values = found.select("framework", "task_name", F.explode(F.map_values("metrics")).alias("m"))
    return values.groupBy("framework", "task_name").agg(
        F.count("m.value").alias("n"), F.round(F.avg("m.value"), 4).alias("value_mean")
    )


@query(
    RUNS_SQL
    + """select task_name, model_name, count(*) as n, count(stderr) as n_stderr,
    round(avg(stderr), 6) as stderr_mean,
    case when count(stderr) = 1 then 0.0 else round(stddev_samp(stderr), 6) end as stderr_std
from (select *, case event_id % 3 when 0 then value / 100 when 1 then value / 50 end as stderr from runs)
group by all"""
)
def stderr_lookup(spark, sf_dir):
    kind, value, turn = F.col("event_type"), F.col("value"), F.pmod(F.col("event_id"), F.lit(3))
    metric = synth.event_metric(kind)
    before_comma = F.regexp_replace(metric, ",", "_stderr,")
    appended = F.concat(metric, F.lit("_stderr"))
    members = F.create_map(
        metric, synth.variant(value, "double"),
        before_comma,
        F.when(turn == 0, synth.variant(value / 100, "double")).when(turn == 2, synth.variant(F.lit("N/A"), "string")),
        # behind "N/A" this one must not be found
        appended, synth.variant(value / 50, "double"),
    )
    content = synth.lm_eval_content(
        F.create_map(synth.event_task(kind), members), model=synth.event_model(F.col("user_id"))
    )
    events = scored_events(spark, sf_dir)
    docs = synth.documents(events, synth.file_path(F.col("event_id")), content)
    stats = G.group_stats(G.metrics_long(X.results(X.extract(docs))))
    return stats.select(*G.GROUP, "n", "n_stderr", r6("stderr_mean"), r6("stderr_std"))


@query(f"""select task_name, count(*) as n, count(stderr) as n_stderr, round(avg(stderr), 4) as stderr_mean
from (select case o_orderpriority when '1-URGENT' then 'math_500|0' when '2-HIGH' then 'aime25|0'
        when '3-MEDIUM' then 'gpqa:diamond|0' when '4-NOT SPECIFIED' then 'lcb:codegeneration_v6' end as task_name,
        case o_orderkey % 3 when 0 then o_totalprice / {SCALE} / 7 end as stderr from orders)
where task_name is not null group by task_name""")
def lighteval_stderr(spark, sf_dir):
    """The other harness appends its mark to the whole name; a mark before a comma, or a text, is none."""
    docs = synth.order_documents(scored_orders(spark, sf_dir).withColumn("o_totalprice", F.col("o_totalprice") / 7))
    key = F.col("content")
    marked = F.regexp_replace(key, r'("[^"]*pass@k:k=1&n=1)":([0-9.Ee+-]+)', '$1":$2,$1_stderr":$2')
    unmarked = F.regexp_replace(key, r'("[^"]*pass@k:k=1&n=1)":([0-9.Ee+-]+)', '$1":$2,$1_stderr":"N/A",$1_stderr,x":$2')
    number = F.substring_index("source_filename", ".", 1).cast("bigint") % 3
    docs = docs.withColumn("content", F.when(number == 0, marked).when(number == 1, unmarked).otherwise(key))
    stats = G.metrics_long(X.results(X.extract(docs))).groupBy("task_name")
    return stats.agg(F.count("value").alias("n"), F.count("stderr").alias("n_stderr"), F.round(F.avg("stderr"), 4).alias("stderr_mean"))


@query(
    RUNS_SQL
    + """select row_number() over (order by min(event_id))::int as position, task_name, model_name, count(*) as num_repetitions
from runs group by task_name, model_name"""
)
def report_order(spark, sf_dir):
    """Places of the groups in the written report: by their first run."""
    outcomes = materialize(X.extract(synth.event_documents(scored_events(spark, sf_dir))), "outcomes")
    folder = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    lines = read_report(spark, write_report(outcomes, folder, layout="parts"), position=True)
    heads = lines.where(F.col("text").rlike('^,?\\{"task_name"'))
    field = lambda name, kind: F.get_json_object(F.concat(F.regexp_extract("text", '^,?(.*),"aggregate_stats"', 1), F.lit("}")), f"$.{name}").cast(kind)
    # as many rows as groups
    order = F.row_number().over(W.orderBy("file", "line"))
    return heads.select(
        order.alias("position"), field("task_name", "string").alias("task_name"), field("model_name", "string").alias("model_name"),
        field("num_repetitions", "bigint").alias("num_repetitions"),
    )


@query(
    RUNS_SQL
    + """select task_name, model_name, count(*) as num_repetitions, count(seconds) as n_durations,
    round(avg(seconds), 6) as duration_mean,
    case when count(seconds) = 1 then 0.0 else round(stddev_samp(seconds), 6) end as duration_std
from (select *, case event_id % 4 when 0 then value when 1 then value end as seconds from runs)
group by all"""
)
def duration_stats(spark, sf_dir):
    turn, value = F.pmod(F.col("event_id"), F.lit(4)), F.col("value")
    duration = (
        F.when(turn == 0, synth.variant(value, "double"))
        .when(turn == 1, synth.variant(value, "string"))
        .when(turn == 2, synth.variant(F.lit("abc"), "string"))
    )
    stats = G.duration_stats(event_results(spark, sf_dir, duration=duration))
    return stats.select(*G.GROUP, "num_repetitions", "n_durations", r6("duration_mean"), r6("duration_std"))


@query(
    RUNS_SQL
    + """select source_filename, strftime(t, '%Y-%m-%dT%H:%M:%S')
    || case when microsecond(t) % 1000000 = 0 then '' else strftime(t, '.%f') end || '+00:00' as iso
from (select source_filename, case when event_id % 10 = 0 then date_trunc('second', ts) else ts end as t from runs)"""
)
def epoch_iso(spark, sf_dir):
    seconds = synth.epoch(F.col("ts"))
    date = F.when(F.pmod(F.col("event_id"), F.lit(10)) == 0, F.floor(seconds).cast("double")).otherwise(seconds)
    found = event_results(spark, sf_dir, date=date)
    return found.select("source_filename", F.col("evaluation_datetime_iso").alias("iso"))


@query(
    RUNS_SQL
    + """select framework, source_filename, temperature, top_k, max_gen_toks, seed,
    case when framework = 'lm_eval' then event_id % 2 = 0 else coalesce(temperature > 0, false) end as do_sample
from (select f.framework, source_filename, event_id,
        case event_id % 3 when 0 then value when 1 then null
             else case when f.framework = 'lighteval' then 0.0 end end as temperature,
        50::bigint as top_k, 1000 + user_id as max_gen_toks, 1234 + event_id as seed
      from runs, (values ('lm_eval'), ('lighteval')) f(framework))"""
)
def inference_params(spark, sf_dir):
    events = scored_events(spark, sf_dir)
    turn = F.pmod(F.col("event_id"), F.lit(3))
    temperature = (
        F.when(turn == 0, F.create_map(F.lit("temperature"), synth.variant(F.col("value"), "double")))
        .when(turn == 1, F.create_map(F.lit("temperature"), F.parse_json(F.lit("null"))))
        .otherwise(F.create_map().cast("map<string,variant>"))
    )

    def params(length_key: str, *more):
        return F.map_concat(
            F.create_map(
                F.lit("top_k"), synth.variant(F.lit(50), "bigint"),
                F.lit(length_key), synth.variant(F.col("user_id") + 1000, "bigint"),
                F.lit("seed"), synth.variant(F.col("event_id") + 1234, "bigint"),
                *more,
            ),
            temperature,
        )

    kind = F.col("event_type")
    results = F.create_map(synth.event_task(kind), F.create_map(synth.event_metric(kind), F.col("value")))
    model = synth.event_model(F.col("user_id"))
    sampled = synth.variant(F.pmod(F.col("event_id"), F.lit(2)) == 0, "boolean")
    first = synth.lm_eval_content(results, model=model, gen_kwargs=params("max_gen_toks", F.lit("do_sample"), sampled))
    second = synth.lighteval_content(results, model=model, generation=params("max_new_tokens"))
    docs = synth.documents(events, synth.file_path(F.col("event_id"), "/lm"), first).unionByName(
        synth.documents(events, synth.file_path(F.col("event_id"), "/le"), second)
    )
    p = "inference_parameters."
    return X.results(X.extract(docs)).select(
        "framework", "source_filename", p + "temperature", p + "top_k", p + "max_gen_toks", p + "seed", p + "do_sample"
    )


def _seed_params():
    return F.create_map(F.lit("seed"), F.col("event_id") + 1234)


@query(
    RUNS_SQL
    + """select task_name, model_name, count(*) as num_repetitions,
    arg_min(1234 + event_id, event_id) as seed, arg_min(source_filename, event_id) as first_file
from runs group by all"""
)
def first_run_params(spark, sf_dir):
    groups = G.group_rows(event_results(spark, sf_dir, gen_kwargs=_seed_params()))
    return groups.select(
        *G.GROUP,
        "num_repetitions",
        F.col("inference_parameters.seed").alias("seed"),
        F.substring_index("first_seen.path", "/", -1).alias("first_file"),
    )


@query("""with runs as (
    select t.task_name, 'm' || (user_id % 5) as model_name, t.task_ord,
           lpad(event_id::varchar, 19, '0') || '.json' as source_filename,
           case t.task_ord when 0 then value else value / 2 end as value, event_id
    from events, (values ('mrcr', 0), ('ifeval', 1)) t(task_name, task_ord))
select task_name, model_name, source_filename, task_ord, round(value, 6) as value,
    source_filename = min(source_filename) over (partition by task_name, model_name) as is_first
from runs""")
def run_list_ordered(spark, sf_dir):
    """Runs in order of (path, task_ord); two tasks per document, not in key order."""
    value = F.col("value")
    results = F.create_map(
        F.lit("mrcr"), F.create_map(F.lit("AUC"), value),
        F.lit("ifeval"), F.create_map(F.lit("inst_level_strict_acc,none"), value / 2),
    )
    content = synth.lm_eval_content(results, model=synth.event_model(F.col("user_id")))
    docs = synth.documents(work_table(spark, sf_dir, "events"), synth.file_path(F.col("event_id")), content)
    found = X.results(materialize(X.extract(docs), "outcomes"))
    runs, firsts = G.runs(found), G.first_run(found).select(*G.GROUP, "first_seen")
    return runs.join(firsts, G.same_group(runs, firsts)).select(
        runs["task_name"],
        runs["model_name"],
        "source_filename",
        "task_ord",
        F.round(F.map_values("metrics")[0]["value"], 6).alias("value"),
        (G.position() == F.col("first_seen")).alias("is_first"),
    )


@query(
    RUNS_SQL
    + """select task_name, 'e' || event_id as model_name, count(*) as n, round(avg(value), 6) as value_mean,
    coalesce(stddev_samp(value), 0.0) as value_std
from runs group by all"""
)
def singleton_std(spark, sf_dir):
    kind = F.col("event_type")
    results = F.create_map(synth.event_task(kind), F.create_map(synth.event_metric(kind), F.col("value")))
    model = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    docs = synth.documents(
        scored_events(spark, sf_dir),
        synth.file_path(F.col("event_id")),
        synth.lm_eval_content(results, model=model),
    )
    stats = G.group_stats(G.metrics_long(X.results(X.extract(docs))))
    return stats.select(*G.GROUP, "n", r6("value_mean"), "value_std")


@query(
    RUNS_SQL
    + """select 'total_results_parsed' as item, null::varchar as name, count(*) as n from runs
union all select 'total_files_parsed', null, count(*) from events
union all select distinct 'task', task_name, null::bigint from runs
union all select distinct 'model', model_name, null from runs"""
)
def report_metadata(spark, sf_dir):
    outcomes = materialize(X.extract(synth.event_documents(scored_events(spark, sf_dir))), "outcomes")
    totals = G.totals(outcomes).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("item"), F.lit(None).cast("string").alias("name"), F.col(c).alias("n"))
                    for c in ("total_results_parsed", "total_files_parsed")
                )
            )
        )
    )
    names = G.unique_names(X.results(outcomes))
    return totals.unionByName(names.select(F.col("kind").alias("item"), "name", F.lit(None).cast("bigint").alias("n")))


@query("""select code, count(*) as n from (
    select case when event_id % 11 <> 0 then null
        when (event_id // 11) % 4 = 0 then 'MALFORMED_JSON'
        when (event_id // 11) % 4 = 1 then 'UNKNOWN_FORMAT'
        when (event_id // 11) % 4 = 2 then 'BAD_RESULTS'
        when event_type <> 'error' then 'BAD_TIMESTAMP' end as code from events)
group by code""")
def reject_codes(spark, sf_dir):
    """Every 11th document is damaged in one of four ways; a bad date only counts beside a reported task."""
    docs = synth.event_documents(scored_events(spark, sf_dir), date=F.lit(1.7e9))
    number = F.substring_index("source_filename", ".", 1).cast("bigint")
    way = F.pmod(F.floor(number / 11), F.lit(4))
    content = F.col("content")
    damaged = (
        F.when(way == 0, F.concat(content, F.lit(" x")))
        .when(way == 1, F.replace(content, F.lit('"configs"'), F.lit('"conf"')))
        .when(way == 2, F.regexp_replace(content, r'"results":\{[^}]*\}\}', '"results":null'))
        .otherwise(F.regexp_replace(content, '"date":[0-9.E]+', '"date":"today"'))
    )
    broken = docs.withColumn("content", F.when(number % 11 == 0, damaged).otherwise(content))
    return X.extract(broken).groupBy("code").agg(F.count(F.lit(1)).alias("n"))


@query("""select 'flag_' || l_returnflag as task_name, metric, count(*) as n,
    round(avg(value), 4) as value_mean, count(case when metric = 'l_quantity' then 1 end) as n_stderr
from (unpivot (select l_returnflag, l_quantity, l_extendedprice, l_discount, l_tax from lineitem)
      on l_quantity, l_extendedprice, l_discount, l_tax into name metric value value)
group by all""")
def auto_metrics(spark, sf_dir):
    """No registry: every numeric key of every task is a metric, names and stderr keys are not."""
    numbers = (F.col(name).cast("double").alias(name) for name in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    members = F.struct(
        F.lit("l").alias("alias"),
        F.lit(7).alias("sample_len"),
        F.lit("12").alias("note"),
        F.lit(0.5).alias("l_quantity_stderr"),
        *numbers,
    )
    results = F.create_map(F.concat(F.lit("flag_"), F.col("l_returnflag")), members)
    path = F.concat(synth.file_path(F.col("l_orderkey")), F.lit("."), F.col("l_linenumber").cast("string"))
    docs = synth.documents(
        work_table(spark, sf_dir, "lineitem"), path, synth.lm_eval_content(results, model=F.lit("m"), keep_nulls=True)
    )
    found = X.results(X.extract(docs, registry={}, metrics="auto"))
    return G.group_stats(G.metrics_long(found)).select(
        "task_name", "metric", "n", F.round("value_mean", 4).alias("value_mean"), "n_stderr"
    )


@query("""select 'src_' || source as task_name, lang as model_name, count(*) as n,
    round(avg(n_chars), 6) as value_mean
from documents group by all""")
def custom_registry(spark, sf_dir):
    """A caller's registry, as a DataFrame, names one of the two metrics of every source."""
    documents = work_table(spark, sf_dir, "documents")
    registry = documents.select("source").distinct().select(
        F.concat(F.lit("src_"), F.col("source")).alias("task_name"),
        F.lit("chars").alias("metric_key"),
        F.lit(0).alias("ord"),
    )
    results = F.create_map(F.concat(F.lit("src_"), F.col("source")), F.create_map(F.lit("chars"), F.col("n_chars"), F.lit("id"), F.col("doc_id")))
    docs = synth.documents(
        documents, synth.file_path(F.col("doc_id")), synth.lighteval_content(results, model=F.col("lang"))
    )
    stats = G.group_stats(G.metrics_long(X.results(X.extract(docs, registry=registry))))
    return stats.select(*G.GROUP, "n", r6("value_mean"))


@query("""with lines as (
    select l_orderkey, l_linenumber, max(l_quantity) as q from lineitem group by all)
select 'q' || l_linenumber as metric, count(*) as n, round(avg(q), 6) as value_mean
from lines where l_linenumber % 2 = 1 group by l_linenumber""")
def large_registry(spark, sf_dir):
    """A registry with a row per order line of odd number, far too long for a literal; one document per order.

    Some documents have no path, some share one, and some have the key of the results twice, where the last counts.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("q"))
    lines = lines.withColumn("metric", F.concat(F.lit("q"), F.col("l_linenumber").cast("string")))
    task = F.concat(F.lit("order_"), F.col("l_orderkey").cast("string"))
    registry = lines.where("l_linenumber % 2 = 1").select(
        task.alias("task_name"), F.col("metric").alias("metric_key"), F.col("l_linenumber").alias("ord")
    )
    orders = lines.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("metric", "q"))).alias("members"))
    turn, path = F.col("l_orderkey") % 10, synth.file_path(F.col("l_orderkey"))
    path = F.when(turn == 1, F.lit("/runs/same.json")).when(turn != 0, path)
    content = synth.lm_eval_content(F.create_map(task, F.col("members")), model=F.lit("m"))
    before = F.concat(F.lit('{"results":{"'), task, F.lit('":{"q1":-1}},'))
    content = F.when(turn == 2, F.concat(before, F.substr(content, F.lit(2)))).otherwise(content)
    docs = synth.documents(orders, path, content)
    long = G.metrics_long(X.results(X.extract(docs, registry=registry)))
    return long.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 6).alias("value_mean"))


THIRD_FORMAT = Adapter(
    name="ledger",
    required=("run", "results"),
    header=("run",),
    started="when",
    duration="secs",
    model="who",
    params=("run", "sampling"),
    fields=(ParamField("temperature", "t"), ParamField("seed", "s")),
)


@query("""select 'ledger' as framework, 'ifeval' as task_name, c_mktsegment as model_name, count(*) as num_repetitions,
    round(avg(c_nationkey), 6) as duration_mean, arg_min(c_custkey, c_custkey) as seed
from customer group by c_mktsegment""")
def custom_adapter(spark, sf_dir):
    """A format the library does not know, described by one adapter."""
    run = F.struct(
        F.lit(1.7e9).alias("when"),
        F.col("c_nationkey").alias("secs"),
        F.col("c_mktsegment").alias("who"),
        F.struct(F.col("c_custkey").alias("s")).alias("sampling"),
    )
    results = F.create_map(F.lit("ifeval"), F.create_map(F.lit("inst_level_strict_acc,none"), F.col("c_acctbal")))
    docs = synth.documents(
        work_table(spark, sf_dir, "customer"),
        synth.file_path(F.col("c_custkey")),
        F.to_json(F.struct(run.alias("run"), results.alias("results"))),
    )
    found = X.results(X.extract(docs, adapters=(*DEFAULT_ADAPTERS, THIRD_FORMAT)))
    return G.group_rows(found).select(
        F.lit("ledger").alias("framework"),
        *G.GROUP,
        "num_repetitions",
        F.round("evaluation_duration_seconds.mean", 6).alias("duration_mean"),
        F.col("inference_parameters.seed").alias("seed"),
    )


@query(
    RUNS_SQL
    + """select task_name, model_name, count(*) as n, count(case when event_id % 7 = 0 then 1 end) as n_nan,
    round(avg(case when event_id % 7 <> 0 then value end), 6) as finite_mean
from runs group by all"""
)
def nonfinite_metrics(spark, sf_dir):
    """Bare NaN and Infinity tokens, beside a string that only looks like one."""
    docs = synth.event_documents(scored_events(spark, sf_dir))
    number = F.substring_index("source_filename", ".", 1).cast("bigint")
    bare = F.regexp_replace(
        F.regexp_replace("content", r"(\":)[0-9.Ee+-]+\}\}", "$1NaN}}"),
        r'"configs":\{\}',
        r'"configs":{"note":"a, NaN, b","limit":-Infinity}',
    )
    mixed = docs.withColumn("content", F.when(number % 7 == 0, bare).otherwise(F.col("content")))
    long = G.metrics_long(X.results(X.extract(mixed)))
    return long.groupBy(*G.GROUP).agg(
        F.count("value").alias("n"),
        F.count(F.when(F.isnan("value"), 1)).alias("n_nan"),
        F.round(F.avg(F.when(~F.isnan("value"), F.col("value"))), 6).alias("finite_mean"),
    )


@query(
    RUNS_SQL
    + """select task_name, model_name, metric, count(*) as num_repetitions, round(avg(value), 6) as value_mean,
    round(stddev_samp(value), 6) as value_std, round(avg(user_id), 6) as duration_mean
from runs group by all"""
)
def grouped_report_rows(spark, sf_dir):
    """The nested group rows, flattened for comparison."""
    found = event_results(spark, sf_dir, duration=F.col("user_id"))
    nested = materialize(G.grouped(materialize(found, "results")), "grouped")
    entry = F.explode(F.map_entries("aggregate_stats.metrics"))
    return nested.select("*", entry.alias("m")).select(
        *G.GROUP,
        F.col("m.key").alias("metric"),
        "num_repetitions",
        F.round("m.value.value.mean", 6).alias("value_mean"),
        F.round("m.value.value.std", 6).alias("value_std"),
        F.round("aggregate_stats.evaluation_duration_seconds.mean", 6).alias("duration_mean"),
    )


@query(
    RUNS_SQL
    + """, groups as (select task_name, model_name, count(*) as n from runs group by all)
select 0 as section, 0 as part, 1::bigint as n_lines, 0::bigint as n_commas
union all select 1, p.part, count(*), case p.part when 0 then count(*) - 1 else 0 end
    from groups, (values (0), (1), (2), (4)) p(part) group by p.part
union all select 1, 3, sum(n)::bigint, sum(n - 1)::bigint from groups
union all select 2, 0, 1, 0
union all select 3, 0, count(distinct task_name), count(distinct task_name) - 1 from groups
union all select 4, 0, 1, 0
union all select 5, 0, count(distinct model_name), count(distinct model_name) - 1 from groups
union all select 6, 0, 1, 0"""
)
def report_line_counts(spark, sf_dir):
    """Lines of the report by place, and how many of them start with a separating comma."""
    from datetime import datetime, timezone

    docs = synth.event_documents(scored_events(spark, sf_dir), date=synth.epoch(F.col("ts")))
    outcomes = materialize(X.extract(docs), "outcomes")
    lines = report_lines(outcomes, datetime(2024, 1, 1, tzinfo=timezone.utc))
    return lines.groupBy("section", "part").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count(F.when(F.col("text").startswith(","), 1)).alias("n_commas")
    )


PARAMS_TEXT = '{"do_sample":null,"temperature":null,"top_p":null,"top_k":null,"max_gen_toks":null,"seed":null}'


@query(
    RUNS_SQL
    + f""", scored as (select *, (1 + user_id % 5) / 8.0::double as v, (10 + user_id % 5)::double as d from runs),
groups as (
    select task_name, model_name, metric, v, d, count(*) as n, min(event_id) as first, min(min(event_id)) over () as very_first
    from scored group by all),
names as (
    select 'task' as kind, task_name as name from groups union select 'model', model_name from groups),
firsts as (select kind, min(name) as first from names group by kind)
select '{{"results":[' as text
union all select case when first <> very_first then ',' else '' end || '{{"task_name":"' || task_name || '","model_name":"' || model_name
    || '","inference_parameters":{PARAMS_TEXT},"num_repetitions":' || n
    || ',"aggregate_stats":{{"evaluation_duration_seconds":{{"mean":' || d || ',"std":0.0}},"metrics":{{' from groups
union all select '"' || metric || '":{{"value":{{"mean":' || v || ',"std":0.0}},"stderr":{{"mean":null,"std":null}}}}' from groups
union all select '}}}},"runs":[' from groups
union all select case when event_id <> first then ',' else '' end || '{{"source_filename":"' || source_filename
    || '","evaluation_datetime":null,"evaluation_datetime_iso":null,"evaluation_duration_seconds":' || s.d || ',"metrics":{{"' || s.metric
    || '":{{"value":' || s.v || ',"stderr":null}}}}}}' from scored s join groups using (task_name, model_name)
union all select ']}}' from groups
union all select '],"metadata":{{"parser_version":"1.0","parse_datetime":"2024-01-01T00:00:00+00:00","total_results_parsed":' || (select count(*) from runs)
    || ',"total_files_parsed":' || (select count(*) from events) || ',"unique_tasks":['
union all select case when name <> first then ',' else '' end || '"' || name || '"' from names join firsts using (kind)
union all select '],"unique_models":['
union all select ']}}}}'"""
)
def report_text(spark, sf_dir):
    """The report, written and read back, line by line. Scores and durations are alike within a group, so its spreads are 0."""
    from datetime import datetime, timezone

    model = F.pmod(F.col("user_id"), F.lit(5))
    events = work_table(spark, sf_dir, "events").withColumn("value", (model + 1) / F.lit(8.0))
    docs = synth.event_documents(events, duration=(model + 10).cast("double"))
    outcomes = materialize(X.extract(docs), "outcomes")
    folder = f"{shared_dir(spark)}/reports-{uuid.uuid4().hex}"
    return read_report(spark, write_report(outcomes, folder, layout="parts", now=datetime(2024, 1, 1, tzinfo=timezone.utc)))


LANG_TASK_SQL = """case lang when 'de' then 'gsm8k_platinum_cot_llama' when 'en' then 'mmlu_cot_llama'
        when 'es' then 'mmlu_pro_chat' when 'fr' then 'ifeval' end"""


def _language_scores(spark, sf_dir) -> DataFrame:
    """Mean quality per source and language as harness scores, one run per source."""
    lang = F.col("lang")
    task = (
        F.when(lang == "de", "gsm8k_platinum_cot_llama")
        .when(lang == "en", "mmlu_cot_llama")
        .when(lang == "es", "mmlu_pro_chat")
        .when(lang == "fr", "ifeval")
    )
    metric = (
        F.when(lang == "de", "exact_match,strict-match")
        .when(lang == "en", "exact_match,strict_match")
        .when(lang == "es", "exact_match,custom-extract")
        .when(lang == "fr", "inst_level_strict_acc,none")
    )
    from scoreloom.operators.scoring import mean_score

    joined = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    scores = mean_score(joined, F.col("quality"), ["source", "lang"], "score")
    return scores.select(
        F.concat(F.lit("results/"), F.col("source"), F.lit("_1_seed_1234.json")).alias("path"),
        F.col("source").alias("model_name"),
        F.lit(1.7e9).alias("started"),
        F.lit(12.5).alias("duration"),
        F.create_map(F.lit("temperature"), F.lit(0.6), F.lit("seed"), F.lit(1234.0)).alias("params"),
        task.alias("task_name"),
        metric.alias("metric"),
        F.col("score").alias("value"),
        F.col("score_stderr").alias("stderr"),
    )


ROUNDTRIP_SQL = f"""select source as model_name, {LANG_TASK_SQL} as task_name,
    round(avg(quality), 6) as value, round(stddev_samp(quality) / sqrt(count(*)), 6) as stderr
from documents join labels using (doc_id) group by all"""


@query(ROUNDTRIP_SQL)
def harness_roundtrip(spark, sf_dir):
    """Scores to documents and back to the same numbers."""
    docs = harness_documents(_language_scores(spark, sf_dir))
    docs = synth.documents(docs, F.col("path"), F.col("content"))
    long = G.metrics_long(X.results(X.extract(docs)))
    return long.select("model_name", "task_name", r6("value"), r6("stderr"))


@query(
    f"""select regexp_replace(source, '[^A-Za-z0-9]', '_', 'g') || '_1_seed_1234.json' as source_filename,
    task_name, value, stderr from (select *, model_name as source from ({ROUNDTRIP_SQL}))"""
)
def scan_files(spark, sf_dir):
    """Documents written as files, found again by the directory scan."""
    root = f"{shared_dir(spark)}/files-{uuid.uuid4().hex}"
    docs = harness_documents(_language_scores(spark, sf_dir))
    stem = F.regexp_replace(F.regexp_extract("path", "^results/(.*)_1_seed", 1), "[^A-Za-z0-9]", "_")
    write_documents(docs.withColumn("path", F.concat(F.lit("results/"), stem, F.lit("_1_seed_1234.json"))), root)
    long = G.metrics_long(X.results(X.extract(scan_documents(spark, [root]))))
    return long.select(
        F.substring_index("path", "/", -1).alias("source_filename"), "task_name", r6("value"), r6("stderr")
    )


@query(
    RUNS_SQL
    + """select task_name, model_name, count(*) as n, round(avg(value), 6) as value_mean, round(stddev_samp(value), 6) as value_std,
    count(*) as num_repetitions, round(avg(user_id), 6) as duration_mean, min(source_filename) as first_file
from runs group by all"""
)
def incremental_ingest(spark, sf_dir):
    """A stream of documents in three batches; the statistics come from the sums that each batch left."""
    events = scored_events(spark, sf_dir)
    work = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    batches = 3
    files = max(1, spark.sparkContext.defaultParallelism // 2)
    events.repartition(batches * files).write.parquet(f"{work}/events")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{work}/events")
    docs = synth.event_documents(stream, duration=F.col("user_id"))
    ingest(docs, f"{work}/table", f"{work}/state", statistics=f"{work}/statistics").awaitTermination()
    found = stored_statistics(spark, f"{work}/statistics")
    stats, groups = found.stats, found.groups
    joined = stats.join(groups, G.same_group(stats, groups)).drop(*(groups[name] for name in G.GROUP))
    return joined.select(
        *G.GROUP,
        "n",
        r6("value_mean"),
        r6("value_std"),
        "num_repetitions",
        F.round("evaluation_duration_seconds.mean", 6).alias("duration_mean"),
        F.substring_index("first_seen.path", "/", -1).alias("first_file"),
    )


@query("""select event_type as task_name, 3 * count(*) as n, sum(event_id % 1000)::double / (3 * count(*)) as value_mean, 0.1::double as stderr_mean,
    0.0::double as stderr_std
from events group by event_type""")
def exact_means(spark, sf_dir):
    """Small values among large ones that cancel, and copies of 0.1; the means are compared bit for bit."""
    big = F.col("event_id") * F.lit(2.0**70) + F.lit(2.0**90)
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("task_name"),
        F.lit("m").alias("model_name"),
        F.lit("x").alias("metric"),
        F.explode(F.array(big, (F.col("event_id") % 1000).cast("double"), -big)).alias("value"),
        F.lit(0.1).alias("stderr"),
    )
    return G.group_stats(rows).select("task_name", "n", "value_mean", "stderr_mean", "stderr_std")
