"""Queries over the run matrix and over comparisons of models."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.functions import scalars as S
from scoreloom.operators import compare, runplan
from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G
from scoreloom.plans import synth
from scoreloom.plans.catalog import query, table
from scoreloom.plans.parsing import RUNS_SQL, event_results, r6, scored_events


def _part_configs(spark, sf_dir):
    """Every part is a configuration."""
    key = F.col("p_partkey")
    second = F.pmod(key, F.lit(2)) == 1
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("suite"),
        F.concat(F.lit("part_"), key.cast("string")).alias("task_label"),
        F.when(second, "lighteval").otherwise("lm_eval").alias("harness"),
        F.col("p_brand").alias("model_name"),
        (F.pmod(key, F.lit(5)) + 1).cast("int").alias("reps"),
        (F.col("p_size") * 128).alias("max_gen_toks"),
        F.when(F.pmod(key, F.lit(4)) == 0, F.col("p_size") * 64).alias("think_budget"),
    )


@query("""with runs as (
    select p_brand as suite, 'part_' || p_partkey as task_label, i.rep::int as rep, (1233 + i.rep)::int as seed, p_brand,
        p_partkey % 2 = 1 as second, p_size * 128 as gen,
        case when p_partkey % 4 = 0 then p_size * 64 end as think
    from part, unnest(range(1, p_partkey % 5 + 2)) i(rep))
select suite, task_label, rep, seed,
    'results/' || task_label || '_' || rep || '_seed_' || seed || case when second then '' else '.json' end as output_path,
    case when second then 'model_name=' || p_brand || ',timeout=3600,concurrent_requests=8,generation_parameters={temperature:0.6,max_new_tokens:'
            || gen || ',top_p:0.9,seed:' || seed || ',top_k:50}'
        else 'do_sample=True,temperature=0.6,top_p=0.9,top_k=50,max_gen_toks=' || gen
            || coalesce(',thinking_token_budget=' || think, '') || ',seed=' || seed end as parameters,
    task_label as read_label, rep as read_rep, seed as read_seed
from runs""")
def run_plan(spark, sf_dir):
    """Repetitions, seeds, output paths and parameter strings; the path is read back too."""
    runs = runplan.generation_params(runplan.expand_runs(_part_configs(spark, sf_dir)))
    back = runplan.read_output_path(F.col("output_path"))
    return runs.select(
        "suite", "task_label", "rep", "seed", "output_path", "parameters",
        back["task_label"].alias("read_label"), back["rep"].alias("read_rep"), back["seed"].alias("read_seed"),
    )


@query("""select 'part_' || p_partkey as task_label,
    case when p_partkey % 2 = 0 then 'model=' || p_brand || ',max_length=' || p_size * 256
        || ',num_concurrent=128,max_retries=3,tokenized_requests=False,tokenizer_backend=None,timeout=1200'
        || case when p_partkey % 4 = 0 then ',enable_thinking=True,think_end_token=</think>' else '' end end as model_args,
    'tag' || p_size || case when p_partkey % 2 = 1 then '@k=1@n=1|0' else '' end as task_spec
from part""")
def harness_calls(spark, sf_dir):
    """What each harness is told about model, requests and task."""
    runs = _part_configs(spark, sf_dir).select(
        "*", (F.col("max_gen_toks") * 2).alias("max_length"),
        F.concat(F.lit("tag"), (F.col("max_gen_toks") / 128).cast("int").cast("string")).alias("task_tag"),
    )
    return runplan.task_spec(runplan.model_args(runs)).select("task_label", "model_args", "task_spec")


@query("""select event_id, user_id as seed, event_type as kind, round(value, 6) as temperature,
    'x=' || event_id as tail, event_id as nested_seed, 'a' || user_id as nested_name
from events""")
def params_roundtrip(spark, sf_dir):
    """Columns to a packed string and back, with a braced list inside."""
    text = lambda c: c.cast("string")
    outer = F.create_map(
        F.lit("seed"), text(F.col("user_id")),
        F.lit("kind"), F.col("event_type"),
        F.lit("unset"), F.lit(None).cast("string"),
        F.lit("temperature"), text(F.col("value")),
        F.lit("tail"), F.concat(F.lit("x="), text(F.col("event_id"))),
    )
    inner = F.create_map(
        F.lit("seed"), text(F.col("event_id")), F.lit("name"), F.concat(F.lit("a"), text(F.col("user_id")))
    )
    packed = table(spark, sf_dir, "events").select(
        "event_id", S.render_nested_params(outer, "generation_parameters", inner).alias("s")
    )
    flat, nested = S.parse_params(F.col("s")), S.parse_nested_params(F.col("s"), "generation_parameters")
    return packed.select(
        "event_id",
        flat["seed"].cast("bigint").alias("seed"),
        flat["kind"].alias("kind"),
        F.round(flat["temperature"].cast("double"), 6).alias("temperature"),
        flat["tail"].alias("tail"),
        nested["seed"].cast("bigint").alias("nested_seed"),
        nested["name"].alias("nested_name"),
    )


@query(
    RUNS_SQL
    + """, stats as (select task_name, model_name, avg(value) as value_mean from runs group by all),
members as (select * from (values ('reasoning', 'gsm8k_platinum_cot_llama'), ('reasoning', 'mmlu_pro_chat'),
    ('reasoning', 'ifeval'), ('instruction', 'gsm8k_platinum_cot_llama'), ('instruction', 'mmlu_cot_llama'),
    ('instruction', 'mmlu_pro_chat'), ('instruction', 'ifeval')) t(suite, task_name))
select suite, model_name, count(*) as n_tasks, round(avg(value_mean), 6) as suite_mean
from stats join members using (task_name) group by all"""
)
def suite_rollup(spark, sf_dir):
    """Observed scores rolled up to the suites of the run matrix."""
    stats = G.group_stats(G.metrics_long(event_results(spark, sf_dir)))
    rolled = runplan.suite_rollup(stats, runplan.run_configs(spark))
    return rolled.select("suite", "model_name", "n_tasks", r6("suite_mean"))


def _config_rows() -> str:
    """The configurations as rows of SQL: suite, script, label, task, harness, model, reps, length of an answer."""
    rows = [(c[0], c[2], c[3], c[5], c[6], c[8], c[10], c[12]) for c in runplan.RUN_CONFIGS]
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


@query(
    RUNS_SQL
    + f""", configs(suite, script, label, task_name, harness, model, reps, gen) as (values {_config_rows()}),
planned as (
    select *, 'results/' || label || '_' || rep || '_seed_' || (1233 + rep) || case when harness = 'lm_eval' then '.json' else '' end as output_path
    from configs, unnest(range(1, 9)) r(rep) where rep <= reps),
observed as (select task_name, event_id % 9 as rep, count(*) as n, min(value) as least from runs group by all)
select suite, script, harness, model as model_name, rep::int as rep, (1233 + rep)::int as seed, output_path, gen as max_gen_toks,
    coalesce(n, 0) as n_results, round(least, 6) as least
from planned left join observed using (task_name, rep)"""
)
def run_matrix(spark, sf_dir):
    """The 44 runs of the 13 configurations, each with the results that were found for its task and repetition."""
    rep = F.pmod(F.substring_index("source_filename", ".", 1).cast("bigint"), F.lit(9)).cast("int")
    long = event_results(spark, sf_dir).select("task_name", rep.alias("rep"), F.explode(F.map_values("metrics")).alias("m"))
    observed = long.groupBy("task_name", "rep").agg(F.count(F.lit(1)).alias("n_results"), F.min("m.value").alias("least"))
    runs = runplan.expand_runs(runplan.run_configs(spark)).join(observed, ["task_name", "rep"], "left")
    return runs.select(
        "suite", "script", "harness", "model_name", "rep", "seed", "output_path", F.col("max_gen_toks").cast("int").alias("max_gen_toks"),
        F.coalesce("n_results", F.lit(0).cast("bigint")).alias("n_results"), r6("least"),
    )


def _planned_and_observed(spark, sf_dir):
    """Even events plan two runs of their (type, user), odd events are runs that happened."""
    events = table(spark, sf_dir, "events")
    even = F.pmod(F.col("event_id"), F.lit(2)) == 0
    keys = ["event_type", "user_id", "rep"]
    planned = events.where(even).withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(2)))).select(*keys)
    observed = events.where(~even).withColumn("rep", (F.pmod(F.col("event_id"), F.lit(3)) + 1).cast("int")).select(*keys)
    return planned, observed, keys


GAPS_SQL = """with planned as (select distinct event_type, user_id, r.rep::int as rep
    from events, (values (1), (2)) r(rep) where event_id % 2 = 0),
observed as (select distinct event_type, user_id, (event_id % 3 + 1)::int as rep from events where event_id % 2 = 1)
"""


@query(
    GAPS_SQL
    + """select *, 'missing' as gap from (select * from planned except select * from observed)
union all select *, 'unplanned' from (select * from observed except select * from planned)"""
)
def run_gaps(spark, sf_dir):
    return runplan.run_gaps(*_planned_and_observed(spark, sf_dir))


@query(
    GAPS_SQL
    + """select event_type, count(p.rep) as planned, count(case when p.rep = o.rep then 1 end) as done,
    count(case when o.rep is null then 1 end) as missing, count(case when p.rep is null then 1 end) as unplanned
from planned p full join observed o using (event_type, user_id, rep) group by event_type"""
)
def run_completeness(spark, sf_dir):
    return runplan.completeness(*_planned_and_observed(spark, sf_dir), by=["event_type"])


def _scored(spark, sf_dir):
    """Group statistics of documents that carry a standard error."""
    kind, value = F.col("event_type"), F.col("value")
    metric = synth.event_metric(kind)
    members = F.create_map(metric, value, F.regexp_replace(metric, ",", "_stderr,"), value / 10)
    content = synth.lm_eval_content(
        F.create_map(synth.event_task(kind), members), model=synth.event_model(F.col("user_id"))
    )
    docs = synth.documents(scored_events(spark, sf_dir), synth.file_path(F.col("event_id")), content)
    return G.group_stats(G.metrics_long(X.results(X.extract(docs))))


@query(
    RUNS_SQL
    + """, stats as (select task_name, model_name, metric, avg(value) as v, avg(value / 10) as e from runs group by all)
select s.task_name, s.model_name, s.metric, round(s.v, 6) as value_mean, round(b.v, 6) as baseline_mean,
    round(s.v - b.v, 6) as delta, round(100 * s.v / b.v, 6) as recovery_pct,
    round((s.v - b.v) / sqrt(s.e * s.e + b.e * b.e), 6) as z_score
from stats s join stats b on s.task_name = b.task_name and s.metric = b.metric and b.model_name = 'm0'"""
)
def model_comparison(spark, sf_dir):
    compared = compare.compare_models(_scored(spark, sf_dir), "m0")
    return compared.select(
        "task_name", "model_name", "metric", r6("value_mean"), r6("baseline_mean"),
        r6("delta"), r6("recovery_pct"), r6("z_score"),
    )


@query(
    RUNS_SQL
    + """select task_name, metric, round(avg(value) filter (model_name = 'm0'), 6) as m0,
    round(avg(value) filter (model_name = 'm1'), 6) as m1, round(avg(value) filter (model_name = 'm2'), 6) as m2,
    round(avg(value) filter (model_name = 'm3'), 6) as m3, round(avg(value) filter (model_name = 'm4'), 6) as m4
from runs group by all"""
)
def model_wide(spark, sf_dir):
    table_ = compare.wide(_scored(spark, sf_dir), [f"m{i}" for i in range(5)])
    return table_.select("task_name", "metric", *(r6(f"m{i}") for i in range(5)))
