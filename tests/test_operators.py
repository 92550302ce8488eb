"""Prompts, generation, scores, run plan and comparison against plain Python."""

import hashlib
import math
import statistics
from itertools import combinations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scoreloom.functions import scalars as S
from scoreloom.functions import stats
from scoreloom.operators import compare, prompts, runplan, scoring
from scoreloom.operators.generate import generate


def md5(key, seed):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


def test_numbers_by_hash_are_the_hash_order(spark):
    pool = spark.range(500).withColumn("g", F.col("id") % 2)
    rows = prompts.number_by_hash(pool, "id", 7, ["g"]).collect()
    for g in (0, 1):
        mine = [r for r in rows if r.g == g]
        order = sorted((r.id for r in mine), key=lambda i: md5(i, 7))
        assert {r.id: r.ordinal for r in mine} == {i: n for n, i in enumerate(order)}
        assert {r.pool_size for r in mine} == {250}


@pytest.mark.parametrize(("size", "shots"), [(30, 5), (5, 5), (3, 5), (1, 2)])
def test_exemplars_against_brute_force(spark, size, shots):
    items = spark.range(size + 4).withColumnRenamed("id", "item")
    pool = spark.range(size).withColumnRenamed("id", "ex").withColumn("text", F.col("ex").cast("string"))
    chosen = prompts.choose_exemplars(items, pool, item_id="item", pool_id="ex", shots=shots, seed=11)
    got = {}
    for r in sorted(chosen.collect(), key=lambda r: (r.for_item, r["rank"])):
        got.setdefault(r.for_item, []).append(r.ex)
    ring = sorted(range(size), key=lambda i: md5(i, 11))
    for item in range(size + 4):
        start = int(md5(item, 12)[:13], 16) % size
        walk = [ring[(start + k) % size] for k in range(min(shots + 1, size))]
        assert got.get(item, []) == [e for e in walk if e != item][:shots]


def test_exemplars_do_not_depend_on_partitioning(spark):
    items, pool = spark.range(50).withColumnRenamed("id", "item"), spark.range(40).withColumnRenamed("id", "ex")
    run = lambda n: sorted(
        map(tuple, prompts.choose_exemplars(items.repartition(n), pool.repartition(n), item_id="item", pool_id="ex", shots=3, seed=1).collect())
    )
    assert run(1) == run(9)


def test_messages_and_rendering(spark):
    items = spark.createDataFrame([(1, "q1", "a1"), (2, "q2", "a2")], "id long, q string, a string")
    chosen = prompts.choose_exemplars(
        items, items.withColumnRenamed("id", "ex"), item_id="id", pool_id="ex", shots=1, seed=3
    )
    messages = prompts.fewshot_messages(items, chosen, item_id="id", question="q", answer="a", system="s")
    style = prompts.ChatStyle(before="<{role}>", after="\n", answer="<assistant>")
    rows = {r.id: r.p for r in messages.select("id", prompts.render_chat(F.col("messages"), style).alias("p")).collect()}
    assert rows[1] == "<system>s\n<user>q2\n<assistant>a2\n<user>q1\n<assistant>"
    assert rows[2] == "<system>s\n<user>q1\n<assistant>a1\n<user>q2\n<assistant>"


def test_zero_shots(spark):
    items = spark.createDataFrame([(1, "q1", "a1")], "id long, q string, a string")
    chosen = prompts.choose_exemplars(items, items.withColumnRenamed("id", "ex"), item_id="id", pool_id="ex", shots=0, seed=3)
    row = prompts.fewshot_messages(items, chosen, item_id="id", question="q", answer="a").first()
    assert [(m.role, m.content) for m in row.messages] == [("user", "q1")]


def test_seeded_limit(spark):
    df = spark.range(1000)
    top = [r.id for r in prompts.seeded_limit(df, "id", 5, 10).collect()]
    assert top == sorted(range(1000), key=lambda i: md5(i, 5))[:10]
    many = prompts.seeded_limit(spark.range(30_000), "id", 5, 12_000)
    assert {r.id for r in many.collect()} == set(sorted(range(30_000), key=lambda i: md5(i, 5))[:12_000])
    share = prompts.seeded_limit(df, "id", 5, 0.25).count()
    assert share == sum(int(md5(i, 5)[:13], 16) < 0.25 * 16**13 for i in range(1000))


def test_context_budget(spark):
    df = spark.createDataFrame([(10,), (11,), (0,)], "n int")
    got = [r.decision for r in prompts.context_budget(df, length="n", max_length=15, max_gen_toks=5).collect()]
    assert got == ["keep", "truncate", "keep"]
    assert prompts.context_budget(df, length="n", max_length=5, max_gen_toks=5).first().decision == "drop"


def test_generation_retries_and_keeps_errors(spark):
    def flaky():
        seen = {}

        def answer(text):
            seen[text] = seen.get(text, 0) + 1
            if text == "never" or (text == "third" and seen[text] < 3):
                raise RuntimeError(f"no {text}")
            return text.upper()

        return answer

    df = spark.createDataFrame([(1, "fine"), (2, "third"), (3, "never")], "id int, p string")
    rows = {r.id: r for r in generate(df, flaky(), key="id", prompt="p", tasks=2, threads=2, retries=3).collect()}
    assert (rows[1].output, rows[1].error, rows[1].attempts) == ("FINE", None, 1)
    assert (rows[2].output, rows[2].error, rows[2].attempts) == ("THIRD", None, 3)
    assert (rows[3].output, rows[3].error, rows[3].attempts) == (None, "RuntimeError: no never", 4)


def value_of(spark, column, **literals):
    df = spark.range(1)
    for name, value in literals.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(column.alias("v")).first().v


def test_reasoning_spans(spark):
    strip = lambda t: value_of(spark, scoring.strip_reasoning(F.col("t")), t=t)
    assert strip("a<think>x\ny</think>b<think></think>c") == "abc"
    assert strip("<think>open") == "<think>open"
    after = lambda t: value_of(spark, scoring.after_reasoning(F.col("t")), t=t)
    assert after("x</think>y</think> z") == " z"
    assert after("plain") == "plain"


def test_answers(spark):
    get = lambda t, **o: value_of(spark, scoring.extract_answer(F.col("t"), r"answer is (\w*)", **o), t=t)
    assert get("answer is A, answer is B") == "A"
    assert get("answer is A, answer is B", last=True) == "B"
    assert get("nothing") == get("nothing", last=True) == "[invalid]"
    assert get("answer is ") == ""
    norm = value_of(spark, scoring.normalise(F.col("t"), punctuation=True), t="  A,  b.\n")
    assert norm == "a b"


def test_instruction_checks(spark):
    cases = [
        (scoring.words_at_least(F.lit("a b  c"), 3), True),
        (scoring.words_at_most(F.lit("a b c"), 2), False),
        (scoring.keyword_at_least(F.lit("Foo bar foo"), "foo", 2), True),
        (scoring.forbidden_word(F.lit("food"), "foo"), True),
        (scoring.all_lower(F.lit("abc")), True),
        (scoring.all_upper(F.lit("aBC")), False),
        (scoring.no_comma(F.lit("a,b")), False),
        (scoring.bullets_exactly(F.lit("* a\n- b\ntext\n *c"), 2), True),
        (scoring.is_json(F.lit('```json\n{"a": 1}\n```')), True),
        (scoring.is_json(F.lit("{a}")), False),
    ]
    row = spark.range(1).select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(cases))).first()
    assert list(row) == [expected for _, expected in cases]


def test_instruction_accuracy_counts_instructions_and_prompts(spark):
    df = spark.createDataFrame([(True, True), (False, None), (None, None)], "a boolean, b boolean")
    row = scoring.instruction_accuracy(df, {"a": F.col("a"), "b": F.col("b")}, []).first()
    assert (row.n_instructions, row.n_prompts) == (3, 2)
    assert row.inst_level_strict_acc == pytest.approx(2 / 3)
    assert row.prompt_level_strict_acc == 0.5


def test_pass_at_k_against_enumeration(spark):
    cases = [(n, c, k) for n in range(1, 8) for c in range(n + 1) for k in range(1, 8)]
    for k in range(1, 8):
        rows = spark.createDataFrame([c[:2] for c in cases if c[2] == k], "n long, c long")
        for r in rows.select("n", "c", stats.pass_at_k(F.col("n"), F.col("c"), k).alias("p")).collect():
            if k <= r.n:
                draws = list(combinations(range(r.n), k))
                expected = sum(any(i < r.c for i in d) for d in draws) / len(draws)
            else:
                expected = 1.0 if r.c else 0.0
            assert r.p == pytest.approx(expected), (r.n, r.c, k)


def test_pass_at_k_of_a_huge_group(spark):
    row = spark.range(1).select(stats.pass_at_k(F.lit(10**12), F.lit(5 * 10**11), 2).alias("p")).first()
    assert row.p == pytest.approx(0.75)


def test_code_verdicts(spark):
    rows = [("p", 1, True), ("p", 1, True), ("p", 2, True), ("p", 2, False), ("p", 3, None)]
    df = spark.createDataFrame(rows, "problem string, sample int, ok boolean")
    row = scoring.code_pass_at_k(df, ["problem"], "sample", F.col("ok"), [1, 2]).first()
    assert (row.n, row.c, row.pass_at_1, row.pass_at_2) == (3, 1, pytest.approx(1 / 3), pytest.approx(2 / 3))


def test_length_buckets_and_area(spark):
    df = spark.createDataFrame([(1024, 1.0), (1025, 0.0), (2048, 1.0), (4096, 0.0), (4097, 9.0), (0, 9.0)], "n int, s double")
    buckets = scoring.bucket_scores(df, "n", "s", [0, 1024, 2048, 4096])
    got = {r.upper: (r.metric, r.n, r.score) for r in buckets.collect()}
    assert got == {
        1024: ("score_gt_0_le_1k", 1, 1.0),
        2048: ("score_gt_1k_le_2k", 2, 0.5),
        4096: ("score_gt_2k_le_4k", 1, 0.0),
        None: ("score_gt_4k", 1, 9.0),
        0: ("score_le_0", 1, 9.0),
    }
    # the open bucket stands at 8192, one doubling on; the one below has no place
    assert scoring.length_auc(buckets).first().length_auc == pytest.approx((0.75 + 0.25 + 4.5) / 3)


def test_json_check_takes_one_value_and_nothing_else(spark):
    texts = {'{"a":1}': True, '{"a":1} trailing': False, '{"a":1}{"b":2}': False, "```json\n[1]\n```": True, "": False, "[1": False}
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.ok for r in df.select("t", scoring.is_json(F.col("t")).alias("ok")).collect()} == texts


def test_exemplars_of_a_null_group(spark):
    pool = spark.createDataFrame([(i, None if i % 2 else "x", f"t{i}") for i in range(100, 120)], "id long, g string, t string")
    items = spark.createDataFrame([(1, None), (2, "x"), (3, "none")], "item long, g string")
    rows = prompts.choose_exemplars(items, pool, item_id="item", pool_id="id", shots=3, seed=5, by=["g"]).collect()
    assert sorted((r.for_item, r.id % 2) for r in rows) == [(1, 1)] * 3 + [(2, 0)] * 3


def test_sampling_a_number_of_rows_at_any_size(spark):
    df = spark.range(30_000)
    want = [r.id for r in df.orderBy(prompts.seeded_hash(F.col("id"), 3), "id").limit(12_000).collect()]
    for n in (5, 12_000):
        assert {r.id for r in prompts.seeded_limit(df, "id", 3, n).collect()} == set(want[:n])


def test_last_of_repeated_parameters_counts(spark):
    from scoreloom.functions.scalars import parse_params

    row = spark.range(1).select(parse_params(F.lit("a=1,b=x=y,a=2")).alias("m")).first()
    assert row.m == {"a": "2", "b": "x=y"}


def test_generation_leaves_other_columns_alone(spark):
    from scoreloom.operators.generate import generate

    def slow(text):
        import time

        time.sleep(3 if text == "slow" else 0)
        return text.upper()

    df = spark.createDataFrame([(9007199254740993, "a"), (None, "slow")], "big long, t string").coalesce(1)
    rows = {r.t: r for r in generate(df, slow, key="t", prompt="t", retries=0, timeout=1.0).collect()}
    assert (rows["a"].big, rows["a"].output) == (9007199254740993, "A")
    assert rows["slow"].error.startswith("RequestTimeout") and rows["slow"].output is None


def test_comparison_needs_no_second_pass(spark):
    from scoreloom.operators.compare import compare_models

    rows = [("t", "m0", "k", 0.5, 0.1), ("t", "m1", "k", 1.0, None), ("u", "m1", "k", 1.0, 0.1)]
    stats = spark.createDataFrame(rows, "task_name string, model_name string, metric string, value_mean double, stderr_mean double")
    got = {(r.task_name, r.model_name): (r.baseline_mean, r.delta, r.z_score) for r in compare_models(stats, "m0").collect()}
    assert got == {("t", "m0"): (0.5, 0.0, 0.0), ("t", "m1"): (0.5, 0.5, None), ("u", "m1"): (None, None, None)}


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=30))
def test_mean_and_spread(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    row = df.agg(stats.mean("x").alias("m"), stats.spread("x").alias("s"), stats.standard_error("x").alias("e")).first()
    known = [v for v in values if v is not None]
    if not known:
        assert (row.m, row.s) == (None, None)
        return
    assert row.m == pytest.approx(statistics.fmean(known), abs=1e-6)
    spread = statistics.stdev(known) if len(known) > 1 else 0.0
    assert row.s == pytest.approx(spread, abs=1e-6)
    assert row.e is None if len(known) < 2 else row.e == pytest.approx(spread / math.sqrt(len(known)), abs=1e-6)


def test_default_plan(spark):
    runs = runplan.generation_params(runplan.expand_runs(runplan.run_configs(spark))).collect()
    assert len(runs) == 44
    by_path = {(r.suite, r.output_path): r for r in runs}
    row = by_path["reasoning", "results/ifeval_2_seed_1235.json"]
    assert row.parameters == (
        "do_sample=True,temperature=0.6,top_p=0.9,top_k=50,max_gen_toks=2560,thinking_token_budget=1280,seed=1235"
    )
    row = by_path["reasoning", "results/aime_25_8_seed_1241"]
    assert row.parameters == (
        "model_name=Qwen/Qwen3-8B,timeout=3600,concurrent_requests=8,generation_parameters="
        "{temperature:0.6,max_new_tokens:32768,top_p:0.9,seed:1241,top_k:50}"
    )
    assert by_path["instruction", "results/ifeval_1_seed_1234.json"].parameters.endswith("max_gen_toks=1280,seed=1234")


def test_paths_are_read_back(spark):
    read = lambda p: value_of(spark, runplan.read_output_path(F.col("p")), p=p)
    assert tuple(read("results/aime_25_8_seed_1241/sub/results_x.json")) == ("aime_25", 8, 1241)
    assert tuple(read("/x/results/ifeval_1_seed_1234.json")) == ("ifeval", 1, 1234)
    assert read("/x/other.json") is None


def test_parameter_strings(spark):
    text = "model=m,think_end_token=</a=b>,generation_parameters={temperature:0.6,seed:7},last=1"
    parsed = value_of(spark, S.parse_params(F.col("t")), t=text)
    assert parsed == {"model": "m", "think_end_token": "</a=b>", "last": "1"}
    nested = value_of(spark, S.parse_nested_params(F.col("t"), "generation_parameters"), t=text)
    assert nested == {"temperature": "0.6", "seed": "7"}
    assert value_of(spark, S.parse_nested_params(F.col("t"), "absent"), t=text) == {}
    assert value_of(spark, S.parse_params(F.col("t")), t="") == {}


def test_comparison(spark):
    rows = [("t", "base", "x", 0.5, 0.03), ("t", "new", "x", 0.6, 0.04), ("t", "zero", "y", 0.1, None), ("t", "base", "y", 0.0, 0.1)]
    df = spark.createDataFrame(rows, "task_name string, model_name string, metric string, value_mean double, stderr_mean double")
    got = {(r.model_name, r.metric): r for r in compare.compare_models(df, "base").collect()}
    row = got["new", "x"]
    assert (row.delta, row.recovery_pct, row.z_score) == (pytest.approx(0.1), pytest.approx(120), pytest.approx(2.0))
    assert (got["zero", "y"].recovery_pct, got["zero", "y"].z_score) == (None, None)
    assert got["base", "x"].delta == 0


def test_registry_forms(spark):
    from scoreloom.operators import registry

    frame = registry.registry_frame(spark)
    assert frame.count() == 10
    assert registry.as_mapping(frame) == registry.DEFAULT_REGISTRY
    assert registry.as_mapping({f"t{i}": ("a",) for i in range(registry.LITERAL_ENTRIES + 1)}) is None
    assert registry.as_mapping(frame)["mrcr"] == ("score_gt_16k_le_32k", "AUC")
    metrics = spark.createDataFrame([("mrcr", "AUC", 1.0), ("mrcr", "x", 2.0)], "task_name string, metric string, value double")
    assert registry.keep_registered(metrics, frame).collect()[0].metric == "AUC"


def test_registry_frame_is_made_once(spark):
    from scoreloom.operators import registry
    from scoreloom.operators.extract import extract

    made = spark.sparkContext.accumulator(0)

    def entry(i):
        made.add(1)
        return f"q{i % 3}"

    entries = registry.LITERAL_ENTRIES + 500
    frame = spark.range(entries).select(
        F.format_string("t%d", "id").alias("task_name"), F.udf(entry, "string")("id").alias("metric_key"), F.lit(0).alias("ord")
    )
    results = ['{"t0":{"q0":1}}', '{"t1":{"q1":2},"t2":{"q2":3}}', '{"t3":{"x":4}}', "{}", '{"none":{"q0":5}}', '{"t1":{"q1":2},"t2":{"q2":3}}']
    contents = [(f"/r/{i % 5}.json", f"{i % 5}.json", f'{{"results":{r},"configs":{{}},"config":{{}},"model_name":"m"}}') for i, r in enumerate(results)]
    contents += [(None, None, contents[0][2])] * 2
    docs = spark.createDataFrame([*contents, contents[1]], "path string, source_filename string, content string")
    rows = extract(docs, registry=frame).collect()
    got = sorted((str(r.path), r.code, [(t.task_name, [(m.metric, m.value) for m in t.metrics]) for t in r.rows]) for r in rows)
    one, two = [("t0", [("q0", 1.0)])], [("t1", [("q1", 2.0)]), ("t2", [("q2", 3.0)])]
    want = [("/r/0.json", None, one), ("/r/0.json", None, two), ("/r/1.json", None, two), ("/r/1.json", None, two)]
    want += [("/r/2.json", None, [("t3", [])]), ("/r/3.json", None, []), ("/r/4.json", None, []), ("None", None, one), ("None", None, one)]
    assert got == want
    assert made.value == entries
