"""Work that may run twice: details of a run, answers of a generator."""

import os

import pytest
from pyspark.sql import functions as F

from scoreloom.operators.generate import generate_with_ledger, ledger_of
from scoreloom.sources.harness import write_details


def test_a_run_written_twice_is_there_once(spark, tmp_path):
    target = str(tmp_path / "details")
    samples = spark.range(300).selectExpr("id", "'a|0' task_name", "'x/y' model_name", "cast(id % 3 as int) rep")
    write_details(samples, target, max_rows_per_file=40)
    write_details(samples, target)
    write_details(samples.where("rep = 1").withColumn("id", F.col("id") + 1000), target)
    back = {r.id for r in spark.read.parquet(target).collect()}
    assert back == {i + 1000 * (i % 3 == 1) for i in range(300)}
    assert spark.read.parquet(target).count() == 300


def test_a_job_that_dies_leaves_the_table_as_it_was(spark, tmp_path):
    target = str(tmp_path / "details")
    samples = spark.range(100).selectExpr("id", "'t' task_name", "'m' model_name", "cast(id % 2 as int) rep")
    write_details(samples, target)
    dying = samples.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id") + 500).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_details(dying, target)
    assert {r.id for r in spark.read.parquet(target).collect()} == set(range(100))


PROMPTS = [(f"k{i}", f"text {i}", i) for i in range(50)] + [("k1", "text 1", 99), ("k2", "a", 100), (None, "no key", 101), ("k50", None, 102)]


def prompts(spark):
    return spark.createDataFrame(PROMPTS, "id string, prompt string, output_of int")


def counting(folder, fails=lambda text: False):
    """A function that leaves a mark for every call that it answers."""

    def fn(text):
        if fails(text):
            raise ValueError("not now")
        with open(os.path.join(folder, "calls"), "a") as file:
            file.write(f"{text}\n")
        return f"<{text}>"

    return fn


def calls(folder):
    path = os.path.join(folder, "calls")
    return sorted(open(path).read().splitlines()) if os.path.exists(path) else []


def test_each_key_is_answered_by_one_call(spark, tmp_path):
    ledger, folder = str(tmp_path / "ledger"), str(tmp_path)
    options = {"key": "id", "prompt": "prompt", "tasks": 3, "threads": 2, "retries": 1, "batch": 4}
    first = generate_with_ledger(prompts(spark), counting(folder, lambda t: t is None or t.endswith("3")), ledger, **options)
    rows = {r.output_of: r for r in first.collect()}
    assert rows[3].output is None and rows[3].error == "ValueError: not now" and rows[3].attempts == 2
    assert rows[99].output == rows[1].output == "<text 1>" and rows[2].output == rows[100].output == "<a>" and rows[101].output is None
    once = calls(folder)
    assert len(once) == len(set(once)) == 45
    second = {r.output_of: r.output for r in generate_with_ledger(prompts(spark), counting(folder), ledger, **options).collect()}
    assert second[3] == "<text 3>" and second[102] == "<None>" and second[101] is None
    assert len(calls(folder)) == len(set(calls(folder))) == 51
    generate_with_ledger(prompts(spark), counting(folder), ledger, **options)
    assert len(calls(folder)) == 51
    assert ledger_of(spark, ledger).where("error is null").count() == 51


def test_a_pass_that_breaks_off(spark, tmp_path):
    """The function takes its worker down; what was answered before is not asked again."""
    ledger, folder = str(tmp_path / "ledger"), str(tmp_path)
    options = {"key": "id", "prompt": "prompt", "tasks": 1, "batch": 2}
    answer = counting(folder)

    def dies(text):
        path = os.path.join(folder, "calls")
        if os.path.exists(path) and len(open(path).read().splitlines()) >= 20:
            raise SystemExit(1)
        return answer(text)

    with pytest.raises(Exception):
        generate_with_ledger(prompts(spark), dies, ledger, **options)
    kept = ledger_of(spark, ledger).count()
    assert 18 <= kept <= 20
    generate_with_ledger(prompts(spark), answer, ledger, **options)
    assert ledger_of(spark, ledger).count() == 51
    assert len(calls(folder)) - len(set(calls(folder))) <= 2


def test_nothing_to_ask(spark, tmp_path):
    none = prompts(spark).where("false")
    assert generate_with_ledger(none, len, str(tmp_path / "l"), key="id", prompt="prompt", tasks=2).count() == 0
