"""Statistics that add up over batches, and exact means of the reported groups."""

import json
import random

from conftest import ROOT  # noqa: F401
from pyspark.sql import functions as F

from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G
from scoreloom.streaming.ingest import document_stream, ingest, stored_outcomes
from scoreloom.streaming.statistics import stored_statistics, write_partials


def doc(value, duration, model="m", task="ifeval", stderr=None):
    metrics = {"inst_level_strict_acc,none": value} | ({} if stderr is None else {"inst_level_strict_acc_stderr,none": stderr})
    return json.dumps({
        "results": {task: metrics}, "configs": {}, "config": {"gen_kwargs": {"seed": int(duration)}}, "date": 1.7e9,
        "model_name": model, "total_evaluation_time_seconds": duration,
    })


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def test_batches_add_up(spark, tmp_path):
    source, table, state, folder = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state"), str(tmp_path / "statistics")
    source.mkdir()
    assert stored_statistics(spark, folder) is None
    rng = random.Random(1)
    number = 0
    for batch in range(4):
        for _ in range(5):
            value, model = rng.uniform(0, 1) * 10 ** rng.randrange(-9, 9), rng.choice(["a", "b", None])
            stderr = rng.choice([None, "N/A", rng.uniform(0, 1)])
            (source / f"{rng.randrange(10**6):06}-{number}.json").write_text(doc(value, rng.uniform(1, 1e6), model, stderr=stderr))
            number += 1
        (source / f"bad{batch}.json").write_text("{")
        ingest(document_stream(spark, str(source), max_files=3), table, state, statistics=folder).awaitTermination()
        found = stored_statistics(spark, folder)
        once = X.results(stored_outcomes(spark, table))
        assert once.count() == number
        assert rows(found.stats) == rows(G.group_stats(G.metrics_long(once)))
        columns = sorted(found.groups.columns)
        assert rows(found.groups.select(columns)) == rows(G.group_rows(once).select(columns))
    # a batch that runs again replaces what it left
    before = rows(stored_statistics(spark, folder).stats)
    again = spark.read.parquet(f"{table}/batch_id=1")
    write_partials(again, folder, 1)
    assert rows(stored_statistics(spark, folder).stats) == before


def test_means_round_once(spark):
    values = [(f"p{i}", 0, "t", "m", "x", v, s) for i, (v, s) in enumerate([(0.1, None)] * 10 + [(1e16, 0.1), (1.0, None), (-1e16, 0.2)])]
    df = spark.createDataFrame(values, "path string, task_ord int, task_name string, model_name string, metric string, value double, stderr double")
    first = G.group_stats(df.where("value = 0.1")).first()
    assert (first.n, first.value_mean, first.value_std, first.n_stderr, first.stderr_mean) == (10, 0.1, 0.0, 0, None)
    for pieces in (1, 3, 13):
        rest = G.group_stats(df.where("value <> 0.1").repartition(pieces, F.col("path"))).first()
        assert (rest.n, rest.value_mean, rest.n_stderr) == (3, 1 / 3, 2)
