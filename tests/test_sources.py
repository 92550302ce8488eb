"""Scan, report, harness output and ingestion on real files."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G
from scoreloom.pipeline import parse, parse_documents
from scoreloom.sources.harness import harness_documents, write_details, write_documents
from scoreloom.sources.report import write_report
from scoreloom.sources.scan import scan_documents
from scoreloom.streaming.ingest import document_stream, ingest, stored_outcomes

KEY = "inst_level_strict_acc,none"


def doc(value=0.5, model="m", seed=1, task="ifeval", key=KEY, **top):
    return json.dumps(
        {"results": {task: {key: value}}, "configs": {}, "config": {"gen_kwargs": {"seed": seed}},
         "model_name": model, "date": 1700000000, "total_evaluation_time_seconds": 10, **top}
    )


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


@pytest.fixture
def tree(tmp_path):
    for name in ("b.json", "deep/er/c.json", "_u.json", ".dot.json", ".hid/x.json", "_under/y.json", "a+b c.json",
                 "%41ä.json", "_metadata.json", "_metadata.d/m.json", "p=1/_z=2.json", "UP.JSON", "note.txt", "deep/x.json.bak"):
        put(tmp_path / name, doc())
    put(tmp_path / "deep/empty.json", b"")
    (tmp_path / "dir.json").mkdir()
    return tmp_path


def test_scan_finds_every_document(spark, tree):
    expected = sorted(str(p) for p in tree.rglob("*.json") if p.is_file())
    found = scan_documents(spark, [str(tree)])
    assert sorted(r.path for r in found.select("path").collect()) == expected
    names = {r.path: r.source_filename for r in found.collect()}
    assert all(name == os.path.basename(path) for path, name in names.items())
    assert {r.content for r in found.where("source_filename <> 'empty.json'").collect()} == {doc()}


def test_scan_of_overlapping_and_odd_directories(spark, tree, tmp_path):
    odd = tmp_path / "od[d]{1}*"
    put(odd / "q.json", doc())
    expected = sorted(str(p) for p in tree.rglob("*.json") if p.is_file())
    found = scan_documents(spark, [str(tree), str(tree / "deep"), str(odd)])
    assert sorted(r.path for r in found.collect()) == expected


def test_scan_of_bad_paths(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        scan_documents(spark, [str(tmp_path / "none")])
    with pytest.raises(NotADirectoryError):
        scan_documents(spark, [put(tmp_path / "a.json", doc())])
    (tmp_path / "void").mkdir()
    assert scan_documents(spark, [str(tmp_path / "void")]).collect() == []
    assert scan_documents(spark, []).collect() == []


def test_empty_file_is_rejected_not_lost(spark, tree):
    run = parse(spark, [str(tree)])
    assert [(os.path.basename(r.path), r.code) for r in run.rejects.collect()] == [("empty.json", "EMPTY_FILE")]


RUNS = {
    "r/b2.json": doc(0.3, seed=3),
    "r/a1.json": doc(0.1, seed=1),
    "r/z9.json": doc(0.9, model=None),
    "r/a0.json": doc(0.7, model='q"uo\\te', task="mrcr", key="AUC"),
    "r/k.json": doc(task="unknown"),
    "r/bad.json": "{",
    "r/n.json": doc(float("nan"), model="nan"),
}


def expected_report(report):
    rows = {(r["task_name"], r["model_name"]): r for r in report["results"]}
    assert list(rows) == [("mrcr", 'q"uo\\te'), ("ifeval", "m"), ("ifeval", "nan"), ("ifeval", None)]
    group = rows["ifeval", "m"]
    assert group["num_repetitions"] == 2
    assert group["inference_parameters"]["seed"] == 1
    assert [r["source_filename"] for r in group["runs"]] == ["a1.json", "b2.json"]
    assert group["runs"][0] == {
        "source_filename": "a1.json",
        "evaluation_datetime": 1700000000,
        "evaluation_datetime_iso": "2023-11-14T22:13:20+00:00",
        "evaluation_duration_seconds": 10,
        "metrics": {KEY: {"value": 0.1, "stderr": None}},
    }
    stats = group["aggregate_stats"]
    assert stats["evaluation_duration_seconds"] == {"mean": 10, "std": 0}
    assert stats["metrics"][KEY]["value"]["mean"] == pytest.approx(0.2)
    assert stats["metrics"][KEY]["value"]["std"] == pytest.approx(0.02**0.5)
    assert stats["metrics"][KEY]["stderr"] == {"mean": None, "std": None}
    assert rows["ifeval", "nan"]["aggregate_stats"]["metrics"][KEY]["value"]["mean"] is None
    meta = report["metadata"]
    assert meta == {
        "parser_version": "1.0",
        "parse_datetime": "2024-05-06T07:08:09+00:00",
        "total_results_parsed": 5,
        "total_files_parsed": 6,
        "unique_tasks": ["ifeval", "mrcr"],
        "unique_models": ["m", "nan", 'q"uo\\te'],
    }


NOW = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)


def test_report_as_one_file(spark, tmp_path):
    for name, text in RUNS.items():
        put(tmp_path / "in" / name, text)
    run = parse(spark, [str(tmp_path / "in")])
    target = run.write_report(str(tmp_path / "out"), now=NOW)
    assert target.endswith("out/parsed_results_20240506_070809.json")
    expected_report(json.loads(open(target).read()))
    # the same second again replaces the report
    assert run.write_report(str(tmp_path / "out"), now=NOW) == target
    assert sorted(p for p in os.listdir(tmp_path / "out") if not p.startswith(".")) == [os.path.basename(target)]


def test_report_in_parts(spark, tmp_path):
    for name, text in RUNS.items():
        put(tmp_path / "in" / name, text)
    run = parse(spark, [str(tmp_path / "in")])
    target = run.write_report(str(tmp_path / "out"), now=NOW, layout="parts")
    parts = sorted(p for p in os.listdir(target) if p.startswith("part-"))
    expected_report(json.loads("".join(open(os.path.join(target, p)).read() for p in parts)))


def test_empty_report(spark, tmp_path):
    (tmp_path / "in").mkdir()
    target = parse(spark, [str(tmp_path / "in")]).write_report(str(tmp_path / "out"), now=NOW)
    report = json.loads(open(target).read())
    assert report["results"] == []
    assert (report["metadata"]["total_results_parsed"], report["metadata"]["unique_tasks"]) == (0, [])


def test_order_and_partitioning_of_files_do_not_matter(spark, docs):
    contents = {f"/r/{i:03d}.json": doc((i * 37 % 100) / 100, model=f"m{i % 3}", seed=i) for i in range(60)}
    frame = docs(contents)
    base = None
    for shuffled in (frame, frame.repartition(7), frame.orderBy(F.rand(5)), frame.coalesce(1)):
        run = parse_documents(shuffled, store=False)
        rows = sorted(map(repr, run.grouped.collect()))
        base = base or [r.split("'num_rep")[0] for r in rows]
        seeds = {r.model_name: (r.inference_parameters.seed, r.num_repetitions) for r in run.grouped.collect()}
        assert seeds == {"m0": (0, 20), "m1": (1, 20), "m2": (2, 20)}
        assert run.totals.first().total_results_parsed == 60


def _scores(spark):
    rows = [
        (f"results/t_{i}_seed_{1233 + i}.json", "m", 1.7e9, 12.5, {"temperature": 0.6, "seed": float(1233 + i)}, task, key, i / 10, err)
        for i in (1, 2, 3)
        for task, key, err in (
            ("mmlu_cot_llama", "exact_match,strict_match", 0.25),
            ("mrcr", "AUC", None),
            ("mrcr", "score_gt_16k_le_32k", 0.5),
        )
    ]
    return spark.createDataFrame(
        rows,
        "path string, model_name string, started double, duration double, params map<string,double>,"
        " task_name string, metric string, value double, stderr double",
    )


@pytest.mark.parametrize("harness", ["lm_eval", "lighteval"])
def test_scores_to_files_and_back(spark, tmp_path, harness):
    scores = _scores(spark)
    assert write_documents(harness_documents(scores, harness), str(tmp_path / "out")) == 3
    run = parse(spark, [str(tmp_path / "out")], store=False)
    long = run.metrics_long.select("task_name", "metric", "value", "stderr", F.regexp_extract("path", "results/.*", 0).alias("path"))
    back = sorted(map(str, (tuple(r) for r in long.collect())))
    sent = scores.select("task_name", "metric", "value", "stderr", "path")
    assert back == sorted(map(str, (tuple(r) for r in sent.collect())))
    row = run.results.orderBy("path").first()
    assert row.framework == harness
    assert (row.inference_parameters.temperature, row.inference_parameters.seed) == (0.6, 1234)
    assert row.evaluation_duration_seconds == 12.5


def test_stored_outcomes_live_in_the_shared_folder(spark, docs):
    run = parse_documents(docs({"/r/a.json": doc()}))
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in run.outcomes.inputFiles())


def test_details_are_partitioned_by_run(spark, tmp_path):
    samples = spark.range(1000).selectExpr("id", "'a|0' task_name", "'x/y' model_name", "cast(id % 3 as int) rep")
    write_details(samples, str(tmp_path / "d"), max_rows_per_file=100)
    back = spark.read.parquet(str(tmp_path / "d"))
    assert back.count() == 1000
    assert {(r.task_name, r.model_name) for r in back.select("task_name", "model_name").distinct().collect()} == {("a|0", "x/y")}


def test_ingestion_picks_up_only_new_files(spark, tmp_path):
    source, table, state = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "state")

    def run():
        ingest(document_stream(spark, str(source)), table, state).awaitTermination()
        return X.results(stored_outcomes(spark, table))

    put(source / "a.json", doc(0.1))
    put(source / "sub/b.json", doc(0.3))
    put(source / "bad.json", "{")
    assert run().count() == 2
    put(source / "c.json", doc(0.5))
    assert run().count() == 3
    assert run().count() == 3
    stored = stored_outcomes(spark, table)
    assert stored.count() == 4
    stats = G.group_stats(G.metrics_long(X.results(stored))).collect()
    assert [(r.n, round(r.value_mean, 6), round(r.value_std, 6)) for r in stats] == [(3, 0.3, 0.2)]


def test_addresses_are_qualified_and_checked(spark, tmp_path):
    from scoreloom.sources import scan

    assert scan.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert scan.listable("s3a://bucket/x") == "s3a://bucket/x"
    with pytest.raises(ValueError, match="leftovers=False"):
        scan.listable("dbfs:/x")
    (tmp_path / ".hidden.json").write_text(doc())
    put(tmp_path / "a.json", doc())
    assert parse(spark, [f"file://{tmp_path}"], leftovers=False).totals.first().total_files_parsed == 1
    assert parse(spark, [f"file:{tmp_path}"]).totals.first().total_files_parsed == 2


def test_report_of_a_run_that_is_not_stored(spark, tmp_path):
    put(tmp_path / "in" / "a.json", doc())
    run = parse(spark, [str(tmp_path / "in")], store=False)
    assert not run.stored
    report = json.loads(open(run.write_report(str(tmp_path / "out"), now=NOW)).read())
    assert report["metadata"]["total_results_parsed"] == 1


def test_ingestion_of_an_empty_folder(spark, tmp_path):
    from scoreloom.streaming.ingest import document_stream, ingest, stored_outcomes

    (tmp_path / "in").mkdir()
    table = str(tmp_path / "table")
    for expected in (0, 1, 2):
        if expected:
            put(tmp_path / "in" / f"{expected}.json", doc())
        ingest(document_stream(spark, str(tmp_path / "in")), table, str(tmp_path / "state")).awaitTermination()
        assert stored_outcomes(spark, table).count() == expected


@pytest.mark.parametrize("harness", ["lm_eval", "lighteval"])
def test_hostile_scores_to_documents_and_back(spark, harness):
    from scoreloom.operators.extract import extract
    from scoreloom.sources.harness import harness_documents
    from scoreloom.sources.scan import documents_from_table

    nan = float("nan")
    rows = [
        ("p1", "NaN", 1.7e9, 1.0, {"seed": 1.0}, "ifeval", KEY, nan, float("inf")),
        ("p2", "m", 1.7e9, 1.0, {"seed": 1.0}, "ifeval", KEY, None, None),
        ("p3", "m", 1.7e9, 1.0, {"seed": 1.0}, "ifeval", KEY, 0.25, 0.5),
        ("p3", "m", 1.7e9, 1.0, {"seed": 1.0}, "ifeval", KEY, 0.5, None),
    ]
    kind = "path string, model_name string, started double, duration double, params map<string,double>, task_name string, metric string, value double, stderr double"
    documents = harness_documents(spark.createDataFrame(rows, kind), harness)
    got = {r.path: r for r in extract(documents_from_table(documents)).collect()}
    assert {p: r.code for p, r in got.items()} == {"p1": None, "p2": None, "p3": None}
    assert got["p1"].model_name == "NaN" and str(got["p1"].rows[0].metrics[0].value) == "nan"
    assert got["p1"].rows[0].metrics[0].stderr == float("inf")
    assert list(got["p2"].rows) == []
    assert (got["p3"].rows[0].metrics[0].value, got["p3"].rows[0].metrics[0].stderr) == (0.5, 0.5)


def test_documents_on_a_cluster_go_to_the_shared_folder_only(spark, tmp_path, monkeypatch):
    from scoreloom.session import shared_dir

    monkeypatch.setattr(spark.sparkContext, "master", "spark://master:7077")
    docs = spark.createDataFrame([("a/b.json", "{}"), ("c.json", "[]")], "path string, content string")
    shared = f"{shared_dir(spark)}/cluster"
    assert write_documents(docs, shared) == 2
    assert {r.source_filename: r.content for r in scan_documents(spark, [shared]).collect()} == {"b.json": "{}", "c.json": "[]"}
    with pytest.raises(ValueError, match="share"):
        write_documents(docs, str(tmp_path / "own"))
