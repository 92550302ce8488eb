"""One small document per rule; expected rows worked out by hand."""

import json
import math

import pytest
from pyspark.sql import functions as F

from scoreloom.operators.extract import extract, rejects, results  # noqa: F401
from scoreloom.operators import grouping as G

IFEVAL, IFEVAL_KEY = "ifeval", "inst_level_strict_acc,none"
MATH, MATH_KEY = "math_500|0", "pass@k:k=1&n=1"


def lm(members=None, task=IFEVAL, **top):
    members = {IFEVAL_KEY: 0.5} if members is None else members
    doc = {"results": {task: members}, "configs": {}, "config": {}, "model_name": "m"}
    doc.update(top)
    return doc


def le(members=None, task=MATH, generation=None, header=None, **top):
    members = {MATH_KEY: 0.9} if members is None else members
    head = {"model_name": "m", **(header or {})}
    if generation is not None:
        head["model_config"] = {"generation_parameters": generation}
    return {"config_general": head, "results": {"all": {}, task: members}, **top}


def without(doc, *keys):
    return {k: v for k, v in doc.items() if k not in keys}


CODES = {
    "lm_ok": (lm(), None),
    "le_ok": (le(), None),
    "no_configs": (without(lm(), "configs"), "UNKNOWN_FORMAT"),
    "null_configs": (lm(configs=None), None),
    "unregistered": (lm(task="other", members={"x": 1}), None),
    "unregistered_bad_date": (lm(task="other", members={"x": 1}, date="x", config=None), None),
    "date_text": (lm(date="2024-01-01"), "BAD_TIMESTAMP"),
    "date_empty_text": (lm(date=""), None),
    "date_false": (lm(date=False), None),
    "date_true": (lm(date=True), None),
    "date_empty_list": (lm(date=[]), None),
    "date_list": (lm(date=[1]), "BAD_TIMESTAMP"),
    "date_object": (lm(date={"a": 1}), "BAD_TIMESTAMP"),
    "date_out_of_range": (lm(date=1e15), "BAD_TIMESTAMP"),
    "date_year_10000": (lm(date=253402300800), "BAD_TIMESTAMP"),
    "date_last_second": (lm(date=253402300799), None),
    "gen_kwargs_null": (lm(config={"gen_kwargs": None}), "BAD_PARAMS"),
    "gen_kwargs_text": (lm(config={"gen_kwargs": "temperature=0"}), "BAD_PARAMS"),
    "gen_kwargs_absent": (lm(config={"other": 1}), None),
    "config_null": (lm(config=None), "BAD_PARAMS"),
    "config_list": (lm(config=[1]), "BAD_PARAMS"),
    "results_null": (lm(results=None), "BAD_RESULTS"),
    "results_list": (lm(results=[1]), "BAD_RESULTS"),
    "le_results_absent": (without(le(), "results"), None),
    "le_results_null": (le(results=None), "BAD_RESULTS"),
    "task_not_object": (lm(results={IFEVAL: 1, "mrcr": {"AUC": 1}}), "BAD_TASK"),
    "task_null": (lm(results={IFEVAL: None}), "BAD_TASK"),
    "unregistered_not_object": (lm(results={IFEVAL: {IFEVAL_KEY: 1}, "x": 3}), None),
    "value_text": (lm({IFEVAL_KEY: "N/A"}), "NON_NUMERIC_METRIC"),
    "value_numeric_text": (lm({IFEVAL_KEY: "0.5"}), "NON_NUMERIC_METRIC"),
    "value_list": (lm({IFEVAL_KEY: [1]}), "NON_NUMERIC_METRIC"),
    "value_true": (lm({IFEVAL_KEY: True}), None),
    "stderr_text": (lm({IFEVAL_KEY: 1, IFEVAL_KEY + "_stderr": "0.1"}), "NON_NUMERIC_METRIC"),
    "stderr_text_without_value": (lm({IFEVAL_KEY: None, IFEVAL_KEY + "_stderr": "0.1"}), None),
    "other_key_text": (lm({IFEVAL_KEY: 1, "alias": "x", "z": [1]}), None),
    "duration_list": (lm(total_evaluation_time_seconds=[1]), "BAD_DURATION"),
    "duration_object": (lm(total_evaluation_time_seconds={}), "BAD_DURATION"),
    "model_list": (lm(model_name=["m"]), "BAD_MODEL_NAME"),
    "model_null": (lm(model_name=None), None),
    "model_empty": (lm(model_name=""), None),
    "le_header_null": (le(config_general=None), "BAD_PARAMS"),
    "le_model_config_null": (le(header={"model_config": None}), "BAD_PARAMS"),
    "le_generation_null": (le(header={"model_config": {"generation_parameters": None}}), "BAD_PARAMS"),
    "le_temperature_text": (le(generation={"temperature": "0.6"}), "BAD_TEMPERATURE"),
    "le_temperature_list": (le(generation={"temperature": []}), "BAD_TEMPERATURE"),
    "le_start_text": (le(header={"start_time": "x"}), "BAD_TIMESTAMP"),
}

GOOD = json.dumps(lm())
TEXTS = {
    "empty": ("", "EMPTY_FILE"),
    "blank": ("  \n", "MALFORMED_JSON"),
    "truncated": (GOOD[:-1], "MALFORMED_JSON"),
    "trailing": (GOOD + " x", "MALFORMED_JSON"),
    "two": (GOOD + GOOD, "MALFORMED_JSON"),
    "two_lines": (GOOD + "\n" + GOOD, "MALFORMED_JSON"),
    "comma_two": (GOOD + "," + GOOD, "MALFORMED_JSON"),
    "comma_pair": (GOOD + ',"x":5', "MALFORMED_JSON"),
    "closing": (GOOD + "]", "MALFORMED_JSON"),
    "brace": (GOOD + "}", "MALFORMED_JSON"),
    "bom": ("﻿" + GOOD, "MALFORMED_JSON"),
    "control": (GOOD.replace('"m"', '"a\tb"'), "MALFORMED_JSON"),
    "trailing_comma": (GOOD[:-1] + ",}", "MALFORMED_JSON"),
    "single_quotes": (GOOD.replace('"', "'"), "MALFORMED_JSON"),
    "comment": (GOOD + "/* c */", "MALFORMED_JSON"),
    "nan_key": ("{NaN: 1}", "MALFORMED_JSON"),
    "nan_word": (GOOD.replace("0.5", "NaNx"), "MALFORMED_JSON"),
    "utf8": (GOOD.encode()[:-1] + b',"x":"\xff"}', "INVALID_UTF8"),
    "list": ('["results","configs","config"]', "UNKNOWN_FORMAT"),
    "text": ('"config_general"', "UNKNOWN_FORMAT"),
    "number": ("5", "UNKNOWN_FORMAT"),
    "null": ("null", "UNKNOWN_FORMAT"),
    "spaces": (" \n" + GOOD + "\n ", None),
    "bare_nan": (GOOD.replace("0.5", "NaN"), None),
    "bare_infinity": (GOOD.replace("0.5", "-Infinity"), None),
    "nan_in_text": (GOOD.replace("0.5", "NaN").replace('"m"', '"m, NaN, \\"NaN\\" "'), None),
    "nan_date": (GOOD[:-1] + ',"date":NaN}', "BAD_TIMESTAMP"),
    "text_like_marker": (GOOD.replace("0.5", '"~nonfinite:NaN"'), "NON_NUMERIC_METRIC"),
    "huge": (GOOD.replace("0.5", "1e400"), None),
    "unicode": (GOOD.replace('"m"', '"模型 😀 \\u00e9"'), None),
}


def test_codes(docs):
    cases = {f"/g/{k}.json": json.dumps(d) for k, (d, _) in CODES.items()}
    cases |= {f"/t/{k}.json": c for k, (c, _) in TEXTS.items()}
    expected = {f"/g/{k}.json": code for k, (_, code) in CODES.items()}
    expected |= {f"/t/{k}.json": code for k, (_, code) in TEXTS.items()}
    got = {r.path: r.code for r in extract(docs(cases)).collect()}
    assert got == expected


def one(docs, doc, **options):
    text = doc if isinstance(doc, str) else json.dumps(doc)
    rows = results(extract(docs({"/g/a.json": text}), **options)).collect()
    assert len(rows) == 1
    return rows[0]


def metrics_of(row):
    return {k: (v.value, v.stderr) for k, v in row.metrics.items()}


def test_both_key_sets_is_the_second_format(docs):
    row = one(docs, {**lm(), **le()})
    assert (row.framework, row.task_name) == ("lighteval", MATH)


def test_registered_task_of_the_other_format_is_accepted(docs):
    assert one(docs, lm({MATH_KEY: 1}, task=MATH)).framework == "lm_eval"


def test_missing_or_null_metric_leaves_an_empty_row(docs):
    assert metrics_of(one(docs, lm({"other": 1}))) == {}
    assert metrics_of(one(docs, lm({IFEVAL_KEY: None}))) == {}


@pytest.mark.parametrize(
    ("members", "stderr"),
    [
        ({"inst_level_strict_acc_stderr,none": 0.1}, 0.1),
        ({IFEVAL_KEY + "_stderr": 0.2}, 0.2),
        ({"inst_level_strict_acc_stderr,none": "N/A", IFEVAL_KEY + "_stderr": 0.2}, None),
        ({"inst_level_strict_acc_stderr,none": None, IFEVAL_KEY + "_stderr": 0.2}, 0.2),
        ({IFEVAL_KEY + "_stderr": "N/A"}, None),
        ({}, None),
    ],
)
def test_stderr_lookup(docs, members, stderr):
    assert metrics_of(one(docs, lm({IFEVAL_KEY: 0.5, **members}))) == {IFEVAL_KEY: (0.5, stderr)}


def test_second_format_knows_only_the_suffix(docs):
    doc = le({IFEVAL_KEY: 1, "inst_level_strict_acc_stderr,none": 0.1}, task=IFEVAL)
    assert metrics_of(one(docs, doc)) == {IFEVAL_KEY: (1.0, None)}
    doc = le({MATH_KEY: 1, MATH_KEY + "_stderr": 0.1})
    assert metrics_of(one(docs, doc)) == {MATH_KEY: (1.0, 0.1)}


def test_stderr_candidates_before_each_comma(docs):
    registry = {"t": ("a,b,c",)}
    doc = lm({"a,b,c": 1, "a,b_stderr,c": 0.3, "a,b,c_stderr": 0.4}, task="t")
    assert metrics_of(one(docs, doc, registry=registry)) == {"a,b,c": (1.0, 0.3)}
    auto = one(docs, doc, registry={}, metrics="auto")
    assert metrics_of(auto)["a,b,c"] == (1.0, 0.3)


@pytest.mark.parametrize(
    ("duration", "expected"),
    [
        ("12.5", 12.5), ("abc", None), (7, 7.0), (None, None), (True, 1.0), ("1_000", 1000.0), ("1.5d", None),
        (" 1e3 ", 1000.0), ("1__0", None), ("_1", None), ("+.5", 0.5), ("5.", 5.0), ("", None), ("0x10", None),
        ("inf", math.inf), ("-Infinity", -math.inf),
    ],
)
def test_durations(docs, duration, expected):
    row = one(docs, lm(total_evaluation_time_seconds=duration))
    assert row.evaluation_duration_seconds == expected


def test_nan_duration_text(docs):
    assert math.isnan(one(docs, lm(total_evaluation_time_seconds="nan")).evaluation_duration_seconds)


@pytest.mark.parametrize(
    "date",
    [1700000000, 1700000000.1234565, 1700000000.5, 1.5e-6, -1.25, -62135596800, 253402300799, 1234567890.9999996,
     True, 1e9, 1723456789.123456],
)
def test_iso_agrees_with_datetime(docs, date):
    from datetime import datetime, timezone

    row = one(docs, lm(date=date))
    assert row.evaluation_datetime_iso == datetime.fromtimestamp(date, tz=timezone.utc).isoformat()
    assert row.evaluation_datetime == float(date)


@pytest.mark.parametrize("date", [0, 0.0, None, "", False])
def test_empty_dates(docs, date):
    assert one(docs, lm(date=date)).evaluation_datetime_iso is None


@pytest.mark.parametrize(
    ("generation", "temperature", "do_sample"),
    [({}, 0.0, False), ({"temperature": None}, None, False), ({"temperature": 0.6}, 0.6, True), ({"temperature": 0}, 0.0, False)],
)
def test_sampling_is_inferred(docs, generation, temperature, do_sample):
    params = one(docs, le(generation=generation)).inference_parameters
    assert (params.temperature, params.do_sample) == (temperature, do_sample)


def test_parameters_of_both_formats(docs):
    values = {"temperature": 0.6, "top_p": 0.9, "top_k": 50, "seed": 1234}
    first = one(docs, lm(config={"gen_kwargs": {"do_sample": True, "max_gen_toks": 9, **values}}))
    second = one(docs, le(generation={"max_new_tokens": 9, **values}))
    assert first.inference_parameters == second.inference_parameters
    assert first.inference_parameters.asDict() == {"do_sample": True, "max_gen_toks": 9, **values}
    assert set(one(docs, lm()).inference_parameters.asDict().values()) == {None}
    # no generation parameters at all: the default temperature still applies
    assert one(docs, le()).inference_parameters.temperature == 0.0


def test_document_order_and_duplicate_keys(docs):
    text = (
        '{"results":{"zz":{},"mrcr":{"AUC":1},"ifeval":{"inst_level_strict_acc,none":0.1},'
        '"mrcr":{"AUC":2,"score_gt_16k_le_32k":3}},"configs":{},"config":{},"model_name":"a","model_name":"b"}'
    )
    rows = results(extract(docs({"/g/a.json": text}))).orderBy("task_ord").collect()
    assert [(r.task_ord, r.task_name) for r in rows] == [(0, "mrcr"), (1, "ifeval")]
    assert {k: v.value for k, v in rows[0].metrics.items()} == {"AUC": 2.0, "score_gt_16k_le_32k": 3.0}
    assert rows[0].model_name == "b"


def test_nonfinite_values_are_kept(docs):
    text = json.dumps(lm({IFEVAL_KEY: float("nan"), IFEVAL_KEY + "_stderr": float("-inf")}))
    value, stderr = metrics_of(one(docs, text))[IFEVAL_KEY]
    assert math.isnan(value) and stderr == -math.inf


def test_long_documents_keep_every_string(docs):
    name = "m" * 5000
    small = lm({IFEVAL_KEY: float("nan")}) | {"model_name": name}
    head, tail = json.dumps(small)[:-1] + ',"log":"', '"}'
    long = docs({"/g/a.json": head}).withColumn("content", F.concat("content", F.repeat(F.lit('x, NaN \\" '), 1_800_000), F.lit(tail)))
    row = results(extract(long)).first()
    assert math.isnan(row.metrics[IFEVAL_KEY].value) and row.model_name == name


def test_what_the_parser_does_not_take_has_its_own_code(docs):
    head, tail = json.dumps(lm({IFEVAL_KEY: 0.5}))[:-1] + ',"log":"', '"}'
    frame = docs({"/g/a.json": head}).withColumn("content", F.concat("content", F.repeat(F.lit("x, y "), 4_100_000), F.lit(tail)))
    assert [r.code for r in extract(frame).select("code").collect()] == ["STRING_TOO_LONG"]
    wide = docs({"/g/b.json": '{"a":['}).withColumn(
        "content", F.concat("content", F.repeat(F.lit("12345678,"), 15_000_000), F.lit("1]}"))
    )
    assert [r.code for r in extract(wide).select("code").collect()] == ["TOO_LARGE"]


def test_auto_metrics(docs):
    members = {"acc,none": 0.5, "acc_stderr,none": 0.1, "alias": 3, "name": 4, "sample_len": 5, "flag": True, "s": "1", "n": None}
    row = one(docs, lm(members, task="anything"), metrics="auto")
    assert metrics_of(row) == {"acc,none": (0.5, 0.1), "flag": (1.0, None)}
    row = one(docs, le({"acc": 0.5, "acc_stderr": "N/A", "alias": 3}, task="anything"), metrics="auto")
    assert metrics_of(row) == {"acc": (0.5, None), "alias": (3.0, None)}


def test_auto_keeps_registry_metrics_of_registered_tasks(docs):
    row = one(docs, lm({IFEVAL_KEY: 1, "other": 2}), metrics="auto")
    assert metrics_of(row) == {IFEVAL_KEY: (1.0, None)}


@pytest.mark.parametrize("frame", ["outcomes", "results", "runs", "grouped", "metrics_long", "totals", "unique_names", "rejects"])
def test_fail_on_first_refused_document(docs, frame):
    from scoreloom.pipeline import parse_documents

    run = parse_documents(docs({"/g/a.json": "x", "/g/b.json": json.dumps(lm({IFEVAL_KEY: 0.5}))}), on_bad="fail", store=False)
    with pytest.raises(Exception, match="refused document /g/a.json: MALFORMED_JSON"):
        getattr(run, frame).collect()
    with pytest.raises(Exception, match="refused document"):
        parse_documents(docs({"/g/a.json": "x"}), on_bad="fail")



def _groups(docs, contents):
    found = results(extract(docs(contents)))
    stats = {r.metric: r for r in G.group_stats(G.metrics_long(found)).collect()}
    return found, stats


def test_spread_of_one_two_and_no_values(docs):
    runs = [lm({"AUC": v}, task="mrcr", total_evaluation_time_seconds=d) for v, d in ((1, None), (3, None))]
    found, stats = _groups(docs, {f"/g/{i}.json": json.dumps(r) for i, r in enumerate(runs)})
    assert (stats["AUC"].value_mean, stats["AUC"].value_std) == (2.0, math.sqrt(2))
    assert (stats["AUC"].stderr_mean, stats["AUC"].stderr_std) == (None, None)
    durations = G.duration_stats(found).collect()[0]
    assert (durations.num_repetitions, durations.duration_mean, durations.duration_std) == (2, None, None)
    _, stats = _groups(docs, {"/g/0.json": json.dumps(runs[0])})
    assert (stats["AUC"].value_mean, stats["AUC"].value_std) == (1.0, 0.0)


def test_value_and_stderr_count_separately(docs):
    runs = [lm({IFEVAL_KEY: 0.1}), lm({IFEVAL_KEY: 0.2, IFEVAL_KEY + "_stderr": 0.5}), lm({IFEVAL_KEY: 0.3})]
    _, stats = _groups(docs, {f"/g/{i}.json": json.dumps(r) for i, r in enumerate(runs)})
    row = stats[IFEVAL_KEY]
    assert (row.n, row.n_stderr, row.stderr_mean, row.stderr_std) == (3, 1, 0.5, 0.0)
    assert row.value_mean == pytest.approx(0.2) and row.value_std == pytest.approx(0.1)


def test_first_run_by_path(docs):
    contents = {
        f"/g/run_{i}.json": json.dumps(lm(config={"gen_kwargs": {"seed": 1233 + i}})) for i in (3, 1, 2)
    }
    row = G.group_rows(results(extract(docs(contents)))).collect()[0]
    assert (row.inference_parameters.seed, row.first_seen.path, row.num_repetitions) == (1234, "/g/run_1.json", 3)


def test_models_without_a_name_form_a_group(docs):
    contents = {f"/g/{i}.json": json.dumps(lm(model_name=m)) for i, m in enumerate([None, None, "", "a"])}
    outcomes = extract(docs(contents))
    found = results(outcomes)
    sizes = {r.model_name: r.num_repetitions for r in G.duration_stats(found).collect()}
    assert sizes == {None: 2, "": 1, "a": 1}
    names = {(r.kind, r.name) for r in G.unique_names(found).collect()}
    assert names == {("task", IFEVAL), ("model", "a")}
    nested = {r.model_name: r.num_repetitions for r in G.grouped(found).collect()}
    assert nested == sizes


def test_totals_count_files_without_rows(docs):
    contents = {"/g/a.json": GOOD, "/g/b.json": json.dumps(lm(task="x", members={})), "/g/c.json": "x"}
    row = G.totals(extract(docs(contents))).collect()[0]
    assert (row.total_results_parsed, row.total_files_parsed) == (1, 2)
    empty = G.totals(extract(docs({"/g/c.json": "x"}).where("false"))).collect()[0]
    assert (empty.total_results_parsed, empty.total_files_parsed) == (0, 0)


def test_rejects(docs):
    rows = rejects(extract(docs({"/g/a.json": GOOD, "/g/b.json": "x"}))).collect()
    assert [(r.path, r.code) for r in rows] == [("/g/b.json", "MALFORMED_JSON")]


@pytest.mark.parametrize("metrics", ["registry", "auto"])
def test_joined_registry_reports_the_same(spark, monkeypatch, metrics):
    from scoreloom.operators import registry

    two = json.dumps(lm({"AUC": 1, "score_gt_16k_le_32k": 0.25, "AUC_stderr": "N/A"}, task="mrcr"))
    repeated = '{"results": {"ifeval": {"inst_level_strict_acc,none": 1}}, "configs": {}, "config": {}, "results": {"zeta": {"x": 1}, "mrcr": {"AUC": 0.5}, "ifeval": {"inst_level_strict_acc,none": 0.125}}}'
    contents = [
        ("/g/a.json", json.dumps(lm({IFEVAL_KEY: 0.5, "other": 1}))), ("/g/b.json", json.dumps(lm({IFEVAL_KEY: "x"}))),
        ("/g/c.json", json.dumps(lm({IFEVAL_KEY: float("nan")}))), ("/g/d.json", "{"), ("/g/e.json", json.dumps(lm({"k": 1}, task="unknown"))),
        ("/g/f.json", json.dumps(le({"acc": 0.5}, task="mrcr"))), ("/g/g.json", ""), (None, json.dumps(lm())), (None, json.dumps(lm())), (None, two),
        ("/g/h.json", two), ("/g/h.json", two), ("/g/h.json", json.dumps(lm())), ("/g/i.json", repeated), ("/g/j.json", json.dumps(without(le(), "results"))),
        ("/g/k.json", json.dumps(lm(results=None))), ("/g/l.json", json.dumps(lm(results={"ifeval": 1}))), ("/g/m.json", json.dumps(lm(results={}))),
        ("/g/n.json", None), ("/g/o.json", json.dumps(le({MATH_KEY: 1, MATH_KEY + "_stderr": 0.5}, generation={"temperature": 1}))),
        *((path, json.dumps(doc)) for path, (doc, _) in CODES.items()),
    ]
    frame = spark.createDataFrame([(p, p and p[3:], c) for p, c in contents], "path string, source_filename string, content string").repartition(3)
    literal = sorted(map(str, extract(frame, metrics=metrics).collect()))
    monkeypatch.setattr(registry, "LITERAL_ENTRIES", 3)
    assert registry.as_mapping(registry.DEFAULT_REGISTRY) is None
    for small in (True, False):
        monkeypatch.setattr("scoreloom.session.BROADCAST_BYTES", 1 << 20 if small else 0)
        found = extract(frame, registry=registry.DEFAULT_REGISTRY, metrics=metrics)
        assert sorted(map(str, found.collect())) == literal
    assert extract(frame.where("false"), registry=registry.DEFAULT_REGISTRY).collect() == []


def test_rejects_name_step_task_and_metric(docs):
    contents = {
        "/g/a.json": "{", "/g/b.json": json.dumps(lm({IFEVAL_KEY: "x"})), "/g/c.json": "{}", "/g/d.json": "",
        "/g/e.json": json.dumps(lm({IFEVAL_KEY: 1}) | {"results": {"ifeval": 3}}),
    }
    got = {r.path[3]: (r.stage, r.code, r.detail) for r in rejects(extract(docs(contents))).collect()}
    assert got == {
        "a": ("parse", "MALFORMED_JSON", None), "b": ("extract", "NON_NUMERIC_METRIC", f"ifeval: {IFEVAL_KEY}"),
        "c": ("classify", "UNKNOWN_FORMAT", None), "d": ("read", "EMPTY_FILE", None), "e": ("extract", "BAD_TASK", "ifeval"),
    }
