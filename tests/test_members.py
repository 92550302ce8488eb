"""Members of a document are taken out in one walk, whatever their names and types."""

import re

from scoreloom.operators import extract as X
from scoreloom.operators.adapters import Adapter


def documents(spark, *texts):
    rows = [(f"/runs/{i}.json", f"{i}.json", text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "path string, source_filename string, content string")


def outcomes(docs, **options):
    return {row.source_filename: row for row in X.extract(docs, **options).collect()}


def test_no_path_is_walked_for_a_member(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        for metrics in ("registry", "auto"):
            plan = X.extract(documents(spark, "{}"), metrics=metrics)._jdf.queryExecution().analyzed().toString()
            # results of another type than an object are the only ones looked for again
            assert set(re.findall(r"\$\[0\]\['(\w+)'\]", plan)) == {"results"}
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_tasks_and_members_of_odd_types(spark):
    head = '"configs":{},"config":null,"model_name":"m"'
    found = outcomes(
        documents(
            spark,
            '{"results":{"t":{"a":1,"b":"2","a_stderr":0.5,"c_stderr":3,"alias":7,"name":8,"x,y":true}},%s}' % head,
            '{"results":{"t":{"a":1},"u":[1]},%s}' % head,
            '{"results":{"t":null},%s}' % head,
            '{"results":null,%s}' % head,
            '{"results":[],%s}' % head,
            '[{"results":{}}]',
        ),
        registry={},
        metrics="auto",
    )
    codes = [found[f"{i}.json"].code for i in range(6)]
    assert codes[1:] == ["BAD_TASK", "BAD_TASK", "BAD_RESULTS", "BAD_RESULTS", "UNKNOWN_FORMAT"]
    assert [found[f"{i}.json"].detail for i in (1, 2)] == ["u", "t"]
    # "config" is no object
    assert codes[0] == "BAD_PARAMS"


def test_members_that_differ_by_case(spark):
    one = Adapter(name="one", required=("run", "results"), started="When", duration="secs", model="who", params=("run",), fields=())
    two = Adapter(name="two", required=("Run", "results"), started="when", duration="Secs", model="Who", params=("Run",), fields=())
    text = '{"%s":{},"results":{"ifeval":{"AUC":0.5}},"who":"small","Who":"large"}'
    found = outcomes(documents(spark, text % "run", text % "Run"), registry={"ifeval": ("AUC",)}, adapters=(one, two))
    assert [(found[f].framework, found[f].model_name, found[f].code) for f in ("0.json", "1.json")] == [
        ("one", "small", None),
        ("two", "large", None),
    ]
