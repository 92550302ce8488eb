"""Every named query against its SQL, and the shape of the plans."""

import re

import pytest
from conftest import SF
from oracle import connect, spark_rows, sql_rows

import __spark_entry__ as entry_point
from scoreloom.plans.catalog import CATALOG


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query_equals_sql(spark, con, name):
    got = spark_rows(CATALOG[name].run(spark, SF))
    assert got[1], "no rows"
    assert got == sql_rows(con, CATALOG[name].sql)


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_document_is_parsed_once(spark):
    from pyspark.sql import functions as F

    from scoreloom.operators import extract as X
    from scoreloom.plans import synth
    from scoreloom.plans.catalog import table

    found = X.results(X.extract(synth.event_documents(table(spark, SF, "events"))))
    filtered = found.where((F.col("model_name") == "m1") & (F.col("task_name") == "ifeval"))
    # once for the text, once for its repaired form
    assert len(re.findall(r"parseJson\(", plan_of(filtered))) == 2


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_no_cartesian_product(spark, name):
    if name in ("scan_files", "incremental_ingest", "details_sink", "report_line_counts", "grouped_report_rows"):
        pytest.skip("runs jobs while it is built")
    plan = plan_of(CATALOG[name].run(spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_what_is_used(spark):
    plan = plan_of(CATALOG["pass_at_k"].run(spark, SF))
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan


def test_python_only_where_a_caller_brings_python(spark):
    for name in sorted(CATALOG):
        if name in ("batch_generate", "scan_files", "incremental_ingest", "details_sink", "report_line_counts"):
            continue
        plan = plan_of(CATALOG[name].run(spark, SF))
        assert "Python" not in plan and "MapInPandas" not in plan, name
