"""The registered queries: SQL where there is some, plans, and the pipeline against brute force."""

from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from oracle import connect, spark_rows, sql_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
from scoreloom.llm import line_dedup
from scoreloom.llm.queries import CATALOG


def test_all_are_registered():
    assert {n.partition("_")[0] for n in CATALOG} == {f"op{i}" for i in range(1, 14)}
    assert {*CATALOG, "pipeline"} <= entry_point.queries().keys()


@pytest.mark.parametrize("name", sorted(n for n, entry in CATALOG.items() if entry.sql))
def test_query_equals_sql(spark, name):
    got = spark_rows(CATALOG[name].run(spark, SF))
    assert got[1], "no rows"
    assert got == sql_rows(connect(SF), CATALOG[name].sql)


@pytest.mark.parametrize("name", ["op3_line_dedup", "op5_url_filters"])
def test_native_plans(spark, name):
    plan = CATALOG[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


@pytest.mark.parametrize("name", ["op1_ngram_jaccard", "op2_token_counts", "op4_byte_bpe", "op10_language_id", "op12_tokenizer_alignment"])
def test_one_row_per_document(spark, name):
    want = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    got = [r.doc_id for r in CATALOG[name].run(spark, SF).select("doc_id").collect()]
    assert sorted(got) == sorted(want)


def close(a: str, b: str, limit: int = 2) -> bool:
    if abs(len(a) - len(b)) > limit:
        return False
    row = {j: j for j in range(limit + 1)}
    for i, x in enumerate(a, 1):
        row, old = {}, row
        for j in range(max(0, i - limit), min(len(b), i + limit) + 1):
            same = old.get(j - 1, 9) + (j > 0 and x != b[j - 1])
            row[j] = i if j == 0 else min(same, old.get(j, 9) + 1, row.get(j - 1, 9) + 1)
        if min(row.values()) > limit:
            return False
    return row.get(len(b), 9) <= limit


def test_pipeline(spark):
    from test_llm_operators import brute_components

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()}
    first: dict[str, tuple] = {}
    places = [(k, i, x) for k, t in docs.items() for i, x in enumerate(t.split("\n")) if x.strip()]
    for k, i, x in places:
        first.setdefault(x, (k, i))
    gone = {(k, i) for k, i, x in places if first[x] < (k, i)}
    lines = sorted((x for x in first if len(x) >= line_dedup.MIN_CHARS), key=len)
    for n, x in enumerate(lines):
        for y in reversed(lines[:n]):
            if len(x) - len(y) > 2:
                break
            if close(x, y):
                gone.add(max(first[x], first[y]))
    kept = {}
    for k, t in docs.items():
        left = "\n".join(x for i, x in enumerate(t.split("\n")) if (k, i) not in gone)
        if left == t or left.strip():
            kept[k] = left
    stays = {k: kept[k] for k, _, c in brute_components(list(kept.items())) if c == k}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {k: [*tokenizer.encode(t, add_special_tokens=False).ids, 2] for k, t in stays.items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == set(want)
    for r in rows:
        ids = want[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.asarray(ids, "<u4").tobytes())
    assert sum(r.length for r in rows) == sum(map(len, want.values()))


def test_stages_keep_odd_rows(spark):
    rows = [
        (None, "A text without an id, which is in English and stays in the corpus.", "en", "s", 1), (1, None, "en", "s", None),
        (2, "", None, None, 0), (3, "The same English text, twice with one id, is one document.", "en", "s", 5),
        (3, "The same English text, twice with one id, is one document.", "en", "s", 5), (4, "the same english text, twice with one id, is one document.", "en", "t", 5),
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    real = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'de')").where(F.length("text") > 400)
    docs = real.withColumn("doc_id", F.col("doc_id") + 100).unionByName(spark.createDataFrame(rows, schema))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == real.columns, name
    kept = [r.doc_id for r in docs.where("doc_id is null or doc_id < 100").collect()]
    assert sorted(kept, key=str) == [3, 3, None]
    empty = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0, name
