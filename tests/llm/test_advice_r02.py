"""Whole jobs: what the operators left out before."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from conftest import SF
from test_llm_operators import best_of, frame, within

from scoreloom.llm import ann, language_id, line_dedup
from scoreloom.llm.common import prepare
from scoreloom.llm.queries import CATALOG


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    prepare(spark)


def test_line_dedup_of_short_lines(spark):
    rng = random.Random(8)
    lines = ["And.", "Of.", "x", "x", "", " ", "\t", " ", "\r", "\r", "Of.", "And.", "", "12345", "12354", "Öen 🙂 ß", "Oen 🙂 ss"]
    for length in range(1, 45):
        base = "".join(rng.choice("abcdefgh é") for _ in range(length))
        for _ in range(4):
            line = list(base)
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(line) + 1)
                line[at : at + rng.randrange(2)] = rng.choice(["", "x", "y z"])
            lines.append("".join(line))
    rng.shuffle(lines)
    docs = [(i, "\n".join(lines[4 * i : 4 * i + 4])) for i in range(-(-len(lines) // 4))]
    got = {(r.doc_id, i) for r in line_dedup.repeated_lines(frame(spark, docs)).collect() for i in r.lines}
    places = [(k, i, x) for k, t in docs for i, x in enumerate(t.split("\n")) if x.strip()]
    near = lambda x, y: min(len(x), len(y)) >= 5 and abs(len(x) - len(y)) <= 2 and within(x, y, 2)
    want = {(k, i) for n, (k, i, x) in enumerate(places) for _, _, y in places[:n] if x == y or near(x, y)}
    assert got == want
    assert min(len(docs[k][1].split("\n")[i]) for k, i in got) == 1


@pytest.mark.parametrize("stretch", [1.0, 30.0, 1000.0])
def test_neighbours_of_unequal_norms(spark, stretch):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(1500, 16))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    vectors[7] *= stretch
    vectors[8, 3] = stretch / 10  # one component far out
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in ann.search(df, F.col("vec_id") % 50 == 1, 10).collect()}
    want = {(r[0], r[2]) for q in range(1, 1500, 50) for r in best_of(dict(enumerate(vectors)), q, 10, float)}
    assert len(got & want) >= 0.9 * len(want)


def test_labels_are_no_evidence_and_pages_are_read_whole(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("lang in ('en', 'de')").where(F.length("text") > 400)
    english = docs.where("lang = 'en'").orderBy("doc_id").first().text
    short = " ".join(english.split()[:4])
    mislabelled = spark.createDataFrame([(-1, short, "de", "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.unionByName(mislabelled, allowMissingColumns=True).write.parquet(f"{tmp_path}/documents.parquet")
    body = f"<body><!-- le --><nav>der die das</nav><p>{english[:200]}</p><script>var t='</p>';</script>&eacute;</body>"
    pages = [(1, "http://a.b.de/x", f"<html lang='en'>{body}</html>"), (2, None, None), (3, "http://a.b.de/de/x", "<html lang='de'></html>"), (3, "x", "<p>")]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.doc_id: r.language for r in CATALOG["op10_language_id"].run(spark, str(tmp_path)).collect()}
    assert found[-1] == "en"
    rows = [(r.page_id, r.language, r.kept) for r in CATALOG["op10_page_language"].run(spark, str(tmp_path)).collect()]
    assert sorted(rows) == [(1, "en", True), (2, "und", False), (3, "und", False), (3, "und", False)]
    assert language_id.page_text(pages[0][2]) == " ".join(english[:200].split()) + " é"


def test_every_page_has_a_language(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = CATALOG["op10_page_language"].run(spark, SF)
    assert found.count() == pages.count() == pages.join(found, "page_id").count()
    named = pages.join(found, "page_id").select((language_id.declared_in(F.col("html")) == F.col("language")).cast("int").alias("same"))
    assert named.agg(F.avg("same")).first()[0] >= 0.9
