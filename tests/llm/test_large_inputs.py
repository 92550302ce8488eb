"""What operators leave on disk and hold in memory."""

from __future__ import annotations

import random
import tracemalloc
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import best_of, brute_components, frame, near_copies

from scoreloom.llm import jaccard, line_dedup, topk
from scoreloom.llm.common import prepare
from scoreloom.session import materialize, scratch, shared_dir


@pytest.fixture(scope="module", autouse=True)
def settings(spark):
    prepare(spark)


def left_by(spark, action):
    """Names of the tables that it leaves in the shared folder."""
    folder = Path(shared_dir(spark).removeprefix("file:"))
    before = {*folder.iterdir()}
    action()
    return sorted(p.name.rsplit("-", 1)[0] for p in {*folder.iterdir()} - before)


def test_tables_of_a_scratch(spark):
    def one(name):
        return materialize(spark.range(3), name)

    def nested():
        with scratch() as keep:
            one("a")
            b = keep(one("b"))
            with scratch() as inner:
                c, _ = inner(one("c")), one("d")
            assert c.count() == 3
        assert b.count() == 3

    assert left_by(spark, nested) == ["b"]

    def failing():
        with scratch(), pytest.raises(ZeroDivisionError), scratch():
            one("e")
            raise ZeroDivisionError

    assert left_by(spark, failing) == []


def test_near_duplicates_leave_what_the_result_reads(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    docs, found = near_copies(2, 2, 30), []
    assert left_by(spark, lambda: found.append(jaccard.near_duplicates(frame(spark, docs)))) == ["classes", "nodes", "survey"]
    assert sorted(map(tuple, found[0].collect())) == brute_components(docs)


def test_line_dedup_leaves_what_the_result_reads(spark):
    lines = ["A line that comes again and again.", "a line that comes again and again", "Another one, of some length."]
    docs = spark.createDataFrame([(i, "\n".join(lines[i % 2 :])) for i in range(9)], "doc_id bigint, text string")
    assert left_by(spark, lambda: line_dedup.repeated_lines(docs)) == ["repeated-lines"]


def test_shuffle_files_go_with_the_action(spark):
    held = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses()
    before = held.size()
    for _ in range(3):
        materialize(spark.range(100).groupBy(F.col("id") % 7).count(), "counts")
    assert held.size() <= before


def sets_of(seed, n, size, base):
    rng = np.random.default_rng(seed)
    return [np.unique(np.concatenate([rng.choice(base, size - size // 12, replace=False), rng.integers(1, 1 << 62, size // 12).astype(np.uint64)])) for _ in range(n)]


def grouped(links, nodes):
    label = {x: x for x in nodes}
    for a, b in links:
        old, new = label[a], label[b]
        label = {x: new if y == old else y for x, y in label.items()}
    return {frozenset(x for x in nodes if label[x] == y) for y in label.values()}


def test_forest_of_few_cells(monkeypatch):
    bases = [np.random.default_rng(i).integers(1, 1 << 62, 40).astype(np.uint64) for i in range(3)]
    sets = [s for i, base in enumerate(bases) for s in sets_of(i, 14, 40, base)] + [bases[0][:2], bases[0][:1]]
    left, right = [*enumerate(sets)][::2], [*enumerate(sets)][1::2] + [(0, sets[0])]
    pairs = [(i, j) for i, a in left for j, b in right if 4 * len(np.intersect1d(a, b)) >= 3 * len(np.union1d(a, b))]
    for cells in (1, 50, 1 << 21):
        monkeypatch.setattr(jaccard, "CELLS", cells, raising=False)
        links = jaccard._forest(left, right, jaccard.SIMILAR)
        assert {*links} <= {*pairs} and len(links) == len(sets) - len(grouped(pairs, range(len(sets))))
        assert grouped(links, range(len(sets))) == grouped(pairs, range(len(sets)))


def test_forest_of_full_blocks_stays_small():
    base = np.random.default_rng(5).integers(1, 1 << 62, 60).astype(np.uint64)
    sets = [*enumerate(sets_of(6, 4000, 30, base))]
    tracemalloc.start()
    jaccard._forest(sets[:2000], sets[2000:], jaccard.SIMILAR)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20


def test_few_crowded_shingles_make_no_bucket(spark):
    """Forty sets of one size that have one shingle of their prefixes in common are no candidates; of two sizes they may be."""
    kind = "token bigint, node bigint, `group` bigint, n bigint, m bigint, head boolean"
    live = spark.createDataFrame([(1, i, 1000 + i, 100, 40, True) for i in range(40)], kind)
    pairs, buckets = jaccard._candidates(live, jaccard.SIMILAR)
    assert pairs.count() == 0 == buckets.count()
    live = spark.createDataFrame([(1, i, 1000 + i, 75 if i == 7 else 100, 40, True) for i in range(40)], kind)
    pairs, buckets = jaccard._candidates(live, jaccard.SIMILAR)
    assert sorted(map(sorted, pairs.collect())) == sorted(sorted((7, i)) for i in range(40) if i != 7)
    assert buckets.count() == 0


def test_near_duplicates_under_shared_phrases(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 3)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 450)
    monkeypatch.setattr(jaccard, "COMMON_FROM", 10**9)  # no shingle is known as common
    rng = random.Random(7)
    phrase = [f"p{i}" for i in range(14)]
    docs = []
    for i in range(40):
        words = [f"u{rng.randrange(10**6)}" for _ in range(rng.choice((25, 40)))]
        longer = words + phrase + [f"v{rng.randrange(10**6)}" for _ in range(rng.choice((3, (len(words) + 10) // 3, len(words))))]
        docs += [(3 * i, " ".join(words + phrase)), (3 * i + 1, " ".join(longer))]
    docs += [(2000 + k, t) for k, t in near_copies(3, 2, 20)]
    got = jaccard.near_duplicates(frame(spark, docs)).collect()
    assert sorted(map(tuple, got)) == brute_components(docs)


def test_blocks_of_whole_numbers_are_narrow():
    rng = np.random.default_rng(2)
    for most, width in ((1 << 10, 2), (1 << 20, 4), (1 << 40, 8)):
        values = rng.integers(-most, most, (300, 16)).astype(np.float64)
        values[0, 0] = 1 - most
        index = topk.BlockIndex.build(np.arange(300), values)
        row = index.fields()
        assert len(row["values"]) == 300 * 16 * width and len(row["order"]) == 300 * 16 * 2
        again = topk.BlockIndex.load(row)
        assert all((getattr(index, n) == getattr(again, n)).all() for n in ("keys", "values", "order", "ordered", "starts"))


def test_exact_topk_in_few_groups_of_blocks(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    whole = {k: np.floor(1024 * np.asarray(v)) for k, v in rows}
    want = [r for key in range(0, 700, 100) for r in best_of(whole, key, 5, int)]
    for groups in (1, 3, 256):
        monkeypatch.setattr(topk, "GROUPS", groups, raising=False)
        got = topk.search(df, F.col("vec_id") % 100 == 0, 5, 1024.0, block=64, query_block=3).collect()
        assert sorted(map(tuple, got)) == sorted(want)
