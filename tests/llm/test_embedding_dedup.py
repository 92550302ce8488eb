"""Near copies of vectors against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest

from scoreloom.llm import embedding_dedup
from scoreloom.llm.common import prepare

SCHEMA = "vec_id bigint, label int, embedding array<float>, kept string, component_id int"


def sound(vector):
    return vector is not None and len(vector) > 0 and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def brute(rows, similar=0.98):
    """The links between rows, and the smallest key each one reaches."""
    parent = list(range(len(rows)))
    links = [0] * len(rows)

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    units = [
        np.asarray(v, np.float32).astype(float) / np.abs(v).max() if k is not None and label is not None and sound(v) else None
        for k, label, v, *_ in rows
    ]
    for i, a in enumerate(units):
        for j in range(i):
            b = units[j]
            if a is None or b is None or rows[i][1] != rows[j][1] or len(a) != len(b):
                continue
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= similar:
                links[i] += 1
                links[j] += 1
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least: dict = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return [(r[0], n, least.get(root(i)) if r[0] is not None else None, r[0] is not None and least[root(i)] == r[0]) for i, (r, n) in enumerate(zip(rows, links))]


def clusters(sizes, dim=16, labels=2, noise=0.03, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for size in sizes:
        centre, label = rng.standard_normal(dim), int(rng.integers(labels))
        for _ in range(size):
            vector = centre / np.linalg.norm(centre) + rng.standard_normal(dim) * noise / 2
            rows.append([label, (vector * rng.uniform(0.1, 10)).astype(np.float32).tolist()])
    order = rng.permutation(len(rows)).tolist()
    return [(1000 + n, *rows[i], "x", 7) for n, i in enumerate(order)]


def found(spark, rows, **options):
    prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted(map(tuple, embedding_dedup.near_copies(df, **options).collect()), key=repr)


def test_whole_labels(spark):
    rows = clusters([60, 20, 5, 2, *[1] * 40])
    odd = [
        (1, 0, None, "", 0), (2, None, [1.0] * 16, "", 0), (3, None, [1.0] * 16, "", 0), (None, 1, [1.0] * 16, "", 0),
        (4, 1, [1.0] * 16, "", 0), (5, 1, [2.0] * 16, "", 0), (5, 1, [2.0] * 16, "", 0), (6, 1, [1.0] * 15 + [None], "", 0),
        (7, 1, [1.0] * 15 + [math.nan], "", 0), (8, 1, [math.inf] * 16, "", 0), (9, 1, [0.0] * 16, "", 0), (10, 1, [], "", 0),
        (11, 1, [1.0] * 8, "", 0), (12, 1, [1e-30] * 8, "", 0), (13, 1, [1e30] * 8, "", 0), (14, 1, [-1.0] * 16, "", 0),
        (15, 1, [0.0, 1.0], "", 0), (15, 1, [1.0, 0.0], "", 0), (16, 1, [-0.0, 1.0], "", 0),
    ]
    want = brute(rows + odd)
    assert found(spark, rows + odd) == sorted(want, key=repr)
    assert found(spark, []) == []
    assert found(spark, odd[:1]) == [(1, 0, 1, True)]


def test_small_windows_count_each_link_once(spark):
    rows = clusters([150, 40, 10, *[1] * 400], labels=1)
    want = {r[0]: r for r in brute(rows)}
    got = found(spark, rows, window=64)
    assert embedding_dedup.passes_for(600, 0.98, 64, 1e-4) > 3
    assert all(n <= want[k][1] for k, n, *_ in got)
    assert sum(n for _, n, *_ in got) >= 0.9 * sum(r[1] for r in want.values())
    assert [(k, c, kept) for k, _, c, kept in got] == [(k, *want[k][2:]) for k, *_ in got]


def test_hot_vector(spark):
    rows = [(i - 3000, 0, [1.0, 2.0, 3.0], "", 0) for i in range(3000)] + clusters([30, *[1] * 100], dim=3, labels=1)
    want = brute(rows[:1] + rows[3000:])
    got = {r[0]: r for r in found(spark, rows, window=64)}
    assert {r[2] for k, r in got.items() if k < 0} == {-3000} and got[-7][1] == got[-3000][1] >= 2999
    assert got[-3000][1] == 2999 + want[0][1]
    assert sum(r[3] for r in got.values()) == sum(r[3] for r in want)


@pytest.mark.parametrize("largest", [0, 1, 64, 65, 10**4, 10**9])
def test_passes_grow_slowly(largest):
    assert 1 <= embedding_dedup.passes_for(largest, 0.98, 64, 1e-4) <= 120
