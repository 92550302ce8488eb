"""Manifest and proofs against a plain hash tree."""

from __future__ import annotations

from hashlib import sha256

from pyspark.sql import functions as F

from scoreloom.llm import merkle
from scoreloom.llm.common import prepare


def tree(leaves):
    """Root, and per leaf the segments (before, after) from the leaf up."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for path, i in zip(paths, at):
            run = level[i // 3 * 3 : i // 3 * 3 + 3]
            path.append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
        at = [i // 3 for i in at]
        level = [sha256("".join(level[i : i + 3]).encode()).hexdigest() for i in range(0, len(level), 3)]
    return level[0], paths


def framed(*values):
    parts = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values]
    return sha256("".join(parts).encode()).hexdigest()


SCHEMA = "rank bigint, tree string, text string, height int, digest string"


def rows_of(sizes):
    rows = [(i * 7 % n if n > 2 else i, group, f"{group} ä {i}", i, None) for group, n in sizes.items() for i in range(n)]
    return [*rows, (None, "b", "no key", 0, "x"), (None, "b", "no key", 0, "x"), (3, "b", None, 0, ""), (2**40, "ü", "", 0, "")]


def check(spark, rows, requests=None):
    prepare(spark)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    df = df.withColumn("leaf", merkle.leaf_digest(F.col("rank"), F.col("tree"), F.col("text")))
    manifest = merkle.build(df, "tree", "rank", "leaf")
    found = merkle.proofs(manifest, requests(manifest) if requests else None)
    got = found.select(
        "row.rank", "row.tree", "row.text", "row.digest",
        *[merkle.text_of(F.col(c)).alias(c.split(".")[-1]) for c in ("row.leaf", "subroot", "root")],
        merkle.siblings(F.col("path")).alias("proof"), merkle.folded(F.col("row.leaf"), F.col("path")).alias("folded"),
    ).collect()
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[1], []).append(((r[0] is not None, r[0] or 0, framed(*r[:3])), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([k[2] for k, _ in sorted(groups[g], key=lambda x: x[0])]) for g in order}
    root, upper = tree([trees[g][0] for g in order]) if order else (None, [])
    want = []
    for g, above in zip(order, upper):
        for (k, r), path in zip(sorted(groups[g], key=lambda x: x[0]), trees[g][1]):
            proof = "".join(a + b for a, b in [*path, *above])
            want.append((r[0], r[1], r[2], r[4], k[2], trees[g][0], root, proof, root))
    return sorted(map(repr, map(tuple, got))), sorted(map(repr, want))


def test_manifest(spark):
    got, want = check(spark, rows_of({"a": 1, "b": 85, "hot": 400, None: 9, "c": 2, "d": 3, "e": 28}))
    assert got == want


def test_one_tree_and_none(spark):
    for rows in ([], [(1, None, "x", 0, "")], rows_of({})[:1], [(i, "g", "same", 0, "") for i in (1, 1, 2, 2)]):
        got, want = check(spark, rows)
        assert got == want


def test_requests(spark):
    rows = rows_of({"a": 1, "b": 30, "hot": 90})
    got, want = check(spark, rows, lambda m: m.leaves.where("rank % 10 = 4 or height = 0").select("tree", "rank"))
    assert got and len(got) < len(want) and set(got) <= set(want)


def test_tampering_shows(spark):
    prepare(spark)
    df = spark.createDataFrame(rows_of({"a": 40}), SCHEMA)
    leaf, other = (merkle.leaf_digest(F.col("rank"), c) for c in (F.col("text"), F.concat("text", F.lit("!"))))
    found = merkle.proofs(merkle.build(df.select("rank", "tree", leaf.alias("leaf"), other.alias("other")), "tree", "rank", "leaf"))
    bad = merkle.folded(F.col("row.other"), F.col("path")) == merkle.text_of(F.col("root"))
    same = F.col("row.other") == F.col("row.leaf")  # a null text stays null
    assert found.where(bad != same).count() == 0 and found.where(bad).count() == 1
