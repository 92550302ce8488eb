"""A content-addressed manifest of a table: hash trees, and proofs of their leaves.

Every row is a leaf. The leaves of a group stand in order of their key; runs of three neighbours become the digest of
their digests until one is left, the root of the group. The roots of the groups, in the order of
the groups, form one more tree. The manifest stores a record ``digest -> children`` for every inner node, one table
a level.

Proofs come from a descent: it starts at the root and follows the digits of the leaf's rank, least digit last. At each
level a node is looked up by its digest, the child of the next digit is taken, and the children not taken are
kept as a segment of the path. Requests of one subtree travel as one row until they part, so a level costs a
join of as many rows as it has nodes. Read backwards, the segments are the proof from leaf to root.

Digests are 32 bytes in the tables and lower-case hex text when they are hashed again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import broadcast_if_small, ranked
from scoreloom.session import materialize

#: Children of a node.
RUN = 3
_NO_PATH = "cast(array() as array<struct<before: binary, after: binary>>)"


def text_of(digest: Column) -> Column:
    """A stored digest, or several on end, as text."""
    return F.lower(F.hex(digest))


def digest_of(text: Column) -> Column:
    """SHA-256 of a text or of bytes, as stored."""
    return F.unhex(F.sha2(text, 256))


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row: each value as its byte count, a colon and itself; null as a dash."""
    parts = []
    for column in columns:
        text = column.cast("string")
        framed = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        parts.append(F.coalesce(framed, F.lit("-")))
    return digest_of(F.concat(*parts))


@dataclass(frozen=True)
class Forest:
    """Trees over ranked leaves.

    ``trees (tree, n, height, digest)``: one row per tree with its root. ``records[h - 1] (digest, children)``:
    the inner nodes of height ``h`` of all trees, each digest once.
    """

    trees: DataFrame
    records: list[DataFrame]


@dataclass(frozen=True)
class Manifest:
    """``leaves (row, digest, tree, height, rank)``, the forest of the groups, and the tree above it."""

    leaves: DataFrame
    forest: Forest
    top: Forest


def _height(n: str) -> str:
    """Levels above ``n`` leaves: how many powers of ``RUN`` are less than ``n``."""
    powers, power = [], 1
    while power < 1 << 62:
        powers.append(f"cast({n} > {power} as int)")
        power *= RUN
    return " + ".join(powers)


def _grow(leaves: DataFrame, trees: DataFrame) -> Forest:
    """Trees of ``leaves (tree, height, rank, digest)``; ``trees (tree, n, height)`` lists them."""
    tallest = trees.agg(F.max("height")).first()[0] or 0
    nodes = leaves.select("tree", "height", F.col("rank").alias("at"), "digest")
    roots = nodes.where("height = 0")
    records = []
    for level in range(1, tallest + 1):
        runs = nodes.where(f"height >= {level}").groupBy("tree", "height", F.expr(f"at div {RUN}").alias("above"))
        run = F.array_sort(F.collect_list(F.struct("at", "digest")))
        made = runs.agg(F.transform(run, lambda x: x["digest"]).alias("children"))
        joined = F.array_join(F.transform("children", text_of), "")
        made = made.select("tree", "height", F.col("above").alias("at"), digest_of(joined).alias("digest"), "children")
        made = materialize(made, "level")
        records.append(made.select("digest", "children").dropDuplicates(["digest"]))
        nodes = made.select("tree", "height", "at", "digest")
        roots = roots.unionByName(nodes.where(f"height = {level}"))
    rooted = trees.join(roots.select("tree", "digest"), "tree")
    return Forest(materialize(rooted, "trees"), records)


def build(rows: DataFrame, group: str, key: str, leaf: str) -> Manifest:
    """The manifest of ``rows``, whose column ``leaf`` holds their digests.

    Groups stand in ascending order, null first, text by its bytes; leaves of a group in ascending order of key, null
    first. Rows of one group and key stand in the order of their digests, so equal rows change nothing
    by their order. A group of one row has that leaf as its root. No rows give no trees. All columns of a row,
    whatever their names, are kept in ``row``.
    """
    rows = rows.select(F.col(group).alias("group"), F.col(key).alias("key"), F.col(leaf).alias("digest"), F.struct("*").alias("row"))
    rows = materialize(rows.withColumn("tie", F.monotonically_increasing_id()), "leaves")
    counts = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).withColumn("height", F.expr(_height("n")))
    numbered = ranked(counts.withColumn("all", F.lit(0)), "all", ["group"])
    trees = materialize(numbered.select("group", F.col("rank").alias("tree"), "n", "height"), "groups")
    leaves = ranked(rows, "group", ["key", "digest", "tie"])
    known = broadcast_if_small(trees.select(F.col("group").alias("of"), "tree", "height"))
    leaves = leaves.join(known, F.col("group").eqNullSafe(F.col("of"))).select("row", "digest", "tree", "height", "rank")
    leaves = materialize(leaves, "ranked-leaves")
    forest = _grow(leaves, trees.drop("group"))
    subroots = forest.trees.select(F.lit(0).alias("tree"), F.col("tree").alias("rank"), "digest")
    whole = subroots.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).withColumn("height", F.expr(_height("n")))
    whole = materialize(whole, "whole")
    top = _grow(subroots.join(F.broadcast(whole.select("tree", "height")), "tree"), whole)
    return Manifest(leaves, forest, top)


def _segment(digit: Column) -> Column:
    """The children not taken, those before the one taken and those after it."""

    def kept(wanted) -> Column:
        none = F.lit(bytearray())
        return F.concat(*[F.when(wanted(i), F.coalesce(F.get("children", F.lit(i)), none)).otherwise(none) for i in range(RUN)])

    return F.struct(kept(lambda i: digit > i).alias("before"), kept(lambda i: digit < i).alias("after"))


def _descend(starts: DataFrame, forest: Forest, down_to: int, wanted: DataFrame | None = None) -> DataFrame:
    """From ``starts (tree, height, at, digest, path)`` to the nodes of height ``down_to``.

    Lower trees join in at their own height; those under ``down_to`` take no part. With ``wanted (tree, rank)`` only
    nodes with such leaves below are followed.
    """
    front = starts.where("false").drop("height")
    for height in range(len(forest.records), down_to - 1, -1):
        front = front.unionByName(starts.where(f"height = {height}").drop("height"))
        if wanted is not None:
            asked = wanted.select("tree", F.expr(f"rank div {RUN**height}").alias("at")).distinct()
            front = front.join(asked, ["tree", "at"], "left_semi")
        if height == down_to:
            break
        met = front.join(forest.records[height - 1], "digest")
        digits = met.select("tree", "at", "path", "children", F.posexplode("children").alias("digit", "digest"))
        front = digits.select(
            "tree",
            (F.col("at") * RUN + F.col("digit")).alias("at"),
            "digest",
            F.concat("path", F.array(_segment(F.col("digit")))).alias("path"),
        )
    return front


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``row``, ``subroot``, ``root`` and ``path``, the segments from the leaf's own run up to the root, per leaf.

    ``requests (tree, rank)`` names the leaves; without it all are proven. A segment has the digests that stand
    before and after the node in its run, each on end in order; a run of one leaves an empty segment.
    """
    forest, top = manifest.forest, manifest.top
    root = top.trees.select(F.lit(0).alias("tree"), "height", F.lit(0).cast("bigint").alias("at"), "digest", F.expr(_NO_PATH).alias("path"))
    asked = None if requests is None else requests.select(F.lit(0).alias("tree"), F.col("tree").alias("rank")).distinct()
    subroots = _descend(root, top, 0, asked).select(F.col("at").alias("tree"), "digest", "path")
    starts = materialize(forest.trees.select("tree", "height").join(subroots, "tree"), "subroots")
    at_zero = starts.select("tree", "height", F.lit(0).cast("bigint").alias("at"), "digest", "path")
    front = _descend(at_zero, forest, 1, requests)
    if forest.records:
        front = front.join(forest.records[0], "digest").select("tree", "at", "path", "children")
    else:
        front = front.select("tree", "at", "path", F.array("digest").alias("children"))
    lone = at_zero.where("height = 0").select("tree", "at", "path", F.array("digest").alias("children"))
    leaves = manifest.leaves
    if requests is not None:
        leaves = leaves.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
    leaves = leaves.withColumn("at", F.expr(f"rank div {RUN}"))
    met = leaves.drop("digest").join(front.unionByName(lone), ["tree", "at"])
    digit = (F.col("rank") % RUN).cast("int")
    path = F.when(F.col("height") == 0, F.col("path")).otherwise(F.concat("path", F.array(_segment(digit))))
    met = met.withColumn("path", F.reverse(path)).drop("at", "children")
    ends = starts.select("tree", F.col("digest").alias("subroot"))
    whole = top.trees.select(F.col("digest").alias("root"))
    return met.join(broadcast_if_small(ends), "tree").join(F.broadcast(whole)).select("row", "subroot", "root", "path")


def siblings(path: Column) -> Column:
    """All digests of a path as one text, from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(text_of(s["before"]), text_of(s["after"]))), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root, as text, that a leaf has by its path."""

    def above(digest: Column, segment: Column) -> Column:
        return F.sha2(F.concat(text_of(segment["before"]), digest, text_of(segment["after"])), 256)

    return F.aggregate(path, text_of(leaf), above)
