"""Near copies among vectors, by passes over sorted random projections.

Each pass hashes every vector to 64 signs of random projections and sorts by them, the first sign first: vectors at a
small angle agree in most signs, and stand close together when they agree in the first ones. Every
vector is compared with a bounded window of those after it, on the original components. Other passes take other
projections, and the links of all passes are united.

How many passes are made follows from the angle, the largest label and the window: so many that a pair at
the least similarity is missed with a stated probability, if signs split a label evenly. A label no larger than the
window is compared whole in one pass.

Links are counted, not listed. Every vector knows its place in each pass, so a window sees of which
pairs an earlier pass had both in one window, and counts each pair once; it gives back a number for each vector and a
forest of links, whatever the number of pairs. Equal vectors are one node with a number of rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.llm.common import broadcast_if_small, ranked
from scoreloom.llm.components import components
from scoreloom.llm.vectors import matrix
from scoreloom.session import materialize

SIMILAR = 0.98
#: Vectors after a vector that it is compared with in a pass.
WINDOW = 1024
#: Rows of a product of two matrices.
ROWS = 512
#: Probability that no pass brings a pair together.
MISSED = 1e-4
SIGNS = 64


def passes_for(largest: int, similar: float, window: int, missed: float) -> int:
    """Passes for a label of ``largest`` vectors."""
    if largest <= window:
        return 1
    agree = (1 - math.acos(similar) / math.pi) ** math.log2(largest / window)
    return max(1, math.ceil(math.log(missed) / math.log1p(-agree)))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that no square is too large or too small."""
    vectors = vectors.astype(np.float64)
    vectors /= np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _codes(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """``(node, label, length, codes)``: a code per pass, as numbers that sort like the signs."""
    schema = nodes.select("node", "label", "length").schema.add("codes", T.ArrayType(T.LongType()))

    def run(batches):
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            codes = np.zeros((len(lengths), passes), np.int64)
            for length in np.unique(lengths).tolist():
                if length not in planes:
                    planes[length] = np.random.default_rng((seed, length)).standard_normal((length, passes * SIGNS))
                at = np.flatnonzero(lengths == length)
                signs = unit(matrix(batch.column("vector").take(pa.array(at)))) @ planes[length] > 0
                packed = np.packbits(signs, axis=1).view(">u8").astype(np.uint64)
                codes[at] = (packed ^ np.uint64(1 << 63)).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, codes.size + 1, passes, dtype=np.int32), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "label", "length")), lists], names=schema.names)

    return nodes.select("node", "label", "length", "vector").mapInArrow(run, schema)


def _places(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """``(node, places)``: where the node stands in each pass."""
    codes = materialize(_codes(nodes, passes, seed), "codes")
    each = codes.select(F.posexplode("codes").alias("pass", "code"), "label", "length", "node")
    placed = ranked(each, "pass", ["label", "length", "code", "node"])
    at = F.array_sort(F.collect_list(F.struct("pass", "rank")))
    return placed.groupBy("node").agg(F.transform(at, lambda x: x["rank"]).alias("places"))


def _united(size: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of ``size`` members the first one it is connected with."""
    root = np.arange(size)
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(units: np.ndarray, places: np.ndarray, at: int, own: int, window: int, similar: float):
    """Pairs (i, j) within ``window`` in this pass, i among the first ``own``, that are similar and new."""
    found = []
    for start in range(0, own, ROWS):
        stop = min(start + ROWS, own)
        end = min(stop + window, len(units))
        near = units[start:stop] @ units[start:end].T >= similar
        i, j = np.nonzero(near)
        keep = (j > i) & (j - i <= window)
        i, j = i[keep] + start, j[keep] + start
        new = np.ones(len(i), bool)
        for earlier in range(at):
            new &= np.abs(places[i, earlier] - places[j, earlier]) > window
        found.append((i[new], j[new]))
    return (np.concatenate(side) for side in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2


def _windows(nodes: DataFrame, window: int, block: int, similar: float) -> DataFrame:
    """Rows (node, links, root): what the windows of each pass find for a node.

    A block holds neighbours in the order of a pass, and the first vectors of the next block.
    """
    each = nodes.select("*", F.posexplode("places").alias("pass", "place"))
    number = F.floor(F.col("place") / block)
    before = F.when((F.col("place") % block < window) & (number > 0), F.array(number, number - 1)).otherwise(F.array(number))
    dealt = each.select("*", F.explode(before).alias("block"))
    fields = nodes.select(F.col("node"), F.lit(0).cast("bigint").alias("links"), F.col("node").alias("root")).schema

    def work(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        order = np.argsort(group.column("place").to_numpy(), kind="stable")
        group = group.take(pa.array(order))
        place, rows = group.column("place").to_numpy(), group.column("rows").to_numpy()
        at, first = group.column("pass")[0].as_py(), group.column("block")[0].as_py() * block
        places = matrix(group.column("places").combine_chunks()).astype(np.int64)
        labels, lengths = (group.column(c).to_numpy() for c in ("label_number", "length"))
        links, root = np.zeros(len(place), np.int64), np.arange(len(place))
        cuts = np.flatnonzero((np.diff(labels) != 0) | (np.diff(lengths) != 0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(place)], strict=True):
            own = int((place[a:b] < first + block).sum())
            if own == 0 or b - a == 1:
                continue
            units = unit(matrix(group.column("vector").slice(a, b - a).combine_chunks()))
            i, j = _compared(units, places[a:b], at, own, window, similar)
            np.add.at(links, i + a, rows[j + a])
            np.add.at(links, j + a, rows[i + a])
            root[a:b] = _united(b - a, i, j) + a
        told = np.flatnonzero(links)
        node = group.column("node")
        return pa.table([node.take(pa.array(told)), pa.array(links[told]), node.take(pa.array(root[told]))], names=fields.names)

    kept = dealt.select("pass", "block", "place", "places", "node", "label_number", "length", "vector", "rows")
    return kept.groupBy("pass", "block").applyInArrow(work, fields)


def near_copies(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    similar: float = SIMILAR,
    window: int = WINDOW,
    missed: float = MISSED,
    seed: int = 11,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` per row of ``vectors``.

    Two vectors of one label and one length link when the cosine of their angle, in double precision, is ``similar`` or
    more and a pass has them in one window. ``n_links`` counts the other rows linked directly, ``component_id`` is the
    smallest key reachable by links, its own included, and ``kept`` says whether that is the own one.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do rows without a
    label. Equal vectors of one label always link. Rows that repeat a key are vectors of their own. A row
    without a key takes no part and has no component. An empty table gives no rows, and further columns are not
    looked at.
    """
    kind = "array<float>" if vectors.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    sound = F.col("key").isNotNull() & F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    # 128 bits; rows that are not sound meet nothing, and are spread by their key
    of_vector, of_key = (F.xxhash64("label", "vector"), F.xxhash64(F.lit(1), "label", "vector")), (F.xxhash64("key"), F.lit(0))
    rows = rows.withColumns({h: F.when(F.col("sound"), a).otherwise(b) for h, a, b in zip(("h1", "h2"), of_vector, of_key)})
    alike = rows.where("sound").groupBy("h1", "h2").agg(
        F.min("key").alias("first"), F.count(F.lit(1)).alias("rows"), F.any_value("label").alias("label"), F.any_value("vector").alias("vector")
    )
    # the smallest key comes first, so the smallest node of a component has the smallest key
    node = F.struct("first", "h1", "h2").alias("node")
    nodes = materialize(alike.select(node, "label", F.size("vector").alias("length"), "vector", "rows"), "vector-nodes")
    sizes = nodes.groupBy("label", "length").count()
    passes = passes_for(sizes.agg(F.max("count")).first()[0] or 0, similar, window, missed)
    placed = nodes.join(_places(nodes, passes, seed), "node").withColumn("label_number", F.xxhash64("label"))
    placed = materialize(placed, "vector-places")
    found = materialize(_windows(placed, window, 4 * window, similar), "vector-links")
    roots = materialize(components(found.select(F.col("node").alias("u"), F.col("root").alias("v"))), "vector-roots")
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    several = nodes.select("node", "rows").join(counts, "node", "left").where("rows > 1 or links is not null")
    linked = several.join(roots, "node", "left").select(
        F.col("node.h1").alias("h1"),
        F.col("node.h2").alias("h2"),
        (F.coalesce("links", F.lit(0)) + F.col("rows") - 1).alias("links"),
        F.coalesce("root.first", "node.first").alias("component_id"),
    )
    linked = broadcast_if_small(materialize(linked, "linked-vectors"))
    told = rows.select("key", "h1", "h2").join(linked, ["h1", "h2"], "left")
    component = F.coalesce("component_id", "key")
    return told.select(
        F.col("key").alias(key),
        F.coalesce("links", F.lit(0).cast("bigint")).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("key"), F.lit(False)).alias("kept"),
    )
