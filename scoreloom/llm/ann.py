"""Approximate nearest neighbours by inner product: NN-descent in Spark joins, greedy graph search.

Equal vectors are one node. Vectors get one more component that makes their lengths equal, so that the largest
inner product is the nearest; the graph and the search work on that in whole numbers of sixteen
bits, each vector on a scale of its own and the added component apart, and what they find is scored on the
original vectors in double precision.

The graph starts from blocks of nodes on the same side of random planes. Then each round every
node meets its neighbours and those it is a neighbour of: all of them are compared with each other, and each
keeps the best it has met. A search starts from a query's own neighbours and follows the graph from the best
nodes it knows until none of them is new.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoreloom.llm.vectors import matrix, usable
from scoreloom.session import materialize

#: Neighbours of a node, of which as many again that name it are met; rounds of descent.
DEGREE, REVERSE, ROUNDS = 24, 24, 3
#: Sets of random planes for the start, nodes of a block, best of a block kept for each.
PLANES, BLOCK = 10, 1024
#: Nodes that a search keeps.
BEAM = 160

_LIST = "node bigint, ids binary, scores binary"


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best distinct ids, best first, ties to the smaller id."""
    ids, at = np.unique(ids, return_index=True)
    scores = scores[at]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i8")


def _scores(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<f4")


def _rows(nodes: list, lists: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = [
        pa.array(nodes, pa.int64()),
        pa.array([i.astype("<i8").tobytes() for i, _ in lists], pa.binary()),
        pa.array([s.astype("<f4").tobytes() for _, s in lists], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["node", "ids", "scores"])


def _packed(vectors: np.ndarray, extra: np.ndarray) -> list[bytes]:
    """Whole numbers of sixteen bits for each row, then its own scale and the added component."""
    scale = (np.abs(vectors).max(1) / 32767).astype("<f4")
    whole = np.rint(vectors / np.maximum(scale, np.finfo("<f4").tiny)[:, None].astype(float)).clip(-32767, 32767).astype("<i2")
    tail = np.stack([scale, extra.astype("<f4")], 1)
    return [a.tobytes() + b.tobytes() for a, b in zip(whole, tail, strict=True)]


def _vectors(codes: bytes, count: int) -> np.ndarray:
    """``count`` packed vectors as rows, the added component last."""
    data = np.frombuffer(codes, np.uint8).reshape(count, -1)
    whole = np.ascontiguousarray(data[:, :-8]).view("<i2").astype(np.float32)
    tail = np.ascontiguousarray(data[:, -8:]).view("<f4")
    return np.hstack([whole * tail[:, :1], tail[:, 1:]])


def _nearness(vectors: np.ndarray) -> np.ndarray:
    """Minus half the squared distance of each two rows: the inner product less what all rows have in common, so that
    one very long vector does not drown the others."""
    own, extra = vectors[:, :-1], vectors[:, -1]
    half = (own * own).sum(1) / 2
    apart = extra[:, None] - extra
    return own @ own.T - half[:, None] - half - apart * apart / 2


def _codes(nodes: DataFrame, planes: int, block: int) -> DataFrame:
    """``(node, code, buckets)``: packed components, and the side of random planes per set of planes."""
    count, widest = (x or 0.0 for x in nodes.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("vector", F.abs)))).first())
    # components are taken as shares of the widest of the table, so that their squares neither overflow nor vanish
    size = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / widest) * (x / widest))
    longest = nodes.agg(F.max(size)).first()[0] or 0.0
    means = nodes.select(F.posexplode("vector")).groupBy("pos").agg(F.avg("col").alias("mean")).orderBy("pos").collect()
    centre = np.asarray([r["mean"] for r in means])
    bits = max(0, math.ceil(math.log2(max(1, count / block))))
    rng = np.random.default_rng(7)
    sides = rng.standard_normal((len(centre), planes * bits))

    def run(batches):
        for batch in batches:
            vectors = matrix(batch.column("vector"))
            if not len(vectors):
                continue
            scaled = vectors / widest
            extra = np.sqrt(np.maximum(0.0, longest - (scaled * scaled).sum(1)))
            codes = _packed(scaled, extra)
            above = ((vectors - centre) @ sides > 0).reshape(len(vectors), planes, bits)
            buckets = (above << np.arange(bits)).sum(2) if bits else np.zeros((len(vectors), planes), np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(codes, pa.binary()), pa.array(buckets.tolist(), pa.list_(pa.int64()))],
                names=["node", "code", "buckets"],
            )

    return nodes.mapInArrow(run, "node bigint, code binary, buckets array<bigint>")


def _unpacked(members) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and vectors of a collected list of (node, code)."""
    found = members.values if hasattr(members, "values") else members
    ids = found.field("node").to_numpy()
    return ids, _vectors(b"".join(found.field("code").to_pylist()), len(ids))


def _neighbourhoods(groups: DataFrame, k: int) -> DataFrame:
    """For every node of every group its ``k`` best in the group; groups are collected ``(node, code)``."""

    def run(batches):
        for batch in batches:
            column = batch.column("members")
            nodes, lists = [], []
            for i in range(len(column)):
                ids, vectors = _unpacked(column[i])
                scores = _nearness(vectors)
                np.fill_diagonal(scores, -np.inf)
                keep = min(k, len(ids) - 1)
                if keep < 1:
                    continue
                near = np.argpartition(-scores, keep - 1, axis=1)[:, :keep]
                nodes += ids.tolist()
                lists += zip(ids[near], np.take_along_axis(scores, near, 1), strict=True)
                if len(nodes) > 20_000:
                    yield _rows(nodes, lists)
                    nodes, lists = [], []
            yield _rows(nodes, lists)

    return groups.select("members").mapInArrow(run, _LIST)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list per node of the ``k`` best of all its lists."""

    def run(batches):
        for batch in batches:
            found = []
            for lists in batch.column("lists").to_pylist():
                ids = np.concatenate([_ids(x["ids"]) for x in lists])
                found.append(_best(ids, np.concatenate([_scores(x["scores"]) for x in lists]), k))
            yield _rows(batch.column("node").to_pylist(), found)

    grouped = lists.groupBy("node").agg(F.collect_list(F.struct("ids", "scores")).alias("lists"))
    return grouped.mapInArrow(run, _LIST)


def _edges(graph: DataFrame) -> DataFrame:
    """``(node, other, score)`` of a graph."""

    def run(batches):
        for batch in batches:
            ids = [_ids(x) for x in batch.column("ids").to_pylist()]
            scores = [_scores(x) for x in batch.column("scores").to_pylist()]
            nodes = np.repeat(batch.column("node").to_numpy(), [len(i) for i in ids])
            columns = [nodes, np.concatenate([*ids, _ids(b"")]), np.concatenate([*scores, _scores(b"")])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["node", "other", "score"])

    return graph.mapInArrow(run, "node bigint, other bigint, score float")


def neighbour_graph(
    codes: DataFrame, degree: int = DEGREE, reverse: int = REVERSE, rounds: int = ROUNDS, block: int = BLOCK
) -> DataFrame:
    """``(node, ids, scores)``: up to ``degree`` near nodes of each node of ``_codes``.

    Blocks and neighbourhoods are bounded: a bucket is dealt by hash to blocks of about ``block``, and of
    the nodes that name a node the ``reverse`` nearest are met.
    """
    dealt = codes.select("node", "code", F.posexplode("buckets").alias("plane", "bucket"))
    parts = dealt.groupBy("plane", "bucket").agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
    part = F.expr("pmod(xxhash64(node, plane), parts)").alias("part")
    dealt = dealt.join(F.broadcast(parts) if parts.count() <= 100_000 else parts, ["plane", "bucket"])
    dealt = dealt.select("node", "code", "plane", "bucket", part)
    blocks = dealt.groupBy("plane", "bucket", "part").agg(F.collect_list(F.struct("node", "code")).alias("members"))
    graph = materialize(_merged(_neighbourhoods(blocks, degree), degree), "graph")
    for _ in range(rounds):
        edges = _edges(graph)
        nearest = Window.partitionBy("other").orderBy(F.desc("score"), "node")
        back = edges.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= reverse)
        met = edges.select(F.col("node").alias("centre"), F.col("other").alias("node"))
        met = met.unionByName(back.select(F.col("other").alias("centre"), "node"))
        met = met.unionByName(graph.select(F.col("node").alias("centre"), "node")).distinct()
        around = met.join(codes.select("node", "code"), "node").groupBy("centre")
        around = around.agg(F.collect_list(F.struct("node", "code")).alias("members"))
        better = _neighbourhoods(around, degree // 3)
        graph = materialize(_merged(better.unionByName(graph), degree), "graph")
    return graph


def _step(asked: DataFrame, graph_codes: DataFrame) -> DataFrame:
    """Scores of the neighbours of the nodes in ``asked (query, node, code, floor)``, above the floor."""
    joined = asked.join(graph_codes, "node")

    def run(batches):
        for batch in batches:
            queries, lists = [], []
            columns = (batch.column(c).to_pylist() for c in ("query", "code", "floor", "ids", "codes"))
            for query, code, floor, ids, codes in zip(*columns, strict=True):
                own = _vectors(code, 1)[0]
                ids = _ids(ids)
                scores = _vectors(codes, len(ids)) @ own
                good = (scores > floor) & (ids != query)
                if good.any():
                    queries.append(query)
                    lists.append((ids[good], scores[good]))
            yield _rows(queries, lists)

    return joined.select("query", "code", "floor", "ids", "codes").mapInArrow(run, _LIST)


def _searched(graph: DataFrame, codes: DataFrame, queries: DataFrame, beam: int) -> DataFrame:
    """``(query, node)``: the nodes that a search from each query keeps."""
    edges = _edges(graph)
    held = edges.join(codes.select(F.col("node").alias("other"), "code"), "other").groupBy("node")
    held = held.agg(F.collect_list(F.struct(F.col("other").alias("node"), "code")).alias("members"))

    def packed(batches):
        for batch in batches:
            members = batch.column("members").to_pylist()
            ids = [np.asarray([m["node"] for m in x], "<i8").tobytes() for x in members]
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array(ids, pa.binary()), pa.array([b"".join(m["code"] for m in x) for x in members], pa.binary())],
                names=["node", "ids", "codes"],
            )

    graph_codes = materialize(held.mapInArrow(packed, "node bigint, ids binary, codes binary"), "graph-codes")
    # a query is a point without the additional component
    asked = codes.join(queries, "node").select(F.col("node").alias("query"), F.expr("overlay(code placing X'00000000' from octet_length(code) - 3)").alias("code"))
    asked = materialize(asked, "asked")
    pool = asked.select("query", *[F.lit(b"").alias(c) for c in ("ids", "scores", "done")])
    frontier = asked.select("query", F.col("query").alias("node"), "code", F.lit(float("-inf")).cast("float").alias("floor"))
    while True:
        found = _step(frontier, graph_codes)
        new = found.select(F.col("node").alias("query"), "ids", "scores")
        opened = materialize(frontier.select("query", "node"), "opened")
        expanded = opened.groupBy("query").agg(F.collect_set("node").alias("opened"))
        gathered = new.groupBy("query").agg(F.collect_list(F.struct("ids", "scores")).alias("lists"))
        state = pool.join(gathered, "query", "left").join(expanded, "query", "left")

        def merge(batches):
            for batch in batches:
                out: list[list] = [[], [], [], [], [], []]
                columns = (batch.column(c).to_pylist() for c in ("query", "ids", "scores", "done", "lists", "opened"))
                for query, ids, scores, done, lists, opened in zip(*columns, strict=True):
                    lists = [(_ids(x["ids"]), _scores(x["scores"])) for x in lists or []]
                    every = np.concatenate([_ids(ids), *[x[0] for x in lists]])
                    kept, best = _best(every, np.concatenate([_scores(scores), *[x[1] for x in lists]]), beam)
                    done = np.union1d(_ids(done), np.asarray(opened or [], np.int64))
                    fresh = np.setdiff1d(kept, done)
                    floor = float(best[-1]) if len(best) == beam else -math.inf
                    packed = (kept.astype("<i8").tobytes(), best.astype("<f4").tobytes(), done.astype("<i8").tobytes())
                    row = (query, *packed, fresh.tolist(), floor)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                types = (pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.float32())
                names = ["query", "ids", "scores", "done", "fresh", "floor"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

        state = state.select("query", "ids", "scores", "done", "lists", "opened")
        fields = "query bigint, ids binary, scores binary, done binary, fresh array<bigint>, floor float"
        state = materialize(state.mapInArrow(merge, fields), "search")
        pool = state.select("query", "ids", "scores", "done")
        frontier = state.select("query", F.explode("fresh").alias("node"), "floor").join(asked, "query")
        frontier = frontier.select("query", "node", "code", "floor")
        if state.where(F.size("fresh") > 0).isEmpty():
            return _edges(pool.select(F.col("query").alias("node"), "ids", "scores")).select(F.col("node").alias("query"), F.col("other").alias("node"))


def search(
    vectors: DataFrame,
    queries: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    beam: int = BEAM,
    **graph_options: int,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the rows where ``queries`` (on ``key``) holds, up to ``k`` near
    other rows by inner product, best first, ties to the smaller key.

    Scores are exact; which rows are found is approximate. Rows without key and vectors that are
    null, empty, zero or hold null or non-finite components take no part; so do vectors that are not of
    the commonest length. Of rows with one key the greatest vector counts. Equal vectors are found together. An empty
    table gives no rows, and further columns are not looked at.
    """
    rows = usable(vectors, key, vector).where(F.exists("vector", lambda x: x != 0))
    nodes = materialize(rows.groupBy("vector").agg(F.min("key").alias("node")), "nodes")
    members = rows.join(nodes, "vector").select("node", "key")
    smallest = Window.partitionBy("node").orderBy("key")
    listed = members.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1).select("node", "key")
    codes = materialize(_codes(nodes, PLANES, BLOCK), "codes")
    graph = neighbour_graph(codes, **graph_options)
    asked = members.withColumnRenamed("key", key).where(queries).select("node", F.col(key).alias("query_id"))
    asked = materialize(asked, "queries")
    found = _searched(graph, codes, asked.select("node").distinct(), beam)
    hits = found.unionByName(asked.select(F.col("node").alias("query"), "node").distinct()).distinct()
    original = nodes.select("node", "vector")
    scored = hits.join(original.withColumnsRenamed({"node": "query", "vector": "own"}), "query").join(original, "node")
    product = F.aggregate(F.zip_with("own", "vector", lambda a, b: a * b), F.lit(0.0), lambda a, x: a + x)
    scored = scored.select("query", "node", product.alias("score"))
    # a node that k others beat strictly gives no row, so ties for the k-th place all stay
    places = Window.partitionBy("query").orderBy(F.desc("score"))
    scored = scored.withColumn("place", F.rank().over(places)).where(F.col("place") <= k + 1)
    each = asked.withColumnRenamed("node", "query").join(scored, "query").join(listed, "node").where(F.col("key") != F.col("query_id"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "key")
    out = each.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("key").alias("vec_id"), "score")
