"""Exact top-k by inner product of whole-number vectors: an impact-ordered index, score at a time.

Rows are indexed in blocks. In a block each component has its rows in order of value, cut into
segments by quantised value. A query takes the segments in descending order of what they can add,
and after each round knows for every row a lower bound and an upper bound of its score. It stops
when all rows but a few have an upper bound below the k-th lower bound, which proves that they
are out, and scores the few exactly. Every query meets every block; no pair of rows is a Spark row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scoreloom.llm.vectors import in_blocks, usable
from scoreloom.session import materialize

BLOCK, QUERY_BLOCK = 4096, 256
#: Segments of a component; possible rows that end the search.
SEGMENTS, POSSIBLE = 8, 256
#: Bounds are compared when these shares of a block's postings have been taken.
SHARES = (0.25, 0.5, 0.65, 0.75, 0.85, 0.95, 1.0)
#: Whole numbers up to this are exact as doubles.
EXACT = 1 << 53
#: Groups of blocks that the queries are sent to, each with a copy of all of them.
GROUPS = 256


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers held as doubles, in the narrowest type that has them all."""
    most = np.abs(values).max(initial=0)
    return values.astype("<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8").tobytes()


def _unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = {2: "<i2", 4: "<i4", 8: "<f8"}[len(data) // (rows * width)]
    return np.frombuffer(data, kind).reshape(rows, width).astype(np.float64)


@dataclass(frozen=True)
class BlockIndex:
    """Postings of one block: per component, rows by ascending value and where each segment begins."""

    keys: np.ndarray
    values: np.ndarray
    order: np.ndarray
    ordered: np.ndarray
    starts: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray, values: np.ndarray) -> BlockIndex:
        order = np.argsort(values, axis=0, kind="stable").T.astype(np.int32)
        starts = []
        for component, rows in enumerate(order):
            column = values[rows, component]
            edges = np.linspace(column[0], column[-1], SEGMENTS + 1)[1:-1]
            starts.append([0, *np.searchsorted(column, edges).tolist(), len(rows)])
        return cls(keys, values, order, np.take_along_axis(values.T, order, 1), np.asarray(starts, np.int32))

    def fields(self) -> dict:
        order = self.order.astype("<u2" if len(self.keys) <= 1 << 16 else "<i4")
        parts = {"keys": self.keys.astype("<i8"), "order": order, "starts": self.starts}
        return {"values": _packed(self.values), **{n: p.tobytes() for n, p in parts.items()}}

    @classmethod
    def load(cls, row: dict) -> BlockIndex:
        keys = np.frombuffer(row["keys"], "<i8")
        starts = np.frombuffer(row["starts"], np.int32).reshape(-1, SEGMENTS + 1)
        values = _unpacked(row["values"], len(keys), len(starts))
        order = np.frombuffer(row["order"], "<u2" if len(keys) <= 1 << 16 else "<i4").astype(np.int32).reshape(len(starts), len(keys))
        return cls(keys, values, order, np.take_along_axis(values.T, order, 1), starts)

    def possible(self, query: np.ndarray, own: int, k: int) -> np.ndarray:
        """Rows that may be among the ``k`` best of the block, ``own`` left out; proven to hold them all."""
        rows, width = self.values.shape
        others = np.flatnonzero(self.keys != own)
        if len(others) <= max(k, POSSIBLE):
            return others
        component = np.arange(width)[:, None]
        # the ends of each segment of each component, as impact of this query
        low = self.ordered[component, np.minimum(self.starts[:, :-1], rows - 1)] * query[:, None]
        high = self.ordered[component, np.maximum(self.starts[:, 1:] - 1, 0)] * query[:, None]
        sizes = self.starts[:, 1:] - self.starts[:, :-1]
        base = np.where(sizes > 0, np.minimum(low, high), np.inf).min(1)
        gain = np.where(sizes > 0, np.maximum(low, high) - base[:, None], -1.0).ravel()
        ranked = np.argsort(-gain, kind="stable")[: np.count_nonzero(sizes)]
        taken = np.cumsum(sizes.ravel()[ranked])
        found, unseen, at = np.zeros(rows), np.ones(rows * width), 0
        for stop in np.searchsorted(taken, np.asarray(SHARES) * taken[-1]) + 1:
            segments = ranked[at:stop]
            at = max(at, int(stop))
            if len(segments):
                owner, inside = np.divmod(segments, SEGMENTS)
                begin, size = self.starts[owner, inside], self.starts[owner, inside + 1] - self.starts[owner, inside]
                # where each posting of the round lies in the rows of ``order``
                place = np.repeat(owner * rows + begin - np.cumsum(size) + size, size) + np.arange(size.sum())
                owner, members = np.repeat(owner, size), self.order.ravel()[place]
                found += np.bincount(members, self.ordered.ravel()[place] * query[owner] - base[owner], rows)
                unseen[members * width + owner] = 0.0
            rest = np.zeros(width)
            np.maximum.at(rest, ranked[at:] // SEGMENTS, gain[ranked[at:]])
            proven = np.partition(found[others], -k)[-k]
            left = others[(found + unseen.reshape(rows, width) @ rest)[others] >= proven]
            if len(left) <= max(k, POSSIBLE):
                break
        return left

    def best(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The ``k`` best rows other than ``own`` as (key, score), ties to the smaller key."""
        bound = np.abs(self.values).max(initial=0) * np.abs(query).max(initial=0) * 4 * len(query)
        if bound < EXACT:
            rows = self.possible(query, own, k)
            scores = (self.values[rows] @ query).astype(np.int64)
        else:  # no room in a double: Python's whole numbers, held at the ends of a long
            rows = np.flatnonzero(self.keys != own)
            whole = [int(x) for x in query.tolist()]
            exact = [sum(int(x) * y for x, y in zip(v, whole, strict=True)) for v in self.values[rows].tolist()]
            scores = np.asarray([min(max(x, -(1 << 63)), (1 << 63) - 1) for x in exact], np.int64)
        order = np.lexsort((self.keys[rows], ~scores))[:k]
        return list(zip(self.keys[rows][order].tolist(), scores[order].tolist(), strict=True))


def _whole(vectors: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(vectors * scale)


def search(
    vectors: DataFrame,
    queries: Column,
    k: int,
    scale: float,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for the rows where ``queries`` (on ``key``) holds, the ``k``
    best other rows by the inner product of ``floor(scale * x)``, ties to the smaller key.

    Fewer than ``k`` others give fewer rows. Rows without key and vectors that are null, empty,
    or hold null or non-finite components take no part; so do vectors that are not of the commonest
    length. Of rows with one key the greatest vector counts. Scores beyond a long stay at its end.
    An empty table gives no rows, and further columns are not looked at.
    """
    rows = usable(vectors, key, vector)
    blocks = in_blocks(
        rows, block, "values binary, keys binary, `order` binary, starts binary",
        lambda keys, m: BlockIndex.build(keys, _whole(m, scale)).fields(),
    )
    blocks = materialize(blocks.withColumn("number", F.monotonically_increasing_id()), "impact-blocks")
    count = max(1, blocks.count())
    cells = min(count, GROUPS)
    asked = rows.withColumnRenamed("key", key).where(queries).withColumnRenamed(key, "key")
    asked = in_blocks(
        asked.repartition(max(1, math.ceil(count * block / 100 / query_block))), query_block, "queries binary, asked binary",
        lambda keys, m: {"queries": keys.astype("<i8").tobytes(), "asked": _packed(_whole(m, scale))},
    )
    every = asked.withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    met = blocks.withColumn("cell", F.expr(f"cast(pmod(xxhash64(number), {cells}) as int)")).join(every, "cell")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                index = BlockIndex.load(row)
                keys = np.frombuffer(row["queries"], "<i8")
                asked = _unpacked(row["asked"], len(keys), index.values.shape[1])
                found = [(q, *hit) for q, v in zip(keys.tolist(), asked, strict=True) for hit in index.best(v, q, k)]
                columns = zip(*found, strict=True) if found else ([], [], [])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    hits = met.select("keys", "values", "order", "starts", "queries", "asked").mapInArrow(
        run, "query_id bigint, vec_id bigint, score bigint"
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
