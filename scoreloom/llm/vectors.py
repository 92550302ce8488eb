"""What the two vector searches share: which rows take part, and blocks of rows as packed matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.session import materialize


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key bigint, vector array<double>)``: one row per key, all vectors of one length.

    Rows without a key take no part, nor do vectors that are null, empty or hold null or
    non-finite components. Of lengths, the commonest counts (of several such the greatest); of rows with
    one key, the greatest vector.
    """
    rows = vectors.select(F.col(key).cast("bigint").alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = rows.where(F.col("key").isNotNull() & (F.size("vector") > 0) & finite)
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    length = lengths.orderBy(F.desc("count"), F.desc("length")).first()
    if length is None:
        return rows.where("false")
    rows = rows.where(F.size("vector") == length.length)
    return materialize(rows.groupBy("key").agg(F.max("vector").alias("vector")), "vectors")


def matrix(column: pa.ListArray) -> np.ndarray:
    """A batch of vectors of one length as rows of a matrix."""
    if not len(column):
        return np.zeros((0, 0))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def in_blocks(rows: DataFrame, size: int, fields: str, make):
    """Rows of ``(key, vector)`` in groups of up to ``size``; ``make(keys, matrix)`` gives one row of ``fields`` for each."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def block():
            values = make(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in values.values()], names=list(values))

        for batch in batches:
            keys, vectors = batch.column("key").to_numpy(), matrix(batch.column("vector"))
            at = 0
            while at < len(keys):
                room = size - sum(len(h[0]) for h in held)
                held.append((keys[at : at + room], vectors[at : at + room]))
                at += room
                if at <= len(keys):
                    yield block()
                    held = []
        if held:
            yield block()

    return rows.select("key", "vector").mapInArrow(run, fields)
