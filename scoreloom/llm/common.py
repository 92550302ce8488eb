"""What several of the operators need: batches, session settings, ranks, ASCII lower case."""

from __future__ import annotations

import ctypes
import gc
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from scoreloom.session import ensure_conf, materialize

#: Rows and bytes of an Arrow batch: a task holds a few batches at a time, however long the texts are.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2048", "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}

#: Shuffle files go when the action that made them ends; the driver deletes them at a collection of its garbage otherwise, however full the disks are.
SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}

#: Values of a side up to which it is broadcast: some tens of megabytes.
BROADCAST_VALUES = 1_000_000

Work = Callable[[pa.RecordBatch], list]


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for rows that carry whole texts."""
    ensure_conf(spark)
    for key, value in (BATCH | SHUFFLES).items():
        spark.conf.set(key, value)
    return spark


def broadcast_if_small(stored: DataFrame, values: Column | None = None) -> DataFrame:
    """A hint to broadcast a stored table if it is small enough; beyond, both sides are shuffled.

    Counted are rows, which must be narrow, or the sum of ``values`` where rows hold arrays.
    """
    size = stored.agg(F.sum(F.lit(1) if values is None else values + 1)).first()[0] or 0
    return F.broadcast(stored) if size <= BROADCAST_VALUES else stored


def ranked(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank``, from 0, of each within its group.

    Rows are sorted by range, so that a large group lies in many partitions; the number of its rows in earlier
    ones is added to the place in the own. A table of one row per partition and group is all that is summed.
    """
    sorted_rows = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = materialize(sorted_rows.withColumn("__place", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("__place", 33).alias("__part")
    parts = placed.groupBy(F.col(group).alias("__group"), part).agg(F.min("__place").alias("__first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("__group").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__group", "__part", "__first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("__before"))
    parts = materialize(parts, "places")
    same = placed[group].eqNullSafe(parts["__group"]) & (F.shiftright(placed["__place"], 33) == parts["__part"])
    met = placed.join(broadcast_if_small(parts), same)
    return met.select(*rows.columns, (F.col("__place") - F.col("__first") + F.col("__before")).alias("rank"))


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def release_memory() -> None:
    """Give back what earlier tasks of this Python worker have freed; allocators keep it otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def add_columns(df: DataFrame, make: Callable[[], Work], fields: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Columns computed from whole batches in Python; the other columns pass untouched.

    ``make`` runs once per task and returns the function for a batch, which gives one
    Arrow array for each of ``fields``. Columns in ``drop`` are not sent back.
    """
    added = T._parse_datatype_string(fields) if isinstance(fields, str) else fields
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType([*kept, *added.fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        work = None
        for batch in batches:
            work = work or make()
            arrays = [batch.column(f.name) for f in kept] + list(work(batch))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.mapInArrow(run, schema)
