"""Batch generation through a caller's function."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from threading import Thread

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloom.session import ship_with_tasks
from scoreloom.sources.scan import _open, listable, qualified

ship_with_tasks(__name__)

Generator = Callable[[str], str]


class RequestTimeout(TimeoutError):
    """A call that took longer than it may."""


def _within(fn: Generator, text: str | None, seconds: float | None) -> str:
    """``fn(text)``, given up after so many seconds. The call itself cannot be stopped; its thread ends with it."""
    if seconds is None:
        return fn(text)
    done: list[tuple[bool, object]] = []

    def call() -> None:
        try:
            done.append((True, fn(text)))
        except Exception as failure:  # noqa: BLE001 - raised again by the caller
            done.append((False, failure))

    thread = Thread(target=call, daemon=True)
    thread.start()
    thread.join(seconds)
    if not done:
        raise RequestTimeout(f"no answer within {seconds:g} s")
    ok, value = done[0]
    if not ok:
        raise value
    return value


def _attempts(fn: Generator, retries: int, timeout: float | None) -> Callable[[str | None], tuple[str | None, str | None, int]]:
    """A function that calls ``fn`` up to ``retries`` times more and gives output, error and the number of calls."""

    def attempt(text: str | None) -> tuple[str | None, str | None, int]:
        error = None
        for count in range(1, retries + 2):
            try:
                return _within(fn, text, timeout), None, count
            except Exception as failure:  # noqa: BLE001 - kept as data
                error = f"{type(failure).__name__}: {failure}"
        return None, error, retries + 1

    return attempt


def generate(
    prompts: DataFrame,
    fn: Generator,
    *,
    key: str,
    prompt: str,
    tasks: int | None = None,
    threads: int = 1,
    retries: int = 3,
    timeout: float | None = None,
) -> DataFrame:
    """``prompts`` with ``output``, ``error`` and ``attempts``; all other columns pass untouched.

    ``fn`` is called once per row and again up to ``retries`` times after an exception or after
    ``timeout`` seconds. A row that still fails keeps its error and stays in the result. ``tasks`` x ``threads``
    bounds the open requests of a cluster; requests wait on a remote side, so a task may
    keep several open. Rows are spread by their key, which makes a retried task see the
    same rows.
    """
    spread = prompts.repartition(tasks, key) if tasks else prompts
    schema = T.StructType(
        [
            *prompts.schema.fields,
            T.StructField("output", T.StringType()),
            T.StructField("error", T.StringType()),
            T.StructField("attempts", T.IntegerType()),
        ]
    )
    names = schema.names
    attempt = _attempts(fn, retries, timeout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                answers = list(pool.map(attempt, batch.column(prompt).to_pylist()))
                columns = zip(*answers, strict=True) if answers else ((), (), ())
                added = [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int32()), strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=names)

    return spread.mapInArrow(run, schema)


LEDGER = "key string, output string, error string, attempts int"


def ledger_of(spark: SparkSession, folder: str) -> DataFrame:
    """What a ledger holds: one row per key, an answer before any error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    best = F.min_by(F.struct("output", "error", "attempts"), F.col("error").isNotNull())
    return spark.read.schema(LEDGER).parquet(folder).groupBy("key").agg(best.alias("_b")).select("key", "_b.*")


def generate_with_ledger(
    prompts: DataFrame,
    fn: Generator,
    ledger: str,
    *,
    key: str,
    prompt: str,
    tasks: int,
    threads: int = 1,
    retries: int = 3,
    timeout: float | None = None,
    batch: int = 32,
) -> DataFrame:
    """``generate`` whose answers are kept: what ``ledger`` has an answer for is not asked again.

    ``ledger`` is a folder that all executors share. Every ``batch`` of answers goes there as a file of its own before the
    next one is asked, so a call that breaks off, a lost executor or a killed job loses the answers of one open batch
    a task at most, and the next call goes on from there. Keys that only have an error are asked again. ``key`` is cast to
    a string; of rows with one key the prompt that sorts first is asked, and all get its answer. Rows without a key are not asked.
    """
    spark = prompts.sparkSession
    root = listable(qualified(spark, ledger)).rstrip("/")
    known = ledger_of(spark, ledger).where("error is null").select("key")
    asked = prompts.select(F.col(key).cast("string").alias("key"), F.col(prompt).alias("prompt")).where("key is not null")
    asked = asked.groupBy("key").agg(F.min("prompt").alias("prompt")).join(known, "key", "left_anti")
    attempt = _attempts(fn, retries, timeout)
    kinds = pa.schema([("key", pa.string()), ("output", pa.string()), ("error", pa.string()), ("attempts", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        system, folder, _ = _open(root)
        system.create_dir(folder, recursive=True)

        def answered(rows: list[dict]) -> int:
            keys = [r["key"] for r in rows]
            name = hashlib.sha256("\0".join(keys).encode()).hexdigest()
            target, work = f"{folder}/answers-{name}.parquet", f"{folder}/_{name}-{uuid.uuid4().hex}"
            # a task that runs again meets the same rows in the same order, and finds what it has done
            if system.get_file_info(target).type.name != "File" or pq.read_table(target, filesystem=system)["error"].null_count < len(rows):
                found = list(pool.map(attempt, (r["prompt"] for r in rows)))
                columns = [keys, *(list(c) for c in zip(*found, strict=True))]
                table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
                pq.write_table(table, work, filesystem=system)
                system.move(work, target)
            return len(rows)

        with ThreadPoolExecutor(threads) as pool:
            held: list[dict] = []
            done = 0
            for rows in batches:
                held += rows.to_pylist()
                while len(held) >= batch:
                    done += answered(held[:batch])
                    held = held[batch:]
            if held:
                done += answered(held)
            yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["n"])

    asked.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(run, "n bigint").agg(F.sum("n")).collect()
    found = ledger_of(spark, ledger).withColumnRenamed("key", "_key")
    return prompts.join(found, F.col(key).cast("string") == F.col("_key"), "left").drop("_key")
