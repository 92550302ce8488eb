"""Registry of the named queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scoreloom.session import ensure_conf, spread

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the same question in DuckDB SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(ensure_conf(spark), sf_dir)

        CATALOG[fn.__name__] = Entry(run, sql)
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def work_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows take much work each, in as many pieces as ``spark.scoreloom.pieces`` asks for, if it is set."""
    pieces = spark.conf.get("spark.scoreloom.pieces", None)
    return spread(table(spark, sf_dir, name), int(pieces) if pieces else None)
