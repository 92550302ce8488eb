"""The parser as one call: directories in, frames and a report out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G
from scoreloom.operators.adapters import DEFAULT_ADAPTERS, Adapter
from scoreloom.operators.registry import Registry
from scoreloom.session import ensure_conf, materialize
from scoreloom.sources.scan import scan_documents


@dataclass(frozen=True)
class ParsedRun:
    """Frames over one stored extraction."""

    outcomes: DataFrame
    stored: bool = True

    @property
    def results(self) -> DataFrame:
        return X.results(self.outcomes)

    @property
    def rejects(self) -> DataFrame:
        return X.rejects(self.outcomes)

    @property
    def grouped(self) -> DataFrame:
        return G.grouped(self.results)

    @property
    def runs(self) -> DataFrame:
        return G.runs(self.results)

    @property
    def metrics_long(self) -> DataFrame:
        return G.metrics_long(self.results)

    @property
    def totals(self) -> DataFrame:
        return G.totals(self.outcomes)

    @property
    def unique_names(self) -> DataFrame:
        return G.unique_names(self.results)

    def write_report(self, output_dir: str, **options) -> str:
        from scoreloom.sources.report import write_report

        return write_report(self.outcomes, output_dir, **{"stored": self.stored} | options)


def parse_documents(
    docs: DataFrame,
    *,
    registry: Registry | None = None,
    adapters: Sequence[Adapter] = DEFAULT_ADAPTERS,
    metrics: str = "registry",
    on_bad: str = "quarantine",
    store: bool = True,
) -> ParsedRun:
    """Extract documents; with ``store`` they are parsed once for all frames.

    ``on_bad="fail"`` makes the first refused document fail the job instead of
    landing in ``rejects``.
    """
    if on_bad not in ("quarantine", "fail"):
        raise ValueError("on_bad must be 'quarantine' or 'fail'")
    ensure_conf(docs.sparkSession)
    outcomes = X.extract(docs, registry=registry, adapters=adapters, metrics=metrics)
    if on_bad == "fail":
        outcomes = X.fail_on_rejects(outcomes)
    return ParsedRun(materialize(outcomes, "outcomes") if store else outcomes, store)


def parse(spark: SparkSession, directories: Sequence[str], *, leftovers: bool = True, **options) -> ParsedRun:
    """Scan the directories and extract what is found.

    ``leftovers=False`` passes over hidden and empty files, as Spark's own sources do.
    """
    ensure_conf(spark)
    return parse_documents(scan_documents(spark, directories, leftovers=leftovers), **options)
