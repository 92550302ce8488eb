"""scoreloom: evaluation-result analytics on Spark DataFrames."""

from scoreloom.operators.adapters import LIGHTEVAL, LM_EVAL, Adapter, ParamField
from scoreloom.operators.extract import extract, rejects, results
from scoreloom.operators.grouping import group_stats, grouped, metrics_long
from scoreloom.operators.registry import DEFAULT_REGISTRY
from scoreloom.pipeline import parse
from scoreloom.session import build_session, ensure_conf
from scoreloom.sources.scan import documents_from_table, scan_documents

__all__ = [
    "Adapter",
    "DEFAULT_REGISTRY",
    "LIGHTEVAL",
    "LM_EVAL",
    "ParamField",
    "build_session",
    "documents_from_table",
    "ensure_conf",
    "extract",
    "group_stats",
    "grouped",
    "metrics_long",
    "parse",
    "rejects",
    "results",
    "scan_documents",
]
