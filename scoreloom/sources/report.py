"""The JSON report, written as sorted lines.

The report nests all runs of a group in one array, and one group may hold a third of
all runs. So no row ever holds a group: every run, every metric and every opening or
closing piece is a line of text with a sort position, and the lines in order are the
document. Separating commas stand at the start of a line.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scoreloom.operators import extract as X
from scoreloom.operators import grouping as G
from scoreloom.session import materialize

PARSER_VERSION = "1.0"
_JSON = {"ignoreNullFields": "false"}
_POSITION = ["section", "group_path", "group_ord", "part", "name", "ord"]


def write_report(
    outcomes: DataFrame,
    output_dir: str,
    *,
    stored: bool = True,
    layout: str = "file",
    now: datetime | None = None,
) -> str:
    """Write ``parsed_results_<UTC time>.json`` and return its path.

    The lines are sorted in ranges and written by many tasks. ``layout="parts"`` leaves a directory of part
    files which, concatenated in name order, are the document; ``"file"`` joins them to one: where the file system
    can join files by their blocks that moves no bytes, elsewhere they are streamed, one after the other. Pass ``stored=False`` for outcomes that are not backed by a
    table yet.
    """
    if layout not in ("file", "parts"):
        raise ValueError("layout must be 'file' or 'parts'")
    spark = outcomes.sparkSession
    if not stored:
        outcomes = materialize(outcomes, "outcomes")
    now = now or datetime.now(timezone.utc)
    target = f"{output_dir.rstrip('/')}/parsed_results_{now:%Y%m%d_%H%M%S}.json"
    lines = report_lines(outcomes, now)
    fs, path = _hadoop(spark, target)
    fs.delete(path, True)  # a report of the same second is replaced
    ordered = lines.orderBy(*_POSITION).select("text").write.mode("overwrite")
    if layout == "parts":
        ordered.text(target)
        return target
    work = f"{output_dir.rstrip('/')}/_report_{now:%Y%m%d_%H%M%S%f}"
    ordered.text(work)
    _concatenate(spark, work, target)
    fs.delete(_hadoop(spark, work)[1], True)
    return target


def _concatenate(spark, parts_dir: str, target: str) -> None:
    """Part files in name order as one file: joined by the file system, or else copied a buffer at a time."""
    fs, path = _hadoop(spark, target)
    parts = sorted(s.getPath().toString() for s in fs.globStatus(_hadoop(spark, f"{parts_dir}/part-*")[1]))
    if fs.hasPathCapability(path, "fs.capability.paths.concat") and parts:
        paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts))
        for i, part in enumerate(parts):
            paths[i] = _hadoop(spark, part)[1]
        fs.create(path, True).close()
        fs.concat(path, paths)
        return
    out = fs.create(path, True)
    try:
        for part in parts:
            source = fs.open(_hadoop(spark, part)[1])
            try:
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
            finally:
                source.close()
    finally:
        out.close()


def read_report(spark, report: str, position: bool = False) -> DataFrame:
    """The lines of a report of either layout, as ``text``; with ``position`` also ``file`` and ``line``, by which they sort."""
    lines = spark.read.text(report)
    if not position:
        return lines.select(F.col("value").alias("text"))
    # numbers grow within a file, which is read in pieces from front to back
    place = [F.col("_metadata.file_name").alias("file"), F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("line")]
    return lines.select(F.col("value").alias("text"), *place)


def _hadoop(spark, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def report_lines(outcomes: DataFrame, now: datetime) -> DataFrame:
    """Lines of the report with their sort position."""
    results = X.results(outcomes)
    groups = materialize(G.group_rows(results), "report-groups")
    seen = groups.select(*G.GROUP, "first_seen")
    # the group that comes first goes without a comma
    ranked = groups.withColumn("first", groups.agg(F.min("first_seen")).scalar())

    body = (
        _group_lines(ranked)
        .unionByName(_metric_lines(results, seen))
        .unionByName(_run_lines(results, seen))
    )
    return body.unionByName(_frame_lines(outcomes, results, now)).select(*_POSITION, "text")


def _lines(df: DataFrame, section: int | Column, part: int | Column, text: Column, **place: Column) -> DataFrame:
    """``df`` as lines; missing pieces of the position sort first."""
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.select(
        as_column(section).cast("int").alias("section"),
        place.get("group_path", F.lit(None)).cast("string").alias("group_path"),
        place.get("group_ord", F.lit(None)).cast("int").alias("group_ord"),
        as_column(part).cast("int").alias("part"),
        place.get("name", F.lit(None)).cast("string").alias("name"),
        place.get("ord", F.lit(None)).cast("int").alias("ord"),
        text.alias("text"),
    )


def _comma(needed: Column) -> Column:
    return F.when(needed, F.lit(",")).otherwise(F.lit(""))


def _finite(value: Column) -> Column:
    """JSON has no NaN."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def _mean_std(mean: Column, std: Column) -> Column:
    return F.struct(_finite(mean).alias("mean"), _finite(std).alias("std"))


def _json_text(value: Column) -> Column:
    """A scalar as JSON, through a one-field object."""
    return F.regexp_extract(F.to_json(F.struct(value.alias("v")), _JSON), r'(?s)^\{"v":(.*)\}$', 1)


def _group_lines(groups: DataFrame) -> DataFrame:
    duration = F.col("evaluation_duration_seconds")
    head = F.to_json(
        F.struct("task_name", "model_name", "inference_parameters", "num_repetitions"), _JSON
    )
    opening = F.concat(
        _comma(F.col("first_seen") != F.col("first")),
        F.regexp_replace(head, r"\}$", ""),
        F.lit(',"aggregate_stats":{"evaluation_duration_seconds":'),
        F.to_json(_mean_std(duration["mean"], duration["std"]), _JSON),
        F.lit(',"metrics":{'),
    )
    pieces = F.array(
        F.struct(F.lit(0).alias("part"), opening.alias("line")),
        F.struct(F.lit(2).alias("part"), F.lit('}},"runs":[').alias("line")),
        F.struct(F.lit(4).alias("part"), F.lit("]}").alias("line")),
    )
    return _lines(
        groups.select("first_seen", F.inline(pieces)),
        1,
        F.col("part"),
        F.col("line"),
        group_path=F.col("first_seen.path"),
        group_ord=F.col("first_seen.task_ord"),
    )


def _place_of_group(rows: DataFrame, seen: DataFrame) -> DataFrame:
    return rows.join(seen, G.same_group(rows, seen)).drop(*(seen[name] for name in G.GROUP))


def _metric_lines(results: DataFrame, seen: DataFrame) -> DataFrame:
    stats = G.group_stats(G.metrics_long(results))
    # rows here are metric names of one task and model
    order = W.partitionBy(*G.GROUP).orderBy("metric")
    placed = _place_of_group(stats.withColumn("_rank", F.row_number().over(order)), seen)
    entry = F.struct(
        _mean_std(F.col("value_mean"), F.col("value_std")).alias("value"),
        _mean_std(F.col("stderr_mean"), F.col("stderr_std")).alias("stderr"),
    )
    text = F.concat(
        _comma(F.col("_rank") > 1), _json_text(F.col("metric")), F.lit(":"), F.to_json(entry, _JSON)
    )
    return _lines(
        placed, 1, 1, text,
        group_path=F.col("first_seen.path"), group_ord=F.col("first_seen.task_ord"), name=F.col("metric"),
    )


def _run_lines(results: DataFrame, seen: DataFrame) -> DataFrame:
    placed = _place_of_group(G.runs(results), seen)
    run = F.struct(
        "source_filename",
        _finite(F.col("evaluation_datetime")).alias("evaluation_datetime"),
        "evaluation_datetime_iso",
        _finite(F.col("evaluation_duration_seconds")).alias("evaluation_duration_seconds"),
        F.transform_values(
            "metrics",
            lambda _, m: F.struct(_finite(m["value"]).alias("value"), _finite(m["stderr"]).alias("stderr")),
        ).alias("metrics"),
    )
    later = G.position() != F.col("first_seen")
    return _lines(
        placed, 1, 3, F.concat(_comma(later), F.to_json(run, _JSON)),
        group_path=F.col("first_seen.path"), group_ord=F.col("first_seen.task_ord"),
        name=F.col("path"), ord=F.col("task_ord"),
    )


def _frame_lines(outcomes: DataFrame, results: DataFrame, now: datetime) -> DataFrame:
    """Opening and closing of the document and its metadata."""
    head = F.concat(
        F.lit('],"metadata":{'),
        F.lit(f'"parser_version":"{PARSER_VERSION}","parse_datetime":"{now.isoformat()}",'),
        F.format_string(
            '"total_results_parsed":%d,"total_files_parsed":%d,"unique_tasks":[',
            "total_results_parsed",
            "total_files_parsed",
        ),
    )
    fixed = F.array(
        F.struct(F.lit(0).alias("section"), F.lit('{"results":[').alias("line")),
        F.struct(F.lit(2).alias("section"), head.alias("line")),
        F.struct(F.lit(4).alias("section"), F.lit('],"unique_models":[').alias("line")),
        F.struct(F.lit(6).alias("section"), F.lit("]}}").alias("line")),
    )
    frame = _lines(
        materialize(G.totals(outcomes), "report-totals").select(F.inline(fixed)), F.col("section"), F.lit(0), F.col("line")
    )
    names = materialize(G.unique_names(results), "report-names")
    # two rows: the first task and the first model
    firsts = names.groupBy("kind").agg(F.min("name").alias("first"))
    listed = names.join(F.broadcast(firsts), "kind")
    section = F.when(F.col("kind") == "task", 3).otherwise(5)
    text = F.concat(_comma(F.col("name") != F.col("first")), _json_text(F.col("name")))
    return frame.unionByName(_lines(listed, section, F.lit(0), text, name=F.col("name")))
