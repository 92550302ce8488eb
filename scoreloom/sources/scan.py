"""Result documents from directories or tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.scalars import base_name, decoded_path
from scoreloom.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

SUFFIX = ".json"


def scan_documents(
    spark: SparkSession, directories: Sequence[str], *, leftovers: bool = True
) -> DataFrame:
    """Every ``*.json`` below the directories as ``(path, source_filename, content)``.

    A missing directory raises FileNotFoundError, a plain file NotADirectoryError.
    Spark's file sources pass over hidden names and empty files; ``leftovers`` lists
    the directories once more, in tasks, and adds those.
    """
    directories = list(directories)
    for directory in directories:
        check_directory(spark, directory)
    if not directories:
        return spark.createDataFrame([], "path string, source_filename string, content string")
    files = (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{SUFFIX}")
        .text([_no_glob(directory) for directory in directories])
        .select(decoded_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content"))
    )
    if leftovers:
        files = files.unionByName(passed_over(spark, directories))
    return _with_name(files)


def documents_from_table(df: DataFrame, path: str | Column = "path", content: str | Column = "content") -> DataFrame:
    """Documents kept as rows of a table, the form to prefer for very many small files."""
    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    return _with_name(df.select(as_column(path).alias("path"), as_column(content).alias("content")))


def _with_name(files: DataFrame) -> DataFrame:
    return files.select("path", base_name(F.col("path")).alias("source_filename"), "content")


def check_directory(spark: SparkSession, directory: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"nothing to scan at {directory}")
    if not fs.getFileStatus(path).isDirectory():
        raise NotADirectoryError(f"{directory} is a file, a folder is needed")


def _no_glob(directory: str) -> str:
    """Escape characters the reader would take for a pattern."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in directory)


def qualified(spark: SparkSession, directory: str) -> str:
    """The address with the file system that Spark takes it to be on."""
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


# Hadoop's schemes, and those under which the listing in tasks knows the same stores.
_SCHEMES = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def listable(uri: str) -> str:
    """``uri`` itself, if tasks can list and write there."""
    scheme = uri.partition(":")[0]
    if scheme not in _SCHEMES:
        raise ValueError(f"tasks cannot list {scheme}: addresses; scan with leftovers=False")
    return uri


def passed_over(spark: SparkSession, directories: Sequence[str]) -> DataFrame:
    """``(path, content)`` of hidden and of empty documents.

    Directories are listed in tasks, level by level: what one level finds is spread over the cluster anew for
    the next. Each level is a table in the shared folder.
    """
    roots = dict.fromkeys(listable(qualified(spark, d)) for d in directories)
    level = spark.createDataFrame([(d, False) for d in roots], "dir string, hidden boolean")
    found = spark.createDataFrame([], "path string, content binary")
    while True:
        listed = level.repartition("dir").mapInPandas(_list_one_level, "dir string, hidden boolean, path string, content binary")
        listed = materialize(listed, "listing")
        found = found.unionByName(listed.where(F.col("path").isNotNull()).select("path", "content"))
        level = listed.where(F.col("dir").isNotNull()).select("dir", "hidden").distinct()
        if level.isEmpty():
            break
    # overlapping roots meet the same file twice
    return found.dropDuplicates(["path"]).select("path", F.col("content").cast("string").alias("content"))


def _is_hidden(name: str, is_directory: bool) -> bool:
    """Names that Spark's file index leaves out."""
    if is_directory and name.startswith(("_common_metadata", "_metadata")):
        return False  # listed, though files of such names are not taken for data
    return (name.startswith("_") and "=" not in name) or name.startswith(".") or name.endswith("._COPYING_")


def _open(uri: str):
    """File system, path in it, and the prefix that turns such paths into URIs again."""
    from pyarrow import fs

    if uri.startswith(("/", "file:")):
        return fs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/"), ""
    scheme, _, rest = uri.partition(":")
    system, path = fs.FileSystem.from_uri(f"{_SCHEMES[scheme]}:{rest}")
    return system, path, uri[: len(uri) - len(path.rstrip("/"))] if path else uri


def _entries(uri: str, hidden: bool):
    """Children of one directory: ``(subdirectory, hidden)`` and documents passed over."""
    from pyarrow import fs

    system, path, prefix = _open(uri)
    for info in system.get_file_info(fs.FileSelector(path, recursive=False)):
        concealed = hidden or _is_hidden(info.base_name, info.type == fs.FileType.Directory)
        if info.type == fs.FileType.Directory:
            yield prefix + info.path, concealed, None, None
        elif info.type == fs.FileType.File and info.base_name.endswith(SUFFIX):
            if info.size == 0:
                yield None, concealed, prefix + info.path, b""
            elif concealed:
                with system.open_input_stream(info.path) as stream:
                    yield None, concealed, prefix + info.path, stream.read()


#: Bytes of content held before a batch of rows goes out.
_HELD = 8 << 20


def _list_one_level(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["dir", "hidden", "path", "content"]
    for batch in batches:
        rows, size = [], 0
        for uri, hidden in batch.itertuples(index=False):
            for row in _entries(uri, hidden):
                rows.append(row)
                size += 200 + len(row[3] or b"")
                if size > _HELD:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
        yield pd.DataFrame(rows, columns=columns).astype({"hidden": "bool"})
