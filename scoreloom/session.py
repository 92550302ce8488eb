"""Session settings and the shared work folder."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTINGS = {
    # ISO strings are UTC, and the last of two equal object keys wins.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Every shuffle is re-planned at run time: small partitions are merged,
    # skewed join partitions are split, small sides turn into broadcasts.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods of more bytes than this. Plans here have long projections; as one generated
    # method they would be interpreted for good, while Spark's other form cuts them into small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def ship_with_tasks(module: str) -> None:
    """Send the functions of a module along with the tasks that call them.

    Otherwise a Python worker would import them, and executors need not have this package.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on; call before building a plan on a foreign session."""
    for key, value in _SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "scoreloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above. ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in _SETTINGS.items():
        builder = builder.config(key, value)
    # Plans here have thousands of expressions; no call site is recorded for each.
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return ensure_conf(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="scoreloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def spread(df: DataFrame, pieces: int | None) -> DataFrame:
    """``df`` in that many pieces; as it is without a number.

    For inputs of few splits whose rows take far more work than a move. The caller decides: on a cluster
    the splits of the scan are enough.
    """
    return df.repartition(pieces) if pieces else df


#: Tables written in the innermost open ``scratch``, with their folders.
_WRITTEN: ContextVar[list[tuple[DataFrame, str]] | None] = ContextVar("written", default=None)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several outputs hang off one expensive stage; the written table
    survives the loss of executors, unlike a cache.
    """
    spark = df.sparkSession
    target = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(target)
    stored = spark.read.schema(df.schema).parquet(target)
    if (written := _WRITTEN.get()) is not None:
        written.append((stored, target))
    return stored


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables materialized inside are deleted at the end, but for those passed to the function it gives.

    Kept tables belong to the scratch around it, if there is one. No plan that runs later may read the others.
    """
    outer, own = _WRITTEN.get(), []
    kept: set[int] = set()
    token = _WRITTEN.set(own)

    def keep(stored: DataFrame) -> DataFrame:
        kept.add(id(stored))
        return stored

    try:
        yield keep
    finally:
        _WRITTEN.reset(token)
        for stored, target in own:
            if id(stored) not in kept:
                spark = stored.sparkSession
                path = spark._jvm.org.apache.hadoop.fs.Path(target)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            elif outer is not None:
                outer.append((stored, target))


#: Bytes of a table up to which it is broadcast.
BROADCAST_BYTES = 32 << 20


def broadcast_if_small(stored: DataFrame) -> DataFrame:
    """A hint to broadcast a stored table whose rows, written out, are few enough bytes; without it both sides are shuffled."""
    if 16 * stored.count() > BROADCAST_BYTES:  # no need to write rows out
        return stored
    row = F.octet_length(F.to_json(F.struct("*")))
    size = stored.agg(F.sum(row + 16)).first()[0] or 0
    return F.broadcast(stored) if size <= BROADCAST_BYTES else stored
