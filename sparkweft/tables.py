"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_own_folder: dict[str, str] = {}
_made: dict[str, list[str]] = {}
_inside: ContextVar[list[str] | None] = ContextVar("inside", default=None)
_group: ContextVar[int | None] = ContextVar("group", default=None)
#: Whether Spark deletes a query's shuffle files when the query ends; else they stay until the driver collects its garbage.
SWEEP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder, as the session names it in spark.checkpoint.dir.

    Where the setting is missing, a local session (one process, as in tests) gets a temporary folder;
    a cluster has no such fallback and must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        folder = tempfile.mkdtemp(prefix="sparkweft-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folder[app] = "file://" + folder
    return _own_folder[app]


def fresh_dir(spark: SparkSession, what: str) -> str:
    """A path of the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    if (inside := _inside.get()) is not None:
        inside.append(path)
    return path


def mark(spark: SparkSession) -> int:
    """How many paths the application has made in the shared folder so far."""
    return len(_made.get(spark.sparkContext.applicationId, []))


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Removes what the application made in the shared folder since a mark, but for the last keep paths.

    Frames that still read a removed table fail, so this is for the caller who knows that results are written.
    """
    paths = _made.get(spark.sparkContext.applicationId, [])
    _delete(spark, paths[since : len(paths) - keep])
    paths[since : len(paths) - keep] = []


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def passing(spark: SparkSession, keep: int = 1) -> Iterator[None]:
    """At its end, removes what this thread made inside it in the shared folder, but for the last keep paths.

    For the steps of an operator, where it is known which table the next step reads.
    """
    outer, paths = _inside.get(), []
    token = _inside.set(paths)
    try:
        yield
    finally:
        _inside.reset(token)
        gone = paths[: len(paths) - keep]
        _delete(spark, gone)
        every = _made.get(spark.sparkContext.applicationId, [])
        every[:] = [p for p in every if p not in gone]
        if outer is not None:
            outer += paths[len(paths) - keep :]


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries that run inside go when they end. For writes: their results need no shuffle file."""
    before = spark.conf.get(SWEEP, None)
    spark.conf.set(SWEEP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SWEEP)
        else:
            spark.conf.set(SWEEP, before)


@contextmanager
def grouped(size: int) -> Iterator[None]:
    """Tables that are written inside end a row group at so many bytes, checked each 100 rows. For long rows: a reader holds up to a group at once."""
    token = _group.set(size)
    try:
        yield
    finally:
        _group.reset(token)


def written(df: DataFrame, what: str) -> DataFrame:
    """The frame as a table of the shared folder: cuts lineage, is computed once however often it is read, and survives the loss of any executor."""
    path = fresh_dir(df.sparkSession, what)
    size = _group.get()
    with swept(df.sparkSession):
        (df.write if size is None else df.write.option("parquet.block.size", size)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame) -> DataFrame:
    """df, for a scan in Python: the session's Arrow batches have 4 MB at most, or a row, unless it sets a bound itself."""
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(key, None) is None:
        conf.set(key, "4m")
    return df
