"""What the operators of this subpackage share: the shared folder, written tables and size-checked broadcasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from ..tables import fresh_dir, swept

#: The word pattern of the contracts: runs of anything but blank, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"

#: A side of at most this many bytes may be broadcast; beyond it joins shuffle.
BROADCAST_BYTES = 16 << 20

#: Bytes of one Arrow batch between Spark and Python; Spark's own default would let a task hold several times 64 MB.
BATCH_BYTES = "4m"


def bounded(df: DataFrame) -> DataFrame:
    """df, for a scan in Python: the session's Arrow batches are bounded by BATCH_BYTES unless it sets a bound itself.

    Batches have at least a row, so a very long text still goes whole.
    """
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(key, None) is None:
        conf.set(key, BATCH_BYTES)
    return df


@contextmanager
def _by_size(spark: SparkSession):
    """Inside, adaptive execution joins small partitions up to the advised size, also where that leaves fewer than cores: narrow tables become few files."""
    key = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, what: str, files: int | None = None) -> DataFrame:
    """The frame as a table of the shared folder: cuts lineage and survives the loss of any executor. files bounds the tasks that write it, where the rows are known to be few for each."""
    path = fresh_dir(df.sparkSession, what)
    with _by_size(df.sparkSession), swept(df.sparkSession):
        (df.coalesce(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int) -> DataFrame:
    """Hints a broadcast if the frame's counted rows are within BROADCAST_BYTES, else leaves the join to shuffle.

    Counts, so the frame should be a written table or a cheap aggregate of one.
    """
    most = BROADCAST_BYTES // row_bytes
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def free_prefix(docs: DataFrame) -> str:
    """A prefix with which no column of docs starts, in any case: columns named with it clash with none of them."""
    names, out = [c.lower() for c in docs.columns], "_"
    while any(n.startswith(out) for n in names):
        out += "_"
    return out


def own(docs: DataFrame) -> list[Column]:
    """The columns of docs as they are, whatever characters their names have."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def extended(docs: DataFrame, column: str, fields: Sequence[tuple[str, DataType]], of: Callable[[list], list[pa.Array]]) -> DataFrame:
    """docs with more columns, which of() computes from lists of a column's values, by Arrow batches.

    Columns named like one of fields are replaced; all others stay, whatever their names: in Python they go by number.
    """
    new = {name.lower() for name, _ in fields}
    kept = [(c, name) for c, name in zip(own(docs), docs.columns, strict=True) if name.lower() not in new]
    numbered = docs.select(*(c.alias(f"c{i}") for i, (c, _) in enumerate(kept)))
    at = [name.lower() for _, name in kept].index(column.lower())
    names = [f"c{i}" for i in range(len(kept) + len(fields))]
    schema = StructType([*numbered.schema.fields, *(StructField(names[len(kept) + i], kind) for i, (_, kind) in enumerate(fields))])

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, *of(batch.column(at).to_pylist())], names=names)

    return bounded(numbered).mapInArrow(go, schema).toDF(*(name for _, name in kept), *(name for name, _ in fields))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
