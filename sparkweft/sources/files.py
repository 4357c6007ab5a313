"""Single files of a run, each written by the task that has its content, and folders."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession, path: str) -> tuple:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cleared(spark: SparkSession, path: str) -> None:
    """Removes a folder with all that is in it."""
    folder, system = _hadoop(spark, path)
    system.delete(folder, True)


def written_files(rows: DataFrame) -> DataFrame:
    """(key, path, bytes, at): writes the content (text or binary) of rows (key, path, content) to the file at path, at seconds since 1970.

    Paths are URIs, or paths of a folder that all executors share. A file appears whole, under its name only when it is complete, so an attempt that
    fails or runs twice harms nothing. The frame is lazy: whoever reads it writes the files.
    """
    kind = rows.schema["key"].dataType.simpleString()
    data = rows.select("key", "path", F.col("content").cast("binary").alias("content")).where("path is not null and content is not null")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            sizes, times = [], []
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                system, place = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
                system.create_dir(place.rpartition("/")[0], recursive=True)
                draft = f"{place}.{uuid.uuid4().hex}.part"
                with system.open_output_stream(draft, compression=None) as f:
                    f.write(content.as_buffer())
                system.move(draft, place)
                sizes.append(len(content.as_buffer()))
                times.append(time.time())
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("path"), pa.array(sizes, pa.int64()), pa.array(times, pa.float64())], names=["key", "path", "bytes", "at"])

    return data.mapInArrow(go, f"key {kind}, path string, bytes long, at double")


def write_dataset(rows: DataFrame, path: str) -> None:
    """Samples by their column split as <path>/split/<name>/*.arrow, the layout that read_dataset takes, replacing what is there."""
    spark = rows.sparkSession
    cleared(spark, f"{path}/split")
    uri = path if "://" in path else "file://" + path
    columns = [c for c in rows.columns if c != "split"]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyspark import TaskContext

        system, place = fs.FileSystem.from_uri(uri)
        out: dict[str, tuple] = {}
        for batch in batches:
            names = batch.column("split").to_pylist()
            for name in dict.fromkeys(names):
                part = pa.table(batch).select(columns).filter(pa.array([n == name for n in names]))
                if name not in out:
                    folder = f"{place}/split/{name}"
                    system.create_dir(folder, recursive=True)
                    target = f"{folder}/{TaskContext.get().partitionId():06d}.arrow"
                    draft = f"{target}.{uuid.uuid4().hex}.part"
                    stream = system.open_output_stream(draft, compression=None)
                    out[name] = (target, draft, stream, pa.ipc.new_stream(stream, part.schema))
                out[name][3].write_table(part)
        for target, draft, stream, writer in out.values():
            writer.close()
            stream.close()
            system.move(draft, target)
        yield pa.record_batch([pa.array([x[0] for x in out.values()], pa.string())], names=["target"])

    rows.where("split is not null").mapInArrow(go, "target string").count()
