"""A data source for Arrow IPC stream files: `spark.read.format("arrow_stream").load(folder)`.

One partition a file, in order of name; record batches go to Spark as they are. With skip_bad (the default) a file
that cannot be read on is logged and its remaining rows are skipped. Rows get `file` and `row_index`.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructType

log = logging.getLogger(__name__)


def _files(path: str) -> tuple[object, list[str]]:
    from pyarrow import fs

    system, folder = fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
    found = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return system, sorted(f.path for f in found if f.is_file and f.path.endswith(".arrow"))


class ArrowStream(DataSource):
    @classmethod
    def name(cls) -> str:
        return "arrow_stream"

    def schema(self) -> StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        system, files = _files(self.options["path"])
        if not files:
            return StructType()
        out, skip_bad = StructType(), self.options.get("skip_bad", "true").lower() == "true"
        for file in files:  # of the first that can be read
            try:
                with system.open_input_stream(file) as f:
                    out = from_arrow_schema(pa.ipc.open_stream(f).schema)
                break
            except (OSError, pa.ArrowException):
                if not skip_bad:
                    raise
                log.exception("%s: no schema", file)
        return out.add("file", StringType()).add("row_index", LongType())

    def reader(self, schema: StructType) -> DataSourceReader:
        return ArrowStreamReader(self.options["path"], self.options.get("skip_bad", "true").lower() == "true")


class ArrowStreamReader(DataSourceReader):
    def __init__(self, path: str, skip_bad: bool) -> None:
        self.path, self.skip_bad = path, skip_bad

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(f) for f in _files(self.path)[1]] or [InputPartition(None)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if partition.value is None:
            return
        system, first = _files(self.path)[0], 0
        try:
            with system.open_input_stream(partition.value) as f:
                for batch in pa.ipc.open_stream(f):
                    n = len(batch)
                    batch = batch.append_column("file", pa.array([partition.value] * n, pa.string()))
                    yield batch.append_column("row_index", pa.array(range(first, first + n), pa.int64()))
                    first += n
        except (OSError, pa.ArrowException):
            if not self.skip_bad:
                raise
            log.exception("%s: skipped after %s rows", partition.value, first)


def read_arrow(spark: SparkSession, path: str, skip_bad: bool = True) -> DataFrame:
    spark.dataSource.register(ArrowStream)
    return spark.read.format("arrow_stream").option("skip_bad", str(skip_bad).lower()).load(path)
