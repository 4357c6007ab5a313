"""Files of the shared folder that tasks write by themselves and read by byte range."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

#: Reads of one file are joined if at most this many bytes lie between them, up to RANGE bytes in all.
GAP = 64 << 10
RANGE = 8 << 20
#: A task starts a new file beyond this size.
FILE_BYTES = 256 << 20


def _opened(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Appends blobs to files of a folder, each of its own name; an attempt that fails leaves files that no index names."""

    def __init__(self, folder: str, ending: str, closing: bytes = b"") -> None:
        self.folder, self.ending, self.closing = folder, ending, closing
        self.stream, self.uri, self.at = None, "", 0

    def add(self, blob: bytes) -> tuple[str, int]:
        """The file's URI and the blob's offset."""
        if self.stream is None or self.at > FILE_BYTES:
            self.close()
            self.uri, self.at = f"{self.folder}/{uuid.uuid4().hex}{self.ending}", 0
            system, path = _opened(self.folder)
            system.create_dir(path, recursive=True)
            self.stream = system.open_output_stream(f"{path}/{self.uri.rpartition('/')[2]}", compression=None)
        offset = self.at
        self.stream.write(blob)
        self.at += len(blob)
        return self.uri, offset

    def close(self) -> None:
        if self.stream is not None:
            self.stream.write(self.closing)
            self.stream.close()
            self.stream = None


class Reader:
    """Reads ranges, keeping the last file open."""

    def __init__(self) -> None:
        self.uri, self.file = "", None

    def read(self, uri: str, offset: int, length: int) -> bytes:
        if uri != self.uri:
            self.close()
            system, path = _opened(uri)
            self.uri, self.file = uri, system.open_input_file(path)
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.uri, self.file = "", None

    def blobs(self, wanted: Sequence[tuple[str, int, int]]) -> Iterator[bytes]:
        """The blobs at (uri, offset, length), which are in order of uri and offset, by coalesced reads."""
        i = 0
        while i < len(wanted):
            uri, start, length = wanted[i]
            end, j = start + length, i + 1
            while j < len(wanted) and wanted[j][0] == uri and start <= wanted[j][1] <= end + GAP and wanted[j][1] + wanted[j][2] - start <= RANGE:
                end = max(end, wanted[j][1] + wanted[j][2])
                j += 1
            data = self.read(uri, start, end - start)
            for _, o, n in wanted[i:j]:
                blob = data[o - start : o - start + n]
                if len(blob) != n:
                    raise EOFError(f"{uri} ends before {o + n}")
                yield blob
            i = j


def dealt(index, file: str, spans_bytes: int = RANGE):
    """An index (file column, offset, length) dealt for reading, each partition in order of file and offset.

    The number of partitions follows the bytes to read, as the rows themselves are too light to show them.
    """
    from pyspark.sql import functions as F

    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(index.sparkSession.sparkContext.defaultParallelism, -(-total // (4 * spans_bytes)))
    spans = index.withColumn("_span", F.floor(F.col("offset") / spans_bytes))
    return spans.repartition(int(parts), file, "_span").sortWithinPartitions(file, "offset").drop("_span")
