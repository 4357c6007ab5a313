"""Media columns: content-addressed payloads in tar shards, with digest, offset and length in the rows.

A payload is stored once, as the member <sha256 of the payload>.png of some shard: an 8-bit greyscale image of
64 samples a line. Rows keep the payload's digest; the index has each digest's shard, offset and length of the
stored bytes. Metadata columns come from reads of the first HEADER bytes of a member, features
from reads of whole members, coalesced where members are neighbours.

To store equal texts once without moving texts about, the texts that occur twice are found by digest, and of
those only the row with the least doc_id is stored. Should several rows have it, or none a doc_id, the
index takes one of the copies.

Defined results: null text counts as empty and gives 64 zero bytes; repeated rows and equal texts get equal values;
an empty table gives an empty result. Other columns are left to the caller.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..tables import fresh_dir
from .shared import bounded, small, written
from .stores import Reader, Writer, dealt

LINE = 64
#: Text that one task stores at least, if there are tasks for all cores: fewer and larger shards.
TASK_BYTES = 128 << 20
#: Signature and IHDR of a PNG: all that metadata columns need.
HEADER = 33
SIGNATURE = b"\x89PNG\r\n\x1a\n"


def payload(text: str | None) -> bytes:
    """A text's UTF-8 with zero bytes up to a positive multiple of LINE."""
    data = (text or "").encode("utf-8", "replace")
    return data + bytes(-len(data) % LINE if data else LINE)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def image(data: bytes) -> bytes:
    """The payload as a PNG, one sample a byte."""
    lines = np.frombuffer(data, np.uint8).reshape(-1, LINE)
    raw = np.hstack([np.zeros((len(lines), 1), np.uint8), lines]).tobytes()
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", LINE, len(lines), 8, 0, 0, 0, 0)) + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")


def header(data: bytes) -> tuple[int, int, int]:
    """Width, height and bit depth, from the first HEADER bytes."""
    if data[:8] != SIGNATURE or data[12:16] != b"IHDR" or zlib.crc32(data[12:29]) != struct.unpack(">I", data[29:33])[0]:
        raise ValueError("not a PNG")
    return struct.unpack(">IIB", data[16:25])


def samples(data: bytes) -> bytes:
    """The payload of an image that image() made."""
    width, height, _ = header(data[:HEADER])
    at, packed = HEADER, []
    while at < len(data):
        (n,), kind = struct.unpack(">I", data[at : at + 4]), data[at + 4 : at + 8]
        if kind == b"IDAT":
            packed.append(data[at + 8 : at + 8 + n])
        at += n + 12
    lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(height, width + 1)
    if lines[:, 0].any():
        raise ValueError("a filter that image() doesn't use")
    return lines[:, 1:].tobytes()


def member_header(name: str, size: int) -> bytes:
    """The ustar header of a regular file."""
    block = bytearray(512)
    size_field = f"{size:011o}\0".encode() if size < 1 << 33 else b"\x80" + size.to_bytes(11, "big")
    for at, field in ((0, name.encode()), (100, b"0000644\0"), (108, b"0000000\0"), (116, b"0000000\0"), (124, size_field), (136, b"00000000000\0"), (148, b" " * 8), (156, b"0"), (257, b"ustar\x0000")):
        block[at : at + len(field)] = field
    block[148:156] = f"{sum(block):06o}\0 ".encode()
    return bytes(block)


def feature(data: bytes) -> str:
    """Mean, deviation and entropy of the samples, and their shares in eight equal ranges."""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts / len(data)
    value = np.arange(256)
    mean = float(share @ value)
    some = share[share > 0]
    parts = [mean, float(np.sqrt(max(share @ value**2 - mean**2, 0))), float(-(some @ np.log2(some))), *share.reshape(8, 32).sum(axis=1)]
    return ",".join(f"{x:.6f}" for x in parts)


def payload_digest(text: Column) -> Column:
    """The digest of a text's payload."""
    data = F.encode(F.coalesce(text, F.lit("")), "utf-8")
    n = F.length(data)
    zeros = F.when(n == 0, F.lit(LINE)).otherwise(F.pmod(-n, F.lit(LINE)))
    return F.sha2(F.concat(data, F.substring(F.lit(bytes(LINE)), F.lit(1), zeros)), 256)


def stored(docs: DataFrame) -> DataFrame:
    """Stores the payloads of docs (doc_id, text) in tar shards; the index (payload_sha256, shard, offset, length), one row a payload."""
    folder = fresh_dir(docs.sparkSession, "media")
    rows = docs.select("doc_id", "text", payload_digest(F.col("text")).alias("payload_sha256"))
    again = rows.groupBy(F.col("payload_sha256").alias("_digest")).agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("_digest", "least")
    rows = rows.join(small(written(again, "media-repeated"), 96), F.col("payload_sha256") == F.col("_digest"), "left")
    rows = rows.where(F.col("_digest").isNull() | F.col("doc_id").eqNullSafe(F.col("least"))).select("text", "payload_sha256")

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer(folder, ".tar", bytes(1024))
        for batch in batches:
            shards, offsets, lengths = [], [], []
            for text, digest in zip(batch.column("text"), batch.column("payload_sha256"), strict=True):
                data = image(payload(text.as_py()))
                shard, offset = out.add(member_header(f"{digest.as_py()}.png", len(data)) + data + bytes(-len(data) % 512))
                shards.append(shard)
                offsets.append(offset + 512)
                lengths.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column("payload_sha256"), pa.array(shards, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["payload_sha256", "shard", "offset", "length"])
        out.close()

    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    tasks = max(2 * docs.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_BYTES))
    index = written(bounded(rows).mapInArrow(go, "payload_sha256 string, shard string, offset long, length long"), "media-index", int(tasks))
    one = index.groupBy("payload_sha256").agg(F.min(F.struct("shard", "offset", "length")).alias("at"))  # of a table, so cheap to make again
    return one.select("payload_sha256", "at.shard", "at.offset", "at.length")


def _with_reads(index: DataFrame, fields: list[tuple[str, str, pa.DataType]], of, head: int | None) -> DataFrame:
    """An index in reading order with more columns: of() gives their values for a member's bytes, or the first head of them."""
    schema = index.select("*", *(F.lit(None).cast(kind).alias(name) for name, kind, _ in fields)).schema

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                wanted = list(zip(part.column("shard").to_pylist(), part.column("offset").to_pylist(), (head or n for n in part.column("length").to_pylist()), strict=True))
                found = [of(x) for x in (reader.blobs(wanted) if head is None else (reader.read(*w) for w in wanted))]
                more = [pa.array([x[k] for x in found], kind) for k, (_, _, kind) in enumerate(fields)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], names=[*part.schema.names, *(n for n, _, _ in fields)])
        reader.close()

    return index.mapInArrow(go, schema)


def metadata(index: DataFrame) -> DataFrame:
    """An index with width, height and bit_depth, from header-only range reads."""
    return _with_reads(dealt(index, "shard"), [("width", "int", pa.int32()), ("height", "int", pa.int32()), ("bit_depth", "int", pa.int32())], header, HEADER)


def _features(blob: bytes) -> tuple:
    data = samples(blob)
    return len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-LINE:]), len(blob), hashlib.sha256(blob).hexdigest(), feature(data)


def features(index: DataFrame) -> DataFrame:
    """An index (as stored or metadata return it) with what whole members show: payload_bytes, read_sha256, tail_crc32, media_bytes, media_sha256, feature."""
    fields = [("payload_bytes", "long", pa.int64()), ("read_sha256", "string", pa.string()), ("tail_crc32", "long", pa.int64()), ("media_bytes", "long", pa.int64()), ("media_sha256", "string", pa.string()), ("feature", "string", pa.string())]
    return _with_reads(index if "width" in index.columns else dealt(index, "shard"), fields, _features, None)


def media_rows(docs: DataFrame) -> DataFrame:
    """For each row of docs: doc_id, n_bytes, and its payload's place, metadata and features."""
    found = features(metadata(stored(docs))).withColumnRenamed("payload_sha256", "_digest")
    rows = docs.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), payload_digest(F.col("text")).alias("_own"))
    return rows.join(found, F.col("_own") == F.col("_digest")).drop("_own", "_digest")
