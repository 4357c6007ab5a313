"""WARC archives: index first, then coalesced byte-range reads.

Writing tasks put one gzip member per record into archives of the shared folder and return the index:
file, offset, length, URL and payload digest of each record. Reading takes any selection of index
rows, deals them by file and span, sorts them, and joins neighbouring ranges into one read.

Of records with equal payloads of at least REVISIT_BYTES, that with the smallest page_id is a response, the others are revisits
without the payload, which name the response, the digest and, in their HTTP header, the full length.
Only payloads that occur twice matter for that, so the pages are joined with those alone.

Defined results: null html is an empty payload; a null url has no WARC-Target-URI; one that is no valid URI stands there
percent-encoded and is read back as given; a null page_id is left out of the
record's id and read back as null, and never counts as the smallest unless all are null: then all are responses;
rows that repeat the smallest page_id are responses too. An empty table gives an empty index. Other columns are not archived.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..tables import fresh_dir
from .shared import bounded, small, written
from .stores import Reader, Writer, dealt

REVISIT_BYTES = 100
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID = "urn:x-page:"
#: The URL as the page has it, where that is no valid URI.
GIVEN = "X-Given-URL"
INDEX = "page_id long, url string, payload_digest string, record_type string, file string, offset long, length long"


def _id(page_id: int | None) -> str:
    return f"<{ID}{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A response record, or with refers_to a revisit record, as a gzip member."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        target = quote(url, safe=":/?#[]@!$&()*+,;=%~-._")
        lines.append(f"WARC-Target-URI: {target}")
        if target != url:  # JSON is ASCII without line ends, and restores any text
            lines.append(f"{GIVEN}: {json.dumps(url)}")
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is None:
        block += payload
    else:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_id(refers_to)}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def parsed(member: bytes) -> dict:
    """The fields of a record: type, page_id, url, digest, refers_to, payload_bytes, payload (None for a revisit)."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    block = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = int(http.rpartition(b"Content-Length: ")[2])
    number = lambda x: int(x) if (x := x[1:-1].removeprefix(ID)) else None
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != stated or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    refers = number(fields["WARC-Refers-To"]) if "WARC-Refers-To" in fields else None
    return {"record_type": kind, "page_id": number(fields["WARC-Record-ID"]), "url": json.loads(fields[GIVEN]) if GIVEN in fields else fields.get("WARC-Target-URI"), "payload_digest": digest, "refers_to": refers, "payload_bytes": stated, "payload": payload if kind == "response" else None}


def archive(pages: DataFrame, *, date: str = DATE, revisit_bytes: int = REVISIT_BYTES) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html); the index, as a table of the shared folder."""
    spark = pages.sparkSession
    folder = fresh_dir(spark, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "utf-8").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    again = rows.where(F.length("payload") >= revisit_bytes).groupBy(F.col("payload_digest").alias("_digest")).agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("_digest", "first")
    rows = rows.join(small(written(again, "warc-repeated"), 96), F.col("payload_digest") == F.col("_digest"), "left").drop("_digest")
    rows = rows.withColumn("first", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Writer(folder, ".warc.gz")
        for batch in batches:
            kinds, files, offsets, lengths = [], [], [], []
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "payload_digest", "first")]
            for page, url, payload, digest, first in zip(*columns, strict=True):
                refers = first.as_py()
                member = record(page.as_py(), url.as_py(), payload.as_py(), digest.as_py(), refers, date)
                file, offset = out.add(member)
                kinds.append("response" if refers is None else "revisit")
                files.append(file)
                offsets.append(offset)
                lengths.append(len(member))
            yield pa.RecordBatch.from_arrays([columns[0], columns[1], columns[3], pa.array(kinds, pa.string()), pa.array(files, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], names=["page_id", "url", "payload_digest", "record_type", "file", "offset", "length"])
        out.close()

    return written(bounded(rows).mapInArrow(go, INDEX), "warc-index")


def read(selected: DataFrame, *, payloads: bool = True) -> DataFrame:
    """The records that rows of an index name, read from the archives: page_id, url, record_type, payload_digest, payload_bytes, refers_to[, payload]."""
    fields = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long" + ", payload binary" * payloads
    names = [x.split()[0] for x in fields.split(", ")]

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader()
        for batch in batches:
            for i in range(0, len(batch), 512):
                part = batch.slice(i, 512)
                wanted = list(zip(part.column("file").to_pylist(), part.column("offset").to_pylist(), part.column("length").to_pylist(), strict=True))
                found = [parsed(x) for x in reader.blobs(wanted)]
                kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}
                yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in found], kinds.get(n, pa.string())) for n in names], names=names)
        reader.close()

    return bounded(dealt(selected.select("file", "offset", "length"), "file")).mapInArrow(go, fields)
