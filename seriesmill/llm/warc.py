"""Web archives with an index: write records, then read selected ones by byte range.

``write_archives`` writes one gzip member per record into archive files of the shared
folder and returns the index as a written table: file, offset, length, URL and digest per record.
``read_records`` takes any selection of the index, sorts it by file and offset,
merges near ranges into one read and parses the records.  The index is the only
list of what was written: a task that is repeated writes a file of another name, and
what a lost attempt left behind is in no index row.

Files are opened by pyarrow's file systems (local or mounted folders, HDFS, S3,
GCS), so the shared folder must be of one of these kinds.

Of records with equal payloads of ``min_bytes`` or more, that with the smallest
page_id is the response and the others are revisits of it, without a payload of their own.

Edge cases: a null html is an empty payload.  Rows that share both page_id and payload cannot be
told apart: each smallest one is a response.  A page without id revisits like any other but is never
referred to.  A null url leaves out the target header and comes back as null.
Empty tables give an empty index.  Further columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesmill.session import materialise, scratch_path

FILE_BYTES = 1 << 30  # an archive file is closed beyond this size
GAP_BYTES = 64 << 10  # ranges nearer than this are read at once
RUN_BYTES = 8 << 20  # as long as one read stays below this
SHARE_BYTES = 64 << 20  # stretch of a file that one task reads

INDEX = (
    "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string,"
    " file string, offset long, length long"
)
RECORD = "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def plan_records(pages: DataFrame, min_bytes: int = 100) -> DataFrame:
    """page_id, url, html, payload_bytes, payload_digest, record_type, refers_to."""
    html = F.coalesce("html", F.lit(""))
    sized = pages.select(
        "page_id",
        "url",
        html.alias("html"),
        F.octet_length(html).cast("long").alias("payload_bytes"),
        F.sha2(html, 256).alias("payload_digest"),
    )
    shared = (
        sized.where(F.col("payload_bytes") >= min_bytes)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") > 1) & F.col("_first").isNotNull())
    )
    joined = sized.join(shared, F.col("payload_digest") == F.col("_digest"), "left")
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return joined.select(
        *sized.columns,
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("_first")).alias("refers_to"),
    )


def record_bytes(page_id, url, html, size, digest, kind, refers_to, date: str) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (html.encode("utf-8") if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


# Every printable ASCII character but the percent sign, which marks the quoted ones.
_URL_SAFE = "".join(chr(c) for c in range(33, 127) if chr(c) != "%")


def write_archives(
    pages: DataFrame, folder: str | None = None, min_bytes: int = 100, date: str = "2024-01-01T00:00:00Z"
) -> DataFrame:
    """Write one record per page; returns the index, a written table."""
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    kind = pages.schema["page_id"].dataType
    planned = plan_records(pages, min_bytes).select(
        F.col("page_id").cast("string"),
        "url",
        "html",
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("string"),
    )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        out, name, at = None, "", 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {c: batch.column(c).to_pylist() for c in batch.schema.names}
            files, offsets, lengths = [], [], []
            for row in zip(*(rows[c] for c in _PLANNED)):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    store.create_dir(root, recursive=True)
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                made = record_bytes(*row, date)
                out.write(made)
                files.append(name)
                offsets.append(at)
                lengths.append(len(made))
                at += len(made)
            kept = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")
            arrays = [batch.column(c) for c in kept] + [pa.array(files), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "file", "offset", "length"])
        if out is not None:
            out.close()

    index = materialise(planned.mapInArrow(over, INDEX), "warc-index")
    where = F.concat(F.lit(f"{folder}/"), F.col("file"))
    return index.withColumn("file", where).withColumn("page_id", F.col("page_id").cast(kind))


_PLANNED = ("page_id", "url", "html", "payload_bytes", "payload_digest", "record_type", "refers_to")


def parse_record(member: bytes) -> dict:
    """Fields of one record; the payload is checked against its digest."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    if not version.startswith("WARC/") or len(rest) != int(fields["Content-Length"]) + 4:
        raise ValueError(f"not a whole record: {fields.get('WARC-Record-ID')}")
    http, _, payload = rest[:-4].partition(b"\r\n\r\n")
    size = next(int(x.split(":")[1]) for x in http.decode().split("\r\n") if x.lower().startswith("content-length:"))
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and (len(payload) != size or sha256(payload).hexdigest() != digest):
        raise ValueError(f"payload differs from its digest: {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return {
        "page_id": fields["WARC-Record-ID"][len("<urn:page:") : -1] or None,
        "url": None if url is None else unquote(url),
        "record_type": kind,
        "refers_to": fields["WARC-Refers-To"][len("<urn:page:") : -1] if kind == "revisit" else None,
        "payload_bytes": size,
        "payload_digest": digest,
        "payload": payload if kind == "response" else None,
    }


def _runs(rows: list[tuple[str, int, int]]) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted ranges, in groups that are read at once."""
    run: list = []
    for file, offset, length in rows:
        if run and (file != run[0][0] or offset - (run[-1][1] + run[-1][2]) > GAP_BYTES or offset + length - run[0][1] > RUN_BYTES):
            yield run
            run = []
        run.append((file, offset, length))
    if run:
        yield run


def read_records(index: DataFrame, payload: bool = True) -> DataFrame:
    """The records that ``index`` (or a selection of it) names; ``payload`` may be left out of the result."""
    kind = index.schema["page_id"].dataType

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))))
            for run in _runs(rows):
                store, path = _store(run[0][0])
                first = run[0][1]
                with store.open_input_file(path) as source:
                    data = source.read_at(run[-1][1] + run[-1][2] - first, first)
                found = [parse_record(data[o - first : o - first + n]) for _, o, n in run]
                if not payload:
                    for x in found:
                        x["payload"] = None
                yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)

    share = F.floor(F.col("offset") / SHARE_BYTES)
    placed = index.select("file", "offset", "length").repartition("file", share).sortWithinPartitions("file", "offset")
    read = placed.mapInArrow(over, RECORD)
    return read.withColumn("page_id", F.col("page_id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


_SCHEMA = pa.schema(
    [(c, pa.string()) for c in ("page_id", "url", "record_type", "refers_to")]
    + [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())]
)
