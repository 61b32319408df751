"""WARC archives, index first (operator 6).

Writing gives one gzip member per record and one index row per record (file,
offset, length, URL, digest). Reading starts from the index: the selected rows
are sorted by file and offset, neighbouring byte ranges are joined into one read
of a bounded size, and each record is cut out of what was read.

Archives lie in the shared folder and are written through ``pyarrow.fs``. A task
that is tried again writes a new file; only the files of the attempts that
committed are named in the index.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import shared_path, stage, table

REVISIT_BYTES = 1000  # payloads of at least so many bytes are stored once
RECORD_DATE = "2020-01-01T00:00:00Z"
FILE_BYTES = 256 << 20  # an archive is closed once it has so many bytes
READ_BYTES = 8 << 20  # joined byte ranges are read in pieces of about this size
TASK_BYTES = 32 << 20  # stored bytes that a task reads back
READ_GAP = 64 << 10  # bytes between two ranges that are read along
MAX_SHARED_BROADCAST = 100_000  # rows of (digest, page_id)

INDEX_SCHEMA = ("file string, offset bigint, length bigint, page_id bigint, url string, record_type string, "
                "refers_to bigint, payload_bytes bigint, payload_digest string")
RECORD_SCHEMA = INDEX_SCHEMA + ", payload binary"


def payload_of(html: Column) -> Column:
    return F.coalesce(html, F.lit("")).cast("binary")


def plan_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of the rows of ``pages``.

    Of equal payloads of at least ``REVISIT_BYTES``, rows of the largest page_id are
    responses and the others revisit it; anything else is a response. A null
    page_id is never the largest; if all are null, all are responses. Payloads do
    not move: only the digests that occur twice are joined back to the pages.
    """
    rows = pages.select("page_id", "url", payload_of(F.col("html")).alias("payload")).select(
        "*", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    shared = (rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest")
              .agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n"))
    shared = stage(shared, "warc-shared")
    if shared.limit(MAX_SHARED_BROADCAST + 1).count() <= MAX_SHARED_BROADCAST:
        shared = F.broadcast(shared)
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("_first")), F.col("_first"))
    return (rows.join(shared, "payload_digest", "left").withColumn("refers_to", refers)
            .withColumn("record_type", F.when(F.col("refers_to").isNotNull(), "revisit").otherwise("response")).drop("_first"))


def _file_system(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _header(row: dict) -> bytes:
    """Header block of a record; the fields that WARC has no name for are extension fields."""
    payload = row["payload"] if row["record_type"] == "response" else b""
    url = (row["url"] or "").encode("utf-8").replace(b"\r", b"%0D").replace(b"\n", b"%0A").decode("utf-8")
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {RECORD_DATE}",
             f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"X-Payload-Length: {row['payload_bytes']}",
             "Content-Type: application/octet-stream", f"Content-Length: {len(payload)}"]
    if row["url"] is not None:
        lines.append(f"WARC-Target-URI: {url}")
    if row["page_id"] is not None:
        lines.append(f"X-Page-ID: {row['page_id']}")
    if row["refers_to"] is not None:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {row['refers_to']}"]
    return "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n"


def _member(row: dict) -> bytes:
    body = row["payload"] if row["record_type"] == "response" else b""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(_header(row) + body + b"\r\n\r\n") + z.flush()


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Writes the planned records to archives in ``folder``; returns the index, staged in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = _file_system(folder)
        system.create_dir(base, recursive=True)
        out, at, name = None, 0, ""
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                index = []
                for row in batch.slice(start, 128).to_pylist():
                    if out is None or at >= FILE_BYTES:
                        if out is not None:
                            out.close()
                        name, at = f"{base}/{uuid.uuid4().hex}.warc.gz", 0
                        out = system.open_output_stream(name, compression=None)
                    data = _member(row)
                    out.write(data)
                    index.append({"file": name, "offset": at, "length": len(data)} | {
                        k: row[k] for k in ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")})
                    at += len(data)
                yield pa.RecordBatch.from_pylist(index, schema=schema)
        if out is not None:
            out.close()

    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])
    columns = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]
    return stage(records.select(*columns).mapInArrow(run, INDEX_SCHEMA), "warc-index")


def parse_record(member: bytes) -> dict:
    """A record from its gzip member: its header fields and its payload (None for a revisit)."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    number = lambda name: int(fields[name]) if name in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": number("X-Refers-To-Page"), "payload_bytes": number("X-Payload-Length"),
            "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
            "payload": body if fields["WARC-Type"] == "response" else None}


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """The records that the rows of ``index`` point to, read by joined byte ranges.

    Digest and length of a response are computed anew from the payload that was
    read; those of a revisit are the ones in its header. An index without rows gives
    none; an index row that occurs twice gives its record twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        system, _ = _file_system(folder)

        def records(file: str, ranges: list[tuple[int, int]]) -> list[dict]:
            start, end = ranges[0][0], max(o + n for o, n in ranges)
            with system.open_input_file(file) as f:
                f.seek(start)
                data = f.read(end - start)
            found = []
            for offset, length in ranges:
                r = parse_record(data[offset - start:offset - start + length])
                if r["payload"] is not None:
                    r |= {"payload_bytes": len(r["payload"]), "payload_digest": hashlib.sha1(r["payload"]).hexdigest()}
                found.append(r | {"file": file, "offset": offset, "length": length})
            return found

        file, ranges = None, []
        for batch in batches:
            for f, o, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if ranges and (f != file or o - sum(ranges[-1]) > READ_GAP or o + n - ranges[0][0] > READ_BYTES):
                    yield pa.RecordBatch.from_pylist(records(file, ranges), schema=schema)
                    ranges = []
                file = f
                ranges.append((o, n))
        if ranges:
            yield pa.RecordBatch.from_pylist(records(file, ranges), schema=schema)

    schema = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("payload", pa.binary())])
    total = index.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    parts = max(1, -(-total // TASK_BYTES))  # by the bytes that the rows stand for; the rows themselves are small
    ordered = index.select("file", "offset", "length").repartitionByRange(parts, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, RECORD_SCHEMA)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes a record for every page, then reads all of them back through the index."""
    folder = shared_path(spark, "warc")
    index = write_archives(plan_records(table(spark, sf_dir, "pages")), folder)
    return read_records(index, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = f"""
with p as (select page_id, cast(strlen(coalesce(html, '')) as bigint) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
g as (select payload_digest, max(page_id) as first from p where payload_bytes >= {REVISIT_BYTES} group by 1 having count(*) > 1)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when g.first is not null and p.page_id is distinct from g.first then 'revisit' else 'response' end as record_type,
  case when p.page_id is distinct from g.first then g.first end as refers_to
from p left join g using (payload_digest)
"""

QUERIES = {"op6_warc": op6_warc}
ORACLES = {"op6_warc": OP6_SQL}
