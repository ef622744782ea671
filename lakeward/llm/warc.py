"""WARC archives: a writer and a splittable reader (operator 4).

Each record is a gzip member of its own. The reader deals byte ranges of the files
to tasks. A task looks for the gzip magic in its range, takes a place for a member
only if its head inflates to a WARC header, and owns the records whose member
starts inside its range; the last one is read on past the range's end. Magic bytes
inside compressed data fail the decoding and are passed over.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
greatest id is written whole as a response and the others as revisits of it,
without payload. Winners are found on a narrow table of digests; the payloads are
shuffled once, by digest and salt, so a payload that a third of all pages share is
dealt over many tasks.

A writing task makes files with names of its own attempt, and only files that a
finished task reported are in the manifest; a task that is run again after a lost
executor leaves no records twice.

Defined cases: a null payload is an empty one; a null url leaves out the target; a
null id loses against any id and is read back as null; of rows that repeat the
winner's id all are responses; control characters in urls are percent-encoded;
other columns are ignored; no rows make no files and read back as no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.llm.common import cut, salted_lookup
from lakeward.session import scratch_path

# Fixed values of the format.
MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 256 << 20
SPLIT_BYTES = 4 << 20
READ_BYTES = 256 << 10
HEAD_BYTES = 4 << 10
WHEN = "2024-01-01T00:00:00Z"


def filesystem(uri: str):
    """A file system and a path in it, for a URI or a plain path."""
    return pafs.FileSystem.from_uri(uri if re.match(r"^[A-Za-z][A-Za-z0-9+.-]*:", uri) else f"file://{uri}")


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def record(page_id, url: str | None, payload: bytes, refers_to, digest: str) -> bytes:
    """One record: a response with its payload, or a revisit of ``refers_to``."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {urn(page_id)}", f"WARC-Date: {WHEN}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Refers-To: {urn(refers_to)}", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def decided(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, refers_to): whom each page revisits, or null."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"),
                        F.encode(F.coalesce(payload_col, F.lit("")), "UTF-8").alias("payload")).withColumn("_sha", F.sha2("payload", 256))
    winners = rows.groupBy("_sha").agg(F.max("page_id").alias("_winner"))
    met = salted_lookup(rows.withColumn("_spread", F.xxhash64("page_id", "url")), winners, ["_sha"], "_spread")
    other = (F.octet_length("payload") >= min_bytes) & ~F.col("page_id").eqNullSafe(F.col("_winner"))
    return met.select("page_id", "url", "payload", F.when(other, F.col("_winner")).alias("refers_to"))


def write_archives(rows: DataFrame, root: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write decided rows under ``root``; returns the manifest (path, size, records)."""

    def write(batches):
        files, root_path = filesystem(root)
        files.create_dir(root_path, recursive=True)
        out, size, count = None, 0, 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    out, size, count = files.open_output_stream(f"{root_path}/{name}", compression=None), 0, 0
                packer = zlib.compressobj(4, zlib.DEFLATED, 31)
                payload = row["payload"]
                member = packer.compress(record(row["page_id"], row["url"], payload, row["refers_to"], base32_sha1(payload))) + packer.flush()
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "size": [size], "records": [count]})
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [f"{root}/{name}"], "size": [size], "records": [count]})

    return cut(rows.mapInArrow(write, "path string, size long, records long"), "warc-manifest")


def inflated(read, start: int):
    """(bytes, end) of the gzip member at ``start``; read(at, n) gives file bytes."""
    unpack, out, at = zlib.decompressobj(31), [], start
    while not unpack.eof:
        raw = read(at, READ_BYTES)
        if not raw:
            raise ValueError("the archive ends inside a record")
        out.append(unpack.decompress(raw))
        at += len(raw)
    return b"".join(out), at - len(unpack.unused_data)


def is_record(head: bytes) -> bool:
    """Whether a candidate's first bytes inflate to a WARC header."""
    try:
        return zlib.decompressobj(31).decompress(head, 16).startswith(b"WARC/1.")
    except zlib.error:
        return False


def members(read, start: int, end: int):
    """Inflated records of the members that start in [start, end)."""
    at = start
    while at < end:
        window = read(at, min(SPLIT_BYTES, end - at) + len(MAGIC) - 1)
        offset = 0
        while True:
            found = window.find(MAGIC, offset)
            if found < 0 or at + found >= end:
                at += max(1, len(window) - len(MAGIC) + 1)
                break
            if is_record(read(at + found, HEAD_BYTES)):
                data, at = inflated(read, at + found)
                yield data
                break
            offset = found + 1


def id_of(value: str | None) -> int | None:
    number = (value or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def parsed(data: bytes) -> dict:
    """The fields of a record. A response's digest and length are those of the payload
    as read; a digest that doesn't fit the header's is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"(?im)^Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response" and (base32_sha1(payload) != digest or len(payload) != size):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {"page_id": id_of(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "record_type": fields["WARC-Type"],
            "refers_to": id_of(fields.get("WARC-Refers-To")), "payload_bytes": size, "payload_digest": digest,
            "payload": payload if fields["WARC-Type"] == "response" else None}


def read_archives(spark: SparkSession, files: DataFrame, split_bytes: int = SPLIT_BYTES, payload: bool = True) -> DataFrame:
    """Records of the files in (path, size): page_id, url, record_type, refers_to,
    payload_bytes, payload_digest and, if asked for, payload."""
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
              ("payload_bytes", pa.int64()), ("payload_digest", pa.string())] + [("payload", pa.binary())] * payload
    schema = pa.schema(fields)

    def read_ranges(batches):
        for batch in batches:
            for row in batch.to_pylist():
                fs, path = filesystem(row["path"])
                with fs.open_input_file(path) as file:
                    held, size = [], 0
                    for data in members(lambda at, n, file=file: file.read_at(n, at), row["start"], row["end"]):
                        one = parsed(data)
                        held.append({k: one[k] for k, _ in fields})
                        size += len(data) if payload else 200
                        if size >= 8 << 20:
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_pylist(held, schema)

    ranges = files.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("size")).alias("end"))
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kinds = {"int64": "long", "string": "string", "binary": "binary"}
    return ranges.repartition(spread, "path", "start").mapInArrow(read_ranges, ", ".join(f"{k} {kinds[str(t)]}" for k, t in fields))


def archived(pages: DataFrame, min_bytes: int = 0, payload: bool = False) -> DataFrame:
    """Write the pages to archives in the shared folder and read them back."""
    spark = pages.sparkSession
    root = scratch_path(spark, "warc")
    return read_archives(spark, write_archives(decided(pages, min_bytes), root), payload=payload)
