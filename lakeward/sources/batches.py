"""CSV order-event batches, columns matched by header name.

A *batch* is one CSV file, as landed; the ``part-*`` files that a Spark writer
leaves in one folder are together one batch, named by that folder. A batch is
known by its full path everywhere; its basename is only a label in reports.

Spark's multi-file CSV reader maps columns by position, so files whose
headers differ (reordered, added or renamed columns) would silently shift
values. Here:

1. the files are listed once (``headers``): the gate and the build read that
   list, so a file that lands in between waits for the next run;
2. one distributed job reads the header of every file that the ledger of an earlier
   run doesn't know unchanged, touching only its head;
3. ``read_columns`` groups files by where the wanted columns stand, ``read_batches``, which
   returns all columns, by distinct header; each group is one scan with an
   all-string schema. Files with quoted line breaks, which the contract finds, are read apart,
   each by one task;
4. the groups are combined by name.

Paths and header lines reach the driver (one row per file, as in Spark's own
file index); the rows themselves never leave the executors.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Holds the text of a row whose cells don't match the header.
MALFORMED = "_malformed_row"
#: A longer first line is an error.
MAX_HEADER_BYTES = 1 << 24


def _as_list(paths: str | Sequence[str]) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def _batch_of(file_path: str) -> str:
    folder, _, name = file_path.rpartition("/")
    return folder if name.startswith("part-") else file_path


def _label_of(batch: str) -> str:
    return re.sub(r"^[^=/]+=", "", batch.rsplit("/", 1)[-1])


def batch_label(batch: Column) -> Column:
    """Basename of a batch path; a Hive-style ``key=`` prefix is dropped. The name is cut off, not
    matched: a pattern for the end of a path is tried from each of its characters, for every row."""
    name = F.substring_index(batch, "/", -1)
    return F.when(F.contains(name, F.lit("=")), F.regexp_replace(name, r"^[^=/]+=", "")).otherwise(name)


def as_pattern(path: str) -> str:
    """A path that Spark's readers, which expand patterns, take literally."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def plain_path(path: str) -> str:
    """One form for a path that names no host: ``file:/x`` for ``file:///x`` too."""
    return re.sub(r"^([A-Za-z][A-Za-z0-9+.-]*):///", r"\1:/", path)


def plain_paths(file_path: Column) -> Column:
    """``plain_path`` of the URL-encoded paths that file metadata carries."""
    plain = F.replace(F.replace(file_path, F.lit(":///"), F.lit(":/")), F.lit("+"), F.lit("%2B"))
    return F.url_decode(plain)


@dataclass(frozen=True)
class FileHeader:
    file_path: str
    batch: str
    label: str
    columns: tuple[str, ...]
    length: int = 0
    modified: int = 0  # microseconds since 1970
    multiline: bool = False  # has quoted line breaks
    known: bool = False  # unchanged since the ledger was written


def batch_path(file_path: Column) -> Column:
    """The batch of a file, as ``_batch_of`` has it."""
    name = F.substring_index(file_path, "/", -1)
    folder = F.substring(file_path, F.lit(1), F.length(file_path) - F.length(name) - 1)
    return F.when(F.startswith(name, F.lit("part-")), folder).otherwise(file_path)


def parse_header(line: str) -> tuple[str, ...]:
    """Column names of a header line. An unnamed column is named by its place; a name
    that an earlier column has (in any case) gets a number."""
    text = line.lstrip("﻿").rstrip("\r\n")
    cells = next(csv.reader(io.StringIO(text, newline="")), [])
    out: list[str] = []
    taken: set[str] = set()
    for place, cell in enumerate(cells):
        base = name = cell or f"column{place}"
        n = 0
        while name.lower() in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def _first_lines_fn(head_bytes: int = 1 << 16, max_bytes: int = MAX_HEADER_BYTES):
    """mapInPandas body: the first line of each file (more if a quoted name has line breaks),
    reading only its head.

    Built as a closure that imports only the standard library, pandas and
    pyarrow, so it is shipped to executors by value: the workers do not need
    this package installed. A file in a store that pyarrow has no client for yields
    a NULL header (the caller falls back to Spark's text reader for those); any
    other error ends the job."""

    def first_lines(batches):
        import re as _re
        from urllib.parse import unquote as _unquote

        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs

        def location(uri: str):
            if uri.startswith("file:"):
                return pafs.LocalFileSystem(), _re.sub(r"^file:(//)?", "", uri)
            scheme = uri.split(":", 1)[0]
            mapped = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
            try:
                return pafs.FileSystem.from_uri(mapped + uri[len(scheme):])
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                return None

        for pdf in batches:
            heads = []
            for uri in pdf["file_path"]:
                place = location(uri)
                if place is None:
                    heads.append(None)
                    continue
                fs, path = place
                with fs.open_input_stream(path, compression="detect") as stream:
                    buf, end, seen = b"", -1, 0
                    while end < 0 and (chunk := stream.read(head_bytes)):
                        buf += chunk
                        while (end := buf.find(b"\n", seen)) >= 0 and buf.count(b'"', 0, end) % 2:
                            seen = end + 1
                        if len(buf) > max_bytes and end < 0:
                            # An odd quote isn't closed: the line itself, if there is one, is the header.
                            end = buf.find(b"\n")
                            if end < 0:
                                raise ValueError(f"first line of {uri} is longer than {max_bytes} bytes")
                first = buf.find(b"\n")
                line = buf[:end] if end >= 0 else buf[:first] if first >= 0 else buf
                heads.append(line.decode("utf-8", errors="replace"))
            yield pdf.assign(header=pd.Series(heads, index=pdf.index, dtype=object))

    return first_lines


def _headers_by_text_scan(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """First line per file via Spark's text reader (reads the whole files)."""
    text = spark.read.text([as_pattern(f) for f in files])
    return (
        text.select(
            F.col("value"),
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_block_start").alias("block_start"),
            F.monotonically_increasing_id().alias("pos"),
        )
        .where(F.col("block_start") == 0)
        .groupBy("file_path")
        .agg(F.min_by("value", "pos").alias("header"))
        .select(plain_paths(F.col("file_path")).alias("file_path"), "header")
    )


def headers(spark: SparkSession, paths: str | Sequence[str], ledger: DataFrame | None = None) -> list[FileHeader]:
    """Every file under ``paths`` with its column names, the list that all later reads
    of a run share. An empty file, or one whose first line is empty, has no columns.

    Files are listed with the ``binaryFile`` source without its content
    column (listing only), then each task reads just the head of its files. Files that
    ``ledger`` holds with the same length and modification time aren't opened."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_as_list(paths))
    files = listing.select(F.regexp_replace("path", r"^([A-Za-z][A-Za-z0-9+.-]*):///", "$1:/").alias("file_path"), "length",
                           F.unix_micros("modificationTime").alias("modified"))
    # The scan leaves out files of no bytes, the list of the same index doesn't.
    out = {path: _file(path, ()) for path in (plain_path(unquote(f)) for f in listing.inputFiles())}
    new = files
    if ledger is not None:
        same = ["file_path", "length", "modified"]
        seen = files.join(ledger.select(*same, "columns", "multiline"), same)
        for r in seen.collect():
            out[r["file_path"]] = _file(r["file_path"], tuple(r["columns"]), r["length"], r["modified"], r["multiline"], True)
        new = files.join(ledger.select(*same), same, "left_anti")
    heads = new.mapInPandas(_first_lines_fn(), "file_path string, length bigint, modified bigint, header string").collect()
    unreadable = sorted(r["file_path"] for r in heads if r["header"] is None)
    texts = {r["file_path"]: r["header"] for r in _headers_by_text_scan(spark, unreadable).collect()} if unreadable else {}
    for r in heads:
        line = texts.get(r["file_path"]) if r["header"] is None else r["header"]
        out[r["file_path"]] = _file(r["file_path"], parse_header(line or ""), r["length"], r["modified"])
    return [out[path] for path in sorted(out)]


def _file(path: str, columns: tuple[str, ...], length: int = 0, modified: int = 0, multiline: bool = False, known: bool = False) -> FileHeader:
    batch = _batch_of(path)
    return FileHeader(path, batch, _label_of(batch), columns, length, modified, multiline, known)


def input_bytes(spark: SparkSession, paths: str | Sequence[str]) -> int:
    """Bytes of all files under ``paths``, from the listing alone."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(_as_list(paths))
    return listing.agg(F.sum("length")).first()[0] or 0


def read_csv(spark: SparkSession, files: Sequence[str], columns: Sequence[str], multiline: bool = False, trim_values: bool = False) -> DataFrame:
    """One scan of CSV files that have headers of ``columns``, all as strings."""
    return (
        spark.read.schema(T.StructType([T.StructField(c, T.StringType(), True) for c in columns]))
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(multiline).lower())
        .option("ignoreLeadingWhiteSpace", str(trim_values).lower())
        .option("ignoreTrailingWhiteSpace", str(trim_values).lower())
        .csv([as_pattern(f) for f in files])
    )


def cells_by_width(spark: SparkSession, file_headers: Sequence[FileHeader], multiline: bool = False) -> Iterator[tuple[int, DataFrame]]:
    """(width, frame) for each number of columns, whatever their names and order: the cells
    by position (``c0``, ``c1``, trimmed), the text of rows of another width, and the file's path as the scan has it."""
    groups: dict[tuple[int, bool], list[str]] = {}
    for h in file_headers:
        if h.columns:
            groups.setdefault((len(h.columns), multiline or h.multiline), []).append(h.file_path)
    for (width, broken), files in sorted(groups.items()):
        cells = [f"c{i}" for i in range(width)]
        yield width, read_csv(spark, files, [*cells, MALFORMED], broken, trim_values=True).select(*cells, MALFORMED, F.col("_metadata.file_path").alias("file"))


def header_groups(spark: SparkSession, file_headers: Sequence[FileHeader], multiline: bool = False) -> Iterator[tuple[tuple[str, ...], DataFrame]]:
    """(columns, frame) for each distinct header: all columns as strings and
    ``source_file``, the batch path."""
    # Only paths without a host or with special characters need rewriting.
    groups: dict[tuple[tuple[str, ...], bool, bool], list[str]] = {}
    for h in file_headers:
        if h.columns:
            plain = re.fullmatch(r"[A-Za-z0-9+.-]+://[A-Za-z0-9/:._=-]*", h.file_path) is not None
            groups.setdefault((h.columns, plain, multiline or h.multiline), []).append(h.file_path)
    for (cols, plain, broken), files in sorted(groups.items()):
        path = F.col("_metadata.file_path")
        batch = batch_path(path if plain else plain_paths(path))
        yield cols, read_csv(spark, files, cols, broken).select(*[F.col(f"`{c}`") for c in cols], batch.alias("source_file"))


def read_columns(spark: SparkSession, file_headers: Sequence[FileHeader], columns: Sequence[str], multiline: bool = False) -> DataFrame:
    """The named columns of all batches as strings, NULL where a header lacks one, and ``source_file``.
    Files share a scan if these columns stand at the same places of equally many, whatever
    the others are called."""
    groups: dict[tuple, list[str]] = {}
    for h in file_headers:
        if h.columns:
            place = {c: i for i, c in enumerate(h.columns)}
            plain = re.fullmatch(r"[A-Za-z0-9+.-]+://[A-Za-z0-9/:._=-]*", h.file_path) is not None
            key = (len(h.columns), tuple(place.get(c, -1) for c in columns), plain, multiline or h.multiline)
            groups.setdefault(key, []).append(h.file_path)
    out = None
    for (width, places, plain, broken), files in sorted(groups.items()):
        path = F.col("_metadata.file_path")
        cells = read_csv(spark, files, [f"c{i}" for i in range(width)], broken)
        own = cells.select(*[(F.col(f"c{i}") if i >= 0 else F.lit(None).cast("string")).alias(c) for c, i in zip(columns, places)],
                           batch_path(path if plain else plain_paths(path)).alias("source_file"))
        out = own if out is None else out.unionByName(own)
    if out is None:
        raise ValueError("no input file has a header")
    return out


def read_batches(
    spark: SparkSession,
    paths: str | Sequence[str],
    file_headers: list[FileHeader] | None = None,
    with_label: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """All columns of all batches as strings, matched by name, plus
    ``source_file`` (the batch path) and, optionally, ``source_batch``.

    Files marked ``multiline`` in ``file_headers`` (the contract finds them) may have quoted
    line breaks and are read by one task each; ``multiline`` reads all files so."""
    hs = file_headers if file_headers is not None else headers(spark, paths)
    if not hs:
        raise FileNotFoundError(f"no input files match {_as_list(paths)}")
    out = None
    for _, frame in header_groups(spark, hs, multiline=multiline):
        out = frame if out is None else out.unionByName(frame, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no input file under {_as_list(paths)} has a header")
    return out.withColumn("source_batch", batch_label(F.col("source_file"))) if with_label else out
