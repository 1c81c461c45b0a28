"""WARC and ARC archives as a Spark data source (batch and stream).

``spark.read.format("warc").load(path)`` after :func:`register`. One partition
per file (a compressed archive cannot be split) unless it is an uncompressed
WARC larger than ``splitBytes``, which is cut at record starts, found by walking
the records' lengths from the file's begin. Options: ``includePayload`` (false
leaves payloads null, for statistics and indexes), ``maxPayloadBytes`` (payloads
are cut beyond, and no more is held in memory), ``recordTypes`` (comma list, read
before payloads are copied), ``pathGlobFilter``.

The source reads folders that every executor sees at the same path.
:func:`load_archives` reads from any file system that Spark knows, by its binary
file source (files of less than 2 GB).

Header names are matched whatever their case. Empty files are skipped. A record that cannot be read becomes a row with
``error``; reading goes on at the next record, or ends with the file.
"""

from __future__ import annotations

import fnmatch
import gzip
import io
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, InputPartition, DataSourceStreamReader

SCHEMA = T.StructType(
    [
        T.StructField("source_file_path", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("source_file_offset", T.LongType()),
        T.StructField("record_length", T.LongType()),
        T.StructField("file_size", T.LongType()),
        T.StructField("version", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("warc_headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("http_status", T.StringType()),
        T.StructField("http_headers", T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.StringType())]))),
        T.StructField("payload", T.BinaryType()),
        T.StructField("error", T.StringType()),
    ]
)


#: Header names of the format in their own spelling.
_NAMES = {n.lower(): n for n in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "Content-Type", "WARC-Concurrent-To", "WARC-Block-Digest", "WARC-Payload-Digest", "WARC-IP-Address", "WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date", "WARC-Target-URI", "WARC-Truncated", "WARC-Warcinfo-ID", "WARC-Filename", "WARC-Profile", "WARC-Identified-Payload-Type", "WARC-Segment-Number", "WARC-Segment-Origin-ID", "WARC-Segment-Total-Length")}


#: HTTP headers take at most so many bytes of a block.
_HEAD = 1 << 16


class _Inflated(io.RawIOBase):
    """The bytes of one gzip member, inflated as they are read."""

    def __init__(self, members: _Members):
        self.members, self.engine, self.left = members, zlib.decompressobj(31), b""

    def readable(self):
        return True

    def readinto(self, into):
        while not self.left and not self.engine.eof:
            packed = self.engine.unconsumed_tail or self.members.take()
            if not packed:
                break
            self.left = self.engine.decompress(packed, 1 << 18)
            if self.engine.eof:
                self.members.buffer = self.engine.unused_data
        n = min(len(into), len(self.left))
        into[:n] = self.left[:n]
        self.left = self.left[n:]
        return n


class _Members:
    """Reads a gzip file member by member, or a plain file, and tells each record's offset."""

    def __init__(self, file: io.BufferedReader, start: int = 0):
        self.file = file
        file.seek(0)
        self.packed = file.read(2) == b"\x1f\x8b"
        file.seek(start)
        self.buffer, self.at = b"", start

    def take(self) -> bytes:
        """The next packed bytes."""
        out, self.buffer = self.buffer or self.file.read(1 << 16), b""
        return out

    def records(self, end: int) -> Iterator[tuple[int, io.BufferedIOBase]]:
        if not self.packed:
            while self.at < end:
                self.file.seek(self.at)
                head = self.file.read(64)
                self.at += len(head) - len(head.lstrip(b"\r\n"))  # a record begins after the blank lines of the last one
                if not head or self.at >= end:
                    return
                self.file.seek(self.at)
                yield self.at, self.file
                self.at = self.file.tell()
            return
        while True:
            if not self.buffer:
                self.buffer = self.file.read(1 << 16)
                if not self.buffer:
                    return
            offset = self.file.tell() - len(self.buffer)
            stream = io.BufferedReader(_Inflated(self), 1 << 16)
            yield offset, stream
            _skip(stream, None)


def _skip(stream, size: int | None) -> None:
    """Pass over some bytes, or all that are left."""
    if size is not None and isinstance(stream, io.BufferedReader) and stream.seekable():
        stream.seek(size, 1)
        return
    while size is None or size > 0:
        got = len(stream.read(1 << 18 if size is None else min(size, 1 << 18)))
        if not got:
            return
        size = None if size is None else size - got


def _lines(stream) -> Iterator[bytes]:
    while True:
        line = stream.readline(1 << 20)
        if not line or not line.strip(b"\r\n"):
            return
        yield line.rstrip(b"\r\n")


def _fields(stream) -> list[tuple[str, str]]:
    out: list[tuple[str, str]] = []
    for line in _lines(stream):
        text = line.decode("utf-8", "replace")
        if text[:1] in " \t" and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {text.strip()}")
        elif ":" in text:
            name, _, value = text.partition(":")
            out.append((name.strip(), value.strip()))
    return out


def _record_fields(stream) -> dict[str, str]:
    """Record headers by name; the first value of a name counts."""
    return {_NAMES.get(n.lower(), n): v for n, v in reversed(_fields(stream))}


def split_http(block: bytes) -> tuple[str | None, list[tuple[str, str]] | None, bytes]:
    """(status line, headers, payload) of a block; only a block that starts with HTTP is split."""
    if not block.startswith(b"HTTP/"):
        return None, None, block
    stream = io.BytesIO(block)
    status = stream.readline().decode("utf-8", "replace").strip()
    headers = _fields(stream)
    return status, headers, block[stream.tell() :]


def _read_record(stream, wanted: set[str], payload: bool, limit: int):
    """(version, type, headers, block or None) of the record at the stream's position; None at its end."""
    first = stream.readline(1 << 20)
    while first and not first.strip():
        first = stream.readline(1 << 20)
    if not first:
        return None
    line = first.decode("utf-8", "replace").strip()
    if line.startswith("WARC/"):
        headers = _record_fields(stream)
        kind, size, version = headers.get("WARC-Type"), int(headers.get("Content-Length", 0)), line
    else:  # ARC: url, address, date, type, [..], length
        parts = line.split(" ")
        if len(parts) < 5 or not parts[-1].isdigit():
            raise ValueError(f"no record here: {line[:80]}")
        kind = "arc" if not line.startswith("filedesc:") else "warcinfo"
        size, version = int(parts[-1]), "ARC/1.0"
        headers = {"WARC-Type": kind, "WARC-Target-URI": parts[0], "WARC-IP-Address": parts[1], "WARC-Date": parts[2], "Content-Type": parts[3], "Content-Length": parts[-1]}
    keep = not wanted or kind in wanted
    if keep and payload:
        block = stream.read(min(size, limit + _HEAD))
        if len(block) < min(size, limit + _HEAD):
            raise EOFError(f"record cut at {len(block)} of {size} bytes")
        _skip(stream, size - len(block))
    else:
        head = stream.read(min(size, _HEAD)) if keep else b""
        block = head[: head.find(b"\r\n\r\n") + 4] if keep and head.startswith(b"HTTP/") else b""
        _skip(stream, size - len(head))
    return version, kind, headers, block, keep, limit


def read_archive(path: str, start: int = 0, end: int | None = None, payload: bool = True, limit: int = 1 << 28, wanted: set[str] | None = None, data: bytes | None = None) -> Iterator[tuple]:
    """Rows of one archive, or of nested bytes."""
    size = len(data) if data is not None else os.path.getsize(path)
    if not size:
        return
    name = os.path.basename(path)
    with io.BufferedReader(io.BytesIO(data)) if data is not None else open(path, "rb") as file:
        members = _Members(file, start)
        for offset, stream in members.records(size if end is None else end):
            try:
                found = _read_record(stream, wanted or set(), payload, limit)
            except Exception as e:  # noqa: BLE001 - reported as a row
                yield path.replace("\\", "/"), name, offset, None, size, None, None, None, None, None, None, f"{type(e).__name__}: {e}"
                if members.packed:
                    continue
                return
            if found is None:
                if members.packed:
                    continue
                return
            version, kind, headers, block, keep, _ = found
            if members.packed:
                _skip(stream, None)  # to the member's end
            after = (stream.tell() if not members.packed else file.tell() - len(members.buffer)) - offset
            if keep:
                status, http, body = split_http(block)
                yield path.replace("\\", "/"), name, offset, after, size, version, kind, headers, status, http, (body[:limit] if payload else None), None


@dataclass
class _Part(InputPartition):
    path: str
    start: int
    end: int | None


def _files(path: str, pattern: str | None) -> list[str]:
    path = re.sub(r"^file:(//)?", "", path)
    if os.path.isdir(path):
        found = [os.path.join(at, n) for at, _, names in os.walk(path) for n in names]
    else:
        found = [path]
    return sorted(f for f in found if not pattern or fnmatch.fnmatch(os.path.basename(f), pattern))


def _record_starts(path: str, step: int) -> list[int]:
    """Offsets of the first record of a plain WARC at or after each multiple of ``step``; records are walked by their lengths, payloads passed over."""
    size, starts = os.path.getsize(path), [0]
    with open(path, "rb") as file:
        if file.read(5) != b"WARC/" or size <= step:
            return starts
        wanted = step
        for offset, stream in _Members(file).records(size):
            if offset >= wanted:
                starts.append(offset)
                wanted = (offset // step + 1) * step
            try:
                if not _read_record(stream, {""}, False, 0):
                    break
            except Exception:  # noqa: BLE001 - the last part reads on from here and reports it
                break
    return starts


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.options = options
        self.wanted = {t for t in options.get("recordtypes", "").split(",") if t}

    def pushFilters(self, filters):  # used with spark.sql.python.filterPushdown.enabled
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute == ("record_type",):
                self.wanted = {f.value}
            yield f

    def partitions(self):
        step = int(self.options.get("splitbytes", 1 << 30))
        parts = []
        for path in [p for chosen in self.options["path"].split(",") for p in _files(chosen, self.options.get("pathglobfilter"))]:
            starts = _record_starts(path, step)
            parts += [_Part(path, a, b) for a, b in zip(starts, [*starts[1:], None])]
        return parts

    def read(self, partition):
        yield from read_archive(partition.path, partition.start, partition.end, self.options.get("includepayload", "true") != "false", int(self.options.get("maxpayloadbytes", 1 << 28)), self.wanted)


class WarcStreamReader(DataSourceStreamReader):
    """New files of a landing folder, in the order of their time; each file is a partition. The offset is the time and path of the last file taken."""

    def __init__(self, options):
        self.options = options
        self.taken = (0, "")

    def _files(self) -> list[tuple[int, str]]:
        return sorted((os.stat(f).st_mtime_ns, f) for f in _files(self.options["path"], self.options.get("pathglobfilter")))

    def initialOffset(self):
        return {"time": 0, "path": ""}

    def latestOffset(self, *_):
        new = [f for f in self._files() if f > self.taken][: int(self.options.get("maxfilespertrigger", 1000))]
        self.taken = new[-1] if new else self.taken
        return {"time": self.taken[0], "path": self.taken[1]}

    def partitions(self, start, end):
        first, last = (start["time"], start["path"]), (end["time"], end["path"])
        self.taken = max(self.taken, last)
        return [_Part(path, 0, None) for at, path in self._files() if first < (at, path) <= last]

    def read(self, partition):
        yield from read_archive(partition.path, payload=self.options.get("includepayload", "true") != "false", limit=int(self.options.get("maxpayloadbytes", 1 << 28)))


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader({k.lower(): v for k, v in self.options.items()})

    def streamReader(self, schema):
        return WarcStreamReader({k.lower(): v for k, v in self.options.items()})


def register(spark: SparkSession) -> None:
    """Make the source known to a session, and let Spark hand it filters on record types."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def load_archives(spark: SparkSession, path: str, include_payload: bool = True, max_payload_bytes: int = 1 << 28, record_types: tuple[str, ...] = (), glob: str | None = None) -> DataFrame:
    """Records of the archives below ``path`` on any file system, one file at a time per task."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (reader.option("pathGlobFilter", glob) if glob else reader).load(path).select("path", "content")
    wanted = set(record_types)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for path_, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows = []
                for row in read_archive(re.sub(r"^file:(//)?", "", path_), payload=include_payload, limit=max_payload_bytes, wanted=wanted, data=data.as_buffer().to_pybytes()):
                    rows.append(row)
                    if len(rows) == 500:
                        yield _batch(pa, rows)
                        rows = []
                if rows:
                    yield _batch(pa, rows)

    return files.mapInArrow(run, SCHEMA)


def _batch(pa, rows: list[tuple]):
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = to_arrow_schema(SCHEMA)
    columns = [pa.array([list(v.items()) if isinstance(v, dict) else [{"name": n, "value": x} for n, x in v] if f.name == "http_headers" and v is not None else v for v in column], type=f.type) for column, f in zip(zip(*rows), kind)]
    return pa.RecordBatch.from_arrays(columns, names=SCHEMA.names)


def nested_archives(df: DataFrame, key: str, payload: str) -> DataFrame:
    """Records of archives that are themselves payloads: (key, and the source's columns)."""
    schema = T.StructType([T.StructField("outer_key", df.schema[key].dataType), *SCHEMA.fields])

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = [(k, *row) for k, data in zip(frame[key], frame[payload]) if data is not None for row in read_archive(str(k), data=bytes(data))]
            yield pd.DataFrame(rows, columns=schema.names)

    return df.select(key, payload).mapInPandas(run, schema)


def write_record(kind: str, url: str | None, date: str, block: bytes, extra: dict[str, str] | None = None, packed: bool = False) -> bytes:
    """The bytes of one WARC record, for fixtures and nested archives."""
    head = {"WARC-Type": kind, "WARC-Date": date, "WARC-Record-ID": f"<urn:uuid:{abs(hash((kind, url, date))):032x}>", **({"WARC-Target-URI": url} if url else {}), **(extra or {}), "Content-Length": str(len(block))}
    raw = b"WARC/1.0\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items()) + b"\r\n" + block + b"\r\n\r\n"
    return gzip.compress(raw, mtime=0) if packed else raw
