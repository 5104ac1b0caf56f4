"""Files read by byte ranges: digests, headers and the records of delimited text, whatever a file's size.

Python data sources over ``pyarrow.fs``, which opens local paths and the common object stores. No file is
held whole: digests go on in chunks, headers stop at their last line, and delimited files fall into ranges
that several tasks read. Small files and ranges are packed, so that a task reads many of them.

A record may have line breaks inside quotes, so a range cannot tell by itself where one begins. The quotes
of each range are counted first; the sum of those before a range, modulo 2, says whether it begins inside
quotes (one number per range goes to the driver, as the list of files does). A range then passes over the
record that it begins within, and reads on to the end of the last one that begins in it or right behind it. Quotes inside quotes are doubled; a quote in an
unquoted field counts as any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from fnmatch import fnmatch

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

CHUNK_BYTES, RANGE_BYTES = 4_000_000, 64_000_000
_QUOTE, _LINE = ord('"'), ord("\n")


@dataclass
class FilePart(InputPartition):
    """Bytes ``start`` to ``end`` of a file; ``quoted`` if they begin inside quotes."""

    path: str
    size: int
    modified: float
    start: int
    end: int
    quoted: bool = False


@dataclass
class FilePack(InputPartition):
    """Parts that one task reads, one after another."""

    parts: list[FilePart]


def packed(parts: list[FilePart], tasks: int, most: int = RANGE_BYTES) -> list[FilePack]:
    """The parts in their order, in packs of about the same bytes: a pack for each of ``tasks``, more if they would be beyond ``most``.

    Opening a file counts as a 256th of ``most``, so a pack has that many parts at most. A part that is as large is alone.
    """
    sizes = [most // 256 + part.end - part.start for part in parts]
    each, packs, held = min(most, -(-sum(sizes) // max(tasks, 1))), [], 0
    for part, size in zip(parts, sizes):
        if not packs or held + size > each:
            packs.append(FilePack([]))
            held = 0
        packs[-1].parts.append(part)
        held += size
    return packs


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    for name in ("s3a://", "s3n://"):
        path = path.replace(name, "s3://", 1) if path.startswith(name) else path
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def listed(path: str, glob: str = "*") -> list[FilePart]:
    """All files at or below ``path`` whose name matches, hidden ones left out, as one part each."""
    store, inner = opened(path)
    prefix = path[: len(path) - len(inner)] if path.endswith(inner) else ""
    info = store.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == pafs.FileType.File else store.get_file_info(pafs.FileSelector(inner, recursive=True))
    files = [f for f in found if f.type == pafs.FileType.File and fnmatch(f.base_name, glob) and not f.base_name.startswith(("_", "."))]
    return [FilePart(prefix + f.path, f.size, f.mtime.timestamp() if f.mtime else 0.0, 0, f.size) for f in sorted(files, key=lambda f: f.path)]


def chunks(part: FilePart, size: int = CHUNK_BYTES, beyond: bool = False) -> Iterator[bytes]:
    """The bytes of a part, ``size`` at a time; ``beyond`` goes on to the end of the file."""
    store, inner = opened(part.path)
    with store.open_input_file(inner) as file:
        file.seek(part.start)
        at, end = part.start, part.size if beyond else part.end
        while at < end and (data := file.read(min(size, end - at))):
            yield data
            at += len(data)


def keyword_lines(pieces: Iterator[bytes], names: tuple[str, ...], last: str) -> list[str]:
    """The lines that begin with one of the names, up to the first that begins with ``last``; all other bytes are passed over."""
    wanted, found, line, skipping = {n.upper() for n in (*names, last)}, [], b"", False

    def keyword(text: bytes) -> str:
        return text.lstrip(b" \t")[:32].split(None, 1)[0].decode("latin-1").upper() if text.strip() else ""

    for data in pieces:
        while data:
            cut = data.find(b"\n")
            line += b"" if skipping else data if cut < 0 else data[:cut]
            data = b"" if cut < 0 else data[cut + 1 :]
            if len(line) > 64 and not skipping:
                name = keyword(line)
                if name == last.upper():
                    return [*found, line[:64].decode("utf-8", "replace")]
                if name not in wanted:
                    line, skipping = b"", True
            if cut >= 0:
                name = "" if skipping else keyword(line)
                if name in wanted:
                    found.append(line.rstrip(b"\r").decode("utf-8", "replace"))
                if name == last.upper():
                    return found
                line, skipping = b"", False
    if not skipping and keyword(line) in wanted:
        found.append(line.rstrip(b"\r").decode("utf-8", "replace"))
    return found


def records(part: FilePart, size: int = CHUNK_BYTES) -> Iterator[tuple[int, bytes]]:
    """Place and bytes of the records that begin behind a part's first byte (in the first part: at it) up to its end, without their line ends."""
    held, at, quotes, begun = b"", part.start, int(part.quoted), part.start == 0
    for data in chunks(part, size, beyond=True):
        held += data
        array = np.frombuffer(held, np.uint8)
        inside = (quotes + np.cumsum(array == _QUOTE)) % 2
        ends = np.flatnonzero((array == _LINE) & (inside == 0))
        first = 0
        for end in ends.tolist():
            if begun:
                yield at + first, held[first:end].rstrip(b"\r")
            begun, first = True, end + 1
            if at + first > part.end:
                return
        quotes = quotes if first == 0 else 0  # a record ends outside quotes
        held, at = held[first:], at + first
    if begun and held and at <= part.end:
        yield at, held.rstrip(b"\r")


class _Files(DataSource):
    """Options: ``path``, ``glob``, ``tasks``, ``range_bytes``, and ``quoted`` (whether each range begins inside quotes, as 0 and 1)."""

    columns = ""

    def schema(self) -> str:
        return self.columns

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.read_part, self.options, self.ranged)

    ranged = False


class _Reader(DataSourceReader):
    def __init__(self, read_part, options, ranged: bool):
        self.read_part, self.options, self.ranged = read_part, dict(options), ranged

    def partitions(self) -> list[InputPartition]:
        parts, size = listed(self.options["path"], self.options.get("glob", "*")), int(self.options.get("range_bytes", RANGE_BYTES))
        if self.ranged:
            parts = [FilePart(f.path, f.size, f.modified, at, min(f.size, at + size)) for f in parts for at in range(0, f.size, size)]
            for part, flag in zip(parts, self.options.get("quoted", "")):
                part.quoted = flag == "1"
        return packed(parts, int(self.options.get("tasks", 1)), size) or [FilePack([])]

    def read(self, pack: FilePack):
        for part in pack.parts:
            yield from self.read_part(part)


class FileDigests(_Files):
    columns = "path string, length bigint, modificationTime timestamp, file_hash string"

    @classmethod
    def name(cls) -> str:
        return "file_digests"

    @staticmethod
    def read_part(part: FilePart):
        digest = hashlib.sha256()
        for data in chunks(part):
            digest.update(data)
        yield part.path, part.size, datetime.fromtimestamp(part.modified, timezone.utc), digest.hexdigest()


class FileHeaders(_Files):
    columns = "file string, header string"

    @classmethod
    def name(cls) -> str:
        return "file_headers"

    def reader(self, schema) -> DataSourceReader:
        names, last = tuple(self.options["keywords"].split(",")), self.options["last"]

        def read_part(part: FilePart):
            yield part.path, "\n".join(keyword_lines(chunks(part), names, last))

        return _Reader(read_part, self.options, False)


class QuoteCounts(_Files):
    columns, ranged = "file string, start bigint, quotes bigint", True

    @classmethod
    def name(cls) -> str:
        return "quote_counts"

    @staticmethod
    def read_part(part: FilePart):
        yield part.path, part.start, sum(data.count(b'"') for data in chunks(part))


class TextRecords(_Files):
    columns, ranged = "file string, start bigint, record string", True

    @classmethod
    def name(cls) -> str:
        return "text_records"

    @staticmethod
    def read_part(part: FilePart):
        places, texts, size = [], [], 0

        def batch() -> pa.RecordBatch:
            text = pa.array([t.decode("utf-8", "replace") for t in texts], pa.string())
            return pa.RecordBatch.from_arrays([pa.array([part.path] * len(texts), pa.string()), pa.array(places, pa.int64()), text], ["file", "start", "record"])

        for at, record in records(part):
            places.append(at)
            texts.append(record)
            size += len(record)
            if size > CHUNK_BYTES:
                yield batch()
                places, texts, size = [], [], 0
        if texts:
            yield batch()


def _load(spark: SparkSession, source: type[DataSource], path: str, **options: str) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(path=path, tasks=str(spark.sparkContext.defaultParallelism), **options).load()


def read_digests(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``path``, ``length``, ``modificationTime``, ``file_hash`` (SHA-256) of every file, hashed in chunks."""
    return _load(spark, FileDigests, path, glob=glob)


def read_headers(spark: SparkSession, path: str, keywords: tuple[str, ...], last: str, glob: str = "*") -> DataFrame:
    """``file``, ``header``: the keyword lines of every file up to its first ``last`` line; bytes behind it are not read."""
    return _load(spark, FileHeaders, path, glob=glob, keywords=",".join(keywords), last=last)


def read_records(spark: SparkSession, path: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``file``, ``start``, ``record`` of delimited files, read in ranges; line breaks inside quotes belong to their record."""
    counts = _load(spark, QuoteCounts, path, glob=glob, range_bytes=str(range_bytes)).collect()  # a row per range
    flags, file, quoted = [], None, 0
    for row in sorted(counts, key=lambda r: (r.file, r.start)):
        quoted = 0 if row.file != file else quoted
        file = row.file
        flags.append("1" if quoted else "0")
        quoted = (quoted + row.quotes) % 2
    records_ = _load(spark, TextRecords, path, glob=glob, range_bytes=str(range_bytes), quoted="".join(flags))
    return records_.where(F.col("record") != "")
