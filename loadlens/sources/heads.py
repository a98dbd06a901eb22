"""The first lines of files, without reading the rest.

A Python data source that opens each file, reads a piece from its start and
goes on, in pieces of doubled size, until the wanted line feeds are there; so
what is read depends on the length of the first lines and not of the files.
Compressed files inflate only as far. There is no cap: a first line of any
length comes whole. Tasks get a share of the files each, largest names apart.

``read_heads`` gives a *lines* DataFrame like ``lines.read_lines``, with the
same file names, bytes and line numbers, so header tests, format detection,
column names and contract proposals take it as it is. ``read_samples`` gives
counts over the first bytes of each file, from which rows are estimated.

Files are reached through Arrow's file systems (local, HDFS, S3, GCS). For a
store that only Spark's own readers know, use ``lines.read_lines``.
"""

from __future__ import annotations

import bz2
import fnmatch
import json
import os
import sys
import urllib.parse
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NAME = "file_heads"
FIRST_PIECE, LARGEST_PIECE = 16 << 10, 4 << 20
SAMPLE_BYTES = 256 << 10
FILES_PER_TASK = 64
_BOM = b"\xef\xbb\xbf"

LINES = "file string, file_size bigint, line_no bigint, value string, bytes_read bigint"
SAMPLES = "file string, file_size bigint, bytes_read bigint, plain_bytes bigint, line_feeds bigint, whole boolean, open_line boolean"


def _codec(path: str):
    """What inflates the file, a new one for each member; none for plain files."""
    suffix = os.path.splitext(path)[1].lower()
    if suffix in (".zst", ".lz4", ".snappy"):
        raise ValueError(f"heads of {suffix} files cannot be read: {path}")
    return {".gz": lambda: zlib.decompressobj(31), ".bz2": bz2.BZ2Decompressor, ".deflate": zlib.decompressobj}.get(suffix)


def _located(path: str) -> tuple[arrow_fs.FileSystem, str]:
    parts = urllib.parse.urlsplit(path)
    if parts.scheme in ("", "file"):
        local = urllib.parse.unquote(parts.path) if parts.scheme else os.path.abspath(path)
        return arrow_fs.LocalFileSystem(), local
    return arrow_fs.FileSystem.from_uri(path)


def _named(path: str, original: str) -> str:
    """A file's name as Spark's readers give it."""
    scheme = urllib.parse.urlsplit(original).scheme
    if scheme in ("", "file"):
        return "file:" + urllib.parse.quote(path, safe="/!$&'()*+,;=:@-._~")
    return original[: original.index("://") + 3] + path


def listed(paths: list[str], glob: str | None) -> list[tuple[str, int]]:
    """Names and sizes of the files at or under the paths; names that begin with a dot or underscore are left out."""
    found = []
    for original in paths:
        system, top = _located(original)
        info = system.get_file_info(top)
        if info.type == arrow_fs.FileType.NotFound:
            raise FileNotFoundError(original)
        infos = system.get_file_info(arrow_fs.FileSelector(top, recursive=True)) if info.type == arrow_fs.FileType.Directory else [info]
        for x in infos:
            inside = x.path[len(top) :].split("/") if x is not info else []
            hidden = any(p[:1] in ("_", ".") for p in inside if p)
            if x.type == arrow_fs.FileType.File and not hidden and (not glob or fnmatch.fnmatch(x.base_name, glob)):
                found.append((_named(x.path, original), x.size))
    return sorted(set(found))


class _Stored:
    """The plain bytes of a file from its start, as far as they are asked for."""

    def __init__(self, path: str):
        system, place = _located(path)
        self.stream = system.open_input_stream(place, compression=None)
        self.make = _codec(path)
        self.codec = self.make() if self.make else None
        self.read, self.ended, self.path = 0, False, path

    def more(self, size: int) -> bytes:
        """What the next ``size`` stored bytes hold; nothing at the end."""
        stored = self.stream.read(size)
        self.read += len(stored)
        self.ended = len(stored) < size
        if self.codec is None:
            return stored
        plain = []
        while stored:
            plain.append(self.codec.decompress(stored))
            stored = self.codec.unused_data if self.codec.eof else b""
            if self.codec.eof and stored:
                self.codec = self.make()
        if self.ended and self.read and not self.codec.eof:
            raise EOFError(f"{self.path} ends inside its compressed data")
        return b"".join(plain)


def first_lines_of(path: str, count: int) -> tuple[list[bytes], int]:
    """The first lines of a file, split at line feeds only, and the stored bytes read for them."""
    stored, size = _Stored(path), FIRST_PIECE
    pieces, feeds = [], 0
    with stored.stream:
        while feeds < count and not stored.ended:
            piece = stored.more(size)
            pieces.append(piece)
            feeds += piece.count(b"\n")
            size = min(2 * size, LARGEST_PIECE)
    body = b"".join(pieces).removeprefix(_BOM)
    parts = body.split(b"\n", count)
    return (parts[:count] if len(parts) > count else parts if parts[-1] else parts[:-1]), stored.read


def sample_of(path: str, limit: int) -> tuple[int, int, int, bool, bool]:
    """Stored and plain bytes, line feeds, whether that is all, and whether a line without a line feed ends it."""
    stored, size = _Stored(path), min(FIRST_PIECE, limit)
    plain, feeds, last = 0, 0, b"\n"
    with stored.stream:
        # A sample goes on until it holds a line feed, whatever the limit.
        while not stored.ended and (stored.read < limit or feeds == 0):
            piece = stored.more(size)
            plain, feeds, last = plain + len(piece), feeds + piece.count(b"\n"), piece[-1:] or last
            size = min(2 * size, LARGEST_PIECE, max(limit - stored.read, FIRST_PIECE))
    return stored.read, plain, feeds, stored.ended, last != b"\n"


@dataclass
class Share(InputPartition):
    """The files of one task."""

    files: list[tuple[str, int]]


class HeadReader(DataSourceReader):
    def __init__(self, options: dict):
        self.paths = json.loads(options["paths"])
        self.glob = options.get("glob")
        self.lines = int(options.get("lines", 1))
        self.sample = int(options.get("sample", 0))
        self.share = int(options.get("files_per_task", FILES_PER_TASK))

    def partitions(self) -> list[Share]:
        files = listed(self.paths, self.glob)
        tasks = max(-(-len(files) // self.share), 1)
        return [Share(files[k::tasks]) for k in range(tasks)]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        for path, size in partition.files:
            known = None if path.endswith(".gz") else size
            if self.sample:
                told = sample_of(path, self.sample)
                columns = [[path], [size], *[[x] for x in told]]
                types = [pa.string(), *[pa.int64()] * 4, pa.bool_(), pa.bool_()]
                names = [c.split()[0] for c in SAMPLES.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
                continue
            values, read = first_lines_of(path, self.lines)
            n = len(values)
            arrays = [
                pa.array([path] * n, pa.string()),
                pa.array([known] * n, pa.int64()),
                pa.array(range(1, n + 1), pa.int64()),
                # As in Spark's own reader, bytes that are no UTF-8 stay what they are.
                pa.array(values, pa.binary()).view(pa.string()),
                pa.array([read] * n, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in LINES.split(", ")])


class HeadSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return SAMPLES if int(self.options.get("sample", 0)) else LINES

    def reader(self, schema) -> HeadReader:
        return HeadReader(dict(self.options))


def _source(spark: SparkSession, paths: str | list[str], glob: str | None, **options) -> DataFrame:
    spark.dataSource.register(HeadSource)
    names = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.format(NAME).option("paths", json.dumps(names)).options(**options)
    return (reader.option("glob", glob) if glob else reader).load()


def read_heads(
    spark: SparkSession, paths: str | list[str], lines: int = 1, glob: str | None = None, files_per_task: int = FILES_PER_TASK
) -> DataFrame:
    """The first ``lines`` lines of every file as a lines DataFrame, with ``line_no`` and the ``bytes_read`` of the file."""
    rows = _source(spark, paths, glob, lines=lines, files_per_task=files_per_task)
    return rows.select(
        "file", "file_size", F.lit(0).cast("bigint").alias("block"), F.col("line_no").alias("seq"), "line_no", "value", "bytes_read"
    )


def read_samples(
    spark: SparkSession, paths: str | list[str], sample: int = SAMPLE_BYTES, glob: str | None = None, files_per_task: int = FILES_PER_TASK
) -> DataFrame:
    """For each file its stored size and what its first ``sample`` stored bytes hold."""
    if sample < 1:
        raise ValueError("sample must be positive")
    return _source(spark, paths, glob, sample=sample, files_per_task=files_per_task)


def estimated_rows(samples: DataFrame) -> DataFrame:
    """Rows per file from the share of it that was sampled; ``exact`` where that is all of it.

    Stored bytes are held against stored bytes, so compressed files are estimated like plain ones.
    """
    rows = F.col("line_feeds") + F.when(F.col("whole") & F.col("open_line"), 1).otherwise(0)
    scaled = F.round(F.col("line_feeds") * (F.col("file_size") / F.col("bytes_read"))).cast("bigint")
    return samples.select(
        "file", F.when(F.col("whole"), rows).otherwise(scaled).alias("estimated_rows"), F.col("whole").alias("exact"), "bytes_read"
    )
