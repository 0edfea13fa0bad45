"""Log files read in byte ranges: lines, or innermost objects that may span lines; and many small files written.

A Python data source. Files are cut into ranges of some bytes, whatever is in them, and each range gives what begins in
it, reading on behind its end where something is still open there. So the byte at which a line or object begins
is its order in the file, and no task needs what another one read.
"""

from __future__ import annotations

import pickle
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 64 << 20
BLOCK = 1 << 20
BATCH_BYTES = 4 << 20
_LINE_END = re.compile(rb"\r\n|\n|\r")
_INNERMOST = re.compile(rb"\{[^{}]+\}")
_BRACE = re.compile(rb"[{}]")


class Ranges(InputPartition):
    """(file, start, end) of some ranges; packed, since there may be as many as files."""

    def __init__(self, ranges: list[tuple[str, int, int]]) -> None:
        super().__init__(None)
        self.packed = zlib.compress(pickle.dumps(ranges), 1)

    @property
    def ranges(self) -> list[tuple[str, int, int]]:
        return pickle.loads(zlib.decompress(self.packed))


def lines(f: BinaryIO, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The lines that begin in [start, end), without their ends, each with its first byte."""
    at = max(start - 1, 0)
    f.seek(at)
    held, begin, done = b"", (0 if start == 0 else None), False
    while not done:
        block = f.read(BLOCK)
        held += block
        done, cut = not block, 0
        for m in _LINE_END.finditer(held):
            if m.end() == len(held) and m.group() == b"\r" and not done:
                break  # a line feed may follow
            if begin is not None:
                yield begin, held[begin - at:m.start()]
            begin, cut = at + m.end(), m.end()
            if begin >= end:
                return
        # What is kept begins with the open line, or with a line end that may go on.
        keep = begin - at if begin is not None else max(cut, len(held) - 1)
        held, at = held[keep:], at + keep
    if begin is not None and begin < end and held:
        yield begin, held


def objects(f: BinaryIO, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The objects without inner braces that begin in [start, end), each with its first byte."""
    at, held = start, b""
    f.seek(start)
    while at + len(held) < end:
        block = f.read(BLOCK)
        if not block:
            break
        held += block
        last = -1
        for m in _INNERMOST.finditer(held):
            if at + m.start() >= end:
                return
            yield at + m.start(), m.group()
            last = m.end() - 1
        # A brace that is still open behind the last object waits for more.
        open_ = max(held.rfind(b"{"), held.rfind(b"}"))
        keep = open_ if open_ > last and held[open_:open_ + 1] == b"{" else len(held)
        held, at = held[keep:], at + keep
    if held and at < end:
        found = _closed(f, at + len(held))
        if found is not None:
            f.seek(at)
            body = f.read(found - at)
            if len(body) > 2:
                yield at, body


def _closed(f: BinaryIO, at: int) -> int | None:
    """Where the next brace from `at` ends, if it is a closing one. Nothing is kept on the way."""
    f.seek(at)
    while block := f.read(BLOCK):
        if m := _BRACE.search(block):
            return at + m.end() if m.group() == b"}" else None
        at += len(block)
    return None


def whole(f: BinaryIO, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """The file, for the range that it begins in."""
    if start == 0:
        yield 0, f.read()


_UNITS = {"line": lines, "object": objects, "file": whole}
_ESCAPED = re.compile(r'[\x00-\x20"#%<>?\[\\\]^`{|}\x7f]')


def _uri(path: str) -> str:
    """A local path as Spark names it in `_metadata.file_path`."""
    return "file:" + _ESCAPED.sub(lambda m: f"%{ord(m.group()):02X}", path)


def local(path: str) -> bool:
    """Whether this is a file or folder of this machine or a mounted one, and no pattern."""
    if path.startswith("/") and "://" not in path or path.startswith("file:/"):
        filesystem, root = _filesystem(path)
        return filesystem.get_file_info(root).type != pafs.FileType.NotFound
    return False


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


class LogReader(DataSourceReader):
    def __init__(self, path: str, unit: str, split_bytes: int) -> None:
        self.path, self.unit, self.split_bytes = path, unit, split_bytes

    def _files(self) -> Iterator[tuple[str, int]]:
        """The files and their bytes, a folder at a time."""
        filesystem, root = _filesystem(self.path)
        if filesystem.get_file_info(root).type == pafs.FileType.File:
            yield root, filesystem.get_file_info(root).size
            return
        folders = [root]
        while folders:
            found = filesystem.get_file_info(pafs.FileSelector(folders.pop()))
            seen = sorted((x.path, x.size, x.type) for x in found if self._seen(x))
            yield from ((path, size) for path, size, kind in seen if kind == pafs.FileType.File and size)
            folders.extend(path for path, _, kind in reversed(seen) if kind == pafs.FileType.Directory)

    def _seen(self, x: pafs.FileInfo) -> bool:
        if self.unit == "file":  # as Spark's readers: of folders those that name a partition
            return not x.base_name.startswith(".") and ("=" in x.base_name or x.type == pafs.FileType.File and x.base_name[:1] != "_")
        return not x.base_name.startswith(("_", "."))

    def partitions(self) -> list[Ranges]:
        """Ranges of large files, and small files together, up to the bytes of a split."""
        out, held, size = [], [], 0
        for path, total in self._files():
            for start in range(0, total, self.split_bytes):
                end = min(start + self.split_bytes, total)
                if held and size + end - start > self.split_bytes:
                    out.append(Ranges(held))
                    held, size = [], 0
                held.append((path, start, end))
                size += end - start
        return [*out, Ranges(held)] if held else out or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        filesystem, _ = _filesystem(self.path)
        rows, size = [], 0  # of several files, when these are small
        for path, start, end in partition.ranges:
            # a file read whole may be compressed, as for Spark's readers
            name, opened = (_uri(path), filesystem.open_input_stream) if self.unit == "file" else (path, filesystem.open_input_file)
            with opened(path) as f:
                for at, body in _UNITS[self.unit](f, start, end):
                    rows.append((name, at, body.decode("utf-8", "replace")))
                    size += len(name) + len(body) + 16
                    if size > BATCH_BYTES:
                        yield _batch(rows)
                        rows, size = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[tuple[str, int, str]]) -> pa.RecordBatch:
    paths, places, values = zip(*rows, strict=True)
    return pa.record_batch([pa.array(paths, pa.string()), pa.array(places, pa.int64()), pa.array(values, pa.string())],
                           ["file", "seq", "value"])


class LogFiles(DataSource):
    """Options: path (a file or folder), unit (line, object or file), split_bytes."""

    @classmethod
    def name(cls) -> str:
        return "log_files"

    def schema(self) -> str:
        return "file string, seq bigint, value string"

    def reader(self, schema) -> LogReader:  # noqa: ANN001
        unit = self.options.get("unit", "line")
        if unit not in _UNITS:
            raise ValueError(f"unit is line, object or file, not {unit}")
        return LogReader(self.options["path"], unit, int(self.options.get("split_bytes", SPLIT_BYTES)))


def read_units(spark: SparkSession, path: str, unit: str = "line", split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """file, seq (the first byte in the file) and value of the lines or innermost objects of log files, or of the files themselves."""
    spark.dataSource.register(LogFiles)
    return spark.read.format("log_files").option("unit", unit).option("split_bytes", split_bytes).load(path)


def write_files(rows: DataFrame, key: str, folder: str, value: str = "value") -> None:
    """Print `value` to a file for each value of `key`, a line for each row; its name begins with `key=` and that value.

    Rows of one value in several tasks go to a file for each of these. Files are made with pyarrow, as Spark's writer
    takes some 20 ms for each one in a folder of its own. A task's folder gets its name when all files are in it.
    """
    rows = rows.select(F.coalesce(F.col(key).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias("key"), F.col(value).cast("binary"), key)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = _filesystem(folder)
        part = f"{TaskContext.get().partitionId():06d}"
        trial, name, out, n = f"{root}/.{part}-{uuid.uuid4().hex}", None, None, 0
        for b in batches:
            for own, body in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                if own != name:
                    if out is None:
                        filesystem.create_dir(trial, recursive=True)
                    else:
                        out.close()
                    name, n = own, n + 1
                    out = filesystem.open_output_stream(f"{trial}/{key}={name}-{part}.txt")
                if body.is_valid:
                    out.write(body.as_buffer())
                out.write(b"\n")
        if out is not None:
            out.close()
            whole = f"{root}/part={part}"
            if filesystem.get_file_info(whole).type == pafs.FileType.NotFound:  # else an earlier attempt has left it
                filesystem.move(trial, whole)
        yield pa.record_batch([pa.array([n])], ["files"])

    filesystem, root = _filesystem(folder)
    filesystem.create_dir(root, recursive=True)
    rows.sortWithinPartitions(key).drop(key).mapInArrow(write, "files bigint").agg(F.sum("files")).collect()
