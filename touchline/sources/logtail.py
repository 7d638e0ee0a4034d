"""Follow growing log files: a streaming source whose offset is a byte position per file.

A line comes once it ends with a newline; a line that is still being written waits. Files are known by their
identity on disk and not by name, so a file that is renamed while it is rotated is finished under its new name
and its successor starts at its beginning. The positions lie in the query's checkpoint: a restarted query goes on
where the last batch ended, and a repeated batch reads the same bytes again.

The folder must be one that the driver and all executors mount; files in an object store do not grow, and
``read_app_logs`` reads those. Long ranges are cut into pieces for several tasks: a line belongs to the piece in
which it begins. The driver keeps one position per file and looks at the last bytes of files that changed.

Options: ``path`` (folder), ``pattern`` (files to follow, ``*.log*``), ``live`` (files that are being written, ``*.log``),
``fromStart`` (``true``: lines there at the first start, ``false``: only later ones), ``settleSeconds`` (a rotated file
unchanged for so long ends with its last line, newline or not), ``pieceBytes`` and ``failOnDataLoss`` (``true``: a file that
vanished or shrank before its lines were read fails the query).

A file that is cut to a smaller size is read from its beginning again; one that was cut and has grown beyond the old
position between two batches cannot be told from one that only grew. Bytes that are not UTF-8 become replacement
characters; a carriage return before the newline is dropped; an empty line is a row with an empty ``value``.
"""

from __future__ import annotations

import os
import time
from collections.abc import Iterator
from fnmatch import fnmatch
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "file string, position bigint, value string"
_ARROW = pa.schema([("file", pa.string()), ("position", pa.int64()), ("value", pa.string())])
_BLOCK = 1 << 20
_TAIL = 1 << 16


def local_path(path: str) -> str:
    """The folder behind a ``file:`` URI, or the path itself."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _identity(stat: os.stat_result) -> str:
    return f"{stat.st_dev}-{stat.st_ino}"


class LogPiece(InputPartition):
    """Lines of one file that begin in ``start .. end``; ``first``: ``start`` is itself the beginning of a line."""

    def __init__(self, folder: str, name: str, identity: str, start: int, end: int, first: bool) -> None:
        self.folder, self.name, self.identity = folder, name, identity
        self.start, self.end, self.first = start, end, first


class LogTail(DataSource):
    """``spark.readStream.format("logtail")``; see the module."""

    @classmethod
    def name(cls) -> str:
        return "logtail"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> LogTailReader:  # noqa: N802
        return LogTailReader(dict(self.options))


class LogTailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]) -> None:
        options = {k.lower(): v for k, v in options.items()}
        self._folder = local_path(options["path"])
        self._pattern = options.get("pattern", "*.log*")
        self._live = options.get("live", "*.log")
        self._from_start = options.get("fromstart", "true").lower() == "true"
        self._settle = float(options.get("settleseconds", "60"))
        self._piece = int(options.get("piecebytes", str(64 << 20)))
        self._strict = options.get("failondataloss", "true").lower() == "true"
        self._ended: dict[str, tuple[int, int]] = {}

    # --- driver: offsets -----------------------------------------------------------

    def initialOffset(self) -> dict:  # noqa: N802
        """No file is known yet; with ``skip`` the first batch only marks where the files end."""
        return {"files": {}, "skip": not self._from_start}

    def latestOffset(self) -> dict:  # noqa: N802
        files = {}
        for name, stat in self._listed():
            key = _identity(stat)
            files[key] = {"name": name, "at": self._end_of_lines(name, key, stat)}
        # In one order: Spark compares offsets by their text.
        return {"files": dict(sorted(files.items())), "skip": False}

    def partitions(self, start: dict, end: dict) -> list[LogPiece]:
        if start["skip"]:
            return []
        pieces = []
        for key, now in sorted(end["files"].items()):
            at, to = start["files"].get(key, {"at": 0})["at"], now["at"]
            if to < at:  # cut: what is there now is new
                at = 0
            for a in range(at, to, self._piece):
                pieces.append(LogPiece(self._folder, now["name"], key, a, min(a + self._piece, to), a == at))
        return pieces

    def _listed(self) -> Iterator[tuple[str, os.stat_result]]:
        if not os.path.isdir(self._folder):  # wait for it
            return
        with os.scandir(self._folder) as entries:
            for e in entries:
                if fnmatch(e.name, self._pattern) and e.is_file():
                    try:
                        # Not from the listing, which may lag on some file systems.
                        yield e.name, os.stat(e.path)
                    except FileNotFoundError:
                        continue

    def _end_of_lines(self, name: str, key: str, stat: os.stat_result) -> int:
        """Where the last whole line of a file ends; its size, if it is rotated and has settled."""
        if not fnmatch(name, self._live) and time.time() - stat.st_mtime >= self._settle:
            return stat.st_size
        size, end = self._ended.get(key, (-1, 0))
        if size != stat.st_size:
            try:
                with open(os.path.join(self._folder, name), "rb") as f:
                    end = _last_newline(f, stat.st_size)
            except FileNotFoundError:
                return end
            self._ended[key] = (stat.st_size, end)
        return end

    # --- executors: lines ----------------------------------------------------------

    def read(self, partition: LogPiece) -> Iterator[pa.RecordBatch]:
        handle = _opened(partition)
        if handle is None:
            if self._strict:
                raise FileNotFoundError(f"{partition.folder}/{partition.name} went before its lines were read")
            return
        with handle:
            if os.fstat(handle.fileno()).st_size < partition.end and self._strict:
                raise EOFError(f"{partition.folder}/{partition.name} shrank before its lines were read")
            yield from _lines(handle, partition)


def _last_newline(f: BinaryIO, size: int) -> int:
    """Place after the last newline among the first ``size`` bytes."""
    at = size
    while at > 0:
        low = max(0, at - _TAIL)
        f.seek(low)
        found = f.read(at - low).rfind(b"\n")
        if found >= 0:
            return low + found + 1
        at = low
    return 0


def _opened(piece: LogPiece) -> BinaryIO | None:
    """The file of a piece, also if it was renamed meanwhile."""
    names = [piece.name, *(n for n in sorted(os.listdir(piece.folder)) if n != piece.name)] if os.path.isdir(piece.folder) else []
    for name in names:
        try:
            handle = open(os.path.join(piece.folder, name), "rb")  # noqa: SIM115
        except OSError:
            continue
        if _identity(os.fstat(handle.fileno())) == piece.identity:
            return handle
        handle.close()
    return None


def _lines(f: BinaryIO, piece: LogPiece) -> Iterator[pa.RecordBatch]:
    """Arrow batches of the lines that begin inside the piece; memory follows a block, or the longest line."""
    at = piece.start
    f.seek(at)
    if not piece.first:  # the line that runs into the piece belongs to the one before
        f.seek(at - 1)
        at += len(f.readline()) - 1
    places: list[int] = []
    values: list[str] = []
    held = 0

    def batch() -> pa.RecordBatch:
        n = len(values)
        columns = [pa.array([piece.name] * n, pa.string()), pa.array(places, pa.int64()), pa.array(values, pa.string())]
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    while at < piece.end:
        line = f.readline()
        if not line:
            break
        places.append(at)
        values.append(line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace"))
        at += len(line)
        held += len(line)
        if held >= _BLOCK:
            yield batch()
            places, values, held = [], [], 0
    if values:
        yield batch()


def follow_app_logs(
    spark: SparkSession, path: str, from_start: bool = True, **options: str | int | float
) -> DataFrame:
    """Lines appended to the log files of a folder, as a stream ``(file, position, value)``."""
    spark.dataSource.register(LogTail)
    reader = spark.readStream.format("logtail").option("path", path).option("fromStart", str(from_start).lower())
    return reader.options(**{k: str(v) for k, v in options.items()}).load()
