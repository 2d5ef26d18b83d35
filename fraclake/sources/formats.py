"""Signature archives and raw vectors as formats of ``spark.read``, archives also of ``spark.readStream``.

``register(spark)``, then ``spark.read.format("signature_archives").load(root)`` has the rows of
``decode_archive_files``, and ``spark.read.format("hash_vectors").load(root)`` those of
``read_vectors``. Filters on ``ksize`` are pushed into the readers, those on ``part`` into that of
vectors: archives then decode only sketches of those k and give no rows about members without
any, and folders of vectors with other k or parts are not opened. Files are never listed on the
driver.

``spark.readStream.format("signature_archives").load(root)`` has the same rows of archives in the
order in which they came. Its offsets are times: a batch reads what was put there since the last
one, and an archive that is replaced is read again. Each batch opens every folder, so triggers
should be minutes apart.
"""

from __future__ import annotations

import re
import time
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from fraclake.functions.paths import ARCHIVE_SUFFIX
from fraclake.sources.archives import _ROWS_PER_BATCH, _record_batch, opened_rows
from fraclake.sources.files import _children
from fraclake.sources.vectors import KSIZE_FOLDER, PART_FOLDER, RANGE, vector_slices
from fraclake.types import ARCHIVE_ROWS

NAME, VECTORS = "signature_archives", "hash_vectors"
#: Folders that the planner looks for at most, and parts into which the files of a folder above them fall.
FOLDERS, PARTS = 1024, 8
#: Seconds for which what has come is left alone, so that no file gets an earlier time than a batch that is over.
SETTLE = 10.0


@dataclass
class FolderPart(InputPartition):
    """The files below a folder, or directly in it, or one part of ``parts`` of them."""

    folder: str
    deep: bool
    part: int = 0
    parts: int = 1


@dataclass
class Arrivals(InputPartition):
    """Those that came after ``since``, and not after ``until``."""

    files: FolderPart
    since: float
    until: float


def _any(_folder: str) -> bool:
    return True


def folder_parts(root: str, parts: int, deep_parts: int = 1, wanted: Callable[[str], bool] = _any) -> list[FolderPart]:
    """Folders are opened level by level until there are many; files are left to the tasks."""
    found, frontier = [], [root]
    while frontier and len(frontier) < FOLDERS // 4:
        found += [FolderPart(f, False, i, parts) for f in frontier for i in range(parts)]
        below = [f"{top.rstrip('/')}/{name}" for top in frontier for name, _, _, is_folder in _children(top) if is_folder]
        frontier = [f for f in below if wanted(f)]
    return found + [FolderPart(f, True, i, deep_parts) for f in frontier for i in range(deep_parts)]


def files_of(part: FolderPart, came: bool = False, wanted: Callable[[str], bool] = _any) -> Iterator[tuple[str, int, float]]:
    """(path, length, time) of all files of a folder, which is walked as they are asked for; parts are not told apart."""
    waiting = [part.folder]
    while waiting:
        top = waiting.pop()
        for name, size, when, is_folder in _children(top, came):
            path = f"{top.rstrip('/')}/{name}" if name else top
            if not is_folder:
                yield path, size, when
            elif part.deep and wanted(path):
                waiting.append(path)


def falls_to(part: FolderPart, name: str) -> bool:
    return zlib.crc32(name.encode()) % part.parts == part.part


def archive_batches(paths: Iterable[str], ksizes: frozenset | None, root_only: bool, found_only: bool) -> Iterator[pa.RecordBatch]:
    """The rows of archives; with ``found_only`` none about members without a wanted k."""
    rows: list[tuple] = []
    for path in paths:
        for row in opened_rows(path, ksizes, root_only):
            if found_only and row[8] is None:
                continue
            rows.append(row)
            if len(rows) >= _ROWS_PER_BATCH:
                yield _record_batch(rows)
                rows = []
    if rows:
        yield _record_batch(rows)


def _values_asked(one: Filter, column: str) -> frozenset | None:
    """The values that a filter lets a column have; None if it says something else."""
    if isinstance(one, (EqualTo, In)) and one.attribute == (column,):
        return frozenset([one.value] if isinstance(one, EqualTo) else one.value)
    return None


class ArchiveReader(DataSourceReader):
    def __init__(self, root: str, root_only: bool) -> None:
        self.root, self.root_only = root, root_only
        self.ksizes: frozenset | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            asked = _values_asked(one, "ksize")
            if asked is None:
                yield one
            else:
                self.ksizes = asked if self.ksizes is None else self.ksizes & asked

    def partitions(self) -> list[InputPartition]:
        return folder_parts(self.root, PARTS)

    def read(self, part: FolderPart) -> Iterator[pa.RecordBatch]:
        paths = (p for p, _, _ in files_of(part) if p.endswith(ARCHIVE_SUFFIX) and falls_to(part, p))
        return archive_batches(paths, self.ksizes, self.root_only, self.ksizes is not None)


class ArchiveStream(DataSourceStreamReader):
    """Archives by the time at which they came: for local files that of their last change of any
    kind, a rename or new times included, elsewhere the time that the store tells."""

    def __init__(self, root: str, root_only: bool, ksizes: frozenset | None, settle: float) -> None:
        self.root, self.root_only, self.ksizes, self.settle = root, root_only, ksizes, settle
        self.reached = 0.0

    def initialOffset(self) -> dict:
        return {"until": 0.0}

    def latestOffset(self) -> dict:
        self.reached = max(self.reached, time.time() - self.settle)
        return {"until": self.reached}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        self.reached = max(self.reached, start["until"], end["until"])
        return [Arrivals(p, start["until"], end["until"]) for p in folder_parts(self.root, PARTS)]

    def read(self, part: Arrivals) -> Iterator[pa.RecordBatch]:
        paths = (p for p, _, came in files_of(part.files, came=True)
                 if part.since < came <= part.until and p.endswith(ARCHIVE_SUFFIX) and falls_to(part.files, p))
        return archive_batches(paths, self.ksizes, self.root_only, False)


class VectorReader(DataSourceReader):
    """Ranges of files are dealt to the tasks of a folder, so those of one large file are shared."""

    def __init__(self, root: str, suffix: str, values: int) -> None:
        self.root, self.suffix, self.values = root, suffix, values
        self.ksizes: frozenset | None = None
        self.part_names: frozenset | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for one in filters:
            ksizes, names = _values_asked(one, "ksize"), _values_asked(one, "part")
            if ksizes is not None:
                self.ksizes = ksizes if self.ksizes is None else self.ksizes & ksizes
            elif names is not None:
                self.part_names = names if self.part_names is None else self.part_names & names
            else:
                yield one

    def about(self, path: str) -> tuple[int | None, str]:
        k, part = re.search(KSIZE_FOLDER, path), re.search(PART_FOLDER, path)
        return int(k[1]) if k else None, part[1] if part else ""

    def wanted(self, folder: str) -> bool:
        """Whether files below may have a k and part that were asked for."""
        k, part = self.about(f"{folder}/")
        return (self.ksizes is None or k is None or k in self.ksizes) and (self.part_names is None or not part or part in self.part_names)

    def partitions(self) -> list[InputPartition]:
        return folder_parts(self.root, PARTS, PARTS, self.wanted)

    def read(self, part: FolderPart) -> Iterator[pa.RecordBatch]:
        for path, length, _ in files_of(part, wanted=self.wanted):
            k, name = self.about(path)
            if not path.endswith(self.suffix) or self.ksizes is not None and k not in self.ksizes or self.part_names is not None and name not in self.part_names:
                continue
            for piece in range(-(-length // (8 * self.values))):
                if falls_to(part, f"{path}/{piece}"):
                    for bits in vector_slices(path, 8 * piece * self.values, 8 * self.values):
                        about = [pa.repeat(pa.scalar(v, t), len(bits)) for v, t in ((k, pa.int32()), (name, pa.string()))]
                        yield pa.RecordBatch.from_arrays([*about, pa.array(bits)], names=["ksize", "part", "hash"])


class ArchiveFormat(DataSource):
    """``path`` is the folder; ``root_only`` leaves out members whose signatures folder is nested. For
    streams, ``ksizes`` are the wanted k (``15,31``; all by default), and ``settle`` the seconds
    for which what has come is left alone."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return ARCHIVE_ROWS

    def _root(self) -> tuple[str, bool]:
        return _folder(self.options), str(self.options.get("root_only", "false")).lower() == "true"

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(*self._root())

    def streamReader(self, schema: StructType) -> ArchiveStream:
        ksizes = frozenset(int(k) for k in self.options.get("ksizes", "").split(",") if k.strip())
        return ArchiveStream(*self._root(), ksizes or None, float(self.options.get("settle", SETTLE)))


class VectorFormat(DataSource):
    """``path`` is the folder, ``suffix`` what names of files end with (``.bin``, or ``.npy``), ``values`` the
    length of a range in values of eight bytes. Unreadable or empty files give no rows."""

    @classmethod
    def name(cls) -> str:
        return VECTORS

    def schema(self) -> str:
        return "ksize int, part string, hash bigint"

    def reader(self, schema: StructType) -> VectorReader:
        values = int(self.options.get("values", RANGE))
        if values < 1:
            raise ValueError("a range needs a value at least")
        return VectorReader(_folder(self.options), self.options.get("suffix", ".bin"), values)


def _folder(options: dict) -> str:
    if "path" not in options:
        raise ValueError("the folder of the files is needed: load(path)")
    return options["path"]


def register(spark: SparkSession) -> None:
    """Make the formats known to the session and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for one in (ArchiveFormat, VectorFormat):
        spark.dataSource.register(one)
