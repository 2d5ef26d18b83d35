"""Signature archives (*.sig.zip): discovery and decoding.

An archive is a zip holding gzip-compressed JSON members. Spark lists, splits and
schedules the files; inside a task one small function unpacks each archive.
"""

from __future__ import annotations

import gzip
import io
import json
import zipfile
from collections.abc import Collection, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraclake.functions.paths import ARCHIVE_SUFFIX, MEMBER_FOLDER, MEMBER_SUFFIX
from fraclake.sinks.archives import file_system
from fraclake.sources.files import OPEN_BYTES, TASKS, dealt_by_bytes, list_files
from fraclake.types import ARCHIVE_ROWS

_SLICE = 1 << 16
_ROWS_PER_BATCH = 256

_ARROW = pa.schema([
    ("path", pa.string()), ("member", pa.string()), ("status", pa.string()), ("error", pa.string()),
    ("archive_head", pa.bool_()), ("member_head", pa.bool_()), ("sketch_head", pa.bool_()),
    ("filename", pa.string()), ("ksize", pa.int32()), ("scaled", pa.int64()),
    ("max_hash", pa.decimal128(20, 0)), ("num_hashes", pa.int64()), ("hashes", pa.list_(pa.int64())),
])


def find_archives(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """All archives under ``root``, or only those one directory down."""
    reader = spark.read.format("binaryFile")
    if recursive:
        return (reader.option("recursiveFileLookup", True)
                .option("pathGlobFilter", "*" + ARCHIVE_SUFFIX).load(root))
    return reader.load(f"{root.rstrip('/')}/*/*{ARCHIVE_SUFFIX}")


def list_archives(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """(path, length, mtime) of all archives under ``root``, or only those one directory down."""
    if recursive:
        return list_files(spark, root, ARCHIVE_SUFFIX)
    below = len([p for p in root.split("/") if p]) + 2
    return list_files(spark, root, ARCHIVE_SUFFIX, 1).where(F.size(F.filter(F.split("path", "/"), lambda p: p != "")) == below)


def decode_archives(files: DataFrame, ksizes: Collection[int] | None = None,
                    root_only: bool = False) -> DataFrame:
    """Unpack (path, content) rows into ARCHIVE_ROWS.

    Each archive and each member fails on its own. The ``*_head`` flags mark one row
    per archive, member and sketch, so that counts need no second pass. ``status``:

    ``ok``           the member gave sketches of a wanted k
    ``no_match``     it was read but holds no wanted k
    ``bad_content``  it was unpacked but its JSON or a value is wrong
    ``bad_read``     it could not be unpacked
    ``bad_archive``  the file is not a readable zip
    ``bad_open``     the store did not give the file, or broke off while it was read
    ``empty``        the zip holds no signature members

    Long hash vectors are cut into several rows, so no row or batch grows with the
    size of a sketch. ``ksizes=None`` keeps every k.
    """
    wanted = None if ksizes is None else frozenset(ksizes)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                for row in archive_rows(path, content.as_py(), wanted, root_only):
                    rows.append(row)
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield _record_batch(rows)
                        rows = []
        if rows:
            yield _record_batch(rows)

    return files.select("path", "content").mapInArrow(unpack, ARCHIVE_ROWS)


def decode_archive_files(paths: DataFrame, ksizes: Collection[int] | None = None, root_only: bool = False,
                         deal: bool = True) -> DataFrame:
    """The same for (path, length) rows: each file is opened by its task, which seeks to the members it
    wants. So a file of any size is read, member by member, and no file passes through Spark.

    Files are dealt to tasks by their bytes first: lists are short, and left as they come they are
    few tasks, whatever the archives hold. ``deal=False`` leaves (path,) rows where they are."""
    wanted = None if ksizes is None else frozenset(ksizes)
    if deal:
        paths = dealt_by_bytes(paths, TASKS * paths.sparkSession.sparkContext.defaultParallelism, open_bytes=OPEN_BYTES)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                for row in opened_rows(uri, wanted, root_only):
                    rows.append(row)
                    if len(rows) >= _ROWS_PER_BATCH:
                        yield _record_batch(rows)
                        rows = []
        if rows:
            yield _record_batch(rows)

    return paths.select("path").mapInArrow(unpack, ARCHIVE_ROWS)


def opened_rows(uri: str, wanted: frozenset | None, root_only: bool) -> Iterator[tuple]:
    """Rows of one archive that is opened by its path."""
    try:
        store, path = file_system(uri)
        file = store.open_input_file(path)
    except Exception as problem:
        yield (uri, None, "bad_open", str(problem), True, False, False) + (None,) * 6
        return
    with file:
        yield from archive_rows(uri, file, wanted, root_only)


def _record_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def archive_rows(path: str, content: bytes | pa.NativeFile, wanted: frozenset | None, root_only: bool) -> Iterator[tuple]:
    """Rows of one archive, given as bytes or as an open file."""
    first = True
    try:
        with zipfile.ZipFile(io.BytesIO(content) if isinstance(content, bytes) else content) as archive:
            for name in archive.namelist():
                inside = name.startswith(MEMBER_FOLDER) or (not root_only and "/" + MEMBER_FOLDER in name)
                if not inside or not name.endswith(MEMBER_SUFFIX):
                    continue
                status, error, sketches = _member(archive, name, wanted)
                head = True
                if not sketches:
                    yield (path, name, status, error, first, True, False, None, None, None, None, None, None)
                    first = False
                    continue
                for filename, k, scaled, max_hash, bits in sketches:
                    for lo in range(0, len(bits), _SLICE):
                        yield (path, name, status, error, first, head, lo == 0, filename, k, scaled, max_hash,
                               len(bits), bits[lo:lo + _SLICE])
                        first = head = False
    except OSError as problem:  # not the archive's fault: another attempt may succeed
        yield (path, None, "bad_open", str(problem), first, False, False) + (None,) * 6
        return
    except Exception as problem:  # an unreadable archive must not fail the task
        yield (path, None, "bad_archive", str(problem), first, False, False) + (None,) * 6
        return
    if first:
        yield (path, None, "empty", None, True, False, False) + (None,) * 6


def _member(archive: zipfile.ZipFile, name: str, wanted: frozenset | None) -> tuple[str, str | None, list]:
    """Status, error and sketches of one member; all of its values count or none."""
    try:
        packed = archive.read(name)
    except OSError:
        raise
    except Exception as problem:
        return "bad_read", str(problem), []
    try:
        raw = gzip.decompress(packed)
    except Exception as problem:
        return "bad_read", str(problem), []
    try:
        sketches = list(_sketches(json.loads(raw), wanted))
    except Exception as problem:
        return "bad_content", str(problem), []
    return ("ok" if sketches else "no_match"), None, sketches


def _sketches(document: object, wanted: frozenset | None) -> Iterator[tuple]:
    """Sketches of a record, a list of records, or bare signatures."""
    for record in document if isinstance(document, list) else [document]:
        if not isinstance(record, dict):
            continue
        nested = record.get("signatures")
        signatures = nested if isinstance(nested, list) else [record]
        for signature in signatures:
            if not isinstance(signature, dict):
                continue
            k = signature.get("ksize")
            if k is None or (wanted is not None and k not in wanted):
                continue
            values = signature.get("mins") or signature.get("hashes")
            if not values:
                continue
            if isinstance(values, dict):
                values = [int(v) for v in values]
            bits = np.asarray(values, dtype=np.uint64).view(np.int64)
            scaled, top, name = signature.get("scaled"), signature.get("max_hash"), record.get("filename")
            if name is not None and not isinstance(name, str):
                raise ValueError(f"filename is no text: {name!r}")
            top = _whole(top, "max_hash", 0, None) if top else None
            yield (name, _whole(k, "ksize", 1, (1 << 31) - 1), None if scaled is None else _whole(scaled, "scaled", 0, (1 << 63) - 1),
                   None if top is None else Decimal(min(top, 1 << 64)), bits)


def _whole(value: object, name: str, least: int, most: int | None) -> int:
    """A number from the metadata, checked to fit its column."""
    number = int(value)
    if number < least or most is not None and number > most:
        raise ValueError(f"{name} out of range: {value!r}")
    return number


def resolved_scale() -> Column:
    """``scaled``, else derived from ``max_hash``, else 0 when neither is known."""
    whole = F.expr(f"CAST({1 << 64} AS DECIMAL(20,0))")
    top = F.nullif(F.col("max_hash"), F.lit(0).cast("decimal(20,0)"))
    derived = F.when(top >= whole, F.lit(1).cast("bigint")).otherwise((whole / top).cast("double").cast("bigint"))
    return F.coalesce(F.col("scaled"), derived, F.lit(0).cast("bigint"))


def sketch_name() -> Column:
    """The recorded file name, else the archive itself."""
    return F.coalesce(F.nullif(F.col("filename"), F.lit("")), F.col("path"))


def flat_hashes(rows: DataFrame) -> DataFrame:
    """(hash, ksize, scaled, source_file, sketch_name), one row per hash as stored."""
    return rows.where(F.size("hashes") > 0).select(
        F.explode("hashes").alias("hash"), "ksize", resolved_scale().alias("scaled"),
        F.col("path").alias("source_file"), sketch_name().alias("sketch_name"))


def sketch_rows(rows: DataFrame) -> DataFrame:
    """One row per sketch with its number of stored hashes."""
    return rows.where("sketch_head").select(
        "path", "member", "ksize", resolved_scale().alias("scaled"), "num_hashes",
        sketch_name().alias("sketch_name"))
