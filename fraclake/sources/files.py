"""Lists of files as tables, and work dealt out by bytes."""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fraclake.shared import stored
from fraclake.sinks.archives import file_system

#: Entries that leave a task at a time, and bytes of files that one task is dealt.
_ENTRIES, TASK_BYTES = 10_000, 64 << 20

#: Tasks for each core that work is dealt to, and the bytes that opening a file counts as.
TASKS, OPEN_BYTES = 4, 16 << 10

_LISTED = "path string, length bigint, mtime double, folder boolean"


def _children(uri: str, came: bool = False) -> Iterator[tuple[str, int, float, bool]]:
    """What is directly in a folder, or the file itself. A local folder is read entry by entry, so a
    wide one fills no memory; other stores answer with one list for a folder. With ``came`` the
    time is when a local file was put there, which copies that keep times do not set back."""
    store, path = file_system(uri)
    if isinstance(store, fs.LocalFileSystem) and os.path.isdir(path):
        with os.scandir(path) as found:
            for entry in found:
                try:
                    told = entry.stat()
                except FileNotFoundError:  # it went meanwhile
                    continue
                yield entry.name, told.st_size, told.st_ctime if came else told.st_mtime, entry.is_dir()
        return
    top = store.get_file_info(path)
    for info in [top] if top.is_file else store.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        yield info.base_name if info is not top else "", info.size or 0, info.mtime_ns / 1e9 if info.mtime_ns else 0.0, info.type == fs.FileType.Directory


def _level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.float64(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 4, kinds)], names=["path", "length", "mtime", "folder"])

    rows: list[tuple] = []
    for batch in batches:
        for uri in batch.column("path").to_pylist():
            for name, size, mtime, folder in _children(uri):
                rows.append((f"{uri.rstrip('/')}/{name}" if name else uri, size, mtime, folder))
                if len(rows) >= _ENTRIES:
                    yield batch_of(rows)
                    rows = []
    yield batch_of(rows)


def list_files(spark: SparkSession, root: str, suffix: str = "", levels: int | None = None) -> DataFrame:
    """(path, length, mtime) of the files under ``root`` whose names end so.

    Folders are opened level by level, all those of a level in parallel, and each level is a
    written table: neither files nor folders are ever listed on the driver. ``levels``
    bounds how deep folders are opened; with 1 only those at the top are.
    """
    found, depth = [], 0
    frontier = spark.createDataFrame([(root.rstrip("/") or "/",)], "path string")
    while levels is None or depth <= levels:
        level = stored(frontier.mapInArrow(_level, _LISTED), "listing")
        found.append(level.where(~F.col("folder") & F.col("path").endswith(suffix)).drop("folder"))
        folders = level.where("folder").select("path")
        if folders.isEmpty():
            break
        # dealt in turn; a wide level becomes many tasks of some hundred folders
        frontier = folders.repartition(min(4096, max(spark.sparkContext.defaultParallelism, -(-folders.count() // 256))))
        depth += 1
    return reduce(DataFrame.unionByName, found)


def tasks_for(work: DataFrame, rows: int | None = None) -> int:
    """Several tasks for each core, and with ``rows`` so many that each has no more of them;
    counting them runs ``work`` once more."""
    return max(TASKS * work.sparkSession.sparkContext.defaultParallelism, -(-work.count() // rows) if rows else 0)


def dealt_in_turn(work: DataFrame, rows: int | None = None) -> DataFrame:
    """A list of work dealt row by row to ``tasks_for`` it.

    The ``rebalance`` hint goes by the bytes of the list itself, which say nothing about the work
    that a row stands for, and gathers a list in one task.
    """
    return work.repartition(tasks_for(work, rows))


def dealt_by_bytes(files: DataFrame, least_tasks: int = 1, task_bytes: int = TASK_BYTES, open_bytes: int = 0) -> DataFrame:
    """(path, length, ...) rows in partitions of about as many bytes, ``task_bytes`` each or less.
    A file counts as ``open_bytes`` besides its own.

    Files are ordered by a hash of their path and cut where the running total of bytes passes
    the next multiple. The total runs within 4,096 groups, whose own totals are a table
    of that size. A file that is larger is a partition with what falls beside it.
    """
    cost = F.col("length") + F.lit(open_bytes)
    total = files.agg(F.coalesce(F.sum(cost), F.lit(0))).first()[0]
    share = max(1, min(task_bytes, -(-total // max(1, least_tasks))))
    pieces = int(-(-total // share)) or 1
    placed = files.withColumns({"_order": F.xxhash64("path"), "_group": F.pmod(F.xxhash64(F.lit(1), "path"), F.lit(4096))})
    sizes = placed.groupBy("_group").agg(F.sum(cost).alias("_size"))
    offsets = sizes.select("_group", F.coalesce(F.sum("_size").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    before = F.sum(cost).over(Window.partitionBy("_group").orderBy("_order", "path").rowsBetween(Window.unboundedPreceding, -1))
    cut = placed.join(F.broadcast(offsets), "_group")  # at most 4,096 rows
    cut = cut.withColumn("_piece", F.floor((F.col("_offset") + F.coalesce(before, F.lit(0))) / F.lit(share)))
    return cut.repartitionByRange(pieces, "_piece").drop("_order", "_group", "_offset", "_piece")
