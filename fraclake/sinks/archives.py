"""Writing signature archives and raw vectors from tasks."""

from __future__ import annotations

import gzip
import io
import os
import uuid
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fraclake.functions.mixing import with_partition_id
from fraclake.shared import exists, rename


#: Archives that are packed before they leave a task.
_ROWS = 64


def pack_archives(df: DataFrame) -> DataFrame:
    """(path, content) with one zip per row of (path, members).

    ``members`` is ARRAY<STRUCT<name, json, plain>>; ``plain`` leaves out the gzip step,
    which readers must then report. Each row is packed by itself: nothing is
    gathered, whatever the number of members that share a folder or source.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), _ROWS):
                some = batch.slice(lo, _ROWS)
                packed = [zip_of(row.as_py()) for row in some.column("members")]
                yield pa.RecordBatch.from_arrays([some.column("path"), pa.array(packed, type=pa.binary())],
                                                 names=["path", "content"])

    return df.select("path", "members").mapInArrow(pack, "path string, content binary")


def zip_of(members: list[dict]) -> bytes:
    """A zip of gzip-compressed texts; the same input gives the same bytes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for member in members:
            entry = zipfile.ZipInfo(member["name"], (1980, 1, 1, 0, 0, 0))
            text = member["json"].encode()
            archive.writestr(entry, text if member.get("plain") else gzip.compress(text, mtime=0))
    return out.getvalue()


#: Names that Spark uses for a store, and the one pyarrow knows.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """The store and the path of anything that Spark would take as a path, relative ones too."""
    scheme, mark, rest = uri.partition("://")
    if mark:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
    local = uri.removeprefix("file:")
    return fs.LocalFileSystem(), os.path.abspath(local)


def put_file(store: fs.FileSystem, path: str, content: bytes, tag: str) -> None:
    """Write under another name, then rename: a task that is lost leaves no half file,
    and one that runs twice leaves the same file."""
    store.create_dir(path.rsplit("/", 1)[0], recursive=True)
    partial = f"{path}.{tag}.part"
    with store.open_output_stream(partial) as stream:
        stream.write(content)
    store.move(partial, path)


def write_files(files: DataFrame, days_old: int = 0) -> None:
    """Write (path, content) rows, each to its own file on the shared file system.

    On a local file system ``days_old`` sets the files' times back, as copies that keep
    times would have them.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tag = str(TaskContext.get().taskAttemptId())
        for batch in batches:
            for uri, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                store, path = file_system(uri)
                put_file(store, path, content.as_py(), tag)
                if days_old and isinstance(store, fs.LocalFileSystem):
                    then = os.stat(path).st_mtime - 86400 * days_old
                    os.utime(path, (then, then))
            yield batch.select(["path"])

    files.select("path", "content").mapInArrow(write, "path string").write.format("noop").mode("overwrite").save()


def array_files(hashes: DataFrame, root: str, bits: int = 8, mode: str = "low", kind: str = "<u8", values: int = 1 << 20) -> DataFrame:
    """(path, content) of (ksize, hash) as ksize=K/part=HEX/w<task>-<n>.npy, with values of the type ``kind``.

    A file holds at most ``values`` values; those of a partition and task lie one after another.
    """
    width = -(-bits // 4)
    placed = with_partition_id(hashes.select("ksize", "hash"), bits, mode)
    ordered = placed.hint("rebalance", "ksize", "part_id").sortWithinPartitions("ksize", "part_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = (batch.column("ksize").to_numpy().astype(np.int64) << 32) | batch.column("part_id").to_numpy()
            found = batch.column("hash").to_numpy().view(np.uint64).astype(kind)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                for at in range(lo, hi, values):
                    out = io.BytesIO()
                    np.save(out, found[at:min(hi, at + values)])
                    path = f"{root}/ksize={int(keys[lo]) >> 32}/part={int(keys[lo]) & 0xFFFFFFFF:0{width}x}/w{task}-{number}.npy"
                    number += 1
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([out.getvalue()], pa.binary())], names=["path", "content"])

    return ordered.select("ksize", "part_id", "hash").mapInArrow(pack, "path string, content binary")


def write_vectors(hashes: DataFrame, root: str, bits: int = 8, mode: str = "low") -> None:
    """Write (ksize, hash) as ksize=K/part=HEX/w<task>.bin, little-endian uint64.

    Rows of a partition are gathered so that it gets few files; a hot partition is
    split over several tasks, each with a file of its own. Within a task the rows are
    sorted by partition, so one file is open at a time and nothing is held back.

    The files are written beside ``root`` and the folder gets its name when the job has
    ended, so a job that breaks off leaves nothing there; ``root`` must not exist before.
    """
    if exists(hashes.sparkSession, root):
        raise FileExistsError(root)
    target, root = root, f"{root.rstrip('/')}.writing-{uuid.uuid4().hex}"
    width = -(-bits // 4)
    placed = with_partition_id(hashes.select("ksize", "hash"), bits, mode)
    ordered = placed.hint("rebalance", "ksize", "part_id").sortWithinPartitions("ksize", "part_id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        store, base = file_system(root)
        name, tag = f"w{context.partitionId()}.bin", f"{context.taskAttemptId()}.part"
        key, stream, path = None, None, None
        for batch in batches:
            keys = (batch.column("ksize").to_numpy().astype(np.int64) << 32) | batch.column("part_id").to_numpy()
            values = batch.column("hash").to_numpy().astype("<i8", copy=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for lo, hi in zip(cuts, cuts[1:]):
                if keys[lo] != key:
                    if stream:
                        stream.close()
                        store.move(f"{path}.{tag}", path)
                    key = keys[lo]
                    folder = f"{base}/ksize={int(key) >> 32}/part={int(key) & 0xFFFFFFFF:0{width}x}"
                    store.create_dir(folder, recursive=True)
                    path = f"{folder}/{name}"
                    stream = store.open_output_stream(f"{path}.{tag}")
                stream.write(values[lo:hi].tobytes())
            yield batch.select(["hash"]).slice(0, 0)
        if stream:
            stream.close()
            store.move(f"{path}.{tag}", path)

    (ordered.select("ksize", "part_id", "hash").mapInArrow(write, "hash bigint")
     .write.format("noop").mode("overwrite").save())
    rename(hashes.sparkSession, root, target)
