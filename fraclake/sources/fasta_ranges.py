"""FASTA files read by ranges of bytes, so that one long sequence becomes many tasks.

A range begins anywhere, also inside a line. Whether it begins in a header line is known
from the last line break before it: each range first looks backwards for its own last line break,
which is mostly near its end, and the nearest one among the ranges before tells. Then each
range gives its bases, and after them the first k - 1 bases that follow in the same
record, so that every window of k bases that begins in the range is in one of its rows, and in no
other range's. Block-compressed gzip is read by its blocks, each of which belongs to the range
it begins in; other gzip files cannot be entered in the middle and are one range.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraclake.sinks.archives import file_system
from fraclake.sources.files import TASK_BYTES, list_files, tasks_for

#: Bytes of a range and of a read; bases of a row; bytes of the first read behind a range.
RANGE, READ, ROW, BEHIND = 32 << 20, 1 << 20, 1 << 20, 256

#: Fixed values of block-compressed gzip: how a block's header begins, and the name and length of its size field.
_BLOCK, _FIELD = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
_BLANKS = b"\r\n \t"


def _size_of_block(head: bytes, at: int) -> int | None:
    """The length of the block that begins there, or None if none does."""
    if head[at:at + 4] != _BLOCK or len(head) < at + 18 or head[at + 12:at + 16] != _FIELD:
        return None
    return struct.unpack_from("<H", head, at + 16)[0] + 1


def _chunks(file: pa.NativeFile, packed: str, first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) from ``first`` on; of blocks the offsets are those of the compressed file.
    Of plain files one chunk ends at ``last``, and behind it reads are small at first, as little of that is needed."""
    size = file.size()
    if packed == "no":
        at, step = first, BEHIND
        while at < size:
            length = min(READ, last - at) if at < last else step
            yield at, file.read_at(length, at)
            step, at = min(READ, 4 * step) if at >= last else step, at + length
    elif packed == "blocks":
        at = _next_block(file, first, size)
        while at < size:
            length = _size_of_block(file.read_at(18, at), 0)
            if length is None:
                raise ValueError(f"no block at {at}")
            yield at, zlib.decompress(file.read_at(length, at), 31)
            at += length
    else:
        unpack, at = zlib.decompressobj(31), 0
        while at < size:
            raw = file.read_at(READ, at)
            while raw:
                yield at, unpack.decompress(raw)
                raw = unpack.unused_data
                if unpack.eof:
                    unpack = zlib.decompressobj(31)
            at += READ


def _next_block(file: pa.NativeFile, first: int, size: int) -> int:
    """Where the first block at or behind ``first`` begins: there is a block, and another or the end behind it."""
    at = first
    while at < size:
        raw = file.read_at(1 << 17, at)
        found = raw.find(_BLOCK)
        while found >= 0:
            length = _size_of_block(raw, found)
            if length is not None:
                after = at + found + length
                if after == size or _size_of_block(file.read_at(18, after), 0) is not None:
                    return at + found
            found = raw.find(_BLOCK, found + 1)
        at += max(1, len(raw) - 17)
    return size


def packing(uri: str) -> str:
    """``no``, ``blocks`` or ``whole``: how a file is compressed, from its first bytes."""
    store, path = file_system(uri)
    with store.open_input_file(path) as file:
        head = file.read_at(18, 0)
    return "blocks" if _size_of_block(head, 0) is not None else "whole" if head[:2] == _BLOCK[:2] else "no"


def _state(file: pa.NativeFile, packed: str, lo: int, hi: int) -> str | None:
    """``header`` or ``bases``: what the line is in which a range ends; None if no line ends in it."""
    if packed == "no":
        at = hi
        while at > lo:
            start = max(lo, at - (1 << 16))
            found = file.read_at(at - start, start).rfind(b"\n")
            if found >= 0:
                return "header" if file.read_at(1, start + found + 1) == b">" else "bases"
            at = start
        return None
    state, line_start = None, False
    for at, data in _chunks(file, packed, lo, hi):
        if line_start and data:
            state, line_start = "header" if data[:1] == b">" else "bases", False
        if at >= hi:
            break
        found = data.rfind(b"\n")
        if found >= 0:
            line_start = found + 1 == len(data)
            state = "header" if data[found + 1:found + 2] == b">" else "bases"
    return state


def _pieces(file: pa.NativeFile, packed: str, lo: int, hi: int, header: bool, k: int) -> Iterator[bytes]:
    """Rows of bases of a range that begins in a header line or not."""
    tail, line_start, more = b"", False, None
    for at, part in _chunks(file, packed, lo, hi):
        if packed != "whole" and at >= hi and more is None:
            if not tail or header:
                return
            more = b""
        place = 0
        while place < len(part):
            if header:
                end = part.find(b"\n", place)
                if end < 0:
                    break
                header, line_start, place = False, True, end + 1
                continue
            if line_start and part[place:place + 1] == b">":
                if more is not None:
                    yield tail + more
                    return
                header, line_start, tail = True, False, b""
                continue
            end = part.find(b"\n>", place)
            end = len(part) if end < 0 else end + 1
            found = part[place:end].translate(None, _BLANKS).upper()
            line_start, place = part[end - 1:end] == b"\n", end
            if more is not None:
                more += found
                if len(more) >= k - 1:
                    yield tail + more[:k - 1]
                    return
                continue
            whole = tail + found
            for start in range(0, max(0, len(whole) - k + 1), ROW):
                yield whole[start:start + ROW + k - 1]
            tail = whole[max(0, len(whole) - k + 1):]
    if more:
        yield tail + more


def read_fasta_ranges(spark: SparkSession, root: str, k: int, suffix: str = "", size: int = RANGE) -> DataFrame:
    """(path, offset, seq): bases of the FASTA files under ``root``, in rows of bounded length.

    Every window of ``k`` bases that a record holds is in one row exactly; windows of fewer
    bases may be in two. Rows do not reach over the ends of records, and ``offset`` is that of
    the range they come from. Bases are upper-cased; blanks and line ends are left out.
    """
    files = list_files(spark, root, suffix).where("length > 0").select("path", "length")

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), pa.array([packing(p) for p in batch.column("path").to_pylist()], pa.string())],
                                             names=["path", "length", "packed"])

    known = files.mapInArrow(told, "path string, length bigint, packed string")
    step = F.when(F.col("packed") == "whole", F.col("length")).otherwise(F.lit(size).cast("bigint"))
    ranges = known.withColumn("step", step).select("path", "packed", "length", "step", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.col("step"))).alias("lo"))
    ranges = ranges.select("path", "packed", "lo", F.least(F.col("lo") + F.col("step"), "length").alias("hi"))
    tasks = tasks_for(ranges, max(1, TASK_BYTES // size))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            states = []
            for uri, packed, lo, hi in zip(*(batch.column(c).to_pylist() for c in ("path", "packed", "lo", "hi"))):
                store, path = file_system(uri)
                with store.open_input_file(path) as file:
                    states.append("bases" if packed == "whole" else _state(file, packed, lo, hi))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(states, pa.string())], names=["path", "packed", "lo", "hi", "state"])

    before = Window.partitionBy("path").orderBy("lo").rowsBetween(Window.unboundedPreceding, -1)  # the ranges of one file
    begun = ranges.repartition(tasks).mapInArrow(ends, "path string, packed string, lo bigint, hi bigint, state string").select(
        "path", "packed", "lo", "hi", F.last("state", ignorenulls=True).over(before).alias("state")).repartition(tasks)

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for uri, packed, lo, hi, state in zip(*(batch.column(c).to_pylist() for c in ("path", "packed", "lo", "hi", "state"))):
                store, path = file_system(uri)
                with store.open_input_file(path) as file:
                    # without a line break before, the first byte of the file tells
                    header = state == "header" if state else next(_chunks(file, packed, 0, 1), (0, b""))[1][:1] == b">"
                    for seq in _pieces(file, packed, lo, hi, header, k):
                        rows.append((uri, lo, seq.decode("latin-1")))
                        held += len(seq)
                        if held >= ROW:
                            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "offset", "seq"])
                            rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["path", "offset", "seq"])

    return begun.mapInArrow(bases, "path string, offset bigint, seq string").where(F.length("seq") >= k)
