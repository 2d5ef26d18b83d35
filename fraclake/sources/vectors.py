"""Raw hash vectors: ksize=K/part=HEX/*.bin (little-endian uint64) and *.npy files."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.sinks.archives import file_system
from fraclake.sources.files import TASK_BYTES, dealt_in_turn, list_files

_SLICE = 1 << 16
_SCHEMA = "path string, hashes array<bigint>"
_ARROW = pa.schema([("path", pa.string()), ("hashes", pa.list_(pa.int64()))])

#: What names of folders tell of the files below.
KSIZE_FOLDER, PART_FOLDER = r"ksize=(\d+)/", r"part=([0-9a-f]+)/"

#: Values of eight bytes that one task reads from one file at a time: 32 MB.
RANGE = 1 << 22


def find_vectors(spark: SparkSession, root: str, suffix: str = ".bin") -> DataFrame:
    """Files as (path, length), listed by tasks; empty ones and those with hidden names are left out."""
    hidden = F.substring_index("path", "/", -1).rlike("^[._]")
    return list_files(spark, root, suffix).where((F.col("length") > 0) & ~hidden).select("path", "length")


def read_vectors(files: DataFrame, values: int = RANGE) -> DataFrame:
    """(ksize, part, hash) for every stored value; unreadable or empty files give none.
    Files outside such folders have a null k and an empty part.

    A file is read in ranges of ``values`` values of eight bytes, or more of narrower ones, each opened and sought to by the task it
    falls to, so a file of any size is shared between tasks and no task holds more than a
    slice of one.
    """
    pieces = F.sequence(F.lit(0), F.floor((F.col("length") - 1) / F.lit(8 * values)).cast("bigint"))
    ranges = files.where("length > 0").select("path", F.explode(pieces).alias("piece"))

    def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, piece in zip(batch.column("path").to_pylist(), batch.column("piece").to_pylist()):
                for bits in vector_slices(path, 8 * piece * values, 8 * values):
                    yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([bits], type=pa.list_(pa.int64()))], schema=_ARROW)

    read = dealt_in_turn(ranges, max(1, TASK_BYTES // (8 * values))).mapInArrow(slices, _SCHEMA)
    return read.select(F.regexp_extract("path", KSIZE_FOLDER, 1).try_cast("int").alias("ksize"),
                       F.regexp_extract("path", PART_FOLDER, 1).alias("part"),
                       F.explode("hashes").alias("hash"))


def vector_slices(uri: str, first: int, length: int) -> Iterator[np.ndarray]:
    """Bit patterns of the values in some bytes behind the header of one file, a range in
    multiples of eight bytes; trailing bytes that fill no value are dropped."""
    store, path = file_system(uri)
    with store.open_input_file(path) as file:
        kind, begin = np.dtype("<u8"), 0
        if path.endswith(".npy"):
            try:
                version = np.lib.format.read_magic(file)
                header = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
                kind, begin = header(file)[2], file.tell()
            except ValueError:
                return
            if kind.kind not in "iu":
                return
        for at in range(first, first + length, 8 * _SLICE):
            raw = file.read_at(min(8 * _SLICE, first + length - at), begin + at)
            values = np.frombuffer(raw, kind, len(raw) // kind.itemsize)
            if not len(values):
                return
            yield np.ascontiguousarray(values.astype(np.uint64, copy=False)).view(np.int64)
