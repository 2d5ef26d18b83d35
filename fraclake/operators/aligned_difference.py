"""Difference of two stored sets partition by partition, without shuffling either.

Sets that were stored alike hold a hash under the same (k, part), so each such pair of folders is
compared by itself. The work is listed first: the row groups of both sides with the least
and the largest hash in them, from the footers of the files. Pairs of folders are cut into equal
ranges of hashes, which are dealt in turn, so that a piece of work holds a bounded number of
values however full a partition is. A row group is read by every piece that it reaches into, so pieces
smaller than PIECE are cut only as far as each value is read about three times. A task then reads the row groups that reach into its piece,
keeps the values inside, and merges the two sorted sides. Only the list of work and the hashes
that are missing ever move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraclake.functions.unsigned import unsigned_key
from fraclake.sinks.archives import file_system
from fraclake.sources.files import dealt_in_turn

#: Values of both sides in a piece of work, about; values read at a time.
PIECE, BATCH = 1 << 23, 1 << 16

#: Fixed value: the folder name that stands for a NULL.
NO_PART = "__HIVE_DEFAULT_PARTITION__"

_GROUPS = "side string, path string, row_group int, values bigint, low bigint, high bigint, nulls bigint"


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, ksize, part) of the files of a stored set."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root).select("path"))
    return files.select("path", F.regexp_extract("path", r"/ksize=(\d+)/", 1).cast("int").alias("ksize"), F.regexp_extract("path", r"/part=([^/]+)/", 1).alias("part"))


def bounds(group, column: int) -> tuple[int, int, int]:
    """The least and largest hash of a row group as bit patterns, and its NULLs.

    Statistics order bit patterns as signed numbers; a group that has both signs, or none
    recorded, may hold any value.
    """
    told = group.column(column).statistics
    nulls = told.null_count if told is not None and told.has_null_count else -1
    if told is None or not told.has_min_max or not isinstance(told.min, int):
        return 0, -1, nulls
    low, high = told.min, told.max
    if low < 0 <= high:
        return 0, -1, nulls
    return *(v - (1 << 64) if v >= 1 << 63 else v for v in (low, high)), nulls


def row_groups(files: DataFrame) -> DataFrame:
    """(side, path, row_group, values, low, high, nulls) of (side, path) rows, read from footers by tasks."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for side, uri in zip(batch.column("side").to_pylist(), batch.column("path").to_pylist()):
                store, path = file_system(uri)
                with store.open_input_file(path) as file:
                    footer = pq.read_metadata(file)
                column = footer.schema.names.index("hash")
                for i in range(footer.num_row_groups):
                    rows.append((side, uri, i, footer.row_group(i).num_rows, *bounds(footer.row_group(i), column)))
            columns = list(zip(*rows)) or [()] * 7
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["side", "path", "row_group", "values", "low", "high", "nulls"])

    return dealt_in_turn(files.select("side", "path")).mapInArrow(read, _GROUPS)


def work_list(spark: SparkSession, lhs: str, rhs: str, ksizes: list[int], piece: int = PIECE) -> DataFrame:
    """(ksize, part, first, last, opening, groups): what is to be compared, for partitions that ``rhs`` has.

    A piece covers the order keys from ``first`` up to, and without, ``last``; NULL means to the
    end. Its ``groups`` are those row groups of either side that reach into it. The
    ``opening`` piece of a partition also takes its NULLs.
    """
    sides = [stored_files(spark, root).withColumn("side", F.lit(side)) for side, root in (("l", lhs), ("r", rhs))]
    files = sides[0].unionByName(sides[1]).where(F.col("ksize").isin(*ksizes))
    groups = row_groups(files).join(files, ["side", "path"]).where("values > 0").withColumns({"low": unsigned_key("low"), "high": unsigned_key("high")})
    width = F.col("high").cast("double") - F.col("low").cast("double") + 1
    sizes = groups.groupBy("ksize", "part").agg(F.sum("values").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum(F.col("values") * width).alias("reach"),
                                                F.bool_or(F.col("side") == "r").alias("wanted")).where("wanted")
    # of p pieces of the whole width, a group reaches into p times its share of that, and one more
    few = F.floor(2 * F.col("n") * width / F.col("reach"))
    pieces = F.greatest(F.ceil(F.col("n") / F.lit(max(piece, PIECE))), F.least(F.ceil(F.col("n") / F.lit(piece)), few)).cast("bigint")
    cut = sizes.withColumn("pieces", pieces).withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("pieces") - 1)))

    def bound(i: str) -> Column:
        """The distance can pass the largest BIGINT, so it is taken as a decimal."""
        way = f"(cast(high as decimal(20,0)) - cast(low as decimal(20,0)) + 1) * {i}"
        return F.expr(f"cast(cast(low as decimal(20,0)) + cast(({way} - {way} % pieces) / pieces as decimal(20,0)) as bigint)")

    cuts = cut.select("ksize", "part", F.when(F.col("i") > 0, bound("i")).alias("first"), F.when(F.col("i") + 1 < F.col("pieces"), bound("(i + 1)")).alias("last"),
                      (F.col("i") == 0).alias("opening"))
    reach = ((F.col("first").isNull() | (F.col("high") >= F.col("first"))) & (F.col("last").isNull() | (F.col("low") < F.col("last")))) | (F.col("opening") & (F.col("nulls") != 0))
    met = cuts.join(groups, ["ksize", "part"]).where(reach)
    return met.groupBy("ksize", "part", "first", "last", "opening").agg(F.collect_list(F.struct("side", "path", "row_group")).alias("groups"))


def _values(groups: list[dict], side: str, first: int | None, last: int | None, nulls: bool) -> tuple[np.ndarray, int]:
    """The order keys of a side inside a piece, ascending, and its NULLs."""
    parts, missing = [np.zeros(0, np.int64)], 0
    for uri in sorted({g["path"] for g in groups if g["side"] == side}):
        store, path = file_system(uri)
        with store.open_input_file(path) as file:
            reader = pq.ParquetFile(file)
            chosen = sorted(g["row_group"] for g in groups if g["path"] == uri and g["side"] == side)
            for batch in reader.iter_batches(BATCH, row_groups=chosen, columns=["hash"]):
                column = batch.column(0)
                if column.null_count:
                    missing += column.null_count if nulls else 0
                    column = column.drop_null()
                keys = column.to_numpy(zero_copy_only=False).astype(np.uint64, copy=False).view(np.int64) ^ np.int64(-1 << 63)
                inside = np.ones(len(keys), bool)
                if first is not None:
                    inside &= keys >= first
                if last is not None:
                    inside &= keys < last
                parts.append(keys[inside])
    found = np.sort(np.concatenate(parts))
    return found, missing


def aligned_difference(spark: SparkSession, lhs: str, rhs: str, ksizes: list[int], piece: int = PIECE) -> DataFrame:
    """(ksize, part, hash): rows of the stored set ``rhs`` whose hash ``lhs`` lacks.

    Both must be stored with one partitioning. A NULL hash is in no set. Hashes may be stored
    signed or unsigned, sorted or not; where a partition's files are not sorted, or are many
    sorted runs, each of its pieces reads all of them.
    """
    spread = dealt_in_turn(work_list(spark, lhs, rhs, ksizes, piece))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                wanted, nulls = _values(row["groups"], "r", row["first"], row["last"], row["opening"])
                known, _ = _values(row["groups"], "l", row["first"], row["last"], False)
                at = np.searchsorted(known, wanted)
                lost = wanted[(at == len(known)) | (known[np.minimum(at, len(known) - 1)] != wanted)] if len(known) else wanted
                hashes = pa.concat_arrays([pa.array(lost ^ np.int64(-1 << 63), pa.int64()), pa.nulls(nulls, pa.int64())])
                for lo in range(0, len(hashes), BATCH):
                    some = hashes.slice(lo, BATCH)
                    yield pa.RecordBatch.from_arrays([pa.array([row["ksize"]] * len(some), pa.int32()), pa.array([row["part"]] * len(some), pa.string()), some],
                                                     names=["ksize", "part", "hash"])

    found = spread.mapInArrow(compare, "ksize int, part string, hash bigint")
    return found.withColumn("part", F.nullif("part", F.lit(NO_PART)))
