"""Hash sets on disk: partitioned, flat, sorted and bucketed layouts, and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fraclake.functions.mixing import check_partitioning, hex_label, low_bits, with_partition_id
from fraclake.functions.unsigned import unsigned_key
from fraclake.sources.hash_sets import MANIFEST_FOLDER

#: Fixed layout values: label width bits and mode of unique sets, bits of bucketed exports.
PARTITION_BITS = 8
PARTITION_MODE = "low"
BUCKET_BITS = 9


def with_part(df: DataFrame, bits: int = PARTITION_BITS, mode: str = PARTITION_MODE) -> DataFrame:
    """Add the hex label of the partition of each hash."""
    return with_partition_id(df, bits, mode).withColumn("part", hex_label("part_id", bits)).drop("part_id")


def write_unique_set(hashes: DataFrame, root: str, bits: int = PARTITION_BITS,
                     mode: str = PARTITION_MODE) -> None:
    """Write distinct (ksize, hash) as ksize=K/part=HEX, zstd, ascending unsigned.

    ``rebalance`` gathers the rows of a partition in one place, so that each gets few
    files, but splits a partition that is larger than a task should be: with scaled
    hashes and mode ``high`` a single partition holds nearly everything.
    """
    check_partitioning(bits, mode)
    placed = with_part(hashes.select("ksize", "hash"), bits, mode)
    (placed.hint("rebalance", "ksize", "part")
     .sortWithinPartitions("ksize", "part", unsigned_key("hash"))
     .write.partitionBy("ksize", "part").option("compression", "zstd").parquet(root))


def write_flat(flat: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Write hashes with their origin, split by k. ``mode='append'`` adds a batch."""
    (flat.hint("rebalance", "ksize").write.mode(mode).partitionBy("ksize")
     .option("compression", "snappy").parquet(root))


def write_sorted_unique(hashes: DataFrame, root: str) -> None:
    """Write distinct (ksize, hash) in ascending unsigned order within each k.

    Range partitioning on (k, hash) gives every k as many files as its size needs.
    """
    key = unsigned_key("hash")
    (hashes.select("ksize", "hash").distinct().repartitionByRange("ksize", key)
     .sortWithinPartitions("ksize", key)
     .write.partitionBy("ksize").option("compression", "snappy").parquet(root))


def write_bucketed(hashes: DataFrame, root: str, bits: int = BUCKET_BITS) -> None:
    """Write distinct hashes as bucket=N, the bucket being the low bits."""
    (hashes.select(low_bits("hash", bits).alias("bucket"), "hash").distinct()
     .hint("rebalance", "bucket").sortWithinPartitions("bucket")
     .write.partitionBy("bucket").option("compression", "zstd").parquet(root))


def write_difference(difference: DataFrame, root: str, bits: int = PARTITION_BITS,
                     mode: str = PARTITION_MODE) -> None:
    """Write a difference set in the layout of a unique set; empty partitions leave nothing."""
    write_unique_set(difference, root, bits, mode)


def layout_stats(df_files: DataFrame, partition: str = "bucket") -> DataFrame:
    """Files, bytes and partition values present, from a listing of Parquet files."""
    value = F.nullif(F.regexp_extract("path", partition + r"=([^/]+)/", 1), F.lit(""))
    return df_files.agg(F.count(F.lit(1)).alias("files"),
                        F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
                        F.count_distinct(value).alias("partitions"))


def list_parquet(spark, root: str) -> DataFrame:
    """Paths and lengths of the Parquet files below ``root``; contents are not read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet").load(root).select("path", "length"))


def require_parquet(spark, root: str) -> None:
    """Raise when a write left no Parquet file."""
    if list_parquet(spark, root).isEmpty():
        raise RuntimeError(f"no Parquet files were written to {root}")


def manifest(stored: DataFrame, bits: int, mode: str, created_at: str, fmt: str = "parquet") -> DataFrame:
    """One row describing a stored set: partitions and distinct hashes per k, and in all."""
    per_k = stored.groupBy("ksize").agg(F.count_distinct("part").alias("partitions"),
                                        F.count(F.lit(1)).alias("distinct_count"))
    entry = F.struct(F.col("ksize").cast("string").alias("key"),
                     F.struct("partitions", "distinct_count").alias("value"))
    return per_k.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("ksizes"),
                     F.coalesce(F.sum("distinct_count"), F.lit(0)).alias("total_distinct")).select(
        F.lit(fmt).alias("format"), F.lit(bits).alias("partition_bits"), F.lit(mode).alias("partition_mode"),
        F.lit(created_at).alias("created_at"), "ksizes", "total_distinct")


def write_manifest(one_row: DataFrame, root: str) -> None:
    """Store the manifest beside the data, where scans of the data do not see it."""
    one_row.coalesce(1).write.mode("overwrite").json(f"{root.rstrip('/')}/{MANIFEST_FOLDER}")
