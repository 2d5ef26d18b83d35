"""Stored hash sets, their k-sizes and manifests."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraclake.functions.unsigned import bits_from_decimal
from fraclake.shared import entries, exists, small_text
from fraclake.types import MANIFEST

MANIFEST_FOLDER = "_manifest"
SINGLE_MANIFEST = "_MANIFEST.json"


#: Type of the hash column in files written by this package.
OWN_TYPE = "bigint"


def read_unique_set(spark: SparkSession, root: str, ksizes: Collection[int] | None = None,
                    hash_type: str | None = None) -> DataFrame:
    """(hash, ksize, part) of a set stored as ksize=K/part=HEX.

    Partition types are given, never inferred: labels such as ``1e10`` would turn into
    numbers. Files with unsigned columns are converted to bit patterns. Naming the
    type of the stored column (OWN_TYPE) saves looking at a file for it, and with it
    one more listing of the set.
    """
    return _partitioned(spark, root, "ksize int, part string", ksizes, hash_type)


def read_bucketed_set(spark: SparkSession, root: str, hash_type: str | None = None) -> DataFrame:
    """(hash, bucket) of a set stored as bucket=N."""
    return _partitioned(spark, root, "bucket int", None, hash_type)


def read_flat_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Only the ``hash`` column of any table with one, as bit patterns."""
    return _as_bits(spark.read.parquet(path).select("hash"))


def _partitioned(spark: SparkSession, root: str, partitions: str, ksizes: Collection[int] | None,
                 hash_type: str | None) -> DataFrame:
    stored = hash_type or spark.read.parquet(root).schema["hash"].dataType.simpleString()
    df = spark.read.schema(f"hash {stored}, {partitions}").parquet(root)
    if ksizes is not None:
        df = df.where(F.col("ksize").isin(*ksizes))
    return _as_bits(df)


def _as_bits(df: DataFrame) -> DataFrame:
    if df.schema["hash"].dataType.simpleString() == "bigint":
        return df
    return df.withColumn("hash", bits_from_decimal("hash"))


def discover_ksizes(spark: SparkSession, root: str, requested: Collection[int] | None = None) -> list[int]:
    """k-sizes present in a stored set, cut to those requested; none is an error.

    They are the names of the folders at the top of the set: no file is opened.
    """
    found = sorted(int(n.removeprefix("ksize=")) for n in entries(spark, root) if n.startswith("ksize="))
    found = [k for k in found if requested is None or k in requested]
    if not found:
        raise ValueError("the stored set has none of the k-sizes asked for")
    return found


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    """The manifest as at most one row; none when missing or unreadable.

    Sets written elsewhere keep it in a file whose name Spark treats as hidden; that
    one small file is opened directly, on whatever file system the set is.
    """
    folder = f"{root.rstrip('/')}/{MANIFEST_FOLDER}"
    if exists(spark, folder):
        rows = spark.read.schema(MANIFEST).json(folder)
    else:
        text = small_text(spark, f"{root.rstrip('/')}/{SINGLE_MANIFEST}")
        rows = spark.createDataFrame([] if text is None else [(text,)], "value string")
        rows = rows.select(F.from_json("value", MANIFEST).alias("m")).select("m.*")
    return rows.where(F.col("format").isNotNull())


def manifests_agree(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: compatible BOOLEAN plus what each side says. A missing manifest never conflicts."""
    sides = left.select(F.lit("l").alias("_side"), "partition_bits", "partition_mode").unionByName(
        right.select(F.lit("r").alias("_side"), "partition_bits", "partition_mode"))

    def of(side: str, column: str) -> Column:
        return F.max(F.when(F.col("_side") == side, F.col(column)))

    told = sides.agg(of("l", "partition_bits").alias("lhs_bits"), of("r", "partition_bits").alias("rhs_bits"),
                     of("l", "partition_mode").alias("lhs_mode"), of("r", "partition_mode").alias("rhs_mode"),
                     F.countDistinct("_side").alias("_known"))
    same = F.col("lhs_bits").eqNullSafe(F.col("rhs_bits")) & F.col("lhs_mode").eqNullSafe(F.col("rhs_mode"))
    return told.select(((F.col("_known") < 2) | same).alias("compatible"),
                       "lhs_bits", "rhs_bits", "lhs_mode", "rhs_mode")


def require_compatible(left: DataFrame, right: DataFrame) -> None:
    """Raise ValueError when both sets have manifests with another partitioning."""
    row = manifests_agree(left, right).first()
    if not row["compatible"]:
        raise ValueError(f"partitioning differs: {row.asDict()}")
