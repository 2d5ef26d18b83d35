"""Counts over archives, sketches and raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def unique_per_k(stored: DataFrame) -> DataFrame:
    """Distinct hashes and non-empty partitions per k, with a total row (NULL k).

    ``stored`` is distinct already. Partitions are counted per k and added up, as the
    same label under two k is two partitions.
    """
    per_k = stored.groupBy("ksize").agg(F.count_distinct("part").alias("_p"), F.count(F.lit(1)).alias("_n"))
    return per_k.rollup("ksize").agg(F.sum("_p").alias("partitions"), F.sum("_n").alias("distinct_count"))


def extraction_counts(rows: DataFrame) -> DataFrame:
    """Archives seen, members unpacked, members that gave hashes, members that failed."""
    member = F.col("member_head")
    status = F.col("status")
    return rows.agg(
        F.count_if("archive_head").alias("archives"),
        F.count_if(member & status.isin("ok", "no_match", "bad_content")).alias("members_read"),
        F.count_if(member & (status == "ok")).alias("members_ok"),
        F.count_if(member & status.isin("bad_content", "bad_read")).alias("members_bad"))


def run_statistics(rows: DataFrame) -> DataFrame:
    """Files in all, processed and failed, and stored hashes including repeats."""
    failed = F.col("archive_head") & (F.col("status") == "bad_archive")
    return rows.agg(
        F.count_if("archive_head").alias("total_files"),
        F.count_if(F.col("archive_head") & (F.col("status") != "bad_archive")).alias("processed_files"),
        F.count_if(failed).alias("failed_files"),
        F.coalesce(F.sum(F.when(F.col("sketch_head"), F.col("num_hashes"))), F.lit(0)).alias("total_hashes"))


def distinct_per_k(flat: DataFrame) -> DataFrame:
    """Distinct hashes per k of flat rows, repeats dropped before the shuffle."""
    return flat.select("ksize", "hash").distinct().groupBy("ksize").agg(F.count(F.lit(1)).alias("unique_hashes"))


def sized_counts(files: DataFrame) -> DataFrame:
    """Values and files of raw vectors from file sizes alone: 8 bytes per value.

    Spark's file listing leaves out empty files, which hold no values; they are the
    one thing ``files`` and the mean do not count.
    """
    values = F.coalesce(F.sum(F.floor(F.col("length") / 8)), F.lit(0))
    return files.agg(values.alias("hashes"), F.count(F.lit(1)).alias("files")).withColumn(
        "mean_per_file", F.when(F.col("files") > 0, F.col("hashes") / F.col("files")).otherwise(0.0))


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    """Number of rows as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(name))
