"""FASTA text (plain or gzip) as (file, record_id, seq)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_fasta(spark: SparkSession, path: str, file_name: Column | None = None) -> DataFrame:
    """One row per record, sequence lines joined and upper-cased.

    Records are separated at a ``>`` that starts a line, so headers may contain the
    character. Plain files are split across tasks, gzip files are one task each.
    """
    name = F.col("_metadata.file_name") if file_name is None else file_name
    raw = spark.read.option("lineSep", "\n>").text(path).select(name.alias("file"), "value")
    record = F.regexp_replace("value", "^>", "")
    lines = raw.select("file", F.translate(F.split_part(record, F.lit("\n"), F.lit(1)), "\r", "").alias("header"),
                       F.translate(F.regexp_replace(record, "^[^\n]*", ""), "\r\n \t", "").alias("seq"))
    return lines.where(F.length("seq") > 0).select(
        "file", F.split_part("header", F.lit(" "), F.lit(1)).alias("record_id"), F.upper("seq").alias("seq"))
