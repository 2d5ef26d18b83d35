"""Loading stored sets into SQL tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.operators import hash_sets as sets
from fraclake.plans.inputs import SQL_KNOWN_KEYS, SQL_SOLD_KEYS, known_keys, sold_keys
from fraclake.plans.storage import CREATED_AT, stored_set
from fraclake.shared import fresh_database
from fraclake.sinks.tables import DATASET_TABLE, KSIZE_TABLE, ingest


def load_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_database(spark)
    ingest(spark, stored_set(spark, sold_keys(spark, sf_dir)), schema, "single", ksizes=[15, 33], analyze=True)
    return spark.table(f"{schema}.hashes").select("ksize", "hash")


def load_per_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fresh_database(spark)
    ingest(spark, stored_set(spark, sold_keys(spark, sf_dir)), schema, "per-ksize", analyze=True)
    return spark.table(f"{schema}.hashes_31").select("hash")


def load_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the metadata tables say after one load of either kind; folders left out."""
    schema = fresh_database(spark)
    root = stored_set(spark, sold_keys(spark, sf_dir))
    ingest(spark, root, schema, "per-ksize")
    ingest(spark, root, schema, "single")
    about = spark.table(f"{schema}.{DATASET_TABLE}").select(
        "dataset_root", "format", "partition_bits", "partition_mode", F.col("created_at").cast("string").alias("created_at"),
        "ksizes").distinct()
    per_k = spark.table(f"{schema}.{KSIZE_TABLE}").select(
        "dataset_root", "ksize", F.regexp_replace("table_name", r"^[^.]*\.", "").alias("table_name"), "rows_ingested")
    return per_k.join(about, "dataset_root").drop("dataset_root")


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = ingest(spark, stored_set(spark, sold_keys(spark, sf_dir)), fresh_database(spark), "single")
    return summary.select("mode", "table", "ksizes", "rows_ingested")


def bucketed_table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference of two tables stored bucketed by hash: the join itself shuffles nothing."""
    left, right = fresh_database(spark), fresh_database(spark)
    for schema, bag in ((left, sold_keys(spark, sf_dir)), (right, known_keys(spark, sf_dir))):
        ingest(spark, stored_set(spark, bag), schema, "per-ksize", ksizes=[15], hash_buckets=8)
    return sets.difference(spark.table(f"{right}.hashes_15"), spark.table(f"{left}.hashes_15"), ["hash"])


QUERIES = {
    "load_single": load_single,
    "load_per_k": load_per_k,
    "load_meta": load_meta,
    "load_summary": load_summary,
    "bucketed_table_diff": bucketed_table_diff,
}

_SOLD = f"SELECT DISTINCT ksize, hash FROM {SQL_SOLD_KEYS}"

ORACLES = {
    "load_single": f"SELECT ksize::SMALLINT AS ksize, hash FROM ({_SOLD}) WHERE ksize IN (15, 33)",
    "load_per_k": f"SELECT hash FROM ({_SOLD}) WHERE ksize = 31",
    "load_meta": f"""
      WITH per_k AS (SELECT ksize, count(*) AS n FROM ({_SOLD}) GROUP BY ksize)
      SELECT ksize::SMALLINT AS ksize, CASE WHEN own THEN 'hashes_' || ksize ELSE 'hashes' END AS table_name,
             CASE WHEN own THEN n END AS rows_ingested, 'parquet' AS format, 5::SMALLINT AS partition_bits,
             'low' AS partition_mode, '{CREATED_AT}' AS created_at, '15,31,33' AS ksizes
      FROM per_k, (VALUES (true), (false)) AS v(own)""",
    "load_summary": f"""
      SELECT 'single' AS mode, 'hashes' AS "table", '15,31,33' AS ksizes, count(*) AS rows_ingested FROM ({_SOLD})""",
    "bucketed_table_diff": f"""
      SELECT hash FROM (SELECT DISTINCT hash FROM {SQL_KNOWN_KEYS} WHERE ksize = 15)
      WHERE hash NOT IN (SELECT hash FROM {SQL_SOLD_KEYS} WHERE ksize = 15)""",
}
