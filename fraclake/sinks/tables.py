"""Loading stored sets into SQL tables, with metadata about each load."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.sources.hash_sets import discover_ksizes, read_manifest, read_unique_set

DATASET_TABLE = "meta_dataset"
KSIZE_TABLE = "meta_ksize"


def _analyze(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS hash")


def load_single(spark: SparkSession, root: str, table: str, ksizes: Collection[int],
                analyze: bool = False) -> DataFrame:
    """CREATE OR REPLACE one table (ksize SMALLINT, hash BIGINT), partitioned by k."""
    rows = read_unique_set(spark, root, ksizes).select(F.col("ksize").cast("smallint"), "hash")
    rows.hint("rebalance", "ksize").write.mode("overwrite").partitionBy("ksize").saveAsTable(table)
    if analyze:
        _analyze(spark, table)
    return spark.table(table)


def load_per_k(spark: SparkSession, root: str, schema: str, ksizes: Iterable[int], analyze: bool = False,
               hash_buckets: int | None = None) -> dict[int, str]:
    """CREATE OR REPLACE one table hashes_<k>(hash BIGINT) per k.

    ``hash_buckets`` stores them bucketed and sorted by hash: later differences and
    aggregations on the hash then need no shuffle. Worth it for sets compared often.
    """
    tables = {}
    whole = read_unique_set(spark, root)  # listed once; each k prunes its folder
    for k in ksizes:
        name = f"{schema}.hashes_{k}"
        rows = whole.where(F.col("ksize") == k).select("hash")
        if hash_buckets:
            writer = rows.repartition(hash_buckets, "hash").write.bucketBy(hash_buckets, "hash").sortBy("hash")
        else:
            writer = rows.write
        writer.mode("overwrite").saveAsTable(name)
        if analyze:
            _analyze(spark, name)
        tables[k] = name
    return tables


def record_dataset(spark: SparkSession, schema: str, root: str, ksizes: Collection[int]) -> None:
    """Append one row about the data set; manifest columns are NULL without a manifest."""
    told = read_manifest(spark, root)
    known = F.col("format").isNotNull()
    row = (told.agg(*[F.first(c).alias(c) for c in told.columns])
           .select(F.lit(root).alias("dataset_root"), "format", F.col("partition_bits").cast("smallint"),
                   "partition_mode", F.col("created_at").cast("timestamp").alias("created_at"),
                   F.current_timestamp().alias("ingested_at"),
                   F.lit(",".join(str(k) for k in ksizes)).alias("ksizes_csv"),
                   F.when(known, F.to_json(F.struct(*told.columns))).alias("source_manifest"))
           .withColumnRenamed("ksizes_csv", "ksizes"))
    row.write.mode("append").saveAsTable(f"{schema}.{DATASET_TABLE}")


def record_ksizes(counts: DataFrame, schema: str) -> None:
    """Append (dataset_root, ksize, table_name, rows_ingested) rows."""
    (counts.select("dataset_root", F.col("ksize").cast("smallint"), "table_name",
                   F.col("rows_ingested").cast("bigint"))
     .coalesce(1).write.mode("append").saveAsTable(f"{schema}.{KSIZE_TABLE}"))


def ingest(spark: SparkSession, root: str, schema: str = "hashes", mode: str = "single", table: str = "hashes",
           ksizes: Collection[int] | None = None, analyze: bool = False,
           hash_buckets: int | None = None) -> DataFrame:
    """Load a stored set and record the load; returns the summary row.

    ``mode`` is ``single`` or ``per-ksize``. Row counts per k are only recorded for
    tables per k; the single table records NULL.
    """
    if mode not in ("single", "per-ksize"):
        raise ValueError("mode must be single or per-ksize")
    wanted = list(ksizes) if ksizes else discover_ksizes(spark, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    if mode == "single":
        loaded = load_single(spark, root, f"{schema}.{table}", wanted, analyze)
        total = loaded.agg(F.count(F.lit(1)).alias("rows_ingested"))
        per_k = spark.createDataFrame([(root, k, f"{schema}.{table}", None) for k in wanted],
                                      "dataset_root string, ksize int, table_name string, rows_ingested bigint")
    else:
        tables = load_per_k(spark, root, schema, wanted, analyze, hash_buckets)
        per_k = None
        for k, name in tables.items():
            one = spark.table(name).agg(F.count(F.lit(1)).alias("rows_ingested")).select(
                F.lit(root).alias("dataset_root"), F.lit(k).alias("ksize"), F.lit(name).alias("table_name"),
                "rows_ingested")
            per_k = one if per_k is None else per_k.unionByName(one)
        total = per_k.agg(F.sum("rows_ingested").alias("rows_ingested"))
    # a load that failed is not recorded as made
    record_dataset(spark, schema, root, wanted)
    record_ksizes(per_k, schema)
    return total.select(F.lit(root).alias("dataset_root"), F.lit(mode).alias("mode"), F.lit(schema).alias("schema"),
                        F.lit(table if mode == "single" else None).cast("string").alias("table"),
                        F.lit(",".join(str(k) for k in wanted)).alias("ksizes"), "rows_ingested")
