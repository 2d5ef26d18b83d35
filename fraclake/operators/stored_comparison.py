"""What one stored set has that another lacks, with the facts of both sides."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.operators.aligned_difference import aligned_difference
from fraclake.operators.hash_sets import difference
from fraclake.sinks.hash_sets import layout_stats, list_parquet, write_difference
from fraclake.sources.hash_sets import OWN_TYPE, discover_ksizes, manifests_agree, read_manifest, read_unique_set, require_compatible


def stored_difference(spark: SparkSession, lhs: str, rhs: str, ksizes: list[int], hash_type: str | None = OWN_TYPE) -> DataFrame:
    """(ksize, part, hash): rows of the stored set ``rhs`` that ``lhs`` lacks.

    Where both manifests say that the sets are partitioned alike, no hash is shuffled.
    """
    told = manifests_agree(read_manifest(spark, lhs), read_manifest(spark, rhs)).first()
    if told.compatible and told.lhs_bits is not None and told.rhs_bits is not None:
        return aligned_difference(spark, lhs, rhs, ksizes)
    left, right = (read_unique_set(spark, root, ksizes, hash_type) for root in (lhs, rhs))
    return difference(right, left).select("ksize", "part", "hash")


def compare_stored(spark: SparkSession, lhs: str, rhs: str, ksizes: Collection[int] | None = None, out: str | None = None,
                   bits: int = 8, mode: str = "low", hash_type: str | None = OWN_TYPE, strict: bool = False) -> DataFrame:
    """One row: hashes of ``rhs`` that ``lhs`` lacks per k (a JSON object) and in all, and files,
    bytes and partitions of each side.

    Sets whose manifests name the same partitioning are compared partition by partition, others
    by a join; ``strict`` refuses those whose manifests differ. The k-sizes are those of ``rhs``,
    cut to those asked for. With ``out`` the missing hashes are written there as a
    stored set first, and counted from it.
    """
    wanted = discover_ksizes(spark, rhs, ksizes)
    if strict:
        require_compatible(read_manifest(spark, lhs), read_manifest(spark, rhs))
    lost = stored_difference(spark, lhs, rhs, wanted, hash_type)
    if out:
        write_difference(lost, out, bits, mode)
        lost = read_unique_set(spark, out, wanted, OWN_TYPE) if list_parquet(spark, out).where("length > 0").count() else lost.limit(0)
    every = spark.createDataFrame([(k,) for k in wanted], "ksize int")
    counts = every.join(lost.groupBy("ksize").agg(F.count(F.lit(1)).alias("n")), "ksize", "left").fillna(0, ["n"])
    entry = F.struct(F.col("ksize").cast("string").alias("key"), F.col("n").alias("value"))
    report = counts.agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("rhs_not_in_lhs"), F.sum("n").alias("total"))
    for side, root in (("lhs", lhs), ("rhs", rhs)):
        facts = layout_stats(list_parquet(spark, root), "part")
        report = report.join(facts.select(*[F.col(c).alias(f"{side}_{c}") for c in facts.columns]))  # one row each
    return report
