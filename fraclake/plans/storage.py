"""Layouts on disk: write whole sets, read them back, describe them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.operators import hash_sets as sets
from fraclake.operators.aligned_difference import aligned_difference
from fraclake.operators.counting import sized_counts, unique_per_k
from fraclake.plans.comparisons import _benchmark, _documents
from fraclake.operators.sketching import word_hashes
from fraclake.operators.stored_comparison import compare_stored, stored_difference
from fraclake.plans.inputs import (SQL_KNOWN_KEYS, SQL_SOLD_KEYS, WORD_KSIZES, WORD_SCALED, known_keys, sold_keys,
                                   sql_word_bag, wide)
from fraclake.shared import shared_folder
from fraclake.sinks import hash_sets as layouts
from fraclake.sinks.archives import array_files, write_files, write_vectors
from fraclake.sinks.reports import write_report
from fraclake.sources.hash_sets import (OWN_TYPE, discover_ksizes, manifests_agree, read_bucketed_set, read_manifest,
                                         read_unique_set)
from fraclake.sources.formats import VECTORS, register
from fraclake.sources.vectors import find_vectors, read_vectors

CREATED_AT = "2025-08-12 00:00:00"

#: Partitions and buckets suited to the given tables; real sets use the layout defaults.
BITS = 5


def stored_set(spark: SparkSession, hashes: DataFrame, bits: int = BITS,
               mode: str = layouts.PARTITION_MODE) -> str:
    """Write a unique set with its manifest to a fresh folder and return the folder."""
    root = shared_folder(spark, "unique")
    layouts.write_unique_set(sets.unique_hashes(hashes), root, bits, mode)
    layouts.require_parquet(spark, root)
    layouts.write_manifest(layouts.manifest(read_unique_set(spark, root, hash_type=OWN_TYPE), bits, mode, CREATED_AT), root)
    return root


def parquet_set_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = stored_set(spark, sold_keys(spark, sf_dir))
    wanted = discover_ksizes(spark, root, (15, 31))
    return read_unique_set(spark, root, wanted, OWN_TYPE).select("ksize", "part", "hash")


def unique_per_k_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = stored_set(spark, sold_keys(spark, sf_dir))
    told = read_manifest(spark, root)
    return (told.select("*", F.explode("ksizes").alias("k", "v"))
            .select(F.col("k").cast("int").alias("ksize"), F.col("v.partitions").alias("partitions"),
                    F.col("v.distinct_count").alias("distinct_count"), "total_distinct", "format",
                    "partition_bits", "partition_mode", "created_at"))


def unique_rollup_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unique_per_k(layouts.with_part(sets.unique_hashes(sold_keys(spark, sf_dir)), BITS))


def layout_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bucketed export of the sold part keys; file and byte counts depend on the cluster."""
    root = shared_folder(spark, "bucketed")
    layouts.write_bucketed(sets.keep_ksizes(sold_keys(spark, sf_dir), [31]), root, BITS)
    layouts.require_parquet(spark, root)
    stats = layouts.layout_stats(layouts.list_parquet(spark, root))
    return stats.select((F.col("files") > 0).alias("has_files"), (F.col("bytes") > 0).alias("has_bytes"), "partitions")


def bucketed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "bucketed")
    layouts.write_bucketed(sets.keep_ksizes(sold_keys(spark, sf_dir), [15]), root, BITS)
    return read_bucketed_set(spark, root, OWN_TYPE).select("bucket", "hash")


def sketch_union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of documents into one flat table, then one sorted unique set per k."""
    flat, unique = shared_folder(spark, "flat"), shared_folder(spark, "sorted")
    docs = wide(spark, sf_dir, "documents", "doc_id", "lang", "text")
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for batch in (docs.where(english), docs.where(~english)):
        layouts.write_flat(_flat(batch), flat, mode="append")
    merged = spark.read.schema("hash bigint, scaled bigint, source_file string, sketch_name string, ksize int").parquet(flat)
    layouts.write_sorted_unique(merged, unique)
    return spark.read.schema("hash bigint, ksize int").parquet(unique).select("ksize", "hash")


def _flat(docs: DataFrame) -> DataFrame:
    bag = word_hashes(docs, ["doc_id"], "text", WORD_KSIZES, WORD_SCALED)
    return bag.select("hash", "ksize", F.lit(WORD_SCALED).cast("bigint").alias("scaled"),
                      F.concat(F.lit("doc-"), "doc_id").alias("source_file"),
                      F.concat(F.lit("doc-"), "doc_id").alias("sketch_name"))


def written_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference of two stored sets, itself written and read back as a stored set."""
    lhs, rhs = stored_set(spark, sold_keys(spark, sf_dir)), stored_set(spark, known_keys(spark, sf_dir))
    out = shared_folder(spark, "difference")
    lost = sets.difference(read_unique_set(spark, rhs, hash_type=OWN_TYPE), read_unique_set(spark, lhs, hash_type=OWN_TYPE))
    layouts.write_difference(lost, out, BITS)
    return read_unique_set(spark, out, hash_type=OWN_TYPE).select("ksize", "part", "hash")


def diff_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export both sides by bucket, compare the exports, write and read the report."""
    roots = {}
    for side, bag in (("a", _documents(spark, sf_dir, (5,))), ("b", _benchmark(spark, sf_dir, (5,)))):
        roots[side] = shared_folder(spark, f"export-{side}")
        layouts.write_bucketed(bag, roots[side], BITS)
        layouts.require_parquet(spark, roots[side])
    a, b = (read_bucketed_set(spark, roots[s], OWN_TYPE) for s in "ab")
    counts = sets.difference_counts(sets.membership(a, b, ["hash"]))
    facts = counts.select(F.lit(1).alias("_one"), "a_not_b", "b_not_a")
    for side, root in roots.items():
        seen = layouts.layout_stats(layouts.list_parquet(spark, root))
        facts = facts.join(seen.select(F.lit(1).alias("_one"), F.col("partitions").alias(f"{side}_buckets")), "_one")
    report = facts.select(F.lit(BITS).cast("bigint").alias("bucket_bits"),
                          F.lit((1 << BITS) - 1).cast("bigint").alias("mask"),
                          "a_not_b", "b_not_a", "a_buckets", "b_buckets")
    folder = shared_folder(spark, "report")
    write_report(report, folder)
    return spark.read.schema(report.schema).json(f"{folder}/json")


def stored_diff_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored sets with manifests compared as they are, the report written and both copies read."""
    lhs, rhs = (stored_set(spark, bag(spark, sf_dir)) for bag in (sold_keys, known_keys))
    report = compare_stored(spark, lhs, rhs, (15, 31), shared_folder(spark, "missing"), BITS)
    folder = shared_folder(spark, "report")
    write_report(report, folder)
    facts = spark.read.schema(report.schema).json(f"{folder}/json")
    line = spark.read.text(f"{folder}/text").where(F.col("value").startswith("total: ")).select(F.split("value", ": ")[1].cast("bigint").alias("text_total"))
    one = facts.join(line)  # one row each
    return one.select("rhs_not_in_lhs", "total", "text_total", "lhs_partitions", "rhs_partitions",
                      (F.col("lhs_files") >= F.col("lhs_partitions")).alias("lhs_files_fit"), (F.col("rhs_bytes") > 0).alias("rhs_has_bytes"))


def aligned_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difference of two sets stored alike, partition by partition; most hashes are in one partition,
    which is cut into many pieces."""
    lhs, rhs = (stored_set(spark, bag(spark, sf_dir), BITS, "high") for bag in (sold_keys, known_keys))
    return aligned_difference(spark, lhs, rhs, discover_ksizes(spark, rhs), 500)


def unlike_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for sets stored in different ways, which are joined instead."""
    lhs, rhs = stored_set(spark, sold_keys(spark, sf_dir), 4, "mix"), stored_set(spark, known_keys(spark, sf_dir))
    return stored_difference(spark, lhs, rhs, discover_ksizes(spark, rhs))


def manifest_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """May these pairs of stored sets be compared partition by partition?"""
    low = stored_set(spark, sold_keys(spark, sf_dir))
    same = stored_set(spark, known_keys(spark, sf_dir))
    finer = stored_set(spark, known_keys(spark, sf_dir), bits=4, mode="mix")
    bare = shared_folder(spark, "bare")
    layouts.write_unique_set(sets.unique_hashes(known_keys(spark, sf_dir)), bare, BITS)
    result = None
    for name, other in (("same", same), ("finer", finer), ("no manifest", bare)):
        verdict = manifests_agree(read_manifest(spark, low), read_manifest(spark, other))
        total = read_manifest(spark, low).select(F.lit(name).alias("pair"), F.col("total_distinct").alias("lhs_distinct"))
        row = total.join(verdict.withColumn("pair", F.lit(name)), "pair")
        result = row if result is None else result.unionByName(row)
    return result


def bin_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values and distinct values per k and partition of raw vector files."""
    root = shared_folder(spark, "vectors")
    write_vectors(sold_keys(spark, sf_dir), root, BITS)
    values = read_vectors(find_vectors(spark, root))
    per_hash = values.groupBy("ksize", "part", "hash").agg(F.count(F.lit(1)).alias("n"))
    return per_hash.groupBy("ksize", "part").agg(F.sum("n").alias("stored"), F.count(F.lit(1)).alias("distinct_hashes"))


def npy_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same of .npy files whose values have two bytes, read in short ranges."""
    root = shared_folder(spark, "arrays")
    narrow = sold_keys(spark, sf_dir).withColumn("hash", F.col("hash").bitwiseAND(0xFFFF))
    write_files(array_files(narrow, root, BITS, kind="<u2"))
    values = read_vectors(find_vectors(spark, root, ".npy"), 64)
    per_hash = values.groupBy("ksize", "part", "hash").agg(F.count(F.lit(1)).alias("n"))
    return per_hash.groupBy("ksize", "part").agg(F.sum("n").alias("stored"), F.count(F.lit(1)).alias("distinct_hashes"))


def vector_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One k of the raw vectors, read as a format that opens only the folders of that k."""
    root = shared_folder(spark, "vectors")
    write_vectors(sold_keys(spark, sf_dir), root, BITS)
    register(spark)
    values = spark.read.format(VECTORS).option("values", 1000).load(root).where("ksize = 31")
    per_hash = values.groupBy("ksize", "part", "hash").agg(F.count(F.lit(1)).alias("n"))
    return per_hash.groupBy("ksize", "part").agg(F.sum("n").alias("stored"), F.count(F.lit(1)).alias("distinct_hashes"))


def bin_roundtrip_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of stored values from file sizes and from reading them, and whether files and
    their mean agree with it: every partition has a file, and the mean times the files is the sum."""
    root = shared_folder(spark, "vectors")
    write_vectors(sold_keys(spark, sf_dir), root, BITS)
    files = find_vectors(spark, root)
    values = read_vectors(files, 1000)
    read = values.agg(F.count(F.lit(1)).alias("hashes"), F.count_distinct("ksize", "part").alias("parts"))
    both = sized_counts(files).withColumnRenamed("hashes", "sized").join(read)  # one row each
    return both.select("sized", "hashes", F.round(F.col("mean_per_file") * F.col("files")).cast("bigint").alias("mean_times_files"),
                       (F.col("files") >= F.col("parts")).alias("file_for_each_part"))


QUERIES = {
    "parquet_set_roundtrip": parquet_set_roundtrip,
    "unique_per_k_manifest": unique_per_k_manifest,
    "unique_rollup_k": unique_rollup_k,
    "layout_stats": layout_stats,
    "bucketed_rows": bucketed_rows,
    "sketch_union_batches": sketch_union_batches,
    "written_difference": written_difference,
    "diff_report": diff_report,
    "stored_diff_report": stored_diff_report,
    "aligned_diff": aligned_diff,
    "unlike_diff": unlike_diff,
    "manifest_guard": manifest_guard,
    "bin_vectors": bin_vectors,
    "npy_vectors": npy_vectors,
    "vector_format": vector_format,
    "bin_roundtrip_counts": bin_roundtrip_counts,
}

_PART = "lpad(lower(to_hex(hash & 31)), 2, '0')"
_SOLD = f"SELECT DISTINCT ksize, hash FROM {SQL_SOLD_KEYS}"
_KNOWN = f"SELECT DISTINCT ksize, hash FROM {SQL_KNOWN_KEYS}"


def _five(name: str, key: str) -> str:
    return f"SELECT DISTINCT hash FROM {sql_word_bag(name, key, (5,))}"


ORACLES = {
    "parquet_set_roundtrip": f"SELECT ksize, {_PART} AS part, hash FROM ({_SOLD}) WHERE ksize IN (15, 31)",
    "unique_per_k_manifest": f"""
      WITH u AS ({_SOLD})
      SELECT ksize, count(DISTINCT hash & 31) AS partitions, count(*) AS distinct_count,
             (SELECT count(*) FROM u) AS total_distinct, 'parquet' AS format, 5::INTEGER AS partition_bits,
             'low' AS partition_mode, '{CREATED_AT}' AS created_at
      FROM u GROUP BY ksize""",
    "unique_rollup_k": f"""
      WITH u AS (SELECT ksize, count(DISTINCT hash & 31) AS p, count(*) AS n FROM ({_SOLD}) GROUP BY ksize)
      SELECT ksize, sum(p)::BIGINT AS partitions, sum(n)::BIGINT AS distinct_count FROM u GROUP BY ROLLUP (ksize)""",
    "layout_stats": f"""
      SELECT count(*) > 0 AS has_files, count(*) > 0 AS has_bytes, count(DISTINCT hash & 31) AS partitions
      FROM ({_SOLD}) WHERE ksize = 31""",
    "bucketed_rows": f"SELECT (hash & 31)::INTEGER AS bucket, hash FROM ({_SOLD}) WHERE ksize = 15",
    "sketch_union_batches": f"SELECT DISTINCT ksize, hash FROM {sql_word_bag('documents', 'doc_id')}",
    "written_difference": f"""
      SELECT ksize, {_PART} AS part, hash FROM ({_KNOWN}) b ANTI JOIN ({_SOLD}) a USING (ksize, hash)""",
    "diff_report": f"""
      WITH a AS ({_five('documents', 'doc_id')}), b AS ({_five('benchmark', 'item_id')})
      SELECT 5::BIGINT AS bucket_bits, 31::BIGINT AS mask,
             (SELECT count(*) FROM a ANTI JOIN b USING (hash)) AS a_not_b,
             (SELECT count(*) FROM b ANTI JOIN a USING (hash)) AS b_not_a,
             (SELECT count(DISTINCT hash & 31) FROM a) AS a_buckets,
             (SELECT count(DISTINCT hash & 31) FROM b) AS b_buckets""",
    "stored_diff_report": f"""
      WITH l AS ({_SOLD}), r AS (SELECT DISTINCT ksize, hash FROM {SQL_KNOWN_KEYS}),
      lost AS (SELECT ksize, count(l.hash IS NULL OR NULL) AS n FROM r LEFT JOIN l USING (ksize, hash) WHERE ksize IN (15, 31) GROUP BY ksize)
      SELECT '{{' || string_agg('"' || ksize || '":' || n, ',' ORDER BY ksize) || '}}' AS rhs_not_in_lhs,
             sum(n)::BIGINT AS total, sum(n)::BIGINT AS text_total,
             (SELECT count(DISTINCT hash & 31) FROM l) AS lhs_partitions, (SELECT count(DISTINCT hash & 31) FROM r) AS rhs_partitions,
             true AS lhs_files_fit, true AS rhs_has_bytes FROM lost""",
    "aligned_diff": f"""
      SELECT ksize, lpad(lower(to_hex(hash >> 59 & 31)), 2, '0') AS part, hash FROM ({_KNOWN}) b ANTI JOIN ({_SOLD}) a USING (ksize, hash)""",
    "unlike_diff": f"""
      SELECT ksize, {_PART} AS part, hash FROM ({_KNOWN}) b ANTI JOIN ({_SOLD}) a USING (ksize, hash)""",
    "manifest_guard": f"""
      WITH n AS (SELECT count(*) AS lhs_distinct FROM ({_SOLD}))
      SELECT pair, lhs_distinct, compatible, 5::INTEGER AS lhs_bits, rhs_bits::INTEGER AS rhs_bits, 'low' AS lhs_mode,
             rhs_mode
      FROM n, (VALUES ('same', true, 5, 'low'), ('finer', false, 4, 'mix'), ('no manifest', true, NULL, NULL))
              AS v(pair, compatible, rhs_bits, rhs_mode)""",
    "bin_vectors": f"""
      SELECT ksize, {_PART} AS part, count(*) AS stored, count(DISTINCT hash) AS distinct_hashes
      FROM {SQL_SOLD_KEYS} GROUP BY ALL""",
    "vector_format": f"""
      SELECT ksize, {_PART} AS part, count(*) AS stored, count(DISTINCT hash) AS distinct_hashes
      FROM {SQL_SOLD_KEYS} WHERE ksize = 31 GROUP BY ALL""",
    "npy_vectors": f"""
      SELECT ksize, {_PART} AS part, count(*) AS stored, count(DISTINCT hash & 65535) AS distinct_hashes
      FROM {SQL_SOLD_KEYS} GROUP BY ALL""",
    "bin_roundtrip_counts": f"""
      SELECT n AS sized, n AS hashes, n AS mean_times_files, true AS file_for_each_part FROM (SELECT count(*) AS n FROM {SQL_SOLD_KEYS})""",
}
