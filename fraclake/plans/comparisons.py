"""Set algebra over text sketches and over the keys of the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.functions.unsigned import decimal_from_bits, unsigned_key
from fraclake.functions.hashing import md5_64
from fraclake.operators import hash_sets as sets
from fraclake.plans.inputs import (KEY_SCALED, SQL_KNOWN_KEYS, SQL_SOLD_KEYS, WORD_SCALED, known_keys, sold_keys,
                                   sql_word_bag, table, word_bag)
from fraclake.shared import shared_folder
from fraclake.sinks.hash_sets import BUCKET_BITS, write_flat
from fraclake.sources.hash_sets import read_flat_hashes

ROW_CAP = 5000


def _documents(spark: SparkSession, sf_dir: str, ksizes=(3, 5)) -> DataFrame:
    return word_bag(spark, sf_dir, "documents", "doc_id", ksizes)


def _benchmark(spark: SparkSession, sf_dir: str, ksizes=(3, 5)) -> DataFrame:
    return word_bag(spark, sf_dir, "benchmark", "item_id", ksizes)


_DOCS = f"SELECT DISTINCT ksize, hash FROM {sql_word_bag('documents', 'doc_id')}"
_BENCH = f"SELECT DISTINCT ksize, hash FROM {sql_word_bag('benchmark', 'item_id')}"
_AB = f"WITH a AS ({_DOCS}), b AS ({_BENCH})"
_SOLD_KNOWN = (f"WITH a AS (SELECT DISTINCT ksize, hash FROM {SQL_SOLD_KEYS}),"
               f" b AS (SELECT DISTINCT ksize, hash FROM {SQL_KNOWN_KEYS})")


def diff_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many hashes of the documents are not in the benchmark, and the reverse?"""
    return sets.difference_counts(sets.membership(_documents(spark, sf_dir), _benchmark(spark, sf_dir)))


def diff_by_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = sets.membership(_documents(spark, sf_dir, (5,)), _benchmark(spark, sf_dir, (5,)))
    return sets.difference_counts_by_bucket(members, BUCKET_BITS)


def diff_rollup_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known keys that were never sold, per k and in total."""
    return sets.difference_rollup(sets.membership(sold_keys(spark, sf_dir), known_keys(spark, sf_dir)))


def diff_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = sets.unique_hashes(known_keys(spark, sf_dir))
    return sets.difference(known, sets.unique_hashes(sold_keys(spark, sf_dir)))


def intersection_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = sets.unique_hashes(known_keys(spark, sf_dir))
    return sets.intersection(known, sets.unique_hashes(sold_keys(spark, sf_dir)))


def set_compare_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    members = sets.membership(_documents(spark, sf_dir), _benchmark(spark, sf_dir))
    return sets.comparison(members, "ksize")


def set_compare_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compare one k with a foreign table of which only the hash column is known."""
    path = shared_folder(spark, "external")
    write_flat(known_keys(spark, sf_dir).where("ksize = 31"), path)
    ours = sets.keep_ksizes(sold_keys(spark, sf_dir), [31])
    return sets.comparison(sets.membership(ours, read_flat_hashes(spark, path), ["hash"]))


def diff_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trial run: cap each side by rows in hash order before removing repeats."""
    a = sets.first_rows_distinct(_documents(spark, sf_dir, (5,)), ROW_CAP)
    b = sets.first_rows_distinct(_benchmark(spark, sf_dir, (5,)), ROW_CAP)
    return sets.difference_counts(sets.membership(a, b, ["hash"]))


def limited_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.first_rows_distinct(sold_keys(spark, sf_dir), ROW_CAP)


def unique_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sets.unique_hashes(sold_keys(spark, sf_dir))


def unsigned_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full-width hashes of the order keys as unsigned numbers, ascending."""
    orders = table(spark, sf_dir, "orders").select(F.lit(31).alias("ksize"), md5_64(F.col("o_orderkey").cast("string")).alias("hash"))
    return sets.sorted_hashes(orders.distinct()).select("ksize", decimal_from_bits("hash").cast("string").alias("value"))


def unsigned_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest and largest unsigned hash of the orders of each priority."""
    hashed = table(spark, sf_dir, "orders").select("o_orderpriority", md5_64(F.col("o_orderkey").cast("string")).alias("hash"))
    ends = hashed.groupBy("o_orderpriority").agg(F.min(unsigned_key("hash")).alias("lo"), F.max(unsigned_key("hash")).alias("hi"))
    return ends.select("o_orderpriority", decimal_from_bits(unsigned_key("lo")).cast("string").alias("smallest"),
                       decimal_from_bits(unsigned_key("hi")).cast("string").alias("largest"))


QUERIES = {
    "diff_both_ways": diff_both_ways,
    "diff_by_bucket": diff_by_bucket,
    "diff_rollup_k": diff_rollup_k,
    "diff_rows": diff_rows,
    "intersection_rows": intersection_rows,
    "set_compare_jaccard": set_compare_jaccard,
    "set_compare_external": set_compare_external,
    "diff_limited": diff_limited,
    "limited_rows": limited_rows,
    "unique_hashes": unique_hashes,
    "unsigned_order": unsigned_order,
    "unsigned_extremes": unsigned_extremes,
}

_COMPARED = """
  count(a.hash)::BIGINT AS a_total, count(b.hash)::BIGINT AS b_total,
  count(*) FILTER (a.hash IS NOT NULL AND b.hash IS NOT NULL)::BIGINT AS intersection,
  count(*) FILTER (b.hash IS NULL)::BIGINT AS a_only, count(*) FILTER (a.hash IS NULL)::BIGINT AS b_only,
  CASE WHEN count(*) = 0 THEN 0.0::DOUBLE
       ELSE count(*) FILTER (a.hash IS NOT NULL AND b.hash IS NOT NULL)::DOUBLE / count(*) END AS jaccard_similarity"""

_BY_BUCKET = """
  SELECT bucket, sum(x)::BIGINT AS a_not_b, sum(y)::BIGINT AS b_not_a FROM (
    SELECT (hash & 511)::INTEGER AS bucket, (hash NOT IN (SELECT hash FROM b))::INTEGER AS x, 0 AS y FROM a
    UNION ALL
    SELECT (hash & 511)::INTEGER, 0, (hash NOT IN (SELECT hash FROM a))::INTEGER FROM b) GROUP BY bucket"""


def _five(name: str, key: str) -> str:
    return sql_word_bag(name, key, (5,))


ORACLES = {
    "diff_both_ways": f"""{_AB}
      SELECT (SELECT count(*) FROM a ANTI JOIN b USING (ksize, hash)) AS a_not_b,
             (SELECT count(*) FROM b ANTI JOIN a USING (ksize, hash)) AS b_not_a""",
    "diff_by_bucket": f"""
      WITH a AS (SELECT DISTINCT hash FROM {_five('documents', 'doc_id')}),
           b AS (SELECT DISTINCT hash FROM {_five('benchmark', 'item_id')}) {_BY_BUCKET}""",
    "diff_rollup_k": f"""{_SOLD_KNOWN},
      d AS (SELECT b.ksize, (a.hash IS NULL)::INTEGER AS x FROM b LEFT JOIN a USING (ksize, hash))
      SELECT ksize, sum(x)::BIGINT AS rhs_not_in_lhs FROM d GROUP BY ROLLUP (ksize)""",
    "diff_rows": f"{_SOLD_KNOWN} SELECT ksize, hash FROM b ANTI JOIN a USING (ksize, hash)",
    "intersection_rows": f"{_SOLD_KNOWN} SELECT ksize, hash FROM b SEMI JOIN a USING (ksize, hash)",
    "set_compare_jaccard": f"{_AB} SELECT ksize, {_COMPARED} FROM a FULL JOIN b USING (ksize, hash) GROUP BY ksize",
    "set_compare_external": f"""{_SOLD_KNOWN}
      SELECT {_COMPARED} FROM (SELECT hash FROM a WHERE ksize = 31) a
      FULL JOIN (SELECT hash FROM b WHERE ksize = 31) b USING (hash)""",
    "diff_limited": f"""
      WITH a AS (SELECT DISTINCT hash FROM (SELECT hash FROM {_five('documents', 'doc_id')} ORDER BY hash LIMIT {ROW_CAP})),
           b AS (SELECT DISTINCT hash FROM (SELECT hash FROM {_five('benchmark', 'item_id')} ORDER BY hash LIMIT {ROW_CAP}))
      SELECT (SELECT count(*) FROM a ANTI JOIN b USING (hash)) AS a_not_b,
             (SELECT count(*) FROM b ANTI JOIN a USING (hash)) AS b_not_a""",
    "limited_rows": f"SELECT DISTINCT hash FROM (SELECT hash FROM {SQL_SOLD_KEYS} ORDER BY hash LIMIT {ROW_CAP})",
    "unique_hashes": f"SELECT DISTINCT ksize, hash FROM {SQL_SOLD_KEYS}",
    "unsigned_order": """
      SELECT DISTINCT 31::INTEGER AS ksize, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 16))::UBIGINT::VARCHAR AS value
      FROM orders""",
    "unsigned_extremes": """
      SELECT o_orderpriority, min(u)::VARCHAR AS smallest, max(u)::VARCHAR AS largest FROM (
        SELECT o_orderpriority, ('0x' || substr(md5(o_orderkey::VARCHAR), 1, 16))::UBIGINT AS u FROM orders)
      GROUP BY o_orderpriority""",
}
