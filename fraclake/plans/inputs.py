"""Derived inputs shared by the queries, each with its SQL twin.

The tables hold no genomes. Texts stand in for them in two ways: runs of words are
hashed like k-mers, and the bytes of a text, two bases each, form a DNA sequence.
Keys of the star schema give three collections under three k-sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraclake.functions.hashing import md5_64
from fraclake.functions.unsigned import unsigned_at_most
from fraclake.operators.sketching import max_hash_for, word_hashes
from fraclake.shared import widen

WORD_KSIZES = (3, 5)
WORD_SCALED = 10
KEY_SCALED = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wide(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table, ready for heavy per-row work on every core."""
    return widen(table(spark, sf_dir, name).select(*columns))


def hex_bound(scaled: int) -> str:
    return f"{max_hash_for(scaled):016x}"


# --- runs of words -----------------------------------------------------------

def word_bag(spark: SparkSession, sf_dir: str, name: str, key: str, ksizes=WORD_KSIZES,
             scaled: int = WORD_SCALED) -> DataFrame:
    """(key, ksize, hash) of a text table, repeats included."""
    return word_hashes(wide(spark, sf_dir, name, key, "text"), [key], "text", ksizes, scaled)


def sql_word_bag(name: str, key: str, ksizes=WORD_KSIZES, scaled: int = WORD_SCALED) -> str:
    runs = " UNION ALL ".join(
        f"SELECT {key}, {k}::INTEGER AS ksize, concat_ws(' ', word"
        + "".join(f", lead(word, {i}) OVER o" for i in range(1, k))
        + f") AS gram, lead(word, {k - 1}) OVER o AS last FROM words WINDOW o AS (PARTITION BY {key} ORDER BY i)"
        for k in ksizes)
    return f"""(
      WITH words AS (
        SELECT {key}, unnest(w) AS word, generate_subscripts(w, 1) AS i
        FROM (SELECT {key}, regexp_split_to_array(text, '[ \\n\\t\\r]+') AS w FROM {name}))
      SELECT {key}, ksize, ('0x' || hx)::UBIGINT::BIGINT AS hash FROM (
        SELECT {key}, ksize, substr(md5(gram), 1, 16) AS hx FROM ({runs}) WHERE last IS NOT NULL)
      WHERE hx <= '{hex_bound(scaled)}')"""


# --- keys of the star schema -------------------------------------------------

def _keyed(rows: DataFrame) -> DataFrame:
    hashed = rows.withColumn("hash", md5_64(F.concat_ws(":", "ksize", "key")))
    return hashed.where(unsigned_at_most("hash", max_hash_for(KEY_SCALED))).select("ksize", "hash")


def _pair(k: int, column: str) -> Column:
    return F.struct(F.lit(k).alias("ksize"), F.col(column).alias("key"))


def sold_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bag of (ksize, hash) of the order, part and supplier keys found in lineitem."""
    pairs = F.array(_pair(15, "l_orderkey"), _pair(31, "l_partkey"), _pair(33, "l_suppkey"))
    return _keyed(wide(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey").select(F.inline(pairs)))


def known_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for the order, part and supplier tables themselves."""
    orders = table(spark, sf_dir, "orders").select(F.inline(F.array(_pair(15, "o_orderkey"))))
    parts = table(spark, sf_dir, "part").select(F.inline(F.array(_pair(31, "p_partkey"))))
    suppliers = table(spark, sf_dir, "supplier").select(F.inline(F.array(_pair(33, "s_suppkey"))))
    return _keyed(orders.unionByName(parts).unionByName(suppliers))


def _sql_keyed(rows: str) -> str:
    return f"""(
      SELECT ksize, ('0x' || hx)::UBIGINT::BIGINT AS hash
      FROM (SELECT ksize, substr(md5(ksize || ':' || key), 1, 16) AS hx FROM ({rows}))
      WHERE hx <= '{hex_bound(KEY_SCALED)}')"""


SQL_SOLD_KEYS = _sql_keyed("""
        SELECT 15::INTEGER AS ksize, l_orderkey AS key FROM lineitem UNION ALL
        SELECT 31::INTEGER, l_partkey FROM lineitem UNION ALL
        SELECT 33::INTEGER, l_suppkey FROM lineitem""")
SQL_KNOWN_KEYS = _sql_keyed("""
        SELECT 15::INTEGER AS ksize, o_orderkey AS key FROM orders UNION ALL
        SELECT 31::INTEGER, p_partkey FROM part UNION ALL
        SELECT 33::INTEGER, s_suppkey FROM supplier""")


# --- DNA from the bytes of a text ---------------------------------------------

HEX_DIGITS, BASES = "0123456789ABCDEF", "ACGTACGTACGTACGT"


def dna(text: str) -> Column:
    """Each half byte of the text as one base."""
    return F.translate(F.hex(F.col(text)), HEX_DIGITS, BASES)


def sql_kmers(name: str, key: str, k: int) -> str:
    """(key, kmer): canonical k-mers of every text, cut into pieces to keep slicing cheap."""
    step = 256
    return f"""(
      SELECT {key}, least(substr(piece, i, {k}), substr(rc, len(piece) - i - {k} + 2, {k})) AS kmer FROM (
        SELECT {key}, piece, rc, unnest(range(1, least({step}, len(piece) - {k} + 1) + 1)) AS i FROM (
          SELECT {key}, piece, reverse(translate(piece, 'ACGT', 'TGCA')) AS rc FROM (
            SELECT {key}, substr(seq, f + 1, {step} + {k} - 1) AS piece FROM (
              SELECT {key}, seq, unnest(range(0, len(seq) - {k} + 1, {step})) AS f FROM (
                SELECT {key}, translate(hex(text), '{HEX_DIGITS}', '{BASES}') AS seq FROM {name}))))))"""
