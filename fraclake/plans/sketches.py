"""Sketching and partition functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.functions import register_sql
from fraclake.functions.hashing import (ADD_1, ADD_2, C1, C2, FINAL_1, FINAL_2, KMER_SEED, md5_64)
from fraclake.functions.mixing import (GOLDEN_GAMMA, MULTIPLIER_1, MULTIPLIER_2, SHIFT_1, SHIFT_2, SHIFT_3,
                                       hex_label, with_partition_id)
from fraclake.operators.sketching import KSIZES, SCALED, generated_sketches, kmer_hashes, max_hash_for
from fraclake.plans.inputs import (WORD_KSIZES, dna, sql_kmers, sql_word_bag, table, wide, word_bag)
from fraclake.shared import shared_folder
from fraclake.sources.fasta import read_fasta
from fraclake.sources.fasta_ranges import read_fasta_ranges

DNA_SCALED = 100
MURMUR_SCALED = 10
PART_BITS = 10

_LOW = f"{(1 << 64) - 1}::UHUGEINT"


def sql_signed(value: str) -> str:
    """Unsigned 64-bit value to the BIGINT with the same bits."""
    return (f"(CASE WHEN {value} >= {1 << 63}::UHUGEINT THEN ({value})::HUGEINT - {1 << 64}::HUGEINT"
            f" ELSE ({value})::HUGEINT END)::BIGINT")


def text_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bag(spark, sf_dir, "documents", "doc_id").distinct()


def dna_kmer_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = wide(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", dna("text").alias("seq"))
    return kmer_hashes(records, ["doc_id"], "seq", (31,), DNA_SCALED, "md5_64").distinct()


def dna_murmur_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = wide(spark, sf_dir, "conversations", "conv_id", "text").select("conv_id", dna("text").alias("seq"))
    return kmer_hashes(records, ["conv_id"], "seq", (15, 31), MURMUR_SCALED, "murmur64").distinct()


def dna_default_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the parameters that sketches have by default."""
    records = wide(spark, sf_dir, "conversations", "conv_id", "text").select("conv_id", dna("text").alias("seq"))
    return kmer_hashes(records, ["conv_id"], "seq").distinct()


def _sql_word(first: int, count: int) -> str:
    """Little-endian value of up to eight characters of a k-mer."""
    if count == 0:
        return "0::UHUGEINT"
    return f"('0x' || hex(reverse(substr(kmer, {first}, {count}))))::UBIGINT::UHUGEINT"


def _sql_times(a: str, b: int) -> str:
    return f"((({a}) * {b}::UHUGEINT) & {_LOW})"


def _sql_rotl(a: str, n: int) -> str:
    return f"(((({a}) << {n}) & {_LOW}) | (({a}) >> {64 - n}))"


def _sql_murmur(kmers: str, key: str, k: int) -> str:
    """MurmurHash3 x64-128, first word, one step per sub-query."""
    def scrambled(word: str, first: int, turn: int, last: int) -> str:
        return _sql_times(_sql_rotl(_sql_times(word, first), turn), last)

    base = f"SELECT {key}, kmer, {KMER_SEED}::UHUGEINT AS h1, {KMER_SEED}::UHUGEINT AS h2 FROM {kmers}"
    at = 1
    while k - at + 1 >= 16:
        base = (f"SELECT *, {scrambled(_sql_word(at, 8), C1, 31, C2)} AS k1,"
                f" {scrambled(_sql_word(at + 8, 8), C2, 33, C1)} AS k2 FROM ({base})")
        base = f"SELECT {key}, kmer, {_sql_rotl('xor(h1, k1)', 27)} AS g1, xor(h2, k2) AS g2, h2 FROM ({base})"
        base = f"SELECT {key}, kmer, ((g1 + h2) * 5 + {ADD_1}) & {_LOW} AS h1, g2 FROM ({base})"
        base = f"SELECT {key}, kmer, h1, (({_sql_rotl('g2', 31)} + h1) * 5 + {ADD_2}) & {_LOW} AS h2 FROM ({base})"
        at += 16
    tail = k - at + 1
    base = (f"SELECT {key}, xor(xor(h1, {scrambled(_sql_word(at, min(8, tail)), C1, 31, C2)}), {k}::UHUGEINT) AS h1,"
            f" xor(xor(h2, {scrambled(_sql_word(at + 8, max(0, tail - 8)), C2, 33, C1)}), {k}::UHUGEINT) AS h2"
            f" FROM ({base})")
    base = f"SELECT {key}, (h1 + h2) & {_LOW} AS h1, (h1 + h2 + h2) & {_LOW} AS h2 FROM ({base})"
    for factor in (FINAL_1, FINAL_2):
        base = (f"SELECT {key}, {_sql_times('xor(h1, h1 >> 33)', factor)} AS h1,"
                f" {_sql_times('xor(h2, h2 >> 33)', factor)} AS h2 FROM ({base})")
    return f"SELECT {key}, {k}::INTEGER AS ksize, (xor(h1, h1 >> 33) + xor(h2, h2 >> 33)) & {_LOW} AS u FROM ({base})"


def _sql_murmur_sketch(ksizes: tuple[int, ...], scaled: int) -> str:
    hashes = " UNION ALL ".join(_sql_murmur(sql_kmers("conversations", "conv_id", k), "conv_id", k) for k in ksizes)
    return f"SELECT DISTINCT conv_id, ksize, {sql_signed('u')} AS hash FROM ({hashes}) WHERE u <= {max_hash_for(scaled)}::UHUGEINT"


_sql_by_length = " UNION ALL ".join(
    _sql_murmur(f"(SELECT l_orderkey, kmer FROM k WHERE len(kmer) = {n})", "l_orderkey", n) for n in range(1, 16))


def fasta_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the DNA of all documents as FASTA files by language, read them, sketch each."""
    root = shared_folder(spark, "fasta")
    docs = wide(spark, sf_dir, "documents", "doc_id", "text", "lang")
    lines = F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" lang>"), F.col("lang"), F.lit("\n"),
                     F.regexp_replace(F.lower(dna("text")), "(.{60})", "$1\n"))
    (docs.select("lang", lines.alias("value")).write.partitionBy("lang").option("compression", "gzip").text(root))
    file_name = F.regexp_extract("_metadata.file_path", r"lang=([^/]+)/", 1)
    records = read_fasta(spark, f"{root}/lang=*/*", file_name)
    return kmer_hashes(records, ["file"], "seq", (31,), DNA_SCALED, "md5_64", spread=True).distinct()


def fasta_ranges_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from plain files that are read by ranges, most of which begin inside a sequence."""
    root = shared_folder(spark, "fasta")
    docs = wide(spark, sf_dir, "documents", "doc_id", "text", "lang")
    lines = F.concat(F.lit(">"), F.col("doc_id").cast("string"), F.lit(" lang>"), F.col("lang"), F.lit("\n"),
                     F.regexp_replace(F.lower(dna("text")), "(.{60})", "$1\n"))
    docs.select("lang", lines.alias("value")).write.partitionBy("lang").text(root)
    pieces = read_fasta_ranges(spark, root, 31, ".txt", 5000)
    named = pieces.select(F.regexp_extract("path", r"lang=([^/]+)/", 1).alias("file"), "seq")
    return kmer_hashes(named, ["file"], "seq", (31,), DNA_SCALED, "md5_64").distinct()


def _row_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full-width hash per lineitem row; half of them have the sign bit set."""
    lines = wide(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber")
    return lines.withColumn("hash", md5_64(F.concat_ws("-", "l_orderkey", "l_linenumber")))


_ROW_HASHES = """(SELECT l_orderkey, l_linenumber,
    ('0x' || substr(md5(l_orderkey || '-' || l_linenumber), 1, 16))::UBIGINT::UHUGEINT AS u FROM lineitem)"""


def _partition(mode: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        placed = with_partition_id(_row_hashes(spark, sf_dir), PART_BITS, mode)
        return placed.select("l_orderkey", "l_linenumber", "hash", "part_id",
                             hex_label("part_id", PART_BITS).alias("part"))
    return query


def _sql_partition(source: str, part_id: str) -> str:
    return f"""
      SELECT l_orderkey, l_linenumber, {sql_signed('u')} AS hash, ({part_id})::INTEGER AS part_id,
             lpad(lower(to_hex(({part_id})::BIGINT)), {-(-PART_BITS // 4)}, '0') AS part
      FROM {source}"""


_MIXED = f"""(
    SELECT *, xor(z, z >> {SHIFT_3}) AS m FROM (
      SELECT * EXCLUDE z, {_sql_times(f'xor(z, z >> {SHIFT_2})', MULTIPLIER_2)} AS z FROM (
        SELECT * EXCLUDE z, {_sql_times(f'xor(z, z >> {SHIFT_1})', MULTIPLIER_1)} AS z FROM (
          SELECT *, (u + {GOLDEN_GAMMA}::UHUGEINT) & {_LOW} AS z FROM {_ROW_HASHES}))))"""


def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The functions registered for SQL, over the hashes of all lineitem rows."""
    register_sql(spark)
    return spark.sql("SELECT l_orderkey, l_linenumber, splitmix64(hash) AS mixed, hash_bucket(hash, 9) AS bucket,"
                     " murmur64(CAST(l_orderkey AS STRING)) AS murmur FROM {rows}", rows=_row_hashes(spark, sf_dir))


def synthetic_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated sketches for one archive per supplier."""
    return generated_sketches(wide(spark, sf_dir, "supplier", "s_suppkey"), "s_suppkey")


_SYNTHETIC = f"""
  SELECT DISTINCT archive, folder, member, ksize,
         ((('0x' || substr(md5(archive || '/' || member || '/' || ksize || '/' || draw), 1, 16))::UBIGINT >> 1)
          % {max_hash_for(1000)}::UBIGINT)::BIGINT AS hash
  FROM (SELECT s_suppkey AS archive, ['AAA', 'AAB', 'AAC'][(s_suppkey % 3 + 1)::INTEGER] AS folder,
               m::INTEGER AS member, k::INTEGER AS ksize,
               unnest(range(1, 201 + (s_suppkey + m + k) % 50)) AS draw
        FROM supplier, (VALUES (0), (1)) AS mm(m), (VALUES (15), (31), (33)) AS kk(k))"""

QUERIES = {
    "text_sketch": text_sketch,
    "dna_kmer_sketch": dna_kmer_sketch,
    "dna_murmur_sketch": dna_murmur_sketch,
    "dna_default_sketch": dna_default_sketch,
    "fasta_sketch": fasta_sketch,
    "fasta_ranges_sketch": fasta_ranges_sketch,
    "splitmix_partition": _partition("mix"),
    "low_partition": _partition("low"),
    "high_partition": _partition("high"),
    "sql_functions": sql_functions,
    "synthetic_sets": synthetic_sets,
}


def _sql_dna(key: str, source: str) -> str:
    return f"""
      SELECT DISTINCT {key}, 31::INTEGER AS ksize, ('0x' || hx)::UBIGINT::BIGINT AS hash
      FROM (SELECT {key}, substr(md5(kmer), 1, 16) AS hx FROM {source})
      WHERE hx <= '{max_hash_for(DNA_SCALED):016x}'"""


ORACLES = {
    "text_sketch": f"SELECT DISTINCT doc_id, ksize, hash FROM {sql_word_bag('documents', 'doc_id', WORD_KSIZES)}",
    "dna_kmer_sketch": _sql_dna("doc_id", sql_kmers("documents", "doc_id", 31)),
    "dna_murmur_sketch": _sql_murmur_sketch((15, 31), MURMUR_SCALED),
    "dna_default_sketch": _sql_murmur_sketch(KSIZES, SCALED),
    "fasta_sketch": _sql_dna("file", "(SELECT lang AS file, kmer FROM documents JOIN "
                             + sql_kmers("documents", "doc_id", 31) + " USING (doc_id))"),
    "splitmix_partition": _sql_partition(_MIXED, f"m >> {64 - PART_BITS}"),
    "low_partition": _sql_partition(_ROW_HASHES, f"u % {1 << PART_BITS}"),
    "high_partition": _sql_partition(_ROW_HASHES, f"u >> {64 - PART_BITS}"),
    "sql_functions": f"""
      WITH k AS (SELECT DISTINCT l_orderkey, l_orderkey::VARCHAR AS kmer FROM lineitem),
      h AS ({_sql_by_length})
      SELECT l_orderkey, l_linenumber, {sql_signed('m')} AS mixed, (u % 512)::BIGINT AS bucket, {sql_signed('h.u2')} AS murmur
      FROM {_MIXED} JOIN (SELECT l_orderkey, u AS u2 FROM h) h USING (l_orderkey)""",
    "synthetic_sets": _SYNTHETIC,
}

ORACLES["fasta_ranges_sketch"] = ORACLES["fasta_sketch"]
