"""Signature archives made from the documents, written, found and decoded again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraclake.operators.counting import distinct_per_k, extraction_counts, run_statistics
from fraclake.operators.hash_sets import unique_hashes
from fraclake.operators.sketching import GENERATED_FOLDERS, max_hash_for, word_sketch_arrays
from fraclake.plans.inputs import WORD_KSIZES, WORD_SCALED, sql_word_bag, wide
from fraclake.shared import shared_folder
from fraclake.sinks.archives import pack_archives, write_files
from fraclake.sources.archives import decode_archive_files, decode_archives, flat_hashes, list_archives, sketch_rows
from fraclake.sources.formats import NAME, register
from fraclake.sources.signatures import decode_signatures

MAX_HASH = max_hash_for(WORD_SCALED)


def sketched_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, lang, h3, h5): both sketches of each document as arrays."""
    docs = wide(spark, sf_dir, "documents", "doc_id", "text", "lang")
    return word_sketch_arrays(docs, ["doc_id", "lang"], "text", WORD_KSIZES, WORD_SCALED)


def signature_json(hashes: str, k: int, extra: Column | None = None) -> Column:
    """The JSON of one sketch; the shape of the file varies with the document.

    A list of records, an object with max_hash instead of scaled, a bare signature
    without a file name, and hashes as the keys of an object.
    """
    values = F.array_join(F.transform(hashes, lambda h: h.cast("string")), ",")
    if extra is not None:
        values = F.concat_ws(",", F.nullif(values, F.lit("")), extra)
    as_keys = F.array_join(F.transform(F.array_distinct(hashes), lambda h: F.concat(F.lit('"'), h.cast("string"), F.lit('":1'))), ",")
    name = F.concat(F.lit('"filename":"doc-'), "doc_id", F.lit('"'))
    plain = F.concat(F.lit(f'{{"ksize":{k},"scaled":{WORD_SCALED},"mins":['), values, F.lit("]}"))
    bounded = F.concat(F.lit(f'{{"ksize":{k},"max_hash":{MAX_HASH},"mins":['), values, F.lit("]}"))
    keyed = F.concat(F.lit(f'{{"ksize":{k},"scaled":{WORD_SCALED},"mins":[],"hashes":{{'), as_keys, F.lit("}}"))
    shape = F.pmod("doc_id", F.lit(4))
    return (F.when(shape == 0, F.concat(F.lit("[{"), name, F.lit(',"signatures":['), plain, F.lit("]}]")))
            .when(shape == 1, F.concat(F.lit("{"), name, F.lit(',"signatures":['), bounded, F.lit("]}")))
            .when(shape == 2, plain)
            .otherwise(F.concat(F.lit("[{"), name, F.lit(',"signatures":['), keyed, F.lit("]}]"))))


def archive_name() -> Column:
    return F.concat(F.lit("wgs.DOC"), F.lpad(F.col("doc_id").cast("string"), 8, "0"), F.lit(".1.fsa_nt.gz.sig.zip"))


def archive_path(root: str) -> Column:
    folder = F.element_at(F.array(*[F.lit(f) for f in GENERATED_FOLDERS]), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    return F.concat_ws("/", F.lit(root), folder, archive_name())


def _entry(name: str | Column, text: Column, plain: Column | bool = False) -> Column:
    return F.struct((F.lit(name) if isinstance(name, str) else name).alias("name"), text.alias("json"),
                    (F.lit(plain) if isinstance(plain, bool) else plain).alias("plain"))


def document_archives(sketched: DataFrame, root: str) -> DataFrame:
    """(doc_id, path, content): one archive for each document."""
    members = F.array(_entry("MANIFEST.csv", F.lit("not,used\n"), True),
                      _entry("signatures/a.3.sig.gz", signature_json("h3", 3)),
                      _entry("nested/signatures/a.5.sig.gz", signature_json("h5", 5)))
    packed = pack_archives(sketched.select(archive_path(root).alias("path"), members.alias("members")))
    return packed.withColumn("doc_id", F.regexp_extract("path", r"DOC0*(\d+)", 1).cast("bigint"))


def write_document_archives(sketched: DataFrame, root: str, days_old: int = 0) -> None:
    write_files(document_archives(sketched, root), days_old)


def archive_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_folder(spark, "archives")
    write_document_archives(sketched_documents(spark, sf_dir), root)
    flat = flat_hashes(decode_archive_files(list_archives(spark, root), WORD_KSIZES)).distinct()
    return flat.select("hash", "ksize", "scaled", *[F.regexp_extract(c, "[^/]+$", 0).alias(c)
                                                    for c in ("source_file", "sketch_name")])


def archive_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashes of one k, read as a format that decodes only sketches of that k."""
    root = shared_folder(spark, "archives")
    write_document_archives(sketched_documents(spark, sf_dir), root)
    register(spark)
    rows = spark.read.format(NAME).load(root).where("ksize = 5")
    return flat_hashes(rows).distinct().select("hash", "ksize", "scaled", *[F.regexp_extract(c, "[^/]+$", 0).alias(c) for c in ("source_file", "sketch_name")])


def archive_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All archives one directory down, members at the root only: one set of hashes."""
    root = shared_folder(spark, "archives")
    write_document_archives(sketched_documents(spark, sf_dir), root)
    rows = decode_archive_files(list_archives(spark, root, recursive=False), root_only=True)
    return unique_hashes(flat_hashes(rows))


def archive_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every sketch as stored."""
    root = shared_folder(spark, "archives")
    write_document_archives(sketched_documents(spark, sf_dir), root)
    rows = decode_archive_files(list_archives(spark, root))
    return sketch_rows(rows).select(F.regexp_extract("path", "[^/]+$", 0).alias("source_file"), "ksize", "scaled",
                                    "num_hashes")


def damaged_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content): archives of all documents, most of them damaged in one way or another."""
    kind = F.pmod("doc_id", F.lit(9))
    good = signature_json("h5", 5)
    text = F.when(kind == 2, F.concat(F.lit("{"), good)).when(
        kind == 5, signature_json("h5", 5, F.lit(str(1 << 64)))).otherwise(good)
    # The shapes that keep hashes as keys take the impossible value there.
    text = F.when((kind == 5) & (F.pmod("doc_id", F.lit(4)) == 3), F.lit(
        f'{{"ksize":5,"hashes":{{"{1 << 64}":1}}}}')).otherwise(text)
    # Metadata that fits no column: a name that is a number, a scale and a bound out of range.
    for wrong, fields in ((6, '"filename":7,"ksize":5'), (7, f'"ksize":5,"scaled":{1 << 63}'), (8, '"ksize":5,"max_hash":-1000000000000000000000')):
        text = F.when(kind == wrong, F.lit('{' + fields + ',"mins":[1]}')).otherwise(text)
    folder = F.when(kind == 4, "other/").otherwise("signatures/")
    members = F.array(_entry(F.concat(folder, F.lit("a.3.sig.gz")), signature_json("h3", 3)),
                      _entry(F.concat(folder, F.lit("a.5.sig.gz")), text, kind == 3))
    sketched = sketched_documents(spark, sf_dir)
    packed = pack_archives(sketched.select(F.col("doc_id").cast("string").alias("path"), members.alias("members")))
    cut = F.expr("substring(content, 1, length(content) div 2)")
    return packed.withColumn("content", F.when(F.pmod(F.col("path").cast("bigint"), F.lit(9)) == 1, cut)
                             .otherwise(F.col("content")))


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decode_archives(damaged_archives(spark, sf_dir), (5,))


def archive_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = F.col("member_head") | F.col("member").isNull()
    return _damaged(spark, sf_dir).where(heads).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def archive_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction_counts(_damaged(spark, sf_dir))


def archive_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_statistics(_damaged(spark, sf_dir))


def archive_unique_per_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_per_k(flat_hashes(_damaged(spark, sf_dir)))


def signature_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loose JSON decoded by Spark; every fifth document holds an impossible value."""
    extra = F.when(F.pmod("doc_id", F.lit(5)) == 4, F.lit(str(1 << 64)))
    loose = sketched_documents(spark, sf_dir).select("doc_id", signature_json("h5", 5, extra).alias("json"))
    rows = decode_signatures(loose, "json", ["doc_id"])
    return rows.select("doc_id", "filename", "ksize", "scaled", "num_hashes",
                       F.explode_outer("hashes").alias("hash")).distinct()


QUERIES = {
    "archive_roundtrip": archive_roundtrip,
    "archive_format": archive_format,
    "archive_union": archive_union,
    "archive_sketches": archive_sketches,
    "archive_status": archive_status,
    "archive_counters": archive_counters,
    "archive_run_stats": archive_run_stats,
    "archive_unique_per_k": archive_unique_per_k,
    "signature_json_decode": signature_json_decode,
}

SQL_NAME = "'wgs.DOC' || lpad(doc_id::VARCHAR, 8, '0') || '.1.fsa_nt.gz.sig.zip'"
_BAG = sql_word_bag("documents", "doc_id")
_FIVE = sql_word_bag("documents", "doc_id", (5,))
SQL_KINDS = f"""
  WITH n AS (SELECT doc_id, count(*) AS n FROM {_FIVE} GROUP BY doc_id),
  d AS (SELECT doc_id, doc_id % 9 AS kind, coalesce(n, 0) AS n FROM documents LEFT JOIN n USING (doc_id)),
  m AS (SELECT 'no_match' AS status, d.* FROM d WHERE kind NOT IN (1, 4) UNION ALL
        SELECT CASE kind WHEN 1 THEN 'bad_archive' WHEN 2 THEN 'bad_content' WHEN 3 THEN 'bad_read' WHEN 4 THEN 'empty'
               WHEN 5 THEN 'bad_content' WHEN 6 THEN 'bad_content' WHEN 7 THEN 'bad_content' WHEN 8 THEN 'bad_content' ELSE CASE WHEN n > 0 THEN 'ok' ELSE 'no_match' END END, d.* FROM d)"""

ORACLES = {
    "archive_roundtrip": f"""
      SELECT DISTINCT hash, ksize, {WORD_SCALED}::BIGINT AS scaled, {SQL_NAME} AS source_file,
             CASE WHEN doc_id % 4 = 2 THEN {SQL_NAME} ELSE 'doc-' || doc_id END AS sketch_name FROM {_BAG}""",
    "archive_format": f"""
      SELECT DISTINCT hash, ksize, {WORD_SCALED}::BIGINT AS scaled, {SQL_NAME} AS source_file,
             CASE WHEN doc_id % 4 = 2 THEN {SQL_NAME} ELSE 'doc-' || doc_id END AS sketch_name FROM {_BAG} WHERE ksize = 5""",
    "archive_union": f"SELECT DISTINCT ksize, hash FROM {_BAG} WHERE ksize = 3",
    "archive_sketches": f"""
      SELECT {SQL_NAME} AS source_file, ksize, {WORD_SCALED}::BIGINT AS scaled,
             CASE WHEN doc_id % 4 = 3 THEN count(DISTINCT hash) ELSE count(*) END AS num_hashes
      FROM {_BAG} GROUP BY doc_id, ksize""",
    "archive_status": f"{SQL_KINDS} SELECT status, count(*) AS n FROM m GROUP BY status",
    "archive_counters": f"""{SQL_KINDS}
      SELECT count(DISTINCT doc_id) AS archives,
             count(*) FILTER (status IN ('ok', 'no_match', 'bad_content')) AS members_read,
             count(*) FILTER (status = 'ok') AS members_ok,
             count(*) FILTER (status IN ('bad_content', 'bad_read')) AS members_bad FROM m""",
    "archive_run_stats": f"""
      WITH n AS (SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN count(DISTINCT hash) ELSE count(*) END AS n
                 FROM {_FIVE} GROUP BY doc_id)
      SELECT count(*) AS total_files, count(*) FILTER (doc_id % 9 <> 1) AS processed_files,
             count(*) FILTER (doc_id % 9 = 1) AS failed_files,
             coalesce(sum(n) FILTER (doc_id % 9 = 0), 0)::BIGINT AS total_hashes
      FROM documents LEFT JOIN n USING (doc_id)""",
    "archive_unique_per_k": f"SELECT ksize, count(DISTINCT hash) AS unique_hashes FROM {_FIVE} WHERE doc_id % 9 = 0 GROUP BY ksize",
    "signature_json_decode": f"""
      WITH b AS (SELECT * FROM {_FIVE} WHERE doc_id % 5 <> 4 OR doc_id % 4 = 3),
      n AS (SELECT doc_id, CASE WHEN doc_id % 4 = 3 THEN count(DISTINCT hash) ELSE count(*) END AS num_hashes
            FROM b GROUP BY doc_id)
      SELECT DISTINCT doc_id, CASE WHEN doc_id % 4 <> 2 THEN 'doc-' || doc_id END AS filename, ksize,
             {WORD_SCALED}::BIGINT AS scaled, num_hashes, hash
      FROM b JOIN n USING (doc_id)""",
}
