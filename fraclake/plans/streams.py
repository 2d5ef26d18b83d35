"""Streams over the given tables: each runs twice, so that the second run must find
only what is new, and the stored result is returned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fraclake.plans.archives import SQL_KINDS, SQL_NAME, damaged_archives, document_archives, sketched_documents, write_document_archives
from fraclake.plans.inputs import SQL_KNOWN_KEYS, SQL_SOLD_KEYS, WORD_KSIZES, known_keys, sold_keys, sql_word_bag, table
from fraclake.plans.listings import BASE, listing_pages, sql_candidates
from fraclake.shared import fresh_database, shared_folder, stored
from fraclake.sinks.archives import write_files
from fraclake.sources.archives import flat_hashes
from fraclake.sources.formats import NAME, register
from fraclake.streaming.filtered import compact_filtered_set, grow_filtered_set
from fraclake.streaming.ingest import (compact_table, compact_unique_set, grow_unique_set, grow_unique_table, ingest_archives, ingested,
                                       ingested_hashes, read_grown_set, read_grown_table)
from fraclake.streaming.ledger import compact_ledger, feed_ledger, read_ledger_version, record_outcomes

CLOCK = 1705708800.0
STEP = 100.0


def _ingested_twice(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Archives of the English documents, then of all others, which carry times long past."""
    base = shared_folder(spark, "stream-archives")
    sketched = sketched_documents(spark, sf_dir)
    english = F.coalesce(F.col("lang") == "en", F.lit(False))
    for part, days in ((english, 0), (~english, 30)):
        write_document_archives(sketched.where(part), f"{base}/in", days)
        ingest_archives(spark, f"{base}/in", f"{base}/out", f"{base}/log", WORD_KSIZES)
    return f"{base}/out", f"{base}/log"


def stream_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each archive is ingested once, whatever its time."""
    flat = ingested_hashes(spark, *_ingested_twice(spark, sf_dir))
    return flat.groupBy(F.regexp_extract("source_file", "[^/]+$", 0).alias("source_file"), "ksize").agg(
        F.count(F.lit(1)).alias("stored"))


def stream_archive_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives as a stream that runs twice over a folder; the second time it finds those that came
    since, which carry times long past."""
    base = shared_folder(spark, "stream-format")
    sketched = sketched_documents(spark, sf_dir)
    register(spark)
    odd = F.col("doc_id") % 2 == 1
    for part, days in ((odd, 0), (~odd, 30)):
        write_document_archives(sketched.where(part), f"{base}/in", days)
        rows = spark.readStream.format(NAME).option("ksizes", "5").option("settle", 0).load(f"{base}/in")
        flat = flat_hashes(rows).select("hash", "ksize", "scaled", "source_file")
        (flat.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True)
         .start(f"{base}/out").awaitTermination())
    flat = spark.read.schema("hash bigint, ksize int, scaled bigint, source_file string").parquet(f"{base}/out")
    return flat.groupBy(F.regexp_extract("source_file", "[^/]+$", 0).alias("source_file"), "ksize").agg(F.count(F.lit(1)).alias("stored"))


def stream_archive_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of damaged archives and members over two runs, the second of which finds the rest."""
    base = shared_folder(spark, "stream-errors")
    packed = damaged_archives(spark, sf_dir)
    even = F.pmod(F.col("path").cast("bigint"), F.lit(2)) == 0
    for part in (even, ~even):
        write_files(packed.where(part).withColumn("path", F.concat(F.lit(f"{base}/in/"), "path", F.lit(".sig.zip"))))
        ingest_archives(spark, f"{base}/in", f"{base}/out", f"{base}/log", (5,))
    return ingested(spark, f"{base}/log").groupBy("run", "status").agg(F.count(F.lit(1)).alias("n"), F.count("error").alias("errors"))


def stream_archive_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hashes of archives of which every third was cut in half when the first run came, and
    whole when the second did."""
    base = shared_folder(spark, "stream-retries")
    sketched = sketched_documents(spark, sf_dir)
    whole = document_archives(sketched, f"{base}/in")
    half = F.expr("IF(doc_id % 3 = 0, substring(content, 1, length(content) div 2), content)")
    for run, files in enumerate((whole.withColumn("content", half), whole.where("doc_id % 3 = 0"))):
        write_files(files.select("path", "content"))
        ingest_archives(spark, f"{base}/in", f"{base}/out", f"{base}/log", WORD_KSIZES, now=CLOCK + run)
    flat = ingested_hashes(spark, f"{base}/out", f"{base}/log")
    tried = ingested(spark, f"{base}/log").groupBy(F.col("path").alias("source_file")).agg(F.max("run").alias("last_run"), F.count_if(F.col("status") == "bad_archive").alias("faults"))
    counts = flat.groupBy("source_file").agg(F.count(F.lit(1)).alias("stored"))
    return (tried.join(counts, "source_file", "left")
            .select(F.regexp_extract("source_file", "[^/]+$", 0).alias("source_file"), "last_run", "faults", F.coalesce("stored", F.lit(0)).alias("stored")))


def _with_null(bag: DataFrame) -> DataFrame:
    """The bag, which is made and kept once, and one NULL hash for each of its k."""
    bag = stored(bag, "bag")
    return bag.unionByName(bag.select("ksize").distinct().withColumn("hash", F.lit(None).cast("bigint")))


def stream_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold keys first, known keys later, into a table bucketed by hash: it gains only what it
    lacks, NULLs too, and is compacted in the end."""
    base, name = shared_folder(spark, "stream-unique"), f"{fresh_database(spark)}.hashes"
    for bag in (sold_keys(spark, sf_dir), known_keys(spark, sf_dir)):
        _with_null(bag).write.mode("append").parquet(f"{base}/in")
        hashes = spark.readStream.schema("ksize int, hash bigint").parquet(f"{base}/in")
        grow_unique_table(hashes, name, f"{base}/checkpoint", 8).awaitTermination()
    compact_table(spark, name, 8)
    return read_grown_table(spark, name)


def stream_unique_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same into a folder whose additions are commits, compacted once there are two."""
    base = shared_folder(spark, "stream-folder")
    for bag in (sold_keys(spark, sf_dir), known_keys(spark, sf_dir)):
        _with_null(bag).write.mode("append").parquet(f"{base}/in")
        hashes = spark.readStream.schema("ksize int, hash bigint").parquet(f"{base}/in")
        grow_unique_set(hashes, f"{base}/out", f"{base}/checkpoint").awaitTermination()
        compact_unique_set(spark, f"{base}/out", keep=1)
    return read_grown_set(spark, f"{base}/out")


def stream_unique_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with filters beside the folders; what was sold comes a second time after compaction, and is known."""
    base = shared_folder(spark, "stream-filtered")
    sold, known = _with_null(sold_keys(spark, sf_dir)), _with_null(known_keys(spark, sf_dir))
    for bag in (sold, known, sold):
        bag.write.mode("append").parquet(f"{base}/in")
        hashes = spark.readStream.schema("ksize int, hash bigint").parquet(f"{base}/in")
        grow_filtered_set(hashes, f"{base}/out", f"{base}/checkpoint", bits=4).awaitTermination()
        compact_filtered_set(spark, f"{base}/out", bits=4, keep=1)
    return read_grown_set(spark, f"{base}/out")


def stream_unique_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table without NULLs and without compaction."""
    base, table_name = shared_folder(spark, "stream-table"), f"{fresh_database(spark)}.hashes"
    for bag in (sold_keys(spark, sf_dir), known_keys(spark, sf_dir)):
        bag.write.mode("append").parquet(f"{base}/in")
        hashes = spark.readStream.schema("ksize int, hash bigint").parquet(f"{base}/in")
        grow_unique_table(hashes, table_name, f"{base}/checkpoint", 8).awaitTermination()
    return read_grown_table(spark, table_name)


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages arrive in two parts; between them, outcomes of every third file are
    recorded and all changes are folded into the base; the second part leaves them alone."""
    base = shared_folder(spark, "stream-ledger")
    pages = listing_pages(table(spark, sf_dir, "pages"))
    odd = F.col("page_id") % 2 == 1
    for part in (odd, ~odd):
        pages.where(part).select("url", "html").write.mode("append").parquet(f"{base}/in")
        arriving = spark.readStream.schema("url string, html string").parquet(f"{base}/in")
        feed_ledger(arriving, BASE, f"{base}/out", f"{base}/checkpoint",
                    lambda n: CLOCK + STEP * n).awaitTermination()
        waiting = read_ledger_version(spark, f"{base}/out")
        done = waiting.where("id % 3 = 0").select(
            "id", F.lit("DONE").alias("status"), F.concat(F.lit("/done/"), "filename").alias("out_path"),
            F.lit(None).cast("string").alias("error"), F.lit(False).alias("inc_tries"), F.lit(CLOCK + 1).alias("ts"))
        record_outcomes(spark, f"{base}/out", done, "outcomes@noon/1")  # the second time it is known
        compact_ledger(spark, f"{base}/out")
    return read_ledger_version(spark, f"{base}/out")


QUERIES = {
    "stream_archives": stream_archives,
    "stream_archive_format": stream_archive_format,
    "stream_archive_errors": stream_archive_errors,
    "stream_archive_retries": stream_archive_retries,
    "stream_unique": stream_unique,
    "stream_unique_folder": stream_unique_folder,
    "stream_unique_filtered": stream_unique_filtered,
    "stream_unique_table": stream_unique_table,
    "stream_ledger": stream_ledger,
}

_BAG = sql_word_bag("documents", "doc_id")
_SQL_WITH_NULLS = f"""SELECT ksize, hash FROM {SQL_SOLD_KEYS} UNION SELECT ksize, hash FROM {SQL_KNOWN_KEYS}
  UNION ALL SELECT DISTINCT ksize, NULL::BIGINT FROM (SELECT ksize FROM {SQL_SOLD_KEYS} UNION SELECT ksize FROM {SQL_KNOWN_KEYS})"""

ORACLES = {
    "stream_archives": f"""
      SELECT {SQL_NAME} AS source_file, ksize,
             CASE WHEN doc_id % 4 = 3 THEN count(DISTINCT hash) ELSE count(*) END AS stored
      FROM {_BAG} GROUP BY doc_id, ksize""",
    "stream_archive_format": f"""
      SELECT {SQL_NAME} AS source_file, ksize,
             CASE WHEN doc_id % 4 = 3 THEN count(DISTINCT hash) ELSE count(*) END AS stored
      FROM {_BAG} WHERE ksize = 5 GROUP BY doc_id, ksize""",
    "stream_archive_errors": f"""{SQL_KINDS}
      SELECT (1 + doc_id % 2)::INTEGER AS run, status, count(*) AS n, count(*) FILTER (status LIKE 'bad%') AS errors FROM m GROUP BY ALL""",
    "stream_archive_retries": f"""
      WITH n AS (SELECT doc_id, ksize, CASE WHEN doc_id % 4 = 3 THEN count(DISTINCT hash) ELSE count(*) END AS n FROM {_BAG} GROUP BY doc_id, ksize),
      t AS (SELECT doc_id, sum(n)::BIGINT AS n FROM n GROUP BY doc_id)
      SELECT {SQL_NAME} AS source_file, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END::INTEGER AS last_run,
             CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS faults, coalesce(n, 0)::BIGINT AS stored
      FROM documents LEFT JOIN t USING (doc_id)""",
    "stream_unique": _SQL_WITH_NULLS,
    "stream_unique_folder": _SQL_WITH_NULLS,
    "stream_unique_filtered": _SQL_WITH_NULLS,
    "stream_unique_table": f"SELECT ksize, hash FROM {SQL_SOLD_KEYS} UNION SELECT ksize, hash FROM {SQL_KNOWN_KEYS}",
    "stream_ledger": f"""
      WITH c AS (SELECT subdir, filename, url, min(1 - page_id % 2) AS first, max(1 - page_id % 2) AS last
                 FROM {sql_candidates(False)} GROUP BY ALL),
      n AS (SELECT *, row_number() OVER (PARTITION BY first ORDER BY md5(subdir || '/' || filename))
                   + CASE WHEN first = 1 THEN (SELECT count(*) FROM c WHERE first = 0) ELSE 0 END AS id FROM c)
      SELECT id, subdir, filename, url, NULL::BIGINT AS size, NULL::VARCHAR AS mtime,
             CASE WHEN first = 0 AND id % 3 = 0 THEN 'DONE' ELSE 'PENDING' END AS status,
             0::INTEGER AS tries, NULL::VARCHAR AS last_error,
             CASE WHEN first = 0 AND id % 3 = 0 THEN '/done/' || filename END AS out_path,
             (CASE WHEN first = 0 AND last = 0 AND id % 3 = 0 THEN {CLOCK} + 1 ELSE {CLOCK} + {STEP} * last END)::DOUBLE AS updated_at,
             ({CLOCK} + {STEP} * first)::DOUBLE AS created_at FROM n""",
}
