"""Links of the pages, and listing pages derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraclake.functions.paths import (HREF, SHARD_DIRECTORY, TARGET_FILE, base_name, download_path, is_signature_member,
                                      is_target_file, output_path, shard_of)
from fraclake.operators.listing import classified_links, link_candidates, listing_candidates, page_links
from fraclake.plans.inputs import table
from fraclake.shared import shared_folder, stored
from fraclake.sinks.archives import write_files
from fraclake.sources.listings import read_pages

BASE = "https://files.example.org/assemblies"


def href_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_links(table(spark, sf_dir, "pages"))


def _code() -> Column:
    return F.upper(F.substring(F.md5(F.col("page_id").cast("string")), 1, 3))


def listing_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, html): for each page a piece of the root listing and a sub-directory
    listing around the page's own text. Some sub-directories are not linked."""
    linked = F.substring(F.md5(F.col("page_id").cast("string")), 4, 1) < "c"
    folder_link = F.when(linked, F.concat(F.lit('<a href="'), _code(), F.lit('/">d</a>'))).otherwise("")
    root = pages.select("page_id", F.lit(f"{BASE}/").alias("url"),
                        F.concat(F.lit('<a href="../">up</a><a href="stats/">s</a>'), folder_link).alias("html"))
    sub = pages.select(
        "page_id", F.concat(F.lit(f"{BASE}/"), _code(), F.lit("/")).alias("url"),
        F.concat("html", F.lit('<A HREF="wgs.'), _code(), F.lit("01."), "page_id", F.lit('.fsa_nt.gz">f</A>'),
                 F.lit('<a href="./">.</a><a href="wgs.'), _code(), F.lit('.gbff.gz">g</a><a href="A/">a</a>'),
                 F.lit('<a href="README.txt">r</a><a href="wgs.'), _code(), F.lit('X.fsa_nt.gz">f</a>')).alias("html"))
    return root.unionByName(sub)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified_links(listing_pages(table(spark, sf_dir, "pages")))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_candidates(listing_pages(table(spark, sf_dir, "pages")), BASE)


def saved_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candidates from pages that were saved as files and are read again."""
    folder = shared_folder(spark, "pages")
    pages = listing_pages(table(spark, sf_dir, "pages"))
    below = F.concat(F.substring("url", F.lit(len(BASE) + 1), F.length("url")), "page_id", F.lit(".html"))
    write_files(pages.select(F.concat(F.lit(folder), below).alias("path"), F.encode("html", "utf-8").alias("content")))
    read = read_pages(spark, folder, f"{BASE}/").withColumn("url", F.regexp_replace("url", "[^/]+$", ""))
    return link_candidates(stored(classified_links(read), "links"), BASE)


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicates and paths for names of many forms, made from the page addresses."""
    code = _code()
    number = F.col("page_id").cast("string")
    names = F.array(
        F.concat(F.lit("wgs."), code, number, F.lit(".1.fsa_nt.gz")), F.concat(F.lit("wgs."), code, F.lit(".fsa_nt.gz")),
        F.concat(F.lit("x/wgs."), code, F.lit("DTR.2.fsa_nt.gz")), F.concat(F.lit("wgs."), code, F.lit(".1.gbff.gz")),
        F.concat(F.lit("stats.wgs."), code, F.lit("/file.txt")), F.concat(F.lit("wgs.."), number, F.lit(".fsa_nt.gz")),
        F.concat(F.lit("other"), number), F.col("url"))
    listed = table(spark, sf_dir, "pages").select("page_id", F.explode(names).alias("name"))
    return listed.select(
        "page_id", "name", is_target_file("name").alias("is_target"), shard_of("name").alias("shard"),
        output_path("out", F.lit(""), base_name("name")).alias("out_path"),
        download_path("tmp", F.lit("SUB"), base_name("name")).alias("tmp_path"))


def member_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("page_id").cast("string")
    names = F.array(*[F.concat(F.lit(a), number, F.lit(b)) for a, b in (
        ("signatures/", ".sig.gz"), ("x/signatures/", ".sig.gz"), ("signatures/", ".sig"), ("other/", ".sig.gz"),
        ("xsignatures/", ".sig.gz"))])
    listed = table(spark, sf_dir, "pages").select(F.explode(names).alias("name"))
    return listed.select("name", is_signature_member("name").alias("anywhere"),
                         is_signature_member("name", root_only=True).alias("at_root"))


QUERIES = {
    "href_links": href_links,
    "href_kinds": classified,
    "listing_candidates": candidates,
    "saved_pages": saved_pages,
    "file_names": file_names,
    "member_names": member_names,
}

_SQL_CODE = "upper(substr(md5(page_id::VARCHAR), 1, 3))"
SQL_LISTING_PAGES = f"""(
  SELECT page_id, '{BASE}/' AS url, '<a href="../">up</a><a href="stats/">s</a>' ||
    CASE WHEN substr(md5(page_id::VARCHAR), 4, 1) < 'c' THEN '<a href="' || {_SQL_CODE} || '/">d</a>' ELSE '' END AS html
  FROM pages UNION ALL
  SELECT page_id, '{BASE}/' || {_SQL_CODE} || '/', html || '<A HREF="wgs.' || {_SQL_CODE} || '01.' || page_id ||
    '.fsa_nt.gz">f</A><a href="./">.</a><a href="wgs.' || {_SQL_CODE} || '.gbff.gz">g</a><a href="A/">a</a>' ||
    '<a href="README.txt">r</a><a href="wgs.' || {_SQL_CODE} || 'X.fsa_nt.gz">f</a>'
  FROM pages)"""
SQL_KINDS = f"""(
  SELECT * FROM (
    SELECT page_id, url, href, CASE WHEN href IN ('../', './') THEN NULL
           WHEN regexp_matches(href, '{SHARD_DIRECTORY}') THEN 'dir' WHEN ends_with(href, '.gz') THEN 'file' END AS kind
    FROM (SELECT page_id, url, unnest(regexp_extract_all(html, '{HREF[4:]}', 1, 'i')) AS href FROM {SQL_LISTING_PAGES}))
  WHERE kind IS NOT NULL)"""


def sql_candidates(follow_root: bool) -> str:
    rule = (f"url IN (SELECT '{BASE}/' || href FROM {SQL_KINDS} WHERE kind = 'dir' AND url = '{BASE}/')"
            if follow_root else f"url <> '{BASE}/'")
    return f"""(
      SELECT page_id, rtrim(substr(url, {len(BASE) + 2}), '/') AS subdir, href AS filename, url || href AS url,
             NULL::BIGINT AS size, NULL::VARCHAR AS mtime
      FROM {SQL_KINDS} WHERE kind = 'file' AND regexp_matches(href, '{TARGET_FILE}') AND {rule})"""


_SQL_SHARD = """CASE WHEN starts_with(base, 'wgs.') THEN
    coalesce(nullif(substr(split_part(substr(base, 5), '.', 1), 1, 3), ''), 'misc') ELSE 'misc' END"""

ORACLES = {
    "href_links": f"""
      SELECT url, unnest(regexp_extract_all(html, '{HREF[4:]}', 1, 'i')) AS href FROM pages""",
    "href_kinds": f"SELECT url, href, kind FROM {SQL_KINDS}",
    "listing_candidates": f"SELECT subdir, filename, url, size, mtime FROM {sql_candidates(True)}",
    "saved_pages": f"SELECT subdir, filename, url, size, mtime FROM {sql_candidates(True)}",
    "file_names": f"""
      SELECT page_id, name, regexp_matches(base, '{TARGET_FILE}') AS is_target, {_SQL_SHARD} AS shard,
             'out/' || {_SQL_SHARD} || '/' || base || '.sig.zip' AS out_path, 'tmp/SUB/' || base AS tmp_path
      FROM (SELECT page_id, name, split_part(name, '/', -1) AS base FROM (
        SELECT page_id, unnest(['wgs.' || c || page_id || '.1.fsa_nt.gz', 'wgs.' || c || '.fsa_nt.gz',
          'x/wgs.' || c || 'DTR.2.fsa_nt.gz', 'wgs.' || c || '.1.gbff.gz', 'stats.wgs.' || c || '/file.txt',
          'wgs..' || page_id || '.fsa_nt.gz', 'other' || page_id, url]) AS name
        FROM (SELECT page_id, url, {_SQL_CODE} AS c FROM pages)))""",
    "member_names": """
      SELECT name, ends_with(name, '.sig.gz') AND (starts_with(name, 'signatures/') OR contains(name, '/signatures/')) AS anywhere,
             ends_with(name, '.sig.gz') AND starts_with(name, 'signatures/') AS at_root
      FROM (SELECT unnest(['signatures/' || page_id || '.sig.gz', 'x/signatures/' || page_id || '.sig.gz',
        'signatures/' || page_id || '.sig', 'other/' || page_id || '.sig.gz', 'xsignatures/' || page_id || '.sig.gz']) AS name
        FROM pages)""",
}
