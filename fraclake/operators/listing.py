"""From listing pages to rows for the work ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fraclake.functions.paths import HREF, SHARD_DIRECTORY, TARGET_FILE, href_kind, is_target_file


def page_links(pages: DataFrame) -> DataFrame:
    """(url, href) for every link of every page, repeats included."""
    return pages.select("url", F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("href"))


def classified_links(pages: DataFrame) -> DataFrame:
    """(url, href, kind) for sub-directories and gzip files; other links are dropped."""
    return page_links(pages).withColumn("kind", href_kind("href")).where(F.col("kind").isNotNull())


def listing_candidates(pages: DataFrame, base_url: str, pattern: str = TARGET_FILE,
                       follow_root: bool = True) -> DataFrame:
    """(subdir, filename, url, size, mtime) of the files to sketch.

    Pages of sub-directories count when the root page links to them; with
    ``follow_root=False``, for feeds that deliver the root page at another time, when
    their address is that of a sub-directory. Listings give no size or time. A file
    linked twice gives two rows; the ledger keeps one.
    """
    return link_candidates(classified_links(pages), base_url, pattern, follow_root)


def link_candidates(links: DataFrame, base_url: str, pattern: str = TARGET_FILE, follow_root: bool = True) -> DataFrame:
    """The same for classified links, which ``follow_root`` uses twice: store them where pages are dear to read."""
    base = base_url.rstrip("/")
    folder = F.substring("url", F.lit(len(base) + 2), F.length("url"))
    files = links.where((F.col("kind") == "file") & is_target_file("href", pattern))
    if follow_root:
        listed = links.where((F.col("url") == f"{base}/") & (F.col("kind") == "dir"))
        files = files.join(listed.select(F.concat(F.lit(f"{base}/"), "href").alias("url")).distinct(),
                           "url", "left_semi")
    else:
        files = files.where(F.col("url").startswith(f"{base}/") & folder.rlike(SHARD_DIRECTORY))
    return files.select(F.rtrim(folder, F.lit("/")).alias("subdir"), F.col("href").alias("filename"),
                        F.concat("url", "href").alias("url"),
                        F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("string").alias("mtime"))
