"""Lines that a site repeats: site-relative line frequency.

Pages are grouped by site. A line's frequency is the number of the site's pages that hold it
over the number of the site's pages; copies of one page count as one page on both sides, so a
page that was fetched often does not make its own text look like boilerplate. On request near
copies count as one page too, with the links of near-dedup. Lines at or above the ratio are
dropped from every page of the site.

Lines are compared without blanks around them, by a 64-bit hash; blank lines stay. Only
hashes are shuffled for counting, pre-aggregated per (site, line), so a site with a third of
all pages is many keys. A site has at most (lines per page / ratio) such lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import fresh, small_side, stored
from fraclake.llm.near_duplicates import link
from fraclake.shared import passing

RATIO, LEAST_PAGES = 0.02, 5
#: Fixed value: the blanks taken off both ends of a line.
AROUND = " \t\r"


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(AROUND))


def _hash(line: Column) -> Column:
    return F.xxhash64(_bare(line))


def copy_groups(pages: DataFrame) -> DataFrame:
    """(t1, copies): the group of near copies that each text with a doc_id is in."""
    with passing(pages.sparkSession) as made:
        linked = link(pages.select("doc_id", "text", F.xxhash64("text").alias("copy_t1")), also=("copy_t1",)).where("component_id is not null")
        groups = stored(linked.groupBy(F.col("copy_t1").alias("t1")).agg(F.min("component_id").alias("copies")), "copy-groups")
        made.pop()
    return groups


def boilerplate(pages: DataFrame, site: str = "source", ratio: float = RATIO, least: int = LEAST_PAGES, near: bool = False) -> DataFrame:
    """(site, lines): hashes of the lines on at least ``ratio`` of the site's pages, and on ``least`` of them.

    With ``near``, a group of near copies is one page that holds the lines of all.
    """
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: _bare(x) != "")
    page = pages.select(F.col(site).alias("site"), F.xxhash64("text").alias("t1"), F.hash("text").alias("t2"),
                        F.array_distinct(F.transform(lines, _hash)).alias("lines"))
    distinct = stored(page.groupBy("site", "t1", "t2").agg(F.any_value("lines").alias("lines")), "site-pages")
    each, found = distinct, distinct.select("site", F.explode("lines").alias("line"))
    if near:
        named = distinct.join(copy_groups(pages), "t1", "left")
        # a text in no group is told apart by its hashes
        own = [F.when(F.col("copies").isNull(), F.col(c)).alias(c) for c in ("t1", "t2")]
        each = named.select("site", "copies", *own).distinct()
        found = named.select("site", "copies", *own, F.explode("lines").alias("line")).distinct()
    totals = each.groupBy("site").agg(F.count("*").alias("pages"))
    counts = found.groupBy("site", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    joined = counts.join(totals.withColumnRenamed("site", "s"), F.col("site").eqNullSafe(F.col("s")))
    often = joined.where(F.col("n") >= ratio * F.col("pages"))
    return often.groupBy("site").agg(F.collect_set("line").alias("lines"))


def reported(pages: DataFrame, site: str = "source", ratio: float = RATIO, least: int = LEAST_PAGES, near: bool = False) -> tuple[DataFrame, str]:
    """``pages`` with a struct column (n_lines, n_dropped, text), and that column's name."""
    found = stored(boilerplate(pages, site, ratio, least, near), "boilerplate")
    name, key, bad = (fresh(pages, n) for n in ("cleaned", "site_key", "site_lines"))
    renamed = found.select(F.col("site").alias(key), F.col("lines").alias(bad))
    joined = pages.join(small_side(renamed), F.col(f"`{site}`").eqNullSafe(F.col(key)), "left")
    lines = F.split(F.col("text"), "\n")
    kept = F.filter(lines, lambda x: (_bare(x) == "") | ~F.array_contains(F.col(bad), _hash(x)))
    # a page of a site without such lines, or without text, stays as it is
    parts = F.when(F.col(bad).isNull(), lines).otherwise(kept)
    cleaned = F.transform(F.array(parts), lambda p: F.struct(
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(p), F.lit(0)).cast("long").alias("n_dropped"),
        F.array_join(p, "\n").alias("text")))[0]
    return joined.withColumn(name, cleaned).drop(key, bad), name


def without_boilerplate(docs: DataFrame, site: str = "source", ratio: float = RATIO, least: int = LEAST_PAGES, near: bool = False) -> DataFrame:
    """``docs`` without their sites' boilerplate lines.

    ``n_chars``, where there is one, follows the text. Documents of which only blanks are
    left are dropped; documents without such lines stay untouched, empty and null ones too.
    Rows without a site form a site. Repeated rows are cleaned alike. With ``near``, near
    copies count as one page; that needs a doc_id.
    """
    found, name = reported(docs, site, ratio, least, near)
    cut = F.col(f"{name}.n_dropped") > 0
    text = F.col(f"{name}.text")
    out = found.where(~cut | (_bare(F.replace(text, F.lit("\n"), F.lit(""))) != ""))
    new = {"text": F.when(cut, text).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return out.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """One row per document: how many of its lines went, and the text that is left."""
    found, name = reported(docs.select("doc_id", "source", "text"))
    return found.select("doc_id", "source", f"{name}.n_lines", f"{name}.n_dropped", f"{name}.text")


SQL = f"""
WITH p AS (SELECT DISTINCT source, text FROM documents WHERE text IS NOT NULL),
 totals AS (SELECT source, count(*) AS pages FROM (SELECT DISTINCT source, text FROM documents) GROUP BY source),
 l AS (SELECT DISTINCT source, text, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line FROM p),
 often AS (SELECT l.source, line FROM l JOIN totals ON l.source IS NOT DISTINCT FROM totals.source WHERE line <> '' GROUP BY l.source, line, pages
           HAVING count(*) >= {LEAST_PAGES} AND count(*) >= {RATIO} * pages),
 d AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS ls FROM documents),
 e AS (SELECT r, source, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM d),
 k AS (SELECT e.r, e.i, e.line, often.line IS NULL AS keep FROM e LEFT JOIN often ON e.source IS NOT DISTINCT FROM often.source
       AND trim(e.line, ' ' || chr(9) || chr(13)) = often.line),
 a AS (SELECT r, count(*) FILTER (WHERE NOT keep) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keep) AS text FROM k GROUP BY r)
SELECT doc_id, source, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(n_dropped, 0)::BIGINT AS n_dropped,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(a.text, '') END AS text
FROM d LEFT JOIN a USING (r)
"""
