"""Exact copies by distributed MSD radix partitioning.

Texts are split by successive bytes, from the first on, until a group holds one text or its
texts have ended; texts that end in the same group are equal byte for byte, and no digest says
so. A round splits by a run of bytes at once: 64 in the first, then four times as many as in the
round before, so a text of a megabyte takes eight rounds, and the number of rounds follows from
the longest text that shares all its bytes so far with another.

Copies are gathered before anything is shuffled: within a batch of rows, equal texts become one
entry with the list of their rows. So a text that a third of all rows hold is one entry per
batch, and a group is as large as the number of batches, not of rows. A round shuffles the next
bytes of the open entries for counting, and these entries once more to take their new group;
entries alone in their group leave, and the first round looks only at a short column of heads.
Every round is written, so a lost executor costs a part of one round.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import fresh, small_side, stored
from fraclake.llm.words import cuts

HEAD, GROWTH = 64, 4
#: Bytes of text whose rows are gathered at once.
GATHERED = 8 << 20


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row (ids, text) for each text of some rows; ``ids`` lists theirs."""
    for batch in batches:
        texts = batch.column("text")
        for lo, hi in cuts(texts, GATHERED):
            part = texts.slice(lo, hi - lo).dictionary_encode()
            of = part.indices
            order = pc.sort_indices(of)
            ids = batch.column("id").slice(lo, hi - lo).take(order)
            sizes = pc.value_counts(of.take(order)).field("counts").to_pylist()
            ends = [0]
            for size in sizes:
                ends.append(ends[-1] + size)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([lists, part.dictionary.cast(pa.binary())], names=["ids", "text"])


def entries(rows: DataFrame) -> DataFrame:
    """(entry, ids, n, top, head, text), written, of rows (id, text) with distinct ids.

    Texts become bytes with the ids of the rows that hold them; ``entry`` numbers them, ``n``
    counts the rows and ``top`` is the largest id.
    """
    plain = rows.select("id", F.coalesce("text", F.lit("")).alias("text"))
    found = plain.mapInArrow(gathered, f"ids array<{plain.schema['id'].dataType.simpleString()}>, text binary")
    return stored(found.select(F.monotonically_increasing_id().alias("entry"), "ids", F.size("ids").cast("long").alias("n"), F.array_max("ids").alias("top"),
                               F.substring("text", 1, HEAD).alias("head"), "text"), "texts")


def split(opened: DataFrame, width: int) -> DataFrame:
    """Open entries that share their group's next bytes with another, written.

    ``opened`` has entry, part, digit, n and top and any other columns. The result has the
    new ``part``, named by its smallest entry, and for the whole part ``rows``, ``keep`` (the
    largest id) and ``ended``: all its texts have ended.
    """
    found = (opened.groupBy("part", "digit").agg(F.count("*").alias("entries"), F.min("entry").alias("name"), F.sum("n").alias("rows"), F.max("top").alias("keep"))
             .where("entries > 1").drop("entries"))
    joined = opened.join(found, ["part", "digit"]).withColumn("ended", F.length("digit") < width)
    return stored(joined.drop("part", "digit").withColumnRenamed("name", "part"), "shared-bytes")


def copies(rows: DataFrame, *columns: Column) -> DataFrame:
    """(ids, keep, rows) and ``columns`` of the text: the entries of rows (id, text) with distinct
    ids, and for each the largest id of its text and the number of rows that hold it.

    Texts themselves are not shuffled for this, only what ``columns`` make of them.
    """
    found = entries(rows)
    shared = split(found.select("entry", F.lit(0).cast("long").alias("part"), F.col("head").alias("digit"), "n", "top"), HEAD)
    ended, width = [shared], HEAD
    tails = shared.where("not ended").select("entry", "part", "n", "top")
    opened = stored(found.select("entry", F.expr(f"substring(text, {HEAD + 1})").alias("rest")).join(small_side(tails), "entry"), "tails")
    while not opened.isEmpty():
        width *= GROWTH
        shared = split(opened.withColumn("digit", F.expr(f"substring(rest, 1, {width})")).withColumn("rest", F.expr(f"substring(rest, {width + 1})")), width)
        ended.append(shared)
        opened = shared.where("not ended").select("entry", "part", "n", "top", "rest")
    known = reduce(DataFrame.union, [s.where("ended").select("entry", "rows", "keep") for s in ended])
    out = found.select("entry", "ids", "n", "top", *columns).join(small_side(known), "entry", "left")
    named = [c for c in out.columns if c not in ("entry", "ids", "n", "top", "rows", "keep")]
    return out.select("ids", F.coalesce("keep", "top").alias("keep"), F.coalesce("rows", "n").alias("rows"), *named)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.withColumn("id", F.struct("doc_id", F.monotonically_increasing_id().alias("row")))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for each row of (doc_id, text).

    Of the rows with one text that with the largest doc_id stays; of rows that repeat this
    doc_id and text just one. Null texts count as empty and are copies of empty ones. A null
    doc_id ranks below all others. Without rows there is no result. The digest is for readers;
    equality does not rest on it.
    """
    found = copies(_numbered(docs.select("doc_id", "text")).select("id", "text"), F.sha2("text", 256).alias("text_sha256"))
    rows = found.select("keep", "rows", "text_sha256", F.explode("ids").alias("id"))
    return rows.select("id.doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("rows").alias("group_size"), (F.col("id.row") == F.col("keep.row")).alias("kept"), "text_sha256")


def without_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each text, the one that ``report`` keeps, and all its columns."""
    name = fresh(docs, "row")
    written = stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    found = copies(written.select(F.struct("doc_id", F.col(name).alias("row")).alias("id"), "text"))
    kept = found.select("keep.row").distinct().withColumnRenamed("row", name)
    return written.join(kept, name, "left_semi").select(*[f"`{c}`" for c in docs.columns])


#: The same in DuckDB's SQL; no doc_id may repeat.
SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
