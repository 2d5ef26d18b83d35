"""Benchmark decontamination: documents that hold passages of test items.

Both sides are lower-cased (A-Z) and cut into words of digits, letters and characters beyond
ASCII. A window is ``size`` consecutive words of an item; an item with fewer words is one
window by itself. The windows' hashes go to every task as a sorted array behind a bit table;
every word position of every text is looked up, and each hit is verified word by word.

A benchmark of more windows than ``block`` is looked up block by block, so what is sent to
the tasks has a fixed bound; a document's hits are then merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import by_text, fresh, stored
from fraclake.llm.words import ALPHANUMERIC, text_bytes, window_rows, windows, words

#: Windows in one block: about 100 bytes each, so at most some 50 MB.
BLOCK_WINDOWS = 500_000
_BITS = 22

REPORT = "n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<start:bigint,stop:bigint>>"


@dataclass
class Index:
    """Windows of one block of items: hashes sorted per length, and each one's words and items."""

    by_length: dict[int, np.ndarray]
    table: np.ndarray
    known: dict[int, dict[tuple[bytes, ...], list[int | None]]]


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """(item_id, words) for each distinct window of each item."""
    text = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.filter(F.split(text, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), found.alias("found")).where(F.size("found") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("found") - size + 1))
    return (rows.select("item_id", "found", F.explode(starts).alias("at"))
            .select("item_id", F.slice("found", F.col("at"), size).alias("window")).distinct())


def index_of(rows: list) -> Index:
    flat = pa.array([" ".join(r.window) for r in rows], pa.string())
    code = words(flat, ALPHANUMERIC)
    table, lengths, known = np.zeros(1 << _BITS, bool), {}, {}
    for i, r in enumerate(rows):
        h = windows(code.hash[code.row[i]:code.row[i + 1]], len(r.window))[0]
        lengths.setdefault(len(r.window), set()).add(int(h))
        table[int(h) >> (64 - _BITS)] = True
        window = tuple(w.encode() for w in r.window)
        known.setdefault(int(h), {}).setdefault(window, []).append(r.item_id)
    return Index({n: np.sort(np.array(list(s), np.uint64)) for n, s in lengths.items()}, table, known)


def scan(index: Index, column: pa.Array) -> pa.Array:
    """A REPORT for each text."""
    found = words(column, ALPHANUMERIC, lower=True)
    hit = np.zeros(len(found.hash) + 1, np.int32)
    items: dict[int, set[int]] = {}
    for n, sorted_hashes in index.by_length.items():
        code = windows(found.hash, n)
        inside, _ = window_rows(found.row, n)
        likely = np.flatnonzero(index.table[(code >> np.uint64(64 - _BITS)).astype(np.int64)] & inside[:len(code)])
        place = np.minimum(np.searchsorted(sorted_hashes, code[likely]), len(sorted_hashes) - 1)
        for at in likely[sorted_hashes[place] == code[likely]]:
            owners = index.known[int(code[at])].get(found.text(at, n))
            if owners is None:
                continue  # another run of words with the same hash
            hit[at] += 1
            hit[at + n] -= 1
            row = int(np.searchsorted(found.row, at, "right")) - 1
            items.setdefault(row, set()).update(o for o in owners if o is not None)
    _, origin = text_bytes(column)
    covered = np.cumsum(hit[:-1]) > 0
    count = np.concatenate(([0], np.cumsum(covered)))
    spans: dict[int, list[dict]] = {}
    for row in np.flatnonzero(np.diff(count[found.row])):
        lo, hi = found.row[row], found.row[row + 1]
        edge = np.diff(covered[lo:hi].astype(np.int8), prepend=0, append=0)
        spans[int(row)] = [{"start": int(found.start[lo + a] - origin[row]), "stop": int(found.end[lo + b - 1] - origin[row])}
                           for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]
    rows = range(len(column))
    return pa.StructArray.from_arrays([
        pa.array(np.diff(found.row), pa.int64()), pa.array(np.diff(count[found.row]), pa.int64()),
        pa.array([sorted(items.get(r, ())) for r in rows], pa.list_(pa.int64())),
        pa.array([spans.get(r, []) for r in rows], pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
    ], names=["n_words", "n_hit", "items", "spans"])


def blocks(items: DataFrame, size: int, block: int = BLOCK_WINDOWS) -> list[DataFrame]:
    """The windows of the items in tables of at most twice ``block`` rows; one unless the benchmark is huge."""
    found = stored(item_windows(items.select("item_id", "text"), size), "item-windows")
    parts = max(1, -(-found.count() // block))
    while True:
        part = F.pmod(F.xxhash64("item_id", "window"), F.lit(parts))
        largest = found.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] or 0
        if parts == 1 or largest <= 2 * block:
            return [found.where(part == k) for k in range(parts)]
        parts *= 2


def scanned(index: Index) -> Column:
    """The report of a text against one index."""
    return by_text(lambda column: scan(index, column), f"struct<{REPORT}>")("text")


def merge(column: pa.Array, reports: pa.Array) -> pa.Array:
    """One report for each text from those of all blocks that have hits in it."""
    code, (_, origin) = words(column, ALPHANUMERIC, lower=True), text_bytes(column)
    out = []
    for row, parts in enumerate(reports.to_pylist()):
        spans: list[list[int]] = []
        for start, stop in sorted((s["start"], s["stop"]) for r in parts or () for s in r["spans"]):
            if spans and start <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], stop)
            else:
                spans.append([start, stop])
        lo, hi = code.row[row], code.row[row + 1]
        begins = code.start[lo:hi] - origin[row]
        hit = sum(int(np.searchsorted(begins, b) - np.searchsorted(begins, a)) for a, b in spans)
        out.append({"n_words": int(hi - lo), "n_hit": hit, "items": sorted({i for r in parts or () for i in r["items"]}),
                    "spans": [{"start": a, "stop": b} for a, b in spans]})
    return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))]))


def contamination(docs: DataFrame, items: DataFrame, size: int = 10, block: int = BLOCK_WINDOWS) -> DataFrame:
    """``docs`` with a struct column of n_words, n_hit (words inside any occurrence of a window),
    items (ids of the items that occur, ascending) and spans (byte ranges of the hit words),
    called ``contamination`` (with underscores in front if that is taken).

    A null or empty text has no words and no hits, a null or empty item no windows. An item
    without id counts for hits and is not listed. Repeated rows get equal reports. Other
    columns pass through untouched.
    """
    name = fresh(docs, "contamination")
    parts = blocks(items, size, block)
    if len(parts) == 1:
        return docs.withColumn(name, scanned(index_of(parts[0].collect())))
    # one block at a time is on the driver and in the tasks; what it hits is written before the next
    row = fresh(docs, "row")
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    found = [stored(rows.select(row, scanned(index_of(part.collect())).alias("r")).where("r.n_hit > 0"), "block-hits") for part in parts]
    hits = reduce(DataFrame.unionByName, found).groupBy(F.col(row).alias(f"{row}_hit")).agg(F.collect_list("r").alias("r"))  # one for each block at most
    joined = rows.join(hits, F.col(row) == F.col(f"{row}_hit"), "left")
    return joined.select(*[rows[c] for c in docs.columns], by_text(merge, f"struct<{REPORT}>")(rows["text"], hits["r"]).alias(name))


def without_contaminated(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """The rows of ``docs`` whose text holds no window of any item."""
    reported = contamination(docs, items, size)
    return reported.where(F.col(f"{reported.columns[-1]}.n_hit") == 0).select(*[f"`{c}`" for c in docs.columns])


def without_spans(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """``docs`` with the hit words cut out of the texts; what stands around them stays."""

    def cut(texts: pa.Array, reports: pa.Array) -> pa.Array:
        out = []
        for text, report in zip(texts.to_pylist(), reports.to_pylist()):
            if text is not None and report["spans"]:
                raw, kept, at = text.encode(), [], 0
                for span in report["spans"]:
                    kept.append(raw[at:span["start"]])
                    at = span["stop"]
                text = b"".join([*kept, raw[at:]]).decode()
            out.append(text)
        return pa.array(out, pa.string())

    reported = contamination(docs, items, size)
    name = reported.columns[-1]
    cleaned = reported.withColumn("text", by_text(cut, "string")("text", name))
    return cleaned.select(*[f"`{c}`" for c in docs.columns])


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The contract's row per document."""
    reported = contamination(docs.select("doc_id", "text"), items)
    ids = F.array_join(F.array_sort(F.transform("contamination.items", lambda i: i.cast("string"))), ",")
    return reported.select("doc_id", "contamination.n_words", "contamination.n_hit",
                           F.size("contamination.items").cast("long").alias("n_items"),
                           F.sha2(ids, 256).alias("items_sha256"), (F.col("contamination.n_hit") > 0).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM documents),
 b AS (SELECT item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
       FROM benchmark),
 bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
 sizes AS (SELECT DISTINCT n FROM bw),
 dw AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
 hits AS (SELECT r, i, bw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
 counted AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r),
 listed AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN counted USING (r) LEFT JOIN listed USING (r)
"""
