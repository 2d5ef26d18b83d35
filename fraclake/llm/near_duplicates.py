"""Near-duplicate documents by b-bit MinHash.

Each text becomes the set of its distinct five-word shingles. 256 minima of the set give 51
band keys of five minima each, and the low two bits of every minimum are packed into eight
longs. Texts with equal sets form one class; what follows works on class representatives.
Band keys give candidates; their packed signatures give an estimate, corrected for the
chance agreement of low bits, by counting bits; pairs far below the threshold are let go and
the others are confirmed on the full sets.

A pair at the threshold of 0.75 escapes all bands with probability (1 - 0.75^5)^51, one in
a million, and is let go by the estimate only if that is off by six standard deviations.

Groups do not become pairs. First each member of a band's bucket is compared with the
bucket's smallest member, and confirmed links are closed to components. Then, in buckets
that still hold several components, members outside the bucket's main component are compared
with members of other components. A text can share no more shingles than those that occur in
two or more of the texts in question, which are counted first; this count, the size, the
signature and the set travel with a member, and the join compares them in this order, so
that only links become rows. So copies and near copies cost a pair each per bucket, other
texts with much in common cost none, and no link between components is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.components import closed
from fraclake.llm.frames import by_text, fresh, stored
from fraclake.llm.words import NOT_BLANK, keys, mix, window_rows, windows, words

SHINGLE = 5
ROWS, BANDS, SLOTS = 5, 51, 256
#: Six standard deviations below 0.75 of an estimate from 256 slots of two bits.
LET_GO = 0.55

SKETCH = "n bigint, set array<bigint>, bands array<bigint>, bits array<bigint>"
_XOR = keys(SLOTS, 11).astype(np.uint32)
_TIMES = keys(SLOTS, 12).astype(np.uint32) | np.uint32(1)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows one after another, and where each row's begin."""
    found = words(column, NOT_BLANK, lower=True)
    code = windows(found.hash, SHINGLE)
    inside, _ = window_rows(found.row, SHINGLE)
    sets = []
    for lo, hi in zip(found.row, found.row[1:]):
        if hi - lo >= SHINGLE:
            sets.append(np.unique(code[lo:hi - SHINGLE + 1]))
        else:
            sets.append(windows(found.hash[lo:hi], int(hi - lo)) if hi > lo else code[:0])
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return (np.concatenate(sets) if sets else code[:0]), first


def minima(shingles: np.ndarray, first: np.ndarray) -> np.ndarray:
    """One row of SLOTS minima for each set, none of which may be empty."""
    out = np.empty((len(first) - 1, SLOTS), np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    lo = 0
    while lo < len(first) - 1:  # some sets at a time, so that the vectors stay in cache
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + 16384, "right")) - 1)
        part, at = short[first[lo]:first[hi]], first[lo:hi] - first[lo]
        for k in range(SLOTS):
            out[lo:hi, k] = np.minimum.reduceat((part ^ _XOR[k]) * _TIMES[k], at)
        lo = hi
    return out


def sketches(column: pa.Array) -> pa.Array:
    shingles, first = shingle_sets(column)
    sizes = np.diff(first)
    full = sizes > 0
    low = minima(shingles, np.append(first[:-1][full], first[-1])) if full.any() else np.zeros((0, SLOTS), np.uint32)
    rows = low[:, :ROWS * BANDS].astype(np.uint64).reshape(-1, BANDS, ROWS)
    bands = mix((rows * keys(ROWS, 13)).sum(axis=2, dtype=np.uint64) + keys(BANDS, 14))
    two = ((low >> np.uint32(7)) & np.uint32(3)).astype(np.uint64).reshape(-1, SLOTS // 32, 32)
    bits = (two << (2 * np.arange(32, dtype=np.uint64))).sum(axis=2, dtype=np.uint64)
    digests = np.zeros((len(low), 2), np.int64)
    for i, row in enumerate(np.flatnonzero(full)):
        digests[i] = np.frombuffer(hashlib.blake2b(shingles[first[row]:first[row + 1]].tobytes(), digest_size=16).digest(), np.int64)

    def lists(values: np.ndarray) -> pa.Array:
        ends = np.concatenate(([0], np.cumsum(full * values.shape[1]))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.reshape(-1).view(np.int64)))

    return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), lists(digests), lists(bands), lists(bits)],
                                      names=["n", "set", "bands", "bits"])


def similarity(a: str, b: str) -> Column:
    """The estimate from two packed signatures, corrected for slots that agree by chance."""
    differ = F.lit(0)
    for k in range(SLOTS // 32):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        differ = differ + F.bit_count((x.bitwiseOR(F.shiftrightunsigned(x, 1))).bitwiseAND(F.lit(0x5555555555555555)))
    return ((1 - differ / SLOTS) - 0.25) / 0.75


def shared_shingles(a: pa.Array, b: pa.Array) -> pa.Array:
    """Sizes of both sets and of what they share, for pairs of texts."""
    sets_a, first_a = shingle_sets(a)
    sets_b, first_b = shingle_sets(b)
    common = [len(np.intersect1d(sets_a[i:j], sets_b[k:m], assume_unique=True))
              for i, j, k, m in zip(first_a, first_a[1:], first_b, first_b[1:])]
    return pa.StructArray.from_arrays([pa.array(np.diff(first_a), pa.int64()), pa.array(np.diff(first_b), pa.int64()),
                                       pa.array(common, pa.int64())], names=["n_a", "n_b", "common"])


def likely(percent: int) -> Column:
    """Whether a pair of (n_a, bits_a) and (n_b, bits_b) may have that similarity."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (similarity("bits_a", "bits_b") >= LET_GO - (0.75 - percent / 100))


def shingle_lists(column: pa.Array) -> pa.Array:
    shingles, first = shingle_sets(column)
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(shingles.view(np.int64)))


def open_sets(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, full, c): the shingles of these texts, and how many occur in another one of them too."""
    found = docs.join(reps.hint("merge"), docs["doc_id"] == reps["rep"], "left_semi").groupBy("doc_id", "text").agg(F.lit(1))
    sets = stored(found.select(F.col("doc_id").alias("rep"), by_text(shingle_lists, "array<bigint>")("text").alias("full")), "open-sets")
    shingled = sets.select("rep", F.explode("full").alias("shingle"))
    repeated = shingled.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1")
    counted = shingled.join(repeated.hint("merge"), "shingle", "left_semi").groupBy("rep").agg(F.count("*").alias("c"))
    return sets.join(counted, "rep")


def side(rows: DataFrame, letter: str) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{c}_{letter}" if c in ("n", "c", "bits", "full", "component") else c) for c in rows.columns])


def confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Those of the (a, b) pairs whose full sets are similar enough.

    The texts of a pair are brought to it by sort-merge joins at every size: broadcasting
    would send documents through the driver.
    """
    wanted = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct()
    found = docs.join(wanted.hint("merge"), docs["doc_id"] == wanted["rep"], "left_semi")
    texts = stored(found.groupBy("doc_id", "text").agg(F.lit(1)).select("doc_id", "text"), "pair-texts")
    left, right = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    shared = by_text(shared_shingles, "struct<n_a:bigint,n_b:bigint,common:bigint>")("text_a", "text_b")
    checked = both.select("a", "b", shared.alias("s"))
    return checked.where(100 * F.col("s.common") >= percent * (F.col("s.n_a") + F.col("s.n_b") - F.col("s.common"))).select("a", "b").distinct()


def _linked(docs: DataFrame, percent: int, also: tuple[str, ...]) -> DataFrame:
    """``link`` for rows whose doc_ids do not repeat, but for rows with the same text."""
    named = docs.select("doc_id", "text")
    sketched = stored(docs.select("doc_id", *also, by_text(sketches, f"struct<{SKETCH}>")("text").alias("s")).select("doc_id", *also, "s.*"), "sketches")
    full = sketched.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stored(full.groupBy("n", "set").agg(F.min_by(F.struct("doc_id", "bands", "bits"), "doc_id").alias("r"))
                     .select("n", "set", F.col("r.doc_id").alias("rep"), "r.bands", "r.bits"), "classes")
    members = stored(classes.select(F.explode("bands").alias("key"), "rep"), "band-members")
    hubs = members.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("size")).where("size > 1")
    met = stored(members.join(hubs.select("key", "hub"), "key").where("rep != hub").select("key", "rep", "hub"), "bucket-members")
    star = met.select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    signatures = classes.select("rep", "n", "bits")
    hub_side, member_side = (side(signatures, x).withColumnRenamed("rep", x) for x in "ab")
    near = stored(star.join(hub_side, "a").join(member_side, "b").where(likely(percent)).select("a", "b"), "star-pairs")
    linked = stored(confirmed(near, named, percent), "links")
    labels = closed(linked)

    # Buckets whose members are still in several components.
    buckets = met.select("key", "rep").union(met.groupBy("key").agg(F.min("hub").alias("rep")))
    placed = buckets.join(labels, buckets["rep"] == labels["node"], "left").select("key", "rep", F.coalesce("label", "rep").alias("component"))
    placed = stored(placed, "bucket-components")
    spread = placed.groupBy("key", "component").agg(F.count("*").alias("size"))
    main = (spread.groupBy("key").agg(F.max_by("component", F.struct("size", "component")).alias("main"), F.count("*").alias("parts"))
            .where("parts > 1").select("key", "main"))
    open_members = stored(placed.join(main, "key"), "open-members")
    sets = open_sets(open_members.select("rep").distinct(), named)
    enough = sets.join(signatures, "rep").where(100 * F.col("c") >= percent * F.col("n"))
    open_members = stored(open_members.join(enough, "rep"), "linkable-members")
    outside = side(open_members.where("component != main").withColumnRenamed("rep", "a").drop("main"), "a")
    others = side(open_members.withColumnRenamed("rep", "b").drop("main"), "b")
    needed = percent * (F.size("full_a") + F.size("full_b"))
    possible = (100 + percent) * F.least("c_a", "c_b") >= needed
    exact = (100 + percent) * F.size(F.array_intersect("full_a", "full_b")) >= needed
    across = outside.join(others, "key").where((F.col("component_a") != F.col("component_b")) & possible & likely(percent) & exact)
    labels = closed(linked.union(across.select("a", "b").distinct()))
    resolved = classes.join(labels, classes["rep"] == labels["node"], "left").select("n", "set", F.coalesce("label", "rep").alias("component_id"))
    out = sketched.join(resolved, ["n", "set"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"),
                      F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"), *also)


def link(docs: DataFrame, percent: int = 75, also: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) and the columns ``also`` for each row of (doc_id, text).

    Texts are linked when their sets of shingles have a similarity of ``percent`` / 100 or
    more; component_id is the smallest doc_id reachable by links. A text with fewer words
    than a shingle is one shingle; an empty or null one has none and is linked with nothing.
    A row without doc_id cannot name a group: it is linked with nothing, has a null
    component_id and is kept. Rows that repeat a doc_id each stand for themselves: each is
    linked by its own text.
    """
    if not repeated_ids(docs):
        return _linked(docs, percent, also)
    rows, row = _numbered(docs.select("doc_id", "text", *also))
    own = fresh(rows, "own")
    found = _by_row(rows, row, own, percent, also)
    least = found.groupBy("component_id").agg(F.min(own).alias("least"))
    out = found.join(least.where("component_id is not null"), "component_id", "left")
    return out.select(F.col(own).alias("doc_id"), "n_shingles", F.col("least").alias("component_id"),
                      F.coalesce(F.col(own) == F.col("least"), F.lit(True)).alias("kept"), *also)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows, written, with a column of different numbers, and its name."""
    row = fresh(docs, "row")
    return stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered"), row


def _by_row(rows: DataFrame, row: str, own: str, percent: int, also: tuple[str, ...] = ()) -> DataFrame:
    """Numbered rows linked by their numbers; the column ``own`` holds their doc_ids."""
    number = F.when(F.col("doc_id").isNotNull(), F.col(row)).alias("doc_id")
    return _linked(rows.select(number, "text", F.col("doc_id").alias(own), *also), percent, (own, *also))


def representatives(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of ``docs`` that are kept: one document of each group, the smallest doc_id.

    Rows that repeat a doc_id each stand for themselves; of the rows of a group with the smallest
    doc_id one stays. Rows without a doc_id stay.
    """
    if not repeated_ids(docs):
        gone = stored(_linked(docs, percent, ()).where(~F.col("kept")).select("doc_id").distinct(), "near-copies")
        return docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
    rows, row = _numbered(docs)
    found = _by_row(rows, row, "own", percent).where("doc_id is not null")
    stays = found.groupBy("component_id").agg(F.min_by("doc_id", F.struct("own", "doc_id")).alias(row)).select(row)
    left = rows.where("doc_id is not null").join(stored(stays, "staying-rows"), row, "left_semi").unionByName(rows.where("doc_id is null"))
    return left.select(*[f"`{c}`" for c in docs.columns])


def repeated_ids(docs: DataFrame) -> bool:
    """Whether a doc_id occurs more than once."""
    return not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
       FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
 c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
 p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
 e AS (SELECT a, b FROM p JOIN c ca ON a = ca.doc_id JOIN c cb ON b = cb.doc_id WHERE 100 * common >= 75 * (ca.n + cb.n - common)),
 walk AS (SELECT doc_id AS a, doc_id AS b FROM c UNION SELECT walk.a, e.b FROM walk JOIN e ON walk.b = e.a),
 least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM walk GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
  d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""
