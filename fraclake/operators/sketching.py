"""FracMinHash sketches of sequences and texts.

Every function returns a bag of (keys..., ksize, hash); callers add ``distinct``
on the columns they need, so that a global union pays for one shuffle, not two.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from fraclake.functions.hashing import (MD5_KEYS, md5_64, md5_64_canonical, md5_64_slices, md5_hex16, murmur64, murmur64_fixed,
                                        padded_words)
from fraclake.functions.unsigned import bits_from_hex, unsigned_at_most

#: Token separator of text sketches, the same in every engine.
WORD_BREAK = r"[ \n\t\r]+"

#: Fixed sketch parameters.
KSIZES = (15, 31, 33)
SCALED = 1000
GENERATED_FOLDERS = ("AAA", "AAB", "AAC")
DRAWS_BASE = 200
DRAWS_SPREAD = 50

_CHUNK = 1 << 16
_BLOCK = 1 << 17

#: Bytes of texts whose words are hashed at a time, and the bytes of WORD_BREAK.
_TEXT_BYTES = 1 << 18
_BLANKS = np.frombuffer(b" \n\t\r", dtype=np.uint8)


def max_hash_for(scaled: int) -> int:
    """Largest hash kept by a sketch that keeps one in ``scaled``."""
    return min(int(2**64 / scaled), 2**64 - 1)


def _keep_hashed(df: DataFrame, value: Column, scaled: int, hash_fn: str) -> DataFrame:
    """Replace the candidates by the hashes under the threshold.

    For md5 the threshold is applied to the fixed-width hex text, so the slower
    conversion to a number only runs for the few survivors.
    """
    bound = max_hash_for(scaled)
    if hash_fn == "md5_64":
        kept = df.withColumn("_hex", md5_hex16(value)).where(F.col("_hex") <= f"{bound:016x}")
        return kept.withColumn("hash", bits_from_hex("_hex"))
    if hash_fn == "xxhash64":
        return df.withColumn("hash", F.xxhash64(value)).where(unsigned_at_most("hash", bound))
    if hash_fn == "murmur64":
        return (df.withColumn("hash", murmur64(value.cast("string")))
                .where(unsigned_at_most("hash", bound)))
    raise ValueError(f"unknown hash function {hash_fn}")


def word_hashes(docs: DataFrame, keys: Sequence[str], text: str, ksizes: Sequence[int],
                scaled: int, hash_fn: str = "md5_64") -> DataFrame:
    """Sketch texts by runs of ``ksize`` words; all stages stay in generated code."""
    split = docs.select(*keys, F.split(F.col(text), WORD_BREAK).alias("_words"))
    sized = split.select(*keys, "_words", F.explode(F.array(*[F.lit(k) for k in ksizes])).alias("ksize"))
    placed = sized.where(F.size("_words") >= F.col("ksize")).select(
        *keys, "ksize", "_words",
        F.explode(F.sequence(F.lit(1), F.size("_words") - F.col("ksize") + 1)).alias("_at"))
    shingle = F.array_join(F.slice("_words", F.col("_at"), F.col("ksize")), " ")
    return _keep_hashed(placed, shingle, scaled, hash_fn).select(*keys, "ksize", "hash")


def word_sketch_arrays(docs: DataFrame, keys: Sequence[str], text: str, ksizes: Sequence[int],
                       scaled: int) -> DataFrame:
    """(keys..., h<k>...): the same sketches as one array per text, for packing.

    Runs are hashed with array arithmetic, the texts of about _TEXT_BYTES at a time or one longer
    text; lambdas over arrays are not compiled and took several times as long.
    """
    bound, wanted, names = np.uint64(max_hash_for(scaled)), list(ksizes), list(keys)
    schema = T.StructType([docs.schema[k] for k in names]
                          + [T.StructField(f"h{k}", T.ArrayType(T.LongType())) for k in wanted])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").cast(pa.large_binary())
            ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
            lo = 0
            while lo < len(batch):
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + _TEXT_BYTES, side="right")) - 1)
                found = word_run_hashes(texts.slice(lo, hi - lo), wanted, bound)
                columns = [batch.column(n).slice(lo, hi - lo) for n in names]
                columns += [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(hashes.view(np.int64))) for cuts, hashes in found]
                yield pa.RecordBatch.from_arrays(columns, names=names + [f"h{k}" for k in wanted])
                lo = hi

    return docs.select(*keys, F.col(text).alias("_text")).mapInArrow(sketch, schema)


def word_run_hashes(texts: pa.Array, ksizes: Sequence[int], bound: np.uint64) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each k the hashes of all runs of words up to a bound, and where those of each text begin.

    Separators are made single blanks first; then a run of words is one slice of its text.
    """
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[ends[0]:ends[-1]]
    ends = ends - ends[0]
    filled = np.diff(ends) > 0
    blank = np.isin(raw, _BLANKS)
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    kept[ends[:-1][filled]] = True  # a text begins anew
    places = np.concatenate([[0], np.cumsum(kept)])[ends]
    data = np.where(blank, np.uint8(32), raw)[kept]
    # a word ends at a blank or with its text, and the next one begins behind; NULL has no words
    breaks = np.flatnonzero(blank[kept])
    inside = np.concatenate([[0], np.cumsum(blank[kept])])[places]
    known = texts.is_valid().to_numpy(zero_copy_only=False)
    counts = np.where(known, np.diff(inside) + 1, 0)
    first = np.concatenate([[0], np.cumsum(counts)])
    starts, stops = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    starts[first[:-1][known]], stops[first[1:][known] - 1] = places[:-1][known], places[1:][known]
    later, earlier = np.ones(len(starts), bool), np.ones(len(starts), bool)
    later[first[:-1][known]], earlier[first[1:][known] - 1] = False, False
    starts[later], stops[earlier] = breaks + 1, breaks
    out = []
    for k in ksizes:
        runs = np.clip(counts - k + 1, 0, None)
        begun = np.concatenate([[0], np.cumsum(runs)])
        at = np.arange(begun[-1]) + np.repeat(first[:-1] - begun[:-1], runs)
        hashes = md5_64_slices(data, starts[at], stops[at + k - 1] - starts[at])
        small = hashes <= bound
        out.append((np.concatenate([[0], np.cumsum(small)])[begun], hashes[small]))
    return out


def sequence_chunks(records: DataFrame, keys: Sequence[str], seq: str, ksizes: Sequence[int],
                    chunk: int = _CHUNK) -> DataFrame:
    """Cut sequences into (keys..., piece BINARY) that together hold every k-mer.

    Runs of valid bases are separated first, so k-mers never cross an unknown base
    or a record border. Long runs are cut every ``chunk`` bases with an overlap of
    the largest k less one; a chromosome therefore becomes many rows. Pieces are
    binary because slicing them does not depend on the position.
    """
    smallest, largest = min(ksizes), max(ksizes)
    runs = records.select(*keys, F.explode(F.split(F.upper(F.col(seq)), "[^ACGT]+")).alias("_run"))
    runs = runs.where(F.length("_run") >= smallest).withColumn("_run", F.col("_run").cast("binary"))
    last = F.length("_run") - smallest
    starts = F.sequence(F.lit(0), last, F.lit(chunk))
    return (runs.select(*keys, "_run", F.explode(starts).alias("_from"))
            .select(*keys, F.substring("_run", F.col("_from") + 1, F.lit(chunk + largest - 1)).alias("piece")))


def kmer_hashes(records: DataFrame, keys: Sequence[str], seq: str, ksizes: Sequence[int] = KSIZES,
                scaled: int = SCALED, hash_fn: str = "murmur64", spread: bool = False,
                chunk: int = _CHUNK) -> DataFrame:
    """Sketch DNA by canonical k-mers (the smaller of k-mer and reverse complement).

    ``spread`` redistributes the pieces before hashing: one gzip file is one task
    when read, and may hold a large share of all bases.
    """
    pieces = sequence_chunks(records, keys, seq, ksizes, chunk)
    if spread:
        pieces = pieces.hint("rebalance")
    if hash_fn in _KMER_HASHES:
        return _array_kmers(pieces, keys, ksizes, scaled, chunk, hash_fn)
    reverse = F.reverse(F.translate(F.col("piece").cast("string"), "ACGT", "TGCA")).cast("binary")
    both = pieces.withColumn("_reverse", reverse)
    sized = both.select("*", F.explode(F.array(*[F.lit(k) for k in ksizes])).alias("ksize"))
    windows = F.least(F.lit(chunk), F.length("piece") - F.col("ksize") + 1)
    placed = sized.where(F.length("piece") >= F.col("ksize")).select(
        "*", F.explode(F.sequence(F.lit(1), windows)).alias("_at"))
    forward = F.substring("piece", F.col("_at"), F.col("ksize"))
    backward = F.substring("_reverse", F.length("piece") - F.col("_at") - F.col("ksize") + 2, F.col("ksize"))
    return _keep_hashed(placed, F.least(forward, backward), scaled, hash_fn).select(*keys, "ksize", "hash")


def _array_kmers(pieces: DataFrame, keys: Sequence[str], ksizes: Sequence[int], scaled: int,
                 chunk: int, hash_fn: str) -> DataFrame:
    bound = np.uint64(max_hash_for(scaled))
    schema = T.StructType([pieces.schema[k] for k in keys]
                          + [T.StructField("ksize", T.IntegerType()), T.StructField("hash", T.LongType())])
    names, wanted = list(keys), list(ksizes)

    def hash_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in wanted:
                for rows, hashes in _KMER_HASHES[hash_fn](batch.column("piece"), k, chunk):
                    kept = hashes <= bound
                    owners = pa.array(rows[kept])
                    columns = [batch.column(n).take(owners) for n in names]
                    columns.append(pa.array(np.full(len(owners), k, dtype=np.int32)))
                    columns.append(pa.array(hashes[kept].view(np.int64)))
                    yield pa.RecordBatch.from_arrays(columns, names=names + ["ksize", "hash"])

    return pieces.mapInArrow(hash_batches, schema)


def _complement_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.uint8)
    for base, other in zip(b"ACGT", b"TGCA"):
        table[base] = other
    return table


def canonical_hashes(pieces: pa.Array, k: int, chunk: int = _CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Yield (row of the piece, murmur hash of the canonical k-mer) for all k-mers.

    All pieces of a batch are treated as one buffer, so short pieces cost no more
    per k-mer than long ones; blocks bound the working memory.
    """
    data, ends, counts = _laid_out(pieces, k, chunk)
    before = np.concatenate([[0], np.cumsum(counts)])
    complement = _complement_table()
    for lo in range(0, int(before[-1]), _BLOCK):
        nth = np.arange(lo, min(lo + _BLOCK, int(before[-1])))
        rows = np.searchsorted(before, nth, side="right") - 1
        starts = ends[rows] + nth - before[rows]
        forward = data[starts[:, None] + np.arange(k)]
        backward = complement[forward[:, ::-1]]
        words, other = padded_words(forward), padded_words(backward)
        flip = _comes_first(other, words)
        yield rows, murmur64_fixed(np.where(flip[:, None], other, words), k)


def canonical_md5(pieces: pa.Array, k: int, chunk: int = _CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same with the top 64 bits of the md5. Pieces that lie one after another are hashed as one
    run of bases; k-mers that begin in one and end in the next are dropped."""
    complement = _complement_table()
    data, ends, counts = _laid_out(pieces, k, chunk)
    row = 0
    while row < len(counts):
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + MD5_KEYS, side="right")) - 1)
        nth = np.concatenate([np.arange(counts[row])] if stop == row + 1 else [np.arange(c) for c in counts[row:stop]])
        rows, starts = np.repeat(np.arange(row, stop), counts[row:stop]), nth + np.repeat(ends[row:stop] - ends[row], counts[row:stop])
        for lo in range(0, int(ends[stop] - ends[row]), MD5_KEYS):  # one piece may be longer
            first, last = np.searchsorted(starts, (lo, lo + MD5_KEYS))
            if first < last:
                part = data[ends[row] + starts[first]:ends[row] + starts[last - 1] + k]
                hashes = md5_64_canonical(part, complement[part[::-1]], k)
                yield rows[first:last], hashes[starts[first:last] - starts[first]]
        row = stop


def _laid_out(pieces: pa.Array, k: int, chunk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of the pieces, where each begins and the last ends, and how many k-mers each has."""
    pieces = pieces.cast(pa.large_binary())
    ends = np.frombuffer(pieces.buffers()[1], dtype=np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
    data = np.frombuffer(pieces.buffers()[2] or b"", dtype=np.uint8)
    return data, ends, np.clip(np.minimum(np.diff(ends) - k + 1, chunk), 0, None)


_KMER_HASHES = {"murmur64": canonical_hashes, "md5_64": canonical_md5}


def _comes_first(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise a < b as byte strings: compare the first differing word, high byte first."""
    a, b = a.view(">u8"), b.view(">u8")
    at = np.argmax(a != b, axis=1)[:, None]
    return (np.take_along_axis(a, at, 1) < np.take_along_axis(b, at, 1))[:, 0]


def generated_sketches(archives: DataFrame, number: str, members: int = 2, ksizes: Sequence[int] = KSIZES,
                       scaled: int = SCALED) -> DataFrame:
    """Synthetic sketches for each archive number: (number, folder, member, ksize, hash).

    Values are spread evenly below the threshold of ``scaled`` and are a function of
    (archive, member, k, draw), so a task that runs again draws the same values.
    Repeated values within a sketch are removed in its row, so nothing is shuffled.
    """
    i = F.col(number)
    folders = F.array(*[F.lit(f) for f in GENERATED_FOLDERS])
    cells = (archives.select(i.alias("archive"))
             .select("archive", F.explode(F.sequence(F.lit(0), F.lit(members - 1))).alias("member"))
             .select("*", F.explode(F.array(*[F.lit(k) for k in ksizes])).alias("ksize")))
    draws = F.lit(DRAWS_BASE) + F.pmod(F.col("archive") + F.col("member") + F.col("ksize"),
                                       F.lit(DRAWS_SPREAD)).cast("int")
    value = F.transform(F.sequence(F.lit(1), draws), lambda draw: F.shiftrightunsigned(
        md5_64(F.concat_ws("/", "archive", "member", "ksize", draw)), 1) % F.lit(max_hash_for(scaled)))
    folder = F.element_at(folders, (F.pmod(F.col("archive"), F.lit(len(GENERATED_FOLDERS))) + 1).cast("int"))
    return cells.select("archive", folder.alias("folder"), "member", "ksize",
                        F.explode_outer(F.array_distinct(value)).alias("hash"))
