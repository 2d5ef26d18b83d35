"""Quality by importance resampling on hashed n-grams.

Words and pairs of neighbouring words fall into ``BUCKETS`` buckets by hash. Two generative
models are the smoothed bucket frequencies of the target, which is the documents labelled
good, and of all documents. A document's log importance weight is the sum over its n-grams of
log(target frequency / raw frequency); the k documents with the largest weight plus Gumbel
noise are a sample without replacement in proportion to the weights. k follows from the
labels: the share of good ones among labelled documents, plus ``margin``.

Counting keeps one vector of buckets per task; what reaches the driver has a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.frames import by_text, fresh, small_side, stored
from fraclake.llm.top_k import kth_largest
from fraclake.llm.words import NOT_BLANK, in_slices, windows, words

BUCKETS, MARGIN, SEED = 1 << 14, 0.02, 20240229


def buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of a batch, row by row, and the first of each row."""
    found = words(column, NOT_BLANK)
    sizes = np.diff(found.row)
    first = np.concatenate(([0], np.cumsum(2 * sizes - (sizes > 0))))
    # a row's n-grams are its words, each followed by the pair it begins but for the last
    out = np.empty(int(first[-1]), np.int32)
    at = 2 * np.arange(len(found.hash)) - np.repeat(np.cumsum(sizes > 0) - (sizes > 0), sizes)
    shift = np.uint64(64 - BUCKETS.bit_length() + 1)
    out[at] = found.hash >> shift
    pair = windows(found.hash, 2) >> shift
    last = np.zeros(len(found.hash), bool)
    last[found.row[1:][sizes > 0] - 1] = True
    begins = np.flatnonzero(~last)
    out[at[begins] + 1] = pair[begins]
    return out, first


def good_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, good) from the quality labels; a document with conflicting labels is not good."""
    return labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg((F.min("quality") == 1).alias("good"))


def ratios(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, float]:
    """log(target / raw) of each bucket, and the share of good documents among labelled ones.

    Without good labels nothing is known: all ratios are 0 and the share is 1.
    """
    judged = stored(good_labels(labels), "good-labels")
    marked = docs.select("doc_id", "text").join(small_side(judged), "doc_id", "left").select("text", F.coalesce("good", F.lit(False)).alias("good"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in in_slices(batch, "text"):
                found, first = buckets(part.column("text"))
                good = np.repeat(part.column("good").to_numpy(zero_copy_only=False), np.diff(first))
                raw += np.bincount(found, minlength=BUCKETS)
                target += np.bincount(found[good], minlength=BUCKETS)
        seen = np.flatnonzero(raw)
        yield pa.record_batch({"bucket": pa.array(seen, pa.int32()), "raw": pa.array(raw[seen]), "target": pa.array(target[seen])})

    counts = marked.mapInArrow(count, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in counts.collect():
        raw[row.bucket], target[row.bucket] = row.raw, row.target
    share = judged.agg(F.avg(F.col("good").cast("int"))).first()[0]
    if not target.sum() or share is None:
        return np.zeros(BUCKETS), 1.0
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS)), share


def weight(ratio: np.ndarray) -> Column:
    """The log importance weight of each text; 0 if it has no words."""

    def score(column: pa.Array) -> pa.Array:
        found, first = buckets(column)
        total = np.concatenate(([0.0], np.cumsum(ratio[found])))
        return pa.array(np.round(total[first[1:]] - total[first[:-1]], 6))

    return by_text(score, "double")("text")


def gumbel(seed: int = SEED) -> Column:
    """Gumbel noise that depends on doc_id only, so that a recomputed row draws it again."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("doc_id")), 12) + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def sampled(docs: DataFrame, labels: DataFrame, margin: float = MARGIN, seed: int = SEED) -> tuple[DataFrame, str]:
    """``docs`` with a struct column (log_weight, key, kept), and that column's name.

    Exactly k rows are kept: those with the largest keys; at the last key those with the
    smallest doc_id, null last, and rows equal in both together. Texts without words have
    weight 0. Other columns pass through.
    """
    name, raw = fresh(docs, "importance"), fresh(docs, "log_weight_of_text")
    ratio, share = ratios(docs, labels)
    scored = docs.withColumn(raw, weight(ratio))
    key = F.col(raw) + gumbel(seed)
    keys = stored(scored.select("doc_id", key.alias("key")), "importance-keys")
    total = keys.count()
    k = min(total, round(total * min(1.0, share + margin)))
    least = kth_largest(keys, "key", k)
    if least is None:
        kept = F.lit(False)
    else:
        ties = keys.where(F.col("key") == least)
        rest = k - keys.where(F.col("key") > least).count()
        tied = ties.select((-F.col("doc_id")).alias("id"))
        last = kth_largest(tied, "id", rest)
        kept = (key > least) | ((key == least) & (F.lit(True) if last is None else F.coalesce(F.col("doc_id") <= -last, F.lit(False))))
    return scored.withColumn(name, F.struct(F.col(raw).alias("log_weight"), key.alias("key"), kept.alias("kept"))).drop(raw), name


def kept_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The sampled rows of ``docs`` with their own columns."""
    found, name = sampled(docs, labels)
    return found.where(f"`{name}`.kept").select(*[f"`{c}`" for c in docs.columns])


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, log_weight, key, kept) for each row of ``docs``."""
    found, name = sampled(docs.select("doc_id", "text"), labels.select("doc_id", "quality"))
    return found.select("doc_id", f"{name}.log_weight", f"{name}.key", f"{name}.kept")
