"""Set algebra on (ksize, hash): union, difference, overlap, ordered cap."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame, functions as F

from fraclake.functions.mixing import low_bits
from fraclake.functions.unsigned import unsigned_key
from fraclake.shared import stored

KEY = ("ksize", "hash")


def keep_ksizes(hashes: DataFrame, ksizes: Collection[int]) -> DataFrame:
    """Filter on k; a bare column, so stored partitions are pruned."""
    return hashes.where(F.col("ksize").isin(*ksizes))


def union_of(*bags: DataFrame) -> DataFrame:
    """Bag union by column name."""
    first, *rest = bags
    for bag in rest:
        first = first.unionByName(bag)
    return first


def unique_hashes(bag: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Distinct hashes. Repeats are dropped before the shuffle, so a hash that makes up
    a large share of the rows costs one row per task."""
    return bag.select(*key).distinct()


def difference(a: DataFrame, b: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``. A NULL hash is never in ``b``.

    Both sides are distinct on the key, so no key is heavy in the join. Spark
    broadcasts ``b`` only when its measured size allows it.
    """
    return a.join(b.select(*key), list(key), "left_anti")


def intersection(a: DataFrame, b: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """Rows of ``a`` whose key is also in ``b``."""
    return a.join(b.select(*key), list(key), "left_semi")


def membership(a: DataFrame, b: DataFrame, key: Sequence[str] = KEY) -> DataFrame:
    """(key..., in_a, in_b): where each distinct hash of either bag occurs.

    Serves every count of a comparison from a single shuffle, and takes bags as they
    are: repeats collapse in the partial aggregation. NULL hashes match nothing, so
    they are kept apart by side.
    """
    tagged = (a.select(*key, F.lit(1).alias("_side"))
              .unionByName(b.select(*key, F.lit(2).alias("_side"))))
    null_side = F.when(F.col("hash").isNull(), F.col("_side"))
    sides = tagged.groupBy(*key, null_side.alias("_null_side")).agg(F.bit_or("_side").alias("_sides"))
    return sides.select(*key, (F.col("_sides").bitwiseAND(1) != 0).alias("in_a"),
                        (F.col("_sides").bitwiseAND(2) != 0).alias("in_b"))


def _only(inside: str, outside: str):
    return F.col(inside) & ~F.col(outside)


def difference_counts(members: DataFrame, *by: str) -> DataFrame:
    """a_not_b and b_not_a per group of ``by``, or in total; 0 when there are none."""
    return members.groupBy(*by).agg(F.count_if(_only("in_a", "in_b")).alias("a_not_b"),
                                    F.count_if(_only("in_b", "in_a")).alias("b_not_a"))


def difference_counts_by_bucket(members: DataFrame, bits: int) -> DataFrame:
    """The same per bucket of the hash. The bucket follows from the hash, so it is
    computed after the shuffle instead of being part of its key."""
    return difference_counts(members.withColumn("bucket", low_bits("hash", bits)), "bucket")


def difference_rollup(members: DataFrame) -> DataFrame:
    """rhs-not-in-lhs (b not a) per k and in total; the total has a NULL k.

    Only k-sizes present in b are reported.
    """
    per_k = members.where("in_b").groupBy("ksize").agg(F.count_if(_only("in_b", "in_a")).alias("n"))
    return per_k.rollup("ksize").agg(F.sum("n").alias("rhs_not_in_lhs"))


def comparison(members: DataFrame, *by: str) -> DataFrame:
    """Sizes of both sets, overlap, both differences and Jaccard (0 for an empty union)."""
    both = F.col("in_a") & F.col("in_b")
    counts = members.groupBy(*by).agg(
        F.count_if("in_a").alias("a_total"), F.count_if("in_b").alias("b_total"),
        F.count_if(both).alias("intersection"),
        F.count_if(_only("in_a", "in_b")).alias("a_only"), F.count_if(_only("in_b", "in_a")).alias("b_only"))
    either = F.col("a_total") + F.col("b_total") - F.col("intersection")
    return counts.withColumn("jaccard_similarity", F.when(either > 0, F.col("intersection") / either).otherwise(0.0))


def sorted_hashes(hashes: DataFrame) -> DataFrame:
    """Ascending unsigned order within k."""
    return hashes.orderBy("ksize", unsigned_key("hash"))


def first_rows_distinct(bag: DataFrame, rows: int) -> DataFrame:
    """Distinct hashes among the first ``rows`` rows of a bag in unsigned hash order.

    The cap of a trial run can be billions of rows, too many to pass through one
    sorted partition. Instead each distinct hash gets its number of rows, and the hashes
    between two bounds, at first the smallest and the largest there are, are counted in at
    most 2^12 equal ranges; a running total tells in which range the cap lies, and its
    bounds are the next ones, until it holds a single hash or few. So everything that is
    windowed or collected has a fixed size, whatever the hashes. NULL hashes come first.

    The counted hashes are written once, as every step reads them.
    """
    counted = stored(bag.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")), "counted")
    keyed = counted.withColumn("_key", unsigned_key("hash"))
    last = _last_key(keyed, rows)
    if last is None:
        return counted.select("hash")
    return keyed.where((F.col("_key") <= last) | (F.col("hash").isNull() & F.lit(rows > 0))).select("hash")


#: Ranges of one step, and hashes that may be looked at one by one.
_RANGES, _FEW = 1 << 12, 1 << 14


def _last_key(keyed: DataFrame, rows: int) -> int | None:
    """The order key of the last hash inside the cap; None if all are, below every key if none is."""
    low, high, total, nulls = keyed.agg(F.min("_key"), F.max("_key"), F.sum("_n"), F.sum(F.when(F.col("hash").isNull(), F.col("_n")))).first()
    if total is None or total <= rows:
        return None
    left = rows - (nulls or 0)
    if left <= 0 or low is None:
        return -(1 << 63)
    while True:
        width = max(1, -(-(high - low + 1) // _RANGES))
        inside = keyed.where(F.col("_key").between(low, high))
        # the distance can pass the largest BIGINT, so it is taken as a decimal
        part = F.expr(f"cast((cast(_key as decimal(20,0)) - cast({low} as decimal(20,0))) div cast({width} as decimal(20,0)) as int)")
        counts = sorted((r["part"], r["n"], r["hashes"]) for r in inside.groupBy(part.alias("part")).agg(
            F.sum("_n").alias("n"), F.count(F.lit(1)).alias("hashes")).collect())
        for at, n, hashes in counts:
            if n >= left:
                break
            left -= n
        low, high = low + at * width, min(high, low + (at + 1) * width - 1)
        if low == high or hashes == 1:
            return high
        if hashes <= _FEW:
            for key, n in keyed.where(F.col("_key").between(low, high)).select("_key", "_n").orderBy("_key").collect():
                if n >= left:
                    return key
                left -= n
