"""Bloom filters of hash sets as tables: one row for each block of 512 bits.

A hash belongs to one block and sets one bit in each of the block's eight words, so a test
is an equality join on the block and looks at a single row. Blocks without hashes have no row.
A filter of 2^b blocks should hold at most 32 hashes a block; it then lets about one in a
thousand of other hashes pass, and takes a quarter of the room of the hashes themselves. It
never misses a hash that it holds. NULL is one value like any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from fraclake.operators.hash_sets import KEY

WORDS, PER_BLOCK = 8, 32
BLOCKS = ", ".join(["block bigint", *(f"w{i} bigint" for i in range(WORDS))])


def block_bits(rows: int, least: int = 1) -> int:
    """b, so that 2^b blocks are enough for so many hashes."""
    return max(1, least, (max(1, -(-rows // PER_BLOCK)) - 1).bit_length())


def place(key: Sequence[str] = KEY) -> Column:
    """64 bits of which the leading ones name the block, or any coarser part."""
    return F.xxhash64(*key)


def leading(column: Column | str, bits: int) -> Column:
    return F.shiftrightunsigned(column, 64 - bits)


def _bit(word: int) -> Column:
    """The bit of ``_inside`` in a word: six bits of it say which."""
    return F.expr(f"shiftleft(1L, cast(shiftrightunsigned(_inside, {6 * word}) & 63L as int))")


def _inside(key: Sequence[str]) -> Column:
    return F.xxhash64(*key, F.lit(1))


def filter_blocks(hashes: DataFrame, bits: int, key: Sequence[str] = KEY) -> DataFrame:
    """The rows of a filter of 2^``bits`` blocks. Bits are combined before the shuffle."""
    rows = hashes.select(leading(place(key), bits).alias("block"), _inside(key).alias("_inside"))
    return rows.groupBy("block").agg(*[F.bit_or(_bit(i)).alias(f"w{i}") for i in range(WORDS)])


def suspected(hashes: DataFrame, filters: Sequence[tuple[int, DataFrame]], key: Sequence[str] = KEY) -> DataFrame:
    """(key..., place, maybe) of each distinct hash: ``maybe`` is false where none of the (bits, blocks) filters holds it.

    Filters of any sizes are tested in one join. Blocks follow from a hash of the key, so no
    block is heavy.
    """
    rows = hashes.select(*key).distinct().withColumn("place", place(key))
    if not filters:
        return rows.withColumn("maybe", F.lit(False))
    blocks = reduce(DataFrame.unionByName, [b.withColumn("of", F.lit(bits)) for bits, b in filters])
    sizes = F.array(*[F.lit(bits) for bits in sorted({bits for bits, _ in filters})])
    asked = (rows.withColumn("_inside", _inside(key)).withColumn("of", F.explode(sizes))
             .withColumn("block", F.expr("shiftrightunsigned(place, 64 - of)")))
    hit = reduce(and_, [F.col(f"w{i}").bitwiseAND(_bit(i)) != 0 for i in range(WORDS)])
    answers = asked.join(blocks, ["of", "block"], "left").withColumn("hit", hit)
    return answers.groupBy(*key, "place").agg(F.coalesce(F.bool_or("hit"), F.lit(False)).alias("maybe"))
