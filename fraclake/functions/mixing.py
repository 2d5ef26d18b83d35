"""SplitMix64 and the partition ids derived from a hash.

BIGINT addition and multiplication raise on overflow under ANSI, so arithmetic
modulo 2^64 is put together from pieces that cannot overflow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed values of the SplitMix64 mixer.
GOLDEN_GAMMA = 0x9E3779B97F4A7C15
MULTIPLIER_1 = 0xBF58476D1CE4E5B9
MULTIPLIER_2 = 0x94D049BB133111EB
SHIFT_1 = 30
SHIFT_2 = 27
SHIFT_3 = 31

MODES = ("mix", "low", "high")

_LOW32 = (1 << 32) - 1
_LIMB = 22


def _sum_mod_2_64(terms: list[Column]) -> Column:
    """Add 64-bit patterns, letting carries out of the top fall off."""
    low = terms[0].bitwiseAND(F.lit(_LOW32))
    high = F.shiftrightunsigned(terms[0], 32)
    for t in terms[1:]:
        low = low + t.bitwiseAND(F.lit(_LOW32))
        high = high + F.shiftrightunsigned(t, 32)
    high = high + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(F.lit(_LOW32)))


def _product_terms(z: str, factor: int) -> list[Column]:
    """Partial products of a pattern and a constant: 32-bit halves times 22-bit limbs."""
    low, high = F.col(z).bitwiseAND(F.lit(_LOW32)), F.shiftrightunsigned(F.col(z), 32)
    limbs = [(factor >> (_LIMB * i)) & ((1 << _LIMB) - 1) for i in range(3)]
    terms = [F.shiftleft(low * F.lit(limb), _LIMB * i) for i, limb in enumerate(limbs)]
    terms += [F.shiftleft(high * F.lit(limb), 32 + _LIMB * i) for i, limb in enumerate(limbs[:2])]
    return terms


def _fold(z: str, by: int) -> Column:
    return F.col(z).bitwiseXOR(F.shiftrightunsigned(F.col(z), by))


def with_splitmix64(df: DataFrame, source: str, target: str) -> DataFrame:
    """Add ``target`` = SplitMix64(``source``).

    One step per ``withColumn``: each step reads its input several times, and as a
    single nested expression the tree would grow exponentially.
    """
    z = "_mix"
    gamma = F.lit(GOLDEN_GAMMA - (1 << 64))
    df = df.withColumn(z, _sum_mod_2_64([F.col(source), gamma]))
    for by, factor in ((SHIFT_1, MULTIPLIER_1), (SHIFT_2, MULTIPLIER_2)):
        df = df.withColumn(z, _fold(z, by))
        df = df.withColumn("_terms", F.array(*_product_terms(z, factor)))
        df = df.withColumn(z, _sum_mod_2_64([F.col("_terms")[i] for i in range(5)])).drop("_terms")
    return df.withColumn(target, _fold(z, SHIFT_3)).drop(z)


def low_bits(hash_col: Column | str, bits: int) -> Column:
    """The low ``bits`` bits, also used as the bucket of a hash."""
    h = F.col(hash_col) if isinstance(hash_col, str) else hash_col
    return h.bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def high_bits(hash_col: Column | str, bits: int) -> Column:
    h = F.col(hash_col) if isinstance(hash_col, str) else hash_col
    return F.shiftrightunsigned(h, 64 - bits).cast("int")


def check_partitioning(bits: int, mode: str) -> None:
    if bits <= 0:
        raise ValueError("partition bits must be > 0")
    if mode not in MODES:
        raise ValueError(f"partition mode must be one of {', '.join(MODES)}")


def with_partition_id(df: DataFrame, bits: int, mode: str = "mix",
                      source: str = "hash", target: str = "part_id") -> DataFrame:
    """Add the partition of a hash in [0, 2^bits).

    ``mix`` takes the top bits after mixing; ``low`` and ``high`` take raw bits.
    Scaled sketches only hold small hashes, so ``high`` puts nearly all of them in
    partition 0: writers must (and ours do) cope with one dominant partition.
    """
    check_partitioning(bits, mode)
    if mode == "low":
        return df.withColumn(target, low_bits(source, bits))
    if mode == "high":
        return df.withColumn(target, high_bits(source, bits))
    mixed = with_splitmix64(df, source, "_mixed")
    return mixed.withColumn(target, high_bits("_mixed", bits)).drop("_mixed")


def hex_label(part_id: Column | str, bits: int) -> Column:
    """Lower-case hex name of a partition, zero-padded to the width ``bits`` needs."""
    p = F.col(part_id) if isinstance(part_id, str) else part_id
    return F.lpad(F.lower(F.hex(p)), -(-bits // 4), "0")


def register_sql(spark: SparkSession) -> None:
    """Temporary SQL functions: splitmix64(x) and hash_bucket(x, bits).

    The arguments of a SQL function are evaluated once per call, so nesting the
    steps as functions keeps the plan small.
    """
    half = f"{_LOW32}L"

    def define(name: str, params: str, body: str) -> None:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS BIGINT RETURN {body}")

    define("u64_add", "a BIGINT, b BIGINT",
           f"shiftleft(shiftrightunsigned(a, 32) + shiftrightunsigned(b, 32)"
           f" + shiftrightunsigned((a & {half}) + (b & {half}), 32), 32)"
           f" | (((a & {half}) + (b & {half})) & {half})")
    limb = f"{(1 << _LIMB) - 1}L"
    define("u64_mul", "a BIGINT, b BIGINT",
           f"u64_add(u64_add(u64_add((a & {half}) * (b & {limb}),"
           f" shiftleft((a & {half}) * (shiftrightunsigned(b, {_LIMB}) & {limb}), {_LIMB})),"
           f" u64_add(shiftleft((a & {half}) * shiftrightunsigned(b, {2 * _LIMB}), {2 * _LIMB}),"
           f" shiftleft(shiftrightunsigned(a, 32) * (b & {limb}), 32))),"
           f" shiftleft(shiftrightunsigned(a, 32) * (shiftrightunsigned(b, {_LIMB}) & {limb}), {32 + _LIMB}))")
    define("u64_fold", "a BIGINT, n INT", "a ^ shiftrightunsigned(a, n)")

    def lit(v: int) -> str:
        return f"{v - (1 << 64)}L"

    define("splitmix64", "x BIGINT",
           f"u64_fold(u64_mul(u64_fold(u64_mul(u64_fold(u64_add(x, {lit(GOLDEN_GAMMA)}), {SHIFT_1}),"
           f" {lit(MULTIPLIER_1)}), {SHIFT_2}), {lit(MULTIPLIER_2)}), {SHIFT_3})")
    define("hash_bucket", "x BIGINT, bits INT", "x & (shiftleft(1L, bits) - 1L)")
