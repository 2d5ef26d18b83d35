"""Unsigned 64-bit values on top of BIGINT.

Spark has no uint64. A hash is held as the BIGINT with the same 64 bits, which is
all that equality, joins, DISTINCT and bit operations need. Only ordering and the
edges of the system (Parquet uint64, JSON numbers) have to look at the sign.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SIGN = -(1 << 63)
_TWO_63 = f"CAST({1 << 63} AS DECIMAL(20,0))"
_TWO_64 = f"CAST({1 << 64} AS DECIMAL(20,0))"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bits_from_decimal(c: Column | str) -> Column:
    """DECIMAL(20,0) in [0, 2^64) to its bit pattern; larger values overflow the cast."""
    c = _col(c)
    wraps = (c >= F.expr(_TWO_63)) & (c < F.expr(_TWO_64))
    return F.when(wraps, c - F.expr(_TWO_64)).otherwise(c).cast("bigint")


def decimal_from_bits(c: Column | str) -> Column:
    """Bit pattern to the unsigned value as DECIMAL(20,0)."""
    c = _col(c)
    wide = c.cast("decimal(20,0)")
    return F.when(c < 0, wide + F.expr(_TWO_64)).otherwise(wide).cast("decimal(20,0)")


def bits_from_hex(c: Column | str) -> Column:
    """Sixteen hex digits to the bit pattern."""
    return F.conv(_col(c), 16, -10).cast("bigint")


def unsigned_key(c: Column | str) -> Column:
    """BIGINT whose signed order is the unsigned order of ``c``."""
    return _col(c).bitwiseXOR(F.lit(_SIGN))


def signed(value: int) -> int:
    """Python integer in [0, 2^64) to the signed integer with the same bits."""
    return value - (1 << 64) if value >> 63 else value


def unsigned_at_most(c: Column | str, bound: int) -> Column:
    """``c <= bound`` in unsigned order."""
    c = _col(c)
    if bound < 1 << 63:
        return c.between(0, bound)
    return unsigned_key(c) <= F.lit(signed(bound ^ (1 << 63)))
