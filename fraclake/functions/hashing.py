"""64-bit hashes of strings: two JVM-side ones; MurmurHash3 x64-128 and md5 of many short strings in numpy."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, SparkSession, functions as F
from pyspark.sql import types as T

from fraclake.functions.unsigned import bits_from_hex

# Fixed values of MurmurHash3 x64-128.
C1 = 0x87C37B91114253D5
C2 = 0x4CF5AD432745937F
ADD_1 = 0x52DCE729
ADD_2 = 0x38495AB5
FINAL_1 = 0xFF51AFD7ED558CCD
FINAL_2 = 0xC4CEB9FE1A85EC53

#: Seed of the k-mer hash.
KMER_SEED = 42


def md5_hex16(value: Column) -> Column:
    """First 16 hex digits of the md5: fixed width, so text order is unsigned order."""
    return F.substring(F.md5(value), 1, 16)


def md5_64(value: Column) -> Column:
    """Top 64 bits of the md5 as a bit pattern."""
    return bits_from_hex(md5_hex16(value))


def _u(v: int) -> np.uint64:
    return np.uint64(v)


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << _u(n)) | (x >> _u(64 - n))


def _avalanche(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u(33))) * _u(FINAL_1)
    x = (x ^ (x >> _u(33))) * _u(FINAL_2)
    return x ^ (x >> _u(33))


def murmur64_fixed(words: np.ndarray, length: int, seed: int = KMER_SEED) -> np.ndarray:
    """First word of MurmurHash3 x64-128 for many keys of one byte length.

    ``words`` is (keys, 2 * blocks) little-endian uint64, zero-padded to 16-byte
    blocks. A zero-padded tail contributes nothing where it has no bytes, so the
    last block needs no special case beyond leaving out the per-block stirring.
    """
    h1 = np.full(len(words), seed, dtype=np.uint64)
    h2 = h1.copy()
    whole = length // 16
    for b in range(words.shape[1] // 2):
        k1, k2 = words[:, 2 * b], words[:, 2 * b + 1]
        k1 = _rotl(k1 * _u(C1), 31) * _u(C2)
        k2 = _rotl(k2 * _u(C2), 33) * _u(C1)
        h1 = h1 ^ k1
        if b >= whole:
            h2 = h2 ^ k2
            continue
        h1 = (_rotl(h1, 27) + h2) * _u(5) + _u(ADD_1)
        h2 = _rotl(h2 ^ k2, 31)
        h2 = (h2 + h1) * _u(5) + _u(ADD_2)
    h1, h2 = h1 ^ _u(length), h2 ^ _u(length)
    h1 = h1 + h2
    h2 = h2 + h1
    return _avalanche(h1) + _avalanche(h2)


def padded_words(rows: np.ndarray) -> np.ndarray:
    """(keys, length) bytes to zero-padded little-endian words in 16-byte blocks."""
    n, length = rows.shape
    width = max(16, -(-length // 16) * 16)
    padded = np.zeros((n, width), dtype=np.uint8)
    padded[:, :length] = rows
    return padded.view("<u8")


def murmur64_bytes(keys: list[bytes], seed: int = KMER_SEED) -> np.ndarray:
    """MurmurHash3 of byte strings, vectorised over the keys of each length."""
    out = np.zeros(len(keys), dtype=np.uint64)
    lengths = np.fromiter((len(k) for k in keys), dtype=np.int64, count=len(keys))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        joined = b"".join(keys[i] for i in at)
        rows = np.frombuffer(joined, dtype=np.uint8).reshape(len(at), int(length))
        out[at] = murmur64_fixed(padded_words(rows), int(length), seed)
    return out


# Fixed values of md5: the sines, the rotations of each round, and the first state.
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_TURNS = [np.uint32(t) for t in (7, 12, 17, 22, 5, 9, 14, 20, 4, 11, 16, 23, 6, 10, 15, 21)]
_STATE = [np.uint32(v) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]

#: Bytes that fit one md5 block, keys hashed at a time, and what is kept of and added to a word with 0 to 4 bytes of a key.
MD5_BYTES, MD5_KEYS = 55, 1 << 14
_KEPT = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint32)
_ENDED = np.array([0x80, 0x8000, 0x800000, 0x80000000, 0], dtype=np.uint32)


def _md5_top(words: list[np.ndarray | None], bits: np.ndarray | int) -> np.ndarray:
    """Top 64 bits of the md5 of one block for each key, given as words 0 to 13, None where all are zero."""
    n = len(words[0])
    a, b, c, d = (np.full(n, v, dtype=np.uint32) for v in _STATE)
    f, t = np.empty(n, dtype=np.uint32), np.empty(n, dtype=np.uint32)
    block = [*words, *[None] * (14 - len(words)), np.asarray(bits, dtype=np.uint32), None]
    for i in range(64):
        if i < 16:
            g = i
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif i < 32:
            g = (5 * i + 1) % 16
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif i < 48:
            g = (3 * i + 5) % 16
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            g = 7 * i % 16
            np.invert(d, out=f)
            f |= b
            f ^= c
        f += a
        f += _SINES[i]
        if block[g] is not None:
            f += block[g]
        turn = _TURNS[4 * (i // 16) + i % 4]
        np.left_shift(f, turn, out=t)
        f >>= np.uint32(32) - turn
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    a += _STATE[0]
    b += _STATE[1]
    return (a.byteswap().astype(np.uint64) << _u(32)) | b.byteswap()


def _at_every_byte(data: np.ndarray, kind: str) -> np.ndarray:
    """The number that begins at each of the bytes, in an array of its own: views that are not aligned are slow to take from."""
    width = np.dtype(kind).itemsize
    view = np.ndarray((max(0, len(data) - width + 1),), dtype=kind, buffer=data, strides=(1,))
    return view.astype(np.dtype(kind).newbyteorder("="))


def md5_64_slices(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Top 64 bits of the md5 of many slices of a buffer; MD5_KEYS at a time, longer ones one by one."""
    every = _at_every_byte(np.concatenate([data, np.zeros(MD5_BYTES + 5, dtype=np.uint8)]), "<u4")
    out = np.empty(len(starts), dtype=np.uint64)
    for lo in range(0, len(starts), MD5_KEYS):
        first, length = starts[lo:lo + MD5_KEYS], lengths[lo:lo + MD5_KEYS]
        short = np.minimum(length, MD5_BYTES)
        words = []
        for j in range(int(short.max()) // 4 + 1):
            held = np.clip(short - 4 * j, 0, 4)
            word = every[first + 4 * j] & _KEPT[held]
            word |= np.where(short >= 4 * j, _ENDED[held], np.uint32(0))
            words.append(word)
        top = _md5_top(words, 8 * short)
        for i in np.flatnonzero(length > MD5_BYTES):
            top[i] = int.from_bytes(hashlib.md5(data[first[i]:first[i] + length[i]]).digest()[:8], "big")
        out[lo:lo + MD5_KEYS] = top
    return out


def md5_64_canonical(data: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
    """Top 64 bits of the md5 of the smaller one of each slice of ``data`` of that length, one from every byte on,
    and its counterpart in ``other``, which holds the bytes that belong to them in reverse order."""
    n = len(data) - length + 1
    if length > MD5_BYTES or length < 8:
        pairs = ((data[a:a + length].tobytes(), other[n - 1 - a:n - 1 - a + length].tobytes()) for a in range(n))
        tops = (int.from_bytes(hashlib.md5(min(pair)).digest()[:8], "big") for pair in pairs)
        return np.fromiter(tops, dtype=np.uint64, count=n)
    one, two = _at_every_byte(data, ">u8"), np.ascontiguousarray(_at_every_byte(other, ">u8")[::-1])
    flip, alike = two[-n:] < one[:n], np.flatnonzero(two[-n:] == one[:n])
    for at in [*range(8, length - 7, 8), length - 8]:  # eight bytes at a time, until they differ
        if not len(alike):
            break
        ahead, behind = one[alike + at], two[alike + len(two) - n - at]
        flip[alike] = behind < ahead
        alike = alike[behind == ahead]
    here, there = _at_every_byte(data, "<u4"), np.ascontiguousarray(_at_every_byte(other, "<u4")[::-1])
    mask = flip.astype(np.uint32) * np.uint32(0xFFFFFFFF)

    def word(at: int) -> np.ndarray:
        mine, theirs = here[at:at + n], there[len(there) - at - n:len(there) - at]
        return mine ^ ((mine ^ theirs) & mask)

    words = [word(at) for at in range(0, length - 3, 4)]
    rest = length % 4
    if rest:  # the last four bytes, without those that the word before has
        words.append((word(length - 4) >> np.uint32(8 * (4 - rest))) | _ENDED[rest])
    else:
        words.append(np.full(n, _ENDED[0]))
    return _md5_top(words, 8 * length)


@F.pandas_udf(T.LongType())
def murmur64(values: pd.Series) -> pd.Series:
    """Bit pattern of the k-mer hash of each string; NULL stays NULL."""
    known = values.notna()
    hashed = murmur64_bytes([v.encode() for v in values[known]]).view(np.int64)
    out = pd.Series([None] * len(values), dtype="Int64")
    out[known.to_numpy()] = hashed
    return out


def register_sql(spark: SparkSession) -> None:
    """SQL function murmur64(string)."""
    spark.udf.register("murmur64", murmur64)
