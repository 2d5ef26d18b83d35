"""Packing documents into training sequences by the sum-of-squares rule.

Each document becomes its ids and an end token; one longer than a sequence is cut into whole
sequences and a shorter first piece. Whole pieces are sequences by themselves. Each other
piece goes where the sum over gaps g of N(g)^2 becomes smallest, N(g) being the number of
open sequences with g tokens left; opening a new sequence is one of the choices. What the
rule needs to know is one counter per gap.

Pieces are packed in groups of ``group`` of them, drawn evenly, each by one task. A group
leaves a handful of sequences partly empty, so a fixed group size keeps the share of padding
fixed while the number of groups follows the corpus.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraclake.llm.bpe import SLICE, Encoder, texts_of
from fraclake.llm.frames import by_text, stored

CAPACITY, END, GROUP = 1024, 2, 65_536
PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def cutter(path: str, capacity: int = CAPACITY, end: int = END):
    """A column function: the pieces of each text."""

    def cut(column: pa.Array) -> pa.Array:
        encoded = Encoder.at(path).encode(texts_of(column))
        flat, sizes = encoded.flat().astype("<u4"), encoded.tokens()
        firsts = np.cumsum(sizes) - sizes
        tail = np.array([end], "<u4").tobytes()
        out, piece, start, length, crc = [0], [], [], [], []
        for first, size in zip(firsts.tolist(), sizes.tolist()):
            raw = flat[first:first + size].tobytes() + tail
            at, n = 0, (size + 1) % capacity or capacity
            while at <= size:
                piece.append(len(piece) - out[-1])
                start.append(at)
                length.append(n)
                crc.append(zlib.crc32(raw[4 * at:4 * (at + n)]))
                at, n = at + n, capacity
            out.append(len(piece))
        fields = [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        items = pa.StructArray.from_arrays(fields, names=["piece", "start", "length", "ids_crc32"])
        return pa.ListArray.from_arrays(pa.array(out, pa.int32()), items)

    return by_text(cut, PIECES, SLICE)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The sequence and the offset of each piece, placed in the given order.

    Putting a piece of length s into a gap g takes one from N(g) and adds one to N(g - s),
    which changes half the sum of squares by N(g - s) - N(g) + 1, or by 1/2 - N(g) where it
    fills the gap; a new sequence changes it by N(capacity - s) + 1/2. Ties go to the
    smallest gap. As many sequences as all pieces need at least may be opened by this rule;
    from then on a new one is opened only for a piece that fits nowhere.
    """
    count = np.zeros(capacity + 1)  # N as floats
    shut = np.full(capacity + 1, np.inf)  # infinite where N(g) is 0
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made, needed = 0, max(-(-int(lengths.sum()) // capacity), int((2 * lengths > capacity).sum()))
    for i, s in enumerate(lengths.tolist()):
        change = count[:capacity - s] - count[s:capacity] + shut[s:capacity]
        change[:1] -= 0.5  # a full sequence is no longer counted
        best = int(np.argmin(change)) if len(change) else 0
        fits = len(change) and change[best] < np.inf
        if fits and (made >= needed or change[best] + 1 <= count[capacity - s] + 0.5):
            gap = best + s
            number = open_[gap].pop()
            count[gap] -= 1
            if count[gap] == 0:
                shut[gap] = np.inf
        else:
            gap, number, made = capacity, made, made + 1
        sequence[i], offset[i] = number, capacity - gap
        if gap > s:
            open_[gap - s].append(number)
            count[gap - s] += 1
            shut[gap - s] = 0
    return sequence, offset


def best_of_two(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The rule with the longest pieces first, or in the given order where that needs fewer."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    sequence[order], offset[order] = sum_of_squares(lengths[order], capacity)
    plain = sum_of_squares(lengths, capacity)
    return plain if plain[0].max(initial=-1) < sequence.max(initial=-1) else (sequence, offset)


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, group: int = GROUP) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) for each piece of each row.

    A null or empty text is the end token alone. Repeated rows are packed as often as they
    occur. An empty table gives no rows. Other columns are not looked at.
    """
    cut = docs.select("doc_id", F.explode(cutter(path, capacity, end)("text")).alias("p")).select("doc_id", "p.*")
    pieces = stored(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    parts = max(1, -(-pieces.where(F.col("length") < capacity).count() // group))
    dealt = pieces.withColumn("part", F.when(F.col("length") == capacity, -1).otherwise(F.pmod(F.xxhash64("row"), F.lit(parts))))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("row", ignore_index=True)
        rows["sequence_id"], rows["offset"] = best_of_two(rows["length"].to_numpy(), capacity)
        rows["sequence_id"] = rows["sequence_id"] * parts + rows["part"]
        return rows.drop(columns=["row", "part"])

    names = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    shared = dealt.where("part >= 0").groupBy("part").applyInPandas(place, names)
    whole = dealt.where("part < 0").select("doc_id", "piece", "start", "length", "ids_crc32",
                                           (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(shared)
