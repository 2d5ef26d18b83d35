"""Helpers that the operators share: fresh names, stored intermediates, parts of a folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraclake.llm.words import BLOCK, cuts
from fraclake.shared import stored

__all__ = ["by_text", "fresh", "stored"]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def by_text(one: Callable[..., pa.Array], kind: str, limit: int = 2 * BLOCK) -> Callable[..., Column]:
    """A column function of (text, ...) from ``one``, which gets arrays of bounded size.

    Batches are cut at about ``limit`` bytes of text, so memory is bounded by the longest
    single text however many rows Spark puts into a batch.
    """

    def run(batches):
        for columns in batches:
            columns = (columns,) if isinstance(columns, pa.Array) else columns
            parts = [one(*(c.slice(lo, hi - lo) for c in columns)) for lo, hi in cuts(columns[0], limit)]
            yield pa.concat_arrays(parts) if parts else one(*columns)

    def call(*columns: Column | str) -> Column:
        given = pa.Array if len(columns) == 1 else tuple[pa.Array, ...]
        run.__annotations__ = {"batches": Iterator[given], "return": Iterator[pa.Array]}
        return F.arrow_udf(run, kind)(*columns)

    return call


#: A side of fewer rows and bytes than this may be sent to every executor.
SMALL_ROWS, SMALL_BYTES = 1_000_000, 64 << 20


def small_side(side: DataFrame) -> DataFrame:
    """``side`` marked for broadcast if its counted rows and the bytes of its arrays are few,
    else as it is, so that the join is a shuffle."""
    arrays = [F.coalesce(F.size(f.name), F.lit(0)) * 16 for f in side.schema if f.dataType.typeName() == "array"]
    rows, size = side.agg(F.count("*"), F.coalesce(F.sum(sum(arrays, F.lit(64))), F.lit(0))).first()
    return F.broadcast(side) if rows <= SMALL_ROWS and size <= SMALL_BYTES else side
