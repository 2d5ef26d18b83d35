"""Stored sets that grow with a filter beside them.

Each folder that a commit adds comes with a block filter of its hashes, and is laid out by
(ksize, part) with parts from the same bits that name a block. A micro-batch is tested against
the filters first. Hashes that no filter holds are new for certain; the set itself is read for
the others only, and of it only the parts they fall into. So the fewer known hashes arrive, the
fewer stored rows are read; the result is exact either way.

Folders without a filter, of sets that ``grow_unique_set`` made or compacted, are read whole
until ``compact_filtered_set`` writes all of the set anew, so both ways to grow may be mixed.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fraclake.operators.block_filter import BLOCKS, block_bits, filter_blocks, leading, place, suspected
from fraclake.operators.hash_sets import KEY
from fraclake.shared import delete, entries
from fraclake.streaming.commits import State, commit, forget
from fraclake.streaming.ingest import _grown

PART_BITS, MOST_PART_BITS = 6, 12


def _number(folder: str) -> int:
    """The bits that a folder's name tells: of parts in those of hashes, of blocks in those of filters."""
    return int("".join(c for c in folder.partition("-")[0] if c.isdigit()))


def _filters(spark: SparkSession, out: str, state: State) -> list[tuple[int, DataFrame]]:
    held = set(state.get("folders", []))
    return [(_number(name), spark.read.schema(BLOCKS).parquet(f"{out}/{name}")) for folder, name in state.get("filters", {}).items() if folder in held]


def _unfiltered(state: State) -> list[str]:
    return [f for f in state.get("folders", []) if f not in state.get("filters", {})]


def _parts(spark: SparkSession, out: str, folder: str, suspects: DataFrame) -> DataFrame:
    """The rows of a folder in the parts of the suspects, at most 2^MOST_PART_BITS for each k."""
    rows = spark.read.schema("hash bigint, ksize int, part int").parquet(f"{out}/{folder}")
    found = suspects.select("ksize", leading("place", _number(folder)).cast("int").alias("part")).distinct().collect()
    by_k: dict[int | None, list[int]] = {}
    for r in found:
        by_k.setdefault(r.ksize, []).append(r.part)
    wanted = [F.col("ksize").eqNullSafe(F.lit(k)) & F.col("part").isin(sorted(p)) for k, p in by_k.items()]
    return rows.where(reduce(Column.__or__, wanted, F.lit(False))).select(*KEY)


def unheld(spark: SparkSession, out: str, state: State, hashes: DataFrame, judged_in: str) -> DataFrame:
    """Distinct (ksize, hash) rows that the set lacks; a NULL is one value.

    What the filters say of each hash is written to the folder ``judged_in``, which the result reads.
    """
    plain = _unfiltered(state)
    answers = suspected(hashes, _filters(spark, out, state)).withColumn("maybe", F.col("maybe") | F.lit(bool(plain)))
    answers.write.parquet(judged_in)
    judged = spark.read.schema(answers.schema).parquet(judged_in)
    suspects = judged.where("maybe")
    held = [_parts(spark, out, f, suspects) for f in state.get("folders", []) if f not in plain]
    if plain:
        held.append(_grown(spark, out, {"folders": plain}))
    if not held:
        return judged.select(*KEY)
    # the stored side keeps its place: what is sent to it, or shuffled with it, are the suspects
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
    known = reduce(DataFrame.unionByName, held).alias("a").join(suspects.select(*KEY).alias("b"), same, "left_semi")
    missing = suspects.select(*KEY).alias("a").join(known.alias("b"), same, "left_anti")
    return judged.where("not maybe").select(*KEY).unionByName(missing)


def _written(spark: SparkSession, out: str, rows: DataFrame, bits: int, folder: Callable[[str], str]) -> tuple[str, str] | None:
    """Write rows with their filter; the names of both folders, None without rows."""
    path = f"{out}/{(name := folder(f'added{bits}'))}"
    placed = rows.withColumn("part", leading(place(), bits).cast("int"))
    placed.hint("rebalance", "ksize", "part").sortWithinPartitions("ksize", "part", "hash").write.partitionBy("ksize", "part").parquet(path)
    if not any("=" in n for n in entries(spark, path)):
        return None
    added = spark.read.schema("hash bigint, ksize int, part int").parquet(path)
    blocks = block_bits(added.count(), bits)
    beside = folder(f"filter{blocks}")
    filter_blocks(added, blocks).write.parquet(f"{out}/{beside}")
    return name, beside


def _checked(bits: int) -> int:
    if not 1 <= bits <= MOST_PART_BITS:
        raise ValueError(f"part bits must be between 1 and {MOST_PART_BITS}")
    return bits


def grow_filtered_set(hashes: DataFrame, out: str, checkpoint: str, bits: int = PART_BITS) -> StreamingQuery:
    """``grow_unique_set`` with a filter: keep a stored set up to date with a stream of hashes.

    ``bits`` is the number of bits that name a part, so a folder has up to 2^bits parts for each
    k. Read the set with ``read_grown_set``. A micro-batch shuffles the filters, about 2.5 bytes
    for each stored hash, unless Spark finds the batch small enough to broadcast.
    """
    _checked(bits)
    out = out.rstrip("/")

    def add(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession

        def step(state: State, _number: int, folder: Callable[[str], str]) -> State | None:
            judged = f"{out}/{folder('judged')}"
            names = _written(spark, out, unheld(spark, out, state, batch, judged), bits, folder)
            delete(spark, judged)
            if names is None:
                return None
            return state | {"folders": [*state.get("folders", []), names[0]], "filters": state.get("filters", {}) | {names[0]: names[1]}}

        commit(spark, out, step)

    return (hashes.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def compact_filtered_set(spark: SparkSession, out: str, bits: int = PART_BITS, keep: int | None = None) -> int:
    """Write all folders as one, with one filter. Streams may go on adding meanwhile. ``keep``
    removes all but the last versions."""
    _checked(bits)
    out = out.rstrip("/")

    def step(state: State, _number: int, folder: Callable[[str], str]) -> State | None:
        if len(state.get("folders", [])) < 2 and not _unfiltered(state):
            return None
        names = _written(spark, out, _grown(spark, out, state), bits, folder)
        return None if names is None else state | {"folders": [names[0]], "filters": {names[0]: names[1]}}

    def carry(before: State, result: State, now: State) -> State | None:
        done = before["folders"]
        if now["folders"][:len(done)] != done:
            return None
        later = now["folders"][len(done):]
        filters = now.get("filters", {})
        return now | {"folders": result["folders"] + later, "filters": result["filters"] | {f: filters[f] for f in later if f in filters}}

    number = commit(spark, out, step, rebase=carry)
    if keep:
        forget(spark, out, keep)
    return number
