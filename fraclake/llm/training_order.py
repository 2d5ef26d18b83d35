"""Token ids in training order: fixed-stride shards by a keyed permutation.

Documents become sequences of ``length`` ids (the last one of a document is filled up with the
end token). Sequence number i of N goes to slot P(i): a Feistel network keyed by ``key``
permutes the next power of four, and values beyond N are sent through it again until they
fall below N, so P is a permutation of 0..N-1 that any task computes by itself. A shard
holds ``rows`` neighbouring slots as rows of one stride, so slot s is row s mod rows of shard
s div rows: training reads shards from front to back, and resumes by a seek.

Ids are encoded once, into a compressed table. With their number known, each sequence gets its
slot, and the table is written once more, a folder for each wave of slots; the first one goes.
Each wave then reads and shuffles its own folder only, which goes with its shuffle files when
the wave ends, so the disk needed beside input and output is a fraction of the corpus. A wave
that is run again leaves finished shards as they are.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraclake.llm.bpe import SLICE, Encoder, texts_of
from fraclake.llm.frames import by_text
from fraclake.llm.words import keys, mix
from fraclake.shared import delete, passing, shared_folder
from fraclake.sinks.archives import file_system, put_file

LENGTH, ROWS, WAVES, ROUNDS, KEY, END = 256, 8192, 8, 6, 20240229, 50256
#: A row: doc_id, number of the piece in its document, number of own ids, ids.
HEADER = np.dtype([("doc_id", "<i8"), ("piece", "<i4"), ("n", "<u2")])
NO_ID = -(1 << 63)


def stride(length: int) -> int:
    return HEADER.itemsize + 2 * length


def permuted(index: np.ndarray, total: int, key: int) -> np.ndarray:
    """Slots of sequence numbers below ``total``."""
    half = max(1, (max(1, total - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    rounds = keys(ROUNDS, key)
    out = index.astype(np.uint64)
    left_over = np.arange(len(out))
    while len(left_over):
        high, low = out[left_over] >> shift, out[left_over] & mask
        for k in rounds:
            high, low = low, high ^ (mix(low * k + k) & mask)
        out[left_over] = (high << shift) | low
        left_over = left_over[out[left_over] >= np.uint64(total)]
    return out.astype(np.int64)


def slot_of(index: Column, total: int, key: int) -> Column:
    return F.arrow_udf(_slots(total, key), "bigint")(index)


def _slots(total: int, key: int):
    def slots(index: pa.Array) -> pa.Array:
        return pa.array(permuted(index.to_numpy(zero_copy_only=False), total, key))

    return slots


def sequences(docs: DataFrame, path: str, length: int, end: int) -> DataFrame:
    """(doc_id, piece, ids) with ids as little-endian uint16."""

    def cut(column: pa.Array) -> pa.Array:
        encoder = Encoder.at(path)
        encoded = encoder.encode(texts_of(column))
        flat, sizes = encoded.flat(), encoded.tokens()
        if flat.dtype != np.uint16:
            raise ValueError("ids of this vocabulary do not fit into two bytes")
        ends = np.cumsum(sizes)
        tail = np.array([end], "<u2").tobytes()
        out = []
        for hi, n in zip(ends.tolist(), sizes.tolist()):
            raw = flat[hi - n:hi].astype("<u2").tobytes() + tail
            out.append([raw[at:at + 2 * length] for at in range(0, len(raw), 2 * length)])
        return pa.array(out, pa.list_(pa.binary()))

    return docs.select("doc_id", F.posexplode(by_text(cut, "array<binary>", SLICE)("text")).alias("piece", "ids"))


def numbered(docs: DataFrame, path: str, length: int, end: int) -> tuple[DataFrame, int]:
    """The stored sequences with consecutive numbers ``index``, and how many there are.

    Numbers follow the written partitions: a row's place in its partition plus the sizes of the
    partitions before, a table of one row per partition.
    """
    spark = docs.sparkSession
    pool = shared_folder(spark, "sequences")
    made = sequences(docs, path, length, end).withColumn("row", F.monotonically_increasing_id())
    made.write.option("compression", "zstd").parquet(pool)
    rows = spark.read.schema(made.schema).parquet(pool)
    sizes = rows.groupBy(F.shiftright("row", 33).alias("partition")).agg(F.count("*").alias("n")).toPandas().sort_values("partition")
    before = sizes["n"].cumsum() - sizes["n"]
    total = int(sizes["n"].sum())
    bases = spark.createDataFrame(pd.DataFrame({"partition": sizes["partition"].astype("int64"), "base": before.astype("int64")}), "partition bigint, base bigint")
    place = F.col("row").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(bases), F.shiftright("row", 33) == F.col("partition")).withColumn("index", F.col("base") + place).select("doc_id", "piece", "ids", "index"), total


def in_waves(pool: DataFrame, total: int, key: int, rows: int, per: int) -> str:
    """Write the sequences with their slots, a folder wave=N for each ``per`` shards; returns the folder of these.

    ``mark`` is a hash of a row, so that all can be compared later without reading the ids.
    """
    spark = pool.sparkSession
    folder = shared_folder(spark, "waves")
    slotted = (pool.withColumn("doc_id", F.col("doc_id").cast("bigint")).withColumn("slot", slot_of(F.col("index"), total, key))
               .withColumn("shard", F.floor(F.col("slot") / rows)))
    marked = slotted.withColumn("mark", F.xxhash64("index", "doc_id", "piece", "ids")).withColumn("wave", F.floor(F.col("shard") / per))
    marked.drop("index").write.option("compression", "zstd").partitionBy("wave").parquet(folder)
    return folder


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session that holds inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def shard_file(base: str, shard: int) -> str:
    return f"{base}/shard-{shard:08d}.bin"


def content(spark: SparkSession, folder: str) -> int:
    """A number that changes with the sequences, their documents and their order."""
    return spark.read.schema("mark bigint").parquet(folder).agg(F.bit_xor("mark")).first()[0]


def begin(root: str, manifest: dict) -> None:
    """Write the manifest of the shards under ``root``; ValueError if there are others."""
    store, base = file_system(root)
    name = f"{base}/manifest.json"
    if store.get_file_info(name).is_file:
        with store.open_input_file(name) as file:
            told = json.loads(file.read())
        if told != manifest:
            raise ValueError(f"{root} holds shards of other sequences or of another order")
    elif any(f.base_name.endswith(".bin") for f in store.get_file_info(fs.FileSelector(base, allow_not_found=True))):
        raise ValueError(f"{root} holds shards without a manifest")
    else:
        put_file(store, name, json.dumps(manifest).encode(), "manifest")


def materialised(docs: DataFrame, path: str, root: str, length: int = LENGTH, rows: int = ROWS, waves: int = WAVES,
                 key: int = KEY, end: int = END) -> int:
    """Write the sequences of (doc_id, text) rows as shards under ``root``; returns their number.

    A null or empty text is one sequence with the end token alone; a null doc_id is stored as
    the smallest bigint, so a document with that id reads as one without. An empty table
    writes nothing. Ids of the vocabulary must fit into two bytes, else a ValueError says so.

    A manifest is written first. A job that broke off is taken up where it was: shards of the
    right size are kept if the manifest tells of the same sequences in the same order, and a
    folder with other shards is refused.
    """
    spark = docs.sparkSession
    with passing(spark) as made, setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(waves + 1)):
        pool, total = numbered(docs, path, length, end)
        if not total:
            return 0
        shards = -(-total // rows)
        per = -(-shards // max(1, waves))
        folder = in_waves(pool, total, key, rows, per)
        made.remove(folder)
    begin(root, {"key": key, "length": length, "rows": rows, "end": end, "total": total, "content": content(spark, folder)})
    width = stride(length)

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("slot")
        shard = table.column("shard")[0].as_py()
        n = table.num_rows
        block = np.zeros(n, np.dtype([*((x, HEADER[x]) for x in HEADER.names), ("ids", "<u2", length)]))
        block["doc_id"] = table.column("doc_id").fill_null(NO_ID).to_numpy()
        block["piece"] = table.column("piece").to_numpy()
        block["ids"] = end
        for i, raw in enumerate(table.column("ids").to_pylist()):
            block["n"][i] = len(raw) // 2
            block["ids"][i, :len(raw) // 2] = np.frombuffer(raw, "<u2")
        store, base = file_system(root)
        name = shard_file(base, shard)
        if store.get_file_info(name).size != n * width:
            put_file(store, name, block.tobytes(), str(TaskContext.get().taskAttemptId()))
        return pa.table({"shard": pa.array([shard], pa.int64()), "rows": pa.array([n], pa.int64())})

    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        for n, first in enumerate(range(0, shards, per)):
            wave = spark.read.schema("doc_id bigint, piece int, ids binary, slot bigint, shard bigint").parquet(f"{folder}/wave={n}")
            # one shard is a key, and as large as any other
            dealt = wave.repartition(min(per, shards - first), "shard").groupBy("shard")
            dealt.applyInArrow(write, "shard bigint, rows bigint").write.format("noop").mode("overwrite").save()
            delete(spark, f"{folder}/wave={n}")
    return total


def read(spark: SparkSession, root: str, total: int, first: int = 0, last: int | None = None, length: int = LENGTH, rows: int = ROWS) -> DataFrame:
    """(slot, doc_id, piece, n_tokens, ids) of the slots from ``first`` up to ``last`` (not included).

    Each task seeks to its rows in each of its shards and reads them in order.
    """
    last = total if last is None else min(last, total)
    shards = spark.range(first // rows, max(first // rows, -(-last // rows)))
    width = stride(length)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(root)
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                lo, hi = max(first, shard * rows), min(last, (shard + 1) * rows)
                with store.open_input_file(shard_file(base, shard)) as file:
                    raw = file.read_at((hi - lo) * width, (lo - shard * rows) * width)
                block = np.frombuffer(raw, np.dtype([*((x, HEADER[x]) for x in HEADER.names), ("ids", "<u2", length)]))
                ids = pa.array([b[:n].tobytes() for b, n in zip(block["ids"], block["n"])], pa.binary())
                doc_id = pa.array(np.ascontiguousarray(block["doc_id"]), mask=block["doc_id"] == NO_ID)
                yield pa.record_batch([pa.array(np.arange(lo, hi)), doc_id, pa.array(np.ascontiguousarray(block["piece"])),
                                       pa.array(block["n"].astype(np.int64)), ids], names=["slot", "doc_id", "piece", "n_tokens", "ids"])

    return shards.mapInArrow(load, "slot bigint, doc_id bigint, piece int, n_tokens bigint, ids binary")


def report(docs: DataFrame, path: str) -> DataFrame:
    """Materialise ``docs`` and read all of it back: one row per sequence, with a checksum of its ids."""
    root = shared_folder(docs.sparkSession, "training-order")
    total = materialised(docs.select("doc_id", "text"), path, root)
    rows = read(docs.sparkSession, root, total)
    return rows.select("slot", F.floor(F.col("slot") / ROWS).alias("shard"), "doc_id", "piece", "n_tokens", F.crc32("ids").alias("ids_crc32"))
