"""Streams that read what is new, process it once, and stop (or keep running).

All state is in the checkpoint and in stored tables, so a stream survives the loss of
executors and of the driver. Replaying a micro-batch changes nothing.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Collection
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fraclake.functions.paths import retry_delay
from fraclake.operators.hash_sets import difference, unique_hashes
from fraclake.operators.ledger import ERROR_MAX_TRIES
from fraclake.shared import entries, exists, stored
from fraclake.sources.archives import decode_archive_files, flat_hashes, list_archives
from fraclake.sources.files import OPEN_BYTES, TASKS, dealt_by_bytes
from fraclake.streaming.commits import State, commit, forget, newest

FLAT = "hash bigint, scaled bigint, source_file string, sketch_name string, run int, ksize int"
INGESTED = "path string, length bigint, mtime double, attempt int, tried_at double, member string, status string, error string, run int"


def ingest_archives(spark: SparkSession, root: str, out: str, log: str, ksizes: Collection[int] | None = None, now: float | None = None) -> int:
    """Decode the archives that are due; returns the number of this run.

    Due are archives that no earlier run has tried, and those of ``waiting``. Neither a file's
    age nor the order of arrival matters. A run writes its hashes under ``out`` and then what
    became of each archive and member under ``log``; the log commits the run. A run that
    broke off is not in the log: the next one has the same number and writes it anew.
    ``now`` is the time of the run in seconds, the clock's by default.
    """
    run = 1 + max(committed(spark, log, "run"), default=0)
    now = time.time() if now is None else now
    work = stored(worklist(list_archives(spark, root), ingested(spark, log), now), "worklist")
    # the same rows give hashes and outcomes: they are decoded once
    spread = dealt_by_bytes(work, TASKS * spark.sparkContext.defaultParallelism, open_bytes=OPEN_BYTES)
    rows = stored(decode_archive_files(spread, ksizes, deal=False), "decoded")
    flat_hashes(rows).write.mode("overwrite").partitionBy("ksize").parquet(f"{out}/run={run}")
    heads = rows.where(F.col("member_head") | F.col("member").isNull()).select("path", "member", "status", "error")
    tried = work.join(heads, "path").withColumn("tried_at", F.lit(float(now)))
    tried.select("path", "length", "mtime", "attempt", "tried_at", "member", "status", "error").write.mode("overwrite").parquet(f"{log}/run={run}")
    return run


def worklist(listed: DataFrame, log: DataFrame, now: float) -> DataFrame:
    """(path, length, mtime, attempt) of the listed archives that are due.

    An archive with a fault comes again when its length or time has changed since it was
    tried: it was incomplete then, or has been replaced. One that could not be opened or read
    comes again unchanged too, after a delay that doubles with each attempt, up to
    ERROR_MAX_TRIES of them. All others are done with their first attempt.
    """
    about = F.struct("length", "mtime", "attempt", "tried_at")
    runs = log.groupBy("path", "run").agg(F.any_value(about).alias("seen"), F.bool_or(F.col("status").startswith("bad")).alias("faulty"),
                                          F.bool_or(F.col("status") == "bad_open").alias("passing"))
    last = runs.groupBy(F.col("path").alias("_path")).agg(F.max_by(F.struct("seen", "faulty", "passing"), "run").alias("last"))
    both = listed.join(last, F.col("path") == F.col("_path"), "left")
    tries = F.coalesce("last.seen.attempt", F.lit(1))
    changed = (F.col("length") != F.col("last.seen.length")) | (F.col("mtime") != F.coalesce("last.seen.mtime", "mtime"))
    rested = (tries < ERROR_MAX_TRIES) & (F.lit(float(now)) >= F.coalesce("last.seen.tried_at", F.lit(0.0)) + retry_delay(tries))
    due = F.col("_path").isNull() | (F.col("last.faulty") & changed) | (F.col("last.passing") & rested)
    return both.where(due).select("path", "length", "mtime", F.when(F.col("_path").isNull() | changed, 1).otherwise(tries + 1).alias("attempt"))


def committed(spark: SparkSession, root: str, name: str) -> list[int]:
    """Numbers of the folders ``name``=N that were written to the end."""
    found = [int(n.split("=")[1]) for n in entries(spark, root) if n.startswith(f"{name}=")]
    return [n for n in found if exists(spark, f"{root}/{name}={n}/_SUCCESS")]


def ingested(spark: SparkSession, log: str) -> DataFrame:
    """What became of each archive and member, bad ones with their whole errors."""
    runs = committed(spark, log, "run")
    rows = spark.read.schema(INGESTED).option("basePath", log).parquet(*[f"{log}/run={r}" for r in runs]) if runs else None
    return spark.createDataFrame([], INGESTED) if rows is None else rows


def ingested_hashes(spark: SparkSession, out: str, log: str) -> DataFrame:
    """The flat table of all committed runs; of an archive that was tried again the last attempt counts."""
    runs = committed(spark, log, "run")
    if not runs:
        return spark.createDataFrame([], FLAT)
    flat = spark.read.schema(FLAT).parquet(out).where(F.col("run").isin(*runs))
    tried = ingested(spark, log).groupBy(F.col("path").alias("_path")).agg(F.max("run").alias("_last"), F.min("run").alias("_first"))
    again = tried.where("_first < _last").drop("_first")
    return flat.join(again, (F.col("source_file") == F.col("_path")) & (F.col("run") < F.col("_last")), "left_anti")


def missing_hashes(hashes: DataFrame, stored_set: DataFrame, hint: str | None = None) -> DataFrame:
    """Distinct (ksize, hash) rows that the stored set lacks; a NULL hash is one value per k.

    NULL rows are few after deduplication and are compared by k apart from the others, so
    that the join on the hash stays an equality that fits stored buckets.
    """
    new = unique_hashes(hashes)
    named = stored_set.hint(hint) if hint else stored_set
    plain = difference(new.where("hash is not null"), named)
    known = stored_set.where("hash is null").select(F.col("ksize").alias("_k")).distinct()
    nulls = new.where("hash is null").join(known, F.col("ksize").eqNullSafe(F.col("_k")), "left_anti")
    return plain.unionByName(nulls)


def grow_unique_set(hashes: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Keep a stored set of distinct (ksize, hash) up to date with a stream of hashes.

    Each micro-batch commits a folder with what the set does not hold yet. A batch that is
    replayed finds its own rows there and adds nothing; deduplication state in the stream
    would instead have to hold every hash for ever. Streams may share a set, and it may be
    compacted meanwhile. The stored side is shuffled every time: for a set that grows large
    use ``grow_unique_table``.
    """

    def add(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession

        def step(state: State, _number: int, folder: Callable[[str], str]) -> State | None:
            path = f"{out.rstrip('/')}/{(name := folder('added'))}"
            missing_hashes(batch, _grown(spark, out, state)).hint("rebalance", "ksize").write.partitionBy("ksize").parquet(path)
            if not any("=" in n for n in entries(spark, path)):
                return None
            return state | {"folders": [*state.get("folders", []), name]}

        commit(spark, out, step)

    return (hashes.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def read_grown_set(spark: SparkSession, out: str) -> DataFrame:
    """(ksize, hash) of a set that streams keep up to date."""
    return _grown(spark, out, newest(spark, out)[1])


def _grown(spark: SparkSession, out: str, state: State) -> DataFrame:
    parts = [spark.read.schema("hash bigint, ksize int").parquet(f"{out.rstrip('/')}/{folder}").select("ksize", "hash")
             for folder in state.get("folders", [])]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "ksize int, hash bigint")


def compact_unique_set(spark: SparkSession, out: str, keep: int | None = None) -> int:
    """Write the folders of a grown set as one. Streams may go on adding: what they commit
    meanwhile stays beside it. ``keep`` removes all but the last versions."""

    def step(state: State, _number: int, folder: Callable[[str], str]) -> State | None:
        if len(state.get("folders", [])) < 2:
            return None
        name = folder("whole")
        rows = _grown(spark, out, state).hint("rebalance", "ksize").sortWithinPartitions("ksize", "hash")
        rows.write.partitionBy("ksize").parquet(f"{out.rstrip('/')}/{name}")
        return state | {"folders": [name]}

    def carry(before: State, result: State, now: State) -> State | None:
        done = before["folders"]
        return now | {"folders": result["folders"] + now["folders"][len(done):]} if now["folders"][:len(done)] == done else None

    number = commit(spark, out, step, rebase=carry)
    if keep:
        forget(spark, out, keep)
    return number


def grow_unique_table(hashes: DataFrame, table: str, checkpoint: str, buckets: int) -> StreamingQuery:
    """The same for a catalog table bucketed by (ksize, hash).

    The stored side of the difference is read in place, bucket by bucket: only the
    hashes of the micro-batch are shuffled, however large the table has become. Their
    shuffle follows the buckets, so each batch adds one file per bucket; ``compact_table``
    makes them one again. ``table`` is a view of the generation that counts.
    """

    def add(batch: DataFrame, _batch_id: int) -> None:
        spark = batch.sparkSession
        present = open_generation(spark, table, buckets)
        _append_buckets(missing_hashes(batch, spark.table(present), "merge"), present, buckets)

    return (hashes.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def _append_buckets(rows: DataFrame, table: str, buckets: int) -> None:
    (rows.repartition(buckets, "ksize", "hash").write.mode("append")
     .bucketBy(buckets, "ksize", "hash").sortBy("ksize", "hash").saveAsTable(table))


_GENERATION = "fraclake.generation"


def _generations(spark: SparkSession, table: str) -> dict[int, str]:
    """The stored generations of a table, pointed at or not."""
    database, _, name = table.rpartition(".")
    found = spark.catalog.listTables(database or None, f"{name}__g*")
    return {int(t.name.removeprefix(f"{name.lower()}__g")): f"{table}__g{t.name.removeprefix(f'{name.lower()}__g')}" for t in found}


def _pointed(spark: SparkSession, table: str) -> int | None:
    """The generation the view shows; None without a view."""
    if not spark.catalog.tableExists(table) or spark.catalog.getTable(table).tableType != "VIEW":
        return None
    return int(spark.sql(f"SHOW TBLPROPERTIES {table} ('{_GENERATION}')").first()["value"])


def _point(spark: SparkSession, table: str, number: int) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{_GENERATION}' = '{number}') AS SELECT * FROM {table}__g{number}")


def open_generation(spark: SparkSession, table: str, buckets: int) -> str:
    """The name of the stored table behind ``table``, made if there is none.

    A table that is no view yet becomes the first generation. Without a view the oldest
    generation counts: later ones are only written while there is a view.
    """
    number = _pointed(spark, table)
    if number is None:
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} RENAME TO {table}__g1")
        stored_ones = _generations(spark, table)
        if not stored_ones:
            _append_buckets(spark.createDataFrame([], "ksize int, hash bigint"), f"{table}__g1", buckets)
        number = min(stored_ones, default=1)
        _point(spark, table, number)
    spark.catalog.refreshTable(f"{table}__g{number}")  # another session may have added files
    return f"{table}__g{number}"


def read_grown_table(spark: SparkSession, table: str) -> DataFrame:
    """(ksize, hash) of a table that streams keep up to date, with what sessions of theirs have added."""
    spark.catalog.refreshTable(table)
    return spark.table(table).select("ksize", "hash")


def compact_table(spark: SparkSession, table: str, buckets: int) -> None:
    """Write a bucketed table as its next generation, with one file per bucket. Not while a stream appends to it.

    The view changes over when that is complete, in one step of the catalog; then older
    generations go. Broken off at any point the table is whole, as it was or compacted, and
    the next call removes what is left over.
    """
    now = open_generation(spark, table, buckets)
    number = int(now.rpartition("__g")[2])
    for other, name in _generations(spark, table).items():
        if other != number:
            spark.sql(f"DROP TABLE {name}")
    _append_buckets(spark.table(now), f"{table}__g{number + 1}", buckets)
    _point(spark, table, number + 1)
    spark.sql(f"DROP TABLE {now}")
