"""The stored work ledger: base files by ranges of ids, and change files on top of them.

A change writes only the rows it changes, whatever the size of the ledger. Readers take the
last version of each id among the changes, and the base for all other ids. Compaction
rewrites the ranges of ids that changes have touched and leaves the others as they are. Every
change is a commit, so several writers may work at once and none loses what another did.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fraclake.operators.ledger import outcome_rows, upsert_rows
from fraclake.operators.listing import listing_candidates
from fraclake.shared import entries
from fraclake.streaming.commits import State, commit, commits, forget, newest, state_of
from fraclake.types import LEDGER

#: A bucket holds 2^20 consecutive ids; changes are folded in when there are this many.
BUCKET_BITS, CHANGES = 20, 16

_OTHERS = [f.name for f in LEDGER.fields if f.name != "id"]
_CHANGED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in LEDGER.fields) + ", version bigint"


def _bucket() -> Column:
    return F.shiftright("id", BUCKET_BITS).cast("bigint")


def newest_version(spark: SparkSession, root: str) -> int:
    """The last version of the ledger; 0 before the first."""
    return max(commits(spark, root), default=0)


def read_ledger_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of the stored ledger, or the one named."""
    return _rows(spark, root, newest(spark, root)[1] if version is None else state_of(spark, root, version))


def _rows(spark: SparkSession, root: str, state: State, buckets: set[str] | None = None) -> DataFrame:
    """The ledger of a state, or the part of it in some buckets that hold all its changes."""
    root = root.rstrip("/")
    places = [f"{root}/{folder}/bucket={b}" for b, folder in sorted(state.get("base", {}).items()) if buckets is None or b in buckets]
    base = spark.read.schema(LEDGER).parquet(*places) if places else spark.createDataFrame([], LEDGER)
    if not state.get("changes"):
        return base
    changes = spark.read.schema(_CHANGED).option("recursiveFileLookup", True).parquet(*[f"{root}/{folder}" for folder in state["changes"]])
    last = changes.groupBy("id").agg(F.max_by(F.struct(*_OTHERS), "version").alias("r")).select("id", "r.*")
    return base.join(last.select("id"), "id", "left_anti").unionByName(last)


def publish(spark: SparkSession, root: str, source: str, change: Callable[[DataFrame], DataFrame], keep: int | None = None,
            number: int = 0, compact_after: int = CHANGES) -> int:
    """Write the next version of the ledger, and return its number.

    ``change`` is given the ledger and returns the rows that are new or changed, one for
    each id. It runs again, on the newer ledger, when another writer was first. ``source`` and
    ``number`` name what is applied, any text and its position in a stream: what has been
    applied before changes nothing, so replays are harmless. ``keep`` removes all but the
    last versions.
    """

    def step(state: State, version: int, folder: Callable[[str], str]) -> State:
        name = folder("changes")
        rows = change(_rows(spark, root, state)).withColumns({"version": F.lit(version).cast("bigint"), "bucket": _bucket()})
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{root.rstrip('/')}/{name}")
        return state | {"changes": [*state.get("changes", []), name]}

    version = commit(spark, root, step, source, number)
    if len(newest(spark, root)[1].get("changes", [])) >= compact_after:
        version = max(version, compact_ledger(spark, root))
    if keep:
        forget(spark, root, keep)
    return version


def compact_ledger(spark: SparkSession, root: str) -> int:
    """Fold all changes into the buckets they touch; the ledger stays the same."""
    root = root.rstrip("/")

    def step(state: State, version: int, folder: Callable[[str], str]) -> State | None:
        changes = state.get("changes", [])
        if not changes:
            return None
        touched = {n.removeprefix("bucket=") for c in changes for n in entries(spark, f"{root}/{c}") if n.startswith("bucket=")}
        name = folder("base")
        rows = _rows(spark, root, state, touched).withColumn("bucket", _bucket())
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{root}/{name}")
        return state | {"base": state.get("base", {}) | dict.fromkeys(touched, name), "changes": []}

    def carry(before: State, result: State, now: State) -> State | None:
        """Changes that were added meanwhile stay on top of the new base."""
        done = before["changes"]
        if now.get("base", {}) != before.get("base", {}) or now["changes"][:len(done)] != done:
            return None
        return now | {"base": result["base"], "changes": now["changes"][len(done):]}

    return commit(spark, root, step, rebase=carry)


def feed_ledger(pages: DataFrame, base_url: str, root: str, checkpoint: str, clock: Callable[[int], float],
                name: str = "listing") -> StreamingQuery:
    """Upsert the files of new listing pages into the ledger.

    A batch is applied to the newest version, which outcomes may have written since the last
    one, and gives a new version. ``clock`` gives the time stamp of a batch. ``name`` stands
    for the stream: a stream that starts over with a new checkpoint takes another name.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        listed = listing_candidates(batch, base_url, follow_root=False)
        publish(batch.sparkSession, root, name, lambda before: upsert_rows(before, listed, clock(batch_id)), number=batch_id)

    return (pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def record_outcomes(spark: SparkSession, root: str, outcomes: DataFrame, name: str, keep_error: bool = False) -> int:
    """Apply results of finished work to the newest version; ``name`` stands for these results."""
    return publish(spark, root, name, lambda before: outcome_rows(before, outcomes, keep_error))
