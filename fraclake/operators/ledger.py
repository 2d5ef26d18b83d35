"""The work ledger as DataFrame transitions: each returns the next version of the table.

The current time is always an argument, so a job that runs again gives the same rows.
Latest-per-key choices are aggregates, not windows: an aggregate combines rows before
the shuffle, so a key with very many updates never gathers in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fraclake.functions.paths import retry_delay
from fraclake.shared import stored
from fraclake.types import LEDGER

IN_PROGRESS = ("DOWNLOADING", "SKETCHING")
UNFINISHED = ("PENDING", "ERROR") + IN_PROGRESS

#: Fixed retry settings.
ERROR_COOLDOWN = 1800.0
ERROR_MAX_TRIES = 20
STALE_SECONDS = 3600.0

_KEY = ["subdir", "filename"]
_COLUMNS = [f.name for f in LEDGER.fields]


def latest_listing(listed: DataFrame, order: str | None = None) -> DataFrame:
    """One row per (subdir, filename): the last by ``order``, ties broken by content."""
    content = F.struct("url", "size", "mtime")
    rank = F.struct(F.col(order), content) if order else content
    return (listed.groupBy(*_KEY).agg(F.max(F.struct(rank.alias("_rank"), content.alias("_row"))).alias("_last"))
            .select(*_KEY, "_last._row.*"))


def upsert(ledger: DataFrame, listed: DataFrame, now: float, order: str | None = None,
           touch: bool = True) -> DataFrame:
    """Add listed files as PENDING; refresh url, size and mtime of known ones.

    Status, tries and creation time of known files stay. Their ``updated_at`` is set
    to ``now``, which also restarts retry and stale clocks; ``touch=False`` leaves it.
    """
    seen = latest_listing(listed, order).select(
        *_KEY, F.col("url").alias("_url"), F.col("size").alias("_size"), F.col("mtime").alias("_mtime"),
        F.lit(True).alias("_listed"))
    # one join says which rows stay, are refreshed, and are new; the new ones are numbered apart
    joined = stored(ledger.withColumn("_known", F.lit(True)).join(seen, _KEY, "full_outer"), "ledger-listing")
    listed_now = F.col("_listed").isNotNull()

    def fresh(new: str, old: str) -> Column:
        return F.when(listed_now, F.col(new)).otherwise(F.col(old)).alias(old)

    stamp = F.lit(float(now)) if touch else F.col("updated_at")
    kept = joined.where("_known").select(
        "id", *_KEY, fresh("_url", "url"), fresh("_size", "size"), fresh("_mtime", "mtime"),
        "status", "tries", "last_error", "out_path",
        F.when(listed_now, stamp).otherwise(F.col("updated_at")).alias("updated_at"), "created_at")
    new = _new_rows(joined.where("_known IS NULL"), joined.where("_known"), now)
    return kept.select(*_COLUMNS).unionByName(new)


def upsert_rows(ledger: DataFrame, listed: DataFrame, now: float, order: str | None = None, touch: bool = True) -> DataFrame:
    """Only the rows that ``upsert`` refreshes or adds, for a ledger that takes changes as rows.

    The ledger is read once and stays in place where the listing is small: Spark sends
    the listing to it.
    """
    seen = latest_listing(listed, order).select(*_KEY, *[F.col(c).alias(f"_{c}") for c in ("url", "size", "mtime")])
    known = stored(ledger.join(seen, _KEY), "known-files")
    stamp = F.lit(float(now)) if touch else F.col("updated_at")
    kept = known.withColumns({"url": F.col("_url"), "size": F.col("_size"), "mtime": F.col("_mtime"), "updated_at": stamp})
    new = _new_rows(seen.join(known.select(*_KEY), _KEY, "left_anti"), ledger, now)
    return kept.select(*_COLUMNS).unionByName(new)


def _new_rows(listed: DataFrame, ledger: DataFrame, now: float) -> DataFrame:
    """Files that are waiting, with ids after those of the ledger."""
    added = _numbered(listed.select(*_KEY, "_url", "_size", "_mtime"), ledger)
    new = added.select("id", *_KEY, F.col("_url").alias("url"), F.col("_size").alias("size"),
                       F.col("_mtime").alias("mtime"), F.lit("PENDING").alias("status"),
                       F.lit(0).alias("tries"), F.lit(None).cast("string").alias("last_error"),
                       F.lit(None).cast("string").alias("out_path"), F.lit(float(now)).alias("updated_at"),
                       F.lit(float(now)).alias("created_at"))
    return new.select(*_COLUMNS)


def _numbered(new: DataFrame, ledger: DataFrame) -> DataFrame:
    """Give new files consecutive ids after the largest one in use.

    Ids follow the order of the md5 of the key. Its first four digits split the files
    into at most 65,536 even groups: positions are found within each group, and a
    running total over the group sizes, a table of bounded size, gives the offsets.
    """
    keyed = new.withColumn("_md5", F.md5(F.concat_ws("/", *_KEY))).withColumn("_group", F.substring("_md5", 1, 4))
    sizes = keyed.groupBy("_group").agg(F.count(F.lit(1)).alias("_size_of"))
    ahead = F.sum("_size_of").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("_group", F.coalesce(ahead, F.lit(0)).alias("_offset"))
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_md5", *_KEY))
    last = ledger.agg(F.coalesce(F.max("id"), F.lit(0)).alias("last")).scalar()
    placed = keyed.withColumn("_place", place).join(F.broadcast(offsets), "_group")  # at most 65,536 rows
    return placed.withColumn(
        "id", last + F.col("_offset") + F.col("_place"))


def requeue_stale(ledger: DataFrame, now: float, stale_seconds: float = STALE_SECONDS) -> DataFrame:
    """Put rows back to PENDING that have been in progress for too long."""
    stale = F.col("status").isin(*IN_PROGRESS) & (
        F.col("updated_at").isNull() | (F.col("updated_at") < float(now - stale_seconds)))
    return ledger.select(*[
        F.when(stale, F.lit("PENDING")).otherwise(F.col(c)).alias(c) if c == "status" else
        F.when(stale, F.lit(float(now))).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c)
        for c in _COLUMNS])


def apply_outcomes(ledger: DataFrame, outcomes: DataFrame, keep_error: bool = False) -> DataFrame:
    """Record results: the last outcome of a row decides, every failed try counts.

    Outcomes with the same time are ordered by status, DONE last, so that a success is never
    hidden by a failure. Status, out_path and last_error are overwritten, also with NULL. ``keep_error``
    is the other convention in use: success leaves the error text alone and failure
    leaves out_path alone.
    """
    return _with_outcomes(ledger, outcomes, keep_error, "left")


def outcome_rows(ledger: DataFrame, outcomes: DataFrame, keep_error: bool = False) -> DataFrame:
    """Only the rows that ``apply_outcomes`` changes."""
    return _with_outcomes(ledger, outcomes, keep_error, "inner")


def _with_outcomes(ledger: DataFrame, outcomes: DataFrame, keep_error: bool, how: str) -> DataFrame:
    result = F.struct("ts", (F.col("status") == "DONE").alias("won"), "status", "out_path", "error")
    last = outcomes.groupBy("id").agg(F.max(result).alias("_o"), F.count_if("inc_tries").alias("_more"))
    joined = ledger.join(last, "id", how)
    done = F.col("_o").isNotNull()
    path, error = F.col("_o.out_path"), F.col("_o.error")
    if keep_error:
        path, error = F.coalesce(path, F.col("out_path")), F.coalesce(error, F.col("last_error"))
    changed = {
        "status": F.when(done, F.col("_o.status")).otherwise(F.col("status")),
        "out_path": F.when(done, path).otherwise(F.col("out_path")),
        "last_error": F.when(done, error).otherwise(F.col("last_error")),
        "tries": (F.col("tries") + F.coalesce("_more", F.lit(0))).cast("int"),
        "updated_at": F.when(done, F.col("_o.ts")).otherwise(F.col("updated_at")),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in _COLUMNS])


def next_batch(ledger: DataFrame, limit: int = 1000) -> DataFrame:
    """The first waiting or failed rows by id."""
    return (ledger.where(F.col("status").isin("PENDING", "ERROR")).orderBy("id").limit(limit)
            .select("id", "subdir", "filename", "url"))


def unfinished(ledger: DataFrame, limit: int = 100) -> DataFrame:
    """The first rows that are not finished, with their status."""
    return (ledger.where(F.col("status").isin(*UNFINISHED)).orderBy("id").limit(limit)
            .select("id", "subdir", "filename", "url", "status"))


def with_eligibility(ledger: DataFrame, cooldown: float = ERROR_COOLDOWN,
                     max_tries: int = ERROR_MAX_TRIES) -> DataFrame:
    """Add attempts_left, next_retry_at (end of the cooldown) and retry_delay."""
    return ledger.select(
        "*", F.greatest(F.lit(max_tries) - F.col("tries"), F.lit(0)).alias("attempts_left"),
        F.when(F.col("status") == "ERROR", F.col("updated_at") + F.lit(float(cooldown))).alias("next_retry_at"),
        retry_delay("tries").alias("retry_delay"))


def _retryable(now: float, cooldown: float, max_tries: int) -> Column:
    return (F.col("status") == "ERROR") & (F.col("tries") < max_tries) & (
        F.col("updated_at").isNull() | (F.col("updated_at") <= float(now - cooldown)))


def claim_plan(ledger: DataFrame, now: float, limit: int, cooldown: float = ERROR_COOLDOWN,
               max_tries: int = ERROR_MAX_TRIES) -> DataFrame:
    """The next ``limit`` rows to work on, in order.

    Waiting rows by id come first, then failed rows that have cooled down and have
    tries left, longest untouched first and never touched before all.
    """
    retry = _retryable(now, cooldown, max_tries)
    ready = ledger.where((F.col("status") == "PENDING") | retry)
    late = F.when(F.col("status") == "ERROR", F.col("updated_at"))
    order = [(F.col("status") == "ERROR").asc(), late.asc_nulls_first(), F.col("id").asc()]
    return ready.orderBy(*order).limit(limit).select("id", "subdir", "filename", "url", "status")


def mark_claimed(ledger: DataFrame, claimed: DataFrame, now: float) -> DataFrame:
    """Set the claimed rows to DOWNLOADING."""
    marked = ledger.join(claimed.select("id", F.lit(True).alias("_c")), "id", "left")
    taken = F.col("_c").isNotNull()
    return marked.select(*[
        F.when(taken, F.lit("DOWNLOADING")).otherwise(F.col(c)).alias(c) if c == "status" else
        F.when(taken, F.lit(float(now))).otherwise(F.col(c)).alias(c) if c == "updated_at" else F.col(c)
        for c in _COLUMNS])


def candidates(ledger: DataFrame, now: float, cooldown: float = ERROR_COOLDOWN,
               max_tries: int = ERROR_MAX_TRIES, limit: int | None = None) -> DataFrame:
    """Waiting rows and retryable failed rows together, by id; optionally the first few."""
    ready = ledger.where((F.col("status") == "PENDING") | _retryable(now, cooldown, max_tries))
    ordered = ready.select("id", "subdir", "filename", "url").orderBy("id")
    return ordered.limit(limit) if limit else ordered


def with_produced(ledger: DataFrame, produced: DataFrame, root: str, path_of) -> DataFrame:
    """The ledger with the expected output of each row (path) and whether it exists (produced).

    ``produced`` lists existing outputs (path), for instance of found archives;
    ``path_of`` builds the expected one, so ``root`` must be spelled as in the listing
    (Spark lists local files as ``file:/...``).
    """
    expected = ledger.withColumn("path", path_of(root, "subdir", "filename"))
    known = produced.select("path").distinct().withColumn("_produced", F.lit(True))
    joined = expected.join(known, "path", "left")
    return joined.withColumn("produced", F.col("_produced").isNotNull()).drop("_produced")


def status_counts(ledger: DataFrame) -> DataFrame:
    """Rows per status and in total (NULL status)."""
    return ledger.rollup("status").agg(F.count(F.lit(1)).alias("files"))


def unfinished_counts(ledger: DataFrame, max_tries: int = ERROR_MAX_TRIES) -> DataFrame:
    """Unfinished rows, and how many of them are failed with no tries left."""
    open_row = F.col("status").isin(*UNFINISHED)
    spent = (F.col("status") == "ERROR") & (F.col("tries") >= max_tries)
    return ledger.agg(F.count_if(open_row).alias("unfinished"), F.count_if(spent).alias("exhausted"))


def outcome_tally(outcomes: DataFrame) -> DataFrame:
    """One row with the number of DONE, GONE and ERROR results."""
    status = F.col("status")
    return outcomes.agg(F.count_if(status == "DONE").alias("done"), F.count_if(status == "GONE").alias("gone"),
                        F.count_if(~status.isin("DONE", "GONE")).alias("error"))
