"""The work ledger made from the events: one event is one file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fraclake.functions.paths import (ERROR_LENGTH, download_path, failure_status, output_path, retry_delay,
                                      short_error)
from fraclake.operators import ledger as work
from fraclake.plans.inputs import table

HOST = "https://files.example.org"
#: 2024-01-16 and 2024-01-20, 00:00 UTC.
SPLIT = 1705363200
NOW = 1705708800.0
STATUS = {"signup": "PENDING", "view": "DOWNLOADING", "click": "SKETCHING", "purchase": "DONE", "error": "ERROR"}


def _seconds() -> Column:
    """Whole seconds of the zone-less event time, whatever the session's zone."""
    return (F.unix_date(F.to_date("ts")).cast("bigint") * 86400 + F.hour("ts") * 3600 + F.minute("ts") * 60
            + F.second("ts"))


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger, with the event's time ``t`` and whole ``v`` value."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    named = events.select(
        F.col("event_id").alias("id"), F.upper(F.substring(F.md5(F.col("user_id").cast("string")), 1, 3)).alias("subdir"),
        F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])[F.col("event_type")].alias("status"),
        F.floor("value").cast("bigint").alias("v"), _seconds().alias("t"))
    named = named.withColumn("filename", F.concat(F.lit("wgs."), "subdir", F.lpad(F.col("id").cast("string"), 8, "0"),
                                                  F.lit(".1.fsa_nt.gz")))
    named = named.withColumn("url", F.concat_ws("/", F.lit(HOST), "subdir", "filename"))
    tries = (F.col("v") % 25).cast("int")
    message = F.when(tries % 4 == 0, F.concat(F.lit("HTTP 404 for "), "url")).otherwise(
        F.concat(F.lit("sketch failed: "), F.repeat(F.col("filename"), 30)))
    return named.select(
        "id", "subdir", "filename", "url", F.lit(None).cast("bigint").alias("size"),
        F.lit(None).cast("string").alias("mtime"), "status", tries.alias("tries"),
        F.when(F.col("status") == "ERROR", message).alias("last_error"),
        F.when(F.col("status") == "DONE", F.concat(F.lit("out/"), "filename")).alias("out_path"),
        F.when(tries % 7 != 0, F.col("t").cast("double")).alias("updated_at"),
        (F.col("t") - 3600).cast("double").alias("created_at"), "t", "v")


def ledger_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_files(spark, sf_dir).drop("t", "v")


def _listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file listed twice, the second listing (seq 1) being the newer one."""
    files = event_files(spark, sf_dir)
    return files.select("subdir", "filename", F.concat("url", F.lit("?v=2")).alias("url"),
                        F.explode(F.sequence(F.lit(0), F.lit(1))).alias("seq"), "v", F.col("t").cast("string").alias("mtime")
                        ).select("subdir", "filename", "url", (F.col("v") + F.col("seq")).alias("size"), "mtime", "seq")


def ledger_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = event_files(spark, sf_dir).where(F.col("t") < SPLIT).drop("t", "v")
    return work.upsert(before, _listed(spark, sf_dir), NOW, order="seq")


def ledger_requeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.requeue_stale(ledger_table(spark, sf_dir), NOW)


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in progress report up to three results: two failures, then perhaps success."""
    files = event_files(spark, sf_dir).where(F.col("status").isin(*work.IN_PROGRESS))
    text = F.when(F.col("v") % 5 == 0, F.concat(F.lit("HTTP 404 for "), "url")).otherwise("timeout")
    failed = files.select("id", F.explode(F.array(F.lit(10), F.lit(20))).alias("after"), "t", "v",
                          failure_status(text).alias("status"), F.lit(None).cast("string").alias("out_path"),
                          short_error(text).alias("error"), F.lit(True).alias("inc_tries"))
    done = files.where(F.col("v") % 3 == 0).select(
        "id", F.lit(30).alias("after"), "t", "v", F.lit("DONE").alias("status"),
        F.concat(F.lit("out/"), "filename").alias("out_path"), F.lit(None).cast("string").alias("error"),
        F.lit(False).alias("inc_tries"))
    return failed.unionByName(done).select("id", "status", "out_path", "error", "inc_tries",
                                           (F.col("t") + F.col("after")).cast("double").alias("ts"))


def _apply(keep_error: bool):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return work.apply_outcomes(ledger_table(spark, sf_dir), _outcomes(spark, sf_dir), keep_error)
    return query


def ledger_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.outcome_tally(_outcomes(spark, sf_dir))


def ledger_claimed(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = ledger_table(spark, sf_dir)
    return work.mark_claimed(files, work.claim_plan(files, NOW, 500), NOW)


def skip_done(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which waiting files have been produced already? Outputs of every third value exist."""
    files = event_files(spark, sf_dir)
    made = files.where(F.col("v") % 3 == 0).select(output_path("sketches", "subdir", "filename").alias("path"))
    waiting = files.where(F.col("status") == "PENDING").drop("t", "v")
    return work.with_produced(waiting, made, "sketches", output_path).select("id", "path", "produced")


def output_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths, failure classes and retry delays; files with an even value have no sub-directory."""
    files = event_files(spark, sf_dir)
    subdir = F.when(F.col("v") % 2 == 0, "").otherwise(F.col("subdir"))
    return files.select("id", output_path("sketches", subdir, "filename").alias("sketch_path"),
                        download_path("tmp", subdir, "filename").alias("tmp_path"),
                        F.when(F.col("last_error").isNotNull(), failure_status("last_error")).alias("failure"),
                        short_error("last_error").alias("error"), retry_delay("tries").alias("delay"))


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return work.with_eligibility(ledger_table(spark, sf_dir)).select("id", "attempts_left", "next_retry_at", "retry_delay")


def _over(operation):
    return lambda spark, sf_dir: operation(ledger_table(spark, sf_dir))


QUERIES = {
    "ledger_rows": _over(lambda files: files),
    "ledger_status": _over(work.status_counts),
    "ledger_unfinished_counts": _over(work.unfinished_counts),
    "ledger_next_batch": _over(work.next_batch),
    "ledger_unfinished": _over(work.unfinished),
    "ledger_outcomes": ledger_outcomes,
    "ledger_upsert": ledger_upsert,
    "ledger_requeue": ledger_requeue,
    "ledger_apply": _apply(False),
    "ledger_apply_keep_error": _apply(True),
    "ledger_claimed": ledger_claimed,
    "claim_plan": _over(lambda files: work.claim_plan(files, NOW, 500)),
    "claim_plan_all": _over(lambda files: work.claim_plan(files.where("status = 'ERROR'"), NOW, 300)),
    "candidate_union": _over(lambda files: work.candidates(files, NOW)),
    "candidate_union_limited": _over(lambda files: work.candidates(files, NOW, limit=200)),
    "eligibility": eligibility,
    "skip_done": skip_done,
    "output_paths": output_paths,
}

_CASES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS.items())
FILES = f"""(
  SELECT id, subdir, filename, url, NULL::BIGINT AS size, NULL::VARCHAR AS mtime, status, tries,
         CASE WHEN status = 'ERROR' THEN CASE WHEN tries % 4 = 0 THEN 'HTTP 404 for ' || url
              ELSE 'sketch failed: ' || repeat(filename, 30) END END AS last_error,
         CASE WHEN status = 'DONE' THEN 'out/' || filename END AS out_path,
         CASE WHEN tries % 7 <> 0 THEN t::DOUBLE END AS updated_at, (t - 3600)::DOUBLE AS created_at, t, v
  FROM (SELECT *, '{HOST}/' || subdir || '/' || filename AS url, (v % 25)::INTEGER AS tries FROM (
    SELECT *, 'wgs.' || subdir || lpad(id::VARCHAR, 8, '0') || '.1.fsa_nt.gz' AS filename FROM (
      SELECT event_id AS id, upper(substr(md5(user_id::VARCHAR), 1, 3)) AS subdir,
             CASE event_type {_CASES} END AS status, floor(value)::BIGINT AS v, floor(epoch(ts))::BIGINT AS t
      FROM events))))"""
_ROW = "id, subdir, filename, url, size, mtime, status, tries, last_error, out_path, updated_at, created_at"
_RETRY = f"status = 'ERROR' AND tries < 20 AND (updated_at IS NULL OR updated_at <= {NOW - 1800.0})"
_PROGRESS = "status IN ('DOWNLOADING', 'SKETCHING')"
_TEXT = "CASE WHEN v % 5 = 0 THEN 'HTTP 404 for ' || url ELSE 'timeout' END"
_OUTCOMES = f"""(
  SELECT id, CASE WHEN v % 5 = 0 THEN 'GONE' ELSE 'ERROR' END AS status, NULL AS out_path,
         substr({_TEXT}, 1, {ERROR_LENGTH}) AS error, true AS inc_tries, (t + a)::DOUBLE AS ts
  FROM {FILES}, (VALUES (10), (20)) AS x(a) WHERE {_PROGRESS} UNION ALL
  SELECT id, 'DONE', 'out/' || filename, NULL, false, (t + 30)::DOUBLE FROM {FILES} WHERE {_PROGRESS} AND v % 3 = 0)"""
_SHARD = "coalesce(nullif(CASE WHEN v % 2 = 0 THEN '' ELSE subdir END, ''), substr(split_part(filename, '.', 2), 1, 3))"


def _sql_apply(path: str, error: str) -> str:
    return f"""
      WITH o AS (SELECT id, arg_max(status, ts) AS s, arg_max(coalesce(out_path, '-'), ts) AS p,
                        arg_max(coalesce(error, '-'), ts) AS e, max(ts) AS ts,
                        count(*) FILTER (inc_tries) AS more FROM {_OUTCOMES} GROUP BY id)
      SELECT f.id, subdir, filename, url, size, mtime, coalesce(s, status) AS status,
             (tries + coalesce(more, 0))::INTEGER AS tries,
             CASE WHEN s IS NULL THEN last_error ELSE {error} END AS last_error,
             CASE WHEN s IS NULL THEN out_path ELSE {path} END AS out_path,
             coalesce(o.ts, updated_at) AS updated_at, created_at
      FROM {FILES} f LEFT JOIN o USING (id)"""


_CLAIM = f"""SELECT id, subdir, filename, url, status FROM {FILES}
      WHERE status = 'PENDING' OR ({_RETRY})
      ORDER BY status = 'ERROR', CASE WHEN status = 'ERROR' THEN updated_at END NULLS FIRST, id"""
_CANDIDATES = f"SELECT id, subdir, filename, url FROM {FILES} WHERE status = 'PENDING' OR ({_RETRY}) ORDER BY id"

ORACLES = {
    "ledger_rows": f"SELECT {_ROW} FROM {FILES}",
    "ledger_status": f"SELECT status, count(*) AS files FROM {FILES} GROUP BY ROLLUP (status)",
    "ledger_unfinished_counts": f"""
      SELECT count(*) FILTER (status <> 'DONE') AS unfinished,
             count(*) FILTER (status = 'ERROR' AND tries >= 20) AS exhausted FROM {FILES}""",
    "ledger_next_batch": f"""
      SELECT id, subdir, filename, url FROM {FILES} WHERE status IN ('PENDING', 'ERROR') ORDER BY id LIMIT 1000""",
    "ledger_unfinished": f"""
      SELECT id, subdir, filename, url, status FROM {FILES} WHERE status <> 'DONE' ORDER BY id LIMIT 100""",
    "ledger_outcomes": f"""
      SELECT count(*) FILTER (status = 'DONE') AS done, count(*) FILTER (status = 'GONE') AS gone,
             count(*) FILTER (status = 'ERROR') AS error FROM {_OUTCOMES}""",
    "ledger_upsert": f"""
      WITH f AS (SELECT * FROM {FILES}), top AS (SELECT coalesce(max(id), 0) AS last FROM f WHERE t < {SPLIT})
      SELECT id, subdir, filename, url || '?v=2' AS url, v + 1 AS size, t::VARCHAR AS mtime, status, tries, last_error,
             out_path, {NOW}::DOUBLE AS updated_at, created_at FROM f WHERE t < {SPLIT}
      UNION ALL
      SELECT last + row_number() OVER (ORDER BY md5(subdir || '/' || filename)), subdir, filename, url || '?v=2',
             v + 1, t::VARCHAR, 'PENDING', 0::INTEGER, NULL, NULL, {NOW}, {NOW} FROM f, top WHERE t >= {SPLIT}""",
    "ledger_requeue": f"""
      WITH f AS (SELECT *, {_PROGRESS} AND (updated_at IS NULL OR updated_at < {NOW - 3600.0}) AS stale FROM {FILES})
      SELECT id, subdir, filename, url, size, mtime, CASE WHEN stale THEN 'PENDING' ELSE status END AS status, tries,
             last_error, out_path, CASE WHEN stale THEN {NOW}::DOUBLE ELSE updated_at END AS updated_at, created_at FROM f""",
    "ledger_apply": _sql_apply("nullif(p, '-')", "nullif(e, '-')"),
    "ledger_apply_keep_error": _sql_apply("coalesce(nullif(p, '-'), out_path)", "coalesce(nullif(e, '-'), last_error)"),
    "ledger_claimed": f"""
      WITH c AS ({_CLAIM} LIMIT 500)
      SELECT f.id, f.subdir, f.filename, f.url, size, mtime, CASE WHEN c.id IS NULL THEN f.status ELSE 'DOWNLOADING' END AS status,
             tries, last_error, out_path, CASE WHEN c.id IS NULL THEN updated_at ELSE {NOW}::DOUBLE END AS updated_at, created_at
      FROM {FILES} f LEFT JOIN c ON c.id = f.id""",
    "claim_plan": f"{_CLAIM} LIMIT 500",
    "claim_plan_all": f"SELECT * FROM ({_CLAIM.replace('''status = 'PENDING' OR''', '')} LIMIT 300)",
    "candidate_union": _CANDIDATES,
    "candidate_union_limited": f"{_CANDIDATES} LIMIT 200",
    "eligibility": f"""
      SELECT id, greatest(20 - tries, 0)::INTEGER AS attempts_left,
             CASE WHEN status = 'ERROR' THEN updated_at + 1800 END AS next_retry_at,
             least(300, pow(2, tries))::INTEGER AS retry_delay FROM {FILES}""",
    "skip_done": f"""
      SELECT id, 'sketches/' || subdir || '/' || filename || '.sig.zip' AS path, v % 3 = 0 AS produced
      FROM {FILES} WHERE status = 'PENDING'""",
    "output_paths": f"""
      SELECT id, 'sketches/' || {_SHARD} || '/' || filename || '.sig.zip' AS sketch_path,
             'tmp/' || {_SHARD} || '/' || filename AS tmp_path,
             CASE WHEN contains(last_error, 'HTTP 404') THEN 'GONE' WHEN last_error IS NOT NULL THEN 'ERROR' END AS failure,
             substr(last_error, 1, {ERROR_LENGTH}) AS error, least(300, pow(2, tries))::INTEGER AS delay FROM {FILES}""",
}
