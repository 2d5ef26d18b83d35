"""One-row reports as JSON and as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def write_report(report: DataFrame, folder: str) -> None:
    """Store a one-row report twice: report as JSON, and one 'name: value' line per column."""
    base = folder.rstrip("/")
    report.coalesce(1).write.mode("overwrite").json(f"{base}/json")
    lines = [F.concat(F.lit(f"{c}: "), F.coalesce(F.col(c).cast("string"), F.lit("-"))) for c in report.columns]
    report.select(F.concat_ws("\n", *lines).alias("value")).coalesce(1).write.mode("overwrite").text(f"{base}/text")
