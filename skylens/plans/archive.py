"""PIPE-8: reprocess archived snapshots as Spark jobs (observations, windows, quality report, marker).

Every document is read, parsed and hashed once, into a table of its state rows; scope, identity and
the inside-box test come from each document's own bounding box.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylens.functions.constants import WINDOW_SECONDS
from skylens.operators.cells import aircraft_windows
from skylens.operators.envelope import observation_id, scope_columns
from skylens.operators.normalize import normalize_observations
from skylens.operators.reports import archive_report, flag_histogram, snapshot_gaps
from skylens.plans import fs
from skylens.plans.lake import deduplicated
from skylens.sources.snapshots import BOUNDS, archived_rows, read_snapshots


def snapshot_observations(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(delivered state events, deduplicated Silver observations, scopes with their bounds) of archived rows."""
    text, sid = scope_columns(*[F.col(b) for b in BOUNDS])
    typed = rows.where("source_row_text is not null").select(
        sid.alias("scope_id"), observation_id(text, F.col("snapshot_time"), F.col("source_row_text")).alias("observation_id"),
        F.concat(F.lit("opensky:"), text, F.lit(":"), F.col("snapshot_time").cast("string")).alias("snapshot_id"),
        "snapshot_time", F.col("snapshot_time").alias("event_time"), F.lit("snapshot_time").alias("event_time_basis"), "collected_at",
        F.struct(F.lit("archive").alias("bucket"), F.col("path").alias("key"), F.col("source_sha256").alias("sha256")).alias("source_object"),
        "state")
    scopes = rows.select(sid.alias("scope_id"), *BOUNDS).distinct()
    return typed, normalize_observations(deduplicated(typed)), scopes


def bounds() -> tuple[Column, ...]:
    """A row's own box, for ``in_box``."""
    return tuple(F.col(b) for b in BOUNDS)


def reprocess_archive(spark: SparkSession, snapshot_path: str, output: str, *, expected_interval: int = 120) -> dict:
    output = output.rstrip("/")
    if fs.exists(spark, output):
        raise FileExistsError(f"{output} exists")
    archived_rows(read_snapshots(spark, snapshot_path)).write.parquet(output + "/_rows")
    rows = spark.read.parquet(output + "/_rows")
    bad = rows.agg(F.count_if(~F.col("intact")).alias("altered"), F.count_if(F.col("row_error").isNotNull()).alias("malformed")).first()
    if bad["altered"] or bad["malformed"]:
        raise ValueError(f"archive refused: {bad['altered']} rows of altered documents, {bad['malformed']} rows that are no state vector")
    deliveries, observations, scopes = snapshot_observations(rows)
    observations.write.parquet(output + "/observations")
    observations = spark.read.parquet(output + "/observations")
    placed = observations.join(scopes, "scope_id")
    aircraft_windows(placed, bounds()).write.parquet(output + "/aircraft_windows")
    report = {row["metric"]: row["value"] for row in archive_report(deliveries, placed, bounds()).collect()}
    documents = rows.groupBy("path").agg(F.count("source_row_text").alias("n"))
    totals = documents.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("n") == 0).alias("empty")).first()
    report |= {"snapshots": totals["n"], "empty_snapshots": totals["empty"]}
    flags = {row["flag"]: row["observations"] for row in flag_histogram(observations).collect()}
    # Gaps grow with the archive's length, so they are a table, not part of the JSON report.
    text, sid = scope_columns(*bounds())
    snapshot_gaps(rows.select(sid.alias("scope_id"), "snapshot_time"), expected_interval).write.parquet(output + "/snapshot_gaps")
    gap_count = spark.read.parquet(output + "/snapshot_gaps").count()
    quality = {"schema_version": 1, "counts": report, "quality_flags": flags, "snapshot_gap_count": gap_count,
               "expected_interval_seconds": expected_interval, "cell_degrees": 1, "window_seconds": WINDOW_SECONDS}
    fs.write_text(spark, output + "/quality.json", json.dumps(quality, indent=2, default=str))
    fs.delete(spark, output + "/_rows")
    fs.write_text(spark, output + "/_SUCCESS", "complete\n")
    return quality
