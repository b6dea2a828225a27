"""AG-9..11 + JN-5: quality status counts (long, wide, enriched with labels).

Status precedence: invalid_identity > missing_position > stale_position > usable_position.
The label dimension is a fixed 4-row table, so broadcasting it is size-proven.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylens.functions.constants import QUALITY_LABELS, QUALITY_STATUSES, WINDOW_SECONDS

LABEL_SCHEMA = "quality_status string, description string, severity int"


def quality_status() -> Column:
    return (F.when(F.array_contains("quality_flags", "invalid_icao24"), F.lit("invalid_identity"))
            .when(~F.col("has_position"), F.lit("missing_position"))
            .when(F.array_contains("quality_flags", "stale_position"), F.lit("stale_position"))
            .otherwise(F.lit("usable_position")))


def quality_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(QUALITY_LABELS), LABEL_SCHEMA)


def quality_counts(silver: DataFrame, window_seconds: int = WINDOW_SECONDS) -> DataFrame:
    start = (F.floor(F.col("snapshot_time") / F.lit(window_seconds)) * F.lit(window_seconds)).cast("long")
    return (silver.select("scope_id", start.alias("window_start"), quality_status().alias("quality_status"))
            .groupBy("scope_id", "window_start", "quality_status").count())


def quality_enriched(counts: DataFrame) -> DataFrame:
    labels = quality_labels(counts.sparkSession)
    return counts.join(F.broadcast(labels), "quality_status", "left")


def quality_wide(counts: DataFrame) -> DataFrame:
    statuses = list(QUALITY_STATUSES)
    return (counts.groupBy("scope_id", "window_start").pivot("quality_status", statuses)
            .sum("count").fillna(0, subset=statuses))


def quality_long(wide: DataFrame) -> DataFrame:
    return wide.unpivot(["scope_id", "window_start"], list(QUALITY_STATUSES), "quality_status", "observations")


def quality_views(silver: DataFrame, window_seconds: int = WINDOW_SECONDS):
    """(enriched, wide, long) as in the analytics run."""
    counts = quality_counts(silver, window_seconds)
    wide = quality_wide(counts)
    return quality_enriched(counts), wide, quality_long(wide)
