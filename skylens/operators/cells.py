"""AG-7 / FLT-1: distinct aircraft per tumbling window x grid cell x scope (Gold).

Batch form; the streaming form with watermark lives in ``skylens.streaming.states``.
Distinct counting is planned by Catalyst as a two-level aggregate (group keys + icao24
first), so a crowded cell is spread over tasks by aircraft before the final count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skylens.functions.constants import CELL_DEGREES, DEFAULT_BOX, WINDOW_SECONDS

GOLD_COLUMNS = ("scope_id", "window_start", "window_end", "cell_lat_min", "cell_lon_min", "distinct_aircraft")


def in_box(box=DEFAULT_BOX) -> Column:
    """FLT-1: a position of a valid aircraft inside the configured box (inclusive bounds)."""
    lamin, lamax, lomin, lomax = box
    return (F.col("has_position") & ~F.array_contains("quality_flags", "invalid_icao24")
            & F.col("latitude").between(lamin, lamax) & F.col("longitude").between(lomin, lomax))


def cell_of(c: str, degrees: float = CELL_DEGREES) -> Column:
    if degrees == 1:
        return F.floor(F.col(c)).cast("long")
    return (F.floor(F.col(c) / F.lit(degrees)) * F.lit(degrees)).cast("long")


def aircraft_windows(silver: DataFrame, box=DEFAULT_BOX, *, window_seconds: int = WINDOW_SECONDS,
                     cell_degrees: float = CELL_DEGREES, time: str = "event_time") -> DataFrame:
    start = (F.floor(F.col(time) / F.lit(window_seconds)) * F.lit(window_seconds)).cast("long")
    return (silver.where(in_box(box))
            .groupBy("scope_id", start.alias("window_start"),
                     cell_of("latitude", cell_degrees).alias("cell_lat_min"),
                     cell_of("longitude", cell_degrees).alias("cell_lon_min"))
            .agg(F.count_distinct("icao24").cast("int").alias("distinct_aircraft"))
            .withColumn("window_end", F.col("window_start") + F.lit(window_seconds))
            .select(*GOLD_COLUMNS))
