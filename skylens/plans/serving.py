"""PIPE-9 / PIPE-10: serving views over committed lake tables and scheduled recent analytics."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.operators.serving import overview_windows, recent_cells, recent_movement
from skylens.plans.analytics import RunConfig, latest_signature, recent_config, run_from_lake
from skylens.plans.publish import committed_table, latest_completed_run

GOLD_SCHEMA = ("scope_id string, window_start long, window_end long, cell_lat_min long, cell_lon_min long, "
               "distinct_aircraft int")


def serving_view(spark: SparkSession, root: str, analytics_prefix: str, silver_schema: str,
                 hours: int = 24) -> dict[str, DataFrame]:
    """windows / cells / movement DataFrames of the last ``hours``, sorted for serving."""
    root = root.rstrip("/")
    silver = committed_table(spark, root + "/silver", silver_schema)
    gold = committed_table(spark, root + "/gold", GOLD_SCHEMA)
    view = {"windows": overview_windows(silver, hours).orderBy("scope_id", "window_start"),
            "cells": recent_cells(gold, silver, hours).orderBy("scope_id", "window_start", "cell_lat_min",
                                                             "cell_lon_min")}
    run = latest_completed_run(spark, analytics_prefix)
    if run:
        view["movement"] = recent_movement(spark.read.parquet(run + "/movement"), silver, hours) \
            .orderBy("scope_id", "icao24", "time_position")
    return view


def run_recent(spark: SparkSession, root: str, output_prefix: str, hours: int = 24,
               previous: tuple | None = None) -> tuple[tuple, dict | None]:
    """PIPE-10: run analytics over the last ``hours`` only when (latest, count) changed."""
    if not 1 <= hours <= 168:
        raise ValueError("hours must be 1-168")
    signature = latest_signature(spark.read.parquet(root.rstrip("/") + "/silver"))
    if signature[0] is None or signature == previous:
        return signature, None
    config = recent_config(signature, f"{output_prefix.rstrip('/')}/recent-{uuid.uuid4().hex}", hours)
    return signature, run_from_lake(spark, root, config)
