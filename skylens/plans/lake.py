"""Batch Silver/Gold tables from typed state events (the batch twin of the streaming chain).

Silver is partitioned by ``event_date`` (UTC date of snapshot_time), Gold by that of window_start, so range scans of
later runs prune whole directories.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skylens.functions.columns import epoch_date
from skylens.functions.constants import DEFAULT_BOX
from skylens.operators.cells import aircraft_windows
from skylens.operators.normalize import normalize_observations, with_event_timestamp


def first_delivery(deliveries: DataFrame, key: str = "observation_id",
                   order=("topic", "partition", "offset")) -> DataFrame:
    """WN-1: the first delivery of every key by Kafka position (row_number = 1, planned as a group limit)."""
    from pyspark.sql import Window
    w = Window.partitionBy(key).orderBy(*order)
    return deliveries.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def deduplicated(observations: DataFrame, key: str = "observation_id") -> DataFrame:
    """STR-2 batch twin: one row per observation id, the same one at every run.

    The smallest by collection time and source, then by all other columns that can be ordered; the
    aggregate combines before the shuffle, so an id that is delivered very often is a row per task.
    """
    order = F.struct("collected_at", *[c for c in ("source_object", "snapshot_id") if c in observations.columns])
    rest = [c for c in observations.columns if c != key]
    kept = observations.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(order, F.xxhash64(*rest))).alias("_kept"))
    return kept.select(*[F.col(key) if c == key else F.col(f"_kept.{c}").alias(c) for c in observations.columns])


def build_lake(spark: SparkSession, state_events: DataFrame, root: str, box=DEFAULT_BOX) -> dict:
    root = root.rstrip("/")
    silver = with_event_timestamp(deduplicated(normalize_observations(state_events)))
    from skylens.plans.analytics import clustered_by_date
    (clustered_by_date(silver, "snapshot_time")
     .write.mode("errorifexists").partitionBy("event_date").parquet(root + "/silver"))
    written = spark.read.parquet(root + "/silver")
    (clustered_by_date(aircraft_windows(written, box), "window_start")
     .write.mode("errorifexists").partitionBy("event_date").parquet(root + "/gold"))
    return {"silver": root + "/silver", "gold": root + "/gold"}
