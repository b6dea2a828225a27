"""PIPE-7 / SNK-6 / FLT-6 / AG-16 / PIPE-10: reproducible analytics runs.

A run reads Silver over a half-open range [start, end) and Gold over
[start - baseline, end) (so the first window has history), writes six tables
partitioned by ``event_date`` into a new directory, records row counts and executed
plans, and writes ``_SUCCESS`` last.  Derived tables are read back from what was
written (``gaps`` from ``movement``, ``quality_wide`` from ``quality``,
``quality_long`` from ``quality_wide``), which cuts lineage: a lost executor
re-reads a finished table instead of recomputing the whole chain.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from skylens.functions.columns import epoch_date
from skylens.functions.constants import BASELINE_SECONDS, GAP_SECONDS, MAX_SPEED_MPS, WINDOW_SECONDS
from skylens.operators.density import density_statistics
from skylens.operators.movement import movement_segments, observation_gaps
from skylens.operators.quality import quality_counts, quality_enriched, quality_long, quality_wide
from skylens.operators.serving import TimeRange
from skylens.plans import fs
from skylens.plans.publish import Version

LIMITATIONS = ["a segment never looks beyond the first and last position of its run",
               "a cell without aircraft has no row, so baselines skip it",
               "a track is what was received; where a flight began or ended isn't known"]


@dataclass(frozen=True)
class RunConfig:
    """FLT-6: where a run goes, the windows it covers and its thresholds; wrong ones are refused at once."""
    output: str
    start: int
    end: int
    gap_seconds: int = GAP_SECONDS
    max_speed_mps: float = MAX_SPEED_MPS
    baseline_seconds: int = BASELINE_SECONDS

    def __post_init__(self):
        TimeRange(self.start, self.end)
        for name in ("gap_seconds", "max_speed_mps", "baseline_seconds"):
            if not 0 < getattr(self, name) < math.inf:
                raise ValueError(f"{name} is {getattr(self, name)}, but has to be above 0 and finite")


def in_range(df: DataFrame, column: str, start: int, end: int) -> DataFrame:
    """SRC-4: half-open range kept adjacent to the scan (pushed to Parquet, prunes event_date)."""
    out = df.where((F.col(column) >= start) & (F.col(column) < end))
    if "event_date" in df.columns:
        out = out.where(F.col("event_date").between(epoch_date(F.lit(start)), epoch_date(F.lit(end - 1))))
    return out


def clustered_by_date(frame: DataFrame, time_column: str) -> DataFrame:
    """Add ``event_date`` and rebalance by it before a date-partitioned write.

    The REBALANCE exchange groups rows of one date into few tasks, so a task writes files for
    one date instead of one file per (task x date); AQE splits a date larger than the advisory
    partition size over several tasks and merges small ones, so files stay well sized at any
    scale and no task receives a whole busy date.
    """
    return frame.withColumn("event_date", epoch_date(time_column)).hint("rebalance", "event_date")


class AnalyticsRun(Version):
    """SNK-6: a version whose tables are laid out by date and keep their plans and times."""

    def __init__(self, spark: SparkSession, config: RunConfig, silver: DataFrame, gold: DataFrame):
        super().__init__(spark, config.output)
        self.config = config
        self.silver = in_range(silver, "snapshot_time", config.start, config.end)
        # windows before the range only serve as history
        self.gold = in_range(gold, "window_start", config.start - config.baseline_seconds, config.end)
        self.seconds: dict[str, float] = {}

    def note(self, name: str, document) -> None:
        text = document if isinstance(document, str) else json.dumps(document, indent=2, sort_keys=True)
        fs.write_text(self.spark, f"{self.output}/{name}", text)

    def add(self, name: str, frame: DataFrame) -> DataFrame:
        """Written by date of its rows' time; its rows are counted on the way."""
        begun, seen, path = time.perf_counter(), Observation(), f"{self.output}/{name}"
        dated = clustered_by_date(frame.observe(seen, F.count(F.lit(1)).alias("rows")), TIME_OF[name])
        dated.write.partitionBy("event_date").parquet(path)
        self.note(f"{name}-plan.txt", frame._jdf.queryExecution().executedPlan().toString())
        self.tables[name] = {"path": path, "row_count": seen.get["rows"]}
        self.seconds[name] = round(time.perf_counter() - begun, 3)
        return self.read(name)

    def stored(self, name: str) -> DataFrame:
        return self.read(name).drop("event_date")

    def report(self) -> dict:
        return {"source_observations": self.silver.count(), "counts": {name: t["row_count"] for name, t in self.tables.items()},
                "seconds": self.seconds, "time_basis": "rows by snapshot time, segments by position time", "limitations": LIMITATIONS}


#: The tables of a run in the order in which they rest on each other, and the column that dates their rows.
STEPS: tuple[tuple[str, str, Callable[[AnalyticsRun], DataFrame]], ...] = (
    ("movement", "snapshot_time", lambda run: movement_segments(run.silver, run.config.gap_seconds, run.config.max_speed_mps)),
    ("gaps", "snapshot_time", lambda run: observation_gaps(run.stored("movement"))),
    ("density", "window_start", lambda run: density_statistics(run.gold, run.config.baseline_seconds).where(F.col("window_start") >= run.config.start)),
    ("quality", "window_start", lambda run: quality_enriched(quality_counts(run.silver))),
    ("quality_wide", "window_start", lambda run: quality_wide(run.stored("quality").select("scope_id", "window_start", "quality_status", "count"))),
    ("quality_long", "window_start", lambda run: quality_long(run.stored("quality_wide"))),
)
TABLES = tuple(name for name, _, _ in STEPS)
TIME_OF = {name: column for name, column, _ in STEPS}


def run_analytics(spark: SparkSession, silver: DataFrame, gold: DataFrame, config: RunConfig) -> dict:
    """PIPE-7: one immutable run of six tables; returns its report, which is kept with it.

    An output that exists is refused, as is a range without observations; a run that fails has no marker.
    """
    with AnalyticsRun(spark, config, silver, gold) as run:
        run.note("run-config.json", asdict(config))
        if run.silver.isEmpty():
            raise ValueError(f"no observation lies in [{config.start}, {config.end})")
        for name, _, made in STEPS:
            run.add(name, made(run))
        report = run.report()
        run.note("report.json", report)
    return report


def run_from_lake(spark: SparkSession, root: str, config: RunConfig) -> dict:
    root = root.rstrip("/")
    return run_analytics(spark, spark.read.parquet(root + "/silver"), spark.read.parquet(root + "/gold"), config)


def latest_signature(silver: DataFrame) -> tuple:
    """AG-16: (max snapshot_time, count) -- a recent run is needed only when this changes."""
    row = silver.agg(F.max("snapshot_time"), F.count(F.lit(1))).first()
    return tuple(row)


def recent_config(signature: tuple, output: str, hours: int = 24, **thresholds) -> RunConfig | None:
    """PIPE-10: range [end - hours, end) with end = next 300 s boundary after the latest snapshot."""
    latest = signature[0]
    if latest is None:
        return None
    end = (latest // WINDOW_SECONDS + 1) * WINDOW_SECONDS
    return RunConfig(output=output, start=max(0, end - hours * 3600), end=end, **thresholds)
