"""STR-11: progress of every batch of every stage, as rows of a table.

A listener of the session's streaming queries writes one JSON line per batch under a folder; read back with a fixed
schema it is a table of batches: rows in, rows too late, rows of state, watermark and times. Stages are told
apart by their query's name (``skylens_<stage>_<run>``); queries of other names are left alone.
"""

from __future__ import annotations

import json
import re
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from skylens.plans import fs

SCHEMA = ("stage string, run_id string, batch_id long, started string, input_rows long, late_rows long, state_rows long, state_bytes long, "
          "watermark string, milliseconds long")
NAME = re.compile(r"skylens_([a-z]+)_")


def batch_row(progress: dict) -> dict:
    """One row of the table from a batch's progress as Spark reports it."""
    states = progress.get("stateOperators") or []
    total = lambda field: sum(s.get(field) or 0 for s in states)
    return {"stage": NAME.match(progress["name"]).group(1), "run_id": progress["runId"], "batch_id": progress["batchId"], "started": progress["timestamp"],
            "input_rows": progress["numInputRows"], "late_rows": total("numRowsDroppedByWatermark"), "state_rows": total("numRowsTotal"),
            "state_bytes": total("memoryUsedBytes"), "watermark": (progress.get("eventTime") or {}).get("watermark"),
            "milliseconds": (progress.get("durationMs") or {}).get("triggerExecution")}


class BatchLog(StreamingQueryListener):
    """Writes a row per batch under ``folder`` while it is attached (``with`` attaches and detaches it)."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.rows: list[dict] = []
        self._over: dict[str, threading.Event] = {}

    def _end_of(self, run_id: str) -> threading.Event:
        return self._over.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = json.loads(event.progress.json)
        if NAME.match(progress.get("name") or ""):
            row = batch_row(progress)
            self.rows.append(row)
            # a batch that a restarted query repeats has its own run, so no row is written over
            fs.write_text(self.spark, f"{self.folder}/{row['stage']}-{row['run_id']}-{row['batch_id']:012d}-{len(self.rows)}.json", json.dumps(row) + "\n")

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end_of(str(event.runId)).set()

    def __enter__(self) -> BatchLog:
        fs.mkdirs(self.spark, self.folder)
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        self.spark.streams.removeListener(self)

    def after(self, query, seconds: float = 60.0) -> None:
        """Returns once the last batch of ``query``, which has ended, is written (events come a little later)."""
        if not self._end_of(str(query.runId)).wait(seconds):
            raise TimeoutError(f"no end of {query.name} was reported")


def batches(spark: SparkSession, folder: str) -> DataFrame:
    """The table of batches under ``folder``."""
    return spark.read.schema(SCHEMA).json(folder)
