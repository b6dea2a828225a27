"""Composite pipelines: analytics run, archive reprocessing, serving view."""

import json
import os
import tempfile

import pytest


def test_analytics_run(spark):
    from skylens.plans.analytics import TABLES, RunConfig, run_analytics
    from tests.test_analytics import seen, silver as rows
    silver = rows(spark, seen("a", 10, 5.0), seen("b", 700, 690.0, lat=0.5), seen("c", 90, 80.0, aircraft="000001"), seen("x", 100, 90.0, flags=["invalid_icao24"]))
    gold = spark.createDataFrame([("north", i * 300, i * 300 + 300, 0, 0, v) for i, v in enumerate([1, 2, 3, 10])],
                                 "scope_id string, window_start long, window_end long, cell_lat_min long, "
                                 "cell_lon_min long, distinct_aircraft int")
    root = tempfile.mkdtemp(prefix="skylens-run-")
    config = RunConfig(output=root + "/run", start=0, end=1500)
    report = run_analytics(spark, silver, gold, config)
    assert report["source_observations"] == 4 and report["counts"] == dict(zip(TABLES, (3, 1, 4, 3, 2, 8)))
    assert os.path.exists(root + "/run/_SUCCESS") and json.load(open(root + "/run/report.json"))["counts"] == report["counts"]
    assert json.load(open(root + "/run/run-config.json"))["end"] == 1500
    with pytest.raises(FileExistsError):
        run_analytics(spark, silver, gold, config)
    with pytest.raises(ValueError):
        run_analytics(spark, silver, gold, RunConfig(output=root + "/none", start=90_000, end=90_300))
    assert not os.path.exists(root + "/none/_SUCCESS")
    loaded = spark.read.parquet(root + "/run/movement").where("event_date = '1970-01-01'")
    assert "PartitionFilters" in loaded._jdf.queryExecution().executedPlan().toString()
    for wrong in ({"end": 100}, {"start": -300}, {"end": 0}, {"gap_seconds": 0}, {"max_speed_mps": float("inf")}, {"baseline_seconds": -1}):
        with pytest.raises(ValueError):
            RunConfig(**{"output": "x", "start": 0, "end": 300, **wrong})


def test_gold_is_pruned_by_date(spark):
    from skylens.plans.analytics import in_range
    from skylens.plans.lake import build_lake
    from skylens.sources.events import state_rows, table
    root = tempfile.mkdtemp(prefix="skylens-lake-")
    build_lake(spark, state_rows(table(spark, "/root/testdata/sf0.001", "events")), root + "/lake")
    plan = in_range(spark.read.parquet(root + "/lake/gold"), "window_start", 1704067200, 1704153600)._jdf.queryExecution().executedPlan().toString()
    import re
    assert "event_date" in re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)


def test_archive_reprocessing(spark):
    from skylens.plans.archive import reprocess_archive
    from tests.test_sources import ROW, _write_snapshot
    folder = tempfile.mkdtemp(prefix="skylens-snap-")
    _write_snapshot(spark, folder, [ROW, ROW], time=120)
    _write_snapshot(spark, folder, [ROW, ROW], time=240)
    _write_snapshot(spark, folder, [], time=600)
    out = tempfile.mkdtemp(prefix="skylens-arch-") + "/out"
    quality = reprocess_archive(spark, folder, out)
    counts = quality["counts"]
    assert counts["source_rows"] == 4 and counts["observations"] == 2 and counts["duplicate_rows"] == 2
    assert counts["repeated_position_rows"] == 1 and counts["empty_snapshots"] == 1
    assert quality["snapshot_gap_count"] == 1
    assert [r.seconds for r in spark.read.parquet(out + "/snapshot_gaps").collect()] == [360]
    windows = spark.read.parquet(out + "/aircraft_windows").collect()
    assert len(windows) == 1 and windows[0].distinct_aircraft == 1
    assert os.path.exists(out + "/_SUCCESS")


def test_run_batch_publishes_silver_version(spark):
    from skylens.operators.envelope import archive_rows, raw_kafka_rows
    from skylens.plans.preprocess import run_batch
    from skylens.sources.events import raw_receptions, table
    root = tempfile.mkdtemp(prefix="skylens-batch-")
    kafka = raw_kafka_rows(raw_receptions(table(spark, "/root/testdata/sf0.001", "events").where("event_id < 200")))
    archive_rows(kafka).write.parquet(root + "/bronze")
    manifest = run_batch(spark, root + "/bronze", root + "/silver-v1", "events")
    assert os.path.exists(root + "/silver-v1/_SUCCESS")
    assert manifest["input_deliveries"] == kafka.count() and manifest["repeated_deliveries"] == 0
    assert set(manifest["datasets"]) == {"deliveries", "receptions", "rejected", "transmissions",
                                         "transmission_lineage", "positions", "states", "reconstruction_quality"}
    assert manifest["datasets"]["positions"]["row_count"] > 0
    with pytest.raises(ValueError):
        run_batch(spark, root + "/bronze", root + "/bronze/inside", "events")
    with pytest.raises(FileExistsError):
        run_batch(spark, root + "/bronze", root + "/silver-v1", "events")
