"""Streaming chain: batch/stream equivalence, duplicates, late data (fixture F5)."""

import tempfile

from pyspark.sql import functions as F


def test_chain_matches_batch(spark):
    from skylens.operators.cells import aircraft_windows
    from skylens.operators.envelope import archive_frame
    from skylens.sources.events import state_deliveries, table
    from skylens.streaming.states import dedup_stage, run_chain, stream_files
    root = tempfile.mkdtemp(prefix="skylens-stream-")
    deliveries = state_deliveries(table(spark, "/root/testdata/sf0.001", "events"))
    source = stream_files(spark, deliveries, root + "/incoming")
    reports = run_chain(spark, root + "/lake", source)
    assert list(dict.fromkeys(r["stage"] for r in reports)) == ["archive", "dedup", "windows"]
    assert sum(r["input_rows"] for r in reports if r["stage"] == "archive") == deliveries.count()
    bronze = spark.read.parquet(root + "/lake/bronze")
    silver = spark.read.parquet(root + "/lake/silver")
    gold = spark.read.parquet(root + "/lake/gold")
    assert bronze.count() == deliveries.count()
    batch_silver = dedup_stage(archive_frame(deliveries))
    assert silver.count() == batch_silver.count()
    assert silver.select("observation_id").distinct().count() == silver.count()
    # Gold holds the windows closed by the final watermark; they equal the batch computation.
    horizon = silver.where("has_position").agg(F.max("event_time")).first()[0] - 600
    batch_gold = aircraft_windows(batch_silver).where(F.col("window_end") <= horizon)
    streamed = gold.select(*batch_gold.columns)
    assert streamed.count() > 0
    assert streamed.exceptAll(batch_gold).count() == 0


def test_resumed_chain_counts_what_came_too_late(spark):
    """Three runs on the same checkpoints, two files a batch: one row of progress per batch and stage."""
    from skylens import registry
    from skylens.streaming.progress import SCHEMA, batches
    sf = "/root/testdata/sf0.001"
    total = {r.stage: r for r in registry.queries()["stream_progress"](spark, sf).collect()}
    assert sorted(total) == ["archive", "dedup", "windows"] and {r.runs for r in total.values()} == {3}
    assert total["dedup"].late_rows > 0 == total["archive"].late_rows and total["dedup"].input_rows == total["archive"].input_rows
    log = batches(spark, registry._resumed(spark, sf) + "/progress")
    assert log.schema.simpleString() == spark.createDataFrame([], SCHEMA).schema.simpleString()
    rows = log.where("stage = 'archive'").collect()
    assert len(rows) == len({(r.run_id, r.batch_id) for r in rows}) > 3  # the cap makes several batches of a run
    assert log.where("stage = 'dedup' and state_rows > 0").count() > 0


def test_kafka_source_settings():
    import pytest
    from skylens.streaming.states import KafkaSource
    assert KafkaSource("host:9092").options() == {"kafka.bootstrap.servers": "host:9092", "subscribe": "states", "startingOffsets": "earliest",
                                                  "failOnDataLoss": "true", "maxOffsetsPerTrigger": "10000"}
    loose = KafkaSource("h", "raw", '{"raw":{"0":5}}', gaps_fail=False, max_offsets=None).options()
    assert loose["startingOffsets"] == '{"raw":{"0":5}}' and loose["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" not in loose
    for wrong in ({"starting": "middle"}, {"max_offsets": 0}):
        with pytest.raises(ValueError):
            KafkaSource("h", **wrong)
