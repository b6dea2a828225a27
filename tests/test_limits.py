"""What must not be cut, dropped or accepted: large ids, empty files, non-finite numbers, several boxes, unknown scopes."""

import json

import pytest
from pyspark.sql import functions as F


def events(spark, ids, users):
    return spark.createDataFrame([(e, u, "x", 1.5) for e, u in zip(ids, users)], "event_id long, user_id long, event_type string, value double") \
        .withColumn("ts", F.expr("timestamp_ntz'2024-01-01 00:00:00'"))


def test_large_event_ids_keep_their_own_offsets(spark):
    from skylens.sources.events import state_deliveries
    ids = [5, 10, 1_000_005, 1_000_010, 2_000_020, 10_000_000_000]
    rows = state_deliveries(events(spark, ids, [1] * len(ids)))
    positions = rows.select("partition", "offset").collect()
    assert len(positions) == 2 * len(ids) == len(set(positions))


def test_large_user_ids_stay_different_aircraft(spark):
    from skylens.operators.frames import decode_frames
    from skylens.operators.normalize import normalize_observations
    from skylens.sources.events import raw_receptions, state_rows
    users = [0xFFFFFF, 0x1000000, 0x1FFFFFF, 0xBFFFFF, 0xC00000]
    source = events(spark, [1, 2, 4, 7, 8], users)
    silver = {r.icao24: "invalid_icao24" in r.quality_flags for r in normalize_observations(state_rows(source)).collect()}
    assert silver == {"ffffff": False, "1000000": True, "1ffffff": True, "bfffff": False, "c00000": False}
    frames = decode_frames(raw_receptions(source).select("envelope.*")).where("record_index % 4 = 1").collect()
    assert sorted(r.icao24 for r in frames if r.status == "valid") == [] or all(r.icao24 is None or len(r.icao24) == 6 for r in frames)
    assert sum(r.reason == "invalid_frame_format" for r in frames) == 4  # 0xBFFFFF + 0x400000 is the last address that fits


def test_replays_are_whole_unless_a_number_is_given(spark):
    from skylens.sources.raw_files import catalog, profile, replay_receptions
    raw = spark.range(3000).select(F.lit("8D").alias("rawMessage"), F.col("id").cast("double").alias("timeAtServer"), F.lit(1).alias("sensorSerialNumber"))
    options = {"checksum": "c", "run_id": "r", "source_url": "u"}
    whole = replay_receptions(raw, max_rows=None, **options)
    assert whole.count() == 3000 and whole.select("envelope.delivery_id").distinct().count() == 3000
    assert sorted(whole.select("envelope.delivery_id").collect()) == sorted(whole.select("envelope.delivery_id").collect())
    assert replay_receptions(raw, max_rows=None, start=2990, **options).count() == 10
    for refused in ({"max_rows": 5, "start": 3000}, {"max_rows": 0}, {"max_rows": None, "start": -1}):
        with pytest.raises(ValueError):
            replay_receptions(raw, **{**options, **refused})
    with pytest.raises(TypeError):
        replay_receptions(raw, **options)
    with pytest.raises(ValueError):
        profile(raw.limit(0))
    files = spark.createDataFrame([("a.avro", 1, "x"), ("b.avro", None, "y")], "url string, size long, seen_by string")
    one, two = catalog(files, files.select(F.lit("").alias("identity"))), catalog(files.drop("seen_by"), files.select(F.lit("").alias("identity")))
    assert [r.identity for r in one.collect()] == [r.identity for r in two.collect()] and one.count() == 1


def test_messages_refuse_numbers_that_are_not_finite(spark):
    from skylens.operators.envelope import state_envelope_value
    from skylens.sources.events import state_rows
    rows = state_rows(events(spark, [1], [2]))
    assert json.loads(rows.select(state_envelope_value(rows).alias("v")).first().v)["state"]["icao24"]
    for field in ("velocity", "longitude"):
        bad = rows.withColumn("state", F.col("state").withField(field, F.lit(float("nan"))))
        with pytest.raises(Exception, match="finite"):
            bad.select(state_envelope_value(bad).alias("v")).collect()


def test_every_snapshot_has_its_own_box(spark, tmp_path):
    from skylens.plans.archive import reprocess_archive
    from skylens.sources.snapshots import with_snapshot_key
    row = ["abc123", "OWN", "Peru", 100, 110, 105.5, 20.25, 9000.0, False, 100.0, 90.0, 0.0, None, None, None, False, 0]
    boxes = [((20, 21, 105, 106), 120, [row]), ((-13, -12, -78, -77), 120, [["0a0b0c", *row[1:5], -77.5, -12.5, *row[7:]]]), ((20, 21, 105, 106), 240, [])]
    for n, (box, time, states) in enumerate(boxes):
        body = {"schema_version": 1, "collected_at": 125.0, "bounding_box": dict(zip(("lamin", "lamax", "lomin", "lomax"), map(float, box))), "response": {"time": time, "states": states}}
        keyed = with_snapshot_key(spark.createDataFrame([(json.dumps(body),)], "value string")).first()
        body["source_sha256"] = keyed.source_sha256
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / keyed.key.split("/")[-1]).write_text(json.dumps(body))
    quality = reprocess_archive(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert quality["counts"]["positions_outside_requested_bbox"] == 0 and quality["counts"]["empty_snapshots"] == 1 and quality["counts"]["snapshots"] == 3
    windows = spark.read.parquet(str(tmp_path / "out" / "aircraft_windows")).collect()
    assert len({r.scope_id for r in windows}) == 2 and len(windows) == 2


def test_scopes_and_pages(spark):
    from skylens.operators.serving import known_scope, movement_page, overview_windows
    windows = spark.createDataFrame([("b", 0), ("a", 300)], "scope_id string, window_start long")
    assert known_scope(windows, None) == "a" and known_scope(windows, "b") == "b"
    with pytest.raises(LookupError):
        known_scope(windows, "c")
    with pytest.raises(LookupError):
        known_scope(windows.limit(0), None)
    rows = spark.createDataFrame([("a", "abc123", i, str(i), False) for i in range(7)], "scope_id string, icao24 string, snapshot_time long, observation_id string, observation_gap boolean")
    for offset, n, more in ((0, 3, True), (3, 3, True), (6, 1, False)):
        page, has_more = movement_page(rows, windows, "ABC123", limit=3, offset=offset)
        assert page.count() == n and has_more == more
    from tests.test_analytics import seen, silver
    rows = silver(spark, *[seen(f"o{i}", 90_000 * i, 1.0) for i in range(5)])
    assert overview_windows(rows, None).agg(F.sum("observations")).first()[0] == 5


def test_duplicates_leave_the_same_row_at_every_run(spark):
    from skylens.plans.lake import deduplicated
    rows = spark.range(300).select((F.col("id") % 50).cast("string").alias("observation_id"), (1000 - F.col("id")).cast("double").alias("collected_at"),
                                   F.struct(F.col("id").cast("string").alias("key")).alias("source_object"))
    want = sorted(tuple(r) for r in deduplicated(rows).collect())
    assert len(want) == 50 and all(sorted(tuple(r) for r in deduplicated(rows.repartition(n)).collect()) == want for n in (2, 9))


def test_stages_hold_to_their_contract(spark, tmp_path):
    from skylens.streaming.states import start_stage
    (tmp_path / "bronze").mkdir()
    start_stage(spark, "dedup", str(tmp_path)).awaitTermination()
    for changed in ({"topic": "other"}, {"watermark": "5 minutes"}):
        with pytest.raises(ValueError, match="other settings"):
            start_stage(spark, "dedup", str(tmp_path), **changed)


def test_no_local_folder_on_a_cluster(spark, monkeypatch):
    from skylens import session

    class Remote:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})()
        sparkContext = type("S", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})()

    with pytest.raises(RuntimeError):
        session.checkpoint_dir(Remote())
