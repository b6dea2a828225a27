"""State-vector normalisation: flags, nulls, ages (reference fixture F1)."""

from pyspark.sql import functions as F

from skylens.functions.constants import STATE_FIELDS

BASE = ["abc123", " ABC ", "Vietnam", 100, 110, 105, 20, 10000, False, 100, 90, 0, None, None, None, False, 0, None]
TYPES = {"icao24": "string", "callsign": "string", "origin_country": "string", "on_ground": "boolean",
         "sensors": "array<int>", "squawk": "string", "spi": "boolean", "position_source": "int", "category": "int"}


def frame(spark, row, snapshot=120, collected=125.0):
    schema = ", ".join(f"{n} {TYPES.get(n, 'double')}" for n in STATE_FIELDS)
    values = [float(v) if TYPES.get(n, "double") == "double" and v is not None else v for n, v in zip(STATE_FIELDS, row)]
    state = spark.createDataFrame([tuple(values)], schema)
    return state.select(
        F.lit("id").alias("observation_id"), F.lit("snap").alias("snapshot_id"),
        F.lit(snapshot).cast("long").alias("snapshot_time"), F.lit(snapshot).cast("long").alias("event_time"),
        F.lit("snapshot_time").alias("event_time_basis"), F.lit(collected).alias("collected_at"),
        F.struct(F.lit("b").alias("bucket"), F.lit("k").alias("key"), F.lit("s").alias("sha256")).alias("source_object"),
        F.lit("scope").alias("scope_id"), F.struct(*STATE_FIELDS).alias("state"))


def test_missing_and_invalid(spark):
    from skylens.operators.normalize import normalize_observations
    row = list(BASE)
    row[5] = None      # longitude
    row[9] = -20       # velocity
    out = normalize_observations(frame(spark, row)).first()
    assert out.callsign == "ABC" and out.has_position is False and out.velocity is None
    assert "invalid_velocity" in out.quality_flags and "stale_position" in out.quality_flags
    assert "missing_longitude" in out.quality_flags and "missing_velocity" in out.quality_flags
    assert out.position_age_seconds == 20
    assert out.quality_flags == sorted(out.quality_flags)


def test_future_and_ranges(spark):
    from skylens.operators.normalize import normalize_observations
    row = list(BASE)
    row[3], row[6], row[10] = 500, 91, 360
    out = normalize_observations(frame(spark, row)).first()
    for flag in ("future_time_position", "invalid_latitude", "invalid_true_track"):
        assert flag in out.quality_flags
    assert out.has_position is False


def test_identity_and_collection(spark):
    from skylens.operators.normalize import normalize_observations
    row = list(BASE)
    row[0], row[1] = "ABC12Z", " \t "
    out = normalize_observations(frame(spark, row, collected=100.0)).first()
    assert out.icao24 == "abc12z" and "invalid_icao24" in out.quality_flags
    assert out.callsign is None
    assert "snapshot_after_collection" in out.quality_flags
    assert out.on_ground is False
