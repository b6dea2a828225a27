"""PRJ-3 / VAL-2 / VAL-3: normalise state-vector events into Silver observations.

Nothing is invented: an invalid value becomes null and is flagged both ``invalid_<f>``
and, for the required measurements, ``missing_<f>``.  Everything is one projection of
native expressions, so it runs inside whole-stage codegen on batch and streaming frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skylens.functions.columns import flag_array, is_finite, strip_whitespace
from skylens.functions.constants import (FUTURE_CHECKED, NUMERIC_RANGES, REQUIRED_MEASUREMENTS,
                                         STALE_SECONDS)

SILVER_COLUMNS = (
    "observation_id", "snapshot_id", "snapshot_time", "event_time", "event_time_basis", "collected_at",
    "schema_version", "source_object", "scope_id", "icao24", "callsign", "latitude", "longitude",
    "baro_altitude", "geo_altitude", "velocity", "true_track", "vertical_rate", "time_position",
    "last_contact", "position_age_seconds", "snapshot_age_at_collection_seconds", "has_position",
    "on_ground", "quality_flags",
)


def _valid(name: str, value: Column, type_errors: Column) -> Column:
    low, high, high_open = NUMERIC_RANGES[name]
    ok = is_finite(value) & ~F.array_contains(type_errors, name)
    if low is not None:
        ok = ok & (value >= F.lit(low))
    if high is not None:
        ok = ok & ((value < F.lit(high)) if high_open else (value <= F.lit(high)))
    return F.coalesce(ok, F.lit(False))


def silver_columns(*, state: Column, type_errors: Column | None = None, snapshot_time: Column | None = None,
                   collected_at: Column | None = None, provenance: dict[str, Column] | None = None) -> list[Column]:
    """Silver columns as expressions, so callers can embed them in any projection or struct.

    ``type_errors`` lists state fields that were present with a non-numeric JSON type;
    they are treated as present-but-invalid, exactly like out-of-range numbers.
    """
    s = lambda f: state.getField(f)
    errors = F.coalesce(type_errors, F.array().cast("array<string>")) if type_errors is not None \
        else F.array().cast("array<string>")
    snapshot = snapshot_time if snapshot_time is not None else F.col("snapshot_time")
    collected = collected_at if collected_at is not None else F.col("collected_at")
    prov = {name: F.col(name) for name in ("observation_id", "snapshot_id", "snapshot_time", "event_time",
                                           "event_time_basis", "collected_at", "source_object", "scope_id")}
    prov.update(provenance or {})

    icao = F.lower(s("icao24"))
    values = {name: F.when(_valid(name, s(name).cast("double"), errors), s(name).cast("double"))
              for name in NUMERIC_RANGES}
    invalid = [((s(name).isNotNull() | F.array_contains(errors, name)) & ~_valid(name, s(name).cast("double"), errors),
                f"invalid_{name}") for name in NUMERIC_RANGES]
    missing = [(values[name].isNull(), f"missing_{name}") for name in REQUIRED_MEASUREMENTS]
    future = [(values[name] > snapshot, f"future_{name}") for name in FUTURE_CHECKED]
    age = snapshot.cast("double") - values["time_position"]
    collection_age = collected - snapshot.cast("double")
    flags = flag_array(
        (~icao.rlike("^[0-9a-f]{6}$") | icao.isNull(), "invalid_icao24"),
        *invalid, *missing, *future,
        (age > STALE_SECONDS, "stale_position"),
        (collection_age < 0, "snapshot_after_collection"),
    )
    return [
        *[prov[name].alias(name) for name in ("observation_id", "snapshot_id", "snapshot_time", "event_time",
                                              "event_time_basis", "collected_at")],
        F.lit(1).alias("schema_version"),
        prov["source_object"].alias("source_object"), prov["scope_id"].alias("scope_id"),
        icao.alias("icao24"),
        F.nullif(strip_whitespace(s("callsign")), F.lit("")).alias("callsign"),
        *[values[name].alias(name) for name in ("latitude", "longitude", "baro_altitude", "geo_altitude",
                                               "velocity", "true_track", "vertical_rate", "time_position",
                                               "last_contact")],
        age.alias("position_age_seconds"),
        collection_age.alias("snapshot_age_at_collection_seconds"),
        (values["latitude"].isNotNull() & values["longitude"].isNotNull()).alias("has_position"),
        s("on_ground").cast("boolean").alias("on_ground"),
        flags.alias("quality_flags"),
    ]


def normalize_observations(events: DataFrame, *, state: str = "state",
                           type_errors: str = "state_type_errors") -> DataFrame:
    """Typed state events (``state`` struct + provenance columns) -> Silver rows.

    The Silver columns are materialised once per row (a one-element ``inline``): downstream
    filters and keys reference them many times, and without the barrier Catalyst inlines the
    whole validation into every reference.
    """
    errors = F.col(type_errors) if type_errors in events.columns else None
    return events.select(F.inline(F.array(F.struct(*silver_columns(state=F.col(state), type_errors=errors)))))


def with_event_timestamp(silver: DataFrame) -> DataFrame:
    """Event-time column used for watermarks and windows (an instant, zone independent)."""
    return silver.withColumn("event_timestamp", F.timestamp_seconds("event_time"))
