"""Adapters that turn the driver's ``events`` table into the observation data model.

The test tables hold no aircraft data, so each ``events`` row is mapped, with integer
arithmetic only, to one state-vector row of one snapshot.  The same rules are
restated in SQL in ``skylens.oracle`` so DuckDB computes identical values.

Mapping (e = event_id, u = user_id, t = whole epoch seconds of ts):
  scope_id        'scope' || u % 2
  snapshot_time   (t div 10) * 10 + 10           (every 10 s)
  icao24          hex(u) left-padded to 6 (longer ones whole); e % 23 = 0 -> 'ZZ' || u (invalid)
  callsign        ' FL' || u || ' '; e % 11 = 0 -> blanks
  time_position   t - (e % 7) * 3; e % 29 = 0 -> snapshot + 5 (future); e % 31 = 0 -> null
  last_contact    t + e % 5
  latitude        10 + ((u * 7919 + t div 60) % 3000) / 1000; e % 17 = 0 -> null,
                  e % 37 = 0 -> 95.5 (invalid), e % 41 = 0 -> 30.25 (outside the box)
  longitude       104 + ((u * 104729 + t div 30) % 2000) / 1000; e % 19 = 0 -> null
  baro_altitude   value * 100; e % 59 = 0 -> null
  velocity        150 + e % 100; e % 43 = 0 -> -20 (invalid)
  true_track      (u * 13 + e) % 360; e % 47 = 0 -> 360 (invalid)
  collected_at    snapshot + 2 + e % 4; e % 53 = 0 -> snapshot - 1
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skylens.functions.constants import STATE_FIELDS

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def epoch_seconds_ntz(ts: str = "ts") -> Column:
    """Whole epoch seconds of a TIMESTAMP_NTZ (or TIMESTAMP) column, time-zone independent."""
    return F.expr(f"unix_date(cast({ts} as date)) * 86400L + hour({ts}) * 3600L + minute({ts}) * 60L"
                  f" + cast(second({ts}) as bigint)")


def padded_hex(number: Column) -> Column:
    """Hexadecimal text of at least six digits; longer numbers keep all their digits (and are then
    no valid address, but no other aircraft's either)."""
    text = F.hex(number)
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def _state_struct() -> Column:
    e, u = F.col("event_id"), F.col("user_id")
    t, snap = F.col("_t"), F.col("_snap")
    dbl = lambda c: c.cast("double")
    fields = {
        "icao24": F.when(e % 23 == 0, F.concat(F.lit("ZZ"), u.cast("string")))
                   .otherwise(padded_hex(u)),
        "callsign": F.when(e % 11 == 0, F.lit("   ")).otherwise(F.concat(F.lit(" FL"), u.cast("string"), F.lit(" "))),
        "origin_country": F.col("event_type"),
        "time_position": F.when(e % 31 == 0, F.lit(None).cast("double"))
                          .when(e % 29 == 0, dbl(snap + 5))
                          .otherwise(dbl(t - (e % 7) * 3)),
        "last_contact": dbl(t + e % 5),
        "longitude": F.when(e % 19 == 0, F.lit(None).cast("double"))
                      .otherwise(dbl((u * 104729 + F.expr("_t div 30")) % 2000) / 1000 + 104),
        "latitude": F.when(e % 17 == 0, F.lit(None).cast("double"))
                     .when(e % 37 == 0, F.lit(95.5))
                     .when(e % 41 == 0, F.lit(30.25))
                     .otherwise(dbl((u * 7919 + F.expr("_t div 60")) % 3000) / 1000 + 10),
        "baro_altitude": F.when(e % 59 == 0, F.lit(None).cast("double")).otherwise(F.col("value") * 100),
        "on_ground": e % 13 == 0,
        "velocity": F.when(e % 43 == 0, F.lit(-20.0)).otherwise(dbl(150 + e % 100)),
        "true_track": F.when(e % 47 == 0, F.lit(360.0)).otherwise(dbl((u * 13 + e) % 360)),
        "vertical_rate": dbl(e % 21 - 10),
        "sensors": F.lit(None).cast("array<int>"),
        "geo_altitude": F.col("value") * 100 + 50,
        "squawk": F.lpad((e % 7777).cast("string"), 4, "0"),
        "spi": F.lit(False),
        "position_source": F.lit(0),
        "category": (e % 8).cast("int"),
    }
    return F.struct(*[fields[name].alias(name) for name in STATE_FIELDS])


def state_rows(events: DataFrame) -> DataFrame:
    """One typed state-vector event per ``events`` row (the shape EXP-1 produces)."""
    base = (events.select("event_id", "user_id", "event_type", "value",
                          epoch_seconds_ntz("ts").alias("_t"))
            .withColumn("_snap", (F.expr("_t div 10") * 10 + 10))
            .withColumn("scope_id", F.concat(F.lit("scope"), (F.col("user_id") % 2).cast("string"))))
    e = F.col("event_id")
    return base.select(
        "scope_id",
        F.sha2(F.concat_ws(":", "scope_id", F.col("_snap").cast("string"), e.cast("string")), 256)
        .alias("observation_id"),
        F.concat(F.lit("snapshot:"), F.col("scope_id"), F.lit(":"), F.col("_snap").cast("string")).alias("snapshot_id"),
        F.col("_snap").alias("snapshot_time"),
        F.col("_snap").alias("event_time"),
        F.lit("snapshot_time").alias("event_time_basis"),
        F.when(e % 53 == 0, (F.col("_snap") - 1).cast("double"))
         .otherwise((F.col("_snap") + 2 + e % 4).cast("double")).alias("collected_at"),
        F.struct(F.lit("testdata").alias("bucket"), F.lit("events.parquet").alias("key"),
                 F.sha2(F.concat_ws(":", F.lit("events"), F.col("scope_id"), F.col("_snap").cast("string")), 256)
                 .alias("sha256")).alias("source_object"),
        _state_struct().alias("state"),
        F.array().cast("array<string>").alias("state_type_errors"),
    )


def state_deliveries(events: DataFrame, topic: str = "states") -> DataFrame:
    """Kafka-shaped deliveries of JSON state envelopes built from ``events``, with defects.

    An event's delivery has offset 2e in partition e % 4; every fifth event is delivered
    twice (second copy at offset 2e + 1).  Injected defects: e % 97 = 0 broken JSON; e % 83 = 0 fractional
    snapshot_time; e % 89 = 0 state.latitude altered; e % 79 = 0 empty source bucket.
    """
    from skylens.operators.envelope import state_envelope_value

    base = (events.select("event_id", "user_id", "event_type", "value", epoch_seconds_ntz("ts").alias("_t"))
            .withColumn("_snap", (F.expr("_t div 10") * 10 + 10))
            .withColumn("scope_id", F.concat(F.lit("scope"), (F.col("user_id") % 2).cast("string"))))
    e = F.col("event_id")
    typed = base.select(
        "event_id", F.col("_snap").alias("snapshot_time"),
        F.when(e % 53 == 0, (F.col("_snap") - 1).cast("double"))
         .otherwise((F.col("_snap") + 2 + e % 4).cast("double")).alias("collected_at"),
        _state_struct().alias("state"),
        F.struct(F.when(e % 79 == 0, F.lit("")).otherwise(F.lit("testdata")).alias("bucket"),
                 F.lit("events.parquet").alias("key"),
                 F.sha2(F.concat_ws(":", F.lit("events"), F.col("_snap").cast("string")), 256).alias("sha256"))
        .alias("source_object"))
    altered = F.col("state").withField(
        "latitude", F.coalesce(F.col("state.latitude"), F.lit(0.0)) + F.lit(1.0))
    value = state_envelope_value(typed, state_override=F.when(e % 89 == 0, altered).otherwise(F.col("state")))
    value = (F.when(e % 97 == 0, F.lit("{broken"))
             .when(e % 83 == 0, F.regexp_replace(value, r'"snapshot_time":(\d+)', '"snapshot_time":$1.5'))
             .otherwise(value))
    first = typed.select("event_id", value.alias("value"), (e % 4).cast("int").alias("partition"),
                         (e * 2).alias("offset"))
    again = first.where(F.col("event_id") % 5 == 0).withColumn("offset", F.col("offset") + 1)
    return (first.unionByName(again)
            .select(F.lit(topic).alias("topic"), "partition", "offset",
                    F.timestamp_seconds(F.lit(0) + F.col("offset") % 1000).alias("timestamp"),
                    F.col("event_id").cast("string").cast("binary").alias("key"),
                    F.col("value").cast("binary").alias("value")))


RAW_SOURCE = "events-raw"


def _messages(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_me``, the 56-bit message of what each frame tells (``what``: even, odd, ident, velocity)."""
    from skylens.sources import frames

    e, u, what = F.col("event_id"), F.col("user_id"), F.col("what")
    odd = (what == "odd").cast("int")
    jump = F.when((F.col("slot") == 1) & (e % 19 == 0), 1700).when((F.col("slot") == 1) & (e % 23 == 0), 31000).otherwise(0)
    placed = rows.withColumns({
        "_odd": odd,
        "_lat": ((u * 7919) % 150000 - 75000 + F.expr("_t div 60") % 100 + jump).cast("double") / 1000,
        "_lon": ((u * 104729) % 360000 - 180000 + F.expr("_t div 30") % 100).cast("double") / 1000})
    coded = frames.cpr_encoded(placed, "_lat", "_lon", "_odd")
    altitude = (F.when(e % 40 == 39, F.lit(0).cast("long"))
                .when(e % 2 == 0, frames.quarter_altitude((e * 7 + u) % 2000 + 1))
                .otherwise(frames.hundreds_altitude((e + u) % 500, e % 40 != 19)))
    number = F.lpad((e % 1000).cast("string"), 3, "0")
    name = F.when(e % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("K"), F.chr(65 + u % 26), number))
    told = frames.velocity(F.when(e % 7 == 0, 3).when(e % 5 == 0, 2).otherwise(1), F.expr("event_id div 2") % 2, (u * 3 + e) % 1024,
                           F.expr("event_id div 4") % 2, (u + e * 5) % 1024, u % 2, e % 512)
    me = (F.when(what == "ident", frames.identification(name)).when(what == "velocity", told)
          .otherwise(frames.airborne_position(9 + e % 10, altitude, F.col("_odd"), F.col("cpr_lat"), F.col("cpr_lon"))))
    other = F.lit(28 << 51)  # type code 28: aircraft status
    return coded.withColumn("_me", F.when((F.col("slot") != 1) & (e % 71 == 0), other).otherwise(me)).drop("_odd", "_lat", "_lon", "cpr_lat", "cpr_lon")


def raw_receptions(events: DataFrame) -> DataFrame:
    """Bronze-shaped raw receptions derived from ``events`` (two frames per event).

    kind = e % 3: 0 -> even then odd position, 1 -> identification then velocity,
    2 -> odd then even; frames 0.37 s apart, first at t + (e % 1000) / 1000.  Address =
    hex(u + 0x400000).  What the frames tell follows from e, u and t:
      position      latitude ((u * 7919) % 150000 - 75000 + t div 60 % 100) / 1000 (the second frame jumps
                    by 1.7 degrees where e % 19 = 0, else by 31 where e % 23 = 0), longitude
                    ((u * 104729) % 360000 - 180000 + t div 30 % 100) / 1000, type code 9 + e % 10
      altitude      even e: ((e * 7 + u) % 2000 + 1) * 25 - 1000; odd e: (e + u) % 500 * 100 - 1200 in the
                    100 ft code; none where e % 40 = 19 (hundreds that don't occur) or 39 (empty field)
      callsign      K, a letter (65 + u % 26), e % 1000 in three digits; blank where e % 17 = 0
      velocity      subtype 3 where e % 7 = 0, 2 where e % 5 = 0, else 1; raw east-west speed (u * 3 + e) % 1024
                    (west where e div 2 is odd), north-south (u + e * 5) % 1024 (south where e div 4
                    is odd), vertical rate e % 512 (down where u is odd)
    The first frame is also heard by a second receiver 2 ms later when e % 4 = 0, and again by the same
    receiver 4 ms later when e % 16 = 0.  Defects on the first frame: e % 31 = 0 corrupted last digit,
    e % 67 = 0 zeroed parity of an SBS-3 sensor, e % 61 = 0 address ffffff, e % 71 = 0 type code 28,
    e % 59 = 0 downlink format 18, e % 73 = 0 a short all-call reply, e % 53 = 0 cut in half, e % 37 = 0
    not hex, e % 41 = 0 receiver latitude 91, e % 47 = 0 metadata a list, e % 43 = 0 time 0.
    A user_id whose address needs more than 24 bits gets the text that is no frame, so no two aircraft
    share an address.
    """
    from skylens.sources.frames import extended_squitter, frame_text

    e, u = F.col("event_id"), F.col("user_id")
    base = events.select("event_id", "user_id", epoch_seconds_ntz("ts").alias("_t"))
    kind = e % 3
    one = F.when(kind == 0, "even").when(kind == 1, "ident").otherwise("odd")
    two = F.when(kind == 0, "odd").when(kind == 1, "velocity").otherwise("even")
    t1 = F.col("_t").cast("double") + (e % 1000).cast("double") / 1000
    receiver = (u % 7 + 1).cast("int")
    other = ((u + 1) % 7 + 1).cast("int")
    slots = F.array(*[F.struct(F.lit(slot).alias("slot"), what.alias("what"), (t1 + later).alias("time"), rx.alias("rx"))
                      for slot, what, later, rx in ((0, one, 0.0, receiver), (1, two, 0.37, receiver), (2, one, 0.002, other), (3, one, 0.004, receiver))])
    rows = base.select("event_id", "user_id", "_t", F.inline(slots))
    rows = rows.where((F.col("slot") < 2) | ((F.col("slot") == 2) & (e % 4 == 0)) | ((F.col("slot") == 3) & (e % 16 == 0)))
    first = F.col("slot") != 1
    defect = lambda n: first & (e % n == 0)
    address = F.when(defect(61), F.lit(0xFFFFFF)).otherwise((u + 0x400000).bitwiseAND(F.lit(0xFFFFFF)))
    rows = _messages(rows)
    upper, lower = extended_squitter(F.when(defect(59), 0x95).otherwise(0x8D), address, F.col("_me"))
    rows = rows.withColumns({"_upper": upper, "_lower": lower}).withColumn("_text", frame_text(F.col("_upper"), F.col("_lower")))
    text = F.col("_text")
    digit = F.when(F.substring(text, 28, 1) == "0", F.lit("1")).otherwise(F.lit("0"))
    reply = F.concat(F.lit("5D"), F.substring(text, 3, 6), F.lit("000000"))
    frame = (F.when(defect(37) | (u + 0x400000 > 0xFFFFFF), F.lit("not-a-frame"))
             .when(defect(73), reply)
             .when(defect(53), F.substring(text, 1, 14))
             .when(defect(67), F.concat(F.substring(text, 1, 22), F.lit("000000")))
             .when(defect(31), F.concat(F.substring(text, 1, 27), digit))
             .otherwise(text))
    sensor_lat = F.when(defect(41), F.lit("91")).otherwise(F.lit("10.5"))
    sensor = F.when(defect(67), F.lit("SBS-3")).otherwise(F.lit("dump1090"))
    index = e * 4 + F.col("slot")
    source_sha = F.sha2(F.lit(RAW_SOURCE), 256)
    rows = rows.withColumn("_msg", frame)
    told = F.concat(F.lit('{"rawMessage":"'), F.col("_msg"), F.lit('","sensorSerialNumber":'), F.col("rx").cast("string"),
                    F.lit(',"sensorLatitude":'), sensor_lat, F.lit(',"sensorType":"'), sensor, F.lit('"}'))
    meta = F.when(defect(47), F.lit("[]")).otherwise(told)
    time = F.when(defect(43), F.lit(0.0)).otherwise(F.col("time"))
    envelope = F.struct(
        F.lit(1).alias("schema_version"), F.lit("raw_reception").alias("record_type"), F.lit("replay").alias("mode"),
        F.lit("events").alias("run_id"), F.lit(RAW_SOURCE).alias("dataset_id"),
        F.sha2(F.concat_ws(":", source_sha, index.cast("string")), 256).alias("reception_id"),
        F.concat(F.lit("delivery-"), index.cast("string")).alias("delivery_id"),
        source_sha.alias("source_sha256"), F.lit("testdata/events.parquet").alias("source_url"),
        index.alias("record_index"), F.col("_msg").alias("raw_message"), F.col("rx").alias("receiver_id"),
        time.alias("source_reception_time"), time.alias("event_time"),
        F.lit("timeAtServer").alias("event_time_basis"), F.col("time").alias("replay_released_at"),
        meta.alias("source_record_json"), F.sha2(meta, 256).alias("source_payload_sha256"))
    return rows.select(F.lit("raw").alias("topic"), (e % 4).cast("int").alias("partition"),
                       index.alias("offset"), F.lit(None).cast("string").alias("payload"), envelope.alias("envelope"))


def snapshot_objects(events: DataFrame) -> DataFrame:
    """SNK-13: (path, value) of the archived snapshot documents that ``events`` make, one per scope and ten minutes.

    scope0 has the default box, scope1 a smaller one; every fifth event's row stands twice. With k the
    document's time in tens of minutes: k % 24 = 5 has an empty list of rows, k % 24 = 6 null for it,
    and k % 7 = 3 is altered after it was keyed.
    """
    from skylens.operators.envelope import source_row_text
    from skylens.sources.snapshots import with_snapshot_key

    rows = (events.select("event_id", "user_id", "event_type", "value", epoch_seconds_ntz("ts").alias("_t"))
            .withColumn("_snap", F.expr("_t div 10") * 10 + 10)
            .select("event_id", (F.col("user_id") % 2).alias("scope"), F.expr("_t div 600 + 1").alias("k"), _state_struct().alias("state"))
            .select("scope", "k", source_row_text().alias("row"), F.when(F.col("event_id") % 5 == 0, 2).otherwise(1).alias("times")))
    listed = (rows.withColumn("rows", F.array_repeat("row", F.col("times")))
              .groupBy("scope", "k").agg(F.array_join(F.array_sort(F.flatten(F.collect_list("rows"))), ",").alias("rows")))
    k = F.col("k")
    states = F.when(k % 24 == 5, "[]").when(k % 24 == 6, "null").otherwise(F.concat(F.lit("["), F.col("rows"), F.lit("]")))
    box = F.when(F.col("scope") == 0, '{"lamax":24.0,"lamin":8.0,"lomax":110.0,"lomin":102.0}').otherwise('{"lamax":12.5,"lamin":11.0,"lomax":105.5,"lomin":104.5}')
    time = (k * 600).cast("string")
    source = F.concat(F.lit('"bounding_box":'), box, F.lit(',"response":{"states":'), states, F.lit(',"time":'), time)
    keyed = with_snapshot_key(listed.select("k", time.alias("time"), source.alias("source"), F.concat(F.lit("{"), source, F.lit("}}")).alias("value")))
    return keyed.select(F.col("key").alias("path"), F.concat(
        F.lit('{"schema_version":1,"source_sha256":"'), "source_sha256", F.lit('","collected_at":'), "time", F.lit(".5,"), "source",
        F.when(k % 7 == 3, F.lit(',"altered":true}}')).otherwise(F.lit("}}"))).alias("value"))
