"""DuckDB SQL twins of the registered queries (the correctness oracle).

The SQL restates, in plain SQL, the event -> observation mapping of
``skylens.sources.events`` and the semantics of each operator.  Floating results that
depend on transcendental functions or summation order are rounded on both sides.
"""

from __future__ import annotations

import math

# Stated here once more, so that a wrong constant in the engine shows up as a difference.
# name -> (lower bound, upper bound, upper bound exclusive)
NUMERIC_RANGES = {
    "latitude": (-90.0, 90.0, False), "longitude": (-180.0, 180.0, False), "baro_altitude": (None, None, False),
    "geo_altitude": (None, None, False), "velocity": (0.0, None, False), "true_track": (0.0, 360.0, True),
    "vertical_rate": (None, None, False), "time_position": (0.0, None, False), "last_contact": (0.0, None, False),
}
REQUIRED_MEASUREMENTS = ("latitude", "longitude", "velocity", "baro_altitude", "time_position", "last_contact")
FUTURE_CHECKED = ("time_position", "last_contact")
STALE_SECONDS = 15
QUALITY_LABELS = (("invalid_identity", "Invalid aircraft identity", 3), ("missing_position", "Missing or invalid coordinates", 2),
                  ("stale_position", "Position older than 15 seconds", 1), ("usable_position", "Position available and recent", 0))
QUALITY_STATUSES = ("invalid_identity", "missing_position", "stale_position", "usable_position")
DEFAULT_BOX = (8.0, 24.0, 102.0, 110.0)
BOX_SCOPE = "66d77bb9d6003db4"


def _valid_sql(name: str, raw: str) -> str:
    low, high, high_open = NUMERIC_RANGES[name]
    parts = [f"{raw} IS NOT NULL", f"isfinite({raw})"]
    if low is not None:
        parts.append(f"{raw} >= {low}")
    if high is not None:
        parts.append(f"{raw} {'<' if high_open else '<='} {high}")
    return "(" + " AND ".join(parts) + ")"


def _silver_ctes() -> str:
    values = ",\n      ".join(
        f"CASE WHEN {_valid_sql(n, 'r_' + n)} THEN r_{n} END AS {n}" for n in NUMERIC_RANGES)
    invalid = [f"CASE WHEN r_{n} IS NOT NULL AND NOT {_valid_sql(n, 'r_' + n)} THEN 'invalid_{n}' END"
               for n in NUMERIC_RANGES]
    missing = [f"CASE WHEN {n} IS NULL THEN 'missing_{n}' END" for n in REQUIRED_MEASUREMENTS]
    future = [f"CASE WHEN {n} > snapshot_time THEN 'future_{n}' END" for n in FUTURE_CHECKED]
    flags = ",\n        ".join(
        ["CASE WHEN NOT regexp_full_match(icao24, '[0-9a-f]{6}') THEN 'invalid_icao24' END", *invalid, *missing,
         *future,
         f"CASE WHEN position_age_seconds > {STALE_SECONDS} THEN 'stale_position' END",
         "CASE WHEN snapshot_age_at_collection_seconds < 0 THEN 'snapshot_after_collection' END"])
    return f"""
ev AS (
  SELECT event_id AS e, user_id AS u, event_type, value, epoch_us(ts) // 1000000 AS t FROM events),
ev2 AS (
  SELECT *, (t // 10) * 10 + 10 AS snap, 'scope' || CAST(u % 2 AS VARCHAR) AS scope_id FROM ev),
st AS (
  SELECT e, scope_id,
    sha256(concat_ws(':', scope_id, CAST(snap AS VARCHAR), CAST(e AS VARCHAR))) AS observation_id,
    'snapshot:' || scope_id || ':' || CAST(snap AS VARCHAR) AS snapshot_id,
    snap AS snapshot_time, snap AS event_time,
    CASE WHEN e % 53 = 0 THEN CAST(snap - 1 AS DOUBLE) ELSE CAST(snap + 2 + e % 4 AS DOUBLE) END AS collected_at,
    CASE WHEN e % 23 = 0 THEN 'ZZ' || CAST(u AS VARCHAR) ELSE lpad(hex(u), greatest(6, length(hex(u)))::INTEGER, '0') END AS r_icao24,
    CASE WHEN e % 11 = 0 THEN '   ' ELSE ' FL' || CAST(u AS VARCHAR) || ' ' END AS r_callsign,
    CASE WHEN e % 31 = 0 THEN NULL WHEN e % 29 = 0 THEN CAST(snap + 5 AS DOUBLE)
         ELSE CAST(t - (e % 7) * 3 AS DOUBLE) END AS r_time_position,
    CAST(t + e % 5 AS DOUBLE) AS r_last_contact,
    CASE WHEN e % 19 = 0 THEN NULL
         ELSE CAST((u * 104729 + t // 30) % 2000 AS DOUBLE) / 1000 + 104 END AS r_longitude,
    CASE WHEN e % 17 = 0 THEN NULL WHEN e % 37 = 0 THEN 95.5 WHEN e % 41 = 0 THEN 30.25
         ELSE CAST((u * 7919 + t // 60) % 3000 AS DOUBLE) / 1000 + 10 END AS r_latitude,
    CASE WHEN e % 59 = 0 THEN NULL ELSE value * 100 END AS r_baro_altitude,
    (e % 13 = 0) AS r_on_ground,
    CASE WHEN e % 43 = 0 THEN -20.0 ELSE CAST(150 + e % 100 AS DOUBLE) END AS r_velocity,
    CASE WHEN e % 47 = 0 THEN 360.0 ELSE CAST((u * 13 + e) % 360 AS DOUBLE) END AS r_true_track,
    CAST(e % 21 - 10 AS DOUBLE) AS r_vertical_rate,
    value * 100 + 50 AS r_geo_altitude
  FROM ev2),
sv1 AS (
  SELECT *, lower(r_icao24) AS icao24, NULLIF(trim(r_callsign), '') AS callsign,
      {values}
  FROM st),
sv2 AS (
  SELECT *, CAST(snapshot_time AS DOUBLE) - time_position AS position_age_seconds,
    collected_at - CAST(snapshot_time AS DOUBLE) AS snapshot_age_at_collection_seconds,
    (latitude IS NOT NULL AND longitude IS NOT NULL) AS has_position,
    r_on_ground AS on_ground
  FROM sv1),
silver AS (
  SELECT *, list_sort(list_filter([
        {flags}
      ], lambda x: x IS NOT NULL)) AS quality_flags
  FROM sv2)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([_silver_ctes().strip(), *ctes]) + "\n"


LAMIN, LAMAX, LOMIN, LOMAX = DEFAULT_BOX

MOVEMENT_CTES = (
    """elig AS (
  SELECT * FROM silver WHERE has_position AND NOT list_contains(quality_flags, 'invalid_icao24')
    AND time_position IS NOT NULL AND time_position <= snapshot_time)""",
    """pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scope_id, icao24, time_position
                                              ORDER BY snapshot_time DESC, observation_id DESC) AS rk
                 FROM elig) WHERE rk = 1)""",
    """seg0 AS (
  SELECT scope_id, icao24, observation_id, snapshot_time, time_position, latitude, longitude,
    lag(time_position) OVER w AS previous_time_position,
    lead(time_position) OVER w AS next_position_time,
    lag(latitude) OVER w AS p_lat, lag(longitude) OVER w AS p_lon,
    baro_altitude - lag(baro_altitude) OVER w AS altitude_change_m
  FROM pos WINDOW w AS (PARTITION BY scope_id, icao24 ORDER BY time_position))""",
    """seg1 AS (
  SELECT *, time_position - previous_time_position AS elapsed_seconds,
    CASE WHEN previous_time_position IS NOT NULL THEN 12742000.0 * asin(sqrt(least(1.0, greatest(0.0,
      pow(sin((radians(latitude) - radians(p_lat)) / 2), 2)
      + cos(radians(p_lat)) * cos(radians(latitude)) * pow(sin(radians(longitude - p_lon) / 2), 2))))) END AS dist
  FROM seg0)""",
    """movement AS (
  SELECT scope_id, icao24, observation_id, snapshot_time, time_position, latitude, longitude,
    previous_time_position, next_position_time, elapsed_seconds,
    round(dist, 3) AS distance_m,
    round(CASE WHEN elapsed_seconds > 0 THEN dist / elapsed_seconds END, 6) AS observed_speed_mps,
    altitude_change_m,
    coalesce(elapsed_seconds > 600, false) AS observation_gap,
    coalesce(CASE WHEN elapsed_seconds > 0 THEN dist / elapsed_seconds END > 400.0, false) AS implausible_speed
  FROM seg1)""",
)

GOLD_CTE = f"""gold AS (
  SELECT scope_id, (event_time // 300) * 300 AS window_start, (event_time // 300) * 300 + 300 AS window_end,
    CAST(floor(latitude) AS BIGINT) AS cell_lat_min, CAST(floor(longitude) AS BIGINT) AS cell_lon_min,
    CAST(count(DISTINCT icao24) AS INTEGER) AS distinct_aircraft
  FROM silver
  WHERE has_position AND NOT list_contains(quality_flags, 'invalid_icao24')
    AND latitude BETWEEN {LAMIN} AND {LAMAX} AND longitude BETWEEN {LOMIN} AND {LOMAX}
  GROUP BY ALL)"""

STATUS_SQL = """CASE WHEN list_contains(quality_flags, 'invalid_icao24') THEN 'invalid_identity'
       WHEN NOT has_position THEN 'missing_position'
       WHEN list_contains(quality_flags, 'stale_position') THEN 'stale_position'
       ELSE 'usable_position' END"""

COUNTS_CTE = f"""counts AS (
  SELECT scope_id, (snapshot_time // 300) * 300 AS window_start, {STATUS_SQL} AS quality_status,
         count(*) AS "count"
  FROM silver GROUP BY ALL)"""

LABELS_VALUES = ", ".join(f"('{s}', '{d}', {v})" for s, d, v in QUALITY_LABELS)

WIDE_CTE = "wide AS (\n  SELECT scope_id, window_start, " + ", ".join(
    f"CAST(sum(CASE WHEN quality_status = '{s}' THEN \"count\" ELSE 0 END) AS BIGINT) AS {s}"
    for s in QUALITY_STATUSES) + "\n  FROM counts GROUP BY scope_id, window_start)"

def _overview(hours: int | None) -> str:
    since = "" if hours is None else f"WHERE snapshot_time >= (SELECT CAST(floor((max(snapshot_time) - {hours * 3600}) / 300) * 300 AS BIGINT) FROM silver)"
    return f"""overview AS (
  SELECT scope_id, (snapshot_time // 300) * 300 AS window_start, count(*) AS observations,
    count(DISTINCT CASE WHEN NOT list_contains(quality_flags, 'invalid_icao24') THEN icao24 END) AS distinct_aircraft,
    CAST(sum(CAST(has_position AS BIGINT)) AS BIGINT) AS with_position,
    CAST(sum(CAST(list_contains(quality_flags, 'stale_position') AS BIGINT)) AS BIGINT) AS stale_positions,
    max(snapshot_time) AS last_snapshot
  FROM silver
  {since}
  GROUP BY ALL)"""


OVERVIEW_CTE = _overview(None)

DENSITY_SELECT = """SELECT scope_id, window_start, window_end, cell_lat_min, cell_lon_min, distinct_aircraft,
  count(*) OVER h AS baseline_windows,
  round(avg(distinct_aircraft) OVER h, 6) AS baseline_mean,
  round(stddev_samp(distinct_aircraft) OVER h, 6) AS baseline_stddev,
  dense_rank() OVER (PARTITION BY scope_id, window_start ORDER BY distinct_aircraft DESC) AS density_rank,
  round(CASE WHEN count(*) OVER h >= 3 AND stddev_samp(distinct_aircraft) OVER h > 0
             THEN (distinct_aircraft - avg(distinct_aircraft) OVER h) / stddev_samp(distinct_aircraft) OVER h END, 6)
    AS density_zscore
FROM gold
WINDOW h AS (PARTITION BY scope_id, cell_lat_min, cell_lon_min ORDER BY window_start
             RANGE BETWEEN 3600 PRECEDING AND 1 PRECEDING)"""

SILVER_OUT = """SELECT observation_id, snapshot_id, snapshot_time, event_time, collected_at, scope_id, icao24, callsign,
  latitude, longitude, baro_altitude, geo_altitude, velocity, true_track, vertical_rate, time_position,
  last_contact, position_age_seconds, snapshot_age_at_collection_seconds, has_position, on_ground,
  array_to_string(quality_flags, ',') AS quality_flags
FROM silver"""


DELIVERY_CTES = (
    """deliveries AS (
  SELECT event_id AS e, event_id % 4 AS "partition", event_id * 2 AS "offset" FROM events
  UNION ALL
  SELECT event_id AS e, event_id % 4 AS "partition", event_id * 2 + 1 AS "offset" FROM events WHERE event_id % 5 = 0)""",
    """checked AS (
  SELECT d.*, CASE WHEN e % 97 = 0 THEN 'malformed_json' WHEN e % 83 = 0 THEN 'invalid_timestamps'
                   WHEN e % 89 = 0 THEN 'envelope_mismatch' WHEN e % 79 = 0 THEN 'missing_source_provenance'
              END AS error
  FROM deliveries d)""",
)


# What the frames built from events tell, and what must come out of them: the altitudes, callsigns and
# velocities that went in, and the positions that the public CPR definition gives for a pair of codes.
def _mod(a: str, n: str) -> str:
    """Remainder with the sign of n, for numbers that aren't whole."""
    return f"CASE WHEN {a} % {n} < 0 THEN ({a} % {n} + {n}) % {n} ELSE {a} % {n} END"


def _zones(lat: str) -> str:
    """Longitude zones at a latitude."""
    return (f"CASE WHEN abs({lat}) <= 1e-8 THEN 59 WHEN abs(abs({lat}) - 87) <= 1e-8 + 1e-5 * 87 THEN 2 WHEN abs({lat}) > 87 THEN 1 "
            f"ELSE floor(2 * pi() / acos(1.0 - {1 - math.cos(math.pi / 30)!r}::DOUBLE / pow(cos(pi() / 180 * abs({lat})), 2)))::BIGINT END")


_DECODED = f"""WITH rev AS (
  SELECT event_id AS e, user_id AS u, epoch_us(ts) // 1000000 AS t, CAST(epoch_us(ts) // 1000000 AS DOUBLE) + CAST(event_id % 1000 AS DOUBLE) / 1000 AS t1
  FROM events),
slots AS (
  SELECT *, 0 AS slot, CASE e % 3 WHEN 0 THEN 'even' WHEN 1 THEN 'ident' ELSE 'odd' END AS what, t1 AS time, u % 7 + 1 AS rx FROM rev
  UNION ALL
  SELECT *, 1, CASE e % 3 WHEN 0 THEN 'odd' WHEN 1 THEN 'velocity' ELSE 'even' END, t1 + CAST(0.37 AS DOUBLE), u % 7 + 1 FROM rev
  UNION ALL
  SELECT *, 2, CASE e % 3 WHEN 0 THEN 'even' WHEN 1 THEN 'ident' ELSE 'odd' END, t1 + CAST(0.002 AS DOUBLE), (u + 1) % 7 + 1
  FROM rev WHERE e % 4 = 0
  UNION ALL
  SELECT *, 3, CASE e % 3 WHEN 0 THEN 'even' WHEN 1 THEN 'ident' ELSE 'odd' END, t1 + CAST(0.004 AS DOUBLE), u % 7 + 1
  FROM rev WHERE e % 16 = 0),
checked AS (
  SELECT *, sha256(concat_ws(':', sha256('events-raw'), CAST(e * 4 + slot AS VARCHAR))) AS reception_id,
    e * 4 + slot AS record_index, CAST(rx AS INTEGER) AS receiver_id,
    CASE WHEN u + 4194304 > 16777215 THEN CASE WHEN slot <> 1 AND e % 43 = 0 THEN 'invalid_timestamp' WHEN slot <> 1 AND e % 47 = 0 THEN 'invalid_metadata'
              WHEN slot <> 1 AND e % 41 = 0 THEN 'invalid_receiver_location' ELSE 'invalid_frame_format' END
         WHEN slot = 1 THEN NULL
         WHEN e % 43 = 0 THEN 'invalid_timestamp'
         WHEN e % 47 = 0 THEN 'invalid_metadata'
         WHEN e % 41 = 0 THEN 'invalid_receiver_location'
         WHEN e % 37 = 0 THEN 'invalid_frame_format'
         WHEN e % 53 = 0 AND e % 73 <> 0 THEN 'invalid_frame_length'
         WHEN e % 59 = 0 OR e % 73 = 0 THEN 'unsupported_downlink_format'
         WHEN e % 61 = 0 THEN 'invalid_aircraft_address'
         WHEN e % 67 = 0 THEN 'receiver_zero_parity'
         WHEN e % 31 = 0 THEN 'crc_failure'
         WHEN e % 71 = 0 THEN 'unsupported_typecode' END AS reason
  FROM slots),
told AS (
  SELECT *, CASE what WHEN 'even' THEN 0 WHEN 'odd' THEN 1 END AS odd,
    CASE WHEN e % 40 IN (19, 39) THEN NULL WHEN e % 2 = 0 THEN ((e * 7 + u) % 2000 + 1) * 25 - 1000 ELSE (e + u) % 500 * 100 - 1200 END AS feet,
    CASE WHEN e % 17 <> 0 THEN 'K' || chr((65 + u % 26)::INTEGER) || lpad((e % 1000)::VARCHAR, 3, '0') END AS name,
    CASE WHEN e % 7 = 0 THEN 0 WHEN e % 5 = 0 THEN 4 ELSE 1 END AS knots,
    CASE WHEN (u * 3 + e) % 1024 > 0 THEN ((u * 3 + e) % 1024 - 1) * (1 - 2 * ((e // 2) % 2)) END AS east,
    CASE WHEN (u + e * 5) % 1024 > 0 THEN ((u + e * 5) % 1024 - 1) * (1 - 2 * ((e // 4) % 2)) END AS north,
    CASE WHEN e % 512 > 0 THEN (e % 512 - 1) * 64 * (1 - 2 * (u % 2)) END AS climb,
    ((u * 7919) % 150000 - 75000 + (t // 60) % 100 + CASE WHEN slot = 1 AND e % 19 = 0 THEN 1700 WHEN slot = 1 AND e % 23 = 0 THEN 31000 ELSE 0 END)::DOUBLE / 1000 AS lat,
    ((u * 104729) % 360000 - 180000 + (t // 30) % 100)::DOUBLE / 1000 AS lon
  FROM checked),
coded1 AS (SELECT *, 360.0::DOUBLE / (60 - odd) AS dlat FROM told),
coded2 AS (SELECT *, floor(131072 * ({_mod("lat", "dlat")}) / dlat + 0.5)::BIGINT AS y FROM coded1),
coded3 AS (SELECT *, dlat * (y::DOUBLE / 131072 + floor(lat / dlat)) AS rlat FROM coded2),
coded4 AS (SELECT *, CASE WHEN odd IS NOT NULL THEN 360.0::DOUBLE / greatest({_zones("rlat")} - odd, 1) END AS dlon FROM coded3),
coded AS (SELECT *, y & 131071 AS yz, floor(131072 * ({_mod("lon", "dlon")}) / dlon + 0.5)::BIGINT & 131071 AS xz FROM coded4),
decoded AS (
  SELECT reception_id, record_index, receiver_id, e, u, t, slot, what, time, reason, yz, xz,
    CASE WHEN reason IS NULL THEN 'valid' WHEN starts_with(reason, 'unsupported') THEN 'unsupported'
         WHEN reason = 'receiver_zero_parity' THEN 'unverified' ELSE 'invalid' END AS status,
    CASE WHEN reason = 'invalid_aircraft_address' THEN 'ffffff'
         WHEN reason IS NULL OR reason IN ('receiver_zero_parity', 'crc_failure', 'unsupported_typecode') THEN lower(lpad(hex(u + 4194304), 6, '0')) END AS icao24,
    CASE WHEN reason IS NULL THEN CASE what WHEN 'ident' THEN 'identification' WHEN 'velocity' THEN 'velocity' ELSE 'position' END END AS category,
    CASE WHEN reason IS NULL THEN odd END AS parity,
    CASE WHEN reason IS NULL AND odd IS NOT NULL THEN feet::DOUBLE END AS altitude_ft,
    CASE WHEN reason IS NULL AND what = 'ident' THEN name END AS callsign,
    CASE WHEN reason IS NULL AND what = 'velocity' AND knots > 0 THEN floor(sqrt((east * knots * east * knots + north * knots * north * knots)::DOUBLE)) END AS speed_knots,
    CASE WHEN reason IS NULL AND what = 'velocity' AND knots > 0 THEN
      round({_mod("degrees(atan2((east * knots)::DOUBLE, (north * knots)::DOUBLE))", "360.0::DOUBLE")}, 2) END AS track_deg,
    CASE WHEN reason IS NULL AND what = 'velocity' AND knots > 0 THEN climb::DOUBLE END AS vertical_rate_fpm,
    CASE what WHEN 'ident' THEN 'i' || coalesce(name, '') WHEN 'velocity' THEN concat_ws(':', 'v', knots, e % 7 = 0, (u * 3 + e) % 1024, (e // 2) % 2, (u + e * 5) % 1024, (e // 4) % 2, e % 512)
         ELSE concat_ws(':', what, e % 10, coalesce(feet, -e % 40 - 9999), e % 2, yz, xz) END AS content
  FROM coded),
"""


def _grouped(source: str) -> str:
    """Receptions of one message in one bin, and the earliest of them."""
    return f"""grouped AS (
  SELECT *, CAST(floor(time * 100) AS BIGINT) AS bin FROM {source} WHERE status = 'valid'),
binned AS (
  SELECT *, count(*) OVER (PARTITION BY u, content, bin) <> count(DISTINCT receiver_id) OVER (PARTITION BY u, content, bin)
    AS ambiguous FROM grouped),
tx AS (
  SELECT *, CASE WHEN ambiguous THEN reception_id ELSE CAST(u AS VARCHAR) || ':' || content || ':'
                 || CAST(bin AS VARCHAR) END AS tx_key FROM binned),
lineage AS (
  SELECT *, row_number() OVER (PARTITION BY tx_key ORDER BY time, reception_id) = 1 AS representative,
    count(*) OVER (PARTITION BY tx_key) AS members FROM tx)
"""


RAW_CTES = _DECODED + _grouped("decoded")

#: What three arrivals leave in time: the cutoff after an arrival is its newest event time less 30 s, to the hundredth.
EPOCH_CTES = _DECODED + """arrived AS (
  SELECT d.*, CASE WHEN d.slot <> 1 AND d.e % 43 = 0 THEN 0.0::DOUBLE ELSE d.time END AS event_time,
    (d.t - lo) * 3 // (hi - lo + 1) + CASE WHEN d.e % 101 = 0 AND (d.t - lo) * 3 // (hi - lo + 1) < 2 THEN 1 ELSE 0 END AS arrival
  FROM decoded d, (SELECT min(t) AS lo, max(t) AS hi FROM rev)),
newest AS (SELECT arrival, max(max(event_time)) OVER (ORDER BY arrival) AS newest FROM arrived GROUP BY arrival),
cutoffs AS (SELECT arrival + 1 AS arrival, floor((newest - 30) * 100) / 100 AS cutoff FROM newest),
timed AS (SELECT a.*, coalesce(event_time < cutoff, false) AS late FROM arrived a LEFT JOIN cutoffs USING (arrival)),
intime AS (SELECT * FROM timed WHERE NOT late),
""" + _grouped("intime")

_FRAME = "struct_pack(time := time, key := tx_key, rec := reception_id, y := yz / 131072.0::DOUBLE, x := xz / 131072.0::DOUBLE)"
_CARRIED = ("callsign", "speed_knots", "vertical_rate_fpm")

#: Position frames with the last frame of the other parity, and what the pair of codes gives; the newer frame decides (a tie: odd).
PAIR_CTES = f"""reps AS (SELECT * FROM lineage WHERE representative),
carried AS (
  SELECT *,
    last_value(CASE WHEN parity = 0 THEN {_FRAME} END IGNORE NULLS) OVER b AS even,
    last_value(CASE WHEN parity = 1 THEN {_FRAME} END IGNORE NULLS) OVER b AS odd,
    {", ".join(f"last_value(CASE WHEN {c} IS NOT NULL THEN struct_pack(v := {c}, at := time) END IGNORE NULLS) OVER a AS last_{c}" for c in _CARRIED)}
  FROM reps
  WINDOW a AS (PARTITION BY u ORDER BY time, tx_key ROWS UNBOUNDED PRECEDING),
         b AS (PARTITION BY u ORDER BY time, tx_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
paired AS (SELECT *, CASE WHEN parity = 0 THEN odd ELSE even END AS partner FROM carried WHERE category = 'position'),
codes AS (SELECT *, CASE WHEN parity = 0 THEN {_FRAME} ELSE even END AS ef, CASE WHEN parity = 1 THEN {_FRAME} ELSE odd END AS of FROM paired),
lats AS (SELECT *, ef.time > of.time AS newer_even, floor(ef.y * 59 - of.y * 60 + 0.5) AS j FROM codes),
lats1 AS (SELECT *, 6.0::DOUBLE * ({_mod("j", "60")} + ef.y) AS le0, 360.0::DOUBLE / 59 * ({_mod("j", "59")} + of.y) AS lo0 FROM lats),
lats2 AS (SELECT *, CASE WHEN le0 >= 270 THEN le0 - 360 ELSE le0 END AS le, CASE WHEN lo0 >= 270 THEN lo0 - 360 ELSE lo0 END AS lo FROM lats1),
lats3 AS (SELECT *, CASE WHEN newer_even THEN le ELSE lo END AS lat, CASE WHEN partner IS NOT NULL THEN {_zones("le")} END AS ne, CASE WHEN partner IS NOT NULL THEN {_zones("lo")} END AS no FROM lats2),
lons AS (SELECT *, CASE WHEN partner IS NOT NULL THEN {_zones("lat")} END AS nl FROM lats3),
lons1 AS (SELECT *, greatest(CASE WHEN newer_even THEN nl ELSE nl - 1 END, 1) AS ni, floor(ef.x * (nl - 1) - of.x * nl + 0.5) AS m FROM lons),
lons2 AS (SELECT *, 360.0::DOUBLE / ni * ({_mod("m", "ni")} + CASE WHEN newer_even THEN ef.x ELSE of.x END) AS lon0 FROM lons1),
solved AS (
  SELECT *, round(lat, 5) AS lat5, round(CASE WHEN lon0 > 180 THEN lon0 - 360 ELSE lon0 END, 5) AS lon5 FROM lons2),
judged AS (
  SELECT *, CASE WHEN partner IS NULL THEN 'no_prior_opposite' WHEN time - partner.time > 10 THEN 'expired_pair' WHEN ne <> no THEN 'zone_mismatch'
                 WHEN NOT (lat5 BETWEEN -90 AND 90 AND lon5 BETWEEN -180 AND 180) THEN 'invalid_coordinates' ELSE 'decoded' END AS outcome FROM solved)
"""


SOURCED = """, heard AS (SELECT tx_key, list(reception_id) AS ids FROM lineage GROUP BY tx_key),
sourced AS (SELECT j.*, list_sort(list_distinct(list_concat(h.ids, p.ids))) AS ids
            FROM judged j JOIN heard h ON h.tx_key = j.tx_key JOIN heard p ON p.tx_key = j.partner.key WHERE outcome = 'decoded')
SELECT reception_id, icao24, time AS event_time, lat5 AS latitude, lon5 AS longitude, len(ids)::INTEGER AS n_sources, array_to_string(ids, ',') AS sources FROM sourced"""


def _attribute(name: str, lifetime: int, updated: bool) -> str:
    last = f"last_{name}"
    return (f"CASE WHEN time - {last}.at <= {lifetime} THEN {last}.v END AS {name}, "
            f"CASE WHEN {last} IS NULL THEN 'missing' WHEN time - {last}.at <= {lifetime} THEN 'fresh' ELSE 'stale' END AS {name}_status"
            + (f", {last}.at AS {name}_updated_at" if updated else ""))


def oracle_sql() -> dict[str, str]:
    movement = _with(*MOVEMENT_CTES)
    envelopes = _with(*DELIVERY_CTES)
    stream_gold = _with(*DELIVERY_CTES, f"""accepted AS (
  SELECT s.* FROM checked c JOIN silver s ON s.e = c.e WHERE c.error IS NULL AND c."offset" % 2 = 0
    AND s.has_position AND NOT list_contains(s.quality_flags, 'invalid_icao24')
    AND s.latitude BETWEEN {LAMIN} AND {LAMAX} AND s.longitude BETWEEN {LOMIN} AND {LOMAX})""")
    # an accepted delivery is late if its time is 10 minutes or more before the newest accepted one of earlier arrivals
    resumed = _with(*DELIVERY_CTES, """arriving AS (
  SELECT c.*, s.* EXCLUDE (e), (s.t - lo) * 3 // (hi - lo + 1) + CASE WHEN c.e % 101 = 0 AND (s.t - lo) * 3 // (hi - lo + 1) < 2 THEN 1 ELSE 0 END AS arrival
  FROM checked c JOIN (SELECT silver.*, ev.t FROM silver JOIN ev ON ev.e = silver.e) s ON s.e = c.e, (SELECT min(t) AS lo, max(t) AS hi FROM ev))""",
                    """newest AS (SELECT arrival + 1 AS arrival, max(max(event_time)) OVER (ORDER BY arrival) AS newest FROM arriving WHERE error IS NULL GROUP BY arrival)""",
                    """judged AS (SELECT a.*, coalesce(a.event_time <= newest - 600, false) AS late FROM arriving a LEFT JOIN newest USING (arrival))""",
                    """kept AS (SELECT * FROM judged WHERE error IS NULL AND NOT late AND "offset" % 2 = 0)""")
    inside = f"""has_position AND NOT list_contains(quality_flags, 'invalid_icao24') AND latitude BETWEEN {LAMIN} AND {LAMAX} AND longitude BETWEEN {LOMIN} AND {LOMAX}"""
    return {
        "stream_resumed": resumed + f"""SELECT * FROM (
  SELECT '{BOX_SCOPE}' AS scope_id, (event_time // 300) * 300 AS window_start, (event_time // 300) * 300 + 300 AS window_end,
    CAST(floor(latitude) AS BIGINT) AS cell_lat_min, CAST(floor(longitude) AS BIGINT) AS cell_lon_min, CAST(count(DISTINCT icao24) AS INTEGER) AS distinct_aircraft
  FROM kept WHERE {inside} GROUP BY 1, 2, 3, 4, 5)
WHERE window_end <= (SELECT max(event_time) - 600 FROM kept WHERE {inside})""",
        "stream_progress": resumed + """SELECT 'archive' AS stage, count(*) AS input_rows, 0::BIGINT AS late_rows, 3::BIGINT AS runs FROM judged
UNION ALL SELECT 'dedup', count(*), count(*) FILTER (error IS NULL AND late), 3 FROM judged UNION ALL SELECT 'windows', count(*), 0, 3 FROM kept""",
        "stream_windows": stream_gold + f"""SELECT * FROM (
  SELECT '{BOX_SCOPE}' AS scope_id, (event_time // 300) * 300 AS window_start,
    (event_time // 300) * 300 + 300 AS window_end, CAST(floor(latitude) AS BIGINT) AS cell_lat_min,
    CAST(floor(longitude) AS BIGINT) AS cell_lon_min, CAST(count(DISTINCT icao24) AS INTEGER) AS distinct_aircraft
  FROM accepted GROUP BY 1, 2, 3, 4, 5)
WHERE window_end <= (SELECT max(event_time) - 600 FROM accepted)""",
        "archive_report": _with("""copies AS (
  SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE e % 5 = 0)""") + f"""SELECT 'source_rows' AS metric, count(*) AS value FROM copies
UNION ALL SELECT 'snapshots', count(DISTINCT (scope_id, snapshot_time)) FROM copies
UNION ALL SELECT 'observations', count(DISTINCT observation_id) FROM copies
UNION ALL SELECT 'duplicate_rows', count(*) - count(DISTINCT observation_id) FROM copies
UNION ALL SELECT 'rows_with_position', count(*) FILTER (WHERE has_position) FROM silver
UNION ALL SELECT 'repeated_position_rows', count(*) FILTER (WHERE has_position)
  - count(DISTINCT CASE WHEN has_position THEN (scope_id, icao24, time_position, latitude, longitude) END) FROM silver
UNION ALL SELECT 'positions_outside_requested_bbox', count(*) FILTER (WHERE has_position
  AND NOT list_contains(quality_flags, 'invalid_icao24')
  AND NOT (latitude BETWEEN {LAMIN} AND {LAMAX} AND longitude BETWEEN {LOMIN} AND {LOMAX})) FROM silver
UNION ALL SELECT 'distinct_aircraft', count(DISTINCT CASE WHEN NOT list_contains(quality_flags, 'invalid_icao24')
  THEN icao24 END) FROM silver""",
        "archive_documents": _with("""filed AS (
  SELECT s.*, ev.t // 600 + 1 AS k, s.scope_id = 'scope0' AS whole FROM silver s JOIN ev ON ev.e = s.e)""",
                                   """listed AS (SELECT *, k % 24 NOT IN (5, 6) AS has_rows, k % 7 <> 3 AS intact, CASE WHEN whole THEN latitude BETWEEN 8 AND 24
    AND longitude BETWEEN 102 AND 110 ELSE latitude BETWEEN 11 AND 12.5 AND longitude BETWEEN 104.5 AND 105.5 END AS inside FROM filed)""") + f"""SELECT CASE WHEN whole THEN 8.0 ELSE 11.0 END::DOUBLE AS lamin,
  k * 600 AS snapshot_time, intact, coalesce(sum(CASE WHEN e % 5 = 0 THEN 2 ELSE 1 END) FILTER (has_rows), 0)::BIGINT AS state_rows, 0::BIGINT AS malformed,
  CASE WHEN intact AND has_rows THEN CASE WHEN whole THEN '{BOX_SCOPE}' ELSE
    substr(sha256('{{"lamax": 12.5, "lamin": 11.0, "lomax": 105.5, "lomin": 104.5}}'), 1, 16) END END AS scope_id,
  count(*) FILTER (intact AND has_rows) AS observations,
  count(*) FILTER (intact AND has_rows AND has_position AND NOT list_contains(quality_flags, 'invalid_icao24') AND inside) AS inside
FROM listed GROUP BY whole, k, intact, has_rows""",
        "snapshot_gaps": _with("""snaps AS (SELECT DISTINCT scope_id, snapshot_time FROM silver)""") + """SELECT scope_id, gap_from,
  gap_to, gap_to - gap_from AS seconds
FROM (SELECT scope_id, lag(snapshot_time) OVER (PARTITION BY scope_id ORDER BY snapshot_time) AS gap_from,
        snapshot_time AS gap_to FROM snaps)
WHERE gap_from IS NOT NULL AND gap_to - gap_from > 180""",
        "frame_decode": RAW_CTES + """SELECT reception_id, record_index, receiver_id, status, reason, icao24, category,
  parity, altitude_ft, callsign, speed_knots, track_deg, vertical_rate_fpm FROM decoded""",
        "transmission_lineage": RAW_CTES + "SELECT reception_id, ambiguous, representative, members FROM lineage",
        "cpr_positions": RAW_CTES + "," + PAIR_CTES + """SELECT reception_id, icao24, time AS event_time, partner.rec AS partner_reception, outcome,
  CASE WHEN outcome = 'decoded' THEN lat5 END AS latitude, CASE WHEN outcome = 'decoded' THEN lon5 END AS longitude FROM judged""",
        "position_lineage": RAW_CTES + "," + PAIR_CTES + SOURCED,
        "epoch_positions": EPOCH_CTES + "," + PAIR_CTES + SOURCED,
        "epoch_late": EPOCH_CTES + """SELECT (e % 4)::INTEGER AS "partition", record_index AS "offset", event_time FROM timed WHERE late""",
        "state_envelopes": envelopes + """SELECT c."partition", c."offset", c.error,
  CASE WHEN c.error IS NULL THEN s.icao24 END AS icao24,
  CASE WHEN c.error IS NULL THEN s.snapshot_time END AS snapshot_time,
  CASE WHEN c.error IS NULL THEN s.latitude END AS latitude,
  CASE WHEN c.error IS NULL THEN array_to_string(s.quality_flags, ',') END AS quality_flags
FROM checked c JOIN silver s ON s.e = c.e""",
        "first_delivery": envelopes + """SELECT c."partition", c."offset", s.icao24, s.snapshot_time, s.time_position
FROM checked c JOIN silver s ON s.e = c.e
WHERE c.error IS NULL AND c."offset" % 2 = 0""",
        "normalize_flags": _with() + SILVER_OUT,
        "flag_histogram": _with() + """SELECT flag, count(*) AS observations
FROM (SELECT unnest(quality_flags) AS flag FROM silver) GROUP BY flag""",
        "movement_segments": movement + "SELECT * FROM movement",
        "observation_gaps": movement + "SELECT * FROM movement WHERE observation_gap",
        "cell_windows": _with(GOLD_CTE) + "SELECT * FROM gold",
        "density_stats": _with(GOLD_CTE) + DENSITY_SELECT,
        "quality_counts": _with(COUNTS_CTE) + f"""SELECT c.quality_status, c.scope_id, c.window_start, c."count",
  l.description, l.severity
FROM counts c LEFT JOIN (VALUES {LABELS_VALUES}) AS l(quality_status, description, severity)
  ON c.quality_status = l.quality_status""",
        "quality_wide": _with(COUNTS_CTE, WIDE_CTE) + "SELECT * FROM wide",
        "quality_long": _with(COUNTS_CTE, WIDE_CTE) + "\nUNION ALL\n".join(
            f"SELECT scope_id, window_start, '{s}' AS quality_status, {s} AS observations FROM wide"
            for s in QUALITY_STATUSES),
        "overview_windows": _with(OVERVIEW_CTE) + "SELECT * FROM overview",
        "overview_recent": _with(_overview(6)) + "SELECT * FROM overview",
        "reception_invariants": RAW_CTES + """, i AS (SELECT record_index AS i FROM checked)
SELECT count(*) FILTER (i % 97 = 0) AS missing_identity, count(*) FILTER (i % 79 = 0 AND i % 97 <> 0 AND i % 83 <> 0) +
  (SELECT (count(DISTINCT i) > 1)::BIGINT FROM i WHERE i % 83 = 0 AND i % 97 <> 0) AS conflicting_content,
  count(*) FILTER (i % 89 = 0) AS missing_provenance, count(*) FILTER (i % 83 = 0 AND i % 97 <> 0) AS invalid_identity FROM i""",
        "pending_outbox": _with() + "SELECT DISTINCT snapshot_id AS snapshot_key FROM silver WHERE snapshot_time % 30 <> 0",
        "raw_envelope_status": RAW_CTES + """SELECT e % 4 AS "partition", record_index AS "offset",
  CASE WHEN record_index % 97 = 0 THEN 'malformed_json' WHEN record_index % 89 = 0 THEN 'unsupported_schema'
       WHEN record_index % 83 = 0 THEN 'unknown_record_type' ELSE 'raw_reception' END AS status,
  CASE WHEN record_index % 97 <> 0 THEN reception_id END AS reception_id FROM checked""",
        "attribute_states": RAW_CTES + "," + PAIR_CTES + f"""SELECT reception_id, {_attribute("callsign", 300, True)}, {_attribute("speed_knots", 30, True)},
  {_attribute("vertical_rate_fpm", 30, False)} FROM judged WHERE outcome = 'decoded'""",
        "overview_summary": _with(OVERVIEW_CTE) + """SELECT scope_id,
  CAST(sum(observations) AS BIGINT) AS observations, CAST(sum(with_position) AS BIGINT) AS with_position,
  CAST(sum(stale_positions) AS BIGINT) AS stale_positions, max(distinct_aircraft) AS peak_window_aircraft,
  round(CAST(sum(with_position) AS DOUBLE) / sum(observations), 6) AS position_share,
  round(CAST(sum(stale_positions) AS DOUBLE) / sum(observations), 6) AS stale_share
FROM overview GROUP BY scope_id""",
        "movement_pages": _with(*MOVEMENT_CTES) + """SELECT * EXCLUDE (key_rows), (row_number - 1) // 200 AS page,
  ((row_number - 1) // 200) * 200 AS page_offset, key_rows > ((row_number - 1) // 200 + 1) * 200 AS has_more
FROM (SELECT *, row_number() OVER (PARTITION BY scope_id, icao24 ORDER BY snapshot_time, observation_id) AS row_number,
        count(*) OVER (PARTITION BY scope_id, icao24) AS key_rows FROM movement)""",
    }
