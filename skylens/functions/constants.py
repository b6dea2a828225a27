"""Fixed values that results depend on.

FIXED VALUES (must stay exactly as written for results to agree):
  state row field order: icao24, callsign, origin_country, time_position, last_contact,
    longitude, latitude, baro_altitude, on_ground, velocity, true_track, vertical_rate,
    sensors, geo_altitude, squawk, spi, position_source, category
  minimum state row length: 17
  numeric ranges: latitude [-90, 90], longitude [-180, 180], velocity [0, inf),
    true_track [0, 360) (360 itself invalid), time_position [0, inf), last_contact [0, inf),
    baro_altitude / geo_altitude / vertical_rate: any finite value
  fields whose absence is flagged: latitude, longitude, velocity, baro_altitude,
    time_position, last_contact
  stale position: age strictly greater than 15 seconds
  quality statuses (precedence, description, severity):
    invalid_identity  "Invalid aircraft identity"       3
    missing_position  "Missing or invalid coordinates"  2
    stale_position    "Position older than 15 seconds"  1
    usable_position   "Position available and recent"   0
  default bounding box: latitude 8..24, longitude 102..110
  window 300 s, cell 1 degree, earth radius 6,371,000 m
  movement defaults: gap 600 s, max speed 400 m/s; density baseline 3600 s,
    z-score needs >= 3 baseline windows and stddev > 0
  attribute time-to-live: callsign 300 s, speed/track/vertical rate 30 s (inclusive)
  CPR pair horizon 10 s; transmission bin 10 ms; policy tag "raw-silver-v1"
  envelope statuses: malformed_json, unsupported_schema, raw_reception, unknown_record_type
  reconstruction outcomes: no_prior_opposite, expired_pair, zone_mismatch,
    invalid_coordinates, decode_error, decoded
"""

STATE_FIELDS = (
    "icao24", "callsign", "origin_country", "time_position", "last_contact",
    "longitude", "latitude", "baro_altitude", "on_ground", "velocity",
    "true_track", "vertical_rate", "sensors", "geo_altitude", "squawk",
    "spi", "position_source", "category",
)
MIN_STATE_FIELDS = 17

# name -> (lower bound, upper bound, upper bound exclusive)
NUMERIC_RANGES = {
    "latitude": (-90.0, 90.0, False),
    "longitude": (-180.0, 180.0, False),
    "baro_altitude": (None, None, False),
    "geo_altitude": (None, None, False),
    "velocity": (0.0, None, False),
    "true_track": (0.0, 360.0, True),
    "vertical_rate": (None, None, False),
    "time_position": (0.0, None, False),
    "last_contact": (0.0, None, False),
}
REQUIRED_MEASUREMENTS = ("latitude", "longitude", "velocity", "baro_altitude", "time_position", "last_contact")
FUTURE_CHECKED = ("time_position", "last_contact")
STALE_SECONDS = 15

QUALITY_LABELS = (
    ("invalid_identity", "Invalid aircraft identity", 3),
    ("missing_position", "Missing or invalid coordinates", 2),
    ("stale_position", "Position older than 15 seconds", 1),
    ("usable_position", "Position available and recent", 0),
)
QUALITY_STATUSES = tuple(label[0] for label in QUALITY_LABELS)

DEFAULT_BOX = (8.0, 24.0, 102.0, 110.0)  # lamin, lamax, lomin, lomax
WINDOW_SECONDS = 300
CELL_DEGREES = 1
EARTH_RADIUS_M = 6371000.0

GAP_SECONDS = 600
MAX_SPEED_MPS = 400.0
BASELINE_SECONDS = 3600
MIN_BASELINE_WINDOWS = 3

ATTRIBUTE_TTL = {"callsign": 300, "speed_knots": 30, "track_deg": 30, "vertical_rate_fpm": 30}
PAIR_HORIZON_SECONDS = 10
BIN_PER_SECOND = 100
POLICY = "raw-silver-v1"

ENVELOPE_STATUSES = ("malformed_json", "unsupported_schema", "raw_reception", "unknown_record_type")
OUTCOMES = ("no_prior_opposite", "expired_pair", "zone_mismatch", "invalid_coordinates", "decode_error", "decoded")
