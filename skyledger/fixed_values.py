"""Domains, limits, labels and texts that results must match exactly.

Everything here is data. The rules that use it live in ``operators`` and ``plans``.
"""

# --- Fixed values: run identity ---------------------------------------------------------------

PIPELINE_VERSION = "1.0.0"
MESSAGE_SOURCE = "pubsub"

# --- Fixed values: entity domains -------------------------------------------------------------

SATELLITES = [
    "SAT-01", "SAT-02", "SAT-03", "SAT-04", "SAT-05", "SAT-06",
    "SAT-07", "SAT-08", "SAT-09", "SAT-10", "SAT-11", "SAT-12",
]
GROUND_STATIONS = ["GS-1", "GS-2", "GS-3", "GS-4"]
SUBSYSTEMS = ["POWER", "THERMAL", "COMMS", "ORBITAL"]
COMM_STATUSES = ["NOMINAL", "DEGRADED", "LOST"]

# --- Fixed values: message fields -------------------------------------------------------------

ID_FIELDS = ["message_id", "satellite_id", "ground_station_id", "subsystem"]
TIME_FIELDS = ["event_timestamp", "received_timestamp"]
REQUIRED_FIELDS = ID_FIELDS + TIME_FIELDS

# Measures per subsystem in checking order, each with its inclusive physical range.
PHYSICAL_RANGES = {
    "POWER": [
        ("battery_voltage_v", 20.0, 35.0),
        ("battery_current_a", 0.0, 10.0),
        ("solar_output_w", 0.0, 1000.0),
    ],
    "THERMAL": [
        ("internal_temp_c", -100.0, 100.0),
        ("external_temp_c", -200.0, 150.0),
    ],
    "COMMS": [
        ("signal_strength_dbm", -150.0, 0.0),
        ("bit_error_rate", 0.0, 1.0),
    ],
    "ORBITAL": [
        ("latitude", -90.0, 90.0),
        ("longitude", -180.0, 180.0),
        ("altitude_km", 0.0, 2000.0),
        ("velocity_kms", 0.0, 15.0),
    ],
}

# Link quality: at or above the first limit NOMINAL, at or above the second DEGRADED, below it LOST.
NOMINAL_FROM_DBM = -80.0
DEGRADED_FROM_DBM = -95.0

# --- Fixed values: reason codes and texts -----------------------------------------------------

INVALID_JSON = "INVALID_JSON"
MISSING_REQUIRED_FIELD = "MISSING_REQUIRED_FIELD"
INVALID_SATELLITE = "INVALID_SATELLITE"
INVALID_GROUND_STATION = "INVALID_GROUND_STATION"
INVALID_SUBSYSTEM = "INVALID_SUBSYSTEM"
INVALID_TIMESTAMP = "INVALID_TIMESTAMP"
FUTURE_EVENT_TIMESTAMP = "FUTURE_EVENT_TIMESTAMP"
INVALID_RECEIVED_TIMESTAMP = "INVALID_RECEIVED_TIMESTAMP"
OUT_OF_PHYSICAL_RANGE = "OUT_OF_PHYSICAL_RANGE"
INVALID_NUMERIC_TYPE = "INVALID_NUMERIC_TYPE"
INVALID_COMM_STATUS = "INVALID_COMM_STATUS"
INCONSISTENT_COMM_STATUS = "INCONSISTENT_COMM_STATUS"

REASON_CODES = [
    INVALID_JSON, MISSING_REQUIRED_FIELD, INVALID_SATELLITE, INVALID_GROUND_STATION,
    INVALID_SUBSYSTEM, INVALID_TIMESTAMP, FUTURE_EVENT_TIMESTAMP, INVALID_RECEIVED_TIMESTAMP,
    OUT_OF_PHYSICAL_RANGE, INVALID_NUMERIC_TYPE, INVALID_COMM_STATUS, INCONSISTENT_COMM_STATUS,
]

NOT_AN_OBJECT_TEXT = "Payload must be a JSON object"
RECEIVED_BEFORE_EVENT_TEXT = "received_timestamp is before event_timestamp"
MUST_BE_NOMINAL_TEXT = "Signal >= -80 dBm must be NOMINAL"
MUST_BE_DEGRADED_TEXT = "Signal between -95 and -80 dBm must be DEGRADED"
MUST_BE_LOST_TEXT = "Signal below -95 dBm must be LOST"

# --- Fixed values: event time -----------------------------------------------------------------

ALLOWED_LATENESS = "1 hour"
EVENT_WINDOW = "5 minutes"
TICK_MINUTES = 5
GRID_START = "2026-08-01 00:00:00"
GRID_END = "2026-08-14 23:55:00"
TICKS_PER_DAY = 288

# --- Fixed values: contact gaps ---------------------------------------------------------------

GAP_OVER_MINUTES = 5
SIGNIFICANT_GAP_MINUTES = 30
MAJOR_GAP_MINUTES = 360
MINOR_GAP = "MINOR_CONTACT_GAP"
SIGNIFICANT_GAP = "SIGNIFICANT_CONTACT_GAP"
MAJOR_GAP = "MAJOR_CONTACT_GAP"

# --- Fixed values: dimension labels -----------------------------------------------------------

DROPOUT_SATELLITE = "SAT-07"
DROPOUT_PROFILE = "DROP_OUT_TEST_SATELLITE"
DEGRADED_SATELLITE = "SAT-11"
DEGRADED_PROFILE = "DEGRADED_COMMS_TEST_SATELLITE"
DEFAULT_PROFILE = "NOMINAL"
GROUND_STATION_NAMES = {
    "GS-1": "Ground Station 1",
    "GS-2": "Ground Station 2",
    "GS-3": "Ground Station 3",
    "GS-4": "Ground Station 4",
}

# Our own parameter: a key sketch of 2^12 registers has a standard error of 1.6 %.
SKETCH_LG_K = 12
