"""Telemetry messages derived from the ``events`` table, with planted faults and duplicates.

Every event becomes one message, some become two. All numbers are dyadic fractions, so that sums and
averages are exact in any order.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.schemas import ANSWER_KEY_FIELDS, PAYLOAD_FIELDS

AS_OF = "2024-02-01 00:00:00"
GRID_START = "2024-01-01 00:00:00"
GRID_END = "2024-01-30 23:55:00"
EVENT_COLUMNS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the events that messages are made from, dealt over the session's shuffle partitions.

    A message is many times as large and dear as its event, while the given file may be a single split.
    """
    events = spark.read.schema(EVENT_COLUMNS).parquet(f"{sf_dir}/events.parquet")
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return events.select("event_id", "ts", "user_id", "event_type").repartition(partitions, "event_id")


def _steps(modulus: int, size: float, start: float) -> str:
    return f"{start}D + double(event_id % {modulus}) * {size}D"


def _measure(subsystem: str, value: str, faults: dict[int, str | None] | None = None) -> str:
    """Text of a measure for its own subsystem, with the values of the fault classes."""
    broken = "".join(
        f" WHEN fault = {fault} THEN {'NULL' if text is None else repr(text)}"
        for fault, text in (faults or {}).items()
    )
    return f"""CASE WHEN base_subsystem <> '{subsystem}' THEN NULL {broken}
                    ELSE string(cast({value} AS DECIMAL(24,16))) END"""


def _iso(time: str) -> str:
    return f"""concat(date_format({time}, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z')"""


def received_rows(events: DataFrame) -> DataFrame:
    """The 18 message fields and 4 answer-key fields as text, and the fault class."""
    base = events.selectExpr(
        "event_id", "user_id", "cast(ts AS TIMESTAMP) AS ts",
        "explode(CASE WHEN event_id % 33 = 5 THEN array(0, 1) ELSE array(0) END) AS copy",
        """CASE WHEN event_id % 50 = 7 THEN floor((event_id % 400) / 50) + 1
                WHEN event_id % 50 = 23 THEN floor((event_id % 400) / 50) + 9 ELSE 0 END AS fault""",
        """CASE event_type WHEN 'click' THEN 'POWER' WHEN 'view' THEN 'THERMAL'
                WHEN 'error' THEN 'ORBITAL' ELSE 'COMMS' END AS base_subsystem""",
        f"""CASE WHEN user_id % 12 = 10 THEN {_steps(176, 0.125, -110.0)}
                 ELSE {_steps(200, 0.125, -75.0)} END AS signal""",
    )
    delay_ms = "CASE WHEN fault = 7 THEN -5000 ELSE 1000 + (event_id * 37) % 7000 + copy * 1500 END"
    latitude = _measure("ORBITAL", _steps(412, 0.25, -51.5), {9: None})
    fields = {
        "message_id": "CASE WHEN fault = 15 THEN '' WHEN copy = 0 THEN concat('m', event_id) ELSE concat('d', event_id) END",
        "satellite_id": """CASE WHEN fault = 1 THEN NULL WHEN fault = 2 THEN 'SAT-99'
                                ELSE concat('SAT-', lpad(string(user_id % 12 + 1), 2, '0')) END""",
        "ground_station_id": "CASE WHEN fault = 3 THEN 'GS-9' ELSE concat('GS-', event_id % 4 + 1) END",
        "subsystem": "CASE WHEN fault = 4 THEN 'PAYLOAD' ELSE base_subsystem END",
        "event_timestamp": f"""CASE WHEN fault = 5 THEN 'not-a-time' WHEN fault = 6 THEN '2100-01-01T00:00:00Z'
                                    ELSE {_iso('ts')} END""",
        "received_timestamp": _iso(f"timestampadd(MILLISECOND, {delay_ms}, ts)"),
        "battery_voltage_v": _measure("POWER", _steps(64, 0.015625, 27.5), {8: "-40", 9: None}),
        "battery_current_a": _measure("POWER", _steps(32, 0.015625, 1.75), {10: "N/A"}),
        "solar_output_w": _measure("POWER", _steps(480, 0.25, 80.0)),
        "internal_temp_c": _measure("THERMAL", _steps(48, 0.125, 18.0), {8: "700", 9: None}),
        "external_temp_c": _measure("THERMAL", _steps(320, 0.25, -60.0), {10: "N/A"}),
        "signal_strength_dbm": _measure("COMMS", "signal", {8: "30", 9: None}),
        "bit_error_rate": _measure("COMMS", _steps(128, 0.0000152587890625, 0.0), {10: "N/A"}),
        "comm_status": """CASE WHEN base_subsystem <> 'COMMS' THEN NULL WHEN fault = 11 THEN 'UNKNOWN'
                               WHEN fault = 12 THEN CASE WHEN signal >= -80 THEN 'LOST' ELSE 'NOMINAL' END
                               WHEN signal >= -80 THEN 'NOMINAL' WHEN signal >= -95 THEN 'DEGRADED'
                               ELSE 'LOST' END""",
        "latitude": f"CASE WHEN fault = 16 THEN 'abc' ELSE {latitude} END",
        "longitude": _measure("ORBITAL", _steps(1440, 0.25, -180.0)),
        "altitude_km": _measure("ORBITAL", _steps(160, 0.125, 530.0), {8: "-250"}),
        "velocity_kms": _measure("ORBITAL", _steps(16, 0.015625, 7.5), {10: "N/A"}),
        "is_malformed": "string(fault > 0)",
        "malformed_reason": "CASE WHEN fault > 0 THEN concat('fault ', fault) END",
        "is_duplicate": "string(copy = 1)",
        "duplicate_of_message_id": "CASE WHEN copy = 1 THEN concat('m', event_id) END",
        "fault": "fault",
    }
    return base.selectExpr(*[f"{text} AS {name}" for name, text in fields.items()])


def messages(events: DataFrame, numeric: bool = False, booleans: bool = False) -> DataFrame:
    """Messages as bytes. ``numeric`` writes measures as JSON numbers instead of strings, ``booleans`` 0 and 1 as false and true."""
    rows = received_rows(events)
    text = F.to_json(F.struct(*PAYLOAD_FIELDS), {"ignoreNullFields": "false"})
    if numeric:
        text = F.regexp_replace(text, r':"(-?\d+(?:\.\d+)?)"', r":$1")
    if booleans:
        for value, word in (("0", "false"), ("1", "true")):
            text = F.regexp_replace(text, rf'":"{value}\.0+"', f'":{word}')
    broken = (
        F.when(F.col("fault") == 13, F.substring(text, F.lit(1), F.length(text) - 1))
        .when(F.col("fault") == 14, F.concat(F.lit("["), text, F.lit("]")))
        .otherwise(text)
    )
    return rows.select(F.encode(broken, "UTF-8").alias("value"))


def received_csv_rows(events: DataFrame) -> DataFrame:
    """The rows as a received file holds them: 22 text columns."""
    return received_rows(events).select(PAYLOAD_FIELDS + ANSWER_KEY_FIELDS)
