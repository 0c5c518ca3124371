"""Silver tables: conformed telemetry and its split by subsystem."""

from pyspark.sql import DataFrame, functions as F

from skyledger import schemas
from skyledger.functions.metrics import latency_ms

_TIMES = ("event_timestamp", "received_timestamp", "ingestion_timestamp")
_COMMON_HEAD = ["message_id", "satellite_id", "ground_station_id", "event_timestamp", "received_timestamp"]
_COMMON_TAIL = ["latency_ms", "dedup_key", "ingestion_timestamp", "pipeline_version"]
_READINGS = {
    "POWER": ["battery_voltage_v", "battery_current_a", "solar_output_w"],
    "THERMAL": ["internal_temp_c", "external_temp_c"],
    "COMMS": ["signal_strength_dbm", "bit_error_rate", "comm_status"],
    "ORBITAL": ["latitude", "longitude", "altitude_km", "velocity_kms"],
}


def silver_telemetry(curated: DataFrame) -> DataFrame:
    names = [c for c in schemas.CURATED.fieldNames() if c != "dedup_key"]
    names.insert(names.index("ingestion_timestamp"), "dedup_key")
    usable = curated.dropna(subset=["satellite_id", "subsystem", "event_timestamp", "received_timestamp"])
    typed = usable.withColumns({name: F.col(name).cast("timestamp") for name in _TIMES})
    return typed.select(*names, latency_ms().alias("latency_ms"))


def _subsystem(telemetry: DataFrame, subsystem: str) -> DataFrame:
    rows = telemetry.filter(F.col("subsystem") == subsystem)
    return rows.select(_COMMON_HEAD + _READINGS[subsystem] + _COMMON_TAIL)


def silver_power(telemetry: DataFrame) -> DataFrame:
    return _subsystem(telemetry, "POWER")


def silver_thermal(telemetry: DataFrame) -> DataFrame:
    return _subsystem(telemetry, "THERMAL")


def silver_comms(telemetry: DataFrame) -> DataFrame:
    return _subsystem(telemetry, "COMMS")


def silver_orbital(telemetry: DataFrame) -> DataFrame:
    return _subsystem(telemetry, "ORBITAL")
