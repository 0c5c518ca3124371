import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyledger.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"
AS_OF = "2026-08-20 00:00:00"

BASE = {
    "message_id": "m1", "satellite_id": "SAT-01", "ground_station_id": "GS-1", "subsystem": "POWER",
    "event_timestamp": "2026-08-01T00:00:00+00:00", "received_timestamp": "2026-08-01T00:00:05+00:00",
    "battery_voltage_v": None, "battery_current_a": None, "solar_output_w": None,
    "internal_temp_c": None, "external_temp_c": None, "signal_strength_dbm": None,
    "bit_error_rate": None, "comm_status": None, "latitude": None, "longitude": None,
    "altitude_km": None, "velocity_kms": None,
}
OWN = {
    "POWER": {"battery_voltage_v": 28.0, "battery_current_a": 2.0, "solar_output_w": 140.0},
    "THERMAL": {"internal_temp_c": 21.0, "external_temp_c": -40.0},
    "COMMS": {"signal_strength_dbm": -65.0, "bit_error_rate": 0.0005, "comm_status": "NOMINAL"},
    "ORBITAL": {"latitude": 10.0, "longitude": 20.0, "altitude_km": 540.0, "velocity_kms": 7.6},
}


def record(subsystem="POWER", **changes):
    return {**BASE, "subsystem": subsystem, **OWN.get(subsystem, {}), **changes}


def payload(subsystem="POWER", **changes):
    return json.dumps(record(subsystem, **changes)).encode()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "4",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def messages(spark):
    def make(payloads):
        return spark.createDataFrame([(bytearray(p),) for p in payloads], "value binary")

    return make
