"""Very long payloads, JSON booleans, and satellites from a dimension."""

import json

import pytest
from conftest import AS_OF, payload, record
from test_stored import batch, write_files

from skyledger.plans import ingest
from skyledger.sources.layers import Layers
from skyledger.sources.messages import read_stream
from skyledger.streaming import ingest as streaming

MB = 1 << 20


@pytest.mark.parametrize("extra", ["x" * MB, "\\\\" * MB, '\\"' * (MB // 2), "INF " * (MB // 4), "\\u0041" * 100000, "]" * MB])
def test_long_strings_with_foreign_words(spark, messages, extra):
    body = json.dumps(record(message_id="INF-1"))[:-1] + f', "other": "{extra}"}}'
    bare = json.dumps(record(message_id="INF-2"))[:-1] + f', "other": "{extra}", "bad": +INF}}'
    assert json.loads(body)["message_id"] == "INF-1"
    rows = ingest.validated(messages([body.encode(), bare.encode()]), AS_OF).select("message_id", "reason_code").collect()
    assert sorted(map(tuple, rows), key=str) == [("INF-1", None), (None, "INVALID_JSON")]
    assert ingest.raw_envelope(messages([body.encode()]), AS_OF).first().message_id == "INF-1"


def test_booleans_are_numbers_in_measures(spark, messages):
    def judged(**changes):
        row = ingest.validated(messages([payload("POWER", **changes)]), AS_OF).first()
        return row.reason_code, row.reason_detail, row.battery_current_a, row.battery_voltage_v

    assert judged(battery_current_a=True) == (None, None, 1.0, 28.0)
    assert judged(battery_current_a=False) == (None, None, 0.0, 28.0)
    assert judged(battery_current_a="true")[0] == "INVALID_NUMERIC_TYPE"
    assert judged(battery_voltage_v=True, battery_current_a="false")[:2] == ("OUT_OF_PHYSICAL_RANGE", "battery_voltage_v")
    assert judged(other="true", battery_current_a="true")[0] == "INVALID_NUMERIC_TYPE"
    assert judged(other=True, battery_current_a="true")[0] == "INVALID_NUMERIC_TYPE"
    assert judged(other=[True, {"battery_current_a": True}])[0] is None
    assert judged(bit_error_rate=True)[0] is None  # another subsystem's measure
    two = [payload(battery_current_a=1.0, message_id="a"), payload(battery_current_a=True, message_id="b"), payload(battery_current_a=2, message_id="c")]
    assert sorted(r.message_id for r in ingest.curated(messages(two), AS_OF).collect()) == ["a", "c"]  # 1.0 and true are one reading
    assert ingest.validated(messages([b"[true]", b"true", b'[{"a": true}]']), AS_OF).filter("reason_code = 'INVALID_JSON'").count() == 3


def test_satellites_from_a_dimension(spark, messages):
    bodies = [payload(satellite_id=s, ground_station_id=g) for s in ("SAT-01", "SAT-77", "", "sat-01") for g in ("GS-1", "GS-9")]
    dimension = spark.createDataFrame([("SAT-77",), ("SAT-77",), (None,), ("SAT-01",)], "satellite_id string")
    found = ingest.validated(messages(bodies), AS_OF, dimension).select("satellite_id", "ground_station_id", "reason_code", "reason_detail").collect()
    assert sorted(map(tuple, found), key=str) == sorted([
        ("SAT-01", "GS-1", None, None), ("SAT-01", "GS-9", "INVALID_GROUND_STATION", "GS-9"), ("SAT-77", "GS-1", None, None),
        ("SAT-77", "GS-9", "INVALID_GROUND_STATION", "GS-9"), ("", "GS-1", "MISSING_REQUIRED_FIELD", "satellite_id"),
        ("", "GS-9", "MISSING_REQUIRED_FIELD", "satellite_id"), ("sat-01", "GS-1", "INVALID_SATELLITE", "sat-01"), ("sat-01", "GS-9", "INVALID_SATELLITE", "sat-01"),
    ], key=str)
    none = ingest.validated(messages(bodies), AS_OF, dimension.limit(0))
    assert none.filter("reason_code = 'INVALID_SATELLITE'").count() == 6
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:  # a fleet that is too large to broadcast
        large = ingest.validated(messages(bodies), AS_OF, dimension)
        assert "BroadcastHashJoin" not in large._jdf.queryExecution().executedPlan().toString()
        assert large.filter("reason_code is null").count() == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_closed_days_of_a_stream(spark, tmp_path):
    folder = write_files(tmp_path / "in", [batch()[:4], batch()[4:9], batch()[9:]])
    layers = Layers(spark, str(tmp_path / "out"))
    stream = read_stream(spark, "text", folder, maxFilesPerTrigger=1)
    streaming.drain(stream, layers, str(tmp_path / "checkpoints"), as_of=AS_OF, tables=["telemetry_curated", "telemetry_raw"])
    before = sorted(map(str, layers.read("telemetry_curated").collect()))
    old = layers.read("telemetry_curated")
    first_day = layers.read("telemetry_curated", ["2026-08-01"]).count()
    many = len(layers.read("telemetry_curated", ["2026-08-01"]).inputFiles())
    layers.close_days("telemetry_curated", ["2026-08-01", "2026-08-02", "2026-08-09"])
    assert sorted(map(str, layers.read("telemetry_curated").collect())) == before == sorted(map(str, old.collect()))
    assert layers.read("telemetry_curated", ["2026-08-01"]).count() == first_day > 2 and many > 1
    closed = layers._by_day("telemetry_curated_closed", ["2026-08-01"])
    assert len(closed.inputFiles()) == 1 and closed.count() == first_day
    satellites = [(r.satellite_id, r.ground_station_id, r.subsystem) for r in closed.collect()]
    assert satellites == sorted(satellites)
    layers.close_days("telemetry_curated", ["2026-08-01"])
    assert layers.day_versions("telemetry_curated_closed") == {"2026-08-01": 1, "2026-08-02": 1}

    # the stream goes on from its log, unaware of this
    (tmp_path / "in" / "900.txt").write_bytes(payload(message_id="new", event_timestamp="2026-08-07T00:00:00Z", received_timestamp="2026-08-09T00:00:00Z") + b"\n")
    streaming.drain(stream, layers, str(tmp_path / "checkpoints"), as_of=AS_OF, tables=["telemetry_curated"])
    assert layers.read("telemetry_curated").count() == len(before) + 1
    with pytest.raises(ValueError, match="has no stream"):
        Layers(spark, str(tmp_path / "other")).create().close_days("telemetry_raw", ["2026-08-01"])
