"""Reason codes: one case per rule and boundary, precedence, and payload forms."""

import json

from conftest import AS_OF, payload, record

from skyledger.plans import ingest

V, W = "MISSING_REQUIRED_FIELD", "OUT_OF_PHYSICAL_RANGE"
NUM = "INVALID_NUMERIC_TYPE"


def without(name):
    fields = record()
    del fields[name]
    return json.dumps(fields).encode()


def ranges():
    limits = {
        "POWER": [("battery_voltage_v", 20, 35), ("battery_current_a", 0, 10), ("solar_output_w", 0, 1000)],
        "THERMAL": [("internal_temp_c", -100, 100), ("external_temp_c", -200, 150)],
        "COMMS": [("bit_error_rate", 0, 1)],
        "ORBITAL": [("latitude", -90, 90), ("longitude", -180, 180), ("altitude_km", 0, 2000), ("velocity_kms", 0, 15)],
    }
    for subsystem, columns in limits.items():
        for name, low, high in columns:
            yield payload(subsystem, **{name: low}), None, None
            yield payload(subsystem, **{name: high}), None, None
            yield payload(subsystem, **{name: low - 0.001}), W, name
            yield payload(subsystem, **{name: high + 0.001}), W, name
            for bad in (None, "", "N/A", "28.0f", "0x1p3", "true", [1], [True], {"a": 1}):
                yield payload(subsystem, **{name: bad}), NUM, subsystem
            for infinite in ("NaN", "inf", "-Infinity", float("nan"), float("inf")):
                yield payload(subsystem, **{name: infinite}), W, name


def signals():
    nominal, degraded, lost = (
        "Signal >= -80 dBm must be NOMINAL", "Signal between -95 and -80 dBm must be DEGRADED",
        "Signal below -95 dBm must be LOST")
    bad = "INCONSISTENT_COMM_STATUS"
    for signal, right, text in [
        (0, "NOMINAL", nominal), (-80.0, "NOMINAL", nominal), (-80.1, "DEGRADED", degraded),
        (-95.0, "DEGRADED", degraded), (-95.1, "LOST", lost), (-150, "LOST", lost),
    ]:
        for status in ("NOMINAL", "DEGRADED", "LOST"):
            expected = (None, None) if status == right else (bad, text)
            yield payload("COMMS", signal_strength_dbm=signal, comm_status=status), *expected
    yield payload("COMMS", signal_strength_dbm=0.1), W, "signal_strength_dbm"
    yield payload("COMMS", signal_strength_dbm=-150.1), W, "signal_strength_dbm"
    yield payload("COMMS", comm_status="UNKNOWN"), "INVALID_COMM_STATUS", "UNKNOWN"
    yield payload("COMMS", comm_status=None), "INVALID_COMM_STATUS", "None"
    yield payload("COMMS", comm_status=""), "INVALID_COMM_STATUS", ""


def precedence():
    """Two faults: the earlier rule is named."""
    yield payload(satellite_id="SAT-99", message_id=""), V, "message_id"
    yield payload(satellite_id="SAT-99", ground_station_id="GS-9"), "INVALID_SATELLITE", "SAT-99"
    yield payload(ground_station_id="GS-9", subsystem="X"), "INVALID_GROUND_STATION", "GS-9"
    yield payload(subsystem="X", event_timestamp="x"), "INVALID_SUBSYSTEM", "X"
    yield (payload(event_timestamp="2100-01-01T00:00:00Z", received_timestamp="x"),
           "INVALID_TIMESTAMP", "Invalid isoformat string: 'x'")
    yield (payload(event_timestamp="2100-01-01T00:00:00Z"), "FUTURE_EVENT_TIMESTAMP", "2100-01-01T00:00:00Z")
    yield (payload(received_timestamp="2026-07-31T23:59:59Z", battery_voltage_v=-1),
           "INVALID_RECEIVED_TIMESTAMP", "received_timestamp is before event_timestamp")
    yield payload(battery_voltage_v=-1, battery_current_a="N/A"), W, "battery_voltage_v"
    yield payload(battery_voltage_v="N/A", battery_current_a=-1), NUM, "POWER"
    yield payload("COMMS", bit_error_rate=2, comm_status="UNKNOWN"), W, "bit_error_rate"
    yield payload(latitude="abc"), NUM, "POWER"
    yield payload(latitude="abc", battery_voltage_v=-1), W, "battery_voltage_v"
    yield payload(latitude="", longitude=None, altitude_km=99999), None, None


def required():
    for name in ("message_id", "satellite_id", "ground_station_id", "subsystem",
                 "event_timestamp", "received_timestamp"):
        for body in (without(name), payload(**{name: None}), payload(**{name: ""})):
            yield body, V, name
    yield b'{"message_id":"broken-json"}', V, "satellite_id"
    yield b"{}", V, "message_id"
    yield payload(satellite_id=["SAT-01"]), "INVALID_SATELLITE", '["SAT-01"]'
    yield payload(received_timestamp="2026-08-01T00:00:00+00:00"), None, None


def forms():
    good = payload()
    invalid, non_object = "Payload is not valid JSON", "Payload must be a JSON object"
    for body in (b"", b"  ", b"nonsense", good[:-1], good.replace(b'"', b"'"), b"{,}", b"\xef\xbb\xbf" + good):
        yield body, "INVALID_JSON", invalid
    for body in (b"[" + good + b"]", b"[]", b"null", b"true", b"17", b'"text"'):
        yield body, "INVALID_JSON", non_object
    for body in (good + b" trailing", good + good, good + b"," + good, good + b"],[" + good, good + b"]",
                 good + b"}", good + b',"x":' + good):
        yield body, "INVALID_JSON", None
    yield b"\n " + good + b" \t\r\n", None, None
    yield good.replace(b'"SAT-01"', b'"SAT-99", "satellite_id": "SAT-02"'), None, None
    yield payload(battery_voltage_v="2_8"), None, None
    yield payload(battery_voltage_v=" 28 "), None, None
    yield payload(is_malformed="true", other={"a": [1]}), None, None
    yield payload(other="],[", list=[[1], {"a": []}]), None, None
    yield b'{"message_id": "\xff\xfe"}', V, "satellite_id"


def test_reasons(messages):
    cases = [case for group in (required, precedence, ranges, signals, forms) for case in group()]
    expected = {}
    for body, code, detail in cases:
        text = body.decode("utf-8", errors="replace")
        assert expected.setdefault(text, (code, detail)) == (code, detail), text
    checked = ingest.validated(messages([body for body, _, _ in cases]), AS_OF)
    rows = checked.select("raw_payload", "reason_code", "reason_detail").collect()
    assert len(rows) == len(cases)
    wrong = []
    for row in rows:
        code, detail = expected[row.raw_payload]
        if code == "INVALID_JSON" and detail is None:
            detail = row.reason_detail
        if (row.reason_code, row.reason_detail) != (code, detail):
            wrong.append((row, code, detail))
    assert not wrong, wrong[:5]


def test_now_decides_the_future(messages):
    body = messages([payload(event_timestamp="2026-08-10T00:00:00Z", received_timestamp="2026-08-10T00:00:01Z")])
    for as_of, code in (("2026-08-09 23:59:59", "FUTURE_EVENT_TIMESTAMP"), ("2026-08-10 00:00:00", None)):
        assert ingest.validated(body, as_of).first().reason_code == code


def test_raw_keeps_every_payload(messages):
    bodies = [payload(), b"nonsense", b'{"message_id":7,"subsystem":"X"}', b"[1]", b"\xff{}", b""]
    rows = ingest.raw_envelope(messages(bodies), AS_OF).collect()
    found = {row.raw_payload: (row.message_id, row.satellite_id, row.subsystem) for row in rows}
    assert found == {
        bodies[0].decode(): ("m1", "SAT-01", "POWER"),
        "nonsense": (None, None, None),
        '{"message_id":7,"subsystem":"X"}': ("7", None, "X"),
        "[1]": (None, None, None),
        "�{}": (None, None, None),
        "": (None, None, None),
    }


def test_quarantine_and_curated_split_all_rows(messages):
    bodies = [payload(), payload(battery_voltage_v=-500), payload(event_timestamp="2026-13-01T00:00:00Z")]
    checked = ingest.validated(messages(bodies), AS_OF)
    rejected = {row.reason_code: row for row in ingest.quarantined(checked, AS_OF).collect()}
    assert set(rejected) == {"OUT_OF_PHYSICAL_RANGE", "INVALID_TIMESTAMP"}
    assert rejected["INVALID_TIMESTAMP"].event_timestamp is None
    assert rejected["OUT_OF_PHYSICAL_RANGE"].event_timestamp is not None
    kept = ingest.accepted(checked, AS_OF).collect()
    assert [(r.message_id, r.source_ground_station, r.pipeline_version) for r in kept] == [("m1", "GS-1", "1.0.0")]


def test_foreign_infinities_are_no_json(spark, messages):
    """Python's parser takes NaN, Infinity and -Infinity, and no other spelling; texts may hold any."""
    base = json.loads(payload())
    for token, code in [("+INF", "INVALID_JSON"), ("-INF", "INVALID_JSON"), ("+Infinity", "INVALID_JSON"), ("INF", "INVALID_JSON")]:
        text = json.dumps(base)[:-1] + ', "extra": ' + token + "}"
        assert [r.reason_code for r in ingest.validated(messages([text.encode()]), AS_OF).collect()] == [code]
    text = json.dumps(base | {"extra": '+INF " -INF'})
    assert [r.reason_code for r in ingest.validated(messages([text.encode()]), AS_OF).collect()] == [None]
