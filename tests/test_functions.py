"""Parsing and canonical text against Python's own float, datetime, json and hashlib."""

import hashlib
import json
import math
import random
from datetime import datetime, timezone

from conftest import AS_OF, payload, record
from pyspark.sql import functions as F

from skyledger.functions.canonical import float_text, json_text
from skyledger.functions.parsing import number, utc_time
from skyledger.plans import ingest
from skyledger.schemas import IDENTITY_FIELDS, MEASURES


def python_time(text):
    if text.startswith("0000"):
        return None
    try:
        time = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    if time.tzinfo is None:
        time = time.replace(tzinfo=timezone.utc)
    return time.astimezone(timezone.utc).replace(tzinfo=None)


def test_times(spark):
    texts = [
        "2026-08-01", "2026-08-01T10", "2026-08-01T10:15", "2026-08-01T10:15:30", "2026-08-01 10:15:30",
        "2026-08-01T10:15:30Z", "2026-08-01T10:15:30.5Z", "2026-08-01T10:15:30.1234567Z", "2026-08-01T10:15:30,25",
        "2026-08-01T10:15:30+05:30", "2026-08-01T10:15:30-0530", "2026-08-01T10:15:30+05",
        "2026-08-01T10:15:30+05:30:15", "20260801", "20260801T101530", "20260801T1015", "20260801T10",
        "20260801T101530.25Z", "2026-08-01T101530", "20260801T10:15:30", "2026-08-01x10:15:30",
        "2026-W31", "2026-W31-6", "2026W316", "2026W31", "2026-W31-6T10:15:30Z", "2026-W53-1", "2020-W53-7",
        "2026-W00-1", "2026-08-01Z", "2026-02-28T23:59:59.999999Z", "2024-02-29",
        "", " ", "x", "not-a-time", "2026", "2026-08", "2026-8-1", "2026-02-30", "2026-13-01", "T10:15",
        "2026-08-01T", "2026-08-01T1", "2026-08-01T24:00:00", "2026-08-01T10:60:00", "2026-08-01T10:15:60",
        "2026-08-01T10:15:30z", "2026-08-01T10:15:30 UTC", "2026-08-01T10:15:30Europe/Paris",
        "2026-08-01T10:15:30.", "0000-01-01", "2026-0801", "202608-01", " 2026-08-01", "2026-08-01 ", "now",
        "2026-08-01T10:15:30+18:00", "2026-08-01T10:15:30+18:30", "2026-08-01T10:15:30.25-19:00", "2026-08-01T10:15:30+23:59",
        "2026-08-01T10:15:30-23:59:59", "2026-08-01T10:15:30+24:00", "2026-08-01T10:15:30-99", "2026-08-01 05+2330",
        "20260801T0500-190030", "2026-08-01-05-19", "2026-08-01-19", "2026-08-19", "2026-W31-6T10-20", "2026-08-01T10:60:00+20:00",
        "2026-02-30T10:00:00+20:00", "2026-08-01T10:15:30+20:", "2026-08-01T10:15:30,5+20", "20260801-2000", "2026-08-01+20:00",
        "2026-08-01T10+05:30", "2026-08-01T10:15Z", "2026-08-01T1015-0800", "2026-08-01T10:15+02", "2026-W31-6T10Z", "20260801T10+0530",
    ]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", F.expr(utc_time("t")).cast("timestamp_ntz").alias("time")).collect()
    wrong = [(r.t, r.time, python_time(r.t)) for r in got if r.time != python_time(r.t)]
    assert not wrong, wrong


def python_float(text):
    try:
        return float(text)
    except ValueError:
        return None


def test_numbers(spark):
    texts = ["1", "-1.5", "+2", ".5", "5.", "1e3", "1E-3", "1_000", "1__0", "_1", " 7 ", "inf", "-inf", "Infinity",
             "nan", "1e400", "", "x", "1d", "1f", "0x1p3", "true", "1,5", "--1", "1e", "e1", ".",
             '"28"', '28"', '"""28', '""', '"nan"']
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(number("t")).alias("x")).collect()
    same = lambda a, b: a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    wrong = [(r.t, r.x, python_float(r.t)) for r in got if not same(r.x, python_float(r.t))]
    assert not wrong, wrong


def test_float_text_is_pythons(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, 28.1, 1e-4, 1.2e-4, -1.25e-4, 9.9e-5, 1e-5, 1.5e-10, 1e7, 12345678.0, 1234567890.5,
              -98765432.125, 1e15, 1e16, 1.5e16, 1e22, 1.5e300, 1.5e-300, 123456789012345.0]
    values += [round(rng.uniform(-200, 200), rng.randint(0, 6)) for _ in range(300)]
    values += [round(rng.uniform(0, 0.002), 6) for _ in range(300)]
    values += [rng.randint(1, 10**9) / 64 for _ in range(200)]
    got = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", F.expr(float_text("x")).alias("t")).collect()
    wrong = [(r.x, r.t) for r in got if r.t != repr(r.x)]
    assert not wrong, wrong[:5]


def test_json_text(spark):
    texts = ["NOMINAL", 'a"b', "a\\b", "a\nb", "a\tb", "", "a/b", "}{,:"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.expr(json_text("t")).alias("j")).collect()
    assert [(r.t, r.j) for r in got if r.j != json.dumps(r.t)] == []


def test_dedup_key_is_the_hash_of_sorted_compact_json(messages):
    rng = random.Random(3)
    records = [
        record("POWER", message_id="a", battery_voltage_v="28.10", solar_output_w=140),
        record("COMMS", message_id="b", bit_error_rate=0.00012),
        record("COMMS", message_id="c", bit_error_rate="1.2e-05", event_timestamp="2026-08-01T00:00:00Z"),
        record("THERMAL", message_id="d", comm_status='odd "text"\\', longitude=""),
        record("ORBITAL", message_id="e", latitude=-0.0005, longitude=-1e-7),
        record("ORBITAL", message_id="f", battery_voltage_v=123456789.0),
    ]
    for n in range(100):
        records.append(record("COMMS", message_id=f"r{n}", bit_error_rate=round(rng.uniform(0, 0.001), rng.randint(4, 9))))
    expected = {}
    for fields in records:
        identity = {f: fields[f] for f in IDENTITY_FIELDS}
        identity |= {f: None if identity[f] in (None, "") else float(identity[f]) for f in MEASURES}
        text = json.dumps(identity, sort_keys=True, separators=(",", ":"))
        expected[fields["message_id"]] = hashlib.sha256(text.encode()).hexdigest()
    rows = ingest.accepted(ingest.validated(messages([json.dumps(r).encode() for r in records]), AS_OF), AS_OF).collect()
    assert {r.message_id: r.dedup_key for r in rows} == expected


def test_utf8_replacement_is_pythons(messages):
    bodies = [b"\xff", b"a\xc3", b"\xe2\x82", b"\xf0\x9f\x98\x80", b"\xc0\xaf", b"ok \xed\xa0\x80 x", b"caf\xc3\xa9"]
    rows = ingest.raw_envelope(messages(bodies), AS_OF).select("raw_payload").collect()
    assert sorted(r.raw_payload for r in rows) == sorted(b.decode("utf-8", errors="replace") for b in bodies)


def test_payload_constant_is_valid(messages):
    for subsystem in ("POWER", "THERMAL", "COMMS", "ORBITAL"):
        assert ingest.validated(messages([payload(subsystem)]), AS_OF).first().reason_code is None
