"""Gold tables and reports against brute force and planted facts."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from skyledger import fixed_values as fv
from skyledger.operators.gaps import silent_spans
from skyledger.plans import gold, reports

START = datetime(2026, 8, 1)


def silver_rows(spark, rows):
    """rows: (satellite, subsystem, event time, changes)."""
    names = ["satellite_id", "subsystem", "ground_station_id", "event_timestamp", "latency_ms", "battery_voltage_v",
             "internal_temp_c", "signal_strength_dbm", "bit_error_rate", "comm_status"]
    data = []
    for satellite, subsystem, time, changes in rows:
        base = dict.fromkeys(names) | {"satellite_id": satellite, "subsystem": subsystem, "ground_station_id": "GS-1",
                                       "event_timestamp": time, "latency_ms": 2000} | changes
        data.append(tuple(base[n] for n in names))
    schema = ("satellite_id string, subsystem string, ground_station_id string, event_timestamp timestamp_ntz, "
              "latency_ms bigint, battery_voltage_v double, internal_temp_c double, signal_strength_dbm double, "
              "bit_error_rate double, comm_status string")
    df = spark.createDataFrame(data, schema)
    return df.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


def brute_gaps(events, over):
    spans = []
    for key in {k for k, _ in events}:
        times = sorted(t for k, t in events if k == key)
        for a, b in zip(times, times[1:]):
            minutes = int((b - a) / timedelta(minutes=1))
            if minutes > over:
                spans.append((key, a, b, minutes))
    return sorted(spans)


@pytest.mark.parametrize("seed", range(4))
def test_gaps_equal_plain_lookback(spark, seed):
    rng = random.Random(seed)
    events, time = [], START - timedelta(days=20000 * (seed % 2))
    for _ in range(400):
        time += timedelta(microseconds=rng.choice([0, 1, 299_999_999, 300_000_000, 359_999_999, 360_000_000,
                                                   360_000_001, rng.randint(1, 4_000_000_000)]))
        events += [(rng.choice("ab"), time)] * rng.randint(1, 2)
    df = spark.createDataFrame(events, "k string, t timestamp_ntz").withColumn("t", F.col("t").cast("timestamp"))
    for over in (5, 30):
        got = silent_spans(df, "k", "t", over).select(
            "k", F.col("gap_start").cast("timestamp_ntz"), F.col("gap_end").cast("timestamp_ntz"), "gap_minutes")
        assert sorted(tuple(r) for r in got.collect()) == brute_gaps(events, over)


def test_gap_severity_bounds(spark):
    minutes = [5, 6, 29, 30, 359, 360]
    rows, time = [], START
    for gap in minutes:
        rows.append(("SAT-01", "POWER", time, {}))
        time += timedelta(minutes=gap)
    rows.append(("SAT-01", "POWER", time, {}))
    got = [(r.gap_minutes, r.gap_severity) for r in gold.gold_contact_gaps(silver_rows(spark, rows)).collect()]
    assert got == [(360, fv.MAJOR_GAP), (359, fv.SIGNIFICANT_GAP), (30, fv.SIGNIFICANT_GAP),
                   (29, fv.MINOR_GAP), (6, fv.MINOR_GAP)]


@pytest.fixture(scope="module")
def day(spark):
    """One day of five-minute ticks: SAT-07 silent from 14:20 to 20:20, SAT-11 weak."""
    rows = []
    for tick in range(288):
        time = START + timedelta(minutes=5 * tick)
        silent = timedelta(hours=14, minutes=20) <= time - START < timedelta(hours=20, minutes=20)
        if not silent:
            rows.append(("SAT-07", "POWER", time, {"battery_voltage_v": 28.0}))
            rows.append(("SAT-07", "COMMS", time, {
                "signal_strength_dbm": -65.0, "bit_error_rate": 0.0005, "comm_status": "NOMINAL"}))
        rows.append(("SAT-11", "COMMS", time, {
            "signal_strength_dbm": -100.0, "bit_error_rate": 0.001, "comm_status": "LOST"}))
    return silver_rows(spark, rows).cache()


def test_planted_silence_is_found(day):
    gaps = gold.gold_contact_gaps(day).collect()
    assert [(g.satellite_id, g.gap_minutes, g.gap_severity) for g in gaps] == [("SAT-07", 365, fv.MAJOR_GAP)]


def test_planted_weak_link_is_found(day):
    comms = day.filter("subsystem = 'COMMS'")
    weakest = reports.weakest_communication_satellite(gold.gold_communication_health(comms)).collect()
    assert [tuple(r) for r in weakest] == [("SAT-11", -100.0, 0.001, 0, 288, 1.0)]


def test_health_and_dashboard(day):
    health = {r.satellite_id: r for r in gold.gold_satellite_health(day).collect()}
    s7 = health["SAT-07"]
    assert (s7.telemetry_rows, s7.power_readings, s7.comms_readings) == (432, 216, 216)
    assert (s7.avg_internal_temp_c, s7.communication_issue_rate, s7.daily_completeness_rate) == (None, 0.0, 0.375)
    board = {r.satellite_id: r for r in reports.mission_operations_dashboard(gold.gold_satellite_health(day)).collect()}
    assert board["SAT-07"].completeness_pct == 37.5
    assert board["SAT-11"].communication_issue_pct == 100.0
    assert board["SAT-11"].max_latency_ms == 2000.0


def test_issue_rate_without_comms_is_null(spark):
    telemetry = silver_rows(spark, [("SAT-01", "POWER", START, {})])
    assert gold.gold_satellite_health(telemetry).first().communication_issue_rate is None


def test_completeness_as_stated_and_per_reading(day):
    grid = {"start": "2026-08-01 00:00:00", "end": "2026-08-02 23:55:00"}
    rows = {(r.satellite_id, str(r.event_date)): tuple(r)[2:] for r in gold.gold_data_completeness(day, **grid).collect()}
    assert len(rows) == 24
    assert rows["SAT-07", "2026-08-01"] == (288, 432, -144, 1.5)
    assert rows["SAT-07", "2026-08-02"] == (288, 0, 288, 0.0)
    four = {(r.satellite_id, str(r.event_date)): tuple(r)[2:]
            for r in gold.gold_data_completeness(day, **grid, readings_per_tick=4).collect()}
    assert four["SAT-07", "2026-08-01"] == (1152, 432, 720, 0.375)


def test_default_grid_is_fourteen_days(day):
    rows = gold.gold_data_completeness(day)
    assert rows.agg(F.sum("expected_readings")).first()[0] == 4032 * 12
    assert rows.count() == 14 * 12


def test_quality_of_nothing_has_null_rates(spark, day):
    empty = spark.createDataFrame([], "quarantined_at timestamp, reason_code string")
    row = gold.gold_pipeline_quality(
        empty, day.limit(0).withColumn("dedup_key", F.lit("k")), empty).first()
    assert (row.raw_records, row.curated_records, row.quarantined_records) == (0, 0, 0)
    assert row.quarantine_rate is None and row.avg_latency_ms is None


def test_dimensions(spark):
    satellites = {r.satellite_id: tuple(r)[1:] for r in gold.dim_satellite(
        gold.inline_ids(spark, "satellite_id", fv.SATELLITES)).collect()}
    assert len(satellites) == 12
    assert satellites["SAT-07"] == ("DROP_OUT_TEST_SATELLITE", True, False)
    assert satellites["SAT-11"] == ("DEGRADED_COMMS_TEST_SATELLITE", False, True)
    assert satellites["SAT-01"] == ("NOMINAL", False, False)
    stations = dict(gold.dim_ground_station(
        gold.inline_ids(spark, "ground_station_id", fv.GROUND_STATIONS + ["GS-9"])).collect())
    assert stations == {"GS-1": "Ground Station 1", "GS-2": "Ground Station 2", "GS-3": "Ground Station 3",
                        "GS-4": "Ground Station 4", "GS-9": None}


def test_no_cross_joins(day):
    raw = day.select("satellite_id")
    quarantine = day.select(F.col("event_timestamp").alias("quarantined_at"), F.col("subsystem").alias("reason_code"))
    for df in (gold.gold_data_completeness(day),
               gold.gold_pipeline_quality(raw, day.withColumn("dedup_key", F.lit("k")), quarantine)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
