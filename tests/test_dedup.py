"""One curated row per reading, whatever the copies and their order."""

import json
import random

from conftest import AS_OF, record
from pyspark.sql import functions as F

from skyledger.operators.dedup import dedup_batch, event_days, without_known
from skyledger.plans import gold, ingest, silver


def some_records(count=60):
    rng = random.Random(11)
    subsystems = ["POWER", "THERMAL", "COMMS", "ORBITAL"]
    return [
        record(
            subsystems[n % 4], message_id=f"m{n:03d}", satellite_id=f"SAT-{rng.randint(1, 12):02d}",
            event_timestamp=f"2026-08-0{1 + n % 3}T{n % 24:02d}:{n % 60:02d}:00Z",
            received_timestamp="2026-08-09T00:00:00Z",
        )
        for n in range(count)
    ]


def as_messages(messages, records):
    return messages([json.dumps(r).encode() for r in records])


def keys(curated):
    return sorted(r.dedup_key for r in curated.select("dedup_key").collect())


def test_first_received_copy_survives(messages):
    copies = [
        record(message_id="late", received_timestamp="2026-08-01T00:00:09Z"),
        record(message_id="b-first", received_timestamp="2026-08-01T00:00:02Z"),
        record(message_id="a-first", received_timestamp="2026-08-01T00:00:02Z"),
    ]
    for order in (copies, copies[::-1]):
        rows = ingest.curated(as_messages(messages, order), AS_OF).collect()
        assert [r.message_id for r in rows] == ["a-first"]


def test_what_makes_a_reading_different(messages):
    variants = [
        {}, {"event_timestamp": "2026-08-01T00:00:00Z"}, {"ground_station_id": "GS-2"},
        {"satellite_id": "SAT-02"}, {"battery_voltage_v": 28.5}, {"latitude": 1.0}, {"comm_status": "x"},
    ]
    same = [{"message_id": "other"}, {"received_timestamp": "2026-08-02T00:00:00Z"},
            {"battery_voltage_v": "28.0"}, {"longitude": ""}, {"extra": 1}]
    records = [record(**v) for v in variants] + [record(**v) for v in same]
    assert ingest.curated(as_messages(messages, records), AS_OF).count() == len(variants)


def test_shuffled_and_copied_input_gives_the_same_tables(messages):
    records = some_records()
    plain = ingest.curated(as_messages(messages, records), AS_OF)
    noisy = records + [{**r, "message_id": "z" + r["message_id"], "received_timestamp": "2026-08-10T00:00:00Z"}
                       for r in records for _ in range(2)]
    random.Random(5).shuffle(noisy)
    mixed = ingest.curated(as_messages(messages, noisy), AS_OF)
    assert keys(plain) == keys(mixed) and len(keys(plain)) == len(records)
    health = [gold.gold_satellite_health(silver.silver_telemetry(c)) for c in (plain, mixed)]
    assert sorted(map(str, health[0].collect())) == sorted(map(str, health[1].collect()))


def test_a_key_with_a_third_of_all_rows_is_cut_before_the_shuffle(spark):
    rows = spark.range(0, 30000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("dedup_key"),
        F.lit("SAT-01").alias("satellite_id"), F.lit("POWER").alias("subsystem"),
        F.timestamp_seconds(F.lit(0)).alias("event_timestamp"),
        F.timestamp_seconds("id").alias("received_timestamp"), F.col("id").cast("string").alias("message_id"),
    )
    deduped = dedup_batch(rows)
    assert deduped.count() == 20001
    assert deduped.filter("dedup_key = 'hot'").first().message_id == "0"
    plan = deduped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_filters_on_reading_columns_pass_below_the_dedup(messages):
    telemetry = silver.silver_telemetry(ingest.curated(as_messages(messages, some_records(4)), AS_OF))
    plan = silver.silver_comms(telemetry)._jdf.queryExecution().optimizedPlan().toString()
    below_window = plan[plan.index("Window ["):]
    assert "= COMMS" in below_window


def test_stored_readings_are_not_new(messages):
    records = some_records(12)
    old = ingest.accepted(ingest.validated(as_messages(messages, records[:8]), AS_OF), AS_OF)
    new = ingest.accepted(ingest.validated(as_messages(messages, records[4:]), AS_OF), AS_OF)
    unseen = without_known(dedup_batch(new), old)
    assert sorted(r.message_id for r in unseen.collect()) == ["m008", "m009", "m010", "m011"]
    assert unseen.columns == new.columns
    assert event_days(new) == ["2026-08-01", "2026-08-02", "2026-08-03"] and event_days(new.limit(0)) == []


def test_the_dedups_shuffle_serves_the_join_with_stored_rows(spark, messages):
    new = ingest.accepted(ingest.validated(as_messages(messages, some_records(4)), AS_OF), AS_OF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        unseen = without_known(dedup_batch(new), new)
        plan = unseen._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 2
