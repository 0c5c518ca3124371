"""Layer tables, the batch job, CSV input and streams."""

import json
from datetime import datetime, timedelta

import pytest
from conftest import AS_OF, payload, record
from pyspark.sql import functions as F

from skyledger import job, schemas
from skyledger.plans import ingest, refresh, reports
from skyledger.sources.layers import LAYOUTS, Layers
from skyledger.sources.messages import read_batch, read_received_csv, read_stream, to_messages
from skyledger.streaming import ingest as streaming


def batch():
    return [payload(s, message_id=f"{s}{n}", event_timestamp=f"2026-08-0{n}T00:00:00Z", received_timestamp="2026-08-09T00:00:00Z")
            for s in ("POWER", "THERMAL", "COMMS", "ORBITAL") for n in (1, 2, 3)] + [b"broken", payload(satellite_id="SAT-99")]


def test_batch_job_builds_every_table(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path))
    refresh.refresh(messages(batch()), layers, AS_OF)
    counts = {t: layers.read(t).count() for t in LAYOUTS}
    assert counts == {
        "telemetry_raw": 14, "telemetry_quarantine": 2, "telemetry_curated": 12, "silver_telemetry": 12,
        "silver_power": 3, "silver_thermal": 3, "silver_comms": 3, "silver_orbital": 3, "fact_telemetry": 12,
        "dim_satellite": 12, "dim_ground_station": 4, "gold_satellite_health": 3, "gold_communication_health": 3,
        "gold_contact_gaps": 2, "gold_data_completeness": 168, "gold_data_quality": 2, "gold_pipeline_quality": 1,
        "gold_gap_segments": 3, "gold_quality_days": 3, "gold_intake_days": 1,
    }
    assert layers.read("telemetry_curated").columns == schemas.CURATED.fieldNames()

    # the same messages again: raw and quarantine keep all, curated stays as it was
    refresh.refresh(messages(batch()), layers, AS_OF)
    again = layers.read("gold_pipeline_quality").first()
    assert (again.raw_records, again.curated_records, again.quarantined_records) == (28, 12, 4)

    for _ in range(2):  # publishing again replaces names, not data
        names = layers.publish("t1_")
    assert len(names) == len(LAYOUTS)
    assert spark.sql("SELECT count(*) FROM t1_silver.silver_power").first()[0] == 3
    days = spark.sql("SELECT count(*) FROM t1_silver.silver_telemetry WHERE partition_date = '2026-08-02'")
    assert days.first()[0] == 4


def test_appends_need_a_table_and_required_values(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path))
    raw = ingest.raw_envelope(messages([payload()]), AS_OF)
    with pytest.raises(ValueError, match="does not exist"):
        layers.append(raw, "telemetry_raw")
    layers.create()
    assert layers.read("telemetry_raw").count() == 0
    layers.append(raw, "telemetry_raw")
    with pytest.raises(Exception, match="required column source"):
        layers.append(raw.withColumn("source", F.lit(None).cast("string")), "telemetry_raw")
    assert layers.create().read("telemetry_raw").count() == 1


def test_a_large_day_is_written_by_many_tasks(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    hot = spark.range(0, 200000, 1, 8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("message_id"), F.lit("SAT-01").alias("satellite_id"),
        F.lit("GS-1").alias("ground_station_id"), F.lit("POWER").alias("subsystem"),
        F.timestamp_seconds(F.lit(1785542400)).alias("event_timestamp"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        layers.replace(hot, "silver_telemetry")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = layers.read("silver_telemetry")
    assert stored.count() == 200000 and len(stored.inputFiles()) > 2


def test_csv_rows_replay_as_messages(spark, tmp_path):
    names = schemas.PAYLOAD_FIELDS + schemas.ANSWER_KEY_FIELDS
    rows = [record("POWER", message_id="ok"), record("COMMS", message_id="bad", bit_error_rate="N/A"),
            record("THERMAL", message_id="blank", internal_temp_c=None)]
    lines = [",".join(names)] + [
        ",".join("" if r.get(n) is None else str(r[n]) for n in names[:18]) + ",false,,false," for r in rows]
    (tmp_path / "received.csv").write_text("\n".join(lines) + "\n")
    received = read_received_csv(spark, str(tmp_path / "received.csv"))
    assert received.columns == names and received.count() == 3
    reasons = ingest.validated(to_messages(received), AS_OF).select("message_id", "reason_code", "reason_detail")
    assert sorted(tuple(r) for r in reasons.collect()) == [
        ("bad", "INVALID_NUMERIC_TYPE", "COMMS"), ("blank", "INVALID_NUMERIC_TYPE", "THERMAL"), ("ok", None, None)]


def write_files(folder, files):
    folder.mkdir()
    for number, bodies in enumerate(files):
        path = folder / f"{number:03d}.txt"
        path.write_bytes(b"\n".join(bodies) + b"\n")
        stamp = 1_700_000_000 + number
        __import__("os").utime(path, (stamp, stamp))
    return str(folder)


def test_stream_equals_batch(spark, tmp_path):
    folder = write_files(tmp_path / "in", [batch(), batch()[:5]])
    layers = Layers(spark, str(tmp_path / "out"))
    stream = read_stream(spark, "text", folder)
    streaming.drain(stream, layers, str(tmp_path / "checkpoints"), as_of=AS_OF)
    stored = read_batch(spark, "text", folder)
    assert layers.read("telemetry_raw").count() == 19
    for table, expected in (("telemetry_quarantine", ingest.quarantine(stored, AS_OF)),
                            ("telemetry_curated", ingest.curated(stored, AS_OF))):
        names = [c for c in expected.columns if c not in ("message_id", "received_timestamp")]
        rows = [sorted(map(str, df.select(names).collect())) for df in (layers.read(table), expected)]
        assert rows[0] == rows[1] and rows[0]

    # a second run goes on from the checkpoint: new files only
    (tmp_path / "in" / "900.txt").write_bytes(payload(message_id="new", event_timestamp="2026-08-07T00:00:00Z",
                                                      received_timestamp="2026-08-09T00:00:00Z") + b"\n")
    streaming.drain(stream, layers, str(tmp_path / "checkpoints"), as_of=AS_OF)
    assert layers.read("telemetry_raw").count() == 20
    assert layers.read("telemetry_curated").count() == 13

    with pytest.raises(ValueError, match="belongs to a stream"):
        layers.append(ingest.raw_envelope(stored, AS_OF), "telemetry_raw")


def test_streams_do_not_join_batch_tables(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path / "out")).create()
    layers.append(ingest.raw_envelope(messages([payload()]), AS_OF), "telemetry_raw")
    stream = read_stream(spark, "text", write_files(tmp_path / "in", [batch()]))
    with pytest.raises(ValueError, match="batch files"):
        streaming.start(stream, layers, str(tmp_path / "c"), tables=["telemetry_raw"])


@pytest.mark.parametrize("spread", [1, 16])
def test_late_rows_and_late_copies(spark, tmp_path, spread):
    def at(clock, message_id):
        received = (datetime(2026, 8, 1) + timedelta(days=1)).isoformat()
        return json.dumps(record("POWER", message_id=message_id, event_timestamp=f"2026-08-01T{clock}:00Z",
                                 received_timestamp=received)).encode()

    files = [
        [at("03:00", "a")],                                                   # watermark becomes 02:00
        [at("02:59", "b"), at("03:00", "copy")],                              # a copy in a later micro-batch
        [at("00:30", "late"), at("02:30", "in-time"), at("02:59", "copy")],   # 00:30 is too late
        [at("03:10", "c")],
    ]
    folder = write_files(tmp_path / "in", files)
    stream = read_stream(spark, "text", folder, maxFilesPerTrigger=1)
    query = (
        streaming.stream_curated(stream, AS_OF, spread=spread).writeStream.format("parquet")
        .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    kept = sorted(r.message_id for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert kept == ["a", "b", "c", "in-time"]
    assert streaming.LateRows(query).update() == 1


def test_day_range_reads_only_its_partitions(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path))
    refresh.refresh(messages(batch()), layers, AS_OF)
    found = layers.read("silver_telemetry", days=("2026-08-02", "2026-08-02"))
    assert found.count() == 4 and "partition_date" not in found.columns
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    with pytest.raises(ValueError, match="not stored by day"):
        layers.read("dim_satellite", days=("2026-08-02", "2026-08-02"))


def test_a_batch_leaves_no_staged_rows(spark, messages, tmp_path, monkeypatch):
    monkeypatch.setattr(refresh, "shared_dir", lambda _, purpose: f"{tmp_path}/{purpose}-x")
    layers = Layers(spark, f"{tmp_path}/layers")
    refresh.refresh(messages(batch()), layers, AS_OF)
    assert not (tmp_path / "validated-x").exists()


def test_late_rows_are_counted_beyond_the_reports_held(spark):
    class Query:
        recentProgress = []

    def report(number, rows):
        return {"batchId": number, "stateOperators": [{"numRowsDroppedByWatermark": rows}]}

    query, late = Query(), None
    late = streaming.LateRows(query)
    for held, total in [
        ([(0, 1), (1, 2)], 3), ([(1, 2), (2, 4)], 7), ([(2, 4), (3, 0)], 7),
        ([(3, 0), (3, 5)], 12), ([(3, 5), (4, 1)], 13), ([(4, 1), (4, 0)], 13),
    ]:
        query.recentProgress = [report(*h) for h in held]
        assert late.update() == total and late.update() == total
    query.recentProgress = [report(6, 0)]
    with pytest.raises(RuntimeError, match="batches 5 to 5"):
        late.update()


def test_watch_counts_with_two_reports_held(spark, tmp_path):
    def at(clock, message_id):
        return json.dumps(record("POWER", message_id=message_id, event_timestamp=f"2026-08-01T{clock}:00Z",
                                 received_timestamp="2026-08-02T00:00:00Z")).encode()

    files = [[at("03:00", "a")], [at("03:01", "b")], [at("00:30", "late")]] + [[at(f"03:1{n}", f"c{n}")] for n in range(4)]
    stream = read_stream(spark, "text", write_files(tmp_path / "in", files), maxFilesPerTrigger=1)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        query = (
            streaming.stream_curated(stream, AS_OF).writeStream.format("parquet")
            .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c"))
            .trigger(availableNow=True).start()
        )
        assert streaming.watch(query, 0.05) == 1
        assert len(query.recentProgress) < len(files)  # Spark no longer holds them all
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_a_failed_replace_keeps_the_old_table(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    rows = lambda n: spark.range(n).select(F.col("id").cast("string").alias("satellite_id"))
    layers.replace(rows(3), "dim_satellite")
    old = layers.read("dim_satellite")
    with pytest.raises(Exception, match="on purpose"):
        layers.replace(rows(5).withColumn("x", F.raise_error(F.lit("on purpose"))), "dim_satellite")
    assert layers.read("dim_satellite").count() == 3
    layers.replace(rows(4), "dim_satellite")
    assert layers.read("dim_satellite").count() == 4
    assert old.count() == 3  # a reader of the version before still finds its files
    layers.replace(layers.read("dim_satellite").limit(2), "dim_satellite")
    assert layers.read("dim_satellite").count() == 2
    assert len(list((tmp_path / "gold" / "dim_satellite").iterdir())) == 2
    with pytest.raises(ValueError, match="appended to"):
        layers.replace(rows(1), "telemetry_raw")


def test_jobs_and_named_reports(spark, tmp_path):
    folder = write_files(tmp_path / "in", [batch()])
    root = str(tmp_path / "layers")
    job.main(["batch", "--root", root, "--path", folder, "--as-of", AS_OF, "--publish", "t2_",
              "--satellites", "SAT-01,SAT-02", "--grid-start", "2026-08-01", "--grid-end", "2026-08-02"])
    layers = Layers(spark, root)
    assert {r.satellite_id for r in layers.read("gold_data_completeness").collect()} == {"SAT-01", "SAT-02"}
    assert spark.sql("SELECT count(*) FROM t2_gold.dim_satellite").first()[0] == 2
    assert "weakest_communication_satellite" in reports.publish_reports(layers)
    assert spark.sql("SELECT satellite_id FROM weakest_communication_satellite").first()[0] == "SAT-01"
    assert spark.sql("SELECT count(*) FROM subsystem_alerts").first()[0] > 0

    live = str(tmp_path / "live")
    late = job.main(["stream", "--root", live, "--path", folder, "--as-of", AS_OF, "--until-empty",
                     "--checkpoints", str(tmp_path / "checkpoints")])
    assert late == {"telemetry_raw": 0, "telemetry_quarantine": 0, "telemetry_curated": 0}
    assert Layers(spark, live).read("telemetry_curated").count() == 12
