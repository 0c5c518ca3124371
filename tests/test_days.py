"""Touched days, the batch ledger, merging day tables, and the one-pass stream."""

import json
from pathlib import Path

import pytest
from conftest import AS_OF, payload, record
from pyspark.sql import functions as F
from test_stored import batch, write_files

from skyledger.plans import gold, ingest, refresh, silver
from skyledger.sources.layers import Layers
from skyledger.sources.ledger import Ledger
from skyledger.sources.messages import read_stream
from skyledger.streaming import ingest as streaming

BY_DAY = ["silver_telemetry", "silver_power", "fact_telemetry", "gold_satellite_health", "gold_communication_health", "gold_gap_segments", "gold_quality_days"]


def late():
    """A new reading of the second day, a copy of one of the third, and a new day."""
    return [
        payload("POWER", message_id="late", satellite_id="SAT-02", event_timestamp="2026-08-02T05:00:00Z", received_timestamp="2026-08-09T00:00:00Z"),
        payload("POWER", message_id="copy", event_timestamp="2026-08-03T00:00:00Z", received_timestamp="2026-08-10T00:00:00Z"),
        payload("COMMS", message_id="next", event_timestamp="2026-08-05T00:00:00Z", received_timestamp="2026-08-09T00:00:00Z"),
    ]


def files(layers, table, day):
    """Files of a day that readers use, with their times."""
    paths = [Path(p.removeprefix("file:")) for p in layers.read(table, [day]).inputFiles()]
    return sorted((str(p), p.stat().st_mtime_ns) for p in paths)


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_batch_rebuilds_the_days_it_touches(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path / "by-day"))
    refresh.refresh(messages(batch()), layers, AS_OF)
    before = {(t, d): files(layers, t, d) for t in BY_DAY for d in ("2026-08-01", "2026-08-02")}
    assert all(before.values())
    assert refresh.ingest_batch(messages(late()), layers, AS_OF)
    assert layers.read("silver_telemetry").count() == 12  # not yet brought up to date
    assert refresh.refresh_days(layers) == (["2026-08-02", "2026-08-03", "2026-08-05"], [AS_OF[:10]])
    assert refresh.refresh_days(layers) == ([], [])
    for table in BY_DAY:
        assert files(layers, table, "2026-08-01") == before[table, "2026-08-01"]
        assert files(layers, table, "2026-08-02") != before[table, "2026-08-02"]
        assert layers.read(table, ["2026-08-05"]).count() == (0 if table == "silver_power" else 1)

    whole = Layers(spark, str(tmp_path / "whole"))
    whole.create()
    for bodies in (batch(), late()):
        refresh.ingest_batch(messages(bodies), whole, AS_OF)
    refresh.rebuild(whole)
    for table in [*BY_DAY[:-1], "silver_comms", "gold_intake_days", "gold_data_quality", "gold_contact_gaps", "gold_data_completeness", "gold_pipeline_quality"]:
        assert rows(layers.read(table)) == rows(whole.read(table)), table
    telemetry = layers.read("silver_telemetry")
    for table, direct in {
        "gold_contact_gaps": gold.gold_contact_gaps(telemetry), "gold_data_completeness": gold.gold_data_completeness(telemetry),
        "gold_pipeline_quality": gold.gold_pipeline_quality(layers.read("telemetry_raw"), telemetry, layers.read("telemetry_quarantine")),
    }.items():
        assert rows(layers.read(table)) == rows(direct), table


def test_a_day_that_loses_its_rows_goes(spark, tmp_path):
    layers = Layers(spark, str(tmp_path))
    def days(*names):
        made = spark.createDataFrame([(f"SAT-{n}", f"2026-08-{n:02d}") for n in names], "satellite_id string, d string")
        return made.select("satellite_id", F.to_date("d").alias("metric_date"), F.lit(1).alias("telemetry_rows"))

    table = "gold_satellite_health"
    with pytest.raises(ValueError, match="does not exist"):
        layers.read(table)
    layers.replace(days(1, 2, 3), table)
    old = layers.read(table)
    layers.replace(days(2, 9), table, ["2026-08-02", "2026-08-03"])  # rows of other days are not taken
    assert sorted(layers.day_versions(table).items()) == [("2026-08-01", 1), ("2026-08-02", 2)]
    assert old.count() == 3  # a reader of the version before still finds its files
    with pytest.raises(Exception, match="on purpose"):
        layers.replace(days(1).withColumn("telemetry_rows", F.raise_error(F.lit("on purpose")).cast("int")), table, ["2026-08-01"])
    assert layers.read(table).count() == 2
    folder = tmp_path / "gold" / table
    (folder / "version=3" / "partition_date=2026-08-01").mkdir(parents=True)  # left by a writer that was killed
    layers.replace(days(1), table, ["2026-08-01"])
    assert layers.day_versions(table) == {"2026-08-01": 4, "2026-08-02": 2}
    assert sorted(p.name for p in folder.iterdir() if p.name[0] == "v") == ["version=1", "version=2", "version=4"]
    assert [p.name for p in (folder / "version=1").iterdir() if p.is_dir()] == ["partition_date=2026-08-01"]
    layers.replace(days(1).limit(0), table)
    assert layers.read(table).count() == 0 and layers.read(table).columns == ["satellite_id", "metric_date", "telemetry_rows"]
    assert layers.publish("t9_") == ["t9_gold.gold_satellite_health"]


def test_published_days_are_those_that_count(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path))
    refresh.refresh(messages(batch()), layers, AS_OF)
    refresh.refresh(messages(late()), layers, AS_OF)
    layers.ledger.begin("open", AS_OF)
    layers.append(ingest.raw_envelope(messages(late()), AS_OF), "telemetry_raw", "open")
    layers.publish("t8_")
    assert spark.sql("SELECT count(*) FROM t8_silver.silver_telemetry").first()[0] == 14
    assert spark.sql("SELECT count(*) FROM t8_silver.silver_telemetry WHERE partition_date = '2026-08-02'").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM t8_raw.telemetry_raw").first()[0] == 17


def test_a_batch_reads_only_the_days_it_touches(spark, messages, tmp_path):
    layers = Layers(spark, str(tmp_path)).create()
    refresh.ingest_batch(messages(batch()), layers, AS_OF)
    stored = layers.read("telemetry_curated", ["2026-08-02", "2026-08-04"])
    assert {p.split("partition_date=")[1][:10] for p in stored.inputFiles()} == {"2026-08-02"}
    new = ingest.accepted(ingest.validated(messages(late()), AS_OF), AS_OF)
    plan = refresh.without_known(refresh.dedup_batch(new), stored)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan parquet"):]
    schema = scan[scan.index("ReadSchema"):].split("\n")[0]
    assert "PartitionFilters: [partition_date" in scan and "2026-08-01" not in scan
    assert "dedup_key" in schema and "battery_voltage_v" not in schema and "message_id" not in schema


class Died(Exception):
    pass


class Dying(Layers):
    at = ""

    def append(self, df, table, batch_id=None):
        super().append(df, table, batch_id)
        if table == self.at:
            raise Died(table)


@pytest.mark.parametrize("at", ["telemetry_raw", "telemetry_quarantine", "telemetry_curated"])
def test_a_run_that_died_is_repeated_without_doubling(spark, messages, tmp_path, at):
    dying = Dying(spark, str(tmp_path)).create()
    dying.at = at
    layers = Layers(spark, str(tmp_path))
    refresh.ingest_batch(messages(batch()[:5]), layers, AS_OF, "zero")
    with pytest.raises(Died):
        refresh.ingest_batch(messages(batch()), dying, AS_OF, "one")
    def counts():
        return [layers.read(t).count() for t in ("telemetry_raw", "telemetry_quarantine", "telemetry_curated")]

    assert counts() == [5, 0, 5] and layers.ledger.open_batches() == ["one"]  # what died does not count
    assert layers.read("telemetry_raw", batch_id="one").count() == 14
    assert refresh.ingest_batch(messages(late()), layers, AS_OF, "two")  # nor does it keep others from their rows
    assert refresh.ingest_batch(messages(batch()), layers, "2030-01-01 00:00:00", "one")
    assert counts() == [22, 2, 14] and layers.ledger.open_batches() == []
    first = layers.read("telemetry_quarantine", batch_id="one").select("quarantined_at").distinct().collect()
    assert [str(r[0]) for r in first] == [AS_OF]  # by the clock of the run that died
    assert not refresh.ingest_batch(messages(batch()), layers, AS_OF, "one") and counts() == [22, 2, 14]
    with pytest.raises(ValueError, match="counts already"):
        layers.forget("one")


def test_a_refresh_that_died_is_made_good(spark, messages, tmp_path, monkeypatch):
    layers = Layers(spark, str(tmp_path)).create()
    refresh.ingest_batch(messages(batch()), layers, AS_OF, "one")
    with monkeypatch.context() as patched:
        patched.setattr(refresh, "build_totals", lambda *_: (_ for _ in ()).throw(Died()))
        with pytest.raises(Died):
            refresh.refresh_days(layers)
    assert list(layers.ledger.owed()) == ["one"]
    assert refresh.refresh_days(layers)[0] == ["2026-08-01", "2026-08-02", "2026-08-03"]
    assert layers.read("silver_telemetry").count() == 12 and layers.ledger.owed() == {}


def test_the_ledger(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path))
    with pytest.raises(ValueError, match="batch id"):
        ledger.begin("a/b")
    note, died = ledger.begin("a")
    assert not died and note.clock[:2] == "20" and ledger.begin("a", "other") == (note, True)
    ledger.folders.put(ledger._path("owed", "a"), json.dumps({"clock": "x"}))  # died between the notes of a commit
    assert ledger.owed() == {} and ledger.open_batches() == ["a"]
    ledger.commit("a", note)
    ledger.folders.put(ledger._path("open", "a"), json.dumps({"clock": "x"}))  # died before the open note went
    assert ledger.open_batches() == [] and ledger.begin("a") == (None, False) and list(ledger.owed()) == ["a"]
    ledger.settle(["a"])
    assert ledger.owed() == {} and ledger.is_done("a")


def test_segments_of_days_fold_to_the_gaps(spark):
    times = ["00:00", "00:05:59", "00:12", "23:59:59"], ["00:05"], [], ["05:00", "05:06"]
    events = [("SAT-01", f"2026-08-0{n + 1} {t}") for n, day in enumerate(times) for t in day] + [("SAT-02", "2026-08-02 01:00")]
    telemetry = spark.createDataFrame(events, "satellite_id string, t string").select("satellite_id", F.col("t").cast("timestamp").alias("event_timestamp"))
    segments = gold.gold_gap_segments(telemetry)
    assert segments.count() == 4
    direct = gold.gold_contact_gaps(telemetry)
    assert rows(gold.gaps_from_segments(segments)) == rows(direct) and direct.count() == 4
    merged = [segments.filter(F.col("event_date") == d) for d in ("2026-08-04", "2026-08-01", "2026-08-02")]
    assert rows(gold.gaps_from_segments(merged[0].union(merged[1]).union(merged[2]))) == rows(direct)
    assert gold.gaps_from_segments(segments.limit(0)).count() == 0


def test_sketches_of_days_merge(spark):
    def day(n, keys):
        made = spark.range(keys).select(F.sha2(F.concat(F.lit(f"{n}-"), F.col("id").cast("string")), 256).alias("dedup_key"), F.lit(5).cast("long").alias("latency_ms"),
                                        F.timestamp_seconds(F.lit(n * 86400)).alias("event_timestamp"))
        return made

    telemetry = day(1, 30000).union(day(2, 20000))
    days = gold.gold_quality_days(telemetry)
    estimate = gold.estimated_events(days).first()
    assert estimate.unique_semantic_events == 50000 and estimate.within_bound and estimate.estimated_events != 0
    one = gold.estimated_events(days.filter("event_date = '1970-01-02'")).first()
    assert one.unique_semantic_events == 30000 and one.within_bound


def test_the_one_pass_stream_equals_the_batch(spark, tmp_path):
    folder = write_files(tmp_path / "in", [batch(), late(), batch()[:5]])
    stream = read_stream(spark, "text", folder, maxFilesPerTrigger=1)
    layers = Layers(spark, str(tmp_path / "out"))
    streaming.start_fan_out(stream, layers, str(tmp_path / "c"), as_of=AS_OF, trigger={"availableNow": True}).awaitTermination()
    def counts():
        return [layers.read(t).count() for t in ("telemetry_raw", "telemetry_quarantine", "telemetry_curated")]

    assert counts() == [22, 2, 14]
    streaming.start_fan_out(stream, layers, str(tmp_path / "c2"), as_of=AS_OF, trigger={"availableNow": True}).awaitTermination()
    assert counts() == [22, 2, 14]  # the same micro-batches once more
    refresh.refresh_days(layers)
    assert rows(layers.read("gold_contact_gaps")) == rows(gold.gold_contact_gaps(silver.silver_telemetry(layers.read("telemetry_curated"))))


def test_windows_come_out_when_the_watermark_passes(spark, tmp_path):
    def at(clock, message_id, **changes):
        return json.dumps(record("POWER", message_id=message_id, event_timestamp=f"2026-08-01T{clock}Z", received_timestamp="2026-08-02T00:00:00Z", **changes)).encode()

    folder = write_files(tmp_path / "in", [
        [at("03:00:00", "a"), at("03:04:59", "b"), at("03:05:00", "c"), at("03:00:00", "copy")], [at("03:00:00", "copy again"), at("04:06:00", "d")],
        [at("03:01:00", "late, forgiven")], [at("04:20:00", "e")]])
    stream = read_stream(spark, "text", folder, maxFilesPerTrigger=1)
    query = (
        streaming.window_metrics(stream, AS_OF).writeStream.format("parquet").outputMode("append").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(str(r.window_start)[11:16], r.readings, r.lost_links) for r in found] == [("03:00", 3, 0), ("03:05", 1, 0)]
