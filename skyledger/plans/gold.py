"""Gold tables: dimensions, fact, daily health, gaps, completeness and quality rates."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.metrics import avg_where, count_where, rate, utc_date
from skyledger.operators.gaps import fold_segments, gap_segments, silent_spans
from skyledger.operators.grid import expected_per_day


# --- dimensions and fact ----------------------------------------------------------------------

def inline_ids(spark: SparkSession, name: str, ids: list[str]) -> DataFrame:
    """A constant list as a one-column relation."""
    return spark.createDataFrame([(value,) for value in ids], f"{name} string")


def dim_satellite(satellites: DataFrame) -> DataFrame:
    """One row per satellite of the given relation: test profile and its flags."""
    satellite = F.col("satellite_id")
    return satellites.select(
        satellite,
        F.when(satellite == fv.DROPOUT_SATELLITE, fv.DROPOUT_PROFILE)
        .when(satellite == fv.DEGRADED_SATELLITE, fv.DEGRADED_PROFILE)
        .otherwise(fv.DEFAULT_PROFILE).alias("mission_test_profile"),
        F.coalesce(satellite == fv.DROPOUT_SATELLITE, F.lit(False)).alias("known_dropout_satellite"),
        F.coalesce(satellite == fv.DEGRADED_SATELLITE, F.lit(False)).alias("known_degraded_comms_satellite"),
    )


def dim_ground_station(stations: DataFrame) -> DataFrame:
    """One row per station of the given relation; an unknown station has no name."""
    name = F.lit(None).cast("string")
    for station, label in fv.GROUND_STATION_NAMES.items():
        name = F.when(F.col("ground_station_id") == station, label).otherwise(name)
    return stations.select("ground_station_id", name.alias("ground_station_name"))


def fact_telemetry(telemetry: DataFrame) -> DataFrame:
    ids = ["message_id", "satellite_id", "ground_station_id", "subsystem",
           "event_timestamp", "received_timestamp", "latency_ms"]
    rest = [c for c in telemetry.columns if c not in ids and c != "source_ground_station"]
    return telemetry.select(ids + rest)


# --- daily health -----------------------------------------------------------------------------

def gold_satellite_health(telemetry: DataFrame) -> DataFrame:
    power, thermal, comms, orbital = [F.col("subsystem") == s for s in fv.SUBSYSTEMS]
    daily = telemetry.groupBy(utc_date("event_timestamp").alias("metric_date"), "satellite_id").agg(
        F.count("*").alias("telemetry_rows"),
        count_where(power, "power_readings"),
        count_where(thermal, "thermal_readings"),
        count_where(comms, "comms_readings"),
        count_where(orbital, "orbital_readings"),
        avg_where(power, "battery_voltage_v", "avg_battery_voltage_v"),
        avg_where(thermal, "internal_temp_c", "avg_internal_temp_c"),
        avg_where(comms, "signal_strength_dbm", "avg_signal_strength_dbm"),
        avg_where(comms, "bit_error_rate", "avg_bit_error_rate"),
        count_where(comms & (F.col("comm_status") == "DEGRADED"), "degraded_comms_count"),
        count_where(comms & (F.col("comm_status") == "LOST"), "lost_comms_count"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.max("latency_ms").alias("max_latency_ms"),
    )
    issues = F.col("degraded_comms_count") + F.col("lost_comms_count")
    full_day = F.lit(len(fv.SUBSYSTEMS) * fv.TICKS_PER_DAY)
    return daily.select(
        "*",
        rate(issues, F.col("comms_readings")).alias("communication_issue_rate"),
        rate(F.col("telemetry_rows"), full_day).alias("daily_completeness_rate"),
    )


def gold_communication_health(comms: DataFrame) -> DataFrame:
    status, signal = F.col("comm_status"), "signal_strength_dbm"
    return comms.groupBy(utc_date("event_timestamp").alias("metric_date"), "satellite_id").agg(
        F.count("*").alias("comm_readings"),
        F.avg(signal).alias("avg_signal_strength_dbm"),
        F.min(signal).alias("min_signal_strength_dbm"),
        F.max(signal).alias("max_signal_strength_dbm"),
        F.avg("bit_error_rate").alias("avg_bit_error_rate"),
        count_where(status == "NOMINAL", "nominal_count"),
        count_where(status == "DEGRADED", "degraded_count"),
        count_where(status == "LOST", "lost_count"),
        rate(F.count_if(status.isin("DEGRADED", "LOST")), F.count("*")).alias("degraded_or_lost_rate"),
    )


# --- gaps and completeness --------------------------------------------------------------------

def _rated_gaps(spans: DataFrame) -> DataFrame:
    minutes = F.col("gap_minutes")
    severity = (
        F.when(minutes >= fv.MAJOR_GAP_MINUTES, fv.MAJOR_GAP)
        .when(minutes >= fv.SIGNIFICANT_GAP_MINUTES, fv.SIGNIFICANT_GAP)
        .otherwise(fv.MINOR_GAP)
    )
    return spans.withColumn("gap_severity", severity).orderBy(F.desc("gap_minutes"), "satellite_id", "gap_start")


def gold_contact_gaps(telemetry: DataFrame) -> DataFrame:
    """Silences of a satellite, longest first. Nothing before its first or after its last event."""
    return _rated_gaps(silent_spans(telemetry, "satellite_id", "event_timestamp", fv.GAP_OVER_MINUTES))


def gold_gap_segments(telemetry: DataFrame) -> DataFrame:
    """Per satellite and day, what ``gaps_from_segments`` needs."""
    return gap_segments(telemetry, "satellite_id", "event_timestamp", fv.GAP_OVER_MINUTES)


def gaps_from_segments(segments: DataFrame) -> DataFrame:
    """The same as ``gold_contact_gaps``, from the segments of the days."""
    return _rated_gaps(fold_segments(segments, "satellite_id", fv.GAP_OVER_MINUTES))


def gold_data_completeness(
    telemetry: DataFrame, start: str = fv.GRID_START, end: str = fv.GRID_END,
    step_minutes: int = fv.TICK_MINUTES, satellites: list[str] = fv.SATELLITES,
    readings_per_tick: int = 1,
) -> DataFrame:
    """Expected against actual readings per satellite and day.

    The default counts one expected reading per tick while all subsystems' rows count as actual;
    ``readings_per_tick=4`` expects one per subsystem.
    """
    actual = telemetry.groupBy("satellite_id", utc_date("event_timestamp").alias("event_date")).agg(
        F.count("*").alias("found")
    )
    return _completeness(actual, start, end, step_minutes, satellites, readings_per_tick)


def completeness_from_health(
    health: DataFrame, start: str = fv.GRID_START, end: str = fv.GRID_END,
    step_minutes: int = fv.TICK_MINUTES, satellites: list[str] = fv.SATELLITES,
    readings_per_tick: int = 1,
) -> DataFrame:
    """The same as ``gold_data_completeness``, from the row counts in daily satellite health."""
    actual = health.select("satellite_id", F.col("metric_date").alias("event_date"), F.col("telemetry_rows").alias("found"))
    return _completeness(actual, start, end, step_minutes, satellites, readings_per_tick)


def _completeness(actual: DataFrame, start: str, end: str, step_minutes: int, satellites: list[str], readings_per_tick: int) -> DataFrame:
    expected = expected_per_day(actual.sparkSession, satellites, start, end, step_minutes, readings_per_tick)
    found = F.coalesce("found", F.lit(0))
    return expected.join(actual, ["satellite_id", "event_date"], "left").select(
        "satellite_id",
        "event_date",
        "expected_readings",
        found.alias("actual_readings"),
        (F.col("expected_readings") - found).alias("missing_readings"),
        rate(found, F.col("expected_readings")).alias("completeness_rate"),
    ).orderBy("event_date", "satellite_id")


# --- quality rates ----------------------------------------------------------------------------

def gold_data_quality(quarantine: DataFrame) -> DataFrame:
    reasons = quarantine.groupBy(utc_date("quarantined_at").alias("quarantine_date"), "reason_code")
    return reasons.agg(F.count("*").alias("rejected_records")).orderBy(
        "quarantine_date", F.desc("rejected_records")
    )


_VOLUMES = ["raw_records", "curated_records", "quarantined_records", "unique_semantic_events", "avg_latency_ms", "max_latency_ms"]


def _laid_over(parts: list[DataFrame]) -> DataFrame:
    """One-row aggregates as one row of volumes and rates."""
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    totals = stacked.agg(*[F.max(c).alias(c) for c in _VOLUMES])
    return totals.select(
        *_VOLUMES,
        rate(F.col("quarantined_records"), F.col("raw_records")).alias("quarantine_rate"),
        rate(F.col("curated_records"), F.col("raw_records")).alias("curated_rate"),
    )


def gold_pipeline_quality(raw: DataFrame, telemetry: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row of volumes, latency and rates. Three one-row aggregates, laid over each other."""
    return _laid_over([
        raw.agg(F.count("*").alias("raw_records")),
        telemetry.agg(
            F.count("*").alias("curated_records"),
            F.countDistinct("dedup_key").alias("unique_semantic_events"),
            F.avg("latency_ms").alias("avg_latency_ms"),
            F.max("latency_ms").alias("max_latency_ms"),
        ),
        quarantine.agg(F.count("*").alias("quarantined_records")),
    ])


def gold_quality_days(telemetry: DataFrame) -> DataFrame:
    """Per event day: counts, latency and a sketch of the keys, all of which merge over days.

    A key holds its event time, so it belongs to one day: exact distinct counts of days add up. The sketch
    serves ranges and unions at a fixed size.
    """
    return telemetry.groupBy(utc_date("event_timestamp").alias("event_date")).agg(
        F.count("*").alias("curated_records"),
        F.countDistinct("dedup_key").alias("unique_semantic_events"),
        F.count("latency_ms").alias("latency_count"),
        F.sum("latency_ms").alias("latency_sum"),
        F.max("latency_ms").alias("max_latency_ms"),
        F.hll_sketch_agg("dedup_key", fv.SKETCH_LG_K).alias("key_sketch"),
    )


def gold_intake_days(raw: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Per day of arrival: messages and rejected messages."""
    arrived = raw.select(utc_date("ingestion_timestamp").alias("arrival_date"), F.lit(1).alias("raw"), F.lit(0).alias("rejected"))
    rejected = quarantine.select(utc_date("quarantined_at").alias("arrival_date"), F.lit(0).alias("raw"), F.lit(1).alias("rejected"))
    return arrived.unionByName(rejected).groupBy("arrival_date").agg(
        F.sum("raw").alias("raw_records"), F.sum("rejected").alias("quarantined_records")
    )


def pipeline_quality_from_days(intake_days: DataFrame, quality_days: DataFrame) -> DataFrame:
    """The same as ``gold_pipeline_quality``, from the totals of the days."""
    total = lambda name: F.coalesce(F.sum(name), F.lit(0)).alias(name)
    return _laid_over([
        intake_days.agg(total("raw_records"), total("quarantined_records")),
        quality_days.agg(
            total("curated_records"), total("unique_semantic_events"),
            rate(F.sum("latency_sum"), F.sum("latency_count")).alias("avg_latency_ms"),
            F.max("max_latency_ms").alias("max_latency_ms"),
        ),
    ])


def estimated_events(quality_days: DataFrame) -> DataFrame:
    """Distinct readings by the days' sketches, merged: (curated_records, estimated_events, within_bound).

    The bound is three standard errors of a sketch of this size.
    """
    merged = F.hll_sketch_estimate(F.hll_union_agg("key_sketch"))
    totals = quality_days.agg(F.sum("unique_semantic_events").alias("unique_semantic_events"), merged.alias("estimated_events"))
    error = F.abs(F.col("estimated_events") - F.col("unique_semantic_events"))
    bound = 3 * 1.04 / 2 ** (fv.SKETCH_LG_K / 2)
    return totals.withColumn("within_bound", error <= bound * F.col("unique_semantic_events"))
