"""Report queries over gold and silver tables."""

from pyspark.sql import DataFrame, functions as F

from skyledger.functions.metrics import count_where, rate, rounded, utc_date


def mission_operations_dashboard(health: DataFrame) -> DataFrame:
    return health.select(
        "metric_date",
        "satellite_id",
        "telemetry_rows",
        rounded("daily_completeness_rate", 2, scale=100).alias("completeness_pct"),
        rounded("avg_battery_voltage_v", 3).alias("avg_battery_voltage_v"),
        rounded("avg_internal_temp_c", 2).alias("avg_internal_temp_c"),
        rounded("avg_signal_strength_dbm", 2).alias("avg_signal_strength_dbm"),
        rounded("avg_bit_error_rate", 6).alias("avg_bit_error_rate"),
        "degraded_comms_count",
        "lost_comms_count",
        rounded("communication_issue_rate", 2, scale=100).alias("communication_issue_pct"),
        rounded("avg_latency_ms", 2).alias("avg_latency_ms"),
        rounded("max_latency_ms", 2).alias("max_latency_ms"),
    ).orderBy("metric_date", "satellite_id")


def communication_by_satellite(comm_health: DataFrame) -> DataFrame:
    """Daily communication health rolled up: plain means of daily means, rate of sums."""
    totals = comm_health.groupBy("satellite_id").agg(
        F.avg("avg_signal_strength_dbm").alias("mean_signal"),
        F.avg("avg_bit_error_rate").alias("mean_errors"),
        F.sum("degraded_count").alias("degraded_count"),
        F.sum("lost_count").alias("lost_count"),
        F.sum("comm_readings").alias("comm_readings"),
    )
    issues = F.col("degraded_count") + F.col("lost_count")
    return totals.select(
        "satellite_id",
        rounded("mean_signal", 2).alias("avg_signal_strength_dbm"),
        rounded("mean_errors", 6).alias("avg_bit_error_rate"),
        "degraded_count",
        "lost_count",
        F.round(rate(issues, F.col("comm_readings")), 4).alias("degraded_or_lost_rate"),
    )


def weakest_communication_satellite(comm_health: DataFrame) -> DataFrame:
    """The satellite with the lowest rounded mean signal; equal ones by id."""
    ranked = communication_by_satellite(comm_health)
    return ranked.orderBy("avg_signal_strength_dbm", "satellite_id").limit(1)


def satellite_telemetry_volume(telemetry: DataFrame) -> DataFrame:
    return telemetry.groupBy("satellite_id").agg(
        F.count("*").alias("telemetry_count"),
        F.countDistinct("ground_station_id").alias("ground_station_count"),
        F.min("event_timestamp").alias("first_event_timestamp"),
        F.max("event_timestamp").alias("last_event_timestamp"),
    )


def battery_health(power: DataFrame) -> DataFrame:
    """Daily least, mean and greatest POWER measures of each satellite."""
    measures = ["battery_voltage_v", "battery_current_a", "solar_output_w"]
    return power.groupBy(utc_date("event_timestamp").alias("metric_date"), "satellite_id").agg(
        F.count("*").alias("power_readings"),
        *[f(m).alias(f"{label}_{m}") for m in measures
          for label, f in (("min", F.min), ("avg", F.avg), ("max", F.max))],
    )


def communication_signal(comms: DataFrame) -> DataFrame:
    """Communication health of each satellite over all days, from its single readings."""
    status, signal = F.col("comm_status"), "signal_strength_dbm"
    return comms.groupBy("satellite_id").agg(
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


def subsystem_alerts(quarantine: DataFrame) -> DataFrame:
    """Rejected records by satellite, subsystem and reason."""
    return quarantine.groupBy("satellite_id", "subsystem", "reason_code").agg(
        F.count("*").alias("rejected_records")
    )


def dataset_profile(received: DataFrame) -> DataFrame:
    """Size of a received data set and its labelled share of malformed and duplicate rows."""
    totals = received.agg(
        F.count("*").alias("total_rows"),
        count_where(F.col("is_malformed") == "true", "malformed_rows"),
        count_where(F.col("is_duplicate") == "true", "duplicate_rows"),
    )
    def percent(part):
        return F.round(rate(F.col(part) * 100, F.col("total_rows")), 3)

    return totals.select(
        "total_rows",
        "malformed_rows",
        percent("malformed_rows").alias("malformed_pct"),
        "duplicate_rows",
        percent("duplicate_rows").alias("duplicate_pct"),
    )


def rows_per_satellite(received: DataFrame) -> DataFrame:
    return received.groupBy("satellite_id").agg(F.count("*").alias("row_count"))


STORED_REPORTS = {
    mission_operations_dashboard: "gold_satellite_health",
    communication_by_satellite: "gold_communication_health",
    weakest_communication_satellite: "gold_communication_health",
    satellite_telemetry_volume: "silver_telemetry",
    battery_health: "silver_power",
    communication_signal: "silver_comms",
    subsystem_alerts: "telemetry_quarantine",
}


def publish_reports(layers) -> list[str]:
    """Make every report over stored tables readable from the session's SQL, as a view of its own name."""
    for report, table in STORED_REPORTS.items():
        report(layers.read(table)).createOrReplaceTempView(report.__name__)
    return [report.__name__ for report in STORED_REPORTS]
