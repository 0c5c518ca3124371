"""Expected readings from a regular time grid."""

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F


def _epoch(text: str) -> int:
    return int(datetime.fromisoformat(text).replace(tzinfo=timezone.utc).timestamp())


def ticks(spark: SparkSession, start: str, end: str, step_minutes: int) -> DataFrame:
    """Times from start to end, both included."""
    seconds = spark.range(_epoch(start), _epoch(end) + 1, step_minutes * 60)
    return seconds.select(F.timestamp_seconds("id").alias("tick"))


def expected_per_day(
    spark: SparkSession, satellites: list[str], start: str, end: str, step_minutes: int,
    readings_per_tick: int = 1,
) -> DataFrame:
    """(satellite_id, event_date, expected_readings). Ticks are counted per day, then given to each satellite."""
    per_day = ticks(spark, start, end, step_minutes).groupBy(F.to_date("tick").alias("event_date")).agg(
        (F.count("*") * readings_per_tick).alias("expected_readings")
    )
    fleet = F.explode(F.array(*[F.lit(s) for s in satellites]))
    return per_day.select(fleet.alias("satellite_id"), "event_date", "expected_readings")
