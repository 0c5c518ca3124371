"""Small expressions shared by the silver and gold tables."""

from pyspark.sql import Column, functions as F


def utc_date(time: str) -> Column:
    return F.to_date(F.col(time))


def rate(part: Column, whole: Column) -> Column:
    """part / whole as double; NULL when whole is 0."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def latency_ms() -> Column:
    """Whole milliseconds from the event to its reception."""
    return F.timestamp_diff("MILLISECOND", F.col("event_timestamp"), F.col("received_timestamp"))


def count_where(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def avg_where(condition: Column, column: str, name: str) -> Column:
    return F.avg(F.when(condition, F.col(column))).alias(name)


def rounded(column: str, digits: int, scale: int = 1) -> Column:
    value = F.col(column).cast("double")
    return F.round(value * scale if scale != 1 else value, digits)
