"""Silence between consecutive events of a group."""

from pyspark.sql import Column, DataFrame, Window, functions as F

MICROS_PER_MINUTE = 60_000_000


def _slots(df: DataFrame, keys: list[str], time: str, over_minutes: int) -> DataFrame:
    """First and last event per key and slot of n + 1 minutes, combined before the shuffle.

    Whole minutes above n means a distance of at least n + 1 minutes, so two such events never share
    a slot. It is therefore exact to keep only these two events and to look back from slot to slot: a window
    holds at most one row per key and slot, whatever the number of events.
    """
    micros, width = f"unix_micros({time})", (over_minutes + 1) * MICROS_PER_MINUTE
    slot = F.expr(f"({micros} - pmod({micros}, {width})) div {width}")
    return df.groupBy(*keys, slot.alias("slot")).agg(F.min(time).alias("first_time"), F.max(time).alias("last_time"))


def _minutes(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def silent_spans(df: DataFrame, key: str, time: str, over_minutes: int) -> DataFrame:
    """Consecutive events of a key that lie more than ``over_minutes`` whole minutes apart."""
    in_order = Window.partitionBy(key).orderBy("slot")
    spans = _slots(df, [key], time, over_minutes).select(
        key,
        F.lag("last_time").over(in_order).alias("gap_start"),
        F.col("first_time").alias("gap_end"),
    )
    return spans.withColumn("gap_minutes", _minutes(F.col("gap_start"), F.col("gap_end"))).filter(F.col("gap_minutes") > over_minutes)


def gap_segments(df: DataFrame, key: str, time: str, over_minutes: int, day: str = "event_date") -> DataFrame:
    """(key, day, first_time, last_time, gaps): what a day's events tell of silence, whatever other days hold.

    ``gaps`` lists the silent spans inside the day. Days can be rebuilt one by one; ``fold_segments`` joins them.
    """
    in_order = Window.partitionBy(key, day).orderBy("slot")
    slots = _slots(df.withColumn(day, F.to_date(time)), [key, day], time, over_minutes)
    spans = slots.withColumn("before", F.lag("last_time").over(in_order))
    minutes = _minutes(F.col("before"), F.col("first_time"))
    gap = F.struct(F.col("before").alias("gap_start"), F.col("first_time").alias("gap_end"), minutes.alias("gap_minutes"))
    return spans.groupBy(key, day).agg(
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
        F.sort_array(F.collect_list(F.when(minutes > over_minutes, gap))).alias("gaps"),
    )


def fold_segments(segments: DataFrame, key: str, over_minutes: int, day: str = "event_date") -> DataFrame:
    """The silent spans of a key over all its days: those inside days, and those at the seams. One row a day in a window."""
    in_order = Window.partitionBy(key).orderBy(day)
    seams = segments.withColumn("before", F.lag("last_time").over(in_order))
    minutes = _minutes(F.col("before"), F.col("first_time"))
    seam = F.struct(F.col("before").alias("gap_start"), F.col("first_time").alias("gap_end"), minutes.alias("gap_minutes"))
    at_seam = F.when(minutes > over_minutes, F.array(seam)).otherwise(F.slice("gaps", 1, 0))
    return seams.select(key, F.explode(F.concat("gaps", at_seam)).alias("gap")).select(key, "gap.*")
