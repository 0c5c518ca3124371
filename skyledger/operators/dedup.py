"""Semantic de-duplication: one row per ``dedup_key``."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.canonical import dedup_key
from skyledger.schemas import IDENTITY_FIELDS


# All follow from the key. Naming them lets filters on them pass below the shuffle.
KEY_COLUMNS = ["dedup_key", "satellite_id", "subsystem", "event_timestamp"]


def identity_key() -> Column:
    """The key of a validated row. Event time enters as the text that was sent."""
    fields = {name: name for name in IDENTITY_FIELDS}
    fields["event_timestamp"] = "event_text"
    return F.expr(dedup_key(fields))


def dedup_batch(df: DataFrame) -> DataFrame:
    """Keep the first received copy of each reading.

    ``row_number() = 1`` lets Spark cut each key to one row per task before the shuffle
    (WindowGroupLimit), so a key with any number of copies arrives as one row per map task.
    """
    first_received = Window.partitionBy(*KEY_COLUMNS).orderBy("received_timestamp", "message_id")
    ranked = df.withColumn("copy_rank", F.row_number().over(first_received))
    return ranked.filter(F.col("copy_rank") == 1).drop("copy_rank")


def event_days(df: DataFrame) -> list[str]:
    """The UTC days of the events, one name each."""
    days = df.select(F.to_date("event_timestamp").cast("string").alias("day")).distinct()
    return sorted(row.day for row in days.collect() if row.day is not None)


def without_known(deduped: DataFrame, stored: DataFrame) -> DataFrame:
    """Drop readings that an earlier run already wrote.

    Equal readings have equal event times, so ``stored`` need only hold the days of the new rows, of which no
    more than the key columns are read. The join uses the dedup's own columns: its shuffle serves the join, and
    copies are gone before it.
    """
    return deduped.join(stored.select(KEY_COLUMNS), KEY_COLUMNS, "left_anti").select(deduped.columns)


def dedup_stream(df: DataFrame, lateness: str = fv.ALLOWED_LATENESS, spread: int = 16) -> DataFrame:
    """Streaming form: the first copy seen within the watermark passes, later ones are dropped.

    A key may hold a large share of a micro-batch, and a stream has no pre-shuffle limit. So copies
    are first dropped among ``spread`` shares of the map tasks, which leaves at most ``spread`` rows
    per key for the exact second step. ``spread=1`` leaves the first step out.
    """
    marked = df.withWatermark("event_timestamp", lateness)
    if spread > 1:
        marked = marked.withColumn("share", F.spark_partition_id() % spread)
        marked = marked.dropDuplicatesWithinWatermark(["dedup_key", "share"]).drop("share")
    return marked.dropDuplicatesWithinWatermark(["dedup_key"])
