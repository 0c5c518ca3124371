"""Messages to the raw, quarantine and curated tables. All steps but the dedup work row by row."""

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import fixed_values as fv, schemas
from skyledger.operators.dedup import dedup_batch, identity_key
from skyledger.operators.parse import parse_payloads
from skyledger.operators.rules import validate


def processing_time(as_of: str | None = None) -> Column:
    """The clock of a run: a given UTC time for replays, else the current time."""
    return F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()


def raw_envelope(messages: DataFrame, as_of: str | None = None) -> DataFrame:
    """Every message, valid or not, with its whole payload and the ids it may carry."""
    parsed = parse_payloads(messages, schemas.ENVELOPE_IDS, hold=False)
    return enveloped(parsed.select("raw_payload", *[F.col(f"message.{name}").alias(name) for name in fv.ID_FIELDS]), as_of)


def enveloped(checked: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rows that hold the payload and the ids, as ``validated`` gives them too, in the raw layout."""
    return checked.select(
        "raw_payload",
        *fv.ID_FIELDS,
        processing_time(as_of).alias("ingestion_timestamp"),
        F.lit(fv.PIPELINE_VERSION).alias("pipeline_version"),
        F.lit(fv.MESSAGE_SOURCE).alias("source"),
    )


def validated(messages: DataFrame, as_of: str | None = None, satellites: DataFrame | None = None) -> DataFrame:
    """Every message with typed fields and the reason of its rejection, if any. ``satellites``: a dimension, see ``validate``."""
    return validate(parse_payloads(messages, schemas.PAYLOAD), processing_time(as_of), satellites)


def quarantined(checked: DataFrame, as_of: str | None = None) -> DataFrame:
    """Rejected rows of ``validated`` in the quarantine layout."""
    return checked.filter(F.col("reason_code").isNotNull()).select(
        *fv.ID_FIELDS,
        "event_timestamp",
        "reason_code",
        "reason_detail",
        processing_time(as_of).alias("quarantined_at"),
        F.lit(fv.PIPELINE_VERSION).alias("pipeline_version"),
        "raw_payload",
    )


def accepted(checked: DataFrame, as_of: str | None = None) -> DataFrame:
    """Valid rows of ``validated`` in the curated layout, copies included."""
    valid = checked.filter(F.col("reason_code").isNull())
    enriched = valid.withColumns({
        "dedup_key": identity_key(),
        "ingestion_timestamp": processing_time(as_of),
        "pipeline_version": F.lit(fv.PIPELINE_VERSION),
        "source_ground_station": F.col("ground_station_id"),
    })
    return enriched.select(schemas.CURATED.fieldNames())


def curated(messages: DataFrame, as_of: str | None = None) -> DataFrame:
    """Batch ingest: one row per reading."""
    return dedup_batch(accepted(validated(messages, as_of), as_of))


def quarantine(messages: DataFrame, as_of: str | None = None) -> DataFrame:
    return quarantined(validated(messages, as_of), as_of)
