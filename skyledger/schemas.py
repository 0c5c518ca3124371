"""Table schemas, and the projection that enforces them at a sink."""

from pyspark.sql import DataFrame, functions as F, types as T

from skyledger import fixed_values as fv

MEASURES = [column for ranges in fv.PHYSICAL_RANGES.values() for column, _, _ in ranges]

# The 18 payload fields, in message order: comm_status follows the COMMS measures.
PAYLOAD_FIELDS = list(fv.REQUIRED_FIELDS)
for _subsystem, _ranges in fv.PHYSICAL_RANGES.items():
    PAYLOAD_FIELDS += [column for column, _, _ in _ranges]
    if _subsystem == "COMMS":
        PAYLOAD_FIELDS.append("comm_status")

ANSWER_KEY_FIELDS = ["is_malformed", "malformed_reason", "is_duplicate", "duplicate_of_message_id"]

# Fields that make two messages the same reading, whatever carried them.
IDENTITY_FIELDS = [c for c in PAYLOAD_FIELDS if c not in ("message_id", "received_timestamp")]


def _text_fields(names):
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _columns(*columns):
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in columns])


_STRING, _TIME, _DOUBLE = T.StringType(), T.TimestampType(), T.DoubleType()

PAYLOAD = _text_fields(PAYLOAD_FIELDS)
RECEIVED_CSV = _text_fields(PAYLOAD_FIELDS + ANSWER_KEY_FIELDS)
ENVELOPE_IDS = _text_fields(fv.ID_FIELDS)

RAW = _columns(
    ("raw_payload", _STRING, False),
    *[(name, _STRING, True) for name in fv.ID_FIELDS],
    ("ingestion_timestamp", _TIME, False),
    ("pipeline_version", _STRING, False),
    ("source", _STRING, False),
)

QUARANTINE = _columns(
    *[(name, _STRING, True) for name in fv.ID_FIELDS],
    ("event_timestamp", _TIME, True),
    ("reason_code", _STRING, False),
    ("reason_detail", _STRING, True),
    ("quarantined_at", _TIME, False),
    ("pipeline_version", _STRING, False),
    ("raw_payload", _STRING, True),
)

READING = [(name, _STRING if name == "comm_status" else _DOUBLE, True)
           for name in PAYLOAD_FIELDS if name not in fv.REQUIRED_FIELDS]

CURATED = _columns(
    ("message_id", _STRING, False),
    ("dedup_key", _STRING, False),
    ("satellite_id", _STRING, False),
    ("ground_station_id", _STRING, False),
    ("subsystem", _STRING, False),
    ("event_timestamp", _TIME, False),
    ("received_timestamp", _TIME, False),
    *READING,
    ("ingestion_timestamp", _TIME, False),
    ("pipeline_version", _STRING, False),
    ("source_ground_station", _STRING, False),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the declared columns, order and types; a NULL in a required column fails the write."""

    def column(field):
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"NULL in required column {field.name}")))
        return value.alias(field.name)

    return df.select([column(field) for field in schema.fields])
