"""Message sources: JSON payload bytes in a ``value`` column, from a topic or from files."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.schemas import PAYLOAD_FIELDS, RECEIVED_CSV


def read_stream(spark: SparkSession, source: str, path: str | None = None, **options) -> DataFrame:
    """Unbounded messages. ``source`` is ``kafka`` or a file format.

    ``text`` gives one message per line, ``binaryFile`` one per file, ``parquet`` a binary ``value``.
    Kafka needs its connector on the class path.
    """
    reader = spark.readStream.format(source).options(**options)
    if source == "kafka":
        return reader.load().select("value")
    if source == "parquet":
        reader = reader.schema("value binary")
    loaded = reader.load(path)
    return loaded.select(F.col("content").alias("value")) if source == "binaryFile" else loaded.select("value")


def read_batch(spark: SparkSession, source: str, path: str, **options) -> DataFrame:
    """Stored messages, for replays: the same formats as ``read_stream``."""
    loaded = spark.read.format(source).options(**options).load(path)
    return loaded.select(F.col("content").alias("value")) if source == "binaryFile" else loaded.select("value")


def read_received_csv(spark: SparkSession, path: str) -> DataFrame:
    """A received-data file: header, 22 columns, all text; an empty cell is NULL."""
    return spark.read.schema(RECEIVED_CSV).options(header=True, enforceSchema=False).csv(path)


def to_messages(rows: DataFrame) -> DataFrame:
    """Received rows as JSON messages, one object per row, NULL fields written out."""
    payload = F.to_json(F.struct(*PAYLOAD_FIELDS), {"ignoreNullFields": "false"})
    return rows.select(F.encode(payload, "UTF-8").alias("value"))
