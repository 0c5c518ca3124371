"""Reading tables, staging narrow results in the shared folder, and filters of a fixed size.

A *key filter* is a bitmap of ``bits`` bits over the hashes of keys: however many keys it holds it
stays ``bits / 8`` bytes, so it may be broadcast. A set bit means "maybe"; every user of a filter
checks the rows that pass against the exact keys.
"""

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.session import shared_dir

FILTER_BITS = 1 << 23
ARROW_ROWS = 1000  # texts in an Arrow batch; Spark's own 10,000 would be gigabytes of long documents
_WORD = 1 << 15  # bits in one row of Spark's bitmap aggregate


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder, or as ``purpose`` into ``folder`` there, and read it back: lost executors never
    repeat its work."""
    path = f"{folder}/{purpose}" if folder else shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_arrow(rows: DataFrame, task, schema) -> DataFrame:
    """``rows.mapInArrow`` in batches of at most ``ARROW_ROWS`` rows, a setting of the session.

    After each batch Arrow gives back what it no longer uses: a Python worker outlives its tasks, and the stages after
    them would find the memory taken.
    """

    def returned(batches):
        for batch in batches:
            yield batch
            del batch
            pa.default_memory_pool().release_unused()

    rows.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return rows.mapInArrow(lambda batches: task(returned(batches)), schema)


def _slot(cols: list[Column], bits: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(bits))


def key_filter(keys: DataFrame, cols: list[str], bits: int = FILTER_BITS) -> DataFrame:
    """Bitmap rows (``__bucket``, ``__bits``) of the keys: at most ``bits / 32768`` rows of 4 KB."""
    slots = keys.select(_slot([F.col(c) for c in cols], bits).alias("__slot"))
    return slots.groupBy(F.bitmap_bucket_number("__slot").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__slot")).alias("__bits")
    )


def with_filter(rows: DataFrame, cols: list[Column], bitmap: DataFrame, flag: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` with boolean ``flag``: whether the filter may hold their key. No shuffle."""
    position = F.bitmap_bit_position(F.col("__slot"))
    byte = F.conv(F.hex(F.substring("__bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10)
    bit = F.bit_get(byte.cast("bigint"), (position % 8).cast("int")) == 1
    return (
        rows.withColumn("__slot", _slot(cols, bits))
        .withColumn("__bucket", F.bitmap_bucket_number("__slot"))
        .join(F.broadcast(bitmap), "__bucket", "left")
        .withColumn(flag, F.col("__bits").isNotNull() & F.coalesce(bit, F.lit(False)))
        .drop("__slot", "__bucket", "__bits")
    )


def without(docs: DataFrame, dropped: DataFrame, id_col: str = "doc_id", bits: int = FILTER_BITS) -> DataFrame:
    """``docs`` without the ids in ``dropped``; rows with a null id stay.

    Only rows that a fixed-size filter of the dropped ids lets through are shuffled, so the texts of
    most kept documents never move. The check is an outer join on purpose: Catalyst moves an anti join below
    the filter, where it would shuffle every text.
    """
    ids = dropped.select(F.col(id_col).alias("__dropped")).where("__dropped is not null")
    flagged = with_filter(docs, [F.col(id_col)], key_filter(ids, ["__dropped"], bits), "__maybe", bits)
    to_check = F.col("__maybe") & F.col(id_col).isNotNull()
    sure = flagged.where(~to_check)
    checked = flagged.where(to_check).join(ids.distinct(), F.col(id_col) == F.col("__dropped"), "left").where("__dropped is null")
    return sure.select(*docs.columns).unionByName(checked.select(*docs.columns))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What tells rows apart that share an id or have none: the id, a null last, and SHA-256 of the text. Sorts by id."""
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    return F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), digest.alias("digest"))


def without_keys(
    docs: DataFrame, dropped: DataFrame, repeated: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text", bits: int = FILTER_BITS
) -> DataFrame:
    """``docs`` without the rows whose ``row_key`` is a ``key`` of ``dropped``, and with one row of each key in ``repeated``.

    As in ``without``, only rows that the filter lets through are shuffled. With ``repeated``, rows of one key
    are combined before that, so a key that a third of all rows have leaves each task as one row.
    """
    gone = dropped.select(F.col("key").alias("__dropped")).distinct()
    named = dropped.select("key") if repeated is None else dropped.select("key").unionByName(repeated.select("key"))
    flagged = with_filter(
        docs.withColumn("__key", row_key(id_col, text_col)), [F.col("__key")], key_filter(named, ["key"], bits), "__maybe", bits
    )
    to_check = flagged.where("__maybe")
    if repeated is not None:
        to_check = to_check.dropDuplicates(["__key"])
    checked = to_check.join(gone, F.col("__key") == F.col("__dropped"), "left").where("__dropped is null")
    return flagged.where("not __maybe").select(*docs.columns).unionByName(checked.select(*docs.columns))


def id_text_crc(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
