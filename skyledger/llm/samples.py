"""Bounded samples of labelled rows for fitting models."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.tables import id_text_crc, stage

SHARES = 256  # groups of map tasks whose best rows of a class are taken first
_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def held_out(modulus: int, remainder: int, id_col: str = "doc_id") -> Column:
    return F.pmod(id_text_crc(id_col), F.lit(modulus)) == remainder


def bounded_sample(texts: DataFrame, classes: DataFrame, per_class: int) -> DataFrame:
    """Texts (doc_id, text) of at most ``per_class`` documents of each class (doc_id, cls).

    Documents are taken in the order of a hash of their id. The choice runs on ids alone, with a limit
    before its shuffle, first among ``SHARES`` groups of tasks and then among their best: however many
    tasks there are, no class brings more than ``SHARES * per_class`` ids to its last task. What is
    chosen is bounded by ``per_class`` ids a class and may be broadcast. An id that several rows have brings one text,
    that with the smallest hash, a null one last; rows of an id are combined before their shuffle.
    """
    spark = texts.sparkSession
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    best = lambda rows, *by: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= per_class)
    ids = classes.where("doc_id is not null and cls is not null").select("doc_id", F.col("cls").cast("string").alias("cls")).distinct()
    shared = best(ids.withColumn("share", F.spark_partition_id() % SHARES), "cls", "share").select("doc_id", "cls")
    before = spark.conf.get(_LIMIT)
    spark.conf.set(_LIMIT, str(max(int(before), per_class + 1)))  # Spark puts larger limits after the shuffle
    try:
        chosen = stage(best(shared, "cls").select(F.col("doc_id").alias("chosen_id"), "cls", "rank"), "sample-ids")
    finally:
        spark.conf.set(_LIMIT, before)
    joined = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
    text = F.min_by("text", F.struct(F.col("text").isNull().alias("none"), F.xxhash64("text").alias("hash"))).alias("text")
    return stage(joined.groupBy("doc_id", "cls", "rank").agg(text), "sample")


def label_classes(labels: DataFrame, column: str, learn: Column) -> DataFrame:
    """(doc_id, cls) of labelled documents that may be learnt from; of contradicting labels the larger counts."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull())
    return known.groupBy("doc_id").agg(F.max(column).alias("cls")).where(learn)
