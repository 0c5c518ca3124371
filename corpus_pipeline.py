"""The corpus pipeline: language, exact copies, near copies, benchmark passages, packing.

Every stage works on all that its predecessor kept; its result is written as Parquet and read again as
the next one's documents. A stage takes (spark, docs, sf_dir). All but the last return the columns of
``docs``, whatever they are; the last returns the packed pieces with their token ids.

The first stage judges rows where they are. The verdicts of the others name a row by ``tables.row_key``, its id
and a digest of its whole text, so rows that share an id or have none are judged each on their own text. Rows
equal in both are copies, of which the dedup stages keep one; which one is not defined where other columns differ.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm import decontaminate as benchmark
from skyledger.llm import exact_dedup as exact
from skyledger.llm import language, near_dedup, packing
from skyledger.llm.tables import row_key, stage, table, without_keys


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the models learn from the rows of ``docs`` that name one.

    In effect a text is rejected when it has no letter: of the others the models always choose a language, and
    without models (no row names one) they all stay. Scores are not used.
    """
    return language.keep_identified(docs, language.learn(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    judged = exact.exact_dedup(docs.withColumn("__key", row_key()), id_col="__key")
    verdicts = stage(judged.where("group_size > 1").select(F.col("doc_id").alias("key"), "kept"), "pipeline-exact")
    repeated = verdicts.where("kept").groupBy("key").count().where("count > 1")
    return without_keys(docs, verdicts.where("not kept"), repeated)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (shingles of five words, similarity of 0.8 or more)."""
    judged = near_dedup.near_groups(docs.withColumn("__key", row_key()), 80, 100, words=5, id_col="__key")
    verdicts = stage(judged.select(F.col("doc_id").alias("key"), "kept"), "pipeline-near")
    repeated = verdicts.where("kept").groupBy("key").count().where("count > 1")
    return without_keys(docs, verdicts.where("not kept"), repeated)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = benchmark.contained_items(docs.withColumn("__key", row_key()), table(spark, sf_dir, "benchmark"), id_col="__key")
    return without_keys(docs, stage(found.select(F.col("doc_id").alias("key")), "pipeline-benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of a power of two tokens, none across documents."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", minhash_near_dedup),
    ("decontamination", benchmark_decontamination),
    ("packing", pack),
]
ORACLE_SQL = None  # models and tokens are beyond SQL; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
