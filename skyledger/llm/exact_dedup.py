"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when they agree after all ASCII white space is deleted. One scan writes a narrow key
table (length, prefix hash). Lengths that occur once are dropped, then prefixes that occur once. A
fixed-size filter carries the surviving (length, prefix) keys to the second scan, and only rows that
pass it have their whole text hashed. No step moves a text, every grouping combines before its shuffle,
so a group that holds a third of all rows leaves each task as one row.

Defined results: a null text is empty; empty texts are equal to each other. A null ``doc_id`` ranks
after every id. Rows that repeat a ``doc_id`` and text count one each in ``group_size`` and share one
verdict. Other columns are ignored, whatever their names. An empty table gives an empty result.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.tables import FILTER_BITS, key_filter, stage, table, union_all, with_filter

WHITE_SPACE = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 128


def normalised(text):
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def repeated(keys: DataFrame, cols: list[str]) -> DataFrame:
    return keys.groupBy(*cols).count().where("count > 1").select(*cols)


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    filter_bits: int = FILTER_BITS,
    digest_all: bool = False,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the most code points stays, then the smallest id. ``text_sha256`` is
    null for texts that needed no full hash, unless ``digest_all`` asks for every digest.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.length(text_col), F.lit(0)).alias("n_chars"),
        normalised(F.col(text_col)).alias("norm"),
    )
    key_cols = [F.length("norm").alias("n_norm"), F.xxhash64(F.substring("norm", 1, prefix_chars)).alias("prefix")]

    keys = stage(rows.select(*key_cols), "exact-keys")
    lengths = key_filter(repeated(keys, ["n_norm"]), ["n_norm"], filter_bits)
    same_length = with_filter(keys, [F.col("n_norm")], lengths, "survives", filter_bits).where("survives")
    prefixes = key_filter(repeated(same_length, ["n_norm", "prefix"]), ["n_norm", "prefix"], filter_bits)

    marked = with_filter(
        rows.select("doc_id", "n_chars", "norm", *key_cols), [F.col("n_norm"), F.col("prefix")], prefixes, "candidate", filter_bits
    )
    digest = F.sha2("norm", 256)
    full = stage(
        marked.select(
            "doc_id", "n_chars", "candidate",
            (digest if digest_all else F.when(F.col("candidate"), digest)).alias("text_sha256"),
        ),
        "exact-digests",
    )
    first = F.min(F.struct((-F.col("n_chars")).alias("order"), F.col("doc_id").isNull().alias("no_id"), "doc_id"))
    groups = stage(  # written, so that the join below deals both sides itself and can split a hot digest
        full.where("candidate").groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), first["doc_id"].alias("keep_id")),
        "exact-groups",
    )
    grouped = full.where("candidate").join(groups, "text_sha256")
    alone = full.where("not candidate").withColumns({"group_size": F.lit(1).cast("long"), "keep_id": F.col("doc_id")})
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    return union_all([grouped.select(*columns), alone.select(*columns)]).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), r AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id NULLS LAST) AS keep_id
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256
FROM r
"""
