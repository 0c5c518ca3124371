from pyspark.sql import functions as F

from skyledger.llm import substring_dedup as sub


def test_only_rows_that_share_an_id_carry_a_tie(spark):
    """A window's key goes through two shuffles; the hash in it is of use only where an id does not name one row."""
    rows = [(1, "a b"), (2, "a b"), (3, "c"), (3, "d"), (None, "e"), (None, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("hash", F.xxhash64("text"))
    found = {(r.doc_id, r.text): (r["tie"], r["hash"]) for r in sub._keyed(docs).collect()}
    for (doc_id, _), (tie, hashed) in found.items():
        assert tie == (hashed if doc_id in (3, None) else 0)


def test_rows_of_one_id_keep_their_own_windows(spark):
    words = [f"w{k}" for k in range(30)]
    first, other = " ".join(words), " ".join(reversed(words))
    rows = [(5, first), (5, other), (7, other + " x"), (6, first), (None, first), (None, "y " + other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    removed = sorted((r.doc_id or 99, r.n_words, r.n_removed) for r in sub.remove_repeats(docs).collect())
    assert removed == [(5, 30, 0), (5, 30, 0), (6, 30, 30), (7, 31, 30), (99, 30, 30), (99, 31, 30)]
