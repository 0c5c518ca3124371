"""Secret scans over very long runs, and hosts as the plain pattern finds them."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import secrets

PLAIN_HOST = r"""https?://[A-Za-z0-9.-]+(?::[0-9]+)?[^\s"'<>]*|(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}:[0-9]{2,5}"""
MB = 1 << 20


def test_hosts_are_those_of_the_plain_pattern(spark):
    rng = random.Random(4)
    parts = ["a", "b-", "com", ".", ":", "80", "123456", "http://", "https://x", " ", "'", "-", "..", "Z9", "é"]
    texts = [("".join(rng.choice(parts) for _ in range(rng.randrange(50))),) for _ in range(8000)]
    rows = spark.createDataFrame(texts, "t string").select(*[
        f("t", F.lit(p)).alias(f"{n}{k}") for k, f in (("all", lambda t, p: F.regexp_extract_all(t, p, F.lit(0))), ("cut", lambda t, p: F.split(t, p)))
        for n, p in (("plain", PLAIN_HOST), ("linear", secrets.ENDPOINT))
    ])
    assert rows.where("size(plainall) > 0").count() > 5000
    assert rows.where("plainall <> linearall OR plaincut <> linearcut").count() == 0


@pytest.mark.parametrize("run", ["x" * MB, "a." * (MB // 2), "Ab9/+" * (MB // 5), "com.com:" * (MB // 8), "password" + " " * MB, "f" * MB, "1f-" * (MB // 3)])
def test_long_runs_take_one_reading(spark, run):
    docs = spark.createDataFrame([(1, run), (2, run + " token=abcdefgh1")], "doc_id long, text string")
    found = {r.doc_id: [s.kind for s in r.base] for r in secrets.scan_secrets(docs).collect()}
    hexes = [2] if run[0] == "f" else []
    assert sorted(found[1]) == hexes and sorted(found[2]) == [0, *hexes]
