"""Near copies in mixed lists, under null and shared ids, and the bound that keeps their pairs few."""

import numpy as np
from pyspark.sql import functions as F

from skyledger.llm import near_dedup, tables
from test_llm import brute_groups, prose


def edited(base, rng, changes, pool):
    words = list(base)
    for at in rng.choice(len(words), changes, replace=False):
        words[at] = f"w{rng.integers(0, pool)}"
    return " ".join(words)


def got(spark, rows, share, size):
    found = near_dedup.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), share, 100, size)
    return sorted(map(str, found.select("doc_id", "n_shingles", "component_id").collect()))


def expect_rows(rows, share, size):
    """Brute force over rows, whether they have an id or not."""
    numbered = brute_groups([(k, t) for k, (_, t) in enumerate(rows)], size, share)
    smallest = {}
    for k, _, part in numbered:
        i = rows[k][0]
        if i is not None:
            smallest[part] = min(i, smallest.get(part, i))
    return sorted(
        f"Row(doc_id={rows[k][0]}, n_shingles={n}, component_id={smallest.get(part) if n else rows[k][0]})" for k, n, part in numbered
    )


def test_parity_never_exceeds_the_shingles_of_one_set_only():
    rng = np.random.default_rng(1)
    for n in (1, 5, 40, 300, 3000):
        for share in (0.0, 0.5, 0.9, 1.0):
            a = rng.integers(0, 1 << 62, n, dtype=np.uint64)
            b = np.concatenate([a[: int(n * share)], rng.integers(0, 1 << 62, n - int(n * share), dtype=np.uint64)])
            for size_class in near_dedup._partner_classes(n, 80, 100):
                bits = near_dedup._parity(np.unique(a), size_class) ^ near_dedup._parity(np.unique(b), size_class)
                differ = np.bitwise_count(bits.view(np.uint64)).sum()
                assert differ <= len(set(a.tolist()) ^ set(b.tolist()))
                assert share < 1 or differ == 0
    for n in range(1, 400):  # classes of partners cover every size that may be similar enough
        for m in range(1, 400):
            if 100 * min(n, m) >= 80 * max(n, m):
                assert near_dedup._size_class(m) in near_dedup._partner_classes(n, 80, 100)


def test_mixed_lists_of_many_sizes(spark):
    """Families of near copies with a common passage, of sizes around the borders of size classes."""
    rng, passage, rows = np.random.default_rng(2), prose(200, 50).split(), []
    for length in (20, 62, 66, 70, 130, 255, 262, 520):
        base = prose(300 + length, length).split()
        for _ in range(14):
            cut = int(rng.integers(0, max(1, length // 6)))
            rows.append((len(rows), edited(passage + base[cut:], rng, int(rng.integers(0, 6)), 12)))
    rows += [(len(rows) + k, edited(passage, rng, int(rng.integers(0, 4)), 3)) for k in range(30)]
    for size, share in ((3, 85), (5, 80)):
        assert got(spark, rows, share, size) == expect_rows(rows, share, size)


def test_rows_without_an_id_and_rows_that_share_one(spark):
    """Each row is linked by its own text; a row without an id may connect two documents."""
    base = prose(400, 200).split()
    left, right = base[:], base[:]
    left[3:10], right[180:187] = [f"l{k}" for k in range(7)], [f"r{k}" for k in range(7)]
    rows = [
        (1, " ".join(left)), (2, " ".join(right)), (None, " ".join(base)), (None, " ".join(base)), (None, prose(401, 90)),
        (5, prose(402, 90)), (5, prose(403, 90)), (8, prose(403, 90) + " uno"), (9, prose(402, 90) + " due"), (5, prose(402, 90)),
        (None, prose(404, 90)), (None, prose(404, 90) + " tre"), (None, None), (None, ""), (10, "  "), (None, "one two"), (11, "One  two"),
    ]
    sets = expect_rows(rows, 85, 3)
    assert "Row(doc_id=2, n_shingles=198, component_id=1)" in sets and "Row(doc_id=8, n_shingles=89, component_id=5)" in sets
    assert got(spark, rows, 85, 3) == sets
    assert got(spark, rows * 3, 85, 3) == sorted(sets * 3)


def test_ids_of_any_type_that_sorts(spark):
    docs = spark.createDataFrame([(1, prose(1, 50)), (1, prose(1, 50) + " x"), (None, prose(1, 50)), (2, prose(2, 50))], "doc_id long, text string")
    found = near_dedup.near_groups(docs.withColumn("key", tables.row_key()), 80, 100, 5, id_col="key")
    parts = found.groupBy("component_id.id", "component_id.no_id").agg(F.count("*").alias("n"), F.sum(F.col("kept").cast("int")).alias("kept"))
    assert sorted(map(tuple, parts.collect())) == [(1, False, 3, 1), (2, False, 1, 1)]


def test_a_group_that_no_one_text_links_costs_few_pairs(spark, monkeypatch):
    """Copies with one or two words of their own: many pairs are links, and no text is linked to all."""
    rng, base, n = np.random.default_rng(5), [f"v{x}" for x in np.random.default_rng(1).integers(0, 5000, 60)], 600
    rows = [(k, edited(base, rng, int(rng.integers(1, 3)), 10**9)) for k in range(n)]
    made, across = [], near_dedup.across

    def counted(*args):
        pairs = across(*args)
        made.append(pairs.count())
        return pairs

    monkeypatch.setattr(near_dedup, "across", counted)
    assert got(spark, rows, 85, 3) == expect_rows(rows, 85, 3)
    assert made[0] <= n
