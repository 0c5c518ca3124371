import os
import random
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import substring_dedup as sub

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])


def rows_of(seed: int) -> list[tuple]:
    """Passages copied whole, in part and side by side, periodic texts, equal rows, shared and missing ids."""
    rng = random.Random(seed)
    passages = [[f"p{k}_{w}" for w in range(rng.randint(15, 70))] for k in range(5)]
    passages += [["a"] * 50, ["a", "b"] * 25, [f"c{w % 9}" for w in range(60)], [f"d{w % 23}" for w in range(80)]]
    rows = []
    for doc in range(40):
        words = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.7:
                passage = rng.choice(passages)
                cut = rng.randint(0, len(passage) // 2)
                words += passage[cut:] if rng.random() < 0.5 else passage
            else:
                words += [f"u{rng.randint(0, 10**9)}" for _ in range(rng.randint(1, 30))]
        rows.append((rng.choice([doc, doc, doc, 7, None]), " ".join(words)))
    return rows + rows[3:6] + [(50, None), (51, ""), (52, "one"), (None, None)]


def by_words(docs) -> Counter:
    """The contract, by comparing words."""
    found = docs.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit("")))).collect()
    shared = Counter(r.doc_id for r in found)
    texts = [((r.doc_id is None, r.doc_id or 0, r["hash"] if shared[r.doc_id] > 1 else 0), r) for r in found]
    first, result = {}, Counter()
    for key, row in texts:
        words = (row.text or "").split()
        for at in range(len(words) - sub.WINDOW + 1):
            window = tuple(words[at : at + sub.WINDOW])
            first[window] = min(first.get(window, (key, at)), (key, at))
    for key, row in texts:
        words, gone = (row.text or "").split(), set()
        for at in range(len(words) - sub.WINDOW + 1):
            if first[tuple(words[at : at + sub.WINDOW])] < (key, at):
                gone |= set(range(at, at + sub.WINDOW))
        result[row.doc_id, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)] += 1
    return result


def removed(docs, **settings) -> Counter:
    return Counter(tuple(r) for r in sub.remove_repeats(docs, **settings).select("doc_id", "n_words", "n_removed", "kept").collect())


def test_stretches_find_what_words_find(spark):
    for seed in range(3):
        docs = spark.createDataFrame(rows_of(seed), SCHEMA).repartition(5)
        assert removed(docs) == by_words(docs)


def test_full_filters_change_nothing(spark, monkeypatch):
    """Rows that a filter lets through without need cost time, but decide nothing."""
    docs = spark.createDataFrame(rows_of(11), SCHEMA).repartition(3)
    expected = by_words(docs)
    monkeypatch.setattr(sub, "MOST_BITS", 8)
    monkeypatch.setattr(sub, "FILTER_BITS", 8)
    assert removed(docs, bits=8) == expected


def test_starts_of_repeated_windows(spark):
    words = [f"w{k}" for k in range(60)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, "x " + " ".join(words[10:50])), (3, "y")], SCHEMA)
    (found,) = sub.repeated_windows(docs).collect()
    assert (found["rank"], found["tie"], sorted(found["starts"])) == (2, 0, list(range(1, 22)))


def test_copies_of_a_passage_are_staged_as_stretches(spark, monkeypatch):
    """A passage of 300 words in 40 documents has 11,240 windows; staged by window they took 4.4 x the input on disk."""
    staged, stage = [], sub.stage

    def counted(df, *where):
        result = stage(df, *where)
        staged.append(result.count())
        return result

    monkeypatch.setattr(sub, "stage", counted)
    passage = " ".join(f"w{k}" for k in range(300))
    docs = spark.createDataFrame([(doc, f"a{doc} {passage} z{doc}") for doc in range(40)], SCHEMA)
    result = sub.remove_repeats(docs).agg(F.sum("n_removed")).first()[0]
    assert result == 39 * 300
    assert sum(staged) < 40 * 300 / 2


def test_staged_rows_are_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sub, "shared_dir", lambda spark, purpose: str(tmp_path / purpose))
    docs = spark.createDataFrame(rows_of(5), SCHEMA)
    assert removed(docs) == by_words(docs)
    assert os.listdir(tmp_path) == []
    assert sub._bits(spark.range(1000), 1 << 10) == 1 << 13
    assert sub._bits(spark.range(10), 1 << 10) == 1 << 10
