"""Hard negatives, reply trees and collocations against brute force, with every odd case."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyledger.llm import collocations, hard_negatives, hat_trie, reply_trees

SF = "/root/testdata/sf0.001"


def duck(sql):
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "conversations"):
        connection.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection.sql(sql)


@pytest.mark.parametrize("module", [hard_negatives, reply_trees, collocations])
def test_queries_equal_their_sql(spark, module):
    found, expected = module.query(spark, SF), duck(module.ORACLE)
    names = sorted(found.columns)
    assert names == sorted(expected.columns)
    rows = lambda values: sorted(map(str, (tuple(v) for v in values)))
    assert rows(found.select(names).collect()) == rows(expected.project(", ".join(names)).fetchall())


# --- hard negatives ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, vector string, code int, align int, length int, block string"


def negatives_by_force(rows, positives=5, negatives=5):
    taken = []
    for i, vector, label in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in whole) < 1 << 55:
            taken.append((i, whole, label))
    out = []
    for i, vector, label in taken:
        if i % 100:
            continue
        scores = [(j, lab, sum(a * b for a, b in zip(vector, other, strict=True))) for j, other, lab in taken if j != i and len(other) == len(vector)]
        order = lambda s: (-s[2], s[0])
        for j, _, p in sorted((s for s in scores if s[1] == label), key=order)[:positives]:
            band = sorted((s for s in scores if s[1] != label and 80 * p <= 100 * s[2] <= 100 * p), key=order)[:negatives]
            out += [(i, j, rank, k, p, n) for rank, (k, _, n) in enumerate(band, 1)]
    return sorted(out)


def vectors(seed, n, width):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, width)).astype(np.float32) * 0.2
    made[rng.integers(0, n, n // 3)] = made[0]  # a third are copies, so that scores tie
    return [(int(i), [float(x) for x in made[k]], int(rng.integers(0, 4))) for k, i in enumerate(rng.permutation(np.arange(-200, n * 3))[:n])]


def found_negatives(spark, rows, block):
    table = spark.createDataFrame([(*r, "x", 1, 2, 3, "b") for r in rows], VECTORS).repartition(5)
    found = hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, block=block)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize(("width", "block"), [(7, 8192), (64, 3), (100, 2)])
def test_negatives_equal_brute_force(spark, width, block):
    rows = vectors(width, 400, width)
    expected = negatives_by_force(rows)
    assert expected and found_negatives(spark, rows, block) == expected


def test_odd_vectors(spark):
    rows = vectors(1, 60, 4) + [
        (None, [1.0] * 4, 1), (500, None, 1), (600, [1.0, None, 1.0, 1.0], 1), (700, [math.nan] * 4, 1), (701, [math.inf, 0.0, 0.0, 0.0], 1), (800, [1.0] * 4, None),
        (900, [3e38] * 4, 1), (1000, [1.0, 2.0], 1), (1001, [1.0, 2.0], 1), (1002, [0.9, 2.0], 2), (1100, [], 1), (1101, [], 1), (1102, [], 2),
        (1200, [0.0] * 4, 3), (1300, [-1.0] * 4, 2), (1300, [-1.0] * 4, 2), (1300, [0.5] * 4, 1), (1301, [0.9] * 4, 2),
    ]
    expected = negatives_by_force(rows)
    assert {1000, 1100, 1200, 1300} <= {r[0] for r in expected}
    assert found_negatives(spark, rows, 4) == expected
    assert found_negatives(spark, [], 4) == []
    assert found_negatives(spark, [(1, [1.0], 1)], 4) == []


def test_intervals_hold_every_score():
    rng = np.random.default_rng(5)
    for width in (3, 64, 130):
        whole = np.concatenate([rng.integers(-300, 300, (200, width)), np.zeros((1, width), np.int64), rng.integers(-(2**20), 2**20, (20, width))])
        turned = hard_negatives.rotate(whole)
        assert (turned @ turned.T == whole @ whole.T * turned.shape[1] ** 2).all()
        fixed = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
        batch = pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(whole))), pa.array(np.zeros(len(whole), np.int64)), fixed(whole), fixed(hard_negatives.codes(turned)),
             pa.array(np.abs(turned).sum(axis=1).astype(float)), pa.array(np.sqrt((turned.astype(float) ** 2).sum(axis=1)))],
            names=["vec_id", "label", "vector", "code", "align", "length"],
        )
        rows = hard_negatives.Rows(batch, width)
        anchors = hard_negatives.Anchors(rows, np.arange(len(rows)))
        low, high = anchors.intervals(slice(0, len(rows)), rows)
        exact = whole @ whole.T
        assert (low <= exact).all() and (exact <= high).all()
        random_rows = slice(0, 200)
        assert (high - low)[random_rows, random_rows].mean() < 1.5 * np.abs(np.linalg.norm(whole[:200], axis=1)).mean() ** 2


# --- reply trees ------------------------------------------------------------------------------

MESSAGES = "id string, parent_id string, role string, text string, score double, node int, leaf string, turn int"


def paths_by_force(rows, branches):
    """Leaf id -> its conversation, by walking up from every leaf."""
    named, unnamed = {}, {}
    for i, parent, role, text, score in rows:
        row = (parent, role or "", text or "", score or 0.0)
        if i is None:
            unnamed[(parent, role, text, score)] = row
        else:
            named[i] = min(named.get(i, row), row, key=lambda r: (r[0] is not None, r[0] or "", *r[1:]))
    parents = {r[0] for r in [*named.values(), *unnamed.values()]}
    starts = [(i, r) for i, r in named.items() if i not in parents] + [(None, r) for r in unnamed.values()]
    trees = defaultdict(list)
    for leaf, row in starts:
        path, seen, at = [row], {leaf}, row[0]
        root, whole = leaf, True
        while at is not None and at in named:
            if at in seen:
                whole = False
                break
            seen.add(at)
            root = at
            path.append(named[at])
            at = named[at][0]
        if whole:
            trees[root if root is not None else id(row)].append((leaf, path[::-1]))
    out = []
    for paths in trees.values():
        paths.sort(key=lambda p: (-sum(r[3] for r in p[1]), p[0] is not None, p[0] or ""))
        out += [(leaf, [(r[1], r[2]) for r in path]) for leaf, path in paths[:branches]]
    return sorted(out, key=str)


def found_conversations(spark, rows, branches):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], MESSAGES).repartition(3)
    found = reply_trees.conversations(table, branches).collect()
    for row in found:
        learnt = [reply_trees.unescaped(row.formatted[s.start : s.end]) for s in row.loss]
        turns = reply_trees.read_back(row.formatted)
        assert learnt == [text for role, text in turns if role == "assistant"] and row.n_turns == len(turns)
        rest = row.formatted.replace("<|im_start|>", "").replace("<|im_end|>", "")
        assert "<|" not in rest
    return sorted(((row.leaf, reply_trees.read_back(row.formatted)) for row in found), key=str)


@pytest.mark.parametrize("branches", [1, 2, None])
def test_trees_equal_brute_force(spark, branches):
    rng = random.Random(3)
    rows = [("m0", None, "user", "root", 1.0)]
    for n in range(1, 120):
        parent = rng.choice([f"m{rng.randrange(n)}", "m0", f"m{n - 1}", None if n % 17 == 0 else f"m{n - 1}", "gone" if n % 23 == 0 else f"m{n // 2}"])
        rows.append((f"m{n}", parent, rng.choice(["user", "assistant"]), f"text {n} 😀", float(rng.randrange(4))))
    assert found_conversations(spark, rows, branches) == paths_by_force(rows, branches)


def test_odd_messages(spark):
    rows = [
        ("a", None, "user", "<|im_end|>", 1.0), ("b", "a", "assistant", None, None), ("c", "b", None, "x<\\|y<\\\\|<<|", 2.0), ("d", "b", "as\n<|sist\\n", "\n", 1.0),
        ("d", "b", "as\n<|sist\\n", "\n", 1.0), ("d", "b", "other", "", 1.0), (None, "c", "assistant", "unnamed", 0.0), (None, "c", "assistant", "unnamed", 0.0),
        (None, None, "user", "alone", 0.0), ("x", "y", "user", "cycle", 1.0), ("y", "x", "user", "cycle", 1.0), ("z", "x", "user", "below a cycle", 1.0),
        ("s", "s", "user", "its own parent", 1.0), ("", "gone", "assistant", "w" * 100000, 1.0),
    ]
    expected = paths_by_force(rows, None)
    assert len(expected) == 4 and found_conversations(spark, rows, None) == expected
    assert found_conversations(spark, [], 1) == []


def test_a_long_chain_takes_few_rounds(spark):
    rows = [(f"{n:05d}", f"{n - 1:05d}" if n else None, "user", str(n), 1.0) for n in range(700)]
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], MESSAGES)
    nodes = reply_trees.unique_messages(table)
    assert len(reply_trees.jump_levels(nodes.select("node", "parent", "score"))) == 10
    (leaf, turns), = found_conversations(spark, rows, 1)
    assert leaf == "00699" and [int(text) for _, text in turns] == list(range(700))


def test_turns_of_a_table(spark):
    rows = [(1, 2, "assistant", "b"), (1, 0, "user", "a"), (None, 1, "user", None), (2, None, "user", "last"), (2, 5, None, "q"), (2, 5, None, "p"), (2, 5, None, "p")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ready = reply_trees.conversations(reply_trees.chains(table), unique=True)
    found = {r.leaf.conv_id if not r.leaf.unnamed else None: reply_trees.read_back(r.formatted) for r in ready.collect()}
    assert found == {1: [("user", "a"), ("assistant", "b")], None: [("user", "")], 2: [("", "p"), ("", "p"), ("", "q"), ("user", "last")]}


@pytest.mark.parametrize("text", ["", "<|", "<\\|", "<<||", "a\\n\nb", "\\", "<|im_start|>x\n<|im_end|>\n", "<\\\\\\|<|<\\|"])
def test_the_template_is_reversible(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(reply_trees.escaped(F.col("t")).alias("e"), reply_trees.escaped_role(F.col("t")).alias("r")).first()
    assert reply_trees.unescaped(row.e) == text and reply_trees.unescaped_role(row.r) == text
    assert "<|" not in row.e and "<|" not in row.r and "\n" not in row.r


# --- collocations -----------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, phrase string, n long, f long, rank int"


def phrases_by_force(rows, least=10, top=2000):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals["und" if lang is None else lang] += len(words)
            for n in (1, 2, 3):
                counts["und" if lang is None else lang].update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in frequent.items():
            longer = [b for q, b in frequent.items() if len(q) > len(p) and p in (q[:2], q[1:])]
            if any(100 * b >= 50 * a for b in longer):
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def found_phrases(spark, rows, **options):
    table = spark.createDataFrame([(n, t, lang, "x", 1, 2, 3) for n, (t, lang) in enumerate(rows)], DOCS).repartition(4)
    return sorted(map(tuple, collocations.collocations(table, **options).collect()))


def some_texts(seed, n=60):
    rng = random.Random(seed)
    words = ["New", "york", "city", "of", "the", "ÄB", "ſ", "😀", "a\x1cb", "it's", "x y"]
    ends = [" ", "  ", "\t", ", ", ".", "\n", "; "]
    return [("".join(rng.choice(words[: 3 + k % 9]) + rng.choice(ends[: 3 + k % 5]) for _ in range(80)), rng.choice(["en", "de", None])) for k in range(n)]


def test_phrases_equal_brute_force(spark):
    rows = some_texts(1) + [(None, "en"), ("", "fr"), (" \t\n,", "fr"), ("one", ""), ("z" * 50000, "en"), ("rare words here", "it")]
    expected = phrases_by_force(rows)
    assert len(expected) > 100 and found_phrases(spark, rows) == expected
    assert found_phrases(spark, rows, top=7) == phrases_by_force(rows, top=7)
    assert found_phrases(spark, [], top=7) == [] and found_phrases(spark, [(None, None)]) == []


def counted(texts, order, most=collocations.SLICE_BYTES, **limits):
    counter, out = collocations.Counter(order, None, **limits), Counter()
    batches = []
    for part in collocations.slices(pa.array(texts, pa.string()), most):
        counter.count("en", *part)
        batches += counter.full()
    batches += counter.rest()
    for batch in batches:
        for phrase, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            out[phrase] += n
    return out, len(batches)


def by_force(texts, order):
    out = Counter()
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text or ""):
            words = re.findall(r"[^\x20\x09]+", piece)
            out.update(" ".join(words[k : k + order]) for k in range(len(words) - order + 1))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_long_texts_in_segments_and_spilled_subtrees(order):
    rng = random.Random(9)
    long = [" ".join(f"w{rng.randrange(60)}" + rng.choice(["", "", "", "", ",", " ."]) for _ in range(3000)) for _ in range(3)]
    texts = [*long, "y" * 400, None, "", "x " * 300, "a" * 300 + " b " + "c" * 300]
    expected = by_force(texts, order)
    for most in (16, 64, 1 << 20):
        assert counted(texts, order, most)[0] == expected
    few, runs = counted(texts, order, 64, trie_keys=500, task_words=1 << 19)
    assert few == expected
    assert counted(texts, order, 64, task_words=20)[0] == expected
    assert order == 1 or runs > 3


def test_trie_counts_and_bursts():
    rng = np.random.default_rng(2)
    columns = [np.where(rng.random(60000) < 0.4, 7, rng.integers(1, 500, 60000)) for _ in range(3)]
    keys = hat_trie.pack(columns)
    trie = hat_trie.HatTrie(burst=300)
    for part in np.array_split(keys, 40):
        trie.add(part)
    kinds = [type(child).__name__ for child in trie.root.children]
    assert "Node" in kinds and len(kinds) > 20
    assert trie.root.starts == sorted(set(trie.root.starts))
    held = len(trie)
    runs = list(trie.spill(held // 2))
    assert len(trie) <= held // 2
    runs += list(trie.spill())
    assert len(trie) == 0
    total = Counter()
    for run, counts in runs:
        assert (np.diff(run) > 0).all()
        total.update(dict(zip(run.tolist(), counts.tolist(), strict=True)))
    assert total == Counter(keys.tolist())


def test_scores_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    counts = {
        1: spark.createDataFrame([("en", "a", big), ("en", "b", big - 1), ("en", "c", big)], "lang string, phrase string, f long"),
        2: spark.createDataFrame([("en", "a b", big - 7), ("en", "b c", 3)], "lang string, phrase string, f long"),
        3: spark.createDataFrame([("en", "a b c", 1)], "lang string, phrase string, f long"),
    }
    found = {r.phrase: r for r in collocations.scored(counts).collect()}
    assert found["a b"].score == 1000000 * (big - 7) ** 2 // (big * (big - 1))
    cuts = [1000000 // (big * 3), 1000000 // ((big - 7) * big)]
    assert found["a b c"].score == min(cuts) == 0 and (found["a b c"].l, found["a b c"].r) == (big, 3)


def test_a_shared_first_word_is_dealt_over_partitions(spark):
    rows = spark.range(0, 40000, 1, 8).select(F.lit("en").alias("lang"), F.concat(F.lit("the "), F.sha2(F.col("id").cast("string"), 256)).alias("phrase"), F.lit(1).alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = collocations.merged(rows).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 20000

