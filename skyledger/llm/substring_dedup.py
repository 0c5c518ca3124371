"""Substring dedup: every word covered by a window of 20 words that also starts earlier is removed.

The method asked for, suffix automata of reference shards broadcast to all tasks, needs every document to
be streamed past every shard: the work grows with the square of the corpus, and the automata of all shards
together are larger than the corpus. See the README for figures. This operator finds the same windows
by hashing, with work in proportion to the text:

1. A window's *anchor* is the smallest hash among its 13 runs of 8 words. Equal windows have equal anchors,
   and neighbouring windows mostly share one, so anchors are a seventh as many as words.
2. Consecutive windows with one anchor are a *stretch*, at most 13 of them; a hash of its windows is its
   *content*. Anchors that occur twice go into a filter. Only stretches whose anchor passes become rows (anchor,
   content, key of the row, first window); unique text, most of the corpus, never leaves its scan.
3. The first stretch of each content is found by an aggregate that combines before its shuffle, so a passage that
   a third of all documents share is no hot key. All other stretches of the content repeat it as a whole.
4. Windows become rows only from the first stretch of a content, and only where another content has the same
   anchor, as at the edges of a passage, or where a window recurs within the stretch. Their first occurrence is
   found in the same way, and the others are joined to it.
5. Documents that lose words, and no others, are brought together with the stretches of windows they lose. What
   was staged before that is removed.

Windows are compared by 64-bit hashes of their words. Documents rank by id, a null id after all others, and
rows of one id, or of none, by a 64-bit hash of their whole text, which a row that alone has its id needs not. Id and hash are the key of a row: its windows
are its own, whatever other rows share its id. Rows equal in id and text are one document that repeats: neither
is earlier than the other, and each gets the same result. A null text has no words; a text of fewer than 20
words loses none. Other columns are ignored.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import wordhash as wh
from skyledger.llm.tables import FILTER_BITS, key_filter, map_arrow, stage, table, union_all, with_filter
from skyledger.session import remove_folder, shared_dir

WINDOW = 20
GRAM = 8
ANCHOR_BITS = 1 << 26  # least bits of a filter of anchors or stretches
MOST_BITS = 1 << 29  # a filter has at least eight bits a key up to this, 64 MB
_LAST = (1 << 63) - 1
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """Minimum of each n consecutive values, by doubling."""
    width, block = 1, values
    while 2 * width <= n:
        block = np.minimum(block[: len(block) - width], block[width:])
        width *= 2
    rest = n - width
    return np.minimum(block[: len(block) - rest], block[rest:]) if rest else block


def _anchored(texts: pa.Array, window: int, gram: int):
    """(row, start, anchor, window hash) of every window of the rows."""
    for first, _, data, offsets in wh.text_slices(texts):
        _, _, hashes, bounds = wh.words(data, offsets)
        if len(hashes) < window:
            continue
        anchors = _smallest(wh.runs(hashes, gram), window - gram + 1)
        windows = wh.runs(hashes, window)
        counts = np.diff(bounds)
        rows = np.repeat(np.arange(len(counts)), counts)[: len(windows)]
        start = np.arange(len(windows)) - bounds[:-1][rows]
        inside = start + window <= counts[rows]
        yield first + rows[inside], start[inside], anchors[inside].view(np.int64), windows[inside].view(np.int64)


def _breaks(rows: np.ndarray, anchors: np.ndarray, limit: int) -> np.ndarray:
    """Where a new stretch of windows with one anchor begins; no stretch is longer than ``limit``."""
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (anchors[1:] != anchors[:-1])
    begin = np.flatnonzero(new)
    since = np.arange(len(rows)) - np.repeat(begin, np.diff(np.append(begin, len(rows))))
    return np.flatnonzero(since % limit == 0)


def _contents(begin: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of its windows, number of windows, whether a window recurs) of the stretches that begin at ``begin``."""
    counts = np.diff(np.append(begin, len(hashes)))
    of = np.repeat(np.arange(len(begin)), counts)
    step = (np.arange(len(hashes)) - begin[of]).astype(np.uint64)
    placed = wh.mix(hashes.view(np.uint64) ^ wh.mix(step + np.uint64(1)))
    contents = wh.mix(np.add.reduceat(placed, begin) + counts.astype(np.uint64))
    recurs = np.zeros(len(begin), bool)
    for gap in range(1, int(counts.max())):
        recurs[of[gap:][(hashes[gap:] == hashes[:-gap]) & (of[gap:] == of[:-gap])]] = True
    return contents.view(np.int64), counts, recurs


def _bits(keys: DataFrame, least: int) -> int:
    """Bits of a filter of staged ``keys``: eight a key or more, up to ``MOST_BITS``, and never fewer than ``least``."""
    return max(least, min(MOST_BITS, 1 << (8 * keys.count()).bit_length()))


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the key of each row, ``rank`` and ``tie``.

    The tie counts only among rows of one rank, and a window carries its row's key through two shuffles: where the
    rank belongs to one row the tie is 0. A filter of the shared ranks decides, alike for all rows of a rank.
    """
    ranked = docs.withColumn("rank", F.coalesce(F.col("doc_id"), F.lit(_LAST)))
    shared = stage(ranked.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank"), "substring-shared")
    marked = with_filter(ranked, [F.col("rank")], key_filter(shared, ["rank"]), "shared")
    return marked.withColumn("tie", F.when(F.col("shared"), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))).drop("shared")


def _repeated_stretches(docs: DataFrame, window: int, gram: int, bits: int) -> DataFrame:
    """(rank, tie, stretches): the windows of each document, by its key, that also start earlier, as (first, n), staged."""
    docs = (docs if "tie" in docs.columns else _keyed(docs)).select("rank", "tie", "text")
    limit = window - gram + 1
    spark = docs.sparkSession
    folder = shared_dir(spark, "substring")

    def anchors_of(batches):
        for batch in batches:
            for rows, _, anchors, hashes in _anchored(batch.column(2), window, gram):
                order = np.argsort(hashes, kind="stable")
                again = order[1:][hashes[order][1:] == hashes[order][:-1]]  # also inside one stretch
                found = np.concatenate([anchors[_breaks(rows, anchors, limit)], anchors[again]])
                yield pa.RecordBatch.from_arrays([pa.array(found)], names=["anchor"])

    def stretches_of(batches):
        for batch in batches:
            for rows, starts, anchors, hashes in _anchored(batch.column(2), window, gram):
                if not len(rows):
                    continue
                at = _breaks(rows, anchors, limit)
                contents, counts, recurs = _contents(at, hashes)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[at])), batch.column(1).take(pa.array(rows[at])),
                        pa.array(anchors[at]), pa.array(contents), pa.array(starts[at].astype(np.int32)),
                        pa.array(counts.astype(np.int32)), pa.array(recurs),
                        pa.ListArray.from_arrays(pa.array(np.append(at, len(rows)).astype(np.int32)), pa.array(hashes)),
                    ],
                    names=["rank", "tie", "anchor", "content", "first", "n", "recurs", "hashes"],
                )

    anchors = map_arrow(docs, anchors_of, "anchor long")
    repeated = stage(anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "anchors", folder)
    anchor_bits = _bits(repeated, bits)
    found = map_arrow(
        docs, stretches_of, "rank long, tie long, anchor long, content long, first int, n int, recurs boolean, hashes array<long>"
    )
    possible = with_filter(found, [F.col("anchor")], key_filter(repeated, ["anchor"], anchor_bits), "maybe", anchor_bits)
    stretches = stage(possible.where("maybe").drop("maybe"), "stretches", folder)
    key = F.struct("rank", "tie", "first")
    contents = stage(
        stretches.groupBy("anchor", "content").agg(F.count("*").alias("copies"), F.min(key).alias("e"), F.max("recurs").alias("recurs")),
        "contents", folder,
    )

    # what these filters let through without need makes more rows, no other result: all windows of any stretch may be among them
    mixed = contents.groupBy("anchor").agg(F.count("*").alias("several"), F.max("recurs").alias("recurs")).where("several > 1 or recurs")
    mixed = key_filter(mixed, ["anchor"], anchor_bits)
    firsts = stage(with_filter(contents, [F.col("anchor")], mixed, "maybe", anchor_bits).where("maybe").select("e.*"), "firsts", folder)
    first_bits = _bits(firsts, bits)
    columns = ["rank", "tie", "first"]
    single = with_filter(stretches, [F.col(c) for c in columns], key_filter(firsts, columns, first_bits), "maybe", first_bits).where("maybe")
    windows = stage(
        single.select("rank", "tie", "first", F.posexplode("hashes").alias("step", "window"))
        .select("window", "rank", "tie", (F.col("first") + F.col("step")).alias("first")),
        "windows", folder,
    )

    whole = contents.where("copies > 1").select(F.col("anchor").alias("e_anchor"), F.col("content").alias("e_content"), "e")
    whole = stage(
        stretches.select("anchor", "content", "rank", "tie", "first", "n")
        .join(whole, (F.col("anchor") == F.col("e_anchor")) & (F.col("content") == F.col("e_content")))
        .where(key > F.col("e")).select("rank", "tie", "first", "n"),
        "whole", folder,
    )
    for purpose in ("stretches", "contents"):
        remove_folder(spark, f"{folder}/{purpose}")
    earliest = stage(
        windows.groupBy("window").agg(F.count("*").alias("copies"), F.min(key).alias("e")).where("copies > 1")
        .select(F.col("window").alias("e_window"), "e"),
        "earliest", folder,
    )
    later = windows.join(earliest, F.col("window") == F.col("e_window")).where(key > F.col("e"))
    later = whole.unionByName(later.select("rank", "tie", "first", F.lit(1).alias("n")))
    result = stage(later.groupBy("rank", "tie").agg(F.collect_set(F.struct("first", "n")).alias("stretches")), "substring-starts")
    remove_folder(spark, folder)
    return result


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = ANCHOR_BITS) -> DataFrame:
    """(rank, tie, starts): the windows of each document, by its key, that also start earlier."""
    starts = F.array_distinct(F.flatten(F.transform("stretches", lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1))))
    return _repeated_stretches(docs, window, gram, bits).select("rank", "tie", starts.alias("starts"))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, gram: int = GRAM, bits: int = ANCHOR_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, removed (spans of word numbers, end exclusive) and
    ``kept``, the kept words joined by a space."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    docs = _keyed(docs)
    repeated = _repeated_stretches(docs, window, gram, bits)
    key = ["rank", "tie"]
    key_bits = _bits(repeated, FILTER_BITS)
    marked = with_filter(docs, [F.col(c) for c in key], key_filter(repeated, key, key_bits), "maybe", key_bits)
    touched = marked.where("maybe").join(repeated, key, "left")
    none = F.lit(None).cast(repeated.schema["stretches"].dataType)
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("removed", T.ArrayType(T.ArrayType(T.IntegerType()))), T.StructField("kept", T.StringType()),
    ])

    def cut(batches):
        for batch in batches:
            texts, stretches = batch.column(1), batch.column(2)
            bounds = np.concatenate([[0], np.cumsum(stretches.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            flat = stretches.flatten()
            firsts = flat.field("first").to_numpy(zero_copy_only=False).astype(np.int64)
            ends = firsts + flat.field("n").to_numpy(zero_copy_only=False) + window - 1
            for first, last, _, _ in wh.text_slices(texts):
                totals, gone, spans, kept = [], [], [], []
                for row in range(first, last):
                    found = _WORD.findall(texts[row].as_py().encode())
                    begin, end = firsts[bounds[row] : bounds[row + 1]], ends[bounds[row] : bounds[row + 1]]
                    inside = end <= len(found)
                    change = np.zeros(len(found) + 1, np.int64)
                    np.add.at(change, begin[inside], 1)
                    np.add.at(change, end[inside], -1)
                    covered = np.cumsum(change[:-1]) > 0
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                    totals.append(len(found))
                    gone.append(int(covered.sum()))
                    spans.append(edges.reshape(-1, 2).tolist())
                    kept.append(b" ".join(w for w, c in zip(found, covered.tolist(), strict=True) if not c) if gone[-1] else b" ".join(found))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()),
                        pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array([k.decode() for k in kept], pa.string()),
                    ],
                    names=schema.names,
                )

    columns = ["doc_id", "text", "stretches"]
    return union_all([
        map_arrow(touched.select(*columns), cut, schema),
        map_arrow(marked.where("not maybe").select("doc_id", "text", none.alias("stretches")), cut, schema),
    ])


def query(spark, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
