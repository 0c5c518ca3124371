"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are short and documents long, so their resemblance says nothing; containment does. Items are
partitioned by size (number of distinct five-word shingles) with doubling upper bounds ``u``. An item's
sketch is its ``floor((1 - t) * u) + 1`` smallest shingle hashes, a bottom-k MinHash as long as its
partition needs: a document that holds at least the share ``t`` of an item's shingles must hold one of
these, so no match is missed. Documents are streamed past the sketches, and each candidate pair is
verified on the words of all its shingles.

Items are handled in blocks of bounded size, each a broadcast of about ``BLOCK_SHINGLES`` shingles
(one larger item may lie in any block). A block is gathered, searched for, its matches written and its broadcast
given up before the next one: a larger benchmark makes more passes over the documents, and never a larger
broadcast or driver. Documents are not shuffled.

Words are runs of letters and digits in lower case (characters beyond ASCII count as letters).
Defined results: null and empty texts match nothing, and so do items of fewer than five words. A repeated
item row counts once, items with equal ids and other texts are told apart by their text; a document row
that repeats is reported each time. Null ids are kept, ids may be of any type that Arrow knows. Very long texts
are searched in whole; an empty table on either side gives no rows. Other columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from skyledger.llm import wordhash as wh
from skyledger.llm.tables import map_arrow, stage, table, union_all

WORDS = 5
THRESHOLD = 0.8
BLOCK_SHINGLES = 1_000_000
_FAST_BITS = 20


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column.fill_null(""))


def _shingle_texts(data: bytes, starts, ends) -> set[bytes]:
    found = [data[a:b].translate(_LOWER) for a, b in zip(starts, ends, strict=True)]
    return {b" ".join(found[i : i + WORDS]) for i in range(len(found) - WORDS + 1)}


_LOWER = bytes(wh.LOWER)


class Block:
    """Sketches and shingles of the items of one block."""

    def __init__(self, items: list[tuple[object, str]], threshold: float):
        self.ids, self.shingles, hashes, owners = [], [], [], []
        texts = _lower(pa.array([t for _, t in items], pa.large_string()))
        for first, last, data, offsets in wh.text_slices(texts):
            starts, ends, words, bounds = wh.words(data, offsets, wh.NOT_ALNUM, lower=True)
            for k in range(last - first):
                a, b = bounds[k], bounds[k + 1]
                own = _shingle_texts(data.tobytes(), starts[a:b], ends[a:b])
                if not own:
                    continue
                values = np.unique(wh.runs(words[a:b], WORDS))
                upper = 1 << (len(own) - 1).bit_length()
                sketch = values[: math.floor((1 - threshold) * upper + 1e-9) + 1]
                hashes.append(sketch)
                owners.append(np.full(len(sketch), len(self.ids)))
                self.ids.append(items[first + k][0])
                self.shingles.append(own)
        flat = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.hashes, self.owners = flat[order], (np.concatenate(owners) if owners else np.zeros(0, np.int64))[order]
        self.fast = np.zeros(1 << _FAST_BITS, bool)
        self.fast[self.hashes & np.uint64((1 << _FAST_BITS) - 1)] = True
        self.threshold = threshold

    def search(self, texts: pa.Array):
        """(row, item number, shingles found) of every match."""
        for first, _, data, offsets in wh.text_slices(_lower(texts)):
            starts, ends, words, bounds = wh.words(data, offsets, wh.NOT_ALNUM, lower=True)
            whole = wh.runs(words, WORDS)
            at = np.flatnonzero(self.fast[whole & np.uint64((1 << _FAST_BITS) - 1)])
            left = np.searchsorted(self.hashes, whole[at], "left")
            count = np.searchsorted(self.hashes, whole[at], "right") - left
            rows = np.searchsorted(bounds, at[count > 0], "right") - 1
            pairs = set()
            for row, i, n in zip(rows.tolist(), left[count > 0].tolist(), count[count > 0].tolist(), strict=True):
                pairs.update((row, k) for k in self.owners[i : i + n].tolist())
            raw, last_row, own = None, None, set()
            for row, k in sorted(pairs):
                if row != last_row:
                    raw = data[offsets[row] : offsets[row + 1]].tobytes()
                    a, b = bounds[row], bounds[row + 1]
                    own, last_row = _shingle_texts(raw, starts[a:b] - offsets[row], ends[a:b] - offsets[row]), row
                hits = len(self.shingles[k] & own)
                if hits >= self.threshold * len(self.shingles[k]) - 1e-9:
                    yield first + row, k, hits


def contained_items(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, block_shingles: int = BLOCK_SHINGLES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, n_item_shingles, n_found, containment."""
    items = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).where("text is not null").distinct()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([
        rows.schema["doc_id"], items.schema["item_id"], T.StructField("n_item_shingles", T.LongType()),
        T.StructField("n_found", T.LongType()), T.StructField("containment", T.DoubleType()),
    ])
    size = items.agg(F.coalesce(F.sum(F.length("text") / 2), F.lit(0.0))).first()[0]  # no text has more shingles than that
    blocks = max(1, math.ceil(size / block_shingles))
    place = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))

    def one(number: int) -> DataFrame:
        held = items.where(place == number).collect()
        block = docs.sparkSession.sparkContext.broadcast(Block([(r.item_id, r.text) for r in held], threshold))

        def search(batches):
            for batch in batches:
                hits = list(block.value.search(batch.column(1)))
                sizes = [len(block.value.shingles[k]) for _, k, _ in hits]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([r for r, _, _ in hits], pa.int64())),
                        pa.array([block.value.ids[k] for _, k, _ in hits], item_type),
                        pa.array(sizes, pa.int64()), pa.array([n for _, _, n in hits], pa.int64()),
                        pa.array([n / s for (_, _, n), s in zip(hits, sizes, strict=True)], pa.float64()),
                    ],
                    names=schema.names,
                )

        found = stage(map_arrow(rows, search, schema), "contained-items")
        block.destroy()
        return found

    item_type = to_arrow_type(items.schema["item_id"].dataType)
    return union_all([one(b) for b in range(blocks)])


def query(spark, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') FROM benchmark
), shingles AS (
  SELECT DISTINCT side, id, unnest(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) AS s
  FROM words WHERE len(w) >= 5
), items AS (
  SELECT id AS item_id, s, count(*) OVER (PARTITION BY id) AS n_item_shingles FROM shingles WHERE side = 'i'
)
SELECT d.id AS doc_id, i.item_id, i.n_item_shingles, count(*) AS n_found, count(*) / i.n_item_shingles AS containment
FROM items i JOIN shingles d ON d.side = 'd' AND d.s = i.s
GROUP BY d.id, i.item_id, i.n_item_shingles HAVING 10 * count(*) >= 8 * i.n_item_shingles
"""
