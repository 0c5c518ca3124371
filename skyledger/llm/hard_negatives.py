"""Hard negatives by rotated one-bit codes, whose intervals decide which rows get an exact score.

1. *Codes.* Components become integers. Two rounds of random signs and a Hadamard transform rotate a vector, in
   integers, so the result is exact and the same on every machine. Its code is one sign bit per coordinate;
   with it are stored the alignment of code and vector (the sum of absolute coordinates) and the length.
2. *Estimate.* An anchor's rotated coordinates are cut into ``PLANES`` bit planes. Population counts of
   ``code & plane`` give the inner product of the anchor with the code, up to the known remainder of the cut.
3. *Interval.* A vector is its projection on its code plus a residual that is orthogonal to the code. The first part
   is the estimate; the second is at most the product of the two residual lengths (Cauchy-Schwarz).
   The interval holds the score with certainty, so dropping a row by it loses nothing.
4. *Scores.* Rows whose interval reaches what an anchor still looks for get their integer inner product.

Two passes: an anchor's positives, then the different-label rows in the band under each positive. Anchors are taken
in blocks of at most ``BLOCK`` rows; a block is all that the driver and every task hold of them, with five positives
each. Rows are never shuffled: every task keeps the best few per anchor, and only these are merged.

Defined results: a row takes no part when its id, label or vector is null, or a component is null or
not finite, or the squared length of its integer vector reaches 2^55 (a hundred times its scores would pass 64 bits). Vectors
of other lengths than the anchor's are not compared with it. Rows with the anchor's id are never its partners; rows that
repeat an id count one each, as anchors too. Ties rank by id. A positive with a negative score has no band.
Without anchors or rows the result is empty. Other columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm.tables import map_arrow, stage, table
from skyledger.session import shared_dir

BLOCK = 8192
POSITIVES = 5
NEGATIVES = 5
FLOOR_PERCENT = 80
PLANES = 8
TILE = 1 << 20  # anchor-row pairs whose intervals are held at once
SEED = 11
_LIMIT = float(1 << 55)
_SLACK = 1e-9  # of the product of the lengths; covers the rounding of the bounds, which are doubles
_CODED = "vec_id long, label long, vector array<long>, code array<long>, align double, length double"
_NEVER = np.iinfo(np.int64).min


# --- codes ------------------------------------------------------------------------------------

def rotate(vectors: np.ndarray) -> np.ndarray:
    """Integer vectors after two rounds of signs and Hadamard transform; inner products grow by the squared width."""
    width = max(64, 1 << max(vectors.shape[1] - 1, 0).bit_length())
    turned = np.zeros((len(vectors), width), np.int64)
    turned[:, : vectors.shape[1]] = vectors
    rng = np.random.default_rng(SEED)
    for _ in range(2):
        turned *= rng.choice(np.array([-1, 1]), width)
        half = 1
        while half < width:
            parts = turned.reshape(len(turned), width // (2 * half), 2, half)
            turned = np.stack([parts[:, :, 0] + parts[:, :, 1], parts[:, :, 0] - parts[:, :, 1]], axis=2).reshape(len(turned), width)
            half *= 2
    return turned


def codes(turned: np.ndarray) -> np.ndarray:
    return np.packbits(turned >= 0, axis=1, bitorder="little").view(np.int64)


def usable(vec_id: str, embedding: str, label: str) -> Column:
    finite = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vec_id).isNotNull() & F.col(label).isNotNull() & F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False))


def coded(rows: DataFrame, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """The rows that take part, with integer vectors, codes, alignments and lengths."""

    def encode(batches):
        for batch in batches:
            lists = batch.column(2)
            widths = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.concatenate([[0], np.cumsum(widths)[:-1]]) if len(widths) else widths
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                scaled = np.floor(scale * flat[starts[at][:, None] + np.arange(width)])
                length = (scaled * scaled).sum(axis=1)
                at, scaled, length = at[length < _LIMIT], scaled[length < _LIMIT], length[length < _LIMIT]
                if not len(at):
                    continue
                whole = scaled.astype(np.int64)
                turned = rotate(whole)
                bits = codes(turned)
                fixed = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1, dtype=np.int32) * m.shape[1]), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), fixed(whole), fixed(bits),
                        pa.array(np.abs(turned).sum(axis=1).astype(np.float64)), pa.array(np.sqrt((turned.astype(np.float64) ** 2).sum(axis=1))),
                    ],
                    names=["vec_id", "label", "vector", "code", "align", "length"],
                )

    taken = rows.where(usable(vec_id, embedding, label)).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(embedding).cast("array<double>").alias("embedding")
    )
    return stage(map_arrow(taken, encode, _CODED), "negatives-coded")


def _matrix(column: pa.Array, at: np.ndarray, width: int) -> np.ndarray:
    starts = column.offsets.to_numpy()[at] - column.offsets.to_numpy()[0]
    return column.flatten().to_numpy(zero_copy_only=False)[starts[:, None] + np.arange(width)]


class Rows:
    """The rows of a batch that have the given width."""

    def __init__(self, batch: pa.RecordBatch, width: int):
        at = np.flatnonzero(np.diff(batch.column("vector").offsets.to_numpy()) == width)
        take = lambda name: batch.column(name).take(pa.array(at)).to_numpy(zero_copy_only=False)
        self.ids, self.labels, self.align, self.length = take("vec_id"), take("label"), take("align"), take("length")
        self.vectors = _matrix(batch.column("vector"), at, width)
        turned_width = max(64, 1 << max(width - 1, 0).bit_length())
        self.codes = _matrix(batch.column("code"), at, turned_width // 64).view(np.uint64)
        self.residual = np.sqrt(np.maximum(self.length**2 - self.align**2 / turned_width, 0))

    def __len__(self) -> int:
        return len(self.ids)


class Anchors:
    """A block's anchors of one width, cut into bit planes."""

    def __init__(self, rows: Rows, numbers: np.ndarray):
        self.rows, self.numbers = rows, numbers
        turned = rotate(rows.vectors)
        self.width = turned.shape[1]
        self.low = turned.min(axis=1)
        raised = turned - self.low[:, None]
        self.step = raised.max(axis=1) // (1 << PLANES) + 1
        cut = raised // self.step[:, None]
        self.remainder = (raised - cut * self.step[:, None]).sum(axis=1).astype(np.float64)
        self.total = turned.sum(axis=1).astype(np.float64)
        self.planes = np.stack([np.packbits((cut >> plane) & 1 == 1, axis=1, bitorder="little").view(np.uint64) for plane in range(PLANES)], axis=1)

    def intervals(self, some: slice, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest possible scores of some anchors (down) with all rows (across)."""
        ones = np.bitwise_count(rows.codes).sum(axis=1, dtype=np.int64)
        under = np.zeros((len(self.numbers[some]), len(rows)))
        for plane in range(PLANES):
            hit = np.bitwise_count(rows.codes[None, :, :] & self.planes[some, plane][:, None, :]).sum(axis=2, dtype=np.float32)
            under += hit * np.float32(1 << plane)
        under = under * self.step[some, None] + ones[None, :] * self.low[some, None].astype(np.float64)
        least = 2 * under - self.total[some, None]
        most = least + 2 * self.remainder[some, None]
        nearest = np.where((least <= 0) & (most >= 0), 0, np.minimum(np.abs(least), np.abs(most)))
        length = self.rows.length[some, None]
        rest = np.sqrt(np.maximum(length**2 - nearest**2 / self.width, 0)) * rows.residual[None, :]
        rest += _SLACK * length * rows.length[None, :]
        part, scale = rows.align[None, :] / self.width, 1.0 / self.width**2
        return (part * least - rest) * scale, (part * most + rest) * scale

    def scores(self, some: slice, rows: Rows, down: np.ndarray, across: np.ndarray) -> np.ndarray:
        """Integer inner products of the named pairs."""
        left, right = self.rows.vectors[some], rows.vectors
        if self.rows.length[some].max() * rows.length.max() < float(1 << 52) * self.width**2 and 4 * len(down) > len(left) * len(right):
            return (left.astype(np.float64) @ right.T.astype(np.float64))[down, across].astype(np.int64)  # whole numbers below 2^53
        found = np.empty(len(down), np.int64)
        for at in range(0, len(down), TILE // 64):
            part = slice(at, at + TILE // 64)
            found[part] = (left[down[part]] * right[across[part]]).sum(axis=1)
        return found


class Best:
    """The best few (score, id) of every key: higher scores, then smaller ids."""

    def __init__(self, keys: int, most: int):
        self.most = most
        self.floor = np.full(keys, _NEVER)  # the last of a full list's scores
        self.keys = np.zeros(0, np.int64)
        self.scores, self.ids = self.keys, self.keys

    def add(self, keys: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        reach = scores >= self.floor[keys]
        if not reach.any():
            return
        keys, scores, ids = (np.concatenate(pair) for pair in ((self.keys, keys[reach]), (self.scores, scores[reach]), (self.ids, ids[reach])))
        order = np.lexsort((ids, -scores, keys))
        keys, scores, ids = keys[order], scores[order], ids[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        place = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
        last = place == self.most - 1
        self.floor[keys[last]] = scores[last]
        kept = place < self.most
        self.keys, self.scores, self.ids = keys[kept], scores[kept], ids[kept]


def _blocks_of(block: pa.Table, width: int) -> Anchors | None:
    batch = block.combine_chunks().to_batches()[0]
    at = np.flatnonzero(np.diff(batch.column("vector").offsets.to_numpy()) == width)
    return Anchors(Rows(batch, width), at) if len(at) else None


def _by_width(block: pa.Table) -> list[Anchors]:
    widths = np.unique(np.diff(block.combine_chunks().column("vector").chunk(0).offsets.to_numpy())) if block.num_rows else []
    return [_blocks_of(block, int(width)) for width in widths]


def _widths(anchors: list[Anchors]) -> dict[int, Anchors]:
    return {a.rows.vectors.shape[1]: a for a in anchors}


def _tiles(anchors: Anchors, rows: Rows):
    step = max(1, TILE // max(len(rows), 1))
    for at in range(0, len(anchors.numbers), step):
        yield slice(at, min(at + step, len(anchors.numbers)))


def positives(block: pa.Table, rows: DataFrame, most: int) -> DataFrame:
    """(anchor, vec_id, score): the best same-label rows of every anchor of the block, from each task."""
    n = block.num_rows

    def task(batches):
        anchors = _widths(_by_width(block))
        best = Best(n, most)
        for batch in batches:
            for width, own in anchors.items():
                some_rows = Rows(batch, width)
                for some in _tiles(own, some_rows) if len(some_rows) else ():
                    numbers = own.numbers[some]
                    _, high = own.intervals(some, some_rows)
                    wanted = (own.rows.labels[some, None] == some_rows.labels) & (own.rows.ids[some, None] != some_rows.ids)
                    down, across = np.nonzero(wanted & (high >= best.floor[numbers][:, None].astype(np.float64)))
                    if len(down):
                        best.add(numbers[down], own.scores(some, some_rows, down, across), some_rows.ids[across])
        yield pa.RecordBatch.from_arrays([pa.array(best.keys), pa.array(best.ids), pa.array(best.scores)], names=["anchor", "vec_id", "score"])

    return _first(map_arrow(rows, task, "anchor long, vec_id long, score long"), ["anchor"], most)


def negatives(block: pa.Table, found: pa.Table, rows: DataFrame, most: int, floor_percent: int) -> DataFrame:
    """The best different-label rows in the band under each positive (``found``: anchor, vec_id, score) of the block."""
    n, ids = block.num_rows, block.column("vec_id").to_numpy()
    of, positive, score = (found.column(k).to_numpy() for k in ("anchor", "vec_id", "score"))
    in_order = np.lexsort((positive, -score, of))
    of, positive, score = of[in_order], positive[in_order], score[in_order]
    first = np.searchsorted(of, np.arange(n + 1))
    least = -((-score * floor_percent) // 100)  # the least whole score in the band

    def task(batches):
        anchors = _widths(_by_width(block))
        best = Best(len(score), most)
        slots = int(np.diff(first).max(initial=0))
        for batch in batches:
            for width, own in anchors.items():
                some_rows = Rows(batch, width)
                for some in _tiles(own, some_rows) if len(some_rows) else ():
                    numbers = own.numbers[some]
                    has = first[numbers + 1] > first[numbers]
                    bottom, top = np.full(len(numbers), np.inf), np.full(len(numbers), -np.inf)
                    for slot in range(slots):
                        key = np.minimum(first[numbers] + slot, max(len(score) - 1, 0))
                        is_key = has & (first[numbers] + slot < first[numbers + 1])
                        reach = np.maximum(least[key], best.floor[key])
                        bottom = np.where(is_key, np.minimum(bottom, reach), bottom)
                        top = np.where(is_key & (score[key] >= 0), np.maximum(top, score[key]), top)
                    low, high = own.intervals(some, some_rows)
                    wanted = own.rows.labels[some, None] != some_rows.labels
                    down, across = np.nonzero(wanted & (high >= bottom[:, None]) & (low <= top[:, None]))
                    if not len(down):
                        continue
                    exact = own.scores(some, some_rows, down, across)
                    for slot in range(slots):
                        key = first[numbers[down]] + slot
                        inside = np.flatnonzero(key < first[numbers[down] + 1])
                        inside = inside[(exact[inside] >= least[key[inside]]) & (exact[inside] <= score[key[inside]])]
                        best.add(key[inside], exact[inside], some_rows.ids[across[inside]])
        key = best.keys
        yield pa.RecordBatch.from_arrays(
            [pa.array(key), pa.array(ids[of[key]]), pa.array(positive[key]), pa.array(score[key]), pa.array(best.ids), pa.array(best.scores)],
            names=["key", "anchor_id", "positive_id", "positive_score", "vec_id", "score"],
        )

    schema = "key long, anchor_id long, positive_id long, positive_score long, vec_id long, score long"
    ranked = _first(map_arrow(rows, task, schema), ["key"], most)
    return ranked.select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def _first(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    """Every task has at most ``most`` rows a key already."""
    in_order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, scale: int = 256, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
    floor_percent: int = FLOOR_PERCENT, block: int = BLOCK, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``is_anchor`` is a condition on ``vec_id``. A negative's score is between ``floor_percent`` of the positive's
    and the positive's own.
    """
    spark = rows.sparkSession
    data = coded(rows, scale, vec_id, embedding, label)
    chosen = data.where(is_anchor)
    n = chosen.count()
    folder = shared_dir(spark, "negatives-anchors")
    place = F.monotonically_increasing_id()
    spread = chosen.repartition(max(1, -(-n // block))).withColumn("place", place)
    numbered = spread.withColumn("block", F.concat_ws("-", F.shiftright("place", 33), F.floor(F.col("place").bitwiseAND(F.lit((1 << 33) - 1)) / block).cast("long")))
    numbered.drop("place").write.partitionBy("block").parquet(folder)
    results = shared_dir(spark, "negatives")
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    empty.write.parquet(results)
    if n:
        stored = spark.read.parquet(folder).withColumn("block", F.col("block").cast("string"))
        for row in stored.select("block").distinct().collect():  # one name for each block of anchors
            anchors = stored.where(F.col("block") == row.block).drop("block").toArrow()
            found = positives(anchors, data, n_positives).toArrow()
            negatives(anchors, found, data, n_negatives, floor_percent).write.mode("append").parquet(results)
    return spark.read.schema(empty.schema).parquet(results)


def query(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long")).alias("label"),
    )
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


ORACLE = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::bigint + 1) % 10 ELSE label::bigint END AS label,
         [cast(floor(256 * x::double) AS bigint) for x in embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         cast(list_inner_product(a.v::double[], b.v::double[]) AS bigint) AS score
  FROM e AS a, e AS b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.positive_id, cast(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.other_id) AS integer) AS rank, n.other_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives AS p JOIN pairs AS n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
