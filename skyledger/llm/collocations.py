r"""Phrases of two and three words that stand together more often than their parts suggest, per language.

Texts are lower-cased (A-Z only), cut into pieces at ``[.,;:!?\x0A-\x0D]`` and into words ``[^\x20\x09]+``.
Phrases are counted length by length. Each map task counts in a HAT-trie (``hat_trie``) over word ids of its
own; when the trie or the ids pass their limit, whole subtrees leave as sorted runs of (language, phrase, count).
The runs are dealt by ranges of (language, phrase), so every partition holds a range of prefixes, and
merged there. Ranges are cut from samples: a frequent first word spreads over many partitions.

A phrase is no more frequent than what it contains. So two-word phrases are counted only of words that occur
``min_count`` times in the language, three-word phrases only of such pairs. Tasks know these by a bitmap
(of 16 bits a key, at most ``MOST_BITS``, hence a bounded broadcast); a bit set by chance costs a row, never a
count: the merged counts decide.

``l``, ``r`` and the score of a cut are exact: products are decimals of 38 digits, good for counts below 10^16.
The score is at most 1,000,000, since neither part is rarer than the phrase.

Defined results: a null text is empty, a null language is ``und``. A table without phrases gives no rows.
Rows that repeat each other all count. A text of any length is worked through in segments; a word is never cut.
Other columns are ignored, whatever their names. Ties rank by count, then by the phrase's bytes.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.llm import wordhash as wh
from skyledger.llm.hat_trie import HatTrie, pack, word_of
from skyledger.llm.tables import map_arrow, stage, table

MIN_COUNT = 10
TOP = 2000
CONTAINED_PERCENT = 50
MOST_BITS = 1 << 28
TRIE_KEYS = 1 << 21  # keys a task holds before it spills down to half of them
TASK_WORDS = 1 << 19  # distinct words a task numbers before it spills all and starts anew; below 2^21
SLICE_BYTES = 1 << 20
RUN_ROWS = 1 << 16
SHARES = 64

_KIND = np.zeros(256, np.uint8)  # 0: in a word, 1: between words, 2: between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_NO_SEPARATOR = np.zeros(256, bool)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_RUN = "lang string, phrase string, n long"


# --- words of texts ---------------------------------------------------------------------------

class Slice:
    """The words of some bytes: distinct words, the number of each word among them, and its piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = wh.LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        first[edges] = inside[edges]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[edges - 1] = inside[edges - 1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.pieces = np.cumsum(kind == 2, dtype=np.int64)[starts] + np.searchsorted(offsets, starts, "right")
        cuts = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        letters = np.ascontiguousarray(data[inside])
        words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(cuts), pa.py_buffer(letters)])
        encoded = words.dictionary_encode()
        self.words = encoded.dictionary
        self.codes = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(bytes, offsets, whether they go on where the last ones ended). Long texts are cut between words."""
    for _, _, data, offsets in wh.text_slices(texts, most):
        if len(data) <= 2 * most:
            yield data, offsets, False
            continue
        at = 0
        while at < len(data):
            end = at + most
            while end < len(data):
                gap = np.flatnonzero(_KIND[data[end : end + most]])
                if len(gap):
                    end += int(gap[0])
                    break
                end += most
            end = min(end, len(data))
            yield data[at:end], np.array([0, end - at]), at > 0
            at = end


def word_hashes(words: pa.Array) -> np.ndarray:
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = words.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return wh.words(data[offsets[0] : offsets[-1]], offsets - offsets[0], _NO_SEPARATOR)[2]


def _language_hash(lang: str) -> np.uint64:
    return word_hashes(pa.array([f"_{lang}"]))[0]


def _pair(left: np.ndarray, right: np.ndarray | np.uint64) -> np.ndarray:
    return wh.mix(left * _ODD + right)


class Bitmap:
    """Which keys may be among those it was made from."""

    def __init__(self, data: np.ndarray):
        self.data = data

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        slots = hashes & np.uint64(8 * len(self.data) - 1)
        return (self.data[slots >> np.uint64(3)] >> (slots & np.uint64(7)).astype(np.uint8)) & 1 == 1


def bitmap(phrases: DataFrame, most_bits: int = MOST_BITS) -> Bitmap:
    """Of the one- or two-word phrases of (lang, phrase); 16 bits a phrase, a power of two, at most ``most_bits``."""
    rows = phrases.count()
    bits = min(max(1 << 16, 1 << (16 * rows).bit_length()), most_bits)

    def slots(batches):
        for batch in batches:
            key = word_hashes(batch.column(1))
            two = np.flatnonzero(np.asarray(pc.not_equal(batch.column(2), "")))
            key[two] = _pair(key[two], word_hashes(batch.column(2).filter(pc.not_equal(batch.column(2), ""))))
            langs = batch.column(0).dictionary_encode()
            known = np.array([_language_hash(lang) for lang in langs.dictionary.to_pylist()], np.uint64)
            key = _pair(key, known[langs.indices.to_numpy(zero_copy_only=False)])
            yield pa.RecordBatch.from_arrays([pa.array((key & np.uint64(bits - 1)).astype(np.int64) + 1)], names=["slot"])

    first, second = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    split = phrases.select("lang", first.alias("first"), F.when(F.contains("phrase", F.lit(" ")), second).otherwise("").alias("second"))
    # Spark numbers the bits of a bucket from 1.
    found = split.mapInArrow(slots, "slot long").groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")
    )
    data = np.zeros(bits // 8, np.uint8)
    for row in found.toLocalIterator():  # at most bits / 32768 rows of 4 KB
        start = (row.bucket - 1) * 4096
        data[start : start + 4096] = np.frombuffer(row.bits, np.uint8)[: len(data) - start]
    return Bitmap(data)


# --- counting ---------------------------------------------------------------------------------

class Counter:
    """One task's counts of phrases of ``order`` words."""

    def __init__(self, order: int, frequent: Bitmap | None, trie_keys: int = TRIE_KEYS, task_words: int = TASK_WORDS):
        self.order, self.frequent, self.trie_keys, self.task_words = order, frequent, trie_keys, task_words
        self.trie = HatTrie()
        self.ids: dict[tuple[str, bytes], int] = {}
        self.hashes: dict[str, np.uint64] = {}
        self.carry: list[bytes] = []

    def count(self, lang: str, data: np.ndarray, offsets: np.ndarray, goes_on: bool) -> None:
        found = Slice(data, offsets)
        words, codes, pieces = found.words, found.codes, found.pieces
        carried = self.carry if goes_on else []
        if carried:  # the last words before a cut between words; a phrase has at least one word after the cut
            words = pa.concat_arrays([words, pa.array(carried, pa.large_binary())])
            codes = np.concatenate([np.arange(len(words) - len(carried), len(words)), codes])
            pieces = np.concatenate([np.full(len(carried), 1), pieces])
        last = len(data) == 0 or _KIND[data[-1]] != 2
        self.carry = []
        if last and self.order > 1 and len(codes):
            tail = codes[pieces == 1 + np.count_nonzero(_KIND[data] == 2)][-(self.order - 1) :] if len(offsets) == 2 else []
            self.carry = [words[int(code)].as_py() for code in tail]
        inside = np.ones(max(len(codes) - self.order + 1, 0), bool)
        for step in range(1, self.order):
            inside &= pieces[step : step + len(inside)] == pieces[: len(inside)]
        if self.frequent is not None:
            inside &= self._possible(lang, words, codes, len(inside))
        starts = np.flatnonzero(inside)
        columns = [codes[starts + step] for step in range(self.order)]
        used = np.unique(np.concatenate(columns)) if len(starts) else np.zeros(0, np.int64)
        ids = np.zeros(len(words), np.int64)
        ids[used] = [self.ids.setdefault((lang, word), len(self.ids) + 1) for word in words.take(pa.array(used)).to_pylist()]
        if len(starts):
            self.trie.add(pack([ids[column] for column in columns]))

    def _possible(self, lang: str, words: pa.Array, codes: np.ndarray, n: int) -> np.ndarray:
        """Whether the parts of one word (of two, for phrases of three) are frequent, for the first n positions."""
        if not n:
            return np.zeros(0, bool)
        if lang not in self.hashes:
            self.hashes[lang] = _language_hash(lang)
        hashes = word_hashes(words)
        if self.order == 2:
            known = self.frequent.holds(_pair(hashes, self.hashes[lang]))[codes]
        else:
            known = self.frequent.holds(_pair(_pair(hashes[codes[:-1]], hashes[codes[1:]]), self.hashes[lang]))
        return known[:n] & known[1 : n + 1]

    def full(self) -> Iterator[pa.RecordBatch]:
        """Runs that leave now, because a limit is passed."""
        if len(self.ids) > self.task_words:
            yield from self.rest()
        elif len(self.trie) > self.trie_keys:
            yield from self._rows(self.trie.spill(self.trie_keys // 2))

    def rest(self) -> Iterator[pa.RecordBatch]:
        yield from self._rows(self.trie.spill())
        self.ids = {}

    def _rows(self, runs) -> Iterator[pa.RecordBatch]:
        langs, words = None, None
        for keys, counts in runs:
            if langs is None:
                langs = pa.array([None, *(lang for lang, _ in self.ids)], pa.string()).dictionary_encode()
                words = pa.array([b"", *(word for _, word in self.ids)], pa.large_binary())
            for at in range(0, len(keys), RUN_ROWS):
                some = keys[at : at + RUN_ROWS]
                ids = [pa.array(word_of(some, position)) for position in range(self.order)]
                parts = [words.take(column) for column in ids]
                phrase = pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if len(parts) > 1 else parts[0]
                yield pa.RecordBatch.from_arrays(
                    [langs.take(ids[0]).cast(pa.string()), phrase.view(pa.large_string()).cast(pa.string()), pa.array(counts[at : at + RUN_ROWS])],
                    names=["lang", "phrase", "n"],
                )


def runs(texts: DataFrame, order: int, frequent: Bitmap | None = None, trie_keys: int = TRIE_KEYS, task_words: int = TASK_WORDS) -> DataFrame:
    """(lang, phrase, n): the spilled runs of all tasks over (lang, text); a phrase may be in many."""

    def count(batches):
        counter = Counter(order, frequent, trie_keys, task_words)
        for batch in batches:
            for lang in pc.unique(batch.column(0)).to_pylist():
                for part in slices(batch.column(1).filter(pc.equal(batch.column(0), lang))):
                    counter.count(lang, *part)
                    yield from counter.full()
        yield from counter.rest()

    return map_arrow(texts, count, _RUN)


def merged(counts: DataFrame) -> DataFrame:
    """(lang, phrase, f): runs merged per range of prefixes."""
    return counts.repartitionByRange("lang", "phrase").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


def frequencies(docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text", lang_col: str = "lang") -> dict[int | str, DataFrame]:
    """Phrases of 1, 2 and 3 words that occur ``min_count`` times in their language, and the words of each language."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = stage(runs(texts, 1), "phrase-runs-1")
    found = {"totals": stage(words.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")}
    counts = words
    for order in (1, 2, 3):
        if order > 1:
            counts = stage(runs(texts, order, bitmap(found[order - 1])), f"phrase-runs-{order}")
        found[order] = stage(merged(counts).where(F.col("f") >= min_count), f"phrases-{order}")
    return found


# --- scores -----------------------------------------------------------------------------------

def _with_count(rows: DataFrame, part: Column, counts: DataFrame, name: str) -> DataFrame:
    known = counts.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__part"), F.col("f").alias(name))
    return rows.withColumn("__of", part).join(known, (F.col("lang") == F.col("__lang")) & (F.col("__of") == F.col("__part"))).drop("__lang", "__part", "__of")


def _score(left: str, right: str) -> Column:
    return F.expr(f"(1000000BD * cast(a as decimal(19,0)) * cast(a as decimal(19,0))) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def scored(counts: dict[int | str, DataFrame], contained_percent: int = CONTAINED_PERCENT) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one contains too often."""
    head, tail = F.substring_index("phrase", " ", 1), F.substring_index("phrase", " ", -1)
    first_two, last_two = F.substring_index("phrase", " ", 2), F.substring_index("phrase", " ", -2)
    inside = counts[3].select("lang", F.explode(F.array(first_two, last_two)).alias("part"), "f")
    inside = inside.groupBy("lang", "part").agg(F.max("f").alias("longer")).withColumnRenamed("lang", "i_lang")
    pairs = counts[2].select("lang", "phrase", F.col("f").alias("a"))
    pairs = pairs.join(inside, (F.col("lang") == F.col("i_lang")) & (F.col("phrase") == F.col("part")), "left")
    pairs = pairs.where(F.coalesce(100 * F.col("longer") < contained_percent * F.col("a"), F.lit(True))).drop("i_lang", "part", "longer")
    pairs = _with_count(_with_count(pairs, head, counts[1], "l"), tail, counts[1], "r").withColumn("score", _score("l", "r"))
    triples = counts[3].select("lang", "phrase", F.col("f").alias("a"))
    for part, known, name in ((head, 1, "l1"), (last_two, 2, "r1"), (first_two, 2, "l2"), (tail, 1, "r2")):
        triples = _with_count(triples, part, counts[known], name)
    triples = triples.withColumns({"s1": _score("l1", "r1"), "s2": _score("l2", "r2")})
    late = F.col("s2") < F.col("s1")
    triples = triples.select(
        "lang", "phrase", "a", F.when(late, F.col("l2")).otherwise(F.col("l1")).alias("l"), F.when(late, F.col("r2")).otherwise(F.col("r1")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    return pairs.unionByName(triples)


def collocations(
    docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, contained_percent: int = CONTAINED_PERCENT, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language.

    The rank runs in two steps, among ``SHARES`` shares of a language and then among their best, so the last
    task of a language reads ``SHARES * top`` rows at most.
    """
    counts = frequencies(docs, min_count, text_col, lang_col)
    found = stage(scored(counts, contained_percent), "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    best = lambda rows, *by: rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= top)
    shares = best(found.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES))), "lang", "share").drop("share", "rank")
    totals = counts["totals"].withColumnRenamed("lang", "t_lang")
    ranked = best(shares, "lang").join(totals, F.col("lang") == F.col("t_lang"))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (
  SELECT lang, [x for x in regexp_split_to_array(piece, '[\x20\x09]+') if x <> ''] AS ws FROM pieces
), f AS (
  SELECT lang, len, phrase, count(*) AS f FROM (
    SELECT lang, 1 AS len, unnest(ws) AS phrase FROM w
    UNION ALL SELECT lang, 2, unnest([ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))]) FROM w
    UNION ALL SELECT lang, 3, unnest([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) FROM w
  ) GROUP BY ALL
), totals AS (
  SELECT lang, cast(sum(f) AS bigint) AS n FROM f WHERE len = 1 GROUP BY lang
), c AS (
  SELECT lang, len, phrase, f AS a, string_split(phrase, ' ') AS ws FROM f WHERE len > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.len, c.phrase, c.a, k, x.f AS l, y.f AS r,
         (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) AS score
  FROM c, (VALUES (1), (2)) AS cut(k), f AS x, f AS y
  WHERE k < c.len AND x.lang = c.lang AND y.lang = c.lang
    AND x.phrase = array_to_string(ws[1:k], ' ') AND y.phrase = array_to_string(ws[k + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, ws[1] || ' ' || ws[2] AS part, a FROM c WHERE len = 3
    UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM c WHERE len = 3
  ) GROUP BY ALL
), kept AS (
  SELECT lowest.* FROM lowest LEFT JOIN inside ON lowest.lang = inside.lang AND lowest.phrase = inside.part
  WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, cast(score AS bigint) AS score
FROM kept JOIN totals ON kept.lang = totals.lang
QUALIFY rank <= 2000
"""
