"""Toxicity from subword bags: averaged n-gram embeddings into a linear softmax, trained jointly in numpy.

A word's vector is the mean of the vectors of its hashed byte n-grams (3 to 6 bytes, with word marks) and
of itself, so a misspelling never seen shares most of its vector with the word it hides. A window of
``WINDOW`` words has the mean of its words' vectors; a linear softmax turns it into two classes.
Embeddings and softmax are trained together by Adam. Labels belong to documents, so training alternates:
the highest windows of a toxic document and the highest and some other windows of a clean one are the
examples of the next round. A document's score is its highest window, calibrated on every fourth document of the sample,
which the embeddings do not learn from;
long clean text around a toxic passage does not thin it out.

Both layers are linear, so a trained model is one number per n-gram bucket: scoring costs a lookup
per n-gram of each distinct word of a slice of texts, and a running mean.

Fitting uses at most ``PER_CLASS`` documents a class, in one Spark task. Words are runs of letters and
digits in lower case. Defined results: null texts and texts without words have the score of a window
without evidence. Labels whose id is in no document do not count. Without labels of both classes every score is the share of toxic labels (0 without labels).
Repeated rows are scored each; other columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import wordhash as wh
from skyledger.llm.quality import fit_logistic, labelled
from skyledger.llm.samples import held_out, label_classes
from skyledger.llm.tables import map_arrow, table

PER_CLASS = 2500
BUCKETS = 1 << 17
DIMS = 8
GRAMS = (3, 4, 5, 6)
WINDOW = 4
ROUNDS = 4
STEPS = 40
RATE = 0.05
DAMPING = 0.3
CALIBRATION = 4
SEED = 7
THRESHOLD = 0.5


def word_grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket numbers of all n-grams of the words, and where each word's begin (one more at the end)."""
    lengths = ends - starts
    marked = lengths + 2
    begins = np.concatenate([[0], np.cumsum(marked)])
    code = np.zeros(begins[-1], np.uint64)
    word = np.repeat(np.arange(len(starts)), marked)
    inside = np.arange(begins[-1]) - begins[word]
    letter = (inside > 0) & (inside <= lengths[word])
    code[letter] = data[(starts[word] + inside - 1)[letter]]
    code[inside == 0] = 1
    code[inside == lengths[word] + 1] = 2
    grams, owners = [], []
    rolling = np.zeros(len(code), np.uint64)
    for n in range(1, max(GRAMS) + 1):
        if len(code) < n:
            break
        rolling = wh.mix(rolling[: len(code) - n + 1]) + code[n - 1 :]
        if n in GRAMS:
            keep = word[: len(rolling)] == word[n - 1 :]
            grams.append(wh.mix(rolling[keep] + np.uint64(n << 32)))
            owners.append(word[: len(rolling)][keep])
    sums = np.concatenate([[np.uint64(0)], np.cumsum(wh.mix(code + (inside.astype(np.uint64) << np.uint64(8))))])
    grams.append(wh.mix(sums[begins[1:]] - sums[begins[:-1]]))
    owners.append(np.arange(len(starts)))
    grams, owners = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return (grams[order] % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([[0], np.cumsum(np.bincount(owners, minlength=len(starts)))])


def distinct_words(texts: pa.Array):
    """(first row, data, starts, ends of distinct words, their number per word of the slice, text bounds)."""
    for first, _, data, offsets in wh.text_slices(pc.utf8_lower(texts.fill_null(""))):
        starts, ends, hashes, bounds = wh.words(data, offsets, wh.NOT_ALNUM, lower=True)
        _, at, number = np.unique(hashes, return_index=True, return_inverse=True)
        yield first, wh.LOWER[data], starts[at], ends[at], number.reshape(-1), bounds


def window_means(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Means of the windows of each text: (mean, text, first word). A short text is one window, as if
    filled up to half a window with words of no evidence."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    counts = np.diff(bounds)
    number = np.maximum(counts - WINDOW + 1, np.minimum(counts, 1))
    text = np.repeat(np.arange(len(counts)), number)
    first = bounds[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    last = np.minimum(first + WINDOW, bounds[1:][text])
    return (sums[last] - sums[first]) / np.maximum(last - first, WINDOW // 2), text, first


def highest(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The highest window of each text; 0, no evidence, for a text without words."""
    means, text, _ = window_means(values, bounds)
    out = np.zeros(len(bounds) - 1)
    if len(text):
        begin = np.flatnonzero(np.diff(text, prepend=-1))
        out[text[begin]] = np.maximum.reduceat(means, begin)
    return out


def word_values(grams: np.ndarray, begins: np.ndarray, table_: np.ndarray) -> np.ndarray:
    return np.add.reduceat(table_[grams], begins[:-1]) / np.diff(begins) if len(begins) > 1 else np.zeros(0)


def fit(texts: list[str], toxic: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, float, float]:
    """Evidence per bucket, and slope and intercept of the calibration."""
    column = pa.array(texts, pa.large_string())
    starts, ends, sequence, bounds, data, at, words = [], [], [], [np.zeros(1, np.int64)], [], 0, 0
    numbers: dict[int, int] = {}
    for _, bytes_, s, e, number, b in distinct_words(column):
        seen = [numbers.setdefault(bytes_[i:j].tobytes(), len(numbers)) for i, j in zip(s, e, strict=True)]
        for k, i, j in zip(seen, s.tolist(), e.tolist(), strict=True):
            if k == len(starts):
                starts.append(i + at)
                ends.append(j + at)
        sequence.append(np.array(seen, np.int64)[number] if len(number) else np.zeros(0, np.int64))
        bounds.append(b[1:] + words)
        data.append(bytes_)
        at += len(bytes_)
        words += len(number)
    sequence, bounds = np.concatenate(sequence), np.concatenate(bounds)
    grams, begins = word_grams(np.concatenate(data), np.array(starts), np.array(ends))
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 0.1, (BUCKETS, DIMS)).astype(np.float32)
    softmax = rng.normal(0, 0.1, (DIMS, 2)).astype(np.float32)
    _, doc, first = window_means(np.zeros(len(sequence)), bounds)
    if not len(doc):
        return np.zeros(BUCKETS), 1.0, 0.0
    begin = np.flatnonzero(np.diff(doc, prepend=-1))
    last = np.minimum(first + WINDOW, bounds[1:][doc])

    fitted = np.arange(len(toxic)) % CALIBRATION != 0  # the others calibrate
    if not (toxic[fitted].any() and (~toxic[fitted]).any() and toxic[~fitted].any() and (~toxic[~fitted]).any()):
        fitted = np.ones(len(toxic), bool)

    def some(per_doc: int) -> np.ndarray:
        draws = begin[:, None] + (rng.random((len(begin), per_doc)) * np.diff(np.append(begin, len(doc)))[:, None]).astype(int)
        return np.unique(draws)

    chosen = some(8)
    evidence = np.zeros(BUCKETS)
    for number in range(ROUNDS):
        if number:
            per_word = word_values(grams, begins, evidence)[sequence]
            means, _, _ = window_means(per_word, bounds)
            top = np.maximum.reduceat(means, begin)
            best = np.flatnonzero(means >= top[np.searchsorted(doc[begin], doc)] - 1e-12)
            other = some(4)
            chosen = np.union1d(best, other[~toxic[doc[other]]])
        chosen = chosen[fitted[doc[chosen]]]
        embed, softmax = train(embed, softmax, grams, begins, sequence, first[chosen], last[chosen], toxic[doc[chosen]])
        evidence = (embed @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64)
    top = highest(word_values(grams, begins, evidence)[sequence], bounds)
    rest = ~fitted if (~fitted).any() else fitted
    slope, intercept = fit_logistic(top[rest], toxic[rest].astype(float), weights[rest])
    return evidence, slope, intercept


def train(embed, softmax, grams, begins, sequence, first, last, toxic):
    """Adam on the cross-entropy of the windows, over embeddings and softmax at once; classes weigh alike."""
    sizes = last - first
    owner = np.repeat(np.arange(len(first)), sizes)
    refs = sequence[np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    used, refs = np.unique(refs, return_inverse=True)
    counts = np.diff(begins)[used]
    flat = grams[np.repeat(begins[used] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())]
    buckets, flat = np.unique(flat, return_inverse=True)
    word_of = np.repeat(np.arange(len(used)), counts)
    by_bucket, cuts = np.argsort(flat, kind="stable"), np.searchsorted(np.sort(flat), np.arange(len(buckets)))
    by_word, word_cuts = np.argsort(refs, kind="stable"), np.searchsorted(np.sort(refs), np.arange(len(used)))
    starts, window_starts = np.cumsum(counts) - counts, np.cumsum(sizes) - sizes
    filled = np.maximum(sizes, WINDOW // 2).astype(np.float32)
    target = np.stack([~toxic, toxic], axis=1).astype(np.float32)
    weight = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())).astype(np.float32)[:, None]
    own = embed[buckets]
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (own, softmax)]
    for t in range(1, STEPS + 1):
        vectors = np.add.reduceat(own[flat], starts) / counts[:, None].astype(np.float32)
        windows = np.add.reduceat(vectors[refs], window_starts) / filled[:, None]
        logits = windows @ softmax
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = weight * (p - target)
        to_windows = (slope @ softmax.T) / filled[:, None]
        to_words = np.add.reduceat(to_windows[owner[by_word]], word_cuts) / counts[:, None].astype(np.float32)
        to_own = np.add.reduceat(to_words[word_of[by_bucket]], cuts)
        for p_, g, (m, v) in zip((own, softmax), (to_own, windows.T @ slope), state, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            scale = np.sqrt(v / (1 - 0.99**t))
            # The share of the mean scale keeps n-grams seen a few times from moving as fast as frequent ones.
            p_ -= RATE * (m / (1 - 0.9**t)) / (scale + DAMPING * np.sqrt(np.square(scale).mean()) + 1e-12)
    embed[buckets] = own
    return embed, softmax


def learn(sample: DataFrame, counts: dict[str, int]) -> dict:
    if not (counts.get("0") and counts.get("1")):
        return {"constant": counts.get("1", 0) / max(1, sum(counts.values()))}

    def task(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["cls", "rank"])
        toxic = (rows["cls"] == "1").to_numpy()
        weights = np.where(toxic, counts["1"] / toxic.sum(), counts["0"] / max(1, (~toxic).sum()))
        evidence, slope, intercept = fit(list(rows["text"].fillna("")), toxic, weights)
        return pd.DataFrame({"evidence": [evidence.astype(np.float32).tobytes()], "slope": [slope], "intercept": [intercept]})

    found = sample.withColumn("model", F.lit(1)).groupBy("model").applyInPandas(task, "evidence binary, slope double, intercept double").first()
    return {"evidence": bytes(found.evidence), "slope": found.slope, "intercept": found.intercept}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    if "constant" in model:
        return rows.select("doc_id", F.lit(float(model["constant"])).alias("score"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches):
        model = shared.value
        evidence = np.frombuffer(model["evidence"], np.float32).astype(np.float64)
        for batch in batches:
            top = np.zeros(batch.num_rows)
            for first, data, starts, ends, number, bounds in distinct_words(batch.column(1)):
                values = word_values(*word_grams(data, starts, ends), evidence)
                top[first : first + len(bounds) - 1] = highest(values[number], bounds)
            margin = np.clip(model["slope"] * top + model["intercept"], -30, 30)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-margin)))], names=schema.names)

    return map_arrow(rows, measure, schema)


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classes = label_classes(table(spark, sf_dir, "labels"), "toxic", ~held_out(5, 0))
    scored = score(docs, learn(*labelled(docs, classes, PER_CLASS)))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
