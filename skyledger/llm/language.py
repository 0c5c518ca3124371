"""Language identification by hierarchical discrimination.

A document is described by the square roots of its relative frequencies of hashed byte n-grams of one to
four letters of its whole text. One-versus-rest linear SVMs choose the language family; then, within the
family, one linear SVM for every two languages separates the closely related ones: each votes for one of its
two, the most votes win, and the coupled probability decides between equals (then the first by name). The SVMs
(squared hinge loss) are fitted in numpy, one Spark task for the families and one for every two languages of a
family. Features see letters only; language, source and id are never inputs.

Samples are bounded: ``PER_LANGUAGE`` documents a language, so a task for two languages holds twice as many
vectors of ``4 * DIMS`` bytes (they are sent without their zeros); the families' task gets ``FAMILY_ROWS`` in all, the same number of each language
(one at least).

The score is the probability of the family, from its margins by a softmax, times that of the language within
it, coupled from those of its pairs. Documents without a letter, or a null text, are ``und`` with score 0; so
is every document when there is nothing to learn from (an empty table, or no row with a language). Very long
texts are read whole, in slices. Rows that repeat are judged each; other columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm import wordhash as wh
from skyledger.llm.samples import bounded_sample, held_out
from skyledger.llm.tables import map_arrow, table

PER_LANGUAGE = 800
FAMILY_ROWS = 8000
DIMS = 4096
ORDERS = (1, 2, 3, 4)
SHARPNESS = 4.0
UNKNOWN = "und"
# Families of languages by ISO 639-1 code. Any other language is a family of its own.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "is", "af"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl"],
    "slavic": ["ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
}
_LETTER = ~wh.NOT_ALNUM
_LETTER[ord("0") : ord("9") + 1] = False


def family(language: str) -> str:
    return next((name for name, members in FAMILIES.items() if language in members), language)


def features(texts: pa.Array):
    """(first row, matrix) of consecutive rows: one row of DIMS square roots of shares each."""
    for first, last, data, offsets in wh.text_slices(pc.utf8_lower(texts.fill_null("")), 1 << 19):
        for a in range(first, last, 256):
            b = min(a + 256, last)
            yield a, _matrix(data[offsets[a - first] : offsets[b - first]], offsets[a - first : b - first + 1] - offsets[a - first])


def _matrix(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int64) * DIMS, np.diff(offsets))
    letters = _LETTER[data]
    code = np.where(letters, wh.LOWER[data], 32).astype(np.uint32)
    counts = np.zeros((len(offsets) - 1) * DIMS, np.float32)
    rolling = np.zeros(len(data), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        if len(data) < n:
            break
        rolling = (rolling[: len(data) - n + 1] * np.uint32(0x01000193)) ^ code[n - 1 :]
        if n not in ORDERS:
            continue
        hashed = (rolling * np.uint32(0x9E3779B1) + np.uint32(n * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(20)
        inside = (rows[: len(rolling)] == rows[n - 1 :]) & (letters[: len(rolling)] | letters[n - 1 :])
        counts += np.bincount(rows[: len(rolling)][inside] + hashed[inside], minlength=len(counts))
    matrix = counts.reshape(-1, DIMS)
    return np.sqrt(matrix / np.maximum(matrix.sum(axis=1, keepdims=True), 1))


def fit_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 250) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear SVM with squared hinge loss, classes weighted alike; accelerated gradient."""
    return _fit(np.hstack([x, np.ones((len(x), 1), np.float32)]), y, penalty, steps)


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 250) -> tuple[np.ndarray, float]:
    """``fit_svm`` of vectors that end in a one."""
    sign = np.where(y, 1.0, -1.0).astype(np.float32)
    share = np.where(y, 0.5 / max(1, y.sum()), 0.5 / max(1, (~y).sum())).astype(np.float32)
    step, w = 1 / (4.0 + penalty), np.zeros(x.shape[1], np.float32)
    ahead, t = w.copy(), 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - sign * (x @ ahead))
        new = ahead - step * (penalty * ahead - 2 * ((share * sign * slack) @ x))
        grown = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead, w, t = new + (t - 1) / grown * (new - w), new, grown
    return w[:-1], float(w[-1])


def _packed(vector: np.ndarray) -> bytes:
    """Which values of a vector are not zero, a bit each, and these values."""
    there = vector != 0
    return np.packbits(there).tobytes() + vector[there].astype(np.float32).tobytes()


def _with_ones(packed) -> np.ndarray:
    """A row for each packed vector, with a one at its end; no other copy of all vectors is made."""
    x = np.zeros((len(packed), DIMS + 1), np.float32)
    x[:, -1] = 1
    for row, data in zip(x, packed):
        there = np.unpackbits(np.frombuffer(data, np.uint8, DIMS // 8)).view(bool)
        row[:-1][there] = np.frombuffer(data, np.float32, offset=DIMS // 8)
    return x


def train(sample: DataFrame, family_rows: int = FAMILY_ROWS) -> dict[str, tuple[list[str], np.ndarray, np.ndarray]]:
    """Models by name (``families`` and one per family): classes, weight matrix and biases.

    The families have a column for every class, a family one for every two of its languages in the order of
    ``_pairs``; a positive margin speaks for the first of the two. ``sample`` holds cls, rank and text.
    """
    languages = sorted(r.cls for r in sample.select("cls").distinct().collect())
    if not languages:
        return {}
    members = {}
    for language in languages:
        members.setdefault(family(language), []).append(language)
    shared = max(1, family_rows // len(languages))

    def describe(batches):
        for batch in batches:
            named = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for first, matrix in features(batch.column(2)):
                rows = []
                for (language, rank), vector in zip(named[first : first + len(matrix)], matrix):
                    own, data = family(language), _packed(vector)
                    if rank <= shared:
                        rows.append(("families", "", language, rank, data))
                    for other in members[own]:
                        if other != language:
                            rows.append((own, " ".join(sorted((language, other))), language, rank, data))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["model", "pair", "cls", "rank", "vector"])

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["cls", "rank"])
        x = _with_ones(rows["vector"])
        name, pair = rows["model"].iloc[0], rows["pair"].iloc[0]
        classes = rows["cls"] if pair else rows["cls"].map(family)
        names = [min(classes)] if pair else sorted(set(classes))
        fitted = [_fit(x, (classes == c).to_numpy()) for c in names]
        return pd.DataFrame({
            "model": name, "column": [pair or c for c in names],
            "weights": [w.astype(np.float32).tobytes() for w, _ in fitted], "bias": [b for _, b in fitted],
        })

    described = map_arrow(
        sample.select("cls", F.col("rank").cast("long").alias("rank"), "text"), describe,
        "model string, pair string, cls string, rank bigint, vector binary",
    )
    fitted = described.groupBy("model", "pair").applyInPandas(fit, "model string, column string, weights binary, bias double")
    found = {(r.model, r.column): r for r in fitted.collect()}

    def columns(model, names):
        weights = [np.frombuffer(found[model, name].weights, np.float32) for name in names]
        return np.array(weights, np.float32).reshape(len(names), DIMS).T, np.array([found[model, name].bias for name in names])

    models = {f"family {name}": (own, *columns(name, [f"{own[i]} {own[j]}" for i, j in _pairs(len(own))])) for name, own in members.items()}
    models["families"] = (sorted(members), *columns("families", sorted(members)))
    return models


def _pairs(n: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(n) for j in range(i + 1, n)]


def _family_shares(model, matrix: np.ndarray) -> np.ndarray:
    _, weights, bias = model
    margins = SHARPNESS * (matrix @ weights + bias)
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _vote(model, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and coupled probability of the language that most of its pairs prefer.

    With p(i, j) the logistic of a pair's doubled margin, a language's share is 1 / (sum over j of 1 / p(i, j)
    - (n - 2)), made to add up to one: exact where the pairs agree with one distribution.
    """
    names, weights, bias = model
    n = len(names)
    votes, inverse = np.zeros((len(matrix), n)), np.full((len(matrix), n), 2.0 - n)
    margins = matrix @ weights + bias
    for k, (i, j) in enumerate(_pairs(n)):
        odds = np.exp(np.clip(-2 * SHARPNESS * margins[:, k], -300, 300))
        votes[:, i] += margins[:, k] >= 0
        votes[:, j] += margins[:, k] < 0
        inverse[:, i] += 1 + odds
        inverse[:, j] += 1 + 1 / odds
    shares = 1 / inverse
    shares /= shares.sum(axis=1, keepdims=True)
    most = np.where(votes == votes.max(axis=1, keepdims=True), shares, -1.0).argmax(axis=1)
    return most, shares[np.arange(len(matrix)), most]


def judge(models, matrix: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each row: the best family, then the language within it that most pairs prefer."""
    families = models["families"][0]
    shares = _family_shares(models["families"], matrix)
    best = shares.argmax(axis=1)
    names, scores = np.empty(len(matrix), object), shares[np.arange(len(matrix)), best]
    for k, name in enumerate(families):
        rows = np.flatnonzero(best == k)
        if len(rows):
            model = models[f"family {name}"]
            chosen, share = _vote(model, matrix[rows])
            names[rows] = np.array(model[0], object)[chosen]
            scores[rows] *= share
    return list(names), scores


def identify(docs: DataFrame, models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every document."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.when(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)), F.col(text_col)).alias("text"),
    )
    schema = T.StructType([rows.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def predict(batches):
        for batch in batches:
            texts = batch.column(1)
            names, scores = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
            if models:
                for first, matrix in features(texts):
                    end = first + len(matrix)
                    names[first:end], scores[first:end] = judge(models, matrix)
            missing = np.array(texts.is_null())
            names[missing], scores[missing] = UNKNOWN, 0.0
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1).astype(float))], names=schema.names
            )

    return map_arrow(rows, predict, schema)


def keep_identified(docs: DataFrame, models, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language can not be told (``und``)."""
    place = docs.columns.index(text_col)
    marked = docs.withColumn("__letter", F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))

    def keep(batches):
        for batch in batches:
            names = np.full(batch.num_rows, UNKNOWN, object)
            if models:
                for first, matrix in features(batch.column(place)):
                    names[first : first + len(matrix)] = judge(models, matrix)[0]
            sure = pa.array(names != UNKNOWN, pa.bool_()) if models else pa.array(np.ones(batch.num_rows, bool))
            letters = batch.column(batch.num_columns - 1)
            yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pc.and_(sure, letters))

    return map_arrow(marked, keep, docs.schema)


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE):
    """Models from documents that are not held out and have a language and a letter."""
    known = docs.where(~held_out(4, 2) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    return train(bounded_sample(docs.select("doc_id", "text"), known.select("doc_id", F.col("lang").alias("cls")), per_language))


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs)).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")
