"""Quality by compression: zstandard dictionaries of good and of bad text.

Two dictionaries are trained on labelled text, one per class. A text is cut into chunks of ``CHUNK``
bytes; every chunk of the whole text is compressed with either dictionary, and the difference of the total
sizes over their sum says which class the text resembles. Logistic regression on other labelled texts
turns the difference into a probability. Chunks keep the dictionary useful to the end of long texts.

Fitting uses at most ``PER_CLASS`` labelled documents a class: even ranks of the sample make the
dictionaries (at most ``DICTIONARY_TEXT`` bytes of chunks spread over them), odd ranks the calibration,
where classes are weighted by their true counts.

Defined results: null and empty texts have difference 0. Labels whose id is in no document do not count. Without
labels of both classes every score is the share of good labels (0.5 without labels). Repeated rows are scored each; other columns are ignored.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.samples import bounded_sample, held_out, label_classes
from skyledger.llm.tables import map_arrow, stage, table

PER_CLASS = 2000
CHUNK = 1024
DICTIONARY = 48 << 10
DICTIONARY_TEXT = 6 << 20
LEVEL = 3
THRESHOLD = 0.7
_HELD: dict[tuple[bytes, bytes], list] = {}


def chunks(text: bytes) -> list[bytes]:
    return [text[i : i + CHUNK] for i in range(0, len(text), CHUNK)]


def build_dictionary(texts: list[bytes]) -> bytes:
    """A zstandard dictionary, or raw content where there is too little text to train one."""
    import zstandard

    pieces = [c for t in texts for c in chunks(t)]
    step = max(1, -(-sum(map(len, pieces)) // DICTIONARY_TEXT))
    pieces = pieces[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:
        return b"".join(pieces)[:DICTIONARY]


def differences(texts: list[bytes], good: bytes, bad: bytes) -> np.ndarray:
    """(bad size - good size) / (bad size + good size) of each text, from -1 to 1; above 0 resembles good text."""
    import zstandard

    if (good, bad) not in _HELD:
        _HELD.clear()
        made = []
        for content in (good, bad):
            d = zstandard.ZstdCompressionDict(content)
            d.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        _HELD[good, bad] = made
    like_good, like_bad = _HELD[good, bad]
    out = np.zeros(len(texts))
    for i, text in enumerate(texts):
        a = b = 0
        for c in chunks(text):
            a += len(like_good.compress(c))
            b += len(like_bad.compress(c))
        out[i] = (b - a) / (a + b) if text else 0.0
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, weights: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept of the probability of y, by Newton's method on scaled x."""
    spread = float(x.std()) or 1.0
    z, w = np.stack([x / spread, np.ones_like(x)]), np.zeros(2)
    weights = weights / weights.sum()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(w @ z, -30, 30)))
        slope = z @ (weights * (p - y)) + ridge * np.array([w[0], 0.0])
        curve = (z * (weights * np.maximum(p * (1 - p), 1e-9))) @ z.T + ridge * np.eye(2)
        w = w - np.clip(np.linalg.solve(curve, slope), -3, 3)
    return float(w[0] / spread), float(w[1])


def learn(sample: DataFrame, counts: dict[str, int]) -> dict:
    """Dictionaries and calibration from a sample (cls, rank, text) and the true class counts."""
    if not (counts.get("0") and counts.get("1")):
        share = counts.get("1", 0) / max(1, sum(counts.values())) if counts else 0.5
        return {"constant": share}

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        texts = [t.encode() for t in rows.sort_values("rank")["text"].fillna("")]
        return pd.DataFrame({"cls": [rows["cls"].iloc[0]], "content": [build_dictionary(texts)]})

    even = sample.where("rank % 2 = 0 or rank = 1")
    made = {r.cls: bytes(r.content) for r in even.groupBy("cls").applyInPandas(build, "cls string, content binary").collect()}
    good, bad = made["1"], made["0"]

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(differences([(t or "").encode() for t in batch.column(1).to_pylist()], good, bad))],
                names=["cls", "difference"],
            )

    odd = sample.where("rank % 2 = 1").select("cls", "text")
    found = map_arrow(odd, measure, "cls string, difference double").toPandas()
    y = (found["cls"] == "1").to_numpy()
    seen = {c: max(1, int((found["cls"] == c).sum())) for c in ("0", "1")}
    weights = np.where(y, counts["1"] / seen["1"], counts["0"] / seen["0"])
    slope, intercept = fit_logistic(found["difference"].to_numpy(), y.astype(float), weights)
    return {"good": good, "bad": bad, "slope": slope, "intercept": intercept}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if "constant" in model:
        return rows.select("doc_id", F.lit(float(model["constant"])).alias("score"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def measure(batches):
        for batch in batches:
            found = differences([t.encode() for t in batch.column(1).to_pylist()], model["good"], model["bad"])
            margin = np.clip(model["slope"] * found + model["intercept"], -30, 30)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-margin)))], names=schema.names)

    return map_arrow(rows, measure, schema)


def labelled(docs: DataFrame, classes: DataFrame, per_class: int) -> tuple[DataFrame, dict[str, int]]:
    """Sample and class counts of the labels whose document is there to learn from."""
    ids = docs.select(F.col("doc_id").alias("d_id")).where("d_id is not null").distinct()
    classes = stage(classes.join(ids, F.col("doc_id") == F.col("d_id"), "left_semi"), "label-classes")
    counts = {str(r.cls): r["count"] for r in classes.groupBy("cls").count().where("cls in (0, 1)").collect()}
    return bounded_sample(docs.select("doc_id", "text"), classes.where("cls in (0, 1)"), per_class), counts


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classes = label_classes(table(spark, sf_dir, "labels"), "quality", ~held_out(4, 2))
    scored = score(docs, learn(*labelled(docs, classes, PER_CLASS)))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
