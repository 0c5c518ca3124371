"""Language by family, then by votes of one model for every two languages, against loops over letters and pairs."""

import math

import numpy as np
import pytest

from skyledger.llm import language

LETTERS = {"es": "abcdefg", "fr": "abcdxyz", "it": "abefxyw", "de": "hijklmn", "ja": "語日本文字章"}
ODD = [(90, "ABC abd é", "es", 1), (91, "abcd" * 9000, "es", 1), (92, "", "es", 1), (93, None, "es", 1), (94, "12 34", "fr", 2), (None, "abdc", "fr", 2)]


@pytest.fixture(scope="module")
def sample(spark):
    rng = np.random.default_rng(5)
    rows = []
    for name, letters in LETTERS.items():
        for rank in range(1, 26):
            rows.append((len(rows), " ".join("".join(rng.choice(list(letters), 5)) for _ in range(40)), name, rank))
    return spark.createDataFrame(rows + ODD, "doc_id long, text string, cls string, rank int")


def vector(text):
    """Square roots of the shares of hashed byte n-grams, one byte after another."""
    data = [32 if b < 128 and not chr(b).isalpha() else b for b in text.lower().encode()]
    counts = np.zeros(language.DIMS)
    for n in range(1, 5):
        for at in range(len(data) - n + 1):
            if data[at] == 32 and data[at + n - 1] == 32:
                continue
            rolling = 0
            for b in data[at : at + n]:
                rolling = (rolling * 0x01000193 ^ b) % 2**32
            counts[((rolling * 0x9E3779B1 + n * 0x85EBCA6B) % 2**32) >> 20] += 1
    return np.sqrt(counts / max(1, counts.sum()))


def expected(models, text):
    x = vector(text)
    names, weights, bias = models["families"]
    margins = [language.SHARPNESS * (x @ weights[:, k] + bias[k]) for k in range(len(names))]
    whole = sum(math.exp(m) for m in margins)
    best = max(range(len(names)), key=lambda k: margins[k])
    own, weights, bias = models[f"family {names[best]}"]
    votes, inverse, at = [0] * len(own), [2 - len(own)] * len(own), 0
    for i in range(len(own)):
        for j in range(i + 1, len(own)):
            margin, at = x @ weights[:, at] + bias[at], at + 1
            votes[i if margin >= 0 else j] += 1
            first = 1 / (1 + math.exp(-2 * language.SHARPNESS * margin))
            inverse[i] += 1 / first
            inverse[j] += 1 / (1 - first)
    shares = [1 / v / sum(1 / u for u in inverse) for v in inverse]
    winner = max(range(len(own)), key=lambda i: (votes[i], shares[i], -i))
    return own[winner], math.exp(margins[best]) / whole * shares[winner]


def test_one_model_for_every_two_languages(spark, sample):
    models = language.train(sample)
    assert models["families"][0] == ["germanic", "ja", "romance"]
    names, weights, bias = models["family romance"]
    assert names == ["es", "fr", "it"] and weights.shape == (language.DIMS, 3) and bias.shape == (3,)
    assert models["family ja"][1].shape == (language.DIMS, 0)
    texts = {r.doc_id: r.text for r in sample.collect()}
    got = {r.doc_id: r for r in language.identify(sample, models).collect()}
    known = {r.doc_id: r.cls for r in sample.collect()}
    for key, text in texts.items():
        if not any(c.isalpha() for c in text or ""):
            assert (got[key].lang_pred, got[key].score) == ("und", 0.0)
            continue
        name, score = expected(models, text)
        assert got[key].lang_pred == name and got[key].score == pytest.approx(score, rel=1e-3)
    assert sum(got[k].lang_pred == c for k, c in known.items() if k is not None and k < 90) == 90


def test_bounds_and_few_languages(spark, sample):
    models = language.train(sample, family_rows=10)  # two documents of each language for the families
    got = language.identify(sample.where("doc_id < 90"), models).join(sample, "doc_id")
    assert got.where("lang_pred = cls").count() >= 85
    one = language.train(sample.where("cls = 'es'"))
    assert {(r.lang_pred, r.score) for r in language.identify(sample.where("doc_id < 90"), one).collect()} == {("es", 1.0)}
    assert language.train(sample.limit(0)) == {}
    assert {r.lang_pred for r in language.identify(sample, {}).collect()} == {"und"}


def test_vectors_are_sent_without_their_zeros():
    """They come back bit by bit, with a one at the end, and the models are those of the whole vectors."""
    rng = np.random.default_rng(3)
    x = (rng.random((40, language.DIMS)) * (rng.random((40, language.DIMS)) < 0.1)).astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[0], x[1] = 0, 1 / 64
    packed = [language._packed(v) for v in x]
    assert len(packed[0]) == language.DIMS // 8 and max(map(len, packed[2:])) < language.DIMS
    whole = language._with_ones(packed)
    assert whole.dtype == np.float32 and np.array_equal(whole[:, :-1], x) and (whole[:, -1] == 1).all()
    y = np.arange(40) % 2 == 0
    (weights, bias), (same, other) = language.fit_svm(x, y), language._fit(whole, y)
    assert np.array_equal(weights, same) and bias == other


def test_memory_of_arrow_is_returned_after_each_batch(spark):
    from skyledger.llm.tables import map_arrow

    def task(batches):
        import pyarrow as pa

        freed, pool = [], pa.default_memory_pool()

        class Pool:
            def release_unused(self):
                freed.append(pool.bytes_allocated())

        pa.default_memory_pool = Pool
        try:
            rows = sum(b.num_rows for b in batches)
        finally:
            pa.default_memory_pool = lambda: pool
        yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([len(freed)])], names=["rows", "freed"])

    got = map_arrow(spark.range(0, 2500, 1, 1), task, "rows long, freed long").collect()
    assert [(r.rows, r.freed) for r in got] == [(2500, 3)]
