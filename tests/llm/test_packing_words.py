import struct

import pytest

from skyledger.llm import packing


def library(tokens, text):
    ids = tokens.tokenizer.encode(text, add_special_tokens=False).ids
    return struct.pack(f"<{len(ids)}I", *ids)


def letters():
    return [chr(c) for c in range(0x180) if chr(c).isalpha()]


@pytest.fixture(scope="module")
def path():
    return packing.tokenizer_path()


def test_words_of_letters_by_the_model_alone(path):
    """Each Latin letter, alone, doubled, between others and before signs, as the whole tokenizer encodes it."""
    tokens = packing.WordTokens(path)
    words = [w for c in letters() for w in (c, c * 2, f"xa{c}b", f"{c}qv{c}.", f"Na{c},##", f"{c}'s", f"á{c}", f"{c}9a", f"я{c}")]
    assert list(tokens.texts(words)) == [library(tokens, w) for w in words]
    assert list(tokens.texts([" ".join(words), "", "a"])) == [library(tokens, t) for t in (" ".join(words), "", "a")]


def test_tokenizer_sees_no_word_of_letters(path):
    tokens, asked = packing.WordTokens(path), []

    class Recorder:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return whole.encode_batch_fast(texts, **options)

    whole, tokens.tokenizer = tokens.tokenizer, Recorder()
    list(tokens.texts(["Heitsch. ètionée wa2t laaiaièan, a'b " + "abc" * packing.CACHED_CHARS]))
    assert sorted(p for p in asked if p) == [",", ".", "a'b", "wa2t"]


def test_other_tokenizers_encode_every_word_themselves(path):
    from tokenizers import Tokenizer, normalizers

    tokens = packing.WordTokens(path)
    other = Tokenizer.from_file(path)
    other.normalizer = normalizers.Sequence([normalizers.Lowercase(), normalizers.Replace("e", "a")])
    assert packing.LetterWords.serves(tokens.tokenizer) and not packing.LetterWords.serves(other)
    tokens.tokenizer, tokens.letters = other, None
    assert list(tokens.texts(["Seen here."])) == [library(tokens, "Seen here.")]


def test_chunks_are_cut_into_letters_and_signs():
    cut = {
        "Word": ("word", "", True), "WORD.)": ("word", ".)", True), "x1": ("x1", "", False), "a-b,": ("a-b,", "", False), "...": ("...", "", False),
        "": ("", "", False), "Äpfel!": ("äpfel", "!", True), "İs.": ("İs.", "", False), "Ωmega,": ("Ωmega", ",", False),
        "é": ("é", "", True), "é²": ("é²", "", False), "ab„": ("ab„", "", False), "7": ("7", "", False),
    }
    assert {chunk: packing._parts(chunk) for chunk in cut} == cut
    assert packing._byte_level("\u00e9 a") == "\u00c3\u00a9 a"  # many words at once


def test_latin_letters_by_arrow_and_by_python():
    """Lower case and letters of every sign that Arrow cuts words at are those of ``_parts``, and signs beyond go there."""
    import pyarrow as pa

    words = [w for c in map(chr, range(0x250)) if not c.isspace() for w in (c, f"a{c}", f"{c}b.", f"N{c},##", f".{c}", f"a.{c}!")]
    words += ["", "İs.", "Ωmega,", "слово.", "a" + "́" + ",", "x\x1cy.", "ab\x85c"]
    stems, tails, folded = packing._split(pa.array(words, pa.large_string()))
    assert list(zip(stems.to_pylist(), tails.to_pylist(), folded.tolist())) == [packing._parts(w) for w in words]


def test_table_of_words_stays_small(path, monkeypatch):
    """Once it is full, words used last stay; ids are the same, and no word is a Python object for longer than its slice."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 100)
    tokens = packing.WordTokens(path)
    for n in range(12):
        texts = [" ".join(f"Every w{n}x{k}, twice{chr(97 + k % 26)}." for k in range(30)), "", f" every \t{'long' * 20}{n}"]
        assert list(tokens.texts(texts)) == [library(tokens, t) for t in texts]
        assert len(tokens.known) == len(tokens.ids) == len(tokens.used) <= 100
    assert "every" in tokens.known.to_pylist() and max(map(len, tokens.known.to_pylist())) <= packing.CACHED_CHARS
    assert tokens.known.nbytes + tokens.ids.nbytes < 10_000


def test_pieces_of_many_documents(path):
    """Bounds and pieces of documents at once, empty ones and white space beyond ASCII among them."""
    tokens = packing.WordTokens(path)
    texts = ["word, " * (n * 37 % 300) for n in range(40)] + ["", " a\xa0b\u2003C.\x85\x1cd\u3000e ", "\t"]
    bounds, data = tokens.joined(packing.pa.array(texts), b"\2\0\0\0")
    assert data.to_pybytes() == b"".join(library(tokens, t) + b"\2\0\0\0" for t in texts) and bounds[-1] == len(data)
    lengths = packing.np.diff(bounds) // 4
    row, length = packing.pieces_of(lengths, 64)
    assert [length[row == k].tolist() for k in range(len(texts))] == [packing.piece_lengths(int(n), 64) for n in lengths]
    assert packing.piece_lengths(64 * 2 + 37, 64) == [64, 64, 32, 4, 1]
