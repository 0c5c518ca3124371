"""Packing by power-of-two decomposition.

Each document's tokens (with the end token) are cut into as many full sequences of ``max_len`` as fit,
then into pieces of the binary digits of what is left, longest first. Every piece is a sequence of its
own, of a length that is a power of two: no sequence crosses documents and none needs padding. ``bucket``
is that length; ``write_buckets`` stores pieces of equal length together, ready for batches without
padding. Packing needs no shuffle: a piece depends on its document alone.

Tokens are made per chunk between ASCII white space. The tokenizer never joins characters across white
space (control tokens spelt in a text hold none either, and become the tokens they spell), so each different chunk of a slice is looked up once, its
letters and the signs after them apart, in a bounded table of ids, and the library encodes only what it has not seen lately. Of these, words of letters alone need neither the tokenizer's normalizer nor its
patterns: its model encodes them as one text. Texts are handled in slices of about four megabytes, each document whole.

Defined results: a null or empty text is the end token alone. Rows that repeat a ``doc_id`` are packed
each. Other columns are ignored, whatever their names. An empty table gives no piece.
"""

import json
import os
import string
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyledger.llm.tables import map_arrow, table
from skyledger.llm.wordhash import text_slices

MAX_LEN = 4096
END_ID = 2
CACHED_WORDS = 500_000  # some 40 bytes each in Arrow arrays, which a Python worker keeps after its last task
CACHED_CHARS = 40
SLICE_BYTES = 1 << 22  # each different word of a slice is looked up once
BATCH_IDS = 1 << 20  # in an Arrow batch of pieces, one piece at least
_SIGNS = string.punctuation
_LATIN_END = "\u0180"  # beyond, lower case may depend on neighbours
_DOTTED_I = "\u0130"
_LATIN = "".join(c for c in map(chr, range(ord(_LATIN_END))) if c != _DOTTED_I)
_LATIN_LETTERS = "".join(filter(str.isalpha, _LATIN))
_WORD_END = "</w>"
_JOINED = 500  # words in one text to the model
# With these a lower-case word of Latin letters is one piece, encoded as its bytes.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]}


def _byte_signs() -> dict[int, str]:
    """The signs that stand for bytes which are none themselves, as the ByteLevel step writes them."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: chr(0x100 + n) for n, b in enumerate(b for b in range(0x100) if b not in own)}


_BYTE_SIGNS = _byte_signs()
_BYTE_TABLE = "".join(" " if b == 0x20 else _BYTE_SIGNS.get(b, chr(b)) for b in range(0x100))


def _byte_level(words: str) -> str:
    """Words as the ByteLevel step writes them; the spaces between them stay."""
    return words if words.isascii() else words.encode().decode("latin-1").translate(_BYTE_TABLE)


class LetterWords:
    """The tokenizer's model alone, for lower-case words of Latin letters: many at once, told apart by their last ids."""

    def __init__(self, tokenizer):
        from tokenizers import Tokenizer, pre_tokenizers

        self.model = Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocabulary = self.model.get_vocab()
        self.last = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.last[number] = token.endswith(_WORD_END)

    @staticmethod
    def serves(tokenizer) -> bool:
        """Whether the steps before the model are those that this class leaves out, and the model ends each word visibly."""
        parts = json.loads(tokenizer.to_str())
        model = parts["model"]
        return (
            parts["normalizer"] == _NORMALIZER and parts["pre_tokenizer"] == _PRE_TOKENIZER and parts["post_processor"] is None
            and parts["truncation"] is None and parts["padding"] is None
            and model["type"] == "BPE" and model["end_of_word_suffix"] == _WORD_END and not model["dropout"] and not model["ignore_merges"]
            and all(sign in model["vocab"] and sign + _WORD_END in model["vocab"] for sign in map(chr, {*range(0x100), *map(ord, _BYTE_SIGNS.values())} - set(_BYTE_SIGNS)))
        )

    def encode(self, words: list[str]) -> pa.Array:
        lengths, raw = [], []
        for k in range(0, len(words), _JOINED):
            some = words[k : k + _JOINED]
            ids = np.array(self.model.encode_batch_fast([_byte_level(" ".join(some))], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.last[ids])
            if len(ends) != len(some):
                raise ValueError("the model's words can't be told apart")
            lengths.append(np.diff(ends, prepend=-1))
            raw.append(ids)
        return _binary(lengths, raw)


def _binary(lengths: list[np.ndarray], ids: list[np.ndarray]) -> pa.Array:
    """Consecutive ids as one binary value for each length."""
    places = np.cumsum(np.concatenate([[0], *lengths]) * 4, dtype=np.int64)
    data = np.concatenate(ids).astype("<u4") if ids else np.zeros(0, "<u4")
    return pa.Array.from_buffers(pa.large_binary(), len(places) - 1, [None, pa.py_buffer(places), pa.py_buffer(data)])


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _parts(chunk: str) -> tuple[str, str, bool]:
    """Letters (case folded where that is safe, and whether it was) and the ASCII signs after them, or the whole chunk."""
    stem = chunk if chunk.isalpha() else chunk.rstrip(_SIGNS)
    if stem.isascii():  # nearly all chunks: as below, in fewer steps
        return (stem.lower(), chunk[len(stem) :], True) if stem.isalpha() else (chunk, "", False)
    if not stem.isalpha() or _DOTTED_I in stem:  # its lower case ends in a mark, which is no letter
        return chunk, "", False
    folded = max(stem) < _LATIN_END
    return stem.lower() if folded else stem, chunk[len(stem) :], folded


def _split(words: pa.Array) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """``_parts`` of many words: Latin ones by Arrow, the others one by one."""
    stems = pc.utf8_rtrim(words, characters=_SIGNS)
    latin = pc.equal(pc.utf8_ltrim(words, characters=_LATIN), "")
    folded = pc.and_(latin, pc.utf8_is_alpha(stems))
    tails = pc.if_else(folded, pc.utf8_ltrim(words, characters=_LATIN_LETTERS), "")
    stems = pc.if_else(folded, pc.utf8_lower(stems), words)
    cut = folded.to_numpy(zero_copy_only=False).copy()
    others = ~latin.to_numpy(zero_copy_only=False)
    if others.any():
        mask = pa.array(others)
        some = [_parts(w) for w in words.filter(mask).to_numpy(zero_copy_only=False)]
        stem, tail, fold = zip(*some)
        stems = pc.replace_with_mask(stems, mask, pa.array(stem, stems.type))
        tails = pc.replace_with_mask(tails, mask, pa.array(tail, tails.type))
        cut[others] = fold
    return stems, tails, cut


class WordTokens:
    """Little-endian unsigned 32-bit ids of texts, by way of a bounded table of the parts of words met lately."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.letters = LetterWords(self.tokenizer) if LetterWords.serves(self.tokenizer) else None
        self.known, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.used, self.now = np.zeros(0, np.int64), 0

    def encode(self, parts: pa.Array, folded: np.ndarray) -> pa.Array:
        """Ids of different parts; ``folded`` tells which ones are lower-case Latin letters."""
        if not self.letters:
            folded = np.zeros(len(parts), bool)
        others = self.tokenizer.encode_batch_fast(parts.filter(pa.array(~folded)).to_pylist(), add_special_tokens=False)
        ids = [np.array(e.ids, "<u4") for e in others]
        found = _binary([np.array([len(i) for i in ids], np.int64)], ids)
        if not folded.any():
            return found
        letters = self.letters.encode(parts.filter(pa.array(folded)).to_numpy(zero_copy_only=False).tolist())
        place = np.where(folded, np.cumsum(folded) - 1, len(letters) + np.cumsum(~folded) - 1)
        return pa.concat_arrays([letters, found]).take(pa.array(place))

    def words(self, words: pa.Array) -> pa.Array:
        """Ids of different words. Letters followed by ASCII signs are two words to the tokenizer: the case-folded
        letters and the signs are encoded once for all words that share them."""
        stems, tails, folded = _split(words)
        numbered = pa.concat_arrays([stems, tails]).dictionary_encode()
        parts, code = numbered.dictionary, numbered.indices.to_numpy()
        letters = np.zeros(len(parts), bool)
        letters[code[: len(words)][folded]] = True
        at = pc.index_in(parts, value_set=self.known)
        mask = at.is_null()
        missing = mask.to_numpy(zero_copy_only=False)
        fresh = parts.filter(mask)
        ids = pa.concat_arrays([self.ids, self.encode(fresh, letters[missing])])
        place = at.fill_null(0).to_numpy().astype(np.int64)
        self.used[place[~missing]] = self.now
        place[missing] = len(self.known) + np.arange(len(fresh))
        found = ids.take(pa.array(place))
        self._keep(pa.concat_arrays([self.known, fresh]), ids, len(fresh))
        return pc.binary_join_element_wise(found.take(pa.array(code[: len(words)])), found.take(pa.array(code[len(words) :])), pa.scalar(b"", found.type))

    def _keep(self, parts: pa.Array, ids: pa.Array, fresh: int) -> None:
        """The table for the next words: without long parts, and without the half used longest ago where it got too large."""
        used = np.append(self.used, np.full(fresh, self.now))
        kept = np.ones(len(parts), bool)
        kept[len(parts) - fresh :] = pc.less_equal(pc.utf8_length(parts[len(parts) - fresh :]), CACHED_CHARS).to_numpy(zero_copy_only=False)
        if kept.sum() > CACHED_WORDS:
            kept[np.argsort(np.where(kept, used, -1), kind="stable")[: len(kept) - CACHED_WORDS // 2]] = False
        if not kept.all():
            parts, ids, used = parts.filter(pa.array(kept)), ids.filter(pa.array(kept)), used[kept]
        self.known, self.ids, self.used = parts, ids, used
        self.now += 1

    def joined(self, texts: pa.Array, end: bytes = b"") -> tuple[np.ndarray, pa.Buffer]:
        """Where each text's ids begin (one more at the end), in bytes, and the ids of all texts, ``end`` after each.

        Arrow cuts the texts and numbers their different words; only parts that are not known become Python objects.
        """
        split = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
        numbered = split.flatten().dictionary_encode()
        ids = self.words(numbered.dictionary)
        bounds = np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])
        order = np.insert(numbered.indices.to_numpy(), bounds[1:], len(ids))
        joined = pa.concat_arrays([ids, pa.array([end], ids.type)]).take(pa.array(order))
        _, places, data = joined.buffers()
        return np.frombuffer(places, np.int64)[bounds + np.arange(len(bounds))], data or pa.py_buffer(b"")

    def texts(self, texts: list[str]) -> Iterator[bytes]:
        bounds, data = self.joined(pa.array(texts, pa.large_string()))
        return (data[a:b].to_pybytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist()))


_TOKENS: dict[str, WordTokens] = {}


def pieces_of(tokens: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Document and length of each piece of documents with so many tokens, in order."""
    bits = np.arange(max_len.bit_length() - 1)[::-1]
    counts = np.column_stack([tokens // max_len, (tokens % max_len)[:, None] >> bits & 1])
    sizes = np.concatenate([[max_len], 1 << bits])
    return np.repeat(np.arange(len(tokens)), counts.sum(axis=1)), np.repeat(np.tile(sizes, len(tokens)), counts.ravel())


def piece_lengths(tokens: int, max_len: int) -> list[int]:
    return pieces_of(np.array([tokens]), max_len)[1].tolist()


def pack(
    docs: DataFrame,
    path: str | None = None,
    max_len: int = MAX_LEN,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, bucket, doc_tokens, sequence_id, offset and ``ids``.

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit numbers. ``sequence_id`` is
    unique within the result.
    """
    if max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    path = path or tokenizer_path()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([
        rows.schema["doc_id"], *(T.StructField(c, T.LongType(), False) for c in ("start", "length", "doc_tokens")),
        T.StructField("ids", T.BinaryType(), False),
    ])
    end = struct.pack("<I", end_id)

    def cut(batches):
        tokens = _TOKENS.get(path) or _TOKENS.setdefault(path, WordTokens(path))
        for batch in batches:
            texts = batch.column(1)
            for first, last, _, _ in text_slices(texts, SLICE_BYTES):
                bounds, ids = tokens.joined(texts[first:last], end)
                total = np.diff(bounds) // 4
                row, length = pieces_of(total, max_len)
                ends = np.cumsum(length)
                starts = ends - length
                k = 0
                while k < len(row):
                    stop = max(k + 1, int(np.searchsorted(ends, starts[k] + BATCH_IDS, "right")))
                    own, zero = row[k:stop], starts[k]
                    places = (4 * (np.append(starts[k:stop], ends[stop - 1]) - zero)).astype(np.int32)
                    binary = pa.Array.from_buffers(pa.binary(), stop - k, [None, pa.py_buffer(places), ids.slice(4 * zero, places[-1])])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(own + first)), *map(pa.array, (starts[k:stop] - bounds[own] // 4, length[k:stop], total[own])), binary],
                        names=["doc_id", "start", "length", "doc_tokens", "ids"],
                    )
                    k = stop

    return map_arrow(rows, cut, schema).withColumns({
        "bucket": F.col("length"), "sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"),
    })


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Store pieces so that equal lengths lie together."""
    pieces.write.partitionBy("bucket").parquet(path)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return digest(pack(table(spark, sf_dir, "documents")))
