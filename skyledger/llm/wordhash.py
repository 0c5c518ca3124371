"""Word and shingle hashes of many texts at once, on the bytes of an Arrow string column.

Words are runs of bytes that are no ASCII white space (or, folded, runs of ASCII letters, digits and
bytes beyond ASCII). UTF-8 never uses ASCII bytes inside a character, so byte and character words agree.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18  # larger slices only cost memory: 8 bytes for each byte of text, several times over
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
NOT_ALNUM = np.ones(256, bool)
for _part in (range(48, 58), range(65, 91), range(97, 123), range(128, 256)):
    NOT_ALNUM[list(_part)] = False


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: spreads every bit over all 64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows; a null is an empty text, no row is cut."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + slice_bytes, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Powers:
    """Powers of the base and of its inverse, grown to the longest slice seen."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _BASE))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, _INVERSE))])


_POWERS = Powers()


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE, lower: bool = False):
    """Starts, ends and hashes of all words, and per text the index of its first word (one more at the end)."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~separator[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    _POWERS.to(n + 1)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(((LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)) * _POWERS.up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _POWERS.down[starts] + (ends - starts).astype(np.uint64) * _BASE)
    return starts, ends, hashes, np.searchsorted(starts, offsets)


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on, for the ``len - n + 1`` positions that have them.

    The hash of a + b words is ``mix(hash of a * odd + hash of b)``, built by doubling.
    """
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    at, total, width, block = 0, None, 1, hashes
    while True:
        if n & width:
            part = block[at:]
            total = part if total is None else mix(total[: len(part)] * _BASE + part[: len(total)])
            at += width
        width *= 2
        if width > n:
            break
        block = mix(block[: len(block) - width // 2] * _BASE + block[width // 2 :])
    return mix(total[: len(hashes) - n + 1] + np.uint64(n))


def shingles(hashes: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes of n words that lie in one text, the index of their first word, and text bounds in them.

    A text of 1 to n - 1 words has its whole sequence as its one shingle.
    """
    counts = np.diff(bounds)
    whole = runs(hashes, n)
    keep = np.zeros(len(hashes), bool)
    per_text = np.maximum(counts - n + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(hashes):
        ends = np.repeat(bounds[1:], counts)
        keep = np.arange(len(hashes)) + n <= ends
    values = np.zeros(len(hashes), np.uint64)
    values[: len(whole)] = whole
    for width in range(1, n):
        at = bounds[:-1][short[counts[short] == width]]
        if len(at):
            values[at] = runs(hashes, width)[at]
            keep[at] = True
    per_text[short] = 1
    return values[keep], np.flatnonzero(keep), np.concatenate([[0], np.cumsum(per_text)])
