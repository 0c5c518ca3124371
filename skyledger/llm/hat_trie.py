"""A HAT-trie over packed word ids: hash containers, here sorted arrays with counts, below a shallow trie.

A key packs up to three word ids of ``BITS`` bits, the first word highest; id 0 stands for no word. The root
holds containers for ranges of first words. A container that holds more than ``burst`` distinct keys is split between
two words; one that holds a single word bursts into a trie node over the next word. Containers are
numpy arrays: what is added waits in a buffer and is counted by sorting, many keys at a time.

``spill`` takes whole subtrees below the root, the largest first, as runs of sorted keys with counts.
"""

from collections.abc import Iterator

import numpy as np

BITS = 21
WORDS = 3
MASK = (1 << BITS) - 1
BURST = 1 << 17


def pack(columns: list[np.ndarray]) -> np.ndarray:
    """Keys of equally long columns of word ids."""
    key = np.zeros(len(columns[0]), np.int64)
    for position, ids in enumerate(columns):
        key |= ids.astype(np.int64) << (BITS * (WORDS - 1 - position))
    return key


def word_of(keys: np.ndarray, position: int) -> np.ndarray:
    return (keys >> (BITS * (WORDS - 1 - position))) & MASK


def _counted(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


class Container:
    """Keys of a range of words at its level, with counts."""

    def __init__(self, level: int, burst: int, keys: np.ndarray | None = None, counts: np.ndarray | None = None):
        self.level, self.burst = level, burst
        self.keys = np.zeros(0, np.int64) if keys is None else keys
        self.counts = np.zeros(0, np.int64) if counts is None else counts
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0

    def __len__(self) -> int:
        return len(self.keys) + self.n_waiting

    def add(self, keys: np.ndarray) -> list | None:
        """Takes keys; what shall stand in its place, (first word, child) each, if it bursts."""
        self.waiting.append(keys)
        self.n_waiting += len(keys)
        if self.n_waiting < max(self.burst // 2, len(self.keys)):
            return None
        self.settle()
        return self._parts() if len(self.keys) > self.burst else None

    def settle(self) -> None:
        if self.n_waiting:
            new, counts = np.unique(np.concatenate(self.waiting), return_counts=True)
            self.keys, self.counts = _counted(np.concatenate([self.keys, new]), np.concatenate([self.counts, counts]))
            self.waiting, self.n_waiting = [], 0

    def _parts(self) -> list | None:
        words = word_of(self.keys, self.level)
        if words[0] == words[-1]:
            if self.level == WORDS - 1:
                return None
            return [(int(words[0]), Node(self.level + 1, self.burst, Container(self.level + 1, self.burst, self.keys, self.counts)))]
        middle = words[len(words) // 2]
        cut = np.searchsorted(words, middle, "left" if middle > words[0] else "right")
        halves = [(self.keys[:cut], self.counts[:cut]), (self.keys[cut:], self.counts[cut:])]
        return [(int(word_of(keys[:1], self.level)[0]), Container(self.level, self.burst, keys, counts)) for keys, counts in halves]

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        self.settle()
        if len(self.keys):
            yield self.keys, self.counts


class Node:
    """Children for ranges of the words at one level; each range starts at a word and ends before the next one's."""

    def __init__(self, level: int, burst: int, child: "Container | Node | None" = None):
        self.level, self.burst = level, burst
        self.starts: list[int] = [0]
        self.children: list[Container | Node] = [child or Container(level, burst)]

    def __len__(self) -> int:
        return sum(map(len, self.children))

    def add(self, keys: np.ndarray) -> None:
        """Takes sorted keys."""
        words = word_of(keys, self.level)
        cuts = [0, *np.searchsorted(words, self.starts[1:]), len(keys)]
        for at in range(len(self.children) - 1, -1, -1):
            if cuts[at] < cuts[at + 1]:
                parts = self.children[at].add(keys[cuts[at] : cuts[at + 1]])
                if parts:
                    self._replace(at, parts)

    def _replace(self, at: int, parts: list) -> None:
        """The first part takes over the range's start, unless it is a node, which stands for one word alone."""
        (word, first), *rest = parts
        low, high = self.starts[at], self.starts[at + 1] if at + 1 < len(self.starts) else MASK + 1
        new = [(low, first), *rest]
        if isinstance(first, Node):
            new = [(low, Container(self.level, self.burst))] * (low < word) + [(word, first)]
            new += [(word + 1, Container(self.level, self.burst))] * (word + 1 < high)
        self.starts[at : at + 1] = [start for start, _ in new]
        self.children[at : at + 1] = [child for _, child in new]

    def runs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for child in self.children:
            yield from child.runs()


class HatTrie:
    """Counts of keys in bounded memory, as long as ``spill`` is called when ``len`` passes a limit."""

    def __init__(self, burst: int = BURST):
        self.root = Node(0, burst)

    def __len__(self) -> int:
        """Keys held: distinct ones, and those that still wait to be counted."""
        return len(self.root)

    def add(self, keys: np.ndarray) -> None:
        self.root.add(np.sort(keys))

    def spill(self, down_to: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Whole subtrees, the largest first, until at most ``down_to`` keys are left: (sorted keys, counts) each."""
        sizes = [len(child) for child in self.root.children]
        left = sum(sizes)
        for at in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
            if left <= down_to:
                break
            left -= sizes[at]
            yield from self.root.children[at].runs()
            self.root.children[at] = Container(0, self.root.burst)
