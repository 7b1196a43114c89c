"""Words of whole texts as numpy arrays, straight from Arrow's UTF-8 buffers.

A batch of texts is cut into groups of neighbouring texts of about ``GROUP_BYTES`` (a longer text is a
group of its own), so the arrays stay small whatever the batch size. Words are maximal runs of bytes
outside a separator class; every class used here holds ASCII characters only, so bytes and characters
agree. Hashes depend on the bytes of a word alone: the same in every task, on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

GROUP_BYTES = 1 << 20
#: Odd multipliers of the polynomial hashes: one inside a word, two over the words of a window.
BYTE_BASE, WINDOW_BASE, SECOND_BASE = 0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95, 0xDA942042E4DD58B5


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo : hi + 1] = True
    return table


#: Separators of ``[^\x20\x09-\x0D]+``.
SPACE = _class((0x20, 0x20), (0x09, 0x0D))
#: Separators of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` once A-Z are lower case.
NOT_ALNUM = _class((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base**i`` and its inverse modulo 2**64 for i up to n."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, (n + 1).bit_length())
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=np.uint64))
        have = _POWERS[base] = (pair[0], pair[1])
    return have


def prefix_sums(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=out[1:])
    return out


@dataclass
class Group:
    """Neighbouring texts ``first .. first + texts - 1`` of a batch and their words in order."""

    first: int
    texts: int
    data: np.ndarray  # the UTF-8 bytes of the group's texts, A-Z lower-cased if asked for
    text_start: np.ndarray  # per text and one more: where its bytes begin in data
    start: np.ndarray  # per word: its bytes are data[start:end]
    end: np.ndarray
    text: np.ndarray  # per word: the number of its text within the group
    hash: np.ndarray

    @property
    def word_start(self) -> np.ndarray:
        """Per text and one more: its first word."""
        return np.searchsorted(self.text, np.arange(self.texts + 1))

    def place(self) -> np.ndarray:
        """Per word: its number within its text."""
        return np.arange(len(self.text)) - self.word_start[self.text]

    def windows(self, size: int, base: int = WINDOW_BASE) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of ``size`` words inside one text, and the windows' hashes."""
        n = len(self.hash)
        if n < size:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.text[: n - size + 1] == self.text[size - 1 :])
        return at, self.window_hash(at, size, base)

    def window_hash(self, at: np.ndarray, size, base: int = WINDOW_BASE) -> np.ndarray:
        """Hashes of the windows of ``size`` words (a number, or one for each) that begin at the words ``at``."""
        up, down = powers(base, len(self.hash))
        sums = prefix_sums(self.hash * up[: len(self.hash)])
        return mix((sums[at + size] - sums[at]) * down[at])

    def words(self, lo: int, hi: int) -> bytes:
        """The words lo .. hi - 1, joined by one space."""
        data = self.data
        return b" ".join(data[self.start[i] : self.end[i]].tobytes() for i in range(lo, hi))


def _scan(data: np.ndarray, breaks: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words in a block of bytes; a word ends at each of ``breaks``."""
    word = ~separators[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[1:-1] = word[1:] != word[:-1]
    edge[0], edge[-1] = True, True
    edge[breaks] = True
    at = np.flatnonzero(edge)
    inside = word[at[:-1]]
    start, end = at[:-1][inside], at[1:][inside]
    up, down = powers(BYTE_BASE, len(data))
    sums = prefix_sums(_BYTE[data] * up[: len(data)])
    return start, end, mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def _blocks(data: np.ndarray, separators: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut the bytes of a very long text behind separators."""
    lo = 0
    while lo < len(data):
        hi = min(lo + GROUP_BYTES, len(data))
        while hi < len(data):  # grow until the block ends behind a separator; a word may be long as well
            tail = np.flatnonzero(separators[data[max(lo, hi - 4096) : hi]])
            if len(tail):
                hi = max(lo, hi - 4096) + int(tail[-1]) + 1
                break
            hi = min(hi + 4096, len(data))
        yield lo, hi
        lo = hi


def groups(texts: pa.Array, separators: np.ndarray = SPACE, lower: bool = False) -> Iterator[Group]:
    """The words of a column of texts; null has none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return
    _, offsets, raw = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + GROUP_BYTES, "right")) - 1)
        data = raw[offsets[first] : offsets[last]]
        data = LOWER[data] if lower else data
        bounds = offsets[first : last + 1] - offsets[first]
        if len(data) <= 2 * GROUP_BYTES:
            start, end, code = _scan(data, bounds, separators)
        else:
            parts = [(lo, *_scan(data[lo:hi], bounds[(bounds >= lo) & (bounds <= hi)] - lo, separators)) for lo, hi in _blocks(data, separators)]
            start, end = (np.concatenate([p[i] + p[0] for p in parts]) for i in (1, 2))
            code = np.concatenate([p[3] for p in parts])
        owner = np.searchsorted(bounds, start, "right") - 1
        yield Group(first, last - first, data, bounds, start, end, owner, code)
        first = last
    pa.default_memory_pool().release_unused()  # workers live on between tasks


def signed(x: np.ndarray) -> np.ndarray:
    """Spark's bigint with the same bits."""
    return x.view(np.int64)
