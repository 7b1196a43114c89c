"""Benchmark decontamination by Wu-Manber multi-pattern search (operator 8).

Test strings are windows of ten consecutive words of a benchmark item, or a shorter item whole. Documents
are scanned over their words: a table of two-word blocks says how far the search may skip because no test
string has such a block near its end; where it may not skip, the block selects the bucket of test strings
that end in it, and the words themselves are compared. A batch is scanned in many lanes at once, each with its
own position, so that skips are array operations. Nothing is shuffled.

The test strings reach the executors as one broadcast of at most ``BENCHMARK_BYTES`` of item text. A larger
benchmark is cut into slices by a hash of the item; the documents then pass one scan after the other, and
each adds its findings to the row.

Edge cases: null and empty texts have no words; an item without words finds nothing; items with equal texts are
all reported; repeated documents are judged each; a null ``doc_id`` stays null; an empty table gives an empty
result, and an empty benchmark no findings; further columns are ignored by ``find`` and kept by
``clean_documents``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort.llm.words import NOT_ALNUM, Group, groups, mix

WINDOW = 10
#: Item text in one broadcast, at most (but for a single longer item).
BENCHMARK_BYTES = 8 << 20
LANES = 2048


class Patterns:
    """Test strings of one length with their shift table and suffix buckets."""

    def __init__(self, length: int, strings: dict[bytes, list[str]], hashes: np.ndarray):
        """hashes: per test string, in the order of ``strings``, the hashes of its words."""
        self.length, self.block = length, min(2, length)
        self.items = strings
        self.keys, self.shift = self._shifts(hashes)
        suffix = self._blocks(hashes[:, -self.block :])[:, 0]
        self.buckets: dict[int, set[bytes]] = defaultdict(set)
        for string, code in zip(strings, suffix.tolist(), strict=True):
            self.buckets[code].add(string)

    def _blocks(self, words: np.ndarray) -> np.ndarray:
        """Hashes of all blocks of neighbouring words, along the last axis."""
        if self.block == 1:
            return words
        with np.errstate(over="ignore"):
            return mix(words[..., :-1] * np.uint64(3) + words[..., 1:])

    def _shifts(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Block hashes in order and, for each, the words from its last place in any test string to the end."""
        blocks = self._blocks(hashes)
        away = np.broadcast_to(np.arange(blocks.shape[1])[::-1], blocks.shape)
        keys, inverse = np.unique(blocks, return_inverse=True)
        shift = np.full(len(keys), self.length - self.block + 1)
        np.minimum.at(shift, inverse.ravel(), away.ravel())
        return keys, shift

    def search(self, group: Group) -> Iterator[tuple[int, bytes]]:
        """First word and test string of every occurrence in the texts of a group."""
        n = len(group.hash)
        if n < self.length:
            return
        blocks = self._blocks(group.hash)
        # blocks[i] ends at word i + block - 1; a window ending at word e is judged by its last block.
        at = np.minimum(np.searchsorted(self.keys, blocks), len(self.keys) - 1)
        skip = np.where(self.keys[at] == blocks, self.shift[at], self.length - self.block + 1)
        lanes = max(1, min(LANES, n // (4 * self.length)))
        bounds = np.linspace(self.length - 1, n, lanes + 1).astype(np.int64)
        end, stop = bounds[:-1].copy(), bounds[1:]
        while len(end):
            live = end < stop
            end, stop = end[live], stop[live]
            if not len(end):
                break
            step = skip[end - self.block + 1]
            for last in end[step == 0].tolist():
                first = last - self.length + 1
                if group.text[first] == group.text[last]:
                    string = group.words(first, last + 1)
                    if string in self.buckets[int(blocks[last - self.block + 1])]:
                        yield first, string
            end = end + np.maximum(step, 1)


def compile_patterns(items: list[tuple[object, str | None]], window: int = WINDOW) -> list[Patterns]:
    """Patterns by length from (item_id, text)."""
    ids = [str(item) for item, _ in items]
    strings: dict[int, dict[bytes, list[str]]] = defaultdict(dict)
    hashes: dict[int, list[np.ndarray]] = defaultdict(list)
    for group in groups(pa.array([text for _, text in items], pa.string()), NOT_ALNUM, lower=True):
        bounds = group.word_start
        for i in range(group.texts):
            lo, hi = int(bounds[i]), int(bounds[i + 1])
            size = min(window, hi - lo)
            for first in range(lo, hi - size + 1) if size else ():
                string = group.words(first, first + size)
                if string not in strings[size]:
                    strings[size][string] = []
                    hashes[size].append(group.hash[first : first + size].copy())
                owners = strings[size][string]
                if ids[group.first + i] not in owners:
                    owners.append(ids[group.first + i])
    return [Patterns(size, strings[size], np.array(hashes[size])) for size in sorted(strings)]


def scan_group(group: Group, patterns: list[Patterns]) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Which words of a group are hit, and the items found by text."""
    hit, found = np.zeros(len(group.hash), bool), defaultdict(set)
    for kind in patterns:
        for first, string in kind.search(group):
            hit[first : first + kind.length] = True
            found[int(group.text[first])].update(kind.items[string])
    return hit, found


def _slices(benchmark: DataFrame) -> list[DataFrame]:
    """The items in slices of about BENCHMARK_BYTES of text at most."""
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    if total <= BENCHMARK_BYTES:
        return [items]
    n = -(-2 * total // BENCHMARK_BYTES)
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def _broadcast(items: DataFrame, window: int):
    """The compiled test strings of one slice, whose size is bounded."""
    return items.sparkSession.sparkContext.broadcast(compile_patterns([tuple(r) for r in items.collect()], window))


def _spans(group: Group, hit: np.ndarray) -> list[list[tuple[int, int]]]:
    """Per text, its runs of hit words; a run that goes on into the next text is cut there."""
    edge = np.diff(np.concatenate(([0], hit.view(np.int8), [0])))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = []
    for lo, hi in zip(group.word_start, group.word_start[1:], strict=False):
        a, b = np.searchsorted(end, lo, "right"), np.searchsorted(begin, hi, "left")
        out.append([(int(max(x, lo) - lo), int(min(y, hi) - lo)) for x, y in zip(begin[a:b], end[a:b], strict=True)])
    return out


def _merge(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(a + b):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


FINDINGS = "n_words bigint, spans array<struct<first:bigint,last:bigint>>, item_ids array<string>"
_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, item_ids``: hit words as [first, last) spans, found items in text order."""
    slices = _slices(benchmark)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    for number, items in enumerate(slices):
        last = number == len(slices) - 1
        shared = _broadcast(items, window)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for group in groups(batch.column(1), NOT_ALNUM, lower=True):
                    hit, found = scan_group(group, shared.value)
                    part = batch.slice(group.first, group.texts)
                    spans, items = _spans(group, hit), [found.get(i, set()) for i in range(group.texts)]
                    if part.num_columns > 2:  # findings of earlier slices
                        spans = [_merge(new, [(x["first"], x["last"]) for x in old]) for new, old in zip(spans, part.column(3).to_pylist(), strict=True)]
                        items = [new.union(old) for new, old in zip(items, part.column(4).to_pylist(), strict=True)]
                    columns = [
                        part.column(0), part.column(1), pa.array(np.diff(group.word_start)),
                        pa.array([[{"first": a, "last": b} for a, b in x] for x in spans], _SPANS), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ]
                    names = ["doc_id", "text", "n_words", "spans", "item_ids"]
                    if last:
                        del columns[1], names[1]
                    yield pa.RecordBatch.from_arrays(columns, names)

        docs = docs.mapInArrow(run, "doc_id bigint, " + ("" if last else "text string, ") + FINDINGS)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"])
    return docs.select("doc_id", "n_words", n_hit.alias("n_hit"), "spans", "item_ids")


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no test string occurs."""
    place, schema = docs.columns.index("text"), docs.schema
    for items in _slices(benchmark):
        shared = _broadcast(items, window)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                for group in groups(batch.column(place), NOT_ALNUM, lower=True):
                    kept[[group.first + i for i in scan_group(group, shared.value)[1]]] = False
                yield batch.filter(pa.array(kept))

        docs = docs.mapInArrow(run, schema)
    return docs
