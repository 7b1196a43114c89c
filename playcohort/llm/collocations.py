"""Phrase collocation mining by mergeable Misra-Gries summaries (operator 11).

Phrases of two to four words that occur ``least`` times or more in a language are found in passes over the whole texts:

1. *Summaries.* Every n-gram has a 64-bit key; the key's upper bits name its hash partition. A task counts its n-grams
   and sends each hash partition's share there as one row. There the rows merge into a Misra-Gries summary: counters are
   added; when there are more than the capacity allows, the (capacity + 1)-th largest count is subtracted from all.
   The capacity exceeds the partition's mass divided by ``least``, so all subtractions together stay below ``least`` and
   every frequent n-gram survives: its counter plus all that was subtracted is at least its number. A partition that is
   heavier than twice the mean lets its summary grow rather than subtract too much, so the guarantee needs no luck.
   The passes go words, two words, three and four words; an n-gram enters only if the shorter ones in it survived.
2. *Exact counts.* The last pass counts the survivors themselves, as text, again a row for each hash partition, and drops
   what is not frequent.

Survivors travel between passes as a Bloom filter with one hash, ``2 ** filter_bits`` bits whatever the size of the
corpus (16 MB by default, the only broadcast). A wrong yes costs work and changes no result; a corpus with more frequent
n-grams than bits to spare wants a larger filter. Scores are exact: integer division of decimals.

Joins that look up the parts of a phrase are salted by the phrase, so a word that begins very many phrases is dealt out;
the best phrases of a language are selected by salted ranks in three rounds.

Edge cases: null and empty texts have no words; a null ``lang`` is ``und``, together with that text; repeated documents
count each; equal scores and counts are ordered by the phrase's UTF-8 bytes; an empty table gives an empty result; further
columns are ignored. Summaries hold the upper bits of a key, 32 beyond the hash partition's: keys that collide there only
add to the survivors. The exact pass tells phrases apart by all 64 bits within what one task counts at a time, and by
their text between tasks.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playcohort.llm.words import WINDOW_BASE, Group, groups, mix
from playcohort.session import materialize

LEAST, LONGEST, TOP, COVERED = 30, 4, 2000, 80
FILTER_BITS = 27
#: n-grams a task counts before it sends a row to each hash partition.
FLUSH = 4_000_000
#: Counters in the summary of one hash partition, about; more hash partitions are made for a larger corpus.
COUNTERS = 1 << 17
#: Phrases a task counts exactly before it hands them on.
PHRASES = 400_000
_SPACES = np.isin(np.arange(256), [*b" .,;:!?", *range(0x09, 0x0E)])
_BREAKS = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
SUMMARY = "part int, ahead bigint, keys binary, small binary, large binary"


def _code(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Grams:
    """The n-grams of a group: ``key[n]`` at each word, and where one begins that lies inside a piece of text."""

    def __init__(self, group: Group, langs: list[str]):
        lang = np.array([_code(x) for x in langs], np.uint64)
        self.piece = np.concatenate([[0], np.cumsum(_BREAKS[group.data])])[group.start] + group.text  # neither ever falls
        self.word = group.hash
        self.base = np.uint64(WINDOW_BASE)
        self.key = {1: mix(group.hash * self.base + lang[group.text])}

    def keys(self, n: int) -> np.ndarray:
        if n not in self.key:
            shorter, m = self.keys(n - 1), max(0, len(self.word) - n + 1)
            self.key[n] = mix(shorter[:m] * self.base + self.word[n - 1 :])
        return self.key[n]

    def inside(self, n: int) -> np.ndarray:
        m = max(0, len(self.word) - n + 1)
        return self.piece[:m] == self.piece[n - 1 :][:m]

    def kept(self, n: int, filters: dict[int, np.ndarray]) -> np.ndarray:
        """Where an n-gram begins that its filter, or that of the longest shorter n-grams, lets through."""
        ok = self.inside(n)
        size = max((s for s in filters if s <= n), default=0)
        if size:
            passed = self.inside(size) & _passes(self.keys(size), filters[size])
            for shift in range(n - size + 1):
                ok &= passed[shift : shift + len(ok)]
        return ok


def _passes(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _scan(batch: pa.RecordBatch) -> Iterator[tuple[Group, list[str]]]:
    langs = batch.column(0).to_pylist()
    for group in groups(batch.column(1), _SPACES, lower=True):
        yield group, langs[group.first : group.first + group.texts]


class Summary:
    """A Misra-Gries summary of weighted keys; ``spent`` is what was subtracted from every counter so far."""

    def __init__(self, capacity: int, least: int):
        self.capacity, self.least, self.spent = capacity, least, 0
        self.keys, self.counts = np.zeros(0, "<u4"), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size > self.capacity:
            self._merge()

    def _merge(self) -> None:
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.size = [], 0
        self.keys, place = np.unique(keys, return_inverse=True)
        self.counts = np.bincount(place, counts, len(self.keys)).astype(np.int64) if len(keys) else counts
        while len(self.keys) > self.capacity:
            cut = int(np.partition(self.counts, -(self.capacity + 1))[-(self.capacity + 1)])
            if self.spent + cut >= self.least:  # heavier than expected: a frequent key could be lost
                self.capacity *= 2
                continue
            left = self.counts > cut
            self.keys, self.counts, self.spent = self.keys[left], self.counts[left] - cut, self.spent + cut

    def survivors(self) -> np.ndarray:
        """All keys that can have occurred ``least`` times."""
        self._merge()
        return self.keys[self.counts + self.spent >= self.least]


def _summaries(docs: DataFrame, sizes: tuple[int, ...], filters: dict, mass: int, least: int, filter_bits: int) -> tuple[dict[int, np.ndarray], int]:
    """Filters of the n-grams of ``sizes`` that survive, and how many n-grams the next sizes can have at most."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = min(filter_bits - 3, _parts(tasks, mass, least))
    capacity, longest = 2 * mass // (least << log) + 1024, max(sizes)
    shared = {n: spark.sparkContext.broadcast(bits) for n, bits in filters.items()}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = {n: b.value for n, b in shared.items()}
        waiting: list[np.ndarray] = []
        ahead = 0
        for batch in batches:
            for group, langs in _scan(batch):
                grams = Grams(group, langs)
                waiting += [grams.keys(n)[grams.kept(n, have)] for n in sizes]
                ahead += sum(int(grams.kept(longest + n, have).sum()) for n in (1, 2) if longest + n <= LONGEST)
                if sum(map(len, waiting)) > FLUSH:
                    yield _rows(waiting, ahead, log)
                    waiting, ahead = [], 0
        if waiting:
            yield _rows(waiting, ahead, log)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, Summary] = {}
        ahead = 0
        for batch in batches:
            for part, more, keys, small, large in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                summary = merged.setdefault(part, Summary(capacity, least))
                summary.add(np.frombuffer(keys, "<u4"), _numbers(small, large))
                ahead += more
        for part, summary in merged.items():
            bits = np.zeros(1 << (filter_bits - log), np.uint8)
            bits[summary.survivors() >> np.uint32(32 + log - filter_bits)] = 1
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([ahead]), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], ["part", "ahead", "bits"])
            ahead = 0

    rows = docs.mapInArrow(count, SUMMARY).repartition(max(tasks, (1 << log) // 16), "part").mapInArrow(merge, "part int, ahead bigint, bits binary")
    chunk = 1 << (filter_bits - log - 3)
    bits, ahead = np.zeros(1 << (filter_bits - 3), np.uint8), 0
    for row in rows.collect():  # 2 ** filter_bits bits in all
        bits[row["part"] * chunk : (row["part"] + 1) * chunk] = np.frombuffer(row["bits"], np.uint8)
        ahead += row["ahead"]
    return dict.fromkeys(sizes, bits), ahead


def _rows(waiting: list[np.ndarray], ahead: int, log: int) -> pa.RecordBatch:
    """A task's own counts, a row for each hash partition."""
    keys, counts = np.unique(np.concatenate(waiting), return_counts=True)
    bounds = np.searchsorted(keys >> np.uint64(64 - log), np.arange((1 << log) + 1))
    parts = np.flatnonzero(np.diff(bounds))
    if not len(parts):
        parts = np.zeros(1, np.int64)
    keys = (keys >> np.uint64(32 - log)).astype("<u4")
    rows = [(keys[bounds[p] : bounds[p + 1]].tobytes(), *_bytes(counts[bounds[p] : bounds[p + 1]])) for p in parts]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([ahead] + [0] * (len(parts) - 1)), *(pa.array(c, pa.binary()) for c in zip(*rows, strict=True))],
                                      ["part", "ahead", "keys", "small", "large"])


def _bytes(counts: np.ndarray) -> tuple[bytes, bytes]:
    """Counts as a byte each; 0 stands for the next of those that do not fit one."""
    large = (counts == 0) | (counts > 255)
    return np.where(large, 0, counts).astype(np.uint8).tobytes(), counts[large].astype("<u8").tobytes()


def _numbers(small: bytes, large: bytes) -> np.ndarray:
    counts = np.frombuffer(small, np.uint8).astype(np.int64)
    counts[counts == 0] = np.frombuffer(large, "<u8")
    return counts


FOUND = "part int, lang string, phrases binary, small binary, large binary"


def _counts(docs: DataFrame, filters: dict[int, np.ndarray], mass: int, least: int, longest: int) -> DataFrame:
    """``lang, size, phrase, f``: exact numbers of the frequent phrases; size 0 has all words of a language."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = _parts(tasks, mass, least)
    shared = {n: spark.sparkContext.broadcast(bits) for n, bits in filters.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = {n: b.value for n, b in shared.items()}
        seen = Phrases(log)
        for batch in batches:
            for group, langs in _scan(batch):
                grams, text = Grams(group, langs), group.data.tobytes()
                for lang, n in zip(langs, np.bincount(group.text, minlength=group.texts).tolist(), strict=True):
                    seen.add(_code(lang), n, lang, "")
                # the words up to the next place where more than one blank lies between two
                plain = np.append((group.start[1:] - group.end[:-1] == 1) & (group.data[group.end[:-1]] == 32), False).cumsum()
                for n in range(1, longest + 1):
                    at = np.flatnonzero(grams.kept(n, have))
                    codes, first, numbers = np.unique(grams.keys(n)[at], return_index=True, return_counts=True)
                    for code, i, number in zip(codes.tolist(), at[first].tolist(), numbers.tolist(), strict=True):
                        if not seen.more(code, number):
                            last = i + n - 1
                            straight = plain[last - 1] - (plain[i - 1] if i else 0) == n - 1 if n > 1 else True
                            phrase = text[group.start[i] : group.end[last]] if straight else group.words(i, i + n)
                            seen.add(code, number, langs[group.text[i]], phrase.decode())
                if len(seen.place) > PHRASES:
                    yield seen.rows()
                    seen = Phrases(log)
        yield seen.rows()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[str, dict[str, int]] = {}
        for batch in batches:
            for lang, phrases, small, large in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
                of = merged.setdefault(lang, {})
                for phrase, n in zip(zlib.decompress(phrases).decode().split("\t"), _numbers(small, large).tolist(), strict=True):
                    of[phrase] = of.get(phrase, 0) + n
        for lang, of in merged.items():
            kept = [(p, n) for p, n in of.items() if n >= least or not p]
            for lo in range(0, len(kept), 50_000):
                phrases, numbers = zip(*kept[lo : lo + 50_000], strict=True)
                sizes = [p.count(" ") + 1 if p else 0 for p in phrases]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(sizes)), pa.array(sizes, pa.int32()), pa.array(phrases), pa.array(numbers, pa.int64())], ["lang", "size", "phrase", "f"])

    return docs.mapInArrow(run, FOUND).repartition(max(tasks, (1 << log) // 2), "part").mapInArrow(merge, "lang string, size int, phrase string, f bigint")


class Phrases:
    """What a task has counted: phrases by key."""

    def __init__(self, log: int):
        self.log = log
        self.place: dict[int, int] = {}
        self.names: list[tuple[str, str]] = []
        self.numbers: list[int] = []

    def more(self, code: int, number: int) -> bool:
        """Count a known phrase."""
        at = self.place.get(code)
        if at is not None:
            self.numbers[at] += number
        return at is not None

    def add(self, code: int, number: int, lang: str, phrase: str) -> None:
        if not self.more(code, number):
            self.place[code] = len(self.names)
            self.names.append((lang, phrase))
            self.numbers.append(number)

    def rows(self) -> pa.RecordBatch:
        """A row for each hash partition and language."""
        parts = (np.fromiter(self.place, np.uint64, len(self.place)) >> np.uint64(64 - self.log)).tolist()
        split: dict[tuple[int, str], list[tuple[str, int]]] = {}
        for part, (lang, phrase), number in zip(parts, self.names, self.numbers, strict=True):
            split.setdefault((part, lang), []).append((phrase, number))
        rows = []
        for (part, lang), found in split.items():
            phrases, numbers = zip(*sorted(found), strict=True)  # in order they are compressed best
            rows.append((part, lang, zlib.compress("\t".join(phrases).encode(), 1), *_bytes(np.array(numbers))))
        types = (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary())
        columns = list(zip(*rows, strict=True)) or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["part", "lang", "phrases", "small", "large"])


def _parts(tasks: int, mass: int, least: int) -> int:
    """Hash partitions, as a power of two."""
    return max(6, (4 * tasks - 1).bit_length(), (mass // (least * COUNTERS)).bit_length())


def frequent(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, size, phrase, f``: all phrases of up to ``longest`` words that occur ``least`` times, and size 0 for all words."""
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text <> ''")
    # between two words lies a byte at least
    mass = docs.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    filters: dict[int, np.ndarray] = {}
    mass = words = mass // 2
    for sizes in ((1,), (2,), tuple(range(3, longest + 1))):
        if sizes and sizes[0] <= longest:
            found, mass = _summaries(docs, sizes, filters, mass, least, filter_bits)
            filters |= found
    return materialize(_counts(docs, filters, words, least, longest), "phrases")


def _look_up(rows: DataFrame, part: str, table: DataFrame, name: str) -> DataFrame:
    """Add the number of the phrase in column ``part``; a phrase asked for by very many rows is dealt out by ``_salt``."""
    asked = rows.select("lang", part, "_salt").distinct()
    known = table.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    return rows.join(asked.join(known, ["lang", part]), ["lang", part, "_salt"])


def score(counts: DataFrame, covered: int = COVERED) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of all phrases not covered by a longer one, by the cut that scores lowest."""
    phrases = counts.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"))
    piece = lambda lo, n: F.array_join(F.slice("w", lo, n), " ")
    inner = phrases.where("size > 2").withColumn("w", F.split("phrase", " ")).withColumn("n", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("n") + 1)))
    longer = inner.select("lang", piece(F.col("at"), F.col("n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("_longer"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(f"_longer IS NULL OR CAST(100 AS DECIMAL(3)) * _longer < CAST({covered} AS DECIMAL(3)) * a")
    cuts = kept.withColumn("w", F.split("phrase", " ")).withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", piece(F.lit(1), F.col("k")).alias("left"), piece(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
                       F.pmod(F.xxhash64("phrase"), F.lit(64)).alias("_salt"))
    cuts = _look_up(_look_up(cuts, "left", counts.where("size > 0"), "l"), "right", counts.where("size > 0"), "r")
    whole = F.expr("CAST((CAST(2000000 AS DECIMAL(7)) * CAST(a AS DECIMAL(19))) DIV (CAST(l AS DECIMAL(19)) + CAST(r AS DECIMAL(19))) AS BIGINT)")
    best = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(whole.alias("score"), "k", "l", "r")).alias("m"))
    return best.select("lang", "phrase", "a", F.col("m.l").alias("l"), F.col("m.r").alias("r"), F.col("m.score").alias("score"))


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, covered: int = COVERED, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    counts = frequent(docs, least, longest, filter_bits)
    rows = score(counts, covered)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    for salts in (512, 16):
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(salts)))
        rows = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(f"_rank <= {top}")
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(f"rank <= {top}")
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
