"""Quality rules as a short-circuit cascade (operator 9).

A document is kept when it passes every rule, so the rules may run in any order and the verdicts never
depend on it; the cost does. On a bounded sample, executors time every rule and count what it rejects; the
cascade then runs the rules by rejections per second, and each rule sees only what the earlier ones left.

Edge cases: a null or empty text has no words and is rejected by ``few_words``; ties in rejections per cost
keep the order of ``RULES``; repeated rows are judged each; a null ``doc_id`` stays null; an empty table gives
an empty result; further columns are ignored by ``judge`` and kept by ``keep_documents``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort.llm.words import Group, groups, mix

#: At most about so many documents are timed to order the rules; no verdict depends on them.
SAMPLE_DOCUMENTS = 2_000
SYMBOLS = b"#*$%&|<>"
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _once(count: Callable[[Texts], np.ndarray]) -> Callable[[Texts], np.ndarray]:
    @wraps(count)
    def get(self: Texts) -> np.ndarray:
        if count.__name__ not in self.made:
            self.made[count.__name__] = count(self)
        return self.made[count.__name__]

    return get


class Texts:
    """The texts of a group, some of them selected; every count is made when first asked for, and kept."""

    def __init__(self, group: Group, rows: np.ndarray | None = None, made: dict[str, np.ndarray] | None = None):
        self.group, self.rows, self.made = group, np.arange(group.texts) if rows is None else rows, made or {}

    def only(self, keep: np.ndarray) -> Texts:
        """Some of these texts, with the counts made so far."""
        return Texts(self.group, self.rows[keep], {name: values[keep] for name, values in self.made.items()})

    def raw(self) -> Iterator[bytes]:
        data, at = self.group.data, self.group.text_start
        return (data[at[i] : at[i + 1]].tobytes() for i in self.rows)

    def _each(self, count: Callable[[bytes], int]) -> np.ndarray:
        return np.fromiter(map(count, self.raw()), np.int64, len(self.rows))

    @_once
    def n_words(self) -> np.ndarray:
        return np.diff(self.group.word_start)[self.rows]

    @_once
    def word_chars(self) -> np.ndarray:
        """Code points inside words."""
        return self._each(lambda b: len(b.translate(None, BLANK).decode()))

    @_once
    def n_symbols(self) -> np.ndarray:
        return self._each(lambda b: len(b) - len(b.translate(None, SYMBOLS)))

    @_once
    def n_dup_lines(self) -> np.ndarray:
        def count(b: bytes) -> int:
            lines = [line for line in b.split(b"\n") if line and not line.isspace()]
            return len(lines) - len(set(lines))

        return self._each(count)

    @_once
    def n_lines(self) -> np.ndarray:
        return self._each(lambda b: sum(1 for line in b.split(b"\n") if line and not line.isspace()))

    @_once
    def n_repeat_words(self) -> np.ndarray:
        """Words inside 3-word windows that stand in the text twice or more."""
        group = self.group
        wanted = np.zeros(group.texts, bool)
        wanted[self.rows] = True
        at, code = group.windows(3)
        of = group.text[at]
        at, code, of = at[wanted[of]], code[wanted[of]], of[wanted[of]]
        key = mix(code + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
        at = at[times[inverse] > 1]
        hit = np.zeros(len(group.hash), bool)
        for k in range(3):
            hit[at + k] = True
        return np.bincount(group.text[hit], minlength=group.texts)[self.rows]

    @_once
    def n_upper(self) -> np.ndarray:
        return self._each(lambda b: len(b) - len(b.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")))

    @_once
    def n_digits(self) -> np.ndarray:
        return self._each(lambda b: len(b) - len(b.translate(None, b"0123456789")))


#: Each rule returns True for the texts it rejects.
RULES: dict[str, Callable[[Texts], np.ndarray]] = {
    "few_words": lambda t: t.n_words() < 50,
    "repeated_words": lambda t: 100 * t.n_repeat_words() > 50 * t.n_words(),
    "symbols": lambda t: 10 * t.n_symbols() > 3 * t.n_words(),
    "repeated_lines": lambda t: 2 * t.n_dup_lines() > t.n_lines(),
    "word_length": lambda t: (t.word_chars() < 2 * t.n_words()) | (t.word_chars() > 15 * t.n_words()),
    "upper_case": lambda t: 2 * t.n_upper() > t.word_chars(),
    "digits": lambda t: 2 * t.n_digits() > t.word_chars(),
}


def measure(docs: DataFrame, rules: dict[str, Callable[[Texts], np.ndarray]], documents: int = SAMPLE_DOCUMENTS) -> dict[str, tuple[float, float]]:
    """Per rule: seconds a document and the share it rejects, on a sample of about ``documents`` texts.

    The sample is drawn row by row, whatever the ids; tasks time the rules and return sums, never texts.
    """
    total = docs.count()
    names = list(rules)

    def timed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, seconds, rejected = 0, np.zeros(len(names)), np.zeros(len(names))
        for batch in batches:
            for group in groups(batch.column(0)):
                seen += group.texts
                for i, name in enumerate(names):
                    start = time.thread_time()
                    rejected[i] += rules[name](Texts(group)).sum()
                    seconds[i] += time.thread_time() - start
        yield pa.RecordBatch.from_arrays([pa.array(range(len(names)), pa.int32()), pa.array([seen] * len(names)), pa.array(seconds), pa.array(rejected)], ["rule", "seen", "seconds", "rejected"])

    sample = docs.select(F.col("text").cast("string")).sample(fraction=min(1.0, documents / max(1, total)), seed=9)
    sums = sample.mapInArrow(timed, "rule int, seen bigint, seconds double, rejected double").groupBy("rule").agg(F.sum("seen"), F.sum("seconds"), F.sum("rejected")).collect()
    return {names[rule]: (seconds / max(1, seen), rejected / max(1, seen)) for rule, seen, seconds, rejected in sums}


def cascade(measured: dict[str, tuple[float, float]], rules: dict[str, Callable[[Texts], np.ndarray]] = RULES) -> list[str]:
    """Rule names by rejections per cost, highest first."""
    return sorted(rules, key=lambda name: -(measured.get(name, (0.0, 0.0))[1] / max(measured.get(name, (0.0, 0.0))[0], 1e-9)))


def verdicts(group: Group, order: list[str], rules: dict[str, Callable[[Texts], np.ndarray]] = RULES) -> np.ndarray:
    """True for the texts of a group that pass every rule; a rejected text meets no further rule."""
    return _passed(Texts(group), order, rules)


def _passed(texts: Texts, order: list[str], rules: dict[str, Callable[[Texts], np.ndarray]]) -> np.ndarray:
    """As ``verdicts``, of a whole group's texts; counts made before are used."""
    kept = np.zeros(texts.group.texts, bool)
    for name in order:
        if not len(texts.rows):
            break
        texts = texts.only(~rules[name](texts))
    kept[texts.rows] = True
    return kept


def judge(docs: DataFrame, rules: dict[str, Callable[[Texts], np.ndarray]] = RULES, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """``doc_id``, the five counts, ``base_failed`` and ``kept`` of every document."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = cascade(measure(docs, rules, sample), rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch.column(1)):
                texts = Texts(group)
                counts = {name: getattr(texts, name)() for name in COUNTS}
                failed = (counts["n_words"] < 50) | (100 * counts["n_repeat_words"] > 50 * counts["n_words"])
                kept = _passed(texts, order, rules) & ~failed
                ids = batch.column(0).slice(group.first, group.texts)
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, counts.values()), pa.array(failed), pa.array(kept)], ["doc_id", *counts, "base_failed", "kept"])

    return docs.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", base_failed boolean, kept boolean")


def keep_documents(docs: DataFrame, rules: dict[str, Callable[[Texts], np.ndarray]] = RULES, sample: int = SAMPLE_DOCUMENTS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that pass every rule: one pass, nothing shuffled."""
    order, place = cascade(measure(docs, rules, sample), rules), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [verdicts(group, order, rules) for group in groups(batch.column(place))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(run, docs.schema)
