"""Removal of long repeated passages by difference-cover anchors (operator 4).

A word goes when some window of ``length`` consecutive words that covers it also starts in a document with a
smaller id. Hashing every window of the corpus would shuffle a row per word. Instead, only words whose place
modulo a period is in a difference cover carry an anchor, the hash of a shorter window that starts there: for
any two places there is a shift below the period that takes both into the cover, so two equal long windows
always share an anchor at the same distance from their starts. Anchors met once are dropped; around the others
the long windows are hashed with 96 bits and the smallest document of each hash is found.

Windows and anchors that a task sees several times are settled there, and one row of them is shuffled: a
passage that a third of all documents share meets in one place as often as there are batches, not
documents. Of the texts, only those with a shared anchor are shuffled, once: both joins read the same exchange.

Edge cases: a null or empty text has no words; a document shorter than the window is kept; a window repeated
inside one document alone is kept; equal rows stay as they are (no smaller id); texts that share a ``doc_id``
are judged each by its own windows (removals are kept by ``doc_id`` and a hash of the text); rows with a null ``doc_id`` are kept whole and remove
nothing; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playcohort.llm.shared import small_enough
from playcohort.llm.words import SECOND_BASE, groups, mix, signed
from playcohort.session import materialize

LENGTH = 50
#: A perfect difference set: every shift modulo 31 is the difference of two of its members.
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)


def _settle(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Group equal keys: an order of the rows, where each group begins in it, each row's group, and each group's smallest document."""
    order = np.lexsort((doc, key))
    sorted_key = key[order]
    begin = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1]))) if len(key) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(key))))
    return order, begin, group, doc[order][begin]


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _rows(names: list[str], *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    for lo in range(0, len(columns[0]), 1 << 17):
        yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + (1 << 17)]) for c in columns], names)


def _anchors(length: int):
    size, cover = length - PERIOD + 1, np.isin(np.arange(PERIOD), COVER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``key, doc, place, known``: known anchors have a partner in their batch already."""
        for batch in batches:
            ids, parts = _ids(batch), []
            for group in groups(batch.column(1)):
                place, words = group.place(), np.diff(group.word_start)
                n = len(place)
                at = np.flatnonzero(cover[place % PERIOD] & (words[group.text] >= length))
                at = at[at + size <= n]
                at = at[group.text[at] == group.text[at + size - 1]]
                if len(at):
                    parts.append((group.window_hash(at, size), ids[group.first + group.text[at]], place[at]))
            if not parts:
                continue
            key, doc, place = (np.concatenate(p) for p in zip(*parts, strict=True))
            order, begin, of, _ = _settle(key, doc)
            many = np.diff(np.append(begin, len(key))) > 1
            known = order[many[of]]
            first = order[begin]
            own = mix(mix(doc[known].view(np.uint64)) + place[known].astype(np.uint64))
            yield from _rows(
                ["key", "doc", "place", "known"],
                signed(np.concatenate((key[first], own))), np.concatenate((doc[first], doc[known])),
                np.concatenate((place[first], place[known])).astype(np.int32), np.repeat([False, True], [len(first), len(known)]),
            )

    return run


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``key, more, doc, place, known, code``: the long windows around shared anchors; known ones go already."""
        size = length - PERIOD + 1
        for batch in batches:
            ids, parts = _ids(batch), []
            texts = batch.column(3).to_numpy(zero_copy_only=False).astype(np.int64)
            for group in groups(batch.column(1)):
                first, n = group.word_start, len(group.hash)
                near = np.zeros(n + 1, np.int64)
                for i in range(group.texts):
                    anchors = np.asarray(batch.column(2)[group.first + i].values.to_numpy(), np.int64) + first[i]
                    anchors = anchors[anchors < first[i + 1]]
                    np.add.at(near, np.maximum(anchors - (length - size), first[i]), 1)
                    np.add.at(near, anchors + 1, -1)
                at = np.flatnonzero(np.cumsum(near)[:n] > 0)
                at = at[at + length <= n]
                at = at[group.text[at] == group.text[at + length - 1]]
                if len(at):
                    parts.append((group.window_hash(at, length), group.window_hash(at, length, SECOND_BASE), ids[group.first + group.text[at]], (at - first[group.text[at]]), texts[group.first + group.text[at]]))
            if not parts:
                continue
            key, more, doc, place, code = (np.concatenate(p) for p in zip(*parts, strict=True))
            order, begin, of, least = _settle(key, doc)
            known = np.zeros(len(key), bool)
            # The second hash must agree as well before a window counts as settled.
            known[order] = (doc[order] > least[of]) & (more[order] == more[order[begin]][of])
            own = mix(mix(doc[known].view(np.uint64)) + place[known].astype(np.uint64))
            key, more = key.copy(), more.copy()
            key[known], more[known] = own, 0
            yield from _rows(["key", "more", "doc", "place", "known", "code"], signed(key), (more >> np.uint64(32)).astype(np.uint32).view(np.int32), doc, place.astype(np.int32), known, code)

    return run


def _keep(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """``doc_id, n_words, n_removed, removed, text``: what is left, joined by one space."""
    spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    for batch in batches:
        out: list[tuple] = []
        for doc_id, text, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            words = (text.as_py() or "").encode().split()
            removed: list[dict] = []
            if places.is_valid:
                for place in np.unique(places.values.to_numpy()).tolist():
                    if place + length > len(words):
                        continue
                    if removed and place <= removed[-1]["last"]:
                        removed[-1]["last"] = place + length
                    else:
                        removed.append({"first": place, "last": place + length})
            left, lo = [], 0
            for span in removed:
                left += words[lo : span["first"]]
                lo = span["last"]
            left += words[lo:]
            out.append((doc_id, len(words), len(words) - len(left), removed, b" ".join(left).decode()))
            if len(out) == 512:
                yield _table(out, spans)
                out = []
        if out:
            yield _table(out, spans)


def _table(rows: list[tuple], spans: pa.DataType) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), spans, pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "n_words", "n_removed", "removed", "text"])


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, removed, text`` of every document.

    ``removed`` holds spans [first, last) of words, ``text`` the kept words joined by one space. ``length`` must
    be at least ``PERIOD + 1`` words.
    """
    if length <= PERIOD:
        raise ValueError(f"a window must be longer than {PERIOD} words")
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    named = docs.where("doc_id IS NOT NULL")
    anchors = named.mapInArrow(_anchors(length), "key bigint, doc bigint, place int, known boolean")
    of_key = Window.partitionBy("key")
    shared = (
        anchors.withColumn("low", F.min("doc").over(of_key)).withColumn("high", F.max("doc").over(of_key)).where("known OR low < high")
        .groupBy("doc").agg(F.collect_list("place").alias("places"))
    )
    shared = materialize(shared, "anchors")
    texts, rest = _with_anchors(docs, named, materialize(shared.select("doc"), "anchored"))
    texts = texts.repartition("doc_id")  # one exchange serves both joins
    around = texts.join(shared, texts.doc_id == shared.doc).select("doc_id", "text", "places", F.xxhash64("text").alias("code"))
    windows = around.mapInArrow(_windows(length), "key bigint, more int, doc bigint, place int, known boolean, code bigint")
    of_window = Window.partitionBy("key", "more")
    removed = (
        windows.withColumn("low", F.min("doc").over(of_window)).where("known OR low < doc")
        .groupBy("doc").agg(F.collect_list(F.struct("place", "code")).alias("found"))
    )
    # the join is by document, so that it reads the exchange of the texts; a text takes the places found in it
    places = F.expr("transform(filter(found, x -> x.code = xxhash64(text)), x -> x.place)").alias("places")
    with_places = texts.join(removed, texts.doc_id == removed.doc, "left").select("doc_id", "text", places)
    rest = rest.select("doc_id", "text", F.lit(None).cast("array<int>").alias("places"))
    schema = "doc_id bigint, n_words bigint, n_removed bigint, removed array<struct<first:bigint,last:bigint>>, text string"
    keep = lambda batches: _keep(batches, length)
    return with_places.mapInArrow(keep, schema).unionByName(rest.mapInArrow(keep, schema))


def _with_anchors(docs: DataFrame, named: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents that may lose words, the others). Where the first are few, the texts of the others stay where they are."""
    few = small_enough(ids)
    if few is ids:
        return named, docs.where("doc_id IS NULL")
    return named.join(few, named.doc_id == few.doc, "left_semi"), docs.join(few, docs.doc_id == few.doc, "left_anti")
