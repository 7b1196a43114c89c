"""Removal of lines that many sites share (operator 6).

A line's spread is the number of distinct sites (``source``) it stands on. Each line hash gets a HyperLogLog
sketch of its sites; sketches merge in the aggregation, so a line that a third of all documents share is a
sketch per task before the shuffle. Lines whose estimate lies near the threshold get an exact distinct count;
the others are further from it than the sketch can err. Of a line on ``min_sites`` sites or more, the first
occurrence (smallest document, then line number) stays and all others go.

Edge cases: lines are compared without blanks at their ends, and lines without a word are neither counted nor
removed; a null text has no lines and stays null; a null site counts as the empty one; rows that share a
``doc_id`` lose their own lines only (removals are kept by ``doc_id`` and a hash of the text); rows with a null ``doc_id`` count towards the
spread, but keep their lines; an empty table gives an empty result; further columns are ignored by
``line_dedup`` and kept by ``dedup_documents``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort.session import materialize

MIN_SITES = 10
#: HyperLogLog registers as a power of two, and how many standard errors count as near.
SKETCH_K, NEAR = 12, 6
#: Rows of a batch that are cut at a time, so that few texts are Python strings at once.
ROWS = 256


def _lines(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id, site, line_no, h1, h2`` of all lines with a word, and ``more`` columns of their text."""
    rows = docs.select("doc_id", "site", *more, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    line = F.btrim("line", F.lit(" \t\r\x0b\x0c"))
    return rows.withColumn("line", line).where("line <> ''").select(*[c for c in rows.columns if c != "line"], F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def spread_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``h1, h2, first`` of the lines on at least ``min_sites`` sites, ``first`` being the occurrence to keep."""
    lines = _lines(docs)
    margin = max(1.0, NEAR * 1.04 / math.sqrt(1 << SKETCH_K) * min_sites)
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_agg("site", SKETCH_K).alias("sites"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "line_no"))).alias("first"))
    wide = spread.select("h1", "h2", "first", F.hll_sketch_estimate("sites").alias("sites")).where(F.col("sites") >= min_sites - margin)
    wide = materialize(wide, "spread")
    near = wide.where(F.col("sites") <= min_sites + margin).select("h1", "h2")
    sites = lines.select("h1", "h2", "site").join(near, ["h1", "h2"], "left_semi").distinct().groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("exact"))
    return wide.join(sites, ["h1", "h2"], "left").where(F.coalesce("exact", "sites") >= min_sites).select("h1", "h2", "first")


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("site"))


def removed_lines(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``drop_id, drop_code, drop``: per document and text that loses lines, their numbers."""
    prepared = _prepared(docs)
    wide = materialize(spread_lines(prepared, min_sites), "wide")
    gone = _lines(prepared.where("doc_id IS NOT NULL"), F.xxhash64("text").alias("code")).join(wide, ["h1", "h2"]).where((F.col("doc_id") != F.col("first.doc_id")) | (F.col("line_no") != F.col("first.line_no")))
    return gone.groupBy(F.col("doc_id").alias("drop_id"), F.col("code").alias("drop_code")).agg(F.collect_set("line_no").alias("drop"))


def _cut(text: str, drop: list[int]) -> tuple[str, int, int]:
    """The text without some of its lines, the lines with a word, and how many of them went."""
    lines, gone = text.split("\n"), set(drop)
    worded = sum(1 for line in lines if line.strip(" \t\r\x0b\x0c"))
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), worded, sum(1 for i in gone if i < len(lines))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from (batch.slice(lo, ROWS) for lo in range(0, batch.num_rows, ROWS))
    pa.default_memory_pool().release_unused()  # workers live on between tasks


def line_dedup(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``doc_id, n_lines, n_removed, text`` of every document."""
    drops = removed_lines(docs, min_sites)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            rows = [(None, 0, 0) if text is None else _cut(text, drop or []) for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            texts, lines, gone = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lines, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string())], ["doc_id", "n_lines", "n_removed", "text"])

    return docs.join(drops, (docs.doc_id == drops.drop_id) & (F.xxhash64(docs.text) == drops.drop_code), "left").select("doc_id", "text", "drop").mapInArrow(run, "doc_id bigint, n_lines bigint, n_removed bigint, text string")


def dedup_documents(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """The rows of ``docs`` with all their columns, the text without its removed lines.

    ``n_chars``, where it exists, follows the text. A document all of whose worded lines went is a copy of
    lines kept elsewhere and goes too.
    """
    drops, names, schema = removed_lines(docs, min_sites), docs.columns, docs.schema
    place = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            columns, kept, texts = list(batch.columns)[:-1], [], []
            for text, drop in zip(batch.column(place).to_pylist(), batch.column(len(names)).to_pylist(), strict=True):
                if drop and text is not None:
                    text, worded, gone = _cut(text, drop)
                    kept.append(gone < worded)
                else:
                    kept.append(True)
                texts.append(text)
            columns[place] = pa.array(texts, pa.string())
            if "n_chars" in names:
                at = names.index("n_chars")
                old = columns[at].to_pylist()
                columns[at] = pa.array([len(t) if d and t is not None else n for t, d, n in zip(texts, batch.column(len(names)).to_pylist(), old, strict=True)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(kept, pa.bool_()))

    extra = "_drop"
    while extra in names:
        extra += "_"
    joined = docs.join(drops, (docs["doc_id"] == drops["drop_id"]) & (F.xxhash64(docs["text"].cast("string")) == drops["drop_code"]), "left").select(*(docs[c] for c in names), drops["drop"].alias(extra))
    return joined.mapInArrow(run, schema)
