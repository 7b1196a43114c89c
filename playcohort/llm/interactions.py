"""Filter interaction audit by higher-order SQL folds (operator 12).

Each document gets a mask of the five filters it fails. Documents with the same part, mask and labels form a cell, so
all that follows sees at most 32 x 4 cells of a part, whatever the size of the corpus. A cell folds across the array of
all 120 filter orders, a constant of the plan: ``transform`` goes over the orders, ``aggregate`` over the five filters of
one order, carrying the filters applied so far. This makes 600 structs weighted by the cell's documents; the cells of a
part are merged by elementwise sums. The Shapley sums are read off the merged removals.

Filter E needs the smallest ``doc_id`` of every text. It comes from a grouped minimum over digests (combined on the map
side) and goes back by a join on digest *and* ``doc_id``: only first documents match, so a text with very many copies is
dealt out by its documents and no task holds a group of copies. Equal slim rows are counted before each join.

Edge cases: a null text counts as empty, and so do its copies; a null ``source`` is the part ``''``, together with an
empty one; rows of equal ``doc_id`` count each, and a copy under the same ``doc_id`` has no smaller one; a row without
``doc_id`` has no place in the order: it never fails E, is nobody's original and has no labels; several label rows of one
document count as one, with the highest values; null labels are 0; an empty table has no parts and gives no rows; further
columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort.session import materialize

FILTERS = "ABCDE"
ORDERS = tuple("".join(order) for order in permutations(FILTERS))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
#: Separators of ``[^\\x20\\x09-\\x0D]+``, as a pattern.
SEPARATORS = r"[\x20\x09-\x0D]+"


def text_failures(text: str = "text") -> str:
    """SQL: the filters A to D that a text fails, as bits 1, 2, 4, 8; ``_words`` are its words."""
    return f"""
        if(size(_words) < 50, 1, 0) + if(100 * size(array_distinct(_words)) < 65 * size(_words), 2, 0)
        + if(100L * (char_length({text}) - char_length(regexp_replace({text}, '[A-Z]', ''))) > 5L * char_length({text}), 4, 0)
        + if({text} RLIKE '[#$%&*|]', 8, 0)"""


def masks(docs: DataFrame) -> DataFrame:
    """``part, doc_id, digest, mask, n``: equal rows once, with their number; ``mask`` holds the filters A to D."""
    rows = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("_words", F.filter(F.split("text", SEPARATORS), lambda w: w != ""))
    # the generator keeps the optimizer from splitting the text once for every use of its words
    rows = rows.select("part", "doc_id", "text", F.explode(F.array("_words")).alias("_words"))
    rows = rows.select("part", "doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), F.expr(text_failures()).alias("mask"))
    return rows.groupBy("part", "doc_id", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by failed filters, and how many of them are labelled good or toxic."""
    slim = materialize(masks(docs), "filter-masks")
    known = slim.where("doc_id IS NOT NULL")
    first = known.groupBy(F.col("digest").alias("_digest")).agg(F.min("doc_id").alias("_first"))
    known = known.join(first, (F.col("digest") == F.col("_digest")) & (F.col("doc_id") == F.col("_first")), "left")
    copy = F.when(F.col("_first").isNull(), 16).otherwise(0)
    known = known.groupBy("part", "doc_id", (F.col("mask") + copy).alias("mask")).agg(F.sum("n").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("long")).alias("_good"), F.max((F.col("toxic") == 1).cast("long")).alias("_toxic"))
    known = known.join(marks, F.col("doc_id") == F.col("_id"), "left")
    mark = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    rows = known.select("part", "mask", "n", (mark(F.col("_good")) * F.col("n")).alias("good"), (mark(F.col("_toxic")) * F.col("n")).alias("toxic"))
    nobody = slim.where("doc_id IS NULL").select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return rows.unionByName(nobody).groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


_STEPS = f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>"
#: One cell along one order ``o`` of filter bits: a struct for each step.
_FOLD = f"""
    aggregate(o, named_struct('seen', 0, 'steps', cast(array() AS {_STEPS})),
        (acc, f) -> named_struct('seen', acc.seen | f, 'steps', concat(acc.steps, array(named_struct(
            'kept', if((c.mask & (acc.seen | f)) = 0, c.n, 0L),
            'removed', if((c.mask & f) <> 0 AND (c.mask & acc.seen) = 0, c.n, 0L),
            'redundant', if((c.mask & f) <> 0 AND (c.mask & acc.seen) <> 0, c.n, 0L),
            'unique_fails', if(c.mask = f, c.n, 0L),
            'good_lost', if((c.mask & f) <> 0 AND (c.mask & acc.seen) = 0, c.good, 0L),
            'toxic_lost', if((c.mask & f) <> 0 AND (c.mask & acc.seen) = 0, c.toxic, 0L))))),
        acc -> acc.steps)"""
_SUM = "named_struct(" + ", ".join(f"'{c}', x.{c} + y.{c}" for c in COUNTS) + ")"
_ZERO = "named_struct(" + ", ".join(f"'{c}', 0L" for c in COUNTS) + ")"


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, filter_order, step`` and the counts of each step, for every part and every order of the filters."""
    bits = "array(" + ", ".join("array(" + ", ".join(str(1 << FILTERS.index(f)) for f in order) + ")" for order in ORDERS) + ")"
    parts = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))  # 32 at most
    parts = parts.select("part", "cells", F.expr(bits).alias("orders"))
    merged = parts.select("part", F.expr(f"""
        aggregate(cells, transform(sequence(1, {len(ORDERS) * len(FILTERS)}), i -> {_ZERO}),
            (total, c) -> zip_with(total, flatten(transform(orders, o -> {_FOLD})), (x, y) -> {_SUM}))""").alias("steps"))
    names = "array(" + ", ".join(f"'{order}'" for order in ORDERS) + ")"
    shares = f"""
        transform(sequence(1, {len(FILTERS)}), f -> aggregate(filter(steps, (s, i) -> substring({names}[i div {len(FILTERS)}], i % {len(FILTERS)} + 1, 1) = substring('{FILTERS}', f, 1)),
            0L, (total, s) -> total + s.removed))"""
    merged = merged.withColumn("_shares", F.expr(shares))
    steps = merged.select("part", "_shares", F.posexplode("steps").alias("_at", "s")).select(
        "part", "_shares", F.expr(f"{names}[_at div {len(FILTERS)}]").alias("filter_order"), (F.col("_at") % len(FILTERS) + 1).cast("int").alias("step"), "s.*")
    shapley = F.expr(f"_shares[instr('{FILTERS}', substring(filter_order, step, 1)) - 1]")
    return steps.select("part", "filter_order", "step", *COUNTS, shapley.alias("shapley"))
