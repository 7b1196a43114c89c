"""Ranks inside hot groups and connected components, both without a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playcohort.session import materialize

ROWS_PER_BUCKET = 2_000
#: A list of ids is broadcast up to this many rows, some tens of MB; a longer one is joined by a shuffle.
BROADCAST_IDS = 1_000_000


def rank_within(df: DataFrame, group: str, order: list[str], rank: str, total: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in an order fixed by a hash of ``order``.

    A group is split into buckets by that hash. Only counts of (group, bucket) meet in one place; the rows
    themselves are numbered inside their bucket, so a group with a third of all rows is spread over as many
    tasks as it has buckets. Rows equal in all of ``order`` get different numbers in any order. ``df`` is read
    twice and must give the same rows both times.
    """
    buckets = max(1, -(-total // rows_per_bucket))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = df.groupBy(F.col(group).alias("_group"), F.col("_bucket").alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("_base", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    inside = Window.partitionBy(group, "_bucket").orderBy(*order)
    ranked = df.withColumn("_inside", F.row_number().over(inside))
    return (
        ranked.join(counts, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_part")))
        .withColumn(rank, (F.col("_base") + F.col("_inside") - 1).cast("long"))
        .drop("_group", "_part", "_rows", "_base", "_inside", "_bucket")
    )


def small_enough(ids: DataFrame) -> DataFrame:
    """Written ids, to be broadcast if they are few enough; their number is counted first."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def only_ids(rows: DataFrame, key: str, ids: DataFrame, id_key: str, how: str = "inner") -> DataFrame:
    """Join rows with written ids; where these are few, the rows (and their texts) are not shuffled."""
    return rows.join(small_enough(ids), rows[key] == ids[id_key], how)


def components(edges: DataFrame, a: str, b: str, purpose: str = "components") -> DataFrame:
    """``node, component`` for every node of an undirected graph; the component is its smallest node.

    Alternating large-star and small-star rounds: each links a node's neighbours to the smallest one, which
    halves paths. A round is two aggregations and joins by node. The smallest neighbour comes from ``min``,
    which combines before the shuffle, so a node with very many neighbours is never a list in one task. Each
    round is written to the shared folder; the loop ends when only stars are left.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = materialize(pairs, purpose)
    while not _stars_only(pairs):
        pairs = materialize(_star(_star(pairs, large=True), large=False), purpose)
    centres = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(centres)


def _stars_only(pairs: DataFrame) -> bool:
    """True if every node has one smaller neighbour at most, and a node with one is nobody's centre."""
    ends = pairs.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("centre")).unionByName(pairs.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("centre")))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("centre").alias("centre"))
    return nodes.where("up > 1 OR (up = 1 AND centre = 1)").isEmpty()


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """Link neighbours to the smallest: the larger neighbours (large) or the smaller ones and the node itself."""
    if large:
        both = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("c")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        out = both.join(least, both.u == least.c).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = pairs.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
        out = pairs.join(least, pairs.u == least.c).select(F.col("v").alias("u"), F.col("m").alias("v"))
        out = out.unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()
