"""Sharding by jump consistent hashing (operator 3), in SQL functions only.

The shard follows from a row's key and the number of shards, without a ring table: the jump hash of Lamping
and Veach walks a pseudo-random sequence of ever larger jumps and keeps the last one inside the range. With
one more shard, the rows that move go to the new shard and nowhere else. Its 64-bit generator runs on two
32-bit halves, so that no product leaves a bigint.

Edge cases: a null key hashes as 0; equal keys share a shard; a null text has size 1 and the checksum of an
empty text, 0; repeated rows get different slots, and however many rows share an id, they are numbered by many tasks; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort.llm.shared import rank_within
from playcohort.session import materialize

#: The multiplier of the generator, fixed by the published algorithm.
MULTIPLIER = 2862933555777941757
#: Jumps tried in the common branch; about 14 reach a million shards.
USUAL_JUMPS = 64


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, from 0 to ``shards - 1``, of a bigint key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    mask, m_high, m_low = (1 << 32) - 1, MULTIPLIER >> 32, MULTIPLIER & ((1 << 32) - 1)
    low_mask = F.lit(mask)

    def times(x: Column, c: int) -> tuple[Column, Column]:
        """Low and high 32 bits of a 32-bit value times a 32-bit constant, without overflow."""
        low, high = x * F.lit(c & 0xFFFF), x * F.lit(c >> 16)
        bottom = low + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)
        return bottom.bitwiseAND(low_mask), F.shiftright(bottom, 32) + F.shiftright(high, 16)

    def step(s: Column, _: Column) -> Column:
        bottom, carry = times(s["l"], m_low)
        cross = times(s["h"], m_low)[0] + times(s["l"], m_high)[0]
        low = bottom + F.lit(1)
        high = (carry + cross + F.shiftright(low, 32)).bitwiseAND(low_mask)
        low = low.bitwiseAND(low_mask)
        jump = ((s["j"] + F.lit(1)).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + F.lit(1)).cast("double"))).cast("long")
        moved = F.struct(high.alias("h"), low.alias("l"), s["j"].alias("b"), jump.alias("j"))
        return F.when(s["j"] < F.lit(shards), moved).otherwise(s)

    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("h"), key.bitwiseAND(low_mask).alias("l"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
    )

    def walk(jumps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(jumps)), start, step)

    # Every jump is at least one shard, so `shards` of them always suffice.
    if shards <= USUAL_JUMPS:
        return walk(shards)["b"].cast("int")
    usual = walk(USUAL_JUMPS)
    return F.when(usual["j"] >= F.lit(shards), usual["b"]).otherwise(walk(shards)["b"]).cast("int")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` of every document."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + F.lit(1).cast("long")
    keyed = docs.select(
        F.col("doc_id").cast("long"), size.alias("size"), F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        jump_shard(F.col("doc_id"), shards).alias("shard"), jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"), F.monotonically_increasing_id().alias("row"),
    )
    # A number per row, fixed by writing it, spreads rows that agree in everything else.
    keyed = materialize(keyed, "keyed")
    return rank_within(keyed, "shard", ["doc_id", "row"], "slot", keyed.count()).drop("row")
