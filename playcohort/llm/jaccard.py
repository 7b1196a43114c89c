"""Exact n-gram Jaccard join and near-duplicate groups (operator 2).

Two documents link when their sets of distinct ``WORDS``-word shingles have a Jaccard similarity of at least
``PERCENT`` percent. Equal sets are one class first, so a text copied any number of times is handled once.

* **Tiles.** Shingles are ordered by how common they are, rare ones first; linked sets must share one of the
  first ``n - ceil(t * n) + 1`` of theirs. How common a shingle is comes from a count sketch of fixed size over
  all documents: any fixed order is exact, a good one keeps passages that many documents share out of the
  tiles. A tile is a shared shingle within a band of set sizes a factor ``1 / t`` wide; only the same and the
  next band can link.
* **Bitmaps.** Each set has a parity bitmap with about two bits a shingle. Unequal bits are at most the unequal
  shingles, so their count bounds the overlap from above; pairs that fail the bound are dropped before any text
  moves.
* **Intersection.** What is left is decided by intersecting the sorted arrays of shingle hashes.

A large tile is not turned into all its pairs. Tiles of up to three sets give all of them; in larger ones each
set meets the pivot of its tile, most often the text that near copies were made from, which joins groups of them
with a comparison a member. Then, in large tiles that still hold several components, the pairs of different
components are compared, exhaustively, so no link between components is lost.

Edge cases: A-Z count as lower case; a text of fewer words than a shingle is one shingle; a null or empty text
has the empty set and links with nothing; equal rows and texts are one class; a null ``doc_id`` links with
nothing and keeps a null component; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from playcohort.llm.shared import components, only_ids, small_enough
from playcohort.llm.words import Group, groups, mix, signed
from playcohort.session import materialize

WORDS, PERCENT = 5, 75
#: The count sketch: cells, and the pieces it is summed in.
SKETCH_BITS, CHUNKS = 20, 64
#: Tiles of up to this many sets are compared completely at once.
COMPLETE = 3


def shingles(group: Group, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts of a group in order of (text, hash), and where each text begins."""
    at, code = group.windows(size)
    text, first = group.text[at], group.word_start
    words = np.diff(first)
    for n in range(1, size):
        short = np.flatnonzero(words == n)
        if len(short):
            code = np.concatenate((code, group.window_hash(first[short], n)))
            text = np.concatenate((text, short))
    order = np.lexsort((code, text))
    code, text = code[order], text[order]
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
    code, text = code[new], text[new]
    return code, np.searchsorted(text, np.arange(group.texts + 1))


def set_ids(code: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set that does not depend on the order; 0 for the empty set."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(code ^ np.uint64(0xA0761D6478BD642F)), dtype=np.uint64)))
    return np.where(np.diff(bounds) > 0, mix(sums[bounds[1:]] - sums[bounds[:-1]]), np.uint64(0))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``doc_id, sid, n, bits`` of documents, and at the end the count sketch of the task in chunks."""
    names = ["doc_id", "sid", "n", "bits", "chunk", "counts"]
    cells = np.zeros(1 << SKETCH_BITS, np.uint64)
    for batch in batches:
        seen: set[int] = set()
        for group in groups(batch.column(1), lower=True):
            code, bounds = shingles(group)
            ids, n = set_ids(code, bounds), np.diff(bounds)
            bits = [parity_bits(code[bounds[i] : bounds[i + 1]]) if n[i] else None for i in range(group.texts)]
            new = [i for i, x in enumerate(ids.tolist()) if not (x in seen or seen.add(x))]
            if len(new) < group.texts:
                fresh = np.zeros(group.texts, bool)
                fresh[new] = True
                code = code[np.repeat(fresh, n)]
            cells += np.bincount((code >> np.uint64(64 - SKETCH_BITS)).view(np.int64), minlength=len(cells)).astype(np.uint64)
            empty = pa.nulls(group.texts)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(group.first, group.texts), pa.array(signed(ids)), pa.array(n.astype(np.int32)), pa.array(bits, pa.list_(pa.int64())),
                    empty.cast(pa.int32()), empty.cast(pa.binary()),
                ],
                names,
            )
    if cells.any():
        blobs = [zlib.compress(part.tobytes(), 1) for part in np.split(cells, CHUNKS)]
        none = pa.nulls(CHUNKS)
        columns = [none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.list_(pa.int64())), pa.array(range(CHUNKS), pa.int32()), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names)


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sum the chunks of a partition as they stream by."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            part = np.frombuffer(zlib.decompress(blob.as_py()), np.uint64)
            sums[chunk] = sums[chunk] + part if chunk in sums else part
    if sums:
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([zlib.compress(x.tobytes(), 1) for x in sums.values()], pa.binary())], ["chunk", "counts"])


def count_sketch(sets: DataFrame) -> np.ndarray:
    """How many shingles of all sets fall into each cell: 2**SKETCH_BITS numbers, whatever the corpus."""
    parts = sets.where("chunk IS NOT NULL").select("chunk", "counts")
    schema = "chunk int, counts binary"
    some = parts.repartition("chunk", F.spark_partition_id() % 16).mapInArrow(_add, schema)
    rows = some.repartition("chunk").mapInArrow(_add, schema).collect()  # CHUNKS rows
    cells = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.uint64)
    for chunk, counts in rows:
        cells[chunk] += np.frombuffer(zlib.decompress(counts), np.uint64)
    return np.minimum(cells.ravel(), (1 << 31) - 1).astype(np.int64)


def _prefixes(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``token, sid, n, pos``: the rarest shingles of each set, as many as a linked set cannot miss, and their rank in it."""
        cells = shared.value
        for batch in batches:
            seen: set[int] = set()
            for group in groups(batch.column(0), lower=True):
                code, bounds = shingles(group)
                ids, n = set_ids(code, bounds), np.diff(bounds)
                owner = np.repeat(np.arange(group.texts), n)
                common = cells[(code >> np.uint64(64 - SKETCH_BITS)).view(np.int64)]
                code = code[np.argsort((owner << 32) | common, kind="stable")]
                keep = n - (PERCENT * n + 99) // 100 + 1
                keep[n == 0] = 0
                for i, x in enumerate(ids.tolist()):
                    if x in seen:
                        keep[i] = 0
                    seen.add(x)
                pos = np.arange(len(code)) - bounds[owner]
                rows = pos < keep[owner]
                owner = owner[rows]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(code[rows])), pa.array(signed(ids)[owner]), pa.array(n[owner].astype(np.int32)), pa.array(np.minimum(pos[rows], 32767).astype(np.int16))],
                    ["token", "sid", "n", "pos"],
                )

    return run


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``node, words``: the compressed words of the documents that have the wanted set."""
    for batch in batches:
        wanted = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        for group in groups(batch.column(1), lower=True):
            code, bounds = shingles(group)
            ids, n, first = signed(set_ids(code, bounds)), np.diff(bounds), group.word_start
            rows = [i for i in range(group.texts) if n[i] and ids[i] == wanted[group.first + i]]
            words = [zlib.compress(group.words(first[i], first[i + 1]), 1) for i in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(group.first, group.texts).take(pa.array(rows, pa.int64())), pa.array(words, pa.binary())], ["node", "words"])


def parity_bits(code: np.ndarray) -> np.ndarray:
    """A bit is set when an odd number of shingles hash to it; the length is a power of two, two bits a shingle at least."""
    size = max(64, 1 << int(2 * len(code) - 1).bit_length())
    odd = np.bincount((mix(code) & np.uint64(size - 1)).view(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def may_link(bits_a: Column, bits_b: Column, n_a: Column, n_b: Column) -> Column:
    """False only if the bitmaps prove the overlap too small. Needs set sizes within a factor of 2."""
    short = F.least(F.size(bits_a), F.size(bits_b))

    def fold(x: Column) -> Column:  # the parity bitmap of half the length is the exclusive or of the halves
        return F.when(F.size(x) == short, x).otherwise(F.zip_with(F.slice(x, F.lit(1), short), F.slice(x, short + 1, short), lambda p, q: p.bitwiseXOR(q)))

    unequal = F.aggregate(F.zip_with(fold(bits_a), fold(bits_b), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + x)
    # overlap <= (n_a + n_b - unequal) / 2, and 100 * overlap >= P * union is (100 + P) * overlap >= P * (n_a + n_b)
    return (n_a + n_b - unequal) * F.lit(100 + PERCENT) >= (n_a + n_b) * F.lit(2 * PERCENT)


def fits(n_a: Column, n_b: Column) -> Column:
    return F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * PERCENT


def may_overlap(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column) -> Column:
    """False only if the sets cannot link when the shingle of these ranks is the first they share.

    All sets rank shingles alike, so nothing before the ranks is shared and what is left bounds the overlap. A pair
    refused in the tile of a later shingle is judged in that of its first, which is among the rarest of both.
    """
    return F.least(n_a - pos_a, n_b - pos_b).cast("long") * F.lit(100 + PERCENT) >= (n_a + n_b).cast("long") * F.lit(PERCENT)


def _codes(words: pa.Array) -> list[np.ndarray]:
    """The sorted shingle hashes of compressed texts."""
    out = []
    for group in groups(pa.array([zlib.decompress(w.as_buffer()).decode() for w in words], pa.string())):
        code, bounds = shingles(group)
        out += [code[bounds[i] : bounds[i + 1]] for i in range(group.texts)]
    return out


def _intersect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            part, linked = batch.slice(lo, 512), []
            for x, y in zip(_codes(part.column(2)), _codes(part.column(3)), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield part.select([0, 1]).filter(pa.array(linked, pa.bool_()))


def _close(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs of sets ``a_sid, a_n, b_sid, b_n`` that pass the bitmap bound, as ``a, a_sid, b, b_sid`` with their documents."""
    left, right = (classes.select(F.col("node").alias(x), F.col("sid").alias(f"{x}_sid"), F.col("n").alias(f"{x}_n"), F.col("bits").alias(f"{x}_bits")) for x in "ab")
    near = pairs.join(left, ["a_sid", "a_n"]).join(right, ["b_sid", "b_n"]).where(may_link(F.col("a_bits"), F.col("b_bits"), F.col("a_n"), F.col("b_n")))
    return near.select("a", "a_sid", "b", "b_sid")


def _verify(close: DataFrame, docs: DataFrame) -> DataFrame:
    """The linked ones ``u, v`` among pairs ``a, a_sid, b, b_sid``; only the texts they name are moved."""
    close = materialize(close, "pairs")
    sides = [close.select(F.col(x).alias("named"), F.col(f"{x}_sid").alias("wanted")) for x in "ab"]
    named = materialize(sides[0].unionByName(sides[1]).distinct(), "named")
    texts = materialize(only_ids(docs, "doc_id", named, "named").select("named", "text", "wanted").mapInArrow(_words, "node bigint, words binary"), "words")
    left, right = (texts.select(F.col("node").alias(x), F.col("words").alias(f"{x}_words")) for x in "ab")
    return close.join(left, "a").join(right, "b").select("a", "b", "a_words", "b_words").mapInArrow(_intersect, "a bigint, b bigint").toDF("u", "v")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the component is the smallest document reachable by links."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sets = materialize(docs.mapInArrow(_sets, "doc_id bigint, sid bigint, n int, bits array<bigint>, chunk int, counts binary"), "sets")
    members = sets.where("chunk IS NULL").select("doc_id", "sid", "n")
    full = sets.where("n > 0 AND doc_id IS NOT NULL")
    classes = materialize(full.groupBy("sid", "n").agg(F.min("doc_id").alias("node"), F.first("bits").alias("bits")), "classes")

    shared = spark.sparkContext.broadcast(count_sketch(sets))  # fixed size
    tokens = docs.where("doc_id IS NOT NULL").select("text").mapInArrow(_prefixes(shared), "token bigint, sid bigint, n int, pos smallint")
    tiles = materialize(_tiles(tokens), "tiles")
    label = components(_verify(_close(_pairs(tiles), classes), docs), "u", "v")

    large = tiles.where(F.col("members") > COMPLETE).select("token", "sid", "n", "pos", "band")
    place = classes.join(label, "node", "left").select("sid", "n", "node", F.coalesce("component", "node").alias("component"))
    found = materialize(_verify(_exhaustive(_mixed(large.join(place, ["sid", "n"])), classes), docs), "links")
    if not found.isEmpty():
        known = label.select(F.col("node").alias("u"), F.col("component").alias("v"))
        label = components(found.unionByName(known), "u", "v")

    nodes = classes.join(label, "node", "left").select("sid", "n", F.coalesce("component", "node").alias("component"))
    return members.join(nodes, ["sid", "n"], "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id"))).alias("component_id"),
    )


def _tiles(tokens: DataFrame) -> DataFrame:
    """Tokens that several sets share: ``token, sid, n, band, members`` and the sets each is to be compared with.

    One shuffle by token serves all windows. The rows of a token are the sets that have it among their rarest.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / PERCENT))).cast("int")
    in_order, whole = Window.partitionBy("token").orderBy("sid", "n"), Window.partitionBy("token")
    this = F.struct("sid", "n")
    once = tokens.withColumn("before", F.lag(this).over(in_order)).where(F.col("before").isNull() | (F.col("before") != this)).drop("before")
    shared = once.withColumns({"members": F.count(F.lit(1)).over(whole), "next": F.lead(this, 1).over(in_order), "after": F.lead(this, 2).over(in_order)})
    shared = shared.where("members > 1").withColumn("band", band)
    # The pivot is the set in which the token ranks first. Copies have rare shingles of their own before it, the text
    # they were made from has none, so a group of near copies meets that text in most of its tiles.
    tile = Window.partitionBy("token", "band")
    shared = shared.withColumn("pivot", F.min(F.struct("pos", F.xxhash64("sid").alias("rank"), "sid", "n")).over(tile))
    small = F.col("members") <= COMPLETE
    partners = F.when(small, F.array("next", "after")).otherwise(F.array(F.struct("pivot.sid", "pivot.n")))
    return shared.select("token", "sid", "n", "pos", "band", "members", F.filter(partners, lambda x: x["sid"].isNotNull()).alias("partners"))


def _pairs(tiles: DataFrame) -> DataFrame:
    """Distinct pairs of different sets of fitting sizes, the smaller id first."""
    rows = tiles.select(F.struct("sid", "n").alias("x"), F.explode("partners").alias("y")).where("x <> y").where(fits(F.col("x.n"), F.col("y.n")))
    rows = rows.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    return rows.select(F.col("x.sid").alias("a_sid"), F.col("x.n").alias("a_n"), F.col("y.sid").alias("b_sid"), F.col("y.n").alias("b_n")).distinct()


def _mixed(rows: DataFrame) -> DataFrame:
    """Rows ``token, sid, n, pos, early, band, node, component`` of the tiles that hold several components and an early set.

    A set is early in a tile if it may link with a set of its own size and rank. Of two sets that may link, the smaller
    or an equal one is early: the other's remainder must cover more than its own size asks for.
    """
    whole = Window.partitionBy("token")
    rows = rows.withColumn("early", may_overlap(F.col("n"), F.col("pos"), F.col("n"), F.col("pos")))
    mixed = rows.withColumns({"low": F.min("component").over(whole), "high": F.max("component").over(whole), "any": F.max("early").over(whole)}).where("low < high AND any")
    return materialize(mixed.select("token", "sid", "n", "pos", "early", "band", "node", "component"), "mixed")


def _exhaustive(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """All pairs of sets in a tile that belong to different components and pass the bounds of ranks and bitmaps.

    Only early sets look for partners, so pages that share no more than their frame, where none is early, meet nobody.
    """
    rows = mixed.join(classes.select("node", "bits"), "node")
    a, b = (rows.select(F.col("token").alias(f"{x}_token"), F.col("node").alias(x), *(F.col(c).alias(f"{x}_{c}") for c in ("sid", "n", "pos", "early", "band", "component", "bits"))) for x in "ab")
    a = a.where("a_early")
    once = (F.col("a_component") < F.col("b_component")) | (~F.col("b_early") & (F.col("a_component") > F.col("b_component")))
    near = once & (F.abs(F.col("a_band") - F.col("b_band")) <= 1) & fits(F.col("a_n"), F.col("b_n")) & may_overlap(F.col("a_n"), F.col("a_pos"), F.col("b_n"), F.col("b_pos"))
    close = a.join(b, (F.col("a_token") == F.col("b_token")) & near & may_link(F.col("a_bits"), F.col("b_bits"), F.col("a_n"), F.col("b_n")))
    ends = [F.struct(F.col(x).alias("node"), F.col(f"{x}_sid").alias("sid")) for x in "ab"]
    close = close.select(F.least(*ends).alias("x"), F.greatest(*ends).alias("y")).distinct()
    return close.select(F.col("x.node").alias("a"), F.col("x.sid").alias("a_sid"), F.col("y.node").alias("b"), F.col("y.sid").alias("b_sid"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, but for the later documents of each component.

    Rows of one ``doc_id`` stay or go together; rows with a null ``doc_id`` stay.
    """
    later = near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("_later")).distinct()
    later = materialize(later, "later")
    return docs.join(small_enough(later), docs["doc_id"].cast("long") == later["_later"], "left_anti")
