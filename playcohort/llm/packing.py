"""Best-fit packing of token sequences (operator 1).

Documents become token pieces of at most ``capacity`` tokens. What fits together is decided on the histogram
of piece lengths alone, which has at most ``capacity`` rows whatever the corpus size: a linear program over
configurations (multisets of lengths that fit one sequence) is solved by multiplicative weights, where a
knapsack dynamic program prices the best configuration, and is then rounded; what the rounding leaves is
filled by largest fit. The prices also bound the number of sequences from below: a plan of full configurations
and largest fit is taken if it is within ``GAP`` (and one sequence) of that bound; otherwise the program goes on
with configurations that waste room until every length is covered, for at most ``ROUNDS`` rounds, and the best plan is taken, that of
best-fit decreasing on the same histogram included. Pieces take their places by their rank among the pieces of their length, so no task
ever holds more than a slice of a length and the driver holds the histogram and the plan only.

Edge cases: a null or empty text is the end token alone; a text longer than ``capacity`` is cut into full
pieces, and its first piece takes the remainder; repeated rows are packed each; a null ``doc_id`` stays null;
an empty table gives an empty result; further columns of the input are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playcohort.llm.shared import rank_within
from playcohort.session import materialize

CAPACITY, END_ID = 1024, 2
#: Sequences above the lower bound, as a share of it, at which the search for a better plan ends.
GAP = 0.001
#: Rounds after which the covering program ends, at whatever gap; the plan then is the best of all found and of best-fit decreasing.
ROUNDS = 3_000
#: A run this long goes to `tokenizers`: the fast library takes quadratic time on one.
LONG_RUN = 400
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class Encoder:
    """Token ids as `tokenizers` gives them for the vocabulary file.

    `tiktoken` reads the same vocabulary as ranks and returns the same ids four times as fast; texts with very
    long runs of letters or of spaces go through `tokenizers` itself.
    """

    def __init__(self, vocabulary: str, ranks: str):
        import base64

        import tiktoken

        with open(ranks, "rb") as file:
            table = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file)}
        self.vocabulary, self._exact = vocabulary, None
        self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={"<|endoftext|>": len(table)})
        self._long = re.compile(r"[^\x20\x09-\x0D]{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))

    def exact(self, text: str) -> np.ndarray:
        if self._exact is None:
            from tokenizers import Tokenizer

            self._exact = Tokenizer.from_file(self.vocabulary)
        return np.array(self._exact.encode(text, add_special_tokens=False).ids, np.uint32)

    def __call__(self, text: str) -> np.ndarray:
        if self._long.search(text):
            return self.exact(text)
        return np.asarray(self._fast.encode_to_numpy(text, allowed_special="all"), np.uint32)


def token_pieces(
    docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, vocabulary: str = "byte_bpe_50k.json", ranks: str = "byte_bpe_50k.tiktoken", keep_ids: bool = False
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32`` and, if kept, ``ids``."""
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(public_tokenizers.path(vocabulary), public_tokenizers.path(ranks))
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for piece, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    row = (doc_id, piece, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes()))
                    out.append((*row, ids[lo:hi].astype(np.int32)) if keep_ids else row)
                if len(out) >= (512 if keep_ids else 4096):
                    yield table(out)
                    out = []
            if out:
                yield table(out)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=False)], names[: len(columns)])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema)


def best_configuration(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """How often each length occurs in the configuration of the highest price: the unbounded knapsack."""
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    for room in range(int(lengths[0]), capacity + 1):
        value[room], choice[room] = value[room - 1], -1
        n = fits[room]
        if n:
            gains = prices[:n] + value[room - lengths[:n]]
            best = int(gains.argmax())
            if gains[best] > value[room]:
                value[room], choice[room] = gains[best], best
    counts, room = np.zeros(len(lengths), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= int(lengths[choice[room]])
    return counts


def cover(lengths: np.ndarray, counts: np.ndarray, capacity: int, exact: bool, rounds: int, step: float, rate: float) -> Iterator[tuple[list, np.ndarray, float, bool]]:
    """Rounds of multiplicative weights: (uses so far, covered shares, dual bound, whether the next configuration wastes room).

    A length costs ``length / capacity`` times a weight that shrinks exponentially with the share of its pieces
    already covered, so every round prices a configuration of lengths that lag behind. It is used for up to
    ``step`` of what its scarcest length has. If ``exact``, a covered length is priced at nothing and no length is
    covered twice; otherwise lengths may be covered more often than once, and the solution is scaled down by the
    least covered one. The prices over that of the best configuration are a dual solution, so they bound the
    number of sequences from below.
    """
    covered, uses, bound = np.zeros(len(lengths)), [], float(counts @ lengths) / capacity
    for _ in range(rounds):
        open_ = covered < 1 - 1e-9 if exact else np.ones(len(lengths), bool)
        if not open_.any():
            break
        prices = np.where(open_, lengths / capacity * np.exp(-rate * (covered - covered[open_].min())), 0.0)
        config = best_configuration(prices, lengths, capacity)
        bound = max(bound, float(counts @ prices / (config @ prices)))
        yield uses, covered, bound, bool(config @ lengths < capacity)
        used = config > 0
        most = np.maximum(step * counts[used], 1)
        if exact:
            most = np.minimum(most, (1 - covered[used]) * counts[used])
        amount = float((most / config[used]).min())
        covered[used] += amount * config[used] / counts[used]
        uses.append((config, amount))
    yield uses, covered, bound, False


def solve(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Iterator[tuple[list[tuple[np.ndarray, float]], float]]:
    """Fractional solutions of the configuration program, with a bound from below: [(configuration, how many sequences)], bound.

    First the full configurations only, whose rest is left to rounding; then, with configurations that waste room,
    a solution that covers every length; then the covering program, which also learns which lengths are scarce.
    """
    wasted = False
    # Each round covers a length or a quarter of one, so `4 * len(lengths)` rounds cover all.
    for uses, _, bound, wastes in cover(lengths, counts, capacity, True, 4 * len(lengths) + 1, 0.25, 2.0):
        if wastes and not wasted:
            wasted = True
            yield _joined(uses), bound
    yield _joined(uses), bound
    best, kept, scale, total = np.inf, 0, 1.0, 0.0
    for uses, covered, bound, _ in cover(lengths, counts, capacity, False, ROUNDS, 0.1, 1.0):
        total += uses[-1][1] if uses else 0.0
        if covered.min() > 0:
            value = total / covered.min()
            if value < best:
                best, kept, scale = value, len(uses), float(covered.min())
            if best <= bound * (1 + GAP / 2):
                break
    yield _joined([(config, amount / scale) for config, amount in uses[:kept]]), bound


def _joined(uses: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, float]]:
    solution: dict[bytes, list] = {}
    for config, amount in uses:
        solution.setdefault(config.tobytes(), [config, 0.0])[1] += amount
    return [(config, amount) for config, amount in solution.values()]


def best_fit(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Best-fit decreasing as a solution: [(configuration, how many sequences)].

    Sequences filled alike are one entry with a number, so the work follows from the lengths and not from the pieces. A sequence that took
    a piece is the tightest fit for the next one of that length, so it takes as many as it has room for.
    """
    rooms: dict[int, list[tuple[tuple, int]]] = {}
    for i in range(len(lengths) - 1, -1, -1):
        length, left = int(lengths[i]), int(counts[i])
        for room in [*sorted(room for room in rooms if length <= room < capacity), capacity]:
            entries = rooms.pop(room, []) if room < capacity else [((), left)]
            per, kept = room // length, []
            for config, times in entries:
                full = min(times, left // per)
                rest = left - full * per if full < times else 0
                rest = min(rest, per - 1) if left else 0
                for n, sequences in ((per, full), (rest, 1 if rest else 0)):
                    if sequences:
                        rooms.setdefault(room - n * length, []).append(((*config, (i, n)), sequences))
                        left -= n * sequences
                        times -= sequences
                if times and room < capacity:
                    kept.append((config, times))
            if kept:
                rooms.setdefault(room, []).extend(kept)
            if not left:
                break
    solution = []
    for config, times in (entry for entries in rooms.values() for entry in entries):
        made = np.zeros(len(lengths), np.int64)
        for i, n in config:
            made[i] += n
        solution.append((made, float(times)))
    return solution


def round_off(solution: list[tuple[np.ndarray, float]], lengths: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list, int]:
    """Rows of a plan, and its number of sequences: whole sequences of the solution, then largest fit."""
    left, taken, sequence, rows = counts.copy(), np.zeros_like(counts), 0, []

    def use(config: np.ndarray, times: int) -> None:
        nonlocal sequence
        offset = 0
        for i in np.flatnonzero(config)[::-1]:
            per = int(config[i])
            rows.append((int(lengths[i]), int(taken[i]), per * times, per, sequence, offset))
            offset += per * int(lengths[i])
            taken[i] += per * times
            left[i] -= per * times
        sequence += times

    def filled(config: np.ndarray) -> np.ndarray:
        """The configuration with the largest lengths that still fit."""
        config = config.copy()
        room = capacity - int(config @ lengths)
        while True:
            i = int(np.searchsorted(lengths, room, "right")) - 1
            while i >= 0 and left[i] - config[i] <= 0:
                i -= 1
            if i < 0:
                return config
            n = min(int(left[i] - config[i]), room // int(lengths[i]))
            config[i] += n
            room -= n * int(lengths[i])

    for config, amount in sorted(solution, key=lambda x: -x[1]):
        todo = int(amount + 1e-6)
        while todo:
            # A length may be used up by earlier configurations: then others take its room.
            trimmed = np.minimum(config, left)
            if not trimmed.any():
                break
            trimmed = filled(trimmed)
            used = trimmed > 0
            times = min(todo, int((left[used] // trimmed[used]).min()))
            use(trimmed, times)
            todo -= times
    while left.any():
        # What rounding left: fill one sequence with the largest lengths that fit, and repeat it while pieces last.
        config = filled(np.zeros_like(left))
        used = config > 0
        use(config, int((left[used] // config[used]).min()))
    return rows, sequence


def _candidates(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> Iterator[tuple[list[tuple[np.ndarray, float]], float]]:
    """The solutions of the program, then that of best-fit decreasing, which adds no bound."""
    yield from solve(lengths, counts, capacity)
    yield best_fit(lengths, counts, capacity), 0.0


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Rows (length, first rank, ranks, copies per sequence, first sequence, offset) that place every piece.

    Of the rounded solutions, the first that is within ``GAP`` of the bound, or else the one of fewest sequences; best-fit
    decreasing is one of these.
    """
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(n)] for n in lengths], np.int64)
    best, fewest, least = [], np.inf, 0.0
    if len(lengths):
        for solution, bound in _candidates(lengths, counts, capacity):
            rows, sequences = round_off(solution, lengths, counts, capacity)
            least = max(least, np.ceil(bound - 1e-6))
            if sequences < fewest:
                best, fewest = rows, sequences
            if fewest <= least + max(1, GAP * least):
                break
    return np.array(best, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to written pieces with a ``length`` from 1 to ``capacity``."""
    spark = pieces.sparkSession
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    rows = plan(histogram, capacity)
    rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
    # Ranks of all lengths on one line, so that one binary search finds the entry of a piece.
    base = {n: int(b) for n, b in zip(sorted(histogram), np.cumsum([0, *(histogram[k] for k in sorted(histogram))]), strict=False)}
    first = np.array([base[int(n)] for n in rows[:, 0]], np.int64) + rows[:, 1]
    shared = spark.sparkContext.broadcast((np.array([base.get(n, 0) for n in range(capacity + 1)], np.int64), first, rows))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start_of, first, rows = shared.value
        for batch in batches:
            names = batch.schema.names
            length, rank = (batch.column(names.index(c)).to_numpy(zero_copy_only=False) for c in ("length", "_rank"))
            at = start_of[length] + rank
            entry = np.searchsorted(first, at, "right") - 1
            inside = at - first[entry]
            _, _, _, per, sequence, offset = (rows[entry, i] for i in range(6))
            kept = [c for c in names if c != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(names.index(c)) for c in kept), pa.array(sequence + inside // per), pa.array(offset + inside % per * length)],
                [*kept, "sequence_id", "offset"],
            )

    ranked = rank_within(pieces, "length", ["doc_id", "piece", "ids_crc32"], "_rank", sum(histogram.values()))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id bigint, offset bigint"
    return ranked.select(*pieces.columns, "_rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """Tokenize and pack: one row per piece with its sequence and offset.

    Ids that are kept meet their pieces at the end, by a number of the written row: only lengths are ranked and placed.
    """
    if not keep_ids:
        return pack(materialize(token_pieces(docs, capacity), "pieces"), capacity)
    pieces = materialize(token_pieces(docs, capacity, keep_ids=True).withColumn("_row", F.monotonically_increasing_id()), "pieces")
    placed = pack(pieces.drop("ids"), capacity)
    names = [c for c in placed.columns if c != "_row"]
    return placed.join(pieces.select("_row", "ids"), "_row").select(*names, "ids")
