"""Toxicity by Levenshtein automata over a learned lexicon trie, with context scores (operator 13).

*Lexicon.* Words that the toxic labelled texts hold far more often than the clean ones (log-likelihood ratio), counted by
distinct neighbourhoods, so that copies of one passage are one witness. The terms form a trie. For a word of a text, the
automaton that accepts everything within one or two edits of it walks the trie, all words of a batch at once: a state is
a bit per place in the word and number of edits, a branch is left when no word is alive in it. A word met in training
is weighed by its own texts, one never met by how often words at its distance from a term were abuse.

*Context.* The words up to five places around a term, and whether it stands between quotation marks, have log-odds of their
own, learned from the labelled texts: a report about an insult differs from the insult. The sum is a hit's probability.

*Score.* Logistic regression on the hits of a text: their sum, the largest, and their sum per word.

Everything is fitted on at most ``train_rows`` labelled texts, half of them toxic (parameter; equal texts once, in the
order of a hash, weighted back to their share), none of whose ids is held out. Lexicon, context and word lists are
bounded by parameters as well; they are what is broadcast. Scoring sees every text whole and shuffles nothing.

Edge cases: a null or empty text has no hits and gets the score of a text without hits; equal texts get equal scores;
contradicting labels of one document or text count as toxic; a null ``doc_id`` has no labels and is not held out; without
labels of both kinds nothing can be learned and every score is 0; an empty table gives an empty result; further columns are
ignored, and so are language, source and id in the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort.llm.words import Group, groups, mix, signed
from playcohort.session import materialize

TRAIN_ROWS, TERMS, CONTEXTS, WORDS = 40_000, 2_000, 5_000, 100_000
#: A term needs this log-likelihood ratio (five in a million by chance) and must be so many times as frequent in toxic texts.
EVIDENCE, LIFT = 21.0, 8.0
REACH, THRESHOLD = 5, 0.7
#: Texts by which a word's own share, and its context's, is drawn to what holds in general.
PRIOR = 2.0
#: Words between quotation marks before any label is seen: one in ten of abuse, one in two of reports.
QUOTED = (1.0, 5.0, 10.0)
LONGEST = 60
#: Words a worker remembers as no match, and as near a term, before it starts afresh.
REMEMBERED, REMEMBERED_NEAR = 1_000_000, 100_000
#: Signs inside a word that hide a letter, and all that separates words.
_HIDING = b"*@$"
SEPARATORS = np.array([b < 128 and not chr(b).isalnum() and b not in _HIDING for b in range(256)])


def edits(letters: int) -> int:
    """Edits by which a word may differ from a term of so many letters."""
    return 0 if letters < 5 else 1 if letters < 8 else 2


def plain(text: Column) -> Column:
    """Lower case, one kind of quotation mark and blank."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    return F.translate(F.lower(text), "“”„«»‹› ’‘", '"""""""' + " ''")


@dataclass
class Node:
    edits: int = 0
    term: int = -1
    below: dict[int, Node] = field(default_factory=dict)


class Lexicon:
    """A trie of terms and the words near them."""

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.root = Node()
        self.letters = np.unique(np.array([_character(c) for t in terms for c in t], np.int64))
        for number, term in enumerate(terms):
            node, most = self.root, edits(len(term))
            node.edits = max(node.edits, most)
            for c in term:
                node = node.below.setdefault(int(np.searchsorted(self.letters, _character(c))) + 1, Node())
                node.edits = max(node.edits, most)
            node.term = number

    def match(self, codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per word the nearest term (-1: none; of equally near ones the strongest) and the edits to it.

        codes: a row of characters for each word, filled up at the end; size: characters of each word.
        """
        n = len(size)
        term, distance = np.full(n, -1, np.int64), np.full(n, 9, np.int64)
        if not n or not self.terms:
            return term, distance
        place = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        place = np.where(self.letters[place] == codes, place + 1, 0)
        at = np.zeros((len(self.letters) + 1, n), np.uint64)  # per letter: where it stands in the word
        for p in range(codes.shape[1]):
            rows = np.flatnonzero(p < size)
            at[place[rows, p], rows] |= np.uint64(1 << p)
        accept = np.uint64(1) << size.astype(np.uint64)
        start = [np.full(n, (1 << j + 1) - 1, np.uint64) for j in range(self.root.edits + 1)]
        waiting = [(self.root, np.arange(n), start)]
        while waiting:
            node, alive, states = waiting.pop()
            if node.term >= 0:
                most = edits(len(self.terms[node.term]))
                for j in range(min(most, len(states) - 1), -1, -1):
                    hit = alive[(states[j] & accept[alive]) != 0]
                    hit = hit[(distance[hit] > j) | ((distance[hit] == j) & (term[hit] > node.term))]
                    term[hit], distance[hit] = node.term, j
            for letter, child in node.below.items():
                here = at[letter, alive]
                after: list[np.ndarray] = []
                for j in range(child.edits + 1):
                    state = (states[j] & here) << np.uint64(1)
                    if j:
                        state |= states[j - 1] | states[j - 1] << np.uint64(1) | after[j - 1] << np.uint64(1)
                    after.append(state)
                left = (after[-1] & (accept[alive] | (accept[alive] - np.uint64(1)))) != 0
                if left.any():
                    waiting.append((child, alive[left], [a[left] for a in after]))
        return term, distance


def _character(c: str) -> int:
    return int.from_bytes(c.encode(), "big")


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of UTF-8 text as numbers, and for each byte how many begin before it."""
    first = (data & 0xC0) != 0x80
    begin = np.flatnonzero(first)
    length = np.diff(np.append(begin, len(data)))
    codes = data[begin].astype(np.int64)
    for more in range(1, 4):
        rows = np.flatnonzero(length > more)
        codes[rows] = codes[rows] << 8 | data[begin[rows] + more]
    return codes, np.concatenate([[0], np.cumsum(first)])


@dataclass
class Found:
    """The hits of a group of texts."""

    token: np.ndarray  # number of the word in the group
    term: np.ndarray
    distance: np.ndarray


class Finder:
    """Finds the words near a lexicon's terms; remembers words it has seen."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.nothing = np.zeros(0, np.uint64)
        self.near: dict[int, tuple[int, int]] = {}

    def find(self, group: Group) -> Found:
        # before the words are looked up: what is known of this group must stay until the group is done
        if len(self.nothing) > REMEMBERED:
            self.nothing = np.zeros(0, np.uint64)
        if len(self.near) > REMEMBERED_NEAR:
            self.near = {}
        codes, first, back = np.unique(group.hash, return_index=True, return_inverse=True)
        new = np.flatnonzero(~_among(codes, self.nothing))
        new = new[[c not in self.near for c in codes[new].tolist()]] if len(new) else new
        if len(new):
            self._learn(group, codes[new], first[new])
        term, distance = np.full(len(codes), -1), np.zeros(len(codes), np.int64)
        for i in np.flatnonzero(~_among(codes, self.nothing)).tolist():
            term[i], distance[i] = self.near[int(codes[i])]
        token = np.flatnonzero(term[back] >= 0)
        return Found(token, term[back][token], distance[back][token])

    def _learn(self, group: Group, codes: np.ndarray, word: np.ndarray) -> None:
        letters, before = _characters(group.data)
        hiding = np.isin(group.data, [*_HIDING])
        lo, hi = group.start[word].copy(), group.end[word].copy()
        for _ in range(2):  # emphasis around a word is not part of it
            lo += (hi - lo > 1) & hiding[lo]
            hi -= (hi - lo > 1) & hiding[hi - 1]
        lo, hi = before[lo], before[hi]
        short = np.flatnonzero(hi - lo <= LONGEST)
        term = np.full(len(word), -1)
        distance = np.zeros(len(word), np.int64)
        for some in np.array_split(short, len(short) // 20_000 + 1):
            size = hi[some] - lo[some]
            at = lo[some, None] + np.arange(max(size, default=0))
            term[some], distance[some] = self.lexicon.match(letters[np.minimum(at, len(letters) - 1)], size)
        self.near |= {c: (t, d) for c, t, d in zip(codes.tolist(), term.tolist(), distance.tolist(), strict=True) if t >= 0}
        self.nothing = np.union1d(self.nothing, codes[term < 0])


def _among(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def _around(group: Group, token: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each place around the tokens: which tokens have a word of their text there, and its hash."""
    for step in (*range(-REACH, 0), *range(1, REACH + 1)):
        other = token + step
        inside = (other >= 0) & (other < len(group.hash))
        inside[inside] = group.text[other[inside]] == group.text[token[inside]]
        yield np.flatnonzero(inside), group.hash[other[inside]]


def _quoted(group: Group, token: np.ndarray) -> np.ndarray:
    """Whether a token has an odd number of quotation marks before it in its line."""
    marks = np.concatenate([[0], np.cumsum(group.data == ord('"'))])
    lines = np.concatenate([group.text_start[:-1], np.flatnonzero(group.data == ord("\n"))])
    lines.sort()
    begin = group.start[token]
    return (marks[begin] - marks[lines[np.searchsorted(lines, begin, "right") - 1]]) % 2 == 1


# learning


def training(docs: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """``text, toxic, weight`` of at most ``train_rows`` labelled texts that are not held out."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain(F.col("text")).alias("text")).where(~held_out(F.col("doc_id")) & (F.col("text") != ""))
    slim = rows.select("doc_id", F.xxhash64("text").alias("code"))
    texts = slim.join(marks, F.col("doc_id") == F.col("_id")).groupBy("code").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id"))
    texts = materialize(texts, "labelled")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    chosen = None
    for kind, number in sorted(sizes.items()):
        some = texts.where(F.col("toxic") == kind).orderBy("code").limit(train_rows // 2)
        some = some.select("code", F.col("doc_id").alias("_id"), "toxic", F.lit(max(1.0, number / (train_rows // 2))).alias("weight"))
        chosen = some if chosen is None else chosen.unionByName(some)
    if chosen is None or len(sizes) < 2:
        return docs.sparkSession.createDataFrame([], "text string, toxic int, weight double")
    chosen = F.broadcast(materialize(chosen, "chosen"))  # train_rows at most
    picked = rows.join(chosen, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("code")))
    return materialize(picked.dropDuplicates(["code"]).select("text", "toxic", "weight"), "training-texts")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1


def _witnesses(texts: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """``code, n``: of every word (or those in ``among``) the distinct neighbourhoods of its first places in the texts."""
    only = None if among is None else texts.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in among.select("code").collect()], np.int64)).view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in groups(batch.column(0), SEPARATORS, lower=True):
                _, first = np.unique(mix(group.hash + group.text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)
                if only is not None:
                    first = first[_among(signed(group.hash[first]), only.value)]
                near = np.zeros(len(first), np.uint64)
                for step in (-1, 1):
                    other = first + step
                    inside = (other >= 0) & (other < len(group.hash))
                    inside[inside] = group.text[other[inside]] == group.text[first[inside]]
                    near[inside] += mix(group.hash[other[inside]] + np.uint64(step + 1))
                names = [None] * len(first) if only is not None else [group.words(i, i + 1).decode() for i in first.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(signed(group.hash[first])), pa.array(signed(near)), pa.array(names, pa.string())], ["code", "near", "word"])

    rows = texts.select("text").mapInArrow(run, "code bigint, near bigint, word string")
    return rows.groupBy("code").agg(F.count_distinct("near").alias("n"), F.min("word").alias("word"))


def _lexicon(texts: DataFrame, toxic_texts: int, clean_texts: int, clean_weight: float, terms: int) -> list[str]:
    """The words that speak most clearly for a toxic text, the clearest first."""
    abuse = materialize(_witnesses(texts.where("toxic = 1")).where("n >= 3"), "toxic-words")
    clean = _witnesses(texts.where("toxic = 0"), abuse).select(F.col("code").alias("_code"), F.col("n").alias("clean"))
    rows = abuse.join(clean, F.col("code") == F.col("_code"), "left").withColumn("a", F.col("n").cast("double"))
    rows = rows.withColumn("b", F.coalesce(F.col("clean"), F.lit(0)) * F.lit(clean_weight))
    total_a, total_b = F.lit(float(toxic_texts)), F.lit(clean_texts * clean_weight)
    share = total_a / (total_a + total_b)
    expect = lambda x, p: F.when(x > 0, x * F.log(x / ((F.col("a") + F.col("b")) * p))).otherwise(0.0)
    rows = rows.withColumn("evidence", 2 * (expect(F.col("a"), share) + expect(F.col("b"), 1 - share)))
    lift = (F.col("a") + 0.5) / (total_a + 1) / ((F.col("b") + 0.5) / (total_b + 1))
    best = rows.where((F.col("evidence") >= EVIDENCE) & (lift >= LIFT)).orderBy(F.desc("evidence"), "word").limit(terms)
    return [r["word"] for r in best.select("word").collect() if len(r["word"]) <= LONGEST]


HITS = "toxic int, weight double, code bigint, distance int, quoted boolean, near array<bigint>"


def _training_hits(texts: DataFrame, lexicon) -> DataFrame:
    """A row for each hit of the labelled texts with the words around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(lexicon.value)
        for batch in batches:
            toxic, weight = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for group in groups(batch.column(0), SEPARATORS, lower=True):
                found = finder.find(group)
                near: list[list[int]] = [[] for _ in found.token]
                for which, code in _around(group, found.token):
                    for i, c in zip(which.tolist(), signed(code).tolist(), strict=True):
                        near[i].append(c)
                text = group.first + group.text[found.token]
                yield pa.RecordBatch.from_arrays([
                    pa.array(toxic[text], pa.int32()), pa.array(weight[text]), pa.array(signed(group.hash[found.token])), pa.array(found.distance, pa.int32()),
                    pa.array(_quoted(group, found.token)), pa.array(near, pa.list_(pa.int64()))], ["toxic", "weight", "code", "distance", "quoted", "near"])

    return texts.mapInArrow(run, HITS)


@dataclass
class Model:
    """All that scoring needs; ``words`` and ``near`` are ordered codes with their log-odds."""

    lexicon: Lexicon
    words: tuple[np.ndarray, np.ndarray]
    distance: list[float]
    near: tuple[np.ndarray, np.ndarray]
    quoted: float
    coefficients: tuple[float, ...] = (0.0, 0.0, 0.0)
    intercept: float = 0.0

    def probability(self, group: Group, found: Found) -> np.ndarray:
        """Of each hit: how likely it is abuse, by its word, the words around it and quotation marks."""
        odds = np.array(self.distance)[np.minimum(found.distance, len(self.distance) - 1)]
        code = signed(group.hash[found.token])
        own = _among(code, self.words[0])
        odds[own] = self.words[1][np.searchsorted(self.words[0], code[own])]
        context = np.where(_quoted(group, found.token), self.quoted, 0.0)
        for which, around in _around(group, found.token):
            around = signed(around)
            known = _among(around, self.near[0])
            context[which[known]] += self.near[1][np.searchsorted(self.near[0], around[known])]
        return 1 / (1 + np.exp(-(odds + np.clip(context, -4, 4))))

    def features(self, group: Group, found: Found, probability: np.ndarray) -> np.ndarray:
        """Per text: the sum of its hits, the largest and their sum per word."""
        text = group.text[found.token]
        total, most = np.bincount(text, probability, group.texts), np.zeros(group.texts)
        np.maximum.at(most, text, probability)
        words = np.maximum(1, np.bincount(group.text, minlength=group.texts))
        return np.stack([np.log1p(total), most, np.log1p(100 * total / words)], 1)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(features @ np.array(self.coefficients) + self.intercept)))


def _odds(a: Column, b: Column, of_a: float, of_b: float) -> Column:
    return F.log((a + PRIOR * of_a) / (b + PRIOR * of_b))


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, terms: int = TERMS) -> Model | None:
    """Lexicon, context and regression from the labels; None where there are not labels of both kinds."""
    texts = training(docs, labels, train_rows)
    sizes = {r["toxic"]: (r["n"], r["weight"]) for r in texts.groupBy("toxic").agg(F.count("*").alias("n"), F.max("weight").alias("weight")).collect()}
    if len(sizes) < 2:
        return None
    context = texts.sparkSession.sparkContext
    lexicon = Lexicon(_lexicon(texts, sizes[1][0], sizes[0][0], sizes[0][1] / sizes[1][1], terms))
    hits = materialize(_training_hits(texts, context.broadcast(lexicon)), "lexicon-hits")
    a, b = (F.sum(F.when(F.col("toxic") == k, F.col("weight")).otherwise(0.0)) for k in (1, 0))
    by_distance = {r["distance"]: (r["a"], r["b"]) for r in hits.groupBy("distance").agg(a.alias("a"), b.alias("b")).collect()}
    pooled = [by_distance.get(d, (0.0, 0.0)) for d in range(3)]
    # a word never met is weighed with half a clean text more than were seen, the more so the farther it is from a term
    distance = [math.log((x + 1 / (1 + d)) / (y + 0.5)) for d, (x, y) in enumerate(pooled)]
    share = [1 / (1 + math.exp(-x)) for x in distance]
    of_a = F.when(F.col("distance") == 0, share[0]).when(F.col("distance") == 1, share[1]).otherwise(share[2])
    words = hits.groupBy("code", "distance").agg(a.alias("a"), b.alias("b"), F.count("*").alias("n"))
    words = words.select("code", F.log((F.col("a") + PRIOR * of_a) / (F.col("b") + PRIOR * (1 - of_a))).alias("odds"), "n").orderBy(F.desc("n"), "code").limit(WORDS)
    total = hits.agg(a.alias("a"), b.alias("b"), F.sum(F.when(F.col("quoted") & (F.col("toxic") == 1), F.col("weight")).otherwise(0.0)).alias("qa"),
                     F.sum(F.when(F.col("quoted") & (F.col("toxic") == 0), F.col("weight")).otherwise(0.0)).alias("qb")).first()
    all_a, all_b = total["a"] or 0.0, total["b"] or 0.0
    quoted = math.log(((total["qa"] or 0.0) + QUOTED[0]) / (all_a + QUOTED[2])) - math.log(((total["qb"] or 0.0) + QUOTED[1]) / (all_b + QUOTED[2]))
    part = all_a / (all_a + all_b) if all_a + all_b else 0.5
    near = hits.select("toxic", "weight", F.explode(F.array_distinct("near")).alias("code")).groupBy("code").agg(a.alias("a"), b.alias("b"))
    # log-odds beyond those of any hit, drawn to 0 by as many texts as PRIOR says on either side
    near = near.select("code", (_odds(F.col("a"), F.col("b"), part, 1 - part) - F.lit(math.log(max(part, 1e-9) / max(1 - part, 1e-9)))).alias("odds"), (F.col("a") + F.col("b")).alias("n"))
    near = near.where("n >= 5 AND abs(odds) >= 0.5").orderBy(F.desc("n"), "code").limit(CONTEXTS)
    model = Model(lexicon, _table(words), distance, _table(near), quoted)
    rows = _features(texts, context.broadcast(model))
    fitted = LogisticRegression(featuresCol="x", labelCol="toxic", weightCol="weight", regParam=1e-4, maxIter=50).fit(
        VectorAssembler(inputCols=["total", "most", "dense"], outputCol="x").transform(rows))
    model.coefficients, model.intercept = tuple(fitted.coefficients.toArray().tolist()), float(fitted.intercept)
    return model


def _table(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    pairs = sorted((r["code"], r["odds"]) for r in rows.collect())
    return np.array([c for c, _ in pairs], np.int64), np.array([o for _, o in pairs], float)


def _features(texts: DataFrame, model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(model.value.lexicon)
        for batch in batches:
            for group in groups(batch.column(0), SEPARATORS, lower=True):
                found = finder.find(group)
                x = model.value.features(group, found, model.value.probability(group, found))
                part = batch.slice(group.first, group.texts)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), *(pa.array(c) for c in x.T)], ["toxic", "weight", "total", "most", "dense"])

    return texts.mapInArrow(run, "toxic int, weight double, total double, most double, dense double")


_HIT = pa.list_(pa.struct([("word", pa.int64()), ("term", pa.string()), ("edits", pa.int32()), ("abuse", pa.float64())]))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, score, hits``: per document its score and its hits (place in words, term, edits, probability of abuse)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), plain(F.col("text")).alias("text"))
    hits = "hits array<struct<word:bigint,term:string,edits:int,abuse:double>>"
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.from_json(F.lit("[]"), hits.removeprefix("hits ")).alias("hits"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        finder = Finder(model.lexicon)
        for batch in batches:
            for group in groups(batch.column(1), SEPARATORS, lower=True):
                found = finder.find(group)
                abuse = model.probability(group, found)
                listed: list[list] = [[] for _ in range(group.texts)]
                place = found.token - group.word_start[group.text[found.token]]
                for text, *hit in zip(group.text[found.token].tolist(), place.tolist(), found.term.tolist(), found.distance.tolist(), abuse.tolist(), strict=True):
                    listed[text].append({"word": hit[0], "term": model.lexicon.terms[hit[1]], "edits": hit[2], "abuse": hit[3]})
                values = model.score(model.features(group, found, abuse))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(group.first, group.texts), pa.array(values), pa.array(listed, _HIT)], ["doc_id", "score", "hits"])

    return rows.mapInArrow(run, f"doc_id bigint, score double, {hits}")


def judge(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, terms: int = TERMS, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted, hits`` of every document."""
    rows = score(docs, fit(docs, labels, train_rows, terms))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "hits")
