"""Phrase collocations, the filter audit and toxicity against plain versions, with every edge case."""

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playcohort.llm import collocations, interactions, toxicity
from playcohort.llm.words import groups
from tests.llm import plain

LABELS = "doc_id bigint, quality int, toxic int, text string, part string"


@pytest.fixture(scope="module")
def docs(spark):
    return plain.documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], plain.DOCUMENTS)


# 11 phrase collocations


def _talk(spark, seed=5):
    rng = random.Random(seed)
    words = ["new", "york", "the", "of", "city", "Hall", "é", "a-b", "x", "日本"]
    rows = []
    for i in range(400):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "! ", "\x0b"]) for _ in range(rng.randrange(60)))
        rows.append((i, rng.choice([text, "New York city hall " + text, "of the new york " * 3]), rng.choice(["en", "en", "de", None, "und"])))
    rows += [(None, None, None), (3, "", "fr"), (3, "z " * 5000, "en"), (4, " ... !! ", "es"), rows[0], rows[0]]
    return rows, spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], "doc_id bigint, text string, lang string, phrase string, a int, rank int").repartition(7)


@pytest.mark.parametrize("least,top", [(30, 2000), (5, 40), (3, 7)])
def test_collocations(spark, least, top):
    rows, table = _talk(spark)
    got = collocations.mine(table, least=least, top=top, filter_bits=16)
    assert sorted(map(tuple, got.collect())) == plain.collocations([(lang, text) for _, text, lang in rows], least, top)


def test_collocations_with_small_bounds(spark, monkeypatch):
    """Summaries that must subtract, tasks that hand on often and a filter that is nearly full change nothing."""
    rows, table = _talk(spark, 8)
    for name, value in (("FLUSH", 300), ("PHRASES", 50), ("COUNTERS", 16)):
        monkeypatch.setattr(collocations, name, value)
    got = collocations.mine(table, least=10, top=500, filter_bits=10)
    assert sorted(map(tuple, got.collect())) == plain.collocations([(lang, text) for _, text, lang in rows], 10, 500)


def test_collocations_of_nothing(empty):
    got = collocations.mine(empty)
    assert got.count() == 0 and got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=30), max_size=12), st.integers(1, 30), st.integers(2, 12))
def test_summaries_keep_what_is_frequent(parts, capacity, least):
    summary, true = collocations.Summary(capacity, least), {}
    for part in parts:
        keys, counts = np.array([k for k, _ in part], "<u4"), np.array([c for _, c in part], np.int64)
        summary.add(keys, counts)
        for k, c in part:
            true[k] = true.get(k, 0) + c
    kept = set(summary.survivors().tolist())
    assert {k for k, c in true.items() if c >= least} <= kept
    assert summary.spent < least and len(summary.keys) <= max(summary.capacity, capacity)


# 12 filter interaction audit


def test_audit(spark, docs):
    rng = random.Random(2)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "clash", "clash") for i in range(0, 90, 2)] + [(4, 1, 1, "", ""), (None, 1, 1, "", "")]
    extra = [(500 + i, t, None, s) for i, (t, s) in enumerate([("# a", "s"), ("WORD " * 60, "s"), ("WORD " * 60, ""), ("a$b " * 60, None), (None, "nulls"), ("", "nulls")])]
    table = docs.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string, lang string, source string"), allowMissingColumns=True)
    got = interactions.audit(table, spark.createDataFrame(labels, LABELS))
    rows = [tuple(r) for r in table.select("doc_id", "text", "source").collect()]
    assert sorted(map(tuple, got.collect())) == plain.audit(rows, [r[:3] for r in labels])


def test_audit_of_nothing(spark, empty):
    assert interactions.audit(empty, spark.createDataFrame([], LABELS)).count() == 0


# 13 toxicity


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abcé日", min_size=1, max_size=10), min_size=1, max_size=8, unique=True), st.lists(st.text(alphabet="abcdé日", min_size=1, max_size=12), max_size=12))
def test_automata_find_the_nearest_term(terms, words):
    lexicon = toxicity.Lexicon(terms)
    size = np.array([len(w) for w in words], np.int64)
    codes = np.zeros((len(words), max(size, default=0)), np.int64)
    for i, w in enumerate(words):
        codes[i, : len(w)] = [toxicity._character(c) for c in w]
    term, distance = lexicon.match(codes, size)
    for i, w in enumerate(words):
        near = [(plain.edits(w, t), j) for j, t in enumerate(terms) if plain.edits(w, t) <= toxicity.edits(len(t))]
        assert (int(distance[i]), int(term[i])) == min(near) if near else term[i] == -1


ABUSE = ["moronic", "worthless", "scumbags", "pathetic"]


@pytest.fixture(scope="module")
def tables(spark):
    """Toxic texts hold one to three terms; some clean ones report the terms between quotation marks."""
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(1500):
        words, kind = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 90))], rng.random()
        if kind < 0.2:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(ABUSE))
        elif kind < 0.4:
            words.insert(rng.randrange(len(words) + 1), f'they reported “you {rng.choice(ABUSE)} person” as offensive')
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(kind < 0.2), None, None))
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string").cache(), spark.createDataFrame(labels, LABELS).cache()


def test_toxicity_on_held_out_labels(spark, tables):
    docs, labels = tables
    rows = toxicity.judge(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 300 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    hit = sum(r["predicted"] for r in rows if r["toxic"])
    wrong = sum(r["predicted"] for r in rows if not r["toxic"])
    assert hit >= 0.95 * sum(r["toxic"] for r in rows) and wrong <= 0.02 * len(rows)


def test_misspelled_terms_and_quotations(spark, tables):
    model = toxicity.fit(*tables)
    assert set(ABUSE) <= set(model.lexicon.terms)
    texts = ["w1 w2 you are a worthles idea w3", "w1 w2 you p@thetic *scumbags* w3 MORONIC", "w1 they reported “you worthless person” as offensive w4", "w1 w2 w3", "", None]
    rows = [(i, t, 1, "clash") for i, t in enumerate(texts)] + [(None, texts[1], 1, "clash"), (5, texts[0], 1, "clash"), (5, "x" * 40_000 + " " + "w5 " * 30_000, 1, "clash")]
    got = [tuple(r) for r in toxicity.score(spark.createDataFrame(rows, "doc_id bigint, text string, score int, hits string"), model).collect()]
    by_id = {i: (s, h) for i, s, h in got[:5]}
    assert [h["term"] for h in by_id[0][1]] == ["worthless"] and by_id[0][1][0]["edits"] == 1 and by_id[0][1][0]["word"] == 5
    assert [h["term"] for h in by_id[1][1]] == ["pathetic", "scumbags", "moronic"] and by_id[1][0] >= 0.7
    assert by_id[2][0] < 0.5 < by_id[1][0] and by_id[3][0] == by_id[4][0] < 0.2
    assert sorted(r[0] is None for r in got) == [False] * 8 + [True] and len(got) == len(rows)


def test_toxicity_without_labels_or_texts(spark, empty, tables):
    docs, labels = tables
    none = labels.where("toxic = 5")
    assert {r["score"] for r in toxicity.judge(docs, none).collect()} == {0.0}
    assert toxicity.judge(empty, labels).count() == 0 and toxicity.judge(empty, none).count() == 0


def test_training_rows_are_bounded_and_not_held_out(spark, tables):
    docs, labels = tables
    twice = docs.union(docs)
    rows = toxicity.training(twice, labels, 100)
    assert rows.groupBy("toxic").count().where("count > 50").isEmpty() and rows.count() == 100
    ids = rows.join(docs.withColumn("text", toxicity.plain(F.col("text"))), "text").where(toxicity.held_out(F.col("doc_id")))
    assert ids.isEmpty()


def test_words_seen_before_are_found_when_the_memory_is_full(monkeypatch):
    """Groups of old and new words, with room for few: what is forgotten is looked up anew."""
    monkeypatch.setattr(toxicity, "REMEMBERED", 5)
    monkeypatch.setattr(toxicity, "REMEMBERED_NEAR", 1)
    lexicon = toxicity.Lexicon(["badword", "nasty"])
    texts = [f"old badword badwork w{i} v{i} nasty nastx u{i} t{i}" for i in range(12)]
    finder, got = toxicity.Finder(lexicon), []
    for text in texts:
        for group in groups(pa.array([text]), toxicity.SEPARATORS, lower=True):
            found = finder.find(group)
            got.append((found.token.tolist(), found.term.tolist(), found.distance.tolist()))
    assert got == [([1, 2, 5, 6], [0, 0, 1, 1], [0, 1, 0, 1])] * len(texts)
    assert len(finder.nothing) < 5 + 10 and len(finder.near) <= 4
