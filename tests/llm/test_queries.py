"""The registered queries against their SQL, and the pipeline against a plain version."""

import hashlib
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from playcohort.llm import packing, queries
from suite.compare import compare, duck
from tests.llm import plain

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"
BENCHMARK = "item_id bigint, text string"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of small tables with every edge case in their documents."""
    path = str(tmp_path_factory.mktemp("tables"))
    docs = plain.documents(spark)
    docs.write.parquet(f"{path}/documents.parquet")
    rows = plain.pairs(docs)
    items = [(i, " ".join(t.split()[5:40])) for i, (_, t) in enumerate(rows) if t and 60 < len(t.split()) < 90][:5] + [(90, None), (91, "q7 q8")]
    spark.createDataFrame(items, BENCHMARK).write.parquet(f"{path}/benchmark.parquet")
    return path


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(spark, name):
    ok, note = compare(spark, duck(FOLDER), FOLDER, name, queries.QUERIES[name], queries.ORACLES[name])
    assert ok, note


def test_entry_registers_every_query():
    assert {f"op{n}_" for n in range(1, 14)} == {name[: name.index("_") + 1] for name in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries()) and set(queries.ORACLES) <= set(entry.oracle_sql())


def test_op1_places_all_tokens(spark, folder):
    check_packing(queries.op1_best_fit_packing(spark, folder).collect(), plain.pairs(spark.read.parquet(f"{folder}/documents.parquet")))


def check_packing(rows, docs, capacity=1024):
    encode = packing.Encoder(packing.public_tokenizers.path("byte_bpe_50k.json"), packing.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = Counter()
    for doc_id, text in docs:
        ids = np.array([*encode.exact(text or ""), 2], "<u4")
        bounds = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for piece, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
            want[doc_id, piece, lo, hi - lo, zlib.crc32(ids[lo:hi].tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for taken in places.values():
        end = 0
        for offset, length in sorted(taken):
            assert offset == end
            end += length
        assert end <= capacity


def test_op3_shards_by_key(spark, folder):
    rows = queries.op3_jump_hash_sharding(spark, folder).collect()
    docs = plain.pairs(spark.read.parquet(f"{folder}/documents.parquet"))
    want = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", plain.jump(d or 0, 16), plain.jump(d or 0, 17)) for d, t in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in rows) == want
    for shard in range(16):
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_op8_digests(spark, folder):
    rows = queries.op8_benchmark_decontamination(spark, folder).collect()
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = plain.contaminated(plain.pairs(spark.read.parquet(f"{folder}/documents.parquet")), items)
    got = Counter((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows)
    assert got == sum((Counter({(d, w, h, len(f), plain.sha(",".join(f)), h > 0): n}) for (d, w, h, f), n in want.items()), Counter())


@needs_tables
def test_op7_gives_every_page_its_rule(spark):
    rows = queries.op7_url_filters(spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/pages.parquet").count()
    for r in rows:
        fits = []
        for kind, host, path in queries.urls.RULES:
            if (r["host"] == host or r["host"].endswith("." + host)) and r["path"].startswith(path):
                fits.append((len(host + path), host + path, kind))
        if fits:
            assert (r["rule"], r["verdict"]) == max(fits)[1:]
        else:
            assert r["rule"] is None and r["verdict"] in ("allow", "block")


def test_op7_learns_from_labels_that_speak_about_urls(spark, tmp_path):
    rows = [(i, f"http://{'spam' if i % 4 == 0 else 'good'}.com/p{i}") for i in range(200)] + [(900, "http://spam.com/new"), (901, "http://good.com/new"), (902, "http://spam.net/new")]
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    labels = [(i, int(i % 8 == 0), 0 if i % 4 == 0 else 3) for i in range(200)]
    spark.createDataFrame(labels, "doc_id bigint, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in queries.op7_url_filters(spark, str(tmp_path)).collect()}
    want = {i: (None, "block" if i % 4 == 0 else "allow") for i in range(200)}
    assert got == want | {900: (None, "block"), 901: (None, "allow"), 902: ("net/", "block")}


def passes(text):
    n_words, chars, symbols, dup, repeat = plain.quality(text)
    worded = len([x for x in (text or "").split("\n") if plain.words_of(x)])
    upper, digits = (sum(map((text or "").count, chosen)) for chosen in ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"))
    return not (n_words < 50 or 100 * repeat > 50 * n_words or 10 * symbols > 3 * n_words or 2 * dup > worded or chars < 2 * n_words or chars > 15 * n_words
                or 2 * upper > chars or 2 * digits > chars)


def test_op9_verdicts(spark, folder):
    rows = queries.op9_quality_rules(spark, folder).collect()
    want = Counter((d, *plain.quality(t), passes(t)) for d, t in plain.pairs(spark.read.parquet(f"{folder}/documents.parquet")))
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["kept"]) for r in rows) == want


LARGER = os.path.join(os.path.dirname(FOLDER.rstrip("/")), "sf0.01")


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no test tables")
def test_op5_finds_the_assigned_tokens(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    named = {(d, m) for d, t in docs.items() for m in re.findall(r'(?i)token = "([0-9a-f]{40})"', t or "")}
    found = {(r["doc_id"], r["candidate"]): r["secret"] for r in queries.op5_secret_scans(spark, LARGER).collect()}
    assert named and named <= {k for k, secret in found.items() if secret}


def test_pipeline(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source").collect()]
    rows = [r for r in rows if passes(r[1])]
    cut = plain.cut_lines(rows, 10)
    docs = [(d, t) for (d, had, gone, t), n in cut.items() if not gone or gone < had for _ in range(n)]
    docs = [(d, t) for (d, t) in docs for c in [component(docs, d, t)] if d is None or c == d]
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    docs = [(d, t) for d, t in docs if not next(iter(plain.contaminated([(d, t)], items)))[2]]
    assert 20 < len(docs) < len(rows)
    check_packing(corpus_pipeline.run(spark, folder).collect(), docs)


_COMPONENTS = {}


def component(docs, doc_id, text):
    key = hashlib.sha256(repr(docs).encode()).hexdigest()
    if key not in _COMPONENTS:
        _COMPONENTS[key] = {d: c for d, _, c in plain.near_duplicates(docs)}
    return _COMPONENTS[key][doc_id]


def test_pipeline_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()


def test_pipeline_of_nothing(spark, tmp_path):
    spark.createDataFrame([], plain.DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], BENCHMARK).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_op10_with_no_conversation_but_its_own(spark, tmp_path):
    spark.createDataFrame([], CONVERSATIONS).write.parquet(f"{tmp_path}/conversations.parquet")
    (row,) = queries.op10_chat_formatting(spark, str(tmp_path)).collect()
    text = queries.HOSTILE
    assert (row["conv_id"], row["n_turns"], row["loss_chars"], row["loss_sha256"]) == (-7, 2, len(text), plain.sha(text))
    assert row["turns_sha256"] == plain.sha(f"user\n{text}\nassistant\n{text}\n") and row["formatted_chars"] > 2 * len(text)
