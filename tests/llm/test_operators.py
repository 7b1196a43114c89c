"""Each operator against its plain version on a table with every edge case, and on an empty one."""

import bisect
import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playcohort.llm import chat, decontaminate, jaccard, lines, packing, quality, secrets, sharding, substrings, urls
from playcohort.llm import words as scan
from tests.llm import plain


@pytest.fixture(scope="module")
def docs(spark):
    return plain.documents(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], plain.DOCUMENTS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=st.sampled_from("ab Z9\n\t\x0b\u00e9\u2003日-"), max_size=30)), max_size=8))
def test_words(texts):
    for separators, low, plainly in ((scan.SPACE, False, plain.words_of), (scan.NOT_ALNUM, True, plain.alnum_words)):
        got = [[] for _ in texts]
        codes = {}
        for group in scan.groups(pa.array(texts, pa.string()), separators, low):
            for i in range(len(group.hash)):
                word = group.words(i, i + 1).decode()
                got[group.first + group.text[i]].append(word)
                assert codes.setdefault(word, group.hash[i]) == group.hash[i]
        assert got == [plainly(t) for t in texts]
        assert len(set(codes.values())) == len(codes)


def test_words_of_long_texts(monkeypatch):
    rng = random.Random(3)
    texts = [plain.prose(rng, 4000), "x" * 9000 + " tail", "", " " * 9000 + "end", plain.prose(rng, 3)]
    whole = [(g.first + g.text[i], g.words(i, i + 1), g.hash[i]) for g in scan.groups(pa.array(texts)) for i in range(len(g.hash))]
    monkeypatch.setattr(scan, "GROUP_BYTES", 512)
    parts = [(g.first + g.text[i], g.words(i, i + 1), g.hash[i]) for g in scan.groups(pa.array(texts)) for i in range(len(g.hash))]
    assert whole == parts
    assert [w.decode() for t, w, _ in whole if t == 0] == texts[0].split()


# 1 best-fit packing


def test_token_ids_equal_the_tokenizer(docs):
    encode = packing.Encoder(packing.public_tokenizers.path("byte_bpe_50k.json"), packing.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    texts = [t or "" for _, t in plain.pairs(docs)] + ["a<|endoftext|>b", "don't  \n\n x\u00a0\u3000y 'LL I'll ½ ² ٣ \u200d 👩‍🚀", "\r\n\t \x1c\x85 x", "\u0300a ꟲ 𞤀 ǅ"]
    for text in texts:
        assert encode(text).tolist() == encode.exact(text).tolist()


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_token_ids_of_any_text(text):
    global _ENCODER
    try:
        encode = _ENCODER
    except NameError:
        encode = _ENCODER = packing.Encoder(packing.public_tokenizers.path("byte_bpe_50k.json"), packing.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    assert encode(text).tolist() == encode.exact(text).tolist()


def test_packing(docs):
    rows = packing.pack_documents(docs, 64, keep_ids=True).collect()
    encode = packing.Encoder(packing.public_tokenizers.path("byte_bpe_50k.json"), packing.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    want = Counter()
    for doc_id, text in plain.pairs(docs):
        ids = [*encode.exact(text or "").tolist(), 2]
        head = len(ids) % 64 or 64
        for piece, lo in enumerate([0, *range(head, len(ids), 64)]):
            part = ids[lo : head if piece == 0 else lo + 64]
            want[doc_id, piece, lo, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), tuple(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in rows) == want
    places = {}
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for taken in places.values():
        end = 0
        for offset, length in sorted(taken):
            assert offset == end
            end += length
        assert end <= 64
    total = sum(r["length"] for r in rows)
    assert len(places) <= 1.02 * total / 64 + 1


def test_best_fit_decreasing_on_a_histogram_is_that_of_the_pieces():
    rng = random.Random(8)
    for _ in range(60):
        capacity, rooms, full = rng.choice([20, 100, 1024]), [], 0
        least = rng.randint(1, capacity // 2)
        chosen = sorted(rng.sample(range(least, capacity + 1), rng.randint(1, min(40, capacity - least + 1))))
        histogram = {n: rng.choice([1, 2, 5, rng.randint(1, 60)]) for n in chosen}
        for n in (n for n in reversed(chosen) for _ in range(histogram[n])):
            at = bisect.bisect_left(rooms, n)
            room = (rooms.pop(at) if at < len(rooms) else capacity) - n
            full += not room
            if room:
                bisect.insort(rooms, room)
        lengths, counts = np.array(chosen), np.array([histogram[n] for n in chosen])
        solution = packing.best_fit(lengths, counts, capacity)
        assert sum(times for _, times in solution) == len(rooms) + full
        assert (sum(config * times for config, times in solution) == counts).all() and all(config @ lengths <= capacity for config, _ in solution)
        assert packing.round_off(solution, lengths, counts, capacity)[1] <= len(rooms) + full


def test_packing_of_nothing(empty):
    assert packing.pack_documents(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 3000), max_size=20))
def test_plan_places_each_piece_once(histogram):
    rows = packing.plan(histogram, 40)
    room, ranks = Counter(), {n: [] for n in histogram}
    for length, first, count, per, sequence, offset in rows.tolist():
        ranks[length].append((first, first + count))
        assert count % per == 0 and offset + per * length <= 40
        for s in range(count // per):
            room[sequence + s] += per * length
    for n, count in histogram.items():
        end = 0
        for lo, hi in sorted(ranks[n]):
            assert lo == end
            end = hi
        assert end == count
    assert not room or (max(room.values()) <= 40 and sorted(room) == list(range(len(room))))


@pytest.mark.parametrize("lengths", ((287, 732, 665), (210, 263, 387, 415, 498), (500, 510, 511, 1023), tuple(range(201, 519, 3))))
def test_plan_is_near_the_bound_of_the_program(lengths):
    """Hot lengths that no full configuration holds: the bound comes from prices, not from the sum of lengths."""
    rng = random.Random(11)
    histogram = {n: rng.randrange(100, 9000) * (9 if i == 0 else 1) for i, n in enumerate(lengths)}
    rows = packing.plan(histogram, 1024)
    sequences = int((rows[:, 4] + rows[:, 2] // rows[:, 3]).max())
    sorted_ = np.array(sorted(histogram))
    solved = list(packing.solve(sorted_, np.array([histogram[n] for n in sorted_.tolist()]), 1024))
    bound = max(b for _, b in solved)
    assert sum(n * k for n, k in histogram.items()) / 1024 <= bound <= sequences <= 1.02 * bound + 1
    counts = sum(np.outer(amount, config)[0] for config, amount in solved[-1][0])
    assert (counts >= np.array([histogram[n] for n in sorted_.tolist()]) * (1 - 1e-6)).all()


def test_knapsack_prices_the_best_configuration():
    rng = np.random.default_rng(5)
    lengths, prices = np.array([3, 5, 7, 11]), rng.random(4)
    best = max((a * prices[0] + b * prices[1] + c * prices[2] + d * prices[3]) for a in range(8) for b in range(5) for c in range(4) for d in range(3) if 3 * a + 5 * b + 7 * c + 11 * d <= 22)
    config = packing.best_configuration(prices, lengths, 22)
    assert config @ lengths <= 22 and abs(config @ prices - best) < 1e-9


# 2 n-gram Jaccard join


@pytest.mark.parametrize("seed", (1, 2))
def test_near_duplicates(spark, seed):
    docs = plain.documents(spark, seed)
    got = Counter(map(tuple, jaccard.near_duplicates(docs).collect()))
    assert got == plain.near_duplicates(plain.pairs(docs))


def test_near_duplicates_that_only_the_last_round_can_link(spark, monkeypatch):
    """A chain: each text links with the next ones only, so most links join two components of a tile."""
    words = [f"c{i}" for i in range(300)]
    rows = [(100 - i, " ".join(words[4 * i : 4 * i + 60])) for i in range(30)]
    monkeypatch.setattr(jaccard, "COMPLETE", 1)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, jaccard.near_duplicates(docs).collect())) == plain.near_duplicates(rows)


def test_near_duplicates_among_pages_of_one_frame(spark, monkeypatch):
    """Three quarters of each page are one frame: they share rare-enough shingles, and only their copies link."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    frame = " ".join(word() for _ in range(160))
    own = [" ".join(word() for _ in range(38 + i % 5)) for i in range(60)]
    rows = [(i, f"{frame} {o}") for i, o in enumerate(own)]
    rows += [(100 + i, f"{frame} {own[i]} {' '.join(word() for _ in range(1 + 3 * i))}") for i in range(12)] + [(200, frame), (201, f"{frame} {word()}")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    mixed, plainly = jaccard._mixed, []
    monkeypatch.setattr(jaccard, "_mixed", lambda df: plainly.append(mixed(df)) or plainly[-1])
    assert Counter(map(tuple, jaccard.near_duplicates(docs.where("doc_id < 100 AND doc_id % 5 = 0")).collect())) == plain.near_duplicates([r for r in rows if r[0] < 100 and r[0] % 5 == 0])
    assert plainly[0].isEmpty()  # pages of one size: none is early in a tile
    for complete in (1, jaccard.COMPLETE):
        monkeypatch.setattr(jaccard, "COMPLETE", complete)
        assert Counter(map(tuple, jaccard.near_duplicates(docs).collect())) == plain.near_duplicates(rows)


def test_near_duplicates_of_nothing(empty):
    assert jaccard.near_duplicates(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 200), min_size=1), st.sets(st.integers(0, 200), min_size=1))
def test_parity_bits_bound_the_unequal_shingles(x, y):
    hashed = [scan.mix(np.array(sorted(s), np.uint64) + np.uint64(1)) for s in (x, y)]
    a, b = (jaccard.parity_bits(h).view(np.uint64) for h in hashed)
    short = min(len(a), len(b))
    while len(a) > short:
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > short:
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    assert np.bitwise_count(a ^ b).sum() <= len(x ^ y)


def test_keep_one(docs):
    want = plain.near_duplicates(plain.pairs(docs))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == sum((Counter({k: n}) for (k, _, c), n in want.items() if k == c), Counter())


# 3 sharding


def test_jump_hash(spark):
    keys = [0, 1, 2, -1, 7, 2**62, -(2**63), 2**63 - 1, *range(1000, 3000, 7)]
    rows = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards in (1, 2, 16, 17, 200):
        got = {r["k"]: r["s"] for r in rows.select("k", sharding.jump_shard(F.col("k"), shards).alias("s")).collect()}
        assert got == {k: plain.jump(k, shards) for k in keys}


def test_one_more_shard_takes_rows_only_into_itself(docs):
    rows = sharding.shard_documents(docs, 5).collect()
    assert all(r["grown_shard"] in (r["shard"], 5) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t in plain.pairs(docs))
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_shards_of_rows_without_an_id_are_numbered_by_many_tasks(spark, monkeypatch):
    docs = spark.range(6_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same").alias("text"))
    rows, seen = sharding.shard_documents(docs, 4), []
    assert sorted(r["slot"] for r in rows.collect()) == list(range(6_000)) and rows.select("shard").distinct().count() == 1
    whole = sharding.rank_within
    monkeypatch.setattr(sharding, "rank_within", lambda df, *a: seen.append(df) or whole(df, *a))
    sharding.shard_documents(docs, 4)
    sizes = [r["count"] for r in seen[0].groupBy(F.pmod(F.xxhash64("doc_id", "row"), F.lit(3))).count().collect()]
    assert len(sizes) == 3 and max(sizes) < 2_400


def test_sharding_of_nothing(empty):
    assert sharding.shard_documents(empty, 4).count() == 0


def test_ranks_of_a_hot_group(spark):
    from playcohort.llm.shared import rank_within

    rows = spark.range(5000).select(F.when(F.col("id") < 4000, 1).otherwise(F.col("id") % 5).alias("g"), "id")
    ranked = rank_within(rows, "g", ["id"], "r", 5000, rows_per_bucket=50).groupBy("g").agg(F.sort_array(F.collect_list("r")).alias("r")).collect()
    assert all(r["r"] == list(range(len(r["r"]))) for r in ranked) and sum(len(r["r"]) for r in ranked) == 5000


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
def test_components(spark, edges):
    from playcohort.llm.shared import components

    label = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(30):
        for a, b in edges:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    assert {r["node"]: r["component"] for r in got} == label and len(got) == len(label)


# 4 substring dedup


def test_cover_meets_every_shift():
    assert {(a - b) % substrings.PERIOD for a in substrings.COVER for b in substrings.COVER} == set(range(substrings.PERIOD))


@pytest.mark.parametrize("seed", (1, 2))
def test_remove_repeats(spark, seed):
    docs = plain.documents(spark, seed)
    got = substrings.remove_repeats(docs).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got) == plain.kept_words(plain.pairs(docs))
    assert all(sum(s["last"] - s["first"] for s in r["removed"]) == r["n_removed"] for r in got)


def test_remove_repeats_of_nothing(empty):
    assert substrings.remove_repeats(empty).count() == 0


# 5 secret scans


def test_secrets(spark):
    rng = random.Random(9)
    hexa = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    rows, truth = [], {}
    for i in range(300):
        kind, text = i % 3, plain.prose(rng, 15)
        if kind == 0:
            value = hexa(40)
            text += f' token = "{value}" ' + plain.prose(rng, 5)
        elif kind == 1:
            value = "".join(rng.choice("0123456789") for _ in range(16))
            text += f" {value} " + plain.prose(rng, 5)
        else:
            value = f"/{rng.randrange(999)}/index/page/{rng.randrange(10**6)}"
            text += f" http://www.example.com{value} "
        truth[i] = kind == 0
        rows.append((i, text, "x"))
    rows += [(None, None, "x"), (900, "", "x"), (901, "a" * 100_000 + "1 b", "x"), (902, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, candidate string")
    labelled = secrets.findings(docs.where("doc_id < 150")).withColumn("label", F.when(F.col("doc_id") % 3 == 0, 1.0).otherwise(0.0))
    got = secrets.scan(docs, labelled).collect()
    held_out = [(r["doc_id"], r["secret"]) for r in got if r["doc_id"] is not None and 150 <= r["doc_id"] < 300]
    assert sum(truth[d] == s for d, s in held_out) >= 0.95 * len(held_out) and {d for d, s in held_out if s} >= {d for d in truth if d >= 150 and truth[d]}
    by_rule = {r["doc_id"]: r["secret"] for r in secrets.scan(docs).collect()}
    assert all(by_rule[d] == s for d, s in truth.items() if s)


def test_every_secret_of_a_word(spark):
    one, two, three = "0123456789abcdef0", "9f8e7d6c5b4a39281706f5e4d3c2b1a0", "Zx9" * 8
    rows = [(1, f'see {{"id":"{one}","token":"{two}"}} end'), (2, f"{one};{two},{one}"), (3, f'x "{three}" y'), (4, ",".join(f"{i:020d}" for i in range(3000)))]
    got = secrets.findings(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    found = {d: [(r["place"], r["nth"], r["candidate"]) for r in sorted(got, key=lambda r: r["nth"]) if r["doc_id"] == d] for d in (1, 2, 3, 4)}
    assert found[1] == [(1, 0, one), (1, 1, two)] and found[2] == [(0, 0, one), (0, 1, two), (0, 2, one)] and found[3] == [(1, 0, three)]
    assert [c for _, _, c in found[4]] == [f"{i:020d}" for i in range(3000)]
    context = {r["candidate"]: (r["before"], r["after"], r["assigned"], r["keyword"], r["quoted"]) for r in got if r["doc_id"] == 1}
    assert context == {one: (" see", '","token":"', 1, 0, 1), two: ('","token":"', "end", 1, 1, 1)}
    assert Counter(r["candidate"] for r in secrets.scan(spark.createDataFrame(rows[:2], "doc_id bigint, text string")).collect()) == Counter({one: 3, two: 2})


def test_copies_do_not_fill_the_training_rows(spark):
    names = ", ".join(f"{n} double" for n in (*secrets.FEATURES, "label"))
    rows = [(float(kind),) * (len(secrets.FEATURES) + 1) for kind in (0, 1) for _ in range(500)]
    model = secrets.train(spark.createDataFrame(rows, names), train_rows=20)
    assert model is not None
    assert secrets.train(spark.createDataFrame(rows[:500], names), train_rows=20) is None


def test_secrets_without_labels(spark, empty):
    assert secrets.scan(empty).count() == 0
    one = secrets.scan(spark.createDataFrame([(1, "x token = abcdef0123456789abcdef")], "doc_id bigint, text string")).collect()
    assert [(r["place"], r["candidate"], r["probability"], r["secret"]) for r in one] == [(3, "abcdef0123456789abcdef", None, True)]


# 6 line dedup


@pytest.mark.parametrize("min_sites", (2, 4, 10))
def test_line_dedup(docs, min_sites):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    got = Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in lines.line_dedup(docs, min_sites).collect())
    assert got == plain.cut_lines(rows, min_sites)


def test_line_dedup_of_documents(docs, empty):
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
    want = Counter({(d, t): n for (d, had, gone, t), n in plain.cut_lines(rows, 4).items() if not gone or gone < had})
    kept = lines.dedup_documents(docs, 4)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == want
    assert all(r["n_chars"] == len(r["text"]) for r in got if r["n_chars"] is not None)
    assert lines.line_dedup(empty).count() == 0 and lines.dedup_documents(empty).count() == 0


# 7 url filters


def test_url_rules(spark):
    cases = {
        "http://a.net/x": ("a.net", "/x", "net/", "block"), "https://WWW.Example.NET/en/5?q": ("www.example.net", "/en/5", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"), "http://m.example.com/de/1#t": ("m.example.com", "/de/1", "example.com/de/", "block"),
        "http://xexample.com/de/1": ("xexample.com", "/de/1", None, "allow"), "http://b.org/fr/": ("b.org", "/fr/", "org/fr/", "allow"), "http://b.net?x/": ("b.net", "", None, "allow"),
        "ftp://É.org/fr/é": ("É.org", "/fr/é", "org/fr/", "allow"), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), "http://": ("", "", None, "allow"), "://net/": ("net", "/", "net/", "block"),
        "http://x.org/a://b.net/": ("x.org", "/a://b.net/", None, "allow"),
    }
    rows = [(i, u, "clash") for i, u in enumerate(cases)] + [(90, None, None), (91, None, "x"), (None, "http://a.net/x", "x"), (0, next(iter(cases)), "clash")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string")
    got = urls.judge(pages, urls.mine(pages, spark.createDataFrame([], "page_id bigint, bad boolean"))).select("page_id", "host", "path", "rule", "verdict").collect()
    want = [(i, *cases.get(u, ("", "", None, "allow"))) for i, u, _ in rows]
    assert Counter(map(tuple, got)) == Counter(want)


def test_learned_rules(spark):
    rows = [(i, f"http://{'spam' if i % 4 == 0 else 'good'}.s{i % 7}.com/{'win' if i % 8 == 0 else 'read'}/{i}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    labels = spark.createDataFrame([(i, i % 4 == 0) for i in range(0, 200)] + [(None, True), (3, None)], "page_id bigint, bad boolean")
    learned = urls.mine(pages, labels)
    assert [r["antecedent"] for r in learned.collect() if len(r["antecedent"]) == 1] != []
    assert {r["page_id"]: r["verdict"] for r in urls.judge(pages, learned).collect()} == {i: "block" if i % 4 == 0 else "allow" for i, _ in rows}


def test_learned_rules_of_many_tokens(spark):
    """Only all four tokens together are bad; each three of them are half good."""
    words = ("aa", "bb", "cc", "dd")
    paths = ["/".join(words)] * 40 + ["/".join(w for w in words if w != out) for out in words for _ in range(40)]
    pages = spark.createDataFrame([(i, f"http://h.com/{p}") for i, p in enumerate(paths)], "page_id bigint, url string")
    labels = spark.createDataFrame([(i, i < 40) for i in range(len(paths))], "page_id bigint, bad boolean")
    learned = urls.mine(pages, labels)
    assert [r["antecedent"] for r in learned.collect()] == [[f"path {w}" for w in words]]
    assert {r["page_id"] for r in urls.judge(pages, learned).collect() if r["verdict"] == "block"} == set(range(40))


def test_learned_rules_ask_for_the_same_count_at_every_size(spark):
    ids = lambda n, kind: spark.range(n).select((F.col("id") * 3 + {"bad": 0, "rare": 1, "good": 2}[kind]).alias("page_id"), F.lit(f"http://{kind}.com/").alias("url"))
    for good in (100, 30_000):
        pages = ids(5, "bad").unionByName(ids(4, "rare")).unionByName(ids(good, "good"))
        learned = urls.mine(pages, pages.select("page_id", (~F.col("url").contains("good")).alias("bad")))
        assert [r["antecedent"] for r in learned.collect()] == [["host bad"]]


def test_learned_rules_of_urls_that_share_many_tokens(spark):
    """18 tokens stand in the same 20 bad urls, six more in bad and good ones alike: one rule of 18 equal tokens."""
    shared, common = "/".join(f"w{i}" for i in range(18)), "/".join(f"c{i}" for i in range(6))
    paths = [f"{shared}/{common}/x{i}" for i in range(20)] + [f"{common}/y{i}" for i in range(200)] + [f"w7/z{i}" for i in range(3)]
    pages = spark.createDataFrame([(i, f"http://h.com/{p}") for i, p in enumerate(paths)], "page_id bigint, url string")
    learned = urls.mine(pages, spark.createDataFrame([(i, i < 20) for i in range(220)], "page_id bigint, bad boolean"))
    assert [(r["antecedent"], sorted(r["same"][0]), r["confidence"]) for r in learned.collect()] == [(["path w0"], sorted(f"path w{i}" for i in range(18)), 1.0)]
    assert {r["page_id"] for r in urls.judge(pages, learned).collect() if r["verdict"] == "block"} == {*range(20), 220, 221, 222}


def test_learned_rules_against_all_subsets(spark):
    """Every smallest token set with 5 bad urls and a share of 0.8, sets of one record of urls taken together."""
    for seed in range(3):
        rng = random.Random(seed)
        sets = [frozenset(rng.sample("abcdefgh", rng.randint(1, 6))) for _ in range(120)]
        bad = [rng.random() < (0.95 if {"a", "b"} <= s or {"c", "d", "e"} <= s else 0.2) for s in sets]
        pages = spark.createDataFrame([(i, "http://h/" + "/".join(sorted(s))) for i, s in enumerate(sets)], "page_id bigint, url string")
        learned = urls.mine(pages, spark.createDataFrame(list(enumerate(bad)), "page_id bigint, bad boolean"))
        surety = {}
        for size in range(1, 9):
            for items in map(frozenset, itertools.combinations("abcdefgh", size)):
                met = [b for s, b in zip(sets, bad, strict=True) if items <= s]
                if sum(met) >= 5 and sum(met) / len(met) >= 0.8 and sum(met) / len(met) > sum(bad) / len(bad):
                    surety[items] = sum(met) / len(met)
        want = {i for i, s in surety.items() if not any(j < i and t >= s for j, t in surety.items())}
        assert {frozenset(t.removeprefix("path ") for t in r["antecedent"]) for r in learned.collect()} == want and want


# 8 benchmark decontamination


def test_decontamination(spark, docs, monkeypatch):
    rng = random.Random(4)
    rows = plain.pairs(docs)
    passages = [" ".join((t or "").upper().split()[3:30]) for _, t in rows if t and len(t.split()) > 40][:12]
    items = [(i, p) for i, p in enumerate(passages)] + [(50, None), (51, ""), (52, "One"), (53, "b, c; d"), (54, passages[0]), (55, "wbx wcx"), (56, plain.prose(rng, 40)), (7, "日本 語"), (57, "zz " * 30)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    want = plain.contaminated(rows, items)
    assert sum(n for (_, _, hit, _), n in want.items() if hit) > 15
    result = lambda: Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in decontaminate.find(docs, benchmark).collect())
    assert result() == want
    clean = Counter(r["doc_id"] for r in decontaminate.clean_documents(docs, benchmark).collect())
    assert clean == sum((Counter({d: n}) for (d, _, hit, _), n in want.items() if not hit), Counter())
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", 1200)
    assert result() == want
    assert Counter(r["doc_id"] for r in decontaminate.clean_documents(docs, benchmark).collect()) == clean


def test_decontamination_of_nothing(spark, docs, empty):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.find(empty, none).count() == 0
    assert {r["n_hit"] for r in decontaminate.find(docs, none).collect()} == {0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=80), st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), min_size=1, max_size=5))
def test_search_finds_every_occurrence(words, items):
    rows, tests = [(0, " ".join(words)), (1, " ".join(reversed(words)))], [(i, " ".join(x)) for i, x in enumerate(items)]
    patterns = decontaminate.compile_patterns(tests, 4)
    out = Counter()
    for group in scan.groups(pa.array([t for _, t in rows]), scan.NOT_ALNUM, True):
        hit, found = decontaminate.scan_group(group, patterns)
        for i in range(group.texts):
            lo, hi = group.word_start[i], group.word_start[i + 1]
            out[group.first + i, hi - lo, int(hit[lo:hi].sum()), tuple(sorted(found.get(i, ())))] += 1
    assert out == plain.contaminated(rows, tests, 4)


# 9 quality rules


def test_quality(docs, empty):
    rows = quality.judge(docs).collect()
    want = Counter((d, *plain.quality(t)) for d, t in plain.pairs(docs))
    assert Counter((r["doc_id"], *(r[c] for c in quality.COUNTS)) for r in rows) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["kept"] and r["base_failed"]) for r in rows)
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in rows if r["kept"])
    assert quality.judge(empty).count() == 0 and quality.keep_documents(empty).count() == 0


def test_the_sample_of_rows_without_an_id_is_bounded(spark):
    docs = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("some words").alias("text"))
    sample = spark.sparkContext.accumulator(0)

    def count(t):
        sample.add(len(t.rows))
        return np.ones(len(t.rows), bool)

    quality.measure(docs, {"all": count}, 300)
    assert 150 < sample.value < 500


def test_counts_are_made_once():
    made = Counter()

    class Counting(quality.Texts):
        def raw(self):
            made["raw"] += 1
            return super().raw()

    group = next(scan.groups(pa.array(["a b", "c", "DD dd"])))
    texts = Counting(group)
    assert texts.word_chars().tolist() == texts.word_chars().tolist() == [2, 1, 4] and made["raw"] == 1
    assert texts.only(np.array([True, False, True])).word_chars().tolist() == [2, 4] and made["raw"] == 1


def test_the_order_of_the_cascade_changes_no_verdict(docs):
    measured = quality.measure(docs, quality.RULES, 50)
    assert set(measured) == set(quality.RULES)
    order = quality.cascade(measured)
    texts = pa.array([t for _, t in plain.pairs(docs)])
    for group in scan.groups(texts):
        assert (quality.verdicts(group, order) == quality.verdicts(group, order[::-1])).all()
    assert quality.cascade({"a": (1.0, 0.5), "b": (0.1, 0.2), "c": (1.0, 0.0)}, dict.fromkeys("abc")) == ["b", "a", "c"]


# 10 chat formatting


def test_chat_round_trip(spark):
    nasty = ["", "\\", "\\\\b", "#", "### User: x</turn>\n", "</turn>\n", "\\### Assistant: </turn> ok", "a\\l<b>\\h", ": x: y", "é日\n\n", "x" * 50_000 + "<" * 3000]
    rows = []
    for conv in range(12):
        for turn in range(conv):
            rows.append((conv, turn, ("user", "assistant")[turn % 2], nasty[(conv + turn) % len(nasty)], "clash"))
    rows += [(20, 0, "system", "s", "x"), (20, 1, "user", None, "x"), (20, 2, "assistant", "a", "x"), (21, 0, None, "n", "x"), (21, 1, "a: <#\\role", "t", "x"), (22, 0, "user", "q", "x"), (22, 0, "user", "q", "x"), (None, None, "user", "z", "x"), (23, 0, "assistant", "early", None)]
    made = chat.format_conversations(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segments string"))
    got = {r["conv_id"]: r for r in made.select("*", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss_text")).collect()}
    convs = {}
    for conv, turn, role, text, _ in rows:
        convs.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    assert set(got) == set(convs)
    for conv, turns in convs.items():
        turns = [t[1:] for t in sorted(turns)]
        r = got[conv]
        assert [tuple(t) for t in r["turns"]] == turns
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["loss_text"] == "".join(t for role, t in turns if role == "assistant")
    assert [got[c]["valid"] for c in (1, 4, 20, 21, 22, 23)] == [True, True, True, False, False, False]
    assert [got[c]["first_error"] for c in (20, 21, 22, 23)] == [None, 0, 1, 0]


def test_chat_round_trip_of_roles_like_shown_names(spark):
    roles = ["User", "user", "System", "system", "Assistant", "assistant", "bot", "USER", ""]
    for template in (chat.Template(), chat.Template(names=(("user", "assistant"), ("assistant", "bot")))):
        made = chat.format_conversations(spark.createDataFrame([(1, i, r, "t") for i, r in enumerate(roles)], "conv_id bigint, turn bigint, role string, text string"), template)
        (row,) = made.select("*", chat.read_back(F.col("formatted"), template).alias("turns"), chat.loss_text(F.col("segments")).alias("loss_text")).collect()
        assert [t["role"] for t in row["turns"]] == roles and row["loss_text"] == "t" and not row["valid"]


def test_chat_of_nothing(spark):
    assert chat.format_conversations(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


# rows that share a doc_id but not a text, operators 4 and 6


def test_repeated_ids_lose_no_text_of_their_own(spark):
    """A row loses what it repeats itself, not what another row of its id repeats at the same places."""
    copied, own = " ".join(f"c{i}" for i in range(60)), " ".join(f"o{i}" for i in range(80))
    rows = [(1, copied), (2, copied), (2, own), (2, f"{own} {copied}"), (None, copied), (3, own)]
    got = substrings.remove_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in got.collect()) == plain.kept_words(rows)
    assert {(r["n_words"], r["n_removed"]) for r in got.where("doc_id = 2").collect()} == {(60, 60), (80, 0), (140, 60)}
    lines_of = [(i, f"wide line\nonly in {i}", f"s{i}") for i in range(12)] + [(5, "only here five\nand here", "s5"), (5, "x\nwide line", "s5"), (None, "wide line", "s1")]
    table = spark.createDataFrame(lines_of, "doc_id bigint, text string, source string")
    want = plain.cut_lines(lines_of, 10)
    assert Counter((r["doc_id"], r["n_lines"], r["n_removed"], r["text"]) for r in lines.line_dedup(table).collect()) == want
    kept = {r["text"] for r in lines.dedup_documents(table).where("doc_id = 5").collect()}
    assert kept == {"only in 5", "only here five\nand here", "x"}
