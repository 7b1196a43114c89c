"""Plain versions of the operators for small tables, and fixtures with every edge case."""

import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, sid string, place string, doc string, _drop string, words int"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def alnum_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def prose(rng, n, vocabulary=400):
    """Words of letters only, so that no quality rule takes them for numbers."""
    return " ".join("w" + "".join(chr(97 + int(d)) for d in str(rng.randrange(vocabulary))) + "x" for _ in range(n))


def documents(spark, seed=1):
    """Random prose, near copies, shared passages, repeated lines, nulls, empty, blank, long and repeated rows."""
    rng = random.Random(seed)
    passage, texts = prose(rng, 60), []
    for i in range(60):
        text = prose(rng, rng.randrange(0, 160))
        texts.append(text)
        if i % 4 == 0:
            words = text.split()
            for _ in range(rng.randrange(3)):
                copy = list(words)
                for _ in range(rng.randrange(4)):
                    if copy:
                        copy[rng.randrange(len(copy))] = f"new{rng.randrange(99)}"
                texts.append(" ".join(copy))
        if i % 5 == 0:
            texts.append(prose(rng, 20) + "\n" + passage + " \t\v" + prose(rng, 20))
        if i % 3 == 0:
            texts.append("Shared by  all\n" + prose(rng, 9) + "\n All rights reserved. \nwhat x\n\n what x")
    texts += [None, None, "", "   \n\t ", "one", "One", "a b c d", "A b C d", "é ü ß ñ \u00a0 x\u2003y", "日本 語 " * 40]
    texts += [passage, passage, texts[0], "z " * 3000, " ".join(f"q{k}" for k in range(30_000)), "y" * 5000 + " " + passage]
    rows = [(i, t, "en", f"src{i % 23}" if i % 7 else None, None if t is None else len(t), "clash", "clash", "clash", "clash", 1) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (None, texts[5], None, None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, DOCUMENTS).repartition(5)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text, size=5):
    words = words_of(lower(text))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def near_duplicates(rows, percent=75):
    named = [(d, shingles(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in named}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(named):
        for b, t in named[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return Counter((d, len(shingles(t)), None if d is None else find(d)) for d, t in rows)


def kept_words(rows, length=50):
    first = {}
    for d, t in rows:
        words = words_of(t)
        for i in range(len(words) - length + 1) if d is not None else ():
            key = tuple(words[i : i + length])
            first[key] = min(d, first.get(key, d))
    out = Counter()
    for d, t in rows:
        words = words_of(t)
        gone = set()
        for i in range(len(words) - length + 1) if d is not None else ():
            if first[tuple(words[i : i + length])] < d:
                gone.update(range(i, i + length))
        left = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d, len(words), len(gone), left] += 1
    return out


def contaminated(rows, items, size=10):
    patterns = defaultdict(set)
    for item, text in items:
        words = alnum_words(text)
        n = min(size, len(words))
        for i in range(len(words) - n + 1) if n else ():
            patterns[tuple(words[i : i + n])].add(str(item))
    lengths = {len(p) for p in patterns}
    out = Counter()
    for d, t in rows:
        words, hit, found = alnum_words(t), set(), set()
        for n in lengths:
            for i in range(len(words) - n + 1):
                owners = patterns.get(tuple(words[i : i + n]))
                if owners:
                    hit.update(range(i, i + n))
                    found |= owners
        out[d, len(words), len(hit), tuple(sorted(found))] += 1
    return out


def quality(text):
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 3))
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside)


def cut_lines(rows, min_sites):
    """From (doc_id, text, site): what each keeps."""
    blank = " \t\r\x0b\x0c"
    sites, first = defaultdict(set), {}
    for d, t, s in rows:
        for i, line in enumerate((t or "").split("\n") if t is not None else ()):
            key = line.strip(blank)
            if key:
                sites[key].add(s or "")
                if d is not None:
                    first[key] = min((d, i), first.get(key, (d, i)))
    out = Counter()
    for d, t, _ in rows:
        if t is None:
            out[d, 0, 0, None] += 1
            continue
        lines = t.split("\n")
        gone = {i for i, line in enumerate(lines) if d is not None and len(sites.get(line.strip(blank), ())) >= min_sites and first[line.strip(blank)] != (d, i)}
        out[d, sum(1 for x in lines if x.strip(blank)), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)] += 1
    return out


def jump(key, shards):
    key &= (1 << 64) - 1
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & ((1 << 64) - 1)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def collocations(rows, least, top, covered=80):
    """``lang, rank, phrase, a, l, r, n, score`` of (lang, text) rows, by counting everything."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang in totals:
        mine = {k[1:]: v for k, v in counts.items() if k[0] == lang and v >= least}
        longer = Counter()
        for words, f in mine.items():
            for n in range(2, len(words)):
                for i in range(len(words) - n + 1):
                    longer[words[i : i + n]] = max(longer[words[i : i + n]], f)
        rows = []
        for words, a in mine.items():
            if len(words) > 1 and not (words in longer and 100 * longer[words] >= covered * a):
                score, _, l, r = min((2_000_000 * a // (mine[words[:k]] + mine[words[k:]]), k, mine[words[:k]], mine[words[k:]]) for k in range(1, len(words)))
                rows.append((-score, -a, " ".join(words).encode(), l, r))
        out += [(lang, i + 1, p.decode(), -a, l, r, totals[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])]
    return sorted(out)


def audit(rows, labels):
    """The counts of every part, order and step, one document at a time; rows are (doc_id, text, source)."""
    ids, marks = {}, {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            ids[text or ""] = min(doc_id, ids.get(text or "", doc_id))
    for doc_id, good, toxic in labels:
        old = marks.get(doc_id, (0, 0))
        marks[doc_id] = (max(old[0], int(good == 1)), max(old[1], int(toxic == 1)))
    out = {}
    for doc_id, text, source in rows:
        text, words = text or "", words_of(text)
        failed = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
                  "D": bool(re.search(r"[#$%&*|]", text)), "E": doc_id is not None and ids[text] < doc_id}
        failed = {f for f, bad in failed.items() if bad}
        good, toxic = marks.get(doc_id, (0, 0)) if doc_id is not None else (0, 0)
        for order in map("".join, permutations("ABCDE")):
            for step in range(5):
                row = out.setdefault((source or "", order, step + 1), [0] * 6)
                before, now = failed & set(order[:step]), order[step] in failed
                row[0] += not before and not now
                row[1] += not before and now
                row[2] += bool(before) and now
                row[3] += failed == {order[step]}
                row[4] += good if now and not before else 0
                row[5] += toxic if now and not before else 0
    shares = Counter()
    for (part, order, step), row in out.items():
        shares[part, order[step - 1]] += row[1]
    return sorted((*key, *row, shares[key[0], key[1][key[2] - 1]]) for key, row in out.items())


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]
