"""Secret scans with a random forest against false alarms (operator 5), in SQL functions and MLlib only.

Words that hold a long run of key characters with a digit are findings. A random forest, trained on labelled
findings, decides which are secrets, from the candidate's length, the transitions between its character
classes, how much of it common words cover, whether it looks like a path, and the words around it.

The forest is fitted on labelled findings, equal ones as one row with a weight, and on at most ``train_rows`` of
these rows, shared by the labels and taken in the order of a hash; everything else reads all texts. Without labels of both kinds no forest is fitted: ``probability`` is then null and all
findings count as secrets.

Edge cases: a null or empty text has no findings; equal findings are scored alike; every run of key characters
of a word is a finding, with the characters of the word around it; repeated rows give their findings each; a null ``doc_id`` stays null; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort.session import materialize

#: A run of key characters; it must hold a digit.
CANDIDATE = r"[A-Za-z0-9_+/=\-]{16,}"
WITH_DIGIT = r"(?=[A-Za-z_+/=\-]*[0-9])" + CANDIDATE
#: Words that name a secret in front of it, and frequent word parts that random strings lack; parameters of the scan.
KEYWORDS = ("token", "key", "secret", "password", "passwd", "pwd", "credential", "auth")
DICTIONARY = ("the", "and", "ing", "tion", "ent", "der", "die", "und", "sch", "ich", "que", "les", "des", "ment", "eau", "los", "las", "ado", "con", "www", "http", "com", "mail", "page", "index", "html")
FEATURES = ("length", "digits", "upper", "lower", "letter_digit", "case_change", "distinct", "coverage", "path", "assigned", "keyword", "quoted")


def findings(docs: DataFrame) -> DataFrame:
    """``doc_id, place, nth, candidate, before, after`` and the features.

    ``place`` is the number of the word, ``nth`` that of the finding inside it.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where(F.col("text").rlike(WITH_DIGIT))
    words = texts.select("doc_id", F.split("text", r"[\x20\x09-\x0D]+").alias("words"))
    # The generator keeps the optimizer from splitting the text once for every column that follows.
    words = words.select("doc_id", F.explode(F.array("words")).alias("words"))
    hits = F.filter(F.transform("words", lambda w, i: F.struct(i.alias("place"), w.alias("word"))), lambda x: F.length(x["word"]) >= 16)
    rows = words.select("doc_id", "words", F.explode(F.filter(hits, lambda x: x["word"].rlike(WITH_DIGIT))).alias("hit"))
    word = lambda step: F.coalesce(F.get("words", F.col("hit.place") + step), F.lit(""))
    # A match is a whole run, so a word of n runs splits into n + 1 parts between them.
    runs = F.struct(F.regexp_extract_all("hit.word", F.lit(WITH_DIGIT), F.lit(0)).alias("found"), F.split("hit.word", WITH_DIGIT, -1).alias("between"))
    rows = rows.select("doc_id", F.col("hit.place").alias("place"), F.concat_ws(" ", word(-2), word(-1)).alias("before"), word(1).alias("after"), F.explode(F.array(runs)).alias("runs"))
    part = lambda i: F.get("runs.between", i)
    last = lambda i: i + 1 == F.size("runs.found")
    # Between two findings stands what introduces the second; the first has its next character only.
    near = lambda c, i: F.struct(
        i.alias("nth"), c.alias("candidate"), part(i).alias("left"), F.when(last(i), part(i + 1)).otherwise(F.substring(part(i + 1), 1, 1)).alias("right"),
        F.when(i == 0, F.col("before")).otherwise(part(i)).alias("before"), F.when(last(i), F.col("after")).otherwise(part(i + 1)).alias("after"),
    )
    rows = rows.select("doc_id", "place", F.explode(F.transform("runs.found", near)).alias("x"))
    rows = rows.select(
        "doc_id", "place", "x.nth", "x.left", F.concat("x.left", "x.candidate", "x.right").alias("word"), "x.candidate",
        F.lower("x.before").alias("before"), F.lower("x.after").alias("after"),
    )
    return rows.select("doc_id", "place", "nth", "candidate", "before", "after", *[f.cast("double").alias(n) for n, f in _features().items()])


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _features() -> dict[str, Column]:
    c, word, before = F.col("candidate"), F.col("word"), F.col("before")
    left = F.regexp_replace(F.lower(c), "|".join(DICTIONARY), "")
    return {
        "length": F.length(c),
        "digits": _share(c, "[0-9]"),
        "upper": _share(c, "[A-Z]"),
        "lower": _share(c, "[a-z]"),
        "letter_digit": _share(c, "(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]"),
        "case_change": _share(c, "(?<=[a-z])[A-Z]|(?<=[A-Z])[a-z]"),
        "distinct": F.size(F.array_distinct(F.split(c, ""))),
        "coverage": F.lit(1.0) - F.length(left) / F.greatest(F.length(c), F.lit(1)),
        "path": (F.instr(word, "://") > 0) | (F.regexp_count(c, F.lit("/")) >= 2),
        "assigned": before.rlike("[=:]$") | word.rlike("^[A-Za-z_]+[=:]") | F.col("left").rlike("[=:][\"']?$"),
        "keyword": F.concat_ws(" ", before, F.lower(word)).rlike("|".join(KEYWORDS)),
        "quoted": word.rlike("[\"']"),
    }


def rule_labels(found: DataFrame) -> DataFrame:
    """Labels for corpora without reviewed findings: an assignment to a named key is a secret, plain numbers and paths are not."""
    rule = F.when((F.col("assigned") == 1) & (F.col("keyword") == 1), 1.0).when((F.col("digits") > 0.95) | (F.col("path") == 1) | (F.col("coverage") > 0.5), 0.0)
    return found.withColumn("label", rule).where("label IS NOT NULL")


def train(labelled: DataFrame, train_rows: int = 20_000, trees: int = 30, depth: int = 6, seed: int = 7):
    """The forest, or None where the labels are not of both kinds. ``labelled`` has the features and ``label``."""
    distinct = labelled.where("label IS NOT NULL").groupBy(*FEATURES, "label").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    distinct = materialize(distinct, "labelled")
    kinds = {r["label"]: r["n"] for r in distinct.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per label
    if len(kinds) < 2:
        return None
    parts, total = [], sum(kinds.values())
    for kind, n in sorted(kinds.items()):
        # A label may use what the others leave; what is left out of it is made up for by weight.
        room = max(train_rows // len(kinds), train_rows - (total - n))
        part = distinct.where(F.col("label") == kind).orderBy(F.xxhash64(*FEATURES)).limit(room)
        parts.append(part.withColumn("weight", F.col("weight") * (n / min(n, room))))
    sample = reduce(DataFrame.unionByName, parts).coalesce(1)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(sample)
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", weightCol="weight").fit(rows)


def scan(docs: DataFrame, labelled: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``doc_id, place, candidate, probability, secret`` of every finding; without labels, rule labels train."""
    found = materialize(findings(docs), "findings")  # a row per finding: training and scoring read it again
    model = train(rule_labels(found) if labelled is None else labelled)
    if model is None:
        return found.select("doc_id", "place", "candidate", F.lit(None).cast("double").alias("probability"), F.lit(True).alias("secret"))
    scored = model.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(found))
    share = vector_to_array("probability")[1]
    return scored.select("doc_id", "place", "candidate", share.alias("probability"), (share >= threshold).alias("secret"))
