"""URL filters from rules and mined token associations (operator 7), in SQL functions and MLlib only.

A url is judged by the longest of the given (host, path) rules that fits, or else by learned ones: Spark's
FP-growth mines combinations of url tokens together with the label ``bad`` from labelled urls; combinations
whose share of bad urls and count are high enough become blocking rules. Tokens that stand in the same labelled
urls are one item of the mining, and a learned rule matches a url that has a token of each of its items. Matching
goes through an inverted index from token to rules: a url meets only rules that share a token with it.

Edge cases: a url that is null or has no ``://`` has an empty host and path, no tokens, and is allowed; rules of
equal length keep the order given; repeated pages are judged each; without labelled urls, or with no
combination above the thresholds, nothing is learned and urls without a rule are allowed; a null ``page_id``
stays null; an empty table gives an empty result; further columns are ignored. Sets of labelled urls are compared by
their counts and two sums of 64-bit hashes.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playcohort.session import materialize

#: (verdict, host, path) of the rules of the query: fixed values.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: The item that stands for the label; no token contains a blank.
BAD = "label bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path of a url."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The rule's text and verdict of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, F.lit(name + start)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def tokens(host: Column, path: Column) -> Column:
    """Distinct tokens: the labels of the host from the second level down, and the words of the path."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host "), x))
    words = F.transform(F.split(F.translate(path, UPPER, LOWER), r"[^\p{L}\p{N}]+"), lambda x: F.concat(F.lit("path "), x))
    return F.array_distinct(F.filter(F.concat(labels, words), lambda x: ~x.isin("host ", "path ")))


def _items(rows: DataFrame, least: int, total: int) -> DataFrame:
    """``item, same, n, bad`` of the tokens a rule may need: ``same`` lists those that stand in one set of urls.

    Left out are tokens of fewer than ``least`` bad urls, and tokens of all urls, which make no rule surer.
    """
    def spread(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), "row").cast("decimal(20,0)")).alias(f"hash_{seed}")

    one = rows.select("row", "bad", F.explode("items").alias("token"))
    sets = one.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"), spread(1), spread(2))
    sets = sets.where((F.col("bad") >= least) & (F.col("n") < total))
    same = sets.groupBy("n", "bad", "hash_1", "hash_2").agg(F.array_sort(F.collect_list("token")).alias("same"))
    return same.select(F.element_at("same", 1).alias("item"), "same", "n", "bad")


def mine(urls: DataFrame, labels: DataFrame, least: int = 5, confidence: float = 0.8) -> DataFrame:
    """``rule_id, antecedent, same, support, confidence`` of learned blocking rules.

    ``labels`` has ``page_id`` and ``bad``; every labelled url counts, by Spark's parallel FP-growth. A rule
    needs ``least`` bad urls, however many urls are labelled, and may have any number of items; ``antecedent``
    names each item by its first token, ``same`` gives all its tokens. Among rules with nested item sets only
    the smaller is kept when it is no less sure, since it blocks all the other does. So an item whose urls are
    all bad is a rule by itself and in no other: it is not mined any further.
    """
    spark = urls.sparkSession
    good = labels.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad"))
    host, path = split_url(F.col("url"))
    rows = urls.join(good, "page_id").select(tokens(host, path).alias("items"), "bad").where(F.size("items") > 0)
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()), "labelled")
    total, bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    none = spark.createDataFrame([], "rule_id bigint, antecedent array<string>, same array<array<string>>, support double, confidence double")
    if not 0 < bad < total:  # no label is surer than the share of bad urls
        return none
    items = materialize(_items(rows, max(least, 1), total), "items")
    sure = items.where("n = bad").select(F.array("item").alias("antecedent"), (F.col("bad") / total).alias("support"), F.lit(1.0).alias("confidence"))
    mined = rows.select("row", "bad", F.explode("items").alias("item")).join(items.where("n > bad").select("item"), "item")
    mined = mined.groupBy("row", "bad").agg(F.collect_list("item").alias("items"))
    mined = materialize(mined.select(F.when(F.col("bad") == 1, F.array_append("items", F.lit(BAD))).otherwise(F.col("items")).alias("items")), "mined")
    rules, left = sure, mined.count()
    if left:
        # The count that FP-growth asks for is rounded up from a share: half a url less, so that it is `least` itself.
        model = FPGrowth(itemsCol="items", minSupport=max(least - 0.5, 0) / left, minConfidence=confidence).fit(mined)
        found = model.associationRules.where(F.array_contains("consequent", BAD)).where(F.col("confidence") > bad / total)
        rules = rules.unionByName(found.select(F.sort_array("antecedent").alias("antecedent"), (F.col("support") * left / total).alias("support"), "confidence"))
    rules = materialize(rules, "rules")
    # A smaller rule meets the larger ones by its first item only.
    small = rules.select(F.element_at("antecedent", 1).alias("item"), F.col("antecedent").alias("less"), F.col("confidence").alias("less_confidence"))
    met = rules.where(F.size("antecedent") > 1).select("*", F.explode("antecedent").alias("item")).join(small, "item")
    covered = met.where((F.size("less") < F.size("antecedent")) & (F.size(F.array_except("less", "antecedent")) == 0) & (F.col("less_confidence") >= F.col("confidence")))
    rules = rules.join(covered.select("antecedent").distinct(), "antecedent", "left_anti").withColumn("rule_id", F.xxhash64("antecedent"))
    same = rules.select("rule_id", F.explode("antecedent").alias("item")).join(items, "item").groupBy("rule_id").agg(F.array_sort(F.collect_list("same")).alias("same"))
    return rules.join(same, "rule_id").select("rule_id", "antecedent", "same", "support", "confidence")


def judge(pages: DataFrame, learned: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, learned`` of every page."""
    host, path = split_url(F.col("url"))
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string")).select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    pages = pages.withColumn("rule", rule).withColumn("given", verdict)
    index = learned.select("rule_id", F.size("same").alias("needed"), F.posexplode("same").alias("item", "tokens")).select("rule_id", "needed", "item", F.explode("tokens").alias("token"))
    # A learned verdict depends on the url alone, so equal urls are matched once.
    asked = pages.where("rule IS NULL").select("url", "host", "path").distinct()
    met = asked.select("url", F.explode(tokens(F.col("host"), F.col("path"))).alias("token")).join(index, "token")
    met = met.select("url", "rule_id", "needed", "item").distinct()
    hits = met.groupBy("url", "rule_id", "needed").agg(F.count(F.lit(1)).alias("met")).where("met = needed")
    blocked = hits.groupBy("url").agg(F.min("rule_id").alias("learned"))
    judged = pages.join(blocked, "url", "left")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("given", F.when(F.col("learned").isNotNull(), F.lit("block")).otherwise("allow")).alias("verdict"), F.when(F.col("rule").isNull(), F.col("learned")).alias("learned"))
