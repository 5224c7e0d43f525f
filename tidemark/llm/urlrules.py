"""URL filters: curated rules by longest match, then mined association rules.

FP-growth mines combinations of URL tokens from labelled URLs, with the label
as one more item.  Rules from a combination to the label "bad" that are
confident and frequent enough block a URL which has all their tokens.

Tokens are the words of the whole URL (host, path, query and fragment, letters
and digits of every script), so their combinations are many.  Before mining,
tokens too rare among bad URLs go, tokens that stand in the same labelled URLs
become one item, and items that tell a bad URL by themselves, or stand in every
labelled URL, are not combined any further: none of that loses a rule, as only
minimal rules count (a longer rule fits no URL that a shorter one of it does
not).  A rule has as many tokens as it needs.

Rules are matched by an inverted index: each is filed under its rarest item, a
URL looks up its items, and the other items of a rule are compared on the spot.
All of it is DataFrame expressions and the library's FP-growth.

Defined results: a null URL, or one without ``://``, has an empty host and path
and no tokens; no curated rule fits it and it is allowed.  Repeated rows are
judged each.  Without labelled URLs nothing is mined.  An empty table gives an
empty table; further columns are ignored, whatever their names.

Limit: what FP-growth lists doubles with every further item that stands in
almost the same URLs as others without being equal to them, is frequent among
bad URLs, and does not tell them by itself.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Curated rules (host and path) and their verdicts.
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

BAD = "label=bad"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words: all but letters, their marks, and digits.
BETWEEN = r"[^\p{L}\p{M}\p{N}]+"


@dataclass(frozen=True)
class Mining:
    """What a mined rule needs: share and number of bad labelled URLs, and confidence."""

    support: float = 0.002
    least_urls: int = 20
    confidence: float = 0.6

    def least(self, total: int) -> int:
        """Bad URLs a rule needs among ``total`` labelled ones."""
        return math.ceil(min(1.0, max(self.support, self.least_urls / total)) * total)


def parts(url) -> dict:
    """Host (A-Z lower-cased), path, query and fragment of a URL; the last two with their marks."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    rest = F.substr(rest, F.char_length(host) + 1)
    path = F.regexp_extract(rest, r"^[^?#]*", 0)
    rest = F.substr(rest, F.char_length(path) + 1)
    query = F.regexp_extract(rest, r"^[^#]*", 0)
    fragment = F.substr(rest, F.char_length(query) + 1)
    return {"host": F.translate(host, UPPER, LOWER), "path": path, "query": query, "fragment": fragment}


def tokens(url):
    """Distinct words of a URL, told apart by the part they stand in."""

    def words(text, mark):
        split = F.filter(F.split(F.translate(text, UPPER, LOWER), BETWEEN), lambda w: w != "")
        return F.transform(split, lambda w: F.concat(F.lit(mark), w))

    return F.array_distinct(F.concat(*[words(text, f"{name}:") for name, text in parts(url).items()]))


def curated(sites: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, verdict``: the longest rule that fits each of the distinct ``sites`` (host, path), if any.

    A rule table has rule and verdict.  Each site looks its host and all
    parent domains up among the hosts of the rules.
    """
    at = F.locate("/", F.col("rule"))
    keyed = rules.select(
        "rule",
        "verdict",
        F.translate(F.substr(F.col("rule"), F.lit(1), at - 1), UPPER, LOWER).alias("domain"),
        F.substr(F.col("rule"), at).alias("prefix"),
    )
    labels = F.split("host", r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size("labels")),
        lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."),
    )
    looked = sites.withColumn("labels", labels).select("host", "path", F.explode(parents).alias("domain"))
    fits = looked.join(keyed, "domain").where(F.startswith("path", "prefix"))
    best = fits.groupBy("host", "path").agg(
        F.max(F.struct(F.char_length("rule").alias("length"), "rule", "verdict")).alias("best")
    )
    return best.select("host", "path", "best.rule", "best.verdict")


def _items(baskets: DataFrame, least: int) -> DataFrame:
    """``token, item, n, n_bad``: tokens of enough bad URLs, equal ones under one name.

    Tokens are equal if they stand in the same rows: the same number of them and
    the same two sums of 64-bit hashes of their token sets.  Those of one item
    share a URL, so an item has no more of them than a URL has.
    """
    whole = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    seen = (
        baskets.select(F.explode("tokens").alias("token"), "bad", "mark", "mark2")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"), whole("mark"), whole("mark2"))
        .where(F.col("n_bad") >= least)
    )
    same = Window.partitionBy("n", "n_bad", "mark", "mark2")
    return seen.select("token", F.min("token").over(same).alias("item"), "n", "n_bad")


def _minimal(rules: DataFrame) -> DataFrame:
    """The rules that hold no other one; each looks up its items among the keys of the others."""
    looked = rules.select("rule_id", "needs", F.explode("needs").alias("key"))
    others = rules.select("key", F.col("needs").alias("part"))
    longer = looked.join(others, "key").where(
        (F.size("part") < F.size("needs")) & (F.size(F.array_except("part", "needs")) == 0)
    )
    return rules.join(longer.select("rule_id"), "rule_id", "left_anti")


def mined(labelled: DataFrame, mining: Mining | None = None) -> tuple[DataFrame, DataFrame]:
    """Minimal rules ``rule_id, needs, key, confidence``, and ``token, item`` of the items they need.

    ``labelled``: tokens (array of distinct strings), bad (boolean; null is not bad).  ``key`` is the
    rarest item of ``needs``.
    """
    mining = mining or Mining()
    marked = labelled.select(
        "tokens",
        F.coalesce("bad", F.lit(False)).alias("bad"),
        F.xxhash64("tokens").alias("mark"),
        F.xxhash64(F.lit("second"), "tokens").alias("mark2"),
        F.monotonically_increasing_id().alias("row"),
    )
    baskets = materialize(marked, "urlrules-baskets")
    total = baskets.count()
    schema = "rule_id bigint, needs array<string>, key string, confidence double"
    if not total:
        spark = baskets.sparkSession
        return spark.createDataFrame([], schema), spark.createDataFrame([], "token string, item string")
    least = mining.least(total)
    items = materialize(_items(baskets, least), "urlrules-items")
    sure = F.col("n_bad") / F.col("n") >= mining.confidence
    single = items.where(sure).select(F.array("item").alias("needs"), F.col("item").alias("key"), (F.col("n_bad") / F.col("n")).alias("confidence"))
    rules = single.distinct()
    combined = _combined(baskets, items.where(~sure & (F.col("n") < total)), least, mining.confidence)
    if combined is not None:
        rules = rules.unionByName(combined)
    rules = materialize(rules.select(F.xxhash64("needs").alias("rule_id"), "needs", "key", "confidence"), "urlrules-rules")
    needed = rules.select(F.explode("needs").alias("item")).distinct()
    return rules, items.select("token", "item").join(needed, "item", "left_semi")


def _combined(baskets: DataFrame, items: DataFrame, least: int, confidence: float) -> DataFrame | None:
    """Minimal rules of two and more ``items``; None if no labelled URL has any of these."""
    held = baskets.select("row", "bad", F.explode("tokens").alias("token")).join(items.select("token", "item"), "token")
    rows = held.groupBy("row", "bad").agg(F.collect_set("item").alias("items"))
    with_label = F.when(F.col("bad"), F.array_append("items", F.lit(BAD))).otherwise(F.col("items"))
    rows = materialize(rows.select(with_label.alias("items")), "urlrules-items-of-rows")
    n = rows.count()
    if not n:
        return None
    # Half a row below, so that the product with n rounds up to ``least`` whatever its last digit.
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(0.0, (least - 0.5) / n)), minConfidence=confidence).fit(rows)
    found = model.associationRules.where((F.col("consequent")[0] == BAD) & (F.size("antecedent") > 1)).select(
        F.array_sort("antecedent").alias("needs"), "confidence"
    )
    numbered = found.withColumn("rule_id", F.xxhash64("needs"))
    sizes = items.select("item", "n").distinct()
    keyed = numbered.select("rule_id", F.explode("needs").alias("item")).join(sizes, "item")
    rarest = keyed.groupBy("rule_id").agg(F.min(F.struct("n", "item")).alias("rarest"))
    rules = numbered.join(rarest.select("rule_id", F.col("rarest.item").alias("key")), "rule_id")
    return _minimal(materialize(rules, "urlrules-combined")).select("needs", "key", "confidence")


def matched(sites: DataFrame, rules: DataFrame, items: DataFrame) -> DataFrame:
    """``url, n_rules, confidence`` of the distinct ``sites`` (url, tokens) that fit a mined rule.

    A site has an item if it has any token of it.  Only items that a rule needs move.
    """
    held = sites.select("url", F.explode("tokens").alias("token")).join(items, "token")
    held = held.groupBy("url").agg(F.collect_set("item").alias("items"))
    looked = held.select("url", "items", F.explode("items").alias("key"))
    fits = looked.join(rules, "key").where(F.size(F.array_except("needs", "items")) == 0)
    return fits.groupBy("url").agg(F.count(F.lit(1)).alias("n_rules"), F.max("confidence").alias("confidence"))


def judge(urls: DataFrame, rules: DataFrame, labels: DataFrame, mining: Mining | None = None) -> DataFrame:
    """``id, host, path, rule, verdict, n_rules`` of every row of ``urls`` (id, url).

    ``labels``: id, bad.  URLs of labelled ids are what the rules are mined
    from; every URL that no curated rule fits is judged by the mined ones.
    """
    part = parts(F.col("url"))
    plain = materialize(urls.select("id", "url", part["host"].alias("host"), part["path"].alias("path")), "urlrules-urls")
    known = plain.join(labels.select("id", "bad"), "id").select(tokens(F.col("url")).alias("tokens"), "bad")
    by_rule = curated(plain.select("host", "path").distinct(), rules)
    sites = plain.select("url").distinct().withColumn("tokens", tokens(F.col("url")))
    by_mining = matched(sites, *mined(known, mining))
    verdict = F.coalesce("by_rule", F.when(F.col("n_rules") > 0, F.lit("block")).otherwise(F.lit("allow")))
    return (
        plain.join(by_rule.withColumnRenamed("verdict", "by_rule"), ["host", "path"], "left")
        .join(by_mining, "url", "left")
        .select("id", "host", "path", "rule", verdict.alias("verdict"), F.coalesce("n_rules", F.lit(0)).alias("n_rules"))
    )
