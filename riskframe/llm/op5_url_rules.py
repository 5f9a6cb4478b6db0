"""URL filters: fixed host and path rules, and rules mined from labelled URLs by FP-growth.

The fixed rules decide the URLs they fit.  These are the labelled examples:
Spark's FP-growth finds token combinations that are frequent among them, and
those that imply allow or block with enough support and confidence are kept.
For the other URLs the most confident rule whose tokens a URL has decides.

Tokens that stand in exactly the same examples are one item to the mining: a
long URL, or one that occurs often, would else give a rule for each of the 2^n
subsets of its n tokens, all of one support and confidence.  A URL has an item
if it has one of its tokens, and the rule then counts all of them that it has;
this gives the verdicts of all those rules.

Rules are matched by an inverted index: each rule is filed under the rarest of
its items, items of URLs look it up, and candidates are confirmed on all their
items.  URLs with the same tokens are judged once.

Tokens: the host's words with their place (the last label apart), path
segments but for the last, the kind of the last segment, names of query
arguments, and whether there's a fragment; digits alone count as one token.

Defined results: a null URL or one without ``://`` has an empty host and path,
and no token but that fact; with no labelled URL, or none with a rule, the
verdict is ``DEFAULT``; of equally good mined rules, the one with more support,
then more tokens, then block wins; rows that repeat a page are judged alike;
an empty table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.tables import read_table

#: (host, path, verdict)
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
MIN_SUPPORT, MIN_CONFIDENCE = 0.002, 0.9
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(.*)$"


def url_parts(url: Column) -> dict[str, Column]:
    """host, path and what follows them; all empty if null or without ``://``."""
    part = [F.coalesce(F.regexp_extract(url, _PARTS, i), F.lit("")) for i in (1, 2, 3)]
    return {"host": F.translate(part[0], _UPPER, _LOWER), "path": part[1], "rest": part[2]}


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(the longest rule that fits, its verdict); null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def url_tokens(host: Column, path: Column, rest: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    labels = F.split(host, r"\.")
    words = F.flatten(F.transform(F.slice(labels, F.lit(1), F.greatest(F.size(labels) - 1, F.lit(0))), lambda x: F.split(x, "-")))
    steps = F.split(path, "/")
    inner = F.filter(F.slice(steps, F.lit(1), F.greatest(F.size(steps) - 1, F.lit(0))), lambda x: x != "")
    last = F.regexp_replace(F.element_at(steps, -1), r"[0-9]+", "#")
    names = F.regexp_extract_all(rest, F.lit(r"[?&]([^=&#]*)"), F.lit(1))
    plain = lambda x: F.regexp_replace(x, r"^[0-9]+$", "#")
    return F.array_sort(F.array_distinct(F.concat(
        F.array(F.concat(F.lit("tld:"), F.element_at(labels, -1))),
        F.transform(words, lambda x: F.concat(F.lit("host:"), plain(x))),
        F.transform(inner, lambda x: F.concat(F.lit("dir:"), plain(x))),
        F.array(F.concat(F.lit("file:"), last)),
        F.transform(names, lambda x: F.concat(F.lit("arg:"), x)),
        F.when(rest.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")))))


def token_items(labelled: DataFrame, min_support: float) -> DataFrame:
    """(token, item, n) of the frequent tokens of (row, tokens): tokens that stand in exactly the same rows are one
    item, named by the least of them.  Tokens of every row are left out: they only double the item sets."""
    seen = labelled.select("row", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), *[F.bit_xor(F.xxhash64("row", F.lit(i))).alias(f"x{i}") for i in (1, 2)])
    total = labelled.count()
    frequent = seen.where((F.col("n") >= min_support * total) & (F.col("n") < total)).checkpoint(eager=True)
    same = ["n", "x1", "x2"]  # rows by their number and 128 bits of hashes
    return frequent.join(frequent.groupBy(*same).agg(F.min("token").alias("item")), same).select("token", "item", "n").checkpoint(eager=True)


def mine_rules(labelled: DataFrame, items: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """From (row, tokens, verdict): antecedent (items), verdict, confidence, support, key (the rarest item)."""
    parts = labelled.select("row", F.explode("tokens").alias("token")).join(items, "token")
    found = parts.groupBy("row").agg(F.collect_set("item").alias("items"))
    label = F.array(F.concat(F.lit("="), F.col("verdict")))
    baskets = labelled.join(found, "row", "left").select(F.coalesce(F.concat("items", label), label).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where(F.col("consequent")[0].startswith("=")).where(
        ~F.exists("antecedent", lambda x: x.startswith("=")))
    rules = rules.select("antecedent", F.substring(F.col("consequent")[0], 2, 99).alias("verdict"), "confidence", "support",
                         F.monotonically_increasing_id().alias("rule_id")).checkpoint(eager=True)
    counts = items.select("item", "n").distinct()
    parts = rules.select("rule_id", F.explode("antecedent").alias("item")).join(counts, "item")
    keys = parts.groupBy("rule_id").agg(F.min_by("item", F.struct("n", "item")).alias("key"))
    return rules.join(keys, "rule_id").drop("rule_id")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, mined (the tokens that decided)."""
    ensure_checkpoint_dir(pages.sparkSession)
    parts = url_parts(F.col("url"))
    rows = pages.select("page_id", *[c.alias(n) for n, c in parts.items()])
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("fixed"),
                       url_tokens(F.col("host"), F.col("path"), F.col("rest")).alias("tokens")).checkpoint(eager=True)
    labelled = rows.where("fixed is not null").select(F.monotonically_increasing_id().alias("row"), "tokens", F.col("fixed").alias("verdict"))
    labelled = labelled.checkpoint(eager=True)
    if labelled.isEmpty():
        return rows.select("page_id", "host", "path", "rule", F.lit(DEFAULT).alias("verdict"), F.lit(None).cast("array<string>").alias("mined"))
    items = token_items(labelled, min_support)
    mined = mine_rules(labelled, items, min_support, min_confidence).checkpoint(eager=True)
    # an item is there if one of its tokens is; all of them that are count in the rule
    kinds = rows.where("fixed is null").select("tokens").distinct()
    mine = kinds.select("tokens", F.explode("tokens").alias("token")).join(items, "token")
    mine = mine.groupBy("tokens", "item").agg(F.collect_list("token").alias("of")).groupBy("tokens").agg(
        F.map_from_entries(F.collect_list(F.struct("item", "of"))).alias("held"))
    found = mine.withColumn("key", F.explode(F.map_keys("held"))).join(mined, "key")
    found = found.where(F.size(F.array_except("antecedent", F.map_keys("held"))) == 0)
    tokens = F.array_sort(F.flatten(F.transform("antecedent", lambda i: F.col("held")[i])))
    found = found.select("tokens", "verdict", "confidence", "support", tokens.alias("antecedent"))
    good = F.struct("confidence", "support", F.size("antecedent").alias("n"), (F.col("verdict") == "block").alias("b"))
    best = found.groupBy(F.col("tokens").alias("of")).agg(F.max_by(F.struct("verdict", "antecedent"), good).alias("best"))
    out = rows.join(best, (F.col("tokens") == F.col("of")) & F.col("fixed").isNull(), "left")
    return out.select("page_id", "host", "path", "rule", F.coalesce("fixed", "best.verdict", F.lit(DEFAULT)).alias("verdict"),
                      F.col("best.antecedent").alias("mined"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "pages"))
