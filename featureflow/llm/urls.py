"""URL filtering: fixed host and path rules, then association rules mined from labelled pages.

A page's URL is a set of tokens: its host's labels, domain endings, path segments other than numbers, and the query's
keys and values. FP-growth finds token sets that
come with the label ``block``; those with enough support and confidence that beat every smaller rule they
contain are kept. They match by an inverted index: page tokens are joined to rule tokens, and a rule holds
where all of its tokens were met.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featureflow.operators.lookup import pin

# Verdict, host (with its subdomains) and beginning of the path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
LABEL = "label=block"
# Bounds on mining; they do not depend on the number of pages to judge.
SAMPLE_ROWS = 50_000
LEAST_SUPPORT = 0.0005
LEAST_CONFIDENCE = 0.6
MOST_TOKENS = 3


def host_of(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    folded = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(folded, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query_of(url: Column) -> Column:
    """What follows the first ``?`` after the host, to ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit(""))


def tokens_of(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens: labels of the host, its endings, path segments, and keys and ``key=value`` pairs of the query.

    Segments that are numbers, with or without a file ending, are ids and no tokens. Other rare tokens are left to
    the support that mining asks for.
    """
    labels = F.array_remove(F.split(host, r"\."), "")
    endings = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(labels), F.lit(1))),
        lambda i: F.array_join(F.slice(labels, i, F.greatest(F.size(labels), F.lit(1))), "."),
    )
    segments = F.filter(F.split(path, "/"), lambda s: (s != "") & ~s.rlike(r"^[0-9]+(\.[A-Za-z]\w*)?$"))
    pairs = F.filter(F.split(query, "[&;]"), lambda s: s != "")
    keys = F.filter(F.transform(pairs, lambda s: F.substring_index(s, "=", 1)), lambda s: s != "")
    tagged = F.concat(
        F.transform(labels, lambda t: F.concat(F.lit("host:"), t)),
        F.transform(F.filter(endings, lambda t: t != ""), lambda t: F.concat(F.lit("under:"), t)),
        F.transform(segments, lambda t: F.concat(F.lit("path:"), t)),
        F.transform(keys, lambda t: F.concat(F.lit("key:"), t)),
        F.transform(F.filter(pairs, lambda s: s.contains("=")), lambda t: F.concat(F.lit("query:"), t)),
    )
    return F.array_distinct(tagged)


def fixed_rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """The longest rule that fits, as a struct of ``rule`` (host and path) and ``verdict``; null if none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def classes_of(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokens that stand in the same baskets, as (first, members), and baskets with one token of each class, as (tokens, kept)."""
    sets = labelled.select(F.sort_array("tokens").alias("tokens")).distinct()
    each = sets.select("tokens", F.explode("tokens").alias("token"))
    marks = [F.bit_xor(F.xxhash64("tokens", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    seen = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *marks)
    classes = seen.groupBy("n", "mark0", "mark1").agg(F.sort_array(F.collect_list("token")).alias("members"))
    classes = classes.select(F.col("members")[0].alias("first"), "members")
    firsts = classes.select(F.col("first").alias("token"))
    return classes, each.join(firsts, "token").groupBy("tokens").agg(F.sort_array(F.collect_list("token")).alias("kept"))


def mine(labelled: DataFrame, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE, tokens: int = MOST_TOKENS) -> DataFrame:
    """(rule, tokens, confidence, support) from ``labelled`` (tokens, blocked).

    Kept are rules of at most ``tokens`` tokens that are more confident than each rule on a part of them. Two tokens
    that stand in the same baskets are never in one such rule and replace each other in all: one is mined for both.
    """
    classes, kept = classes_of(labelled)
    single = labelled.select(F.sort_array("tokens").alias("tokens"), "blocked").join(kept, "tokens")
    baskets = single.select(F.when(F.col("blocked"), F.concat("kept", F.array(F.lit(LABEL)))).otherwise(F.col("kept")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    found = model.associationRules.where((F.size("antecedent") <= tokens) & (F.col("consequent")[0] == LABEL))
    found = found.select(F.sort_array("antecedent").alias("tokens"), "confidence", "support")
    # Parts of a rule share a token with it; the rules to compare are met through one.
    each = found.withColumn("token", F.explode("tokens"))
    part = found.select(F.col("tokens").alias("p_tokens"), F.col("confidence").alias("p_confidence"), F.explode("tokens").alias("token"))
    beaten = each.join(part, "token").where(
        (F.size("p_tokens") < F.size("tokens")) & (F.size(F.array_except("p_tokens", "tokens")) == 0) & (F.col("p_confidence") >= F.col("confidence"))
    )
    kept = found.join(beaten.select("tokens").distinct(), "tokens", "left_anti")
    lists = kept.withColumn("first", F.explode("tokens")).join(classes, "first").groupBy("tokens", "confidence", "support").agg(F.collect_list("members").alias("lists"))
    longer = lambda done, members: F.flatten(F.transform(done, lambda d: F.transform(members, lambda m: F.concat(d, F.array(m)))))
    every = F.aggregate("lists", F.array(F.array().cast("array<string>")), longer)
    each = lists.select(F.explode(every).alias("tokens"), "confidence", "support").withColumn("tokens", F.sort_array("tokens"))
    return each.select(F.xxhash64("tokens").alias("rule"), "tokens", "confidence", "support")


def match(pages: DataFrame, rules: DataFrame, small: bool) -> DataFrame:
    """(key, mined, confidence): the most confident rule per page of ``pages`` (key, tokens)."""
    index = rules.select("rule", F.size("tokens").alias("needed"), "confidence", F.explode("tokens").alias("token"), F.col("tokens").alias("of"))
    each = pages.select("key", F.explode("tokens").alias("token"))
    met = each.join(F.broadcast(index) if small else index, "token")
    counted = met.groupBy("key", "rule").agg(
        F.count(F.lit(1)).alias("n"), F.first("needed").alias("needed"), F.first("confidence").alias("confidence"), F.first("of").alias("of")
    )
    full = counted.where("n = needed").select("key", F.struct("confidence", F.array_join("of", " + ").alias("of")).alias("best"))
    return full.groupBy("key").agg(F.max("best").alias("best")).select("key", F.col("best.of").alias("mined"), F.col("best.confidence").alias("confidence"))


def page_labels(pages: DataFrame, labels: DataFrame, key: str = "page_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """(key, tokens, blocked) of at most ``rows`` labelled pages, those with the smallest hash of the key.

    The last number in a page's path names its document; a page is to be blocked if that document is labelled as of
    low quality or toxic.
    """
    url = F.col("url")
    number = F.try_to_number(F.regexp_extract(path_of(url), r"/([0-9]{1,15})[^/]*/?$", 1), F.lit("999999999999999"))
    named = pages.select(F.col(key).alias("key"), tokens_of(host_of(url), path_of(url), query_of(url)).alias("tokens"), number.cast("bigint").alias("doc_id"))
    bad = labels.groupBy("doc_id").agg(F.max(F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.lit(False))).alias("blocked"))
    joined = named.where("doc_id is not null and size(tokens) > 0").join(bad, "doc_id")
    return joined.orderBy(F.xxhash64("key"), "key").limit(rows).select("key", "tokens", "blocked")


def judge(
    pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES, support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE, key: str = "page_id"
) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined, confidence) per row of ``pages``.

    A fixed rule decides where one fits; else a page that a mined rule matches is blocked, others are allowed.

    Defined results: a null URL, or one without ``://``, has empty host and path and is allowed; rows with the
    same URL are judged alike; without labels nothing is mined; an empty table gives an empty result.
    """
    mined, small = pin(mine(page_labels(pages, labels, key), support, confidence))
    url = F.col("url")
    split = pages.select(F.col(key).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), query_of(url).alias("query"))
    judged = split.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules))
    # Pages without numbers have the same tokens as many others: each set is matched once.
    with_tokens = judged.withColumn("tokens", F.sort_array(tokens_of(F.col("host"), F.col("path"), F.col("query")))).withColumn("key", F.xxhash64("tokens"))
    sets = with_tokens.where("fixed is null").groupBy("key").agg(F.first("tokens").alias("tokens"))
    found = match(sets, mined, small)
    out = with_tokens.join(found, "key", "left")
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    by_rule = F.col("fixed").isNull()
    return out.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"),
        F.when(by_rule, F.col("mined")).alias("mined"), F.when(by_rule, F.col("confidence")).alias("confidence"),
    )
