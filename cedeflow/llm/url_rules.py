"""URL filter: fixed host and path rules, then rules mined from labelled URLs."""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cedeflow.llm.storage import written

#: Host, path prefix and verdict of the fixed rules.
FIXED_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)
#: A mined rule holds for at least this share of the labelled URLs, and this
#: number of blocked ones.
MIN_SUPPORT = 0.002
MIN_COUNT = 20
MIN_CONFIDENCE = 0.5
#: Tokens of the sets that the SQL check counts, at most; mined rules may have more.
MAX_TOKENS = 3
BLOCKED = "=blocked"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(rest, upper, upper.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def fixed_rule(
    host: Column, path: Column, rules: tuple[tuple[str, str, str], ...] = FIXED_RULES
) -> Column:
    """``rule, verdict`` of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule_host, prefix, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(prefix)
        value = F.struct(F.lit(rule_host + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


def url_tokens(url: Column) -> Column:
    """The distinct tokens of a URL, sorted; none for a null or malformed one.

    They name its scheme, its host's last two labels and first label, the first
    directory, the ending, the names in its query, and whether it has a
    fragment. Numbers are not tokens, so a URL has about eight at most besides
    the names of its query.
    """
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda part: F.split_part(part, F.lit("="), F.lit(1)))
    single = F.array(
        F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(url, r"^(\w+)://", 1))),
        F.concat(F.lit("site:"), F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)),
        F.concat(F.lit("host:"), host),
        F.concat(F.lit("first:"), F.regexp_extract(host, r"^([^.]+)", 1)),
        F.concat(F.lit("dir:"), F.regexp_extract(path, r"^/([^/0-9]+)/", 1)),
        F.concat(F.lit("ending:"), F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)),
        F.when(url.contains("#"), F.lit("has:fragment")),
    )
    named = F.transform(keys, lambda k: F.concat(F.lit("key:"), k))
    tokens = F.filter(
        F.array_compact(F.concat(single, named)), lambda token: ~token.endswith(":")
    )
    empty = F.array().cast("array<string>")
    return F.when(host != "", F.array_sort(F.array_distinct(tokens))).otherwise(empty)


def _kinds_of_tokens(baskets: DataFrame, least: int) -> DataFrame:
    """``token, confidence, kind`` of the tokens in ``least`` or more blocked URLs.

    Tokens of one ``kind`` are in the same baskets; it is named by their least. At
    most ``1 / MIN_SUPPORT`` times a URL's tokens come back, whatever the input.
    """
    alike = (
        baskets.groupBy("tokens")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("blocked").cast("long")).alias("bad"))
        .withColumn("h", F.xxhash64("tokens"))
        .withColumn("g", F.xxhash64("tokens", F.lit(1)))
    )
    frequent = written(
        alike.select(F.explode("tokens").alias("token"), "n", "bad", "h", "g")
        .groupBy("token")
        .agg(
            F.sum("n").alias("n"),
            F.sum("bad").alias("bad"),
            F.bit_xor("h").alias("h"),
            F.bit_xor("g").alias("g"),
        )
        .filter(F.col("bad") >= least)
    )
    kinds = frequent.groupBy("h", "g", "n").agg(F.min("token").alias("kind"))
    return written(
        frequent.join(kinds, ["h", "g", "n"]).select(
            "token", (F.col("bad") / F.col("n")).alias("confidence"), "kind"
        )
    )


def _of_each_kind(rules: DataFrame, kinds: DataFrame) -> DataFrame:
    """Rules ``tokens, confidence`` of kinds, once for each choice of their tokens."""
    members = kinds.groupBy("kind").agg(F.collect_list("token").alias("alike"))
    choices = F.aggregate(
        "lists",
        F.array(F.array().cast("array<string>")),
        lambda chosen, alike: F.flatten(
            F.transform(
                chosen, lambda one: F.transform(alike, lambda token: F.array_append(one, token))
            )
        ),
    )
    return (
        rules.select(F.col("tokens").alias("of"), "confidence", F.explode("tokens").alias("kind"))
        .join(members, "kind")
        .groupBy("of", "confidence")
        .agg(F.collect_list("alike").alias("lists"))
        .select(F.explode(choices).alias("tokens"), "confidence")
        .select(F.array_sort("tokens").alias("tokens"), "confidence")
    )


def mined_rules(labelled: DataFrame) -> DataFrame:
    """``rule, tokens, confidence`` mined from ``tokens, blocked``.

    FP-growth finds the token sets that occur often with blocked URLs; a set of
    any size is a rule if at least ``MIN_CONFIDENCE`` of the URLs
    that hold it are blocked. Rules that a smaller rule implies are left out. No
    labelled rows, no rules.

    No such rule holds a token that is a rule by itself, one that is rare among
    blocked URLs, or two that are in the same URLs. So the first two are not mined
    again, and tokens of the same URLs are mined as one.
    """
    baskets = written(labelled.filter(F.size("tokens") > 0).select("tokens", "blocked"))
    n = baskets.count()
    least = max(1, math.ceil(min(1.0, max(MIN_SUPPORT, (MIN_COUNT - 0.5) / max(n, 1))) * n))
    kinds = _kinds_of_tokens(baskets, least)
    sure = F.col("confidence") >= MIN_CONFIDENCE
    # at most 1 / MIN_SUPPORT times a URL's tokens
    of_token = F.broadcast(kinds.filter(~sure).select("token", "kind"))
    left = (
        baskets.select(F.monotonically_increasing_id().alias("id"), "tokens", "blocked")
        .select("id", "blocked", F.explode("tokens").alias("token"))
        .join(of_token, "token")
        .groupBy("id", "blocked")
        .agg(F.array_sort(F.collect_set("kind")).alias("items"))
    )
    items = written(
        left.select(
            F.when(F.col("blocked"), F.array_append("items", F.lit(BLOCKED)))
            .otherwise(F.col("items"))
            .alias("items")
        )
    )
    n_left = max(items.count(), 1)
    support = min(1.0, (least - 0.5) / n_left)
    mined = FPGrowth(itemsCol="items", minSupport=support, minConfidence=MIN_CONFIDENCE).fit(items)
    several = mined.associationRules.filter(
        (F.col("consequent") == F.array(F.lit(BLOCKED)))
        & (F.col("confidence") * F.lit(1.0) >= MIN_CONFIDENCE)
    ).select(F.col("antecedent").alias("tokens"), "confidence")
    single = kinds.filter(sure).select(F.array("token").alias("tokens"), "confidence")
    rules = written(single.unionByName(_of_each_kind(several, kinds))).withColumn(
        "rule", F.array_join("tokens", " ")
    )
    # each rule meets the smaller ones that are indexed by one of its tokens, their rarest
    tokens = rules.select("rule", "tokens", F.explode("tokens").alias("token"))
    rarity = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    smaller = (
        tokens.join(rarity, "token")
        .groupBy(F.col("rule").alias("part"))
        .agg(F.first("tokens").alias("held"), F.min(F.struct("k", "token"))["token"].alias("token"))
    )
    implied = (
        tokens.join(smaller, "token")
        .filter(
            (F.size("held") < F.size("tokens")) & (F.size(F.array_except("held", "tokens")) == 0)
        )
        .select("rule")
    )
    return rules.join(implied.distinct(), "rule", "left_anti")


def matched_rules(token_sets: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens`` of the sets that hold a whole rule, with the surest such rule.

    The rules are indexed by token; a set meets only the rules that share a
    token with it, and holds a rule if it meets all its tokens.
    """
    index = rules.select(
        "rule", "confidence", F.size("tokens").alias("n"), F.explode("tokens").alias("token")
    )
    met = token_sets.select("tokens", F.explode("tokens").alias("token")).join(index, "token")
    held = met.groupBy("tokens", "rule", "confidence", "n").agg(F.count(F.lit(1)).alias("k"))
    return (
        held.filter("k = n")
        .groupBy("tokens")
        .agg(F.max(F.struct("confidence", "rule")).alias("best"))
        .select("tokens", F.col("best.rule").alias("mined_rule"), "best.confidence")
    )


def document_number(path: Column) -> Column:
    """The number that ends a page's path, which names its document; else null."""
    digits = F.regexp_extract(path, r"/(\d{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    return F.when(digits != "", digits.cast("long"))


def url_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, host, path, rule, verdict, mined_rule`` of every page.

    The longest fixed rule that fits decides. A URL that none fits is blocked if
    it holds the tokens of a mined rule, else allowed. Rules are mined from all
    pages whose document is labelled; a document is to be blocked if any of its
    labels says low quality or toxic, and null labels say nothing. A null URL,
    or one without ``://``, has an empty host and path, no tokens, and is
    allowed. Equal URLs get equal verdicts; other columns are not read. Token
    sets are grouped before rules are matched, so a common one is matched once.
    """
    parsed = written(
        pages.select(
            "page_id",
            host_of(F.col("url")).alias("host"),
            path_of(F.col("url")).alias("path"),
            url_tokens(F.col("url")).alias("tokens"),
        )
    )
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(
        F.col("toxic") == 1, F.lit(False)
    )
    known = (
        labels.filter(F.col("quality").isNotNull() | F.col("toxic").isNotNull())
        .groupBy(F.col("doc_id").alias("number"))
        .agg(F.max(bad).alias("blocked"))
    )
    numbered = parsed.select("tokens", document_number(F.col("path")).alias("number"))
    rules = written(
        mined_rules(numbered.join(known, "number").select("tokens", "blocked"))
    )
    sets = parsed.groupBy("tokens").agg(F.count(F.lit(1)).alias("n_urls"))
    matched = matched_rules(sets, rules)
    fixed = fixed_rule(F.col("host"), F.col("path"))
    mined = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return (
        parsed.join(matched, "tokens", "left")
        .withColumn("fixed", fixed)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fixed.rule").alias("rule"),
            F.coalesce("fixed.verdict", mined).alias("verdict"),
            F.when(F.col("fixed").isNull(), F.col("mined_rule")).alias("mined_rule"),
        )
    )
