"""URL filters: fixed host and path rules, and association rules mined from labels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surgecast.llm.common import cut, stored

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class Mining:
    """What a rule must show. ``support`` and ``least``: the share and the number of labelled URLs that it
    covers and that are labelled block; ``confidence``: their share of those covered; ``lift``: how
    much more that is than among all. ``held_out``: one URL in so many, by hash, is kept from mining (0: none),
    and on these the lower bound of the rule's confidence (``deviations`` below, by Wilson) must
    exceed the share of block among them."""

    support: float = 0.002
    confidence: float = 0.6
    lift: float = 1.5
    least: int = 20
    held_out: int = 5
    deviations: float = 2.0


#: Rows of the inverted index and tokens that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 100_000


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one, and its verdict; null if none does.

    A rule fits its host and all hosts below it if the path starts with the rule's. Of equally long
    ones the first given holds.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.host + rule.path).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL: labels of the host, parts of the path with numbers as #, query keys."""
    host, path = host_of(url), path_of(url)
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*\?([^#]*)", 1)

    def named(prefix: str, parts: Column) -> Column:
        return F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(prefix), x))

    return F.array_distinct(
        F.concat(
            named("h:", F.split(host, r"\.")),
            named("p:", F.split(F.regexp_replace(path, "[0-9]+", "#"), "/")),
            named("q:", F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))),
        )
    )


def _few(df: DataFrame) -> DataFrame:
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def _telling(known: DataFrame, least: int) -> DataFrame:
    """(tokens, n, blocked): the distinct sets of all tokens of a URL that enough blocked URLs hold, each in
    order, with the URLs that have it and the blocked ones of them.

    Others can be in no rule.
    """
    each = known.select("id", "blocked", F.explode("tokens").alias("token"))
    count = each.groupBy("token").agg(F.sum(F.col("blocked").cast("int")).alias("n"))
    held = each.join(_few(count.filter(F.col("n") >= least).select("token")), "token")
    sets = held.groupBy("id", "blocked").agg(F.array_sort(F.collect_list("token")).alias("tokens"))
    return sets.groupBy("tokens").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("blocked").cast("int")).alias("blocked"))


def _rules(baskets: DataFrame, base: float, least: int, how: Mining) -> DataFrame:
    """(tokens, confidence) of every rule of any size to which no rule of fewer of its tokens is equal or better.

    ``baskets`` are those of :func:`_telling`, ``base`` the share of blocked ones among all URLs. Sets
    grow by one token at a time. A set that covers the same URLs as one of its parts is as good as
    that part, and nothing is better than a rule that is always right, so neither they nor what holds them are
    looked at: tokens that always come together take no combinations.
    """
    holds = stored(baskets.select("*", F.posexplode("tokens").alias("last", "token")).withColumn("held", F.array("token")).drop("token"))
    grown, rules = None, []
    while True:
        counted = holds.groupBy("held").agg(F.sum("n").alias("n"), F.sum("blocked").alias("blocked")).filter(F.col("blocked") >= least)
        if grown is None:
            counted = counted.withColumn("best", F.lit(None).cast("double"))
        else:
            parts = counted.withColumn("part", F.explode(F.transform("held", lambda x: F.array_remove(F.col("held"), x))))
            smaller = grown.select(F.col("held").alias("part"), F.col("n").alias("wider"), F.greatest("best", "confidence").alias("best"))
            own = parts.join(_few(smaller), "part").filter("wider > n").groupBy("held", "n", "blocked")
            counted = own.agg(F.count(F.lit(1)).alias("parts"), F.max("best").alias("best")).filter(F.col("parts") == F.size("held")).drop("parts")
        share = F.col("blocked") / F.col("n")
        # Shares are of all URLs, also of those without a telling token.
        sure = (share >= how.confidence) & (share / base >= how.lift)
        counted = cut(counted.withColumn("confidence", F.when(sure, share)))
        rules.append(counted.filter("confidence > coalesce(best, 0)").select(F.col("held").alias("tokens"), "confidence"))
        grown = counted.filter("confidence is null or confidence < 1")
        if grown.isEmpty():
            return reduce(DataFrame.unionByName, rules)
        more = F.posexplode(F.slice("tokens", F.col("last") + 2, F.size("tokens"))).alias("ahead", "token")
        wider = holds.join(_few(grown.select("held")), "held").select("*", more)
        holds = stored(wider.select("tokens", "n", "blocked", (F.col("last") + 1 + F.col("ahead")).alias("last"), F.array_append("held", F.col("token")).alias("held")))


def mine(labelled: DataFrame, how: Mining) -> DataFrame:
    """(rule, token, size, confidence): token combinations that tell blocked URLs, as an inverted index.

    ``labelled`` has ``url`` and ``blocked``; nulls in either are left out. Rules are searched level by
    level over all tokens of every URL; those with too little support, confidence or lift go, those that add tokens
    to another without adding confidence, and those that do not beat the share of blocked URLs among
    those held out. Without URLs of both kinds, or where labels follow no token, there is none.
    """
    spark = labelled.sparkSession
    none = spark.createDataFrame([], "rule long, token string, size int, confidence double")
    known = labelled.filter("url is not null and blocked is not null").select("url", tokens_of(F.col("url")).alias("tokens"), "blocked")
    held = F.pmod(F.xxhash64("url"), F.lit(how.held_out)) == 0 if how.held_out else F.lit(False)
    known = cut(known.select("url", "tokens", "blocked", held.alias("held"), F.monotonically_increasing_id().alias("id")))
    seen = known.filter("not held")
    kinds = seen.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("blocked").cast("int")).alias("blocked")).first()
    if not kinds["n"] or kinds["blocked"] in (0, kinds["n"]):
        return none
    least = max(how.least, math.ceil(how.support * kinds["n"]))
    rules = _rules(_telling(seen, least), kinds["blocked"] / kinds["n"], least, how)
    index = cut(rules.select(F.xxhash64("tokens").alias("rule"), F.explode("tokens").alias("token"), F.size("tokens").alias("size"), "confidence"))
    return index.join(_beating_chance(known.filter("held"), index, how), "rule", "left_semi") if how.held_out else index


def _beating_chance(held: DataFrame, index: DataFrame, how: Mining) -> DataFrame:
    """(rule): those whose confidence on URLs held out exceeds the share of blocked ones, at its lower bound."""
    base = held.agg(F.avg(F.col("blocked").cast("double"))).first()[0] or 0.0
    labels = held.select("url", "blocked")
    hits = matches(held.select("url"), index).join(labels, "url").groupBy("rule").agg(F.count(F.lit(1)).alias("n"), F.avg(F.col("blocked").cast("double")).alias("p"))
    z, n, p = how.deviations, F.col("n"), F.col("p")
    lower = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return hits.filter(lower > base).select("rule")


def matches(urls: DataFrame, index: DataFrame) -> DataFrame:
    """(url, rule): distinct URLs with the rules all of whose tokens they hold, by the inverted index."""
    each = urls.filter("url is not null").distinct().select("url", F.explode(tokens_of(F.col("url"))).alias("token"))
    hits = each.join(_few(index.select("token", "rule", "size")), "token").groupBy("url", "rule", "size").count()
    return hits.filter("count = size").select("url", "rule")


def blocked_urls(urls: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct URLs that hold all tokens of some rule."""
    return matches(urls, index).select("url").distinct()


def judge_urls(df: DataFrame, key: str, url: str, rules: Sequence[Rule], labelled: DataFrame, how: Mining = Mining()) -> DataFrame:
    """Key, host, path, rule and verdict of every row.

    The longest fixed rule decides; other URLs are blocked if a mined rule holds, else allowed. A URL
    that is null or has no :// has an empty host and path, fits no rule and holds no token, so it is
    allowed. Repeated rows and null keys are rows like others; other columns are not read; an empty table gives no rows.
    """
    rows = df.select(F.col(key).alias("k"), F.col(url).alias("url"))
    bad = blocked_urls(rows.select("url"), mine(labelled, how)).withColumn("bad", F.lit(True))
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = rows.join(bad, "url", "left").withColumns({"host": host, "path": path})
    mined = F.when(F.col("bad"), BLOCK).otherwise(ALLOW)
    return judged.select(F.col("k").alias(key), "host", "path", name.alias("rule"), F.coalesce(verdict, mined).alias("verdict"))
