"""URL filtering with association rules.

URLs are cut into tokens (scheme, host, domain, path start, ...). FP-growth mines token combinations from
labelled URLs; combinations that go with one label often enough become rules, unless some of their tokens alone
are as good a rule. The rules of other URLs are found by an inverted index from token to rule, in which a rule
stands under its rarest token only. Only DataFrame functions and Spark's FP-growth are used.

A URL has one token of each type at most, so a URL has a bounded number of combinations, whatever its
length. Rules are matched once for each distinct set of tokens, not for each page.

Cases: a null URL, or one without ``://``, has an empty host and path and no tokens; it is allowed. Repeated
rows are judged each for itself, page ids may be null. Without labelled URLs, or without rules, what no list
rule fits is allowed. An empty table gives an empty result. Columns that have the name of a column
added here are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallysheet.llm.tables import stored, without

ADDED = ("host", "path", "rule", "verdict", "mined_rule", "mined_confidence")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class ListRule:
    """Fits a host and all its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The lists.
LIST_RULES = (
    ListRule("net", "/", "block"),
    ListRule("example.net", "/en/", "allow"),
    ListRule("example.com", "/de/", "block"),
    ListRule("org", "/fr/", "allow"),
)


@dataclass(frozen=True)
class Mining:
    min_support: float = 0.005
    # Labelled URLs that a rule must hold for, however few there are.
    min_urls: int = 3
    min_confidence: float = 0.9
    # Tokens on the left side of a rule.
    most_tokens: int = 3
    default: str = "allow"
    # Bytes of the inverted index, or of the matches, up to which they are broadcast.
    broadcast_bytes: int = 32 << 20


DEFAULT = Mining()


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def list_rule(host: Column, path: Column, rules: Sequence[ListRule]) -> Column:
    """The longest rule that fits, as a struct (text, verdict); null if none does. For short lists."""
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens_of(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens, one of each type at most; empty if the host is empty."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    last = F.get(segments, F.size(segments) - 1)
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    keys = F.array_join(F.array_sort(F.array_distinct(F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1)))), "&")
    some = lambda name, value, when: F.when(when, F.concat(F.lit(name + ":"), value))
    parts = F.array(
        some("scheme", F.translate(F.substring_index(url, "://", 1), _UPPER, _LOWER), F.lit(True)),
        some("host", host, n > 2),
        some("domain", F.concat_ws(".", F.slice(labels, F.greatest(n - 1, F.lit(1)), 2)), F.lit(True)),
        some("top", F.get(labels, n - 1), F.lit(True)),
        some("sub", F.get(labels, 0), n > 3),
        some("start", F.get(segments, 0), F.size(segments) > 0),
        some("depth", F.least(F.size(segments), F.lit(9)).cast("string"), F.lit(True)),
        some("type", F.regexp_extract(last, r"\.([A-Za-z0-9]+)$", 1), last.rlike(r"\.[A-Za-z0-9]+$")),
        some("query", keys, query != ""),
    )
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(F.array_compact(parts))))


def mine(labelled: DataFrame, mining: Mining = DEFAULT) -> DataFrame:
    """Rules from ``labelled`` (tokens, label): tokens, verdict, support, confidence, and the ``rarest`` token.

    Frequent item sets with a label are the rules; the same set without it gives their confidence.
    """
    items = labelled.where(F.size("tokens") > 0).select(F.array_append("tokens", F.concat(F.lit("label="), "label")).alias("items"))
    n = items.count()
    if not n:
        schema = "tokens array<string>, verdict string, support double, confidence double, rarest string"
        return labelled.sparkSession.createDataFrame([], schema)
    least = min(1.0, max(mining.min_support, mining.min_urls / n))
    sets = FPGrowth(itemsCol="items", minSupport=least, minConfidence=1.0).fit(items).freqItemsets
    is_label = lambda t: t.startswith("label=")
    sets = sets.select(
        F.array_sort(F.filter("items", lambda t: ~is_label(t))).alias("tokens"),
        F.get(F.filter("items", is_label), 0).alias("label"),
        "freq",
    ).where((F.size("tokens") > 0) & (F.size("tokens") <= mining.most_tokens) & (F.col("freq") >= mining.min_urls))
    sets = stored(sets, "itemsets")
    whole = sets.where("label is null").select("tokens", F.col("freq").alias("all"))
    rules = sets.where("label is not null").join(whole, "tokens").select(
        "tokens",
        F.substring_index("label", "=", -1).alias("verdict"),
        (F.col("freq") / F.lit(float(n))).alias("support"),
        (F.col("freq") / F.col("all")).alias("confidence"),
    )
    rules = stored(pruned(rules.where(F.col("confidence") >= mining.min_confidence)), "rules")
    # Every token of a frequent set is one by itself, so its count is known.
    singles = whole.where(F.size("tokens") == 1).select(F.get("tokens", F.lit(0)).alias("token"), F.col("all").alias("n"))
    rarest = F.min_by("token", F.struct("n", "token")).alias("rarest")
    per_rule = rules.select("tokens", F.explode("tokens").alias("token")).distinct().join(singles, "token").groupBy("tokens").agg(rarest)
    return rules.join(per_rule, "tokens")


def pruned(rules: DataFrame) -> DataFrame:
    """``rules`` without those of which some tokens alone are a rule of at least their confidence and support:
    wherever the longer one holds the shorter one does, and is ranked before it."""
    size = F.size("tokens")
    # All smaller combinations of a sorted set, by the bits of a number.
    parts = F.transform(
        F.sequence(F.lit(1), F.call_function("shiftleft", F.lit(1), size) - 2),
        lambda bits: F.filter("tokens", lambda t, i: F.getbit(bits, i) == 1),
    )
    longer = rules.where(size > 1)
    shorter = rules.select(F.col("tokens").alias("part"), F.col("support").alias("_support"), F.col("confidence").alias("_confidence"))
    covered = (
        longer.select("tokens", "verdict", "support", "confidence", F.explode(parts).alias("part")).join(shorter, "part")
        .where((F.col("_confidence") >= F.col("confidence")) & (F.col("_support") >= F.col("support")))
        .select("tokens", "verdict").distinct()
    )
    return rules.join(covered, ["tokens", "verdict"], "left_anti")


def _small(df: DataFrame, text: str, mining: Mining) -> DataFrame:
    """``df`` to be broadcast, if it is known to be small: ``text`` holds the most of its bytes."""
    size = df.agg(F.sum(F.octet_length(text)).alias("bytes"), F.count(F.lit(1)).alias("n")).first()
    return F.broadcast(df) if (size["bytes"] or 0) * 3 + 100 * size["n"] <= mining.broadcast_bytes else df


def match(sets: DataFrame, rules: DataFrame, mining: Mining = DEFAULT) -> DataFrame:
    """The best rule of each distinct ``tokens`` of ``sets``: mined_verdict, mined_rule,
    mined_confidence. Rules rank by confidence, support, fewer tokens, then text."""
    rule = F.array_join("tokens", " ")
    listed = rules.select(
        rule.alias("rule"), F.col("tokens").alias("wanted"), "verdict", "support", "confidence", F.size("tokens").alias("need"), F.col("rarest").alias("token")
    )
    met = sets.select("tokens", F.explode("tokens").alias("token")).join(_small(listed, "rule", mining), "token")
    whole = met.where(F.size(F.array_except("wanted", "tokens")) == 0)
    best = F.min_by(F.struct("verdict", "rule", "confidence"), F.struct(-F.col("confidence"), -F.col("support"), "need", "rule", "verdict"))
    return whole.groupBy("tokens").agg(best.alias("b")).select(
        "tokens", F.col("b.verdict").alias("mined_verdict"), F.col("b.rule").alias("mined_rule"), F.col("b.confidence").alias("mined_confidence")
    )


def judge(pages: DataFrame, url: str = "url", list_rules: Sequence[ListRule] = LIST_RULES, mining: Mining = DEFAULT) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the mined rule that decided, if any.

    URLs that a list rule fits are the labelled ones that rules are mined from.
    """
    parsed = without(pages, (*ADDED, "_tokens", "_listed"))
    parsed = parsed.withColumn("host", F.coalesce(host_of(F.col(url)), F.lit(""))).withColumn("path", F.coalesce(path_of(F.col(url)), F.lit("")))
    parsed = parsed.withColumn("_listed", list_rule(F.col("host"), F.col("path"), list_rules))
    parsed = stored(parsed.withColumn("_tokens", tokens_of(F.col(url), F.col("host"), F.col("path"))), "urls")
    labelled = parsed.where("_listed is not null").select(F.col("_tokens").alias("tokens"), F.col("_listed.verdict").alias("label"))
    rules = stored(mine(labelled, mining), "url-rules")
    sets = parsed.where("_listed is null").select(F.col("_tokens").alias("tokens")).distinct()
    found = stored(match(sets, rules, mining), "matches").withColumnRenamed("tokens", "_set")
    found = _small(found.withColumn("_text", F.array_join("_set", " ")), "_text", mining).drop("_text")
    unlisted = F.col("_listed").isNull()
    joined = parsed.join(found, unlisted & (F.col("_tokens") == F.col("_set")), "left")
    return joined.withColumn("rule", F.col("_listed.text")).withColumn(
        "verdict", F.coalesce("_listed.verdict", "mined_verdict", F.lit(mining.default))
    ).drop("_listed", "_tokens", "_set", "mined_verdict")
