"""URL filters: fixed host rules first, then association rules mined from labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values: (verdict, host, path); the rule's name is host and path joined.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BLOCK = "=block"
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
MIN_LIFT = 1.2
#: A rule must also hold for this many labelled URLs, however few there are.
MIN_COUNT = 10
PARTS = r"^[\s\S]*?://([^/?#]*)([^?#]*)"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), CAPITALS, SMALL)


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def tokens(url: str) -> Column:
    """Different tokens: host and its parent domains, path words, query keys, a fragment.

    Path words that are numbers alone are left out: they say nothing about other URLs.
    """
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    size = F.size(labels)
    domains = F.transform(
        F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>")),
        lambda k: F.concat(F.lit("host="), F.concat_ws(".", F.slice(labels, k, size))),
    )
    words = F.filter(
        F.split(F.translate(path(url), CAPITALS, SMALL), r"[^\p{L}\p{N}]+"),
        lambda x: (x != "") & ~x.rlike(r"^\p{N}+$"),
    )
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    keys = F.filter(
        F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1)), lambda x: x != ""
    )
    mark = F.when(F.col(url).contains("#"), F.array(F.lit("fragment"))).otherwise(
        F.array().cast("array<string>")
    )
    return F.array_distinct(
        F.concat(
            domains,
            F.transform(words, lambda x: F.concat(F.lit("path="), x)),
            F.transform(keys, lambda x: F.concat(F.lit("key="), x)),
            mark,
        )
    )


def mine(
    labelled: DataFrame,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    min_lift: float = MIN_LIFT,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``items``, ``confidence``, ``support``, ``anchor`` of rules items -> block.

    ``labelled``: ``url``, ``blocked``. Rows with a null in either teach nothing. A
    rule goes if some of its items alone block with at least its confidence. The
    anchor is the rule's rarest item. No more than the tokens of a URL divided by
    ``min_support`` can be frequent, so the item list that FP-growth holds is bounded.
    """
    baskets = labelled.filter("url is not null and blocked is not null").select(
        F.array_union(
            F.coalesce(tokens("url"), F.array().cast("array<string>")),
            F.when(F.col("blocked"), F.array(F.lit(BLOCK))).otherwise(F.array().cast("array<string>")),
        ).alias("items")
    )
    least = min(1.0, max(min_support, min_count / max(1, baskets.count())))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=min_confidence).fit(baskets)
    rules = (
        model.associationRules.filter(
            F.array_contains("consequent", BLOCK) & (F.col("lift") >= min_lift)
        )
        .select(F.array_sort("antecedent").alias("items"), "confidence", "support")
    )
    wide = rules.select("*", F.explode("items").alias("first"))
    narrow = rules.select(
        F.col("items").alias("part"),
        F.col("confidence").alias("general"),
        F.col("items")[0].alias("first"),
    )
    needless = (
        wide.join(narrow, "first")
        .filter(
            (F.size("part") < F.size("items"))
            & (F.size(F.array_except("part", "items")) == 0)
            & (F.col("general") >= F.col("confidence"))
        )
        .select("items")
        .distinct()
    )
    single = model.freqItemsets.filter(F.size("items") == 1).select(
        F.col("items")[0].alias("item"), "freq"
    )
    anchors = (
        rules.select("items", F.explode("items").alias("item"))
        .join(single, "item")
        .groupBy("items")
        .agg(F.min(F.struct("freq", "item"))["item"].alias("anchor"))
    )
    return rules.join(needless, "items", "left_anti").join(anchors, "items")


def ruled(host_column: str, path_column: str, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest fixed rule that fits, as (rule, verdict); null if none does."""
    choice = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        own = (F.col(host_column) == domain) | F.col(host_column).endswith(f".{domain}")
        value = F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))
        choice = F.when(own & F.col(path_column).startswith(start), value).otherwise(choice)
    return choice


def judge(
    pages: DataFrame, mined: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """Per row ``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``mined`` (items of a rule).

    A fixed rule decides; else a page is blocked if all items of a mined rule are
    among its tokens, and allowed otherwise, null URLs included. Each page looks up
    its tokens in the index of anchors; of several mined rules that fit, ``mined``
    shows the most confident, of equal ones the last by its items. Rows that repeat
    are kept; other columns are left out.
    """
    parsed = pages.select(
        F.monotonically_increasing_id().alias("_row"),
        "page_id",
        host("url").alias("host"),
        path("url").alias("path"),
        tokens("url").alias("_tokens"),
    ).withColumn("_choice", ruled("host", "path", rules))
    index = mined.select(F.col("anchor").alias("_token"), "items", "confidence")
    looked = parsed.select("*", F.explode_outer("_tokens").alias("_token")).join(index, "_token", "left")
    fits = F.size(F.array_except("items", "_tokens")) == 0
    best = F.max(F.when(F.col("items").isNotNull() & fits, F.struct("confidence", "items")))
    return (
        looked.groupBy("_row", "page_id", "host", "path", "_choice")
        .agg(best.alias("_best"))
        .select(
            "page_id",
            "host",
            "path",
            F.col("_choice.rule").alias("rule"),
            F.coalesce(
                F.col("_choice.verdict"),
                F.when(F.col("_best").isNotNull(), F.lit("block")).otherwise(F.lit("allow")),
            ).alias("verdict"),
            F.col("_best.items").alias("mined"),
        )
    )
