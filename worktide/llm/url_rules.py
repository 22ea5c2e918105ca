"""URL filter: given host and path rules first, mined association rules for what they leave open.

Token combinations of URLs that the given rules decide are mined with FP-growth. Rules of enough support and
confidence are indexed by their rarest token; a URL meets only rules indexed under one of its tokens.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fold_case, hash_sample

Rule = tuple[str, str, str]  # host, path, verdict
LONGEST = 4  # tokens of a mined rule


def host_of(url: Column) -> Column:
    """A-Z in lower case; empty for null or without ``://``."""
    return fold_case(F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as host and path in one string; null if none does."""
    out = F.lit(None).cast("string")
    for rule_host, rule_path, _ in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.lit(rule_host + rule_path)).otherwise(out)
    return out


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, parts of the host, words of the path and names of the query; numbers count as one token."""
    words = F.transform(F.split(path, r"[/._-]+"), lambda x: F.when(x.rlike(r"^\d+$"), F.lit("path=#")).when(x != "", F.concat(F.lit("path="), x)))
    names = F.transform(F.regexp_extract_all(url, F.lit(r"[?&]([^=&#]+)"), F.lit(1)), lambda x: F.concat(F.lit("query="), x))
    parts = F.transform(F.split(host, r"\."), lambda x: F.when(x != "", F.concat(F.lit("host="), x)))
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(url, r"^([^:/?#]*)://", 1)))
    every = F.concat(*[F.coalesce(x, F.array().cast("array<string>")) for x in (scheme, parts, words, names)])
    return F.array_distinct(F.filter(every, lambda x: x.isNotNull()))


def mine(labelled: DataFrame, items: str, verdict: str, min_support: float, min_confidence: float) -> DataFrame | None:
    """antecedent, verdict, confidence and support of rules from token sets to a verdict; None without rows."""
    marked = labelled.select(F.array_append(items, F.concat(F.lit("verdict="), F.col(verdict))).alias("items"))
    if marked.isEmpty():
        return None
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(marked)
    said = F.element_at("consequent", 1)
    return model.associationRules.where(said.startswith("verdict=") & (F.size("antecedent") <= LONGEST)).select(
        F.array_sort("antecedent").alias("antecedent"), F.regexp_replace(said, "^verdict=", "").alias("verdict"), "confidence", "support"
    )


def indexed(rules: DataFrame) -> DataFrame:
    """The rules with the token to look them up by: the one that the fewest rules hold, then the first."""
    held = rules.select(F.explode("antecedent").alias("_token")).groupBy("_token").count()
    by_token = rules.select("*", F.explode("antecedent").alias("_token")).join(held, "_token")
    rarest = by_token.groupBy("antecedent", "verdict", "confidence", "support").agg(F.min(F.struct("count", "_token")).alias("_least"))
    return rarest.select("antecedent", "verdict", "confidence", "support", F.col("_least._token").alias("_token"))


def judge(
    df: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", default: str = "allow",
    sample: int = 50_000, min_support: float = 0.02, min_confidence: float = 0.7,
) -> DataFrame:
    """One row per input row: ``key``, host, path, rule, verdict, confidence (of a mined rule, else null).

    A given rule decides; where none fits, the mined rule of the highest confidence, then support, then
    most tokens, then ``block``; where none of those fits either, ``default``. Rules are mined from at most about
    ``sample`` decided URLs, chosen by hash, and have at most LONGEST tokens; all of them are tried. Null and malformed URLs have empty host and path and no tokens but their
    scheme; repeated rows give repeated results.
    """
    verdicts = F.create_map(*[F.lit(x) for h, p, v in rules for x in (h + p, v)])
    parts = df.select(F.col(key).alias("_k"), F.col(url).alias("_url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    parts = parts.select("*", given_rule(F.col("host"), F.col("path"), rules).alias("rule"))
    parts = parts.select("*", verdicts[F.col("rule")].alias("_said"), tokens(F.col("_url"), F.col("host"), F.col("path")).alias("_items"))
    labelled = hash_sample(parts.where("rule IS NOT NULL").select("_k", "_items", "_said"), "_k", sample)
    mined = mine(labelled, "_items", "_said", min_support, min_confidence)
    decided = parts.where("rule IS NOT NULL").select("_k", "host", "path", "rule", F.col("_said").alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    open_urls = parts.where("rule IS NULL").select("_k", F.monotonically_increasing_id().alias("_row"), "host", "path", "_items")
    if mined is None:
        judged = open_urls.select("_k", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"), F.lit(None).cast("double").alias("confidence"))
    else:
        index = indexed(mined).select("_token", "antecedent", F.struct("confidence", "support", F.size("antecedent").alias("size"), "verdict").alias("_rule"))
        met = open_urls.select("*", F.explode_outer("_items").alias("_token")).join(index, "_token", "left")
        fits = F.when(F.size(F.array_except("antecedent", "_items")) == 0, F.col("_rule"))
        best = met.select("_k", "_row", "host", "path", fits.alias("_fit")).groupBy("_k", "_row", "host", "path").agg(F.max("_fit").alias("_best"))
        judged = best.select("_k", "host", "path", F.lit(None).cast("string").alias("rule"), F.coalesce("_best.verdict", F.lit(default)).alias("verdict"), F.col("_best.confidence").alias("confidence"))
    return decided.unionByName(judged).withColumnRenamed("_k", key)
