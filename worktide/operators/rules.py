"""Sectors by a table of keywords, of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import normalize_common, unaccent

RULES = "rule_order int, sector string, keyword string"


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules (rule_order, sector, keyword) from CSV with a header; the table of a platform is longer than a plan should carry."""
    return spark.read.csv(path, header=True, schema=RULES)


def folded(text: Column) -> Column:
    return unaccent(normalize_common(text))


def sector_by_keywords(df: DataFrame, text: str, rules: DataFrame) -> DataFrame:
    """``df`` with industry_sector, industry_status and industry_keyword: of the rules whose keyword occurs in the text, the first.

    Texts and keywords are compared without accents and case. Each distinct text is cut into the pieces that are as long as some
    keyword, and these are joined to the rules, so the work grows with the texts and not with the number of rules. Status is
    ``missing`` for a blank text and ``unmapped`` where no rule fits. Of rules of one order the smallest keyword counts.
    """
    entries = rules.select("rule_order", "sector", folded(F.col("keyword")).alias("_piece")).filter("_piece != ''")
    sizes = entries.agg(F.collect_set(F.length("_piece"))).scalar()
    cleaned = df.withColumn("_text", folded(F.col(text)))
    texts = cleaned.select("_text").filter("_text != ''").distinct().withColumn("_sizes", sizes)
    cut = F.transform(
        F.filter("_sizes", lambda n: n <= F.length("_text")),
        lambda n: F.transform(F.sequence(F.lit(1), F.length("_text") - n + 1), lambda at: F.substring(F.col("_text"), at, n)),
    )
    # The outer form keeps Spark from cutting the pieces once more in an inferred filter.
    pieces = texts.select("_text", F.explode_outer(F.array_distinct(F.flatten(cut))).alias("_piece"))
    best = pieces.join(entries, "_piece").groupBy("_text").agg(F.min(F.struct("rule_order", "_piece", "sector")).alias("_rule"))
    joined = cleaned.join(best, "_text", "left")
    blank = F.coalesce(F.col("_text") == "", F.lit(True))
    status = F.when(blank, "missing").when(F.col("_rule").isNull(), "unmapped").otherwise("matched")
    return joined.select(
        *df.columns, F.col("_rule.sector").alias("industry_sector"), status.alias("industry_status"), F.col("_rule._piece").alias("industry_keyword")
    )
