"""Lookups, substring matching, alias mapping and export joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .windows import top_k


def star_lookup(
    fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str, str]], literal: Sequence[int] = ()
) -> DataFrame:
    """Left-join each ``(dim, fact_col, dim_col, key_col)`` on its natural key, keeping only the key.

    ``literal`` lists positions of dims that are fixed code lists; only those are broadcast by hint.
    Others are left to adaptive execution, which broadcasts by measured size and splits skew.
    """
    for i, (dim, fact_col, dim_col, key) in enumerate(dims):
        side = dim.select(F.col(dim_col).alias(f"_d{i}"), F.col(key))
        side = F.broadcast(side) if i in literal else side
        fact = fact.join(side, F.col(fact_col) == F.col(f"_d{i}"), "left").drop(f"_d{i}")
    return fact


def unique_lookup(df: DataFrame, key: str) -> DataFrame:
    """One row per key (smallest row), so that a lookup join cannot fan out."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c != key]
    return top_k(df, [key], rest or [F.col(key)], 1)


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    return child.join(parent.select(*on), list(on), "left_anti")


def combinations(df: DataFrame, a: str, b: str) -> DataFrame:
    """Every value of ``a`` with every value of ``b``; the product itself is the result."""
    left, right = df.select(a).distinct(), df.select(b).distinct()
    return left.crossJoin(right)


def map_alias(df: DataFrame, mapping: DataFrame, skip: str = "__SKIP__") -> DataFrame:
    """Map ``raw_skill`` to its canonical name; unmapped ones stand for themselves, skipped ones go."""
    named = mapping.select("raw_skill", "canonical_skill", F.col("skill_type").alias("mapped_type"))
    joined = df.join(named, "raw_skill", "left")
    joined = joined.filter(F.col("canonical_skill").isNull() | (F.col("canonical_skill") != skip))
    return joined.select(
        *[c for c in df.columns], F.coalesce("canonical_skill", "raw_skill").alias("canonical_skill"),
        F.coalesce("mapped_type", F.lit("unknown")).alias("skill_type"),
    )


def longest_word(text: Column, entries: Sequence[tuple[str, str]], default: str) -> Column:
    """Value of the longest entry keyword inside ``text`` for a short fixed list."""
    ordered = sorted(entries, key=lambda e: (-len(e[0]), e[1]))

    def ladder(v: Column) -> Column:
        branches = F.when(v.isNull(), F.lit(default))
        for word, value in ordered:
            branches = branches.when(v.contains(word), F.lit(value))
        return branches.otherwise(F.lit(default))

    return let(text, ladder)


def match_longest(
    df: DataFrame, row_key: Sequence[str], text: str, words: DataFrame, word: str, value: str, default: str,
    out: str, compat_partition: Sequence[str] = (),
) -> DataFrame:
    """Add ``out``: the value of the longest dictionary word contained in ``text``, else ``default``.

    ``row_key`` identifies a posting. ``compat_partition`` keeps one posting per listed columns.
    The dictionary is joined on the substrings of its word lengths, once per distinct text, so the result
    depends on the text alone: repeated and null row keys are rows like any others. Ties go to the smallest value.
    """
    entries = words.select(F.col(word).alias("word"), F.col(value).alias("value")).distinct()
    sizes = entries.agg(F.collect_set(F.length("word"))).scalar()
    texts = df.filter(F.col(text).isNotNull()).select(F.col(text).alias("_text")).distinct().withColumn("_sizes", sizes)
    windows = F.transform(
        F.filter("_sizes", lambda n: (n > 0) & (n <= F.length("_text"))),
        lambda n: F.transform(F.sequence(F.lit(1), F.length("_text") - n + 1), lambda at: F.substring(F.col("_text"), at, n)),
    )
    pieces = texts.select("_text", F.explode(F.array_distinct(F.flatten(windows))).alias("word"))
    best = (
        pieces.join(entries, "word")
        .groupBy("_text")
        .agg(F.min(F.struct((-F.length("word")).alias("size"), "value")).alias("_best"))
    )
    joined = df.join(best, F.col(text) == F.col("_text"), "left")
    matched = joined.withColumn(out, F.coalesce(F.col("_best.value"), F.lit(default))).drop("_best", "_text")
    if not compat_partition:
        return matched
    return top_k(matched, compat_partition, [F.col(k).asc_nulls_last() for k in row_key], 1)


def export_frame(
    facts: DataFrame, jobs: DataFrame, categories: DataFrame, levels: DataFrame, skills: DataFrame,
    min_length: int = 50, min_skills: int = 3,
) -> DataFrame:
    """Flat export rows: jobs with a real requirement text and enough skills."""
    base = (
        facts.select("job_key", "category_key", "level_key")
        .join(jobs.select("job_key", "title_clean", "requirement").filter(F.length("requirement") > min_length), "job_key")
        .join(categories, "category_key", "left")
        .join(levels.select("level_key", "level_name"), "level_key", "left")
        .join(skills, "job_key", "left")
    )
    return base.filter(F.size(F.coalesce("canonical_skills", F.array().cast("array<string>"))) >= min_skills)


def interaction_frame(interactions: DataFrame, users: DataFrame, jobs: DataFrame) -> DataFrame:
    return interactions.join(users, "user_id", "left").join(jobs, "job_key", "left")


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
