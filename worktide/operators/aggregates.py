"""Skill demand, frequencies, medians, profiles and interaction quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_accents
from .skew import lookup_by_key
from .windows import top_k


def skill_counts(mapped: DataFrame) -> DataFrame:
    """Distinct jobs per (category_key, skill_key)."""
    return mapped.groupBy("category_key", "skill_key").agg(F.countDistinct("job_key").alias("job_count"))


def skill_coverage(mapped: DataFrame) -> DataFrame:
    """Demand per category with its share of the category's jobs that name any mapped skill, in one shuffle by job.

    The rows of a job in a category meet in order of their skills, so the first of each skill and the first of all are
    counted where they stand, and no distinct keys are sent again.
    """
    keys = ["category_key", "skill_key"]
    of_job = Window.partitionBy("category_key", "job_key").orderBy("skill_key")
    placed = mapped.select(*keys, "job_key", F.row_number().over(of_job).alias("_place"), F.lag("skill_key").over(of_job).alias("_before"))
    firsts = placed.filter((F.col("_place") == 1) | ~F.col("skill_key").eqNullSafe(F.col("_before")))
    counted = firsts.groupBy(*keys).agg(
        F.count("job_key").alias("job_count"), F.count(F.when(F.col("_place") == 1, F.col("job_key"))).alias("_jobs")
    )
    # The counts are one row per category and skill; a job is in ``_jobs`` of one of them.
    total = F.sum("_jobs").over(Window.partitionBy("category_key"))
    return counted.select(*keys, "job_count", (F.col("job_count") / F.nullif(total, F.lit(0))).alias("coverage"))


def frequencies(df: DataFrame, by: Sequence[str], form: str | None = None) -> DataFrame:
    """Count per group, with the smallest display form."""
    shown = [F.min(form).alias(form)] if form else []
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("freq"), *shown)


def cumulative_cover(freq: DataFrame, percents: Sequence[int]) -> DataFrame:
    """How many of the most frequent items stay within each percentage of all occurrences.

    Items are folded to a histogram of frequencies first (its size grows with the square root of
    the data), so the ordered sum runs over few rows however many items there are.
    """
    histogram = freq.groupBy("freq").agg(F.count(F.lit(1)).alias("items"))
    before = Window.partitionBy(F.lit(0)).orderBy(F.desc("freq")).rowsBetween(Window.unboundedPreceding, -1)
    mass = F.col("freq") * F.col("items")
    steps = histogram.select(
        "freq", "items", F.coalesce(F.sum(mass).over(before), F.lit(0)).alias("mass_before"),
        F.sum(mass).over(Window.partitionBy(F.lit(0))).alias("all_mass"),
    )
    steps = steps.withColumn("percent", F.explode(F.array(*[F.lit(int(p)) for p in percents])))
    room = F.col("percent") * F.col("all_mass") - 100 * F.col("mass_before")
    fits = F.least(F.col("items"), F.greatest(F.floor(room / (100 * F.col("freq"))), F.lit(0)))
    return steps.groupBy("percent").agg(F.sum(fits).cast("bigint").alias("items_within"))


def top_distinct(df: DataFrame, item: str, key: str, n: int) -> DataFrame:
    """The ``n`` items found in most distinct keys, ties by name."""
    counted = df.groupBy(item).agg(F.countDistinct(key).alias("n_jobs"))
    return counted.orderBy(F.desc("n_jobs"), F.asc(item)).limit(n)


def representative(df: DataFrame, group: str, form: str) -> DataFrame:
    """Most frequent form of each group, ties alphabetically."""
    counted = df.groupBy(group, form).agg(F.count(F.lit(1)).alias("cnt"))
    return top_k(counted, [group], [F.desc("cnt"), F.asc(form)], 1)


def mean_by(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(value).alias(value))


def to_wide(df: DataFrame, index: Sequence[str], column: str, values: Sequence[str], value: str) -> DataFrame:
    """One column per listed value; the smallest entry represents repeated cells."""
    return df.groupBy(*index).pivot(column, list(values)).agg(F.min(value))


def strongest(df: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    return df.groupBy(user, item).agg(F.max(rating).alias(rating))


def ordered_lists(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Distinct values per key as aligned, sorted lists. A list is as long as its key has values."""
    rows = df.select(key, F.struct(*columns).alias("_row")).distinct()
    sorted_rows = F.array_sort(F.collect_list("_row"))
    lists = rows.groupBy(key).agg(sorted_rows.alias("_rows"))
    return lists.select(key, *[F.col(f"_rows.{c}").alias(c) for c in columns])


def median_with_fallback(df: DataFrame, by: str, columns: Sequence[str], constants: Mapping[str, float]) -> DataFrame:
    """Median per group; a group without values takes the global median, then a constant.

    Values are counted per group before they meet, so a hot group costs its distinct values only.
    """
    result = df.select(by).distinct()
    for c in columns:
        counted = df.filter(F.col(c).isNotNull()).groupBy(by, c).agg(F.count(F.lit(1)).alias("_n"))
        groups = counted.groupBy(by).agg(F.percentile(c, 0.5, F.col("_n")).alias(f"_{c}"))
        everywhere = counted.groupBy(c).agg(F.sum("_n").alias("_n")).agg(F.percentile(c, 0.5, F.col("_n")).alias("m"))
        result = result.join(groups.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")
        filled = F.coalesce(F.col(f"_{c}"), everywhere.scalar(), F.lit(float(constants[c])))
        result = result.withColumn(c, filled).drop(f"_{c}")
    return result


def distinct_on(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def max_key(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.coalesce(F.max(column), F.lit(0)).alias("max_key"))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, blanks and filled values per column, in one pass."""
    aggs = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        text = F.trim(F.col(c).cast("string"))
        aggs += [F.count_if(F.col(c).isNull()).alias(f"{c}__null"), F.count_if(text == "").alias(f"{c}__empty")]
    entries = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.col("rows").alias("rows"), F.col(f"{c}__null").alias("nulls"),
            F.col(f"{c}__empty").alias("empty"), (F.col("rows") - F.col(f"{c}__null") - F.col(f"{c}__empty")).alias("filled"),
            (F.col(f"{c}__null") / F.col("rows")).alias("null_rate"),
        )
        for c in columns
    ])
    return df.agg(*aggs).select(F.inline(entries))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc(column))


def overlap_count(a: Column, b: Column) -> Column:
    """Shared entries of two lists, ignoring case and surrounding space."""

    def clean(items: Column) -> Column:
        return F.transform(items, lambda s: F.lower(F.trim(s)))

    return F.coalesce(F.size(F.array_intersect(clean(a), clean(b))), F.lit(0))


def interaction_quality(frame: DataFrame) -> DataFrame:
    """Same-category rate, overlap rate and mean overlap: one row overall and one per event type."""
    rated = frame.select(
        "event_type", F.coalesce(F.col("preferred_category") == F.col("category_name_final"), F.lit(False)).alias("same"),
        overlap_count(F.col("skills"), F.col("skills_all")).alias("overlap"),
    )
    return (
        rated.rollup("event_type")
        .agg(
            F.count(F.lit(1)).alias("n"), F.avg(F.col("same").cast("int")).alias("same_category_rate"),
            F.avg((F.col("overlap") > 0).cast("int")).alias("has_skill_overlap_rate"), F.avg("overlap").alias("avg_skill_overlap"),
        )
        .withColumn("event_type", F.coalesce("event_type", F.lit("(all)")))
    )


def drop_rare_singletons(df: DataFrame, key: str, skills: str, min_count: int = 2) -> DataFrame:
    """Clean skill lists: a plain lower-case single word must occur ``min_count`` times in the batch.

    Acronyms, capitalised words and words with digits always stay; phrases go when they end in a
    stray capital vowel. Repeats (accent- and case-insensitive) keep their first form. A word that very many lists
    hold is counted before the shuffle and meets its count in all tasks.
    """
    long = df.select(key, F.posexplode(skills).alias("pos", "_raw")).withColumn("raw", F.trim("_raw"))
    long = long.withColumn("norm", F.trim(F.lower(fold_accents(F.col("raw"))))).filter(F.col("norm") != "")
    counts = long.groupBy("norm").agg(F.count(F.lit(1)).alias("seen"))
    raw, plain = F.col("raw"), fold_accents(F.col("raw"))
    upper = raw.rlike(r"\p{Lu}") & ~raw.rlike(r"\p{Ll}")
    phrase = F.col("norm").rlike(r"\S\s+\S")
    keep_phrase = ~plain.rlike("[AEIOUY]$") | upper
    strong = raw.rlike(r"\d") | upper | (raw.rlike(r"^\p{Lu}[^\p{Lu}]*\p{Ll}[^\p{Lu}]*$") & (F.length(raw) >= 3))
    kept = lookup_by_key(long, counts, "norm", "seen", key).filter(
        F.when(phrase, keep_phrase).otherwise(strong | (F.col("seen") >= min_count))
    )
    firsts = kept.groupBy(key, "norm").agg(F.min(F.struct("pos", "raw")).alias("item"))
    lists = firsts.groupBy(key).agg(F.array_sort(F.collect_list("item")).alias("_items"))
    empty = F.array().cast("array<string>")
    cleaned = df.select(key).join(lists, key, "left")
    return cleaned.select(key, F.coalesce(F.col("_items.raw"), empty).alias(skills))
