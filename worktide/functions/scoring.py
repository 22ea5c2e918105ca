"""Matching scores and explanations as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def skill_match_ratio(mine: Column, wanted: Column) -> Column:
    """Share of the job's distinct skills that the candidate has; 0 when either list is empty."""
    size = F.size(F.array_distinct(wanted))
    return F.when((F.size(mine) > 0) & (size > 0), F.size(F.array_intersect(mine, wanted)) / size).otherwise(0.0)


def match_score(
    mine: Column, wanted: Column, same_category: Column, same_form: Column, same_place: Column, years: Column,
    min_years: Column, max_years: Column,
) -> Column:
    """10 x skill ratio, +3 category, +1 form, +1 place, +2 experience (open ends: 0 and two years up)."""

    def points(flag: Column, worth: int) -> Column:
        return F.when(flag, worth).otherwise(0)

    low = F.coalesce(min_years, F.lit(0.0))
    fits = years.between(low, F.coalesce(max_years, low + 2))
    return (
        skill_match_ratio(mine, wanted) * 10 + points(same_category, 3) + points(same_form, 1) + points(same_place, 1)
        + points(fits, 2)
    )


def score_band(score: Column) -> Column:
    return F.when(score >= 12, "top").when(score >= 9, "high").when(score >= 5, "mid").otherwise("low")


def explain_experience(source: Column, years: Column, min_years: Column, max_years: Column) -> Column:
    mine = F.coalesce(years, F.lit(0.0))
    top = F.coalesce(F.nullif(max_years, F.lit(0.0)), F.lit(99.0))
    return (
        F.when(source == "default", "fresher_fallback")
        .when(mine < F.coalesce(min_years, F.lit(0.0)), "underqualified")
        .when(mine > top, "overqualified")
        .otherwise("exact")
    )


def days_left(expires: Column, today: Column) -> Column:
    return F.coalesce(F.datediff(expires, today), F.lit(-1))


def salary_label(low: Column, high: Column, currency: Column, kind: Column) -> Column:
    shown = F.concat(
        F.format_number(low, 0), F.lit("–"), F.format_number(high, 0), F.lit(" "), F.coalesce(currency, F.lit("VND")),
        F.lit("/"), F.coalesce(kind, F.lit("")),
    )
    return F.when((low > 0) & (high > 0), shown).otherwise("Thỏa thuận")


def matched(mine: Column, wanted: Column) -> Column:
    return F.array_sort(F.array_intersect(wanted, mine))


def missing(mine: Column, wanted: Column) -> Column:
    return F.array_sort(F.array_except(wanted, mine))
