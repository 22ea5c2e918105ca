"""Filters, pages and listing projections."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_blank(df: DataFrame, *columns: str) -> DataFrame:
    for c in columns:
        df = df.filter(F.trim(F.col(c)) != "")
    return df


def apply_defaults(df: DataFrame, impute_zero: bool = False) -> DataFrame:
    """Currency of negotiable salaries, education code, and optionally zero years."""
    changes = {
        "currency": F.when(F.col("salary_type") == "negotiable", "VND").otherwise(F.col("currency")),
        "education_standard": F.coalesce("education_standard", F.lit("0")),
    }
    if impute_zero:
        low, high = F.coalesce("min_years", F.lit(0.0)), F.coalesce("max_years", F.lit(0.0))
        open_type = F.col("experience_type").isNull() & (low == 0) & (high == 0)
        changes |= {
            "min_years": low, "max_years": high,
            "experience_type": F.when(open_type, "none").otherwise(F.col("experience_type")),
        }
    return df.withColumns(changes)


def replace_nan(df: DataFrame, defaults: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.nanvl(F.col(c), F.lit(v)), F.lit(v)) for c, v in defaults.items()})


def filter_listing(
    df: DataFrame, keyword: str = "", location: str | None = None, min_salary: float = 0, skills: Sequence[str] = ()
) -> DataFrame:
    """Listing search: literal keyword in title or description, place, salary and any of the skills."""
    if keyword:
        word = keyword.lower()
        hit = F.lower("title").contains(word) | F.lower("description").contains(word)
        df = df.filter(F.coalesce(hit, F.lit(False)))
    if location:
        df = df.filter(F.col("location") == location)
    if min_salary > 0:
        df = df.filter(F.col("salary_max") >= min_salary)
    if skills:
        df = df.filter(F.arrays_overlap("skills", F.array(*[F.lit(s) for s in skills])))
    return df


def paginate(df: DataFrame, order: Sequence[Column], page: int, size: int) -> DataFrame:
    """Rows of one page with the total number of pages (at least one)."""
    total = df.agg(F.greatest(F.lit(1), F.ceil(F.count(F.lit(1)) / size)).cast("bigint").alias("n"))
    rows = df.orderBy(*order).offset((page - 1) * size).limit(size)
    return rows.withColumn("total_pages", total.scalar())


def active_snapshot(df: DataFrame, today: datetime.date | Column) -> DataFrame:
    """Rows of the newest snapshot that have not expired."""
    newest = df.agg(F.max("snapshot_at").alias("m")).scalar()
    day = F.lit(today) if isinstance(today, datetime.date) else today
    return df.filter((F.col("snapshot_at") == newest) & (F.col("expired_date") >= day))


def listing_view(df: DataFrame) -> DataFrame:
    def years(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("N/A"))

    return df.select(
        F.col("job_key").alias("job_id"),
        F.concat("category_name", F.lit(" at "), "company_name").alias("title"),
        F.col("company_name").alias("company"), F.col("location_name").alias("location"),
        (F.col("min_salary_vnd") / 1_000_000).alias("salary_min"), (F.col("max_salary_vnd") / 1_000_000).alias("salary_max"),
        F.col("experience_type_name").alias("seniority"),
        F.concat(
            F.lit("Level: "), "education_name", F.lit(" | Experience: "), years("min_years"), F.lit("-"),
            years("max_years"), F.lit(" years | Work form: "), "work_form_name", F.lit(" | Quantity: "),
            F.col("quantity_normalized").cast("string"),
        ).alias("description"),
    )


def convert(amount: Column, rate: float) -> Column:
    return amount / F.lit(rate)


def rich_enough(df: DataFrame, min_length: int = 50, min_skills: int = 3) -> DataFrame:
    skills = F.size(F.coalesce("skills", F.array().cast("array<string>")))
    return df.filter((F.length("requirement") > min_length) & (skills >= min_skills))


def select_series(df: DataFrame, codes: Sequence[str], start: str | None = None, end: str | None = None) -> DataFrame:
    df = df.filter(F.col("indicator_code").isin(*codes))
    if start:
        df = df.filter(F.col("full_date") >= F.lit(start).cast("date"))
    if end:
        df = df.filter(F.col("full_date") <= F.lit(end).cast("date"))
    return df
