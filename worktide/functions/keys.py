"""Keys and calendar parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_key(columns: Sequence[Column], keep_nulls: bool = True) -> Column:
    """sha-256 over columns joined by ``||``; nulls count as '' or are skipped."""
    texts = [c.cast("string") for c in columns]
    if keep_nulls:
        texts = [F.coalesce(t, F.lit("")) for t in texts]
    return F.sha2(F.concat_ws("||", *texts), 256)


def business_key(link: Column, fallback: Sequence[Column]) -> Column:
    """Key from the link, or from other columns where the link is blank."""
    text = F.trim(link.cast("string"))
    joined = F.concat_ws("||", *[F.coalesce(c.cast("string"), F.lit("")) for c in fallback])
    return F.sha2(F.when(text != "", text).otherwise(joined), 256)


def name_key(name: Column) -> Column:
    return F.sha2(name, 256)


def date_key(date: Column) -> Column:
    return F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)


def year_key(year: Column) -> Column:
    return year * 10000 + 101


def month_key(year: Column, month: Column) -> Column:
    return year * 10000 + month * 100 + 1


def calendar_parts(date: Column) -> list[Column]:
    return [
        date_key(date).alias("time_key"),
        date.alias("full_date"),
        F.dayofmonth(date).alias("day"),
        F.date_format(date, "EEEE").alias("day_name"),
        F.month(date).alias("month"),
        F.date_format(date, "MMMM").alias("month_name"),
        F.quarter(date).alias("quarter"),
        F.year(date).alias("year"),
    ]
