"""Upserts on frames (there is no MERGE for plain files)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .windows import latest_per


def _all_set(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return present


def _require_unique(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail, as MERGE does, when several source rows address the same target row."""
    counted = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.any_value(F.struct(*source.columns)).alias("_row")
    )
    message = F.lit(f"merge source repeats a key of {list(keys)}")
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return counted.filter(checked).select("_row.*")


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None, insert: bool = True
) -> DataFrame:
    """Target after ``MERGE``: update the given (default all) columns of matches, insert the rest."""
    keys = list(keys)
    values = [c for c in target.columns if c not in keys]
    update = values if update is None else list(update)
    given = [c for c in values if c in source.columns]
    new = _require_unique(source.filter(_all_set(keys)), keys).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in given],
        F.lit(True).alias("_in_source"),
    )
    old = target.withColumn("_in_target", F.lit(True))
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    joined = old.join(new, on, "full" if insert else "left")
    fresh, hit = F.col("_in_target").isNull(), F.coalesce(F.col("_in_source"), F.lit(False))
    columns: list[Column] = []
    for c in target.columns:
        if c in keys:
            columns.append(F.coalesce(F.col(c), F.col(f"_k_{c}")).alias(c))
        elif c not in given:
            columns.append(F.col(c))
        else:
            take_new = (fresh | hit) if c in update else fresh
            columns.append(F.when(take_new, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c))
    merged = joined.select(*columns)
    if not insert:
        return merged
    # A null key matches nothing, so such source rows are always inserted.
    loose = source.filter(~_all_set(keys))
    return merged.unionByName(loose.select(*[c for c in target.columns if c in loose.columns]), allowMissingColumns=True)


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target plus the source rows whose key it lacks, once per key."""
    fresh = latest_per(only_new(source, target, keys), keys, [F.asc_nulls_last(c) for c in source.columns])
    return target.unionByName(fresh.select(*target.columns))


def only_new(df: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
    return df.join(known.select(*on), list(on), "left_anti")


def replace_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str], scope: DataFrame | None = None) -> DataFrame:
    """Drop target rows whose key is in ``scope`` (default: the source keys), then append the source."""
    gone = (source if scope is None else scope).select(*keys)
    return target.join(gone, list(keys), "left_anti").unionByName(source.select(*target.columns))


def flag_rows(target: DataFrame, keys: DataFrame, on: Sequence[str], column: str, value: Column) -> DataFrame:
    """Set ``column`` to ``value`` on rows whose key is listed."""
    listed = keys.select(*on).distinct().withColumn("_listed", F.lit(True))
    marked = target.join(listed, list(on), "left")
    new = F.when(F.col("_listed"), value).otherwise(F.col(column)).alias(column)
    return marked.select(*[new if c == column else F.col(c) for c in target.columns])


def empty_table(spark: SparkSession, schema: StructType | str) -> DataFrame:
    return spark.createDataFrame([], schema)


def conform_to(df: DataFrame, schema: StructType) -> DataFrame:
    """Enforce a declared schema: order, nullability and safe casts."""
    return df.to(schema)


def compaction_files(total_bytes: int, target_bytes: int = 134_217_728) -> int:
    return max(1, -(-total_bytes // target_bytes))


def compact(df: DataFrame, total_bytes: int, target_bytes: int = 134_217_728) -> DataFrame:
    """Re-partition so that each written file has about ``target_bytes``."""
    return df.repartition(compaction_files(total_bytes, target_bytes))


def expired_versions(versions: DataFrame, now: Column, keep: int = 3, max_age_days: int = 7, by: Sequence[str] = ("table",)) -> DataFrame:
    """Versions older than the limit and not among the newest ``keep`` of their table."""
    from .windows import top_k

    old = versions.filter(F.col("committed_at") < now - F.expr(f"interval {int(max_age_days)} days"))
    kept = top_k(versions, by, [F.desc("committed_at"), F.desc("version")], keep)
    return old.join(kept.select(*by, "version"), [*by, "version"], "left_anti")
