"""Deduplication, top-k, keys and panel windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import content_key
from .prefix import ordered_prefix


def top_k(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int, rank: str | None = None) -> DataFrame:
    """The first ``k`` rows of each part. Spark limits groups before the shuffle, so hot parts stay small."""
    window = Window.partitionBy(*part).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= k)
    return ranked.withColumnRenamed("_rank", rank) if rank else ranked.drop("_rank")


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_null_keys: bool = False) -> DataFrame:
    """One row per key, the first by ``order``; rows without a key are all kept or treated as one key."""
    if not keep_null_keys:
        return top_k(df, keys, order, 1)
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    return top_k(df.filter(keyed), keys, order, 1).unionByName(df.filter(~keyed))


def dedupe_content(
    df: DataFrame, columns: Sequence[str], order: Sequence[Column], lists: Sequence[str] = (), keep_nulls: bool = True
) -> DataFrame:
    """One row per equal content; ``lists`` compare as sorted sets of words, nulls as '' or skipped."""
    values = [F.col(c) for c in columns]
    values += [F.concat_ws("||", F.sort_array(F.col(c))) for c in lists]
    keyed = df.withColumn("_content", content_key(values, keep_nulls))
    return latest_per(keyed, ["_content"], order).drop("_content")


def assign_keys(new: DataFrame, existing: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Number ``new`` rows by ``order``, continuing after the largest key of ``existing``."""
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("m"))
    ranked = ordered_prefix(new, [], order, rank="_rank")
    return ranked.select((F.col("_rank") + top.scalar()).cast("bigint").alias(key), *new.columns)


def running_total(df: DataFrame, part: Sequence[str], order: Sequence[Column], value: Column, name: str) -> DataFrame:
    return ordered_prefix(df, part, order, rank="position", sums={name: value})


def _panel(panel: Sequence[str], time: str):
    # Series are aggregated to one row per (panel, time) before, so a group is bounded by its calendar.
    return Window.partitionBy(*panel).orderBy(time)


def fill(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str]) -> DataFrame:
    """Fill gaps forward, then the leading gap backward."""
    past = _panel(panel, time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    future = _panel(panel, time).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = {
        c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(future)) for c in columns
    }
    return df.withColumns(filled)


def difference(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], order: int = 1) -> DataFrame:
    """Difference ``order`` times; rows without enough history are dropped."""
    window = _panel(panel, time)
    for _ in range(order):
        df = df.withColumns({c: F.col(c) - F.lag(c).over(window) for c in columns}).withColumn(
            "_seq", F.row_number().over(window)
        )
        df = df.filter(F.col("_seq") > 1).drop("_seq")
    return df


def undifference(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], bases: Sequence[str]) -> DataFrame:
    """Undo differencing by running sums.

    ``bases`` name per-row suffixes of the last known levels, innermost first: with ``["d1", "d0"]``
    column ``x`` is summed onto ``x_d1`` (last first difference), then onto ``x_d0`` (last level).
    """
    upto = _panel(panel, time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for base in bases:
        df = df.withColumns({c: F.sum(c).over(upto) + F.col(f"{c}_{base}") for c in columns})
    return df


def lag_features(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], p: int) -> DataFrame:
    """Add ``c_lag1..c_lagp`` and keep rows with a full history."""
    window = _panel(panel, time)
    lags = {f"{c}_lag{i}": F.lag(c, i).over(window) for c in columns for i in range(1, p + 1)}
    df = df.withColumns({**lags, "_seq": F.row_number().over(window)})
    return df.filter(F.col("_seq") > p).drop("_seq")


def chrono_split(df: DataFrame, panel: Sequence[str], time: str, share: float = 0.8) -> DataFrame:
    """Tag the first ``share`` of every panel as ``train``, the rest as ``test``."""
    ranked = ordered_prefix(df, panel, [F.col(time).asc()], rank="_rank", total="_all")
    split = F.when(F.col("_rank") <= F.floor(F.col("_all") * share), "train").otherwise("test")
    return ranked.withColumn("split", split).drop("_rank", "_all")


def user_split(
    df: DataFrame, user: str, item: str, share: float = 0.8, seed: int = 42, unique: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Random but repeatable train/test rows per user.

    Users with one row train only; test keeps items that also occur in training. A test set is
    ``ceil((1 - share) * n)`` rows, chosen by a seeded hash.
    """
    draw = F.xxhash64(F.col(user), F.col(item), F.lit(seed))
    ranked = ordered_prefix(
        df.withColumn("_draw", draw), [user], [F.col("_draw").asc(), F.col(item).asc()], rank="_rank", total="_all"
    )
    held = F.ceil(F.round(F.col("_all") * (1 - share), 9))
    in_test = (F.col("_all") >= 2) & (F.col("_rank") <= held)
    train = ranked.filter(~in_test).select(*df.columns)
    test = ranked.filter(in_test).select(*df.columns)
    return train, restrict(test, train, [item])


def restrict(test: DataFrame, train: DataFrame, on: Sequence[str]) -> DataFrame:
    return test.join(train.select(*on).distinct(), list(on), "left_semi")


def next_batch(df: DataFrame, key: str, order: Sequence[Column], size: int, latest: Sequence[Column]) -> DataFrame:
    """The next ``size`` keys to process, each with its latest row."""
    return latest_per(df, [key], latest).orderBy(*order).limit(size)


def stable_sample(df: DataFrame, key: str, size: int, seed: int = 42) -> DataFrame:
    """``size`` rows that depend on key values only, not on partitioning."""
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(size)
