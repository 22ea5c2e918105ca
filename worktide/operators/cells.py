"""Top-k scoring of rows that meet in a cell: equal keys, overlapping intervals, shared entries.

Both sides are dealt to the cells in which a pair can qualify, so cells without rows of both sides cost nothing.
A large cell is cut into blocks on both sides; each block of pairs is scored with array arithmetic and returns the best ``k``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .grid import Score, best_rows, block_solver
from .postings import spread_lookup
from .prefix import ordered_prefix


def cells_top_k(
    left: DataFrame, right: DataFrame, left_id: str, right_id: str, cell: str, score: Score, k: int,
    digits: int = 6, count: str | None = None, left_block: int = 1024, right_block: int = 8192,
) -> DataFrame:
    """(left_id, right_id, score[, count]): the ``k`` best finite scores of every left row among the right rows of its cells.

    A row may be in several cells; ``score`` is finite for a pair in one of them at most. ``cell`` is a column of both sides,
    not null. ``count`` adds the number of qualifying right rows.
    """
    fresh = right.select(*[F.col(c).alias(c if c == cell else f"_r_{c}") for c in right.columns])
    sizes = left.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / left_block).cast("int").alias("_rows")).join(
        fresh.groupBy(cell).agg(F.ceil(F.count(F.lit(1)) / right_block).cast("int").alias("_cols")), cell
    )

    def dealt(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        placed = spread_lookup(df, sizes, cell, key).withColumn("_own", F.pmod(F.xxhash64(key), F.col(own).cast("bigint")).cast("int"))
        return placed.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))

    a = dealt(left, left_id, "_rows", "_cols").withColumn("_block", F.col("_own") * F.col("_cols") + F.col("_copy"))
    b = dealt(fresh, f"_r_{right_id}", "_cols", "_rows").withColumn("_block", F.col("_copy") * F.col("_cols") + F.col("_own"))
    spare = ("_rows", "_cols", "_own", "_copy")
    a, b = a.drop(*spare), b.drop(*spare)
    b = b.select(*[F.col(c).alias(c) for c in b.columns])
    kinds = left.schema[left_id].dataType.simpleString(), right.schema[right_id].dataType.simpleString()
    schema = f"l {kinds[0]}, r {kinds[1]}, score double, n bigint"
    # Blocks are few bytes and much work, so their tasks are not folded by size.
    tasks = 4 * max(left.sparkSession.sparkContext.defaultParallelism, int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    a, b = (x.repartition(tasks, cell, "_block") for x in (a, b))
    scored = a.groupBy(cell, "_block").cogroup(b.groupBy(cell, "_block")).applyInPandas(block_solver(left_id, right_id, score, k, digits), schema)
    return best_rows(scored, left_id, right_id, k, count)


def answered_once(rows: DataFrame, key: str, answer: Callable[[DataFrame], DataFrame], other: str, count: str) -> DataFrame:
    """``answer`` where rows that differ only in ``key`` are answered once and share the result.

    ``answer`` gets the distinct rows with numbers for ``key`` and returns (key, other, score, count), few rows per key.
    Rows whose key comes more than once are answered as they are; null keys have no answer.
    """
    named = rows.filter(F.col(key).isNotNull())
    repeated = cut_lineage(named.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(key))
    some = not repeated.isEmpty()
    single = named.join(repeated, key, "left_anti") if some else named
    same = F.struct(*[c for c in rows.columns if c != key]).alias("_same")
    members = single.select(F.col(key).alias("_key"), same)
    numbered = cut_lineage(ordered_prefix(members.select("_same").distinct(), [], [F.asc("_same")], rank="_id").select("_same", "_id"))
    found = answer(numbered.select(F.col("_id").alias(key), "_same.*"))
    lists = found.groupBy(F.col(key).alias("_id")).agg(F.collect_list(F.struct(other, "score", count)).alias("_best"))
    asked = spread_lookup(members, numbered, "_same", "_key").select("_key", "_id")
    given = spread_lookup(asked, lists, "_id", "_key").select(F.col("_key").alias(key), F.explode("_best").alias("_b"))
    flat = given.select(key, *[F.col(f"_b.{c}").alias(c) for c in (other, "score", count)])
    return flat.unionByName(answer(named.join(repeated, key, "left_semi").select(*rows.columns))) if some else flat


def bins_between(first: Column, last: Column, width: Column) -> Column:
    """The numbers of the bins from the one of ``first`` to the one of ``last``; none if either is null or they are swapped."""
    low, high = F.floor(first / width), F.floor(last / width)
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
