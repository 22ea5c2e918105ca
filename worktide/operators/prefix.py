"""Ranks and running totals over a global (or hot) ordering, without sorting it in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage


def ordered_prefix(
    df: DataFrame,
    part: Sequence[str],
    order: Sequence[Column],
    rank: str = "position",
    sums: Mapping[str, Column] | None = None,
    total: str | None = None,
    slots: int | None = None,
) -> DataFrame:
    """Add the 1-based ``rank`` and running ``sums`` of each row within its ``part``.

    Rows are range-partitioned by ``(part, order)``, ranked inside each slot, and shifted by the
    totals of the slots before it. A part that holds most rows spreads over many slots. ``order``
    must be unique within a part. The placement is checkpointed, because both the ranks and
    the totals read it and must see the same slots even when a task is run again.
    """
    sums = dict(sums or {})
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = [F.col(p).asc() for p in part] + list(order)
    placed = cut_lineage(
        df.select("*", *[v.alias(f"_v_{a}") for a, v in sums.items()])
        .repartitionByRange(slots, *bounds)
        .withColumn("_slot", F.spark_partition_id())
    )
    inside = Window.partitionBy(*part, "_slot").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = placed.select(
        *df.columns, "_slot", F.row_number().over(inside).alias("_n"),
        *[F.sum(f"_v_{a}").over(upto).alias(f"_s_{a}") for a in sums],
    )
    # One row per (part, slot): at most slots + number of parts rows.
    sizes = placed.groupBy(*part, "_slot").agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(f"_v_{a}").alias(f"_t_{a}") for a in sums]
    )
    by_part = Window.partitionBy(*part) if part else Window.partitionBy(F.lit(0))
    before = by_part.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(p).alias(f"_p{i}") for i, p in enumerate(part)], F.col("_slot").alias("_at"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(by_part).alias("_all"),
        *[F.coalesce(F.sum(f"_t_{a}").over(before), F.lit(0)).alias(f"_b_{a}") for a in sums],
    )
    on = F.col("_slot") == F.col("_at")
    for i, p in enumerate(part):
        on = on & F.col(p).eqNullSafe(F.col(f"_p{i}"))
    return local.join(shifts, on).select(
        *df.columns,
        (F.col("_n") + F.col("_before")).cast("bigint").alias(rank),
        *[(F.coalesce(F.col(f"_s_{a}"), F.lit(0)) + F.col(f"_b_{a}")).alias(a) for a in sums],
        *([F.col("_all").cast("bigint").alias(total)] if total else []),
    )
