"""Approximate nearest neighbours by adaptive dimension scans of inverted lists.

Vectors are rotated at random and dealt to the list of their nearest centroid. A query probes its nearest
lists; within a list, distances grow by blocks of dimensions, and after each block a hypothesis test on the
partial distance abandons candidates that can hardly be among the nearest. Lists and the queries that probe
them are split into blocks of bounded size, so a list that holds a third of all rows is many tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import hash_sample, runs

STEP = 16  # dimensions of a block
SURE = 2.1  # how many deviations a partial distance must lie beyond the bound
LIST_ROWS, QUERY_ROWS = 2048, 512
SAMPLE_ROWS, SAMPLE_BYTES, SAMPLE_QUERIES = 20_000, 64 << 20, 256
MOST_LISTS = 1024


@dataclass
class Index:
    """What every task needs: bounded by the sample, not by the corpus."""

    rotation: np.ndarray
    centroids: np.ndarray  # rotated
    probes: int

    def lists(self, vectors: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` nearest lists of each vector, nearest first."""
        turned = vectors @ self.rotation
        far = (self.centroids ** 2).sum(1) - 2 * turned @ self.centroids.T
        if count == 1:
            return far.argmin(1)[:, None]
        return np.argsort(far, axis=1, kind="stable")[:, :count]


def usable(vector: Column, size: int) -> Column:
    """Vectors of the given length, not zero, with finite components only."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, size)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a ** 2).sum(1)[:, None] + (b ** 2).sum(1) - 2 * a @ b.T, 0)


def build(vectors: np.ndarray, lists: int, k: int, recall: float, seed: int = 3) -> Index:
    """Centroids from a sample, and the number of probes that finds ``recall`` of the sample's own neighbours.

    The whole table is denser than its sample, so its neighbours are nearer and probes found here are on the safe side.
    """
    rng = np.random.default_rng(seed)
    size = vectors.shape[1]
    rotation = np.linalg.qr(rng.normal(size=(size, size)))[0]
    turned = vectors @ rotation
    lists = max(1, min(lists, len(turned)))
    centroids = turned[rng.choice(len(turned), lists, replace=False)].copy()
    near = np.zeros(len(turned), np.int64)
    for _ in range(6):
        for at in range(0, len(turned), 4096):
            near[at:at + 4096] = ((centroids ** 2).sum(1) - 2 * turned[at:at + 4096] @ centroids.T).argmin(1)
        count = np.bincount(near, minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, turned)
        held = count > 0
        centroids[held] = sums[held] / count[held, None]
    index = Index(rotation, centroids, lists)
    near = np.concatenate([index.lists(vectors[at:at + 4096], 1)[:, 0] for at in range(0, len(vectors), 4096)])
    queries = rng.choice(len(vectors), min(SAMPLE_QUERIES, len(vectors)), replace=False)
    order = index.lists(vectors[queries], lists)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None, :].repeat(len(queries), 0), 1)
    worst: list[int] = []
    for i, q in enumerate(queries):
        far = _squares(vectors[q:q + 1], vectors)[0]
        far[q] = np.inf
        found = np.argsort(far, kind="stable")[:min(k, len(vectors) - 1)]
        worst += place[i, near[found]].tolist()
    if worst:
        index.probes = int(np.quantile(worst, recall, method="higher")) + 1
    return index


def scan(query: np.ndarray, turned_query: np.ndarray, rows: np.ndarray, turned: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` nearest rows but the query's own: ids and exact distances. Rows are abandoned by blocks of dimensions."""
    size, first = turned.shape[1], min(len(turned), max(4 * k, 128))
    bound = np.inf
    kept = []
    for start, stop in ((0, first), (first, len(turned))):
        at = np.arange(start, stop)
        part = np.zeros(len(at))
        for d in range(0, size, STEP):
            if not len(at):
                break
            e = min(d + STEP, size)
            block = turned[at, d:e] - turned_query[d:e]
            part = part + np.einsum("ij,ij->i", block, block)
            if e < size and np.isfinite(bound):
                live = part * (size / e) <= bound * (1 + SURE / np.sqrt(e)) ** 2
                at, part = at[live], part[live]
        live = (part <= bound * (1 + 1e-9)) & (ids[at] != own)
        at, part = at[live], part[live]
        kept.append(at)
        if len(at) >= k:
            bound = np.partition(part, k - 1)[k - 1]
    at = np.concatenate(kept)
    exact = np.sqrt(((rows[at] - query) ** 2).sum(1))
    best = np.lexsort((ids[at], exact))[:k]
    return ids[at][best], exact[best]


def nearest(
    df: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", recall: float = 0.98, lists: int | None = None
) -> DataFrame:
    """query_id, rank, ``key`` and score (Euclidean distance) of the ``k`` nearest found for each query vector.

    Ties go to the smaller id; only fewer candidates than ``k`` give fewer rows. Other columns are not read. Rows whose vector is null, zero, holds a null or
    non-finite component, or has another length than most, take no part, nor do rows without an id. A row
    repeated whole counts once. Of identical vectors only the ``k`` + 1 smallest ids can be results, so no more are
    indexed. Centroids and the number of probes come from at most about SAMPLE_ROWS vectors and SAMPLE_BYTES.
    """
    spark = df.sparkSession
    empty = spark.createDataFrame([], f"query_id long, rank int, `{key}` long, score double")
    lengths = df.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).groupBy(F.size(vector).alias("n")).count()
    most = lengths.orderBy(F.desc("count"), "n").limit(1).collect()
    if not most or not most[0]["n"]:
        return empty
    size, total = most[0]["n"], most[0]["count"]
    clean = df.where(F.col(key).isNotNull() & usable(F.col(vector), size)).select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    copies = Window.partitionBy("_v").orderBy("_id")
    candidates = clean.distinct().withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k + 1).drop("_copy")
    sample = hash_sample(clean, "_id", max(256, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))).toArrow()
    points = np.unique(_matrix(sample.column("_v").combine_chunks(), size), axis=0) if sample.num_rows else np.zeros((0, size))
    if not len(points):
        return empty
    index = spark.sparkContext.broadcast(build(points, lists or min(MOST_LISTS, max(1, int(np.sqrt(total)))), k, recall))

    def dealt(sizes: np.ndarray | None):
        """Members join their nearest list; queries, for which the lists' sizes are given, as many as they probe."""

        def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    v = _matrix(part.column("_v"), size)
                    if sizes is None:
                        near, count = index.value.lists(v, 1), np.ones(len(v), np.int64)
                    else:
                        near = index.value.lists(v, len(sizes))
                        # On past the usual probes until the lists hold ``k`` rows beside the query's own.
                        enough = (np.cumsum(sizes[near], axis=1) > k).argmax(axis=1) + 1
                        enough[sizes.sum() <= k] = len(sizes)
                        count = np.maximum(enough, min(index.value.probes, len(sizes)))
                    rows = pa.array(np.repeat(np.arange(len(near)), count))
                    lists = near[np.arange(near.shape[1])[None, :] < count[:, None]]
                    yield pa.RecordBatch.from_arrays([pa.array(lists.astype(np.int32)), part.column("_id").take(rows), part.column("_v").take(rows)], ["_list", "_id", "_v"])

        return deal

    dealt_schema = "_list int, _id long, _v array<double>"
    members = cut_lineage(candidates.mapInArrow(dealt(None), dealt_schema))
    # One number per list: MOST_LISTS rows at most.
    rows_of = {r["_list"]: r["count"] for r in members.groupBy("_list").count().collect()}
    held = np.zeros(len(index.value.centroids), np.int64)
    held[list(rows_of)] = list(rows_of.values())
    asked = queries.where(F.col(key).isNotNull() & usable(F.col(vector), size)).select(F.col(key).cast("long").alias("_id"), F.col(vector).cast("array<double>").alias("_v")).distinct()
    probing = cut_lineage(asked.mapInArrow(dealt(held), dealt_schema))
    asks_of = {r["_list"]: r["count"] for r in probing.groupBy("_list").count().collect()}
    parts = spark.createDataFrame(
        [(x, -(-n // LIST_ROWS), -(-asks_of[x] // QUERY_ROWS)) for x, n in rows_of.items() if x in asks_of], "_list int, _row_parts int, _ask_parts int"
    )
    spot = F.pmod(F.xxhash64("_id"), F.lit(1 << 30)).cast("int")
    left = members.join(F.broadcast(parts), "_list").select(
        "_list", (spot % F.col("_row_parts")).alias("_row_part"), F.explode(F.sequence(F.lit(0), F.col("_ask_parts") - 1)).alias("_ask_part"), F.lit(False).alias("_asks"), "_id", "_v"
    )
    right = probing.join(F.broadcast(parts), "_list").select(
        "_list", F.explode(F.sequence(F.lit(0), F.col("_row_parts") - 1)).alias("_row_part"), (spot % F.col("_ask_parts")).alias("_ask_part"), F.lit(True).alias("_asks"), "_id", "_v"
    )

    def search(block: pa.Table) -> pa.RecordBatch | None:
        asks = block.column("_asks").to_numpy()
        if asks.all() or not asks.any():
            return None
        ids, v = block.column("_id").to_numpy(), _matrix(block.column("_v").combine_chunks(), size)
        turned = v @ index.value.rotation
        rows, rows_turned, row_ids = v[~asks], turned[~asks], ids[~asks]
        out = []
        for i in np.flatnonzero(asks):
            found, far = scan(v[i], turned[i], rows, rows_turned, row_ids, int(ids[i]), k)
            out.append((np.full(len(found), ids[i]), found, far))
        query, found, far = (np.concatenate(x) for x in zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(found), pa.array(far)], ["query_id", key, "score"])

    near = runs(left.unionByName(right), ["_list", "_row_part", "_ask_part"], search, f"query_id long, `{key}` long, score double")
    order = Window.partitionBy("query_id").orderBy("score", key)
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), key, "score")
