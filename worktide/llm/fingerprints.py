"""Exact deduplication by composable polynomial fingerprints.

A text is a polynomial in its UTF-8 bytes modulo four primes. Chunks are hashed on their own, shifted by
the number of bytes behind them, and added up, so a huge document is hashed in parallel and never as one
piece. Texts with equal fingerprints are compared chunk by chunk before they count as equal.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import SPACE, keys_repeat

#: Primes below 2^31 and a base for each; together a fingerprint of about 124 bits.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (1103515245, 1664525013, 1220703125, 1812433253)
CHUNK_BYTES = 1 << 16
MARKS = [f"mark{i}" for i in range(len(PRIMES))]


def normalized(text: Column) -> Column:
    """Null counts as empty; each run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE + "+", " ")


def _chunks(data: Column, size: int) -> Column:
    """The binary ``data`` in pieces of ``size`` bytes; empty data has one empty piece."""
    last = F.greatest((F.octet_length(data) - 1).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), (last / size).cast("int")), lambda i: F.substring(data, i * size + 1, F.lit(size)))


class _Powers:
    """Powers of the bases, highest first, so that a chunk's hash is one product and sum."""

    def __init__(self, size: int):
        self.tables = []
        for p, b in zip(PRIMES, BASES, strict=True):
            powers = np.empty(size, np.uint64)
            x = 1
            for i in range(size):
                powers[size - 1 - i] = x
                x = x * b % p
            self.tables.append(powers)

    def hash(self, data: bytes, behind: int) -> list[int]:
        """The four hashes of ``data`` with ``behind`` more bytes to its right; a byte counts as its value plus one."""
        x = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
        out = []
        for p, b, t in zip(PRIMES, BASES, self.tables, strict=True):
            out.append(int((x * t[len(t) - len(x):]).sum() % np.uint64(p)) * pow(b, behind, p) % p)
        return out


def fingerprints(df: DataFrame, key: str, text: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per ``key`` and text: key, n_bytes, text_sha256, mark0 to mark3. ``key`` is the document's id."""
    norm = df.select(F.col(key).alias("_k"), normalized(F.col(text)).alias("_t"))
    rows = norm.select("_k", F.monotonically_increasing_id().alias("_row"), F.sha2("_t", 256).alias("text_sha256"), F.encode("_t", "UTF-8").alias("_b"))
    parts = rows.select("_k", "_row", "text_sha256", F.octet_length("_b").cast("long").alias("n_bytes"), F.posexplode(_chunks(F.col("_b"), chunk_bytes)).alias("_i", "_c"))

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers(chunk_bytes)
        for batch in batches:
            behind = np.maximum(batch.column("n_bytes").to_numpy() - (batch.column("_i").to_numpy() + 1) * chunk_bytes, 0)
            marks = [powers.hash(c.as_buffer().to_pybytes(), n) for c, n in zip(batch.column("_c"), behind.tolist(), strict=True)]
            table = np.array(marks, np.int64).reshape(-1, len(PRIMES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(pa.array(table[:, i]) for i in range(len(PRIMES)))], [*batch.schema.names[:4], *MARKS])

    kind = df.schema[key].dataType.simpleString()
    schema = f"_k {kind}, _row long, text_sha256 string, n_bytes long, " + ", ".join(f"{m} long" for m in MARKS)
    # A document's chunks leave one task, so nearly all sums are complete before the shuffle.
    sums = parts.mapInArrow(hashed, schema).groupBy("_k", "_row", "text_sha256", "n_bytes").agg(*[(F.sum(m) % p).alias(m) for m, p in zip(MARKS, PRIMES, strict=True)])
    return sums.select(F.col("_k").alias(key), "n_bytes", "text_sha256", *MARKS)


def _differing(df: DataFrame, pairs: DataFrame, key: str, text: str, chunk_bytes: int) -> DataFrame:
    """The ids of ``pairs`` (id, keep_id) whose normalised text differs from that of keep_id.

    Chunks meet the chunks of the kept text by (keep_id, number); a large group is one hot key of a plain
    join, which adaptive execution splits, and only a truth value per document leaves it.
    """
    roles = pairs.select(F.col("_id").alias("_k"), F.col("_keep").alias("_group"), F.lit(False).alias("_first"))
    roles = roles.unionByName(pairs.select(F.col("_keep").alias("_k"), F.col("_keep").alias("_group"), F.lit(True).alias("_first")).distinct())
    texts = df.select(F.col(key).alias("_k"), F.encode(normalized(F.col(text)), "UTF-8").alias("_b")).join(roles, "_k")
    parts = texts.select("_k", "_group", "_first", F.posexplode(_chunks(F.col("_b"), chunk_bytes)).alias("_i", "_c"))
    own = parts.where("NOT _first").select("_k", "_group", "_i", "_c")
    kept = parts.where("_first").select("_group", "_i", F.col("_c").alias("_d"))
    same = own.join(kept, ["_group", "_i"], "left").select("_k", F.coalesce(F.col("_c") == F.col("_d"), F.lit(False)).alias("_same"))
    return same.groupBy("_k").agg(F.min("_same").alias("_same")).where("NOT _same").select("_k")


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: ``key``, keep_id, group_size, kept, text_sha256.

    Equal means identical after white space is normalised; null and empty texts are equal to each other.
    The smallest key of a group stays. Repeated rows of one key count in group_size and share its verdict;
    a null key is never kept in place of another, and forms its own group if nothing else equals it. Texts
    that differ despite equal fingerprints are grouped anew by their SHA-256.
    """
    marks = cut_lineage(fingerprints(df, key, text, chunk_bytes))
    same = ["n_bytes", *MARKS]
    # Where keys repeat, a key and its text's digest name what is compared, as one key can have several texts.
    repeat = keys_repeat(marks, key)
    name = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("_id"), F.col("text_sha256").alias("_digest"))) if repeat else F.col(key)
    marks = marks.withColumn("_name", name)
    groups = cut_lineage(marks.groupBy(*same).agg(F.min(key).alias("keep_id"), F.min("_name").alias("_first"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1"))
    grouped = cut_lineage(marks.join(groups, same, "left"))
    pairs = grouped.where(F.col("group_size").isNotNull() & (F.col("_name") != F.col("_first"))).select(F.col("_name").alias("_id"), F.col("_first").alias("_keep")).distinct()
    named = df.select(F.col(key), F.col(text), F.sha2(normalized(F.col(text)), 256).alias("text_sha256")).withColumn("_name", name) if repeat else df.select(F.col(key).alias("_name"), F.col(text))
    odd = cut_lineage(_differing(named, pairs, "_name", text, chunk_bytes))
    if odd.isEmpty():
        found = grouped
    else:
        split = grouped.join(odd.withColumnRenamed("_k", "_name").withColumn("_odd", F.lit(True)), "_name", "left").drop("keep_id", "group_size")
        split = split.withColumn("_class", F.when(F.col("_odd"), F.col("text_sha256")).otherwise(F.lit("")))
        again = cut_lineage(split.groupBy(*same, "_class").agg(F.min(key).alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
        found = split.join(again, [*same, "_class"], "left")
    keep = F.coalesce("keep_id", key)
    return found.select(
        key, keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col(key) == keep, F.lit(True)).alias("kept"), "text_sha256",
    )


def drop_copies(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, all columns; only the ids that go are joined.

    Where keys repeat, each row is decided by its key and text: another text of the same key stays, and of rows equal
    in both one does. Rows without a key all stay.
    """
    gone = exact_groups(df, key, text).where("NOT kept").select(F.col(key).alias("_gone"), F.col("text_sha256").alias("_gone_digest")).distinct()
    if not keys_repeat(df, key):
        return df.join(gone, df[key] == gone["_gone"], "left_anti")
    rows = df.where(F.col(key).isNotNull()).withColumn("_digest", F.sha2(normalized(F.col(text)), 256)).dropDuplicates([key, "_digest"])
    kept = rows.join(gone, (rows[key] == gone["_gone"]) & (rows["_digest"] == gone["_gone_digest"]), "left_anti")
    return kept.select(*df.columns).unionByName(df.where(F.col(key).isNull()))
