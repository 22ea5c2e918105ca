"""Shared helpers: bounded samples, and streaming over sorted runs of a key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: The white space of all contracts: a space and the control characters tab to carriage return.
SPACE = r"[\x20\x09-\x0D]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def fold_case(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, LOWER)


def hash_share(key: Column, share: Column | float, seed: int = 7) -> Column:
    """True for about ``share`` of the rows, chosen by a hash of ``key`` and so the same in every run."""
    steps = 1 << 20
    share = F.lit(share) if isinstance(share, float) else share
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(steps)) < F.ceil(share * steps)


def hash_sample(df: DataFrame, key: str, limit: int, seed: int = 7) -> DataFrame:
    """At most about ``limit`` rows, chosen by hash; the limit at twice that guards against repeated keys."""
    rows = df.count()
    if rows <= limit:
        return df
    return df.where(hash_share(F.col(key), limit / rows, seed)).limit(2 * limit)


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` (text or binary) holds about ``most_bytes``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // most_bytes
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(start, stop - start)


def runs(
    df: DataFrame, keys: Sequence[str], fn: Callable[[pa.Table], pa.RecordBatch | None], schema: str,
    order: Sequence[Column] = (),
) -> DataFrame:
    """Apply ``fn`` to the rows of each key, which must be few: a key's rows meet in one call.

    The rows are shuffled and sorted by Spark; a task streams over them and holds one Arrow batch and one
    key at a time, without the cost of a separate batch for each key.
    """

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, held = None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k) for k in keys]
            change = np.zeros(batch.num_rows - 1, bool)
            for column in columns:
                change |= pa.compute.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(change) + 1), batch.num_rows]
            for start, stop in zip(cuts, cuts[1:], strict=False):
                key = tuple(c[start].as_py() for c in columns)
                if held and key != open_key:
                    out = fn(pa.Table.from_batches(held))
                    if out is not None:
                        yield out
                    held = []
                open_key = key
                held.append(batch.slice(start, stop - start))
        if held:
            out = fn(pa.Table.from_batches(held))
            if out is not None:
                yield out

    placed = df.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys, *order)
    return placed.mapInArrow(stream, schema)


def keys_repeat(df: DataFrame, key: str) -> bool:
    """Whether any key other than null is in more than one row."""
    return not df.where(F.col(key).isNotNull()).groupBy(F.col(key)).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").isEmpty()


class Scratch:
    """Tables written to the shared folder, so that lost executors lose nothing and plans stay short.

    Iterations read them back as plain scans: their plans do not carry what earlier rounds derived.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.root, self.count = spark, f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}", 0

    def write(self, df: DataFrame, **options: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete all tables written; what still reads them must be written elsewhere."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
