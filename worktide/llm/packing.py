"""Pattern packing of token sequences by non-negative least squares.

Only the histogram of lengths, which has at most ``capacity`` entries, is planned in one place. Few-document
patterns that fill a sequence exactly are fitted to it by non-negative least squares and rounded; what is
left is packed best-fit decreasing, on the histogram too. Spark ranks the pieces of each length, and a
piece's rank names its place in the plan.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import ordered_prefix
from ..session import cut_lineage
from .bpe import WordBpe
from .common import slices

END = 1
BATCH_BYTES = 4 << 20


def patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Sets of up to five lengths that occur and add up to ``capacity``, largest first."""
    have = np.flatnonzero(histogram)
    present, out = set(have.tolist()), set()

    def near(value: int) -> list[int]:
        at = int(np.searchsorted(have, value))
        return [int(x) for x in have[max(0, at - 1):at + 2] if x > 0]

    for length in have.tolist():
        rest = capacity - length
        if rest in present:
            out.add(tuple(sorted((length, rest), reverse=True)))
        for more in (2, 3, 4):
            for first in near(rest // more) if rest >= more else []:
                left = rest - first
                if more == 2:
                    tries = [(length, first, left)]
                elif more == 3:
                    tries = [(length, first, second, left - second) for second in near(left // 2)]
                else:
                    tries = [(length, first, first, second, left - first - second) for second in near((left - first) // 2)]
                out.update(tuple(sorted(t, reverse=True)) for t in tries if all(x in present for x in t))
    return sorted(out, reverse=True)


def fit(histogram: np.ndarray, shapes: list[tuple[int, ...]], sweeps: int = 40) -> np.ndarray:
    """How often to use each pattern: least squares against the histogram, none below zero, by coordinate descent."""
    rest = histogram.astype(float).tolist()
    columns = []
    for shape in shapes:
        uses: dict[int, int] = defaultdict(int)
        for x in shape:
            uses[x] += 1
        columns.append((list(uses.items()), sum(n * n for n in uses.values())))
    times = [0.0] * len(shapes)
    for _ in range(sweeps):
        moved = 0.0
        for j, (uses, square) in enumerate(columns):
            step = max(-times[j], sum(n * rest[x] for x, n in uses) / square)
            if step:
                times[j] += step
                moved = max(moved, abs(step))
                for x, n in uses:
                    rest[x] -= n * step
        if moved < 0.25:
            break
    return np.array(times)


@dataclass
class Plan:
    """Rank ``start`` to the next start of pieces of a length go to consecutive sequences at one offset."""

    keys: np.ndarray  # length << 40 | first rank
    sequence: np.ndarray  # of the first rank
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.keys, (length << 40) | rank, side="right") - 1
        return self.sequence[at] + rank - (self.keys[at] & ((1 << 40) - 1)), self.offset[at]


def _residual(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing: each length goes to the fullest sequences it fits, many alike at a time."""
    open_bins: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)  # by space left
    closed: list[tuple[tuple[int, ...], int]] = []
    spaces = np.zeros(capacity + 1, bool)
    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            fits = np.flatnonzero(spaces[length:])
            if not len(fits):
                # As many new sequences as are needed if each takes all copies it can hold.
                each = capacity // length
                full, some = divmod(todo, each)
                for copies, count in ((each, full), (some, 1 if some else 0)):
                    if count:
                        space = capacity - copies * length
                        open_bins[space].append(((length,) * copies, count))
                        spaces[space] = True
                break
            space = length + int(fits[0])
            content, count = open_bins[space].pop()
            each = min(space // length, todo)
            used = min(count, todo // each)
            if count > used:
                open_bins[space].append((content, count - used))
            if not open_bins[space]:
                spaces[space] = False
            rest = space - each * length
            open_bins[rest].append((content + (length,) * each, used))
            spaces[rest] = True
            todo -= used * each
    for bins in open_bins.values():
        closed += bins
    return closed


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Where the pieces of each length go. The fitted plan is kept only if it needs no more sequences than best fit alone."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    shapes = patterns(counts, capacity)
    left, fitted = counts.copy(), []
    for shape, times in zip(shapes, fit(counts, shapes), strict=True):
        uses = {x: shape.count(x) for x in shape}
        n = min(int(times), *(int(left[x]) // k for x, k in uses.items()))
        if n > 0:
            fitted.append((shape, n))
            for x, k in uses.items():
                left[x] -= n * k
    plans = [fitted + _residual(left, capacity), _residual(counts, capacity)]
    chosen = min(plans, key=lambda p: sum(n for _, n in p))
    taken: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for shape, n in chosen:
        offset = 0
        for length in shape:
            rows.append((length << 40 | taken[length], base, offset))
            taken[length] += n
            offset += length
        base += n
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return Plan(table[:, 0], table[:, 1], table[:, 2], base)


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 4096) -> DataFrame:
    """key, piece, start, length and ids_crc32 of the texts' ids with the end mark, cut only beyond ``capacity``.

    A task encodes a few MB of text at a time and returns no ids, only what is known of the pieces.
    """
    model = df.sparkSession.sparkContext.broadcast(WordBpe.load(path))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = model.value, np.array([END], "<u4")
        for batch in slices(batches, "_t", BATCH_BYTES):
            ids, ends = bpe.encode_batch(batch.column("_t").to_pylist())
            rows, ids = [], ids.astype("<u4")
            for at, (first, last) in enumerate(zip(ends.tolist(), ends[1:].tolist(), strict=False)):
                for i, start in enumerate(range(first, last + 1, capacity)):
                    part = ids[start:min(start + capacity, last)]
                    ends_here = start + capacity > last
                    crc = zlib.crc32(end, zlib.crc32(part)) if ends_here else zlib.crc32(part)
                    rows.append((at, i, start - first, len(part) + ends_here, crc))
            table = np.array(rows, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_k").take(pa.array(table[:, 0])), pa.array(table[:, 1].astype(np.int32)), *(pa.array(table[:, i]) for i in (2, 3, 4))],
                [key, "piece", "start", "length", "ids_crc32"],
            )

    kind = df.schema[key].dataType.simpleString()
    source = df.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    return source.mapInArrow(cut, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long")


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", capacity: int = 4096) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is its end mark alone, a very long one as many pieces as it needs. Repeated rows and null keys are
    packed like any others; other columns are not read, whatever their names. An empty table gives no rows. The pieces are written once, as their ranks and the plan must agree.
    """
    cut = cut_lineage(pieces(df, path, key, text, capacity))
    sizes = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    order = [F.col(key), F.col("piece"), F.col("ids_crc32")]
    ranked = ordered_prefix(cut, ["length"], order, rank="_rank")
    shared = df.sparkSession.sparkContext.broadcast(plan(sizes, capacity))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = shared.value.place(batch.column("length").to_numpy(), batch.column("_rank").to_numpy() - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields[:-1])
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")
