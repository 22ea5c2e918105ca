"""Line deduplication that returns compressed keep bitmaps per document, not text.

Line keys are hashed, range-partitioned by (hash, document) and sorted inside each partition, so a line that
a third of all documents hold spreads over many tasks. Each task streams over its rows; what a key has before
and behind a task is known from the first and last key of every task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import fold_case

NO_ID = -(1 << 63)


def _ident(key: str) -> Column:
    return F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_k")


def line_rows(df: DataFrame, key: str, text: str, min_length: int) -> DataFrame:
    """_h1, _h2 (128 bits of the line's key), _k, _r (hash of the text), _pos, _n (lines of the text)."""
    lines = df.select(_ident(key), F.xxhash64(text).alias("_r"), F.split(F.coalesce(text, F.lit("")), "\n").alias("_l"))
    line = lines.select("_k", "_r", F.size("_l").alias("_n"), F.posexplode("_l").alias("_pos", "_line"))
    keyed = line.select("_k", "_r", "_n", "_pos", fold_case(F.btrim("_line", F.lit(" \t\n\x0b\f\r"))).alias("_key")).where(F.length("_key") >= min_length)
    return keyed.select(F.xxhash64("_key").alias("_h1"), F.xxhash64(F.lit(1), "_key").alias("_h2"), "_k", "_r", "_pos", "_n")


def _columns(batch: pa.RecordBatch, names: tuple[str, ...]) -> list[np.ndarray]:
    return [batch.column(n).to_numpy() for n in names]


def _edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of one task: its first and its last key, each with the number of documents it has there."""
    runs: list[list[int]] = []  # h1, h2, documents; only the first and the current one are kept
    slot, last = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        slot = batch.column("_slot")[0].as_py()
        h1, h2, k = _columns(batch, ("_h1", "_h2", "_k"))
        new_key = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
        new_doc = new_key | np.append(True, k[1:] != k[:-1])
        starts = np.flatnonzero(new_key)
        docs = np.add.reduceat(new_doc.astype(np.int64), starts)
        for i in sorted({0, len(starts) - 1}):
            at = starts[i]
            if runs and runs[-1][:2] == [h1[at], h2[at]]:
                runs[-1][2] += int(docs[i]) - (last == (h1[at], h2[at], k[at]))
            else:
                runs = [*runs[:1], [h1[at], h2[at], int(docs[i])]]
        last = (h1[-1], h2[-1], k[-1])
    if runs:
        table = np.array(runs, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([slot] * len(runs), pa.int32()), *(pa.array(table[:, i]) for i in range(3))], ["_slot", "_h1", "_h2", "_docs"])


def _around(edges: list[tuple[int, int, int, int]]) -> dict[int, tuple[int, int]]:
    """Per task: documents before it that hold its first key, documents behind it that hold its last key."""
    edges = sorted(edges, key=lambda e: e[0])
    by_key: dict[tuple[int, int], list[tuple[int, int]]] = {}
    first, last = {}, {}
    for slot, h1, h2, docs in edges:
        by_key.setdefault((h1, h2), []).append((slot, docs))
    for slot, h1, h2, _ in edges:
        first.setdefault(slot, (h1, h2))
    for slot, h1, h2, _ in edges:
        last[slot] = (h1, h2)  # rows of a task come in order, so the later one stays
    before: dict[int, int] = {}
    behind: dict[int, int] = {}
    for key, held in by_key.items():
        total, seen = sum(n for _, n in held), 0
        for slot, n in held:
            if first[slot] == key:
                before[slot] = seen
            seen += n
            if last[slot] == key:
                behind[slot] = total - seen
    return {slot: (before.get(slot, 0), behind.get(slot, 0)) for slot in first}


def dropped_lines(rows: DataFrame, min_documents: int, slots: int) -> DataFrame:
    """_k, _r, _pos, _n of the lines that go: of keys in enough documents, all but those of the largest id."""
    order = [F.col("_h1"), F.col("_h2"), F.col("_k").desc()]
    placed = cut_lineage(
        rows.repartitionByRange(slots, *order).sortWithinPartitions(*order, "_r", "_pos").withColumn("_slot", F.spark_partition_id())
    )
    found = placed.mapInArrow(_edges, "_slot int, _h1 long, _h2 long, _docs long").collect()  # two rows per task at most
    around = placed.sparkSession.sparkContext.broadcast(_around([tuple(r) for r in found]))

    def stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("_h1", "_h2", "_k", "_r", "_pos", "_n")
        held = None  # undecided rows of the open key: of its first documents only
        key, docs, doc = None, 0, None  # the open key, its documents so far, the last of them
        before = behind = 0

        def decide(rows: list[np.ndarray], index: np.ndarray, enough: np.ndarray) -> pa.RecordBatch:
            go = (index > 0) & enough
            return pa.RecordBatch.from_arrays([pa.array(c[go]) for c in rows[2:]], list(names[2:]))

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = _columns(batch, names)
            if key is None:
                before, behind = around.value[batch.column("_slot")[0].as_py()]
            h1, h2, k = columns[:3]
            new_key = np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]))
            goes_on = key == (h1[0], h2[0])
            new_doc = new_key | np.append(True, k[1:] != k[:-1])
            if goes_on and doc == k[0]:
                new_doc[0] = False
            run = np.cumsum(new_key) - 1
            counted = np.cumsum(new_doc)
            base = np.where(new_key, counted - new_doc, 0)[np.flatnonzero(new_key)]
            start = np.zeros(run[-1] + 1, np.int64)
            start[0] = docs if goes_on else (before if key is None else 0)
            index = counted - base[run] - 1 + start[run]  # documents of the key before this one
            totals = np.zeros(run[-1] + 1, np.int64)
            np.maximum.at(totals, run, index + 1)
            if held is not None:
                enough = totals[0] >= min_documents if goes_on else False
                if enough:
                    yield decide(held[0], held[1], np.full(len(held[1]), True))
                    held = None
                elif not goes_on:
                    held = None
            open_run = run[-1]
            is_open = (run == open_run) & (totals[open_run] < min_documents)
            ready = ~is_open
            if ready.any():
                yield decide([c[ready] for c in columns], index[ready], totals[run[ready]] >= min_documents)
            if is_open.any():
                rest = [c[is_open] for c in columns]
                if held is not None:
                    held = ([np.append(a, b) for a, b in zip(held[0], rest, strict=True)], np.append(held[1], index[is_open]))
                else:
                    held = (rest, index[is_open])
            else:
                held = None
            key, docs, doc = (h1[-1], h2[-1]), int(totals[open_run]), k[-1]
        if held is not None:
            yield decide(held[0], held[1], np.full(len(held[1]), docs + behind >= min_documents))

    return placed.mapInArrow(stream, "_k long, _r long, _pos int, _n int")


def keep_bitmaps(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 20, min_documents: int = 3, slots: int | None = None
) -> DataFrame:
    """_k, _r, n_lines, n_dropped and keep_bits of the documents that lose lines; keep_bits is a zlib-compressed bitmap.

    Lines end at newlines. A line's key is the line without white space at its ends, A-Z in lower case. Keys of at
    least ``min_length`` code points in at least ``min_documents`` documents stay only in the largest id. A null
    or empty text is one empty line. Rows that repeat an id are one document; a null id counts as the smallest.
    """
    slots = slots or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gone = dropped_lines(line_rows(df, key, text, min_length), min_documents, slots)
    lists = gone.distinct().groupBy("_k", "_r").agg(F.max("_n").alias("n_lines"), F.collect_list("_pos").alias("_gone"))

    def bits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for n, gone in zip(batch.column("n_lines").to_pylist(), batch.column("_gone"), strict=True):
                keep = np.ones(n, np.uint8)
                keep[gone.values.to_numpy()] = 0
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            dropped = pa.compute.list_value_length(batch.column("_gone"))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], dropped, pa.array(maps, pa.binary())], ["_k", "_r", "n_lines", "n_dropped", "keep_bits"])

    return lists.mapInArrow(bits, "_k long, _r long, n_lines int, n_dropped int, keep_bits binary")


def apply_bitmaps(df: DataFrame, bitmaps: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_lines, n_dropped and kept_text of every row of ``df``."""
    found = bitmaps.select("_k", "_r", "n_dropped", "keep_bits")
    source = df.select(F.col(key).alias("_id"), _ident(key), F.xxhash64(text).alias("_r"), F.coalesce(text, F.lit("")).alias("_text"))
    joined = source.join(found, ["_k", "_r"], "left").select("_id", "_text", F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), "keep_bits")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts = [], []
            for t, b in zip(batch.column("_text"), batch.column("keep_bits"), strict=True):
                whole = t.as_py()
                lines = whole.split("\n")
                counts.append(len(lines))
                if b.is_valid:
                    keep = np.unpackbits(np.frombuffer(zlib.decompress(b.as_py()), np.uint8), count=len(lines))
                    whole = "\n".join([x for x, k in zip(lines, keep.tolist(), strict=True) if k])
                texts.append(whole)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(counts, pa.int64()), batch.column("n_dropped"), pa.array(texts, pa.string())], [key, "n_lines", "n_dropped", "kept_text"])

    kind = df.schema[key].dataType.simpleString()
    return joined.mapInArrow(cut, f"`{key}` {kind}, n_lines long, n_dropped long, kept_text string")
