"""Removal of passages that repeat across documents, with prefix-partitioned suffix trees.

A passage is a window of ``min_words`` words. Suffixes are dealt to groups by their prefixes:

1. Each window is represented by the suffix at its least hashed run of ``PREFIX`` words, so equal windows share it and
   only every fourth suffix is sent. Prefixes are counted; one that a single document holds has no internal node
   above its suffixes and is dropped.
2. What is left is sent to the group of its prefix with the words its windows need. A prefix with more than
   ``MOST_SUFFIXES`` suffixes is extended to the whole window, so that no group grows with a frequent phrase; copies
   within a task are sent once. Each group fits into memory and is one tree: its suffixes are sorted, neighbours
   compared, and a run that agrees in ``min_words`` words or more is a deep internal node. Below it lie all places of
   that window; all but the smallest document lose it.
3. Removed windows are brought to their documents. Those that overlap or adjoin are one maximal repeat.

Trees are built to the depth ``min_words``: a longer repeat is a run of such windows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, runs, slices

NO_ID = -(1 << 63)
PREFIX = 7
#: Prefixes of more suffixes are extended; at most MOST_EXTENDED of them, those that hold the largest shares.
MOST_SUFFIXES, MOST_EXTENDED = 1 << 14, 1 << 16
BATCH_BYTES = 4 << 20
LOW = (1 << 40) - 1
MIX = np.uint64(0x9E3779B97F4A7C15)


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed string, bytes of one weight beside each other."""
    head = np.array([len(a) for a in arrays], "<i8").tobytes()
    body = [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *body]))


def unpacked(data: bytes, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 8 * len(kinds), []
    for size, kind in zip(np.frombuffer(raw, "<i8", len(kinds)).tolist(), map(np.dtype, kinds), strict=True):
        block = np.frombuffer(raw, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(block.T).view(kind).reshape(size))
        at += size * kind.itemsize
    return out


class Words:
    """The words of a batch of texts, its windows and the suffix that represents each."""

    def __init__(self, texts: list[bytes | None], min_words: int):
        lists = [t.split() if t else [] for t in texts]  # of bytes: at space and the control characters tab to return
        self.words: list[bytes] = list(chain.from_iterable(lists))
        self.bounds = np.append(0, np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists))))
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.words), np.uint64, len(self.words))
        grams = max(len(codes) - PREFIX + 1, 0)
        weights = np.random.default_rng(13).integers(0, 1 << 62, PREFIX, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.hashes = np.zeros(grams, np.uint64)
        for i, weight in enumerate(weights):
            self.hashes += codes[i:i + grams] * weight
        for shift in (31, 29):
            self.hashes = (self.hashes ^ (self.hashes >> np.uint64(shift))) * MIX
        ends = np.repeat(self.bounds[1:], np.diff(self.bounds))
        position = np.arange(len(codes))
        self.starts = position[position + min_words <= ends]
        self.anchors = self.starts.copy()
        best = self.hashes[self.starts]
        for i in range(1, min_words - PREFIX + 1):
            other = self.hashes[self.starts + i]
            less = other < best
            best[less], self.anchors[less] = other[less], self.starts[less] + i

    def owner(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, side="right") - 1


def _cut(sorted_slots: np.ndarray, slots: int) -> np.ndarray:
    return np.searchsorted(sorted_slots, np.arange(slots + 1))


def _slot_of_id(ids: np.ndarray, slots: int) -> np.ndarray:
    return ((ids.astype(np.uint64) * MIX >> np.uint64(40)) % np.uint64(slots)).astype(np.int64)


def _rows(ids: np.ndarray, marks: np.ndarray, *values: np.ndarray, alone: int = 0) -> list[pa.Array]:
    """_k, _r and lists of each of the values: a row for each of the first ``alone`` entries, and one for each document of the others.

    The entries of a group of prefixes or of a tree have rows of their own, so that their number does not depend on
    how many groups there are.
    """
    order = np.append(np.arange(alone), alone + np.lexsort((values[0][alone:], marks[alone:], ids[alone:])))
    ids, marks = ids[order], marks[order]
    new = np.append(True, (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]))[:len(ids)]
    new[:alone + 1] = True
    first = np.flatnonzero(new)
    bounds = pa.array(np.append(first, len(ids)).astype(np.int32))
    return [pa.array(ids[first]), pa.array(marks[first].astype(np.int32)), *(pa.ListArray.from_arrays(bounds, pa.array(v[order].astype(np.int32))) for v in values)]


# -- counting of prefixes ------------------------------------------------------------------------------

PREFIX_KINDS = ("<u8", "<u4", "<u8", "<u4", "<u4", "<u4", "<u4", "<i8", "<i4")


def _prefix_blobs(source: DataFrame, min_words: int, slots: int) -> DataFrame:
    """_slot and _blob: the hashed prefixes of the suffixes that represent windows, to be counted by slot.

    A prefix that two documents of a batch share is sent once, with its count; its places go along as found.
    """

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", BATCH_BYTES):
            words = Words(batch.column("_text").to_pylist(), min_words)
            ids, marks = batch.column("_k").to_numpy(), batch.column("_r").to_numpy()
            at = words.anchors[np.append(True, words.anchors[1:] != words.anchors[:-1])[:len(words.anchors)]]
            if not len(at):
                continue
            hashes, owner = words.hashes[at], words.owner(at)
            order = np.lexsort((ids[owner], hashes))
            at, hashes, owner = at[order], hashes[order], owner[order]
            new = np.append(True, hashes[1:] != hashes[:-1])
            first, run = np.flatnonzero(new), np.cumsum(new) - 1
            last = np.append(first[1:], len(at)) - 1
            many = ids[owner[first]] != ids[owner[last]]
            slot = ((hashes >> np.uint64(40)) % np.uint64(slots)).astype(np.int64)
            low, place = hashes & np.uint64(LOW), at - words.bounds[owner]
            found = many[run]

            def by_slot(which: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                chosen = np.flatnonzero(which)
                chosen = chosen[np.lexsort((at[chosen], of[chosen]))]
                return chosen, _cut(of[chosen], slots)

            heads = first[many]
            heads = heads[np.argsort(slot[heads], kind="stable")]
            counts, head_cut = (last - first + 1)[run[heads]], _cut(slot[heads], slots)
            single, single_cut = by_slot(~found, slot)
            home = _slot_of_id(ids[owner], slots)
            done, done_cut = by_slot(found, home)
            out_slots, blobs = [], []
            for s in range(slots):
                h, one, two = slice(*head_cut[s:s + 2]), single[slice(*single_cut[s:s + 2])], done[slice(*done_cut[s:s + 2])]
                if h.start == h.stop and not len(one) and not len(two):
                    continue
                docs, index = np.unique(np.concatenate([owner[one], owner[two]]), return_inverse=True)
                arrays = (low[heads[h]], counts[h], low[one], index[:len(one)], place[one], index[len(one):], place[two], ids[docs], marks[docs])
                out_slots.append(s)
                blobs.append(packed(*(a.astype(k) for a, k in zip(arrays, PREFIX_KINDS, strict=True))))
            yield pa.RecordBatch.from_arrays([pa.array(out_slots, pa.int32()), pa.array(blobs, pa.binary())], ["_slot", "_blob"])

    return source.mapInArrow(emit, "_slot int, _blob binary")


def _repeated_prefixes(table: pa.Table) -> pa.RecordBatch:
    """_k, _r, _at: places whose prefix another document has; and _prefix, _n of prefixes with very many places."""
    slot = table.column("_slot")[0].as_py()
    blobs = [unpacked(b.as_py(), PREFIX_KINDS) for b in table.column("_blob")]
    shared, counts = (np.concatenate([b[i] for b in blobs]) for i in (0, 1))
    hashes, place = (np.concatenate([b[i] for b in blobs]) for i in (2, 4))
    ids, marks = (np.concatenate([b[i][b[3]] for b in blobs]) for i in (7, 8))
    order = np.lexsort((ids, hashes))
    hashes, place, ids, marks = hashes[order], place[order], ids[order], marks[order]
    new = np.append(True, hashes[1:] != hashes[:-1])[:len(hashes)]
    first, run = np.flatnonzero(new), np.cumsum(new) - 1
    last = np.append(first[1:], len(hashes))[:len(first)] - 1
    known, at = np.unique(shared, return_inverse=True)
    repeated = (ids[first] != ids[last]) | np.isin(hashes[first], known)
    total = np.zeros(len(known), np.int64)
    np.add.at(total, at, counts.astype(np.int64))
    mine = np.searchsorted(known, hashes[first])
    both = np.isin(hashes[first], known)
    total[mine[both]] += (last - first + 1)[both]
    alone = ~both & (last - first + 1 > MOST_SUFFIXES)
    hot = np.concatenate([known[total > MOST_SUFFIXES], hashes[first][alone]]).astype(np.int64) | slot << 40
    sizes = np.concatenate([total[total > MOST_SUFFIXES], (last - first + 1)[alone]])
    keep = repeated[run] if len(run) else np.zeros(0, bool)
    columns = _rows(
        np.concatenate([ids[keep], *(b[7][b[5]] for b in blobs)]), np.concatenate([marks[keep], *(b[8][b[5]] for b in blobs)]),
        np.concatenate([place[keep], *(b[6] for b in blobs)]), alone=int(keep.sum()),
    )
    rows = len(columns[0])
    pad = [pa.nulls(rows, pa.int64())] * 2
    tail = [pa.nulls(len(hot), a.type) for a in columns] + [pa.array(hot), pa.array(sizes)]
    return pa.RecordBatch.from_arrays([pa.concat_arrays([a, b]) for a, b in zip([*columns, *pad], tail, strict=True)], ["_k", "_r", "_at", "_prefix", "_n"])


# -- trees ---------------------------------------------------------------------------------------------

FRAGMENT_KINDS = ("<u4", "<u4", "<u4", "<u4", "<u4", "<u4", "<i8", "<i4")


def _fragment_blobs(joined: DataFrame, extended: set[int], prefix_slots: int, min_words: int, slots: int) -> DataFrame:
    """_slot, _text and _blob: the words of suffixes by group, and where they stand.

    A fragment is the words of all windows that one suffix represents, or of one window where its prefix is extended. Of
    equal fragments of a batch only those of the smallest document are sent; the others are already removed.
    """
    hot = joined.sparkSession.sparkContext.broadcast(np.array(sorted(extended), np.int64))

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", BATCH_BYTES):
            words = Words(batch.column("_text").to_pylist(), min_words)
            ids, marks = batch.column("_k").to_numpy(), batch.column("_r").to_numpy()
            lists = batch.column("_at")
            row = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(lists).to_numpy())
            at = lists.flatten().to_numpy() + words.bounds[row]
            wanted = np.zeros(len(words.words) + 1, bool)
            wanted[at[at < words.bounds[row + 1]]] = True
            chosen = wanted[words.anchors]
            starts, anchors = words.starts[chosen], words.anchors[chosen]
            hashes = words.hashes[anchors]
            prefix = (hashes & np.uint64(LOW)).astype(np.int64) | ((hashes >> np.uint64(40)) % np.uint64(prefix_slots)).astype(np.int64) << 40
            single = np.isin(prefix, hot.value)
            new = np.append(True, (anchors[1:] != anchors[:-1]) | single[1:])[:len(anchors)]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(starts))[:len(first)] - 1
            owner = words.owner(starts[first])
            place = (starts[first] - words.bounds[owner]).tolist()
            windows = (starts[last] - starts[first] + 1).tolist()
            home = (hashes[first] >> np.uint64(20)) % np.uint64(slots)
            keys = ids[owner]
            best: dict[bytes, list[int]] = {}  # the fragments of the smallest document that has the text
            gone: list[int] = []
            all_words, span = words.words, starts[first].tolist()
            for i, (s, n, key) in enumerate(zip(span, windows, keys.tolist(), strict=True)):
                text = b" ".join(all_words[s:s + n + min_words - 1])
                held = best.get(text)
                if held is None:
                    best[text] = [i]
                elif key == (known := keys[held[0]]):
                    held.append(i)
                elif key < known:
                    gone += held
                    best[text] = [i]
                else:
                    gone.append(i)
            texts, places = list(best), list(best.values())
            lead = np.fromiter((p[0] for p in places), np.int64, len(places))
            slot = home[lead].astype(np.int64)
            for i in np.flatnonzero(single[first[lead]]).tolist():
                slot[i] = xxhash.xxh3_64_intdigest(texts[i]) % slots
            order = np.argsort(slot, kind="stable")
            cuts = _cut(slot[order], slots)
            gone_at = np.array(gone, np.int64)
            gone_slot = _slot_of_id(keys[gone_at], slots)
            gone_at = gone_at[np.argsort(gone_slot, kind="stable")]
            gone_cuts = _cut(np.sort(gone_slot), slots)
            place_of, windows_of = np.array(place, np.int64), np.array(windows, np.int64)
            out: tuple[list, list, list] = ([], [], [])
            for s in range(slots):
                mine, lost = order[cuts[s]:cuts[s + 1]].tolist(), gone_at[gone_cuts[s]:gone_cuts[s + 1]]
                if not mine and not len(lost):
                    continue
                refs = np.array([x for i in mine for x in places[i]], np.int64)
                text_of = np.repeat(np.arange(len(mine)), [len(places[i]) for i in mine])
                docs, index = np.unique(np.concatenate([owner[refs], owner[lost]]), return_inverse=True)
                arrays = (text_of, index[:len(refs)], place_of[refs], index[len(refs):], place_of[lost], windows_of[lost], ids[docs], marks[docs])
                blob = packed(*(a.astype(k) for a, k in zip(arrays, FRAGMENT_KINDS, strict=True)))
                body = zstandard.ZstdCompressor(level=3).compress(b"\n".join([texts[i] for i in mine]))
                for column, value in zip(out, (s, body, blob), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(c, pa.binary()) for c in out[1:])], ["_slot", "_text", "_blob"])

    return joined.mapInArrow(emit, "_slot int, _text binary, _blob binary")


def deep_nodes(ids: np.ndarray, starts: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The tree of the suffixes at ``starts`` down to ``min_words``: their order, and where in it each deep node begins.

    Suffixes are sorted by their words; neighbours that agree in fewer words than that part two nodes.
    """
    bits = max(int(ids.max(initial=0)).bit_length(), 1)
    each = 62 // bits  # words to a column
    columns = []
    for at in range(0, min_words, each):
        column = np.zeros(len(starts), np.int64)
        for i in range(at, min(at + each, min_words)):
            column = column << bits | ids[starts + i]
        columns.append(column)
    order = np.lexsort(columns[::-1])
    parts = np.zeros(max(len(starts) - 1, 0), bool)
    for column in columns:
        line = column[order]
        parts |= line[1:] != line[:-1]
    return order, np.flatnonzero(np.append(True, parts)[:len(starts)])


def _removed(table: pa.Table, min_words: int) -> pa.RecordBatch | None:
    """Of one group: _k, _r, _from, _windows of the windows that a smaller document has too."""
    blobs = [unpacked(b.as_py(), FRAGMENT_KINDS) for b in table.column("_blob")]
    bodies = [zstandard.ZstdDecompressor().decompress(t.as_py()) for t in table.column("_text")]
    texts = [b.split(b"\n") if b else [] for b in bodies]
    base = np.append(0, np.cumsum([len(t) for t in texts]))
    fragments = list(chain.from_iterable(texts))
    sizes = np.fromiter((f.count(b" ") + 1 for f in fragments), np.int64, len(fragments))
    offset = np.cumsum(sizes) - sizes
    words = b" ".join(fragments).split(b" ") if fragments else []
    numbers = {w: i for i, w in enumerate(set(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    windows = sizes - min_words + 1
    fragment = np.repeat(np.arange(len(fragments)), windows)
    inner = np.arange(len(fragment)) - np.repeat(np.cumsum(windows) - windows, windows)
    order, nodes = deep_nodes(ids, offset[fragment] + inner, min_words)

    text_of = np.concatenate([b[0].astype(np.int64) + s for b, s in zip(blobs, base.tolist(), strict=False)])
    key, mark = (np.concatenate([b[i][b[1]] for b in blobs]) for i in (6, 7))
    place = np.concatenate([b[2] for b in blobs]).astype(np.int64)
    smallest = np.zeros(len(fragments), np.int64)
    smallest[text_of] = key  # all places of a fragment are in one document
    lost = np.zeros(len(fragment), bool)
    if len(nodes):
        least = np.minimum.reduceat(smallest[fragment[order]], nodes)
        lost[order] = smallest[fragment[order]] > np.repeat(least, np.diff(np.append(nodes, len(order))))
    # Runs of lost windows within a fragment.
    goes_on = np.zeros(len(lost) + 1, bool)
    goes_on[1:-1] = lost[1:] & lost[:-1] & (inner[1:] > 0)
    begins, stops = np.flatnonzero(lost & ~goes_on[:-1]), np.flatnonzero(lost & ~goes_on[1:])
    run_of = fragment[begins]
    # Each place of the fragment has the same runs.
    by_text = np.argsort(text_of, kind="stable")
    low, high = (np.searchsorted(text_of[by_text], run_of, side=s) for s in ("left", "right"))
    times = high - low
    run = np.repeat(np.arange(len(run_of)), times)
    ref = by_text[low[run] + np.arange(len(run)) - np.repeat(np.cumsum(times) - times, times)]
    columns = _rows(
        np.concatenate([key[ref], *(b[6][b[3]] for b in blobs)]), np.concatenate([mark[ref], *(b[7][b[3]] for b in blobs)]),
        np.concatenate([place[ref] + inner[begins][run], *(b[4] for b in blobs)]), np.concatenate([(stops - begins + 1)[run], *(b[5] for b in blobs)]),
        alone=len(ref),
    )
    return pa.RecordBatch.from_arrays(columns, ["_k", "_r", "_from", "_windows"]) if len(columns[0]) else None


def drop_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = 13) -> DataFrame:
    """key, n_words, n_removed, kept_text and span_starts, span_words of every row of ``df``.

    Words are cut at the space and the control characters tab to carriage return. A window of ``min_words`` words
    goes from every document if a smaller id has it too; the words left are joined by one space. Spans are the
    maximal runs of removed words, by the number of their first word. Windows are judged on the texts as given. A
    null text has no words, a short one no windows. Rows that repeat an id are one document; a null id counts as the smallest.
    An empty table gives no rows. ``min_words`` is at least PREFIX; ids are integers. Other columns are not read.

    A task holds a few MB of text (or one document) or one group. The texts are shuffled once, by document.
    """
    if min_words < PREFIX:
        raise ValueError(f"a repeat has at least {PREFIX} words")
    spark = df.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = 4 * slots
    body = F.col(text).cast("binary")
    source = df.select(F.col(key).alias("_id"), F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("_k"), F.hash(text).alias("_r"), body.alias("_text"))
    blobs = _prefix_blobs(source.select("_k", "_r", "_text"), min_words, slots)
    found = Scratch(spark).write(runs(blobs, ["_slot"], _repeated_prefixes, "_k long, _r int, _at array<int>, _prefix long, _n long"), compression="zstd")
    many = found.where("_prefix IS NOT NULL")
    total = many.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    extended = {r["_prefix"] for r in many.where(F.col("_n") * MOST_EXTENDED >= total).select("_prefix").collect()}  # MOST_EXTENDED at most

    placed = source.repartition("_k", "_r")
    # A document's places, of which there are fewer than words.
    places = found.where("_k IS NOT NULL").groupBy("_k", "_r").agg(F.flatten(F.collect_list("_at")).alias("_at"))
    fragments = _fragment_blobs(placed.join(places, ["_k", "_r"]).select("_id", "_k", "_r", "_text", "_at"), extended, slots, min_words, groups)
    lost = runs(fragments, ["_slot"], lambda t: _removed(t, min_words), "_k long, _r int, _from array<int>, _windows array<int>")
    lost = lost.groupBy("_k", "_r").agg(F.flatten(F.collect_list("_from")).alias("_from"), F.flatten(F.collect_list("_windows")).alias("_windows"))

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_text", BATCH_BYTES):
            counts, gone, texts, starts, lengths = [], [], [], [], []
            for t, begin, windows in zip(batch.column("_text"), batch.column("_from"), batch.column("_windows"), strict=True):
                words = t.as_py().split() if t.is_valid else []
                first, size = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if begin.is_valid:
                    edge = np.zeros(len(words) + 1, np.int64)
                    at = begin.values.to_numpy()
                    np.add.at(edge, at, 1)
                    np.add.at(edge, at + windows.values.to_numpy() + min_words - 1, -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    turns = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
                    first, size = turns[::2], turns[1::2] - turns[::2]
                    words_left = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                else:
                    words_left = words
                counts.append(len(words))
                gone.append(len(words) - len(words_left))
                texts.append(b" ".join(words_left).decode())
                starts.append(first.astype(np.int32))
                lengths.append(size.astype(np.int32))
            lists = pa.list_(pa.int32())
            columns = [pa.array(counts, pa.int64()), pa.array(gone, pa.int64()), pa.array(texts, pa.string()), pa.array(starts, lists), pa.array(lengths, lists)]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *columns], [key, "n_words", "n_removed", "kept_text", "span_starts", "span_words"])

    kind = df.schema[key].dataType.simpleString()
    joined = placed.join(lost, ["_k", "_r"], "left").select("_id", "_text", "_from", "_windows")
    return joined.mapInArrow(cut, f"`{key}` {kind}, n_words long, n_removed long, kept_text string, span_starts array<int>, span_words array<int>")
