"""Alignment of two tokenizers' tokens by divide and conquer at shared cuts.

Both token sequences cover the same bytes. An interval of tokens is divided at a byte offset where both have a
token end, found near its middle by bisecting the other side's ends; the halves are divided in turn, and an
interval without such an offset is a group. All intervals of a batch of documents are divided together.

Corpus-wide link counts are summed before they are shuffled. The most frequent links, whose number is bounded by
their threshold, are looked up where the documents are; only the rest meet their counts in a join, and
none of those is frequent enough to make a hot key.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from .bpe import byte_symbols
from .common import Scratch, slices

#: Longer texts are encoded in parts that end before a single space between two letters or digits, where
#: both vocabularies begin a new word whatever stands before.
PART = 1 << 15
SAFE_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")
#: Fixed value: the word pattern of the byte-level vocabulary file.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BATCH_BYTES = 1 << 19
#: Ids of the second vocabulary take this many bits of a link's number.
B_BITS = 15
#: At most so many links are looked up by broadcast: those in at least 1 / FREQUENT of all (document, link) pairs.
FREQUENT = 1 << 17


def shared_cut_groups(
    a_ends: np.ndarray, b_ends: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of each group, in order, the numbers of the tokens behind its last ones on either side.

    Document i has the tokens from ``a_bounds[i]`` to ``a_bounds[i + 1]``, and likewise b. Ends are byte offsets that
    rise through the whole batch; a document's last ends on both sides agree.
    """
    has = a_bounds[1:] > a_bounds[:-1]
    low_a, high_a, low_b, high_b = a_bounds[:-1][has], a_bounds[1:][has], b_bounds[:-1][has], b_bounds[1:][has]
    tried = np.zeros(len(low_a), np.int64)
    leaves: list[tuple[np.ndarray, np.ndarray]] = []
    while len(low_a):
        inner = high_a - 1 - low_a  # ends inside the interval
        over = (tried >= inner) | (high_b - low_b <= 1)
        if over.any():
            leaves.append((high_a[over], high_b[over]))
            open_ = ~over
            low_a, high_a, low_b, high_b, tried, inner = (x[open_] for x in (low_a, high_a, low_b, high_b, tried, inner))
            if not len(low_a):
                break
        # The middle end first, then those beside it, further and further out.
        at = low_a + (inner - 1) // 2 + np.where(tried % 2 == 1, (tried + 1) // 2, -(tried // 2))
        other = np.searchsorted(b_ends, a_ends[at])
        cut = b_ends[other] == a_ends[at]
        tried = tried + 1
        left, right, kept = (at[cut] + 1, other[cut] + 1), (high_a[cut], high_b[cut]), ~cut
        low_a, high_a, low_b, high_b, tried = (
            np.concatenate(x) for x in (
                (low_a[kept], low_a[cut], left[0]), (high_a[kept], left[0], right[0]),
                (low_b[kept], low_b[cut], left[1]), (high_b[kept], left[1], right[1]),
                (tried[kept], np.zeros(2 * int(cut.sum()), np.int64)),
            )
        )
    if not leaves:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends_a, ends_b = (np.concatenate(x) for x in zip(*leaves, strict=True))
    order = np.argsort(ends_a, kind="stable")
    return ends_a[order], ends_b[order]


@dataclass
class Aligned:
    """A batch of documents: ids of both sides, where each document begins, and the ends of the groups."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_bounds: np.ndarray
    b_bounds: np.ndarray
    a_cuts: np.ndarray
    b_cuts: np.ndarray
    group_bounds: np.ndarray
    links: np.ndarray  # a << B_BITS | b of every pair of tokens that share bytes, by document
    link_bounds: np.ndarray


class Aligner:
    """Both vocabularies; a task loads them once from their files, which every executor has."""

    def __init__(self, a_path: str, b_path: str):
        self.a_path, self.b_path = a_path, b_path

    def __getstate__(self):
        return {"a_path": self.a_path, "b_path": self.b_path}

    @cached_property
    def _a(self) -> tiktoken.Encoding:
        """The encoder of the byte-level file: its merges are in the order of their ids, so ids serve as ranks."""
        ranks = {data: i for i, data in enumerate(self.a_bytes) if data}
        return tiktoken.Encoding("a", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def _b(self):
        return SentencePieceProcessor(model_file=self.b_path)

    @cached_property
    def a_bytes(self) -> list[bytes]:
        """The bytes of every id of the byte-level vocabulary."""
        value = {s: b for b, s in enumerate(byte_symbols())}
        with open(self.a_path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        made = [vocab[x + y] for x, y in merges]
        if made != sorted(made):
            raise ValueError(f"the merges of {self.a_path} are not in the order of their ids")
        out = [b""] * (1 + max(*vocab.values(), *(t["id"] for t in spec["added_tokens"])))
        for token, i in vocab.items():
            out[i] = bytes(value[c] for c in token)
        return out

    @cached_property
    def b_bytes(self) -> list[bytes]:
        """The bytes of every id of the piece vocabulary; none for control marks."""
        model, out = self._b, []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                out.append(bytes([int(piece[3:-1], 16)]))
            else:
                out.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace("▁", " ").encode())
        return out

    @cached_property
    def _sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.fromiter(map(len, t), np.int64, len(t)) for t in (self.a_bytes, self.b_bytes))

    @cached_property
    def _words(self) -> list[str]:
        """For the written form of groups: an id with each mark that can follow it."""
        a, b = [str(i) for i in range(len(self.a_bytes))], [str(i) for i in range(len(self.b_bytes))]
        return [x + "," for x in a] + [x + "|" for x in a] + [x + "," for x in b] + [x + ";" for x in b]

    @staticmethod
    def parts(text: str) -> list[str]:
        """The text in parts of about ``PART`` characters, cut where no token spans the cut."""
        out, start = [], 0
        while len(text) - start > 2 * PART and (cut := SAFE_CUT.search(text, start + PART)):
            out.append(text[start:cut.start()])
            start = cut.start()
        return [*out, text[start:]]

    def encode(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of a space and each text on both sides; none where the bytes of either side differ from that."""
        parts, owner = [], []
        for i, text in enumerate(texts):
            if text:
                found = self.parts(" " + text)
                parts += found
                owner += [i] * len(found)
        a = [self._a.encode_ordinary(p) for p in parts]
        b = self._b.encode([p[1:] for p in parts], num_threads=1) if parts else []
        out_a: list[list[int]] = [[] for _ in texts]
        out_b: list[list[int]] = [[] for _ in texts]
        differs = set()
        for i, part, x, y in zip(owner, parts, a, b, strict=True):
            data = part.encode()
            if b"".join(map(self.a_bytes.__getitem__, x)) != data or b"".join(map(self.b_bytes.__getitem__, y)) != data:
                differs.add(i)
            out_a[i] += x
            out_b[i] += y
        for i in differs:
            out_a[i], out_b[i] = [], []
        return out_a, out_b

    def align(self, texts: list[str | None]) -> Aligned:
        ids, bounds, ends = [], [], []
        for lists, sizes in zip(self.encode(texts), self._sizes, strict=True):
            bounds.append(np.append(0, np.cumsum(np.fromiter(map(len, lists), np.int64, len(lists)))))
            flat = np.fromiter(chain.from_iterable(lists), np.int64, int(bounds[-1][-1]))
            ids.append(flat)
            ends.append(np.cumsum(sizes[flat]))
        a_cuts, b_cuts = shared_cut_groups(*ends, *bounds)
        group_bounds = np.append(0, np.searchsorted(a_cuts, bounds[0][1:], side="right"))
        stops = np.sort(np.concatenate(ends), kind="stable")  # two rising runs are merged
        stops = stops[np.append(True, stops[1:] != stops[:-1])[:len(stops)]]  # between two neighbours lie the bytes that one pair of tokens shares
        links = ids[0][np.searchsorted(ends[0], stops)] << B_BITS | ids[1][np.searchsorted(ends[1], stops)]
        last = np.append(0, ends[0])[bounds[0][1:]]  # a document's last byte; that of the one before if it has none
        return Aligned(*ids, *bounds, a_cuts, b_cuts, group_bounds, links, np.append(0, np.searchsorted(stops, last, side="right")))

    def written(self, found: Aligned) -> list[str]:
        """Per document ``a1,a2|b1;a3|b2,b3``, the ids of each group."""
        a, b = found.a_ids.copy(), found.b_ids + 2 * len(self.a_bytes)
        a[found.a_cuts - 1] += len(self.a_bytes)
        b[found.b_cuts - 1] += len(self.b_bytes)
        before_a = np.append(0, found.b_cuts)[np.searchsorted(found.a_cuts, np.arange(len(a)), side="right")]
        before_b = found.a_cuts[np.searchsorted(found.b_cuts, np.arange(len(b)), side="right")]
        line = np.empty(len(a) + len(b), np.int64)
        line[np.arange(len(a)) + before_a] = a
        line[np.arange(len(b)) + before_b] = b
        words = list(map(self._words.__getitem__, line.tolist()))
        cuts = (found.a_bounds + found.b_bounds).tolist()
        return ["".join(words[x:y])[:-1] for x, y in zip(cuts, cuts[1:], strict=False)]


def align_column(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """One row per row of ``df``: key, n_a, n_b, n_groups, n_links, groups_sha256, link_ids, link_times and, with ``ids``, a_ids, b_ids, a_cuts, b_cuts.

    Group i holds the tokens before ``a_cuts[i]`` and ``b_cuts[i]`` that no earlier group holds. ``link_ids`` are the
    distinct links, ``a_id << 15 | b_id``, rising, and ``link_times`` how often each occurs. A text that is null or empty, or that
    one of the vocabularies does not give back byte for byte, has no tokens, and '' for a digest. Nothing is
    shuffled; a task holds half a MB of text, or one document if that is larger.
    """
    aligner = df.sparkSession.sparkContext.broadcast(Aligner(a_path, b_path))
    names = ["n_a", "n_b", "n_groups", "n_links"]

    def lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))

    def align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = aligner.value
        for batch in slices(batches, "_t", BATCH_BYTES):
            found = worker.align(batch.column("_t").to_pylist())
            counts = [np.diff(x) for x in (found.a_bounds, found.b_bounds, found.group_bounds, found.link_bounds)]
            digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in worker.written(found)]
            owner = np.repeat(np.arange(batch.num_rows), counts[3])
            distinct, times = np.unique(owner << 32 | found.links, return_counts=True)
            link_bounds = np.searchsorted(distinct, np.arange(batch.num_rows + 1) << 32)
            columns = [batch.column("_k"), *map(pa.array, counts), pa.array(digests), lists(distinct & 0xFFFFFFFF, link_bounds), lists(times, link_bounds)]
            if ids:
                first = [np.repeat(b[:-1], counts[2]) for b in (found.a_bounds, found.b_bounds)]
                columns += [lists(found.a_ids, found.a_bounds), lists(found.b_ids, found.b_bounds)]
                columns += [lists(found.a_cuts - first[0], found.group_bounds), lists(found.b_cuts - first[1], found.group_bounds)]
            yield pa.RecordBatch.from_arrays(columns, [key, *names, "groups_sha256", "link_ids", "link_times", *(["a_ids", "b_ids", "a_cuts", "b_cuts"] if ids else [])])

    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, link_ids array<int>, link_times array<int>"
    schema += ", a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>" if ids else ""
    return df.select(F.col(key).alias("_k"), F.col(text).alias("_t")).mapInArrow(align, schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """link, n and best: in how many rows a link occurs, and whether no other link of its a id occurs in more."""
    counts = aligned.select(F.explode("link_ids").alias("link")).groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    # One row per id of the first vocabulary; the link counts are few beside the links and are counted before they meet.
    top = counts.groupBy(F.shiftright("link", B_BITS).alias("_a")).agg(F.max("n").alias("_top"))
    return counts.join(top, F.shiftright("link", B_BITS) == F.col("_a")).select("link", "n", (F.col("n") == F.col("_top")).alias("best"))


def link_support(aligned: DataFrame, counts: DataFrame, row: str) -> DataFrame:
    """row, n_best and count_sum: how many links of the row are a best one, and the sum of the counts of its links.

    ``counts`` must be a written table, as it is read twice; ``row`` names each row of ``aligned``.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = counts.where(F.col("n") * FREQUENT >= total).orderBy("link").toArrow()  # FREQUENT rows at most
    table = [frequent.column(i).to_numpy() for i in range(3)]
    shared = aligned.sparkSession.sparkContext.broadcast(table)

    def known(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        links, n, best = shared.value
        ids, times = (batch.column(c).flatten().to_numpy() for c in ("link_ids", "link_times"))
        owner = np.repeat(np.arange(batch.num_rows), pa.compute.list_value_length(batch.column("link_ids")).to_numpy())
        at = np.minimum(np.searchsorted(links, ids), max(len(links) - 1, 0))
        found = links[at] == ids if len(links) else np.zeros(len(ids), bool)
        return owner, ids, times, found, n[at[found]], best[at[found]]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, _, times, found, n, best = known(batch)
            total, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, owner[found], times[found] * n)
            np.add.at(good, owner[found], times[found] * best)
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(good), pa.array(total)], ["_row", "_best", "_sum"])

    def others(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, ids, times, found, _, _ = known(batch)
            rows = batch.column("_row").to_numpy()[owner[~found]]
            yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(ids[~found]), pa.array(times[~found])], ["_row", "link", "_times"])

    source = aligned.select(F.col(row).alias("_row"), "link_ids", "link_times")
    rare = source.mapInArrow(others, "_row long, link int, _times int").join(counts, "link")
    rare = rare.groupBy("_row").agg(F.sum(F.when(F.col("best"), F.col("_times")).otherwise(0)).alias("_rare_best"), F.sum(F.col("_times") * F.col("n")).alias("_rare_sum"))
    both = source.mapInArrow(sums, "_row long, _best long, _sum long").join(rare, "_row", "left")
    return both.select(
        F.col("_row").alias(row), (F.col("_best") + F.coalesce("_rare_best", F.lit(0))).alias("n_best"),
        (F.col("_sum") + F.coalesce("_rare_sum", F.lit(0))).alias("count_sum"),
    )


def align_corpus(df: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``df``.

    Rows that repeat an id, or are alike, are documents of their own, each counted. A null id stays null. An
    empty table gives no rows. Other columns are not read. Aligned links are written once, as counts and rows must agree.
    """
    scratch = Scratch(df.sparkSession)
    aligned = scratch.write(align_column(df, a_path, b_path, key, text, ids=False).withColumn("_row", F.monotonically_increasing_id()), compression="zstd")
    counts = scratch.write(link_counts(aligned))
    support = link_support(aligned, counts, "_row")
    return aligned.drop("link_ids", "link_times").join(support, "_row").select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
