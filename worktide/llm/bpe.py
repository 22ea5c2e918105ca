"""Byte-pair encoding and decoding with a public vocabulary file.

Words of one length are the rows of a contiguous array of part ids beside an array of the ranks of
adjacent parts. In each round every word scans its ranks for the minimum, merges there, deletes the
boundary and refreshes the two neighbouring ranks. Words longer than ``SCAN_LIMIT`` bytes use a heap over
the same ranks, which gives the same parts without a quadratic scan.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

NO_RANK = 1 << 40
SCAN_LIMIT = 64
#: The tables of runs and words are emptied before a batch when they take more than this.
CACHED_BYTES = 128 << 20
#: Control characters that str.split() takes for white space and the word pattern does not.
UNSPLIT = re.compile("[\x1c-\x1f]")

#: Fixed value: the word pattern of the vocabulary file, with its white space spelled as a property.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it prints, else the next one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols, spare = {b: chr(b) for b in printable}, 256
    for b in range(256):
        if b not in symbols:
            symbols[b] = chr(spare)
            spare += 1
    return [symbols[b] for b in range(256)]


class Table:
    """Ids of strings, all in one array that grows by doubling."""

    def __init__(self):
        self.rows: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(1024, np.int32), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.used, self.text_bytes = 0, 0

    @property
    def bytes(self) -> int:
        """About what the strings, their entries and the ids take."""
        return self.text_bytes + 120 * len(self.rows) + 4 * self.used

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        if size <= len(array):
            return array
        return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])

    def add(self, names: list[str], flat: np.ndarray, sizes: np.ndarray) -> None:
        before, after, end = len(self.rows), len(self.rows) + len(names), self.used + len(flat)
        self.rows.update(zip(names, range(before, after), strict=True))
        self.start, self.size, self.flat = self._room(self.start, after), self._room(self.size, after), self._room(self.flat, end)
        self.start[before:after], self.size[before:after] = self.used + np.cumsum(sizes) - sizes, sizes
        self.flat[self.used:end] = flat
        self.used = end
        self.text_bytes += sum(map(len, names))

    def take(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given strings behind one another, and how many each has."""
        rows = np.fromiter(map(self.rows.__getitem__, names), np.int64, len(names))
        sizes = self.size[rows]
        ends = np.cumsum(sizes)
        return self.flat[np.repeat(self.start[rows] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)], sizes


class WordBpe:
    """Encoder and decoder of one vocabulary with word ends; small enough to be sent to every executor."""

    def __init__(self, tokens: list[str], pairs: dict[int, int], first: list[int], last: list[int], special: dict[str, int]):
        self.tokens, self.pairs, self.first, self.last, self.special = tokens, pairs, first, last, special
        self.keys = np.array(sorted(pairs), np.int64)
        self.merges = np.array([pairs[k] for k in self.keys.tolist()], np.int64)
        self.runs, self.words = Table(), Table()

    @classmethod
    def load(cls, path: str) -> WordBpe:
        """Read a tokenizer file whose model is byte-level BPE with the word end ``</w>``."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = [""] * (1 + max(*vocab.values(), *special.values()))
        for token, i in [*vocab.items(), *special.items()]:
            tokens[i] = token
        pairs = {}  # both part ids in one integer -> rank << 20 | id of the merged part
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            pairs[vocab[a] << 20 | vocab[b]] = rank << 20 | vocab[a + b]
        symbols = byte_symbols()
        return cls(tokens, pairs, [vocab[s] for s in symbols], [vocab[s + end] for s in symbols], special)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k in ("tokens", "pairs", "first", "last", "special", "keys", "merges")} | {"runs": Table(), "words": Table()}

    @cached_property
    def _words(self):
        return regex.compile(WORDS)

    @cached_property
    def _special(self):
        return re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def _merge_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and id of the part that each pair merges to, NO_RANK where none."""
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.merges[at], NO_RANK)

    def _scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Part ids of words of one length, given as rows of bytes, and their numbers of parts."""
        words, width = data.shape
        ids = np.array(self.first, np.int64)[data]
        ids[:, -1] = np.array(self.last, np.int64)[data[:, -1]]
        done, count, live = np.full((words, width), -1, np.int64), np.full(words, width), np.arange(words)
        ranks = np.full((words, width), NO_RANK, np.int64)  # the last column stays without a rank
        if width > 1:
            ranks[:, :-1] = self._merge_of(ids[:, :-1], ids[:, 1:])
        columns = np.arange(width)
        while len(live):
            at = ranks.argmin(axis=1)
            low = ranks[np.arange(len(live)), at]
            over = low == NO_RANK
            if over.any():
                done[live[over]] = ids[over]
                live, ids, ranks, at, low = live[~over], ids[~over], ranks[~over], at[~over], low[~over]
                if not len(live):
                    break
            rows = np.arange(len(live))
            ids[rows, at] = low & 0xFFFFF
            take = np.minimum(columns + (columns > at[:, None]), width - 1)  # deletes the boundary behind the merged part
            ids, ranks = np.take_along_axis(ids, take, 1), np.take_along_axis(ranks, take, 1)
            count[live] -= 1
            size = count[live]
            ranks[columns >= size[:, None] - 1] = NO_RANK
            for left in (at - 1, at):
                has = (left >= 0) & (left + 1 < size)
                r, c = rows[has], left[has]
                ranks[r, c] = self._merge_of(ids[r, c], ids[r, c + 1])
        return done, count

    def parts(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words behind one another, and how many each word has."""
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        counts, found = np.zeros(len(data), np.int64), []
        for size in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == size)
            if size > SCAN_LIMIT:
                for i in at.tolist():
                    ids = [self.first[b] for b in data[i]]
                    ids[-1] = self.last[data[i][-1]]
                    part = np.array(self._by_heap(ids), np.int32)
                    counts[i] = len(part)
                    found.append((np.full(len(part), i), part))
            else:
                block = np.frombuffer(b"".join([data[i] for i in at.tolist()]), np.uint8).reshape(len(at), size)
                ids, counts[at] = self._scan(block)
                there = np.arange(size) < counts[at][:, None]
                found.append((np.repeat(at, counts[at]), ids[there].astype(np.int32)))
        if not found:
            return np.zeros(0, np.int32), counts
        owner, flat = (np.concatenate(x) for x in zip(*found, strict=True))
        return flat[np.argsort(owner, kind="stable")], counts

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same merges in the same order: lowest rank first, leftmost first among equals."""
        get, size = self.pairs.get, len(ids)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(got, i) for i in range(size - 1) if (got := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            got, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else size
            if j >= size or get(ids[i] << 20 | ids[j]) != got:
                continue
            ids[i], ids[j] = got & 0xFFFFF, -1
            after[i] = after[j]
            if after[j] < size:
                before[after[j]] = i
                if (right := get(ids[i] << 20 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (right, i))
            if before[i] >= 0 and (left := get(ids[before[i]] << 20 | ids[i])) is not None:
                heapq.heappush(heap, (left, before[i]))
        return [x for x in ids if x >= 0]

    def _pieces(self, text: str) -> list[str]:
        """Runs of text whose ids depend on nothing around them, and the special tokens between them."""
        out: list[str] = []
        for part in self._special.split(text) if self._special else [text]:
            out += [part] if part in self.special or UNSPLIT.search(part) else part.split()
        return out

    def _learn(self, runs: set[str]) -> None:
        """Put the ids of the given runs into the tables, which are emptied first if they are full."""
        if self.runs.bytes + self.words.bytes > CACHED_BYTES:
            self.runs, self.words = Table(), Table()
        new = list(runs - self.runs.rows.keys())
        if not new:
            return
        words: list[str] = []
        counts, find, specials = np.ones(len(new), np.int64), self._words.findall, self.special
        for i, run in enumerate(new):
            if run in specials:
                words.append(run)
                continue
            plain = run if run.isascii() else unicodedata.normalize("NFC", run).replace("Σ", "σ")  # no final sigma
            plain = plain.lower()
            if plain.isalpha() and plain.isascii():
                words.append(plain)
            else:
                found = find(plain)
                words += found
                counts[i] = len(found)
        unknown = list(set(words) - self.words.rows.keys())
        named = [w for w in unknown if w in specials]
        if named:
            self.words.add(named, np.array([specials[w] for w in named], np.int32), np.ones(len(named), np.int64))
            unknown = [w for w in unknown if w not in specials]
        self.words.add(unknown, *self.parts(unknown))
        ids, sizes = self.words.take(words)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        self.runs.add(new, ids, np.diff(ends))

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts behind one another, and where each text's ids end, from 0 on."""
        pieces = [self._pieces(t) if t else [] for t in texts]
        runs = list(chain.from_iterable(pieces))
        self._learn(set(runs))
        ids, sizes = self.runs.take(runs)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([len(p) for p in pieces]))]
        return ids, ends

    def encode(self, text: str) -> list[int]:
        """The ids of a text; the strings of special tokens in it become their ids, none are added."""
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens of the ids joined by one space, as the vocabulary file names no decoder of its own."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


def encode_column(df: DataFrame, path: str, text: str = "text", out: str = "ids", keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` and ``out``, an array of token ids for the whole ``text`` of each row.

    A null or empty text has no ids. Rows are neither merged nor dropped, so repeated rows give repeated
    rows. Nothing is shuffled; a task holds a few MB of text at a time, or one document if that is larger.
    """
    model = df.sparkSession.sparkContext.broadcast(WordBpe.load(path))

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        for batch in slices(batches, "_bpe_text"):
            ids, ends = bpe.encode_batch(batch.column("_bpe_text").to_pylist())
            column = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column(f"_bpe_{i}") for i in range(len(keep))] + [column], [*keep, out])

    fields = [df.schema[k] for k in keep]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), f"`{out}` array<int>"])
    source = df.select(*[F.col(k).alias(f"_bpe_{i}") for i, k in enumerate(keep)], F.col(text).alias("_bpe_text"))
    return source.mapInArrow(encode, schema)


def decode_column(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and ``out``, the text that ``ids`` stand for; null ids give a null text, a column named ``out`` is replaced."""
    df = df.drop(out)
    model = df.sparkSession.sparkContext.broadcast(WordBpe.load(path))

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = [bpe.decode(x.values.to_numpy().tolist()) if x.is_valid else None for x in part.column(ids)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields), f"`{out}` string"])
    return df.mapInArrow(decode, schema)
