"""Language identification by compression: the language whose dictionary makes a text smallest.

Each language has a zstandard raw-content dictionary of sample texts. A text is compressed once with each, as
its words in lower case; the smallest result names the language, and a narrow margin to the second one is a
rejection. A long text is compressed in blocks, each with the whole dictionary, and their sizes are added, so that
every part of it is judged alike. Short texts take a level that also matches three bytes, as they have few longer matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_share, slices

UNKNOWN = "und"
LEVEL, SHORT_LEVEL = 3, 19
SHORT_BYTES = 512
BLOCK_BYTES = 1 << 15
NO_LETTERS = regex.compile(r"[^\p{L}]+")


def words_of(text: str) -> bytes:
    """The text's words in lower case between single spaces; empty if it has no letter."""
    words = NO_LETTERS.sub(" ", text.lower()).strip()
    return f" {words} ".encode("utf-8", "surrogatepass") if words else b""


def blocks(data: bytes, most: int = BLOCK_BYTES) -> Iterator[bytes]:
    """``data`` in nearly equal pieces of at most ``most`` bytes, cut before a space if a piece has one in its second half."""
    at, left = 0, -(-len(data) // most)
    while len(data) - at > most:
        end = at + min(most, -(-(len(data) - at) // left))
        space = data.rfind(b" ", at + (end - at) // 2, end)
        end = space if space > at else end
        yield data[at:end]
        at, left = end, max(left - 1, -(-(len(data) - end) // most))
    yield data[at:]


class Dictionaries:
    """One dictionary per language; a few hundred KB in all."""

    def __init__(self, samples: dict[str, bytes]):
        self.samples = dict(sorted(samples.items()))
        self._ready: list | None = None

    def __getstate__(self):
        return {"samples": self.samples, "_ready": None}

    def order(self, data: bytes) -> tuple[list[int], np.ndarray]:
        """The languages from the best on, and their sizes; sizes a byte apart are told apart by the words a dictionary holds."""
        sizes = self.sizes(data)
        close = np.flatnonzero(sizes <= sizes.min() + 1)
        held = np.zeros(len(sizes), np.int64)
        if len(close) > 1:
            words = set(data.split())
            for i in close:
                held[i] = sum(len(w) for w in words & self._vocabulary[i])
        return sorted(range(len(sizes)), key=lambda i: (sizes[i] if held[i] == 0 else sizes.min(), -held[i], sizes[i], i)), sizes

    def told_apart(self, data: bytes, first: int, second: int) -> bool:
        """Whether the dictionary of ``first`` holds more of the words than that of ``second``, counted in bytes."""
        words = set(data.split())
        one, other = (sum(len(w) for w in words & self._vocabulary[i]) for i in (first, second))
        return one > other

    @cached_property
    def _vocabulary(self) -> list[set[bytes]]:
        return [set(s.split()) for s in self.samples.values()]

    def sizes(self, data: bytes) -> np.ndarray:
        """The compressed size of ``data`` with each language's dictionary, summed over its blocks."""
        if self._ready is None:
            self._ready = [[], []]
            for ready, level in zip(self._ready, (LEVEL, SHORT_LEVEL), strict=True):
                for sample in self.samples.values():
                    words = zstandard.ZstdCompressionDict(sample, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                    words.precompute_compress(level=level)
                    ready.append(zstandard.ZstdCompressor(level=level, dict_data=words, write_content_size=False, write_dict_id=False))
        ready = self._ready[len(data) <= SHORT_BYTES]
        return sum(np.array([len(c.compress(part)) for c in ready], np.int64) for part in blocks(data))


def learn(labelled: DataFrame, key: str, text: str, lang: str, documents: int = 96, longest: int = 8192, dictionary_bytes: int = 1 << 17) -> Dictionaries:
    """Dictionaries from about ``documents`` whole texts per language, chosen by hash among those of 40 to ``longest``
    characters; at most ``dictionary_bytes`` of each language count. These three bounds make up the sample; a
    language without such a text is not learned, and rows without text or language are not used."""
    usable = labelled.where(F.col(lang).isNotNull() & F.length(text).between(40, longest)).select(key, text, lang)
    counts = {r[0]: r[1] for r in usable.groupBy(lang).count().collect()}
    if not counts:
        return Dictionaries({})
    # Each share is known from the counts, so only the sampled texts leave the scan.
    share = F.create_map(*[F.lit(x) for lg, n in counts.items() for x in (lg, min(1.0, documents / n))])[F.col(lang)]
    rows = usable.where(hash_share(F.col(key), share, 11)).orderBy(F.xxhash64(key)).limit(2 * documents * len(counts)).collect()
    parts: dict[str, list[bytes]] = {}
    for row in rows:
        parts.setdefault(row[lang], []).append(words_of(row[text]))
    return Dictionaries({lg: b"".join(p)[-dictionary_bytes:] for lg, p in parts.items()})


def identify(df: DataFrame, dictionaries: Dictionaries, text: str = "text", min_margin: float = 0.0, min_bytes: int = 200, prefix: str = "lang", judge_short: bool = False) -> DataFrame:
    """All columns and {prefix}_pred, {prefix}_score (0 to 1), {prefix}_margin and {prefix}_rejected.

    Columns of those names are replaced. The margin is what the second smallest size lies above the smallest, as a share of it, over all blocks of the text. A text that is null or
    has no letter, or any text if nothing was learned, is ``und`` with score 0 and rejected; others are
    rejected if their margin is below ``min_margin`` and their words have ``min_bytes`` or more. Full ties go to the
    alphabetically first language. Sizes are whole bytes, so equal ones say little about a shorter text: with ``judge_short`` it is rejected
    if besides the words held by the dictionaries do not tell its two best languages apart.
    """
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)
    names = [f"{prefix}_{x}" for x in ("pred", "score", "margin", "rejected")]
    df = df.drop(*names)

    def predict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = list(model.samples)
        for batch in slices(batches, text):
            out: list[tuple[str, float, float, bool]] = []
            for value in batch.column(text):
                words = words_of(value.as_py() or "")
                if not known or not words:
                    out.append((UNKNOWN, 0.0, 0.0, True))
                    continue
                order, sizes = model.order(words)
                best, second = np.partition(sizes, 1)[:2].tolist() if len(known) > 1 else (1, 2)
                margin = (second - best) / best
                unclear = margin < min_margin and (len(words) >= min_bytes or judge_short and not model.told_apart(words, *order[:2]))
                out.append((known[order[0]], margin / (margin + 0.02) if margin else 0.0, margin, unclear))
            kinds = (pa.string(), pa.float64(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], [*batch.schema.names, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(predict, f"{fields}, {names[0]} string, {names[1]} double, {names[2]} double, {names[3]} boolean")
