"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained and run in numpy.

A word enters as its own embedding and as the pool of its character n-grams, each with a log-ratio of how
often toxic training documents hold it. Documents are read in overlapping windows that cover every word; a
document is as toxic as its worst window, in training too.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_share, slices

WORD = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 15
GRAMS = (3, 4, 5, 6)
EMBED, HIDDEN, ATTEND = 4, 8, 8
WINDOW, STRIDE = 48, 32
CACHED_WORDS = 200_000
SHRINK = 8.0
F4 = np.float32


def tokenize(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def gram_buckets(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all character n-grams of the words, ends marked, and where each word's begin."""
    data = [b"<" + w.encode("utf-8", "surrogatepass") + b">" for w in words]
    sizes = np.array([len(d) for d in data], np.int64)
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    ends = np.cumsum(sizes)
    left = np.repeat(ends, sizes) - np.arange(len(flat))  # bytes up to the word's end
    owner, hashes = [], []
    for n in GRAMS:
        fits = np.flatnonzero(left >= n)
        h = np.full(len(fits), n, np.uint64)
        for i in range(n):
            h = (h ^ flat[fits + i]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        owner.append(np.searchsorted(ends, fits, side="right"))
        hashes.append((h % np.uint64(BUCKETS)).astype(np.int64))
    owner_all, hash_all = np.concatenate(owner), np.concatenate(hashes)
    order = np.argsort(owner_all, kind="stable")
    return hash_all[order], np.searchsorted(owner_all[order], np.arange(len(words)))


def log_ratio(toxic: np.ndarray, every: np.ndarray, share: float) -> np.ndarray:
    """Log of the toxic share among documents that hold a feature over the share among all, shrunk towards zero."""
    return np.log((toxic + SHRINK * share) / (every + SHRINK) / share).astype(F4)


@dataclass
class Network:
    """Vocabulary, statistics and weights; a few MB, whatever the corpus."""

    vocabulary: dict[str, int]
    word_ratio: np.ndarray
    gram_ratio: np.ndarray
    weights: dict[str, np.ndarray]
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None  # the score of every text, where the labels had one class only
    _cache: dict[str, int] = field(default_factory=dict)
    _rows: list = field(default_factory=list)

    def __getstate__(self):
        return self.__dict__ | {"_cache": {}, "_rows": []}

    def features(self, words: list[str]) -> tuple[np.ndarray, tuple]:
        """Inputs of distinct words, and what their gradient needs."""
        grams, starts = gram_buckets(words)
        ids = np.array([self.vocabulary.get(w, 0) for w in words], np.int64)
        counts = np.diff(np.append(starts, len(grams)))[:, None].astype(F4)
        ratio = self.gram_ratio[grams]
        inputs = np.concatenate([
            self.word_ratio[ids][:, None], np.maximum.reduceat(ratio, starts)[:, None], np.add.reduceat(ratio, starts)[:, None] / counts,
            self.weights["words"][ids], np.add.reduceat(self.weights["grams"][grams], starts) / counts,
        ], axis=1).astype(F4)
        return inputs, (ids, grams, starts, counts)

    def look_up(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Projected inputs of all cached words, row 0 for padding, and the row of each word behind one another."""
        if len(self._cache) > CACHED_WORDS:
            self._cache, self._rows = {}, []
        new = list(set().union(*lists) - self._cache.keys())
        if not self._rows:
            self._rows = [np.zeros((1, 6 * HIDDEN), F4)]
        if new:
            start = sum(len(r) for r in self._rows)
            self._rows.append(self.features(new)[0] @ self.weights["input"] + self.weights["bias"])
            self._cache.update(zip(new, range(start, start + len(new)), strict=True))
        if len(self._rows) > 1:
            self._rows = [np.concatenate(self._rows)]
        get = self._cache.__getitem__
        return self._rows[0], np.array([get(w) for ws in lists for w in ws], np.int32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The score of each text, 0 to 1; a text without words scores as an empty window."""
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        lists = [tokenize(t) for t in texts]
        projected, rows = self.look_up(lists)
        index, owner = windows(rows, [len(x) for x in lists])
        logit = np.full(len(texts), -np.inf)
        for at in range(0, len(index), 2048):
            part = index[at:at + 2048]
            np.maximum.at(logit, owner[at:at + 2048], forward(projected[part], part > 0, self.weights)[0])
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logit + self.scale[1], -30, 30)))


def windows(rows: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows that cover all words of each text, padded with 0, and the text of each window."""
    length = np.array(sizes, np.int64)
    begin = np.cumsum(length) - length
    count = 1 + np.maximum(0, -(-(length - WINDOW) // STRIDE))
    owner = np.repeat(np.arange(len(length)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    padded, filled = np.append(rows, rows.dtype.type(0)), np.empty((len(owner), WINDOW), rows.dtype)
    for at in range(0, len(owner), 4096):  # the places of a few windows at a time
        own = owner[at:at + 4096, None]
        inside = number[at:at + 4096, None] * STRIDE + np.arange(WINDOW)
        filled[at:at + 4096] = padded[np.where(inside < length[own], begin[own] + inside, len(rows))]
    return filled, owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return F4(0.5) * np.tanh(F4(0.5) * x) + F4(0.5)


def forward(x: np.ndarray, mask: np.ndarray, w: dict[str, np.ndarray], keep: bool = False):
    """Logits of windows whose inputs are projected: first 3 x HIDDEN for the forward reading, then the backward one."""
    n, steps, h = len(x), x.shape[1], HIDDEN
    states = np.zeros((2, steps, n, h), F4)
    tape: list = []
    for d in range(2):
        own = x[:, :, d * 3 * h:(d + 1) * 3 * h]
        recur, state = w["recur"][d], np.zeros((n, h), F4)
        for t in range(steps) if d == 0 else range(steps - 1, -1, -1):
            m = mask[:, t, None]
            gates = _sigmoid(own[:, t, :2 * h] + state @ recur[:, :2 * h])
            z, r = gates[:, :h], gates[:, h:]
            inner = state @ recur[:, 2 * h:]
            new = np.tanh(own[:, t, 2 * h:] + r * inner)
            before = state
            state = np.where(m, new + z * (state - new), state)
            states[d, t] = state
            if keep:
                tape.append((d, t, m, z, r, inner, new, before))
    both = np.concatenate([states[0], states[1]], axis=2)  # steps, n, 2h
    hidden = np.tanh(both @ w["attend"] + w["attend_bias"])
    energy = np.where(mask.T, hidden @ w["query"], F4(-1e9))
    energy = np.exp(energy - energy.max(axis=0))
    share = energy / energy.sum(axis=0)
    pooled = (share[:, :, None] * both).sum(axis=0)
    return pooled @ w["out"] + w["out_bias"][0], (both, hidden, share, pooled, tape)


def backward(grad: np.ndarray, saved, mask: np.ndarray, w: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the weights and of the projected inputs."""
    both, hidden, share, pooled, tape = saved
    steps, n, h = both.shape[0], both.shape[1], HIDDEN
    g = {"out": pooled.T @ grad, "out_bias": np.array([grad.sum()], F4)}
    d_pooled = grad[:, None] * w["out"]
    d_share = (both * d_pooled).sum(axis=2)
    d_energy = share * (d_share - (share * d_share).sum(axis=0))
    g["query"] = (hidden * d_energy[:, :, None]).sum(axis=(0, 1))
    d_hidden = d_energy[:, :, None] * w["query"] * (1 - hidden * hidden)
    g["attend"] = both.reshape(-1, 2 * h).T @ d_hidden.reshape(-1, ATTEND)
    g["attend_bias"] = d_hidden.sum(axis=(0, 1))
    d_both = share[:, :, None] * d_pooled + d_hidden @ w["attend"].T
    g["recur"], d_x = np.zeros_like(w["recur"]), np.zeros((n, steps, 6 * h), F4)
    carry = {0: np.zeros((n, h), F4), 1: np.zeros((n, h), F4)}
    for d, t, m, z, r, inner, new, before in reversed(tape):
        up = carry[d] + d_both[t][:, d * h:(d + 1) * h]
        live = np.where(m, up, 0)
        d_new = live * (1 - z) * (1 - new * new)
        d_z = live * (before - new) * z * (1 - z)
        d_r = d_new * inner * r * (1 - r)
        d_inner = d_new * r
        recur = w["recur"][d]
        g["recur"][d] += before.T @ np.concatenate([d_z, d_r, d_inner], axis=1)
        carry[d] = np.where(m, live * z, up) + np.concatenate([d_z, d_r], axis=1) @ recur[:, :2 * h].T + d_inner @ recur[:, 2 * h:].T
        d_x[:, t, d * 3 * h:(d + 1) * 3 * h] = np.concatenate([d_z, d_r, d_new], axis=1)
    return g, d_x


def _statistics(docs: list[list[str]], labels: np.ndarray, vocabulary: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """Log-ratios of words and of n-gram buckets over the given documents, each as its distinct words."""
    share = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3)) if len(labels) else 0.5
    words, grams = np.zeros((2, len(vocabulary) + 1)), np.zeros((2, BUCKETS))
    every = sorted(set().union(*docs)) if docs else []
    if every:
        buckets, starts = gram_buckets(every)
        ends = np.append(starts[1:], len(buckets))
        place = {w: i for i, w in enumerate(every)}
        for doc, label in zip(docs, labels, strict=True):
            if not doc:
                continue
            ids = np.array([vocabulary[w] for w in doc if w in vocabulary], np.int64)
            at = np.array([place[w] for w in doc])
            held = np.unique(np.concatenate([buckets[starts[i]:ends[i]] for i in at]))
            for table, hits in ((words, ids), (grams, held)):
                table[1, hits] += 1
                table[0, hits] += label
    ratio = log_ratio(*words, share)
    ratio[0] = 0
    return ratio, log_ratio(*grams, share)


def train(texts: list[str], labels: list[int], prevalence: float | None = None, batches: int = 240, seed: int = 5) -> Network:
    """Fit a network in about ``batches`` batches, five rounds at least. Statistics used on a training document come
    from the other half of the sample."""
    rng = np.random.default_rng(seed)
    y = np.array(labels, F4)
    names: dict[str, str] = {}  # one string for all places of a word
    lists = [[names.setdefault(w, w) for w in tokenize(t)] for t in texts]
    docs = [list(dict.fromkeys(x)) for x in lists]  # lists take less room than sets
    counts: dict[str, int] = {}
    for doc in docs:
        for word in doc:
            counts[word] = counts.get(word, 0) + 1
    vocabulary = {w: i for i, w in enumerate(sorted(w for w, n in counts.items() if n >= 3), 1)}

    def small(*shape: int) -> np.ndarray:
        return (rng.normal(size=shape) * (1 / np.sqrt(shape[-2] if len(shape) > 1 else shape[-1]))).astype(F4)

    wide = 3 + 2 * EMBED
    weights = {
        "words": small(len(vocabulary) + 1, EMBED) * F4(0.1), "grams": small(BUCKETS, EMBED) * F4(0.1), "input": small(wide, 6 * HIDDEN),
        "bias": np.zeros(6 * HIDDEN, F4), "recur": np.stack([small(HIDDEN, 3 * HIDDEN), small(HIDDEN, 3 * HIDDEN)]),
        "attend": small(2 * HIDDEN, ATTEND), "attend_bias": np.zeros(ATTEND, F4), "query": small(ATTEND), "out": small(2 * HIDDEN), "out_bias": np.zeros(1, F4),
    }
    weights["words"][0] = 0
    network = Network(vocabulary, *_statistics(docs, y, vocabulary), weights)
    if len(set(labels)) < 2:
        network.constant = float(y.mean()) if len(y) else 0.0
        return network
    fold = rng.permutation(len(lists)) % 2
    halves = []
    for f in range(2):
        rest = np.flatnonzero(fold != f)
        halves.append(Network(vocabulary, *_statistics([docs[i] for i in rest], y[rest], vocabulary), weights))
    prepared = []
    for f in range(2):
        own = np.flatnonzero(fold == f)
        words = sorted(set().union(*(docs[i] for i in own)))
        row = {w: i + 1 for i, w in enumerate(words)}
        flat = np.array([row[w] for i in own for w in lists[i]], np.int32)
        index, owner = windows(flat, [len(lists[i]) for i in own])
        prepared.append((own, words, index, owner))
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in weights.items()}
    step = 0

    def logits(f: int) -> np.ndarray:
        own, words, index, _ = prepared[f]
        inputs = halves[f].features(words)[0] if words else np.zeros((0, wide), F4)
        projected = np.concatenate([np.zeros((1, 6 * HIDDEN), F4), inputs @ weights["input"] + weights["bias"]])
        return np.concatenate([forward(projected[p], p > 0, weights)[0] for p in np.array_split(index, max(1, len(index) // 2048))])

    def worst(f: int) -> tuple[np.ndarray, np.ndarray]:
        """The highest window of each document, and its logit."""
        own, _, _, owner = prepared[f]
        found = logits(f)
        order = np.lexsort((-found, owner))
        first = order[np.append(True, owner[order][1:] != owner[order][:-1])]
        return first, found[first]

    epochs = max(5, min(40, -(-batches * 64 // max(1, len(lists)))))
    for epoch in range(epochs):
        chosen = []
        for f in range(2):
            own, _, index, owner = prepared[f]
            first = worst(f)[0]
            extra = rng.choice(len(index), min(len(index), len(own)), replace=False)
            extra = extra[y[own[owner[extra]]] == 0]  # any window of a document without toxicity has none
            chosen += [(f, i) for i in np.concatenate([first, extra])]
        order = rng.permutation(len(chosen))
        rate = 0.02 * 0.08 ** (epoch / epochs)
        for at in range(0, len(order), 128):
            for f in range(2):
                own, words, index, owner = prepared[f]
                picked = np.array([chosen[i][1] for i in order[at:at + 128] if chosen[i][0] == f], np.int64)
                if not len(picked):
                    continue
                part = index[picked]
                used, inverse = np.unique(part, return_inverse=True)
                inverse, real = inverse.reshape(part.shape), used[used > 0]
                if not len(real):
                    continue
                inputs, (ids, grams, starts, counted) = halves[f].features([words[i - 1] for i in real])
                pad = len(used) - len(real)
                full = np.concatenate([np.zeros((pad, wide), F4), inputs])
                projected = full @ weights["input"] + weights["bias"]
                mask = part > 0
                out, saved = forward(projected[inverse], mask, weights, keep=True)
                target = y[own[owner[picked]]]
                grad = ((1 / (1 + np.exp(-out)) - target) / len(picked)).astype(F4)
                g, d_x = backward(grad, saved, mask, weights)
                d_p = np.zeros_like(projected)
                np.add.at(d_p, inverse[mask], d_x[mask])
                g["input"], g["bias"] = full.T @ d_p, d_p.sum(axis=0)
                d_in = (d_p @ weights["input"].T)[pad:]
                g["words"], g["grams"] = np.zeros_like(weights["words"]), np.zeros_like(weights["grams"])
                np.add.at(g["words"], ids, d_in[:, 3:3 + EMBED])
                g["words"][0] = 0
                sizes = np.diff(np.append(starts, len(grams)))
                np.add.at(g["grams"], grams, np.repeat(d_in[:, 3 + EMBED:] / counted, sizes, axis=0))
                step += 1
                for k, v in weights.items():
                    if k in ("words", "grams"):  # their statistics do most of the work; small plain steps suffice
                        v -= F4(rate) * g[k]
                        continue
                    m, s = moments[k]
                    m += F4(0.1) * (g[k] - m)
                    s += F4(0.01) * (g[k] * g[k] - s)
                    v -= F4(rate) * (m / F4(1 - 0.9 ** step)) / (np.sqrt(s / F4(1 - 0.99 ** step)) + F4(1e-6))
    # A line from a document's worst logit to its log-odds, at the prevalence outside the balanced sample.
    found, truth = [], []
    for f in range(2):
        first, values = worst(f)
        found.append(values)
        truth.append(y[prepared[f][0][prepared[f][3][first]]])
    x, t = np.concatenate(found).astype(float), np.concatenate(truth).astype(float)
    share = t.mean()
    prevalence = share if prevalence is None else prevalence
    weight = np.where(t == 1, prevalence / share, (1 - prevalence) / (1 - share))
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        e, v = weight * (p - t), weight * p * (1 - p) + 1e-6
        hessian = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum()]])
        da, db = np.linalg.solve(hessian, [(e * x).sum() + 1e-3 * (a - 1), e.sum()])
        a, b = a - np.clip(da, -1, 1), b - np.clip(db, -1, 1)
        if abs(da) + abs(db) < 1e-6:
            break
    network.scale = (float(max(a, 1e-3)), float(b))
    return network


def learn(documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", per_class: int = 2000, longest: int = 8192) -> Network:
    """Train on about ``per_class`` whole texts of each label, chosen by hash, of at most ``longest`` characters.

    These two bounds make up the sample. Null labels and texts are not used; a document with several labels has the
    highest. With labels of one class only, or none, every text gets that class's value, or 0.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.max(label).cast("int").alias("_y"))
    counts = {r["_y"]: r["n"] for r in known.where("_y IN (0, 1)").groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return train([], [])
    share = F.when(F.col("_y") == 1, F.lit(min(1.0, per_class / counts.get(1, 1)))).otherwise(F.lit(min(1.0, per_class / counts.get(0, 1))))
    chosen = known.where(F.col("_y").isin(0, 1) & hash_share(F.col(key), share, 13)).limit(4 * per_class)
    rows = documents.select(key, text).where(F.length(text) <= longest).join(F.broadcast(chosen), key).orderBy(key).limit(4 * per_class).collect()
    return train([r[text] for r in rows], [r["_y"] for r in rows], counts.get(1, 0) / sum(counts.values()))


def score(df: DataFrame, network: Network, text: str = "text", out: str = "toxicity") -> DataFrame:
    """All columns and ``out``, 0 to 1: the score of the worst of all windows of the whole text. Null counts as empty;
    a column named ``out`` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(network)
    df = df.drop(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in slices(batches, text, 2 << 20):
            found = model.scores(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}, `{out}` double")
