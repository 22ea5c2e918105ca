"""Near-duplicate components by a chosen-path set similarity join.

A document is the set of its word shingles, sketched by minwise tokens. Each of several independent trees
branches documents by chosen minwise tokens: those that share a token share a node. Small nodes are compared
exhaustively. A large node is compared with pivots drawn from it, and what the pivots do not settle branches
again by further tokens; where branching hardly divides a node, its documents are alike and every open pair is
compared, in blocks. Links are confirmed on full sets, and pairs that links already connect are not compared,
so a group of n copies costs about n links.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.prefix import ordered_prefix
from ..session import cut_lineage
from .common import LOWER, UPPER, Scratch, keys_repeat, runs, slices

TOKENS = 64  # minwise tokens of a sketch, more if there are more trees
DEPTH = 8
ALIKE = 0.5  # a child with this share of its parent is not branched further
NODE = 384  # documents of a small node, and about the pivots of a large one
MISS = 3e-7  # probability that no tree shows a pair at the threshold
UNLIKE = 1e-6  # probability that the sketches of such a pair agree on too few tokens

_FOLD = bytes.maketrans(UPPER.encode(), LOWER.encode())
_SPLIT = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")


class Shape(NamedTuple):
    """What a threshold needs of sketches and trees."""

    trees: int
    tokens: int
    branches: int
    agree: int  # tokens that the sketches of a probable pair share at least


def shape(percent: int) -> Shape:
    """Sizes for pairs of ``percent`` similarity, at which a minwise token agrees with that probability.

    All trees miss such a pair with a probability of at most MISS, its sketches agree on fewer than ``agree`` tokens with
    one of at most UNLIKE, and of its children in a large node it shares 1.5 or more on average, so its paths survive.
    """
    if not 1 <= percent <= 100:
        raise ValueError(f"percent is {percent}; thresholds are 1 to 100")
    same = percent / 100
    trees = 1 if percent == 100 else math.ceil(math.log(MISS) / math.log(1 - same))
    tokens, agree = max(TOKENS, trees), 0
    below = 0.0
    while agree < tokens:
        below += math.comb(tokens, agree) * same**agree * (1 - same) ** (tokens - agree)
        if below > UNLIKE:
            break
        agree += 1
    return Shape(trees, tokens, math.ceil(1.5 / same), agree)


def _hashes(tokens: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 1 << 63, tokens, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, tokens, dtype=np.uint64)


def shingles(text: str | None, size: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; with fewer words than ``size``, the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).translate(_SPLIT).split(b" ") if text else []
    words = [w for w in words if w]
    if not words:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    out = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        out = (out ^ hashed[i:len(words) - size + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


def sketch(found: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, one for each hash function."""
    low = np.full(len(times), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(found), 8192):
        low = np.minimum(low, ((found[at:at + 8192, None] * times + plus) >> np.uint64(32)).min(axis=0).astype(np.uint32))
    return low


def _sets(df: DataFrame, key: str, text: str, size: int, tokens: int = 0) -> DataFrame:
    """_k, _n, _u (128-bit name of the set) and _sig of ``tokens`` tokens, or without them the set itself as _set."""

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _hashes(tokens)
        for batch in slices(batches, "_text"):
            counts, names, data = [], [], []
            for value in batch.column("_text").to_pylist():
                found = shingles(value, size)
                counts.append(len(found))
                names.append(xxhash.xxh3_128_digest(found.tobytes()))
                data.append(sketch(found, *hashes).tobytes() if tokens else found.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("_k"), pa.array(counts, pa.int64()), pa.array(names, pa.binary()), pa.array(data, pa.binary())], ["_k", "_n", "_u", out])

    out = "_sig" if tokens else "_set"
    return df.select(F.col(key).cast("long").alias("_k"), F.col(text).alias("_text")).mapInArrow(make, f"_k long, _n long, _u binary, {out} binary")


def _token(i) -> Column:
    return F.substring("_sig", F.lit(4) * i + 1, F.lit(4))


def _probable(sizes: Shape):
    """The documents of a small node whose sketch is near another one's."""

    def flag(node: pa.Table) -> pa.RecordBatch | None:
        sig = np.frombuffer(b"".join(node.column("_sig").to_pylist()), np.uint32).reshape(-1, sizes.tokens)
        near = np.zeros((len(sig), len(sig)), np.int16)
        for i in range(sizes.tokens):
            near += sig[:, i, None] == sig[None, :, i]
        np.fill_diagonal(near, -1)
        flagged = np.flatnonzero((near >= sizes.agree).any(axis=1))
        if not len(flagged):
            return None
        return pa.RecordBatch.from_arrays([node.column("_u").combine_chunks().take(pa.array(flagged))], ["_u"])

    return flag


def _compare(percent: int):
    """Links between labels in one block: each pivot, or each document if the block has none, against all others."""

    def links(block: pa.Table) -> pa.RecordBatch | None:
        label = block.column("_label").to_numpy()
        names, home = np.unique(label, return_inverse=True)
        if len(names) < 2:
            return None
        pivot = block.column("_pivot").to_numpy()
        parent = list(range(len(names)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        count = block.column("_n").to_numpy()
        flat = np.frombuffer(b"".join(block.column("_set").to_pylist()), np.uint64)
        place = np.unique(flat, return_inverse=True)[1].ravel()
        starts = np.cumsum(count) - count
        mark = np.zeros(place.max() + 1, np.int64)
        out = []
        for i in np.flatnonzero(pivot) if pivot.any() else range(len(label)):
            roots = np.array([root(x) for x in range(len(names))])
            other = roots[home] != roots[home[i]]
            if not other.any():
                continue
            own = place[starts[i]:starts[i] + count[i]]
            mark[own] = 1
            shared = np.add.reduceat(mark[place], starts)
            mark[own] = 0
            for j in np.flatnonzero(other & (100 * shared >= percent * (count + count[i] - shared))):
                a, b = root(home[i]), root(home[j])
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((names[home[i]], names[home[j]]))
        if not out:
            return None
        table = np.array(out, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(table[:, 0]), pa.array(table[:, 1])], ["_a", "_b"])

    return links


def connect(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """_from, _to: the smallest label that each label of ``edges`` (_a, _b) reaches.

    Each round hooks every label to its smallest neighbour, follows the hooks four steps, and goes on with the
    edges between different ends; a label that is not yet at its end still has an edge towards it.
    """
    ends = None
    open_edges = edges.select(F.greatest("_a", "_b").alias("_a"), F.least("_a", "_b").alias("_b")).where("_a <> _b")
    while True:
        open_edges = scratch.write(open_edges.distinct())
        if open_edges.isEmpty():
            return ends if ends is not None else open_edges.select(F.col("_a").alias("_from"), F.col("_b").alias("_to"))
        both = open_edges.select("_a", "_b").unionByName(open_edges.select(F.col("_b").alias("_a"), F.col("_a").alias("_b")))
        hooks = both.groupBy("_a").agg(F.min("_b").alias("_low")).select(F.col("_a").alias("_from"), F.least("_a", "_low").alias("_to"))
        for _ in range(2):
            hooks = scratch.write(hooks)
            onward = hooks.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"))
            hooks = hooks.join(onward, "_to").select("_from", F.col("_next").alias("_to"))
        hooks = scratch.write(hooks)
        if ends is None:
            ends = hooks
        else:
            onward = hooks.select(F.col("_from").alias("_to"), F.col("_to").alias("_next"))
            ends = scratch.write(ends.join(onward, "_to", "left").select("_from", F.coalesce("_next", "_to").alias("_to")))
        ahead = hooks.select(F.col("_from").alias("_a"), F.col("_to").alias("_x"))
        moved = open_edges.join(ahead, "_a").select(F.col("_x"), F.col("_b").alias("_a")).join(ahead.withColumnRenamed("_x", "_y"), "_a")
        open_edges = moved.select(F.greatest("_x", "_y").alias("_a"), F.least("_x", "_y").alias("_b")).where("_a <> _b")


def _resolve(rows: DataFrame, labels: DataFrame, sketches: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """The labels (_u, _label) after all links that the nodes ``rows`` (_node, _u) show."""
    sizes = shape(percent)
    rows = rows.withColumn("_parent", F.lit(None).cast("long"))
    for depth in range(DEPTH + 1):
        labelled = rows.join(labels, "_u")
        counts = labelled.groupBy("_node", "_label").agg(F.count(F.lit(1)).alias("_m"), F.max("_parent").alias("_parent"))
        stats = scratch.write(
            counts.groupBy("_node").agg(F.sum("_m").alias("_all"), F.max("_parent").alias("_parent"), F.max(F.struct("_m", "_label")).alias("_top"))
            .where(F.col("_all") > F.col("_top._m"))
            .select("_node", "_all", F.col("_top._label").alias("_major"), (F.col("_all") - F.col("_top._m")).alias("_minor"),
                    ((F.col("_all") > ALIKE * F.coalesce("_parent", F.lit(1 << 60))) | F.lit(depth == DEPTH)).alias("_last"))
        )
        if stats.isEmpty():
            return labels
        live = scratch.write(labelled.drop("_parent").join(stats, "_node"))
        # Documents outside a large node's largest class are its pivots: a part of them, or all where it is settled now.
        large, last = F.col("_all") > NODE, F.col("_last")
        parts, rounds = F.ceil(F.col("_all") / NODE), F.when(last, F.ceil(F.col("_minor") / NODE)).otherwise(F.lit(1))
        up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), (n - 1).cast("long")))
        spot = F.pmod(F.xxhash64("_u", F.lit(depth)), F.lit(1 << 40))
        members = live.select(
            "_node", F.when(large, spot % parts).otherwise(F.lit(0)).cast("long").alias("_part"),
            up_to(F.when(large, rounds).otherwise(F.lit(1))).alias("_slice"), F.lit(False).alias("_pivot"), "_u", "_label",
        )
        drawn = live.where(large & (F.col("_label") != F.col("_major")) & (last | (F.pmod(F.xxhash64("_u", F.lit(-1 - depth)), F.col("_minor")) < NODE)))
        pivots = drawn.select(
            "_node", up_to(parts).alias("_part"), F.pmod(F.xxhash64("_u", F.lit(7)), rounds).cast("long").alias("_slice"), F.lit(True).alias("_pivot"), "_u", "_label",
        )
        blocks = members.unionByName(pivots).join(sets, "_u").drop("_u")
        edges = scratch.write(runs(blocks, ["_node", "_part", "_slice"], _compare(percent), "_a long, _b long"))
        if not edges.isEmpty():
            moved = connect(edges, scratch).select(F.col("_from").alias("_label"), "_to")
            labels = scratch.write(labels.join(moved, "_label", "left").select("_u", F.coalesce("_to", "_label").alias("_label")))
        rest = live.where(large & ~last & (F.col("_minor") > NODE)).select("_node", "_u", F.col("_all").alias("_parent"))
        branches = F.explode(F.array(*[F.lit(depth * sizes.branches + b) for b in range(sizes.branches)]))
        chosen = F.pmod(F.xxhash64("_node", "_branch"), F.lit(sizes.tokens)).cast("int")
        rows = scratch.write(
            rest.join(sketches, "_u").select("_node", "_u", "_parent", "_sig", branches.alias("_branch"))
            .select("_u", F.xxhash64("_node", "_branch", _token(chosen)).alias("_node"), "_parent")
        )
        if rows.isEmpty():
            return labels
    return labels


def components(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 85) -> DataFrame:
    """One row per input row: ``key``, n_shingles, component_id, kept.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of ``size``-word shingles; a
    component's id is its smallest key. Trees, sketches and branches follow from ``percent`` (``shape``). Texts that are null or without words have empty sets and are
    linked with nothing, like rows without a key. Equal sets are one document until the end, so exact
    copies and repeated rows cost one aggregation.
    """
    sizes, scratch = shape(percent), Scratch(df.sparkSession)
    base = scratch.write(_sets(df, key, text, size, sizes.tokens))
    some = base.where("_n > 0 AND _k IS NOT NULL")
    reps = scratch.write(some.groupBy("_u").agg(F.min("_k").alias("_label"), F.max("_sig").alias("_sig")))
    sketches = reps.select("_u", "_sig")
    paths = reps.select("_u", F.posexplode(F.array(*[_token(i) for i in range(sizes.trees)])).alias("_tree", "_value"))
    paths = paths.select("_u", "_tree", F.xxhash64("_tree", "_value").alias("_node"))
    shared = scratch.write(paths.groupBy("_node").agg(F.count(F.lit(1)).alias("_all")).where("_all > 1"))
    met = scratch.write(paths.join(shared, "_node"))
    small = met.where(F.col("_all") <= NODE).select("_node", "_u").join(sketches, "_u")
    probable = runs(small, ["_node"], _probable(sizes), "_u binary").unionByName(met.where(F.col("_all") > NODE).select("_u"))
    candidates = scratch.write(probable.distinct())
    labels = scratch.write(reps.join(candidates, "_u").select("_u", "_label"))
    firsts = labels.select(F.col("_label").alias("_first")).distinct()
    source = df.select(F.col(key).cast("long").alias("_first"), F.col(text).alias("_text")).join(firsts, "_first")
    sets = scratch.write(_sets(source, "_first", "_text", size).select("_u", "_n", "_set").dropDuplicates(["_u"]))
    nodes = scratch.write(met.join(candidates, "_u").select("_node", "_u", "_tree"))
    # The first tree finds most links; the nodes of the others are then mostly of one class and drop out.
    for first, stop in ((0, 1), (1, sizes.trees)):
        labels = _resolve(nodes.where(F.col("_tree").between(first, stop - 1)).select("_node", "_u"), labels, sketches, sets, percent, scratch)
    known = reps.select("_u", F.col("_label").alias("_own")).join(labels, "_u", "left").select("_u", F.coalesce("_label", "_own").alias("_component"))
    known = scratch.write(known)
    linked = some.join(known, "_u").select("_k", "_n", "_component")
    alone = base.where("_n = 0 OR _k IS NULL").select("_k", "_n", F.col("_k").alias("_component"))
    found = cut_lineage(linked.unionByName(alone).select(
        F.col("_k").alias(key), F.col("_n").alias("n_shingles"), F.col("_component").alias("component_id"),
        F.coalesce(F.col("_k") == F.col("_component"), F.lit(True)).alias("kept"),
    ))
    scratch.remove()
    return found


def drop_near_copies(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` that stay, all columns: one document of each component, and all without words or key.

    Where keys repeat, each text of a key is a document of its own, and of rows equal in key and text one stays.
    """
    if keys_repeat(df, key):
        rows = df.where(F.col(key).isNotNull()).withColumns({"_key": F.col(key).cast("long"), "_digest": F.sha2(F.coalesce(text, F.lit("")), 256)})
        own = ["_key", "_digest"]
        placed = ordered_prefix(rows.select(*own).distinct(), [], [F.asc(c) for c in own], rank="_place")
        once = drop_near_copies(rows.dropDuplicates(own).join(placed, own), "_place", text, size, percent)
        return once.select(*df.columns).unionByName(df.where(F.col(key).isNull()))
    gone = components(df, key, text, size, percent).where("NOT kept").select(F.col(key).alias("_gone")).distinct()
    return df.join(gone, df[key].cast("long") == gone["_gone"], "left_anti")
