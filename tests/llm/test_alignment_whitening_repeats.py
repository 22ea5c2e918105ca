"""Operators 11 to 13 against brute force, and on awkward input."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from worktide.llm import alignment, queries, repeats, whitening

A_PATH, B_PATH = queries.BYTE_LEVEL, queries.PIECES


# -- 11: alignment -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B_PATH)


def brute_alignment(texts, tokenizers):
    """Rows of the query's columns after doc_id, with the libraries and plain loops."""
    a_side, b_side = tokenizers
    worker = alignment.Aligner(A_PATH, B_PATH)
    found, counts = [], Counter()
    for text in texts:
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        sides = []
        for ids, table in ((a, worker.a_bytes), (b, worker.b_bytes)):
            ends = np.cumsum([len(table[i]) for i in ids]).tolist()
            sides.append((ids, [0, *ends[:-1]], ends, b"".join(table[i] for i in ids)))
        if not text or any(s[3] != (" " + text).encode() for s in sides):
            found.append(None)
            continue
        groups, i, j = [], 0, 0
        for cut in sorted(set(sides[0][2]) & set(sides[1][2])):
            x, y = i, j
            while i < len(a) and sides[0][2][i] <= cut:
                i += 1
            while j < len(b) and sides[1][2][j] <= cut:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        links, j = [], 0
        for i, (start, end) in enumerate(zip(sides[0][1], sides[0][2], strict=True)):
            while sides[1][2][j] <= start:
                j += 1
            k = j
            while k < len(b) and sides[1][1][k] < end:
                links.append((a[i], b[k]))
                k += 1
        counts.update(set(links))
        found.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for row in found:
        if row is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            links = row[3]
            out.append((*row[:3], len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), row[4]))
    return out


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def align_texts():
    rng = random.Random(1)
    rows = [
        (1, None), (2, ""), (3, " "), (4, "a▁b"), (5, "<|endoftext|> </s> x"), (6, "word " * 15000), (6, "word " * 15000), (7, "🙂é字한\x00\t\n  b   c "),
        (8, "x" * 70000), (9, " lead"), (None, "no id at all"), (10, "ab " * 25000 + "end"), (11, "¼½ Ⅷ ﬁ ̀x"), (12, " \x85 　 a"),
    ]
    return rows + [(100 + i, "".join(rng.choice("abcdeéßΣİ '!.,-09\n\t字한🙂<|>the and ") for _ in range(rng.randrange(80)))) for i in range(200)]


@pytest.mark.parametrize("frequent", [1 << 17, 40, 1])
def test_alignment_equals_brute_force(spark, tokenizers, monkeypatch, frequent):
    monkeypatch.setattr(alignment, "FREQUENT", frequent)  # with 1 and 40 links, the rest meet their counts in the join
    rows = align_texts()
    df = spark.createDataFrame([(i, t, "x", 3) for i, t in rows], "doc_id long, text string, link_ids string, n int").repartition(5)
    found = sorted((tuple(r[c] for c in COLUMNS) for r in alignment.align_corpus(df, A_PATH, B_PATH).collect()), key=repr)
    want = [(i, *w) for (i, _), w in zip(rows, brute_alignment([t for _, t in rows], tokenizers), strict=True)]
    assert found == sorted(want, key=repr)
    assert alignment.align_corpus(df.where("1 = 0"), A_PATH, B_PATH).count() == 0


def test_groups_partition_the_tokens(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(30)
    for row in alignment.align_column(df, A_PATH, B_PATH).collect():
        assert row.a_cuts == sorted(set(row.a_cuts)) and row.b_cuts == sorted(set(row.b_cuts))
        assert (row.a_cuts[-1], row.b_cuts[-1], len(row.a_cuts)) == (row.n_a, row.n_b, row.n_groups)
        assert row.n_links == row.n_a + row.n_b - row.n_groups == sum(row.link_times)


def test_every_character_is_encoded_as_by_the_library(tokenizers):
    worker = alignment.Aligner(A_PATH, B_PATH)
    texts = [f" a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000][::7]
    want = [e.ids for e in tokenizers[0].encode_batch(texts, add_special_tokens=False)]
    assert [worker._a.encode_ordinary(t) for t in texts] == want


def test_long_texts_are_cut_where_nothing_spans(tokenizers):
    worker, rng = alignment.Aligner(A_PATH, B_PATH), random.Random(4)
    text = " ".join("".join(rng.choice("abc'é.🙂") for _ in range(rng.randrange(1, 9))) for _ in range(40000))
    assert len(worker.parts(" " + text)) > 2
    a, b = worker.encode([text])
    assert a[0] == tokenizers[0].encode(" " + text, add_special_tokens=False).ids
    assert b[0] == tokenizers[1].encode(text)


# -- 12: whitening -------------------------------------------------------------------------------------


@pytest.mark.parametrize("size", [1, 2, 7, 8, 20, 40])
@pytest.mark.parametrize("kind", ["random", "equal", "steps", "falling", "flat"])
def test_components_equal_dense_eigenvectors(size, kind):
    rng = np.random.default_rng(size)
    turn, _ = np.linalg.qr(rng.standard_normal((size, size)))
    values = {
        "random": rng.random(size) * 100, "equal": np.full(size, 3.0), "steps": np.r_[np.full(min(size, 9), 5.0), np.ones(max(0, size - 9))],
        "falling": np.logspace(0, -12, size), "flat": np.r_[rng.random(min(size, 3)), np.zeros(max(0, size - 3))],
    }[kind]
    matrix = (turn * values) @ turn.T
    matrix = (matrix + matrix.T) / 2
    found, vectors = whitening.contour_components(matrix, 8)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    assert np.abs(found - want).max() < 1e-13 * values.max()
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-12 * values.max()
    assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-12
    for bound in (values.min() - 0.01, float(np.median(values)) + 1e-3, values.max() + 0.01):
        assert whitening.count_above(matrix, bound) == (np.linalg.eigvalsh(matrix) > bound).sum()


def check_whitening(rows, vectors):
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    assert {r.n for r in rows} == {n}
    centred = x - total / n
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1][:8]
    assert max(r.identity_error for r in rows) < 1e-9 and len({r.identity_error for r in rows}) == 1
    whitened = np.array([r.whitened for r in rows]).reshape(n, -1)
    assert np.abs(whitened.T @ whitened / n - np.eye(whitened.shape[1])).max() < 1e-9
    # The projections explain what the components say, whatever their signs.
    explained = np.array([r.explained for r in rows]).reshape(n, -1)[0]
    assert np.allclose(explained, values / np.trace(covariance), rtol=1e-9)
    directions = np.linalg.lstsq(centred, whitened * np.sqrt(values), rcond=None)[0]
    assert np.abs(covariance @ directions - directions * values).max() < 1e-6 * values[0]
    deviations = [int(r.deviation) for r in rows[:: whitened.shape[1]]]
    assert deviations == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, total, strict=True)) for v in x]


def test_whitening_equals_dense_arithmetic(spark):
    rng = np.random.default_rng(5)
    good = [[float(v) for v in np.float32(row)] for row in rng.standard_normal((700, 12)) * np.linspace(1, 6, 12)]
    bad = [(None,), ([None] + good[0][1:],), ([float("nan")] + good[0][1:],), ([float("inf")] + good[0][1:],), ([],)]
    rows = [(i, v, 1, "x") for i, v in enumerate(good)] + [(9000 + i, b[0], 2, "y") for i, b in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, _x int, component string").repartition(4)
    found = sorted(whitening.whiten(df).collect(), key=lambda r: (r.vec_id, r.component))
    assert len(found) == 700 * 8
    check_whitening(found, good)


def test_whitening_of_few_dimensions_large_entries_and_none(spark):
    def run(rows):
        return sorted(whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect(), key=lambda r: (repr(r.vec_id), r.component))

    small = [[1.0, 5.0], [2.0, 4.0], [4.0, -4.0], [4.0, -4.0]]
    check_whitening(run(list(zip([1, 2, 3, 4], small, strict=True))), small)
    assert {r.vec_id for r in run([(None, [1.0]), (2, [3.0])])} == {None, 2}
    huge = run([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 2.0])])  # held at the bound of 62 bits
    assert len(huge) == 6 and all(r.deviation is None or r.deviation >= 0 for r in huge)
    flat = run([(1, [2.0, 7.0]), (2, [2.0, 7.0])])  # without variance
    assert [(r.whitened, r.explained, r.identity_error) for r in flat] == [(None, 0.0, 0.0)] * 4
    assert run([(1, None), (2, [])]) == []
    with pytest.raises(ValueError):
        run([(1, [1.0]), (2, [1.0, 2.0])])


# -- 13: repeats ---------------------------------------------------------------------------------------


def brute_repeats(rows, size=13):
    lists = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    low, first = (lambda i: -(1 << 63) if i is None else i), {}
    for (i, _), words in zip(rows, lists, strict=True):
        for p in range(len(words) - size + 1):
            window = tuple(words[p:p + size])
            first[window] = min(first.get(window, 1 << 70), low(i))
    out = []
    for (i, _), words in zip(rows, lists, strict=True):
        gone = set()
        for p in range(len(words) - size + 1):
            if first[tuple(words[p:p + size])] < low(i):
                gone.update(range(p, p + size))
        out.append((i, len(words), len(gone), " ".join(w for n, w in enumerate(words) if n not in gone)))
    return sorted(out, key=repr)


def repeated_rows():
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(12)]

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages, rows = [words(rng.randrange(13, 60)) for _ in range(6)], []
    for i in range(400):
        text = []
        for _ in range(rng.randrange(6)):
            text += words(rng.randrange(30)) if rng.random() < 0.5 else rng.choice(passages)[rng.randrange(4):]
        rows.append((rng.randrange(380) if i % 9 else i, (" ".join(text) if i % 3 else "\t".join(text) + "\n")))
    rows += [(None, " ".join(passages[0])), (None, " ".join(passages[1])), (500, None), (501, ""), (502, "a " * 3000), (503, "a " * 2000 + "b"), (503, "a " * 2000 + "b")]
    return [*rows, (504, " ".join(passages[2] * 3)), (7, rows[50][1]), (505, "é ü " * 30), (506, "é ü " * 14)]


@pytest.mark.parametrize("most", [1 << 14, 20, 0])
def test_repeats_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(repeats, "MOST_SUFFIXES", most)  # with fewer, frequent prefixes are extended to whole windows
    rows = repeated_rows()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, _text string, _k int").repartition(5)
    found = repeats.drop_repeats(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found), key=repr) == brute_repeats(rows)
    assert all(sum(r.span_words) == r.n_removed and len(r.span_starts) == len(r.span_words) for r in found)
    assert repeats.drop_repeats(df.where("1 = 0")).count() == 0


@pytest.mark.parametrize("size", [7, 8, 20])
def test_repeats_of_other_lengths(spark, size):
    rows = repeated_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in repeats.drop_repeats(df, min_words=size).collect()), key=repr)
    assert found == brute_repeats(rows, size)


def test_deep_nodes_are_runs_of_equal_prefixes():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 3, 4000)
    starts = np.arange(4000 - 12)
    order, nodes = repeats.deep_nodes(ids, starts, 13)
    found = {frozenset(starts[part].tolist()) for part in np.split(order, nodes[1:])}
    groups = defaultdict(set)
    for s in starts.tolist():
        groups[tuple(ids[s:s + 13].tolist())].add(s)
    assert found == {frozenset(g) for g in groups.values()}


def test_registered_columns(spark):
    assert queries.op11_token_alignment(spark, SF).columns == list(COLUMNS)
    assert queries.op12_whitening(spark, SF).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(queries.op12_whitening(spark, SF).dtypes)["deviation"] == "bigint"
    kept = queries.op13_substring_dedup(spark, SF)
    assert kept.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert kept.agg(F.sum("n_removed")).first()[0] > 0
