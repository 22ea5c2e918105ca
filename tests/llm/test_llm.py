"""The numbered operators against libraries, brute force and SQL, and on awkward input."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from worktide.llm import ann, bpe, chosen_path, fingerprints, language, licenses, lines, packing, queries, toxicity, url_rules

PATH = public_tokenizers.path("word_bpe_49k.json")
SPACE = "[\x20\x09-\x0d]+"
AWKWARD = [
    (1, None), (2, ""), (3, " \t\n "), (4, "The Σ of ÉTÉ don't 12!!\x1c\x85a"), (5, "same text here"), (6, "same  text\there"), (6, "same  text\there"),
    (7, "x" * 300), (8, "<|endoftext|>a<|startoftext|>"), (9, "word " * 9000), (10, "\n\n"), (11, "é" * 70), (12, "🙂!?" * 50), (None, "no id at all"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in AWKWARD], "doc_id long, text string, _text string, _k int, n int")


@pytest.fixture(scope="module")
def empty(awkward):
    return awkward.where("1 = 0")


def of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


# -- 1: encoding ---------------------------------------------------------------------------------------


def test_encode_equals_library(spark, awkward, empty):
    library = Tokenizer.from_file(PATH)
    ids = bpe.encode_column(awkward, PATH, keep=("doc_id", "_k"))
    for row in bpe.decode_column(ids, PATH).collect():
        text = dict(AWKWARD)[row.doc_id] or ""
        want = library.encode(text, add_special_tokens=False).ids
        assert row.ids == want
        assert row.decoded == library.decode(want, skip_special_tokens=False)
    assert bpe.encode_column(empty, PATH).count() == 0


def test_encode_random_texts():
    library, own, rng = Tokenizer.from_file(PATH), bpe.WordBpe.load(PATH), random.Random(3)
    for _ in range(600):
        text = "".join(rng.choice("abcdeéßΣİ '!.,-09\n\t字한🙂<|>") for _ in range(rng.randrange(60)))
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    for text in ("a" * 3000, "!?" * 900, "the" * 40, "ab" * 33):  # the heap form
        assert own.encode(text) == library.encode(text, add_special_tokens=False).ids


# -- 2: near copies ------------------------------------------------------------------------------------


def shingle_set(text):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_components(rows, percent):
    sets = [(i, shingle_set(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_shingle = defaultdict(list)
    for n, (i, s) in enumerate(sets):
        if i is None:
            continue
        for other in {m for g in s for m in by_shingle[g]}:
            o = sets[other][1]
            if 100 * len(s & o) >= percent * len(s | o):
                a, b = root(n), root(other)
                parent[max(a, b)] = min(a, b)
        for g in s:
            by_shingle[g].append(n)
    low = {}
    for n, (i, _) in enumerate(sets):
        if i is not None:
            low[root(n)] = min(i, low.get(root(n), i))
    return {i: (len(s), low[root(n)]) for n, (i, s) in enumerate(sets) if i is not None}


def test_near_copies_equal_brute_force(spark):
    """A large node of near copies, a passage that many share, chains, and exact copies."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    base, passage, rows = [word() for _ in range(70)], " ".join(word() for _ in range(25)), []
    for i in range(900):
        if i % 2:
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(70)] = word()
            rows.append((i, " ".join(copy)))
        else:
            rows.append((i, passage + " " + " ".join(word() for _ in range(rng.randrange(3, 60)))))
    chain = [word() for _ in range(80)]
    for i in range(900, 960):
        chain = chain[1:] + [word()]
        rows += [(i, " ".join(chain)), (i + 100, " ".join(chain).upper())]
    got = chosen_path.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute_components(rows, 85)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


@pytest.mark.parametrize("percent", [40, 60, 80])
def test_near_copies_at_lower_thresholds(spark, percent):
    """Pairs just at the threshold, and a large node of them, at thresholds other than the default."""
    rng, rows = random.Random(percent), []
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    same = next(n for n in range(204) if 100 * n >= percent * (400 - n))  # of 200 shingles each
    for i in range(300):
        first = [word() for _ in range(204)]
        rows += [(2 * i, " ".join(first)), (2 * i + 1, " ".join(first[:same + 4] + [word() for _ in range(200 - same)]))]
    base = [word() for _ in range(204)]
    rows += [(1000 + i, " ".join(base[:same + 4] + [word() for _ in range(200 - same)])) for i in range(450)]
    got = chosen_path.components(spark.createDataFrame(rows, "doc_id long, text string"), percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, percent)


def test_sizes_follow_from_the_threshold():
    assert chosen_path.shape(85) == (8, 64, 2, 39) and chosen_path.shape(80) == (10, 64, 2, 34)
    for percent in (1, 5, 30, 50, 70, 99):
        trees, tokens, branches, agree = chosen_path.shape(percent)
        assert (1 - percent / 100) ** trees <= 3e-7 and tokens >= trees and branches * percent >= 150 and 0 <= agree <= tokens
    assert chosen_path.shape(100).agree == 64


def test_near_copies_of_given_table(spark):
    got = queries.op2_near_dedup(spark, SF).collect()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows, 85)


def test_near_copies_of_awkward_rows(awkward, empty):
    got = chosen_path.components(awkward).collect()
    assert len(got) == len(AWKWARD)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert found[1] == (0, 1) and found[3] == (0, 3) and found[5] == (1, 5) and found[6] == (1, 5)
    assert found[None][1] is None
    assert chosen_path.components(empty).count() == 0
    assert chosen_path.drop_near_copies(awkward).columns == awkward.columns


# -- 3: exact copies -----------------------------------------------------------------------------------


@pytest.mark.parametrize("chunk", [4, 1 << 16])
def test_exact_groups(spark, awkward, empty, chunk):
    by_text = defaultdict(list)
    for i, t in AWKWARD:
        by_text[re.sub(SPACE, " ", t or "")].append(i)
    want = []
    for text, ids in by_text.items():
        keep = min((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), i == keep, hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    rows = awkward.where("doc_id <> 9 OR doc_id IS NULL") if chunk == 4 else awkward
    got = of(fingerprints.exact_groups(rows, chunk_bytes=chunk), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert got == sorted((w for w in want if chunk > 4 or w[0] != 9), key=repr)
    assert fingerprints.exact_groups(empty).count() == 0


def test_one_key_with_two_texts(spark):
    """Each row is decided by its key and text; of equal rows one stays, and rows without a key all do."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (3, c), (3, c), (3, c.replace(" ", "  ")), (4, a + " more"), (4, b.replace("b30", "x")), (None, c), (None, c)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    exact = fingerprints.drop_copies(df)
    squeezed = lambda found: sorted(((r.doc_id, re.sub(SPACE, " ", r.text)) for r in found.collect()), key=repr)
    want = [(1, a), (2, b), (3, c), (4, a + " more"), (4, b.replace("b30", "x")), (None, c), (None, c)]
    assert squeezed(exact) == sorted(want, key=repr) and exact.columns == df.columns
    near = [(1, a), (2, b), (3, c), (None, c), (None, c)]
    assert squeezed(chosen_path.drop_near_copies(exact)) == sorted(near, key=repr)


def test_chunk_hashes_compose():
    powers, data = fingerprints._Powers(1000), bytes(range(256)) * 3
    whole = powers.hash(data, 0)
    parts = [powers.hash(data[:500], 268), powers.hash(data[500:], 0)]
    assert whole == [(a + b) % p for a, b, p in zip(*parts, fingerprints.PRIMES)]


def test_equal_fingerprints_of_other_texts_are_told_apart(spark, monkeypatch):
    """With hashes that always collide, the chunkwise comparison alone decides."""
    monkeypatch.setattr(fingerprints, "_differing", lambda df, pairs, *rest: pairs.select(F.col("_id").alias("_k")))
    rows = spark.createDataFrame([(1, "aa"), (2, "aa"), (3, "aa"), (4, "bb")], "doc_id long, text string")
    assert of(fingerprints.exact_groups(rows), "doc_id", "keep_id", "group_size") == [(1, 1, 1), (2, 2, 2), (3, 2, 2), (4, 4, 1)]


def test_comparison_finds_what_differs(spark):
    rows = spark.createDataFrame([(1, "abcdefgh"), (2, "abcdefgX"), (3, "abcdefgh"), (4, "abcd")], "doc_id long, text string")
    pairs = spark.createDataFrame([(2, 1), (3, 1), (4, 1)], "_id long, _keep long")
    assert of(fingerprints._differing(rows, pairs, "doc_id", "text", 3), "_k") == [(2,), (4,)]


# -- 4: packing ----------------------------------------------------------------------------------------


def check_packing(rows, capacity):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_packing(spark, awkward, empty):
    rows = packing.pack(awkward, PATH, capacity=64).collect()
    library = Tokenizer.from_file(PATH)
    want = Counter()
    for i, t in AWKWARD:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for n, start in enumerate(range(0, len(ids), 64)):
            part = np.array(ids[start:start + 64], "<u4")
            want[i, n, start, len(part), zlib.crc32(part.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert check_packing(rows, 64) <= -(-sum(r.length for r in rows) // 64) + 1
    assert packing.pack(empty, PATH).count() == 0


def test_packing_of_given_table_is_tight(spark):
    rows = queries.op4_pack(spark, SF).collect()
    assert check_packing(rows, 4096) == -(-sum(r.length for r in rows) // 4096)


def test_plan_places_every_rank():
    rng = np.random.default_rng(1)
    counts = Counter(rng.integers(1, 101, 5000).tolist())
    found = packing.plan(counts, 100)
    length = np.repeat(list(counts), list(counts.values()))
    rank = np.concatenate([np.arange(n) for n in counts.values()])
    sequence, offset = found.place(length, rank)
    order = np.lexsort((offset, sequence))
    ends = (offset + length)[order]
    assert ends.max() <= 100 and len(np.unique(sequence)) == found.sequences
    first = np.append(True, sequence[order][1:] != sequence[order][:-1])
    assert (offset[order] == np.where(first, 0, np.append(0, ends[:-1]))).all()


# -- 5: language ---------------------------------------------------------------------------------------


def test_language(spark, awkward, empty):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    found = queries.op5_language(spark, SF.replace("0.001", "0.01")).join(docs, "doc_id")
    held = found.where("held_out").select("lang", "lang_pred").collect()
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.95
    model = language.learn(docs, "doc_id", "text", "lang")
    rows = {r.doc_id: r for r in language.identify(awkward, model).collect()}
    assert rows[1].lang_pred == rows[2].lang_pred == rows[10].lang_pred == rows[12].lang_pred == "und"
    assert all(0 <= r.lang_score <= 1 and (r.lang_pred == "und") <= r.lang_rejected for r in rows.values())
    assert language.identify(empty, model).count() == 0
    nothing = language.learn(docs.where("1 = 0"), "doc_id", "text", "lang")
    assert {r.lang_pred for r in language.identify(awkward, nothing).collect()} == {"und"}


def test_narrow_margins_are_rejected(spark):
    model = language.Dictionaries({"a": b" alpha beta gamma delta " * 4, "b": b" uno dos tres cuatro " * 4})
    rows = spark.createDataFrame([(1, "alpha beta gamma delta alpha beta"), (2, "zzz qqq xxx")], "id int, text string")
    got = {r.id: r for r in language.identify(rows, model, min_margin=0.05, min_bytes=1).collect()}
    assert got[1].lang_pred == "a" and not got[1].lang_rejected and got[2].lang_rejected


def long_texts(docs, sizes):
    """(language, size): distinct texts of one language joined, and repeated where they are not enough."""
    out = {}
    for lang in ("de", "en"):
        texts = sorted({r.text for r in docs.where(F.col("lang") == lang).select("text").collect() if r.text})
        random.Random(1).shuffle(texts)
        every = " ".join(texts)
        out |= {(lang, n): (every * (n // len(every) + 1))[:n] for n in sizes}
    return out


def test_blocks_hold_the_whole_text():
    for data in (b"", b"a" * 100_001, b" ab" * 40_000, b" " + b"x" * 70_000 + b" y " * 9):
        parts = list(language.blocks(data))
        assert b"".join(parts) == data and max(map(len, parts)) <= language.BLOCK_BYTES


def test_language_of_very_long_texts(spark):
    """The margin does not fall with the length: all parts of a text are judged with the dictionary."""
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.1')}/documents.parquet")
    model = language.learn(docs, "doc_id", "text", "lang")
    rows = [(lang, n, t) for (lang, n), t in long_texts(docs, (500_000, 5_000_000, 20_000_000)).items()]
    df = spark.createDataFrame(rows, "lang string, n int, text string").repartition(6)
    got = {(r.lang, r.n): r for r in language.identify(df, model, min_margin=0.0004, min_bytes=400).drop("text").collect()}
    assert len(got) == 6
    for (lang, _), r in got.items():
        assert r.lang_pred == lang and not r.lang_rejected and r.lang_margin > 0.5 * got[lang, 500_000].lang_margin


# -- 6: neighbours -------------------------------------------------------------------------------------


def test_neighbours_recall(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(30, 48))
    points = (centers[rng.integers(0, 30, 3000)] + 0.4 * rng.normal(size=(3000, 48))).tolist()
    rows = spark.createDataFrame(list(enumerate(points)), "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(rows, rows.where("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    x, hits = np.array(points), 0
    for q, found in got.items():
        far = np.sqrt(((x - x[q]) ** 2).sum(1))
        far[q] = np.inf
        assert len(found) == 10 and all(abs(far[i] - s) < 1e-12 for i, s in found)
        assert found == sorted(found, key=lambda p: (p[1], p[0]))
        hits += len({i for i, _ in found} & set(np.argsort(far)[:10].tolist()))
    assert len(got) == 30 and hits / 300 >= 0.9


def test_neighbours_of_awkward_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [1.0, 3.0]), (100, [1.0, 3.0]), (101, None), (102, [0.0, 0.0]), (103, [float("nan"), 1.0]), (104, [None, 1.0]), (105, [1.0]), (None, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.nearest(vectors, vectors.where("vec_id IN (0, 39, 100, 101, 102)"), k=3)
    assert of(found, "query_id", "rank", "vec_id") == sorted([(0, 1, 1), (0, 2, 2), (0, 3, 3), (39, 1, 0), (39, 2, 1), (39, 3, 2), (100, 1, 0), (100, 2, 1), (100, 3, 2)], key=repr)
    assert ann.nearest(vectors.where("1 = 0"), vectors).count() == 0
    assert ann.nearest(vectors.where("vec_id = 100"), vectors.where("vec_id = 100")).count() == 0


# -- 7: URLs -------------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = [
        ("http://a.ORG/x?y", "a.org", "/x", "org/", "allow"), ("http://www.example.org/es/1", "www.example.org", "/es/1", "example.org/es/", "block"),
        ("https://example.org/en/12#t", "example.org", "/en/12", "example.org/en/1", "block"), ("https://b.com/fr/", "b.com", "/fr/", "com/fr/", "allow"),
        ("https://com/de/1", "com", "/de/1", "com/de/", "block"), ("https://xcom/de/1", "xcom", "/de/1", None, None), ("https://b.com?/fr/", "b.com", "", None, None),
        ("no url", "", "", None, None), (None, "", "", None, None), ("", "", "", None, None), ("://h/p://q", "h", "/p://q", None, None),
    ]
    rows = spark.createDataFrame([(i, u[0], "x") for i, u in enumerate(urls)], "page_id long, url string, _url string")
    got = {r.page_id: r for r in url_rules.judge(rows, queries.URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert url_rules.judge(rows.where("1 = 0"), queries.URL_RULES).count() == 0


def test_mined_rules_decide_like_brute_force(spark):
    pages = [(i, f"http://h{i % 3}.net/{'spam' if i % 2 else 'good'}/{i}") for i in range(60)]
    rules = [("h0.net", "/spam", "block"), ("h0.net", "/good", "allow"), ("h1.net", "/spam", "block"), ("h1.net", "/good", "allow")]
    rows = spark.createDataFrame(pages, "page_id long, url string")
    for r in url_rules.judge(rows, rules).collect():
        assert r.verdict == ("block" if r.page_id % 2 else "allow")
        assert (r.rule is None) == (r.page_id % 3 == 2)


def test_every_mined_rule_is_tried(spark, monkeypatch):
    """The weakest of 6000 rules decides the URL that no other fits."""
    rules = spark.createDataFrame([([f"path=a{i}"], "allow", 1.0, 0.5) for i in range(6000)] + [(["path=rare"], "block", 0.7, 0.02)], "antecedent array<string>, verdict string, confidence double, support double")
    monkeypatch.setattr(url_rules, "mine", lambda *rest: rules)
    rows = spark.createDataFrame([(1, "http://h.net/rare"), (2, "http://h.net/a7"), (3, "http://h.net/b")], "page_id long, url string")
    assert of(url_rules.judge(rows, queries.URL_RULES), "page_id", "verdict", "confidence") == [(1, "block", 0.7), (2, "allow", 1.0), (3, "allow", None)]


# -- 8: toxicity ---------------------------------------------------------------------------------------


def test_gradients_are_right():
    rng = np.random.default_rng(2)
    h = toxicity.HIDDEN
    w = {k: rng.normal(size=s) * 0.5 for k, s in {"recur": (2, h, 3 * h), "attend": (2 * h, toxicity.ATTEND), "attend_bias": (toxicity.ATTEND,), "query": (toxicity.ATTEND,), "out": (2 * h,), "out_bias": (1,)}.items()}
    x, mask = rng.normal(size=(3, 5, 6 * h)), np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], bool)
    push = np.array([0.3, -0.7, 0.5])
    toxicity_f4, toxicity.F4 = toxicity.F4, np.float64
    try:
        loss = lambda: float((toxicity.forward(x, mask, w)[0] * push).sum())
        g, d_x = toxicity.backward(push, toxicity.forward(x, mask, w, keep=True)[1], mask, w)
        for name, array, grad in [*((k, w[k], g[k]) for k in w), ("x", x, d_x)]:
            for _ in range(6):
                at = tuple(int(rng.integers(n)) for n in array.shape)
                old, eps = array[at], 1e-5
                array[at] = old + eps
                up = loss()
                array[at] = old - eps
                down = loss()
                array[at] = old
                assert abs((up - down) / (2 * eps) - grad[at]) < 1e-4, name
    finally:
        toxicity.F4 = toxicity_f4


def test_windows_cover_every_word():
    sizes = [0, 1, 48, 49, 200]
    index, owner = toxicity.windows(np.arange(1, sum(sizes) + 1, dtype=np.int32), sizes)
    assert set(owner) == {0, 1, 2, 3, 4}
    assert set(index[index > 0]) == set(range(1, sum(sizes) + 1))


def test_toxicity_on_held_out_documents(spark, awkward, empty):
    folder = SF.replace("0.001", "0.1")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.learn(docs, labels.where(~held))
    found = toxicity.score(docs.join(labels.where(held), "doc_id"), model).select("toxic", "toxicity").collect()
    caught = [r.toxicity >= 0.5 for r in found if r.toxic == 1]
    blamed = [r.toxicity >= 0.5 for r in found if r.toxic == 0]
    assert sum(caught) / len(caught) > 0.8 and sum(blamed) / len(blamed) < 0.06
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.score(empty, model).count() == 0
    nothing = toxicity.learn(docs, labels.where("1 = 0"))
    assert {r.toxicity for r in toxicity.score(awkward, nothing).collect()} == {0.0}


# -- 9: lines ------------------------------------------------------------------------------------------


def brute_lines(rows, least):
    held = defaultdict(set)
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[key(x)].add(i)
    out = []
    for i, t in rows:
        whole = (t or "").split("\n")
        kept = [x for x in whole if not (len(key(x)) >= least and len(held[key(x)]) >= 3 and i != max(held[key(x)]))]
        out.append((i, len(whole), len(whole) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("slots", [1, 3, 16])
def test_lines(spark, slots):
    rng = random.Random(slots)
    pool = ["Hot Line", "hot line ", "\tHOT LINE", "rare", "two", "", "Ünïcode", "ünïcode", *(f"line {i}" for i in range(30))]
    rows = [(i, "\n".join(rng.choice(pool[:3] if rng.random() < 0.5 else pool) for _ in range(rng.randrange(6)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "hot line\n" * 500), (203, "two\nonce only")]
    df = spark.createDataFrame([(*r, "y") for r in rows], "doc_id long, text string, _pos string")
    kept = lines.apply_bitmaps(df, lines.keep_bitmaps(df, min_length=4, slots=slots))
    got = of(kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("h")), "doc_id", "n_lines", "n_dropped", "h")
    assert got == brute_lines(rows, 4)


def test_lines_of_awkward_rows(awkward, empty):
    kept = lines.apply_bitmaps(awkward, lines.keep_bitmaps(awkward))
    assert kept.count() == len(AWKWARD) and lines.apply_bitmaps(empty, lines.keep_bitmaps(empty)).count() == 0


# -- 10: licences --------------------------------------------------------------------------------------


def test_licenses(spark, awkward, empty):
    mit = dict((b, a) for a, b in licenses.KNOWN if "deal in" in b)
    text = next(iter(mit))
    rows = spark.createDataFrame([
        (1, "MIT stuff"), (2, "Copyright (c) 2020 Somebody\n\n" + text.upper().replace("SUBLICENSE", "sub-licence").replace(",", " ,")), (3, "hello\nReleased under  the MIT licence!\nbye\nLICENSED UNDER CC BY-NC 4.0"),
    ], "doc_id long, text string")
    assert of(licenses.scan(rows), "doc_id", "license_id", "n_license_lines", "line_licenses") == [(1, None, 0, ""), (2, "MIT", 0, ""), (3, None, 2, "CC-BY-NC-4.0,MIT")]
    assert licenses.scan(awkward).count() == len(AWKWARD) and licenses.scan(empty).count() == 0


# -- SQL and the pipeline ------------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(queries.ORACLES[name])
    columns = sorted(c[0] for c in want.description)
    got = queries.QUERIES[name](spark, SF)
    assert sorted(got.columns) == columns
    frame = want.df()[columns].astype(object)
    assert of(got, *columns) == sorted((tuple(None if x is None or x != x else x for x in r) for r in frame.itertuples(index=False, name=None)), key=repr)


def test_pipeline_keeps_very_long_documents(spark):
    """Clean documents of 5 to 20 MB pass the language stage; texts without letters do not."""
    import corpus_pipeline

    folder = SF.replace("0.001", "0.1")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = long_texts(docs, (5_000_000, 20_000_000))
    added = [(-1 - i, t, lang, None, n) for i, ((lang, n), t) in enumerate(texts.items())] + [(-9, "12 34 !!" * 100, "en", None, 0)]
    docs = docs.unionByName(spark.createDataFrame(added, docs.schema).repartition(5))
    kept = corpus_pipeline.known_language(spark, docs, folder).where("doc_id < 0").select("doc_id").collect()
    assert {r.doc_id for r in kept} == {-1 - i for i in range(len(texts))}


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(docs.limit(0)).unionByName(spark.createDataFrame([(-1, None, None, None, 0), (-2, "12 34 !!", "en", None, 0)], docs.schema))
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.columns
        out = stage(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.select("doc_id").distinct().count())
        assert name == "pack" or docs.columns == before
    assert kept == sorted(kept, reverse=True) and kept[3] == kept[4]
    texts = [tuple(r) for r in spark.read.parquet(str(tmp_path / "toxicity")).select("doc_id", "text").collect()]
    first = {}
    for i, t in sorted(texts):
        first.setdefault(re.sub(SPACE, " ", t or ""), i)
    exact = spark.read.parquet(str(tmp_path / "exact_dedup"))
    assert {r.doc_id for r in exact.collect()} == set(first.values())
    near = brute_components([(r.doc_id, r.text) for r in exact.collect()], 80)
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "near_dedup")).collect()} == {i for i, (_, c) in near.items() if i == c}
    check_packing(docs.collect(), 4096)


def test_toxicity_trains_in_little_memory():
    """One string per word and places of a few windows at a time: the driver holds little beside the texts."""
    import tracemalloc

    from worktide.llm import toxicity

    rows = np.random.default_rng(1).integers(1, 50, 4_000_000).astype(np.int32)
    tracemalloc.start()
    index, owner = toxicity.windows(rows, [4_000_000])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert index.dtype == np.int32 and len(index) == len(owner)
    assert (index[1] == rows[toxicity.STRIDE:toxicity.STRIDE + toxicity.WINDOW]).all()
    assert peak < 2.5 * index.nbytes


def test_pipeline_judges_the_language_of_short_documents(spark):
    """A text of a word that no language holds goes at any length, a short one that fits one language stays; a missing language is filled in."""
    import corpus_pipeline

    base = {"en": "the house and the garden of this street were quiet", "de": "das haus und der garten dieser strasse waren ruhig"}
    rows = [(i, f"{base[lang]} {word} {i}", lang) for i in range(40) for lang, word in (("en", "weather"), ("de", "wetter"))]
    short = [(-1, "xq.", "en"), (-2, "the house and the garden", "en"), (-3, "das haus und der garten", None), (-4, "!!", "de")]
    docs = spark.createDataFrame(rows + short, "doc_id long, text string, lang string")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, docs, SF).where("doc_id < 0").collect()}
    assert kept == {-2: "en", -3: "de"}
