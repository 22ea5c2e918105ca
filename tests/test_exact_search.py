"""Inverted lists, cells and pivots against brute force, with limits small enough that every path is taken."""

from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from worktide.operators import matching, metric, postings


def found(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


# -- inverted lists ------------------------------------------------------------------------------------


def sparse_rows(n, terms, rng, most):
    out = {}
    for key in range(n):
        chosen = rng.choice(terms, size=rng.integers(0, most), replace=False, p=np.arange(terms, 0, -1) / (terms * (terms + 1) / 2))
        out[key] = {f"t{t}": float(rng.integers(1, 5)) / 4 for t in chosen}
    return out


@pytest.mark.parametrize(("part", "k"), [(1 << 15, 3), (4, 3), (4, 50)])
def test_sparse_top_k_equals_all_products(spark, monkeypatch, part, k):
    monkeypatch.setattr(postings, "LIST_PART", part)
    rng = np.random.default_rng(11)
    queries, docs = sparse_rows(40, 60, rng, 14), sparse_rows(150, 60, rng, 20)
    queries[40] = queries[3]  # equal queries
    docs[150] = docs[7]  # ties
    want = []
    for q, mine in queries.items():
        scores = [(d, round(sum(w * theirs.get(t, 0) for t, w in mine.items()), 6)) for d, theirs in docs.items()]
        want += [(q, d, s) for d, s in sorted((x for x in scores if x[1] > 0), key=lambda x: (-x[1], x[0]))[:k]]

    def frame(rows, name):
        flat = [(key, t, w) for key, row in rows.items() for t, w in row.items()] + [(None, "t1", 1.0), (5, None, 1.0), (6, "t_zero", 0.0)]
        return spark.createDataFrame(flat, f"{name} int, term string, weight double")

    got = postings.sparse_top_k(frame(queries, "q"), "q", frame(docs, "d"), "d", k)
    assert [(q, d, round(s, 6)) for q, d, s in found(got, "q", "d", "score")] == sorted(want)
    none = postings.sparse_top_k(frame({}, "q"), "q", frame(docs, "d").limit(0), "d", k)
    assert none.count() == 0


def test_weak_terms_are_not_joined(spark):
    """A frequent term of small weight brings in no documents once the rare term has named enough."""
    docs = spark.createDataFrame([(d, "common", 0.1) for d in range(500)] + [(d, "rare", 0.9) for d in range(10)], "d int, term string, weight double")
    query = spark.createDataFrame([(1, "common", 0.1), (1, "rare", 0.9)], "q int, term string, weight double")
    assert found(postings.sparse_top_k(query, "q", docs, "d", 3), "d", "score") == [(0, 0.82), (1, 0.82), (2, 0.82)]


def test_zero_scores_fill_up(spark):
    some = spark.createDataFrame([(1, 4, 0.5), (2, 0, 0.25)], "q int, d int, score double")
    queries = spark.createDataFrame([(1,), (2,), (3,)], "q int")
    docs = spark.createDataFrame([(i,) for i in range(6)], "d int")
    got = found(postings.fill_with_zeros(some, queries, "q", docs, "d", 2), "q", "d", "score")
    assert got == [(1, 0, 0.0), (1, 4, 0.5), (2, 0, 0.25), (2, 1, 0.0), (3, 0, 0.0), (3, 1, 0.0)]


# -- cells ---------------------------------------------------------------------------------------------


def test_candidates_equal_the_filter_over_all_pairs(spark):
    rng = np.random.default_rng(4)

    def maybe(value, share=0.25):
        return None if rng.random() < share else value

    cvs = [(i, str(rng.choice(["explicit", "inferred", "default"])), maybe(float(rng.integers(0, 20)) / 2), maybe(str(rng.choice(["HN", "HCM", "DN"])))) for i in range(120)]
    jobs = [
        (i, maybe(str(rng.choice(["HN", "HCM", "DN"]))), maybe(float(rng.integers(0, 30))), maybe(float(rng.integers(0, 14)) - 1), str(rng.choice(["none", "fresher", "range"])), float(i % 7))
        for i in range(150)
    ]
    left = pd.DataFrame(cvs, columns=["cv", "source", "years", "location"]).astype({"years": float})
    right = pd.DataFrame(jobs, columns=["job", "location", "min_years", "max_years", "experience_type", "worth"]).astype({"min_years": float, "max_years": float})
    left["location"], right["location"] = (x["location"].astype(object).where(x["location"].notna(), None) for x in (left, right))
    ok = matching.payload_filter(left, right)
    worth = right["worth"].to_numpy()
    want = []
    for i in range(len(left)):
        fit = np.flatnonzero(ok[i])
        best = sorted(fit.tolist(), key=lambda j: (-worth[j], j))[:4]
        want += [(i, j, float(worth[j]), len(fit)) for j in best]
    df = spark.createDataFrame(cvs, "cv int, source string, years double, location string")
    posted = spark.createDataFrame(jobs, "job int, location string, min_years double, max_years double, experience_type string, worth double")
    got = matching.candidates(df, "cv", posted, "job", lambda lp, rp: np.broadcast_to(rp["worth"].to_numpy()[None, :], (len(lp), len(rp))), 4)
    assert found(got, "cv", "job", "score", "n_candidates") == sorted(want)


@pytest.mark.parametrize("ratio", [0.15, 0.5, 0.0])
def test_scored_pairs_equal_all_pairs(spark, ratio):
    rng = np.random.default_rng(8)
    names = [f"s{i}" for i in range(14)]

    def skills(most):
        return [str(s) for s in rng.choice(names, size=rng.integers(0, most), replace=False)]

    def row(i):
        return (i, skills(7), None if rng.random() < 0.1 else str(rng.integers(0, 4)), str(rng.integers(0, 2)), str(rng.integers(0, 3)))

    users = [(*row(i), float(rng.integers(0, 9))) for i in range(60)]
    jobs = [(*row(i), None if rng.random() < 0.2 else float(rng.integers(0, 8)), None if rng.random() < 0.3 else float(rng.integers(0, 10))) for i in range(90)]
    want = []
    for u in users:
        scored = []
        for j in jobs:
            share = len(set(u[1]) & set(j[1])) / len(set(j[1])) if j[1] else 0.0
            low = j[5] or 0.0
            total = 10 * share + 3 * (u[2] == j[2]) + (u[3] == j[3]) + (u[4] == j[4]) + 2 * (low <= u[5] <= (low + 2 if j[6] is None else j[6]))
            if total >= 2 and (u[2] == j[2] or share >= ratio):
                scored.append((j[0], round(total, 6)))
        want += [(u[0], j, s, len(scored)) for j, s in sorted(scored, key=lambda x: (-x[1], x[0]))[:5]]
    mine = spark.createDataFrame(users, "user_id int, skills array<string>, category string, work_form string, location string, years double")
    theirs = spark.createDataFrame(jobs, "job_key int, skills array<string>, category string, work_form string, location string, min_years double, max_years double")
    got = matching.score_pairs(mine, theirs, 5, min_ratio=ratio)
    assert found(got, "user_id", "job_key", "score", "n_scored") == sorted(want)


# -- pivots --------------------------------------------------------------------------------------------


def cloud(n=260, seed=3, noise=0.25):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 6))
    points = centres[rng.integers(0, 9, n)] + rng.normal(scale=noise, size=(n, 6))
    return points / np.linalg.norm(points, axis=1, keepdims=True)


def nodes(spark, units):
    return spark.createDataFrame([(i, u.tolist()) for i, u in enumerate(units)], "node long, _unit array<double>")


@pytest.mark.parametrize(("tau", "part"), [(0.9, 20), (0.97, 20), (0.5, 40), (0.9, 4096), (-1.0, 50)])
def test_leaders_and_groups_over_many_cells(spark, tau, part):
    units = cloud()
    near = np.round(units @ units.T, 9) >= tau
    leader = {}
    for i in range(len(units)):
        first = [j for j in np.flatnonzero(near[i, :i]) if leader[int(j)] == j]
        leader[i] = int(first[0]) if first else i
    label = list(range(len(units)))
    for _ in label:
        label = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(label))]
    df = nodes(spark, units)
    assert dict(found(metric.greedy_leaders(df, tau, part), "node", "leader")) == leader
    assert dict(found(metric.linked_components(df, tau, part), "node", "cluster")) == dict(enumerate(label))


def test_narrow_angles_visit_few_cells(spark):
    units = cloud(n=600, noise=0.05)
    df = nodes(spark, units)
    cells = metric.Cells(df, "node", 600, part=20)
    home = cells.home(df)
    visits = cells.visits(home, metric.widest_angle(0.99), "_far").count()
    assert 600 <= visits < 600 * len(cells.pivots) / 3


@pytest.mark.parametrize("operator", ["greedy_leaders", "linked_components"])
def test_wide_angles_send_no_vector_to_all_cells(spark, monkeypatch, operator):
    rng = np.random.default_rng(5)
    units = rng.normal(size=(400, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    sent, meet = [0], metric.Cells.meet

    def counted(cells, home, visitors, *rest):
        sent.append(visitors.count())
        return meet(cells, home, visitors, *rest)

    monkeypatch.setattr(metric.Cells, "meet", counted)
    got = dict(found(getattr(metric, operator)(nodes(spark, units), 0.5, 25), "node", "leader" if operator == "greedy_leaders" else "cluster"))
    near = np.round(units @ units.T, 9) >= 0.5
    want = list(range(400))
    if operator == "greedy_leaders":
        for i in want:
            want[i] = next((j for j in range(i) if near[i, j] and want[j] == j), i)
    else:
        for _ in units:
            want = [min(want[j] for j in np.flatnonzero(near[i])) for i in range(400)]
    assert got == dict(enumerate(want))
    assert max(sent) <= 4 * 400


def test_pairs_close_to_the_bound_are_decided_in_double_precision():
    left = np.random.default_rng(2).normal(size=(50, 8))
    left /= np.linalg.norm(left, axis=1, keepdims=True)
    exact = np.round(left @ left.T, 9)
    for tau in (exact[3, 7], exact[3, 7] + 1e-9, exact[0, 0]):
        got = np.concatenate([near for _, near in metric.near_pairs(left, left, tau, 200)])
        assert (got == (exact >= tau)).all()


def test_links_are_contracted(spark):
    links = [(i + 1, i) for i in range(40)] + [(60, 50), (70, 50), (70, 60), (90, 10)]
    df = spark.createDataFrame([(a, b) for a, b in links], "node long, low long")
    every = spark.createDataFrame([(i,) for i in [*range(41), 50, 60, 70, 80, 90]], "node long")
    got = dict(found(metric.contract(df, every), "node", "cluster"))
    assert got == {**dict.fromkeys([*range(41), 90], 0), 50: 50, 60: 50, 70: 50, 80: 80}
    assert found(metric.contract(df.limit(0), every.limit(2)), "node", "cluster") == [(0, 0), (1, 1)]


@pytest.mark.parametrize(("pool_bytes", "tau"), [(1 << 20, 0.8), (0, 0.8), (0, -1.0), (0, 0.99)])
def test_nearest_entry_by_every_path(spark, pool_bytes, tau):
    units, pool = cloud(seed=5), cloud(n=90, seed=6, noise=0.6)
    pool[80:] = pool[:10]  # ties
    kind, group = np.arange(len(units)) % 3, np.arange(len(pool)) % 3
    scores = units @ pool.T
    want, want_by = {}, {}
    for i, row in enumerate(scores):
        for out, allowed in ((want, np.full(len(pool), True)), (want_by, group == kind[i])):
            fit = [j for j in range(len(pool)) if allowed[j] and round(row[j], 9) >= tau]
            if fit:
                best = min(fit, key=lambda j: (-round(row[j], 6), j))
                out[i] = (best, round(row[best], 6))
    left = spark.createDataFrame([(i, u.tolist(), int(k)) for i, (u, k) in enumerate(zip(units, kind, strict=True))] + [(999, [0.0] * 6, 0), (998, None, 0)], "i int, v array<double>, g int")
    right = spark.createDataFrame([(j, u.tolist(), int(k)) for j, (u, k) in enumerate(zip(pool, group, strict=True))], "n int, v array<double>, g int")
    for by, expected in ((None, want), ("g", want_by)):
        got = metric.nearest_in_pool(left, "i", right, "n", "v", tau, by, part=30, pool_bytes=pool_bytes)
        assert {i: (n, round(s, 6)) for i, n, s in found(got, "i", "n", "score")} == expected
    assert metric.nearest_in_pool(left, "i", right.limit(0), "n", "v", tau).count() == 0


def test_lookup_rows_of_a_frequent_key_are_spread(spark):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    lookup = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = postings.spread_lookup(rows, lookup, "k", "id")
    assert joined.count() == 3000 and joined.filter("v != 2 * k").count() == 0
    copies = defaultdict(int)
    for r in rows.filter("k = 0").select(F.pmod(F.xxhash64("id"), F.lit(postings.COPIES)).alias("c")).collect():
        copies[r.c] += 1
    assert len(copies) == postings.COPIES and max(copies.values()) < 200


# -- approximate search in blocks --------------------------------------------------------------------------------


@pytest.mark.parametrize("share", [1.0, 0.5])
def test_approximate_top_k_meets_its_lists_in_blocks(spark, monkeypatch, share):
    """Blocks smaller than a list, equal vectors, null ids and vectors: no pair of rows is made, and with all lists probed nothing is lost."""
    monkeypatch.setattr(matching, "QUERY_BLOCK", 16)
    monkeypatch.setattr(matching, "INDEX_BLOCK", 256)
    rng = np.random.default_rng(3)
    vectors = [[float(x) for x in v] for v in rng.normal(size=(60, 4))] + [[1.0, 2.0, 3.0, 4.0]] * 300
    rows = [*enumerate(vectors), (900, None), (901, [0.0] * 4), (None, [1.0] * 4)]
    left = spark.createDataFrame(rows, "a long, v array<double>")
    found_ = matching.approximate_top_k(left, "a", left.withColumnRenamed("a", "b"), "b", "v", 3, lists=5, share=share)
    assert "FlatMapCoGroupsInPandas" in found_._jdf.queryExecution().toString()
    got = defaultdict(list)
    for r in found_.collect():
        got[r["a"]].append((-r["score"], r["b"]))
    assert sorted(got) == list(range(360)) and all(len(x) == 3 for x in got.values())
    if share == 1.0:
        unit = np.array(vectors) / np.linalg.norm(vectors, axis=1, keepdims=True)
        scores = np.round(unit @ unit.T, 6)
        for a in (0, 7, 59, 60, 359):
            assert sorted(got[a]) == sorted((-scores[a, b], b) for b in range(360) if b != a)[:3]


def test_blocks_of_lists_hold_every_list_once():
    firsts, parts, blocks = matching._blocks_of_lists([3, 4, 0, 25, 2, 9], 10)
    rows = [0] * blocks
    for n, first, part in zip([3, 4, 0, 25, 2, 9], firsts, parts, strict=True):
        for block in range(first, first + part):
            rows[block] += n / part
    assert sum(rows) == 43 and max(rows) <= 10


def test_best_of_cell_with_many_equal_scores():
    from worktide.operators.grid import best_of_cell

    rng = np.random.default_rng(5)
    scores, ids = rng.integers(0, 3, size=(40, 90)).astype(float), rng.permutation(90)
    scores[rng.random(scores.shape) < 0.3] = -np.inf
    scores[0] = -np.inf
    for k in (1, 5, 16, 17, 90, 200):
        rows, cols = best_of_cell(scores, ids, k)
        want = [(r, c) for r in range(40) for c in sorted(range(90), key=lambda c, r=r: (-scores[r, c], ids[c]))[:k] if scores[r, c] > -np.inf]
        assert [*zip(rows, cols)] == want


# -- equal rows are answered once --------------------------------------------------------------------------------


def test_answered_once_gives_every_row_the_answer_of_its_kind(spark):
    """Nulls and NaN are equal to themselves; rows of a key that comes twice are answered together as they are, a row without a key not at all."""
    from worktide.operators.cells import answered_once

    nan = float("nan")
    rows = [*[(i, i % 3 or None, [1.0, nan]) for i in range(300)], (0, None, [1.0, nan]), (1, 2, [1.0, nan]), (None, 2, [1.0, nan])]
    seen = []

    def answer(distinct):
        seen.append(distinct.count())
        other = F.explode(F.sequence(F.lit(1), F.coalesce("x", F.lit(5))))
        return distinct.select("id", other.alias("o")).select("id", F.col("o").alias("other"), F.col("o").cast("double").alias("score"), F.lit(5).cast("bigint").alias("n")).filter("other > 3 OR other < 3")

    got = defaultdict(list)
    df = spark.createDataFrame(rows, "id long, x int, v array<double>")
    out = answered_once(df, "id", answer, "other", "n")
    assert out.columns == ["id", "other", "score", "n"] and out.schema["id"].dataType == df.schema["id"].dataType
    for r in out.collect():
        got[r["id"]].append((r["other"], r["n"]))
    assert seen == [3, 4] and None not in got and len(got) == 300
    assert sorted(got[3]) == [(1, 5), (2, 5), (4, 5), (5, 5)] and sorted(got[4]) == [(1, 5)] and sorted(got[5]) == [(1, 5), (2, 5)]
    assert sorted(got[0]) == sorted(2 * [(1, 5), (2, 5), (4, 5), (5, 5)]) and sorted(got[1]) == [(1, 5), (1, 5), (2, 5)]


def test_repeated_rows_of_a_user_are_scored_as_they_are(spark):
    kinds = "skills array<string>, category string, work_form string, location string"
    users = spark.createDataFrame([(i, ["a"], "c", "f", "l", 1.0) for i in (1, 1, 2, 3)], f"user_id long, {kinds}, years double")
    posts = spark.createDataFrame([(j, ["a"], "d", "f", "l", 0.0, 2.0) for j in range(9)], f"job_key long, {kinds}, min_years double, max_years double")
    got = found(matching.score_pairs(users, posts, 5), "user_id", "job_key", "n_scored")
    assert all(x[2] == 9 for x in got) and [x[:2] for x in got] == [(1, 0)] * 4 + [(1, 1)] + [(u, j) for u in (2, 3) for j in range(5)]


def test_candidates_and_scores_meet_postings_once_per_kind_of_cv(spark, monkeypatch):
    met = []
    real = matching.cells_top_k
    monkeypatch.setattr(matching, "cells_top_k", lambda left, right, left_id, *a, **b: met.append(left.select(left_id).distinct().count()) or real(left, right, left_id, *a, **b))
    cvs = spark.createDataFrame([(i, "explicit", float(i % 2), None) for i in range(40)], "cv long, source string, years double, location string")
    jobs = spark.createDataFrame([(j, 0.0, None, "range", "x") for j in range(5)], "job long, min_years double, max_years double, experience_type string, location string")
    out = matching.candidates(cvs, "cv", jobs, "job", lambda lp, rp: np.broadcast_to(-rp["job"].to_numpy(float)[None, :], (len(lp), len(rp))), 2)
    assert found(out, "cv", "job", "n_candidates") == [(i, j, 5) for i in range(40) for j in (0, 1)]
    users = spark.createDataFrame([(i, ["a"], "c", "f", "l", 1.0) for i in range(40)], "user_id long, skills array<string>, category string, work_form string, location string, years double")
    posts = spark.createDataFrame([(j, ["a"], "c", "f", "l", 0.0, 2.0) for j in range(5)], "job_key long, skills array<string>, category string, work_form string, location string, min_years double, max_years double")
    scored = matching.score_pairs(users, posts, 2)
    assert found(scored, "user_id", "job_key", "n_scored", "band") == [(i, j, 5, "top") for i in range(40) for j in (0, 1)]
    assert met == [2, 1]
