import numpy as np
import pytest
from pyspark.sql import functions as F

from worktide.functions import scoring
from worktide.operators import aggregates as agg
from worktide.operators import collaborative, joins, matching, merge, series, skills, tables, windows
from worktide.operators.prefix import ordered_prefix
from worktide.streaming import increments


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# -- merge and versions ------------------------------------------------------------------------------------


def test_merge_is_idempotent_and_rejects_repeated_keys(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "n", 9.0)], "k int, s string, v double")
    source = spark.createDataFrame([(2, "B", 20.0), (3, "C", 30.0), (None, "x", 7.0)], "k int, s string, v double")
    keyed = source.filter("k is not null")
    once = merge.merge_upsert(target, keyed, ["k"])
    assert rows(once, "k") == rows(merge.merge_upsert(once, keyed, ["k"]), "k")
    assert rows(once, "k") == [(None, "n", 9.0), (1, "a", 1.0), (2, "B", 20.0), (3, "C", 30.0)]
    some = merge.merge_upsert(target, source, ["k"], update=["v"])
    assert rows(some, "k", "s") == [(None, "n", 9.0), (None, "x", 7.0), (1, "a", 1.0), (2, "b", 20.0), (3, "C", 30.0)]
    assert rows(merge.merge_upsert(target, keyed, ["k"], insert=False), "k") == [(None, "n", 9.0), (1, "a", 1.0), (2, "B", 20.0)]
    with pytest.raises(Exception, match="repeats a key"):
        merge.merge_upsert(target, keyed.unionByName(keyed), ["k"]).collect()


def test_append_table(spark, tmp_path):
    table = tables.AppendTable(spark, str(tmp_path / "t"), "k int")
    one, two = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([(2,)], "k int")
    assert not table.exists() and table.read().count() == 0
    table.append(one, "batch-0")
    table.append(two, "batch-1")
    table.append(two, "batch-1")
    table.append(table.read(), "batch-0")  # a batch that reads the table and is delivered again
    table.append(one.filter("k > 5"), "batch-2")
    assert rows(table.read(), "k") == [(1,), (2,)]


def test_folding_keeps_the_state_and_the_names(spark, tmp_path):
    table = tables.AppendTable(spark, str(tmp_path / "t"), "k int, v int")
    write = increments.latest_state(table, ["k"], lambda: [F.desc("v")], width=3)
    for i in range(10):
        write(spark.createDataFrame([(i % 4, i), (9, -i)], "k int, v int"), i)
    state = increments.current_state(table, ["k"], lambda: [F.desc("v")])
    assert rows(state, "k") == [(0, 8), (1, 9), (2, 6), (3, 7), (9, 0)]
    assert table.batches() == ["batch-000000000009", "fold2-batch-000000000008"]
    for i in (0, 8, 9):  # whatever it was folded into, a batch is known
        write(spark.createDataFrame([(5, 100)], "k int, v int"), i)
    assert rows(increments.current_state(table, ["k"], lambda: [F.desc("v")]), "k")[-1] == (9, 0)


def test_bucket_table_writes_what_a_batch_touches(spark, tmp_path):
    table = tables.BucketTable(spark, str(tmp_path / "t"), ["k"], "k int, s string", buckets=32)
    table.upsert(spark.createDataFrame([(i, "a") for i in range(200)], "k int, s string"), "b0")
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    table.upsert(spark.createDataFrame([(3, "b"), (500, "b")], "k int, s string"), "b1")
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").rglob("*.parquet")}
    assert 30 <= len(files.items() & after.items()) and len(after.keys() - files.keys()) <= 2
    want = {i: "a" for i in range(200)} | {3: "b", 500: "b"}
    assert dict(rows(table.read(), "k")) == want
    table.upsert(spark.createDataFrame([(i, "late") for i in range(200)], "k int, s string"), "b0")  # delivered again
    assert dict(rows(table.read(), "k")) == want


def test_bucket_table_takes_up_a_change_that_stopped(spark, tmp_path, monkeypatch):
    table = tables.BucketTable(spark, str(tmp_path / "t"), ["k"], "k int, s string", buckets=4)
    table.upsert(spark.createDataFrame([(1, "a"), (2, "a")], "k int, s string"), "b0")
    change = spark.createDataFrame([(1, "b")], "k int, s string")

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(tables, "_swap_partitions", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            table.upsert(change, "b1")
    assert rows(table.read(), "k") == [(1, "a"), (2, "a")]
    table.upsert(change, "b1")
    assert rows(table.read(), "k") == [(1, "b"), (2, "a")]
    # a bucket that loses its last row is emptied
    table.change(change, "b2", lambda old, new: old.join(new, "k", "left_anti"))
    assert rows(table.read(), "k") == [(2, "a")]


def test_replace_insert_flag(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "k int, s string")
    source = spark.createDataFrame([(2, "z"), (3, "y")], "k int, s string")
    assert rows(merge.replace_by_key(target, source, ["k"]), "k") == [(1, "a"), (2, "z"), (3, "y")]
    assert rows(merge.insert_new(target, source, ["k"]), "k", "s") == [(1, "a"), (2, "b"), (2, "c"), (3, "y")]
    assert rows(merge.flag_rows(target, source, ["k"], "s", F.lit("done")), "k") == [(1, "a"), (2, "done"), (2, "done")]


def test_expired_versions(spark):
    log = spark.createDataFrame([("t", f"v{i}", f"2025-01-{i:02d} 00:00:00") for i in range(1, 8)], "table string, version string, c string")
    log = log.withColumn("committed_at", F.col("c").cast("timestamp")).drop("c")
    now = F.lit("2025-01-12 00:00:00").cast("timestamp")
    assert {r.version for r in merge.expired_versions(log, now).collect()} == {"v1", "v2", "v3", "v4"}
    assert merge.compaction_files(300 * 2**20) == 3 and merge.compaction_files(0) == 1


# -- ordering -------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("slots", [1, 3, 8])
def test_ordered_prefix_equals_a_plain_sort(spark, slots):
    rng = np.random.default_rng(3)
    # part "hot" holds most rows, one part is null
    data = [(None if i % 19 == 0 else ("hot" if i % 3 else f"p{i % 5}"), int(rng.integers(0, 9)), i) for i in range(300)]
    df = spark.createDataFrame(data, "p string, v int, i int")
    got = ordered_prefix(df, ["p"], [F.desc("v"), F.asc("i")], sums={"run": F.col("v")}, total="n", slots=slots)
    want = []
    for p in {d[0] for d in data}:
        part = sorted((d for d in data if d[0] == p), key=lambda d: (-d[1], d[2]))
        total = 0
        for rank, (_, v, i) in enumerate(part, 1):
            total += v
            want.append((p, v, i, rank, total, len(part)))
    assert sorted(rows(got, "i"), key=lambda r: r[2]) == sorted(want, key=lambda r: r[2])


def test_latest_and_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "2025-01-02", "t1"), ("a", "2025-01-03", "t2"), (None, "2025-01-01", "t3"), (None, None, "t4"), ("a", None, "t0")],
        "link string, d string, t string",
    )
    order = [F.desc_nulls_last("d"), F.asc("t")]
    assert [r[2] for r in rows(windows.latest_per(df, ["link"], order, keep_null_keys=True), "t")] == ["t2", "t3", "t4"]


def test_user_split(spark):
    df = spark.createDataFrame([(u, i) for u in range(8) for i in range(1 if u == 0 else 10)], "u int, i int")
    train, test = windows.user_split(df, "u", "i")
    assert train.count() == 1 + 7 * 8 and test.filter("u = 0").count() == 0
    assert test.join(train, ["u", "i"]).count() == 0
    again, _ = windows.user_split(df.repartition(7), "u", "i")
    assert rows(train, "u", "i") == rows(again, "u", "i")


def test_difference_roundtrip_and_fill(spark):
    data = [("a", t, float(v)) for t, v in enumerate([3, 5, 4, 9, 1])]
    df = spark.createDataFrame(data, "p string, t int, x double")
    second = windows.difference(df, ["p"], "t", ["x"], 2).withColumns({"x_d1": F.lit(2.0), "x_d0": F.lit(5.0)})
    assert [r[2] for r in rows(windows.undifference(second, ["p"], "t", ["x"], ["d1", "d0"]), "t")] == [4.0, 9.0, 1.0]
    holes = spark.createDataFrame([("a", 0, None), ("a", 1, 2.0), ("a", 2, None)], "p string, t int, x double")
    assert [r[2] for r in rows(windows.fill(holes, ["p"], "t", ["x"]), "t")] == [2.0, 2.0, 2.0]


# -- skills ----------------------------------------------------------------------------------------------------


def blobs(n=60, seed=5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, 8))
    return [centres[i % 6] + rng.normal(scale=0.35, size=8) for i in range(n)] + [centres[0]] * 10  # ten exact copies


def test_leaders_equal_the_sequential_rule(spark):
    vectors = blobs()
    unit = np.array([v / np.linalg.norm(v) for v in vectors])
    near = np.round(unit @ unit.T, 9) >= 0.85
    want = {}
    for i in range(len(vectors)):
        if i not in want:
            for j in np.flatnonzero(near[i]):
                want.setdefault(int(j), i)
            want[i] = i
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "i int, v array<double>")
    assert {r.item: r.leader for r in skills.leaders(df, "i", "v", "i", 0.85).collect()} == want


def test_components_equal_graph_search(spark):
    vectors = blobs(seed=9)
    unit = np.array([v / np.linalg.norm(v) for v in vectors])
    near = np.round(unit @ unit.T, 9) >= 0.9
    label = list(range(len(vectors)))
    for _ in label:
        label = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(label))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "i int, v array<double>")
    got = skills.components(df, "i", "v", "i", 0.9)
    assert {r.item: r.cluster for r in got.collect()} == dict(enumerate(label))
    names = skills.cluster_canonicals(got, df.select(F.col("i").alias("item"), (100 - F.col("i")).alias("freq")))
    assert all(r.canonical == min(k for k, v in enumerate(label) if v == label[r.item]) for r in names.collect())


def test_extraction_merges_adjacent_hits(spark):
    vocab = spark.createDataFrame(
        [("python", "tech"), ("machine learning", "tech"), ("learning", "tech"), ("c++", "tech"), ("teamwork", "soft")], "term string, skill_type string"
    )
    texts = spark.createDataFrame([(1, "Python, Machine Learning; teamwork. C++ not far"), (2, ""), (3, "nothing")], "i int, t string")
    got = {r.i: (r.tech_skills, r.soft_skills) for r in skills.extract_skills(texts, "i", "t", vocab).collect()}
    assert got == {1: (["Python", "Machine Learning"], ["teamwork"]), 2: ([], []), 3: ([], [])}


def test_extraction_takes_a_model_function(spark):
    def model(batches):
        import pandas as pd

        for b in batches:
            yield pd.DataFrame({"i": b["i"], "skill_type": "tech", "span": "Docker/Spark", "pos": 0})

    texts = spark.createDataFrame([(1, "x")], "i int, t string")
    assert skills.extract_skills(texts, "i", "t", None, model).first().tech_skills == ["Docker", "Spark"]


def test_grow_skill_dimension(spark):
    raw = spark.createDataFrame([("SQL",), (" sql ",), ("Ms Excel",), ("junk",), ("python",)], "raw_skill string")
    mapping = spark.createDataFrame(
        [("ms excel", "Excel", "tech"), ("junk", skills.SKIP, "tech")], "raw_skill string, canonical_skill string, skill_type string"
    )
    dim = spark.createDataFrame([(7, "python", "tech")], "skill_key bigint, skill_name string, skill_type string")
    alias = spark.createDataFrame([], "raw_skill string, skill_key bigint")
    new_dim, new_alias = skills.grow_skill_dim(raw, mapping, dim, alias)
    assert rows(new_dim, "skill_key") == [(8, "Excel", "tech"), (9, "sql", "unknown")]
    assert rows(new_alias, "raw_skill") == [("ms excel", 8), ("python", 7), ("sql", 9)]
    every = dim.unionByName(new_dim)
    assert joins.orphans(new_alias, every, ["skill_key"]).isEmpty()


def test_coverage_counts_jobs_with_mapped_skills_only(spark):
    mapped = spark.createDataFrame([("c", "a", "j1"), ("c", "b", "j1"), ("c", "a", "j2")], "category_key string, skill_key string, job_key string")
    assert rows(agg.skill_coverage(mapped), "skill_key") == [("c", "a", 2, 1.0), ("c", "b", 1, 0.5)]


def test_representative_ties_are_alphabetical(spark):
    df = spark.createDataFrame([("sql", s) for s in ("SQL", "Sql", "SQL", "Sql")], "g string, f string")
    assert agg.representative(df, "g", "f").first().f == "SQL"


def test_drop_rare_singletons(spark):
    df = spark.createDataFrame([(1, ["python", "SQL", "oddity", "web2", "big data A", "Python"]), (2, ["python"]), (3, [])], "k int, s array<string>")
    got = {r.k: r.s for r in agg.drop_rare_singletons(df, "k", "s").collect()}
    assert got == {1: ["python", "SQL", "web2"], 2: ["python"], 3: []}


# -- matching -----------------------------------------------------------------------------------------------------


def test_tfidf_equals_dense_arithmetic(spark):
    docs = ["red fox jumps", "red red dog", "a blue dog", ""]
    queries = ["red dog", "blue fox fox", "zzz"]
    vocab = sorted({w for d in docs for w in d.split() if len(w) > 1})
    tf = np.array([[d.split().count(w) for w in vocab] for d in docs], float)
    idf = np.log((1 + len(docs)) / (1 + (tf > 0).sum(0))) + 1
    unit = tf * idf / np.maximum(np.linalg.norm(tf * idf, axis=1, keepdims=True), 1e-12)
    q = np.array([[s.split().count(w) for w in vocab] for s in queries], float) * idf
    q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)
    want = {(i, j): round(s, 6) for i, row in enumerate(q @ unit.T) for j, s in enumerate(row) if s > 0}
    a = spark.createDataFrame(list(enumerate(queries)), "q int, text string")
    b = spark.createDataFrame(list(enumerate(docs)), "d int, text string")
    got = {(r.q, r.d): r.score for r in matching.tfidf_top_k(a, "q", b, "d", "text", 10).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 2e-6 for k in want)


def test_score_pairs_fixture(spark):
    users = spark.createDataFrame(
        [(1, ["a", "b"], "IT", "full", "HN", 3.0)], "user_id int, skills array<string>, category string, work_form string, location string, years double"
    )
    jobs = spark.createDataFrame(
        [(1, ["a", "b", "c", "d"], "IT", "full", "HN", 2.0, 5.0), (2, ["a"] + list("vwxyz") + ["q"], "HR", "part", "HCM", 9.0, None), (3, [], "IT", "part", "x", 9.0, None)],
        "job_key int, skills array<string>, category string, work_form string, location string, min_years double, max_years double",
    )
    assert rows(matching.score_pairs(users, jobs, 5), "job_key") == [(1, 1, 12.0, 2, "top"), (1, 3, 3.0, 2, "low")]


def test_cosine_of_hot_profiles_equals_the_grid(spark):
    rng = np.random.default_rng(1)
    data = [(u, i, float(rng.integers(1, 6))) for u in range(25) for i in range(30) if u == 0 or rng.random() < 0.25]
    df = spark.createDataFrame(data, "user int, item int, rating double")
    profile = {}
    for u, i, r in data:
        profile.setdefault(u, np.zeros(30))[i] = r
    want = []
    for u, a in profile.items():
        sims = [(n, round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9)) for n, b in profile.items() if n != u and a @ b > 0]
        want += [(u, n, s) for n, s in sorted(sims, key=lambda x: (-x[1], x[0]))[:5]]
    found = collaborative.neighbours(df, "user", "item", "rating", k=5).select("user", "neighbour", "sim")
    assert [tuple(r) for r in rows(found, "user", "neighbour")] == sorted(want)


def test_leaders_of_zero_null_and_repeated_vectors_end(spark):
    items = [("a", [1.0, 0.0], 1), ("b", [0.99, 0.01], 2), ("z1", [0.0, 0.0], 3), ("z2", [0.0, 0.0], 4), ("n", None, 5), ("c", [1.0, 0.0], 2)]
    df = spark.createDataFrame(items, "item string, vector array<double>, rank int")
    found = {r.item: r.leader for r in skills.leaders(df, "item", "vector", "rank").collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "z1": "z1", "z2": "z2", "n": "n"}


def test_leaders_of_equal_rank_keep_their_own_vectors(spark):
    items = [("a", [1.0, 0.0], 1), ("b", [0.0, 1.0], 1), ("c", [0.01, 1.0], 2), ("d", [1.0, 0.01], 1), ("b", [0.0, 1.0], 1), ("b", [0.0, 1.0], 7), (None, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(items, "item string, vector array<double>, rank int")
    found = [(r.item, r.leader) for r in skills.leaders(df, "item", "vector", "rank").collect()]
    assert sorted(found, key=repr) == sorted([("a", "a"), ("b", "b"), ("b", "b"), ("b", "b"), ("c", "b"), ("d", "a"), (None, None)], key=repr)


def test_terms_of_any_length_are_found(spark):
    vocab = spark.createDataFrame([("one two three four five six", "tech"), ("two", "tech")], "term string, skill_type string")
    df = spark.createDataFrame([(1, "zero one two three four five six seven"), (2, ""), (3, None)], "id int, text string")
    assert rows(skills.find_terms(df, "id", "text", vocab).select("id", "term", "pos", "size"), "term") == [(1, "one two three four five six", 1, 6), (1, "two", 2, 1)]
    found = {r.id: r.tech_skills for r in skills.extract_skills(df, "id", "text", vocab).collect()}
    assert found[2] == [] and found[3] == [] and "two three four five six" in found[1][0].lower()


def test_series_of_order_five_becomes_stationary(spark):
    values = np.random.default_rng(0).normal(size=160)
    for _ in range(5):
        values = np.cumsum(values)
    df = spark.createDataFrame([("p", i, float(v)) for i, v in enumerate(values)], "panel string, t int, x double")
    _, order, tested = series.make_stationary(df, ["panel"], "t", ["x"], lags=0)
    assert order >= 5 and all(r.stationary for r in tested.collect())
    short = spark.createDataFrame([("p", i, float(i**3)) for i in range(7)], "panel string, t int, x double")
    assert [r.stationary for r in series.make_stationary(short, ["panel"], "t", ["x"], lags=0)[2].collect()] != []


def test_all_missing_skills_are_named(spark):
    df = spark.createDataFrame([(["a"], list("hgfedcba"))], "mine array<string>, wanted array<string>")
    assert df.select(scoring.missing(F.col("mine"), F.col("wanted")).alias("m")).first().m == list("bcdefgh")


def test_candidates_respect_slack_and_place(spark):
    cvs = spark.createDataFrame(
        [(1, "explicit", 2.0, None), (2, "inferred", 2.0, "HN"), (3, "default", None, None)], "cv int, source string, years double, location string"
    )
    jobs = spark.createDataFrame(
        [(1, "HN", 3.0, 5.0, "range"), (2, "HCM", 0.0, 2.0, "range"), (3, "HN", 2.0, None, "at_least"), (4, "HCM", 0.0, 0.0, "none")],
        "job int, location string, min_years double, max_years double, experience_type string",
    )
    got = matching.candidates(cvs, "cv", jobs, "job", lambda lp, rp: np.ones((len(lp), len(rp))), 10)
    pairs = {(r.cv, r.job) for r in got.collect()}
    assert pairs == {(1, 2), (1, 3), (2, 1), (2, 3), (3, 4)}
    assert {r.cv: r.n_candidates for r in got.collect()} == {1: 2, 2: 2, 3: 1}


# -- series ----------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(0)
    data, arrays = [], {}
    for name in ("a", "b"):
        x = np.zeros((60, 2))
        for t in range(1, 60):
            x[t] = [0.6 * x[t - 1, 0] + 0.2 * x[t - 1, 1], -0.3 * x[t - 1, 1]] + rng.normal(size=2)
        arrays[name] = x
        data += [(name, t, float(x[t, 0]), float(x[t, 1])) for t in range(60)]
    return spark.createDataFrame(data, "p string, t int, x double, y double"), arrays


def test_var_and_forecast_match_least_squares(panel):
    df, arrays = panel
    fitted = series.fit_var(df, ["p"], "t", ["x", "y"], 2)
    coefficients = {(r.p, r.target, r.term): r.coefficient for r in fitted.collect()}
    ahead = {(r.p, r.step): (r.x, r.y) for r in series.forecast(df, fitted, ["p"], "t", ["x", "y"], 2, 3).collect()}
    for name, x in arrays.items():
        design = np.hstack([np.ones((58, 1)), x[1:-1], x[:-2]])
        beta = np.linalg.lstsq(design, x[2:], rcond=None)[0]
        terms = ["const", "x_lag1", "y_lag1", "x_lag2", "y_lag2"]
        for j, target in enumerate(("x", "y")):
            assert np.allclose([coefficients[name, target, t] for t in terms], beta[:, j])
        recent = [x[-1], x[-2]]
        for step in range(1, 4):
            value = beta.T @ np.concatenate([[1.0], recent[0], recent[1]])
            assert np.allclose(ahead[name, step], value)
            recent = [value, recent[0]]


def test_unit_root_and_granger(panel):
    df, arrays = panel
    stat = {(r.p, r.series): r for r in series.adf(df, ["p"], "t", ["x"], lags=1).collect()}
    for name, x in arrays.items():
        v = x[:, 0]
        dy = np.diff(v)
        design = np.column_stack([np.ones(58), v[1:-1], dy[:-1]])
        beta, *_ = np.linalg.lstsq(design, dy[1:], rcond=None)
        rss = ((dy[1:] - design @ beta) ** 2).sum()
        error = np.sqrt(rss / 55 * np.linalg.inv(design.T @ design)[1, 1])
        assert np.isclose(stat[name, "x"].statistic, beta[1] / error)
        assert stat[name, "x"].stationary == (beta[1] / error < stat[name, "x"].critical)
    tests = series.granger(df, ["p"], "t", ["x", "y"], 2).collect()
    assert len(tests) == 2 * 2 * 2 and all(0 <= r.p_value <= 1 for r in tests)
    assert np.isclose(series._beta_fraction(2, 3, 0.5), 0.6875)


def test_weights_sum_to_one(panel):
    df, _ = panel
    preds = df.select("p", "x", (F.col("x") * 0.8).alias("m1"), (F.col("y") - 1).alias("m2"), (F.col("x") + F.col("y")).alias("m3"))
    got = series.ensemble_weights(preds, ["p"], ["m1", "m2", "m3"], "x").collect()
    for p in ("a", "b"):
        weights = [r.weight for r in got if r.p == p]
        assert np.isclose(sum(weights), 1) and min(weights) >= 0


def test_scaling_uses_fitted_statistics(panel):
    df, _ = panel
    train = df.filter("t < 40")
    fitted = series.fit_scale(train, ["p"], ["x"])
    back = series.unscale(series.scale(df, fitted, ["p"], ["x"]), fitted, ["p"], ["x"])
    assert np.allclose([r.x for r in back.orderBy("p", "t").collect()], [r.x for r in df.orderBy("p", "t").collect()])
    assert series.lag_sweep(df, ["p"], "t", ["x", "y"], 3).count() == 8
