"""Frequent keys, keyword rules, content digests and repeated loads."""

from pyspark.sql import functions as F

from worktide.operators import aggregates, collaborative, rules, skew, tables
from worktide.sources import files


def found(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def hot(spark, n=6000):
    """A key with a third of all rows, the others with one or two each."""
    return spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 3500)).alias("k"))


def test_rows_of_a_frequent_key_meet_its_count_everywhere(spark):
    rows = hot(spark)
    counts = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    joined = skew.lookup_by_key(rows, counts, "k", "n", "id", most=64)
    assert joined.count() == 6000 and joined.filter("k = 'hot' AND n <> 2000").count() == 0
    assert [r.k for r in skew.frequent_keys(counts, "k", "n", most=64).collect()] == ["hot"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.filter("k = 'hot'").groupBy(F.pmod(F.xxhash64("id"), F.lit(parts))).count().collect()
    assert len(spread) == parts and max(r["count"] for r in spread) < 1.5 * 2000 / parts
    assert found(joined, "id", "k", "n") == found(rows.join(counts, "k"), "id", "k", "n")


def test_blocks_of_a_frequent_key_give_every_pair_once(spark):
    left = hot(spark, 600)
    right = left.select(F.col("id").alias("other"), "k")
    got = skew.block_join(left, right, "k", "id", "other", block=50, most=64)
    assert found(got, "id", "other") == found(left.join(right, "k"), "id", "other")


def test_neighbours_with_an_item_of_a_third_of_all_ratings(spark):
    rows = [(u, 0, 1.0 + u % 5) for u in range(90)] + [(u, 1 + (u * i) % 40, float(1 + (u + i) % 5)) for u in range(90) for i in (1, 2)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    near = collaborative.neighbours(ratings, "user", "item", "rating", k=3)
    strongest = {}
    for u, i, r in rows:
        strongest[u, i] = max(strongest.get((u, i), 0), r)
    profile = {u: {i: r for (v, i), r in strongest.items() if v == u} for u in range(90)}
    length = {u: sum(r * r for r in p.values()) ** 0.5 for u, p in profile.items()}
    want = []
    for u in range(90):
        sims = [(v, round(sum(r / length[u] * profile[v].get(i, 0) / length[v] for i, r in profile[u].items()), 9)) for v in range(90) if v != u]
        want += [(u, v, s) for v, s in sorted(sims, key=lambda x: (-x[1], x[0]))[:3]]
    got = [(u, v, round(s, 8)) for u, v, s in found(near, "user", "neighbour", "sim")]
    assert sorted(got) == sorted((u, v, round(s, 8)) for u, v, s in want)


def test_rare_words_go_beside_a_word_in_every_list(spark):
    lists = spark.createDataFrame([(i, ["the", f"rare{'x' * i}", "Word", "twice" if i < 2 else "the"]) for i in range(40)], "k int, s array<string>")
    kept = aggregates.drop_rare_singletons(lists, "k", "s", 2)
    assert {r.k: r.s for r in kept.collect()} == {i: ["the", "Word", "twice"] if i < 2 else ["the", "Word"] for i in range(40)}


def test_the_first_rule_wins(spark, tmp_path):
    table = [(3, "finance", "ke toan"), (1, "food", "Nhà hàng"), (2, "finance", "Ngân hàng"), (4, "other", "a"), (4, "same order", "Ă")]
    spark.createDataFrame(table, rules.RULES).coalesce(1).write.csv(str(tmp_path / "rules"), header=True)
    texts = [(1, "KẾ TOÁN ngân  hàng"), (2, "nhà hàng / kế toán"), (3, None), (4, "  "), (5, "xyz"), (6, "b A b"), (1, "KẾ TOÁN ngân  hàng")]
    df = spark.createDataFrame(texts, "k int, t string")
    got = rules.sector_by_keywords(df, "t", rules.read_rules(spark, str(tmp_path / "rules")))
    assert found(got, "k", "industry_sector", "industry_status", "industry_keyword") == sorted([
        (1, "finance", "matched", "ngan hang"), (1, "finance", "matched", "ngan hang"), (2, "food", "matched", "nha hang"), (3, None, "missing", None),
        (4, None, "missing", None), (5, None, "unmapped", None), (6, "other", "matched", "a"),
    ], key=repr)
    assert rules.sector_by_keywords(df, "t", spark.createDataFrame([], rules.RULES)).filter("industry_status = 'matched'").count() == 0


def test_content_is_compared_cell_by_cell(spark):
    df = spark.createDataFrame([(1, "a", [1, 2]), (2, None, None), (2, None, None), (3, "", [])], "k int, s string, l array<int>")

    def differing(other):
        return {r.column for r in files.compare_content(df, other).collect() if not r.ok}

    assert differing(df.repartition(3).orderBy(F.desc("k"))) == set()
    assert differing(df.withColumn("s", F.coalesce("s", F.lit("")))) == {"s", "*"}
    assert differing(df.withColumn("l", F.when(F.col("k") == 1, F.array(F.lit(2), F.lit(1))).otherwise(F.col("l")))) == {"l", "*"}
    assert differing(df.distinct()) == {"k", "s", "l", "*"}  # the number of rows differs
    assert differing(df.drop("s")) == {"s", "*"}
    assert differing(df.limit(0)) == {"k", "s", "l", "*"}


def test_loads_that_are_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string")
    assert tables.load_once(one, path) and not tables.load_once(one.limit(0), path)
    assert found(spark.read.parquet(path), "k", "p") == [(1, "a"), (2, "b")]
    parted = str(tmp_path / "p")
    tables.overwrite_partitions(one, "p", parted)
    tables.overwrite_partitions(spark.createDataFrame([(9, "b")], "k int, p string"), "p", parted)
    assert found(spark.read.parquet(parted), "k", "p") == [(1, "a"), (9, "b")]


def test_neighbours_over_several_blocks_and_parts_shuffle_no_products(spark, monkeypatch):
    """Named raters, a word that all rated, long profiles, and rows without a rater, item or rating; equal to brute force."""
    import pyarrow as pa

    monkeypatch.setattr(collaborative, "BLOCK_CELLS", 120)
    monkeypatch.setattr(collaborative, "PRODUCTS_OF_A_TASK", 300)
    monkeypatch.setattr(collaborative, "PIECE_CELLS", 16)
    rows = [(f"u{u}", f"i{i}", float(1 + (u * 3 + i) % 5)) for u in range(40) for i in range(30) if i == 0 or u == 3 or (u * i) % 7 == 1]
    odd = [(None, "i1", 2.0), ("u1", None, 3.0), ("u2", "i29", None), ("u5", "i0", 1.0), ("u9", "i2", 0.0), ("alone", "x", 1.0), ("zero", "i0", 0.0)]
    strongest = {}
    for u, i, r in rows + odd:
        if u is not None and r is not None:
            strongest[u, i] = max(strongest.get((u, i), 0), r)
    length = {}
    for (u, _), r in strongest.items():
        length[u] = length.get(u, 0) + r * r
    unit = {u: {i: r / length[u] ** 0.5 for (v, i), r in strongest.items() if v == u and i is not None} for u in length if length[u] > 0}
    want = []
    for u, mine in unit.items():
        sims = [(v, round(sum(x * theirs.get(i, 0) for i, x in mine.items()), 9)) for v, theirs in unit.items() if v != u]
        want += [(u, v, round(s, 8)) for v, s in sorted((x for x in sims if x[1] > 0), key=lambda x: (-x[1], x[0]))[:4]]
    near = collaborative.neighbours(spark.createDataFrame(rows + odd, "user string, item string, rating double"), "user", "item", "rating", k=4)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "_v" not in plan and "cells" in plan
    assert sorted((r["user"], r["neighbour"], round(r["sim"], 8)) for r in near.collect()) == sorted(want)

    table = pa.table({"user": [u for u, p in unit.items() for _ in p], "item": [i for p in unit.values() for i in p], "_v": [x for p in unit.values() for x in p.values()]})
    for at_once in (1, 40, 1 << 20):
        monkeypatch.setattr(collaborative, "PRODUCTS_AT_ONCE", at_once)
        best = pa.Table.from_batches(collaborative._Block(table, "user", "item").best(table, "user", "item", 4))
        assert sorted((u, n, round(round(s, 9), 8)) for u, n, s in zip(*(c.to_pylist() for c in best.columns), strict=True)) == sorted(want)
    assert collaborative.neighbours(spark.createDataFrame([], "user string, item string, rating double"), "user", "item", "rating").count() == 0


def test_blocks_of_the_factorisation_follow_the_ratings(spark, monkeypatch):
    rows = [(u, i, float(1 + (u + i) % 2)) for u in range(30) for i in range(20)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    few = collaborative.als(ratings, rank=4, iterations=12, reg=0.01)
    monkeypatch.setattr(collaborative, "ALS_CELLS", 40)
    many = collaborative.als(ratings, rank=4, iterations=12, reg=0.01)
    assert few.userFactors.rdd.getNumPartitions() == 10 and many.userFactors.rdd.getNumPartitions() == 15
    for model in (few, many):
        error = collaborative.rating_error(model.transform(ratings), "rating", "prediction").first()
        assert error["n"] == 600 and error["rmse"] < 0.5  # below the spread of the ratings
