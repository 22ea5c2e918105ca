"""What is large is shuffled once: checks of plans, and of results where rows repeat or keys are null."""

import re

from conftest import SF
from pyspark.sql import functions as F

from worktide.catalog import all_queries
from worktide.operators import aggregates, collaborative, skills
from worktide.plans import gold, silver
from worktide.session import written


def exchanges(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if re.search(rf"Exchange hashpartitioning\([^)]*\b{column}#", line)]


def test_written_rows_are_files_of_known_size(spark):
    df = spark.range(5).select("id", F.array(F.lit("a"), F.lit(None).cast("string")).alias("x"), F.lit(None).cast("string").alias("y"))
    back = written(df)
    assert sorted(back.collect()) == sorted(df.collect()) and back.schema.simpleString() == df.schema.simpleString()
    assert back.inputFiles()


def test_skill_lists_reach_the_postings_without_a_shuffle(spark):
    vocab = spark.createDataFrame([("excel", "tech")], "term string, skill_type string")
    empty = F.array().cast("array<string>")
    rows = spark.createDataFrame([("a", "Biết Excel tốt"), ("b", "Biết Excel tốt"), ("c", ""), ("d", None)], "link string, requirement string")
    found = silver.enrich_skills(rows.withColumns({"tech_skills": empty, "soft_skills": empty, "skills_all": F.array(F.lit("Word"))}), vocab)
    assert not exchanges(found, "_text")
    got = {r["link"]: (r["tech_skills"], r["skills_all"]) for r in found.collect()}
    assert got == {"a": (["Excel"], ["Word", "Excel"]), "b": (["Excel"], ["Word", "Excel"]), "c": ([], ["Word"]), "d": ([], ["Word"])}


def test_coverage_counts_each_job_once(spark):
    rows = [("c", "s", "1"), ("c", "s", "1"), ("c", "t", "1"), ("c", "s", "2"), ("c", None, "3"), ("c", None, "3"), ("d", "s", None), (None, "s", "1"), ("d", "u", "4")]
    mapped = spark.createDataFrame(rows, "category_key string, skill_key string, job_key string")
    got = {(r[0], r[1]): (r[2], r[3] and round(r[3], 6)) for r in aggregates.skill_coverage(mapped).collect()}
    assert got == {
        ("c", "s"): (2, 0.666667), ("c", "t"): (1, 0.333333), ("c", None): (1, 0.333333), ("d", "s"): (0, 0.0), ("d", "u"): (1, 1.0), (None, "s"): (1, 1.0),
    }


def test_demand_shuffles_postings_once(spark):
    postings = spark.createDataFrame(
        [("l1", "Công nghệ thông tin", None, ["A b", "A b", "Cde"]), (None, "Công nghệ thông tin", None, ["Cde"])],
        "link string, category_name_final string, expired_date_norm date, skills_all array<string>",
    )
    alias = spark.createDataFrame([("a b", "x"), ("cde", "x")], "skill_norm string, skill_key string")
    assert len(exchanges(gold.skill_by_category(postings, alias), "job_key")) == 1


def test_job_skills_shuffle_postings_once(spark):
    jobs = spark.createDataFrame([("1", ["A", " a", ""], None), ("1", ["a"], ["B"]), (None, None, ["b"])], "job_key string, tech_skills array<string>, soft_skills array<string>")
    alias = spark.createDataFrame([("a", 7), ("b", 8)], "raw_skill string, skill_key bigint")
    dim = spark.createDataFrame([(7, "tech")], "skill_key bigint, skill_type string")
    found = skills.job_skills(jobs, written(alias), written(dim))
    assert len(exchanges(found, "job_key")) == 1
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([("1", 7, "tech"), ("1", 8, None), (None, 8, None)], key=repr)


def test_pairs_of_raters_are_summed_and_ranked_in_one_shuffle(spark):
    ratings = spark.createDataFrame([(u, i, float((u * i) % 5 + 1)) for u in range(6) for i in range(8) if (u + i) % 3], "user int, item int, rating double")
    assert not exchanges(collaborative.neighbours(ratings, "user", "item", "rating", 2), "neighbour")


def test_wanted_items_that_the_user_has_not_rated_are_predicted(spark, monkeypatch):
    monkeypatch.setattr(collaborative, "LIST_CELLS", 2)
    rows = [(1, "a", 4.0), (1, "b", 2.0), (2, "a", 5.0), (2, "b", 1.0), (2, "c", 3.0), (3, "c", 2.0), (3, None, 1.0)]
    ratings = spark.createDataFrame(rows, "user int, item string, rating double")
    pairs = spark.createDataFrame([(1, "c"), (1, "c"), (3, "a"), (1, "z"), (1, None), (None, "a")], "user int, item string")
    got = {(r["user"], r["item"]): round(r["prediction"], 9) for r in collaborative.user_cf(pairs, ratings).collect()}
    assert got == {(1, "c"): 3.0, (3, "a"): 5.0}


def test_small_files_of_parts_are_read_by_all_tasks(spark):
    plan = all_queries()["k01_skills_of_listed_parts"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan


def test_recommendations_are_the_largest_products(spark, monkeypatch):
    """Equal to all products in every place, over several blocks of both sides, with equal and zero factors; nothing is scored twice."""
    import numpy as np

    from worktide.operators import collaborative

    monkeypatch.setattr(collaborative, "ITEM_BLOCK", 64)
    monkeypatch.setattr(collaborative, "USER_BLOCK", 50)
    draw = np.random.default_rng(3)
    users, items = draw.integers(-4, 5, (180, 4)).astype(float), draw.integers(-4, 5, (700, 4)).astype(float)
    users[7] = 0
    items[100:300] = items[5]

    def frame(matrix):
        return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id int, features array<float>")

    found = collaborative.recommend(frame(users), frame(items), 10).collect()
    products = users @ items.T
    for u in range(len(users)):
        want = sorted(range(len(items)), key=lambda i: (-products[u, i], i))[:10]
        assert [r["item"] for r in sorted((r for r in found if r["user"] == u), key=lambda r: r["position"])] == want
    few = collaborative.recommend(frame(users), frame(items[:3]), 10).collect()
    assert len(few) == 3 * len(users) and {r["position"] for r in few} == {1, 2, 3}
    assert collaborative.recommend(frame(users[:0]), frame(items), 10).count() == 0


def test_short_items_are_not_scored():
    import numpy as np

    from worktide.operators import collaborative

    best = collaborative._Best(np.arange(3), np.eye(3, dtype=np.float32) + 1, 2)
    best.meet(np.arange(4), np.full((4, 3), 9, np.float32), 16.0)
    scored = []
    best._rank = lambda *a: scored.append(a)
    best.meet(np.arange(4, 6), np.full((2, 3), 1, np.float32), 2.0)
    assert not scored
