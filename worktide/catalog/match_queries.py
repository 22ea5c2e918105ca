"""Skill canonicalisation, matching, collaborative filtering and page sources."""

from pyspark.sql import functions as F

from ..functions import scoring
from ..operators import collaborative, matching, skills, windows
from ..operators.aggregates import overlap_count
from ..session import written
from ..sources import files, pages
from .base import query

WORD = r"\p{L}\p{M}\p{Nd}\p{Pc}"

# -- K: skills -----------------------------------------------------------------------------------------


def _vocab(t):
    """Terms from the benchmark passages: first two words as tech terms, fourth word as soft ones."""
    ws = F.filter(F.split(F.lower(F.regexp_replace("text", r"(?U)[^\w]+", " ")), " "), lambda w: w != "")
    base = t.benchmark.select(ws.alias("w"))
    tech = base.select(F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1))).alias("term"), F.lit("tech").alias("skill_type"))
    return tech.unionByName(base.select(F.get("w", F.lit(3)).alias("term"), F.lit("soft").alias("skill_type"))).distinct()


@query("k01_vocabulary_skill_extraction")
def _(t):
    found = skills.extract_skills(t.spread("documents", "doc_id"), "doc_id", "text", _vocab(t))
    return found.select("doc_id", F.array_join("tech_skills", "|").alias("tech"), F.array_join("soft_skills", "|").alias("soft"))


@query(
    "k01_skills_of_listed_parts",
    """SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'Python, SQL tuning' ELSE 'SQL tuning' END AS names, 'team work' AS soft FROM part""",
)
def _(t):
    vocab = t.spark.createDataFrame(
        [("python", "tech"), ("sql", "tech"), ("sql tuning", "tech"), ("team work", "soft")], "term string, skill_type string"
    )
    body = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("Needs Python , SQL tuning for "), "p_name", F.lit(" and team work; team work")))
    text = body.otherwise(F.concat(F.lit("SQL tuning of "), "p_brand", F.lit(". team work")))
    found = skills.extract_skills(t.spread("part", "p_partkey").select("p_partkey", text.alias("text")), "p_partkey", "text", vocab)
    return found.select("p_partkey", F.array_join("tech_skills", ", ").alias("names"), F.array_join("soft_skills", ", ").alias("soft"))


_TAU = 0.5
_UNIT = "e AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v FROM embeddings)"
_NEAR = f"""{_UNIT}, near AS (SELECT a.id AS i, b.id AS j FROM e a JOIN e b ON a.id <> b.id AND round(list_cosine_similarity(a.v, b.v), 9) >= {_TAU})"""


def vectors(t):
    return t.embeddings.select("vec_id", F.col("embedding").alias("vector"), "label")


@query(
    "k02_greedy_leaders",
    f"""WITH RECURSIVE {_NEAR}, adj AS (SELECT id, row_number() OVER (ORDER BY id) AS n, list(j) FILTER (j < id) AS earlier FROM e LEFT JOIN near ON i = id GROUP BY id),
    walk AS (SELECT 0::BIGINT AS n, []::BIGINT[] AS leaders UNION ALL SELECT walk.n + 1, CASE WHEN list_has_any(coalesce(earlier, []::BIGINT[]), leaders) THEN leaders ELSE list_append(leaders, adj.id) END
      FROM walk JOIN adj ON adj.n = walk.n + 1),
    final AS (SELECT unnest(leaders) AS leader FROM (SELECT leaders FROM walk ORDER BY n DESC LIMIT 1))
    SELECT id AS item, min(leader) AS leader FROM (SELECT e.id, f.leader FROM e JOIN final f ON f.leader = e.id UNION ALL SELECT i, j FROM near JOIN final ON leader = j WHERE i NOT IN (SELECT leader FROM final)) GROUP BY 1""",
)
def _(t):
    return skills.leaders(vectors(t), "vec_id", "vector", "vec_id", _TAU)


@query(
    "k04_components",
    f"""WITH RECURSIVE {_NEAR}, reach AS (SELECT id AS a, id AS b FROM e UNION SELECT reach.a, near.j FROM reach JOIN near ON near.i = reach.b)
    SELECT a AS item, min(b) AS cluster FROM reach GROUP BY 1""",
)
def _(t):
    return skills.components(vectors(t), "vec_id", "vector", "vec_id", _TAU)


@query(
    "k03_nearest_canonical",
    f"""WITH {_UNIT}, pool AS (SELECT min(id) AS pid, label FROM e GROUP BY label), s AS (SELECT e.id, p.pid, round(list_cosine_similarity(e.v, pe.v), 6) AS score, round(list_cosine_similarity(e.v, pe.v), 9) AS exact
      FROM e JOIN pool p ON p.label = e.label JOIN e pe ON pe.id = p.pid)
    SELECT id AS vec_id, pid AS canonical, score FROM s WHERE exact >= 0.2""",
)
def _(t):
    v = vectors(t)
    first = windows.top_k(v, ["label"], [F.asc("vec_id")], 1).select(F.col("vec_id").alias("canonical"), "vector", "label")
    return skills.nearest(v, "vec_id", first, "canonical", "vector", tau=0.2, by="label")


@query(
    "k11_category_by_vector",
    f"""WITH {_UNIT}, cats AS (SELECT 'c' || label AS category, list(cs ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS cs FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM e) GROUP BY 1, 2) GROUP BY 1),
    s AS (SELECT id, category, round(list_cosine_similarity(e.v, c.v), 6) AS score, row_number() OVER (PARTITION BY id ORDER BY round(list_cosine_similarity(e.v, c.v), 6) DESC, category) AS rn FROM e, cats c)
    SELECT id AS vec_id, CASE WHEN score >= 0.55 THEN category ELSE 'other' END AS category, score FROM s WHERE rn = 1""",
)
def _(t):
    long = t.embeddings.select("label", F.posexplode("embedding").alias("pos", "x"))
    mean = long.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    cats = mean.groupBy(F.concat(F.lit("c"), "label").alias("category")).agg(F.array_sort(F.collect_list(F.struct("pos", "x")))["x"].alias("vector"))
    return skills.category_by_vector(vectors(t), "vec_id", cats, "vector", 0.55, "other")


@query(
    "k05_priority_cascade",
    """WITH s AS (SELECT DISTINCT p_name AS raw_skill, CASE WHEN p_size % 2 = 0 THEN 'tech' ELSE 'soft' END AS skill_type FROM part),
    both_types AS (SELECT raw_skill, max(CAST(skill_type = 'tech' AS INT)) AS tech FROM s GROUP BY 1)
    SELECT raw_skill, skill_type, CASE WHEN raw_skill LIKE 'red%' THEN 'rule ' || raw_skill WHEN raw_skill LIKE '%ring' AND skill_type = 'tech' THEN 'sim' WHEN raw_skill LIKE 's%' THEN 'cluster' ELSE raw_skill END AS canonical_skill,
      CASE WHEN raw_skill LIKE 'red%' OR (raw_skill LIKE '%ring' AND skill_type = 'tech') OR raw_skill LIKE 's%' THEN skill_type WHEN tech = 1 THEN 'tech' ELSE 'soft' END AS canonical_type,
      CASE WHEN raw_skill LIKE 'red%' THEN 'rule' WHEN raw_skill LIKE '%ring' AND skill_type = 'tech' THEN 'sim' WHEN raw_skill LIKE 's%' THEN 'cluster' ELSE 'none' END AS source FROM s JOIN both_types USING (raw_skill)""",
)
def _(t):
    kind = F.when(F.col("p_size") % 2 == 0, "tech").otherwise("soft")
    named = t.part.select(F.col("p_name").alias("raw_skill"), kind.alias("skill_type")).distinct()
    raw = F.col("raw_skill")
    rules = named.filter(raw.startswith("red")).withColumn("canonical", F.concat(F.lit("rule "), raw))
    sims = named.filter(raw.endswith("ring") & (F.col("skill_type") == "tech")).withColumn("canonical", F.lit("sim"))
    clusters = named.filter(raw.startswith("s")).withColumn("canonical", F.lit("cluster"))
    return skills.cascade(named, rules, sims, clusters)


@query(
    "k06_k07_rules_and_noise",
    """WITH r AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_name END AS canonical, lower(p_brand) AS raw, p_type AS kind FROM part)
    SELECT p_partkey, raw || '|' || kind AS rule_key, CASE WHEN canonical LIKE 'old%' THEN '__SKIP__' ELSE array_to_string(list_transform(string_split(canonical, ' '), lambda w: upper(w[1]) || w[2:]), ' ') END AS canonical
    FROM r WHERE trim(canonical) <> ''""",
)
def _(t):
    name = F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.col("p_name"))
    rows = t.part.select("p_partkey", F.concat(F.lit(" "), "p_brand").alias("raw_skill_norm"), F.col("p_type").alias("skill_type"), name.alias("canonical"))
    keyed = rows.withColumn("raw_skill_norm", F.concat_ws("#", "raw_skill_norm", "p_partkey"))
    rules = skills.clean_rules(keyed.drop("p_partkey"))
    spoiled = rules.withColumn("canonical", F.when(F.col("canonical").startswith("Old"), "& x").otherwise(F.col("canonical")))
    marked = skills.mark_noise(spoiled, "canonical")
    part = F.regexp_extract("raw_skill", r"#(\d+)$", 1).cast("bigint")
    key = F.concat(F.regexp_replace("raw_skill", r"#\d+$", ""), F.lit("|"), "skill_type")
    return marked.select(part.alias("p_partkey"), key.alias("rule_key"), "canonical")


# -- N: matching ------------------------------------------------------------------------------------------

_TFIDF = rf"""toks AS (SELECT id, t, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(text), '[{WORD}]{{2,}}')) AS t FROM docs) GROUP BY 1, 2),
  qtoks AS (SELECT id, t, count(*) AS tf FROM (SELECT id, unnest(regexp_extract_all(lower(text), '[{WORD}]{{2,}}')) AS t FROM qs) GROUP BY 1, 2),
  idf AS (SELECT t, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*))) + 1 AS w FROM toks GROUP BY 1),
  dw AS (SELECT id, t, tf * w AS x, sqrt(sum((tf * w) * (tf * w)) OVER (PARTITION BY id)) AS norm FROM toks JOIN idf USING (t)),
  qw AS (SELECT id, t, tf * w AS x, sqrt(sum((tf * w) * (tf * w)) OVER (PARTITION BY id)) AS norm FROM qtoks JOIN idf USING (t)),
  sims AS (SELECT q.id AS query, d.id AS doc, sum((q.x / q.norm) * (d.x / d.norm)) AS sim FROM qw q JOIN dw d USING (t) GROUP BY 1, 2)"""


@query(
    "n01_tfidf_cosine_top_k",
    f"""WITH docs AS (SELECT doc_id AS id, text FROM documents), qs AS (SELECT item_id AS id, text FROM benchmark), {_TFIDF}
    SELECT query AS item_id, doc AS doc_id, score FROM (SELECT query, doc, round(sim, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY round(sim, 6) DESC, doc) AS rn FROM sims) WHERE rn <= 5""",
)
def _(t):
    return matching.tfidf_top_k(t.benchmark, "item_id", t.spread("documents", "doc_id"), "doc_id", "text", 5)


_LISTED = "docs AS (SELECT p_partkey AS id, p_name || ' ' || p_type || ' ' || p_brand AS text, string_split(p_name, ' ') AS sk FROM part), qs AS (SELECT c_custkey AS id, c_mktsegment || ' red ring ' || 'brand#' || c_nationkey || ' small' AS text, ['RED', 'small', 'ring'] AS sk FROM customer)"


@query(
    "n02_hybrid_rank",
    f"""WITH {_LISTED}, {_TFIDF}, h AS (SELECT q.id AS query, d.id AS doc, 0.6 * coalesce(sim, 0) + 0.4 * len(list_filter(['red', 'small', 'ring'], lambda s: list_contains(d.sk, s))) / len(d.sk) AS score
      FROM qs q CROSS JOIN docs d LEFT JOIN sims ON sims.query = q.id AND sims.doc = d.id)
    SELECT query AS c_custkey, doc AS p_partkey, score FROM (SELECT query, doc, round(score, 6) AS score, row_number() OVER (PARTITION BY query ORDER BY round(score, 6) DESC, doc) AS rn FROM h) WHERE rn <= 3""",
)
def _(t):
    cvs = t.customer.select(
        "c_custkey", F.concat("c_mktsegment", F.lit(" red ring brand#"), "c_nationkey", F.lit(" small")).alias("text"),
        F.array(F.lit("RED"), F.lit("small"), F.lit("ring")).alias("skills"),
    )
    jobs = t.part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type", "p_brand").alias("text"), F.split("p_name", " ").alias("skills"))
    return matching.hybrid_rank(cvs, "c_custkey", jobs, "p_partkey", "text", "skills", 0.6, 3)


@query(
    "n03_n04_vector_top_k",
    f"""WITH {_UNIT}, s AS (SELECT q.id AS vec_id, e.id AS neighbour, round(list_cosine_similarity(q.v, e.v), 6) AS score, row_number() OVER (PARTITION BY q.id ORDER BY round(list_cosine_similarity(q.v, e.v), 6) DESC, e.id) AS rn,
      count(*) OVER (PARTITION BY q.id) AS n_rows FROM e q JOIN e ON e.label <> q.label)
    SELECT vec_id, neighbour, score, CAST(n_rows AS BIGINT) AS n_rows FROM s WHERE rn <= 3""",
)
def _(t):
    jobs = t.embeddings.select("vec_id", F.concat(F.lit("t"), "label").alias("title"), F.array(F.lit("a")).alias("skills"), "label")
    index = matching.build_index(jobs, t.embeddings.select("vec_id", "embedding"), "vec_id", "embedding", kind="double")

    def other_label(lp, rp):
        return lp["label"].to_numpy()[:, None] != rp["label"].to_numpy()[None, :]

    right = index.select(F.col("vec_id").alias("neighbour"), "embedding", "label")
    left = t.embeddings.select("vec_id", "embedding", "label")
    return matching.vector_top_k(left, "vec_id", right, "neighbour", "embedding", 3, other_label, count="n_rows")


@query("n03_approximate_vector_top_k")
def _(t):
    left = t.embeddings.select("vec_id", "embedding")
    return matching.approximate_top_k(left, "vec_id", left.withColumnRenamed("vec_id", "neighbour"), "neighbour", "embedding", 3)


@query("n03_approximate_recall", "SELECT vec_id, CAST(3 AS BIGINT) AS found, CAST(0 AS BIGINT) AS itself, true AS enough FROM embeddings")
def _(t):
    """Per vector how many neighbours were found, and whether over all of them nine of ten are exact."""
    left = t.embeddings.select("vec_id", "embedding")
    right = left.withColumnRenamed("vec_id", "neighbour")
    near = matching.approximate_top_k(left, "vec_id", right, "neighbour", "embedding", 3)

    def other(lp, rp):
        return lp["vec_id"].to_numpy()[:, None] != rp["neighbour"].to_numpy()[None, :]

    exact = matching.vector_top_k(left, "vec_id", right, "neighbour", "embedding", 3, other).select("vec_id", "neighbour", F.lit(True).alias("_hit"))
    joined = near.join(exact, ["vec_id", "neighbour"], "left")
    each = joined.groupBy("vec_id").agg(
        F.count(F.lit(1)).alias("found"), F.count(F.when(F.col("vec_id") == F.col("neighbour"), 1)).alias("itself"), F.count("_hit").alias("_hits")
    )
    enough = each.agg((F.sum("_hits") >= 0.9 * F.sum("found")).alias("enough")).scalar()
    return each.select("vec_id", "found", "itself", enough.alias("enough"))


_CVS = """cvs AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'explicit' WHEN c_custkey % 3 = 1 THEN 'inferred' ELSE 'default' END AS source, CASE WHEN c_custkey % 3 < 2 THEN c_custkey % 12 END AS years,
    CASE WHEN c_custkey % 2 = 0 THEN 'Brand#' || (1 + c_nationkey % 25) END AS location FROM customer),
  jobs AS (SELECT p_partkey, p_brand AS location, CASE WHEN p_size % 4 <> 0 THEN p_size % 10 END AS lo, CASE WHEN p_size % 5 <> 0 THEN p_size % 10 + 3 END AS hi, CASE WHEN p_size % 4 = 0 THEN 'none' ELSE 'range' END AS et, p_retailprice FROM part),
  m AS (SELECT c_custkey, p_partkey, p_retailprice FROM cvs JOIN jobs j ON (cvs.location IS NULL OR cvs.location = j.location) AND
    CASE WHEN source = 'default' THEN et = 'none' ELSE coalesce(lo, -1000) <= years + CASE WHEN source = 'inferred' THEN 1 ELSE 0 END AND coalesce(hi, 1000) >= greatest(years - CASE WHEN source = 'inferred' THEN 1 ELSE 0 END, 0) END)"""


@query(
    "j09_f11_w17_candidates",
    f"""WITH {_CVS} SELECT c_custkey, p_partkey, round(p_retailprice, 6) AS score, CAST(n AS BIGINT) AS n_candidates FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY p_retailprice DESC, p_partkey) AS rn,
      count(*) OVER (PARTITION BY c_custkey) AS n FROM m) WHERE rn <= 3""",
)
def _(t):
    k = F.col("c_custkey")
    source = F.when(k % 3 == 0, "explicit").when(k % 3 == 1, "inferred").otherwise("default")
    cvs = t.customer.select(
        k, source.alias("source"), F.when(k % 3 < 2, (k % 12).cast("double")).alias("years"),
        F.when(k % 2 == 0, F.concat(F.lit("Brand#"), F.col("c_nationkey") % 25 + 1)).alias("location"),
    )
    size = F.col("p_size")
    jobs = t.part.select(
        "p_partkey", F.col("p_brand").alias("location"), F.when(size % 4 != 0, (size % 10).cast("double")).alias("min_years"),
        F.when(size % 5 != 0, (size % 10 + 3).cast("double")).alias("max_years"), F.when(size % 4 == 0, "none").otherwise("range").alias("experience_type"), "p_retailprice",
    )

    def price(lp, rp):
        import numpy as np

        return np.broadcast_to(rp["p_retailprice"].to_numpy(dtype=float)[None, :], (len(lp), len(rp)))

    return matching.candidates(cvs, "c_custkey", jobs, "p_partkey", price, 3)


_PAIRS = """u AS (SELECT c_custkey AS user_id, [lower(c_mktsegment), 'red', 'small', 'ring', 'new'] AS mine, 'Brand#' || (1 + c_nationkey % 25) AS cat, CAST(c_nationkey % 3 AS VARCHAR) AS form, CAST(c_custkey % 7 AS VARCHAR) AS place, c_custkey % 15 AS years FROM customer),
  j AS (SELECT p_partkey AS job_key, list_distinct(string_split(p_name, ' ')) AS sk, p_brand AS cat, CAST(p_size % 3 AS VARCHAR) AS form, CAST(p_partkey % 7 AS VARCHAR) AS place, p_size % 12 AS lo, CASE WHEN p_size % 2 = 0 THEN p_size % 12 + 1 END AS hi FROM part),
  r AS (SELECT user_id, job_key, u.cat = j.cat AS same, len(list_intersect(mine, sk)) / len(sk) AS ratio, CAST(u.form = j.form AS INT) + CAST(u.place = j.place AS INT) + 2 * CAST(years BETWEEN lo AND coalesce(hi, lo + 2) AS INT) AS extra FROM u, j),
  s AS (SELECT user_id, job_key, round(10 * ratio + 3 * CAST(same AS INT) + extra, 6) AS score FROM r WHERE 10 * ratio + 3 * CAST(same AS INT) + extra >= 2 AND (same OR ratio >= 0.15))"""


@query(
    "n05_x33_x34_scored_interactions",
    f"""WITH {_PAIRS} SELECT user_id, job_key, score, CAST(n AS BIGINT) AS n_scored, CASE WHEN score >= 12 THEN 'top' WHEN score >= 9 THEN 'high' WHEN score >= 5 THEN 'mid' ELSE 'low' END AS band
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, job_key) AS rn, count(*) OVER (PARTITION BY user_id) AS n FROM s) WHERE rn <= 5""",
)
def _(t):
    return matching.score_pairs(*_scored_sides(t), k=5)


def _scored_sides(t):
    k, size = F.col("c_custkey"), F.col("p_size")
    users = t.customer.select(
        k.alias("user_id"), F.array(F.lower("c_mktsegment"), F.lit("red"), F.lit("small"), F.lit("ring"), F.lit("new")).alias("skills"),
        F.concat(F.lit("Brand#"), F.col("c_nationkey") % 25 + 1).alias("category"), (F.col("c_nationkey") % 3).cast("string").alias("work_form"),
        (k % 7).cast("string").alias("location"), (k % 15).cast("double").alias("years"),
    )
    jobs = t.part.select(
        F.col("p_partkey").alias("job_key"), F.split("p_name", " ").alias("skills"), F.col("p_brand").alias("category"),
        (size % 3).cast("string").alias("work_form"), (F.col("p_partkey") % 7).cast("string").alias("location"),
        (size % 12).cast("double").alias("min_years"), F.when(size % 2 == 0, (size % 12 + 1).cast("double")).alias("max_years"),
    )
    return users, jobs


@query(
    "x32_x33_match_explanations",
    """WITH b AS (SELECT l_orderkey, l_linenumber, l_partkey, o_custkey % 15 AS years, p_size % 12 AS lo, CASE WHEN p_size % 2 = 0 THEN p_size % 12 + 1 END AS hi, string_split(p_name, ' ') AS sk, ['red', 'ring', 'small'] AS mine,
      CAST(o_orderdate AS DATE) AS d, CAST(l_shipdate AS DATE) AS e, p_brand FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber = 1 THEN 'fresher_fallback' WHEN years < lo THEN 'underqualified' WHEN years > coalesce(hi, 99) THEN 'overqualified' ELSE 'exact' END AS fit,
      CAST(date_diff('day', d, e) AS INT) AS days, array_to_string(list_sort(list_distinct(list_filter(sk, lambda x: list_contains(mine, x)))), ',') AS have,
      array_to_string(list_sort(list_distinct(list_filter(sk, lambda x: NOT list_contains(mine, x)))), ',') AS lack, CASE WHEN lo > 0 THEN (lo * 1000000)::BIGINT || '–' || (coalesce(hi, lo) * 1000000)::BIGINT || ' VND/range' ELSE 'Thỏa thuận' END AS salary,
      10.0 * len(list_intersect(mine, sk)) / len(list_distinct(sk)) + 3 * CAST(p_brand = 'Brand#1' AS INT) + 2 * CAST(years BETWEEN lo AND coalesce(hi, lo + 2) AS INT) AS score FROM b""",
)
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    size = F.col("p_size")
    low, high = (size % 12).cast("double"), F.when(size % 2 == 0, (size % 12 + 1).cast("double"))
    years, mine = (F.col("o_custkey") % 15).cast("double"), F.array(F.lit("red"), F.lit("ring"), F.lit("small"))
    wanted, source = F.split("p_name", " "), F.when(F.col("l_linenumber") == 1, "default").otherwise("explicit")
    pay = scoring.salary_label((low * 1e6).cast("bigint"), (F.coalesce(high, low) * 1e6).cast("bigint"), F.lit(None).cast("string"), F.lit("range"))
    no = F.lit(False)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", scoring.explain_experience(source, years, low, high).alias("fit"),
        scoring.days_left(F.to_date("l_shipdate"), F.to_date("o_orderdate")).alias("days"), F.array_join(scoring.matched(mine, wanted), ",").alias("have"),
        F.array_join(scoring.missing(mine, wanted), ",").alias("lack"), F.replace(pay, F.lit(","), F.lit("")).alias("salary"),
        scoring.match_score(mine, wanted, F.col("p_brand") == "Brand#1", no, no, years, low, high).alias("score"),
    )


# -- N06 .. N12: collaborative filtering -----------------------------------------------------------------------

_RATINGS = """r0 AS (SELECT DISTINCT o_custkey AS u, l_partkey AS i, l_orderkey % 5 + 1 AS r FROM lineitem JOIN orders ON o_orderkey = l_orderkey), ratings AS (SELECT u, i, CAST(max(r) AS DOUBLE) AS r FROM r0 GROUP BY 1, 2)"""


def ratings(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(F.col("o_custkey").alias("user"), F.col("l_partkey").alias("item")).agg(F.max(F.col("l_orderkey") % 5 + 1).cast("double").alias("rating"))


def _cf_sql(me: str, other: str) -> str:
    return f"""WITH {_RATINGS}, n AS (SELECT {me} AS a, {other} AS b, r / sqrt(sum(r * r) OVER (PARTITION BY {me})) AS x FROM ratings),
    sims AS (SELECT p.a, q.a AS b, round(sum(p.x * q.x), 9) AS sim FROM n p JOIN n q ON p.b = q.b AND p.a <> q.a GROUP BY 1, 2),
    near AS (SELECT a, b, sim FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY sim DESC, b) AS rn FROM sims WHERE sim > 0) WHERE rn <= 20),
    votes AS (SELECT w.{me} AS a, w.{other} AS b, sum(sim * k.r) / sum(sim) AS p FROM ratings w JOIN near ON near.a = w.{me} JOIN ratings k ON k.{me} = near.b AND k.{other} = w.{other} GROUP BY 1, 2)
    SELECT {'a' if me == 'u' else 'b'} AS "user", {'b' if me == 'u' else 'a'} AS item, round(p, 6) AS prediction FROM votes"""


@query("n06_user_based_filtering", _cf_sql("u", "i"))
def _(t):
    known = written(ratings(t))
    return collaborative.user_cf(known, known, k=20).select("user", "item", F.round("prediction", 6).alias("prediction"))


@query("n07_item_based_filtering", _cf_sql("i", "u"))
def _(t):
    known = written(ratings(t))
    return collaborative.item_cf(known, known, k=20).select("user", "item", F.round("prediction", 6).alias("prediction"))


@query("n08_n10_matrix_factorisation_error")
def _(t):
    known = written(ratings(t))
    model = collaborative.als(known, rank=8, iterations=5, reg=0.1)
    return collaborative.rating_error(model.transform(known), "rating", "prediction")


@query("n09_implicit_ranking")
def _(t):
    known = written(ratings(t).withColumn("rating", F.lit(1.0)))
    model = collaborative.als(known, implicit=True, rank=8, iterations=5, reg=0.1)
    return collaborative.recommend(model.userFactors, model.itemFactors, 10)


@query("n08_error_below_the_mean_rating", f"WITH {_RATINGS} SELECT CAST(count(*) AS BIGINT) AS n, true AS better FROM ratings")
def _(t):
    """The factors err less than a constant: the root mean square error against the spread of the ratings."""
    known = written(ratings(t))
    model = collaborative.als(known, rank=8, iterations=5, reg=0.1)
    error = collaborative.rating_error(model.transform(known), "rating", "prediction")
    spread = known.agg(F.stddev_pop("rating").alias("v")).scalar()
    return error.select("n", (F.col("rmse") < spread).alias("better"))


@query("n09_lists_are_whole", f"WITH {_RATINGS}, n AS (SELECT least(10, count(DISTINCT i)) AS most FROM ratings) SELECT u AS \"user\", CAST(any_value(most) AS BIGINT) AS items, CAST(any_value(most) AS BIGINT) AS places FROM ratings, n GROUP BY 1")
def _(t):
    known = written(ratings(t).withColumn("rating", F.lit(1.0)))
    model = collaborative.als(known, implicit=True, rank=8, iterations=5, reg=0.1)
    recs = collaborative.recommend(model.userFactors, model.itemFactors, 10)
    return recs.groupBy("user").agg(F.count_distinct("item").alias("items"), F.count_distinct("position").alias("places"))


@query(
    "n10_rating_error",
    f"WITH {_RATINGS} SELECT CAST(count(*) AS BIGINT) AS n, round(sqrt(avg((r - 3) * (r - 3))), 9) AS rmse, round(avg(abs(r - 3)), 9) AS mae FROM ratings",
)
def _(t):
    scored = collaborative.rating_error(ratings(t).withColumn("prediction", F.lit(3.0)), "rating", "prediction")
    return scored.select("n", F.round("rmse", 9).alias("rmse"), F.round("mae", 9).alias("mae"))


@query(
    "n11_ranking_metrics",
    f"""WITH {_RATINGS}, recs AS (SELECT u, i, row_number() OVER (PARTITION BY u ORDER BY r DESC, i) AS pos FROM ratings WHERE i % 7 <> 0), truth AS (SELECT u, i FROM ratings WHERE i % 3 = 0),
    hits AS (SELECT u, count(*) AS h, sum(1 / log2(pos + 1)) AS dcg FROM recs JOIN truth USING (u, i) WHERE pos <= 10 GROUP BY 1), w AS (SELECT u, count(*) AS n FROM truth WHERE u IN (SELECT u FROM recs) GROUP BY 1),
    ideal AS (SELECT n, list_sum(list_transform(range(1, least(n, 10) + 1), lambda x: 1 / log2(x + 1))) AS best FROM (SELECT DISTINCT n FROM w))
    SELECT CAST(count(*) AS BIGINT) AS users, round(avg(coalesce(h, 0) / 10.0), 9) AS precision, round(avg(coalesce(h, 0) / n), 9) AS recall, round(avg(coalesce(dcg, 0) / best), 9) AS ndcg FROM w JOIN ideal USING (n) LEFT JOIN hits USING (u)""",
)
def _(t):
    known = ratings(t)
    listed = known.filter(F.col("item") % 7 != 0)
    recs = windows.top_k(listed, ["user"], [F.desc("rating"), F.asc("item")], 10, rank="position").select("user", "item", "position")
    metrics = collaborative.ranking_metrics(recs, known.filter(F.col("item") % 3 == 0), 10)
    return metrics.select("users", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "ndcg")])


@query(
    "n12_recommendation_quality",
    """WITH f AS (SELECT CASE WHEN l_linenumber < 4 THEN 'a' ELSE 'b' END AS method, 'Brand#' || (1 + c_nationkey % 25) = p_brand AS same, c_custkey % 15 BETWEEN p_size % 12 AND CASE WHEN p_size % 2 = 0 THEN p_size % 12 + 1 ELSE 100 END AS fits,
      len(list_intersect(['red', 'small', 'ring'], string_split(p_name, ' '))) AS overlap FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey)
    SELECT method, round(avg(overlap), 9) AS avg_skill_overlap, round(avg(CAST(same AS INT)), 9) AS category_match_rate, round(avg(CAST(fits AS INT)), 9) AS experience_match_rate FROM f GROUP BY 1""",
)
def _(t):
    who = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    recs = who.select(F.when(F.col("l_linenumber") < 4, "a").otherwise("b").alias("method"), F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("job_key"))
    users = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.concat(F.lit("Brand#"), F.col("c_nationkey") % 25 + 1).alias("preferred_category"),
        (F.col("c_custkey") % 15).cast("double").alias("years_experience"), F.array(F.lit("Red "), F.lit("small"), F.lit("ring")).alias("skills"),
    )
    size = F.col("p_size")
    jobs = t.part.select(
        F.col("p_partkey").alias("job_key"), F.split("p_name", " ").alias("skills_all"), F.col("p_brand").alias("category_name_final"),
        (size % 12).cast("double").alias("min_years"), F.when(size % 2 == 0, (size % 12 + 1).cast("double")).alias("max_years"),
    )
    q = collaborative.rec_quality(recs, jobs, users)
    return q.select("method", *[F.round(c, 9).alias(c) for c in ("avg_skill_overlap", "category_match_rate", "experience_match_rate")])


# -- S: pages, payloads and file scans ---------------------------------------------------------------------------


@query(
    "s23_page_fields_by_expression",
    r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS title FROM pages""",
)
def _(t):
    title = pages.page_field(F.col("html"), r"(?s)<title>(.*?)</title>")
    return t.pages.select("page_id", F.coalesce(title, F.lit("")).alias("title"))


_PAGE = """SELECT page_id, 'Job ' || page_id AS title, 'ACME ' || page_id % 7 AS company, page_id % 50 || ' - ' || page_id % 50 + 5 || ' triệu' AS salary, 'Hà Nội' AS location, 'Đại học' AS education,
  'IT|Sales' AS industries, 'Python|SQL' AS skills, length(html) AS size FROM pages"""


@query("s23_extracted_postings", _PAGE)
def _(t):
    p = F.col("page_id")
    block = F.concat(
        F.lit('<h1 class="title">Job '), p, F.lit('</h1><a class="company">ACME '), p % 7,
        F.lit('</a><div class="map"><a>Hà Nội</a></div><ul><li><strong>Lương</strong><p>'), p % 50, F.lit(" - "), p % 50 + 5,
        F.lit(" triệu</p></li><li><strong>Ngành nghề</strong><p>IT, Sales</p></li><li>Bằng cấp: Đại học</li></ul>"),
        F.lit('<div class="job-tags"><a>Python</a><a>SQL</a></div>'),
    )
    # the posting block stands in front of the whole original page
    found = pages.extract_postings(t.spread("pages", "page_id").select("page_id", F.concat(block, "html").alias("html")))
    return found.join(t.pages.select("page_id", F.length("html").alias("size")), "page_id").select(
        "page_id", "title", "company", "salary", "location", "education", F.array_join("industries", "|").alias("industries"),
        F.array_join("skills", "|").alias("skills"), "size",
    )


@query(
    "s24_flattened_payloads",
    """SELECT p_partkey, p_name AS title, p_brand AS location, 'degree ' || p_size % 4 AS education, coalesce('type ' || nullif(p_size % 3, 2), '') AS work_form, p_type || '|' || p_brand AS skills,
      'Mô tả công việc' || chr(10) || p_type || chr(10) || 'Yêu cầu công việc' || chr(10) AS job_description FROM part""",
)
def _(t):
    size = F.col("p_size")
    payload = F.to_json(F.struct(
        F.col("p_name").alias("jobTitle"), F.array(F.struct(F.col("p_brand").alias("address"))).alias("workingLocations"), F.col("p_type").alias("jobDescription"),
        (size % 4).alias("highestDegreeId"), (size % 3).alias("typeWorkingId"), F.concat(F.lit("u/"), "p_partkey").alias("jobUrl"),
        F.array(F.struct(F.col("p_type").alias("skillName")), F.struct(F.col("p_brand").alias("skillName"))).alias("skills"),
    ))
    degrees = t.part.select((size % 4).cast("bigint").alias("id")).distinct().withColumn("name", F.concat(F.lit("degree "), "id"))
    types = t.part.select((size % 3).cast("bigint").alias("id")).distinct().filter(F.col("id") != 2).withColumn("name", F.concat(F.lit("type "), "id"))
    flat = pages.flatten_payload(t.part.select(payload.alias("payload"), F.lit("c").alias("category")), "payload", degrees, types)
    return flat.select(
        F.substring("link", 3, 20).cast("bigint").alias("p_partkey"), "title", F.array_join("location", "|").alias("location"), "education",
        F.coalesce("work_form", F.lit("")).alias("work_form"), F.array_join("skills", "|").alias("skills"), "job_description",
    )


_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query("s04_s19_file_scan", " UNION ALL ".join(f"SELECT '{n}' AS name, 'ok' AS status, CAST(count(*) AS BIGINT) AS num_rows FROM {n}" for n in _TABLES))
def _(t):
    scan = files.scan_files(t.spark, f"{t.folder}/*.parquet")
    name = F.regexp_extract("path", r"([^/]+)\.parquet$", 1)
    return scan.select(name.alias("name"), "status", "num_rows").filter(F.col("name").isin(*_TABLES))


@query("s20_schema_mismatches", f"SELECT CAST({len(_TABLES) - 1} AS BIGINT) AS different")
def _(t):
    return files.schema_mismatches(files.scan_files(t.spark, f"{t.folder}/*.parquet")).agg(F.count(F.lit(1)).alias("different"))


@query(
    "s01_s02_conformed_batch",
    """SELECT p_partkey || '' AS link, p_name AS title, p_brand || ', ' || p_type AS location, '1' AS quantity, p_brand AS skills, 'a' AS platform FROM part
    UNION ALL SELECT c_custkey || '', c_name, c_mktsegment, c_nationkey || '', '', 'b' FROM customer""",
)
def _(t):
    a = t.part.select(F.col("p_partkey").alias("link"), F.col("p_name").alias("title"), F.array("p_brand", "p_type").alias("location"), F.col("p_brand").alias("skills"))
    b = t.customer.select(F.col("c_custkey").alias("link"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("location"), F.col("c_nationkey").alias("quantity"))
    both = files.conform(a, "a").unionByName(files.conform(b, "b"))
    return both.select("link", "title", "location", "quantity", F.array_join("skills", "|").alias("skills"), "platform")


@query(
    "j14_overlap_counts",
    """SELECT CAST(sum(len(list_intersect(['red', 'ring'], string_split(p_name, ' ')))) AS BIGINT) AS shared FROM part""",
)
def _(t):
    return t.part.agg(F.sum(overlap_count(F.array(F.lit(" RED"), F.lit("ring")), F.split("p_name", " "))).alias("shared"))
