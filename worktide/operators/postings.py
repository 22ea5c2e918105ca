"""Exact top-k by sparse dot products over inverted lists in layers of impact, with maximum-score bounds.

A term's list holds its weight in every document, in layers of similar weight. What the k-th
document has from a query's strongest layers alone is a bound. Layers whose largest possible contributions together
stay well below the bound cannot bring a document into the result: they are not joined, and a document is
completed only if what it has plus those contributions reaches the bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage
from .windows import top_k

#: Lists longer than this are cut into parts, each of which meets the queries on its own.
LIST_PART = 1 << 15
#: At most so many lists can be long; they are told to both sides by broadcast.
LONG_LISTS = 1 << 14
#: Layers are put aside as long as their contributions stay below this share of the bound: a larger one leaves more documents to complete.
WEAK_SHARE = 0.2
#: Queries that complete one document are spread over a copy of it for so many of them.
PAIRS_OF_A_DOCUMENT = 1 << 10
LIST = ["term", "_layer"]
#: Rows of one key in a lookup are spread over so many copies of the looked-up row.
COPIES = 16


def spread_lookup(rows: DataFrame, lookup: DataFrame, on: str, spread: str) -> DataFrame:
    """Inner join with few ``lookup`` rows per key; rows of a frequent key are spread by a hash of ``spread``."""
    copied = lookup.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    salted = rows.withColumn("_copy", F.pmod(F.xxhash64(spread), F.lit(COPIES)).cast("int"))
    return salted.join(copied, [on, "_copy"]).drop("_copy")


def _parts(stats: DataFrame) -> DataFrame:
    """The lists that are long on either side, with _doc_parts and _query_parts; at most LONG_LISTS rows."""
    total = stats.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("qf"), F.lit(0))).first()
    least = [max(LIST_PART, n // (LONG_LISTS // 2)) for n in total]
    long = stats.filter((F.col("df") > least[0]) | (F.col("qf") > least[1]))
    sizes = [F.ceil(F.col(c) / LIST_PART).cast("int").alias(n) for c, n in (("df", "_doc_parts"), ("qf", "_query_parts"))]
    return F.broadcast(long.select(*LIST, *sizes))


def _meet(queries: DataFrame, docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Inner join on the list; parts of long lists meet one another cell by cell."""

    def side(df: DataFrame, key: str, own: str, other: str, names: tuple[str, str]) -> DataFrame:
        known = df.join(parts, LIST, "left")
        dealt = F.pmod(F.xxhash64(key), F.coalesce(own, F.lit(1)).cast("bigint")).cast("int").alias(names[0])
        copies = F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1)).alias(names[1])
        return known.select(*df.columns, dealt, copies)

    left = side(queries, "_q", "_query_parts", "_doc_parts", ("_qp", "_dp"))
    right = side(docs, "_d", "_doc_parts", "_query_parts", ("_dp", "_qp"))
    return left.join(right, [*LIST, "_qp", "_dp"])


def _exact(pairs: DataFrame, queries: DataFrame, docs: DataFrame) -> DataFrame:
    """_q, _d, _score of the given pairs, over all terms both have; only the lists' entries of these documents are read on."""
    named = pairs.groupBy("_d").agg(F.ceil(F.count(F.lit(1)) / PAIRS_OF_A_DOCUMENT).alias("_copies"))
    dealt = pairs.join(named, "_d").select("_q", "_d", F.pmod(F.xxhash64("_q"), F.col("_copies")).alias("_copy"))
    rows = docs.select("_d", "term", "_dw").join(named, "_d").withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_copies") - 1)))
    met = dealt.join(rows.drop("_copies"), ["_d", "_copy"]).join(queries, ["_q", "term"])
    return met.groupBy("_q", "_d").agg(F.sum(F.col("_qw") * F.col("_dw")).alias("_score"))


def sparse_top_k(
    queries: DataFrame, query_key: str, docs: DataFrame, doc_key: str, k: int, digits: int = 6, seeds: int = 32
) -> DataFrame:
    """(query_key, doc_key, score): the ``k`` documents of largest positive dot product per query, ties by smaller key.

    Both sides are rows of key, ``term`` and ``weight``; weights that are not positive count as absent, and a
    key has a term once. Scores are rounded to ``digits`` before they are ranked. Nulls in any of the three drop the row.
    Queries with equal rows are answered once.
    """
    q = queries.select(F.col(query_key).alias("_key"), "term", F.col("weight").cast("double").alias("_w")).filter("_key IS NOT NULL AND term IS NOT NULL AND _w > 0")
    d = docs.select(F.col(doc_key).alias("_d"), "term", F.col("weight").cast("double").alias("_dw")).filter("_d IS NOT NULL AND term IS NOT NULL AND _dw > 0")
    # One query per distinct vector.
    vectors = q.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("term", "_w"))).alias("_v"))
    vectors = cut_lineage(vectors.withColumn("_same", F.sha2(F.to_json("_v"), 256)))
    firsts = vectors.groupBy("_same").agg(F.min("_key").alias("_q"))
    members = spread_lookup(vectors.select("_key", "_same"), firsts, "_same", "_key").select("_key", "_q")
    one = vectors.join(firsts.select(F.col("_q").alias("_key")), "_key", "left_semi").select(F.col("_key").alias("_q"), F.explode("_v").alias("_t"))
    one = cut_lineage(one.select("_q", F.col("_t.term").alias("term"), F.col("_t._w").alias("_qw")))

    # The lists of the terms that are asked for, in layers: a layer's weights differ by a factor of two at most.
    used = one.groupBy("term").agg(F.count(F.lit(1)).alias("qf"))
    layer = F.floor(-F.log2("_dw")).cast("int")
    d = cut_lineage(d.join(used.select("term"), "term", "left_semi").withColumn("_layer", layer))
    stats = d.groupBy(*LIST).agg(F.count(F.lit(1)).alias("df"), F.max("_dw").alias("_most")).join(used, "term")
    stats = cut_lineage(stats)
    parts = _parts(stats)
    found = one.join(stats.drop("qf"), "term").withColumn("_top", F.col("_qw") * F.col("_most"))
    rank = Window.partitionBy("_q")  # a group is the terms of one query, in their layers
    bounded = cut_lineage(found.withColumn("_rank", F.row_number().over(rank.orderBy(F.desc("_top"), "df", *LIST))))

    # A bound: what the k-th document has from the strongest layers alone.
    seeded = _meet(bounded.filter(F.col("_rank") <= seeds).select("_q", *LIST, "_qw"), d, parts)
    named = top_k(seeded.groupBy("_q", "_d").agg(F.sum(F.col("_qw") * F.col("_dw")).alias("_part")), ["_q"], [F.desc("_part"), F.asc("_d")], k)
    reached = named.groupBy("_q").agg(F.count(F.lit(1)).alias("_n"), F.min("_part").alias("_least"))
    spare = 2 * 10.0**-digits
    bound = reached.filter(F.col("_n") == k).select("_q", (F.col("_least") - spare).alias("_bound"))

    # Weak layers, smallest contributions first. Of a term's weak layers a document is in one, so only their largest counts.
    lower = F.coalesce(F.lag("_top").over(Window.partitionBy("_q", "term").orderBy("_top", F.desc("_layer"))), F.lit(0.0))
    order = rank.orderBy("_top", F.desc("df"), "term", F.desc("_layer")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = bounded.withColumn("_more", F.col("_top") - lower).withColumn("_sum", F.sum("_more").over(order)).join(bound, "_q", "left")
    split = split.withColumn("_weak", F.coalesce(F.col("_sum") < WEAK_SHARE * F.col("_bound"), F.lit(False)))
    split = split.withColumn("_rest", F.coalesce(F.max(F.when(F.col("_weak"), F.col("_sum"))).over(rank), F.lit(0.0)))
    split = cut_lineage(split.select("_q", *LIST, "_qw", "_weak", "_rest", "_bound"))
    met = _meet(split.filter(~F.col("_weak")).drop("_weak"), d, parts)
    gathered = met.groupBy("_q", "_d").agg(
        F.sum(F.col("_qw") * F.col("_dw")).alias("_part"), F.first("_rest").alias("_rest"), F.first("_bound").alias("_bound")
    )
    hopeful = cut_lineage(gathered.filter(F.col("_bound").isNull() | (F.col("_part") + F.col("_rest") >= F.col("_bound"))))
    # The k-th of the parts is a bound as well, and often a better one.
    kth = top_k(hopeful, ["_q"], [F.desc("_part"), F.asc("_d")], k).groupBy("_q").agg(F.count(F.lit(1)).alias("_n"), F.min("_part").alias("_least"))
    better = kth.filter(F.col("_n") == k).select("_q", (F.col("_least") - spare).alias("_better"))
    left = hopeful.join(better, "_q", "left").filter(F.col("_better").isNull() | (F.col("_part") + F.col("_rest") >= F.col("_better")))
    # Queries without weak layers have their scores already.
    whole = left.filter("_rest = 0").select("_q", "_d", F.col("_part").alias("_score"))
    scored = whole.unionByName(_exact(left.filter("_rest > 0").select("_q", "_d"), one, d)).select("_q", "_d", F.round("_score", digits).alias("score"))
    best = top_k(scored, ["_q"], [F.desc("score"), F.asc("_d")], k)
    ranked = best.groupBy("_q").agg(F.collect_list(F.struct("_d", "score")).alias("_best"))  # k at most
    result = spread_lookup(members, ranked, "_q", "_key").select("_key", F.explode("_best").alias("_b"))
    return result.select(F.col("_key").alias(query_key), F.col("_b._d").alias(doc_key), F.col("_b.score").alias("score"))


def fill_with_zeros(found: DataFrame, queries: DataFrame, query_key: str, docs: DataFrame, doc_key: str, k: int) -> DataFrame:
    """``found`` with documents of score 0 where a query has fewer than ``k``: those of smallest key it does not have."""
    first = [r[0] for r in docs.select(doc_key).filter(F.col(doc_key).isNotNull()).distinct().orderBy(doc_key).limit(2 * k).collect()]
    if not first:
        return found
    counts = found.groupBy(query_key).agg(F.count(F.lit(1)).alias("_n"))
    kind = docs.schema[doc_key].dataType
    few = queries.select(query_key).distinct().join(counts, query_key, "left").filter(F.coalesce("_n", F.lit(0)) < k)
    listed: Column = F.array(*[F.lit(x).cast(kind) for x in first])
    more = few.select(query_key, F.explode(listed).alias(doc_key)).join(found, [query_key, doc_key], "left_anti")
    every = found.unionByName(more.withColumn("score", F.lit(0.0)))
    return top_k(every, [query_key], [F.desc("score"), F.asc(doc_key)], k)
