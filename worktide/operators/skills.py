"""Skill extraction, canonicalisation and the growing skill dimension."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import collapse, is_noise, protect_terms, smart_title, split_span
from ..session import cut_lineage
from . import metric
from .merge import only_new
from .postings import spread_lookup
from .windows import assign_keys, top_k

SKIP = "__SKIP__"


def stack_arrays(df: DataFrame, keys: Sequence[str], columns: dict[str, str]) -> DataFrame:
    """One row per list entry, tagged with its type: ``{"tech": "tech_skills", ...}``, in one scan."""
    tagged = F.array(*[F.struct(F.lit(t).alias("skill_type"), F.col(c).alias("items")) for t, c in columns.items()])
    rows = df.select(*keys, F.inline(tagged)).select(*keys, "skill_type", F.explode("items").alias("raw_skill"))
    return rows.filter(F.trim("raw_skill") != "")


def find_terms(df: DataFrame, key: str, text: str, vocab: DataFrame, term: str = "term") -> DataFrame:
    """(key, term, pos, size): vocabulary terms found on word boundaries.

    Texts become word n-grams that meet the vocabulary in an equi-join, so cost grows with the text
    and not with text x vocabulary. Only the word counts that occur in the vocabulary are formed.
    """
    clean = F.lower(F.regexp_replace(F.col(text), r"[^\p{L}\p{M}\p{Nd}\p{Pc}+#.]+", " "))
    words = F.filter(F.split(F.regexp_replace(clean, r"\.(?= |$)", ""), " "), lambda w: w != "")
    known = vocab.select(term, F.lower(F.trim(term)).alias("_gram")).distinct()
    sizes = known.agg(F.collect_set(F.size(F.split("_gram", " ")))).scalar()
    tokens = df.select(key, words.alias("_w"), sizes.alias("_sizes"))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size("_w") - 1),
            lambda i: F.transform(
                F.filter("_sizes", lambda n: n <= F.size("_w") - i),
                lambda n: F.struct(
                    i.alias("pos"), n.alias("size"), F.array_join(F.slice(F.col("_w"), i + 1, n), " ").alias("_gram")
                ),
            ),
        )
    )
    # The outer form keeps Spark from building the n-grams once more in an inferred filter.
    exploded = tokens.select(key, F.inline_outer(F.when(F.size("_w") > 0, grams)))
    return exploded.join(known, "_gram").select(key, term, "pos", "size")


SEPARATORS = (",", ";", "/", "-", "–")


def _vocabulary_hits(df: DataFrame, key: str, text: str, vocab: DataFrame) -> DataFrame:
    """Spans (key, skill_type, span, pos): vocabulary hits, merged where only separators lie between.

    Positions count words and skip separators, so hits touch when one starts where the words of
    the one before end.
    """
    known = vocab.select("skill_type", F.lower(protect_terms(F.col("term"))).alias("_gram")).distinct()
    in_term = F.filter(F.split("_gram", " "), lambda w: ~w.isin(*SEPARATORS))
    sizes = known.agg(F.collect_set(F.size(in_term))).scalar()
    prepared = df.select(key, F.split(protect_terms(F.col(text)), " ").alias("_t"), sizes.alias("_sizes"))
    words = F.filter(
        F.transform("_t", lambda t, i: F.struct(t.alias("t"), i.alias("i"))), lambda e: ~e["t"].isin(*SEPARATORS)
    )
    placed = prepared.withColumn("_w", words)

    def gram(j: Column, n: Column) -> Column:
        first, last = F.get("_w", j)["i"], F.get("_w", j + n - 1)["i"]
        joined = F.array_join(F.slice(F.col("_t"), first + 1, last - first + 1), " ")
        # With the separators up to the next word, so that the text of merged hits can be put together from theirs.
        upto = F.coalesce(F.get("_w", j + n)["i"], last + 1)
        own = F.transform(F.sequence(first, upto - 1), lambda i: F.struct(i.alias("i"), F.get("_t", i).alias("t")))
        return F.struct(
            first.alias("start"), (last + 1).alias("stop"), j.alias("pos"), (j + n).alias("end"), F.lower(joined).alias("_gram"), own.alias("_own")
        )

    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size("_w") - 1),
            lambda j: F.transform(F.filter("_sizes", lambda n: (n > 0) & (n <= F.size("_w") - j)), lambda n: gram(j, n)),
        )
    )
    hits = placed.select(key, F.inline_outer(F.when(F.size("_w") > 0, grams))).join(known, "_gram")
    by_text = Window.partitionBy(key, "skill_type").orderBy("start", F.desc("stop"))
    reach = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.withColumn("_new", F.when(reach >= F.col("pos"), 0).otherwise(1))
    upto = by_text.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (
        opened.withColumn("_island", F.sum("_new").over(upto))
        .groupBy(key, "skill_type", "_island")
        .agg(F.min("start").alias("pos"), F.max("stop").alias("_stop"), F.flatten(F.collect_list("_own")).alias("_own"))
    )
    words_of = F.filter(F.array_sort(F.array_distinct("_own")), lambda e: e["i"] < F.col("_stop"))
    return spans.select(key, "skill_type", F.array_join(F.transform(words_of, lambda e: e["t"]), " ").alias("span"), "pos")


def extract_skills(
    df: DataFrame, key: str, text: str, vocab: DataFrame | None, model_fn: Callable | None = None
) -> DataFrame:
    """(key, tech_skills, soft_skills) from a typed vocabulary (term, skill_type).

    Spans split into clean names that keep their order of appearance. ``model_fn(batches)`` may
    supply the spans instead, as an Arrow-batch function yielding (key, skill_type, span, pos).
    """
    if model_fn is not None:
        kind = df.schema[key].dataType.simpleString()
        spans = df.select(key, text).mapInPandas(model_fn, f"{key} {kind}, skill_type string, span string, pos int")
    else:
        spans = _vocabulary_hits(df, key, text, vocab)
    pieces = F.posexplode_outer(split_span(F.col("span"))).alias("sub", "name")
    names = spans.select(key, "skill_type", "pos", pieces).filter(F.col("name").isNotNull())
    firsts = names.groupBy(key, "skill_type", F.lower("name").alias("_low")).agg(
        F.min(F.struct("pos", "sub", "name")).alias("_item")
    )
    lists = firsts.groupBy(key).agg(*[
        F.array_sort(F.collect_list(F.when(F.col("skill_type") == t, F.col("_item")))).alias(f"_{t}") for t in ("tech", "soft")
    ])
    empty = F.array().cast("array<string>")
    return df.select(key).join(lists, key, "left").select(
        key, *[F.coalesce(F.col(f"_{t}.name"), empty).alias(f"{t}_skills") for t in ("tech", "soft")]
    )


def _numbered(vectors: DataFrame, item: str, vector: str, rank: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows with a rank and a direction, rows without, and the distinct vectors of the former as nodes in the order of rank and item."""
    every = cut_lineage(vectors.select(F.col(rank).cast("bigint").alias("rank"), F.col(item).alias("item"), F.col(vector).alias("vector")))
    rows = metric.unit_rows(every.filter("rank IS NOT NULL"), "vector").drop("_unit")
    directed = F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    alone = every.filter(~directed | F.col("rank").isNull())
    return rows, alone, cut_lineage(metric.distinct_nodes(rows))


def leaders(vectors: DataFrame, item: str, vector: str, rank: str, tau: float = 0.88) -> DataFrame:
    """Greedy leader canonicalisation: (item, leader).

    Going down the ranking, an item without an earlier leader within cosine ``tau`` becomes one, and the others join
    their first leader (``metric.greedy_leaders``). Zero and null vectors are near nothing and lead alone, as do items without a rank.
    Items of one rank are ordered by item and vector; equal vectors are decided once.
    """
    rows, alone, nodes = _numbered(vectors, item, vector, rank)
    found = metric.greedy_leaders(nodes, tau)
    names = nodes.select(F.col("node").alias("leader"), F.col("item").alias("_name"))
    led = nodes.select("node", "vector").join(found, "node").join(names, "leader").select("vector", F.col("_name").alias("leader"))
    members = spread_lookup(rows, led, "vector", "item").select("item", "leader")
    return members.unionByName(alone.select("item", F.col("item").alias("leader")))


def components(vectors: DataFrame, item: str, vector: str, rank: str, tau: float) -> DataFrame:
    """(item, cluster): connected groups of vectors within cosine ``tau``; cluster = smallest rank.

    Vectors without a direction, and items without a rank, are groups of their own. This groups differently from a
    density clustering.
    """
    rows, alone, nodes = _numbered(vectors, item, vector, rank)
    found = metric.linked_components(nodes, tau)
    ranks = nodes.select(F.col("node").alias("cluster"), F.col("rank").alias("_rank"))
    grouped = nodes.select("node", "vector").join(found, "node").join(ranks, "cluster").select("vector", F.col("_rank").alias("cluster"))
    members = spread_lookup(rows, grouped, "vector", "item").select("item", "cluster")
    return members.unionByName(alone.select("item", F.col("rank").alias("cluster")))


def cluster_canonicals(clusters: DataFrame, freq: DataFrame, item: str = "item") -> DataFrame:
    """(item, canonical) for clusters of at least two; the most frequent member names the cluster."""
    sized = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= 2)
    members = clusters.join(sized, "cluster").join(freq.select(item, "freq"), item)
    names = top_k(members, ["cluster"], [F.desc("freq"), F.asc(item)], 1).select("cluster", F.col(item).alias("canonical"))
    return members.join(names, "cluster").select(item, "canonical")


def nearest(vectors: DataFrame, item: str, pool: DataFrame, name: str, vector: str, tau: float = 0.93, by: str | None = None) -> DataFrame:
    """(item, name, score): the most similar pool entry at or above ``tau``, within the same ``by``."""
    return metric.nearest_in_pool(vectors, item, pool, name, vector, tau, by)


def category_by_vector(jobs: DataFrame, key: str, categories: DataFrame, vector: str, tau: float, default: str) -> DataFrame:
    """(key, category, score): nearest category text by cosine, else the default; a vector without a direction scores 0."""
    best = jobs.select(key).join(nearest(jobs, key, categories, "category", vector, tau=-1.0), key, "left")
    score = F.coalesce("score", F.lit(0.0))
    final = F.when(score >= tau, F.col("category")).otherwise(F.lit(default))
    return best.select(key, final.alias("category"), score.alias("score"))


def cascade(skills: DataFrame, rules: DataFrame, sims: DataFrame, clusters: DataFrame) -> DataFrame:
    """Canonical form by priority: rule, similarity, cluster, itself; a skill of both types is tech."""
    both = skills.groupBy("raw_skill").agg(
        F.max(F.col("skill_type") == "tech").alias("_tech"), F.max(F.col("skill_type") == "soft").alias("_soft")
    )
    on = ["raw_skill", "skill_type"]
    named = skills.select(*on).distinct()
    for i, source in enumerate((rules, sims, clusters)):
        named = named.join(source.select(*on, F.col("canonical").alias(f"_c{i}")), on, "left")
    named = named.join(both, "raw_skill")
    fallback = F.when(F.col("_tech"), "tech").when(F.col("_soft"), "soft").otherwise("unknown")
    taken = F.when(F.col("_c0").isNotNull(), "rule").when(F.col("_c1").isNotNull(), "sim")
    source = taken.when(F.col("_c2").isNotNull(), "cluster").otherwise("none")
    return named.select(
        "raw_skill", "skill_type", F.coalesce("_c0", "_c1", "_c2", "raw_skill").alias("canonical_skill"),
        F.when(source == "none", fallback).otherwise(F.col("skill_type")).alias("canonical_type"), source.alias("source"),
    )


def rule_table(spark: SparkSession, path: str) -> DataFrame:
    """Hand-filled rules (raw_skill_norm, skill_type, canonical); blank canonicals are skipped."""
    schema = "raw_skill_norm string, skill_type string, canonical string"
    rows = spark.read.csv(path, header=True, schema=schema, mode="DROPMALFORMED", enforceSchema=False)
    return clean_rules(rows)


def clean_rules(rows: DataFrame) -> DataFrame:
    kept = rows.filter(F.trim("canonical") != "")
    raw, kind = F.lower(F.trim("raw_skill_norm")), F.trim("skill_type")
    return kept.select(
        F.concat(raw, F.lit("|"), kind).alias("rule_key"), raw.alias("raw_skill"), kind.alias("skill_type"),
        smart_title(F.trim("canonical")).alias("canonical"),
    )


def mark_noise(mapping: DataFrame, canonical: str = "canonical_skill") -> DataFrame:
    """Replace canonicals that look like extraction noise by the skip marker."""
    noisy = (F.col(canonical) != SKIP) & is_noise(F.col(canonical))
    return mapping.withColumn(canonical, F.when(noisy, SKIP).otherwise(F.col(canonical)))


def canonical_list(df: DataFrame, key: str, skills: str, lookup: DataFrame) -> DataFrame:
    """Skill lists through a (raw_skill, canonical) lookup: unknown ones drop, repeats keep the first."""
    low = F.lower(collapse(F.col("raw")))
    long = df.select(key, F.posexplode(skills).alias("pos", "raw")).withColumn("raw_skill", low)
    firsts = long.join(lookup, "raw_skill").groupBy(key, "canonical").agg(F.min("pos").alias("pos"))
    lists = firsts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "canonical"))).alias("_items"))
    empty = F.array().cast("array<string>")
    return df.select(key).join(lists, key, "left").select(key, F.coalesce(F.col("_items.canonical"), empty).alias(skills))


def grow_skill_dim(raw: DataFrame, mapping: DataFrame, dim: DataFrame, alias: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New rows for the skill dimension and the alias table, from raw skill names of a batch.

    A canonical name seen with several types gets one row (tech before soft before others).
    """
    from .joins import map_alias

    names = raw.select(F.lower(F.trim("raw_skill")).alias("raw_skill")).filter(F.col("raw_skill") != "").distinct()
    mapped = cut_lineage(map_alias(names, mapping))
    order = F.when(F.col("skill_type") == "tech", 0).when(F.col("skill_type") == "soft", 1).otherwise(2)
    canon = mapped.groupBy(F.col("canonical_skill").alias("skill_name")).agg(
        F.min_by("skill_type", F.struct(order, "skill_type")).alias("skill_type")
    )
    fresh = only_new(canon, dim, ["skill_name"])
    new_dim = assign_keys(fresh, dim, "skill_key", [F.asc("skill_name")]).select("skill_key", "skill_name", "skill_type")
    every = dim.select("skill_key", "skill_name").unionByName(new_dim.select("skill_key", "skill_name"))
    keyed = every.select("skill_key", F.lower(F.trim("skill_name")).alias("_canon"))
    keyed = keyed.groupBy("_canon").agg(F.min("skill_key").alias("skill_key"))
    new_alias = (
        only_new(mapped, alias, ["raw_skill"])
        .withColumn("_canon", F.lower(F.trim("canonical_skill")))
        .join(keyed, "_canon")
        .select("raw_skill", "skill_key")
    )
    return new_dim, new_alias


def alias_dim(observed: DataFrame, dim: DataFrame) -> DataFrame:
    """(skill_norm, skill_key): the dimension's key, else the hash of the name itself."""
    known = dim.select(F.col("skill_canon_norm").alias("skill_norm"), F.col("skill_key").alias("_key")).distinct()
    named = observed.select("skill_norm").distinct().join(known, "skill_norm", "left")
    return named.select("skill_norm", F.coalesce("_key", F.sha2("skill_norm", 256)).alias("skill_key"))


def job_skills(jobs: DataFrame, alias: DataFrame, dim: DataFrame) -> DataFrame:
    """Distinct (job_key, skill_key, skill_type) from both skill lists of the postings.

    Postings are shuffled once, by job and with whole lists, and one row is left per job and skill where they arrive.
    """
    lists = jobs.select("job_key", "tech_skills", "soft_skills").repartition("job_key")
    long = stack_arrays(lists, ["job_key"], {"tech": "tech_skills", "soft": "soft_skills"})
    low: Column = F.lower(F.trim("raw_skill"))
    keyed = long.select("job_key", low.alias("raw_skill")).join(alias, "raw_skill")
    typed = keyed.select("job_key", "skill_key").distinct().join(dim.select("skill_key", "skill_type"), "skill_key", "left")
    return typed.select("job_key", "skill_key", "skill_type")
