"""The registered queries of the numbered operators, with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, bpe, chosen_path, fingerprints, language, licenses, lines, packing, repeats, toxicity, url_rules, whitening

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_bpe")
def op1_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ids = bpe.encode_column(table(spark, folder, "documents"), VOCABULARY, keep=("doc_id",))
    both = bpe.decode_column(ids, VOCABULARY)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(
    "op3_exact_dedup",
    r"""WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
    g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)""",
)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.exact_groups(table(spark, folder, "documents"))


@query("op4_pack")
def op4_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), VOCABULARY)


@query("op5_language")
def op5_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.learn(documents.where(~held_out), "doc_id", "text", "lang")
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), "lang_margin")


#: Host, path and verdict of the given URL rules.
URL_RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


@query("op7_url_rules")
def op7_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    return url_rules.judge(table(spark, folder, "pages"), URL_RULES)


@query(
    "op9_line_dedup",
    rf"""WITH l AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
    k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    hot AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
    m AS (SELECT k.doc_id, pos, line, coalesce(last <> doc_id, false) AS gone FROM k LEFT JOIN hot USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM m GROUP BY 1""",
)
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    kept = lines.apply_bitmaps(documents, lines.keep_bitmaps(documents))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op10_licenses", licenses.scan_sql())
def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op6_ann")
def op6_ann(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 100 = 0"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    model = toxicity.learn(documents, table(spark, folder, "labels").where(~held_out))
    found = toxicity.score(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


@query("op2_near_dedup")
def op2_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.components(table(spark, folder, "documents"))


@query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align_corpus(table(spark, folder, "documents"), BYTE_LEVEL, PIECES)


@query("op12_whitening")
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query(
    "op13_substring_dedup",
    r"""WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
    p AS (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 12)) AS pos FROM w),
    k AS (SELECT doc_id, pos, array_to_string(ws[pos:pos + 12], ' ') AS words FROM p),
    f AS (SELECT words, min(doc_id) AS first FROM k GROUP BY 1),
    gone AS (SELECT DISTINCT k.doc_id, unnest(generate_series(pos, pos + 12)) AS pos FROM k JOIN f USING (words) WHERE first < k.doc_id),
    each AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM w),
    kept AS (SELECT each.doc_id, count(*) AS n_words, count(gone.pos) AS n_removed, string_agg(word, ' ' ORDER BY each.pos) FILTER (gone.pos IS NULL) AS left_text
      FROM each LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.pos = each.pos GROUP BY 1)
    SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(left_text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
)
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = repeats.drop_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
