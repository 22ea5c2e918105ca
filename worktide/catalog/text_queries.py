"""Text, parsing and classification queries."""

from pyspark.sql import functions as F

from ..functions import classify, keys, parsing, text
from ..functions.rules import DEFAULT_SECTOR, SECTOR_RULES
from ..operators import joins, skills
from ..operators.prefix import ordered_prefix
from ..operators.rules import sector_by_keywords
from ..plans.silver import province
from .base import query
from .postings import SILVER_SQL, bronze

# SQL spelling of "any Unicode white space" and of a word character.
WS = r"[\s\x0b\x85\p{Z}]"
WORD = r"\p{L}\p{M}\p{Nd}\p{Pc}"


def squash(expr: str) -> str:
    return rf"trim(regexp_replace({expr}, '{WS}+', ' ', 'g'))"


def tidy(expr: str) -> str:
    opened = rf"regexp_replace(regexp_replace({expr}, '\( +', '(', 'g'), ' +\)', ')', 'g')"
    return rf"regexp_replace({opened}, '([^\s(])\(', '\1 (', 'g')"


@query("x01_normalize_common", f"SELECT doc_id, md5(nullif({tidy('lower(' + squash('text') + ')')}, '')) AS digest FROM documents")
def _(t):
    return t.spread("documents", "doc_id").select("doc_id", F.md5(text.normalize_common(F.col("text"))).alias("digest"))


_NAME = (
    rf"regexp_replace(regexp_replace(regexp_replace(text, ',([^\s\x0b\x85\p{{Z}}])', ', \1', 'g'), "
    rf"'([^\s\x0b\x85\p{{Z}}])-([^\s\x0b\x85\p{{Z}}])', '\1 - \2', 'g'), '[^{WORD}\s\x0b\x85\p{{Z}}.,\-/()]', ' ', 'g')"
)


@query(
    "x02_normalize_name",
    f"""WITH plain AS (SELECT o_orderkey, 'Dev(' || replace(o_orderpriority, ' ', '-') || ')/Kế toán,' || o_orderstatus || '*' AS text FROM orders),
    slashed AS (SELECT o_orderkey, replace(text, '/', ' / ') AS text FROM plain)
    SELECT o_orderkey, {tidy('lower(' + squash(_NAME) + ')')} AS name FROM slashed""",
)
def _(t):
    raw = F.concat(
        F.lit("Dev("), F.replace("o_orderpriority", F.lit(" "), F.lit("-")), F.lit(")/Kế toán,"), "o_orderstatus", F.lit("*")
    )
    return t.orders.select("o_orderkey", text.normalize_name(raw).alias("name"))


@query(
    "x03_unaccent",
    f"SELECT doc_id, md5(nullif({squash('replace(strip_accents(lower(text)), chr(273), chr(100))')}, '')) AS digest FROM documents",
)
def _(t):
    return t.spread("documents", "doc_id").select("doc_id", F.md5(text.unaccent(F.col("text"))).alias("digest"))


@query(
    "x04_parse_salary",
    f"""WITH {SILVER_SQL} SELECT k AS l_orderkey, p AS l_partkey, s AS l_suppkey, salary_type, coalesce(min_salary, -1) AS min_salary, coalesce(max_salary, -1) AS max_salary,
      CASE WHEN salary_type = 'negotiable' THEN NULL ELSE currency END AS currency, CAST(count(*) AS BIGINT) AS n
    FROM silver GROUP BY ALL""",
)
def _(t):
    line = F.struct("l_orderkey", "l_partkey", "l_suppkey")
    raw = t.spread("lineitem", "l_orderkey").select(line.alias("i"), "l_linenumber", F.col("l_quantity").cast("int").alias("q"))
    n, q = F.col("l_linenumber"), F.col("q")
    shown = (
        F.when(n == 1, F.concat(q, F.lit(" - "), q + 5, F.lit(" triệu")))
        .when(n == 2, F.concat(F.lit("Từ "), q, F.lit(" đến "), q + 5, F.lit(" triệu")))
        .when(n == 3, F.concat(F.lit("Lên đến "), q, F.lit(" triệu")))
        .when(n == 4, F.concat(F.lit("Từ "), q, F.lit(" triệu")))
        .when(n == 5, F.concat(F.lit("$"), q * 100)).when(n == 6, F.lit("Thỏa thuận")).otherwise(q.cast("string"))
    )
    parsed = raw.select("i.*", parsing.parse_salary(shown).alias("s"))
    low, high = (F.coalesce(f"s.{c}", F.lit(-1)).alias(c) for c in ("min_salary", "max_salary"))
    by = ["l_orderkey", "l_partkey", "l_suppkey", "s.salary_type", low, high, "s.currency"]
    return parsed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


@query(
    "x05_parse_money",
    """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS n, sum(floor(l_extendedprice)) AS whole,
      round(sum(round(l_extendedprice, 2)), 2) AS fraction FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    grouped = F.format_number(F.floor("l_extendedprice"), 0)
    exact = F.translate(F.format_number("l_extendedprice", 2), ",.", ".,")
    row = t.spread("lineitem", "l_orderkey").select(
        "l_orderkey", "l_linenumber", parsing.parse_money(F.concat(grouped, F.lit(" đ")), F.lit(False)).alias("w"),
        # thousands need their own separator next to the decimal one
        F.when(F.col("l_extendedprice") >= 1000, parsing.parse_money(exact, F.lit(True)))
        .otherwise(parsing.parse_money(F.format_string("%.2f", "l_extendedprice"), F.lit(True))).alias("f"),
    )
    return row.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.sum("w").alias("whole"), F.round(F.sum("f"), 2).alias("fraction")
    )


@query(
    "x06_parse_experience",
    f"""WITH {SILVER_SQL} SELECT p AS part, s AS supplier, experience_type, coalesce(min_years, -1) AS min_years, coalesce(max_years, -1) AS max_years, CAST(count(*) AS BIGINT) AS n
    FROM silver GROUP BY ALL""",
)
def _(t):
    raw = t.spread("lineitem", "l_orderkey").select("l_partkey", "l_suppkey")
    years, p = F.col("l_suppkey") % 5, F.col("l_partkey")
    shown = (
        F.when(p % 5 == 0, F.lit("Không yêu cầu"))
        .when(p % 5 == 1, F.concat(F.lit("Từ "), years, F.lit(" đến "), years + 2, F.lit(" năm")))
        .when(p % 5 == 2, F.concat(F.lit("Ít nhất "), years, F.lit(" năm")))
        .when(p % 5 == 3, F.concat(F.lit("Tối đa "), years + 1, F.lit(" years")))
        .otherwise(F.concat(years, F.lit(",5+ yrs")))
    )
    parsed = raw.select(p.alias("part"), F.col("l_suppkey").alias("supplier"), parsing.parse_experience(shown).alias("x"))
    low, high = (F.coalesce(f"x.{c}", F.lit(-1.0)).alias(c) for c in ("min_years", "max_years"))
    return parsed.groupBy("part", "supplier", "x.experience_type", low, high).agg(F.count(F.lit(1)).alias("n"))


@query(
    "x07_parse_date",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS labelled, strftime(o_orderdate, '%Y-%m-%d') AS iso,
      CAST(NULL AS VARCHAR) AS impossible FROM orders""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    label = F.concat(F.lit("Hạn nộp hồ sơ: "), F.date_format(day, "d/M/yyyy"))
    iso = F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    bad = F.concat(F.lit("31/02/"), F.year(day))
    return t.orders.select(
        "o_orderkey", parsing.parse_date(label).cast("string").alias("labelled"),
        parsing.parse_date(iso).cast("string").alias("iso"), parsing.parse_date(bad).cast("string").alias("impossible"),
    )


@query(
    "x08_x09_x10_level_education_form",
    f"""WITH {SILVER_SQL} SELECT company_clean AS company, level_standard AS level, education_standard AS education,
      work_form_standard AS form, CAST(count(*) AS BIGINT) AS n FROM silver GROUP BY ALL""",
)
def _(t):
    posts = bronze(t).select(
        text.normalize_name(F.col("company")).alias("company"), classify.level(F.col("level"))["group"].alias("level"),
        F.coalesce(classify.education(F.col("education"))["group"], F.lit("0")).alias("education"),
        classify.work_form(F.col("work_form")).alias("form"),
    )
    return posts.groupBy("company", "level", "education", "form").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x11_sector_by_platform",
    f"WITH {SILVER_SQL} SELECT platform, category_name_final AS sector, CAST(count(*) AS BIGINT) AS n FROM silver GROUP BY ALL",
)
def _(t):
    sector = classify.categorize_by(F.col("platform"), F.col("category"), SECTOR_RULES, DEFAULT_SECTOR)
    return bronze(t).select("platform", sector.alias("sector")).groupBy("platform", "sector").agg(F.count(F.lit(1)).alias("n"))


@query(
    "x12_industry_rules",
    """SELECT p_partkey, CASE WHEN contains(p_name, 'widget') THEN 'tools' WHEN contains(p_name, 'ring') OR contains(p_name, 'gear')
      THEN 'parts' WHEN contains(p_name, 'red') THEN 'red goods' END AS industry,
      CASE WHEN regexp_matches(p_name, 'widget|ring|gear|red') THEN 'matched' ELSE 'unmapped' END AS status FROM part""",
)
def _(t):
    rules = [("tools", ["widget"]), ("parts", ["ring", "gear"]), ("red goods", ["red"])]
    found = classify.categorize(F.upper("p_name"), rules)
    return t.part.select("p_partkey", found["group"].alias("industry"), found["status"].alias("status"))


@query(
    "x12_industry_rules_by_table",
    """WITH words AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS keyword FROM part UNION SELECT DISTINCT lower(p_type) FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] || ' ' || string_split(p_name, ' ')[2] FROM part),
    rules AS (SELECT keyword, row_number() OVER (ORDER BY md5(keyword)) AS o FROM words),
    texts AS (SELECT p_partkey, CASE WHEN p_size % 9 = 0 THEN NULL WHEN p_size % 9 = 1 THEN 'No. ' || p_size ELSE lower(p_name || ' / ' || p_type) END AS text FROM part),
    hits AS (SELECT p_partkey, min(o) AS o FROM texts JOIN rules ON contains(text, keyword) GROUP BY 1)
    SELECT p_partkey, 'sector ' || (o % 21) AS industry_sector, CASE WHEN text IS NULL THEN 'missing' WHEN o IS NULL THEN 'unmapped' ELSE 'matched' END AS industry_status, keyword AS industry_keyword
    FROM texts LEFT JOIN hits USING (p_partkey) LEFT JOIN rules USING (o)""",
)
def _(t):
    """Some hundreds of keywords in 21 sectors, the words and pairs of words in the names of parts and their types, in an order that has nothing to do with them."""
    names = t.part.select(F.explode(F.split("p_name", " ")).alias("keyword"))
    words = names.union(t.part.select(F.lower("p_type"))).union(t.part.select(F.substring_index("p_name", " ", 2))).distinct()
    ranked = ordered_prefix(words.withColumn("_md5", F.md5("keyword")), [], [F.asc("_md5")], rank="rule_order")
    rules = ranked.select(F.col("rule_order").cast("int").alias("rule_order"), F.concat(F.lit("sector "), F.col("rule_order") % 21).alias("sector"), "keyword")
    whole = F.concat(F.upper("p_name"), F.lit("  / "), "p_type")
    text = F.when(F.col("p_size") % 9 == 0, F.lit(None)).when(F.col("p_size") % 9 == 1, F.concat(F.lit("No. "), "p_size")).otherwise(whole)
    return sector_by_keywords(t.part.select("p_partkey", text.alias("text")), "text", rules).drop("text")


@query("x13_quantity", "SELECT l_orderkey, CAST(sum(CAST(l_quantity AS INT)) AS DOUBLE) AS openings FROM lineitem GROUP BY 1")
def _(t):
    shown = F.concat(F.col("l_quantity").cast("int"), F.lit(" người"))
    return t.lineitem.groupBy("l_orderkey").agg(F.sum(parsing.parse_quantity(shown)).alias("openings"))


@query(
    "x14_requirement_section",
    """SELECT l_partkey, l_suppkey, 'Thành thạo Python, SQL và dự án nhóm ' || (l_partkey % 50) || ' trở lên' AS section,
      CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL""",
)
def _(t):
    described = F.concat(
        F.lit("Mô tả: chăm sóc khách hàng lớn của công ty. Yêu cầu công việc: Thành thạo Python, SQL và dự án nhóm "),
        F.col("l_partkey") % 50, F.lit(" trở lên Quyền lợi: thưởng tết"),
    )
    return t.spread("lineitem", "l_orderkey").groupBy("l_partkey", "l_suppkey", parsing.requirement_section(described).alias("section")).agg(
        F.count(F.lit(1)).alias("n")
    )


def _first_hit_sql(text_column: str, patterns, beyond: int) -> str:
    """Earliest first occurrence beyond a position, as SQL over the same pattern list."""
    hits = []
    for rank, pattern in enumerate(patterns):
        ahead = pattern.endswith(r"(?=\S)")
        plain = pattern.replace(r"(?=\S)", r"\S")
        found = f"regexp_extract({text_column}, '{plain}')"
        size = f"length({found})" + (" - 1" if ahead else "")
        at = f"CASE WHEN {found} <> '' THEN strpos({text_column}, {found}) ELSE 0 END"
        hits.append(f"{{'at': {at}, 'rank': {rank}, 'size': {size}}}")
    return f"list_sort(list_filter([{', '.join(hits)}], lambda h: h.at > {beyond + 1}))[1]"


def _strip_sql(expr: str) -> str:
    return f"regexp_replace({expr}, '^{WS}+|{WS}+$', '', 'g')"


def _block_sql(rule: str) -> str:
    parts = f"list_transform(regexp_split_to_array(text, '{rule}'), lambda p, i: {{'size': -length(p), 'i': i, 'body': {_strip_sql('p')}}})"
    return f"list_sort(list_filter({parts}, lambda b: b.i > 1 AND length(b.body) > 50))[1].body"


@query(
    "x14_requirement_whole_documents",
    f"""WITH opened AS (SELECT doc_id, text, {_first_hit_sql("text", parsing.SECTION_STARTS, 20)} AS s FROM documents),
    body AS (SELECT doc_id, text, CASE WHEN s IS NOT NULL THEN
      regexp_replace(substr(text, s.at + s.size), '^[\\s\x0b\x85\\p{{Z}}:*\\-–—|]+', '') END AS content FROM opened),
    closed AS (SELECT doc_id, text, content, {_first_hit_sql("content", parsing.SECTION_ENDS, 10)} AS e FROM body),
    found AS (SELECT doc_id, text, {_strip_sql("CASE WHEN e IS NULL THEN content ELSE substr(content, 1, e.at - 1) END")} AS f FROM closed)
    SELECT doc_id, md5(CASE WHEN length(f) > 30 THEN f ELSE
      coalesce({_block_sql(parsing.SECTION_RULES[0])}, {_block_sql(parsing.SECTION_RULES[1])}, {_strip_sql("text")}) END) AS digest FROM found""",
)
def _(t):
    return t.spread("documents", "doc_id").select("doc_id", F.md5(parsing.requirement_section(F.col("text"))).alias("digest"))


_CLEANED = "coalesce(text, '')"
for _pattern, _new in [
    (r"(?i)</?p>|</?strong>", " "), (r"(?m)^[\-–]" + WS + "*", ""), (r"[➢▸ü·\r\t•●▪◦*+]+", " "), (r"\n+", " "), ("…+", "."),
    (r"\.{2,}", "."), ("[()]", " "), (r"(\p{Ll})(\p{Lu})", r"\1 \2"), ("([.!?;:])", r" \1 "),
    (rf"(^|[^{WORD}])([A-Za-z]|[IVXLCM]+|\p{{Nd}}+){WS}*\.", r"\1 "), (WS + "{2,}", " "), (f"^{WS}+|{WS}+$", ""),
]:
    _CLEANED = f"regexp_replace({_CLEANED}, '{_pattern}', '{_new}', 'g')"


@query("x15_clean_requirement", f"SELECT doc_id, md5({_CLEANED}) AS digest FROM documents")
def _(t):
    return t.spread("documents", "doc_id").select("doc_id", F.md5(text.clean_requirement(F.col("text"))).alias("digest"))


@query(
    "x16_protect_terms",
    """SELECT o_orderkey, 'R&D / ' || o_orderpriority || ' & r&d ( B2B/b2c ) , ' || o_orderstatus AS spaced FROM orders""",
)
def _(t):
    raw = F.concat(F.lit("R&D/"), "o_orderpriority", F.lit(" & r&d (B2B/b2c),"), "o_orderstatus")
    return t.orders.select("o_orderkey", text.protect_terms(raw).alias("spaced"))


_SKILL = r"lower(p_name || '/' || p_brand || '_' || p_type || '%')"


@query(
    "x17_normalize_skill",
    rf"""SELECT p_partkey, trim(regexp_replace(regexp_replace(regexp_replace({_SKILL}, '[\s_/|;,]+', ' ', 'g'),
      '[^0-9a-zA-Z#+. ]', ' ', 'g'), '\s+', ' ', 'g')) AS skill FROM part""",
)
def _(t):
    raw = F.concat("p_name", F.lit("/"), "p_brand", F.lit("_"), "p_type", F.lit("%"))
    return t.part.select("p_partkey", text.normalize_skill(raw).alias("skill"))


_WORDS_SQL = rf"""words AS (SELECT doc_id, unnest(list_distinct(regexp_split_to_array({squash('text')}, ' '))) AS w FROM documents)"""


@query(
    "x18_reasonable_skill",
    rf"""WITH {_WORDS_SQL}, folded AS (SELECT doc_id, w, replace(replace(strip_accents(w), 'đ', 'd'), 'Đ', 'D') AS plain FROM words WHERE w <> ''),
    judged AS (SELECT doc_id, regexp_matches(lower(plain), '[a-z]') AND regexp_matches(lower(plain), '[aeiouy]') AND
      CASE WHEN regexp_matches(plain, '[0-9]') THEN true
        WHEN regexp_matches(w, '\p{{Lu}}') AND NOT regexp_matches(w, '\p{{Ll}}') THEN true
        WHEN regexp_matches(w, '^\p{{Lu}}[^\p{{Lu}}]*\p{{Ll}}[^\p{{Lu}}]*$') THEN length(plain) >= 3
        ELSE length(plain) >= 5 AND length(regexp_replace(lower(plain), '[^bcdfghjklmnpqrstvwxyz]', '', 'g')) >= 2 END AS ok FROM folded)
    SELECT doc_id, CAST(count(*) AS BIGINT) AS words, CAST(count(*) FILTER (ok) AS BIGINT) AS reasonable FROM judged GROUP BY 1""",
)
def _(t):
    words = t.spread("documents", "doc_id").select("doc_id", F.explode(F.array_distinct(F.split(text.collapse(F.col("text")), " "))).alias("w"))
    words = words.filter(F.col("w") != "")
    return words.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("words"), F.count_if(text.is_reasonable_skill(F.col("w"))).alias("reasonable")
    )


@query(
    "x19_split_span",
    r"""SELECT p_partkey, CASE WHEN regexp_matches(p_name, '\S{4,}') THEN p_name || '|' ELSE '' END || p_brand || '|' || p_type AS names FROM part""",
)
def _(t):
    span = F.concat(F.lit("("), "p_name", F.lit(", "), "p_brand", F.lit("/ "), "p_type", F.lit(" ;xq.)"))
    return t.part.select("p_partkey", F.array_join(text.split_span(span), "|").alias("names"))


@query(
    "x20_noise",
    rf"""WITH {_WORDS_SQL}, pieces AS (SELECT DISTINCT w FROM words WHERE w <> ''),
    judged AS (SELECT w, CASE WHEN w IN ({", ".join("'" + v + "'" for v in text.NOISE_WHITELIST)}) THEN false ELSE
      length(w) <= 2 OR regexp_matches(w, '^[.\-&#*/()\[\]_+~,;:!?]') OR (length(w) > 20 AND regexp_matches(w, '^{text.FRAGMENT_START}')) END AS noise FROM pieces)
    SELECT length(w) AS size, CAST(count(*) AS BIGINT) AS words, CAST(count(*) FILTER (noise) AS BIGINT) AS noisy FROM judged GROUP BY 1""",
)
def _(t):
    words = t.spread("documents", "doc_id").select(F.explode(F.array_distinct(F.split(text.collapse(F.col("text")), " "))).alias("w"))
    pieces = words.filter(F.col("w") != "").distinct()
    return pieces.groupBy(F.length("w").alias("size")).agg(
        F.count(F.lit(1)).alias("words"), F.count_if(text.is_noise(F.col("w"))).alias("noisy")
    )


_TITLE_WORDS = "array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"


@query(
    "x21_capitalize",
    f"""SELECT p_partkey, upper(p_name[1]) || p_name[2:] || ' ' || p_type || ' ' || p_brand AS sentence,
      {_TITLE_WORDS} || ' ' || p_type || ' ' || p_brand AS title FROM part""",
)
def _(t):
    raw = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return t.part.select("p_partkey", text.smart_capitalize(raw).alias("sentence"), text.smart_title(raw).alias("title"))


@query(
    "x22_u06_merge_lists",
    """SELECT p_partkey, array_to_string(list_filter([a, b, c, d, e], lambda x, i: list_position([a, b, c, d, e], x) = i), '|') AS merged,
      array_to_string(list_sort(list_distinct(list_filter([a, b], lambda x: list_contains([c, d, e], x)))), '|') AS matched,
      array_to_string(list_sort(list_distinct(list_filter([a, b], lambda x: NOT list_contains([c, d, e], x)))), '|') AS missing
    FROM (SELECT p_partkey, split_part(p_name, ' ', 1) AS a, split_part(p_name, ' ', 2) AS b, p_brand AS c, lower(p_type) AS d,
          split_part(p_name, ' ', 1) AS e FROM part)""",
)
def _(t):
    from ..functions import scoring

    words = F.split("p_name", " ")
    mine, wanted = F.array("p_brand", F.lower("p_type"), words[0]), F.slice(words, 1, 2)
    return t.part.select(
        "p_partkey", F.array_join(text.merge_lists(wanted, F.array("p_brand"), F.array(F.lower("p_type"), words[0])), "|").alias("merged"),
        F.array_join(scoring.matched(mine, wanted), "|").alias("matched"),
        F.array_join(scoring.missing(mine, wanted), "|").alias("missing"),
    )


@query(
    "x22_merge_lists_folded",
    """SELECT p_partkey, array_to_string(list_distinct_first, '|') AS merged FROM (
      SELECT p_partkey, CASE WHEN upper(split_part(p_name, ' ', 1)) = split_part(p_name, ' ', 1) THEN [p_name] ELSE
        list_filter([split_part(p_name, ' ', 1), split_part(p_name, ' ', 2), p_brand],
          lambda x, i: list_position([lower(split_part(p_name, ' ', 1)), lower(split_part(p_name, ' ', 2)), lower(p_brand)], lower(x)) = i) END AS list_distinct_first
      FROM part)""",
)
def _(t):
    words = F.slice(F.split("p_name", " "), 1, 2)
    again = F.array(F.upper(words[0]), F.col("p_brand"), F.upper("p_brand"))
    return t.part.select("p_partkey", F.array_join(text.merge_lists(words, again, fold=True), "|").alias("merged"))


@query(
    "x23_canonical_lists",
    """WITH lookup AS (SELECT lower(p_name) AS raw, min(p_brand) AS canonical FROM part WHERE p_partkey % 2 = 0 GROUP BY 1)
    SELECT p_partkey, coalesce(canonical || '|', '') || 'Type ' || p_type AS skills FROM part LEFT JOIN lookup ON lower(p_name) = raw""",
)
def _(t):
    lists = t.part.select("p_partkey", F.array(
        F.upper("p_name"), F.lit("not listed"), F.regexp_replace("p_name", " ", "   "), F.lower("p_type")
    ).alias("skills"))
    even = t.part.filter(F.col("p_partkey") % 2 == 0)
    names = even.groupBy(F.lower("p_name").alias("raw_skill")).agg(F.min("p_brand").alias("canonical"))
    types = t.part.select(F.lower("p_type").alias("raw_skill"), F.concat(F.lit("Type "), "p_type").alias("canonical")).distinct()
    mapped = skills.canonical_list(lists, "p_partkey", "skills", names.unionByName(types))
    return mapped.select("p_partkey", F.array_join("skills", "|").alias("skills"))


@query(
    "x24_business_key",
    """SELECT o_orderkey, sha256(CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '||' || strftime(o_orderdate, '%Y-%m-%d')
      ELSE 'job/' || o_orderkey END) AS job_key FROM orders""",
)
def _(t):
    link = F.when(F.col("o_orderkey") % 3 == 0, "  ").otherwise(F.concat(F.lit("job/"), "o_orderkey"))
    fallback = [F.col("o_orderstatus"), F.col("o_orderdate").cast("date")]
    return t.orders.select("o_orderkey", keys.business_key(link, fallback).alias("job_key"))


@query(
    "x25_x26_d01_calendar",
    """WITH span AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM span),
    n AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INT) AS time_key, CAST(day(d) AS INT) AS day, dayname(d) AS day_name,
      CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(quarter(d) AS INT) AS quarter, CAST(year(d) AS INT) AS year,
      CAST(coalesce(n, 0) AS BIGINT) AS orders FROM days LEFT JOIN n USING (d)""",
)
def _(t):
    day = F.col("o_orderdate").cast("date")
    span = t.orders.agg(F.min(day).alias("a"), F.max(day).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("d")).select(*keys.calendar_parts(F.col("d")))
    counts = t.orders.groupBy(keys.date_key(day).alias("time_key")).agg(F.count(F.lit(1)).alias("n"))
    joined = days.join(counts, "time_key", "left").withColumn("orders", F.coalesce("n", F.lit(0)).cast("bigint"))
    return joined.select("time_key", "day", "day_name", "month", "month_name", "quarter", "year", "orders")


@query(
    "x25_period_keys",
    """SELECT CAST(year(o_orderdate) * 10000 + 101 AS INT) AS year_key, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS INT) AS month_key,
      CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1, 2""",
)
def _(t):
    y, m = F.year("o_orderdate"), F.month("o_orderdate")
    return t.orders.groupBy(keys.year_key(y).alias("year_key"), keys.month_key(y, m).alias("month_key")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "x27_x28_x29_period_number_label",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(month(o_orderdate) AS INT) AS month,
      CAST(quarter(o_orderdate) AS INT) AS quarter_only, CASE WHEN o_orderstatus = 'P' THEN -1 ELSE o_totalprice END AS value,
      o_orderstatus AS tail FROM orders""",
)
def _(t):
    monthly = F.concat(F.lit("T"), F.month("o_orderdate"), F.lit(" "), F.year("o_orderdate"))
    quarterly = F.concat(F.lit("Q"), F.quarter("o_orderdate"), F.lit(" "), F.year("o_orderdate"))
    number = F.when(F.col("o_orderstatus") == "P", "-").otherwise(F.concat(F.lit('"'), F.format_number("o_totalprice", 2), F.lit('"')))
    m, q = parsing.parse_period(monthly), parsing.parse_period(quarterly)
    return t.orders.select(
        "o_orderkey", m["year"].alias("year"), m["quarter"].alias("quarter"), m["month"].alias("month"),
        q["quarter"].alias("quarter_only"), F.coalesce(parsing.clean_number(number), F.lit(-1.0)).alias("value"),
        parsing.label_tail(F.concat(F.lit("Aggregate: Status "), "o_orderstatus")).alias("tail"),
    )


_TOKENS_SQL = rf"""list_filter(string_split(regexp_replace(lower(regexp_replace(text, '[^{WORD}+#.]+', ' ', 'g')), '\.( |$)', '\1', 'g'), ' '), lambda w: w <> '')"""


@query(
    "x30_find_terms",
    rf"""WITH toks AS (SELECT doc_id, {_TOKENS_SQL} AS w FROM documents),
    vocab AS (SELECT DISTINCT {_TOKENS_SQL}[1] || ' ' || {_TOKENS_SQL}[2] AS term FROM benchmark
      UNION SELECT DISTINCT {_TOKENS_SQL}[3] FROM benchmark),
    grams AS (SELECT doc_id, unnest(w) AS gram FROM toks UNION ALL
      SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM toks)
    SELECT term, CAST(count(DISTINCT doc_id) AS BIGINT) AS docs, CAST(count(*) AS BIGINT) AS hits FROM grams JOIN vocab ON gram = term GROUP BY 1""",
)
def _(t):
    clean = F.lower(F.regexp_replace("text", r"(?U)[^\w+#.]+", " "))
    words = F.filter(F.split(F.regexp_replace(clean, r"\.(?= |$)", ""), " "), lambda w: w != "")
    base = t.benchmark.select(words.alias("w"))
    pairs = base.select(F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1))).alias("term"))
    vocab = pairs.unionByName(base.select(F.get("w", F.lit(2)).alias("term"))).distinct()
    found = skills.find_terms(t.spread("documents", "doc_id"), "doc_id", "text", vocab)
    return found.groupBy("term").agg(F.countDistinct("doc_id").alias("docs"), F.count(F.lit(1)).alias("hits"))


@query(
    "x31_parse_cv",
    rf"""WITH cv AS (SELECT conv_id, turn, lower(text || CASE turn % 3 WHEN 0 THEN ' có ' || (conv_id % 9) || ' năm kinh nghiệm tại Hà Nội'
        WHEN 1 THEN ' 20' || (10 + conv_id % 10) || ' - nay, Docker' ELSE '' END) AS v, conv_id % 9 AS y, turn % 3 AS kind, conv_id % 10 AS z FROM conversations)
    SELECT conv_id, turn, CAST(CASE kind WHEN 0 THEN y WHEN 1 THEN 2025 - 2010 - z ELSE -1 END AS DOUBLE) AS years,
      CASE kind WHEN 0 THEN 'explicit' WHEN 1 THEN 'inferred' ELSE 'default' END AS source,
      array_to_string(list_filter([{", ".join("'" + s + "'" for s in sorted(parsing.CV_SKILLS))}], lambda s: contains(v, s)), '|') AS skills,
      CASE WHEN kind = 0 THEN 'Hà Nội' END AS location FROM cv""",
)
def _(t):
    kind = F.col("turn") % 3
    extra = (
        F.when(kind == 0, F.concat(F.lit(" có "), F.col("conv_id") % 9, F.lit(" năm kinh nghiệm tại Hà Nội")))
        .when(kind == 1, F.concat(F.lit(" 20"), F.col("conv_id") % 10 + 10, F.lit(" - nay, Docker"))).otherwise("")
    )
    cv = parsing.parse_cv(F.concat("text", extra), F.lit("2025-06-01").cast("date"))
    parsed = t.spread("conversations", "conv_id").select("conv_id", "turn", cv.alias("c"))
    return parsed.select(
        "conv_id", "turn", F.coalesce("c.years", F.lit(-1.0)).alias("years"), "c.source", F.array_join("c.skills", "|").alias("skills"), F.col("c.location").alias("location")
    )


@query(
    "x35_weighted_text",
    """SELECT p_partkey, 'Tieu de: ' || p_name || '. ' || p_name || '. Category_cu: ' || p_brand || '. ' || p_brand || '. ' || p_brand || '.' AS body FROM part""",
)
def _(t):
    body = text.weighted_text(
        [(F.col("p_name"), 2), (F.col("p_brand"), 3), (F.lit(None).cast("string"), 1)], ["Tieu de", "Category_cu", "Ky nang"]
    )
    return t.part.select("p_partkey", body.alias("body"))


@query(
    "f12_truncate_words",
    r"""SELECT doc_id, CASE WHEN length(text) <= 80 THEN text ELSE regexp_replace(left(text, 80), '(?s) [^ ]*$', '') || '...' END AS teaser FROM documents""",
)
def _(t):
    return t.spread("documents", "doc_id").select("doc_id", text.truncate_words(F.col("text"), 80).alias("teaser"))


@query(
    "j04_w08_longest_location_match",
    """WITH nations AS (SELECT n_name, CAST(n_nationkey AS VARCHAR) AS value FROM nation),
    places AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'nowhere' ELSE 'District 1, NATION_' || c_nationkey || ' near NATION_' || (c_nationkey % 3) END AS place FROM customer),
    hits AS (SELECT c_custkey, value, row_number() OVER (PARTITION BY c_custkey ORDER BY length(n_name) DESC, value) AS rn
      FROM places JOIN nations ON contains(place, n_name))
    SELECT c_custkey, coalesce(value, 'Khác') AS place_key FROM places LEFT JOIN (SELECT * FROM hits WHERE rn = 1) USING (c_custkey)""",
)
def _(t):
    return _places(t)


def _places(t):
    n = F.col("c_nationkey")
    place = F.when(F.col("c_custkey") % 11 == 0, "nowhere").otherwise(
        F.concat(F.lit("District 1, NATION_"), n, F.lit(" near NATION_"), n % 3)
    )
    customers = t.customer.select("c_custkey", place.alias("place"))
    nations = t.nation.select("n_name", F.col("n_nationkey").cast("string").alias("value"))
    found = joins.match_longest(customers, ["c_custkey"], "place", nations, "n_name", "value", "Khác", "place_key")
    return found.select("c_custkey", "place_key")


@query(
    "j04_longest_match_by_substring_join",
    """WITH nations AS (SELECT n_name, CAST(n_nationkey AS VARCHAR) AS value FROM nation),
    places AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'nowhere' ELSE 'District 1, NATION_' || c_nationkey || ' near NATION_' || (c_nationkey % 3) END AS place FROM customer),
    hits AS (SELECT c_custkey, value, row_number() OVER (PARTITION BY c_custkey ORDER BY length(n_name) DESC, value) AS rn
      FROM places JOIN nations ON contains(place, n_name))
    SELECT c_custkey, coalesce(value, 'Khác') AS place_key FROM places LEFT JOIN (SELECT * FROM hits WHERE rn = 1) USING (c_custkey)""",
)
def _(t):
    return _places(t)


@query(
    "j04_province_of_posting",
    f"WITH {SILVER_SQL} SELECT location_clean AS province, CAST(count(*) AS BIGINT) AS n FROM silver GROUP BY 1",
)
def _(t):
    return bronze(t).groupBy(province(F.col("location")).alias("province")).agg(F.count(F.lit(1)).alias("n"))
