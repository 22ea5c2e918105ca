"""The posting pipeline end to end, macro facts and incremental runs."""

import uuid

from pyspark.sql import functions as F

from ..functions.keys import date_key
from ..functions.rules import FDI_COLUMNS
from ..functions.text import normalize_skill
from ..operators import skills
from ..operators.tables import AppendTable
from ..plans import dims, gold, macro, silver
from ..session import checkpoint_dir, written
from ..sources import files
from ..streaming import increments
from .base import query
from .postings import PLACES_SQL, SILVER_SQL, bronze

RUN_DAY = "2025-01-15"


def standardized(t):
    return silver.standardize_postings(bronze(t), F.lit(RUN_DAY))


@query(
    "f02_s02_standardized_postings",
    f"""WITH {SILVER_SQL} SELECT platform, coalesce(link, '') AS link, title_clean, company_clean, location_clean, coalesce(min_salary, -1) AS min_salary,
      coalesce(max_salary, -1) AS max_salary, currency, salary_type, coalesce(min_years, -1) AS min_years, coalesce(max_years, -1) AS max_years, experience_type,
      education_standard, coalesce(level_standard, '') AS level_standard, work_form_standard, quantity_normalized,
      strftime(expired_date_norm, '%Y-%m-%d') AS expires, category_name_final, 'Kỹ năng ' || (p % 40) || '|tool_' || (s % 30) AS skills,
      'Thành thạo Python, SQL và dự án nhóm ' || (p % 50) || ' trở lên' AS requirement,
      sha256(coalesce(link, '') || '||' || title_clean || '||' || strftime(expired_date_norm, '%Y-%m-%d') || '||{RUN_DAY}') AS job_key FROM silver""",
)
def _(t):
    rows = standardized(t)
    return rows.select(
        "platform", F.coalesce("link", F.lit("")).alias("link"), "title_clean", "company_clean", "location_clean",
        F.coalesce("min_salary", F.lit(-1)).alias("min_salary"), F.coalesce("max_salary", F.lit(-1)).alias("max_salary"), "currency",
        "salary_type", F.coalesce("min_years", F.lit(-1.0)).alias("min_years"), F.coalesce("max_years", F.lit(-1.0)).alias("max_years"),
        "experience_type", "education_standard", F.coalesce("level_standard", F.lit("")).alias("level_standard"), "work_form_standard",
        "quantity_normalized", F.col("expired_date_norm").cast("string").alias("expires"), "category_name_final",
        F.array_join("skills_all", "|").alias("skills"), "requirement", "job_key",
    )


#: What the requirement texts are searched for; ``sql`` has no vowel, so the rules for skill names drop it again.
VOCABULARY = (("python", "tech"), ("sql", "tech"), ("dự án nhóm", "soft"))


def enriched(t, columns=silver.SILVER_COLUMNS):
    """Standardised postings whose skill lists come from their requirement texts as well."""
    return silver.enrich_skills(standardized(t).select(*columns), t.spark.createDataFrame(list(VOCABULARY), "term string, skill_type string"))


@query(
    "j10_k01_enriched_postings",
    f"""WITH {SILVER_SQL} SELECT platform, title_clean, 'Python' AS tech, 'dự án nhóm' AS soft, 'Kỹ năng ' || (p % 40) || '|tool_' || (s % 30) || '|Python|dự án nhóm' AS every,
      CAST(count(*) AS BIGINT) AS n FROM silver GROUP BY ALL""",
)
def _(t):
    lists = [F.array_join(c, "|").alias(a) for c, a in (("tech_skills", "tech"), ("soft_skills", "soft"), ("skills_all", "every"))]
    return enriched(t).select("platform", "title_clean", *lists).groupBy("platform", "title_clean", "tech", "soft", "every").agg(F.count(F.lit(1)).alias("n"))


def observed_alias(t, extra=()):
    """Alias table over the skills that postings name; part of them are known to the dimension."""
    names = F.array(F.concat(F.lit("Kỹ năng "), F.col("l_partkey") % 40), F.concat(F.lit("tool_"), F.col("l_suppkey") % 30))
    seen = t.lineitem.select(F.explode(names).alias("raw")).select(normalize_skill(F.col("raw")).alias("skill_norm")).distinct()
    if extra:
        more = t.spark.createDataFrame([(x,) for x in extra], "raw string").select(normalize_skill(F.col("raw")).alias("skill_norm"))
        seen = seen.unionByName(more).distinct()
    known = seen.filter(F.col("skill_norm").startswith("ky nang"))
    dim = known.select(F.col("skill_norm").alias("skill_canon_norm"), F.sha2(F.concat(F.lit("dim:"), "skill_norm"), 256).alias("skill_key"))
    return skills.alias_dim(seen, dim)


_ALIAS = """CASE WHEN skill_norm LIKE 'ky nang%' THEN sha256('dim:' || skill_norm) ELSE sha256(skill_norm) END"""


@query(
    "k09_alias_dimension",
    f"""WITH seen AS (SELECT DISTINCT 'ky nang ' || (l_partkey % 40) AS skill_norm FROM lineitem UNION SELECT DISTINCT 'tool ' || (l_suppkey % 30) FROM lineitem)
    SELECT skill_norm, {_ALIAS} AS skill_key FROM seen""",
)
def _(t):
    return observed_alias(t)


@query(
    "d15_skill_demand_by_category",
    f"""WITH {SILVER_SQL}, jobs AS (SELECT sha256(coalesce(link, category_name_final || '||' || strftime(expired_date_norm, '%Y-%m-%d') || '||')) AS job_key,
      category_name_final, p, s FROM silver),
    long AS (SELECT job_key, category_name_final, 'ky nang ' || (p % 40) AS skill_norm FROM jobs UNION SELECT job_key, category_name_final, 'tool ' || (s % 30) FROM jobs
      UNION SELECT job_key, category_name_final, unnest(['python', 'du an nhom']) FROM jobs),
    tot AS (SELECT category_name_final, count(DISTINCT job_key) AS total FROM long GROUP BY 1)
    SELECT category_name_final AS category_name, {_ALIAS} AS skill_key, CAST(count(DISTINCT job_key) AS BIGINT) AS job_count,
      round(count(DISTINCT job_key) / any_value(total), 9) AS coverage FROM long JOIN tot USING (category_name_final) GROUP BY 1, 2""",
)
def _(t):
    needed = ("link", "category_name_final", "expired_date_norm", "requirement", "skills_all", "tech_skills", "soft_skills")
    demand = gold.skill_by_category(enriched(t, needed), observed_alias(t, [term for term, _ in VOCABULARY]))
    category = F.broadcast(dims.literal_dim(t.spark, "category").select("category_key", "category_name"))
    named = demand.join(category, "category_key")
    return named.select("category_name", "skill_key", "job_count", F.round("coverage", 9).alias("coverage"))


@query(
    "d12_dim_job",
    f"""WITH {SILVER_SQL}, keyed AS (SELECT sha256(coalesce(link, platform || '||' || title_clean || '||' || company_clean || '||' || location_clean || '||' || category_name_final || '||' || strftime(expired_date_norm, '%Y-%m-%d'))) AS job_key,
      expired_date_norm, platform, link FROM silver)
    SELECT job_key, strftime(expired_date_norm, '%Y-%m-%d') AS expires, platform FROM (SELECT *, row_number() OVER
      (PARTITION BY job_key ORDER BY expired_date_norm DESC NULLS LAST, platform, link) AS rn FROM keyed) WHERE rn = 1""",
)
def _(t):
    return gold.dim_job(standardized(t)).select("job_key", F.col("expired_date_norm").cast("string").alias("expires"), "platform")


@query(
    "d03_new_companies",
    """SELECT sha256(name) AS company_key, name AS company_name FROM (SELECT DISTINCT 'công ty - ' || l_suppkey AS name FROM lineitem WHERE l_suppkey % 4 <> 0)""",
)
def _(t):
    names = gold.dim_company(standardized(t))
    known = t.supplier.filter(F.col("s_suppkey") % 4 == 0).select(F.concat(F.lit("công ty - "), "s_suppkey").alias("company_name"))
    return dims.new_members(names, "company_name", known, "company_name", "company_key")


@query(
    "d14_j02_star_fact",
    f"""WITH {SILVER_SQL} SELECT sha256(location_clean) AS location_key, sha256(category_name_final) AS category_key, sha256(coalesce(level_standard, 'staff')) AS level_key,
      sha256(education_standard) AS education_key, sha256(company_clean) AS company_key, CAST(year(expired_date_norm) * 10000 + month(expired_date_norm) * 100 + day(expired_date_norm) AS INT) AS expired_time_key,
      currency, CAST(count(*) AS BIGINT) AS postings, CAST(sum(coalesce(min_salary, 0)) AS BIGINT) AS low, CAST(sum(coalesce(max_salary, 0)) AS BIGINT) AS high, sum(coalesce(min_years, 0)) AS years
    FROM silver GROUP BY ALL""",
)
def _(t):
    rows = standardized(t)
    companies = t.supplier.select(F.concat(F.lit("công ty - "), "s_suppkey").alias("company_name"))
    companies = companies.withColumn("company_key", F.sha2("company_name", 256))
    fact = gold.fact_jobs(rows, companies)
    keys = ["location_key", "category_key", "level_key", "education_key", "company_key", "expired_time_key", "currency"]
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("postings"), F.sum("min_salary").alias("low"), F.sum("max_salary").alias("high"), F.sum("min_years").alias("years")
    )


@query(
    "d02_d05_d06_d07_d08_literal_dimensions",
    f"""WITH {SILVER_SQL} SELECT level_standard AS level_code, education_standard AS education_code, work_form_standard AS work_form_code, salary_type AS salary_type_code,
      CASE level_standard WHEN 'staff' THEN 2 WHEN 'manager' THEN 4 ELSE 5 END AS level_rank, CAST(education_standard AS INT) AS education_rank, CAST(count(*) AS BIGINT) AS n
    FROM silver WHERE level_standard IS NOT NULL GROUP BY ALL""",
)
def _(t):
    rows = standardized(t).select(
        F.col("level_standard").alias("level_code"), F.col("education_standard").alias("education_code"),
        F.col("work_form_standard").alias("work_form_code"), F.col("salary_type").alias("salary_type_code"),
    )
    for name in ("level", "education", "work_form", "salary_type"):
        rows = rows.join(F.broadcast(dims.literal_dim(t.spark, name).drop(f"{name}_no", f"{name}_key")), f"{name}_code")
    return rows.groupBy("level_code", "education_code", "work_form_code", "salary_type_code", "level_rank", "education_rank").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "k10_k08_job_skills",
    f"""WITH {SILVER_SQL}, names AS (SELECT DISTINCT lower('Kỹ năng ' || (p % 40)) AS raw, 'tech' AS kind FROM silver UNION SELECT DISTINCT 'tool_' || (s % 30), 'soft' FROM silver),
    mapped AS (SELECT raw, kind, CASE WHEN raw LIKE 'tool_1%' THEN 'Tooling' ELSE raw END AS canonical FROM names WHERE raw <> 'tool_5'),
    canon AS (SELECT canonical AS skill_name, CASE WHEN canonical = 'Tooling' THEN 'soft' ELSE 'unknown' END AS skill_type,
      row_number() OVER (ORDER BY canonical) AS skill_key FROM (SELECT DISTINCT canonical FROM mapped)),
    facts AS (SELECT DISTINCT sha256(k || '|' || p || '|' || s) AS job, skill_key, skill_type FROM silver JOIN mapped ON raw = lower('Kỹ năng ' || (p % 40)) OR raw = 'tool_' || (s % 30) JOIN canon ON skill_name = canonical)
    SELECT CAST(skill_key AS BIGINT) AS skill_key, skill_name, skill_type, CAST(count(DISTINCT job) AS BIGINT) AS jobs FROM facts JOIN canon USING (skill_key, skill_type) GROUP BY ALL""",
)
def _(t):
    key = F.sha2(F.concat_ws("|", "l_orderkey", "l_partkey", "l_suppkey"), 256)
    jobs = t.lineitem.select(
        key.alias("job_key"), F.array(F.concat(F.lit("Kỹ năng "), F.col("l_partkey") % 40)).alias("tech_skills"),
        F.array(F.concat(F.lit("tool_"), F.col("l_suppkey") % 30), F.lit(" ")).alias("soft_skills"),
    )
    raw = skills.stack_arrays(jobs, [], {"tech": "tech_skills", "soft": "soft_skills"}).distinct()
    tools = raw.select("raw_skill").filter(F.col("raw_skill").startswith("tool_1") | (F.col("raw_skill") == "tool_5")).distinct()
    mapping = tools.select(
        "raw_skill", F.when(F.col("raw_skill") == "tool_5", skills.SKIP).otherwise("Tooling").alias("canonical_skill"), F.lit("soft").alias("skill_type")
    )
    dim = t.spark.createDataFrame([], gold.GoldTables.SCHEMAS["dim_skill"])
    alias = t.spark.createDataFrame([], gold.GoldTables.SCHEMAS["dim_skill_alias"])
    new_dim, new_alias = skills.grow_skill_dim(raw, mapping, dim, alias)
    new_dim, new_alias = written(new_dim), written(new_alias)
    facts = skills.job_skills(jobs, new_alias, new_dim)
    named = facts.join(new_dim.select("skill_key", "skill_name"), "skill_key")
    return named.groupBy("skill_key", "skill_name", "skill_type").agg(F.count("job_key").alias("jobs"))


# -- M: indicator tables and facts --------------------------------------------------------------------------


@query(
    "m01_d10_wide_periods_to_long",
    """SELECT o_orderpriority AS industry, CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS year,
      CAST(count(*) * 1000 AS DOUBLE) AS value FROM orders GROUP BY ALL""",
)
def _(t):
    label = F.concat(F.lit("T"), F.month("o_orderdate"), F.lit(" "), F.year("o_orderdate"))
    counted = t.orders.groupBy("o_orderpriority", label.alias("label")).agg(F.format_number(F.count(F.lit(1)) * 1000, 0).alias("v"))
    wide = counted.groupBy(F.concat(F.lit(' "'), "o_orderpriority", F.lit('"')).alias("Chỉ tiêu")).pivot("label").agg(F.first("v"))
    units = t.spark.range(1).select(F.lit("Đơn vị").alias("Chỉ tiêu"))
    table = wide.unionByName(units, allowMissingColumns=True).withColumn("Unnamed: 99", F.lit(None).cast("string"))
    return files.to_long(table, unit_rows=["Đơn vị"]).filter(F.col("value").isNotNull())


_FDI_SQL = """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month, CAST(quarter(o_orderdate) AS INT) AS quarter,
  CAST(count(*) AS DOUBLE) * 1000 AS a, CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE) AS b FROM orders GROUP BY ALL"""


def _fdi(t):
    period = F.concat(F.lit("T"), F.month("o_orderdate"), F.lit(" "), F.year("o_orderdate"))
    rows = t.orders.groupBy(period.alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    a, b = F.concat(F.lit('"'), F.format_number(F.col("n") * 1000, 0), F.lit('"')), F.col("f").cast("string")
    return files.fdi_long(rows.select("p", a, b, a, b, a, F.lit("-"), F.lit("-"), b).toDF(*[f"c{i}" for i in range(9)]))


@query("m02_investment_table", f"SELECT year, month, quarter, a AS registered, b AS purchase_yoy, -1.0::DOUBLE AS purchase FROM ({_FDI_SQL})")
def _(t):
    return _fdi(t).select(
        "year", "month", "quarter", F.col("fdi_registered_value").alias("registered"), F.col("fdi_share_purchase_yoy").alias("purchase_yoy"),
        F.coalesce("fdi_share_purchase_value", F.lit(-1.0)).alias("purchase"),
    )


def _labour(t, kind):
    first = {
        "age": F.concat(F.lit("Age ("), F.when(F.col("l_linenumber") < 4, "Aggregate").otherwise("Detail"), F.lit(" bands): Band"), F.lit(" A"), "l_linenumber"),
        "activity": F.concat(F.lit("Economic activity (Aggregate): "), F.when(F.col("l_linenumber") < 4, "Total").otherwise("Industry")),
        "currency": F.concat(F.lit("Currency: "), F.when(F.col("l_linenumber") < 4, "Local currency").otherwise("US dollars")),
    }[kind]
    rows = t.lineitem.groupBy("l_returnflag", "l_linenumber", F.year("l_shipdate").alias("y")).agg(F.sum("l_quantity").alias("q"))
    return rows.select(
        F.col("l_returnflag").alias("sex.label"), first.alias("classif1.label"), F.lit(None).cast("string").alias("classif2.label"),
        F.col("y").cast("string").alias("time"), F.when(F.col("l_returnflag") != "N", F.col("q")).alias("obs_value"),
    )


@query(
    "m03_normalize_labour",
    """WITH g AS (SELECT l_returnflag AS sex, l_linenumber AS n, CAST(year(l_shipdate) AS INT) AS year, sum(l_quantity) AS value FROM lineitem WHERE l_returnflag <> 'N' AND l_linenumber < 4 GROUP BY 1, 2, 3)
    SELECT 'age' AS kind, sex, 'A' || n AS age_group, year, value FROM g UNION ALL SELECT 'activity', sex, '', year, value FROM g UNION ALL SELECT 'currency', sex, '', year, value FROM g""",
)
def _(t):
    parts = [
        files.normalize_labour(_labour(t, kind)).select(F.lit(kind).alias("kind"), "sex", F.coalesce("age_group", F.lit("")).alias("age_group"), "year", "value")
        for kind in ("age", "activity", "currency")
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "m04_quarter_to_months",
    """WITH q AS (SELECT o_orderpriority AS industry, CAST(year(o_orderdate) AS INT) AS year, CAST(quarter(o_orderdate) AS INT) AS quarter, CAST(count(*) AS BIGINT) AS value FROM orders GROUP BY 1, 2, 3)
    SELECT industry, CAST(year * 10000 + (quarter * 3 - 2 + m) * 100 + 1 AS INT) AS time_key, value FROM q, (SELECT unnest([0, 1, 2]) AS m)""",
)
def _(t):
    return macro.quarter_to_months(_quarterly(t)).select("industry", "time_key", F.col("value").cast("bigint").alias("value"))


def _quarterly(t):
    return t.orders.groupBy(
        F.col("o_orderpriority").alias("industry"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter")
    ).agg(F.count(F.lit(1)).cast("double").alias("value"))


def _monthly(t):
    return t.orders.groupBy(
        F.col("o_orderpriority").alias("industry"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    ).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).cast("double").alias("value"))


@query(
    "m05_unpivot_indicators",
    " UNION ALL ".join(
        f"SELECT year, month, '{code}' AS indicator_code, {value} AS value FROM ({_FDI_SQL})"
        for code, value in zip(FDI_COLUMNS, ("a", "b", "a", "b", "a", "-1.0", "-1.0", "b"), strict=True)
    ),
)
def _(t):
    rows = macro.unpivot_indicators(_fdi(t), ["year", "month"], FDI_COLUMNS)
    return rows.withColumn("value", F.coalesce("value", F.lit(-1.0)))


_FACT = f"""m AS (SELECT o_orderpriority AS industry, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS INT) AS time_key, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) AS value, 'CPI' AS code FROM orders GROUP BY 1, 2),
q AS (SELECT o_orderpriority AS industry, year(o_orderdate) AS y, quarter(o_orderdate) AS q, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2, 3),
f AS (SELECT * FROM m UNION ALL SELECT industry, CAST(y * 10000 + (q * 3 - 2 + i) * 100 + 1 AS INT), value, 'GDP_REAL' FROM q, (SELECT unnest([0, 1, 2]) AS i)
  UNION ALL SELECT 'Tất cả', CAST(year * 10000 + month * 100 + 1 AS INT), a, 'FDI_REGISTERED_VALUE' FROM ({_FDI_SQL}))"""


def _macro_fact(t):
    monthly, quarterly = {"CPI": _monthly(t)}, {"GDP_REAL": _quarterly(t)}
    industries = dims.dim_industry([monthly["CPI"], quarterly["GDP_REAL"]])
    span = t.orders.select(F.to_date(F.date_trunc("month", "o_orderdate")).alias("d")).distinct()
    months = span.select(F.explode(F.array("d", F.add_months("d", 1), F.add_months("d", 2), F.add_months("d", -1), F.add_months("d", -2))).alias("full_date"))
    times = months.distinct().select(date_key(F.col("full_date")).alias("time_key"), "full_date")
    indicators = dims.literal_dim(t.spark, "indicator")
    return macro.fact_macro(monthly, quarterly, _fdi(t), times, industries, indicators), times, industries, indicators


@query(
    "m06_d09_u02_fact_macro",
    f"""WITH {_FACT} SELECT time_key, sha256(industry) AS industry_key, sha256(code) AS indicator_key, value FROM f""",
)
def _(t):
    fact, _times, _industries, indicators = _macro_fact(t)
    kept = indicators.filter(F.col("indicator_code").isin("CPI", "GDP_REAL", "FDI_REGISTERED_VALUE")).select("indicator_key")
    return fact.join(F.broadcast(kept), "indicator_key").select("time_key", "industry_key", "indicator_key", "value")


@query(
    "f13_j06_indicator_panel",
    f"""WITH {_FACT} SELECT code AS indicator_code, strftime(strptime(CAST(time_key AS VARCHAR), '%Y%m%d'), '%Y-%m-%d') AS day, round(avg(value), 4) AS value FROM f
    WHERE code IN ('CPI', 'GDP_REAL') AND time_key BETWEEN 19990101 AND 20011231 GROUP BY 1, 2""",
)
def _(t):
    from ..operators.filters import select_series

    fact, times, _industries, indicators = _macro_fact(t)
    panel = macro.indicator_panel(fact, times, indicators)
    chosen = select_series(panel, ["CPI", "GDP_REAL"], "1999-01-01", "2001-12-31")
    return chosen.select("indicator_code", F.col("full_date").cast("string").alias("day"), F.round("value", 4).alias("value"))


@query(
    "m07_j05_fact_labour",
    """WITH g AS (SELECT l_returnflag AS sex, l_linenumber AS n, CAST(year(l_shipdate) AS INT) AS year, sum(l_quantity) AS value FROM lineitem WHERE l_returnflag <> 'N' AND l_linenumber < 4 GROUP BY 1, 2, 3),
    f AS (SELECT sex, 'A' || n AS age_group, year, value, 'UNEMPLOYMENT' AS code FROM g UNION ALL SELECT sex, 'Total', year, value, 'AVG_INCOME' FROM g UNION ALL SELECT 'Total', 'Total', year, value, 'MIN_WAGE' FROM g)
    SELECT CAST(year * 10000 + 101 AS INT) AS time_key, CASE WHEN age_group <> 'Total' THEN sha256(sex || '||' || age_group) ELSE '' END AS demographic_key, sha256(code) AS indicator_key, value FROM f""",
)
def _(t):
    age, pay = files.normalize_labour(_labour(t, "age")), files.normalize_labour(_labour(t, "currency"))
    fact = macro.fact_labour(
        {"UNEMPLOYMENT": age, "AVG_INCOME": pay, "MIN_WAGE": pay.drop("sex")}, dims.dim_demographic(age), dims.literal_dim(t.spark, "indicator")
    )
    return fact.select("time_key", F.coalesce("demographic_key", F.lit("")).alias("demographic_key"), "indicator_key", "value")


# -- R: increments ---------------------------------------------------------------------------------------------


def _stream(t, columns=("event_id", "ts", "user_id", "event_type", "value")):
    """Events as a stream of several files, written once to the shared folder."""
    root = f"{checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = t.events.select(*columns).withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartitionByRange(8, "event_id").write.parquet(f"{root}/in")
    return root, increments.stream_files(t.spark, f"{root}/in", rows.schema, files_per_batch=3)


@query("r01_r02_idempotent_append", "SELECT event_id, user_id, event_type, value FROM events")
def _(t):
    root, stream = _stream(t)
    table = AppendTable(t.spark, f"{root}/out")
    increments.run_available(stream, increments.idempotent_sink(table), f"{root}/state")
    # a batch that is delivered again must not add rows
    increments.idempotent_sink(table)(table.read(), 0)
    return table.read().select("event_id", "user_id", "event_type", "value")


@query(
    "r04_latest_state_over_batches",
    """SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rn FROM events) WHERE rn = 1""",
)
def _(t):
    root, stream = _stream(t)
    table = AppendTable(t.spark, f"{root}/out")
    order = lambda: [F.desc("value"), F.asc("event_id")]
    increments.run_available(stream, increments.latest_state(table, ["user_id"], order), f"{root}/state")
    return increments.current_state(table, ["user_id"], order).select("user_id", "event_id", "event_type")


@query("r05_new_links_only", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def _(t):
    root, stream = _stream(t)
    table = AppendTable(t.spark, f"{root}/out")
    increments.run_available(stream, increments.insert_only_new(table, ["user_id", "event_type"]), f"{root}/state")
    return table.read().select("user_id", "event_type")


@query("r05_dedupe_within_watermark", "SELECT user_id, event_type FROM events GROUP BY 1, 2")
def _(t):
    root, stream = _stream(t)
    table = AppendTable(t.spark, f"{root}/out")
    first = increments.stream_dedupe(stream, ["user_id", "event_type"], "ts", "60 days")
    increments.run_available(first, increments.idempotent_sink(table), f"{root}/state")
    return table.read().select("user_id", "event_type")


@query(
    "r03_gold_increments",
    f"""WITH {SILVER_SQL}, keyed AS (SELECT sha256(coalesce(link, platform || '||' || title_clean || '||' || company_clean || '||' || location_clean || '||' || category_name_final || '||' || strftime(expired_date_norm, '%Y-%m-%d'))) AS job_key,
      *, sha256(coalesce(link, '') || '||' || title_clean || '||' || strftime(expired_date_norm, '%Y-%m-%d') || '||{RUN_DAY}') AS version FROM silver)
    SELECT job_key, title_clean, sha256(company_clean) AS company_key, sha256(location_clean) AS location_key, true AS in_dim, CAST(2 AS BIGINT) AS n_skills, true AS flagged
    FROM (SELECT *, row_number() OVER (PARTITION BY job_key ORDER BY version DESC) AS rn FROM keyed) WHERE rn = 1""",
)
def _(t):
    root = f"{checkpoint_dir(t.spark)}/gold-{uuid.uuid4().hex}"
    enriched(t).write.parquet(f"{root}/silver")
    return gold_batches(t, root)


def gold_batches(t, root):
    """The postings written below ``root``, brought to gold in two batches, each delivered twice."""
    postings = t.spark.read.parquet(f"{root}/silver")
    tables = gold.GoldTables(t.spark, root)
    mapping = t.spark.createDataFrame([], "raw_skill string, canonical_skill string, skill_type string")
    for i in range(2):
        # the first batch is half of the postings, the second whatever is pending after it; each is bound to its version first
        size = (postings.select(gold.posting_key()).distinct().count() + 1) // 2
        gold.pending_batch(postings, size).write.parquet(f"{root}/batch-{i}")
        batch = t.spark.read.parquet(f"{root}/batch-{i}")
        for _ in range(2):  # a batch that is delivered again changes nothing
            gold.gold_increment(batch, mapping, tables, f"batch-{i:06d}")
        gold.flag_processed(postings, batch).write.parquet(f"{root}/silver-{i}")
        postings = t.spark.read.parquet(f"{root}/silver-{i}")
    jobs = tables.read("dim_job").select("job_key", "title_clean", F.lit(True).alias("in_dim"))
    listed = tables.read("fact_job_skills").groupBy("job_key").agg(F.count(F.lit(1)).alias("n_skills"))
    flags = postings.groupBy(gold.posting_key().alias("job_key")).agg(F.bool_and("gold_processed").alias("flagged"))
    facts = tables.read("fact_jobs").select("job_key", "company_key", "location_key")
    return facts.join(jobs, "job_key").join(listed, "job_key").join(flags, "job_key")


# -- S: files written once to the shared folder and read back ------------------------------------------


@query(
    "s01_s03_loaded_batch",
    """SELECT platform, event_type AS title, level, CAST(count(*) AS BIGINT) AS n, CAST(sum(event_id) AS BIGINT) AS ids
    FROM (SELECT 'p' || (event_id % 2) AS platform, CASE WHEN event_id % 2 = 1 THEN 'u' || user_id % 5 ELSE '' END AS level, * FROM events) GROUP BY ALL
    UNION ALL SELECT 'rejected', 'empty', '', 1, 0""",
)
def _(t):
    """Files of two shapes and one without rows: the readable ones are loaded together, the other is named with its reason."""
    root = f"{checkpoint_dir(t.spark)}/batch-{uuid.uuid4().hex}"
    title, link, level = F.col("event_type").alias("title"), F.col("event_id").cast("string").alias("link"), F.concat(F.lit("u"), F.col("user_id") % 5).alias("level")
    for i, columns in enumerate(([link, title], [title, level, link])):
        t.events.filter(F.col("event_id") % 2 == i).select(*columns).write.parquet(f"{root}/{i}")
    t.events.filter("event_id < 0").select(link).write.parquet(f"{root}/none")
    good, bad = files.quarantine(t.spark, [(f"{root}/0", "p0"), (f"{root}/1", "p1"), (f"{root}/none", "p0")])
    loaded = files.load_batch(t.spark, good).groupBy("platform", "title", F.coalesce("level", F.lit("")).alias("level")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("link").cast("bigint")).alias("ids")
    )
    rejects = t.spark.createDataFrame([("rejected", reason, "", 1, 0) for _, _, reason in bad], "platform string, title string, level string, n bigint, ids bigint")
    return loaded.unionByName(rejects)


@query(
    "s07_indicator_json",
    """SELECT 'Sex: ' || l_linenumber AS sex, CAST(year(l_shipdate) AS INT) AS year, CAST(sum(l_quantity) AS DOUBLE) AS value FROM lineitem GROUP BY 1, 2""",
)
def _(t):
    """Indicator records as JSON arrays, one file per year, read back through their dotted labels."""
    root = f"{checkpoint_dir(t.spark)}/json-{uuid.uuid4().hex}"
    sums = t.lineitem.groupBy(F.concat(F.lit("Sex: "), "l_linenumber").alias("sex.label"), F.year("l_shipdate").cast("string").alias("time")).agg(
        F.sum("l_quantity").cast("double").alias("obs_value")
    )
    records = F.struct(F.col("`sex.label`"), F.col("time"), F.col("obs_value"))
    sums.groupBy(F.col("time").alias("year")).agg(F.to_json(F.collect_list(records)).alias("value")).write.partitionBy("year").text(f"{root}/in")
    found = files.read_indicator_json(t.spark, f"{root}/in")
    return found.select(F.col("`sex.label`").alias("sex"), F.col("time").cast("int").alias("year"), F.col("obs_value").alias("value"))


# -- S08, S09: period tables in UTF-16 ---------------------------------------------------------------------


@query(
    "s08_periods_in_utf16",
    """SELECT 'Ngành ' || l_linenumber AS industry, CAST((month(l_shipdate) - 1) // 3 + 1 AS INT) AS quarter, CAST(month(l_shipdate) AS INT) AS month, CAST(year(l_shipdate) AS INT) AS year,
      CAST(sum(l_quantity) AS DOUBLE) AS value FROM lineitem WHERE l_linenumber < 5 GROUP BY ALL""",
)
def _(t):
    """Monthly sums as a wide table, a column for each period, written as tab-separated UTF-16 and read back as rows."""
    root = f"{checkpoint_dir(t.spark)}/utf16-{uuid.uuid4().hex}"
    label = F.concat(F.lit("T"), F.month("l_shipdate"), F.lit(" "), F.year("l_shipdate"))
    sums = t.lineitem.filter("l_linenumber < 5").groupBy(F.concat(F.lit("Ngành "), "l_linenumber").alias("Ngành"), label.alias("period")).agg(F.sum("l_quantity").alias("v"))
    wide = sums.groupBy("Ngành").pivot("period").agg(F.format_number(F.first(F.col("v").cast("double")), 2))
    wide.coalesce(1).write.csv(f"{root}/in", sep="\t", header=True, encoding="UTF-16", nullValue="-", quoteAll=True)
    long = files.to_long(files.read_period_tsv(t.spark, f"{root}/in"))
    return long.filter("value IS NOT NULL").select("industry", *[F.col(c).cast("int").alias(c) for c in ("quarter", "month", "year")], "value")


@query(
    "s09_two_header_rows_in_utf16",
    """SELECT CAST((month(o_orderdate) - 1) // 3 + 1 AS INT) AS quarter, CAST(month(o_orderdate) AS INT) AS month, CAST(year(o_orderdate) AS INT) AS year,
      CAST(count(*) AS DOUBLE) AS fdi_disbursed_value, CAST(sum(CASE WHEN o_orderpriority LIKE '1%' THEN 1 ELSE 0 END) AS DOUBLE) AS fdi_disbursed_yoy, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1234.5 END) AS DOUBLE) AS fdi_share_purchase_yoy
    FROM orders GROUP BY ALL""",
)
def _(t):
    """Monthly figures below two header rows, the first with line breaks in its cells; columns are named by their place."""
    root = f"{checkpoint_dir(t.spark)}/utf16-{uuid.uuid4().hex}"
    month = F.concat(F.lit("T"), F.month("o_orderdate"), F.lit(" "), F.year("o_orderdate")).alias("c0")
    urgent, closed = F.sum((F.col("o_orderpriority").startswith("1")).cast("int")), F.sum(F.when(F.col("o_orderstatus") == "F", 1234.5))
    text = lambda c, i: F.format_number(c.cast("double"), 2).alias(f"c{i}")
    rows = t.orders.groupBy(month).agg(
        text(F.count(F.lit(1)), 1), text(urgent, 2), *[F.lit("-").alias(f"c{i}") for i in range(3, 8)], F.coalesce(text(closed, 8), F.lit("-")).alias("c8")
    )
    heads = t.spark.createDataFrame([[0, *[f"Vốn {i}\n(triệu USD)" for i in range(9)]], [1, "", *["Giá trị", "YoY"] * 4]], "o int, " + ", ".join(f"c{i} string" for i in range(9)))
    ordered = heads.unionByName(rows.withColumn("o", F.lit(2))).coalesce(1).sortWithinPartitions("o").drop("o")
    ordered.write.csv(f"{root}/in", sep="\t", encoding="UTF-16", quoteAll=True)
    found = files.fdi_long(files.read_period_tsv(t.spark, f"{root}/in", header_rows=2, names=files.FDI_NAMES))
    return found.select(*[F.col(c).cast("int").alias(c) for c in ("quarter", "month", "year")], "fdi_disbursed_value", "fdi_disbursed_yoy", "fdi_share_purchase_yoy")


# -- D: code lists row by row ------------------------------------------------------------------------------

_CODES = """codes(dimension, no, code, name) AS (VALUES ('currency', 1, 'VND', 'Việt Nam Đồng'), ('currency', 2, 'USD', 'Đô la Mỹ'),
    ('salary_type', 1, 'range', 'Khoảng lương (min - max)'), ('salary_type', 2, 'single', 'Mức lương cố định'), ('salary_type', 3, 'at_least', 'Từ mức này trở lên'),
    ('salary_type', 4, 'upto', 'Lên tới / tối đa mức này'), ('salary_type', 5, 'negotiable', 'Lương thương lượng'),
    ('experience_type', 1, 'none', 'Không yêu cầu kinh nghiệm'), ('experience_type', 2, 'single', 'Số năm kinh nghiệm'), ('experience_type', 3, 'range', 'Khoảng kinh nghiệm'),
    ('experience_type', 4, 'at_least', 'Ít nhất X năm kinh nghiệm'), ('experience_type', 5, 'upto', 'Tối đa X năm kinh nghiệm'))"""


@query(
    "d06_code_lists_with_postings",
    f"""WITH {SILVER_SQL}, {_CODES}, seen AS (SELECT 'currency' AS dimension, currency AS code FROM silver UNION ALL SELECT 'salary_type', salary_type FROM silver UNION ALL SELECT 'experience_type', experience_type FROM silver),
    n AS (SELECT dimension, code, count(*) AS n FROM seen GROUP BY 1, 2) SELECT dimension, no, codes.code, name, sha256(codes.code) AS key, CAST(coalesce(n, 0) AS BIGINT) AS postings FROM codes LEFT JOIN n USING (dimension, code)""",
)
def _(t):
    """Every code of three lists with its name, key and the postings that carry it."""
    names = ("currency", "salary_type", "experience_type")
    listed = [
        dims.literal_dim(t.spark, n).select(F.lit(n).alias("dimension"), F.col(f"{n}_no").alias("no"), F.col(f"{n}_code").alias("code"), F.col(f"{n}_name").alias("name"), F.col(f"{n}_key").alias("key"))
        for n in names
    ]
    seen = skills.stack_arrays(standardized(t).select(*[F.array(n).alias(n) for n in names]), [], {n: n for n in names})
    counts = seen.groupBy(F.col("skill_type").alias("dimension"), F.col("raw_skill").alias("code")).agg(F.count(F.lit(1)).alias("_n"))
    rows = listed[0].unionByName(listed[1]).unionByName(listed[2]).join(counts, ["dimension", "code"], "left")
    return rows.select("dimension", "no", "code", "name", "key", F.coalesce("_n", F.lit(0)).alias("postings"))


@query(
    "d02_places_with_postings",
    f"""WITH {SILVER_SQL}, places AS (SELECT unnest({PLACES_SQL}) AS name, generate_subscripts({PLACES_SQL}, 1) AS no), n AS (SELECT location_clean AS name, count(*) AS n FROM silver GROUP BY 1)
    SELECT CAST(no AS INT) AS no, name, sha256(name) AS key, CAST(coalesce(n, 0) AS BIGINT) AS postings FROM places LEFT JOIN n USING (name)""",
)
def _(t):
    """Every province, and the rest, in list order with its key and postings."""
    counts = standardized(t).groupBy(F.col("location_clean").alias("province_name")).agg(F.count(F.lit(1)).alias("_n"))
    places = dims.literal_dim(t.spark, "location").join(counts, "province_name", "left")
    return places.select(F.col("location_no").alias("no"), F.col("province_name").alias("name"), F.col("location_key").alias("key"), F.coalesce("_n", F.lit(0)).alias("postings"))
