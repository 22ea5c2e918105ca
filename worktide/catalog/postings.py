"""Job postings derived from order lines, so that the posting pipeline runs over a table that grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import OTHER_PLACE, PROVINCES, SECTORS
from .base import Tables


def _pick(index, values):
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


CATEGORIES = {
    "topcv": ("Kế toán", "Marketing", "Chưa rõ"),
    "careerviet": ("Bán hàng", "Công nghệ thông tin", "Du lịch"),
    "vietnamworks": ("Y tế", "Kho bãi", "Khác"),
}
EXPECTED_SECTORS = {
    "topcv": ("finance", "retail", "other"),
    "careerviet": ("retail", "ict", "hospitality"),
    "vietnamworks": ("health", "transport", "other"),
}


def bronze(t: Tables) -> DataFrame:
    """One raw posting per order line. Lines of an order share a link; every seventh has none."""
    k, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    q = F.col("l_quantity").cast("int")
    day = F.col("l_shipdate").cast("date")
    years, platform = s % 5, _pick(s % 3, list(CATEGORIES))
    category = F.lit(None).cast("string")
    for i, names in enumerate(CATEGORIES.values()):
        category = F.when(s % 3 == i, _pick(p % 3, names)).otherwise(category)
    salary = (
        F.when(n == 1, F.concat(q, F.lit(" - "), q + 5, F.lit(" triệu")))
        .when(n == 2, F.concat(F.lit("Từ "), q, F.lit(" đến "), q + 5, F.lit(" triệu")))
        .when(n == 3, F.concat(F.lit("Lên đến "), q, F.lit(" triệu")))
        .when(n == 4, F.concat(F.lit("Từ "), q, F.lit(" triệu")))
        .when(n == 5, F.concat(q * 100, F.lit(" USD")))
        .when(n == 6, F.lit("Thoả thuận"))
        .otherwise(q.cast("string"))
    )
    experience = (
        F.when(p % 5 == 0, F.lit("Không yêu cầu"))
        .when(p % 5 == 1, F.concat(years, F.lit(" - "), years + 2, F.lit(" năm")))
        .when(p % 5 == 2, F.concat(F.lit("Trên "), years, F.lit(" năm")))
        .when(p % 5 == 3, F.concat(F.lit("Dưới "), years + 1, F.lit(" năm")))
        .otherwise(F.concat(years, F.lit(",5 years")))
    )
    deadline = F.when(s % 2 == 0, F.concat(F.lit("Hạn nộp hồ sơ: "), F.date_format(day, "d/M/yyyy"))).otherwise(
        F.date_format(day, "yyyy-MM-dd")
    )
    description = F.concat(
        F.lit("Mô tả: chăm sóc khách hàng lớn của công ty. Yêu cầu công việc: Thành thạo Python, SQL và dự án nhóm "),
        p % 50, F.lit(" trở lên Quyền lợi: thưởng tết"),
    )
    return t.spread("lineitem", "l_orderkey").select(
        platform.alias("platform"),
        F.when(n < 7, F.concat(F.lit("https://jobs.example/"), k)).alias("link"),
        F.concat(F.lit("  Kỹ sư   Dữ liệu( "), p % 100, F.lit(" )")).alias("title"),
        F.concat(F.lit("Công ty-"), s).alias("company"),
        F.when(s % 7 == 0, F.lit("Toàn quốc")).otherwise(F.concat(F.lit("Quận 1, "), _pick(s % 63, PROVINCES))).alias("location"),
        salary.alias("salary"), experience.alias("experience"), deadline.alias("expired_date"),
        _pick(p % 4, ["Trưởng/Phó phòng", "Nhân viên", "Quản lý / Giám sát", "xyz"]).alias("level"),
        _pick(s % 4, ["Đại học trở lên", "Cao đẳng", None, "Trung cấp"]).alias("education"),
        _pick(n % 3, ["Toàn thời gian", "Bán thời gian", "Thực tập"]).alias("work_form"),
        F.concat(q, F.lit(" người")).alias("quantity"), category.alias("category"),
        F.array(F.concat(F.lit("Kỹ năng "), p % 40), F.concat(F.lit("tool_"), s % 30)).alias("skills"),
        description.alias("job_description"),
    )


def _sql_list(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


PLACES_SQL = _sql_list((*PROVINCES, OTHER_PLACE))
_SECTOR_SQL = "CASE " + " ".join(
    f"WHEN s % 3 = {i} THEN {_sql_list([SECTORS[x] for x in names])}[p % 3 + 1]" for i, names in enumerate(EXPECTED_SECTORS.values())
) + " END"

# What the parsed postings must be, in closed form over the same order lines.
SILVER_SQL = f"""
silver AS (
  SELECT k, p, s, n, q, {_sql_list(CATEGORIES)}[s % 3 + 1] AS platform,
    CASE WHEN n < 7 THEN 'https://jobs.example/' || k END AS link,
    'kỹ sư dữ liệu (' || (p % 100) || ')' AS title_clean,
    'công ty - ' || s AS company_clean,
    CASE WHEN s % 7 = 0 THEN 'Khác' ELSE {_sql_list(PROVINCES)}[s % 63 + 1] END AS location_clean,
    CAST(CASE WHEN n IN (1, 2, 4, 7) THEN q * 1000000 WHEN n = 5 THEN q * 100 END AS BIGINT) AS min_salary,
    CAST(CASE WHEN n IN (1, 2) THEN (q + 5) * 1000000 WHEN n IN (3, 7) THEN q * 1000000 WHEN n = 5 THEN q * 100 END AS BIGINT) AS max_salary,
    CASE WHEN n = 5 THEN 'USD' ELSE 'VND' END AS currency,
    CASE WHEN n IN (1, 2) THEN 'range' WHEN n = 3 THEN 'upto' WHEN n = 4 THEN 'at_least' WHEN n = 6 THEN 'negotiable' ELSE 'single' END AS salary_type,
    CAST(CASE p % 5 WHEN 0 THEN 0 WHEN 1 THEN s % 5 WHEN 2 THEN s % 5 WHEN 4 THEN s % 5 + 0.5 END AS DOUBLE) AS min_years,
    CAST(CASE p % 5 WHEN 0 THEN 0 WHEN 1 THEN s % 5 + 2 WHEN 3 THEN s % 5 + 1 WHEN 4 THEN s % 5 + 0.5 END AS DOUBLE) AS max_years,
    CASE p % 5 WHEN 0 THEN 'none' WHEN 1 THEN 'range' WHEN 2 THEN 'at_least' WHEN 3 THEN 'upto' ELSE 'single' END AS experience_type,
    ['3', '2', '0', '1'][s % 4 + 1] AS education_standard,
    ['senior_manager', 'staff', 'manager', NULL][p % 4 + 1] AS level_standard,
    ['full_time', 'part_time', 'internship'][n % 3 + 1] AS work_form_standard,
    CAST(q AS DOUBLE) AS quantity_normalized, day AS expired_date_norm,
    {_SECTOR_SQL} AS category_name_final
  FROM (SELECT l_orderkey AS k, l_partkey AS p, l_suppkey AS s, l_linenumber AS n, CAST(l_quantity AS INT) AS q,
               CAST(l_shipdate AS DATE) AS day FROM lineitem))
"""
