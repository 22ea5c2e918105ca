import datetime

import pytest
from pyspark.sql import functions as F

from worktide.functions import classify, keys, parsing, text
from worktide.functions.rules import DEFAULT_SECTOR, SECTOR_RULES, SECTORS


def run(spark, fn, values, kind="string"):
    """Apply a Column function to a list of inputs, returning results in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    rows = df.select("i", fn(F.col("v")).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


def cases(spark, fn, pairs, kind="string"):
    got = run(spark, fn, [p[0] for p in pairs], kind)
    got = [tuple(g) if hasattr(g, "asDict") else g for g in got]
    assert dict(enumerate(zip([p[0] for p in pairs], got))) == dict(enumerate(pairs))


SALARIES = [
    ("10 - 15 triệu", (10000000, 15000000, "VND", "range", "parsed", "range_dash")),
    ("20 - 10 triệu", (10000000, 20000000, "VND", "range", "parsed", "range_dash")),
    ("1000 - 2000 USD", (1000, 2000, "USD", "range", "parsed", "range_dash")),
    ("Từ 10 đến 15 triệu", (10000000, 15000000, "VND", "range", "parsed", "range_to")),
    ("Lên đến 30 triệu", (None, 30000000, "VND", "upto", "parsed", "upto")),
    ("Từ 10 triệu", (10000000, None, "VND", "at_least", "parsed", "at_least")),
    ("Tới 20 triệu", (20000000, 20000000, "VND", "single", "parsed", "single")),
    ("15,5 - 20 triệu", (15500000, 20000000, "VND", "range", "parsed", "range_dash")),
    ("Thoả thuận", (None, None, None, "negotiable", "tag", "negotiable")),
    ("15", (15000000, 15000000, "VND", "single", "assumed", "fallback_single")),
    ("5.000.000 và 7.500.000", (None, None, None, None, "unparsed", "no_match")),
    # two bare amounts keep the order of their raw values; only the small one is read as millions
    ("10 và 2000", (10000000, 2000, "VND", "range", "assumed", "fallback_range")),
    ("hấp dẫn", (None, None, None, None, "unparsed", "no_match")),
    ("  ", (None, None, None, None, "missing", None)),
    (None, (None, None, None, None, "missing", None)),
]


def test_salary(spark):
    cases(spark, parsing.parse_salary, SALARIES)


def test_salary_build_default_and_strict(spark):
    cases(spark, parsing.parse_salary, [
        ("Thỏa thuận", (None, None, None, "negotiable", "tag", "negotiable")),
        ("$1000", (1000, 1000, "USD", "single", "parsed", "single")),
    ])
    cases(spark, lambda c: parsing.parse_salary(c, strict_reference=True), [
        ("Thỏa thuận", (None, None, None, None, "unparsed", "no_match")),
        ("$1000", (1000, 1000, "VND", "single", "assumed", "fallback_single")),
    ])


def test_experience(spark):
    cases(spark, parsing.parse_experience, [
        ("Không yêu cầu", (0.0, 0.0, "none", "tag")),
        ("1 - 3 năm", (1.0, 3.0, "range", "parsed")),
        ("Trên 5 năm", (5.0, None, "at_least", "parsed")),
        ("Dưới 1 năm", (None, 1.0, "upto", "parsed")),
        ("2 năm", (2.0, 2.0, "single", "parsed")),
        ("1,5 years", (1.5, 1.5, "single", "parsed")),
        ("3", (3.0, 3.0, "single", "assumed_years")),
        ("abc", (None, None, None, "unparsed")),
        (None, (None, None, None, "missing")),
    ])


def test_dates(spark):
    cases(spark, parsing.parse_date, [
        ("Hạn nộp hồ sơ: 25/12/2025", datetime.date(2025, 12, 25)),
        ("2025-12-25T00:00:00Z", datetime.date(2025, 12, 25)),
        ("31/02/2026", None),
        ("không rõ", None),
        (None, None),
    ])


def test_classification(spark):
    cases(spark, classify.level, [
        ("Trưởng/Phó phòng", ("senior_manager", "matched", "truong/pho phong")),
        ("Phó Giám đốc", ("executive", "matched", "giam doc")),
        ("Quản lý / Giám sát", ("manager", "matched", "quan ly")),
        ("Mới tốt nghiệp", ("fresher", "matched", "moi tot nghiep")),
        ("xyz", (None, "unmapped", None)),
        (None, (None, "missing", None)),
    ])
    cases(spark, classify.education, [
        ("Đại học trở lên", ("3", "matched", "dai hoc")),
        ("Trung học", ("0", "matched", "trung hoc")),
        ("Sau đại học", ("4", "matched", "sau dai hoc")),
    ])
    cases(spark, classify.work_form, [
        ("Toàn thời gian", "full_time"), ("Bán thời gian", "part_time"), ("Thực tập", "internship"),
        ("Khác", "other"), (None, None), (" ", None),
    ])


def test_sector_by_source(spark):
    df = spark.createDataFrame(
        [(0, "TopCV ", "Nhân viên kinh doanh"), (1, "topcv", "Digital"), (2, "unknown", "IT"), (3, "topcv", None)],
        "i int, p string, c string",
    )
    rule = classify.categorize_by(F.col("p"), F.col("c"), SECTOR_RULES, DEFAULT_SECTOR)
    got = [r[0] for r in df.orderBy("i").select(rule).collect()]
    assert got == [SECTORS["retail"], SECTORS["ict"], DEFAULT_SECTOR, DEFAULT_SECTOR]


def test_quantity_period_number(spark):
    cases(spark, parsing.parse_quantity, [("2 người", 2.0), ("10,5", 10.5), (None, 1.0), ("abc", 1.0)])
    cases(spark, parsing.parse_period, [("T3 2024", (2024, 1, 3)), ("Q2 2024", (2024, 2, None))])
    cases(spark, parsing.clean_number, [('"1,234.5"', 1234.5), ("-", None), ("", None), (None, None)])
    cases(spark, parsing.label_tail, [("Aggregate: Total", "Total")])


def test_text(spark):
    cases(spark, text.normalize_common, [
        ("  Kế toán ( tổng  hợp )", "kế toán (tổng hợp)"), ("Dev(Java)", "dev (java)"), (" ", None), (None, None),
        ("a  b", "a b"),
    ])
    cases(spark, text.normalize_name, [("Kế toán-Thuế/HCM,VN", "kế toán - thuế / hcm, vn"), ("A&B*C", "a b c")])
    cases(spark, text.unaccent, [("Đà  Nẵng", "da nang"), ("é", "e"), (None, None)])
    cases(spark, text.normalize_skill, [("C++/Python", "c++ python"), ("C", None), ("Kỹ năng_mềm", "ky nang mem")])
    cases(spark, text.smart_capitalize, [
        ("làm việc nhóm", "Làm việc nhóm"), ("SQL", "SQL"), ("AutoCAD", "AutoCAD"), ("API gateway", "API gateway"),
        ("python", "Python"),
    ])
    cases(spark, text.smart_title, [("machine learning", "Machine Learning"), ("SQL server2", "SQL server2")])
    cases(spark, lambda c: text.truncate_words(c, 10), [("short", "short"), ("hello big world", "hello big...")])


def test_noise(spark):
    pairs = [
        ("AI", False), (".NET", False), ("3ds Max", False), ("360-degree feedback", False), ("Go", False),
        ("De", True), ("& product", True), ("2022 về kcn", True), ("中", True), ("Python", False), ("Tiếng Anh", False),
        ("đánh giá hiệu quả chiến dịch marketing", True),
        # starts upper-case, so the length rule does not apply
        ("Đánh giá hiệu quả chiến dịch marketing", False),
    ]
    cases(spark, text.is_noise, pairs)


def test_reasonable_skill_and_spans(spark):
    cases(spark, text.is_reasonable_skill, [
        ("SQL", False), ("AI", True), ("Go", False), ("Java", True), ("java", False), ("python", True), ("html5", False),
        ("web2", True), ("a b", False), ("làm việc nhóm", True), (None, False), ("  ", False),
    ])
    cases(spark, text.split_span, [
        ("(Python, Java/Docker)", ["Python", "Java", "Docker"]),
        ("kế toánTổng hợp A", ["kế toán Tổng hợp"]),
        (None, []),
    ])


def test_protect_terms(spark):
    cases(spark, text.protect_terms, [
        ("sales b2b/b2c, R&D/QA", "sales b2b/b2c , R&D / QA"), (None, ""), ("x&y", "x & y"),
    ])


def test_requirement_section(spark):
    lead = "Công ty chúng tôi đang tuyển dụng. "
    body = "Tốt nghiệp đại học, có ít nhất 2 năm kinh nghiệm"
    cases(spark, parsing.requirement_section, [
        (f"{lead}Yêu cầu công việc: {body} Quyền lợi: thưởng", body),
        (f"Yêu cầu: {body}", f"Yêu cầu: {body}"),  # heading within the first 20 characters is ignored
        ("ngắn\n\n\n" + "x" * 60 + "\n\n\n" + "y" * 70, "y" * 70),
        ("  chỉ có mô tả ", "chỉ có mô tả"), (None, ""), ("  ", ""),
    ])


def test_clean_requirement(spark):
    cases(spark, text.clean_requirement, [
        ("<p>Biết Java</p>\n- làm việcNhóm… tốt(nhé)", "Biết Java làm việc Nhóm . tốt nhé"), (None, ""),
    ])


def test_merge_lists(spark):
    df = spark.createDataFrame([(["SQL", "Go"], ["sql", "Rust", ""], None)], "a array<string>, b array<string>, c array<string>")
    row = df.select(
        text.merge_lists(F.col("a"), F.col("b"), F.col("c")).alias("exact"),
        text.merge_lists(F.col("a"), F.col("b"), fold=True).alias("fold"),
    ).first()
    assert row.exact == ["SQL", "Go", "sql", "Rust"]
    assert row.fold == ["SQL", "Go", "Rust"]


def test_parse_cv(spark):
    today = F.lit(datetime.date(2025, 6, 1))
    cases(spark, lambda c: parsing.parse_cv(c, today), [
        ("Có 3 năm kinh nghiệm Python tại Hà Nội", (3.0, "explicit", ["python"], "Hà Nội")),
        ("2019 - 2021 dev, 2021–nay SQL lead", (6.0, "inferred", ["sql"], None)),
        ("fresh", (None, "default", [], None)),
    ])


def test_weighted_text(spark):
    df = spark.createDataFrame([("Dev", "IT", None)], "t string, c string, s string")
    made = text.weighted_text([(F.col("t"), 2), (F.col("c"), 3), (F.col("s"), 1)], ["Tieu de", "Category_cu", "Ky nang"])
    assert df.select(made).first()[0] == "Tieu de: Dev. Dev. Category_cu: IT. IT. IT."


def test_keys(spark):
    df = spark.createDataFrame([("x", "a"), (" ", "a"), (None, "a")], "link string, p string")
    got = [r[0] for r in df.select(keys.business_key(F.col("link"), [F.col("p")])).collect()]
    assert got[1] == got[2] != got[0]


@pytest.mark.parametrize("mode", ["codegen", "interpreted"])
def test_parsers_do_not_depend_on_codegen(spark, mode):
    spark.conf.set("spark.sql.codegen.wholeStage", str(mode == "codegen").lower())
    try:
        test_experience(spark)
    finally:
        spark.conf.set("spark.sql.codegen.wholeStage", "true")
