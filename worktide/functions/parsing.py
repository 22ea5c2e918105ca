"""Parsers for salary, experience, dates, quantities, periods and CV text (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, fold_accents, let, strip_space

# Salary units with currency and multiplier.
UNIT_SCALE = {"tr": 1_000_000, "triệu": 1_000_000, "trieu": 1_000_000, "k": 1_000, "vnd": 1, "đ": 1, "₫": 1, "usd": 1, "$": 1}
DOLLAR_UNITS = ("usd", "$")
DECIMAL_UNITS = ("tr", "triệu", "trieu", "usd", "$")

# Salary patterns, tried in this order.
_AMOUNT = r"([\d.,]+)"
_UNIT = r"(tr|triệu|k|usd|vnd|₫)"
RANGE_DASH = rf"{_AMOUNT}\s*{_UNIT}?\s*[-–]\s*{_AMOUNT}\s*{_UNIT}?"
RANGE_TO = rf"từ\s*{_AMOUNT}\s*{_UNIT}?\s*(?:đến|to)\s*{_AMOUNT}\s*{_UNIT}?"
UP_TO = rf"(?:lên đến|upto|up to|tối đa)\s*{_AMOUNT}\s*{_UNIT}?"
AT_LEAST = rf"(?:từ|ít nhất|tối thiểu|>=)\s*{_AMOUNT}\s*{_UNIT}?"
SINGLE = rf"{_AMOUNT}\s*{_UNIT}"
NEGOTIABLE = "thoả thuận|thương lượng|cạnh tranh|negotiable|competitive"
NEGOTIABLE_ALSO = "thỏa thuận"

# Experience wording.
NO_EXPERIENCE = ("không yêu cầu", "không cần kinh nghiệm", "no experience", "fresh", "mới tốt nghiệp")
_YEARS = r"(\d+(?:[.,]\d+)?)"
_YEAR_WORD = r"(?:năm|nam|years?|yrs?)"
YEARS_RANGE = rf"(?:từ|from)?\s*{_YEARS}\s*\+?\s*{_YEAR_WORD}?\s*(?:-|–|to|đến)\s*{_YEARS}\s*\+?\s*{_YEAR_WORD}"
YEARS_AT_LEAST = rf"(?:ít nhất|tối thiểu|>=|>\s*=?|from|at least|minimum|trên)\s*{_YEARS}\s*\+?\s*{_YEAR_WORD}"
YEARS_UP_TO = rf"(?:tối đa|<=|<\s*=?|dưới|up to)\s*{_YEARS}\s*{_YEAR_WORD}"
YEARS_SINGLE = rf"{_YEARS}\s*\+?\s*{_YEAR_WORD}"
DEADLINE_LABEL = "hạn nộp hồ sơ"

# Skills and places looked up in CV text.
CV_SKILLS = (
    "python", "java", "javascript", "typescript", "react", "reactjs", "nodejs", "fastapi", "django",
    "spring", "docker", "kubernetes", "sql", "postgresql", "mysql", "mongodb", "redis", "git", "aws",
    "gcp", "azure", "spark", "airflow", "kafka", "excel", "sap", "misa", "power bi", "tableau",
)
CV_PLACES = ("hồ chí minh", "hà nội", "đà nẵng", "bình dương", "đồng nai", "hải phòng", "cần thơ", "long an")


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _number(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def parse_money(token: Column, decimal: Column) -> Column:
    """Amount in a token; without ``decimal`` every separator groups thousands."""

    def read(text: Column) -> Column:
        whole = F.regexp_replace(text, "[.,]", "").try_cast("double")
        dot_last = text.rlike(r"\.[^,]*$")
        both = F.when(dot_last, F.replace(text, F.lit(","), F.lit(""))).otherwise(
            F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
        )
        fraction = F.when(text.contains(".") & text.contains(","), both.try_cast("double")).otherwise(_number(text))
        return F.when(decimal, fraction).otherwise(whole)

    return let(F.regexp_replace(token, "[^0-9.,]", ""), read)


def _amount(token: Column, unit: Column) -> Column:
    """Amount in whole currency units; ``unit`` must be cheap to evaluate (a bound variable)."""
    scale = F.when(unit.isin("tr", "triệu", "trieu"), 1_000_000).when(unit == "k", 1_000).otherwise(1)
    return F.rint(parse_money(token, unit.isin(*DECIMAL_UNITS)) * scale).cast("bigint")


def _currency(amount: Column, unit: Column) -> Column:
    return F.when(amount.isNotNull(), F.when(unit.isin(*DOLLAR_UNITS), "USD").otherwise("VND"))


def _groups(text: Column, pattern: str, count: int) -> Column:
    """All groups of the first match of ``pattern`` as an array, with one regex evaluation."""
    marks = "\u0001".join(f"${i}" for i in range(1, count + 1))
    return F.split(F.regexp_replace(text, rf"(?s)^.*?{pattern}.*$", marks), "\u0001")


def _salary(low: Column, high: Column, currency: Column, kind: str | None, status: Column | str, pattern: str | None) -> Column:
    return F.struct(
        low.cast("bigint").alias("min_salary"),
        high.cast("bigint").alias("max_salary"),
        currency.cast("string").alias("currency"),
        F.lit(kind).cast("string").alias("salary_type"),
        (F.lit(status) if isinstance(status, str) else status).cast("string").alias("parse_status"),
        F.lit(pattern).cast("string").alias("pattern_id"),
    )


def parse_salary(text: Column, strict_reference: bool = False) -> Column:
    """Salary text as struct(min_salary, max_salary, currency, salary_type, parse_status, pattern_id).

    ``strict_reference`` ignores the dollar sign and one spelling of "negotiable".
    """
    value = F.lower(F.trim(text))
    if not strict_reference:
        value = F.regexp_replace(value, r"\$\s*([\d.,]+)", "$1 usd")
        value = F.regexp_replace(value, r"([\d.,]+)\s*\$", "$1 usd")
    negotiable = NEGOTIABLE if strict_reference else f"{NEGOTIABLE}|{NEGOTIABLE_ALSO}"
    nothing = _null("bigint")

    def ranged(v: Column, pattern: str, name: str) -> Column:
        def ends(g: Column) -> Column:
            unit_low = F.when(g[1] != "", g[1]).otherwise(g[3])
            unit_high = F.when(g[3] != "", g[3]).otherwise(g[1])
            return F.struct(
                _amount(g[0], unit_low).alias("a"), _amount(g[2], unit_high).alias("b"), unit_low.alias("unit")
            )

        def build(e: Column) -> Column:
            a, b = e["a"], e["b"]
            full = a.isNotNull() & b.isNotNull()
            return _salary(
                F.when(a > b, b).otherwise(a), F.when(a > b, a).otherwise(b), _currency(a, e["unit"]), "range",
                F.when(full, "parsed").otherwise("partial"), name,
            )

        return let(let(_groups(v, pattern, 4), ends), build)

    def one_sided(v: Column, pattern: str, kind: str) -> Column:
        def build(e: Column) -> Column:
            a = e["a"]
            low = nothing if kind == "upto" else a
            high = nothing if kind == "at_least" else a
            status = F.when(a.isNotNull(), "parsed").otherwise("partial")
            return _salary(low, high, _currency(a, e["unit"]), kind, status, kind)

        ends = let(
            _groups(v, pattern, 2), lambda g: F.struct(_amount(g[0], g[1]).alias("a"), g[1].alias("unit"))
        )
        return let(ends, build)

    def fallback(v: Column) -> Column:
        tokens = F.regexp_extract_all(v, F.lit(r"([\d.,]+)"), 1)
        numbers = F.filter(F.transform(tokens, lambda t: parse_money(t, F.lit(True))), lambda n: n.isNotNull())
        dollars = v.rlike(r"(?U)\b(usd|dollar)\b")
        currency = F.when(dollars, "USD").otherwise("VND")

        def full(n: Column) -> Column:
            return F.rint(F.when(~dollars & (n < 1000), n * 1_000_000).otherwise(n))

        def build(ns: Column) -> Column:
            return (
                F.when(F.size(ns) == 0, _salary(nothing, nothing, _null("string"), None, "unparsed", "no_match"))
                .when(F.size(ns) == 1, _salary(full(ns[0]), full(ns[0]), currency, "single", "assumed", "fallback_single"))
                .otherwise(
                    _salary(full(F.array_min(ns)), full(F.array_max(ns)), currency, "range", "assumed", "fallback_range")
                )
            )

        return let(numbers, build)

    def ladder(v: Column) -> Column:
        return (
            F.when(v.isNull() | (v == ""), _salary(nothing, nothing, _null("string"), None, "missing", None))
            .when(v.rlike(RANGE_DASH), ranged(v, RANGE_DASH, "range_dash"))
            .when(v.rlike(RANGE_TO), ranged(v, RANGE_TO, "range_to"))
            .when(v.rlike(UP_TO), one_sided(v, UP_TO, "upto"))
            .when(v.rlike(AT_LEAST), one_sided(v, AT_LEAST, "at_least"))
            .when(v.rlike(SINGLE), one_sided(v, SINGLE, "single"))
            .when(v.rlike(negotiable), _salary(nothing, nothing, _null("string"), "negotiable", "tag", "negotiable"))
            .otherwise(fallback(v))
        )

    return let(value, ladder)


def parse_experience(text: Column) -> Column:
    """Experience text as struct(min_years, max_years, experience_type, parse_status)."""

    def result(low: Column, high: Column, kind: str | None, status: str) -> Column:
        return F.struct(
            low.cast("double").alias("min_years"), high.cast("double").alias("max_years"),
            F.lit(kind).cast("string").alias("experience_type"), F.lit(status).alias("parse_status"),
        )

    nothing = _null("double")

    def ladder(v: Column) -> Column:
        def years(pattern: str, group: int = 1) -> Column:
            return _number(F.regexp_extract(v, pattern, group))

        none = F.lit(False)
        for words in NO_EXPERIENCE:
            none = none | v.contains(words)
        bare = F.transform(F.regexp_extract_all(v, F.lit(_YEARS), 1), _number)

        def assumed(ns: Column) -> Column:
            return (
                F.when(F.size(ns) == 0, result(nothing, nothing, None, "unparsed"))
                .when(F.size(ns) == 1, result(ns[0], ns[0], "single", "assumed_years"))
                .otherwise(result(ns[0], ns[1], "range", "assumed_years"))
            )

        return (
            F.when(v.isNull() | (v == ""), result(nothing, nothing, None, "missing"))
            .when(none, result(F.lit(0.0), F.lit(0.0), "none", "tag"))
            .when(v.rlike(YEARS_RANGE), result(years(YEARS_RANGE), years(YEARS_RANGE, 2), "range", "parsed"))
            .when(v.rlike(YEARS_AT_LEAST), result(years(YEARS_AT_LEAST), nothing, "at_least", "parsed"))
            .when(v.rlike(YEARS_UP_TO), result(nothing, years(YEARS_UP_TO), "upto", "parsed"))
            .when(v.rlike(YEARS_SINGLE), result(years(YEARS_SINGLE), years(YEARS_SINGLE), "single", "parsed"))
            .otherwise(let(bare, assumed))
        )

    return let(F.lower(F.trim(text)), ladder)


def parse_date(text: Column) -> Column:
    """Deadline text as DATE: ISO first, else the first d/m/yyyy; null when invalid."""

    def read(v: Column) -> Column:
        iso = v.rlike(r"^\d{4}-\d{2}-\d{2}([T ].*)?$")
        dmy = r"(\d{1,2})[/-](\d{1,2})[/-](\d{4})"
        loose = F.concat_ws("-", *[F.regexp_extract(v, dmy, i) for i in (3, 2, 1)])
        return F.when(iso, F.substring(v, 1, 10).try_cast("date")).otherwise(loose.try_cast("date"))

    trimmed = F.trim(text)
    labelled = F.lower(trimmed).contains(DEADLINE_LABEL)
    return let(F.when(labelled, F.trim(F.regexp_extract(trimmed, r"([^:]*)$", 1))).otherwise(trimmed), read)


def parse_quantity(text: Column) -> Column:
    """First number in the text; 1.0 when there is none."""
    return F.coalesce(_number(F.regexp_extract(text, r"(\d+(?:[.,]\d+)?)", 1)), F.lit(1.0))


def clean_number(text: Column) -> Column:
    """Number with thousands commas and quotes; ``-`` and blanks are null."""
    return F.trim(F.translate(text, ',"', "")).try_cast("double")


def parse_period(label: Column) -> Column:
    """``T3 2024`` or ``Q2 2024`` as struct(year, quarter, month); month is null for quarters."""
    number = F.regexp_extract(label, r"^[TQ](\d+)", 1).try_cast("int")
    month = F.when(label.startswith("T"), number)
    return F.struct(
        F.regexp_extract(label, r"\s(\d+)\s*$", 1).try_cast("int").alias("year"),
        F.coalesce(F.ceil(month / 3).cast("int"), F.when(label.startswith("Q"), number)).alias("quarter"),
        month.alias("month"),
    )


def label_tail(label: Column) -> Column:
    """Last word of a label (``Aggregate: Total`` -> ``Total``)."""
    return F.element_at(F.split(F.trim(label), " "), -1)


def parse_cv(text: Column, today: Column) -> Column:
    """CV text as struct(years, source, skills, location)."""

    def read(v: Column) -> Column:
        explicit = F.coalesce(
            F.regexp_extract(v, r"(?U)(\d+(?:\.\d+)?)\s*năm\s*kinh\s*nghiệm", 1).try_cast("double"),
            F.regexp_extract(v, r"(?U)(\d+(?:\.\d+)?)\s*years?\s*(?:of\s*)?experience", 1).try_cast("double"),
        )
        starts = F.regexp_extract_all(v, F.lit(r"(20\d{2})\s*[-–]\s*(?:20\d{2}|nay|present)"), 1)
        inferred = (F.year(today) - F.array_min(F.transform(starts, lambda y: y.cast("int")))).cast("double")
        source = F.when(explicit.isNotNull(), "explicit").when(inferred.isNotNull(), "inferred").otherwise("default")
        skills = F.filter(F.array(*[F.lit(s) for s in CV_SKILLS]), lambda s: v.contains(s))
        place = F.get(F.filter(F.array(*[F.lit(p) for p in CV_PLACES]), lambda p: v.contains(p)), F.lit(0))
        return F.struct(
            F.coalesce(explicit, inferred).alias("years"), source.alias("source"),
            F.array_sort(skills).alias("skills"), F.initcap(place).alias("location"),
        )

    return let(F.lower(text), read)


# Headings that open the requirement section ...
SECTION_STARTS = (
    r"YÊU\s*CẦU\s*ỨNG\s*VIÊN", r"Yêu\s*[Cc]ầu\s*[Ứứ]ng\s*[Vv]iên",
    r"YÊU\s*CẦU\s*CÔNG\s*VIỆC", r"Yêu\s*[Cc]ầu\s*[Cc]ông\s*[Vv]iệc", r"YÊU\s*CẦU",
    r"TIÊU\s*CHUẨN\s*TUYỂN\s*DỤNG", r"Tiêu\s*[Cc]huẩn\s*[Tt]uyển\s*[Dd]ụng",
    r"TIÊU\s*CHUẨN", r"Tiêu\s*[Cc]huẩn",
    r"YÊU\s*CẦU\s*KỸ\s*NĂNG", r"Yêu\s*[Cc]ầu\s*[Kk]ỹ\s*[Nn]ăng",
    r"ĐIỀU\s*KIỆN", r"Điều\s*[Kk]iện",
    r"TRÌNH\s*ĐỘ\s*YÊU\s*CẦU", r"Trình\s*[Đđ]ộ\s*[Yy]êu\s*[Cc]ầu",
    r"JOB\s*REQUIREMENTS?", r"REQUIREMENTS?", r"QUALIFICATIONS?", r"[Rr]equirements?", r"[Qq]ualifications?",
    r"SKILLS?\s*(?:REQUIRED|NEEDED)?", r"Skills?\s*(?:Required|Needed)?", r"[Rr]equired\s*[Ss]kills?",
    r"(?:^|\n)\s*:\s*(?=\S)",
)
# ... and headings that close it.
SECTION_ENDS = (
    r"QUYỀN\s*LỢI", r"[Qq]uyền\s*[Ll]ợi", r"PHÚC\s*LỢI", r"[Pp]húc\s*[Ll]ợi", r"THU\s*NHẬP", r"[Tt]hu\s*[Nn]hập",
    r"ĐỊA\s*ĐIỂM\s*LÀM\s*VIỆC", r"[Đđ]ịa\s*[Đđ]iểm\s*[Ll]àm\s*[Vv]iệc",
    r"THÔNG\s*TIN\s*KHÁC", r"[Tt]hông\s*[Tt]in\s*[Kk]hác", r"CÁC\s*PHÚC\s*LỢI", r"[Cc]ác\s*[Pp]húc\s*[Ll]ợi",
    r"MÔ\s*TẢ\s*CÔNG\s*VIỆC", r"[Mm]ô\s*[Tt]ả\s*[Cc]ông\s*[Vv]iệc",
    r"BENEFITS?", r"[Bb]enefits?", r"COMPENSATION", r"[Cc]ompensation",
    r"WHY\s*(?:JOIN|US)", r"[Ww]hy\s*(?:[Jj]oin|[Uu]s)",
    r"WORKING\s*(?:HOURS?|LOCATION|ENVIRONMENT)", r"[Ww]orking\s*(?:[Hh]ours?|[Ll]ocation|[Ee]nvironment)",
)
SECTION_RULES = (r"\n{3,}", r"\n[-─═]{5,}\n")


def _any_of(patterns: tuple[str, ...]) -> str:
    """Alternation in order, behind a look-ahead on the possible first letters."""
    lettered = [p for p in patterns if not p.startswith("(")]
    heads = "".join(sorted({c for p in lettered for c in (p[1 : p.index("]")] if p[0] == "[" else p[0])}))
    rest = [p for p in patterns if p.startswith("(")]
    return "(?:" + "|".join([f"(?=[{heads}])(?:" + "|".join(lettered) + ")", *rest]) + ")"


def requirement_section(text: Column) -> Column:
    """The requirement part of a job description.

    The earliest start heading beyond character 20 opens it, the earliest end heading beyond
    character 10 closes it; short results fall back to the longest block, then to the whole text.
    """

    def first_hit(v: Column, patterns: tuple[str, ...], beyond: int) -> Column:
        """struct(at, size) of the earliest first occurrence of any pattern beyond a position."""
        none = F.lit(None).cast("struct<at:int,size:int>")

        def hit(at: Column, size: Column) -> Column:
            return F.struct(at.cast("int").alias("at"), size.cast("int").alias("size"))

        def one_by_one() -> Column:
            places = [F.struct(F.regexp_instr(v, F.lit(p)).alias("at"), F.lit(i).alias("rank")) for i, p in enumerate(patterns)]
            sizes = F.lit(0)
            best = F.array_min(F.filter(F.array(*places), lambda h: h["at"] > beyond + 1))

            def with_size(b: Column) -> Column:
                size = sizes
                for i, p in enumerate(patterns):
                    size = F.when(b["rank"] == i, F.length(F.regexp_extract(v, p, 0))).otherwise(size)
                return F.when(b.isNotNull(), hit(b["at"], size))

            return let(best, with_size)

        # Where the union of all patterns first matches late enough, that match is the answer.
        union = _any_of(patterns)
        return let(
            F.regexp_instr(v, F.lit(union)),
            lambda at: F.when(at == 0, none)
            .when(at > beyond + 1, hit(at, F.length(F.regexp_extract(v, union, 0))))
            .otherwise(one_by_one()),
        )

    def longest_block(v: Column, rule: str) -> Column:
        parts = F.split(v, rule)
        blocks = F.transform(
            F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
            lambda p, i: F.struct((-F.length(p)).alias("size"), i.alias("rank"), strip_space(p).alias("text")),
        )
        return F.array_min(F.filter(blocks, lambda b: F.length(b["text"]) > 50))["text"]

    def cut(content: Column) -> Column:
        return let(
            first_hit(content, SECTION_ENDS, 10),
            lambda end: strip_space(F.when(end.isNull(), content).otherwise(F.substring(content, F.lit(1), end["at"] - 1))),
        )

    def section(v: Column) -> Column:
        def after(start: Column) -> Column:
            body = F.substring(v, start["at"] + start["size"], F.length(v))
            return let(F.regexp_replace(body, r"^[\s\x85\p{Z}:*\-–—|]+", ""), cut)

        found = let(first_hit(v, SECTION_STARTS, 20), lambda start: F.when(start.isNotNull(), after(start)))
        fallback = F.coalesce(longest_block(v, SECTION_RULES[0]), longest_block(v, SECTION_RULES[1]), strip_space(v))
        return let(found, lambda f: F.when(F.length(f) > 30, f).otherwise(fallback))

    return F.when(F.coalesce(collapse(text), F.lit("")) == "", F.lit("")).otherwise(let(text, section))


def match_form(text: Column) -> Column:
    """Accent-free lower-case words only, as used when places are looked up in text."""
    plain = F.lower(fold_accents(text))
    return collapse(F.regexp_replace(plain, r"[^\w\s]", ""))
