"""Posting fields from saved web pages and API payloads, and link collection."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Labels on posting pages and the fields they fill.
FIELD_LABELS = {
    "Lương": "salary", "Kinh nghiệm": "experience", "Cấp bậc": "level", "Hết hạn nộp": "expired_date",
    "Hình thức": "work_form", "Ngành nghề": "industry",
}
SECTION_WORDS = ("Mô tả", "Yêu Cầu", "Công việc")
DEGREE_LABEL = "Bằng cấp:"

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Outline(HTMLParser):
    """Collects (path of (tag, classes), text) for every piece of visible text."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...], int]] = []
        self.texts: list[tuple[tuple, str]] = []
        self.count = 0

    def handle_starttag(self, tag, attrs):
        if tag in _VOID:
            return
        self.count += 1
        self.stack.append((tag, tuple((dict(attrs).get("class") or "").split()), self.count))

    def handle_endtag(self, tag):
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                return

    def handle_data(self, data):
        if data.strip() and not any(t in ("script", "style") for t, _, _ in self.stack):
            self.texts.append((tuple(self.stack), data.strip()))


def _blocks(texts, tag, css=None):
    """Texts grouped by enclosing element, in page order: [(element id, [texts])]."""
    found: dict[int, list] = {}
    for path, text in texts:
        for name, classes, ident in path:
            if name == tag and (css is None or css in classes):
                found.setdefault(ident, []).append((path, text))
    return list(found.values())


def _joined(block, sep=" "):
    return sep.join(" ".join(t.split()) for _, t in block)


def _first(texts, *choices):
    for tag, css in choices:
        blocks = _blocks(texts, tag, css)
        if blocks:
            return _joined(blocks[0])
    return None


def posting_fields(html: str, labels: Mapping[str, str] = FIELD_LABELS) -> dict:
    """Fields of one saved posting page; a field that is not found is None."""
    page = _Outline()
    page.feed(html or "")
    page.close()
    texts = page.texts
    out = dict.fromkeys(("title", "company", "location", "education", "job_description", *labels.values()))
    out["title"] = _first(texts, ("h1", "title"), ("h1", None), ("title", None))
    out["company"] = _first(texts, ("a", "company"), ("a", "job-company-name"), ("a", "name"))
    out["location"] = _first(texts, ("div", "info-place-detail"), ("div", "map"))
    for tag in ("li", "tr"):
        for block in _blocks(texts, tag):
            head, *rest = block
            for label, field in labels.items():
                if label in head[1] and rest and out[field] is None:
                    out[field] = _joined(rest)
            if DEGREE_LABEL in _joined(block) and out["education"] is None:
                out["education"] = _joined(block).split(DEGREE_LABEL, 1)[1].strip() or None
    lines = []
    for block in _blocks(texts, "div", "detail-row"):
        title = [t for p, t in block if p[-1][0] in ("h2", "h3")]
        if title and any(w in title[0] for w in SECTION_WORDS):
            lines.append(f"\n{title[0]}:")
            lines += [t for p, t in block if any(n in ("p", "li") for n, _, _ in p)]
    out["job_description"] = "\n".join(lines) if lines else None
    tags = _blocks(texts, "div", "job-tags")
    out["skills"] = [t for p, t in tags[0] if any(n == "a" for n, _, _ in p)] if tags else []
    out["industries"] = [v.strip() for v in out["industry"].split(",")] if out.get("industry") else []
    return out


PAGE_FIELDS = (
    "title", "company", "location", "salary", "experience", "level", "expired_date", "work_form", "education", "job_description"
)


def extract_postings(pages: DataFrame, key: str = "page_id", html: str = "html", labels: Mapping[str, str] | None = None) -> DataFrame:
    """Posting fields of every page; only the page id and html enter the Arrow batches."""
    kind = pages.schema[key].dataType.simpleString()
    texts = ", ".join(f"{c} string" for c in PAGE_FIELDS)
    table = dict(labels or FIELD_LABELS)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [posting_fields(h, table) for h in batch[html]]
            frame = pd.DataFrame({c: [r.get(c) for r in rows] for c in (*PAGE_FIELDS, "industries", "skills")})
            frame.insert(0, key, batch[key].to_numpy())
            yield frame

    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, {texts}, industries array<string>, skills array<string>")


def page_field(html: Column, pattern: str) -> Column:
    """A simple field by regular expression, with tags removed and spaces collapsed."""
    raw = F.regexp_extract(html, pattern, 1)
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(raw, "<[^>]*>", " "), r"\s+", " ")), F.lit(""))


PAYLOAD_SCHEMA = (
    "jobTitle string, prettySalary string, workingLocations array<struct<address: string>>, yearsOfExperience string, "
    "expiredOn string, companyName string, jobDescription string, jobRequirement string, jobLevelVI string, "
    "highestDegreeId bigint, numberOfRecruits bigint, typeWorkingId bigint, skills array<struct<skillName: string>>, "
    "jobUrl string, industriesV3 array<struct<industryV3NameVI: string>>"
)


def flatten_payload(df: DataFrame, payload: str, degrees: DataFrame, work_types: DataFrame, category: str = "category") -> DataFrame:
    """JSON payloads as posting rows; degree and work-type ids become labels by lookup (id, name)."""
    j = df.select(category, F.from_json(payload, PAYLOAD_SCHEMA).alias("j"))
    empty = F.array().cast("array<string>")
    text = F.concat_ws(
        "\n", F.lit("Mô tả công việc"), F.coalesce("j.jobDescription", F.lit("")), F.lit("Yêu cầu công việc"),
        F.coalesce("j.jobRequirement", F.lit("")),
    )
    flat = j.select(
        F.col("j.jobTitle").alias("title"), F.col("j.prettySalary").alias("salary"),
        F.coalesce(F.col("j.workingLocations.address"), empty).alias("location"),
        F.col("j.yearsOfExperience").alias("experience"), F.col("j.expiredOn").alias("expired_date"),
        F.col("j.companyName").alias("company"), text.alias("job_description"), F.col("j.jobLevelVI").alias("level"),
        F.col("j.numberOfRecruits").alias("quantity"), F.coalesce(F.col("j.skills.skillName"), empty).alias("skills"),
        F.col("j.jobUrl").alias("link"), F.col(category), F.get("j.industriesV3.industryV3NameVI", F.lit(0)).alias("industry"),
        F.col("j.highestDegreeId").alias("_degree"), F.col("j.typeWorkingId").alias("_type"),
    )
    named = flat.join(degrees.select(F.col("id").alias("_degree"), F.col("name").alias("education")), "_degree", "left")
    named = named.join(work_types.select(F.col("id").alias("_type"), F.col("name").alias("work_form")), "_type", "left")
    return named.drop("_degree", "_type")


def same_day_links(links: DataFrame, run_date: Column, order: str = "seq") -> DataFrame:
    """Links posted on the run date, each once, at its first position."""
    today = links.filter(F.col("post_date") == run_date)
    return today.groupBy("link").agg(F.min(order).alias(order))
