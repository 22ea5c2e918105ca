import json

import pytest
from pyspark.sql import functions as F

from worktide.operators import filters, joins
from worktide.operators.tables import AppendTable, BucketTable
from worktide.plans import dims, gold, macro, silver
from worktide.sources import files, pages
from worktide.streaming import increments


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_period_tables_in_utf16(spark, tmp_path):
    one = tmp_path / "gdp.csv"
    one.write_text('Chỉ tiêu\tQ1 2024\tQ2 2024\t\n"Đơn vị"\tTỷ\tTỷ\t\n"Nông nghiệp"\t1,234.5\t-\t\n', encoding="utf-16")
    long = files.to_long(files.read_period_tsv(spark, str(one)), unit_rows=["Đơn vị"])
    assert rows(long, "quarter") == [("Nông nghiệp", 1, None, 2024, 1234.5), ("Nông nghiệp", 2, None, 2024, None)]
    two = tmp_path / "fdi.csv"
    header = "\t".join(["Kỳ"] + ["FDI"] * 8) + "\n" + "\t".join(["Kỳ"] + ["a", "b"] * 4) + "\n"
    two.write_text(header + "T3 2024\t" + "\t".join(['"1,000"', "-", "2", "3", "4", "5", "6", "7"]) + "\n", encoding="utf-16")
    fdi = files.fdi_long(files.read_period_tsv(spark, str(two), header_rows=2, names=files.FDI_NAMES))
    assert rows(fdi, "month") == [(1, 3, 2024, 1000.0, None, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0)]


def test_indicator_json(spark, tmp_path):
    path = tmp_path / "x.json"
    record = {"sex.label": "Total", "classif1.label": "Age (Aggregate bands): Total", "time": "2023", "obs_value": 2.5}
    other = {**record, "classif1.label": "Age (Youth): 15-24"}
    path.write_text(json.dumps([record, other, {**record, "obs_value": None}]))
    assert rows(files.normalize_labour(files.read_indicator_json(spark, str(path))), "year") == [("Total", "Total", 2023, 2.5)]


def test_drifting_files_queue_and_scan(spark, tmp_path):
    a, b, c, d = (str(tmp_path / n) for n in ("a.parquet", "b.parquet", "c.parquet", "d.parquet"))
    spark.createDataFrame([("x", ["p", "q"], ["s"])], "title string, location array<string>, skills array<string>").write.parquet(a)
    spark.createDataFrame([("y", "r", "t", 3)], "title string, location string, skills string, quantity bigint").write.parquet(b)
    spark.createDataFrame([], "title string").write.parquet(c)
    (tmp_path / "d.parquet").write_bytes(b"not parquet")
    good, bad = files.quarantine(spark, [(a, "m"), (b, "n"), (c, "m"), (d, "m")])
    assert [g[0] for g in good] == [a, b] and [x[0] for x in bad] == [c, d] and bad[0][2] == "empty"
    batch = files.load_batch(spark, good)
    got = rows(batch.select("title", "location", "skills", "quantity", "platform"), "title")
    assert got == [("x", "p, q", ["s"], "1", "m"), ("y", "r", ["t"], "3", "n")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.parquet").write_bytes(b"nope")
    (tmp_path / "in" / "zero.parquet").write_bytes(b"")
    queue = files.discover_files(spark, str(tmp_path / "in" / "*.parquet"), "m")
    assert files.pending_count(queue).first()[0] == 2
    done = files.advance_queue(queue, queue.filter(F.col("file_path").endswith("bad.parquet")), "failed", guard="pending")
    assert sorted(r.status for r in done.collect()) == ["failed", "pending"]
    scan = {r.path.rsplit("/", 1)[1]: r.status for r in files.scan_files(spark, str(tmp_path / "in" / "*.parquet")).collect()}
    assert scan == {"bad.parquet": "corrupt", "zero.parquet": "empty"}
    assert files.folder_bytes(spark, str(tmp_path / "in" / "*.parquet")) == 4


def test_rewrite_and_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "k int, s array<string>")
    df.repartition(4).write.parquet(str(tmp_path / "p"))
    report = files.rewrite_and_verify(spark, str(tmp_path / "p"), str(tmp_path / "q"), files=1).first()
    assert report.ok and report.rows_before == 2
    files.write_csv(df, str(tmp_path / "c"), ["s"])
    assert rows(spark.read.csv(str(tmp_path / "c"), header=True), "k") == [("1", "a|b"), ("2", None)]


def test_page_fields():
    html = """<html><head><title>t</title><script>var a = '<p>x</p>';</script></head><body>
      <div class="head-left"><h1 class="title">Kế toán &amp; Thuế</h1><a class="employer job-company-name">ABC</a></div>
      <div class="info-place-detail"><span>Hà Nội</span></div>
      <table><tr><td class="name">Lương</td><td class="content"> 10 -  15 triệu</td></tr><tr><td>Kinh nghiệm</td><td>2 năm</td></tr></table>
      <div class="detail-row"><h3 class="detail-title">Mô tả</h3><p>Làm sổ</p><ul><li>Báo cáo</li></ul></div>
      <ul><li>Bằng cấp: Đại học</li></ul><div class="job-tags"><a>Excel</a><br><a>Misa</a></div></body></html>"""
    got = pages.posting_fields(html)
    assert got["title"] == "Kế toán & Thuế" and got["company"] == "ABC" and got["location"] == "Hà Nội"
    assert got["salary"] == "10 - 15 triệu" and got["experience"] == "2 năm" and got["education"] == "Đại học"
    assert got["job_description"] == "\nMô tả:\nLàm sổ\nBáo cáo" and got["skills"] == ["Excel", "Misa"]
    assert pages.posting_fields("")["title"] is None


BRONZE = [
    ("topcv", "u1", "Kế toán-Thuế", "ABC", "Quận 1, Hồ Chí Minh", "10 - 15 triệu", "2 năm", "31/12/2025", "Nhân viên", "Đại học", "1", "Toàn thời gian", ["Excel"], "Kế toán", "Mô tả."),
    ("topcv", "u1", "Kế toán-Thuế", "ABC", "Hà Nam, Hà Nội", "Thoả thuận", None, "2025-11-01", None, None, None, None, None, "Digital", None),
    ("other", None, "Dev", "XYZ", None, "$1000", "Trên 5 năm", "x", "Giám đốc", "Khác", "3", "Khác", ["Go", "Go"], "IT", None),
    ("other", "u2", "  ", "XYZ", None, None, None, None, None, None, None, None, None, None, None),
]
BRONZE_SCHEMA = (
    "platform string, link string, title string, company string, location string, salary string, experience string, expired_date string, level string, "
    "education string, quantity string, work_form string, skills array<string>, category string, job_description string"
)


def test_silver_to_gold_increment(spark, tmp_path):
    bronze = spark.createDataFrame(BRONZE, BRONZE_SCHEMA)
    rows_ = silver.standardize_postings(bronze, F.lit("2025-10-01"))
    assert rows_.schema.simpleString() == spark.createDataFrame([], silver.SILVER_SCHEMA).schema.simpleString()
    got = {(r.platform, r.location_clean): r for r in rows_.collect()}
    assert len(got) == 3  # the blank title goes
    first = got["topcv", "Hồ Chí Minh"]
    assert first.title_clean == "kế toán - thuế" and first.min_salary == 10_000_000 and first.level_standard == "staff"
    tie = got["topcv", "Hà Nam"]  # equal lengths: alphabetical
    assert tie.currency == "VND" and tie.education_standard == "0" and tie.min_years is None
    zero = silver.standardize_postings(bronze, F.lit("2025-10-01"), impute_zero=True).filter("platform = 'topcv' and location_clean = 'Hà Nam'").first()
    assert (zero.min_years, zero.max_years, zero.experience_type) == (0.0, 0.0, "none")

    vocab = spark.createDataFrame([("excel", "tech")], "term string, skill_type string")
    enriched = silver.enrich_skills(rows_.withColumn("requirement", F.lit("Biết Excel tốt")), vocab)
    assert enriched.count() == 3 and all(r.tech_skills == ["Excel"] for r in enriched.collect())

    tables = gold.GoldTables(spark, str(tmp_path))
    mapping = spark.createDataFrame([], "raw_skill string, canonical_skill string, skill_type string")
    batch = gold.pending_batch(enriched, 10)
    for version in ("v1", "v1", "v2"):
        gold.gold_increment(batch, mapping, tables, version)
        # postings without a link are keyed by what describes them
        assert tables.read("fact_jobs").count() == 2 and tables.read("fact_job_skills").count() == 2
        assert tables.read("dim_skill").count() == 1
    assert gold.pending_batch(gold.flag_processed(enriched, batch), 10).count() == 0
    linked = enriched.filter("link IS NOT NULL").select(gold.posting_key().alias("job_key"))
    fact = tables.read("fact_jobs").join(linked, "job_key").first()
    assert fact.processed_time_key == 20251001 and fact.company_key is not None and fact.location_key is not None


def test_literal_dimensions_and_calendar(spark):
    assert dims.literal_dim(spark, "location").count() == 64 and dims.literal_dim(spark, "indicator").count() == 23
    assert dims.literal_dim(spark, "category").select("category_key").distinct().count() == 22
    ranks = {r.level_code: r.level_rank for r in dims.literal_dim(spark, "level").collect()}
    assert ranks["intern"] == 0 and ranks["executive"] == 6
    days = dims.dim_time(spark, "2024-02-28", "2024-03-01").orderBy("time_key").collect()
    assert [d.time_key for d in days] == [20240228, 20240229, 20240301] and days[1].day_name == "Thursday"


def test_quarters_and_labour_keys(spark):
    q = spark.createDataFrame([("x", 2, 2025, 7.5)], "industry string, quarter int, year int, value double")
    assert [r.time_key for r in macro.quarter_to_months(q).orderBy("time_key").collect()] == [20250401, 20250501, 20250601]
    wage = spark.createDataFrame([(2024, 5.0)], "year int, value double")
    demo = dims.dim_demographic(spark.createDataFrame([("Total", "Total"), ("Male", "15+")], "sex string, age_group string"))
    fact = macro.fact_labour({"MIN_WAGE": wage}, demo, dims.literal_dim(spark, "indicator")).first()
    assert fact.time_key == 20240101 and fact.demographic_key is not None and demo.count() == 4


def test_longest_match_compat_partition(spark):
    posts = spark.createDataFrame([(1, "t", "Quận 1 ha noi"), (2, "t", "Quận 1 ha noi")], "id int, title string, place string")
    words = spark.createDataFrame([("ha noi", "Hà Nội"), ("noi", "Nội")], "w string, v string")
    both = joins.match_longest(posts, ["id"], "place", words, "w", "v", "Khác", "p")
    assert rows(both.select("id", "p"), "id") == [(1, "Hà Nội"), (2, "Hà Nội")]
    odd = spark.createDataFrame([(None, "x ha noi"), (None, "noi"), (1, "noi"), (1, "x ha noi"), (2, None)], "id int, place string")
    assert sorted(r.p for r in joins.match_longest(odd, ["id"], "place", words, "w", "v", "Khác", "p").collect()) == ["Hà Nội", "Hà Nội", "Khác", "Nội", "Nội"]
    one = joins.match_longest(posts, ["id"], "place", words, "w", "v", "Khác", "p", compat_partition=["title", "place"])
    assert one.count() == 1


def test_pages_of_an_empty_listing(spark):
    empty = spark.createDataFrame([], "id int")
    assert filters.paginate(empty, [F.asc("id")], 1, 5).count() == 0


def test_stream_equals_batch(spark, tmp_path):
    for i in range(5):
        spark.createDataFrame([(k, i * 10 + k) for k in range(4)], "k int, v int").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = increments.stream_files(spark, str(tmp_path / "in"), "k int, v int", 2)
    state, order = AppendTable(spark, str(tmp_path / "state")), lambda: [F.desc("v")]
    increments.run_available(stream, increments.latest_state(state, ["k"], order), str(tmp_path / "c1"))
    assert rows(increments.current_state(state, ["k"], order), "k") == [(k, 40 + k) for k in range(4)]
    merged = BucketTable(spark, str(tmp_path / "merged"), ["k"], buckets=8)
    increments.run_available(stream, increments.upsert_into(merged, order), str(tmp_path / "c2"))
    assert rows(merged.read(), "k") == [(k, 40 + k) for k in range(4)]
    # nothing new: a second run adds no batch
    before = state.batches()
    increments.run_available(stream, increments.latest_state(state, ["k"], order), str(tmp_path / "c1"))
    assert state.batches() == before


def test_damage_behind_the_first_row_group_is_found(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    good, bad = str(tmp_path / "good.parquet"), str(tmp_path / "bad.parquet")
    table = pa.table({"title": [f"t{i}" for i in range(3000)], "company": [f"c{i * 7919 % 3000}" for i in range(3000)]})
    for path in (good, bad):
        pq.write_table(table, path, row_group_size=1000)
    last = pq.ParquetFile(bad).metadata.row_group(1).column(1)  # of the second row group, a column that no count reads
    data = bytearray((tmp_path / "bad.parquet").read_bytes())
    start = last.dictionary_page_offset or last.data_page_offset
    data[start:start + last.total_compressed_size] = b"\xff" * last.total_compressed_size
    (tmp_path / "bad.parquet").write_bytes(data)
    scan = {r.path.rsplit("/", 1)[1]: (r.status, r.num_rows) for r in files.scan_files(spark, str(tmp_path / "*.parquet")).collect()}
    assert scan == {"good.parquet": ("ok", 3000), "bad.parquet": ("corrupt", 3000)}
    kept, out = files.quarantine(spark, [(good, "m"), (bad, "n")])
    assert kept == [(good, "m")] and [x[:2] for x in out] == [(bad, "n")]
    assert files.load_batch(spark, kept).count() == 3000


def test_quarantine_names_the_reason(spark, tmp_path):
    with pytest.raises(ValueError, match="no readable file"):
        files.load_batch(spark, [])


def test_large_batches_are_not_ordered_by_one_task_and_finished_versions_not_worked_out_again(spark, tmp_path, monkeypatch):
    bronze = spark.createDataFrame(BRONZE, BRONZE_SCHEMA)
    rows_ = silver.standardize_postings(bronze, F.lit("2025-10-01"))
    copies = [rows_.withColumn("link", F.concat(F.lit(f"l{i % 5}/"), F.col("platform"))).withColumn("processed_date", F.date_add("processed_date", i)) for i in range(7)]
    every = copies[0]
    for more in copies[1:]:
        every = every.unionByName(more)
    want = {n: sorted(map(str, gold.pending_batch(every, n).collect())) for n in (1, 4, 100)}
    monkeypatch.setattr(gold, "IN_ONE_TASK", 0)
    for n, found in want.items():
        batch = gold.pending_batch(every, n)
        assert sorted(map(str, batch.collect())) == found
        assert "Limit 1" not in batch._jdf.queryExecution().executedPlan().toString()

    tables = gold.GoldTables(spark, str(tmp_path))
    mapping = spark.createDataFrame([], "raw_skill string, canonical_skill string, skill_type string")
    gold.gold_increment(gold.pending_batch(every, 100), mapping, tables, "v1")
    names = tables.read("fact_jobs").count(), tables.read("dim_job").count()

    def never(*_, **__):
        raise AssertionError("the version is there")

    monkeypatch.setattr(gold, "latest_per", never)
    gold.gold_increment(every, mapping, tables, "v1")
    assert (tables.read("fact_jobs").count(), tables.read("dim_job").count()) == names
