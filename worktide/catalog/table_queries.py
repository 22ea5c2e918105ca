"""Deduplication, windows, merges, joins, filters and aggregates over the given tables."""

import uuid

from pyspark.sql import functions as F

from ..functions.text import collapse
from ..operators import aggregates as agg
from ..operators import filters, joins, merge, skills, tables, windows
from ..operators.prefix import ordered_prefix
from ..plans import dims
from ..session import checkpoint_dir, written
from ..sources import files
from .base import query

WORDS_SQL = r"unnest(regexp_split_to_array(trim(regexp_replace(text, '[\s\x0b\x85\p{Z}]+', ' ', 'g')), ' ')) AS w"


def words(t):
    return t.spread("documents", "doc_id").select("doc_id", "lang", F.explode_outer(F.split(collapse(F.col("text")), " ")).alias("w"))


# -- W: deduplication and windows ------------------------------------------------------------------


@query(
    "w01_batch_dedupe_keeping_null_links",
    """WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS link, ts, value FROM events)
    SELECT event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY link ORDER BY ts DESC, event_id) AS rn FROM e)
    WHERE link IS NULL OR rn = 1""",
)
def _(t):
    rows = t.events.withColumn("link", F.when(F.col("event_type") != "error", F.col("user_id")))
    kept = windows.latest_per(rows, ["link"], [F.desc("ts"), F.asc("event_id")], keep_null_keys=True)
    return kept.select("event_id", "value")


@query(
    "w02_u03_change_capture_dedupe",
    """WITH both_sides AS (SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders WHERE o_orderkey % 2 = 0
      UNION ALL SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 <> 0)
    SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS total FROM (SELECT *, row_number() OVER
      (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey, o_totalprice) AS rn FROM both_sides) WHERE rn = 1""",
)
def _(t):
    columns = ["o_custkey", "o_orderkey", "o_orderdate", "o_totalprice"]
    old = t.orders.filter(F.col("o_orderkey") % 2 == 0).select(*columns)
    new = t.orders.filter(F.col("o_orderkey") % 3 != 0).withColumn("o_totalprice", F.col("o_totalprice") + 1).select(*columns)
    order = [F.desc("o_orderdate"), F.asc("o_orderkey"), F.asc("o_totalprice")]
    kept = windows.latest_per(old.unionByName(new), ["o_custkey"], order, keep_null_keys=True)
    return kept.select("o_custkey", "o_orderkey", F.round("o_totalprice", 2).alias("total"))


@query(
    "w03_content_dedupe",
    """SELECT l_orderkey, l_partkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_linestatus, l_quantity, l_discount, l_tax
      ORDER BY l_shipdate DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1""",
)
def _(t):
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]]
    content = ["l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"]
    return windows.dedupe_content(t.lineitem, content, order).select("l_orderkey", "l_partkey", "l_linenumber")


@query(
    "w04_content_dedupe_with_lists",
    """SELECT p_partkey FROM (SELECT p_partkey, row_number() OVER (PARTITION BY p_brand, array_to_string(list_sort(string_split(p_name, ' ')), ' ')
      ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
)
def _(t):
    listed = t.part.withColumn("words", F.reverse(F.split("p_name", " ")))
    return windows.dedupe_content(listed, ["p_brand"], [F.asc("p_partkey")], ["words"], keep_nulls=False).select("p_partkey")


@query(
    "w05_w06_latest_event_per_user",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events) WHERE rn = 1""",
)
def _(t):
    latest = windows.latest_per(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")])
    return latest.select("user_id", "event_id", "event_type", "value")


@query(
    "w07_one_order_per_customer_day",
    """SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority
      ORDER BY o_orderdate DESC, o_orderstatus, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    order = [F.desc_nulls_last("o_orderdate"), F.asc_nulls_last("o_orderstatus"), F.asc_nulls_last("o_orderkey")]
    return windows.latest_per(t.orders, ["o_custkey", "o_orderpriority"], order).select("o_custkey", "o_orderpriority", "o_orderkey")


@query(
    "w09_a13_surrogate_keys",
    """WITH known AS (SELECT s_suppkey AS skill_key FROM supplier), names AS (SELECT DISTINCT w FROM (SELECT """ + WORDS_SQL + """ FROM documents))
    SELECT CAST((SELECT coalesce(max(skill_key), 0) FROM known) + row_number() OVER (ORDER BY md5(w)) AS BIGINT) AS skill_key, md5(w) AS name FROM names""",
)
def _(t):
    names = words(t).select(F.md5("w").alias("name")).distinct()
    return windows.assign_keys(names, t.supplier.withColumnRenamed("s_suppkey", "skill_key"), "skill_key", [F.asc("name")])


@query(
    "w10_running_total",
    """WITH f AS (SELECT l_partkey, count(*) AS freq FROM lineitem GROUP BY 1)
    SELECT l_partkey, CAST(freq AS BIGINT) AS freq, CAST(row_number() OVER w AS BIGINT) AS position, CAST(sum(freq) OVER w AS BIGINT) AS running
    FROM f WINDOW w AS (ORDER BY freq DESC, l_partkey)""",
)
def _(t):
    freq = agg.frequencies(t.lineitem, ["l_partkey"])
    return windows.running_total(freq, [], [F.desc("freq"), F.asc("l_partkey")], F.col("freq"), "running")


@query(
    "w10_running_total_by_group",
    """SELECT event_id, event_type, CAST(row_number() OVER w AS BIGINT) AS position, CAST(sum(CAST(round(value * 100) AS BIGINT)) OVER w AS BIGINT) AS cents
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def _(t):
    cents = F.round(F.col("value") * 100).cast("bigint")
    total = windows.running_total(t.events, ["event_type"], [F.asc("ts"), F.asc("event_id")], cents, "cents")
    return total.select("event_id", "event_type", "position", "cents")


@query(
    "w17_top_orders_per_customer",
    """SELECT o_custkey, o_orderkey, CAST(rn AS INT) AS place FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
      FROM orders) WHERE rn <= 3""",
)
def _(t):
    top = windows.top_k(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, rank="place")
    return top.select("o_custkey", "o_orderkey", "place")


@query(
    "w16_train_rows_per_user",
    """WITH r AS (SELECT DISTINCT o_custkey, o_orderkey FROM orders), n AS (SELECT o_custkey, count(*) AS n FROM r GROUP BY 1)
    SELECT o_custkey, CAST(CASE WHEN n < 2 THEN n ELSE n - ceil(round(n * 0.2, 9)) END AS BIGINT) AS train_rows FROM n""",
)
def _(t):
    train, _test = windows.user_split(t.orders.select("o_custkey", "o_orderkey").distinct(), "o_custkey", "o_orderkey")
    return train.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("train_rows"))


@query("w16_u07_test_rows_seen_in_training")
def _(t):
    pairs = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_partkey").distinct()
    _train, test = windows.user_split(pairs, "o_custkey", "l_partkey")
    return test


@query("w16_split_holds_its_rules", "SELECT true AS disjoint, true AS items_seen, true AS sizes_kept, CAST(count(*) AS BIGINT) AS users FROM (SELECT DISTINCT o_custkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey)")
def _(t):
    pairs = written(t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).select("o_custkey", "l_partkey").distinct())
    train, test = windows.user_split(pairs, "o_custkey", "l_partkey")
    both = train.join(test, ["o_custkey", "l_partkey"], "left_semi").agg((F.count(F.lit(1)) == 0).alias("v")).scalar()
    unseen = test.join(train.select("l_partkey").distinct(), "l_partkey", "left_anti").agg((F.count(F.lit(1)) == 0).alias("v")).scalar()
    sides = train.select("o_custkey", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(test.select("o_custkey", F.lit(0).alias("a"), F.lit(1).alias("b")))
    every = pairs.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    sized = sides.groupBy("o_custkey").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).join(every, "o_custkey")
    held = F.when(F.col("n") < 2, 0).otherwise(F.ceil(F.round(F.col("n") * 0.2, 9)))
    kept = F.bool_and((F.col("a") == F.col("n") - held) & (F.col("b") <= held))
    return sized.agg(both.alias("disjoint"), unseen.alias("items_seen"), kept.alias("sizes_kept"), F.count(F.lit(1)).alias("users"))


# -- T and U: limits, samples and sets ----------------------------------------------------------------


@query("t01_top_customers", "SELECT o_custkey, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 25")
def _(t):
    return agg.value_counts(t.orders, "o_custkey").limit(25)


@query(
    "t02_next_batch",
    """SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders WHERE o_orderstatus <> 'F') WHERE rn = 1 ORDER BY o_orderdate, o_custkey LIMIT 80""",
)
def _(t):
    pending = t.orders.filter(F.col("o_orderstatus") != "F")
    batch = windows.next_batch(
        pending, "o_custkey", [F.asc("o_orderdate"), F.asc("o_custkey")], 80, [F.desc("o_orderdate"), F.desc("o_orderkey")]
    )
    return batch.select("o_custkey", "o_orderkey")


@query("t03_stable_sample")
def _(t):
    return windows.stable_sample(t.documents.select("doc_id", "lang"), "doc_id", 50)


@query("t03_sample_is_stable", "SELECT CAST(50 AS BIGINT) AS n, CAST(50 AS BIGINT) AS from_table, CAST(50 AS BIGINT) AS drawn_again")
def _(t):
    rows = t.documents.select("doc_id", "lang")
    first = windows.stable_sample(rows, "doc_id", 50)
    again = windows.stable_sample(rows.repartition(7, "lang"), "doc_id", 50)
    count = lambda df: df.agg(F.count(F.lit(1)).alias("v")).scalar()
    return first.agg(F.count_distinct("doc_id").alias("n")).select("n", count(first.join(rows, ["doc_id", "lang"])).alias("from_table"), count(first.join(again, "doc_id")).alias("drawn_again"))


@query("t04_d04_sorted_platforms", "SELECT sha256(p_brand) AS platform_key, p_brand AS platform FROM (SELECT DISTINCT p_brand FROM part)")
def _(t):
    return dims.dim_from_values(t.part, "p_brand", "platform", "platform_key").orderBy("platform")


@query(
    "u01_union_distinct",
    """SELECT name FROM (SELECT p_brand AS name FROM part UNION SELECT p_type FROM part UNION SELECT c_mktsegment FROM customer UNION SELECT 'Tất cả')""",
)
def _(t):
    frames = [t.part.select(F.col("p_brand").alias("name")), t.part.select(F.col("p_type").alias("name")),
              t.customer.select(F.col("c_mktsegment").alias("name"))]
    return dims.union_distinct(frames, ["name"], [("Tất cả",)])


@query(
    "u04_stacked_skill_arrays",
    """SELECT p_partkey, 'tech' AS skill_type, unnest(string_split(p_name, ' ')) AS raw_skill FROM part
    UNION ALL SELECT p_partkey, 'soft', unnest([p_brand, p_type]) FROM part""",
)
def _(t):
    lists = t.part.select("p_partkey", F.split("p_name", " ").alias("a"), F.array("p_brand", "p_type", F.lit(" ")).alias("b"))
    return skills.stack_arrays(lists, ["p_partkey"], {"tech": "a", "soft": "b"})


@query(
    "u05_minus_keys",
    "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)",
)
def _(t):
    gone = t.orders.filter(F.col("o_totalprice") > 480000).withColumnRenamed("o_custkey", "c_custkey")
    return merge.only_new(t.customer, gone, ["c_custkey"]).select("c_custkey", "c_mktsegment")


@query(
    "u07_restrict_to_training_items",
    "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')",
)
def _(t):
    test, train = t.lineitem.filter(F.col("l_returnflag") == "R"), t.lineitem.filter(F.col("l_returnflag") == "A")
    return windows.restrict(test, train, ["l_partkey"]).select("l_partkey", "l_suppkey").distinct()


# -- S: merges on tables ------------------------------------------------------------------------------

_TARGET = "target AS (SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance FROM customer WHERE c_custkey % 3 <> 0)"
_SOURCE = """source AS (SELECT o_custkey AS c_custkey, 'ACTIVE' AS segment, round(max(o_totalprice), 2) AS balance FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1)"""


def _target(t):
    rows = t.customer.filter(F.col("c_custkey") % 3 != 0)
    return rows.select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"))


def _source(t):
    even = t.orders.filter(F.col("o_custkey") % 2 == 0)
    best = even.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.max("o_totalprice"), 2).alias("balance"))
    return best.select("c_custkey", F.lit("ACTIVE").alias("segment"), "balance")


@query(
    "s12_merge_update_all",
    f"""WITH {_TARGET}, {_SOURCE} SELECT c_custkey, coalesce(s.segment, t.segment) AS segment, coalesce(s.balance, t.balance) AS balance
    FROM target t FULL JOIN source s USING (c_custkey)""",
)
def _(t):
    return merge.merge_upsert(_target(t), _source(t), ["c_custkey"])


@query(
    "s12_merge_update_some",
    f"""WITH {_TARGET}, {_SOURCE} SELECT c_custkey, coalesce(t.segment, s.segment) AS segment, coalesce(s.balance, t.balance) AS balance
    FROM target t FULL JOIN source s USING (c_custkey)""",
)
def _(t):
    return merge.merge_upsert(_target(t), _source(t), ["c_custkey"], update=["balance"])


@query(
    "s11_insert_only_new",
    f"""WITH {_TARGET}, {_SOURCE} SELECT * FROM target UNION ALL SELECT * FROM source WHERE c_custkey NOT IN (SELECT c_custkey FROM target)""",
)
def _(t):
    return merge.insert_new(_target(t), _source(t), ["c_custkey"])


@query(
    "s13_replace_by_key",
    f"""WITH {_TARGET}, {_SOURCE} SELECT * FROM target WHERE c_custkey NOT IN (SELECT c_custkey FROM source) UNION ALL SELECT * FROM source""",
)
def _(t):
    return merge.replace_by_key(_target(t), _source(t), ["c_custkey"])


@query(
    "s14_flag_processed",
    f"""WITH {_TARGET}, {_SOURCE} SELECT c_custkey, CASE WHEN c_custkey IN (SELECT c_custkey FROM source) THEN 'done' ELSE segment END AS segment, balance FROM target""",
)
def _(t):
    return merge.flag_rows(_target(t), _source(t), ["c_custkey"], "segment", F.lit("done"))


@query(
    "s05_s06_file_queue_transitions",
    """WITH q AS (SELECT 'bronze/' || event_id || '.parquet' AS file_path, CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'processing' ELSE 'pending' END AS status, value FROM events),
    moved AS (SELECT CASE WHEN status = 'pending' AND value > 5 THEN 'processing' ELSE status END AS status FROM q)
    SELECT status, CAST(count(*) AS BIGINT) AS n FROM moved GROUP BY 1""",
)
def _(t):
    from ..sources.files import advance_queue

    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "processing").otherwise("pending")
    path = F.concat(F.lit("bronze/"), "event_id", F.lit(".parquet"))
    now = F.current_timestamp()
    queue = t.events.select(path.alias("file_path"), F.lit("p").alias("platform"), status.alias("status"), now.alias("created_at"), now.alias("updated_at"))
    due = t.events.filter(F.col("value") > 5).select(path.alias("file_path"))
    return advance_queue(queue, due, "processing", guard="pending").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("s06_pending_count", "SELECT CAST(count(*) AS BIGINT) AS pending FROM orders WHERE o_orderstatus = 'P'")
def _(t):
    from ..sources.files import pending_count

    return pending_count(t.orders.select(F.when(F.col("o_orderstatus") == "P", "pending").otherwise("processed").alias("status")))


@query(
    "s15_declared_schema",
    "SELECT CAST(s_suppkey AS INT) AS s_suppkey, s_name, CAST(NULL AS VARCHAR) AS note FROM supplier",
)
def _(t):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("s_suppkey int, s_name string, note string")
    return merge.conform_to(t.supplier.select("s_name", F.col("s_suppkey").cast("int").alias("s_suppkey"), "s_acctbal"), schema)


@query(
    "s17_flattened_arrays",
    "SELECT p_partkey, replace(p_name, ' ', '|') AS skills, '' AS nothing FROM part",
)
def _(t):
    from ..sources.files import flatten_arrays

    lists = t.part.select("p_partkey", F.split("p_name", " ").alias("skills"), F.lit(None).cast("array<string>").alias("nothing"))
    return flatten_arrays(lists, ["skills", "nothing"])


@query(
    "s22_expired_versions",
    """WITH v AS (SELECT o_custkey, o_orderkey, o_orderdate, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    SELECT o_custkey, o_orderkey AS version FROM v WHERE rn > 3 AND o_orderdate < TIMESTAMP '1999-01-08' - INTERVAL 7 DAY""",
)
def _(t):
    log = t.orders.select("o_custkey", F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("committed_at"))
    old = merge.expired_versions(log, F.lit("1999-01-08 00:00:00").cast("timestamp_ntz"), keep=3, max_age_days=7, by=["o_custkey"])
    return old.select("o_custkey", "version")


@query(
    "s25_same_day_links",
    """SELECT user_id AS link, min(event_id) AS seq FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' GROUP BY 1""",
)
def _(t):
    from ..sources.pages import same_day_links

    links = t.events.select(F.col("user_id").alias("link"), F.col("event_id").alias("seq"), F.to_date("ts").alias("post_date"))
    return same_day_links(links, F.lit("2024-01-10").cast("date"))


# -- J: joins -------------------------------------------------------------------------------------------


@query(
    "j01_j02_j06_star_lookup",
    """SELECT r_name AS region, n_name AS nation, p_brand AS brand, CAST(count(*) AS BIGINT) AS lines, round(sum(l_quantity), 2) AS quantity
    FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = l_partkey GROUP BY 1, 2, 3""",
)
def _(t):
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity")
    joined = joins.star_lookup(lines, [
        (t.orders, "l_orderkey", "o_orderkey", "o_custkey"), (t.customer, "o_custkey", "c_custkey", "c_nationkey"),
        (t.part, "l_partkey", "p_partkey", "p_brand"),
    ])
    # quantities are summed per key before the short dimensions are named
    small = joined.groupBy("c_nationkey", "p_brand").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    named = small.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return named.groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("p_brand").alias("brand")).agg(
        F.sum("lines").alias("lines"), F.round(F.sum("quantity"), 2).alias("quantity")
    )


@query("j03_j12_orphans", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(t):
    parents = t.orders.filter(F.col("o_orderstatus") == "F").withColumnRenamed("o_custkey", "c_custkey")
    return joins.orphans(t.customer.select("c_custkey"), parents, ["c_custkey"])


@query(
    "j05_j07_d11_demographics",
    """WITH pairs AS (SELECT b.p_brand AS sex, y.p_type AS age_group FROM (SELECT DISTINCT p_brand FROM part) b, (SELECT DISTINCT p_type FROM part) y),
    n AS (SELECT p_brand AS sex, p_type AS age_group, count(*) AS n FROM part GROUP BY 1, 2)
    SELECT sex, age_group, sha256(sex || '||' || age_group) AS demographic_key, CAST(coalesce(n, 0) AS BIGINT) AS parts FROM pairs LEFT JOIN n USING (sex, age_group)""",
)
def _(t):
    labels = t.part.select(F.col("p_brand").alias("sex"), F.col("p_type").alias("age_group"))
    counted = labels.groupBy("sex", "age_group").agg(F.count(F.lit(1)).alias("n"))
    joined = dims.dim_demographic(labels).join(counted, ["sex", "age_group"], "left")
    return joined.select("sex", "age_group", "demographic_key", F.coalesce("n", F.lit(0)).cast("bigint").alias("parts"))


@query(
    "j08_alias_mapping",
    """WITH raw AS (SELECT DISTINCT lower(p_name) AS raw_skill FROM part),
    m AS (SELECT lower(p_name) AS raw_skill, CASE WHEN min(p_partkey) % 4 = 0 THEN '__SKIP__' ELSE min(p_brand) END AS canonical, min(p_type) AS kind FROM part WHERE p_size > 10 GROUP BY 1)
    SELECT raw_skill, coalesce(canonical, raw_skill) AS canonical_skill, coalesce(kind, 'unknown') AS skill_type FROM raw LEFT JOIN m USING (raw_skill)
    WHERE canonical IS NULL OR canonical <> '__SKIP__'""",
)
def _(t):
    raw = t.part.select(F.lower("p_name").alias("raw_skill")).distinct()
    canonical = F.when(F.min("p_partkey") % 4 == 0, skills.SKIP).otherwise(F.min("p_brand"))
    mapping = t.part.filter(F.col("p_size") > 10).groupBy(F.lower("p_name").alias("raw_skill")).agg(
        canonical.alias("canonical_skill"), F.min("p_type").alias("skill_type")
    )
    return joins.map_alias(raw, mapping)


@query(
    "j11_a10_f10_export_frame",
    """WITH sk AS (SELECT l_orderkey, list_sort(list(DISTINCT {'n': p_name, 't': p_type})) AS s FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
    SELECT o_orderkey AS job_key, o_orderstatus AS title_clean, n_name AS category_name, c_mktsegment AS level_name,
      array_to_string(list_transform(s, lambda x: x.n), '|') AS canonical_skills, array_to_string(list_transform(s, lambda x: x.t), '|') AS skill_types
    FROM orders JOIN sk ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
    WHERE length(repeat('x', CAST(o_totalprice / 5000 AS INT))) > 50 AND len(s) >= 3""",
)
def _(t):
    owned = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    facts = owned.select(F.col("o_orderkey").alias("job_key"), F.col("c_nationkey").alias("category_key"), F.col("c_mktsegment").alias("level_key"))
    size = F.rint(F.col("o_totalprice") / 5000).cast("int")
    jobs = t.orders.select(F.col("o_orderkey").alias("job_key"), F.col("o_orderstatus").alias("title_clean"), F.repeat(F.lit("x"), size).alias("requirement"))
    categories = t.nation.select(F.col("n_nationkey").alias("category_key"), F.col("n_name").alias("category_name"))
    levels = t.customer.select(F.col("c_mktsegment").alias("level_key"), F.col("c_mktsegment").alias("level_name")).distinct()
    named = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_key"), F.col("p_name").alias("canonical_skills"), F.col("p_type").alias("skill_types")
    )
    lists = agg.ordered_lists(named, "job_key", ["canonical_skills", "skill_types"])
    rows = joins.export_frame(facts, jobs, categories, levels, lists)
    return rows.select(
        "job_key", "title_clean", "category_name", "level_name", F.array_join("canonical_skills", "|").alias("canonical_skills"),
        F.array_join("skill_types", "|").alias("skill_types"),
    )


@query("j13_unique_lookup", "SELECT p_name, min(p_brand) AS p_brand FROM part GROUP BY 1")
def _(t):
    return joins.unique_lookup(t.part.select("p_name", "p_brand"), "p_name")


# -- F: filters and listings -----------------------------------------------------------------------------


def listing(t):
    return t.part.select(
        F.col("p_partkey").alias("job_id"), F.initcap("p_name").alias("title"), F.col("p_type").alias("description"),
        F.col("p_brand").alias("location"), F.col("p_retailprice").alias("salary_max"), F.split("p_name", " ").alias("skills"),
    )


@query(
    "f05_filter_listing",
    """SELECT p_partkey AS job_id FROM part WHERE (contains(lower(p_name), 'ri') OR contains(lower(p_type), 'ri')) AND p_retailprice >= 905
      AND (list_contains(string_split(p_name, ' '), 'ring') OR list_contains(string_split(p_name, ' '), 'red') OR list_contains(string_split(p_name, ' '), 'small'))""",
)
def _(t):
    return filters.filter_listing(listing(t), keyword="RI", min_salary=905, skills=["ring", "red", "small"]).select("job_id")


@query("f05_filter_listing_by_place", "SELECT p_partkey AS job_id FROM part WHERE p_brand = 'Brand#11'")
def _(t):
    return filters.filter_listing(listing(t), location="Brand#11").select("job_id")


@query(
    "f06_page_of_listing",
    """SELECT p_partkey AS job_id, (SELECT CAST(ceil(count(*) / 20.0) AS BIGINT) FROM part) AS total_pages FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20 OFFSET 40""",
)
def _(t):
    page = filters.paginate(listing(t), [F.desc("salary_max"), F.asc("job_id")], page=3, size=20)
    return page.select("job_id", "total_pages")


@query(
    "f07_f08_active_listing",
    """WITH v AS (SELECT *, CAST(date_trunc('year', o_orderdate) AS DATE) AS snapshot_at, CAST(o_orderdate AS DATE) AS expired_date FROM orders)
    SELECT o_orderkey AS job_id, o_orderpriority || ' at ' || o_orderstatus AS title, round(o_totalprice / 1000000, 9) AS salary_min,
      'Level: x | Experience: 1-N/A years | Work form: full | Quantity: 2' AS description FROM v
    WHERE snapshot_at = (SELECT max(snapshot_at) FROM v) AND expired_date >= (SELECT max(expired_date) - 30 FROM v)""",
)
def _(t):
    view = t.orders.select(
        F.col("o_orderkey").alias("job_key"), F.col("o_orderpriority").alias("category_name"), F.col("o_orderstatus").alias("company_name"),
        F.lit("here").alias("location_name"), F.col("o_totalprice").alias("min_salary_vnd"), F.col("o_totalprice").alias("max_salary_vnd"),
        F.lit("none").alias("experience_type_name"), F.lit("x").alias("education_name"), F.lit(1).alias("min_years"),
        F.lit(None).cast("int").alias("max_years"), F.lit("full").alias("work_form_name"), F.lit(2).alias("quantity_normalized"),
        F.to_date(F.date_trunc("year", "o_orderdate")).alias("snapshot_at"), F.to_date("o_orderdate").alias("expired_date"),
    )
    today = t.orders.agg(F.date_sub(F.max(F.to_date("o_orderdate")), 30).alias("d")).scalar()
    rows = filters.listing_view(filters.active_snapshot(view, today))
    return rows.select("job_id", "title", F.round("salary_min", 9).alias("salary_min"), "description")


@query(
    "f01_f03_f09_project_filter_convert",
    "SELECT c_custkey, c_mktsegment, round(c_acctbal / 25.0, 6) AS usd FROM customer WHERE trim(replace(c_mktsegment, 'BUILDING', '')) <> ''",
)
def _(t):
    blanked = t.customer.withColumn("c_mktsegment", F.replace("c_mktsegment", F.lit("BUILDING"), F.lit(" ")))
    rows = filters.non_blank(joins.project(blanked, ["c_custkey", "missing", "c_mktsegment", "c_acctbal"]), "c_mktsegment")
    return rows.select("c_custkey", "c_mktsegment", F.round(filters.convert(F.col("c_acctbal"), 25.0), 6).alias("usd"))


@query(
    "f04_business_defaults",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN 'VND' ELSE l_linestatus END AS currency,
      CASE WHEN l_tax > 0.04 THEN l_returnflag ELSE '0' END AS education, CASE WHEN l_discount > 0.05 THEN l_discount ELSE 0 END AS min_years,
      CASE WHEN l_discount > 0.05 THEN 'kept' ELSE 'none' END AS experience_type, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY ALL""",
)
def _(t):
    rich = F.col("l_discount") > 0.05
    raw = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "N", "negotiable").otherwise("range").alias("salary_type"),
        F.col("l_linestatus").alias("currency"), F.when(F.col("l_tax") > 0.04, F.col("l_returnflag")).alias("education_standard"),
        F.when(rich, F.col("l_discount")).otherwise(F.lit(float("nan"))).alias("min_years"), F.lit(None).cast("double").alias("max_years"),
        F.when(rich, "kept").alias("experience_type"),
    )
    done = filters.apply_defaults(filters.replace_nan(raw, {"min_years": 0.0, "max_years": 0.0}), impute_zero=True)
    return done.groupBy(
        "l_orderkey", "l_linenumber", "currency", F.col("education_standard").alias("education"), "min_years", "experience_type"
    ).agg(F.count(F.lit(1)).alias("n"))


# -- A: aggregates -----------------------------------------------------------------------------------------


def _skills_of_orders(t):
    named = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    return named.select(
        F.col("p_brand").alias("category_key"), F.explode(F.split("p_name", " ")).alias("skill_key"), F.col("l_orderkey").alias("job_key")
    )


_MAPPED = """mapped AS (SELECT p_brand AS category_key, unnest(string_split(p_name, ' ')) AS skill_key, l_orderkey AS job_key
  FROM lineitem JOIN part ON p_partkey = l_partkey)"""


@query(
    "a01_skill_demand",
    f"WITH {_MAPPED} SELECT category_key, skill_key, CAST(count(DISTINCT job_key) AS BIGINT) AS job_count FROM mapped GROUP BY 1, 2",
)
def _(t):
    return agg.skill_counts(_skills_of_orders(t))


@query(
    "a02_skill_coverage",
    f"""WITH {_MAPPED}, tot AS (SELECT category_key, count(DISTINCT job_key) AS total FROM mapped GROUP BY 1)
    SELECT category_key, skill_key, CAST(count(DISTINCT job_key) AS BIGINT) AS job_count, round(count(DISTINCT job_key) / any_value(total), 9) AS coverage
    FROM mapped JOIN tot USING (category_key) GROUP BY 1, 2""",
)
def _(t):
    return agg.skill_coverage(_skills_of_orders(t)).withColumn("coverage", F.round("coverage", 9))


@query(
    "a03_word_frequency",
    f"""SELECT md5(lower(w)) AS word, lang, CAST(count(*) AS BIGINT) AS freq, min(md5(w)) AS form FROM (SELECT lang, {WORDS_SQL} FROM documents) GROUP BY ALL""",
)
def _(t):
    rows = words(t).select(F.md5(F.lower("w")).alias("word"), "lang", F.md5("w").alias("form"))
    return agg.frequencies(rows, ["word", "lang"], "form")


@query(
    "a04_cumulative_cover",
    f"""WITH f AS (SELECT lower(w) AS word, count(*) AS freq FROM (SELECT {WORDS_SQL} FROM documents) GROUP BY 1),
    r AS (SELECT sum(freq) OVER (ORDER BY freq DESC, word) AS cum, sum(freq) OVER () AS total FROM f)
    SELECT CAST(percent AS INT) AS percent, CAST(count(*) FILTER (cum * 100 <= percent * total) AS BIGINT) AS items_within FROM r, (SELECT unnest([50, 70, 80, 90, 95]) AS percent) GROUP BY 1""",
)
def _(t):
    freq = agg.frequencies(words(t).select(F.lower("w").alias("word")), ["word"])
    return agg.cumulative_cover(freq, [50, 70, 80, 90, 95])


@query(
    "a05_top_distinct",
    f"""SELECT md5(w) AS skill, CAST(count(DISTINCT doc_id) AS BIGINT) AS n_jobs FROM (SELECT doc_id, {WORDS_SQL} FROM documents) GROUP BY 1 ORDER BY n_jobs DESC, skill LIMIT 500""",
)
def _(t):
    return agg.top_distinct(words(t).select("doc_id", F.md5("w").alias("skill")), "skill", "doc_id", 500)


@query(
    "a06_representative_form",
    f"""SELECT grp, form FROM (SELECT md5(lower(w)) AS grp, md5(w) AS form, row_number() OVER (PARTITION BY lower(w) ORDER BY count(*) DESC, md5(w)) AS rn
      FROM (SELECT {WORDS_SQL} FROM documents) GROUP BY lower(w), w) WHERE rn = 1""",
)
def _(t):
    rows = words(t).select(F.md5(F.lower("w")).alias("grp"), F.md5("w").alias("form"))
    return agg.representative(rows, "grp", "form").select("grp", "form")


@query(
    "a07_a08_monthly_pivot",
    """WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderstatus AS code, avg(CAST(round(o_totalprice * 100) AS BIGINT)) AS v FROM orders GROUP BY 1, 2)
    SELECT period, coalesce(max(v) FILTER (code = 'F'), -1) AS F, coalesce(max(v) FILTER (code = 'O'), -1) AS O, coalesce(max(v) FILTER (code = 'P'), -1) AS P FROM m GROUP BY 1""",
)
def _(t):
    rows = t.orders.select(F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("o_orderstatus").alias("code"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("v"))
    mean = agg.mean_by(rows, ["period", "code"], "v")
    return agg.to_wide(mean, ["period"], "code", ["F", "O", "P"], "v").na.fill(-1.0)


@query("a09_strongest_interaction", "SELECT user_id, event_type, max(value) AS value FROM events GROUP BY 1, 2")
def _(t):
    return agg.strongest(t.events, "user_id", "event_type", "value")


@query(
    "a11_median_with_fallback",
    """SELECT p_brand, coalesce(median(CASE WHEN p_size > 20 THEN p_retailprice END), (SELECT median(p_retailprice) FROM part WHERE p_size > 20)) AS low,
      CAST(25000000 AS DOUBLE) AS high FROM part GROUP BY 1""",
)
def _(t):
    rows = t.part.select("p_brand", F.when(F.col("p_size") > 20, F.col("p_retailprice")).alias("low"), F.lit(None).cast("double").alias("high"))
    return agg.median_with_fallback(rows, "p_brand", ["low", "high"], {"low": 10_000_000, "high": 25_000_000})


@query("a12_distinct", "SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def _(t):
    return agg.distinct_on(t.lineitem, ["l_partkey", "l_suppkey"])


@query("a13_max_key", "SELECT coalesce(max(p_partkey), 0) AS max_key FROM part")
def _(t):
    return agg.max_key(t.part, "p_partkey")


@query(
    "a14_profile",
    """WITH d AS (SELECT CASE WHEN quality = 1 THEN text WHEN toxic = 1 THEN ' ' END AS body, lang FROM documents LEFT JOIN labels USING (doc_id))
    SELECT c AS "column", CAST(count(*) AS BIGINT) AS rows, CAST(count(*) - count(v) AS BIGINT) AS nulls, CAST(count(*) FILTER (trim(v) = '') AS BIGINT) AS empty,
      CAST(count(*) FILTER (trim(v) <> '') AS BIGINT) AS filled, round((count(*) - count(v)) / count(*), 9) AS null_rate
    FROM (SELECT 'body' AS c, body AS v FROM d UNION ALL SELECT 'lang', lang FROM d) GROUP BY 1""",
)
def _(t):
    body = F.when(F.col("quality") == 1, F.col("text")).when(F.col("toxic") == 1, " ")
    rows = t.documents.join(t.labels, "doc_id", "left").select(body.alias("body"), "lang")
    return agg.profile(rows, ["body", "lang"]).withColumn("null_rate", F.round("null_rate", 9))


@query("a15_value_counts", "SELECT source, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY 1")
def _(t):
    return agg.value_counts(t.documents, "source")


_INTERACTIONS = """users AS (SELECT c_custkey AS user_id, 'Brand#' || (c_nationkey + 1) AS cat, [lower(c_mktsegment), 'red', 'small', 'ring'] AS mine FROM customer),
  f AS (SELECT o_orderstatus AS event_type, cat, p_brand, len(list_intersect(mine, string_split(p_name, ' '))) AS overlap FROM lineitem
    JOIN orders ON o_orderkey = l_orderkey LEFT JOIN users ON user_id = o_custkey LEFT JOIN part ON p_partkey = l_partkey)"""


def _interactions(t):
    who = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    inter = who.select(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("job_key"), F.col("o_orderstatus").alias("event_type"))
    users = t.customer.select(
        F.col("c_custkey").alias("user_id"), F.concat(F.lit("Brand#"), F.col("c_nationkey") + 1).alias("preferred_category"),
        F.array("c_mktsegment", F.lit("red"), F.lit(" Small"), F.lit("ring")).alias("skills"),
    )
    jobs = t.part.select(F.col("p_partkey").alias("job_key"), F.col("p_brand").alias("category_name_final"), F.split("p_name", " ").alias("skills_all"))
    return joins.interaction_frame(inter, users, jobs)


@query(
    "a16_j14_interaction_quality",
    f"""WITH {_INTERACTIONS} SELECT coalesce(event_type, '(all)') AS event_type, CAST(count(*) AS BIGINT) AS n, round(avg(coalesce(CAST(cat = p_brand AS INT), 0)), 9) AS same_category_rate,
      round(avg(CAST(overlap > 0 AS INT)), 9) AS has_skill_overlap_rate, round(avg(overlap), 9) AS avg_skill_overlap FROM f GROUP BY ROLLUP (event_type)""",
)
def _(t):
    q = agg.interaction_quality(_interactions(t))
    return q.select("event_type", "n", *[F.round(c, 9).alias(c) for c in ("same_category_rate", "has_skill_overlap_rate", "avg_skill_overlap")])


@query(
    "a17_drop_rare_singletons",
    r"""WITH s AS (SELECT doc_id, i AS pos, w AS raw, lower(replace(replace(strip_accents(w), 'đ', 'd'), 'Đ', 'D')) AS norm FROM
      (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, regexp_split_to_array(trim(regexp_replace(text, '[\s\x0b\x85\p{Z}]+', ' ', 'g')), ' ') AS ws FROM documents)) WHERE w <> ''),
    n AS (SELECT norm, count(*) AS seen FROM s GROUP BY 1),
    k AS (SELECT doc_id, norm, min(pos) AS pos, arg_min(raw, pos) AS raw FROM s JOIN n USING (norm) WHERE regexp_matches(raw, '[0-9]') OR (regexp_matches(raw, '\p{Lu}') AND NOT regexp_matches(raw, '\p{Ll}'))
      OR (regexp_matches(raw, '^\p{Lu}[^\p{Lu}]*\p{Ll}[^\p{Lu}]*$') AND length(raw) >= 3) OR seen >= 2 GROUP BY 1, 2)
    SELECT doc_id, CAST(count(k.pos) AS BIGINT) AS kept, md5(coalesce(string_agg(k.raw, ' ' ORDER BY k.pos), '')) AS digest FROM (SELECT doc_id FROM documents) LEFT JOIN k USING (doc_id) GROUP BY 1""",
)
def _(t):
    lists = t.spread("documents", "doc_id").select("doc_id", F.split(collapse(F.col("text")), " ").alias("skills"))
    cleaned = agg.drop_rare_singletons(lists, "doc_id", "skills", 2)
    return cleaned.select("doc_id", F.size("skills").cast("bigint").alias("kept"), F.md5(F.array_join("skills", " ")).alias("digest"))


# -- S: loads that may be repeated, and a rewrite that is verified ---------------------------------------------


def _root(t, name: str) -> str:
    return f"{checkpoint_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "s10_repeated_partition_loads",
    """SELECT CAST(year(o_orderdate) AS INT) AS year, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(sum(CASE WHEN year(o_orderdate) % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS corrected FROM orders GROUP BY 1""",
)
def _(t):
    """Orders by year; the even years are written again with a mark, twice, and the others stay as they were."""
    path = _root(t, "loads")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.lit(0).alias("mark"))
    tables.overwrite_partitions(rows, "year", path)
    for _ in range(2):
        tables.overwrite_partitions(rows.filter("year % 2 = 0").withColumn("mark", F.lit(1)), "year", path)
    return t.spark.read.parquet(path).groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"), F.sum("mark").alias("corrected")
    )


@query(
    "s16_static_load_once",
    """SELECT n_nationkey AS nation_no, n_name, CAST(count(s_suppkey) AS BIGINT) AS suppliers FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY 1, 2""",
)
def _(t):
    """A dimension that is loaded where it is missing: what a later load brings does not change it."""
    path = _root(t, "static")
    nations = t.nation.select(F.col("n_nationkey").alias("nation_no"), "n_name")
    tables.load_once(nations, path)
    tables.load_once(nations.withColumn("n_name", F.lit("late")).union(nations), path)
    loaded = t.spark.read.parquet(path)
    return loaded.join(t.supplier, F.col("s_nationkey") == F.col("nation_no"), "left").groupBy("nation_no", "n_name").agg(F.count("s_suppkey").alias("suppliers"))


@query(
    "s18_rewritten_and_verified",
    """WITH n AS (SELECT count(*) AS n FROM orders), c AS (SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice', 'o_orderpriority', '*']) AS column_name)
    SELECT 'rewritten' AS copy, column_name, n AS rows_before, n AS rows_after, true AS ok FROM c, n
    UNION ALL SELECT 'changed', column_name, n, n, column_name NOT IN ('o_totalprice', '*') FROM c, n
    UNION ALL SELECT 'shortened', column_name, n, n - 1, false FROM c, n
    UNION ALL SELECT 'swapped', column_name, n, n, column_name <> '*' FROM c, n""",
)
def _(t):
    """Orders rewritten as one file, and three spoiled copies: one cell changed, one row lost, a column's values dealt to other rows."""
    root = _root(t, "rewrite")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]
    t.orders.select(*columns).write.parquet(f"{root}/a")
    before = t.spark.read.parquet(f"{root}/a")
    last = before.agg(F.max("o_orderkey")).scalar()
    one = F.col("o_orderkey") == last
    other = before.select((-F.col("o_orderkey")).alias("_k"), "o_custkey")
    turned = ordered_prefix(before.drop("o_custkey"), [], [F.asc("o_orderkey")], rank="_n").join(
        ordered_prefix(other, [], [F.asc("_k")], rank="_n"), "_n"
    )
    copies = {
        "changed": before.withColumn("o_totalprice", F.when(one, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))),
        "shortened": before.filter(~one), "swapped": turned.select(*columns),
    }
    found = files.rewrite_and_verify(t.spark, f"{root}/a", f"{root}/b", files=1).withColumn("copy", F.lit("rewritten"))
    for name, copy in copies.items():
        found = found.unionByName(files.compare_content(before, copy).withColumn("copy", F.lit(name)))
    return found.select("copy", F.col("column").alias("column_name"), "rows_before", "rows_after", "ok")
