"""Panels of daily series per event type: filling, differences, scaling, models and errors."""

from pyspark.sql import functions as F

from ..operators import series, windows
from .base import query

PANEL, TIME = ["event_type"], "day"

# Exact cents per day, so that both engines add up the same numbers.
_DAILY = """daily AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS y FROM events GROUP BY 1, 2)"""


def daily(t):
    cents = F.round(F.col("value") * 100).cast("bigint")
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum(cents).cast("double").alias("x"), F.count(F.lit(1)).cast("double").alias("y")
    )


_SCALED = f"""{_DAILY}, z AS (SELECT event_type, day, (x - min(x) OVER w) / nullif(max(x) OVER w - min(x) OVER w, 0) * 2 - 1 AS x,
  (y - min(y) OVER w) / nullif(max(y) OVER w - min(y) OVER w, 0) * 2 - 1 AS y FROM daily WINDOW w AS (PARTITION BY event_type))"""


def scaled(t):
    rows = daily(t)
    return series.scale(rows, series.fit_scale(rows, PANEL, ["x", "y"]), PANEL, ["x", "y"])


#: Six-hour steps, a complete calendar for every event type; x in thousands, so that errors keep their digits.
_STEPS = """ev AS (SELECT event_type, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 4 + hour(ts) // 6 AS b, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
  sums AS (SELECT event_type, b, CAST(sum(cents) AS DOUBLE) / 100000 AS x, CAST(count(*) AS DOUBLE) AS y FROM ev GROUP BY 1, 2),
  steps AS (SELECT t.event_type, c.b, coalesce(x, 0) AS x, coalesce(y, 0) AS y FROM (SELECT DISTINCT event_type FROM ev) t CROSS JOIN (SELECT unnest(generate_series(min(b), max(b))) AS b FROM ev) c
    LEFT JOIN sums ON sums.event_type = t.event_type AND sums.b = c.b)"""


def stepped(t):
    day, hour = F.to_date("ts"), F.hour(F.col("ts").cast("timestamp_ntz"))
    rows = t.events.select("event_type", (F.datediff(day, F.lit("2024-01-01")) * 4 + F.floor(hour / 6)).cast("int").alias("b"), F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    sums = rows.groupBy("event_type", "b").agg((F.sum("cents").cast("double") / 100000).alias("x"), F.count(F.lit(1)).cast("double").alias("y"))
    ends = rows.agg(F.sequence(F.min("b"), F.max("b"))).scalar()
    calendar = rows.select("event_type").distinct().withColumn("b", F.explode(ends))
    return calendar.join(sums, ["event_type", "b"], "left").fillna(0.0, ["x", "y"])


_UNIT = f"""{_STEPS}, zs AS (SELECT event_type, b, (x - min(x) OVER w) / nullif(max(x) OVER w - min(x) OVER w, 0) * 2 - 1 AS x,
  (y - min(y) OVER w) / nullif(max(y) OVER w - min(y) OVER w, 0) * 2 - 1 AS y FROM steps WINDOW w AS (PARTITION BY event_type))"""


def unit_steps(t):
    rows = stepped(t)
    return series.scale(rows, series.fit_scale(rows, PANEL, ["x", "y"]), PANEL, ["x", "y"])


def solved(name: str, keys: str, vectors: str, pivots: str) -> str:
    """SQL that sweeps the sums of products of the lists ``v`` of ``vectors`` on their first entries: coefficients, residuals and inverse, by key."""
    return f"""{name}_g AS (SELECT {keys}, i, list(s ORDER BY j) AS r, any_value(n) AS n FROM (SELECT {keys}, i, j, sum(v[i] * v[j]) AS s, count(*) AS n
      FROM (SELECT {keys}, v, unnest(generate_series(1, len(v))) AS i FROM {vectors}) CROSS JOIN LATERAL (SELECT unnest(generate_series(1, len(v))) AS j) GROUP BY ALL) GROUP BY ALL),
    {name}_m AS (SELECT {keys}, any_value(n) AS n, list(r ORDER BY i) AS m FROM {name}_g GROUP BY ALL),
    {name}_s AS (SELECT {keys}, n, 1 AS k, m FROM {name}_m UNION ALL SELECT {keys}, n, k + 1, list_transform(m, lambda r, i: list_transform(r, lambda v, j:
        CASE WHEN i = k AND j = k THEN 1 / m[k][k] WHEN i = k THEN v / m[k][k] WHEN j = k THEN -v / m[k][k] ELSE v - r[k] * m[k][j] / m[k][k] END))
      FROM {name}_s WHERE k <= {pivots}),
    {name} AS (SELECT {keys}, n, m FROM {name}_s WHERE k = {pivots} + 1)"""


def _history(source: str, most: int) -> str:
    return f"""hist AS (SELECT event_type, b, x, y, row_number() OVER w AS rn, coalesce(list_reverse(list(x) OVER (PARTITION BY event_type ORDER BY b ROWS BETWEEN {most} PRECEDING AND 1 PRECEDING)), []) AS hx,
      coalesce(list_reverse(list(y) OVER (PARTITION BY event_type ORDER BY b ROWS BETWEEN {most} PRECEDING AND 1 PRECEDING)), []) AS hy FROM {source} WINDOW w AS (PARTITION BY event_type ORDER BY b))"""


@query(
    "w11_fill_forward_then_back",
    f"""WITH {_DAILY}, holes AS (SELECT event_type, day, CASE WHEN day(day) % 4 = 2 THEN x END AS x FROM daily),
    fwd AS (SELECT *, last_value(x IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY day ROWS UNBOUNDED PRECEDING) AS f FROM holes)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, coalesce(f, first_value(f IGNORE NULLS) OVER
      (PARTITION BY event_type ORDER BY day ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS x FROM fwd""",
)
def _(t):
    holes = daily(t).withColumn("x", F.when(F.dayofmonth("day") % 4 == 2, F.col("x")))
    return windows.fill(holes, PANEL, TIME, ["x"]).select("event_type", F.col("day").cast("string").alias("day"), "x")


@query(
    "w12_second_difference",
    f"""WITH {_DAILY}, d AS (SELECT event_type, day, x - 2 * lag(x) OVER w + lag(x, 2) OVER w AS x, row_number() OVER w AS rn FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day))
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, x FROM d WHERE rn > 2""",
)
def _(t):
    return windows.difference(daily(t), PANEL, TIME, ["x"], 2).select("event_type", F.col("day").cast("string").alias("day"), "x")


@query(
    "w13_inverse_difference",
    f"""WITH {_DAILY}, d AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day) AS rn FROM daily) SELECT event_type, strftime(day, '%Y-%m-%d') AS day, x FROM d WHERE rn > 2""",
)
def _(t):
    rows = daily(t)
    second = windows.difference(rows, PANEL, TIME, ["x"], 2)
    opening = windows.top_k(rows, PANEL, [F.asc("day")], 2, rank="r").groupBy("event_type").agg(
        F.max(F.when(F.col("r") == 2, F.col("x"))).alias("x_d0"), F.max(F.when(F.col("r") == 1, F.col("x"))).alias("_first")
    ).select("event_type", "x_d0", (F.col("x_d0") - F.col("_first")).alias("x_d1"))
    levels = windows.undifference(second.join(opening, "event_type"), PANEL, TIME, ["x"], ["d1", "d0"])
    return levels.select("event_type", F.col("day").cast("string").alias("day"), "x")


@query(
    "w14_lag_samples",
    f"""WITH {_DAILY}, l AS (SELECT event_type, day, x, lag(x, 1) OVER w AS x_lag1, lag(x, 2) OVER w AS x_lag2, lag(x, 3) OVER w AS x_lag3, row_number() OVER w AS rn FROM daily WINDOW w AS (PARTITION BY event_type ORDER BY day))
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, x, x_lag1, x_lag2, x_lag3 FROM l WHERE rn > 3""",
)
def _(t):
    rows = windows.lag_features(daily(t).drop("y"), PANEL, TIME, ["x"], 3)
    return rows.withColumn("day", F.col("day").cast("string"))


@query(
    "w15_chronological_split",
    f"""WITH {_DAILY}, r AS (SELECT event_type, day, row_number() OVER (PARTITION BY event_type ORDER BY day) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM daily)
    SELECT event_type, strftime(day, '%Y-%m-%d') AS day, CASE WHEN rn <= floor(n * 0.8) THEN 'train' ELSE 'test' END AS split FROM r""",
)
def _(t):
    split = windows.chrono_split(daily(t), PANEL, TIME, 0.8)
    return split.select("event_type", F.col("day").cast("string").alias("day"), "split")


@query(
    "m08_scale_and_unscale",
    f"""WITH {_SCALED} SELECT event_type, strftime(day, '%Y-%m-%d') AS day, round(z.x, 9) AS x, round((d.y - avg(d.y) OVER w) / stddev_pop(d.y) OVER w, 9) AS y, d.x AS back
    FROM z JOIN daily d USING (event_type, day) WINDOW w AS (PARTITION BY event_type)""",
)
def _(t):
    rows = daily(t)
    fitted = series.fit_scale(rows, PANEL, ["x", "y"])
    both = series.scale(rows, fitted, PANEL, ["x"])
    back = series.unscale(both, fitted, PANEL, ["x"]).select("event_type", "day", F.round("x", 2).alias("back"))
    done = series.scale(both, fitted, PANEL, ["y"], kind="z").join(back, ["event_type", "day"])
    return done.select("event_type", F.col("day").cast("string").alias("day"), F.round("x", 9).alias("x"), F.round("y", 9).alias("y"), "back")


_LEVELS = f"""{_UNIT}, lev AS (SELECT event_type, 'x' AS series, b, x AS v FROM zs UNION ALL SELECT event_type, 'y', b, y FROM zs),
  dif AS (SELECT event_type, series, b, v - lag(v) OVER w AS d, lag(v) OVER w AS l, row_number() OVER w AS rn, count(*) OVER (PARTITION BY event_type, series) AS size FROM lev WINDOW w AS (PARTITION BY event_type, series ORDER BY b)),
  old AS (SELECT *, CAST(least(size // 2 - 2, ceil(12 * power(size / 100.0, 0.25))) AS BIGINT) AS most,
    coalesce(list_reverse(list(d) OVER (PARTITION BY event_type, series ORDER BY b ROWS BETWEEN 40 PRECEDING AND 1 PRECEDING)), []) AS h FROM dif)"""


@query(
    "m09_unit_root_test",
    f"""WITH RECURSIVE {_LEVELS}, tries AS (SELECT event_type, series, p, [1.0, l] || h[1:p] || [d] AS v FROM old CROSS JOIN range(0, 41) t(p) WHERE p <= most AND rn > most + 1),
    {solved("tried", "event_type, series, p", "tries", "(p + 2)")},
    best AS (SELECT event_type, series, p FROM (SELECT event_type, series, p, row_number() OVER (PARTITION BY event_type, series ORDER BY n * (ln(2 * pi()) + 1 + ln(m[p + 3][p + 3] / n)) + 2 * (p + 2), p) AS rn FROM tried) WHERE rn = 1),
    used AS (SELECT event_type, series, p, [1.0, l] || h[1:p] || [d] AS v FROM old JOIN best USING (event_type, series) WHERE rn > p + 1),
    {solved("fit", "event_type, series, p", "used", "(p + 2)")},
    s AS (SELECT event_type, series, p, n, m[2][p + 3] / sqrt(m[p + 3][p + 3] / (n - p - 2) * m[2][2]) AS statistic, -2.86154 - 2.8903 / n - 4.234 / (n * n) - 40.040 / (n * n * n) AS critical FROM fit)
    SELECT event_type, series, CAST(p AS INT) AS lags, round(statistic, 6) AS statistic, round(critical, 6) AS critical, CAST(statistic < critical AS INT) AS stationary FROM s""",
)
def _(t):
    tested = series.adf(unit_steps(t), PANEL, "b", ["x", "y"])
    return tested.select(
        "event_type", "series", "lags", F.round("statistic", 6).alias("statistic"), F.round("critical", 6).alias("critical"), F.col("stationary").cast("int").alias("stationary")
    )


@query(
    "m10_make_stationary",
    f"""WITH {_UNIT}, d AS (SELECT event_type, b, x - lag(x) OVER w AS x, y - lag(y) OVER w AS y FROM zs WINDOW w AS (PARTITION BY event_type ORDER BY b))
    SELECT event_type, CAST(b AS INT) AS b, round(x, 9) AS x, round(y, 9) AS y, 1 AS difference, true AS stationary FROM d WHERE x IS NOT NULL""",
)
def _(t):
    rows, order, tested = series.make_stationary(unit_steps(t), PANEL, "b", ["x", "y"])
    passed = tested.groupBy("event_type").agg(F.bool_and("stationary").alias("stationary"))
    return rows.join(passed, "event_type").select("event_type", "b", F.round("x", 9).alias("x"), F.round("y", 9).alias("y"), F.lit(order).alias("difference"), "stationary")


_LAG1 = f"""{_SCALED}, l AS (SELECT event_type, day, x, lag(x) OVER w AS xl, y, lag(y) OVER w AS yl FROM z WINDOW w AS (PARTITION BY event_type ORDER BY day)),
  ols AS (SELECT event_type, count(*) AS n, covar_pop(x, xl) AS cx, covar_pop(x, yl) AS cy, var_pop(xl) AS vx, var_pop(yl) AS vy, covar_pop(xl, yl) AS vxy,
    avg(x) AS mx, avg(xl) AS mxl, avg(yl) AS myl, var_pop(x) AS sxx, regr_r2(x, xl) AS r2 FROM l WHERE xl IS NOT NULL GROUP BY 1),
  b AS (SELECT *, (cx * vy - cy * vxy) / (vx * vy - vxy * vxy) AS cfx, (cy * vx - cx * vxy) / (vx * vy - vxy * vxy) AS cfy FROM ols)"""


@query(
    "m11_vector_autoregression",
    f"""WITH {_LAG1} SELECT event_type, 'const' AS term, round(mx - cfx * mxl - cfy * myl, 6) AS coefficient FROM b UNION ALL SELECT event_type, 'x_lag1', round(cfx, 6) FROM b
    UNION ALL SELECT event_type, 'y_lag1', round(cfy, 6) FROM b""",
)
def _(t):
    fitted = series.fit_var(scaled(t), PANEL, TIME, ["x", "y"], 1).filter(F.col("target") == "x")
    return fitted.select("event_type", "term", F.round("coefficient", 6).alias("coefficient"))


@query(
    "m12_lag_order_sweep",
    f"""WITH RECURSIVE {_UNIT}, {_history("zs", 12)}, vs AS (SELECT event_type, p, [1.0] || hx[1:p] || hy[1:p] || [x, y] AS v FROM hist CROSS JOIN range(0, 13) t(p) WHERE rn > p),
    {solved("var", "event_type, p", "vs", "(1 + 2 * p)")},
    c AS (SELECT event_type, p, n, ln((m[2 * p + 2][2 * p + 2] * m[2 * p + 3][2 * p + 3] - m[2 * p + 2][2 * p + 3] * m[2 * p + 3][2 * p + 2]) / (n * n)) AS l, 2 * (1 + 2 * p) AS k FROM var)
    SELECT event_type, CAST(p AS INT) AS lag, round(l + 2.0 * k / n, 6) AS aic, round(l + ln(n) * k / n, 6) AS bic, round(l + 2 * ln(ln(n)) * k / n, 6) AS hqic FROM c""",
)
def _(t):
    swept = series.lag_sweep(unit_steps(t), PANEL, "b", ["x", "y"], 12)
    return swept.select("event_type", "lag", *[F.round(c, 6).alias(c) for c in ("aic", "bic", "hqic")])


@query(
    "m13_granger_f_test",
    f"""WITH RECURSIVE {_UNIT}, {_history("zs", 10)}, pairs AS (SELECT event_type, rn, 'y' AS cause, 'x' AS effect, x AS z, hx AS own, hy AS other FROM hist UNION ALL SELECT event_type, rn, 'x', 'y', y, hy, hx FROM hist),
    shorts AS (SELECT event_type, cause, effect, p, [1.0] || own[1:p] || [z] AS v FROM pairs CROSS JOIN range(1, 11) t(p) WHERE rn > p),
    fulls AS (SELECT event_type, cause, effect, p, [1.0] || own[1:p] || other[1:p] || [z] AS v FROM pairs CROSS JOIN range(1, 11) t(p) WHERE rn > p),
    {solved("a", "event_type, cause, effect, p", "shorts", "(1 + p)")}, {solved("b", "event_type, cause, effect, p", "fulls", "(1 + 2 * p)")}
    SELECT event_type, cause, effect, CAST(p AS INT) AS lag, round(((a.m[p + 2][p + 2] - b.m[2 * p + 2][2 * p + 2]) / p) / (b.m[2 * p + 2][2 * p + 2] / (n - 2 * p - 1)), 6) AS f, CAST(n - 2 * p - 1 AS INT) AS df_den
    FROM a JOIN b USING (event_type, cause, effect, p, n)""",
)
def _(t):
    tested = series.granger(unit_steps(t), PANEL, "b", ["x", "y"], 10)
    return tested.select("event_type", "cause", "effect", "lag", F.round("f", 6).alias("f"), "df_den")


def _forecast_sql(rows: str, lags: str, steps: str) -> str:
    """SQL for forecasts in levels of VARs on the scaled first differences of ``rows``: fc (event_type, p, step, x, y)."""
    return f"""rng AS (SELECT event_type, min(x) AS lx, max(x) - min(x) AS sx, min(y) AS ly, max(y) - min(y) AS sy FROM {rows} GROUP BY 1),
    tz AS (SELECT event_type, b, (x - lx) / sx * 2 - 1 AS x, (y - ly) / sy * 2 - 1 AS y FROM {rows} JOIN rng USING (event_type)),
    td AS (SELECT * FROM (SELECT event_type, b, x - lag(x) OVER w AS x, y - lag(y) OVER w AS y FROM tz WINDOW w AS (PARTITION BY event_type ORDER BY b)) WHERE x IS NOT NULL),
    {_history("td", 20)}, vs AS (SELECT event_type, p, [1.0] || hx[1:p] || hy[1:p] || [x, y] AS v FROM hist CROSS JOIN {lags} t(p) WHERE rn > p),
    {solved("var", "event_type, p", "vs", "(1 + 2 * p)")},
    ends AS (SELECT event_type, arg_max(x, b) AS ex, arg_max(y, b) AS ey FROM tz GROUP BY 1),
    tails AS (SELECT event_type, list(x ORDER BY b DESC) AS ax, list(y ORDER BY b DESC) AS ay FROM td GROUP BY 1),
    w AS (SELECT event_type, p, list_transform(m[1:1 + 2 * p], lambda r: r[2 * p + 2]) AS cx, list_transform(m[1:1 + 2 * p], lambda r: r[2 * p + 3]) AS cy FROM var),
    walk AS (SELECT event_type, p, 0 AS step, ax[1:p] AS ax, ay[1:p] AS ay, 0.0::DOUBLE AS tx, 0.0::DOUBLE AS ty, cx, cy FROM w JOIN tails USING (event_type)
      UNION ALL SELECT event_type, p, step + 1, ([nx] || ax)[1:p], ([ny] || ay)[1:p], tx + nx, ty + ny, cx, cy
      FROM (SELECT *, list_dot_product(cx, [1.0] || ax || ay) AS nx, list_dot_product(cy, [1.0] || ax || ay) AS ny FROM walk) WHERE step < {steps}),
    fc AS (SELECT event_type, p, step, (ex + tx + 1) / 2 * sx + lx AS x, (ey + ty + 1) / 2 * sy + ly AS y FROM walk JOIN ends USING (event_type) JOIN rng USING (event_type) WHERE step > 0)"""


@query(
    "m14_recursive_forecast",
    f"""WITH RECURSIVE {_STEPS}, {_forecast_sql("steps", "range(2, 3)", "5")} SELECT event_type, CAST(step AS INT) AS step, round(x, 6) AS x, round(y, 6) AS y FROM fc""",
)
def _(t):
    """Both series five steps ahead by a VAR(2) of their scaled changes, back in their own units."""
    ahead = series.forecast_levels(stepped(t), PANEL, "b", ["x", "y"], [2], 5)
    return ahead.select("event_type", "step", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(
    "m15_forecast_errors",
    f"""WITH RECURSIVE {_STEPS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY b) AS rn, count(*) OVER (PARTITION BY event_type) AS size FROM steps),
    train AS (SELECT event_type, b, x, y FROM ranked WHERE rn <= floor(size * 0.8)), test AS (SELECT event_type, x, y, row_number() OVER (PARTITION BY event_type ORDER BY b) AS step FROM ranked WHERE rn > floor(size * 0.8)),
    {_forecast_sql("train", "range(1, 21)", "(SELECT max(step) FROM test)")},
    g AS (SELECT event_type, p, 'x' AS series, test.x - fc.x AS gap FROM test JOIN fc USING (event_type, step) UNION ALL SELECT event_type, p, 'y', test.y - fc.y FROM test JOIN fc USING (event_type, step)),
    a AS (SELECT * FROM g UNION ALL SELECT event_type, p, 'total', gap FROM g)
    SELECT event_type, CAST(p AS INT) AS lag, series, round(avg(gap * gap), 6) AS mse, round(sqrt(avg(gap * gap)), 6) AS rmse, round(avg(abs(gap)), 6) AS mae FROM a GROUP BY 1, 2, 3""",
)
def _(t):
    """Errors on the last fifth of the steps of VARs of orders 1 to 20, fitted to the changes of the first four fifths."""
    split = windows.chrono_split(stepped(t), PANEL, "b", 0.8)
    train, test = (split.filter(F.col("split") == name).drop("split") for name in ("train", "test"))
    errors = series.errors_by_lag(train, test, PANEL, "b", ["x", "y"], range(1, 21))
    return errors.select("event_type", "lag", "series", *[F.round(c, 6).alias(c) for c in ("mse", "rmse", "mae")])


@query(
    "m16_t05_actual_and_forecast",
    f"""WITH {_DAILY} SELECT event_type, strftime(day, '%Y-%m-%d') AS day, 'x' AS indicator_code, x AS value, 'actual' AS series FROM daily
    UNION ALL SELECT event_type, strftime(day, '%Y-%m-%d'), 'y', y, 'actual' FROM daily UNION ALL SELECT event_type, strftime(day, '%Y-%m-%d'), 'x', x + 1, 'forecast' FROM daily
    UNION ALL SELECT event_type, strftime(day, '%Y-%m-%d'), 'y', y + 1, 'forecast' FROM daily""",
)
def _(t):
    actual = daily(t).withColumn("day", F.col("day").cast("string"))
    ahead = actual.withColumns({"x": F.col("x") + 1, "y": F.col("y") + 1})
    return series.actual_vs_forecast(actual, ahead, ["event_type", "day"], ["x", "y"]).orderBy("event_type", "indicator_code", "day", "series")


@query(
    "m17_ensemble_weights",
    f"""WITH {_SCALED}, p AS (SELECT event_type, x AS target, 0.9 * x + 0.2 AS m1, y AS m2 FROM z),
    q AS (SELECT event_type, sum(m1 * m1) + 0.001 AS a, sum(m1 * m2) AS b, sum(m2 * m2) + 0.001 AS d, sum(m1 * target) AS e, sum(m2 * target) AS f FROM p GROUP BY 1),
    w AS (SELECT event_type, (d - b + e - f) / (a + d - 2 * b) AS w1 FROM q), c AS (SELECT event_type, greatest(w1, 0) AS u, greatest(1 - w1, 0) AS v FROM w)
    SELECT event_type, 'm1' AS model, round(u / (u + v), 6) AS weight FROM c UNION ALL SELECT event_type, 'm2', round(v / (u + v), 6) FROM c""",
)
def _(t):
    rows = scaled(t).select("event_type", F.col("x").alias("target"), (0.9 * F.col("x") + 0.2).alias("m1"), F.col("y").alias("m2"))
    return series.ensemble_weights(rows, PANEL, ["m1", "m2"], "target").withColumn("weight", F.round("weight", 6))
