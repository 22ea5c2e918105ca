"""Panels of time series: scaling, stationarity, vector autoregression and forecast errors.

Every operator takes a ``panel`` key, so one series or a hundred thousand use the same plan. Models
are fitted from sums of products, which Spark adds up per panel; only those small matrices reach
a solver, one panel at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from math import ceil, comb, log, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import _panel, difference, lag_features, top_k, undifference

# MacKinnon (2010) response surface of the 5 % critical value, constant term, one series.
ADF_5_PERCENT = (-2.86154, -2.8903, -4.234, -40.040)


def fit_scale(df: DataFrame, panel: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row of minimum, maximum, mean and (population) deviation per panel and column."""
    aggs = []
    for c in columns:
        aggs += [
            F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"),
        ]
    return df.groupBy(*panel).agg(*aggs)


def _span(c: str) -> Column:
    width = F.col(f"{c}_max") - F.col(f"{c}_min")
    return F.when(width == 0, 1.0).otherwise(width)


def _std(c: str) -> Column:
    return F.when(F.col(f"{c}_std") == 0, 1.0).otherwise(F.col(f"{c}_std"))


def scale(df: DataFrame, fitted: DataFrame, panel: Sequence[str], columns: Sequence[str], kind: str = "minmax") -> DataFrame:
    """Scale to (-1, 1), or to z-scores, with statistics fitted elsewhere (the training rows)."""
    joined = df.join(fitted, list(panel))
    if kind == "minmax":
        new = {c: (F.col(c) - F.col(f"{c}_min")) / _span(c) * 2 - 1 for c in columns}
    else:
        new = {c: (F.col(c) - F.col(f"{c}_mean")) / _std(c) for c in columns}
    return joined.withColumns(new).select(*df.columns)


def unscale(df: DataFrame, fitted: DataFrame, panel: Sequence[str], columns: Sequence[str], kind: str = "minmax") -> DataFrame:
    joined = df.join(fitted, list(panel))
    if kind == "minmax":
        new = {c: (F.col(c) + 1) / 2 * _span(c) + F.col(f"{c}_min") for c in columns}
    else:
        new = {c: F.col(c) * _std(c) + F.col(f"{c}_mean") for c in columns}
    return joined.withColumns(new).select(*df.columns)


def gram(df: DataFrame, panel: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per panel the row count ``n`` and the flattened matrix ``g`` of sums of products of (1, columns)."""
    names = [F.lit(1.0), *[F.col(c) for c in columns]]
    size = len(names)
    upper = {(i, j): F.sum(names[i] * names[j]) for i in range(size) for j in range(i, size)}
    cells = [upper[min(i, j), max(i, j)] for i in range(size) for j in range(size)]
    return df.groupBy(*panel).agg(F.count(F.lit(1)).alias("n"), F.array(*cells).alias("g"))


def _regress(g: np.ndarray, xs: Sequence[int], y: int) -> tuple[np.ndarray, float, np.ndarray]:
    """Least squares from a Gram matrix: coefficients, residual sum of squares, inverse of X'X."""
    xx, xy = g[np.ix_(xs, xs)], g[xs, y]
    inverse = np.linalg.pinv(xx, hermitian=True)
    beta = inverse @ xy
    return beta, float(max(g[y, y] - beta @ xy, 0.0)), inverse


def _per_panel(grams: DataFrame, panel: Sequence[str], solve, extra: str) -> DataFrame:
    """Apply ``solve(n, G) -> rows`` to each panel's Gram row, inside Arrow batches."""
    keys = ", ".join(f"`{p}` {grams.schema[p].dataType.simpleString()}" for p in panel)
    names = [part.split()[0] for part in extra.split(", ")]

    def run(batches):
        for batch in batches:
            out = {name: [] for name in [*panel, *names]}
            for row in batch.itertuples(index=False):
                flat = np.asarray(row.g, dtype=np.float64)
                side = int(round(len(flat) ** 0.5))
                for result in solve(int(row.n), flat.reshape(side, side)):
                    for p in panel:
                        out[p].append(getattr(row, p))
                    for name, value in zip(names, result, strict=True):
                        out[name].append(value)
            yield pd.DataFrame(out)

    return grams.select(*panel, "n", "g").mapInPandas(run, f"{keys}, {extra}")


@dataclass
class LagSums:
    """Sums of products of a panel's rows with its rows ``h`` steps before, for every ``h``, and its first and last rows.

    The sums of any regression on lags, over any of its possible samples, are these less what lies at the edges.
    """

    n: int
    totals: np.ndarray  # by column
    bands: np.ndarray  # h, column, column of the earlier row
    head: np.ndarray  # the first rows, as many as there are bands behind the first
    tail: np.ndarray

    def gram(self, p: int, start: int | None = None) -> tuple[int, np.ndarray]:
        """Rows and sums of products of (1, z_t, z_t-1, ..., z_t-p) over all t behind the first ``start`` rows, by default ``p``."""
        start = p if start is None else start
        k, n = len(self.totals), self.n
        out = np.zeros((1 + k * (p + 1), 1 + k * (p + 1)))
        out[0, 0] = n - start
        last = n - len(self.tail)
        for i in range(p + 1):
            at = slice(1 + k * i, 1 + k * (i + 1))
            out[0, at] = out[at, 0] = self.totals - self.head[:start - i].sum(axis=0) - self.tail[n - i - last:].sum(axis=0)
            for j in range(i, p + 1):
                h = j - i
                front = self.head[h:start - i].T @ self.head[:max(start - i - h, 0)] if start - i > h else 0.0
                back = self.tail[n - i - last:].T @ self.tail[n - i - h - last:n - h - last] if i else 0.0
                to = slice(1 + k * j, 1 + k * (j + 1))
                out[at, to] = self.bands[h] - front - back
                out[to, at] = out[at, to].T
        return n - start, out


def lag_sums(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], pmax: int) -> DataFrame:
    """One row per panel with what ``LagSums`` holds, from one scan; the columns are filled, without nulls."""
    window, whole = _panel(panel, time), Window.partitionBy(*panel)
    values = [F.col(c).cast("double") for c in columns]
    lags = {f"_l{h}_{i}": F.lag(v, h).over(window) for h in range(pmax + 1) for i, v in enumerate(values)}
    rows = df.withColumns({**lags, "_seq": F.row_number().over(window), "_size": F.count(F.lit(1)).over(whole)})
    k = len(columns)
    bands = [F.coalesce(F.sum(F.col(f"_l0_{i}") * F.col(f"_l{h}_{j}")), F.lit(0.0)) for h in range(pmax + 1) for i in range(k) for j in range(k)]
    row = F.struct("_seq", F.array(*[F.col(f"_l0_{i}") for i in range(k)]).alias("v"))

    def edge(inside: Column, name: str) -> Column:
        return F.transform(F.array_sort(F.collect_list(F.when(inside, row))), lambda e: e["v"]).alias(name)

    return rows.groupBy(*panel).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(f"_l0_{i}") for i in range(k)]).alias("totals"), F.array(*bands).alias("bands"),
        edge(F.col("_seq") <= pmax, "head"), edge(F.col("_seq") > F.col("_size") - pmax, "tail"),
    )


def _each_panel(sums: DataFrame, panel: Sequence[str], pmax: int, solve: Callable[[LagSums], Iterable[tuple]], extra: str) -> DataFrame:
    """The rows that ``solve`` gives for the sums of each panel, in columns ``extra``."""
    keys = ", ".join(f"`{p}` {sums.schema[p].dataType.simpleString()}" for p in panel)
    names = [part.split()[0] for part in extra.split(", ")]

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                totals = np.asarray(row.totals, dtype=float)
                edges = [np.array([list(v) for v in e], dtype=float).reshape(-1, len(totals)) for e in (row.head, row.tail)]
                found = LagSums(int(row.n), totals, np.asarray(row.bands, dtype=float).reshape(pmax + 1, len(totals), -1), *edges)
                key = [getattr(row, p) for p in panel]
                out += [[*key, *values] for values in solve(found)]
            yield pd.DataFrame(out, columns=[*panel, *names])

    return sums.mapInPandas(run, f"{keys}, {extra}")


def _usual_lags(n: int) -> int:
    """How many lags of the change a unit-root test tries: a rule by the length of the series."""
    return max(0, min(n // 2 - 2, ceil(12 * (n / 100) ** 0.25)))


def _test_sums(sums: LagSums, lags: int, start: int) -> tuple[int, np.ndarray]:
    """Sums of products of (1, level before, ``lags`` earlier changes, change) over the rows behind ``start``."""
    n, g = sums.gram(lags + 1, start)
    turn = np.zeros((lags + 3, lags + 3))
    turn[0, 0] = turn[1, 2] = 1
    for i in range(lags + 1):  # the change i steps before
        at = 2 + i - 1 if i else lags + 2
        turn[at, 1 + i], turn[at, 2 + i] = 1, -1
    return n, turn @ g @ turn.T


def best_lags(sums: LagSums, most: int) -> int:
    """The number of lags of smallest information criterion, all tried on the rows that have ``most`` of them.

    The regressions are nested: one elimination, column by column, leaves the residual of each on its way.
    """
    n, g = _test_sums(sums, most, most + 1)
    found = []
    for column in range(most + 2):
        pivot = g[column, column]
        if pivot > 1e-12 * max(1.0, abs(g[0, 0])):
            g = g - np.outer(g[:, column], g[column]) / pivot
        if column:
            rss = max(float(g[-1, -1]), 1e-300)
            found.append((n * (log(2 * pi) + 1 + log(rss / n)) + 2 * (column + 1), column - 1))
    return min(found)[1]


def adf(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], lags: int | None = None) -> DataFrame:
    """(panel, series, lags, statistic, critical, stationary): unit-root test with a constant and lags of the change.

    The change is regressed on the previous level and earlier changes; the t statistic of the level is
    compared with the published 5 % critical value. Without ``lags`` their number is chosen for every series by
    information criterion, up to a rule by its length, and the test then uses all rows that have so many.
    """
    entries = F.array(*[F.struct(F.lit(c).alias("series"), F.col(c).cast("double").alias("y")) for c in columns])
    long = df.select(*panel, time, F.inline(entries)).filter(F.col("y").isNotNull())
    keys = [*panel, "series"]
    if lags is None:
        longest = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    bands = 1 + (_usual_lags(longest) if lags is None else lags)

    def solve(sums: LagSums):
        most = best_lags(sums, _usual_lags(sums.n)) if lags is None and sums.n > 3 else (lags or 0)
        if sums.n - most - 1 < 1:
            return
        n, g = _test_sums(sums, most, most + 1)
        beta, rss, inverse = _regress(g, list(range(most + 2)), most + 2)
        free = n - most - 2
        error = (rss / free * inverse[1, 1]) ** 0.5 if free > 0 else 0.0
        stat = float(beta[1] / error) if error > 0 else float("-inf")
        b0, b1, b2, b3 = ADF_5_PERCENT
        critical = b0 + b1 / n + b2 / n**2 + b3 / n**3
        yield most, stat, critical, bool(stat < critical)

    return _each_panel(lag_sums(long, keys, time, ["y"], bands), keys, bands, solve, "lags int, statistic double, critical double, stationary boolean")


def make_stationary(
    df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], lags: int | None = None
) -> tuple[DataFrame, int, DataFrame]:
    """Difference all series (at least once) until each one passes the unit-root test: rows, order, test results.

    It goes on as long as a series that fails has rows enough for another difference and its test; the
    results say which series of which panel passed.
    """
    order = 0
    while True:
        order += 1
        changed = difference(df, panel, time, columns, order)
        tested = adf(changed, panel, time, columns, lags)
        failed = tested.filter(~F.col("stationary")).select(*panel).distinct()
        # A test with a constant, a level and ``lags`` changes needs one row more than it has coefficients.
        rows = changed.groupBy(*panel).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 2 * (lags or 1) + 4)
        open_panels = failed.join(rows, list(panel), "left_semi") if panel else failed.crossJoin(rows.limit(1))
        if open_panels.isEmpty():
            return changed, order, tested


def _lagged(columns: Sequence[str], p: int) -> list[str]:
    return [f"{c}_lag{i}" for i in range(1, p + 1) for c in columns]


def fit_var(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], p: int) -> DataFrame:
    """VAR(p) by least squares: (panel, target, term, coefficient); terms are ``const`` and ``x_lagi``."""
    lagged = _lagged(columns, p)
    sums = gram(lag_features(df, panel, time, columns, p), panel, [*columns, *lagged])
    k = len(columns)

    def solve(_: int, g: np.ndarray):
        xs = [0, *range(1 + k, g.shape[0])]
        for t, target in enumerate(columns):
            beta, _rss, _inv = _regress(g, xs, 1 + t)
            for term, value in zip(["const", *lagged], beta, strict=True):
                yield target, term, float(value)

    return _per_panel(sums, panel, solve, "target string, term string, coefficient double")


def lag_sweep(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], pmax: int) -> DataFrame:
    """(panel, lag, aic, bic, hqic) of VAR(0..pmax), from one scan; each order uses every row that has its own full history."""
    k = len(columns)

    def solve(sums: LagSums):
        for p in range(min(pmax, sums.n - 1) + 1):
            n, g = sums.gram(p)
            xs = [0, *range(1 + k, g.shape[0])]
            xx, xy, yy = g[np.ix_(xs, xs)], g[np.ix_(xs, range(1, 1 + k))], g[1 : 1 + k, 1 : 1 + k]
            sigma = (yy - xy.T @ np.linalg.pinv(xx, hermitian=True) @ xy) / n
            sign, logdet = np.linalg.slogdet(sigma)
            free = k * len(xs)
            base = float(logdet) if sign > 0 else float("-inf")
            twice = 2 * np.log(np.log(n)) if n > 1 else 0.0
            yield p, base + 2 * free / n, base + np.log(n) * free / n, base + twice * free / n

    return _each_panel(lag_sums(df, panel, time, columns, pmax), panel, pmax, solve, "lag int, aic double, bic double, hqic double")


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta by its continued fraction."""
    from math import exp, lgamma

    if x <= 0 or x >= 1:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_fraction(b, a, 1 - x)
    front = exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * log(x) + b * log(1 - x)) / a
    tiny = 1e-300
    c, d = 1.0, 1 / max(1 - (a + b) * x / (a + 1), tiny)
    value = d
    for m in range(1, 300):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + step * d) or tiny)
            c = (1 + step / c) or tiny
            value *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * value


def granger(df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], p: int) -> DataFrame:
    """(panel, cause, effect, lag, f, df_num, df_den, p_value): do lags of cause help predict effect.

    All lags 1..p are reported, from one scan; ``causality`` takes the smallest p-value per pair.
    """
    k = len(columns)

    def solve(sums: LagSums):
        for lag in range(1, min(p, sums.n - 1) + 1):
            n, g = sums.gram(lag)
            free = n - 2 * lag - 1
            for c, cause in enumerate(columns):
                for e, effect in enumerate(columns):
                    if c == e:
                        continue
                    own, other = ([1 + k * i + x for i in range(1, lag + 1)] for x in (e, c))
                    _, short, _ = _regress(g, [0, *own], 1 + e)
                    _, full, _ = _regress(g, [0, *own, *other], 1 + e)
                    f = ((short - full) / lag) / (full / free) if full > 0 and free > 0 else float("nan")
                    p_value = _beta_fraction(free / 2, lag / 2, free / (free + lag * f)) if f == f and f >= 0 else float("nan")
                    yield cause, effect, lag, float(f), lag, free, float(p_value)

    extra = "cause string, effect string, lag int, f double, df_num int, df_den int, p_value double"
    return _each_panel(lag_sums(df, panel, time, columns, p), panel, p, solve, extra)


def causality(tested: DataFrame, panel: Sequence[str]) -> DataFrame:
    """(panel, effect, cause, p_value): the causality matrix, with the smallest p-value over all lags."""
    usable = F.when(~F.isnan("p_value"), F.col("p_value"))
    return tested.groupBy(*panel, "effect", "cause").agg(F.min(usable).alias("p_value"))


def forecast_sweep(
    df: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], lags: Sequence[int], steps: int
) -> DataFrame:
    """(panel, lag, step, columns...): recursive forecasts of a VAR of each order, fitted and begun from one scan."""
    k, pmax = len(columns), max(lags)

    def solve(sums: LagSums):
        for p in lags:
            if sums.n <= p:
                continue
            _, g = sums.gram(p)
            xs = [0, *range(1 + k, g.shape[0])]
            weights = np.linalg.pinv(g[np.ix_(xs, xs)], hermitian=True) @ g[np.ix_(xs, range(1, 1 + k))]
            recent = list(sums.tail[::-1][:p])
            for step in range(1, steps + 1):
                value = np.concatenate([[1.0], *recent[:p]]) @ weights
                yield p, step, *map(float, value)
                recent.insert(0, value)

    extra = "lag int, step int, " + ", ".join(f"{c} double" for c in columns)
    return _each_panel(lag_sums(df, panel, time, columns, pmax), panel, pmax, solve, extra)


def forecast_levels(
    train: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], lags: Sequence[int], steps: int, order: int = 1
) -> DataFrame:
    """(panel, lag, step, columns...): forecasts in the units of ``train``, of a VAR on its scaled and ``order`` times differenced rows.

    The way back is taken in reverse: running sums from the last differences and the last level of the scaled rows, then the
    training range.
    """
    fitted = fit_scale(train, panel, columns)
    scaled = scale(train.select(*panel, time, *columns), fitted, panel, columns)
    ahead = forecast_sweep(difference(scaled, panel, time, columns, order), panel, time, columns, lags, steps)
    last = top_k(scaled, panel, [F.desc(time)], order, rank="_back")
    bases = []
    for c in columns:
        back = [F.max(F.when(F.col("_back") == i + 1, F.col(c).cast("double"))) for i in range(order)]
        bases += [sum(((-1) ** i * comb(j, i) * back[i] for i in range(j + 1)), F.lit(0.0)).alias(f"{c}_d{j}") for j in range(order)]
    ends = last.groupBy(*panel).agg(*bases)
    restored = undifference(ahead.join(ends, list(panel)), [*panel, "lag"], "step", columns, [f"d{j}" for j in reversed(range(order))])
    return unscale(restored.select(*ahead.columns), fitted, panel, columns)


def errors_by_lag(
    train: DataFrame, test: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], lags: Sequence[int], order: int = 1
) -> DataFrame:
    """(panel, lag, series, mse, rmse, mae) of forecasts of each order against the rows of ``test``, and their ``total``."""
    steps = test.groupBy(*panel).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    ahead = forecast_levels(train, panel, time, columns, lags, steps, order).withColumnsRenamed({c: f"{c}_ahead" for c in columns})
    numbered = test.withColumn("step", F.row_number().over(_panel(panel, time)))
    joined = numbered.join(ahead, [*panel, "step"])
    return forecast_error(joined, [*panel, "lag"], {c: (c, f"{c}_ahead") for c in columns})


def forecast(
    df: DataFrame, coefficients: DataFrame, panel: Sequence[str], time: str, columns: Sequence[str], p: int, steps: int
) -> DataFrame:
    """Recursive VAR forecast: (panel, step, columns...) from the last ``p`` rows of every panel."""
    last = top_k(df, panel, [F.desc(time)], p, rank="_back")
    values = F.array(*[F.col(c).cast("double") for c in columns])
    history = last.groupBy(*panel).agg(F.array_sort(F.collect_list(F.struct("_back", values.alias("v")))).alias("_h"))
    named = F.struct(F.concat_ws("|", "target", "term"), "coefficient")
    model = coefficients.groupBy(*panel).agg(F.map_from_entries(F.collect_list(named)).alias("model"))
    keys = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in panel)
    schema = f"{keys}, step int, " + ", ".join(f"`{c}` double" for c in columns)
    terms = ["const", *_lagged(columns, p)]

    def run(batches):
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                weights = dict(row.model)
                a = np.array([[weights[f"{t}|{term}"] for term in terms] for t in columns])
                recent = [np.asarray(v, dtype=float) for v in row.hist]
                if len(recent) < p:
                    continue
                for step in range(1, steps + 1):
                    value = a @ np.concatenate([[1.0], *recent[:p]])
                    out.append([*[getattr(row, c) for c in panel], step, *value])
                    recent.insert(0, value)
            yield pd.DataFrame(out, columns=[*panel, "step", *columns])

    ready = history.join(model, list(panel)).select(*panel, F.col("_h.v").alias("hist"), "model")
    return ready.mapInPandas(run, schema)


def forecast_error(joined: DataFrame, by: Sequence[str], pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """(by, series, mse, rmse, mae) of actual/predicted column pairs, plus a ``total`` over all series."""
    entries = F.array(*[
        F.struct(F.lit(name).alias("series"), (F.col(a) - F.col(f)).alias("gap")) for name, (a, f) in pairs.items()
    ])
    gaps = joined.select(*by, F.inline(entries))
    both = gaps.unionByName(gaps.withColumn("series", F.lit("total"))) if len(pairs) > 1 else gaps
    mse = F.avg(F.col("gap") * F.col("gap"))
    return both.groupBy(*by, "series").agg(mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.avg(F.abs("gap")).alias("mae"))


def actual_vs_forecast(actual: DataFrame, predicted: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Long rows (keys, indicator_code, value, series) of both frames."""

    def long(df: DataFrame, tag: str) -> DataFrame:
        return df.unpivot(list(keys), list(columns), "indicator_code", "value").withColumn("series", F.lit(tag))

    return long(actual, "actual").unionByName(long(predicted, "forecast"))


def ensemble_weights(df: DataFrame, panel: Sequence[str], predictions: Sequence[str], target: str, lam: float = 1e-3) -> DataFrame:
    """(panel, model, weight): ridge weights that sum to one, negatives cut to zero and rescaled."""
    sums = gram(df, panel, [target, *predictions])
    m = len(predictions)

    def solve(_: int, g: np.ndarray):
        a = g[2:, 2:] + lam * np.eye(m)
        system = np.block([[2 * a, np.ones((m, 1))], [np.ones((1, m)), np.zeros((1, 1))]])
        weights = np.linalg.solve(system, np.concatenate([2 * g[2:, 1], [1.0]]))[:m]
        weights = np.clip(weights, 0, None)
        total = weights.sum()
        for name, value in zip(predictions, weights / total if total > 0 else weights, strict=True):
            yield name, float(value)

    return _per_panel(sums, panel, solve, "model string, weight double")
