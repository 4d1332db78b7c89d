"""Statistics of activity: inequality, regression, distribution summaries, series smoothing."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from editlume.session import ship_package


def _value_table(df: DataFrame, value: str) -> DataFrame:
    """Distinct values with their counts and the running count and sum before them.

    Counts per user take few distinct values, so the ordered part is small however many users there are.
    """
    v = df.where(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("m"))
    before = Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)
    return v.withColumn("n_before", F.coalesce(F.sum("m").over(before), F.lit(0))).withColumn("s_before", F.coalesce(F.sum(F.col("x") * F.col("m")).over(before), F.lit(0.0)))


def gini(df: DataFrame, value: str) -> DataFrame:
    """Gini coefficient of non-negative values, from value counts: sum((2i - n - 1) x) / (n sum(x)). NULL if the sum is 0."""
    v = _value_table(df, value)
    # ranks n_before + 1 .. n_before + m of one value add up in closed form
    ranks = F.col("m") * F.col("n_before") + F.col("m") * (F.col("m") + 1) / 2
    t = v.agg(F.sum("m").alias("n"), F.sum(F.col("x") * F.col("m")).alias("s"), F.sum(ranks * F.col("x")).alias("r"))
    return t.select(F.col("n"), F.try_divide(2 * F.col("r") - (F.col("n") + 1) * F.col("s"), F.col("n") * F.col("s")).alias("gini"))


def lorenz(df: DataFrame, value: str) -> DataFrame:
    """Points of the Lorenz curve at each distinct value, from (0, 0): share of holders, share of the total."""
    v = _value_table(df, value)
    whole = v.agg(F.sum("m").alias("n"), F.sum(F.col("x") * F.col("m")).alias("s"))
    points = v.crossJoin(F.broadcast(whole)).select(
        ((F.col("n_before") + F.col("m")) / F.col("n")).alias("p"), F.try_divide(F.col("s_before") + F.col("x") * F.col("m"), F.col("s")).alias("l")
    )
    origin = whole.where("n > 0").select(F.lit(0.0).alias("p"), F.lit(0.0).alias("l"))
    return origin.unionByName(points)


def ols(df: DataFrame, y: Column, x: Column) -> DataFrame:
    """Least squares of y on x: n, slope, intercept, r2. Rows where either is NULL are left out."""
    d = df.select(y.cast("double").alias("_y"), x.cast("double").alias("_x")).where("_y is not null and _x is not null")
    return d.agg(
        F.count("*").alias("n"), F.regr_slope("_y", "_x").alias("slope"), F.regr_intercept("_y", "_x").alias("intercept"), F.regr_r2("_y", "_x").alias("r2")
    )


def residual_extremes(df: DataFrame, label: str, y: Column, x: Column, k: int = 4) -> DataFrame:
    """The k rows with the largest absolute residuals of y on x, ties by label."""
    d = df.select(F.col(label), y.alias("_y"), x.alias("_x")).where("_y is not null and _x is not null")
    fit = ols(d, F.col("_y"), F.col("_x")).select("slope", "intercept")
    res = d.crossJoin(F.broadcast(fit)).select(label, (F.col("_y") - F.col("intercept") - F.col("slope") * F.col("_x")).alias("residual"))
    return res.orderBy(F.abs("residual").desc(), label).limit(k)


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: n, missing, distinct, mean, five-number summary with 5% and 95% points."""
    out = None
    for c in columns:
        q = F.percentile(c, F.array(*[F.lit(p) for p in (0.05, 0.25, 0.5, 0.75, 0.95)]))
        row = df.agg(
            F.count(c).alias("n"), (F.count("*") - F.count(c)).alias("missing"), F.count_distinct(c).alias("n_distinct"),
            F.mean(c).alias("mean"), F.min(c).cast("double").alias("lowest"), F.max(c).cast("double").alias("highest"), q.alias("_q"),
        )
        row = row.select(
            F.lit(c).alias("column_name"), "n", "missing", "n_distinct", "mean", "lowest",
            *[F.get("_q", F.lit(i)).alias(name) for i, name in enumerate(("p05", "p25", "p50", "p75", "p95"))], "highest",
        )
        out = row if out is None else out.unionByName(row)
    return out


def box_outliers(df: DataFrame, label: str, value: str) -> DataFrame:
    """Rows beyond 1.5 interquartile ranges of the quartiles."""
    q = df.agg(F.percentile(value, F.array(F.lit(0.25), F.lit(0.75))).alias("_q"))
    lo, hi = F.get("_q", F.lit(0)), F.get("_q", F.lit(1))
    return df.crossJoin(F.broadcast(q)).where((F.col(value) < lo - 1.5 * (hi - lo)) | (F.col(value) > hi + 1.5 * (hi - lo))).select(label, value)


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair of the natural logarithms of the columns (zeros left out)."""
    logs = df.select(*[F.ln(F.when(F.col(c) > 0, F.col(c).cast("double"))).alias(c) for c in columns])
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    wide = logs.agg(*[F.corr(a, b).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])))


def moving_mean(df: DataFrame, by: Sequence[str], order: str, value: str, width: int = 12) -> DataFrame:
    """Centred mean over `width` points (one more after than before, if even); NULL unless all are there and not NULL."""
    before = (width - 1) // 2
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-before, width - 1 - before)
    return df.withColumn("moving_mean", F.when((F.count(value).over(w) == width) & (F.count("*").over(w) == width), F.avg(value).over(w)))


def fill_months(df: DataFrame, by: Sequence[str], month: str, value: str) -> DataFrame:
    """A row for each month between a series' first and last, 0 where there was none (`month`: date of its first day)."""
    ends = df.groupBy(*by).agg(F.min(month).alias("_a"), F.max(month).alias("_b"))
    grid = ends.select(*by, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias(month))
    return grid.join(df.select(*by, month, value), [*by, month], "left").withColumn(value, F.coalesce(value, F.lit(0)))


def merge_series(df: DataFrame, time: str, name: str, value: str, names: Sequence[str]) -> DataFrame:
    """Series side by side over the union of their times (a full outer merge), NULL where a series has none."""
    return df.groupBy(time).pivot(name, list(names)).agg(F.first(value))


def _local_lines(x: np.ndarray, y: np.ndarray, at: slice, k: int, robust: np.ndarray) -> np.ndarray:
    """The local fits at the points `at`: tricube weights over the k nearest points of all, times the `robust` ones."""
    gap = np.abs(x[at, None] - x[None, :])
    reach = np.partition(gap, k - 1, axis=1)[:, k - 1]
    near = np.where(reach[:, None] > 0, gap / np.where(reach > 0, reach, 1)[:, None], np.where(gap > 0, 2.0, 0.0))
    w = np.where(near < 1, (1 - near**3) ** 3, 0.0)
    w[near <= 0.001] = 1.0
    w[near >= 0.999] = 0.0
    w = w * robust
    sw = w.sum(axis=1)
    mx, my = (w @ x) / sw, (w @ y) / sw
    dx = x[None, :] - mx[:, None]
    var = (w * dx**2).sum(axis=1) / sw
    slope = np.where(np.sqrt(var) > 0.001 * (x.max() - x.min()), (w * dx * y[None, :]).sum(axis=1) / sw / np.where(var > 0, var, 1), 0.0)
    return my + slope * (x[at] - mx)


def lowess_fit(x: np.ndarray, y: np.ndarray, span: float = 2 / 3, rounds: int = 3, cells: int = 1_000_000) -> np.ndarray:
    """Locally weighted straight lines (tricube weights over the nearest `span` of the points), `rounds` robust reweightings.

    Points are fitted in blocks, so that at most about `cells` weights are held at once.
    """
    n = len(x)
    if n < 3:
        return y.astype(float)
    k = max(2, min(n, int(span * n + 1e-10)))
    block = max(1, cells // n)
    robust = np.ones(n)
    for it in range(rounds + 1):
        fit = np.concatenate([_local_lines(x, y, slice(i, i + block), k, robust) for i in range(0, n, block)])
        if it == rounds:
            break
        res = np.abs(y - fit)
        cut = 6 * np.median(res)
        if cut < 1e-7 * max(res.mean(), 1e-300):
            break
        u = res / cut
        robust = np.where(u <= 0.001, 1.0, np.where(u >= 0.999, 0.0, (1 - u**2) ** 2))
    return fit


def lowess(df: DataFrame, by: Sequence[str], x: str, y: str, span: float = 2 / 3) -> DataFrame:
    """(by..., x, y, fitted) of each series, in x order. A series is worked on in one task: for summaries, not for raw events."""
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["_x", "_y"]).sort_values("_x", kind="stable")
        pdf["fitted"] = lowess_fit(pdf["_x"].to_numpy(), pdf["_y"].to_numpy(), span)
        return pdf

    ship_package(df.sparkSession)
    d = df.select(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    schema = T.StructType([*d.schema.fields, T.StructField("fitted", T.DoubleType())])
    return d.groupBy(*by).applyInPandas(fit, schema).select(*by, F.col("_x").alias("x"), F.col("_y").alias("y"), "fitted")


def _loess(y: np.ndarray, at: np.ndarray, q: int, degree: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Local polynomial (degree 0 or 1) of y at positions 1..n, evaluated at `at`, over the q nearest points."""
    n = len(y)
    pos = np.arange(1, n + 1, dtype=float)
    gap = np.abs(at[:, None] - pos[None, :])
    k = min(q, n)
    reach = np.sort(gap, axis=1)[:, k - 1]
    if q > n:
        reach = reach + (q - n) // 2
    reach = np.where(reach > 0, reach, 1.0)
    r = gap / reach[:, None]
    w = np.where(r <= 0.999, np.where(r > 0.001, (1 - r**3) ** 3, 1.0), 0.0)
    if weights is not None:
        w = w * weights[None, :]
    sw = w.sum(axis=1)
    w = w / np.where(sw > 0, sw, 1)[:, None]
    out = w @ y
    if degree:
        mean = w @ pos
        dx = pos[None, :] - mean[:, None]
        var = (w * dx**2).sum(axis=1)
        slope = np.where(np.sqrt(var) > 0.001 * max(n - 1, 1), (w * dx) @ y / np.where(var > 0, var, 1), 0.0)
        out = out + slope * (at - mean)
    return out


def stl_decompose(y: np.ndarray, period: int = 12, seasonal: int = 3, inner: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seasonal, trend and remainder by repeated loess (local constants over `seasonal` cycles, local lines for the trend)."""
    n = len(y)
    odd = lambda v: int(v) + (int(v) + 1) % 2
    trend_span = odd(np.ceil(1.5 * period / (1 - 1.5 / seasonal)))
    low_span = odd(period)
    trend = np.zeros(n)
    season = np.zeros(n)
    for _ in range(inner):
        detrended = y - trend
        cycle = np.zeros(n + 2 * period)
        for k in range(period):
            sub = detrended[k::period]
            at = np.arange(0, len(sub) + 2, dtype=float)
            cycle[k :: period][: len(sub) + 2] = _loess(sub, at, seasonal, 0)
        mean = lambda v, m: np.convolve(v, np.ones(m) / m, "valid")
        low = _loess(mean(mean(mean(cycle, period), period), 3), np.arange(1, n + 1, dtype=float), low_span, 1)
        season = cycle[period : period + n] - low
        trend = _loess(y - season, np.arange(1, n + 1, dtype=float), trend_span, 1)
    return season, trend, y - season - trend


def stl(df: DataFrame, by: Sequence[str], time: str, value: str, period: int = 12, seasonal: int = 3) -> DataFrame:
    """(by..., time, value, seasonal, trend, remainder) of each gap-free series of at least two periods; shorter ones give no rows."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_t", kind="stable").reset_index(drop=True)
        if len(pdf) < 2 * period:
            pdf = pdf.iloc[:0]
        y = pdf["_v"].to_numpy(dtype=float)
        s, t, r = stl_decompose(y, period, seasonal) if len(y) else (y, y, y)
        return pdf.assign(seasonal=s, trend=t, remainder=r)

    ship_package(df.sparkSession)
    d = df.select(*by, F.col(time).alias("_t"), F.col(value).cast("double").alias("_v"))
    schema = T.StructType([*d.schema.fields, *[T.StructField(c, T.DoubleType()) for c in ("seasonal", "trend", "remainder")]])
    out = d.groupBy(*by).applyInPandas(run, schema)
    return out.select(*by, F.col("_t").alias(time), F.col("_v").alias(value), "seasonal", "trend", "remainder")


def sample_keys(df: DataFrame, key: str, n: int = 50, seed: str = "") -> DataFrame:
    """n distinct keys in the order of a digest of the key: a random sample that is the same on every run."""
    digest = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")))
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(digest, key).limit(n)


def month_start(ts: str) -> Column:
    return F.date_trunc("month", ts).cast("date")


