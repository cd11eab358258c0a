"""M13 with a trend that may change: hinges at changepoints, sparse penalty, bands that widen.

Each group is reduced to one row a day by native aggregates first, so what a task fits is
bounded by the group's days and not by its records. The trend is a line plus hinges at CHANGEPOINTS places,
spread evenly over the first 80 % of the days; weekly and yearly terms are added
where the history holds two weeks or years. The slope changes carry an L1 penalty
(only those that the data ask for stay), the seasonal terms a small quadratic one, level and slope none.

The band holds the residual error and, in the future, the trend's own: changes go on at the rate of the
changepoints, as large on average as the fitted ones, so their variance grows with the cube of the horizon.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolens.operators.forecast import Z80, _daily, _fourier

CHANGEPOINTS = 25
RANGE = 0.8        # part of the history that may hold changepoints
SCALE = 0.05       # prior scale of a slope change (of the scaled target over the whole history)
RIDGE = 0.01       # quadratic penalty of the seasonal terms
_SWEEPS = 20_000


def sparse_fit(gram: np.ndarray, target: np.ndarray, free: int, weight: float) -> np.ndarray:
    """Coefficients b that minimise b'Gb / 2 - b't + weight * sum |b[free:]|.

    The first ``free`` coefficients carry no penalty and are eliminated; the others are found by
    cyclic coordinate descent.
    """
    guu, gud, gdd = gram[:free, :free], gram[:free, free:], gram[free:, free:]
    inner = np.linalg.pinv(guu)
    a = gdd - gud.T @ inner @ gud
    t = target[free:] - gud.T @ inner @ target[:free]
    d = np.zeros(len(t))
    left = t.copy()  # t - a @ d
    diagonal = np.diag(a)
    limit = 1e-10 * max(float(np.abs(t).max(initial=0.0)), 1e-300)
    for _ in range(_SWEEPS if weight > 0 else 0):
        moved = 0.0
        for j in range(len(d)):
            if diagonal[j] <= 1e-12 * max(float(diagonal.max()), 1e-300):
                continue
            raw = left[j] + diagonal[j] * d[j]
            new = np.sign(raw) * max(abs(raw) - weight, 0.0) / diagonal[j]
            if new != d[j]:
                step = new - d[j]
                left -= a[:, j] * step
                moved = max(moved, abs(step) * diagonal[j])
                d[j] = new
        if moved <= limit:
            break
    return np.concatenate([inner @ (target[:free] - gud @ d), d])


def _columns(x: np.ndarray, t: np.ndarray, points: np.ndarray, span: float) -> np.ndarray:
    """Level, slope, seasons (days x) of which the history holds two at least, hinges (scaled time t)."""
    seasons = (_fourier(x, 7.0, 3) if span >= 14 else []) + (_fourier(x, 365.25, 10) if span >= 730 else [])
    return np.column_stack([np.ones_like(t), t, *seasons, *[np.maximum(t - c, 0.0) for c in points]])


def fit_days(x, y, w, within, periods: int, changepoints: int = CHANGEPOINTS, scale: float = SCALE) -> pd.DataFrame:
    """Fit one group's days (day numbers, means, rows, within-day sums of squares): history and ``periods`` days."""
    order = np.argsort(x)
    x, y, w, within = (np.asarray(v, dtype=float)[order] for v in (x, y, w, within))
    first, span = x[0], max(x[-1] - x[0], 1.0)
    size = max(float(np.abs(y).max()), 1e-12)
    t = (x - first) / span
    n_points = min(changepoints, max(len(x) - 2, 0))
    points = np.linspace(0, RANGE, n_points + 1)[1:]
    cols = _columns(x, t, points, span)
    free = cols.shape[1] - n_points
    rows = float(w.sum())
    gram, target = cols.T @ (cols * w[:, None]), cols.T @ (w * y / size)
    gram[range(2, free), range(2, free)] += RIDGE * rows

    def noise(b):
        sse = float((w * (y / size - cols @ b) ** 2).sum() + within.sum() / size ** 2)
        return np.sqrt(sse / max(rows - 2 - np.count_nonzero(b[2:]), 1.0))

    b = sparse_fit(gram, target, free, 0.0)  # a straight line tells the noise that weighs the penalty
    for _ in range(3):
        sigma = max(noise(b), 1e-9)
        b = sparse_fit(gram, target, free, sigma * sigma / scale)
    sigma = noise(b)
    future = x[-1] + 1 + np.arange(periods)
    days = np.concatenate([x, future])
    at = (days - first) / span
    mean = _columns(days, at, points, span) @ b
    ahead = np.maximum(at - 1.0, 0.0)
    change = float(np.abs(b[free:]).mean()) if n_points else 0.0
    trend_variance = (n_points / RANGE) * 2 * change ** 2 * ahead ** 3 / 3  # Laplace changes of that mean size
    band = Z80 * np.sqrt(sigma ** 2 + trend_variance)
    return pd.DataFrame({"ds": pd.to_datetime(days, unit="D").date, "yhat": mean * size, "yhat_lower": (mean - band) * size,
                         "yhat_upper": (mean + band) * size, "future": days > x[-1]})


def changepoint_forecast(df: DataFrame, group: str = "township", date: str = "purchase_date", value: str = "quantity",
                         periods: int = 30, min_rows: int = 10, changepoints: int = CHANGEPOINTS, scale: float = SCALE) -> DataFrame:
    """(group, ds, yhat, yhat_lower, yhat_upper, future) of every day of history and ``periods`` days after it.

    Groups that get no forecast are listed by ``skipped_groups``. NULL groups, dates and values take no part.
    """
    d = _daily(df, group, date, value).withColumnRenamed(group, "__group")
    day = (d.groupBy("__group", "ds").agg(F.avg("y").alias("y"), F.count(F.lit(1)).cast("double").alias("w"),
                                          F.coalesce(F.var_pop("y") * F.count(F.lit(1)), F.lit(0.0)).alias("within")))
    enough = d.groupBy(F.col("__group").alias("__g")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)
    day = day.join(enough, F.col("__group") == F.col("__g"), "left_semi").withColumn("x", F.unix_date("ds").cast("double"))
    kind = d.schema["__group"].dataType.simpleString()

    def fit(key, days):
        out = fit_days(days["x"], days["y"], days["w"], days["within"], periods, changepoints, scale)
        out.insert(0, "__group", key[0])
        return out

    return (day.select("__group", "x", "y", "w", "within").groupBy("__group")
            .applyInPandas(fit, f"__group {kind}, ds date, yhat double, yhat_lower double, yhat_upper double, future boolean")
            .withColumnRenamed("__group", group))


def skipped_groups(df: DataFrame, group: str = "township", date: str = "purchase_date", value: str = "quantity",
                   min_rows: int = 10) -> DataFrame:
    """(group, n_rows, usable_rows, reason) of groups without a forecast: under ``min_rows`` rows with a date and a value."""
    usable = F.count(F.when(F.col(date).isNotNull() & F.col(value).isNotNull(), 1))
    return (df.where(F.col(group).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n_rows"), usable.alias("usable_rows"))
            .where(F.col("usable_rows") < min_rows)
            .withColumn("reason", F.when(F.col("usable_rows") == 0, "no usable row").otherwise("too few rows")))
