"""Per-group demand forecasts.

``linear_forecast``: least-squares trend per group from the mergeable
``regr_*`` aggregates (skew-proof partial aggregation), evaluated on every
history day of the group plus ``periods`` days after its last day, with an
80 % band from the residual standard error.

``seasonal_forecast``: trend + weekly + yearly Fourier terms, ridge-fitted per
group with ``applyInPandas``. Each group is first reduced to (day, mean, rows)
— weighted least squares on that equals least squares on the raw rows — so a
group's size is bounded by its number of days, not by its number of records.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Z80 = 1.2815515655446004  # two-sided 80 % normal quantile


def _daily(df, group, date, value):
    return (df.where(F.col(group).isNotNull() & F.col(date).isNotNull() & F.col(value).isNotNull())
              .select(group, F.to_date(date).alias("ds"), F.col(value).cast("double").alias("y")))


def linear_forecast(df: DataFrame, group: str = "township", date: str = "purchase_date",
                    value: str = "quantity", periods: int = 30, min_rows: int = 10) -> DataFrame:
    d = _daily(df, group, date, value).withColumn("x", F.unix_date("ds").cast("double"))
    fit = (d.groupBy(group)
             .agg(F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"),
                  F.regr_intercept("y", "x").alias("intercept"), F.regr_sxx("y", "x").alias("sxx"),
                  F.regr_syy("y", "x").alias("syy"), F.regr_sxy("y", "x").alias("sxy"),
                  F.avg("y").alias("ybar"), F.max("ds").alias("last_ds"))
             .where(F.col("n") >= min_rows))
    sse = F.greatest(F.col("syy") - F.col("sxy") * F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0)), F.lit(0.0))
    fit = fit.withColumn("sigma", F.sqrt(sse / F.nullif(F.col("n") - 2, F.lit(0))))
    hist = d.select(group, "ds").distinct()
    fut = fit.select(group, F.explode(F.sequence(F.date_add("last_ds", 1),
                                                 F.date_add("last_ds", periods))).alias("ds"))
    days = hist.join(fit.select(group), group, "left_semi").unionByName(fut)
    p = days.join(fit, group)
    yhat = F.coalesce(F.col("intercept") + F.col("slope") * F.unix_date("ds"), F.col("ybar"))
    band = Z80 * F.coalesce(F.col("sigma"), F.lit(0.0))
    return p.select(group, "ds", F.bround(yhat, 4).alias("yhat"),
                    F.bround(yhat - band, 4).alias("yhat_lower"),
                    F.bround(yhat + band, 4).alias("yhat_upper"))


def _fourier(t_days: np.ndarray, period: float, order: int) -> list:
    cols = []
    for k in range(1, order + 1):
        a = 2 * np.pi * k * t_days / period
        cols += [np.sin(a), np.cos(a)]
    return cols


def _design(t: np.ndarray, t0: float, scale: float) -> np.ndarray:
    tt = (t - t0) / scale
    return np.column_stack([np.ones_like(t), tt] + _fourier(t, 7.0, 3) + _fourier(t, 365.25, 10))


def _fit_group(key, pdf: pd.DataFrame, periods: int, ridge: float) -> pd.DataFrame:
    t = pdf["x"].to_numpy(dtype=float)
    y = pdf["y_mean"].to_numpy(dtype=float)
    w = pdf["w"].to_numpy(dtype=float)
    t0, scale = float(t.min()), max(float(t.max() - t.min()), 1.0)
    X = _design(t, t0, scale)
    sw = np.sqrt(w)
    A = X * sw[:, None]
    b = y * sw
    pen = ridge * np.eye(X.shape[1])
    pen[0, 0] = pen[1, 1] = 0.0  # no shrinkage of level and trend
    beta = np.linalg.solve(A.T @ A + pen, A.T @ b)
    # residual variance on the raw rows: within-day spread + daily means' misfit
    n = float(w.sum())
    fitted = X @ beta
    sse = float((w * (y - fitted) ** 2).sum() + pdf["ss_within"].to_numpy(dtype=float).sum())
    sigma = np.sqrt(sse / max(n - X.shape[1], 1.0))
    future = np.arange(t.max() + 1, t.max() + periods + 1, dtype=float)
    allt = np.concatenate([t, future])
    yhat = _design(allt, t0, scale) @ beta
    return pd.DataFrame({
        "group": [key[0]] * len(allt),
        "ds": pd.to_datetime(allt, unit="D").date,
        "yhat": yhat, "yhat_lower": yhat - Z80 * sigma, "yhat_upper": yhat + Z80 * sigma})


def seasonal_forecast(df: DataFrame, group: str = "township", date: str = "purchase_date",
                      value: str = "quantity", periods: int = 30, min_rows: int = 10,
                      ridge: float = 1.0) -> DataFrame:
    d = _daily(df, group, date, value)
    per_day = (d.groupBy(group, "ds")
                .agg(F.avg("y").alias("y_mean"), F.count(F.lit(1)).alias("w"),
                     F.coalesce(F.var_pop("y") * F.count(F.lit(1)), F.lit(0.0)).alias("ss_within"))
                .withColumn("x", F.unix_date("ds").cast("double")))
    sizes = d.groupBy(group).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= min_rows)
    per_day = per_day.join(sizes.select(group), group, "left_semi")

    def fit(key, pdf):
        try:
            return _fit_group(key, pdf, periods, ridge)
        except (np.linalg.LinAlgError, ValueError):
            # the register skips groups whose fit fails
            return pd.DataFrame({"group": pd.Series([], dtype="object"), "ds": pd.Series([], dtype="object"),
                                 "yhat": pd.Series([], dtype="float64"),
                                 "yhat_lower": pd.Series([], dtype="float64"),
                                 "yhat_upper": pd.Series([], dtype="float64")})

    out = (per_day.select(group, "x", "y_mean", F.col("w").cast("double").alias("w"), "ss_within")
                  .groupBy(group)
                  .applyInPandas(fit, "group string, ds date, yhat double, yhat_lower double, yhat_upper double"))
    return out.withColumnRenamed("group", group)
