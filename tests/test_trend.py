import datetime

import numpy as np
import pytest

from agrolens.operators import trend as T


def days(n, noise, seed, bend=0.0):
    rng = np.random.default_rng(seed)
    x = np.arange(n, dtype=float) + 19_000
    line = 50 + 0.05 * np.arange(n) + bend * np.maximum(np.arange(n) - n // 2, 0)
    return x, line, line + rng.normal(0, noise, n)


def test_sparse_fit_meets_the_conditions_of_the_minimum():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(200, 12))
    a[:, 6:] = np.cumsum(a[:, 6:], axis=1)  # strongly correlated, as hinges are
    y = a @ np.r_[1, 2, 0, 0, 0, 0, 0, 3, 0, 0, -2, 0] + rng.normal(size=200)
    g, t = a.T @ a, a.T @ y
    for weight in (0.5, 20.0, 200.0):
        b = T.sparse_fit(g, t, 3, weight)
        slope = g @ b - t
        assert np.abs(slope[:3]).max() < 1e-5
        on = b[3:] != 0
        assert np.abs(slope[3:][on] + weight * np.sign(b[3:][on])).max(initial=0) < 1e-4
        assert (np.abs(slope[3:][~on]) <= weight + 1e-4).all()


def test_a_broken_line_is_followed_within_its_noise():
    x, line, y = days(700, 2.0, 1, bend=0.3)
    out = T.fit_days(x, y, np.ones(700), np.zeros(700), 30)
    got = out["yhat"].to_numpy()
    assert np.sqrt(np.mean((got[:700] - line) ** 2)) < 2.0
    ahead = line[-1] + 0.35 * np.arange(1, 31)
    assert np.abs(got[700:] - ahead).max() < 8.0  # a straight line through all days is off by over 30
    assert abs(np.polyval(np.polyfit(x, y, 1), x[-1] + 30) - ahead[-1]) > 20


def test_the_band_widens_and_holds_what_it_says():
    inside = []
    for seed in range(12):
        x, _, y = days(430, 3.0, seed, bend=0.1 * (seed % 3))
        out = T.fit_days(x[:400], y[:400], np.ones(400), np.zeros(400), 30)
        part = out[out["future"]]
        width = (part["yhat_upper"] - part["yhat_lower"]).to_numpy()
        assert (np.diff(width) > -1e-9).all()
        if seed % 3:
            assert width[-1] > width[0]
        past = out[~out["future"]]
        inside.append(np.mean((y[:400] >= past["yhat_lower"]) & (y[:400] <= past["yhat_upper"])))
    assert 0.75 < np.mean(inside) < 0.85


def test_forecast_groups_and_skipped_groups(spark):
    start = datetime.date(2022, 1, 1)
    rows = [("a", start + datetime.timedelta(days=i % 90), 1.0 + i % 7) for i in range(300)]
    rows += [("b", start, 2.0)] * 12 + [("few", start, 1.0)] * 3 + [("none", None, 1.0)] * 20 + [(None, start, 1.0)] * 20
    df = spark.createDataFrame(rows, "township string, purchase_date date, quantity double")
    got = T.changepoint_forecast(df, periods=10).collect()
    assert {r.township: sum(x.township == r.township for x in got) for r in got} == {"a": 100, "b": 11}
    assert all(np.isfinite([r.yhat, r.yhat_lower, r.yhat_upper]).all() and r.yhat_lower <= r.yhat <= r.yhat_upper for r in got)
    assert [r.yhat for r in got if r.township == "b"] == pytest.approx([2.0] * 11, abs=0.05)
    assert sorted(map(tuple, T.skipped_groups(df).collect())) == [("few", 3, 3, "too few rows"), ("none", 20, 0, "no usable row")]
    assert T.changepoint_forecast(df.limit(0)).count() == 0
