import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from agrolens.operators.features import (category_means, hash_bucket, ordered_target_encoding,
                                         regression_metrics, split_train_test)
from agrolens.operators.forecast import linear_forecast, seasonal_forecast


def test_split_stable_under_repartition(spark):
    df = spark.range(0, 5000).select(F.md5(F.col("id").cast("string")).alias("record_key"))
    a = {r.record_key for r in split_train_test(df).where("is_test").collect()}
    b = {r.record_key for r in split_train_test(df.repartition(13)).where("is_test").collect()}
    assert a == b and 0.17 < len(a) / 5000 < 0.23


@pytest.mark.parametrize("split_hex", [None, 0, 1, 2])
def test_ordered_target_encoding_brute_force(spark, split_hex):
    rng = np.random.default_rng(3)
    rows = [(f"k{i}", f"c{rng.integers(0, 4)}", float(rng.integers(0, 100))) for i in range(400)]
    df = spark.createDataFrame(rows, "record_key string, cat string, y double")
    got = {r.record_key: r.cat_enc for r in ordered_target_encoding(df, "cat", "y", split_hex=split_hex).collect()}
    pdf = pd.DataFrame(rows, columns=["record_key", "cat", "y"])
    import hashlib
    pdf["h"] = [hashlib.md5(k.encode()).hexdigest() for k in pdf.record_key]
    prior = pdf.y.mean()
    for _, g in pdf.sort_values("h").groupby("cat"):
        s = n = 0.0
        for _, r in g.iterrows():
            assert got[r.record_key] == pytest.approx((s + prior) / (n + 1))
            s += r.y
            n += 1


def test_category_means_and_metrics(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "cat string, y double")
    m = {r.cat: r.cat_enc for r in category_means(df, "cat", "y", prior=0.0).collect()}
    assert m == {"a": 4.0 / 3, "b": 2.5}
    sc = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "actual_price double, predicted_price double")
    r = regression_metrics(sc).first()
    assert r.mae == pytest.approx(2 / 3) and r.mse == pytest.approx(2 / 3)
    assert r.mae_std == pytest.approx(float(np.std([1, 0, 1])))


def _demand(spark):
    rows = []
    base = dt.date(2023, 1, 1)
    for i in range(60):
        d = base + dt.timedelta(days=i)
        rows.append(("line", dt.datetime.combine(d, dt.time()), 2.0 * i + 1))
        rows.append(("line", dt.datetime.combine(d, dt.time(12)), 2.0 * i + 1))  # repeated day
    rows += [("small", dt.datetime(2023, 1, d + 1), 1.0) for d in range(9)]        # 9 rows: skipped
    rows += [("const", dt.datetime(2023, 1, d + 1), 4.0) for d in range(10)]
    rows += [("line", None, 3.0), ("line", dt.datetime(2023, 1, 1), None)]
    return spark.createDataFrame(rows, "township string, purchase_date timestamp, quantity double")


def test_linear_forecast_continues_a_line(spark):
    out = linear_forecast(_demand(spark)).collect()
    groups = {r.township for r in out}
    assert groups == {"line", "const"}
    line = sorted((r.ds, r.yhat) for r in out if r.township == "line")
    assert len(line) == 90
    last = line[-1]
    assert last[0] == dt.date(2023, 1, 1) + dt.timedelta(days=89)
    assert last[1] == pytest.approx(2.0 * 89 + 1, abs=1e-6)
    assert all(r.yhat == pytest.approx(4.0) for r in out if r.township == "const")


def test_seasonal_forecast_shape(spark):
    out = seasonal_forecast(_demand(spark)).collect()
    line = [r for r in out if r.township == "line"]
    assert len(line) == 90 and {r.township for r in out} == {"line", "const"}
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in out)
    end = max(line, key=lambda r: r.ds)
    assert end.yhat == pytest.approx(2.0 * 89 + 1, rel=0.05)


def test_seasonal_forecast_skips_failing_group(spark):
    # ten purchases on one single day: trend column is constant -> singular fit -> group skipped
    rows = [("oneday", dt.datetime(2023, 1, 1), float(i)) for i in range(10)]
    rows += [("ok", dt.datetime(2023, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "township string, purchase_date timestamp, quantity double")
    out = seasonal_forecast(df).collect()
    assert {r.township for r in out} <= {"ok", "oneday"}
    assert any(r.township == "ok" for r in out)


def test_ordered_statistics_in_several_orders(spark):
    import hashlib

    from agrolens.operators.features import ordered_target_orders
    rows = [(f"k{i}", None if i % 11 == 0 else "hot" if i % 3 else f"x{i % 5}", f"m{i % 2}", float(i * i % 97)) for i in range(120)]
    df = spark.createDataFrame(rows, "record_key string, a string, b string, y double")
    prior = sum(r[3] for r in rows) / len(rows)
    for hexes in (0, 1, 2):
        got = {r.record_key: r for r in ordered_target_orders(df, ["a", "b"], "y", orders=3, split_hex=hexes).collect()}
        assert len(got) == len(rows)
        for o in range(3):
            for c, name in ((1, "a"), (2, "b")):
                seen = {}
                for r in sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}:{o}".encode()).hexdigest()):
                    s, n = seen.get(r[c], (0.0, 0))
                    assert abs(got[r[0]][f"{name}_enc{o}"] - (s + prior) / (n + 1)) < 1e-9
                    seen[r[c]] = (s + r[3], n + 1)


def test_ordered_target_columns_equal_the_single_ones_for_any_slices(spark):
    from agrolens.operators.features import ordered_target_columns
    rows = [(f"k{i}", "hot" if i % 3 else f"c{i}", f"d{i % 7}", float(i * i % 101) if i % 11 else None) for i in range(400)]
    df = spark.createDataFrame(rows, "record_key string, a string, b string, y double").repartition(3)
    want = {}
    for c in "ab":
        for r in ordered_target_encoding(df, c, "y", prior=7.0, split_hex=0).collect():
            want[r.record_key, c] = r[f"{c}_enc"]
    for slices in (1, 5, 64):
        got = ordered_target_columns(df, ["a", "b"], "y", "record_key", 7.0, slices)
        assert got.columns == [*df.columns, "a_enc", "b_enc"]
        plan = got._jdf.queryExecution().executedPlan().toString()
        found = got.collect()
        assert len(found) == 400
        assert all(abs(r[f"{c}_enc"] - want[r.record_key, c]) < 1e-9 for r in found for c in "ab")
        # one shuffle of the rows, whatever the number of columns; the others are of totals and extra rows
        assert plan.count("REPARTITION_BY_COL") == 1 and "SortMergeJoin" not in plan


def test_orders_of_repeated_keys_and_no_rows(spark):
    from agrolens.operators.features import ordered_target_orders
    df = spark.createDataFrame([("k1", "x", 1.0), ("k1", "x", 1.0), ("k2", None, 3.0)], "record_key string, a string, y double")
    got = {r.record_key: (r.a_enc0, r.a_enc1) for r in ordered_target_orders(df, ["a"], "y", orders=2, prior=2.0).collect()}
    assert got == {"k1": (2.0, 2.0), "k2": (2.0, 2.0)}
    assert ordered_target_orders(df.limit(0), ["a"], "y", orders=2).collect() == []


def test_slices_are_summed_without_windows_and_exactly(spark):
    """Before: one window, sorted by level and hash, over all rows for every column."""
    import math

    import numpy as np

    from agrolens.operators.features import _sums_before, ordered_target_columns
    df = spark.createDataFrame([(f"k{i}" if i % 5 else None, f"c{i % 3}", 0.1 * i) for i in range(50)], "record_key string, a string, y double")
    got = ordered_target_columns(df, ["a"], "y", "record_key", 7.0, 1)
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 50 and got.where("a_enc is null").count() == 0
    assert ordered_target_columns(df, ["a"], "y", "record_key", 7.0, 1, keep=["y"]).columns == ["y", "a_enc"]
    rng = np.random.default_rng(3)
    y, codes = rng.random(5000) * 10.0 ** rng.integers(-6, 6, 5000), np.sort(rng.integers(0, 300, 5000))
    sums = _sums_before(y, codes)
    for k in range(300):
        mine = np.flatnonzero(codes == k)
        for j, i in enumerate(mine):
            assert sums[i] == pytest.approx(math.fsum(y[mine[:j]]), rel=1e-14, abs=1e-18)
    y[10] = np.inf
    spoiled = _sums_before(y, codes)
    assert np.isfinite(spoiled[codes != codes[10]]).all() and np.isinf(spoiled[11:][codes[11:] == codes[10]]).all()
