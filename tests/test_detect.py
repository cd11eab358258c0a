import datetime as dt
import itertools

import pandas as pd
import pytest
from pyspark.sql import functions as F

from agrolens.operators import detect as D


def _brute_rapid(rows, days):
    """The register's loop: sort by date per (buyer, category); a gap of <= days whole days
    between consecutive purchases flags every row of the group."""
    pdf = pd.DataFrame(rows, columns=["k", "buyer", "item_category", "purchase_date"])
    pdf = pdf[pdf.purchase_date.notna() & pdf.buyer.notna() & pdf.item_category.notna()]
    flagged = set()
    for _, g in pdf.sort_values("purchase_date").groupby(["buyer", "item_category"]):
        d = g.purchase_date.sort_values()
        if any((d.iloc[i + 1] - d.iloc[i]).days <= days for i in range(len(d) - 1)):
            flagged |= set(g.k)
    return flagged


F3 = [
    (1, "a", "c", dt.datetime(2023, 1, 1)), (2, "a", "c", dt.datetime(2023, 1, 31)),            # 30 d: hit
    (3, "b", "c", dt.datetime(2023, 1, 1)), (4, "b", "c", dt.datetime(2023, 1, 31, 23)),        # 30 d 23 h: hit
    (5, "e", "c", dt.datetime(2023, 1, 1)), (6, "e", "c", dt.datetime(2023, 2, 1)),             # 31 d: no
    (7, "f", "c", dt.datetime(2023, 1, 1)), (8, "f", "c", dt.datetime(2023, 3, 1)),
    (9, "f", "c", dt.datetime(2023, 3, 20)),                                                    # 3 rows, one hit
    (10, "g", "c", dt.datetime(2023, 5, 5)), (11, "g", "c", dt.datetime(2023, 5, 5)),           # same day
    (12, "h", "c", dt.datetime(2023, 5, 5)),                                                    # single
    (13, "i", "c", None), (14, "i", "c", dt.datetime(2023, 5, 5)),                              # NULL date
    (15, "j", "c", dt.datetime(2023, 1, 31, 23)), (16, "j", "c", dt.datetime(2023, 3, 2, 22)),  # across buckets
    (17, None, "c", dt.datetime(2023, 1, 1)), (18, None, "c", dt.datetime(2023, 1, 2)),
]


@pytest.mark.parametrize("days", [0, 1, 30])
def test_rapid_repeat_matches_brute_force(spark, days):
    df = spark.createDataFrame(F3, "k int, buyer string, item_category string, purchase_date timestamp")
    got = {r.k for r in D.rapid_repeat(df, days=days).collect()}
    assert got == _brute_rapid(F3, days)


def test_rapid_repeat_random_against_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = []
    for k in range(600):
        rows.append((k, f"b{rnd.randrange(40)}", f"c{rnd.randrange(3)}",
                     dt.datetime(2021, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 900))))
    df = spark.createDataFrame(rows, "k int, buyer string, item_category string, purchase_date timestamp")
    for days in (1, 30):
        assert {r.k for r in D.rapid_repeat(df, days=days).collect()} == _brute_rapid(rows, days)


def test_rapid_repeat_is_wall_clock_in_any_session_zone(spark):
    """Naive (wall-clock) day distances, also when the session zone has DST changes."""
    rows = [(1, "a", "c", dt.datetime(2023, 2, 10)), (2, "a", "c", dt.datetime(2023, 3, 13)),   # 31 d over DST
            (3, "b", "c", dt.datetime(2023, 10, 6)), (4, "b", "c", dt.datetime(2023, 11, 5, 23))]  # 30 d 23 h
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.createDataFrame(rows, "k int, buyer string, item_category string, purchase_date timestamp_ntz")
        assert {r.k for r in D.rapid_repeat(df, days=30).collect()} == _brute_rapid(rows, 30) == {3, 4}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_rapid_repeat_null_buyers_parity(spark):
    df = spark.createDataFrame(F3, "k int, buyer string, item_category string, purchase_date timestamp")
    got = {r.k for r in D.rapid_repeat(df, days=30, null_buyers_as_one=True).collect()}
    assert {17, 18} <= got


def test_duplicate_serials_blanks(spark):
    df = spark.createDataFrame([(1, "S1"), (2, "S1"), (3, None), (4, None), (5, "S2")], "k int, serial_no string")
    assert {r.k for r in D.duplicate_serials(df).collect()} == {1, 2}
    assert {r.k for r in D.duplicate_serials(df, blanks_as_values=True).collect()} == {1, 2, 3, 4}


def test_zscore_global_keeps_rows_and_flags(spark):
    vals = [10.0] * 50 + [1000.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "k int, unit_price double")
    out = D.zscore_global(df).collect()
    assert len(out) == 51 and [r.k for r in out if r.price_stat_anomaly] == [50]
    const = D.zscore_global(spark.createDataFrame([(1, 5.0), (2, 5.0)], "k int, unit_price double")).collect()
    assert all(r.price_zscore is None and r.price_stat_anomaly is False for r in const)


def test_zscore_by_group_constant_and_single(spark):
    rows = [(i, "m", 100.0) for i in range(30)] + [(30, "m", 10000.0), (31, "const", 5.0), (32, "const", 5.0),
                                                   (33, "one", 7.0), (34, None, 1e9)]
    df = spark.createDataFrame(rows, "k int, model string, unit_price double")
    out = D.zscore_by_group(df).collect()
    assert [r.k for r in out] == [30]


def test_residual_anomaly_strict_threshold(spark):
    scored = spark.createDataFrame([(1, 10.0, 7.0), (2, 10.0, 6.9), (3, 10.0, 10.0)],
                                   "k int, actual_price double, predicted_price double")
    m = spark.createDataFrame([(1.0, 1.0)], "mae double, mae_std double")  # threshold 3.0
    assert [r.k for r in D.residual_anomaly(scored, m).collect()] == [2]


def test_alert_if(spark):
    many = spark.createDataFrame([(True,)] * 11 + [(False,)] * 3, "f boolean")
    few = spark.createDataFrame([(True,)] * 10, "f boolean")
    r = D.alert_if(many, "f").collect()
    assert len(r) == 1 and r[0].n == 11 and "11" in r[0].text
    assert D.alert_if(few, "f").count() == 0


def test_forest_walk_equals_plain_walk_and_holds_few_rows_at_a_time():
    import tracemalloc

    import numpy as np
    import pandas as pd

    from agrolens.operators import isolation_forest as I
    rng = np.random.default_rng(3)
    x = np.c_[rng.normal(size=20_000), rng.integers(0, 4, 20_000).astype(float)]
    nodes = pd.DataFrame([n for t in range(60) for n in I._grow(t, x[rng.choice(20_000, 64, False)], 1, 6)],
                         columns=["tree", "node", "feature", "threshold", "left", "right", "size", "depth", "leaf"])
    x[7, 0] = np.nan
    tracemalloc.start()
    (got,) = I._score_batches(iter([pd.DataFrame(x, columns=["a", "b"])]), nodes, ["a", "b"], 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8_000_000  # all rows x trees at once take 10 MB for the places alone

    def path(row, t):
        n = t[t.node == 0].iloc[0]
        while not n.leaf:
            n = t[t.node == (n.left if row[int(n.feature)] < n.threshold else n.right)].iloc[0]
        return n.depth + I._c(n["size"])

    trees = [t for _, t in nodes.groupby("tree")]
    for i in (0, 7, 4095, 4096, 19_999):
        want = np.power(2.0, -np.mean([path(x[i], t) for t in trees]) / I._c(64))
        assert abs(got["iforest_score"][i] - want) < 1e-12
