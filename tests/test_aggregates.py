import numpy as np
import pytest
from pyspark.sql import functions as F

from agrolens.operators import aggregates as A
from agrolens.operators.quantiles import exact_quantiles


def test_county_stats_nulls_and_half_even(spark):
    df = spark.createDataFrame(
        [("a", 0.125), ("a", None), ("b", None), (None, 5.0), ("c", 1.0), ("c", 1.25)],
        "county string, unit_subsidy double")
    out = {r.county: r for r in A.county_stats(df).collect()}
    assert set(out) == {"a", "b", "c"}           # NULL key dropped
    assert out["a"].total_subsidy == 0.12         # half-even, like pandas
    assert out["a"].equipment_count == 1          # non-null count
    assert out["b"].total_subsidy == 0.0 and out["b"].average_subsidy is None  # sum of nothing = 0
    assert out["c"].average_subsidy == 1.12


def test_frequency_share_counts_null_rows_in_total(spark):
    df = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "item_category string")
    out = {r.item_category: r.share_pct for r in A.frequency_share(df).collect()}
    assert out == {"x": 50.0, "y": 25.0}


def test_top_n_share_sums_to_100(spark):
    df = spark.createDataFrame([(f"k{i % 13}", float(i)) for i in range(200)], "item_category string, quantity double")
    rows = A.top_n_share(df, n=10).collect()
    assert len(rows) == 10
    assert abs(sum(r.pct for r in rows) - 100) < 0.1


def test_histogram_bins_sum_to_count(spark):
    vals = [float(v) for v in np.random.default_rng(1).normal(100, 20, 500)]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "unit_price double")
    h = A.histogram(df).orderBy("bin").collect()
    assert len(h) == 50 and sum(r.bin_count for r in h) == 500
    expected, _ = np.histogram(vals, bins=50)
    assert [r.bin_count for r in h] == expected.tolist()
    const = A.histogram(spark.createDataFrame([(3.0,), (3.0,)], "unit_price double")).collect()
    assert sum(r.bin_count for r in const) == 2 and len(const) == 50


@pytest.mark.parametrize("n", [1, 2, 7, 1000])
def test_exact_quantiles_match_numpy(spark, n):
    rng = np.random.default_rng(n)
    vals = np.round(rng.normal(0, 10, n), 1)  # ties on purpose
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.98, 1.0]
    got = exact_quantiles(df, "x", probs, accuracy=50).first()  # tiny accuracy: wide slices
    for i, p in enumerate(probs):
        assert got[f"q{i}"] == pytest.approx(float(np.percentile(vals, p * 100)), abs=1e-9)


def test_exact_quantiles_by_group(spark):
    data = [("a", float(i)) for i in range(11)] + [("b", 5.0)]
    df = spark.createDataFrame(data, "g string, x double")
    got = {r.g: r.q0 for r in exact_quantiles(df, "x", [0.5], group_cols=["g"]).collect()}
    assert got == {"a": 5.0, "b": 5.0}


def test_describe(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 10.0]
    r = A.describe(spark.createDataFrame([(v,) for v in vals] + [(None,)], "unit_price double")).first()
    assert r["count"] == 5 and r.p25 == 2.0 and r.p50 == 3.0 and r.p75 == 4.0 and r["max"] == 10.0
    assert r["std"] == pytest.approx(float(np.std(vals, ddof=1)), abs=1e-4)


def test_top_performers_and_ols(spark):
    df = spark.createDataFrame(
        [("c1", "m1", "x", 10.0, 1.0, 2.0), ("c1", "m1", "y", 30.0, 2.0, 4.0), ("c1", "m2", "x", 20.0, 1.0, 6.0),
         ("c2", "m1", "x", 5.0, 1.0, 1.0)],
        "item_category string, manufacturer string, model string, unit_price double, quantity double, unit_subsidy double")
    tp = A.top_performers(df, n=2, category="c1").collect()
    assert [(r.manufacturer, r.model) for r in tp] == [("m1", "y"), ("m2", "x")]
    ols = {r.item_category: r for r in A.ols_by_group(df).collect()}
    assert ols["c1"].n == 3


def test_seeded_sample_is_partition_independent(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("record_key"))
    a = sorted(r.record_key for r in A.seeded_sample(df, 100).collect())
    b = sorted(r.record_key for r in A.seeded_sample(df.repartition(7), 100).collect())
    assert a == b and len(a) == 100
