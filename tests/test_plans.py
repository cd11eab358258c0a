"""Physical-plan properties that matter at scale (checked on the sf0.001 tables)."""

import re

import pytest

import __spark_entry__ as E
from agrolens.operators import detect as D
from agrolens.operators.quantiles import exact_quantiles
from agrolens.records import records, records_join
from tests.conftest import SF_SMALL


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns_and_pushes_filters(spark):
    p = plan(E.queries()["county_subsidy_stats"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert schemas and all(set(s.split(",")) == {"county:string", "unit_subsidy:double"} for s in schemas)
    assert "IsNotNull(county)" in p
    assert "partial_sum" in p  # map-side partial aggregation before the shuffle


@pytest.mark.parametrize("name", ["model_price_outliers_top10", "duplicate_serials", "price_zscore",
                                  "residual_anomalies_top10"])
def test_no_window_over_unbounded_keys(spark, name):
    assert "Window" not in plan(E.queries()[name](spark, SF_SMALL))


def test_rapid_repeat_window_runs_over_bucket_aggregates(spark):
    p = plan(D.rapid_repeat(records(spark, SF_SMALL)))
    assert "Window" in p
    window_input = p[p.index("Window"):]
    assert "partial_min" in window_input and "partial_max" in window_input


def test_global_stats_are_broadcast_not_global_windows(spark):
    p = plan(E.queries()["price_zscore"](spark, SF_SMALL))
    assert "BroadcastNestedLoopJoin" in p or "BroadcastExchange" in p
    assert "Window" not in p
    # the only single-partition exchange carries one-row partial aggregate buffers
    for m in re.finditer(r"Exchange SinglePartition.*\n\s*\+- HashAggregate\(keys=\[\], functions=\[([^\]]*)", p):
        assert "partial_" in m.group(1)


def test_exact_quantiles_do_not_buffer_the_column(spark):
    p = plan(exact_quantiles(records(spark, SF_SMALL), "unit_price", [0.5], accuracy=10_000))
    assert "percentile_approx" in p
    assert not re.search(r"\bpercentile\(", p)


def test_record_join_broadcasts_only_the_fixed_nation_table(spark):
    logical = records_join(spark, SF_SMALL)._jdf.queryExecution().analyzed().toString()
    hints = re.findall(r"ResolvedHint .*broadcast", logical)
    assert len(hints) == 1
