import os
import tempfile

from agrolens.plans import reports as R
from agrolens.records import records
from tests.conftest import SF_SMALL


def test_group_report_and_dashboard(spark):
    r = records(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="agrolens-report-")
    paths = R.write_named({**R.group_report(r), **R.dashboard_tables(r, pending="P")}, d)
    assert len(paths) == 11 and all(os.path.isdir(p) for p in paths.values())
    assert spark.read.parquet(paths["kpi"]).count() == 1


def test_monitoring_run(spark):
    r = records(spark, SF_SMALL)
    d = tempfile.mkdtemp(prefix="agrolens-monitor-")
    out = R.monitoring_run(spark, r, d, iforest_trees=20, boost_rounds=5)
    for name in ["iforest_model", "price_model", "summary", "region_counts", "item_counts", "dup_serials", "suspicious_quick_repeat",
                 "price_zscore_results", "iforest_results", "price_model_test_preds", "ts", "alert"]:
        assert os.path.isdir(out[name]), name
    assert out["alert_count"] > 10  # ~2 % of 6000 rows
    assert any(n.startswith("file_key=") for n in os.listdir(out["ts"]))


def test_price_platform_run_reuses_saved_model(spark):
    r = records(spark, SF_SMALL)
    path = os.path.join(tempfile.mkdtemp(prefix="agrolens-model-"), "rf")
    first = R.price_platform_run(spark, r, path, num_trees=5, max_depth=4)
    assert first["metrics"].first().n > 0 and os.path.isdir(path)
    again = R.price_platform_run(spark, r, path, num_trees=5, max_depth=4)  # loads, no retrain
    assert again["next_year_prices"].count() == first["next_year_prices"].count()
    assert again["residual_anomalies"].count() <= 10
    assert again["top_performers"].count() > 0
