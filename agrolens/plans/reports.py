"""End-to-end workflows of the register, as compositions of the operators.

Each returns named lazy DataFrames or writes them (one sub-folder per table);
nothing is collected except model metadata and the alert count.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolens.functions.clean import safe_key
from agrolens.operators import aggregates as A
from agrolens.operators import detect as D
from agrolens.schema import PENDING_STATUS
from agrolens.sources.sinks import summary_document, write_report, write_table


def group_report(df: DataFrame) -> dict:
    """§3.1: item distribution, county statistics, monthly trend, manufacturer top-20 table."""
    return {"item_distribution": A.frequency_share(df, "item_category"),
            "county_stats": A.county_stats(df),
            "monthly_stats": A.monthly_stats(df),
            "manufacturer_top20": A.manufacturer_table(df)}


def dashboard_tables(df: DataFrame, pending: str = PENDING_STATUS) -> dict:
    """Wall dashboard: KPI card and the six aggregates behind its charts."""
    return {"kpi": A.kpi_card(df, pending=pending),
            "category_quantity": A.sum_by(df, "item_category"),
            "county_quantity": A.with_max(A.sum_by(df, "county"), "quantity", "max_quantity"),
            "daily_quantity": A.daily_sum(df),
            "status_quantity": A.sum_by(df, "status"),
            "buyer_quantity": A.sum_by(df, "buyer"),
            "top10_category_share": A.top_n_share(df, "item_category", "quantity", 10)}


def monitoring_run(spark: SparkSession, df: DataFrame, outdir: str, fmt: str = "csv",
                   iforest_trees: int = 200, boost_rounds: int = 1000, forecast_days: int = 30,
                   alert_min: int = 10) -> dict:
    """§3.2 all-in-one run: summary, counts, duplicates, rapid repeats, z-scores, isolation
    forest, boosted price model with test predictions, per-township forecasts (one folder
    per township), and the alert payload computed from the written isolation-forest table
    (the register's hand-over through storage). Both models are saved in new folders
    (``iforest_model-<id>``, ``price_model-<id>``). Returns {name: path} plus 'alert_count'."""
    import uuid

    from agrolens.operators.forecast import seasonal_forecast
    from agrolens.operators.isolation_forest import fit_isolation_forest
    from agrolens.operators.target_model import fit_boosted_target_model

    out = {}

    def save(name, write):
        out[name] = os.path.join(outdir, f"{name}-{uuid.uuid4().hex[:12]}")
        write(out[name])

    def put(name, table, partition_by=None):
        p = os.path.join(outdir, name)
        write_table(table, p, fmt if name != "summary" else "json", partition_by=partition_by)
        out[name] = p

    put("summary", summary_document(df))
    put("region_counts", A.top_by_count(df, "township", None))
    put("item_counts", A.top_by_count(df, "item_category", None))
    put("dup_serials", D.duplicate_serials(df, blanks_as_values=False))
    put("suspicious_quick_repeat", D.rapid_repeat(df, days=30))
    put("price_zscore_results", D.zscore_global(df))
    feats = [c for c in ["unit_price", "unit_subsidy", "total_subsidy", "quantity"] if c in df.columns]
    forest = fit_isolation_forest(df, feats, n_trees=iforest_trees)
    save("iforest_model", lambda path: forest.save(spark, path))
    put("iforest_results", forest.score(df))
    model, d, best = fit_boosted_target_model(df, max_iter=boost_rounds)
    if model is not None:
        save("price_model", model.save)
        preds = model.score(d.where(F.col("is_test")))
        put("price_model_test_preds",
            preds.select("record_key", "item_category", "manufacturer", "model", "township", "dealer",
                         "quantity", F.col("predicted_price").alias("pred"), F.col("actual_price").alias("actual")))
    fc = seasonal_forecast(df, "township", periods=forecast_days).withColumn("file_key", safe_key("township"))
    put("ts", fc, partition_by=["file_key"])
    reader = spark.read.option("header", True) if fmt == "csv" else spark.read
    handed = reader.format(fmt).load(out["iforest_results"])
    flag = F.lower(F.col("iforest_anomaly").cast("string")) == "true"
    alert = D.alert_if(handed.withColumn("_flag", flag), "_flag", alert_min)
    put("alert", alert)
    out["alert_count"] = handed.where(flag).count()
    return out


def price_platform_run(spark: SparkSession, df: DataFrame, model_path: str, category: str | None = None,
                       num_trees: int = 100, max_depth: int = 10, top_n: int = 5) -> dict:
    """§3.3: reuse a saved forest or train one (year feature), evaluate on the held-out part,
    price next-year specs, importances, residual anomalies over all rows, top performers."""
    from agrolens.operators import models as M
    from agrolens.operators.features import regression_metrics, split_train_test
    from agrolens.operators.target_model import TargetModel, fit_target_model, load_target_model

    cats, nums = M.BASE_CATEGORICAL, M.TIME_NUMERIC
    d = None

    def train():
        nonlocal d
        m, d = fit_target_model(df, M.random_forest(num_trees, max_depth), cats, nums, with_year=True)
        return m

    model = M.load_or_train(model_path, train, load=lambda path: load_target_model(spark, path), save=TargetModel.save)
    if d is None:
        d = split_train_test(M.prepare(df, cats, nums, with_year=True))
    scored = model.score(d)
    metrics = regression_metrics(scored.where(F.col("is_test")))
    specs = d.where(F.col("is_test")).drop(M.TARGET).withColumn("purchase_year", F.lit(2026))
    anomalies = D.top_rows(D.residual_anomaly(scored, metrics), "prediction_error", 10)
    return {"metrics": metrics,
            "next_year_prices": model.score(specs).select("record_key", *cats, "purchase_year", "predicted_price"),
            "feature_importance": model.importance(15),
            "residual_anomalies": anomalies.select("county", "item_category", "manufacturer", "dealer",
                                                   "actual_price", "predicted_price", "price_difference"),
            "top_performers": A.top_performers(df, n=top_n, category=category)}


def write_named(tables: dict, outdir: str, fmt: str = "parquet") -> dict:
    """S8 for any of the dicts above."""
    return write_report({k: v for k, v in tables.items() if isinstance(v, DataFrame)}, outdir, fmt)
