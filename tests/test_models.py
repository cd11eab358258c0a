import numpy as np
import pytest
from pyspark.sql import functions as F

from agrolens.operators import models as M
from agrolens.operators.isolation_forest import isolation_forest


def _records(spark, n=400):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        cat = f"c{i % 3}"
        price = 1000.0 * (i % 3 + 1) + float(rng.normal(0, 10))
        rows.append((f"k{i}", "cty", cat, f"m{i % 5}", "p", f"mod{i % 7}", "d", 1.0, price * 0.1, price,
                     None if i % 50 == 0 else __import__("datetime").datetime(2023, 1 + i % 12, 1)))
    return spark.createDataFrame(rows, "record_key string, county string, item_category string, manufacturer string, "
                                       "product_name string, model string, dealer string, quantity double, "
                                       "unit_subsidy double, unit_price double, purchase_date timestamp")


def test_random_forest_pipeline_scores_unseen_levels(spark):
    df = _records(spark)
    model, d = M.fit_price_model(df, M.random_forest(num_trees=5, max_depth=4), with_year=True,
                                 num_cols=M.TIME_NUMERIC)
    assert d.where("purchase_year = 2024").count() > 0  # missing date -> default year, row kept
    spec = M.prepare(df.limit(1), M.BASE_CATEGORICAL, M.TIME_NUMERIC, with_year=True) \
        .withColumn("manufacturer", F.lit("never-seen")).withColumn("purchase_year", F.lit(2026))
    r = M.score(model, spec).first()
    assert r.predicted_price > 0
    imp = M.feature_importance(model, d, 15).collect()
    assert imp and all(x.importance > 0 for x in imp)
    assert any(x.feature.startswith("item_category (") for x in imp)


def test_boosted_early_stopping(spark):
    model, d, best = M.fit_boosted_early_stopping(_records(spark).withColumn("township", F.lit("t")),
                                                  max_iter=8, patience=3, max_depth=3)
    assert 1 <= best <= 8
    assert M.score(model, d).count() == d.count()
    none_model, _, _ = M.fit_boosted_early_stopping(_records(spark, 20).withColumn("township", F.lit("t")))
    assert none_model is None


def test_isolation_forest_flags_outliers(spark):
    rng = np.random.default_rng(5)
    rows = [(f"k{i}", float(rng.normal(100, 5)), float(rng.normal(10, 1))) for i in range(2000)]
    rows += [("out1", 1000.0, 10.0), ("out2", 100.0, 500.0)]
    df = spark.createDataFrame(rows, "record_key string, a double, b double")
    out = isolation_forest(df, ["a", "b"], n_trees=50).collect()
    flagged = {r.record_key for r in out if r.iforest_anomaly}
    assert {"out1", "out2"} <= flagged
    assert abs(len(flagged) - 0.02 * len(rows)) <= 2
    assert all(r.iforest_label == (-1 if r.iforest_anomaly else 1) for r in out)


def test_encoder_refuses_a_vocabulary_beyond_its_limit(spark):
    from pyspark.ml.feature import StringIndexer
    df = _records(spark)
    cats, nums = ["manufacturer", "model"], ["quantity"]
    full = StringIndexer(inputCols=cats, outputCols=[f"{c}__idx" for c in cats],
                         stringOrderType="alphabetAsc", handleInvalid="keep").fit(df)
    enc = M.fit_encoders(df, cats, nums, "indexed", max_levels=7)
    assert [list(x) for x in enc.stages[0].labelsArray] == [list(x) for x in full.labelsArray]
    with pytest.raises(ValueError, match="model has over 6 levels"):
        M.fit_encoders(df, cats, nums, "indexed", max_levels=6)


def test_specs_without_price_are_priced_one_to_one(spark):
    df = _records(spark)
    model, d = M.fit_price_model(df, M.random_forest(num_trees=3, max_depth=3), with_year=True, num_cols=M.TIME_NUMERIC)
    specs = df.limit(5).select("record_key", *M.BASE_CATEGORICAL, *M.BASE_NUMERIC).withColumn("dealer", F.lit(None).cast("string"))
    with pytest.raises(ValueError, match="purchase_year"):
        M.prepare_specs(specs, M.BASE_CATEGORICAL, M.TIME_NUMERIC)
    ready = M.prepare_specs(specs.withColumn("purchase_year", F.lit(2026)), M.BASE_CATEGORICAL, M.TIME_NUMERIC)
    out = M.score(model, ready)
    assert out.columns == [*ready.columns, "predicted_price"] and out.where("predicted_price > 0").count() == 5


def test_load_or_train_never_overwrites(spark, tmp_path):
    df = _records(spark)
    model, _ = M.fit_price_model(df, M.random_forest(num_trees=2, max_depth=2))
    path = str(tmp_path / "model")
    M.load_or_train(path, lambda: model)
    again = M.load_or_train(path, lambda: pytest.fail("trained again"))
    assert len(again.stages) == len(model.stages)
    other = tmp_path / "other"
    other.mkdir()
    (other / "file").write_text("x")
    with pytest.raises(Exception):
        M.load_or_train(str(other), lambda: pytest.fail("trained over a foreign folder"))
    assert (other / "file").read_text() == "x"


def test_forest_candidates_follow_the_documented_sample(spark):
    from agrolens.operators.isolation_forest import tree_candidates
    d = spark.range(1_000_000).withColumnRenamed("id", "key").withColumn("f", F.lit(0.0))
    n = spark.createDataFrame([(1_000_000,)], "_n long")
    c = tree_candidates(d, "key", ["f"], n, F.least(F.lit(1.0), F.lit(4.0 * 256) / F.col("_n")), 200, 42)
    r = c.agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("low"), F.count_distinct("tree").alias("trees")).first()
    assert abs(r.n - 200 * 1024) < 0.1 * 200 * 1024 and r.low >= 0 and r.trees == 200
