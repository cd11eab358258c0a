from conftest import SF_SMALL
from pyspark.sql import functions as F

from agrolens import records as R
from agrolens.functions.clean import with_row_index
from agrolens.operators import vocabulary as V


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_asked_columns_are_written_and_rows_are_those_of_the_join(spark, monkeypatch):
    monkeypatch.setattr(R, "_MATERIALIZED", {})
    narrow = R.records(spark, SF_SMALL, columns=["unit_price", "record_key"])
    (path,) = next(iter(R._MATERIALIZED.values())).values()
    assert narrow.columns == ["unit_price", "record_key"]
    assert set(spark.read.parquet(path).columns) == {"unit_price", "record_key"}
    whole = R.records(spark, SF_SMALL, materialize=False)
    assert whole.columns == list(R.RECORD_COLUMNS)
    assert narrow.exceptAll(whole.select("unit_price", "record_key")).isEmpty() and narrow.count() == whole.count()
    R.records(spark, SF_SMALL, columns=["unit_price"])  # held by the written view
    assert len(next(iter(R._MATERIALIZED.values()))) == 1


def test_keys_without_match_and_repeated_dimension_keys(spark, tmp_path):
    for name in ("lineitem", "orders", "customer", "nation", "part", "supplier"):
        t = spark.read.parquet(f"{SF_SMALL}/{name}.parquet")
        if name == "supplier":
            t = t.where("s_suppkey > 2").unionByName(t.where("s_suppkey = 3"))
        if name == "lineitem":
            t = t.limit(500).withColumn("l_orderkey", F.when(F.col("l_linenumber") != 1, F.col("l_orderkey")))
        t.write.parquet(str(tmp_path / f"{name}.parquet"))
    li, supp = spark.read.parquet(str(tmp_path / "lineitem.parquet")), spark.read.parquet(str(tmp_path / "supplier.parquet"))
    got = R.records_join(spark, str(tmp_path))
    assert got.count() == li.count() + li.where("l_suppkey = 3").count()
    assert got.where("dealer is null").count() == li.join(supp, li.l_suppkey == supp.s_suppkey, "left_anti").count()
    assert got.where("county is null").count() == got.where("purchase_date is null").count() > 0
    keys = li.select(R.record_key_expr().alias("k"))
    assert got.select("record_key").distinct().exceptAll(keys.distinct()).isEmpty()


def test_numbering_and_small_vocabularies_shuffle_no_rows(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        numbered = with_row_index(spark.range(100).repartition(4))
        assert "SortMergeJoin" not in plan(numbered)
        df = spark.createDataFrame([(1, "x"), (2, "y")], "k long, a string")
        hot = V.one_hot(df, V.fit_vocabulary(df, ["a"]), ["a"], "k")
        assert "SortMergeJoin" not in plan(hot)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_one_hot_of_repeated_and_missing_keys(spark):
    df = spark.createDataFrame([(1, "x", "p"), (1, "y", "q"), (None, "y", "q"), (None, "y", "q"), (2, "y", "p")], "k long, a string, b string")
    v = V.fit_vocabulary(df, ["a", "b"])
    got = sorted((r.k or 0, r.a, r.onehot) for r in V.one_hot(df, v, ["a", "b"], "k").collect())
    assert got == [(0, "y", []), (0, "y", []), (1, "x", [0, 1]), (1, "y", [0, 1]), (2, "y", [0])]
