"""Null / parse / trim rules of the register under Spark's ANSI mode."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from agrolens.functions import clean as C


def _one(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v")).alias("o")).collect()]


def test_strip_text_removes_python_whitespace(spark):
    out = _one(spark, C.strip_text, [" 中牟县 ", "　中牟县　", "\t a b \n", None])
    assert out == ["中牟县", "中牟县", "a b", None]


def test_to_number_rejects_non_numbers(spark):
    out = _one(spark, C.to_number, ["1", "abc", "", "1d", "nan", "0", " 2.5 ", "1e3", None, "-3", ".5"])
    assert out == [1.0, None, None, None, None, 0.0, 2.5, 1000.0, None, -3.0, 0.5]


def test_to_ts_layouts(spark):
    out = _one(spark, C.to_ts, ["2023-05-01", "2023/05/02", "2023-05-01 10:20:30", "bad", None, "2023/5/3 1:02:03"])
    assert out[0] == dt.datetime(2023, 5, 1)
    assert out[1] == dt.datetime(2023, 5, 2)
    assert out[2] == dt.datetime(2023, 5, 1, 10, 20, 30)
    assert out[3] is None and out[4] is None
    assert out[5] == dt.datetime(2023, 5, 3, 1, 2, 3)


def test_to_ts_compact_and_iso_layouts(spark):
    out = _one(spark, C.to_ts, ["20230504", "2023-05-01T10:20:30", " 2023-05-01 10:20 ", "2023-13-01",
                                "12345678", "T", "2023-05-01 10:20:30.5"])
    assert out[0] == dt.datetime(2023, 5, 4)
    assert out[1] == dt.datetime(2023, 5, 1, 10, 20, 30)
    assert out[2] == dt.datetime(2023, 5, 1, 10, 20)
    assert out[3:6] == [None, None, None]
    assert out[6] == dt.datetime(2023, 5, 1, 10, 20, 30, 500_000)
    more = _one(spark, C.to_ts, ["2023-05-01T10:20:30Z", "2023-05-01 10:20:30.000", "2023-05-01T10:20:30.123456Z", "Z", "x:Z"])
    assert more == [dt.datetime(2023, 5, 1, 10, 20, 30)] * 2 + [dt.datetime(2023, 5, 1, 10, 20, 30, 123456), None, None]


def test_normalise_serial(spark):
    assert _one(spark, C.normalise_serial, [" A1 ", "", "None", "nan", None, "  "]) == ["A1", None, None, None, None, None]


def test_clean_records_from_raw_text(spark):
    # source headers (one padded), a filler column, an all-null row
    cols = [" 县 ", "购机者姓名", "购买数量(台)", "购机日期", "单台销售价格(元)", "出厂编号", "Unnamed: 17"]
    rows = [(" 中牟县 ", " 张三 ", "1", "2023/05/02", "100.01", " S1 ", None),
            ("杞县", None, "abc", "bad", "nan", "None", None),
            (None, None, None, None, None, None, None)]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in cols))
    out = C.clean_records(raw, number_rows=True).orderBy("record_id").collect()
    assert len(out) == 2  # all-null row dropped
    a, b = out
    assert a.county == " 中牟县 "  # county is only trimmed at remap time
    assert a.buyer == "张三" and a.quantity == 1.0 and a.unit_price == 100.01
    assert a.purchase_date == dt.datetime(2023, 5, 2) and a.serial_no == "S1"
    assert b.quantity is None and b.unit_price is None and b.purchase_date is None and b.serial_no is None
    assert [r.record_id for r in out] == [1, 2]  # no 序号 column -> row numbers
    assert "Unnamed: 17" not in C.clean_records(raw).columns


def test_row_index_consecutive_across_partitions(spark):
    df = spark.range(0, 1000, numPartitions=7)
    out = C.with_row_index(df, "rid").collect()
    assert sorted(r.rid for r in out) == list(range(1, 1001))
    assert all(r.rid == r.id + 1 for r in out)


@pytest.mark.parametrize("shuffle", [
    lambda d: d.repartition(64, "k"), lambda d: d.groupBy("k", "id").count().drop("count"), lambda d: d.orderBy("k")])
def test_row_index_keeps_every_row_after_a_shuffle(spark, shuffle):
    from pyspark.sql import functions as F
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
                                                "spark.sql.adaptive.coalescePartitions.parallelismFirst")}
    try:
        for k, v in zip(old, ("64", "200k", "false")):
            spark.conf.set(k, v)
        df = spark.range(100_000).withColumn("k", F.col("id") % 97)
        ids = sorted(r.rid for r in C.with_row_index(shuffle(df), "rid").select("rid").collect())
        assert ids == list(range(1, 100_001))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_valid_transactions_strict_price(spark):
    df = spark.createDataFrame([(100.0, 1.0), (100.01, 1.0), (500.0, 0.0), (None, 1.0), (200.0, None)],
                               "unit_price double, quantity double")
    out = C.with_revenue(C.valid_transactions(df)).collect()
    assert [(r.unit_price, r.revenue) for r in out] == [(100.01, 100.01)]


def test_labels_and_keys(spark):
    df = spark.createDataFrame([("a" * 30, "x/y z", None)], "l string, k string, d timestamp")
    r = df.select(C.shorten_label("l").alias("l"), C.safe_key("k").alias("k"),
                  C.year_or_default("d").alias("y"), C.category_text("d").alias("c")).first()
    assert r.l == "a" * 25 + "..." and r.k == "x_y_z" and r.y == 2024 and r.c == "NA"


def test_to_ts_keeps_wall_clock_in_dst_gap(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        out = _one(spark, C.to_ts, ["2023-03-12 02:30:00", "2023/11/05 01:30", "bad"])
        assert out == [dt.datetime(2023, 3, 12, 2, 30), dt.datetime(2023, 11, 5, 1, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
