import os
import tempfile

import pytest

from pyspark.sql import functions as F

from agrolens.sources.html_tables import extract_tables, parse_first_table, rejected_pages, to_columns
from agrolens.sources.readers import merge_batches, read_csv_any
from agrolens.sources.sinks import page_batches, summary_document, write_report


def test_parse_first_table_cases():
    one = ("<table><tr><th> a </th><th>b</th></tr><tr><td> 1 </td><td>x</td></tr>"
           "<tr></tr><tr><td>2</td><td><b>y</b> z</td></tr></table>")
    assert parse_first_table(one) == (["a", "b"], [["1", "x"], ["2", "y z"]])
    two = "<table><tr><th>a</th></tr><tr><td>1</td></tr></table><table><tr><th>b</th></tr><tr><td>2</td></tr></table>"
    assert parse_first_table(two) == (["a"], [["1"]])
    assert parse_first_table("<p>no table</p>") is None
    assert parse_first_table(None) is None
    # widest row wider than the header -> page unusable
    assert parse_first_table("<table><tr><th>a</th></tr><tr><td>1</td><td>2</td></tr></table>") is None
    # short rows are padded
    assert parse_first_table("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr><tr><td>1</td><td>2</td></tr>")[1] \
        == [["1", None], ["1", "2"]]
    # malformed, unclosed tags
    assert parse_first_table("<table><tr><th>a<tr><td>1")[1] == [["1"]]


def test_extract_tables_distributed(spark):
    pages = spark.createDataFrame(
        [(1, "<table><tr><th>k</th><th>v</th></tr><tr><td>1</td><td>a</td></tr><tr><td>2</td><td>b</td></tr></table>"),
         (2, "<div>nothing</div>"), (3, None)], "page_id long, html string")
    out = to_columns(extract_tables(pages), ["k", "v"]).orderBy("row_no").collect()
    assert [(r.page_id, r.k, r.v) for r in out] == [(1, "1", "a"), (1, "2", "b")]


def test_page_batches_clip_last(spark):
    pages = spark.range(1, 251).withColumnRenamed("id", "page_id")
    b = {r.batch: r["count"] for r in page_batches(pages).groupBy("batch").count().collect()}
    assert b == {"1_to_100": 100, "101_to_200": 100, "201_to_250": 50}


def test_read_csv_any_falls_back_to_gbk(spark):
    d = tempfile.mkdtemp(prefix="agrolens-csv-")
    p = os.path.join(d, "gbk.csv")
    with open(p, "wb") as f:
        f.write("县,购买数量(台)\n中牟县,1\n".encode("gbk"))
    df = read_csv_any(spark, p)
    assert df.columns == ["县", "购买数量(台)"]
    assert df.first()[0] == "中牟县"
    u = os.path.join(d, "utf8.csv")
    with open(u, "w", encoding="utf-8") as f:
        f.write("县,x\n杞县,2\n")
    assert read_csv_any(spark, u).first()[0] == "杞县"


def test_read_csv_any_decides_per_file(spark):
    d = tempfile.mkdtemp(prefix="agrolens-csv-")
    old = spark.conf.get("spark.sql.legacy.javaCharsets")
    for name, text, enc in (("a", "县,x\n中牟县\ufffd,1\n", "utf-8"), ("b", "县,x\n杞县,2\n", "gbk")):
        with open(os.path.join(d, name + ".csv"), "wb") as f:
            f.write(text.encode(enc))
    assert sorted(map(tuple, read_csv_any(spark, d).collect())) == [("中牟县\ufffd", "1"), ("杞县", "2")]
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == old
    bad = os.path.join(tempfile.mkdtemp(prefix="agrolens-csv-"), "c.csv")
    with open(bad, "wb") as f:
        f.write(b"a,b\n\xff\xff\xff,1\n")
    with pytest.raises(ValueError, match="neither"):
        read_csv_any(spark, bad)
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == old


def test_merge_and_report(spark):
    d = tempfile.mkdtemp(prefix="agrolens-rep-")
    a = spark.createDataFrame([(1, "x")], "k long, a string")
    b = spark.createDataFrame([(2, 3.0)], "k long, b double")
    paths = write_report({"a": a, "b": b}, d)
    m = merge_batches(spark, [paths["a"], paths["b"]]).orderBy("k").collect()
    assert [(r.k, r.a, r.b) for r in m] == [(1, "x", None), (2, None, 3.0)]


def test_summary_document(spark):
    df = spark.createDataFrame([("t1", "c1", 10.0), ("t1", "c2", 20.0), ("t2", "c1", None)],
                               "township string, item_category string, unit_price double")
    got = {(r.section, r.key): r.value for r in summary_document(df).collect()}
    assert got[("rows", "total")] == 3 and got[("price", "count")] == 2 and got[("price", "p50")] == 15.0
    assert {k: v for k, v in got.items() if k[0] in ("region", "item")} == {
        ("region", "t1"): 2, ("region", "t2"): 1, ("item", "c1"): 2, ("item", "c2"): 1}


def test_rejected_pages(spark):
    good = "<table><tr><th>a</th></tr><tr><td>1</td></tr></table>"
    bad = "<table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr></table>"
    df = spark.createDataFrame([(1, good), (2, bad), (3, "<p>x</p>"), (4, None)], "page_id long, html string")
    assert [r.page_id for r in extract_tables(df).collect()] == [1]
    assert sorted(r.page_id for r in rejected_pages(df).collect()) == [2, 3, 4]


def test_plain_fast_path_matches_html_parser():
    """Differential check: the regex fast path and the html.parser state machine agree on
    random pages built from well-formed, malformed and tricky fragments."""
    import random
    rnd = random.Random(11)
    toks = ["<table>", "</table>", "<TABLE class=x>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>",
            "<td/>", "<b>", "</b>", " a ", "x&amp;y", "&lt;", "&am", "p;", "<!-- <td>c</td> -->", "<br/>",
            "\n", "<td title=\"a>b\">", "v", "<script>var s='<td>';</script>", "&#31;", "<tr class=r>",
            "<TD>", "</TD >", "<thead>", "<tdx>", "</td/>", "<td/x>", "<table-x>", "</table >", "<", ">",
            "'", "< b", "O'Brien", "\xa0", "<!DOCTYPE html>", "<title>a<b>c</title>", "\x00", "</ x>",
            "<td\xa0>", "<table><tr><th>n</th></tr><tr><td>in</td></tr></table>", "　",
            "<td class='c'>", "<td a=\"x\" b='y'>", "<td a='\"' b=\">\">", "<td a=\"x>", "<td a='<'>", "1<2"]
    plain = 0
    for _ in range(4000):
        h = "".join(rnd.choice(toks) for _ in range(rnd.randint(1, 40)))
        assert parse_first_table(h) == parse_first_table(h, fast=False), repr(h)
    for _ in range(2000):
        h = "".join(rnd.choice(toks[:13] + ["<TD>", "</TD >", "<thead>", "<tdx>"]) for _ in range(rnd.randint(1, 60)))
        plain += parse_first_table(h) is not None
        assert parse_first_table(h) == parse_first_table(h, fast=False), repr(h)
    assert plain > 50


def test_bare_rows_match_html_parser():
    """Rows cut by string splits agree with the html.parser state machine, whatever stands around and between them."""
    import random
    rnd = random.Random(5)
    bare = ["<tr><td>1</td><td> a&amp;b </td></tr>", "<tr><td>\t2</td><td>x > 'y' \"z\"</td></tr>\n", "<tr><td>3</td></tr>"]
    toks = ["<table>", "<table><tr><th>k</th><th>v</th></tr>", "</table>", "<tr></tr>", "<tr>", "<td>", "</td>", "</tr>", "<TR><td>u</td></TR>",
            "<tr><td>a<b>c</b></td><td>d</td></tr>", "<tr><td>e<td>f</td></tr>", "<tr>g<td>h</td></tr>", "<!--", "-->", "<a b='", "'>",
            "<title>", "</title>", "<script>", "</script>", "\x00", "text", "<td/>", "<tr><td></td></tr>"]
    some = 0
    for _ in range(6000):
        h = "<table><tr><th>k</th><th>v</th></tr>" * rnd.randint(0, 1) + "".join(
            rnd.choice(bare if rnd.random() < 0.5 else toks) for _ in range(rnd.randint(1, 14)))
        t = parse_first_table(h, fast=False)
        some += t is not None
        assert parse_first_table(h) == t, repr(h)
    assert some > 300


def test_each_step_of_a_roundtrip_is_compiled(spark):
    """The JVM leaves methods of over 8,000 bytes uncompiled, as the one of lookup and cleaning was."""
    import re

    from agrolens.functions.clean import clean_records
    from agrolens.schema import SOURCE_TO_COLUMN
    pages = spark.createDataFrame([(1, "<table><tr><th>k</th></tr><tr><td>1</td></tr></table>")], "page_id long, html string")
    rows = extract_tables(pages)
    c = clean_records(to_columns(rows, list(SOURCE_TO_COLUMN)).drop("page_id", "row_no"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = c._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000


def test_batches_of_many_pages_keep_their_rows(spark):
    """More pages than are built at a time, with short rows, empty rows and pages without a table between."""
    from agrolens.sources.html_tables import PAGES_PER_BATCH
    n = 2 * PAGES_PER_BATCH + 3
    page = "<table><tr><th>k</th><th>v</th></tr><tr><td>{0}</td></tr><tr></tr><tr><td>{0}</td><td>b</td></tr></table>"
    pages = spark.createDataFrame([(i, page.format(i) if i % 3 else "<p>x</p>") for i in range(n)], "page_id long, html string").coalesce(1)
    got = sorted((r.page_id, r.row_no, r.k, r.v) for r in to_columns(extract_tables(pages), ["k", "v"]).collect())
    assert got == [(i, j, str(i), v) for i in range(n) if i % 3 for j, v in ((0, None), (1, "b"))]


def test_a_landed_file_is_read_by_several_tasks(spark, tmp_path):
    """One file of 24 MB of pages that do not compress, read on four cores."""
    from pyspark.sql import functions as F

    from agrolens.streaming.page_ingest import land_pages
    noise = F.concat(*[F.sha2(F.concat(F.col("id"), F.lit(f":{i}")), 512) for i in range(200)])
    pages = spark.range(0, 1000, 1, 1).select(F.col("id").alias("page_id"), F.lit(None).cast("string").alias("url"), noise.alias("html"))
    land_pages(pages, str(tmp_path / "pages"))
    back = spark.read.parquet(str(tmp_path / "pages"))
    assert back.select(F.spark_partition_id()).distinct().count() > 2
    assert back.count() == 1000 and back.exceptAll(pages).count() == 0
