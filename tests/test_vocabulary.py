from pyspark.sql import functions as F

from agrolens.operators import vocabulary as V

SCHEMA = "k long, a string, b string"
ROWS = [(1, "x", "p"), (2, "y", None), (3, None, "p"), (4, "z", "q"), (5, "", "p"), (6, "y", "p")]


def table(v):
    return {(r["name"], r.level): r["index"] for r in v.collect()}


def test_first_level_dropped_and_missing_as_level(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    v = V.fit_vocabulary(df, ["a", "b"])
    assert table(v) == {("a", "x"): 0, ("a", "y"): 1, ("a", "z"): 2, ("a", None): 3, ("b", "q"): 4, ("b", None): 5}
    got = {r.k: r.onehot for r in V.one_hot(df, v, ["a", "b"], "k").collect()}
    assert got == {1: [0], 2: [1, 5], 3: [3], 4: [2, 4], 5: [], 6: [1]}
    assert table(V.fit_vocabulary(df, ["a", "b"], drop_first=False, null_level=False)) == {
        ("a", ""): 0, ("a", "x"): 1, ("a", "y"): 2, ("a", "z"): 3, ("b", "p"): 4, ("b", "q"): 5}
    assert table(V.fit_vocabulary(df.limit(0), ["a"])) == {}


def test_alignment_lists_unknown_levels_and_leaves_their_slots_empty(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    v = V.fit_vocabulary(df.where("k < 4"), ["a", "b"])
    new = spark.createDataFrame([(7, "never", "p"), (8, "x", "r"), (9, "y", None), (10, "never", "p")], SCHEMA)
    assert {r.k: r.onehot for r in V.one_hot(new, v, ["a", "b"], "k").collect()} == {7: [], 8: [], 9: [0, 2], 10: []}
    unknown = V.unknown_levels(new, df.where("k < 4"), ["a", "b"]).collect()
    assert sorted(map(tuple, unknown)) == [("a", "never", 2), ("b", "r", 1)]


def test_hundred_thousand_levels(spark):
    df = spark.range(100_000).select(F.col("id").alias("k"), F.concat(F.lit("l"), F.lpad(F.col("id"), 6, "0")).alias("a"), F.lit("c").alias("b"))
    v = V.fit_vocabulary(df, ["a", "b"])
    assert v.count() == 99_999
    pairs = V.one_hot_pairs(df, v, ["a", "b"], "k")
    assert pairs.where("index <> k - 1").isEmpty() and pairs.count() == 99_999
