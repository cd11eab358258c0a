"""Distributed one-hot vocabulary (M1) and alignment of rows to a saved one.

A vocabulary is a written table (column, level, index): the levels of every column in text order, the first
one dropped where asked, missing values as a level of their own (last) where asked. Indexes are
dealt out by a range-partitioned sort and per-partition counts, so no list of levels reaches the driver and
there is no limit to their number. Rows become (row key, index) pairs or sorted index lists by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolens.functions.clean import with_row_index
from agrolens.session import BROADCAST_ROWS


def _levels(df: DataFrame, cols, *keep) -> DataFrame:
    """One row for each row and column: kept columns, column (its place), level (NULL if missing)."""
    return df.select(*keep, F.posexplode(F.array(*[F.col(c).cast("string") for c in cols])).alias("column", "level"))


def fit_vocabulary(df: DataFrame, cols, drop_first: bool = True, null_level: bool = True) -> DataFrame:
    """(column, name, level, index) with indexes from 0 over all columns in their order.

    ``drop_first``: the first level in text order has no index (rows that hold it have no entry). ``null_level``: a column with
    missing values has a last level NULL. A column whose only level is dropped has no row.
    """
    found = _levels(df, cols).distinct()
    if not null_level:
        found = found.where(F.col("level").isNotNull())
    if drop_first:
        first = df.agg(F.array(*[F.min(F.col(c).cast("string")) for c in cols]).alias("_first"))  # one row
        found = (found.crossJoin(F.broadcast(first))
                 .where(F.col("level").isNull() | (F.col("level") > F.element_at("_first", F.col("column") + 1))).drop("_first"))
    ordered = found.orderBy("column", F.col("level").asc_nulls_last())
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column") + 1)
    return with_row_index(ordered, "index", start=0).select("column", names.alias("name"), "level", "index")


def one_hot_pairs(df: DataFrame, vocabulary: DataFrame, cols, key: str) -> DataFrame:
    """(key, index) of every entry of every row. Levels that the vocabulary does not hold give no pair (slot 0 everywhere).

    Joins are left to AQE: it broadcasts a vocabulary that is measured to be small and splits a hot level otherwise.
    """
    v = vocabulary.select(F.col("column").alias("_c"), F.col("level").alias("_l"), "index")
    # NULL joins NULL through a flag, so that the join stays an equi-join on plain values
    return (_levels(df, cols, key)
            .join(v, (F.col("column") == F.col("_c")) & _same(F.col("level"), F.col("_l")))
            .select(key, "index"))


def _same(a: Column, b: Column) -> Column:
    return (F.coalesce(a, F.lit("")) == F.coalesce(b, F.lit(""))) & (a.isNull() == b.isNull())


def one_hot(df: DataFrame, vocabulary: DataFrame, cols, key: str, out: str = "onehot") -> DataFrame:
    """``df`` plus the sorted indexes of its entries (at most one a column; an empty list if there are none). ``key``: unique.

    Every column's levels are joined to the rows, the smallest vocabulary first, so a level's text is not shuffled once it has
    become a number: columns of few levels take no shuffle, the others one each. Should a key repeat after all, its rows
    all get the entries of them all, and a row without a key gets none.
    """
    sizes = {r["column"]: r["count"] for r in vocabulary.groupBy("column").count().collect()}  # a row a column
    coded = df.select("*", *[F.col(c).cast("string").alias(f"_l{i}") for i, c in enumerate(cols)])
    for i in sorted(range(len(cols)), key=lambda i: sizes.get(i, 0)):
        v = vocabulary.where(F.col("column") == i).select(F.col("level").alias("_l"), F.col("index").alias(f"_x{i}"))
        if sizes.get(i, 0) <= BROADCAST_ROWS:
            v = F.broadcast(v)
        coded = coded.join(v, _same(F.col(f"_l{i}"), F.col("_l")), "left").drop(f"_l{i}", "_l")
    none = F.array().cast("array<bigint>")
    entries = F.array_sort(F.array_compact(F.array(*[F.col(f"_x{i}") for i in range(len(cols))])))
    coded = coded.select(*df.columns, F.when(F.col(key).isNotNull(), entries).otherwise(none).alias(out))
    hashes = df.where(F.col(key).isNotNull()).groupBy(F.xxhash64(key).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    if hashes.where(F.col("_n") > 1).isEmpty():
        return coded
    lists = coded.groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.flatten(F.collect_list(out))).alias("_all"))
    return (coded.join(lists, F.col(key) == F.col("_k"), "left")
            .select(*df.columns, F.when(F.col(key).isNotNull(), F.col("_all")).otherwise(none).alias(out)))


def unknown_levels(df: DataFrame, known: DataFrame, cols) -> DataFrame:
    """(name, level, n_rows) of levels in ``df`` that ``known`` (rows or a table of the fitted data) does not hold."""
    new = _levels(df, cols).groupBy("column", "level").agg(F.count(F.lit(1)).alias("n_rows"))
    old = _levels(known, cols).distinct().select(F.col("column").alias("_c"), F.col("level").alias("_l"))
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column") + 1)
    return (new.join(old, (F.col("column") == F.col("_c")) & _same(F.col("level"), F.col("_l")), "left_anti")
            .select(names.alias("name"), "level", "n_rows"))
