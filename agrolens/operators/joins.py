"""Lookup remapping, stats-back joins and batch unions.

Join sides are not hinted unless their size is bounded by construction: AQE
turns a join into a broadcast hash join at runtime when the measured side is
below ``spark.sql.autoBroadcastJoinThreshold``, and otherwise keeps the
sort-merge join and splits skewed partitions (``skewJoin``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrolens.functions.clean import strip_text


def remap(df: DataFrame, lookup: DataFrame, key: str = "county", out: str | None = None) -> DataFrame:
    """Replace ``key`` by lookup[to_name] on the trimmed key; unmatched keep their own
    trimmed value; NULL stays NULL. Of several targets for one name the smallest counts. AQE
    broadcasts the lookup if its measured size allows."""
    out = out or key
    lk = (lookup.select(strip_text("from_name").alias("_from"), F.col("to_name").alias("_to"))
                .groupBy("_from").agg(F.min("_to").alias("_to")))
    d = df.withColumn("_k", strip_text(key))
    j = d.join(lk, d["_k"] == lk["_from"], "left")
    return j.withColumn(out, F.coalesce(F.col("_to"), F.col("_k"))).drop("_k", "_from", "_to")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """C17: distinct values of a column (NULL kept, like pandas' unique)."""
    return df.select(col).distinct()


def attach_group_stats(df: DataFrame, key: str = "model", value: str = "unit_price",
                       mean_col: str = "avg_model_price", std_col: str = "std_model_price") -> DataFrame:
    """Per-key mean and sample std attached to every row (NULL key -> NULL stats).

    Partial aggregation first (a hot key is combined map-side), then an equi-join
    back; no window over the key, so a key holding a third of the rows is never
    one task.
    """
    stats = (df.where(F.col(key).isNotNull()).groupBy(key)
               .agg(F.avg(value).alias(mean_col), F.stddev_samp(value).alias(std_col)))
    return df.join(stats, key, "left")


def union_batches(dfs) -> DataFrame:
    """Stack batches by column name; missing columns become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), list(dfs))
