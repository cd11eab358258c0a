"""Group statistics, rankings, shares, histograms and trend lines.

All aggregations are hash aggregates with a map-side partial step, so a hot
key is pre-aggregated inside each task before the shuffle. pandas' null rules
are kept: null group keys are dropped, a sum over no values is 0, rounding is
half-even (``bround``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrolens.operators.quantiles import exact_quantiles
from agrolens.schema import PENDING_STATUS


def _sum0(c):
    return F.coalesce(F.sum(c), F.lit(0.0))


def _nonnull(df: DataFrame, *keys) -> DataFrame:
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.where(cond)


def kpi_card(df: DataFrame, qty="quantity", subsidy="total_subsidy", buyer="buyer",
             status="status", pending=PENDING_STATUS) -> DataFrame:
    """A1: total units, total subsidy, distinct buyers, rows awaiting settlement."""
    return df.agg(
        F.bround(_sum0(qty), 2).alias("total_machines"),
        F.bround(_sum0(subsidy), 2).alias("total_subsidy"),
        F.count_distinct(buyer).alias("unique_buyers"),
        F.count_if(F.col(status) == pending).alias("pending_count"))


def summary_stats(df: DataFrame, col="unit_subsidy") -> DataFrame:
    """A2: sum and mean of a column plus the row count."""
    return df.agg(F.bround(_sum0(col), 2).alias("total_subsidy"),
                  F.bround(F.avg(col), 2).alias("average_subsidy"),
                  F.count(F.lit(1)).alias("record_count"))


def sum_by(df: DataFrame, key: str, value="quantity", out="quantity") -> DataFrame:
    """Sum of ``value`` per non-null ``key``."""
    return (_nonnull(df, key).groupBy(key)
            .agg(F.bround(_sum0(value), 2).alias(out)))


def with_max(df: DataFrame, col: str, out: str) -> DataFrame:
    """Attach the maximum of ``col`` (scale bound) via a one-row broadcast aggregate."""
    m = df.agg(F.max(col).alias(out))
    return df.crossJoin(F.broadcast(m))


def daily_sum(df: DataFrame, date="purchase_date", value="quantity") -> DataFrame:
    """A5: quantity per purchase day."""
    d = df.where(F.col(date).isNotNull()).withColumn("day", F.to_date(date))
    return d.groupBy("day").agg(F.bround(_sum0(value), 2).alias("quantity"))


def top_n_share(df: DataFrame, key="item_category", value="quantity", n=10) -> DataFrame:
    """Top-n keys by summed value, share of the n shown (percent, 2 decimals)."""
    top = (sum_by(df, key, value, "quantity").orderBy(F.desc("quantity"), F.asc(key)).limit(n))
    tot = top.agg(F.sum("quantity").alias("_tot"))
    return (top.crossJoin(F.broadcast(tot))
               .withColumn("pct", F.bround(F.col("quantity") / F.nullif(F.col("_tot"), F.lit(0.0)) * 100, 2))
               .drop("_tot"))


def frequency_share(df: DataFrame, key="item_category") -> DataFrame:
    """Rows per key and share of ALL rows (null-key rows included in the total)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))
    tot = counts.agg(F.sum("record_count").alias("_tot"))  # same exchange, so the table is read once
    return (_nonnull(counts, key).crossJoin(F.broadcast(tot))
                  .withColumn("share_pct", F.bround(F.col("record_count") / F.col("_tot") * 100, 2))
                  .drop("_tot"))


def county_stats(df: DataFrame, key="county", value="unit_subsidy") -> DataFrame:
    """A10: sum, mean, count of unit subsidy per county, rounded, ascending by sum."""
    return (_nonnull(df, key).groupBy(key)
            .agg(F.bround(_sum0(value), 2).alias("total_subsidy"),
                 F.bround(F.avg(value), 2).alias("average_subsidy"),
                 F.count(value).alias("equipment_count"))
            .orderBy("total_subsidy", key))


def monthly_stats(df: DataFrame, date="purchase_date", value="unit_subsidy") -> DataFrame:
    """Per calendar month (yyyy-MM) subsidy sum and non-null count; empty months absent."""
    d = df.where(F.col(date).isNotNull()).withColumn("month", F.date_format(date, "yyyy-MM"))
    return (d.groupBy("month").agg(F.bround(_sum0(value), 2).alias("monthly_subsidy"),
                                   F.count(value).alias("monthly_count"))
             .orderBy("month"))


def top_by_count(df: DataFrame, key="manufacturer", n=20) -> DataFrame:
    """Rows per key, descending, first n (n=None: all)."""
    out = (_nonnull(df, key).groupBy(key).agg(F.count(F.lit(1)).alias("record_count"))
           .orderBy(F.desc("record_count"), F.asc(key)))
    return out.limit(n) if n else out


def top_by_sum(df: DataFrame, key="manufacturer", value="unit_subsidy", n=20, out="subsidy_sum") -> DataFrame:
    """Summed value per key, descending, first n."""
    return (sum_by(df, key, value, out).orderBy(F.desc(out), F.asc(key)).limit(n))


def manufacturer_table(df: DataFrame, key="manufacturer", value="unit_subsidy", n=20) -> DataFrame:
    """The two top-n lists aligned on the key (full outer join), key order."""
    a = top_by_count(df, key, n)
    b = top_by_sum(df, key, value, n)
    return a.join(b, key, "full_outer").orderBy(key)


def remap_count(df: DataFrame, lookup: DataFrame, key="county", value="quantity") -> DataFrame:
    """Non-null ``value`` count per remapped key (after C14), plus the largest count
    (the map's scale bound)."""
    from agrolens.operators.joins import remap
    r = remap(df, lookup, key, out="city")
    counts = _nonnull(r, "city").groupBy("city").agg(F.count(value).alias("record_count"))
    return with_max(counts, "record_count", "max_count")


def market_position(df: DataFrame, cat="item_category", maker="manufacturer",
                    price="unit_price", qty="quantity", min_count=5.0) -> DataFrame:
    """Valid transactions per (category, maker): units, mean price, revenue; units >= min."""
    from agrolens.functions.clean import valid_transactions, with_revenue
    v = with_revenue(valid_transactions(df, price, qty), price, qty)
    g = (_nonnull(v, cat, maker).groupBy(cat, maker)
         .agg(F.sum(qty).alias("total_count"), F.avg(price).alias("avg_price"),
              F.sum("revenue").alias("total_revenue")))
    return (g.where(F.col("total_count") >= min_count)
             .select(cat, maker, F.bround("total_count", 2).alias("total_count"),
                     F.bround("avg_price", 2).alias("avg_price"),
                     F.bround("total_revenue", 2).alias("total_revenue")))


def describe(df: DataFrame, col="unit_price", accuracy: int | None = None) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear), max — exact, distributed."""
    s = df.agg(F.count(col).alias("count"), F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"),
               F.min(col).alias("min"), F.max(col).alias("max"))
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], accuracy)
    out = s.join(F.broadcast(q), how="left")
    return out.select(
        "count", *[F.bround(c, 4).alias(c) for c in ("mean", "std", "min")],
        F.bround("q0", 4).alias("p25"), F.bround("q1", 4).alias("p50"), F.bround("q2", 4).alias("p75"),
        F.bround("max", 4).alias("max"))


def histogram(df: DataFrame, col="unit_price", bins: int = 50) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed; all bins listed."""
    x = df.where(F.col(col).isNotNull() & ~F.isnan(col))
    rng = x.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    # bin index by (x - lo) * bins / (hi - lo); a constant column falls in the middle bin
    idx = F.when(F.col("hi") == F.col("lo"), F.lit(bins // 2 + 1)).otherwise(
        F.least(F.floor((F.col(col) - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))) + 1,
                F.lit(bins)))
    counts = (x.crossJoin(F.broadcast(rng)).select(idx.cast("int").alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("bin_count")))
    spark = df.sparkSession
    allb = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    edges = allb.crossJoin(F.broadcast(rng)).select(
        "bin",
        F.bround(F.col("lo") + (F.col("bin") - 1) * (F.col("hi") - F.col("lo")) / bins, 4).alias("bin_lo"),
        F.bround(F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins, 4).alias("bin_hi"))
    return (edges.join(counts, "bin", "left")
                 .select("bin", "bin_lo", "bin_hi", F.coalesce("bin_count", F.lit(0)).cast("bigint").alias("bin_count")))


def top_performers(df: DataFrame, cat="item_category", maker="manufacturer", model="model",
                   price="unit_price", qty="quantity", subsidy="unit_subsidy", n=5,
                   category: str | None = None) -> DataFrame:
    """Per category, the n (maker, model) pairs with the highest mean price.

    ``category`` restricts to one category (the reference's call); by default all
    categories are ranked at once (row_number over the small per-pair aggregate).
    """
    d = df.where(F.col(cat) == category) if category is not None else df
    g = (_nonnull(d, cat, maker, model).groupBy(cat, maker, model)
         .agg(F.avg(price).alias("average_price"), F.sum(qty).alias("sales_count"),
              F.max(subsidy).alias("max_central_subsidy")))
    w = Window.partitionBy(cat).orderBy(F.desc("average_price"), F.asc(maker), F.asc(model))
    return (g.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
             .select(cat, "rank", maker, model, F.bround("average_price", 2).alias("average_price"),
                     F.bround("sales_count", 2).alias("sales_count"),
                     F.bround("max_central_subsidy", 2).alias("max_central_subsidy")))


def top_categories(df: DataFrame, cat="item_category", n=6) -> DataFrame:
    """The n most frequent categories (key + count)."""
    return top_by_count(df, cat, n)


def in_top_categories(df: DataFrame, cat="item_category", n=6) -> DataFrame:
    """Rows whose category is among the n most frequent (left semi join, n rows broadcast)."""
    return df.join(F.broadcast(top_categories(df, cat, n).select(cat)), cat, "left_semi")


def ols_by_group(df: DataFrame, group="item_category", y="unit_price", x="unit_subsidy") -> DataFrame:
    """Least-squares line y = a + b x per group, on all rows (no sampling)."""
    return (_nonnull(df, group).groupBy(group)
            .agg(F.bround(F.regr_slope(y, x), 6).alias("slope"),
                 F.bround(F.regr_intercept(y, x), 4).alias("intercept"),
                 F.bround(F.regr_r2(y, x), 6).alias("r2"),
                 F.regr_count(y, x).cast("bigint").alias("n")))


def seeded_sample(df: DataFrame, n=5000, seed=42, key="record_key") -> DataFrame:
    """Reproducible sample of n rows without replacement: the n smallest md5(seed|key).

    Unlike rand(seed) this does not depend on partitioning and survives task retries.
    """
    h = F.md5(F.concat(F.lit(str(seed)), F.col(key)))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def flag_count(df: DataFrame, flag: str, out="flag_count") -> DataFrame:
    """Number of flagged rows."""
    return df.agg(F.count_if(F.col(flag)).alias(out))
