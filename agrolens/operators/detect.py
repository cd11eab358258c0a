"""Duplicate, rapid-repeat, z-score and residual detectors.

None of these uses a window partitioned by an unbounded key: per-key numbers
come from partially aggregated ``groupBy`` results joined back, so a key that
holds a third of all rows is combined inside every task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrolens.operators.joins import attach_group_stats

DAY_MICROS = 86_400_000_000


def duplicate_serials(df: DataFrame, serial: str = "serial_no",
                      blanks_as_values: bool = False) -> DataFrame:
    """Rows whose serial number occurs at least twice, with the occurrence count.

    ``blanks_as_values=True`` reproduces the register's behaviour of treating all
    missing serials as one value "" (and thus reporting them all).
    """
    key = F.coalesce(F.col(serial), F.lit("")) if blanks_as_values else F.col(serial)
    d = df.withColumn("_serial", key).where(F.col("_serial").isNotNull())
    dups = (d.groupBy("_serial").agg(F.count(F.lit(1)).alias("dup_count"))
              .where(F.col("dup_count") >= 2))
    return d.join(dups, "_serial", "inner").drop("_serial")


def wall_clock_micros(c) -> F.Column:
    """Microseconds since 1970-01-01 00:00 of the wall-clock time (no time zone), like the
    register's naive datetimes: a zoned cast would make a day across a DST change 23 or
    25 hours long in a non-UTC session."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))


def rapid_repeat(df: DataFrame, buyer: str = "buyer", category: str = "item_category",
                 date: str = "purchase_date", days: int = 30,
                 null_buyers_as_one: bool = False) -> DataFrame:
    """D2 (W1 + W2): all dated rows of every (buyer, category) group in which two
    consecutive purchases are at most ``days`` whole 24-hour days apart.

    Two purchases are that close iff their distance is below (days + 1) * 24 h.
    Cutting time into buckets of exactly that width, a group is flagged iff a
    bucket holds two purchases, or the last purchase of a bucket and the first of
    the next bucket are closer than the width. So per (group, bucket) we only need
    count / min / max — a partial aggregate that is skew-proof — and the window
    afterwards runs over buckets, whose number per group is bounded by the date
    range, not by the data volume.
    """
    width = (days + 1) * DAY_MICROS
    b = F.col(buyer)
    c = F.col(category)
    if null_buyers_as_one:
        b = F.coalesce(b.cast("string"), F.lit("nan"))
        c = F.coalesce(c.cast("string"), F.lit("nan"))
    d = (df.where(F.col(date).isNotNull())
           .withColumn("_b", b).withColumn("_c", c)
           .where(F.col("_b").isNotNull() & F.col("_c").isNotNull())
           .withColumn("_t", wall_clock_micros(F.col(date))))
    buckets = (d.groupBy("_b", "_c", F.floor(F.col("_t") / F.lit(width)).alias("_bk"))
                .agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_lo"), F.max("_t").alias("_hi")))
    w = Window.partitionBy("_b", "_c").orderBy("_bk")
    hits = (buckets
            .withColumn("_pbk", F.lag("_bk").over(w))
            .withColumn("_phi", F.lag("_hi").over(w))
            .where((F.col("_n") >= 2) |
                   ((F.col("_pbk") == F.col("_bk") - 1) & (F.col("_lo") - F.col("_phi") < F.lit(width))))
            .select("_b", "_c").distinct())
    return d.join(hits, ["_b", "_c"], "inner").drop("_b", "_c", "_t")


def zscore_global(df: DataFrame, col: str = "unit_price", threshold: float = 3.0,
                  z_col: str = "price_zscore", flag_col: str = "price_stat_anomaly") -> DataFrame:
    """D3: z-score against the global mean / sample std; keeps every row.

    The mean / std come from a one-row aggregate broadcast to all tasks (never a
    global window, which would pull all rows into one partition).
    """
    st = df.agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_std"))
    z = (F.col(col) - F.col("_mean")) / F.nullif(F.col("_std"), F.lit(0.0))
    return (df.crossJoin(F.broadcast(st))
              .withColumn(z_col, z)
              .withColumn(flag_col, F.coalesce(F.abs(F.col(z_col)) > threshold, F.lit(False)))
              .drop("_mean", "_std"))


def zscore_by_group(df: DataFrame, group: str = "model", col: str = "unit_price",
                    threshold: float = 3.0) -> DataFrame:
    """Every row whose |z| against its own group's mean / sample std exceeds the
    threshold (strict). std 0 or a single-row group give NULL z (never flagged)."""
    j = attach_group_stats(df, group, col, "avg_model_price", "std_model_price")
    z = (F.col(col) - F.col("avg_model_price")) / F.nullif(F.col("std_model_price"), F.lit(0.0))
    return j.withColumn("price_z_score", z).where(F.abs(F.col("price_z_score")) > threshold)


def top_rows(df: DataFrame, order_col: str, n: int = 10, tie_break=("record_key",), ascending=False):
    """Sort + head(n) with a deterministic tie-break (TakeOrderedAndProject)."""
    o = F.asc(order_col) if ascending else F.desc(order_col)
    return df.orderBy(o, *[F.asc(t) for t in tie_break if t in df.columns]).limit(n)


def residual_anomaly(scored: DataFrame, metrics: DataFrame, actual: str = "actual_price",
                     pred: str = "predicted_price", sigma: float = 2.0) -> DataFrame:
    """Rows whose |actual - pred| exceeds mae + sigma * mae_std (strict).

    ``metrics`` is a one-row DataFrame with columns ``mae`` and ``mae_std``.
    """
    m = metrics.select("mae", "mae_std")
    return (scored.crossJoin(F.broadcast(m))
                  .withColumn("prediction_error", F.abs(F.col(actual) - F.col(pred)))
                  .withColumn("price_difference", F.col(actual) - F.col(pred))
                  .where(F.col("prediction_error") > F.col("mae") + sigma * F.col("mae_std"))
                  .drop("mae", "mae_std"))


# The alert payload of the register's monitor (title and message).
ALERT_TITLE = "农机补贴异常预警"
ALERT_TEXT = "检测到 {n} 条异常记录，请及时核查。"


def alert_if(df: DataFrame, flag: str, min_count: int = 10) -> DataFrame:
    """A one-row payload (title, text, n) when more than ``min_count`` rows are flagged."""
    pre, post = ALERT_TEXT.split("{n}")
    return (df.agg(F.count_if(F.col(flag)).alias("n"))
              .where(F.col("n") > min_count)
              .select(F.lit(ALERT_TITLE).alias("title"),
                      F.concat(F.lit(pre), F.col("n").cast("string"), F.lit(post)).alias("text"), "n"))
