"""Exact quantiles without gathering a column into one task.

Spark's ``percentile`` is exact but keeps every value of a group in one
aggregation buffer, i.e. one task for a global quantile. Here:

1. one pass computes n and a mergeable sketch (``percentile_approx``) whose rank
   error is at most n/accuracy; it brackets every wanted rank r by [lo, hi];
2. rows with lo <= x <= hi (a ~6/accuracy fraction of the data, pre-aggregated
   to distinct values) are ranked with the exact count of rows below lo;
3. the rows at ranks floor(p(n-1)) and ceil(p(n-1)) are interpolated linearly
   (the textbook / numpy / pandas / DuckDB ``quantile_cont`` definition).

Everything is one lazy plan; nothing passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def choose_accuracy(n_rows: int, max_slice_rows: int = 2_000_000) -> int:
    """Smallest sketch accuracy whose rank slices (~6 n / accuracy rows) stay below
    ``max_slice_rows``; at least 10k, at most 1M (sketch memory)."""
    return int(min(1_000_000, max(10_000, 6 * n_rows / max_slice_rows)))


def exact_quantiles(df: DataFrame, col: str, probs, accuracy: int | None = None,
                    group_cols=()) -> DataFrame:
    """Return one row per group with columns q0..q{k-1} (linear interpolation).

    ``accuracy=None`` picks it from the row count (one scalar count job) so that the
    slice ranked per quantile stays bounded: cheap sketches on small data, bounded
    slices on very large data.
    """
    probs = [float(p) for p in probs]
    if accuracy is None:
        accuracy = choose_accuracy(df.count())
    k = len(probs)
    eps = 3.0 / accuracy
    g = list(group_cols)
    x = (df.select(*g, F.col(col).cast("double").alias("_x"))
           .where(F.col("_x").isNotNull() & ~F.isnan("_x")))
    fracs = []
    for p in probs:
        fracs += [max(0.0, p - eps), min(1.0, p + eps)]
    bounds = x.groupBy(*g).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_x", F.array(*[F.lit(f) for f in fracs]), accuracy).alias("_q"))
    # one row without groups; with groups AQE decides by the measured size
    joined = x.join(bounds, g, "inner") if g else x.crossJoin(F.broadcast(bounds))

    def lo(i):
        return F.element_at("_q", 2 * i + 1)

    def hi(i):
        return F.element_at("_q", 2 * i + 2)

    # per slice: exact count of rows below it, its size, and the nearest value on each side
    # (a wanted rank can sit just outside the bracket when n * eps < 1, i.e. on small inputs)
    below = joined.groupBy(*g).agg(
        F.first("_n").alias("_n"),
        *[F.sum(F.when(F.col("_x") < lo(i), 1).otherwise(0)).cast("bigint").alias(f"_b{i}")
          for i in range(k)],
        *[F.sum(F.when((F.col("_x") >= lo(i)) & (F.col("_x") <= hi(i)), 1).otherwise(0)).cast("bigint")
          .alias(f"_c{i}") for i in range(k)],
        *[F.max(F.when(F.col("_x") < lo(i), F.col("_x"))).alias(f"_nb{i}") for i in range(k)],
        *[F.min(F.when(F.col("_x") > hi(i), F.col("_x"))).alias(f"_na{i}") for i in range(k)])
    # distinct values inside each slice with their multiplicity
    slice_ids = F.filter(F.array(*[F.lit(i) for i in range(k)]),
                         lambda i: (F.col("_x") >= F.element_at("_q", i * 2 + 1))
                         & (F.col("_x") <= F.element_at("_q", i * 2 + 2)))
    sl = (joined.select(*g, "_x", F.explode(slice_ids).alias("_i"))
                .groupBy(*g, "_i", "_x").agg(F.count(F.lit(1)).alias("_c")))
    sl = sl.join(below, g, "inner") if g else sl.crossJoin(F.broadcast(below))

    def pick(prefix):
        return F.element_at(F.array(*[F.col(f"{prefix}{i}") for i in range(k)]), F.col("_i") + 1)

    w = Window.partitionBy(*g, "_i").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    sl = (sl.withColumn("_base", pick("_b")).withColumn("_size", pick("_c"))
            .withColumn("_prev", pick("_nb")).withColumn("_next", pick("_na")))
    sl = sl.withColumn("_first", F.col("_base") + F.sum("_c").over(w) - F.col("_c"))
    sl = sl.withColumn("_last", F.col("_first") + F.col("_c") - 1)
    p_arr = F.array(*[F.lit(p) for p in probs])
    pos = F.element_at(p_arr, F.col("_i") + 1) * (F.col("_n") - 1)
    sl = sl.withColumn("_pos", pos)

    def at(r):
        inside = F.max(F.when((F.col("_first") <= r) & (r <= F.col("_last")), F.col("_x")))
        before = F.max(F.when(r == F.col("_base") - 1, F.col("_prev")))
        after = F.max(F.when(r == F.col("_base") + F.col("_size"), F.col("_next")))
        return F.coalesce(inside, before, after)

    r0, r1 = F.floor("_pos"), F.ceil("_pos")
    per = sl.groupBy(*g, "_i").agg(at(r0).alias("_v0"), at(r1).alias("_v1"), F.first("_pos").alias("_pos"))
    per = per.withColumn("_v", F.col("_v0") + (F.col("_pos") - F.floor("_pos")) * (F.col("_v1") - F.col("_v0")))
    out = per.groupBy(*g).agg(*[F.max(F.when(F.col("_i") == i, F.col("_v"))).alias(f"q{i}") for i in range(k)])
    return out
