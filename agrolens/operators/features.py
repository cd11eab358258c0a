"""Reproducible split, ordered target statistics and regression metrics (M2, M6-M8).

Randomness is a hash of the record content, never ``rand()``: the same row
lands in the same split / order on every run, partitioning and task retry.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from agrolens.functions.clean import category_text
from agrolens.session import release_shuffles, scratch_path


def hash_bucket(key: str = "record_key", buckets: int = 100) -> F.Column:
    """0..buckets-1 from the first 32 bits of md5(key)."""
    return (F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
            % buckets)


def split_train_test(df: DataFrame, key: str = "record_key", test_pct: int = 20,
                     col: str = "is_test") -> DataFrame:
    """M2: ~80/20 split by md5 bucket (stable across partitionings)."""
    return df.withColumn(col, hash_bucket(key) >= (100 - test_pct))


def choose_split_hex(n_rows: int, max_slice_rows: int = 1_000_000) -> int:
    """Fewest leading hex digits k such that a slice (1/16**k of a category) stays below
    ``max_slice_rows`` rows even when one category holds every row."""
    k = 0
    while n_rows > max_slice_rows * 16 ** k and k < 8:
        k += 1
    return k


def ordered_target_encoding(df: DataFrame, cat: str, target: str, order_key: str = "record_key",
                            out: str | None = None, prior=None, split_hex: int | None = None) -> DataFrame:
    """M6: ordered target statistic (sum of earlier targets + prior) / (earlier count + 1),
    rows of a category ordered by md5(order_key).

    A category may hold a third of all rows, so it is cut into 16**split_hex
    slices by the leading hex digits of the hash (the ordering key itself):
    slice totals (aggregate) give each slice's prefix, a window over the few
    slice totals per category accumulates them, and the running sum inside a
    slice is a window over ~1/16**split_hex of the category. ``split_hex=None`` sizes the
    slices from the row count (one count job); the result is the same for every value.
    """
    out = out or f"{cat}_enc"
    if split_hex is None:
        split_hex = choose_split_hex(df.count())
    d = df.withColumn("_h", F.md5(F.col(order_key).cast("string"))) \
          .withColumn("_s", F.substring("_h", 1, split_hex))
    pr = _prior_df(d, target, prior)
    sl = d.groupBy(cat, "_s").agg(F.sum(target).alias("_ss"), F.count(target).alias("_sn"))
    wp = Window.partitionBy(cat).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sl = (sl.withColumn("_ps", F.coalesce(F.sum("_ss").over(wp), F.lit(0.0)))
            .withColumn("_pn", F.coalesce(F.sum("_sn").over(wp), F.lit(0))).drop("_ss", "_sn"))
    wi = Window.partitionBy(cat, "_s").orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)
    j = (d.join(sl, [cat, "_s"], "left").crossJoin(F.broadcast(pr))
          .withColumn("_ws", F.coalesce(F.sum(target).over(wi), F.lit(0.0)))
          .withColumn("_wn", F.coalesce(F.count(target).over(wi), F.lit(0))))
    enc = (F.col("_ps") + F.col("_ws") + F.col("_prior")) / (F.col("_pn") + F.col("_wn") + 1)
    return j.withColumn(out, enc).drop("_h", "_s", "_ps", "_pn", "_ws", "_wn", "_prior")


def _prior_df(df: DataFrame, target: str, prior) -> DataFrame:
    """One-row DataFrame with column _prior: the target mean, a given number, or a given one-row DF."""
    if prior is None:
        return df.agg(F.avg(target).alias("_prior"))
    if isinstance(prior, DataFrame):
        return prior.select(F.col(prior.columns[0]).alias("_prior"))
    return df.sparkSession.range(1).select(F.lit(float(prior)).alias("_prior"))


def ordered_target_encode_all(df: DataFrame, cats, target: str, order_key: str = "record_key",
                              prior=None, split_hex: int | None = None) -> DataFrame:
    """M6 for several categorical columns: one shared prior, one encoding step per column.

    Each step is persisted and materialised before the next one is planned, and
    the previous step released, so no step re-derives the chain before it.
    """
    pr = _prior_df(df, target, prior).persist()
    if split_hex is None:
        split_hex = choose_split_hex(df.count())
    cur, prev = df, None
    for c in cats:
        nxt = ordered_target_encoding(cur, c, target, order_key, prior=pr, split_hex=split_hex).persist()
        nxt.count()
        if prev is not None:
            prev.unpersist()
        prev = cur = nxt
    return cur


SLICE_ROWS = 250_000


def ordered_target_columns(df: DataFrame, cats, target: str, order_key: str, prior: float, slices: int | None = None,
                           order: int | None = None, source: DataFrame | None = None, keep=None) -> DataFrame:
    """M6 for several text columns without missing levels, one prior: ``df`` plus ``<column>_enc`` as in ``ordered_target_encoding``
    (``order``: ``<column>_enc<order>``, by md5 of key, colon and order).

    Rows are dealt once, by slices of the hash that orders them. All running sums inside a slice are taken over that one
    shuffle, by one task a slice; the sums before a slice come from totals by (column, level, slice) and arrive as extra rows of the slice.
    A slice holds about ``SLICE_ROWS`` rows, whatever levels they have. ``source``: the rows that ``df`` was derived from one to
    one, with the same key, levels and target; totals are then taken from them. ``keep``: the columns of ``df`` to return (default: all).
    """
    if slices is None:
        slices = max(1, -(-df.count() // SLICE_ROWS))
    key, end = F.col(order_key).cast("string"), "" if order is None else str(order)
    hashed = F.md5(key if order is None else F.concat_ws(":", key, F.lit(end)))
    first = F.conv(F.substring(hashed, 1, 8), 16, 10).cast("bigint")
    slice_ = F.shiftright(first * F.lit(slices), 32).cast("int").alias("_p")
    d = df.select("*", slice_)
    at, sums, counts = "_at", "_ps", "_pn"
    if slices > 1:
        pairs = (df if source is None else source).select(slice_, F.col(target).alias("_t"), F.posexplode(F.array(*cats)).alias(at, "_l"))
        totals = pairs.groupBy(at, "_l", "_p").agg(F.sum("_t").alias("_ss"), F.count("_t").alias("_sn"))
        before = Window.partitionBy(at, "_l").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
        ahead = (totals.select(at, "_l", "_p", F.sum("_ss").over(before).alias(sums), F.sum("_sn").over(before).alias(counts))
                 .where(F.col(counts) > 0))
        d = d.unionByName(ahead.select("_p", at, sums, counts, *[F.when(F.col(at) == i, F.col("_l")).alias(c) for i, c in enumerate(cats)]),
                          allowMissingColumns=True)
    else:
        d = d.select("*", F.lit(None).cast("int").alias(at), F.lit(0.0).alias(sums), F.lit(0).cast("bigint").alias(counts))
    d = d.repartition("_p").withColumn("_h", F.when(F.col(at).isNull(), F.unhex(hashed))).withColumn("_y", F.col(target).cast("double"))
    names, columns, value = [f"{c}_enc{end}" for c in cats], list(df.columns if keep is None else keep), float(prior)

    def encode(t):
        return _encode_slice(t, list(cats), columns, names, value)

    return d.groupBy("_p").applyInArrow(encode, T.StructType([*[df.schema[c] for c in columns], *[T.StructField(c, T.DoubleType()) for c in names]]))


def _encode_slice(t: pa.Table, cats: list, columns: list, names: list, prior: float) -> pa.Table:
    """The rows of a slice with their statistics. Rows with ``_at`` tell the sums (``_ps``, ``_pn``) of a level of that column before
    the slice; the others are taken in the order of ``_h`` and returned by level of the last column and ``_h``."""
    own, told = t.filter(t.column("_at").is_null()), t.filter(t.column("_at").is_valid())
    out = own.select(columns)
    if not own.num_rows:
        return pa.Table.from_arrays([*out.columns, *[pa.array([], pa.float64())] * len(names)], names=[*columns, *names])
    h = pc.fill_null(own.column("_h"), bytes(16)).combine_chunks().cast(pa.binary(16))
    high, low = np.frombuffer(h.buffers()[1], dtype=">u8", count=2 * len(h), offset=16 * h.offset).reshape(-1, 2).astype(np.uint64).T
    order = np.argsort(high, kind="stable")
    if (np.diff(high[order]) == 0).any():
        order = np.lexsort((low, high))
    y = own.column("_y").to_numpy()[order]
    there = ~own.column("_y").is_null().to_numpy()[order]
    y = np.where(there, y, 0.0)
    told_at = told.column("_at").to_numpy()
    for i, (c, name) in enumerate(zip(cats, names)):
        levels = own.column(c).combine_chunks().dictionary_encode(null_encoding="encode")
        codes, k = levels.indices.to_numpy(), len(levels.dictionary)
        before, counts = np.zeros(k), np.zeros(k, dtype=np.int64)
        mine = told.filter(pa.array(told_at == i))
        if mine.num_rows:
            to = pc.index_in(mine.column(c), value_set=levels.dictionary)
            known = to.is_valid().to_numpy()
            to = to.to_numpy()[known].astype(np.int64)
            before[to] = pc.fill_null(mine.column("_ps"), 0.0).to_numpy()[known]
            counts[to] = pc.fill_null(mine.column("_pn"), 0).to_numpy()[known]
        rank = np.empty(k, dtype=np.uint16 if k <= 1 << 16 else np.int64)  # short codes are sorted by counting
        place = pc.array_sort_indices(levels.dictionary, null_placement="at_start").to_numpy()
        rank[place] = np.arange(k)
        before, counts, codes = before[place], counts[place], rank[codes[order]]
        by = np.argsort(codes, kind="stable")
        codes = codes[by]
        total, n = _sums_before(y[by], codes), _counts_before(there[by], codes)
        enc = np.empty(len(y))
        enc[order[by]] = (before[codes] + total + prior) / (counts[codes] + n + 1)
        out = out.append_column(name, pa.array(enc))
    return out.take(pa.array(order[by]))


def _starts(codes: np.ndarray) -> np.ndarray:
    """For every row of sorted ``codes`` the place where its code begins."""
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return np.repeat(first, np.diff(np.append(first, len(codes))))


def _counts_before(there: np.ndarray, codes: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(there)])
    return run[:-1] - run[_starts(codes)]


def _sums_before(y: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Sum of the earlier values of the same code. One running sum serves all codes: its large part is summed in whole
    multiples of a power of two, exactly, and the rests are too small to leave a mark."""
    most = np.abs(y).max()
    if not np.isfinite(most):  # such values spoil the later sums of their own code only
        return np.concatenate([np.concatenate([[0.0], np.cumsum(x)[:-1]]) for x in np.split(y, np.unique(_starts(codes))[1:])])
    if most == 0:
        return np.zeros(len(y))
    at, (_, bits) = _starts(codes), np.frexp(most)
    unit = 61 - int(len(y)).bit_length() - int(bits)
    large = np.rint(np.ldexp(y, unit))
    rest = y - np.ldexp(large, -unit)
    large, rest = (np.concatenate([[0], np.cumsum(x)]) for x in (large.astype(np.int64), rest))
    return np.ldexp((large[:-1] - large[at]).astype(np.float64), -unit) + (rest[:-1] - rest[at])


def _step(df: DataFrame, before: DataFrame | None) -> DataFrame:
    """``df`` written, so that its shuffle and the step ``before`` it need no disk while the next one runs."""
    spark = df.sparkSession
    path = scratch_path(spark, "order-" + uuid.uuid4().hex[:12])
    df.write.option("compression", "zstd").parquet(path)
    if before is not None:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(before.inputFiles()[0]).getParent()
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    release_shuffles(spark)
    return spark.read.parquet(path)


def ordered_target_orders(df: DataFrame, cats, target: str, order_key: str = "record_key", orders: int = 1,
                          prior: float | None = None, split_hex: int | None = None) -> DataFrame:
    """M6 over several orders: (order_key, <column>_enc<o>) with the ordered target statistic of every categorical column in
    each of ``orders`` seeded orders of the rows (order o: by md5 of key, colon and o).

    An order takes one shuffle of the rows by slices of that order, as in ``ordered_target_columns``, so a level that holds most
    rows is dealt over many tasks; it is written before the next order begins, and the table before it deleted. ``order_key`` must be unique (of rows with one key,
    the largest statistics stay). Missing levels are 'NA'. ``split_hex``: 16**split_hex slices.
    """
    d = _step(df.select(F.col(order_key), F.col(target), *[category_text(c).alias(c) for c in cats]), None)
    n = d.count()
    pr = float(prior) if prior is not None else d.agg(F.avg(target)).first()[0]
    slices = 16 ** split_hex if split_hex is not None else max(1, -(-n // SLICE_ROWS))
    hashes = d.groupBy(F.xxhash64(order_key).alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
    unique = hashes.where(F.col("_n") > 1).isEmpty()
    done = []
    for o in range(orders if n else 0):
        keep = [order_key, *done] if o == orders - 1 else None
        encoded = ordered_target_columns(d, cats, target, order_key, pr, slices, o, keep=keep)
        done += [f"{c}_enc{o}" for c in cats]
        d = _step(encoded, d) if o < orders - 1 else encoded
    encoded = [f"{c}_enc{o}" for o in range(orders) for c in cats]
    if not n:
        return d.select(order_key, *[F.lit(None).cast("double").alias(c) for c in encoded])
    if unique:
        return d.select(order_key, *encoded)
    return d.groupBy(order_key).agg(*[F.max(c).alias(c) for c in encoded])


def category_means(df: DataFrame, cat: str, target: str, out: str | None = None, prior=None) -> DataFrame:
    """M6 at scoring time: full-data (sum + prior) / (count + 1) per category."""
    out = out or f"{cat}_enc"
    pr = _prior_df(df, target, prior)
    return (df.groupBy(cat).agg(F.sum(target).alias("_s"), F.count(target).alias("_n"))
              .crossJoin(F.broadcast(pr))
              .select(cat, ((F.col("_s") + F.col("_prior")) / (F.col("_n") + 1)).alias(out)))


def regression_metrics(scored: DataFrame, actual: str = "actual_price",
                       pred: str = "predicted_price") -> DataFrame:
    """M7/M8: one row — n, mse, rmse, r2, mae and the population std of |error|."""
    e = F.col(actual) - F.col(pred)
    d = scored.where(F.col(actual).isNotNull() & F.col(pred).isNotNull())
    m = d.agg(F.count(F.lit(1)).alias("n"),
              F.avg(e * e).alias("mse"),
              F.avg(F.abs(e)).alias("mae"),
              F.stddev_pop(F.abs(e)).alias("mae_std"),
              F.var_pop(actual).alias("_vy"))
    return m.select("n", "mse", F.sqrt("mse").alias("rmse"),
                    (1 - F.col("mse") / F.nullif(F.col("_vy"), F.lit(0.0))).alias("r2"),
                    "mae", "mae_std")
