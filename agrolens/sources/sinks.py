"""Sinks (S5, S7-S9): partitioned batch files, CSV/parquet tables, reports, JSON summary."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_batches(pages: DataFrame, page_col: str = "page_id", batch_size: int = 100,
                 first_page: int = 1, clip: bool = True) -> DataFrame:
    """Batch of every page: ranges of ``batch_size`` from ``first_page``; the last batch is
    clipped at the last page unless ``clip`` is false, which gives names that stay when later pages arrive.
    Adds batch_start, batch_end and batch ('start_to_end')."""
    if not clip:
        first = (F.floor((F.col(page_col) - first_page) / batch_size) * batch_size + first_page).cast("long")
        return (pages.withColumn("batch_start", first).withColumn("batch_end", F.col("batch_start") + batch_size - 1)
                .withColumn("batch", F.concat_ws("_to_", "batch_start", "batch_end")))
    last = pages.agg(F.max(page_col).alias("_last"))
    start = F.floor((F.col(page_col) - first_page) / batch_size) * batch_size + first_page
    return (pages.crossJoin(F.broadcast(last))
                 .withColumn("batch_start", start.cast("long"))
                 .withColumn("batch_end", F.least(F.col("batch_start") + batch_size - 1, F.col("_last")).cast("long"))
                 .withColumn("batch", F.concat_ws("_to_", "batch_start", "batch_end"))
                 .drop("_last"))


def write_page_batches(df: DataFrame, out_dir: str, fmt: str = "parquet", **kw) -> None:
    """S5 sink: one output directory per batch (``batch=start_to_end``). Batches of ``df`` replace their own
    directories only; other batches under ``out_dir`` stay. Write with ``clip=False`` to re-collect ranges one by one."""
    (page_batches(df, **kw).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").format(fmt).save(out_dir))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    """Write a result table (CSV with header, or parquet)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(path)


def write_report(tables: dict, out_dir: str, fmt: str = "parquet") -> dict:
    """Several named result tables side by side, one sub-directory per name."""
    paths = {}
    for name, df in tables.items():
        p = os.path.join(out_dir, name)
        write_table(df, p, fmt)
        paths[name] = p
    return paths


def summary_document(df: DataFrame, region="township", item="item_category", price="unit_price",
                     top_regions: int = 20) -> DataFrame:
    """The summary as lines (section, key, value): total rows, top regions, all item counts,
    price statistics. One line per key, so no task ever holds all keys; write it as JSON lines.
    """
    from agrolens.operators.aggregates import describe, top_by_count

    def lines(section, t, key, value):
        return t.select(F.lit(section).alias("section"), key.cast("string").alias("key"), value.cast("double").alias("value"))

    stats = describe(df, price)
    pairs = stats.select(F.explode(F.create_map(*[x for c in stats.columns for x in (F.lit(c), F.col(c).cast("double"))])))
    return (lines("rows", df.agg(F.count(F.lit(1)).alias("n")), F.lit("total"), F.col("n"))
            .unionByName(lines("region", top_by_count(df, region, top_regions), F.col(region), F.col("record_count")))
            .unionByName(lines("item", top_by_count(df, item, None), F.col(item), F.col("record_count")))
            .unionByName(lines("price", pairs, F.col("key"), F.col("value"))))


def restore_order(df: DataFrame, col: str = "record_id") -> DataFrame:
    """Results in source order — a sort at the sink only (range-partitioned, distributed)."""
    return df.orderBy(col)
