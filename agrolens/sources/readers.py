"""Record readers (S1-S3, S6): explicit all-text schema at the boundary, no inference."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolens.operators.joins import union_batches
from agrolens.session import scratch_path

REPLACEMENT_CHAR = "�"


def read_records(spark: SparkSession, path, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Load a record table. Text formats are read all-string (header names kept)."""
    r = spark.read.options(**options)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", False)
    elif fmt == "json":
        r = r.option("primitivesAsString", True)
    if schema is not None:
        r = r.schema(schema)
    return r.format(fmt).load(path)


def read_csv_any(spark: SparkSession, path, fallback: str = "GBK", **options) -> DataFrame:
    """CSV files in UTF-8 or ``fallback``, decided for each file on its bytes.

    A file whose lines are all valid UTF-8 is read as UTF-8 (also if it holds a legitimate
    U+FFFD), any other one with ``fallback``; where that does not fit either, ValueError. Files
    of both kinds are stacked by column name. The text scan that decides is distributed; file
    names reach the driver, as for any read. Files in ``fallback`` are written once to the shared
    checkpoint folder, so that Spark's legacy charset switch can be restored.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.is_valid_utf8("value").alias("ok"))
    kind = {r["file"]: r["ok"] for r in lines.groupBy("file").agg(F.bool_and("ok").alias("ok")).collect()}
    good = sorted(f for f, ok in kind.items() if ok)
    other = sorted(f for f, ok in kind.items() if not ok)
    parts = [read_records(spark, good, "csv", encoding="UTF-8", **options)] if good else []
    if other:
        key = "spark.sql.legacy.javaCharsets"
        old = spark.conf.get(key)
        spark.conf.set(key, "true")
        try:
            path_ = scratch_path(spark, f"csv-{uuid.uuid4().hex[:12]}")  # Spark checks the switch when the scan runs
            read_records(spark, other, "csv", encoding=fallback, **options).write.parquet(path_)
            part = spark.read.parquet(path_)
            odd = reduce(lambda x, y: x | y, [F.col(f"`{c}`").contains(REPLACEMENT_CHAR) for c in part.columns])
            if any(REPLACEMENT_CHAR in c for c in part.columns) or part.where(odd).limit(1).take(1):
                raise ValueError(f"{path}: neither UTF-8 nor {fallback}")
        finally:
            spark.conf.set(key, old)
        parts.append(part)
    return union_batches(parts) if parts else read_records(spark, path, "csv", **options)


def merge_batches(spark: SparkSession, paths, fmt: str = "parquet", **options) -> DataFrame:
    """Stack batch outputs by column name (missing columns -> NULL)."""
    return union_batches(read_records(spark, p, fmt, **options) for p in paths)
