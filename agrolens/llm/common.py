"""Shared helpers: table reading, scratch tables in the shared folder, word arrays."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolens.session import scratch_path

# Fixed value: the white space that separates words, as a regex class (space, tab .. carriage return).
SPACE_CLASS = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def write_scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and return the written table.

    This cuts lineage: a lost executor costs a re-read of files, not a re-run of the job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def drop_scratch(df: DataFrame) -> None:
    """Delete the files of a table from ``write_scratch`` (call it only once no plan reads it)."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/tables/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL text gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS + "+"), "")


def bind(value: Column, fn) -> Column:
    """``fn(value)`` with ``value`` evaluated once per row, however often ``fn`` uses it."""
    return F.transform(F.array(value), fn).getItem(0)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, so that a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
