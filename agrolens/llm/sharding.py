"""Operator 6, sharding by a two-pass external shuffle.

Pass 1 scatters records uniformly into memory-sized buckets by a seeded hash of their key. Pass
2 takes one bucket per task, orders it by content (so a retried task sees the same order),
Fisher-Yates-shuffles it with a generator seeded by (seed, bucket) and writes it. A record's
place in the global permutation is its bucket's offset plus its place in the bucket; places are
dealt to the shards in turn, so shard sizes differ by one row at most (law ``rows``) and slots
are gapless. A shard's records, in slot order, are a uniform random sample of the input.

Records of one doc_id and text share a hash. Where such records fill more than a part of a bucket
(HOT_PART), equal ones are pre-aggregated to one row with their count, spread again in chunks, and each copy
is scattered by its number among them.

Defined results: NULL text has size 8 and the CRC-32 of the empty text; records are scattered
by doc_id and text, so NULL ids spread by their texts, and fully equal rows each get a place
of their own; extra columns travel along in ``write_shards``, whose own columns are called ``__shard`` and
``__slot`` where the records have a column ``shard`` or ``slot``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from agrolens.llm.common import write_scratch

SHARDS = 24
SEED = 20_240_607
BUCKET_BYTES = 16 << 20  # UTF-8 bytes of text in a bucket, so that one fits a worker's memory
MIN_BUCKETS = 240        # so that a small table still spreads over many tasks
TASK_BUCKETS = 4         # buckets that one task shuffles, one after the other
HOT_PART = 8             # records of one hash are spread if together they exceed a bucket / HOT_PART
FILE_BYTES = 128 << 20   # text in a written file


def fisher_yates(n: int, seed) -> np.ndarray:
    """A uniform permutation of range(n): each place swaps with a random one at or below it."""
    order = list(range(n))
    below = np.random.default_rng(seed).random(n)
    for i in range(n - 1, 0, -1):
        j = int(below[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, dtype=np.int64)


def _sized(df: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return (df.withColumn("__size", (F.octet_length(text) + 8).cast("long"))
            .withColumn("__crc", F.crc32(text.cast("binary"))))


def total_size(df: DataFrame) -> int:
    return _sized(df).agg(F.sum("__size")).first()[0] or 0


def bucket_count(total: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    return max(MIN_BUCKETS, -(-total // bucket_bytes))


def own_names(columns: list[str]) -> tuple[str, str]:
    """Names of the shard and slot columns beside ``columns``."""
    taken = {c.lower() for c in columns}
    return tuple(f"__{c}" if c in taken else c for c in ("shard", "slot"))


def _spread_copies(keyed: DataFrame, bucket_bytes: int) -> DataFrame:
    """``keyed`` plus __copy: 0, or the number of a record among fully equal ones of a crowded hash."""
    crowded = (keyed.groupBy(F.col("__key").alias("__hot")).agg(F.count(F.lit(1)).alias("n"), F.sum("__size").alias("size"))
               .where((F.col("n") > 1) & (F.col("size") > bucket_bytes // HOT_PART)).select("__hot"))
    crowded = write_scratch(crowded, "shuffle-crowded")
    if crowded.isEmpty():
        return keyed.withColumn("__copy", F.lit(0).cast("long"))
    same = F.col("__key") == F.col("__hot")
    copies = keyed.join(crowded, same, "left_semi").groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("__n"))
    each = F.greatest(F.lit(1), F.floor(F.lit(bucket_bytes) / F.col("__size"))).cast("long")  # copies in a chunk
    chunks = (copies.withColumn("__each", each)
              .withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__n") - 1, F.col("__each"))))
              .repartition("__key", "__from"))
    spread = chunks.withColumn("__copy", F.explode(F.sequence(
        F.col("__from"), F.least(F.col("__n"), F.col("__from") + F.col("__each")) - 1))).drop("__n", "__each", "__from")
    return keyed.join(crowded, same, "left_anti").withColumn("__copy", F.lit(0).cast("long")).unionByName(spread)


def place(df: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``df`` plus __size, __crc and its place (shard and slot, see ``own_names``)."""
    spark = df.sparkSession
    shard, slot = own_names(df.columns)
    buckets = bucket_count(total_size(df), bucket_bytes)
    key = F.xxhash64(F.lit(seed), "doc_id", "__crc", "__size")
    keyed = _spread_copies(_sized(df).withColumn("__key", key), bucket_bytes)
    drawn = F.when(F.col("__copy") == 0, F.col("__key")).otherwise(F.xxhash64("__key", "__copy"))
    tasks = max(min(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets), -(-buckets // TASK_BUCKETS))
    scattered = (keyed.withColumn("__key", drawn).drop("__copy")
                 .withColumn("__bucket", F.pmod("__key", F.lit(buckets)).cast("int"))
                 .withColumn("__task", F.pmod("__bucket", F.lit(tasks)).cast("int")))
    schema = T.StructType(scattered.schema.fields + [T.StructField("__at", T.LongType())])

    def shuffle(place, rows):
        order = rows.select(["__key", "doc_id", "__crc"]).add_column(0, "i", pa.array(np.arange(len(rows))))
        order = order.sort_by([(c, "ascending") for c in ("__key", "doc_id", "__crc", "i")])
        mixed = order.column("i").to_numpy()[fisher_yates(len(rows), [seed, place[1].as_py()])]
        return rows.take(pa.array(mixed)).append_column("__at", pa.array(np.arange(len(rows))))

    # Buckets are dealt to tasks by number, not by hash, so that each task has as many.
    dealt = scattered.repartitionById(tasks, F.col("__task"))
    written = write_scratch(dealt.groupBy("__task", "__bucket").applyInArrow(shuffle, schema), "shuffled")
    # One row per bucket: BUCKET_BYTES of input each, so a million buckets are 16 TB.
    counts = written.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(F.col("__bucket").alias("__b"), F.coalesce(before, F.lit(0)).alias("__offset"))
    at = F.col("__offset") + F.col("__at")
    return (written.join(offsets, F.col("__bucket") == F.col("__b"))
            .withColumn(shard, F.pmod(at, F.lit(shards)).cast("int"))
            .withColumn(slot, ((at - F.pmod(at, F.lit(shards))) / shards).cast("long"))
            .drop("__key", "__bucket", "__task", "__at", "__b", "__offset"))


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    return place(df.select("doc_id", "text"), shards, seed).select(
        "doc_id", F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.lit("rows").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(df: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED) -> None:
    """Write the records under ``path`` as shard=0 .. shard=n-1, with their slots; a large shard is
    written by several tasks, as files that hold consecutive slots."""
    shard, slot = own_names(df.columns)
    files = max(shards, -(-total_size(df) // FILE_BYTES))
    (place(df, shards, seed).drop("__size", "__crc")
     .repartitionByRange(files, shard, slot).sortWithinPartitions(shard, slot)
     .write.partitionBy(shard).parquet(path))
