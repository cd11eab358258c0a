"""Operator 3, SimHash near-dedup: block keys and one-bit codes find links, pivot distance tables filter pairs.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, word shingles with repeats, XXH64
(seed 42) of each; a bit is set if it is set in over half the hashes. Equal fingerprints are
one class, so groups of exact copies cost one row.

Links (at most ``max_bits`` = 2 differing bits) between classes:

1. Candidate pairs share two of four 16-bit blocks (two differing bits touch at most two
   blocks), found by an equi-join on six 32-bit keys.
2. Each class has a pivot table: its Hamming distances to PIVOTS fixed reference fingerprints,
   packed 8 to a long. A pair whose distances to some reference differ by over ``max_bits``
   cannot be a link (triangle inequality) and is discarded; survivors are verified.
3. A key shared by more than MAX_BUCKET classes would make pairs quadratic in its size. Its
   classes are linked in an exact other way: two fingerprints differ by at most two bits iff
   some code lies within one bit of both, so each class emits the 65 codes within one bit of
   it, and the classes that meet at a code (65 at most) are linked to the smallest of them.

Components come from minimum labels over the links. Every step is a grouped aggregate or an
equi-join; no pair list within a group, nothing at the driver.

Defined results: NULL, empty or blank text has fingerprint zero, linked like any other; fewer
words than a shingle make one shingle of all words; repeated rows each get a row; a NULL
doc_id gets its fingerprint's component, which takes its smallest non-NULL doc_id as id (NULL
if there is none); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrolens.llm.common import drop_scratch, small_batches, write_scratch
from agrolens.llm.components import components

SHINGLE = 3
MAX_BITS = 2
MAX_BUCKET = 16      # classes of a block key that are still paired; larger keys go the exact other way
PIVOTS = 16          # reference fingerprints
STEP = 1 << 16       # shingles hashed at a time, so that very long texts stay in bounded memory
_BLOCK_PAIRS = [(i, j) for i in range(4) for j in range(i + 1, 4)]


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints: XXH64 of their numbers."""
    return [xxhash.xxh64_intdigest(f"pivot {i}", seed=42) for i in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one whole text, unsigned."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return 0
    if len(words) < shingle:
        shingle = len(words)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    from_, to = starts[:n].tolist(), ends[shingle - 1:].tolist()
    votes = np.zeros(64, dtype=np.int64)
    hash_ = xxhash.xxh64_intdigest
    for a in range(0, n, STEP):
        h = np.fromiter((hash_(joined[s:e], 42) for s, e in zip(from_[a:a + STEP], to[a:a + STEP])),
                        dtype=np.uint64, count=min(STEP, n - a))
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(doc_id, fp) with fp as a signed long, for every row; with ``keyed`` also key, the hash of id and text."""
    small_batches(docs.sparkSession)
    keep = ["doc_id", "key"] if keyed else ["doc_id"]

    def run(batches):
        for b in batches:
            fp = [_signed(fingerprint(t, shingle)) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.array(fp, pa.int64())], names=[*keep, "fp"])

    cols = {"doc_id": F.col("doc_id").cast("long"), "key": _row_key().alias("key")}
    return docs.select(*[cols[c] for c in keep], "text").mapInArrow(run, ", ".join(f"{c} long" for c in [*keep, "fp"]))


def _row_key() -> Column:
    return F.xxhash64("doc_id", "text")


def _hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(classes: DataFrame, n: int = PIVOTS) -> DataFrame:
    """Add p0, p1, ...: distances to the reference fingerprints, 8 to a long."""
    refs = pivots(n)
    for k in range(0, n, 8):
        packed = F.lit(0).cast("long")
        for i, ref in enumerate(refs[k:k + 8]):
            packed = packed.bitwiseOR(F.shiftleft(_hamming(F.col("fp"), F.lit(_signed(ref))).cast("long"), 8 * i))
        classes = classes.withColumn(f"p{k // 8}", packed)
    return classes


def _near_in_pivots(n: int, max_bits: int) -> Column:
    """True unless some reference tells the pair (l, r) apart by over max_bits."""
    ok = F.lit(True)
    for k in range(n):
        at = [F.shiftrightunsigned(F.col(f"{s}.p{k // 8}"), 8 * (k % 8)).bitwiseAND(F.lit(255)) for s in "lr"]
        ok = ok & (F.abs(at[0] - at[1]) <= max_bits)
    return ok


def _block_keys() -> Column:
    block = [F.shiftrightunsigned(F.col("fp"), 16 * i).bitwiseAND(F.lit(0xFFFF)) for i in range(4)]
    return F.array(*[F.lit(k << 32).bitwiseOR(F.shiftleft(block[i], 16)).bitwiseOR(block[j])
                     for k, (i, j) in enumerate(_BLOCK_PAIRS)])


def links(classes: DataFrame, max_bits: int = MAX_BITS, max_bucket: int = MAX_BUCKET) -> tuple[DataFrame, list]:
    """Links (a, b) that connect exactly the classes linked by chains of <= max_bits steps,
    and the written tables they read. ``classes``: written table of distinct fp."""
    if max_bits != 2:
        raise ValueError("block keys and one-bit codes are lossless for max_bits = 2")
    keyed = pivot_table(classes).select("fp", "p0", "p1", F.explode(_block_keys()).alias("key"))
    sizes = write_scratch(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "simhash-keys")
    few = sizes.where(F.col("n") <= max_bucket).select(F.col("key").alias("k"))
    side = keyed.join(few, keyed.key == few.k, "left_semi")
    pairs = (side.alias("l").join(side.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.fp") < F.col("r.fp")))
             .where(_near_in_pivots(PIVOTS, max_bits))
             .where(_hamming(F.col("l.fp"), F.col("r.fp")) <= max_bits)
             .select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")))

    many = sizes.where(F.col("n") > max_bucket).select(F.col("key").alias("k"))
    crowded = keyed.select("fp", "key").join(many, F.col("key") == F.col("k"), "left_semi").select("fp").distinct()
    codes = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << i)).cast("long") for i in range(64)])
    met = (crowded.select("fp", F.explode(codes).alias("flip"))
           .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("code"))
           .agg(F.collect_list("fp").alias("fps"))  # 65 at most: the code itself and its one-bit neighbours
           .where(F.size("fps") > 1))
    stars = (met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b"))
    return pairs.unionByName(stars).distinct(), [sizes]


def _rooted(prints: DataFrame, max_bits: int) -> DataFrame:
    """(fp, rep, root): of every distinct fingerprint its smallest doc_id and its component."""
    classes = write_scratch(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found, used = links(classes, max_bits)
    root = components(found)
    for t in used:
        drop_scratch(t)
    return (classes.join(root, classes.fp == root.node, "left")
            .select("fp", "rep", F.coalesce("root", "fp").alias("root")))


def simhash_groups(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``docs``."""
    prints = write_scratch(fingerprints(docs, shingle), "simhash-prints")
    rooted = _rooted(prints, max_bits)
    lowest = rooted.groupBy("root").agg(F.min("rep").alias("component_id")).withColumnRenamed("root", "r")
    member = write_scratch(rooted.join(lowest, F.col("root") == F.col("r"))
                           .select(F.col("fp").alias("f"), "component_id"), "simhash-members")
    return (prints.join(member, F.col("fp") == F.col("f"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def drop_near_copies(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of ``docs`` for each component: that of its smallest doc_id (a row without one only if
    no row of the component has any).

    Rows are told apart by a hash of doc_id and text. Among rows of one doc_id (or of none) in a
    component the one with the smallest fingerprint, then the smallest hash, stays; of rows equal
    in both columns the smallest by all columns.
    """
    prints = write_scratch(fingerprints(docs, shingle, keyed=True), "simhash-prints")
    # Reduced to one row a fingerprint before the components are joined, so a hot text or id is one row.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "fp", "key"))
    own = prints.groupBy(F.col("fp").alias("f")).agg(first.alias("first"))
    own = own.join(_rooted(prints, max_bits).select("fp", "root"), F.col("f") == F.col("fp"))
    own = own.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.key").alias("__kept"))
    rows = prints.groupBy("key").agg(F.count(F.lit(1)).alias("__n"))
    own = write_scratch(rows.join(own, F.col("key") == F.col("__kept"), "left_semi")
                        .select(F.col("key").alias("__kept"), "__n"), "simhash-kept")
    keyed = docs.withColumn("__key", _row_key())

    def only(which):
        return keyed.join(own.where(which).select("__kept"), F.col("__key") == F.col("__kept"), "left_semi")

    single = only("__n = 1").drop("__key")
    if own.where("__n > 1").isEmpty():
        return single
    repeated = only("__n > 1").groupBy("__key").agg(F.min(F.struct(*docs.columns)).alias("__row")).select("__row.*")
    return single.unionByName(repeated)
