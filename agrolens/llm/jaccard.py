"""Operator 11, n-gram Jaccard join: pivots, Voronoi regions, triangle-inequality windows, recursion.

Documents are sets of distinct word shingles in the Jaccard metric d(A, B) = 1 - |A & B| / |A | B|.

* Pivots are the one-shingle sets {s}: d(A, {s}) = 1 - 1/|A| if A holds s, else 1. All pivots that A
  holds are equally near, so a fixed order of all shingles settles ties: A's Voronoi region is that
  of its first shingle.
* Window: let P be the first j shingles of A. d(A, P) = 1 - j/|A|, and d(B, P) = 1 for a B that holds
  none of them, so d(A, B) >= d(B, P) - d(A, P) = j/|A|. A document linked to A (d <= r) therefore
  holds one of A's first floor(r|A|) + 1 shingles: A is replicated to the regions of just these
  pivots, and every link meets in a region. Two more bounds prune pairs in a region: the
  sizes (d >= 1 - min/max), and what the pivot's places in both documents leave to share. Pairs that
  meet are compared by sketches before their sets are read: with P_k all shingles of hash class k,
  |A & B| is at most the sum of min(|A & P_k|, |B & P_k|).
* Crowded regions (over MAX_REGION classes) are not paired. All members are first compared with the
  one that has the fewest shingles before the pivot, the middle of a group of near copies, which links
  such groups in linear time. A region whose members are then in one component is done. If at most MAX_REGION members lie outside its main component, those are compared
  with the members of other components. Else the region is joined recursively: linked documents that
  share the pivot share a second shingle within windows longer by one, so (pivot, next shingle)
  are the regions of the next level, and so on for LEVELS levels. Behind the last level, pairs of
  different components that still meet are compared; so no link is lost at any size.

Equal sets are one class, so exact copies cost one row. The order puts shingles that are common in a
bounded sample of documents (SAMPLE, at most MAX_COMMON shingles) last and the others by their
hash; every order gives the same links, the sample only saves work. Candidates are verified on
whole sets. Shingles are compared by XXH64 (a collision within a pair changes a count by one; odds
1 in 10^13 for sets of 1000), classes by 128 bits.

Defined results: NULL, empty or blank text has an empty set and is linked with nothing; fewer words
than a shingle make one shingle of all words; repeated rows each get a row; a NULL doc_id takes its
component's smallest non-NULL doc_id (NULL if there is none); an empty table gives no rows;
extra columns are ignored.
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
PERCENT = 90          # linked from this Jaccard similarity on
MAX_REGION = 128      # classes of a region that are paired
LEVELS = 3
SAMPLE = 20_000       # documents whose shingles tell which are common
MAX_COMMON = 500_000  # shingles put last
MIN_COMMON = 2        # documents of the sample that hold a common shingle
CLASSES = 64          # hash classes of shingles that a document's sketch counts
STEP = 1 << 16        # shingles hashed at a time


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one whole text."""
    words = (text or "").encode("utf-8").lower().split()  # bytes: A-Z and the six ASCII spaces only
    if not words:
        return np.zeros(0, dtype=np.int64)
    shingle = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(words) - shingle + 1
    from_, to = starts[:n].tolist(), ends[shingle - 1:].tolist()
    hash_, parts = xxhash.xxh64_intdigest, []
    for a in range(0, n, STEP):
        h = np.fromiter((hash_(joined[s:e]) for s, e in zip(from_[a:a + STEP], to[a:a + STEP])),
                        dtype=np.uint64, count=min(STEP, n - a))
        parts.append(np.unique(h.view(np.int64)))
    return np.unique(np.concatenate(parts)) if len(parts) > 1 else parts[0]


def window(n: int, percent: int = PERCENT) -> int:
    """Pivots of a set of n shingles, one of which every linked set holds."""
    return n - -(-percent * n // 100) + 1


def _row() -> Column:
    return F.xxhash64("doc_id", "text")


def common_shingles(docs: DataFrame, shingle: int, sample: int = SAMPLE) -> np.ndarray:
    """Hashes of the most common shingles of about ``sample`` documents, rarest first."""
    n = docs.count()
    if not n:
        return np.zeros(0, dtype=np.int64)
    grain = 1 << 20
    some = docs.where(F.pmod(_row(), F.lit(grain)) < F.lit(max(1, min(grain, sample * grain // n)))).select("text")

    def run(batches):
        for b in batches:
            parts = [shingle_set(t, shingle) for t in b.column(0).to_pylist()]
            if parts:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in np.unique(np.concatenate(parts), return_counts=True)],
                                                 names=["s", "n"])

    top = (some.mapInArrow(run, "s long, n long").groupBy("s").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COMMON)
           .orderBy(F.desc("n"), "s").limit(MAX_COMMON).toArrow())
    return top.column("s").to_numpy()[::-1].copy()


def _sets(docs: DataFrame, shingle: int, percent: int, common: np.ndarray) -> DataFrame:
    """(doc_id, row, n, cls, near, sketch) of every row: size, class, first shingles (window and deeper levels), and the
    counts of its shingles by hash class (NULL for sets of millions, which are then not told apart by them)."""
    at = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[at], at))  # at most MAX_COMMON longs each

    def run(batches):
        known, place = shared.value
        for b in batches:
            n, cls, near, sketch = [], [], [], []
            for text in b.column(2).to_pylist():
                s = shingle_set(text, shingle)
                n.append(len(s))
                cls.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                last = np.zeros(len(s), dtype=np.int64)
                if len(known):
                    i = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    last = np.where(known[i] == s, place[i] + 1, 0)
                first = np.lexsort((s, last))[:window(len(s), percent) + LEVELS - 1] if len(s) else np.zeros(0, dtype=np.int64)
                near.append(s[first])
                counts = np.bincount(s & CLASSES - 1, minlength=CLASSES)
                sketch.append(counts.astype(np.int16) if counts.max() < 1 << 15 else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int32()), pa.array(cls, pa.binary()),
                                              pa.array(near, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int16()))],
                                             names=["doc_id", "row", "n", "cls", "near", "sketch"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _row().alias("row"), "text").mapInArrow(
        run, "doc_id long, row long, n int, cls binary, near array<long>, sketch array<short>")


def _whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """(cls, s): the whole sets of the classes in ``wanted`` (row, cls), from the texts."""
    def run(batches):
        for b in batches:
            parts = [shingle_set(t, shingle) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(parts, pa.list_(pa.int64()))], names=["cls", "s"])

    texts = (docs.select(_row().alias("__row"), F.col("text").alias("__text"))
             .join(wanted, F.col("__row") == F.col("row")).select("cls", "times", "__text"))
    # rows equal in id and text have one row hash; one of them is taken
    once = texts.where("times = 1").select("cls", "__text")
    repeated = texts.where("times > 1").select("cls", "__text").dropDuplicates(["cls"])
    return once.unionByName(repeated).mapInArrow(run, "cls binary, s array<long>")


def _reachable(classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sketches allow the similarity."""
    def side(c):
        return classes.select(F.col("cls").alias(f"c{c}"), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"k{c}"))

    most = F.coalesce(F.aggregate(F.zip_with("ka", "kb", lambda x, y: F.least(x, y).cast("int")), F.lit(0), lambda x, y: x + y),
                      F.least("na", "nb"))
    return (pairs.join(side("a"), F.col("a") == F.col("ca")).join(side("b"), F.col("b") == F.col("cb"))
            .where((100 + percent) * most >= percent * (F.col("na") + F.col("nb"))).select("a", "b"))


def _verified(docs: DataFrame, classes: DataFrame, pairs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Written links among the written candidate pairs (a, b)."""
    ends = pairs.select(F.col("a").alias("c")).unionByName(pairs.select(F.col("b").alias("c"))).distinct()
    wanted = classes.join(ends, F.col("cls") == F.col("c"), "left_semi").select("row", "cls", "times")
    sets = write_scratch(_whole_sets(docs, wanted, shingle), "jaccard-sets")
    both = F.size(F.array_intersect("sa", "sb"))
    links = write_scratch(
        pairs.join(sets.select(F.col("cls").alias("ca"), F.col("s").alias("sa")), F.col("a") == F.col("ca"))
        .join(sets.select(F.col("cls").alias("cb"), F.col("s").alias("sb")), F.col("b") == F.col("cb"))
        .withColumn("i", both).where(100 * F.col("i") >= percent * (F.size("sa") + F.size("sb") - F.col("i")))
        .select("a", "b"), "jaccard-links")
    drop_scratch(sets)
    return links


def _near_sizes(percent: int) -> Column:
    return 100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n")


def _enough_left(percent: int, level: int) -> Column:
    """What both documents hold from the pivot on, and the ``level`` - 1 pivots before it, can reach the similarity."""
    most = F.least(F.col("l.n") - F.col("l.pos"), F.col("r.n") - F.col("r.pos")) + (level - 1)
    return (100 + percent) * most >= percent * (F.col("l.n") + F.col("r.n"))


def _regions(members: DataFrame, percent: int, level: int) -> DataFrame:
    """Regions of a level from (cls, n, near, key, at): one row for each pivot in the window behind place ``at``."""
    window_ = F.col("n") - F.ceil(F.col("n") * percent / 100) + level
    later = F.slice("near", F.col("at") + 2, F.greatest(window_.cast("int") - F.col("at") - 1, F.lit(0)))
    return (members.select("cls", "n", "key", "at", F.posexplode(later).alias("i", "s"))
            .select("cls", "n", F.xxhash64("key", "s").alias("key") if level > 1 else F.col("s").alias("key"),
                    (F.col("at") + 1 + F.col("i")).alias("at")))


def _shared(side: DataFrame) -> DataFrame:
    """Written members of the regions with more than one, and m, the region's size. One exchange serves count and join."""
    n = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = side.repartition(n, "key")
    sizes = side.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    return write_scratch(side.join(sizes.hint("merge"), F.col("key") == F.col("k")).drop("k"), "jaccard-regions")


def _candidates(side: DataFrame, middles: DataFrame, percent: int, level: int, max_region: int) -> DataFrame:
    """Pairs of small regions, and of crowded ones every member with the region's middle."""
    small = side.where(F.col("m") <= max_region).select("cls", "n", F.col("at").alias("pos"), "key")
    pairs = (small.alias("l").join(small.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.cls") < F.col("r.cls")))
             .where(_near_sizes(percent) & _enough_left(percent, level)).select(F.col("l.cls").alias("a"), F.col("r.cls").alias("b")))
    stars = (side.where(F.col("m") > max_region).join(middles, F.col("key") == F.col("k"))
             .where("cls <> middle").select(F.col("middle").alias("a"), F.col("cls").alias("b")))
    return pairs.unionByName(stars)


def links(docs: DataFrame, classes: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT,
          max_region: int = MAX_REGION) -> tuple[DataFrame, DataFrame]:
    """Written (links, components) that connect exactly the classes joined by chains of links.

    ``classes``: written table (cls, row, times, n, near, sketch) with one row for each distinct set; row is the hash of a
    document's id and text, times the number of such documents.
    """
    members = classes.select("cls", "n", "near", F.lit(0).cast("long").alias("key"), F.lit(-1).alias("at"))
    found, waiting, root = None, None, None
    for level in range(1, LEVELS + 1):
        side = _shared(_regions(members, percent, level))
        middles = write_scratch(
            side.where(F.col("m") > max_region).groupBy(F.col("key").alias("k"))
            .agg(F.min(F.struct("at", "cls")).alias("first"), F.min("n").alias("small"))
            .select("k", F.col("first.cls").alias("middle"), "small"), "jaccard-middles")
        some = _candidates(side, middles, percent, level, max_region)
        if waiting is not None:
            some = some.unionByName(waiting)
        found, root = _grown(docs, classes, some, found, root, shingle, percent)
        crowded = _unsettled(side.drop("m"), middles, root, percent, level)
        drop_scratch(side)
        if crowded.isEmpty():
            return found, root
        outside, rest = _divided(crowded, max_region)
        waiting = _apart(outside, percent, level)
        near = classes.select(F.col("cls").alias("c"), "near")
        members = rest.join(near, F.col("cls") == F.col("c")).drop("c")
    last = write_scratch(rest, "jaccard-crowded")
    waiting = waiting.unionByName(_apart(last.withColumn("main", F.lit(None).cast("binary")), percent, LEVELS))
    return _grown(docs, classes, waiting, found, root, shingle, percent)


def _grown(docs, classes, candidates, found, root, shingle, percent):
    """Links and components with the verified candidates added."""
    pairs = candidates.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    pairs = write_scratch(_reachable(classes, pairs, percent), "jaccard-pairs")
    new = _verified(docs, classes, pairs, shingle, percent)
    drop_scratch(pairs)
    if found is None:
        return new, components(new)
    fresh = new.join(found.select(F.col("a").alias("x"), F.col("b").alias("y")), (F.col("a") == F.col("x")) & (F.col("b") == F.col("y")),
                     "left_anti")
    if fresh.isEmpty():
        return found, root
    found = write_scratch(found.unionByName(fresh), "jaccard-links")
    return found, components(found)


def _unsettled(side: DataFrame, middles: DataFrame, root: DataFrame, percent: int, level: int) -> DataFrame:
    """Written members of crowded regions that lie in more than one component, with root, region size and main component.

    A member goes if what it can share from the pivot on is too little for the smallest partner the region can offer.
    """
    partner = F.greatest(F.col("small"), F.ceil(F.col("n") * percent / 100))
    rows = (side.join(middles.select("k", "small"), F.col("key") == F.col("k"))
            .where((100 + percent) * (F.col("n") - F.col("at") + level - 1) >= percent * (F.col("n") + partner)).drop("k", "small")
            .join(root.select("node", F.col("root").alias("r")), F.col("cls") == F.col("node"), "left")
            .withColumn("root", F.coalesce("r", "cls")).drop("node", "r"))
    parts = rows.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    main = (parts.groupBy(F.col("key").alias("k"))
            .agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("m"), F.count(F.lit(1)).alias("roots"))
            .where("roots > 1").select("k", "m", F.col("top.root").alias("main"), F.col("top.c").alias("inside")))
    return write_scratch(rows.join(main, F.col("key") == F.col("k")).drop("k"), "jaccard-unsettled")


def _divided(crowded: DataFrame, max_region: int) -> tuple[DataFrame, DataFrame]:
    """Members of regions with few outside the main component, and of the regions to join recursively."""
    few = F.col("m") - F.col("inside") <= max_region
    return crowded.where(few), crowded.where(~few).drop("m", "inside", "main")


def _apart(rows: DataFrame, percent: int, level: int) -> DataFrame:
    """Pairs of a region in different components, one of them outside the region's main component."""
    r = rows.select("cls", "n", F.col("at").alias("pos"), "key", "root", "main")
    outside = r.where(F.col("main").isNull() | (F.col("root") != F.col("main")))
    return (outside.alias("l").join(r.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.root") != F.col("r.root")))
            .where(_near_sizes(percent) & _enough_left(percent, level)).select(F.col("l.cls").alias("a"), F.col("r.cls").alias("b")))


def jaccard_groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, max_region: int = MAX_REGION) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    small_batches(docs.sparkSession)
    sets = write_scratch(_sets(docs, shingle, percent, common_shingles(docs, shingle)), "jaccard-docs")
    times = sets.groupBy(F.col("row").alias("r")).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    classes = sets.where("cls is not null").dropDuplicates(["cls"]).join(times, F.col("row") == F.col("r"), "left")
    classes = write_scratch(classes.select("cls", "row", F.coalesce("times", F.lit(1)).alias("times"), "n", "near", "sketch"), "jaccard-classes")
    _, root = links(docs, classes, shingle, percent, max_region)
    least = sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"))
    rooted = (least.join(root, F.col("cls") == F.col("node"), "left")
              .select("cls", "rep", F.coalesce("root", "cls").alias("root")))
    lowest = rooted.groupBy(F.col("root").alias("r")).agg(F.min("rep").alias("component_id"))
    member = write_scratch(rooted.join(lowest, F.col("root") == F.col("r")).select(F.col("cls").alias("c"), "component_id"), "jaccard-members")
    return (sets.select("doc_id", "n", "cls").join(member, F.col("cls") == F.col("c"), "left")
            .select("doc_id", F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))
