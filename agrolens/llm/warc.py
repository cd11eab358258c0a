"""Operator 9, WARC: Merkle fixity audit of archive replicas.

Pages become WARC response records, grouped into archives of consecutive page ids. A leaf is a
record: SHA-256 of its bytes, its size and its offset range in the archive. Its node is the page
id's place among the archive's ids, so a dropped or inserted record moves no other record to
another node. A node's digest covers the keys, sizes and digests below it, which fix the order
and the offset ranges from the node's start; offsets from the archive's start stand beside the
digests, so a record whose length changed leaves all others alone. Trees are written as one
table (archive, level, node, first offset, end offset, digest, page_id, size, copies).

The audit joins the roots of two replicas and goes down only under roots that differ, one join
per level, until the leaves: it reads the branches with damage and prunes all others. Leaves are
matched by page and digest; what is left over on both sides of a page is paired as altered.

Defined results: NULL url or html is empty; a NULL page_id goes to one of NULL_ARCHIVES archives by
its content (so an altered page without an id is missing there and extra elsewhere); records of one
page are ordered by digest; equal records of a page are one leaf with a number of copies, and
each copy that only one replica has is a row of its own; a record that only one replica has is
reported with that side's range; empty replicas agree. No archive or page is gathered whole in
one task while trees are built, however many records have its id: equal ones are counted first,
others are cut by digest. Only the damaged records of one page are numbered in one sorted stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agrolens.llm.common import write_scratch

FANOUT = 16
PAGES_PER_ARCHIVE = 1024
NULL_ARCHIVES = 4096


def record_head(url: Column, html: Column) -> Column:
    """Header block of a WARC response record."""
    return F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(F.coalesce(html, F.lit(""))).cast("string"), F.lit("\r\n\r\n"))


def records(pages: DataFrame) -> DataFrame:
    """(archive, page_id, record): the bytes of every page's record, as text."""
    record = F.concat(record_head(F.col("url"), F.col("html")), F.coalesce("html", F.lit("")), F.lit("\r\n\r\n"))
    spare = -1 - F.crc32(record.cast("binary")) % NULL_ARCHIVES
    archive = F.coalesce(F.floor(F.col("page_id") / PAGES_PER_ARCHIVE).cast("long"), spare)
    return pages.select(archive.alias("archive"), "page_id", record.alias("record"))


def leaves(recs: DataFrame) -> DataFrame:
    """Level 0 of the trees: node, offset range, digest, page_id, size and copies of every record.

    Only ids, lengths and digests are shuffled. An archive's running offset is a window over the
    sums of its (page, digest prefix) slices, then one inside a slice.
    """
    hashed = (recs.select("archive", "page_id", F.octet_length("record").cast("long").alias("size"),
                          F.sha2("record", 256).alias("digest"))
              .groupBy("archive", "page_id", "digest", "size").agg(F.count(F.lit(1)).alias("copies"))
              .withColumn("slice", F.substring("digest", 1, 3)))
    held = write_scratch(hashed, "merkle-records")
    total = F.sum(F.col("size") * F.col("copies"))
    upto = Window.partitionBy("archive").orderBy(F.col("page_id").asc_nulls_last(), "slice")
    slices = (held.groupBy("archive", "page_id", "slice").agg(total.alias("bytes"))
              .select(F.col("archive").alias("a"), F.col("page_id").alias("p"), F.col("slice").alias("s"),
                      (F.sum("bytes").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("bytes"))
                      .alias("start")))
    inside = Window.partitionBy("archive", "page_id", "slice").orderBy("digest")
    end = F.col("start") + total.over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    same = (F.col("archive") == F.col("a")) & F.col("page_id").eqNullSafe(F.col("p")) & (F.col("slice") == F.col("s"))
    return (held.join(slices, same).withColumn("end", end)
            .select("archive", F.lit(0).alias("level"),
                    F.coalesce(F.pmod("page_id", F.lit(PAGES_PER_ARCHIVE)), F.lit(0)).cast("long").alias("node"),
                    (F.col("end") - F.col("size") * F.col("copies")).alias("first"), "end", "digest", "page_id", "size", "copies"))


def tree(recs: DataFrame) -> DataFrame:
    """The written Merkle trees of all archives: every level up to a single root node each.

    A node over leaves adds up digests of them (four sums of 60 bits), so that it needs no list of
    a page's records; a node over nodes hashes the list of its FANOUT children at most.
    """
    level = write_scratch(leaves(recs), "merkle")
    told = F.sha2(F.concat_ws(":", F.coalesce(F.col("page_id").cast("string"), F.lit("")), "size", "copies", "digest"), 256)
    sums = [F.sum(F.conv(F.substring("told", 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)")) for i in range(4)]
    up = F.floor(F.col("node") / FANOUT).cast("long")
    none = [F.lit(None).cast("long").alias(c) for c in ("page_id", "size", "copies")]
    levels = [level]
    level = write_scratch(
        level.withColumn("told", told).groupBy("archive", up.alias("node"))
        .agg(F.min("first").alias("first"), F.max("end").alias("end"),
             F.sha2(F.concat_ws(":", *[x.cast("string") for x in sums]), 256).alias("digest"))
        .select("archive", F.lit(1).alias("level"), "node", "first", "end", "digest", *none), "merkle")
    levels.append(level)
    width = -(-PAGES_PER_ARCHIVE // FANOUT)
    while width > 1:
        width = -(-width // FANOUT)
        child = F.struct("node", (F.col("end") - F.col("first")).alias("size"), "digest")
        kids = level.groupBy("archive", up.alias("up")).agg(
            F.array_sort(F.collect_list(child)).alias("kids"),  # FANOUT at most
            F.min("first").alias("first"), F.max("end").alias("end"))
        text = F.array_join(F.transform("kids", lambda k: F.concat_ws(":", k["node"], k["size"], k["digest"])), ",")
        level = write_scratch(kids.select("archive", F.lit(len(levels)).alias("level"), F.col("up").alias("node"), "first", "end",
                                          F.sha2(text, 256).alias("digest"), *none), "merkle")
        levels.append(level)
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


def audit(one: DataFrame, two: DataFrame) -> DataFrame:
    """Differing leaves of two replicas' trees: archive, node, page_id, first, end, state.

    state: altered (other bytes), missing (not in ``two``), extra (only there). A record that
    merely moved, because an earlier one is longer, shorter, missing or extra, is not reported.
    """
    top = max((t.agg(F.max("level")).first()[0] or 0 for t in (one, two)))

    def side(t, level, name):
        return t.where(F.col("level") == level).select(
            "archive", "node", *[F.col(c).alias(f"{name}_{c}") for c in ("first", "end", "digest", "page_id", "size", "copies")])

    def under(t, level, bad):
        if bad is None:
            return t
        low = t.where(F.col("level") == level)
        return low.join(bad, (low.archive == bad.archive) & (F.floor(low.node / FANOUT) == bad.up), "left_semi")

    bad = None
    for level in range(top, 0, -1):
        pair = side(under(one, level, bad), level, "a").join(side(under(two, level, bad), level, "b"), ["archive", "node"], "full")
        bad = write_scratch(pair.where(~F.col("a_digest").eqNullSafe(F.col("b_digest")))
                            .select("archive", F.col("node").alias("up")), "merkle-bad")
    a, b = side(under(one, 0, bad), 0, "a"), side(under(two, 0, bad), 0, "b").withColumnsRenamed({"archive": "b_archive", "node": "b_node"})
    pair = a.join(b, (F.col("archive") == F.col("b_archive")) & F.col("a_page_id").eqNullSafe(F.col("b_page_id"))
                  & (F.col("a_digest") == F.col("b_digest")), "full")
    has, other = F.coalesce("a_copies", F.lit(0)), F.coalesce("b_copies", F.lit(0))

    def surplus(name, mine, theirs):
        """The copies that only one side has, numbered within their page."""
        at = F.col(f"{name}_first") + F.col("copy") * F.col(f"{name}_size")
        return (pair.where(mine > theirs).withColumn("copy", F.explode(F.sequence(theirs, mine - 1)))
                .select(F.coalesce("archive", "b_archive").alias("archive"), F.coalesce("node", "b_node").alias("node"),
                        F.col(f"{name}_page_id").alias("page_id"), at.alias("first"), (at + F.col(f"{name}_size")).alias("end"))
                .withColumn("n", F.row_number().over(Window.partitionBy("archive", "page_id").orderBy("first"))))

    lost = write_scratch(surplus("a", has, other), "merkle-lost")
    new = write_scratch(surplus("b", other, has), "merkle-new")

    def twin(x, y):
        """Which rows of x have a row of y with their page and number."""
        y = y.where("page_id is not null").select(F.col("archive").alias("t"), F.col("page_id").alias("q"), F.col("n").alias("m"))
        return x.join(y, (F.col("archive") == F.col("t")) & (F.col("page_id") == F.col("q")) & (F.col("n") == F.col("m")), "left")

    found = ["archive", "node", "page_id", "first", "end"]
    state = F.when(F.col("q").isNull(), "missing").otherwise("altered")
    return (twin(lost, new).select(*found, state.alias("state"))
            .unionByName(twin(new, lost).where("q is null").select(*found, F.lit("extra").alias("state"))))


def archives(one: DataFrame, two: DataFrame) -> DataFrame:
    """Leaf counts, sizes and agreement of every archive: archive, n_records, n_bytes, n_damaged."""
    sums = one.where("level = 0").groupBy("archive").agg(F.sum("copies").alias("n_records"), F.max("end").alias("n_bytes"))
    bad = audit(one, two).groupBy("archive").agg(F.count(F.lit(1)).alias("n_damaged")).withColumnRenamed("archive", "a")
    return (sums.join(bad, F.col("archive") == F.col("a"), "left")
            .select("archive", "n_records", "n_bytes", F.coalesce("n_damaged", F.lit(0)).cast("long").alias("n_damaged")))
