"""Operator 13, hard-negative mining by L2AP-style threshold joins.

Vectors become integers (floor(scale * x)); a score is an integer inner product. The anchors are
a stated query set that is joined with all rows in blocks:

* Dimensions get one order for all rows, by falling energy (sum of squares). A block of rows is
  indexed by dimension: list d holds component d of the block's rows. The trailing dimensions,
  whose suffix norms bound what they can add, stay out of the index.
* For a threshold t, partial scores are accumulated over the indexed lists (a matrix product of
  an anchor block with the lists). A pair is pruned if its partial score plus the product of the
  two remaining norms is below t. Survivors go on through further lists, with smaller remaining
  norms, and are at last completed to exact scores.
* Thresholds start near the top of an anchor's window and are lowered until every window is
  full: an anchor whose windows hold enough rows above its threshold is finished, the others are
  run again with a lower one, at last with the window's own lower end. So the result is exact.

Positives are the first rows of the anchor's label (a window without ends), negatives the first
rows of other labels with a score between two shares of the positive's.

Anchors go to the tasks in groups of at most GROUP_BYTES, one group's jobs after the other, and
each group's results are written. A task keeps the first rows of each window only.

Defined results: rows with a NULL id, label or vector, or with a NULL or non-finite component take
no part; rows equal in id, label and vector are one row; rows that share an id and differ are
rows of their own (ties by a hash of the row); vectors of another length than the longest are
filled with zeros; an empty table or one without anchors gives no rows; extra columns are
ignored. Scores must fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from agrolens.llm.common import drop_scratch, write_scratch

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90                    # percent of the positive's score
GROUP_BYTES = 16 << 20                # anchor vectors sent to the tasks at once
TILE = 512                            # anchors of one matrix product
POSITIVE_STEPS = (0.35, 0.15, None)   # thresholds as shares of |anchor| * longest row; None: no threshold
NEGATIVE_STEPS = (0.125, 0.5, 1.0)    # parts of the window, from its upper end, that a run covers
INDEXED = (0.5, 0.8, 0.95)            # energy within the lists read before each pruning
_ROWS_SCHEMA = "anchor long, w int, score long, vec_id long, key long"


def usable(embeddings: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, v (integers as array<double>), key of every row that takes part; equal rows once."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), v.alias("v"))
            .withColumn("key", F.xxhash64("vec_id", "label", "v"))
            .dropDuplicates(["vec_id", "label", "v"]))


def _matrix(column, dims: int, order: np.ndarray) -> np.ndarray:
    """Rows of a list column as a dense matrix, short ones filled with zeros, dimensions in ``order``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (n == dims).all():
        m = flat.reshape(-1, dims)
    else:
        m = np.zeros((len(n), dims))
        m[np.arange(dims)[None, :] < n[:, None]] = flat
    return np.ascontiguousarray(m[:, order])


def _remaining(m: np.ndarray, cuts) -> np.ndarray:
    """Norms of what lies behind each cut, a little rounded up."""
    squares = np.cumsum((m * m)[:, ::-1], axis=1)[:, ::-1]
    return np.stack([np.sqrt(squares[:, c]) if c < m.shape[1] else np.zeros(len(m)) for c in cuts]) * (1 + 1e-12) + 1e-9


def survivors(q: np.ndarray, x: np.ndarray, least: np.ndarray, cuts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of every pair whose exact score reaches the anchor's threshold ``least``."""
    q_rest, x_rest = _remaining(q, cuts), _remaining(x, cuts)
    lists = np.ascontiguousarray(x[:, :cuts[0]].T)
    partial = q[:, :cuts[0]] @ lists
    a, r = np.nonzero(partial + q_rest[0][:, None] * x_rest[0][None, :] >= least[:, None])
    score = partial[a, r]
    for k in range(1, len(cuts)):
        part = slice(cuts[k - 1], cuts[k])
        if len(a) > partial.size // 8:  # too many left to take them one by one
            score = score + (q[:, part] @ x[:, part].T)[a, r]
        else:
            score = score + np.einsum("ij,ij->i", q[a, part], x[r, part])
        on = score + q_rest[k][a] * x_rest[k][r] >= least[a]
        a, r, score = a[on], r[on], score[on]
    return a, r, score


class _First:
    """The first ``keep`` rows (score falling, then vec_id, then key) of every window of a task's anchors."""

    def __init__(self, keep: int, limit: int):
        self.keep, self.limit, self.parts, self.size = keep, limit, [], 0

    def add(self, *columns):
        if len(columns[0]):
            self.parts.append(columns)
            self.size += len(columns[0])
            if self.size > self.limit:
                self.reduce()

    def reduce(self):
        if not self.parts:
            return None
        anchor, w, score, vec_id, key = [np.concatenate(c) for c in zip(*self.parts)]
        at = np.lexsort((key, vec_id, -score, w, anchor))
        anchor, w = anchor[at], w[at]
        starts = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (w[1:] != w[:-1])])
        rank = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
        on = rank < self.keep
        self.parts = [(anchor[on], w[on], score[at][on], vec_id[at][on], key[at][on])]
        self.size = int(on.sum())
        return self.parts[0]


def _scan(rows: DataFrame, anchors, shape, keep: int, same_label: bool) -> DataFrame:
    """First ``keep`` rows of every window (anchor, w) of a group; a window is (least, most) scores.

    ``anchors``: keys, labels, matrix, least and most (anchors x windows; NaN: no such window).
    """
    spark = rows.sparkSession
    dims, order, cuts = shape
    shared = spark.sparkContext.broadcast(anchors)

    def run(batches):
        keys, labels, q, least, most = shared.value
        lowest = np.nanmin(np.where(np.isnan(least), np.inf, least), axis=1)
        first = _First(keep, max(1 << 18, 2 * keep * least.size))
        for b in batches:
            if not b.num_rows:
                continue
            vec_id, label, key = [b.column(i).to_numpy() for i in (0, 1, 3)]
            x = _matrix(b.column(2), dims, order)
            kinds = np.unique(label) if same_label else [None]
            for kind in kinds:
                mine = np.flatnonzero(label == kind) if same_label else slice(None)
                asked = np.flatnonzero(labels == kind) if same_label else np.arange(len(keys))
                xs, ids, ks, ls = x[mine], vec_id[mine], key[mine], label[mine]
                for t in range(0, len(asked), TILE):
                    some = asked[t:t + TILE]
                    a, r, score = survivors(q[some], xs, lowest[some], cuts)
                    a = some[a]
                    on = (ks[r] != keys[a]) if same_label else (ls[r] != labels[a])
                    a, r, score = a[on], r[on], score[on]
                    for w in range(least.shape[1]):
                        inside = (score >= least[a, w]) & (score <= most[a, w])
                        aw, rw = a[inside], r[inside]
                        first.add(keys[aw], np.full(len(aw), w, np.int32), score[inside].astype(np.int64), ids[rw], ks[rw])
        found = first.reduce()
        if found is not None:
            for i in range(0, len(found[0]), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c[i:i + 10_000]) for c in found],
                                                 names=["anchor", "w", "score", "vec_id", "key"])

    found = rows.select("vec_id", "label", "v", "key").mapInArrow(run, _ROWS_SCHEMA)
    ranked = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), "vec_id", "key")
    found = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= keep)
    written = write_scratch(found, "negatives-found")
    shared.unpersist()
    return written


def _group_table(group: DataFrame, dims: int, order: np.ndarray) -> tuple:
    """Keys, labels and matrix of one group of anchors (at most about GROUP_BYTES), ordered by key."""
    t = group.select("key", "label", "v").toArrow().sort_by("key")
    q = _matrix(t.column("v"), dims, order) if t.num_rows else np.zeros((0, dims))
    return t.column("key").to_numpy(), t.column("label").to_numpy(), q


def _in_steps(rows, group, shape, keep, same_label, windows_at, n_steps, n_windows):
    """Run lower and lower thresholds over the anchors of a group until their windows are full.

    ``windows_at(step)`` gives (least, most) for all anchors. Returns the found rows and the written tables they read.
    """
    keys, labels, q = group
    open_ = np.ones((len(keys), n_windows), dtype=bool)
    parts, scans = [], []
    for step in range(n_steps):
        least, most = windows_at(step)
        open_ &= ~np.isnan(least)
        some = np.flatnonzero(open_.any(axis=1))
        if not len(some):
            break
        least = np.where(open_, least, np.nan)[some]
        found = _scan(rows, (keys[some], labels[some], q[some], least, most[some]), shape, keep, same_label)
        scans.append(found)
        if step == n_steps - 1:
            parts.append(found)
            break
        full = found.groupBy("anchor", "w").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == keep)
        filled = full.select("anchor", "w").toArrow()  # at most the windows of one group
        done = np.searchsorted(keys, filled.column("anchor").to_numpy())
        open_[done, filled.column("w").to_numpy()] = False
        parts.append(found.join(full.select(F.col("anchor").alias("__a"), F.col("w").alias("__w")),
                                (F.col("anchor") == F.col("__a")) & (F.col("w") == F.col("__w")), "left_semi"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out, scans


def mine(embeddings: DataFrame, anchor: Column, scale: int = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor``: condition on vec_id and label that makes a row an anchor.
    """
    spark = embeddings.sparkSession
    rows = write_scratch(usable(embeddings, scale), "negatives-rows")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    size = rows.agg(F.max(F.size("v")).alias("dims"), F.max(norm).alias("longest"),
                    F.sum(anchor.cast("int")).alias("anchors")).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, "
                                      "positive_score long, negative_score long")
    if not size.anchors or not size.dims:
        return empty
    energy = np.zeros(size.dims)
    for r in (rows.select(F.posexplode("v").alias("d", "x")).groupBy("d").agg(F.sum(F.col("x") * F.col("x")).alias("e")).collect()):
        energy[r.d] = r.e
    order = np.argsort(-energy, kind="stable")
    share = np.cumsum(energy[order]) / max(energy.sum(), 1e-300)
    cuts = sorted({int(np.searchsorted(share, s)) + 1 for s in INDEXED if s < 1} | {size.dims})
    cuts = [c for c in cuts if c <= size.dims]
    shape = (size.dims, order, cuts)
    groups = -(-size.anchors * size.dims * 8 // group_bytes)
    asked = write_scratch(rows.where(anchor).withColumn("group", F.pmod(F.hash("key"), F.lit(groups)).cast("int")), "negatives-anchors")
    results = []
    for g in range(groups):
        group = _group_table(asked.where(F.col("group") == g), size.dims, order)
        if len(group[0]):
            results.append(_mine_group(rows, group, shape, size.longest, positives, negatives, low, high))
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    drop_scratch(rows)
    ids = asked.select(F.col("key").alias("__k"), F.col("vec_id").alias("anchor_id"))
    return (out.join(ids, F.col("anchor") == F.col("__k"))
            .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))


def _mine_group(rows, group, shape, longest, positives, negatives, low, high) -> DataFrame:
    keys, _, q = group
    norms = np.sqrt((q * q).sum(axis=1))

    def for_positives(step):
        part = POSITIVE_STEPS[step]
        least = np.full((len(keys), 1), -np.inf) if part is None else (part * norms * longest)[:, None]
        return least, np.full((len(keys), 1), np.inf)

    first, scans = _in_steps(rows, group, shape, positives, True, for_positives, len(POSITIVE_STEPS), 1)
    best = write_scratch(first.select("anchor", F.col("rank").alias("p"), F.col("vec_id").alias("positive_id"),
                                     F.col("score").alias("positive_score")), "negatives-positives")
    for t in scans:
        drop_scratch(t)
    told = best.select("anchor", "p", "positive_score").toArrow()  # a group's windows: a few longs an anchor
    score = np.full((len(keys), positives), np.nan)
    score[np.searchsorted(keys, told.column("anchor").to_numpy()), told.column("p").to_numpy() - 1] = told.column("positive_score").to_numpy()
    bottom, top = np.ceil(low * score / 100), np.floor(high * score / 100)
    bottom[~(bottom <= top)] = np.nan  # a negative score has no window

    def for_negatives(step):
        return np.where(np.isnan(bottom), np.nan, np.maximum(bottom, np.floor(top - NEGATIVE_STEPS[step] * (top - bottom)))), top

    if np.isnan(bottom).all():
        return best.where("false").select("anchor", "positive_id", F.col("p").alias("rank"), F.col("positive_id").alias("negative_id"),
                                          "positive_score", F.col("positive_score").alias("negative_score"))
    found, scans = _in_steps(rows, group, shape, negatives, False, for_negatives, len(NEGATIVE_STEPS), positives)
    result = write_scratch(
        found.select(F.col("anchor").alias("__a"), "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(best, (F.col("__a") == F.col("anchor")) & (F.col("w") + 1 == F.col("p")))
        .select("anchor", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives-result")
    for t in [*scans, best]:
        drop_scratch(t)
    return result
