"""Multivariate outliers with an isolation forest (D5), built and scored on Spark.

1. Sampling: every row gets one uniform from a content hash; tree t takes the
   ``sample_size`` rows nearest after its own offset t/T on the unit circle,
   searched in a window holding ~4 * sample_size rows, so only ~1000
   candidates per tree are ranked (window over a bounded group).
2. Growing: ``groupBy('tree').applyInPandas`` grows one tree per group from
   its <= sample_size rows (random feature, uniform split, depth limit
   ceil(log2(sample_size))); the node tables (trees x <= 511 rows) are the
   only thing collected, and they are broadcast back.
3. Scoring: an iterator pandas UDF over the feature columns walks tree after tree for a few thousand rows
   of an Arrow batch at once; score = 2 ** (-mean path length / c(sample_size)).
4. Threshold: the exact (1 - contamination) quantile of the scores over all
   rows (distributed exact quantile); anomaly = score strictly above it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from agrolens.operators.quantiles import exact_quantiles

NODE_SCHEMA = ("tree int, node int, feature int, threshold double, left int, right int, "
               "size long, depth int, leaf boolean")


def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(tree_id: int, X: np.ndarray, seed: int, max_depth: int) -> list:
    rng = np.random.default_rng([seed, tree_id])
    nodes = []

    def build(idx, depth):
        me = len(nodes)
        nodes.append(None)
        sub = X[idx]
        if depth >= max_depth or len(idx) <= 1:
            nodes[me] = (tree_id, me, -1, 0.0, -1, -1, len(idx), depth, True)
            return me
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        usable = np.flatnonzero(hi > lo)
        if usable.size == 0:
            nodes[me] = (tree_id, me, -1, 0.0, -1, -1, len(idx), depth, True)
            return me
        f = int(rng.choice(usable))
        thr = float(rng.uniform(lo[f], hi[f]))
        left_idx = idx[sub[:, f] < thr]
        right_idx = idx[sub[:, f] >= thr]
        left = build(left_idx, depth + 1)
        right = build(right_idx, depth + 1)
        nodes[me] = (tree_id, me, f, thr, left, right, len(idx), depth, False)
        return me

    build(np.arange(len(X)), 0)
    return nodes


def _levels(nodes: pd.DataFrame):
    """All trees as complete trees: for each level, feature and threshold of its 2**level places (trees x places), and the path
    lengths at the places below the last level. The child for values under the threshold of place p is 2p + 1, the
    other one 2p. A leaf fills all places below it, so a walk needs no check for leaves."""
    depth = int(nodes["depth"].max()) if len(nodes) else 0
    groups = [t.sort_values("node") for _, t in nodes.groupby("tree")]
    feats = [np.zeros((len(groups), 1 << d), dtype=np.intp) for d in range(depth)]
    thrs = [np.zeros((len(groups), 1 << d)) for d in range(depth)]
    paths = np.zeros((len(groups), 1 << depth))
    for i, t in enumerate(groups):
        feature, threshold, left, right, size, at_depth, leaf = [
            t[c].to_numpy() for c in ("feature", "threshold", "left", "right", "size", "depth", "leaf")]
        todo = [(0, 0, 0)] if len(t) else []
        while todo:
            node, d, place = todo.pop()
            if leaf[node]:
                below = depth - d
                paths[i, place << below:(place + 1) << below] = at_depth[node] + _c(size[node])
            else:
                feats[d][i, place], thrs[d][i, place] = feature[node], threshold[node]
                todo += [(left[node], d + 1, 2 * place + 1), (right[node], d + 1, 2 * place)]
    return feats, thrs, paths


WALK_ROWS = 4096  # rows walked at a time: their features and places stay in a core's cache


def _score_batches(batches, nodes: pd.DataFrame, features, sample_size: int):
    feats, thrs, paths = _levels(nodes)
    cn = _c(sample_size)

    def mean_paths(x):
        """Mean path length of the rows of ``x`` (features x rows), tree by tree."""
        n = x.shape[1]
        flat, row, found = np.ascontiguousarray(x).ravel(), np.arange(n), np.empty((n, len(paths)))
        at, cell, own = np.empty(n, np.intp), np.empty(n, np.intp), np.empty(n)
        value, under = np.empty(n), np.empty(n, dtype=bool)
        starts = [f * n for f in feats]
        for t in range(len(paths)):
            at[:] = 0
            for start, thr in zip(starts, thrs):
                np.take(start[t], at, out=cell, mode="clip")
                cell += row
                np.take(flat, cell, out=value, mode="clip")
                np.take(thr[t], at, out=own, mode="clip")
                np.less(value, own, out=under)
                at += at
                at += under
            found[:, t] = paths[t][at]
        return found.mean(axis=1)

    for pdf in batches:
        x = pdf[features].to_numpy(dtype=float).T
        mean_path = np.concatenate([np.zeros(0), *[mean_paths(x[:, i:i + WALK_ROWS]) for i in range(0, len(pdf), WALK_ROWS)]]) \
            if len(paths) else np.zeros(len(pdf))
        pdf = pdf.copy()
        pdf["iforest_score"] = np.power(2.0, -mean_path / cn) if cn > 0 else 0.5
        yield pdf


def tree_candidates(d: DataFrame, key: str, fcols, n: DataFrame, tau, n_trees: int, seed: int) -> DataFrame:
    """Rows of ``d`` per tree whose hash falls in the tree's window of width ``tau``: key,
    features, tree, u (distance from the window start). ``n``: the one-row count behind ``tau``."""
    # One uniform u per row (content hash). Tree t's candidates are the rows whose u falls
    # in the window [t/T, t/T + tau) on the unit circle, ranked by the distance from the
    # window start: a uniformly random sample without replacement for every tree, with no
    # per-row lambda (sequence + explode are code-generated). For tau <= 1/T the windows are
    # disjoint; every row lies in at most ceil(tau * T) windows.
    u = F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed)), 11).cast("double") / F.lit(float(2 ** 53))
    lo = (F.floor(F.col("_u") * n_trees - tau * n_trees) + 1).cast("long")
    hi = F.floor(F.col("_u") * n_trees).cast("long")
    return (d.crossJoin(F.broadcast(n)).withColumn("_u", u)
              .where(lo <= hi)  # sequence() counts down otherwise: such a row lies in no window
              .select(key, *fcols, "_u", F.explode(F.sequence(lo, hi)).alias("_k"))
              .select(key, *fcols, F.pmod(F.col("_k"), F.lit(n_trees)).cast("int").alias("tree"),
                      (F.col("_u") - F.col("_k") / F.lit(float(n_trees))).alias("u")))


@dataclass
class IsolationForestModel:
    """D5, fitted: node table of all trees (trees x <= 511 rows) and the score threshold."""
    features: list
    nodes: pd.DataFrame
    sample_size: int
    threshold: float | None = None

    def raw_scores(self, df: DataFrame) -> DataFrame:
        """``df`` plus iforest_score; only the feature columns reach Python (NULL counts as 0)."""
        bnodes = df.sparkSession.sparkContext.broadcast(self.nodes)
        fcols = [f"__f{i}" for i in range(len(self.features))]
        sample_size = self.sample_size

        @F.pandas_udf("double")
        def path_score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
            for scored_batch in _score_batches(batches, bnodes.value, fcols, sample_size):
                yield scored_batch["iforest_score"]

        return df.withColumn("iforest_score", path_score(F.struct(*_feature_columns(self.features))))

    def score(self, df: DataFrame) -> DataFrame:
        """iforest_score, iforest_anomaly and iforest_label of every row, by the fitted threshold."""
        return _flagged(self.raw_scores(df), F.lit(self.threshold))

    def save(self, spark: SparkSession, path: str) -> None:
        """Node table and settings. A path that holds a saved model raises."""
        spark.createDataFrame([(self.features, self.sample_size, self.threshold)],
                              "features array<string>, sample_size int, threshold double").coalesce(1).write.parquet(f"{path}/meta")
        spark.createDataFrame(self.nodes, NODE_SCHEMA).write.parquet(f"{path}/nodes")


def load_isolation_forest(spark: SparkSession, path: str) -> IsolationForestModel:
    meta = spark.read.parquet(f"{path}/meta").first()
    nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()  # bounded: trees x <= 511
    return IsolationForestModel(list(meta["features"]), nodes, meta["sample_size"], meta["threshold"])


def _feature_columns(features) -> list:
    return [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"__f{i}") for i, c in enumerate(features)]


def _flagged(scored: DataFrame, threshold) -> DataFrame:
    return (scored.withColumn("iforest_anomaly", F.coalesce(F.col("iforest_score") > threshold, F.lit(False)))
                  .withColumn("iforest_label", F.when(F.col("iforest_anomaly"), -1).otherwise(1)))


def _grow_forest(df: DataFrame, features, key: str, n_trees: int, sample_size: int, seed: int,
                 oversample: float) -> IsolationForestModel:
    feats = list(features)
    fcols = [f"__f{i}" for i in range(len(feats))]
    d = df.select(key, *_feature_columns(feats))
    n = d.agg(F.count(F.lit(1)).alias("_n"))
    tau = F.least(F.lit(1.0), F.lit(oversample * sample_size) / F.col("_n"))

    cand = tree_candidates(d, key, fcols, n, tau, n_trees, seed)
    w = Window.partitionBy("tree").orderBy("u", key)
    sample = cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= sample_size)
    max_depth = int(math.ceil(math.log2(max(sample_size, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        return pd.DataFrame(_grow(t, pdf[fcols].to_numpy(dtype=float), seed, max_depth),
                            columns=["tree", "node", "feature", "threshold", "left", "right",
                                     "size", "depth", "leaf"])

    nodes = sample.select("tree", *fcols).groupBy("tree").applyInPandas(grow, NODE_SCHEMA).toPandas()
    return IsolationForestModel(feats, nodes, int(min(sample_size, nodes.loc[nodes["node"] == 0, "size"].max())))


def _threshold(scored: DataFrame, contamination: float) -> DataFrame:
    return exact_quantiles(scored, "iforest_score", [1.0 - contamination]).select(F.col("q0").alias("_thr"))


def fit_isolation_forest(df: DataFrame, features, key: str = "record_key", n_trees: int = 200,
                         sample_size: int = 256, contamination: float = 0.02, seed: int = 42,
                         oversample: float = 4.0) -> IsolationForestModel:
    """D5 as a model that can be saved: trees, and the threshold over all rows of ``df``."""
    model = _grow_forest(df, features, key, n_trees, sample_size, seed, oversample)
    scored = model.raw_scores(df).select("iforest_score").persist()
    row = _threshold(scored, contamination).first()
    scored.unpersist()
    model.threshold = row["_thr"] if row else None
    return model


def isolation_forest(df: DataFrame, features, key: str = "record_key", n_trees: int = 200,
                     sample_size: int = 256, contamination: float = 0.02, seed: int = 42,
                     oversample: float = 4.0) -> DataFrame:
    """Adds iforest_score, iforest_label (-1 anomaly / 1 normal) and iforest_anomaly."""
    model = _grow_forest(df, features, key, n_trees, sample_size, seed, oversample)
    # scores are read by the threshold passes and the output
    scored = model.raw_scores(df).persist()
    thr = _threshold(scored, contamination)
    return _flagged(scored.crossJoin(F.broadcast(thr)), F.col("_thr")).drop("_thr")  # one row
