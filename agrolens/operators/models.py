"""Price regression with Spark ML.

Encoders and model live in one ``PipelineModel``: fitted ``StringIndexer`` +
sparse ``OneHotEncoder`` replace the register's per-call dummy encoding, so
scoring new rows uses the training levels (unseen level -> all-zero slot)
instead of re-deriving columns. Training is distributed; nothing is collected
except the fitted trees and per-feature importances.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agrolens.functions.clean import category_text, drop_missing, fill_constants, year_or_default
from agrolens.operators.features import split_train_test

# The register's feature sets (our column names).
BASE_CATEGORICAL = ["county", "item_category", "manufacturer", "product_name", "model", "dealer"]
BASE_NUMERIC = ["quantity", "unit_subsidy"]
TIME_NUMERIC = ["quantity", "unit_subsidy", "purchase_year"]
PIPELINE_CATEGORICAL = ["item_category", "manufacturer", "model", "township", "dealer"]
PIPELINE_NUMERIC = ["quantity"]
TARGET = "unit_price"


def prepare(df: DataFrame, cat_cols, num_cols, target: str = TARGET, with_year: bool = False,
            fills=None, required=None) -> DataFrame:
    """Year (default 2024), constant fills, then drop rows that miss a
    ``required`` column (default: the target and every feature), then categorical text
    ('NA' for missing)."""
    d = df
    if with_year:
        d = d.withColumn("purchase_year", year_or_default("purchase_date"))
    if fills:
        d = fill_constants(d, fills)
    d = drop_missing(d, required if required is not None else [target] + list(cat_cols) + list(num_cols))
    for c in cat_cols:
        d = d.withColumn(c, category_text(c))
    return d


def prepare_specs(specs: DataFrame, cat_cols, num_cols) -> DataFrame:
    """Rows to price. No row is dropped and no price is needed; every feature column must
    be there, the year of a year model above all."""
    missing = [c for c in [*cat_cols, *num_cols] if c not in specs.columns]
    if missing:
        raise ValueError(f"specs lack the model's columns: {', '.join(missing)}")
    for c in cat_cols:
        specs = specs.withColumn(c, category_text(c))
    return specs


# Largest vocabulary of an indexed or one-hot column: the labels reach the driver (inside the
# fitted indexer) and bound a forest's maxBins. More levels are an error, never merged; such
# columns take target statistics (operators/target_model.py) instead.
MAX_LEVELS = 4096


def fit_encoders(train: DataFrame, cat_cols, num_cols, encoding: str = "onehot",
                 max_levels: int = MAX_LEVELS) -> PipelineModel:
    """Fit the encoder stages on the distinct levels of each column.

    A column with over ``max_levels`` levels raises ValueError (at most ``max_levels`` + 1 of
    them are ever counted). With alphabetical ordering this gives the same indexer as fitting
    on all rows; levels unseen in training take the indexer's own slot (``handleInvalid='keep'``).
    """
    levels = None
    for c in cat_cols:
        top = train.where(F.col(c).isNotNull()).select(c).distinct()
        if top.limit(max_levels + 1).count() > max_levels:
            raise ValueError(f"column {c} has over {max_levels} levels; encode it as target statistics")
        levels = top if levels is None else levels.unionByName(top, allowMissingColumns=True)
    stages = encoder_stages(cat_cols, num_cols, encoding)
    idx = stages[0].fit(levels)
    rest = Pipeline(stages=stages[1:]).fit(idx.transform(train))
    return PipelineModel(stages=[idx] + list(rest.stages))


def encoder_stages(cat_cols, num_cols, encoding: str = "onehot"):
    """M1: alphabetical indexing, then either sparse one-hot (unseen level -> all-zero slot)
    or, with ``encoding='indexed'``, the index itself as a categorical feature (nominal
    metadata): trees then split on category subsets — far fewer columns than one-hot."""
    idx = [StringIndexer(inputCols=list(cat_cols), outputCols=[f"{c}__idx" for c in cat_cols],
                         stringOrderType="alphabetAsc", handleInvalid="keep")]
    if encoding == "indexed":
        asm = VectorAssembler(inputCols=[f"{c}__idx" for c in cat_cols] + list(num_cols),
                              outputCol="features", handleInvalid="keep")
        return idx + [asm]
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cat_cols],
                        outputCols=[f"{c}__ohe" for c in cat_cols], dropLast=True, handleInvalid="keep")
    asm = VectorAssembler(inputCols=[f"{c}__ohe" for c in cat_cols] + list(num_cols),
                          outputCol="features", handleInvalid="keep")
    return idx + [ohe, asm]


def random_forest(num_trees: int = 100, max_depth: int = 10, seed: int = 42, max_bins: int = 32):
    """M3: sklearn-style forest (all features per split, bootstrap). Node ids are not cached: a number for each row and tree
    would be persisted and written to the checkpoint folder (400 bytes a row for 100 trees); rows walk their trees instead."""
    return RandomForestRegressor(featuresCol="features", labelCol=TARGET, predictionCol="predicted_price",
                                 numTrees=num_trees, maxDepth=max_depth, featureSubsetStrategy="all",
                                 seed=seed, maxBins=max_bins, cacheNodeIds=False)


def boosted_trees(max_iter: int = 300, step: float = 0.05, max_depth: int = 7, subsample: float = 0.8,
                  feature_subset: str = "0.8", seed: int = 42, max_bins: int = 32):
    """M5: regularised boosting (row / column sampling)."""
    return GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="predicted_price",
                        maxIter=max_iter, stepSize=step, maxDepth=max_depth, subsamplingRate=subsample,
                        featureSubsetStrategy=feature_subset, seed=seed, maxBins=max_bins,
                        checkpointInterval=10)


def fit_price_model(df: DataFrame, estimator, cat_cols=BASE_CATEGORICAL, num_cols=BASE_NUMERIC,
                    with_year: bool = False, key: str = "record_key", encoding: str = "onehot",
                    max_levels: int = MAX_LEVELS):
    """M1+M2+model: prepare, split 80/20 by content hash, fit on the train part.

    The prepared table is persisted (every encoder / tree pass reads it; lost
    blocks are recomputed from lineage). Returns (PipelineModel, prepared
    DataFrame with ``is_test``)."""
    d = split_train_test(prepare(df, cat_cols, num_cols, with_year=with_year), key).persist()
    train = d.where(~F.col("is_test"))
    enc = fit_encoders(train, cat_cols, num_cols, encoding, max_levels)
    est = estimator
    if encoding == "indexed":
        arity = max(len(labels) for labels in enc.stages[0].labelsArray) + 1  # + unseen slot
        est = estimator.copy().setMaxBins(max(estimator.getMaxBins(), arity))
    fitted = est.fit(enc.transform(train))
    return PipelineModel(stages=list(enc.stages) + [fitted]), d


def fit_boosted_early_stopping(df: DataFrame, cat_cols=PIPELINE_CATEGORICAL, num_cols=PIPELINE_NUMERIC,
                               max_iter: int = 1000, patience: int = 50, step: float = 0.1,
                               max_depth: int = 5, min_rows: int = 50, key: str = "record_key",
                               max_levels: int = MAX_LEVELS):
    """M4: boosting with early stopping on the held-out part.

    Fit ``max_iter`` rounds once, score every prefix of the ensemble on the test
    part (``evaluateEachIteration``), keep the best round count (stopping
    ``patience`` rounds after the last improvement), and refit that many rounds —
    without row sampling the refit's trees equal the first trees of the long run.
    Fewer than ``min_rows`` rows -> None (no model).
    """
    d = split_train_test(prepare(df, cat_cols, num_cols, fills={"quantity": 1.0}, required=[TARGET]), key).persist()
    if d.limit(min_rows).count() < min_rows:
        return None, d, 0
    enc = fit_encoders(d.where(~F.col("is_test")), cat_cols, num_cols, "onehot", max_levels)
    e = enc.transform(d).persist()
    gbt = GBTRegressor(featuresCol="features", labelCol=TARGET, predictionCol="predicted_price",
                       maxIter=max_iter, stepSize=step, maxDepth=max_depth, seed=42, checkpointInterval=10)
    full = gbt.fit(e.where(~F.col("is_test")))
    errs = full.evaluateEachIteration(e.where(F.col("is_test")), "squared")
    best, best_err, since = 1, float("inf"), 0
    for i, v in enumerate(errs, start=1):
        if v < best_err:
            best, best_err, since = i, v, 0
        else:
            since += 1
            if since >= patience:
                break
    final = full if best == len(errs) else gbt.copy().setMaxIter(best).fit(e.where(~F.col("is_test")))
    return PipelineModel(stages=list(enc.stages) + [final]), d, best


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Predictions for any prepared rows (training levels reused): the input's
    columns, predicted_price, and actual_price where the rows have a price."""
    out = model.transform(df).select(*df.columns, "predicted_price")
    return out.withColumn("actual_price", F.col(TARGET)) if TARGET in df.columns else out


def feature_importance(model: PipelineModel, prepared: DataFrame, top: int = 15,
                       positive_only: bool = True) -> DataFrame:
    """Importances > 0, descending, labelled 'column (value)'.

    Slot names come from the ML attribute metadata of the assembled vector (a
    schema lookup, no data pass). This is model metadata, one entry per feature.
    """
    est = model.stages[-1]
    meta = model.transform(prepared.limit(0)).schema["features"].metadata.get("ml_attr", {})
    names = {}
    for group in meta.get("attrs", {}).values():
        for a in group:
            names[a["idx"]] = a.get("name", f"f{a['idx']}")

    def label(n: str) -> str:
        # '<col>__ohe_<value>' -> '<col> (<value>)'; indexed columns keep the column name
        if "__ohe_" in n:
            col, val = n.split("__ohe_", 1)
            return f"{col} ({val})"
        return n[:-5] if n.endswith("__idx") else n

    imp = est.featureImportances.toArray().tolist()
    rows = [(label(names.get(i, f"f{i}")), float(v)) for i, v in enumerate(imp) if (v > 0 or not positive_only)]
    rows.sort(key=lambda r: (-r[1], r[0]))
    return prepared.sparkSession.createDataFrame(rows[:top], "feature string, importance double")


def save_model(model: PipelineModel, path: str) -> str:
    """Persist encoders + model together."""
    model.write().overwrite().save(path)
    return path


def load_or_train(path: str, train_fn, load=PipelineModel.load, save=lambda model, path: model.write().save(path)):
    """Load the model at ``path``, or train and save it if nothing is there. A path that
    holds anything else raises and stays as it is."""
    sc = SparkSession.active().sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at):
        return load(path)
    m = train_fn()
    save(m, path)
    return m
