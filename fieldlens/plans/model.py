"""M3: gold rows -> random-forest yield model.

The pipeline and its fitted model are ``pyspark.ml``'s; the forest's trees are
grown by ``plans.forest``.  The data is never collected; only model metadata
(category labels, split candidates, tree nodes, importances, fold metrics)
reaches the driver.

Matching the usual single-machine forest setup: every split considers every
feature, 100 trees, depth 10, seed 42.
"""

from __future__ import annotations

import gc
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.plans.forest import POSITION, HistogramForest
from fieldlens.session import Scratch, checkpoint_root, materialize, side_by_side

LABEL = "label"
PRED = "Predicted_Yield"


def zscore(df: DataFrame, cols: Sequence[str], *, keep: Sequence[str] = (),
           digits: int = 6) -> DataFrame:
    """K1: (x - mean) / population std per column; one aggregate pass, the
    2 x len(cols) statistics come back as scalars."""
    aggs = []
    for c in cols:
        aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                 F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}")]
    st = df.agg(*aggs).first()
    out = [F.col(k) for k in keep]
    for c in cols:
        z = F.try_divide(F.col(c).cast("double") - F.lit(st[f"m_{c}"]), F.lit(st[f"s_{c}"]))
        out.append(F.round(z, digits).alias(f"{c}_z"))
    return df.select(*out)


def _indexer(cats: Sequence[str]) -> StringIndexer:
    return StringIndexer(inputCols=list(cats), outputCols=[f"{c}__idx" for c in cats],
                         handleInvalid="keep", stringOrderType="alphabetAsc")


def onehot_columns(train: DataFrame, apply_to: DataFrame, cats: Sequence[str], *,
                   keep: Sequence[str] = ()) -> DataFrame:
    """K2: one 0/1 column per category seen in ``train`` (alphabetical), named
    ``<column>_<value>``; a value unseen in training gives all zeros."""
    cats = list(cats)
    idx = _indexer(cats)
    ohe = OneHotEncoder(inputCols=[f"{c}__idx" for c in cats],
                        outputCols=[f"{c}__ohe" for c in cats], dropLast=True)
    model = Pipeline(stages=[idx, ohe]).fit(train)
    labels = model.stages[0].labelsArray
    x = model.transform(apply_to)
    out = [F.col(k) for k in keep]
    for c, labs in zip(cats, labels):
        arr = vector_to_array(F.col(f"{c}__ohe"))
        out += [arr[i].alias(f"{c}_{lab}") for i, lab in enumerate(labs)]
    return x.select(*out)


def onehot_long(train: DataFrame, apply_to: DataFrame, cats: Sequence[str],
                keep: Sequence[str] = ()) -> DataFrame:
    """K2 in long form: (keep..., feature, value 1.0), one row per category of
    a row that ``train`` has seen, so the schema does not grow with the data.
    The seen categories are an aggregate of the training rows, joined."""
    def pairs(df, *cols):
        return df.select(*cols, F.explode(F.array(*[
            F.concat(F.lit(f"{c}_"), F.col(c).cast("string")) for c in cats])).alias("feature"))

    return pairs(apply_to, *keep).join(pairs(train).distinct(), "feature", "left_semi").select(
        *keep, "feature", F.lit(1.0).alias("value"))


# Rows of one training partition: its sort and its packed bins stay well under 1 GB.
PARTITION_ROWS = 1_000_000


def layout_partitions(df: DataFrame) -> int:
    """Partitions of a forest's training rows: whole rounds of the task slots,
    so that no slot waits, as many as give 8 partitions and keep each under
    ``PARTITION_ROWS``.

    Every partition sends at least one block of rows to every group of trees,
    so their number must not follow ``spark.sql.shuffle.partitions``, which stays
    an upper bound.
    """
    spark = df.sparkSession
    slots = max(1, spark.sparkContext.defaultParallelism)
    rounds = max(-(-8 // slots), -(-df.count() // (slots * PARTITION_ROWS)))
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), slots * rounds)


def stable_layout(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Fix partition contents and row order from the data alone.

    The forest's bootstrap is seeded per block of a partition, so
    the same seed gives the same model only for the same partitioning and
    order; rows that leave a shuffle arrive in varying order.  Hash
    partitioning on all columns plus a sort within partitions makes the
    layout a function of the rows (identical rows are interchangeable).
    """
    n = partitions or layout_partitions(df)
    cols = [F.col(c) for c in df.columns]
    return df.repartition(n, *cols).sortWithinPartitions(*cols)


def prepare(df: DataFrame, numeric: Sequence[str], target: str | None) -> DataFrame:
    cols = {c: F.col(c).cast("double") for c in numeric}
    if target and target in df.columns:
        cols[LABEL] = F.col(target).cast("double")
    return df.withColumns(cols)


def training_rows(df: DataFrame, partitions: int) -> DataFrame:
    """The rows in their stable layout, numbered along it."""
    return stable_layout(df, partitions).withColumn(POSITION, F.monotonically_increasing_id())


def build_pipeline(numeric: Sequence[str], categorical: Sequence[str], *, num_trees: int = 100,
                   max_depth: int = 10, seed: int = 42, max_bins: int = 64) -> Pipeline:
    """K3-K5: impute + scale numerics, one-hot categoricals, assemble, forest."""
    imp = [f"{c}__imp" for c in numeric]
    stages = [
        Imputer(inputCols=list(numeric), outputCols=imp, strategy="mean"),
        VectorAssembler(inputCols=imp, outputCol="num_vec"),
        StandardScaler(inputCol="num_vec", outputCol="num_scaled", withMean=True, withStd=True),
        _indexer(categorical),
        OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical],
                      outputCols=[f"{c}__ohe" for c in categorical], dropLast=True),
        VectorAssembler(inputCols=["num_scaled", *[f"{c}__ohe" for c in categorical]],
                        outputCol="features"),
        HistogramForest(numeric_col="num_scaled", index_cols=[f"{c}__idx" for c in categorical],
                        onehot_cols=[f"{c}__ohe" for c in categorical], features_col="features",
                        label_col=LABEL, prediction_col=PRED, num_trees=num_trees, max_depth=max_depth,
                        seed=seed, max_bins=max_bins),
    ]
    return Pipeline(stages=stages)


def fit(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
        **params) -> PipelineModel:
    """K8: fit the pipeline on rows laid out and written once (every stage reads them)."""
    n = layout_partitions(train)
    rows = training_rows(prepare(train, numeric, target), n)
    with Scratch(train.sparkSession, "fit") as scratch:
        data = scratch.table(rows.select(*numeric, *categorical, LABEL, POSITION), "input").coalesce(n)
        return build_pipeline(numeric, categorical, **params).fit(data)


def predict(model: PipelineModel, df: DataFrame, numeric: Sequence[str], target: str | None,
            keep: Sequence[str]) -> DataFrame:
    """K8: score rows; returns ``keep`` columns plus the prediction."""
    out = model.transform(prepare(df, numeric, target))
    return out.select(*[F.col(k) for k in keep], F.col(PRED))


def cross_validated(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], target: str,
                    fold_col: str, *, folds: int = 5, parallelism: int = 2, **params) -> tuple[list[float], DataFrame]:
    """K7: the RMSE of each hash-assigned fold, and the held-out predictions
    (fold, label, prediction) as a written table.

    ``parallelism`` folds are fitted at the same time, the next as soon as one
    ends: the short stages of one forest leave cores idle that the others use.

    The same result as ``CrossValidator(foldCol=...).avgMetrics`` with one
    empty parameter grid, written as plain filters on the fold column (the
    library version checks fold numbers with a row-at-a-time Python UDF on
    every fold).  The prepared table is laid out deterministically and
    written once to the shared folder; the folds are filters on it, read in no
    more partitions than were written.
    """
    checkpoint_root(train.sparkSession)
    n = layout_partitions(train)
    rows = training_rows(prepare(train, numeric, target).withColumn(fold_col, F.col(fold_col).cast("int")), n)
    data = materialize(rows.select(*numeric, *categorical, LABEL, fold_col, POSITION), "cv_input").coalesce(n)
    evaluator = RegressionEvaluator(labelCol=LABEL, predictionCol=PRED, metricName="rmse")

    def held_out(i: int):
        def job():
            model = build_pipeline(numeric, categorical, **params).fit(data.where(F.col(fold_col) != i))
            pred = materialize(model.transform(data.where(F.col(fold_col) == i)).select(fold_col, LABEL, PRED), f"cv_fold{i}")
            rmse = float(evaluator.evaluate(pred))
            del model
            gc.collect()  # else the driver keeps the forest, and the executors its shuffled blocks
            train.sparkSession.sparkContext._jvm.System.gc()
            return rmse, pred
        return job

    done = side_by_side(train.sparkSession, *[held_out(i) for i in range(folds)], at_once=parallelism)
    pred = done[0][1]
    for _, more in done[1:]:
        pred = pred.unionByName(more)
    return [r for r, _ in done], pred


def cross_validated_rmse(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                         target: str, fold_col: str, *, folds: int = 5, **params) -> float:
    """K7: mean of the per-fold RMSE (see :func:`cross_validated`)."""
    rmses, _ = cross_validated(train, numeric, categorical, target, fold_col, folds=folds, **params)
    return sum(rmses) / folds


def feature_importance(spark, model: PipelineModel, numeric: Sequence[str],
                       categorical: Sequence[str]) -> DataFrame:
    """K9: (Feature, Importance) sorted by importance, names aligned with the
    assembled vector: the numeric columns, then ``<column>_<value>``."""
    idx_model = model.stages[3]
    names = list(numeric)
    for c, labs in zip(categorical, idx_model.labelsArray):
        names += [f"{c}_{lab}" for lab in labs]
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = sorted(zip(names, imp), key=lambda t: (-t[1], t[0]))
    schema = T.StructType([T.StructField("Feature", T.StringType()),
                           T.StructField("Importance", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the fitted pipeline (overwrite) in the shared folder."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def record_metrics(spark, path: str, run_id: str, metrics: dict[str, float]) -> DataFrame:
    """Write one run's metrics as rows (run_id, name, value) into a
    table partitioned by run; re-running a run overwrites only its partition."""
    schema = T.StructType([T.StructField("run_id", T.StringType()),
                           T.StructField("name", T.StringType()),
                           T.StructField("value", T.DoubleType())])
    df = spark.createDataFrame([(run_id, k, float(v)) for k, v in metrics.items()], schema)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("run_id").parquet(path))
    return spark.read.parquet(path)
