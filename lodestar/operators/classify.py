"""Tree-ensemble classification with MLlib: assemble -> standardize ->
random forest; scoring with class label and probability of class 1;
metrics by distributed aggregates; model save / load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def forest_estimator(label: str = "label", num_trees: int = 4, max_depth: int = 3, seed: int = 42,
                     subsampling_rate: float = 1.0, feature_subset: str = "auto",
                     max_bins: int = 32) -> RandomForestClassifier:
    """Gini random forest.  Always seeded: an unseeded estimator takes its
    seed from a hash of its class name, which is not a choice."""
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=num_trees,
                                  maxDepth=max_depth, seed=seed, subsamplingRate=subsampling_rate,
                                  featureSubsetStrategy=feature_subset, maxBins=max_bins)


def fit_forest(train: DataFrame, cols: Sequence[str], label: str = "label",
               scaler_data: DataFrame | None = None, with_mean: bool = False,
               handle_invalid: str = "error", **forest) -> PipelineModel:
    """Fit assembler + scaler + forest on ``train``.

    ``scaler_data``: fit the scaler on this DataFrame instead (for example
    all rows before the split, as the original workload does).  The forest
    is fitted on ``train`` either way.
    """
    from lodestar.operators.features import scaler_pipeline
    from lodestar.session import persisted
    stages = scaler_pipeline(cols, with_mean, handle_invalid=handle_invalid).getStages()  # sample std; without the mean by default
    rf = forest_estimator(label=label, **forest)
    # The fit reads its input several times (scaler statistics, forest
    # metadata, split candidates, the binned training set): persist the few
    # columns it needs instead of recomputing the input each time.
    with persisted(train.select(*cols, label)) as tr:
        if scaler_data is None:
            return Pipeline(stages=[*stages, rf]).fit(tr)
        scaler = Pipeline(stages=stages).fit(scaler_data)
        forest_model = rf.fit(scaler.transform(tr))
        return PipelineModel(stages=[*scaler.stages, forest_model])


def score(model: PipelineModel, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns + ``label`` (if present) + ``prediction`` (class) +
    ``p1`` (probability of class 1)."""
    out = model.transform(df)
    extra = ["label"] if "label" in df.columns and "label" not in keep else []
    return out.select(*keep, *extra, F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("p1"))


def metrics(scored: DataFrame, label: str = "label", eps: float = 1e-15) -> DataFrame:
    """One row: ``n, accuracy, log_loss, auc`` of a scored DataFrame
    (``prediction``, ``p1``).  Accuracy and log-loss are one aggregate; AUC
    comes from MLlib's distributed ROC computation."""
    from lodestar.session import persisted
    with persisted(scored.select(label, "prediction", "p1")) as sc:
        return _metrics(sc, label, eps)


def _metrics(scored: DataFrame, label: str, eps: float) -> DataFrame:
    p = F.least(F.greatest(F.col("p1"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(label).cast("double")
    agg = scored.agg(F.count(F.lit(1)).alias("n"),
                     F.avg((F.col("prediction") == F.col(label)).cast("double")).alias("accuracy"),
                     F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss")).first()
    auc = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="p1",
                                        metricName="areaUnderROC", numBins=0).evaluate(  # no binning: exact
        scored.select(F.col(label).cast("double").alias(label), "p1"))
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("accuracy", T.DoubleType()),
                           T.StructField("log_loss", T.DoubleType()), T.StructField("auc", T.DoubleType())])
    return scored.sparkSession.createDataFrame([(agg["n"], agg["accuracy"], agg["log_loss"], float(auc))], schema)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
