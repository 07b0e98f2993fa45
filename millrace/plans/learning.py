"""Training, scoring and versioned models as Spark ML jobs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from millrace.operators.encode import encode_label
from millrace.operators.metrics import binary_metrics, split_by_key, with_balanced_weight
from millrace.operators.schema import integers_to_double, require
from millrace.plans import forest

# Learner settings.
SPLIT_SEED = 42
TRAIN_SHARE = 0.7
LOGISTIC_ITERATIONS = 1000
LOGISTIC_C = 1.0
FOREST_TREES = 100
FOREST_SEED = 42

# Trees are grown until their leaves are pure or it is reached.
FOREST_DEPTH = 30


def model_matrix(
    df: DataFrame, label: str, key: str, features: Sequence[str], drop: Sequence[str] = ("event_timestamp",)
) -> DataFrame:
    """(key, features, label code): integers to double, label classes to codes, NULL to 0."""
    kept = df.drop(*[c for c in drop if c in df.columns])
    require(kept, [key, label, *features])
    numbers = integers_to_double(kept.select(*features, key, label).withColumnRenamed(key, "_key"))
    filled = {}
    for f in numbers.select(*features).schema:
        zero = F.lit(False) if isinstance(f.dataType, T.BooleanType) else F.lit(0.0)
        filled[f.name] = F.coalesce(F.col(f.name), zero)
    coded = encode_label(numbers.withColumns(filled), label, "label")
    return coded.select(F.col("_key").alias(key), *features, F.col("label").cast("double").alias("label"))


def _assembler(features: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")


def _training_rows(train: DataFrame, features: Sequence[str]) -> tuple[DataFrame, int]:
    """(features, label, weight) cached, and the row count.

    Every iteration is a job over these rows. They are spread evenly over
    ``spark.sql.shuffle.partitions`` partitions, whatever their number and whatever the cores, so
    a model depends on rows, seed and that setting alone.
    """
    weighted = with_balanced_weight(train.where("label is not null"), "label")
    rows = _assembler(features).transform(weighted).select("features", "label", "weight")
    rows = rows.repartition(int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))).persist()
    return rows, rows.count()


def fit_logistic(train: DataFrame, features: Sequence[str]) -> PipelineModel:
    """Balanced L2 logistic regression with C = 1.

    Balanced weights sum to the row count n and Spark divides the loss by that sum, so the
    penalty of C = 1 is 1 / n.
    """
    rows, n = _training_rows(train, features)
    try:
        model = LogisticRegression(
            weightCol="weight",
            maxIter=LOGISTIC_ITERATIONS,
            regParam=1.0 / (LOGISTIC_C * max(n, 1)),
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-4,
        ).fit(rows)
    finally:
        rows.unpersist()
    return PipelineModel([_assembler(features), model])


def fit_forest(train: DataFrame, features: Sequence[str], depth: int = FOREST_DEPTH) -> PipelineModel:
    """Balanced random forest, 100 trees, square root of the features per split."""
    return PipelineModel([forest.fit(train, "label", features, FOREST_TREES, depth, FOREST_SEED)])


def train_and_score(matrix: DataFrame, key: str, features: Sequence[str], fit) -> DataFrame:
    """Fit on the 70 % part and return the metrics on the rest."""
    train, test = split_by_key(matrix, key, TRAIN_SHARE, SPLIT_SEED)
    return binary_metrics(fit(train, features).transform(test), "label", "prediction")


def save_model(spark: SparkSession, model: PipelineModel, zone: str, version: int | None = None) -> int:
    """Save under the next free version number of the zone and return it."""
    number = version if version is not None else (latest_version(spark, zone) or 0) + 1
    model.write().save(f"{zone}/version={number}")
    return number


def latest_version(spark: SparkSession, zone: str) -> int | None:
    try:
        listed = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(zone).select("path")
        )
        return listed.agg(F.max(F.regexp_extract("path", r"version=(\d+)/", 1).try_cast("int"))).first()[0]
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            return None
        raise


def load_model(zone: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{zone}/version={version}")
