"""Gradient-boosted trees on gold features with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError

CATEGORIES = ("pickup_zone_id", "dropoff_zone_id", "pickup_hour_of_week")
# 265 zones and one bin for unseen ones.
MAX_BINS = 272


def prepare(rows: DataFrame) -> DataFrame:
    """Numeric columns for the trees.

    Missing values become -1 next to a flag column, because these trees do not
    route missing values by themselves.
    """
    columns = [f"CAST({name} AS STRING) AS {name}_label" for name in CATEGORIES]
    for name in ("passenger_count", *schemas.ROLLING_FEATURES):
        if name in rows.columns:
            columns.append(f"coalesce(CAST({name} AS DOUBLE), -1D) AS {name}_value")
            columns.append(f"CAST({name} IS NULL AS DOUBLE) AS {name}_missing")
    return rows.selectExpr("*", *columns)


def train_trees(
    train: DataFrame,
    *,
    rolling: bool,
    trees: int = 100,
    depth: int = 5,
    step: float = 0.1,
    seed: int = 42,
) -> PipelineModel:
    """Trees with absolute-error loss on the static features, plus the rolling ones if asked."""
    plain = ["passenger_count", *(schemas.ROLLING_FEATURES if rolling else ())]
    inputs = [f"{name}_index" for name in CATEGORIES] + ["trip_distance_miles"]
    inputs += [f"{name}_{part}" for name in plain for part in ("value", "missing")]
    stages = [
        StringIndexer(
            inputCols=[f"{name}_label" for name in CATEGORIES],
            outputCols=[f"{name}_index" for name in CATEGORIES],
            handleInvalid="keep",
        ),
        VectorAssembler(inputCols=inputs, outputCol="features"),
        GBTRegressor(
            featuresCol="features",
            labelCol=schemas.TARGET,
            predictionCol="prediction",
            lossType="absolute",
            maxBins=MAX_BINS,
            maxIter=trees,
            maxDepth=depth,
            stepSize=step,
            seed=seed,
        ),
    ]
    return Pipeline(stages=stages).fit(prepare(train))


def score(model: PipelineModel, rows: DataFrame, name: str) -> DataFrame:
    return model.transform(prepare(rows)).select(*rows.columns, F.col("prediction").alias(name))


def require_rows(train: DataFrame, holdout: DataFrame, min_train: int = 1000, min_holdout: int = 100) -> None:
    for label, frame, least in (("training", train, min_train), ("holdout", holdout, min_holdout)):
        found = frame.limit(least).count()
        if found < least:
            raise DataContractError(f"{label} data has {found} rows; {least} are required")
