"""Fit, evaluate and gate the baseline and two tree models on gold months."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError
from kerbside.functions.clock import Month
from kerbside.operators import evaluation, modelling, quality
from kerbside.session import reliable_checkpoint
from kerbside.sources import storage
from kerbside.sources.files import table_digest
from kerbside.sources.storage import Layers

MODELS = {"baseline": "baseline_seconds", "static": "static_seconds", "rolling": "rolling_seconds"}
REQUIRED = (*schemas.STATIC_FEATURES, *schemas.ROLLING_FEATURES, schemas.TARGET, "feature_model_version")


@dataclass(frozen=True)
class Evaluation:
    scored: DataFrame
    metrics: DataFrame
    buckets: DataFrame
    cohorts: DataFrame
    gates: DataFrame
    decision: DataFrame
    static_model: PipelineModel
    rolling_model: PipelineModel


def load_gold(spark: SparkSession, root: str, months: Sequence[str]) -> DataFrame:
    paths = [storage.location(spark, Layers(root.rstrip("/"), Month.parse(month)).gold()) for month in months]
    return quality.require_columns(spark.read.option("mergeSchema", "true").parquet(*paths), REQUIRED)


def gold_manifests(spark: SparkSession, root: str, months: Sequence[str]) -> DataFrame:
    """Month, digest, rows and feature version of gold months; a month whose files changed is an error."""
    parts = []
    for month in months:
        layers = Layers(root.rstrip("/"), Month.parse(month))
        manifest = storage.read_report(spark, layers.gold_manifest())
        if manifest.first().output_sha256 != storage.digest(spark, layers.gold()).sha256:
            raise DataContractError(f"gold of {month} differs from its manifest")
        parts.append(manifest.selectExpr("month", "output_sha256 AS sha256", "row_count", "feature_model_version"))
    return reduce(DataFrame.unionByName, parts)


def train_month(
    spark: SparkSession, root: str, months: Sequence[str], holdout: str, settings: Mapping[str, str] | None = None, **options
) -> str:
    """Train on gold months, judge on the holdout, and keep models and reports; the path of the run.

    The run is named by what it reads and how it is set up; a finished run of
    that name is used again, not repeated.
    """
    fixed = {key: str(value) for key, value in {**options, **(settings or {}), "holdout": holdout}.items()}
    manifests = gold_manifests(spark, root, [*months, holdout])
    run_id = evaluation.run_identity(manifests, fixed).first().run_id
    path = f"{root.rstrip('/')}/training/{run_id}"
    if storage.exists(spark, f"{path}/manifest"):
        return path
    storage.remove(spark, path)
    # One copy of what every tree pass reads.
    needed = [*REQUIRED]
    train = reliable_checkpoint(load_gold(spark, root, months).select(*needed))
    result = evaluate_models(train, load_gold(spark, root, [holdout]).select(*needed), **options)
    result.static_model.write().overwrite().save(f"{path}/models/static")
    result.rolling_model.write().overwrite().save(f"{path}/models/rolling")
    for name in ("metrics", "buckets", "cohorts", "gates", "decision"):
        storage.write_report(getattr(result, name), f"{path}/{name}")
    held = manifests.where(F.col("month") == holdout).selectExpr("month AS holdout_month", "sha256 AS holdout_sha256")
    manifest = held.withColumns(
        {
            "run_id": F.lit(run_id),
            "training_months": F.lit(",".join(months)),
            "settings": F.lit(json.dumps(fixed, sort_keys=True)),
            "static_model_sha256": F.lit(table_digest(spark, f"{path}/models/static/stages/*/data").sha256),
            "rolling_model_sha256": F.lit(table_digest(spark, f"{path}/models/rolling/stages/*/data").sha256),
        }
    )
    # Written last: a run without it is not finished.
    storage.write_report(manifest, f"{path}/manifest")
    return path


def check_gold(train: DataFrame, holdout: DataFrame) -> None:
    """One supported version everywhere, and passenger counts it allows."""
    both = train.selectExpr("'train' AS input", "feature_model_version").unionByName(
        holdout.selectExpr("'holdout' AS input", "feature_model_version")
    )
    gate = quality.version_gate(
        both, schemas.FEATURES_BY_CONTRACT.values(), column="feature_model_version"
    ).collect()
    if not all(row.single_supported and row.versions_agree for row in gate):
        raise DataContractError("training and holdout need one supported feature version")
    for frame in (train, holdout):
        if quality.passenger_violations(frame).limit(1).count():
            raise DataContractError("passenger counts break the feature contract")


def evaluate_models(
    train: DataFrame,
    holdout: DataFrame,
    *,
    inference_p95_ms: float,
    role: str = "rolling",
    production_mae_seconds: float | None = None,
    thresholds: Mapping[str, float] = evaluation.GATE_THRESHOLDS,
    min_train: int = 1000,
    min_holdout: int = 100,
    **tree_options,
) -> Evaluation:
    """Everything a promotion decision rests on.

    Single-request latency is a property of the serving process, so its p95 is
    an input. Scores are kept in a reliable checkpoint: four reports read them.
    """
    modelling.require_rows(train, holdout, min_train, min_holdout)
    check_gold(train, holdout)
    static_model = modelling.train_trees(train, rolling=False, **tree_options)
    rolling_model = modelling.train_trees(train, rolling=True, **tree_options)
    levels = evaluation.median_levels(train)
    scored = evaluation.median_baseline(levels, holdout)
    scored = modelling.score(static_model, scored, "static_seconds")
    scored = reliable_checkpoint(modelling.score(rolling_model, scored, "rolling_seconds"))

    metrics = evaluation.model_metrics(scored, MODELS)
    buckets = evaluation.bucket_metrics(scored, MODELS)
    measured = metrics.join(evaluation.max_calibration(buckets), "model")
    production = "NULL" if production_mae_seconds is None else f"{float(production_mae_seconds)!r}D"

    def of(model: str, column: str) -> str:
        return f"max(CASE WHEN model = '{model}' THEN {column} END) AS "

    candidate = measured.agg(
        F.expr(f"'{role}' AS candidate_version"),
        F.expr(of(role, "mae_seconds") + "mae_seconds"),
        F.expr(of("baseline", "mae_seconds") + "baseline_mae_seconds"),
        F.expr(of(role, "max_calibration_error_pct") + "max_calibration_error_pct"),
        F.expr(f"{float(inference_p95_ms)!r}D AS inference_p95_ms"),
        F.expr(f"CAST({production} AS DOUBLE) AS production_mae_seconds"),
    )
    gates = evaluation.promotion_gates(candidate, thresholds)
    return Evaluation(
        scored,
        metrics,
        buckets,
        evaluation.cohort_metrics(scored, MODELS),
        gates,
        evaluation.promotion_decision(gates),
        static_model,
        rolling_model,
    )
