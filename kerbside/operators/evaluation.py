"""Median baseline, error metrics, calibration, cohorts and promotion gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.functions import digests, numbers

# --- fixed values: bucket edges and gate thresholds ---
DISTANCE_EDGES = [0.0, 2.0, 5.0, 10.0, float("inf")]
GATE_THRESHOLDS = {
    "mae_improvement_vs_baseline_pct": 15.0,
    "max_distance_bucket_calibration_error_pct": 10.0,
    "inference_p95_ms": 5.0,
    "mae_improvement_vs_production_pct": 1.0,
}
# --- end of fixed values ---

EXACT_KEY = ("pickup_zone_id", "dropoff_zone_id", "pickup_hour_of_week")
PICKUP_KEY = ("pickup_zone_id", "pickup_hour_of_week")


def median_levels(train: DataFrame, target: str = schemas.TARGET) -> DataFrame:
    """Exact medians per (pickup, dropoff, hour), per (pickup, hour) and overall.

    Values are first counted per exact key: durations are whole seconds between
    60 and 10,800, so a key holds at most 10,741 distinct values however many
    trips it has. The coarser levels are built from those counts.
    """
    counted = train.groupBy(*EXACT_KEY, target).agg(F.expr("count(1) AS _rows"))
    per_pickup = counted.groupBy(*PICKUP_KEY, target).agg(F.expr("sum(_rows) AS _rows"))
    overall = per_pickup.groupBy(target).agg(F.expr("sum(_rows) AS _rows"))
    median = [
        F.expr(f"percentile({target}, 0.5D, _rows) AS median_seconds"),
        F.expr("sum(_rows) AS rows"),
    ]
    order = ["level", *EXACT_KEY, "median_seconds", "rows"]
    exact = counted.groupBy(*EXACT_KEY).agg(*median).selectExpr("'exact' AS level", "*").select(order)
    pickup = (
        per_pickup.groupBy(*PICKUP_KEY)
        .agg(*median)
        .selectExpr("'pickup_hour' AS level", "CAST(NULL AS SMALLINT) AS dropoff_zone_id", "*")
        .select(order)
    )
    whole = overall.agg(*median).selectExpr(
        "'global' AS level",
        *[f"CAST(NULL AS SMALLINT) AS {name}" for name in EXACT_KEY],
        "median_seconds",
        "rows",
    )
    return exact.unionByName(pickup).unionByName(whole.where("rows IS NOT NULL"))


def median_baseline(levels: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``baseline_seconds`` and the level it came from, most specific first.

    At most 265 * 168 pickup-hour medians exist, which may be broadcast; exact
    medians can be millions, so Spark chooses that join by size.
    """
    exact = levels.where("level = 'exact'").selectExpr(*EXACT_KEY, "median_seconds AS _exact")
    pickup = levels.where("level = 'pickup_hour'").selectExpr(*PICKUP_KEY, "median_seconds AS _pickup")
    whole = levels.where("level = 'global'").agg(F.max("median_seconds"))
    joined = (
        rows.join(exact, list(EXACT_KEY), "left")
        .join(F.broadcast(pickup), list(PICKUP_KEY), "left")
        .withColumn("_global", whole.scalar())
    )
    return joined.selectExpr(
        *rows.columns,
        "coalesce(_exact, _pickup, _global) AS baseline_seconds",
        "CASE WHEN _exact IS NOT NULL THEN 'exact' WHEN _pickup IS NOT NULL THEN 'pickup_hour'"
        " ELSE 'global' END AS baseline_level",
    )


def scores_long(scored: DataFrame, models: Mapping[str, str], keep: Sequence[str]) -> DataFrame:
    """One row per trip and model with ``model`` and ``predicted``."""
    pairs = ", ".join(f"'{name}', CAST({column} AS DOUBLE)" for name, column in models.items())
    return scored.selectExpr(*keep, f"stack({len(models)}, {pairs}) AS (model, predicted)")


def model_metrics(scored: DataFrame, models: Mapping[str, str], target: str = schemas.TARGET) -> DataFrame:
    """MAE, RMSE and MAPE per model from one pass with no expansion of rows."""
    sums = []
    for name, column in models.items():
        error = f"(CAST({column} AS DOUBLE) - {target})"
        sums += [
            F.expr(f"avg(abs({error})) AS {name}_mae"),
            F.expr(f"sqrt(avg({error} * {error})) AS {name}_rmse"),
            F.expr(f"avg(abs({error}) / {target}) * 100 AS {name}_mape"),
        ]
    one = scored.agg(F.expr("count(1) AS rows"), *sums)
    triples = ", ".join(f"'{name}', {name}_mae, {name}_rmse, {name}_mape" for name in models)
    return one.selectExpr(
        f"stack({len(models)}, {triples}) AS (model, mae_seconds, rmse_seconds, mape_pct)", "rows"
    ).select("model", "rows", "mae_seconds", "rmse_seconds", "mape_pct")


def distance_buckets(rows: DataFrame, edges: Sequence[float] = DISTANCE_EDGES) -> DataFrame:
    return rows.selectExpr(
        "*", f"{numbers.bucket_label('trip_distance_miles', list(edges))} AS distance_bucket"
    )


def bucket_metrics(
    scored: DataFrame,
    models: Mapping[str, str],
    edges: Sequence[float] = DISTANCE_EDGES,
    target: str = schemas.TARGET,
) -> DataFrame:
    """Rows, MAE, means and calibration error per model and distance bucket.

    Empty buckets stay, with NULL measures.
    """
    spark = scored.sparkSession
    bounds = [
        (numbers.bucket_name(lower, upper), lower, None if upper == float("inf") else upper)
        for lower, upper in zip(edges, edges[1:])
    ]
    dimension = spark.createDataFrame(
        [(name, *bound) for name in models for bound in bounds],
        "model string, distance_bucket string, lower_miles double, upper_miles double",
    )
    long = scores_long(distance_buckets(scored, edges), models, ["distance_bucket", target])
    measured = long.groupBy("model", "distance_bucket").agg(
        F.expr("count(1) AS _rows"),
        F.expr(f"avg(abs(predicted - {target})) AS mae_seconds"),
        F.expr(f"avg(CAST({target} AS DOUBLE)) AS actual_mean_seconds"),
        F.expr("avg(predicted) AS predicted_mean_seconds"),
    )
    # Both sides have at most one row per model and bucket.
    return dimension.join(F.broadcast(measured), ["model", "distance_bucket"], "left").selectExpr(
        "model",
        "distance_bucket",
        "lower_miles",
        "upper_miles",
        "coalesce(_rows, 0) AS rows",
        "mae_seconds",
        "actual_mean_seconds",
        "predicted_mean_seconds",
        "abs(predicted_mean_seconds - actual_mean_seconds) / actual_mean_seconds * 100"
        " AS calibration_error_pct",
    )


def max_calibration(buckets: DataFrame) -> DataFrame:
    return buckets.groupBy("model").agg(
        F.expr("coalesce(max(calibration_error_pct), 0D) AS max_calibration_error_pct")
    )


def cohort_metrics(
    scored: DataFrame, models: Mapping[str, str], target: str = schemas.TARGET
) -> DataFrame:
    """MAE per model for trips with and without a known passenger count; both rows always exist."""
    parts = []
    for known, test in (("true", "passenger_count IS NOT NULL"), ("false", "passenger_count IS NULL")):
        parts.append(F.expr(f"count_if({test}) AS rows_{known}"))
        for name, column in models.items():
            parts.append(
                F.expr(
                    f"avg(CASE WHEN {test} THEN abs(CAST({column} AS DOUBLE) - {target}) END)"
                    f" AS {name}_{known}"
                )
            )
    one = scored.agg(*parts)
    fields = ", ".join(
        ", ".join([known, f"rows_{known}", *[f"{name}_{known}" for name in models]])
        for known in ("true", "false")
    )
    names = ", ".join(f"{name}_mae_seconds" for name in models)
    return one.selectExpr(f"stack(2, {fields}) AS (passenger_count_known, rows, {names})")


def promotion_gates(
    candidates: DataFrame, thresholds: Mapping[str, float] = GATE_THRESHOLDS
) -> DataFrame:
    """Gate rows per candidate.

    ``candidates`` has candidate_version, mae_seconds, baseline_mae_seconds,
    max_calibration_error_pct, inference_p95_ms and production_mae_seconds; the
    production gate exists only where that is not NULL.
    """
    observed = {
        "mae_improvement_vs_baseline_pct": (
            numbers.mae_improvement_pct("mae_seconds", "baseline_mae_seconds"),
            ">=",
        ),
        "max_distance_bucket_calibration_error_pct": ("max_calibration_error_pct", "<="),
        "inference_p95_ms": ("inference_p95_ms", "<="),
        "mae_improvement_vs_production_pct": (
            numbers.mae_improvement_pct("mae_seconds", "production_mae_seconds"),
            ">=",
        ),
    }
    rows = []
    for rule, (value, comparison) in observed.items():
        limit = f"{float(thresholds[rule])!r}D"
        rows.append(f"'{rule}', CAST({value} AS DOUBLE), {limit}, ({value}) {comparison} {limit}")
    return candidates.selectExpr(
        "candidate_version",
        "production_mae_seconds",
        f"stack({len(rows)}, {', '.join(rows)}) AS (rule, observed, threshold, passed)",
    ).where(
        "rule <> 'mae_improvement_vs_production_pct' OR production_mae_seconds IS NOT NULL"
    ).select("candidate_version", "rule", "observed", "threshold", "passed")


def promotion_decision(gates: DataFrame) -> DataFrame:
    return gates.groupBy("candidate_version").agg(
        F.expr("CASE WHEN bool_and(passed) THEN 'promote' ELSE 'reject' END AS outcome"),
        F.expr("count(1) AS gates"),
        F.expr("count_if(passed) AS gates_passed"),
    )


def rolling_gain(metrics: DataFrame, static: str = "static", rolling: str = "rolling") -> DataFrame:
    """How much the rolling features cut the static model's MAE, in percent."""
    one = metrics.agg(
        F.expr(f"max(CASE WHEN model = '{static}' THEN mae_seconds END) AS static_mae_seconds"),
        F.expr(f"max(CASE WHEN model = '{rolling}' THEN mae_seconds END) AS rolling_mae_seconds"),
    )
    return one.selectExpr(
        "*",
        "CASE WHEN static_mae_seconds = 0 THEN 0D ELSE (static_mae_seconds - rolling_mae_seconds)"
        " / static_mae_seconds * 100 END AS mae_improvement_vs_static_pct",
    )


def run_identity(inputs: DataFrame, settings: Mapping[str, str]) -> DataFrame:
    """Sixteen hex digits naming what a training run reads and how it is set up.

    Only the manifest rows of the inputs are gathered: one per month.
    """
    fixed = ", ".join(f"'{value}' AS {key}" for key, value in sorted(settings.items()))
    gathered = inputs.agg(
        F.expr(
            "sort_array(collect_list(struct(month, sha256, row_count, feature_model_version)))"
            " AS inputs"
        )
    )
    return gathered.selectExpr("inputs", f"struct({fixed}) AS settings").selectExpr(
        f"{digests.short_digest(['inputs', 'settings'])} AS run_id", "size(inputs) AS input_months"
    )


def holdout_match(reports: DataFrame, incumbents: DataFrame) -> DataFrame:
    """Whether each candidate may be compared with the incumbent: same month, same digest."""
    return reports.join(incumbents, "registered_model").selectExpr(
        "registered_model",
        "candidate_version",
        "holdout_month = production_holdout_month AND coalesce(holdout_sha256, '') <> ''"
        " AND holdout_sha256 <=> production_holdout_sha256 AS comparable",
    )


def score_parity(scores: DataFrame, left: str, right: str, tolerance: float = 1e-12) -> DataFrame:
    return scores.selectExpr("*", f"{numbers.relative_close(left, right, tolerance)} AS agrees")
