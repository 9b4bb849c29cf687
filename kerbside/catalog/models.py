"""Queries over predictions: baseline, metrics, gates, model training."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog.inputs import SPLIT, ctes, frame, rounded, snapped
from kerbside.functions import clock
from kerbside.operators import evaluation, modelling
from kerbside.session import reliable_checkpoint

MODELS = {"baseline": "baseline", "static": "static", "rolling": "rolling"}


def _with_hour(rows):
    return rows.selectExpr("*", f"{clock.HOUR_OF_WEEK_SUNDAY.format('pickup_datetime')} AS pickup_hour_of_week")


def _train(spark, folder):
    return _with_hour(frame(spark, folder, "trips").where(f"pickup_datetime < {clock.naive(SPLIT)}"))


def _median_baseline(spark, folder):
    levels = evaluation.median_levels(_train(spark, folder))
    rows = _with_hour(frame(spark, folder, "holdout")).select(
        "trip_id", "pickup_zone_id", "dropoff_zone_id", "pickup_hour_of_week"
    )
    return rounded(evaluation.median_baseline(levels, rows))


def _buckets(spark, folder):
    # No trip is longer than the last finite edge, so the last bucket is empty for every model.
    return evaluation.bucket_metrics(frame(spark, folder, "holdout"), MODELS, (*evaluation.DISTANCE_EDGES[:-1], 1e6, float("inf")))


def _candidates(spark, folder):
    """One candidate per user: errors of its events against those of simpler models."""
    return frame(spark, folder, "holdout").groupBy((F.col("event_id") % 40).alias("group")).agg(
        F.expr("concat('c', event_id % 40) AS candidate_version"),
        F.expr("CASE WHEN event_id % 40 = 7 THEN 0D ELSE avg(abs(rolling - actual_duration_seconds)) END AS mae_seconds"),
        F.expr("CASE WHEN event_id % 40 IN (7, 8) THEN 0D ELSE avg(abs(static - actual_duration_seconds)) END AS baseline_mae_seconds"),
        F.expr("max(trip_distance_miles) / 3 AS max_calibration_error_pct"),
        F.expr("avg(trip_distance_miles) AS inference_p95_ms"),
        F.expr("CASE WHEN event_id % 40 % 3 = 0 THEN avg(abs(rolling - actual_duration_seconds)) * 1.02D END AS production_mae_seconds"),
    )


def _holdout_match(spark, folder):
    events = frame(spark, folder, "events")
    reports = events.selectExpr(
        "'m' || event_id AS registered_model",
        "'c' || event_id AS candidate_version",
        "CASE WHEN event_id % 14 = 0 THEN '2024-03' ELSE '2024-04' END AS holdout_month",
        "CASE WHEN event_id % 22 = 0 THEN NULL ELSE sha2(CAST(user_id AS STRING), 256) END AS holdout_sha256",
    )
    incumbents = events.selectExpr(
        "'m' || event_id AS registered_model",
        "'2024-04' AS production_holdout_month",
        "sha2(CAST(user_id + CASE WHEN event_id % 18 = 0 THEN 1 ELSE 0 END AS STRING), 256) AS production_holdout_sha256",
    )
    return evaluation.holdout_match(reports, incumbents)


def _score_parity(spark, folder):
    scores = frame(spark, folder, "holdout").selectExpr(
        "trip_id",
        "static AS native",
        "static * (1e0 + CASE WHEN event_id % 5 = 0 THEN 1e-11 WHEN event_id % 7 = 0 THEN 1e-14 ELSE 0e0 END) AS served",
    )
    return evaluation.score_parity(scores, "native", "served").select("trip_id", "agrees")


def _run_id(spark, folder):
    inputs = (
        frame(spark, folder, "trips")
        .groupBy(F.expr("date_format(pickup_datetime, 'yyyy-MM') AS month"))
        .agg(
            # A digest of the rows that does not depend on their order.
            F.expr("sha2(CAST(sum(CAST(xxhash64(trip_id) AS DECIMAL(38, 0))) AS STRING), 256) AS sha256"),
            F.expr("count(1) AS row_count"),
            F.expr("'gold-features-v2' AS feature_model_version"),
        )
    )
    return evaluation.run_identity(inputs, {"promotion_role": "rolling", "seed": "42", "trees": "800"})


def _gbt(spark, folder):
    from kerbside.catalog.trips import gold

    # Every pass of the trees reads it.
    rows = reliable_checkpoint(gold(spark, folder))
    train = rows.where(f"pickup_datetime < {clock.naive(SPLIT)}")
    holdout = rows.where(f"pickup_datetime >= {clock.naive(SPLIT)}")
    fitted = modelling.train_trees(train, rolling=True, trees=3, depth=4, seed=42)
    return rounded(
        modelling.score(fitted, holdout, "predicted").select(
            "trip_id", "actual_duration_seconds", "predicted"
        )
    )


QUERIES = {
    "median_levels": lambda s, d: rounded(evaluation.median_levels(_train(s, d))),
    "median_baseline": _median_baseline,
    "distance_buckets": lambda s, d: evaluation.distance_buckets(frame(s, d, "trips")).select("trip_id", "distance_bucket"),
    "model_metrics": lambda s, d: rounded(evaluation.model_metrics(frame(s, d, "holdout"), MODELS)),
    "bucket_metrics": lambda s, d: rounded(_buckets(s, d)),
    "max_calibration": lambda s, d: rounded(evaluation.max_calibration(_buckets(s, d))),
    "cohort_metrics": lambda s, d: rounded(evaluation.cohort_metrics(frame(s, d, "holdout"), MODELS)),
    "promotion_gates": lambda s, d: rounded(evaluation.promotion_gates(_candidates(s, d))),
    "promotion_decision": lambda s, d: evaluation.promotion_decision(evaluation.promotion_gates(_candidates(s, d))),
    "rolling_gain": lambda s, d: rounded(
        evaluation.rolling_gain(evaluation.model_metrics(frame(s, d, "holdout"), MODELS))
    ),
    "holdout_match": _holdout_match,
    "score_parity": _score_parity,
    "run_id": _run_id,
    "gbt_scores": _gbt,
}

_HOLDOUT = ctes("holdout")
_LEVELS = ctes("trips", "holdout") + """, train AS (SELECT *, CAST(dayofweek(pickup_datetime) * 24 + hour(pickup_datetime) AS SMALLINT) AS h
   FROM trips WHERE pickup_datetime < TIMESTAMP '2024-01-15'),
 exact AS (SELECT pickup_zone_id, dropoff_zone_id, h, median(actual_duration_seconds) AS v, count(*) AS n FROM train GROUP BY ALL),
 pickup AS (SELECT pickup_zone_id, h, median(actual_duration_seconds) AS v, count(*) AS n FROM train GROUP BY ALL),
 whole AS (SELECT median(actual_duration_seconds) AS v, count(*) AS n FROM train) """
_BUCKETS = _HOLDOUT + """, long AS (SELECT 'baseline' AS model, baseline AS predicted, trip_distance_miles AS miles, actual_duration_seconds AS actual FROM holdout
   UNION ALL SELECT 'static', static, trip_distance_miles, actual_duration_seconds FROM holdout
   UNION ALL SELECT 'rolling', rolling, trip_distance_miles, actual_duration_seconds FROM holdout),
 edges(distance_bucket, lower_miles, upper_miles) AS (VALUES ('[0,2)', 0e0, 2e0), ('[2,5)', 2e0, 5e0), ('[5,10)', 5e0, 10e0), ('[10,1e+06)', 10e0, 1e6), ('[1e+06,inf)', 1e6, NULL)),
 measured AS (SELECT m.model, e.distance_bucket, e.lower_miles, e.upper_miles, count(l.actual) AS rows, avg(abs(l.predicted - l.actual)) AS mae,
   avg(l.actual) AS am, avg(l.predicted) AS pm FROM (VALUES ('baseline'), ('static'), ('rolling')) m(model) CROSS JOIN edges e
   LEFT JOIN long l ON l.model = m.model AND l.miles >= e.lower_miles AND (e.upper_miles IS NULL OR l.miles < e.upper_miles) GROUP BY ALL) """
_CANDIDATES = _HOLDOUT + """, g AS (SELECT event_id % 40 AS g, avg(abs(rolling - actual_duration_seconds)) AS r,
   avg(abs(static - actual_duration_seconds)) AS s, max(trip_distance_miles) / 3 AS c, avg(trip_distance_miles) AS l FROM holdout GROUP BY 1),
 k AS (SELECT 'c' || g AS candidate_version, CASE WHEN g = 7 THEN 0 ELSE r END AS mae, CASE WHEN g IN (7, 8) THEN 0 ELSE s END AS base, c, l,
   CASE WHEN g % 3 = 0 THEN r * 1.02e0 END AS prod FROM g),
 gates AS (SELECT candidate_version, 'mae_improvement_vs_baseline_pct' AS rule, CASE WHEN base = 0 THEN CASE WHEN mae = 0 THEN 0e0 ELSE -100e0 END
     ELSE (base - mae) / base * 100 END AS observed, 15e0 AS threshold, true AS atleast FROM k
   UNION ALL SELECT candidate_version, 'max_distance_bucket_calibration_error_pct', c, 10e0, false FROM k
   UNION ALL SELECT candidate_version, 'inference_p95_ms', l, 5e0, false FROM k
   UNION ALL SELECT candidate_version, 'mae_improvement_vs_production_pct', CASE WHEN prod = 0 THEN CASE WHEN mae = 0 THEN 0e0 ELSE -100e0 END
     ELSE (prod - mae) / prod * 100 END, 1e0, true FROM k WHERE prod IS NOT NULL),
 judged AS (SELECT *, CASE WHEN atleast THEN observed >= threshold ELSE observed <= threshold END AS passed FROM gates) """
_METRIC = "SELECT '{0}' AS model, count(*) AS rows, snap(avg(abs({0} - actual_duration_seconds))) AS mae_seconds, snap(sqrt(avg(power({0} - actual_duration_seconds, 2)))) AS rmse_seconds, snap(avg(abs({0} - actual_duration_seconds) / actual_duration_seconds) * 100) AS mape_pct FROM holdout"
_COHORT = "SELECT {0} AS passenger_count_known, count(*) AS rows, snap(avg(abs(baseline - actual_duration_seconds))) AS baseline_mae_seconds, snap(avg(abs(static - actual_duration_seconds))) AS static_mae_seconds, snap(avg(abs(rolling - actual_duration_seconds))) AS rolling_mae_seconds FROM holdout WHERE passenger_count IS {1}NULL"

ORACLES = {
    "median_levels": f"""{_LEVELS}
SELECT 'exact' AS level, pickup_zone_id, dropoff_zone_id, h AS pickup_hour_of_week, snap(v) AS median_seconds, n AS rows FROM exact
UNION ALL SELECT 'pickup_hour', pickup_zone_id, NULL, h, snap(v), n FROM pickup
UNION ALL SELECT 'global', NULL, NULL, NULL, snap(v), n FROM whole""",
    "median_baseline": f"""{_LEVELS}, rows AS (SELECT *, CAST(dayofweek(pickup_datetime) * 24 + hour(pickup_datetime) AS SMALLINT) AS h FROM holdout)
SELECT r.trip_id, r.pickup_zone_id, r.dropoff_zone_id, r.h AS pickup_hour_of_week,
  snap(coalesce(e.v, p.v, (SELECT v FROM whole))) AS baseline_seconds,
  CASE WHEN e.v IS NOT NULL THEN 'exact' WHEN p.v IS NOT NULL THEN 'pickup_hour' ELSE 'global' END AS baseline_level
FROM rows r LEFT JOIN exact e ON e.pickup_zone_id = r.pickup_zone_id AND e.dropoff_zone_id = r.dropoff_zone_id AND e.h = r.h
LEFT JOIN pickup p ON p.pickup_zone_id = r.pickup_zone_id AND p.h = r.h""",
    "distance_buckets": ctes("trips") + """ SELECT trip_id, CASE WHEN trip_distance_miles < 2 THEN '[0,2)' WHEN trip_distance_miles < 5 THEN '[2,5)'
  WHEN trip_distance_miles < 10 THEN '[5,10)' ELSE '[10,inf)' END AS distance_bucket FROM trips""",
    "model_metrics": f"{_HOLDOUT} " + " UNION ALL ".join(_METRIC.format(m) for m in MODELS),
    "bucket_metrics": f"""{_BUCKETS} SELECT model, distance_bucket, snap(lower_miles) AS lower_miles, snap(upper_miles) AS upper_miles, rows,
  snap(mae) AS mae_seconds, snap(am) AS actual_mean_seconds, snap(pm) AS predicted_mean_seconds, snap(abs(pm - am) / am * 100) AS calibration_error_pct FROM measured""",
    "max_calibration": f"{_BUCKETS} SELECT model, snap(coalesce(max(abs(pm - am) / am * 100), 0)) AS max_calibration_error_pct FROM measured GROUP BY model",
    "cohort_metrics": f"{_HOLDOUT} {_COHORT.format('true', 'NOT ')} UNION ALL {_COHORT.format('false', '')}",
    "promotion_gates": f"{_CANDIDATES} SELECT candidate_version, rule, snap(observed) AS observed, snap(threshold) AS threshold, passed FROM judged",
    "promotion_decision": f"""{_CANDIDATES} SELECT candidate_version, CASE WHEN bool_and(passed) THEN 'promote' ELSE 'reject' END AS outcome,
  count(*) AS gates, count(*) FILTER (WHERE passed) AS gates_passed FROM judged GROUP BY 1""",
    "rolling_gain": f"""{_HOLDOUT}, e AS (SELECT avg(abs(static - actual_duration_seconds)) AS s, avg(abs(rolling - actual_duration_seconds)) AS r FROM holdout)
SELECT snap(s) AS static_mae_seconds, snap(r) AS rolling_mae_seconds, snap(CASE WHEN s = 0 THEN 0 ELSE (s - r) / s * 100 END) AS mae_improvement_vs_static_pct FROM e""",
    "holdout_match": """SELECT 'm' || event_id AS registered_model, 'c' || event_id AS candidate_version,
  event_id % 14 <> 0 AND event_id % 22 <> 0 AND event_id % 18 <> 0 AS comparable FROM events""",
    "score_parity": f"{_HOLDOUT} SELECT trip_id, event_id % 5 <> 0 AS agrees FROM holdout",
}
ORACLES = {name: snapped(sql) for name, sql in ORACLES.items()}
