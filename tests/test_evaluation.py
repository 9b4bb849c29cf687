"""Known answers of the baseline, metrics, calibration and gates."""

import math
import random

import pytest

from kerbside.operators import evaluation
from kerbside.operators.ranking import percentiles

TRAIN = "pickup_zone_id smallint, dropoff_zone_id smallint, pickup_hour_of_week smallint, actual_duration_seconds int"


def test_median_levels_fall_back(spark):
    train = spark.createDataFrame([(1, 2, 3, 100), (1, 2, 3, 200), (1, 4, 3, 500), (9, 8, 7, 900)], TRAIN)
    rows = spark.createDataFrame(
        [(1, 2, 3), (1, 99, 3), (99, 99, 99)],
        "pickup_zone_id smallint, dropoff_zone_id smallint, pickup_hour_of_week smallint",
    )
    scored = evaluation.median_baseline(evaluation.median_levels(train), rows).collect()
    assert {(r.dropoff_zone_id, r.baseline_seconds, r.baseline_level) for r in scored if r.pickup_zone_id == 1} == {
        (2, 150.0, "exact"),
        (99, 200.0, "pickup_hour"),
    }
    assert [(r.baseline_seconds, r.baseline_level) for r in scored if r.pickup_zone_id == 99] == [(350.0, "global")]


def scored(spark, rows):
    return spark.createDataFrame(rows, "actual_duration_seconds int, predicted double, trip_distance_miles double")


def test_metrics(spark):
    frame = scored(spark, [(100, 90.0, 1.0), (200, 220.0, 3.0), (300, 270.0, 7.0), (400, 440.0, 12.0)])
    row = evaluation.model_metrics(frame, {"m": "predicted"}).first()
    assert row.mae_seconds == 25
    assert row.rmse_seconds == pytest.approx(math.sqrt(750))
    assert row.mape_pct == pytest.approx(10)
    buckets = evaluation.bucket_metrics(frame, {"m": "predicted"})
    assert evaluation.max_calibration(buckets).first().max_calibration_error_pct == pytest.approx(10)


def test_empty_buckets_stay(spark):
    frame = scored(spark, [(100, 90.0, 0.0), (200, 220.0, 2.0), (400, 440.0, 10.0)])
    rows = evaluation.bucket_metrics(frame, {"m": "predicted"}).orderBy("lower_miles").collect()
    assert [row.rows for row in rows] == [1, 1, 0, 1]
    assert rows[2].mae_seconds is None and rows[2].calibration_error_pct is None
    assert rows[3].upper_miles is None


@pytest.mark.parametrize(
    "mae, calibration, latency, production, outcome",
    [
        (80.0, 5.0, 2.0, None, "promote"),
        (90.0, 5.0, 2.0, None, "reject"),
        (80.0, 15.0, 2.0, None, "reject"),
        (80.0, 5.0, 8.0, None, "reject"),
        (80.0, 5.0, 2.0, 80.5, "reject"),
        (80.0, 5.0, 2.0, 100.0, "promote"),
    ],
)
def test_gates(spark, mae, calibration, latency, production, outcome):
    candidates = spark.createDataFrame(
        [("c", mae, 100.0, calibration, latency, production)],
        "candidate_version string, mae_seconds double, baseline_mae_seconds double,"
        " max_calibration_error_pct double, inference_p95_ms double, production_mae_seconds double",
    )
    row = evaluation.promotion_decision(evaluation.promotion_gates(candidates)).first()
    assert row.outcome == outcome
    assert row.gates == (3 if production is None else 4)


def test_perfect_reference_can_be_equalled(spark):
    candidates = spark.createDataFrame(
        [("same", 0.0, 0.0, 0.0, 1.0, 0.0), ("worse", 1.0, 0.0, 0.0, 1.0, 0.0)],
        "candidate_version string, mae_seconds double, baseline_mae_seconds double,"
        " max_calibration_error_pct double, inference_p95_ms double, production_mae_seconds double",
    )
    thresholds = {**evaluation.GATE_THRESHOLDS, "mae_improvement_vs_baseline_pct": 0.0, "mae_improvement_vs_production_pct": 0.0}
    gates = evaluation.promotion_gates(candidates, thresholds)
    outcomes = {r.candidate_version: r.outcome for r in evaluation.promotion_decision(gates).collect()}
    assert outcomes == {"same": "promote", "worse": "reject"}
    observed = {r.observed for r in gates.where("candidate_version = 'worse' AND rule LIKE 'mae%'").collect()}
    assert observed == {-100.0}


def nearest(values, percent):
    ordered = sorted(values)
    return ordered[math.ceil(len(ordered) * percent / 100) - 1]


def test_nearest_rank_percentiles(spark):
    row = percentiles(spark.range(1, 101).selectExpr("CAST(id AS DOUBLE) AS v"), "v", (50, 95, 99)).first()
    assert (row.p50, row.p95, row.p99) == (50, 95, 99)
    empty = percentiles(spark.range(5).selectExpr("CAST(NULL AS DOUBLE) AS v"), "v", (50, 95, 99)).first()
    assert (empty.p50, empty.p95, empty.p99) == (None, None, None)


def test_percentiles_with_hot_groups_and_values(spark):
    rng = random.Random(3)
    rows = [("hot", rng.choice([7.0, rng.uniform(0, 100)])) for _ in range(5000)]
    rows += [("cold", rng.gauss(0, 1)) for _ in range(37)] + [("one", 5.0)]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {row.g: row for row in percentiles(frame, "v", (50, 95, 99), ["g"]).collect()}
    for group in ("hot", "cold", "one"):
        values = [v for g, v in rows if g == group]
        assert [got[group][f"p{p}"] for p in (50, 95, 99)] == [nearest(values, p) for p in (50, 95, 99)]


@pytest.mark.parametrize("count", [1, 2, 3, 20, 101, 1000])
def test_interpolated_percentile(spark, count):
    import numpy

    rng = random.Random(count)
    values = [rng.uniform(0, 9) for _ in range(count)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    row = percentiles(frame, "v", (50, 95), interpolate=True).first()
    assert row.p50 == pytest.approx(numpy.percentile(values, 50))
    assert row.p95 == pytest.approx(numpy.percentile(values, 95))
