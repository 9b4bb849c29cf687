"""Lookup outcomes, score selection, load summaries, deliveries and contracts."""

import json
from datetime import datetime, timedelta

import pytest

from kerbside.functions import digests
from kerbside.operators import contracts, delivery, lineage, loadtest, online
from kerbside.operators.ranking import percentiles
from kerbside.sources import kafka

END = datetime(2024, 9, 3, 13, 30)
STORE = (
    "key_version string, key_role string, key_zone smallint, key_window string, zone_role string, zone_id smallint,"
    " window_kind string, window_start timestamp_ntz, window_end timestamp_ntz, computed_at timestamp_ntz,"
    " source_max_event_time timestamp_ntz, trip_count bigint, mean_speed_mph double, mean_duration_seconds double,"
    " mean_distance_miles double, feature_model_version string, schema_version string"
)
REQUEST = (
    "trip_id string, pickup_zone_id smallint, dropoff_zone_id smallint, pickup_time timestamp_ntz,"
    " trip_distance_miles double, passenger_count smallint"
)


def snapshot(role, zone, window, count, **changes):
    row = {
        "key_version": "gold-features-v1", "key_role": role, "key_zone": zone, "key_window": window,
        "zone_role": role, "zone_id": zone, "window_kind": window,
        "window_start": END - timedelta(seconds=900 if window == "15m" else 3600), "window_end": END,
        "computed_at": END + timedelta(seconds=4), "source_max_event_time": END - timedelta(seconds=37),
        "trip_count": count, "mean_speed_mph": 9.5, "mean_duration_seconds": 840.0, "mean_distance_miles": 3.1,
        "feature_model_version": "gold-features-v1", "schema_version": "1.0",
    }
    return {**row, **changes}


NOTHING = {"trip_count": 0, "source_max_event_time": None, "mean_speed_mph": 0.0, "mean_duration_seconds": 0.0, "mean_distance_miles": 0.0}


def lookup(spark, age=0.0, short=None, long=None, dropoff=None, drop=()):
    rows = [
        snapshot("pickup", 48, "15m", 8) | (short or {}),
        snapshot("pickup", 48, "60m", 23) | (long or {}),
        snapshot("dropoff", 132, "60m", 11) | (dropoff or {}),
    ]
    rows = [row for n, row in enumerate(rows) if n not in drop]
    names = [part.split()[0] for part in STORE.split(", ")]
    store = spark.createDataFrame([tuple(row[n] for n in names) for row in rows], STORE)
    request = spark.createDataFrame([("t", 48, 132, END + timedelta(seconds=age), 2.0, 1)], REQUEST)
    return online.feature_lookup(request, store).first()


@pytest.mark.parametrize("age, outcome", [(-0.001, "future"), (0, "fresh"), (600, "fresh"), (600.001, "stale")])
def test_age(spark, age, outcome):
    row = lookup(spark, age)
    assert row.outcome == outcome
    if outcome == "fresh":
        assert (row.pu_zone_trips_15m, row.pu_zone_mean_speed_15m, row.pu_zone_mean_duration_60m, row.do_zone_trips_60m) == (8, 9.5, 840, 11)
        assert row.age_seconds == age


@pytest.mark.parametrize(
    "changes, outcome",
    [
        ({"short": {"mean_speed_mph": None}}, "invalid"),
        ({"long": {"mean_distance_miles": float("nan")}}, "invalid"),
        ({"dropoff": {"mean_duration_seconds": -1.0}}, "invalid"),
        ({"dropoff": {"trip_count": -1}}, "invalid"),
        ({"long": {"window_start": END - timedelta(seconds=3500)}}, "invalid"),
        ({"short": {"window_kind": "60m"}}, "invalid"),
        ({"long": {"source_max_event_time": END + timedelta(seconds=1)}}, "invalid"),
        ({"dropoff": {"zone_id": 133}}, "invalid"),
        ({"long": {"zone_role": "dropoff", "schema_version": "7"}}, "invalid"),
        ({"short": {"trip_count": 24}}, "invalid"),
        ({"short": {"trip_count": 23}}, "fresh"),
        ({"drop": (0,)}, "missing"),
        ({"drop": (1, 2)}, "missing"),
        ({"long": {"window_end": END - timedelta(seconds=20), "window_start": END - timedelta(seconds=3620)}}, "inconsistent"),
        ({"short": NOTHING}, "empty"),
        ({"dropoff": NOTHING}, "fresh"),
    ],
)
def test_damage(spark, changes, outcome):
    row = lookup(spark, **changes)
    assert row.outcome == outcome
    if changes.get("dropoff") is NOTHING:
        assert row.do_zone_trips_60m == 0


def test_request_hours(spark):
    utc = [(2024, 4, 15, 16, 0), (2024, 4, 15, 2, 0), (2024, 3, 10, 6, 30), (2024, 3, 10, 7, 30), (2024, 11, 3, 5, 30), (2024, 11, 3, 6, 30)]
    rows = [(str(n), 1, 2, datetime(*t), 1.0, 1) for n, t in enumerate(utc)]
    got = online.request_features(spark.createDataFrame(rows, REQUEST)).orderBy("trip_id").collect()
    assert [row.pickup_hour_of_week for row in got] == [36, 22, 1, 3, 1, 1]


def test_scores_fall_back_and_reject(spark):
    rows = [("a", "fresh", 1, 10.0, 20.0), ("b", "stale", 1, 10.0, 20.0), ("c", "fresh", None, 10.0, 20.0), ("d", "stale", 1, float("nan"), 20.0), ("e", "fresh", 1, 10.0, 0.0)]
    frame = spark.createDataFrame(rows, "trip_id string, outcome string, passenger_count smallint, static_score double, rolling_score double")
    got = {r.trip_id: r for r in online.score_select(frame, static_version="s", rolling_version="r").collect()}
    assert (got["a"].estimated_duration_seconds, got["a"].feature_fallback, got["a"].model_version) == (20.0, False, "r")
    assert (got["b"].estimated_duration_seconds, got["b"].feature_fallback, got["b"].model_version) == (10.0, True, "s")
    assert [got[k].rejection for k in "cde"] == ["unknown_passenger_count", "invalid_estimate", "invalid_estimate"]
    primary = online.score_select(frame, static_version="s", rolling_version="r", static_primary=True, feature_model_version="gold-features-v2")
    assert {r.trip_id for r in primary.where("rejection IS NULL AND feature_fallback").collect()} == {"a", "b", "c", "e"}


SAMPLE = "outcome string, latency_ms double, feature_fallback boolean"


def gates(spark, latency, objective, successes=100, budget=0.01, overflow=0):
    rows = [("success", latency, True)] * successes + [("load_generator_overflow", None, None)] * overflow
    rows += [("timeout", None, None)] * (100 - successes - overflow)
    frame = spark.createDataFrame(rows, SAMPLE)
    summary = loadtest.load_summary(frame, 100, 1.0)
    p95 = percentiles(frame.where("outcome = 'success'"), "latency_ms", (95,))
    return loadtest.load_gates(summary, p95, budget, objective).first()


def test_load_gates(spark):
    assert not gates(spark, 50.0, 50).p95_latency
    assert gates(spark, 50.0, 51).passed
    assert gates(spark, 50.0, 51, successes=99).error_rate
    assert not gates(spark, 50.0, 51, successes=99, overflow=1).no_load_generator_overflow
    none = gates(spark, 50.0, 51, successes=0)
    assert not none.successful_predictions and not none.p95_latency and not none.passed


def test_delivery_needs_every_field(spark):
    samples = spark.createDataFrame(
        [("t1", "p1", "m", True, "d1", "success"), ("t2", "p2", "m", True, "d2", "success"), ("t3", None, None, None, None, "timeout"), ("t4", "p4", "m", True, "d4", "success")],
        "trip_id string, prediction_id string, model_version string, feature_fallback boolean, prediction_sha256 string, outcome string",
    )
    published = spark.createDataFrame(
        [("p1", "t1", "m", True, "d1", True, True), ("p1", "t1", "m", True, "d1", True, True), ("p2", "t2", "m", True, "other", True, True),
         ("p3", "t3", "m", True, "d3", True, True), ("p9", "t9", "m", True, "d9", True, True),
         (None, None, None, None, "bad", False, False), (None, None, None, None, "bad", False, False), ("p5", "t1", "m", True, "d5", True, False)],
        "prediction_id string, trip_id string, model_version string, feature_fallback boolean, payload_sha256 string, envelope_ok boolean, is_valid boolean",
    )
    verdicts = delivery.delivery_reconcile(published, samples)
    got = {(r.prediction_id, r.verdict): r for r in verdicts.collect()}
    assert set(got) == {("p1", "matched"), ("p2", "mismatched"), ("p2", "missing"), ("p3", "ambiguous"), ("p9", "unrelated"), ("p4", "missing"), (None, "unreadable"), ("p5", "unreadable")}
    assert got[("p1", "matched")].records == 2 and got[("p1", "matched")].duplicate
    assert got[(None, "unreadable")].records == 2 and not got[(None, "unreadable")].duplicate
    total = delivery.delivery_summary(verdicts).first()
    assert (total.matched, total.mismatched, total.ambiguous, total.unrelated, total.unreadable, total.missing, total.duplicated) == (1, 1, 1, 1, 2, 2, 1)


def test_messages_keep_their_own_contract_to_the_end(spark):
    """From lookup over score and message to the topic and back, every message is valid and delivered."""
    rows = [snapshot("pickup", 48, "15m", 8), snapshot("pickup", 48, "60m", 23), snapshot("dropoff", 132, "60m", 11)]
    names = [part.split()[0] for part in STORE.split(", ")]
    store = spark.createDataFrame([tuple(row[n] for n in names) for row in rows], STORE)
    requests = spark.createDataFrame(
        [("t1", 48, 132, END + timedelta(seconds=5), 2.0, 1), ("t2", 48, 132, END + timedelta(seconds=5), 2.0, None), ("t3", 48, 131, END, 2.0, 0)], REQUEST
    )
    looked = online.feature_lookup(requests, store).selectExpr("*", "500D AS static_score", "600D AS rolling_score")
    chosen = online.score_select(looked, static_version="s", rolling_version="r", feature_model_version="gold-features-v2")
    hours = online.request_features(requests).select("trip_id", "pickup_hour_of_week")
    made = online.prediction_messages(chosen.join(hours, "trip_id"), "pickup_time")
    fields = made.columns
    records = delivery.kafka_envelope(made, fields).selectExpr("*", "0 AS partition", "monotonically_increasing_id() AS offset")
    published = kafka.published_predictions(records)
    assert published.where("is_valid AND envelope_ok").count() == published.count() == 3
    samples = made.selectExpr(
        "trip_id", "prediction_id", "model_version", "feature_fallback", "'success' AS outcome",
        f"{digests.payload_digest(digests.canonical_json(fields))} AS prediction_sha256",
    )
    assert [r.verdict for r in delivery.delivery_reconcile(published, samples).collect()] == ["matched"] * 3


def test_repeated_completions_do_not_multiply_predictions(spark):
    predictions = spark.createDataFrame([("p", "t", END, 300.0)], "prediction_id string, trip_id string, served_at timestamp_ntz, estimated_duration_seconds double")
    done = [("t", END + timedelta(seconds=s), 400) for s in (400, 400, 460)]
    completed = spark.createDataFrame(done, "trip_id string, event_time timestamp_ntz, actual_duration_seconds int")
    truths = delivery.ground_truth(predictions, completed, 3600)
    assert [r.absolute_error_seconds for r in truths.collect()] == [100.0]
    assert delivery.live_error(truths, 86_400).first().predictions == 1


def failures(spark, name, **message):
    frame = spark.createDataFrame([(json.dumps(message),)], "payload string")
    return contracts.validate_contract(frame, name).first().failed_rules


def test_quality_contract(spark):
    row = {"partition": "2024-01", "rule": "r", "violations": 1, "total_rows": 10, "threshold": 0.2, "passed": True}
    assert failures(spark, "quality-check-result-v1", **row) == []
    assert failures(spark, "quality-check-result-v1", **{**row, "violations": 3, "passed": False}) == []
    assert failures(spark, "quality-check-result-v1", **{**row, "passed": False}) == ["passed_agrees"]
    assert failures(spark, "quality-check-result-v1", **{**row, "violations": 11}) == ["violations_within_total", "passed_agrees"]


def test_request_contract(spark):
    row = {
        "trip_id": "t", "pickup_zone_id": 1, "dropoff_zone_id": 265, "pickup_time": "2024-04-15T12:00:00-04:00",
        "trip_distance_miles": 0, "passenger_count": 0,
    }
    assert failures(spark, "eta-request-v1", **row) == []
    assert failures(spark, "eta-request-v1", **{**row, "passenger_count": None}) == ["unknown_passengers_need_1_1"]
    assert failures(spark, "eta-request-v1.1", **{**row, "passenger_count": None, "schema_version": "1.1"}) == []
    assert failures(spark, "eta-request-v1", **{**row, "pickup_time": "2024-04-15T12:00:00"}) == ["pickup_time_aware"]
    assert failures(spark, "eta-request-v1", **{**row, "extra": 1}) == ["unknown_keys"]
    without = dict(row)
    del without["passenger_count"]
    assert failures(spark, "eta-request-v1", **without) == ["missing:passenger_count"]
    assert failures(spark, "eta-request-v1", **{**row, "pickup_zone_id": 266}) == ["pickup_zone_id_range"]
    broken = spark.createDataFrame([("{",)], "payload string")
    assert contracts.validate_contract(broken, "eta-request-v1").first().failed_rules == ["not_json"]


def test_every_subject_has_a_contract():
    assert len(contracts.SUBJECTS) == 15
    assert set(contracts.SUBJECTS.values()) == set(contracts.CONTRACTS)


def test_runs_end_once_and_only_after_they_start(spark):
    rows = [("ok", 1, "running"), ("ok", 2, "accepted"), ("open", 1, "running"), ("twice", 1, "running"), ("twice", 2, "failed"), ("twice", 3, "accepted"), ("early", 1, "accepted")]
    state = {r.run_id: r for r in lineage.lineage_state(spark.createDataFrame(rows, "run_id string, seq int, status string")).collect()}
    assert {k: (r.status, r.illegal_transition) for k, r in state.items()} == {
        "ok": ("accepted", False), "open": ("running", False), "twice": ("failed", True), "early": ("accepted", True),
    }
