"""Queries that validate JSON messages built from the given tables, with planted defects."""

from __future__ import annotations

from kerbside.catalog.inputs import frame
from kerbside.operators.contracts import validate_contract

ISO = "date_format({0}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || 'Z'"
UUID = (
    "regexp_replace(md5(CAST(event_id AS STRING)),"
    " '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')"
)
LATER = "ts + make_dt_interval(0, 0, 0, {0})"


# How the values of nested fields end in the text; plain values end at a comma or brace.
NESTED = {"candidate_metrics": ".*?}", "feature_statistics": ".*?}}"}


def _messages(spark, folder, columns: dict[str, str], required: str, typed: str):
    """JSON per event; some are broken, have a key too many, a renamed one, or a wrong type."""
    value_text = NESTED.get(typed, "[^,}]*")
    fields = ", ".join(f"{value} AS `{name}`" for name, value in columns.items())
    rows = frame(spark, folder, "events").selectExpr(
        "event_id", f"to_json(struct({fields}), map('ignoreNullFields', 'false')) AS json"
    )
    return rows.selectExpr(
        "event_id",
        "CASE WHEN event_id % 97 = 0 THEN 'not json'"
        " WHEN event_id % 89 = 0 THEN concat('{\"extra\":1,', substring(json, 2))"
        f" WHEN event_id % 83 = 0 THEN replace(json, '\"{required}\":', '\"renamed\":')"
        f" WHEN event_id % 79 = 0 THEN regexp_replace(json, '\"{typed}\":{value_text}', '\"{typed}\":\"abc\"')"
        " ELSE json END AS payload",
    )


def _expected(required: str, typed: str, rules: list[tuple[str, str]]) -> str:
    """The oracle: shape defects by event number, else the value rules in order."""
    cases = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in rules)
    return f"""WITH judged AS (SELECT event_id, CASE WHEN event_id % 97 = 0 THEN 'not_json' WHEN event_id % 89 = 0 THEN 'unknown_keys'
  WHEN event_id % 83 = 0 THEN 'unknown_keys,missing:{required}' WHEN event_id % 79 = 0 THEN 'type:{typed}'
  ELSE concat_ws(',', {cases}) END AS failed_rules FROM events) SELECT event_id, failed_rules, failed_rules = '' AS is_valid FROM judged"""


# name -> (contract, JSON fields, required key, numeric key, rules a planted defect breaks)
_TRIP = {
    "schema_version": "CASE WHEN event_id % 43 = 0 THEN '2.0' WHEN event_id % 4 = 0 THEN '1.0' ELSE '1.1' END",
    "trip_id": "CASE WHEN event_id % 47 = 0 THEN repeat('x', 129) ELSE 'e:' || event_id END",
    "pickup_zone_id": "CASE WHEN event_id % 67 = 0 THEN 0 ELSE user_id % 20 + 1 END",
    "dropoff_zone_id": "CASE WHEN event_id % 71 = 0 THEN 266 ELSE user_id % 20 + 1 END",
    "trip_distance_miles": "CASE WHEN event_id % 59 = 0 THEN -1D ELSE value / 10 END",
    "passenger_count": "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 53 = 0 THEN 10 ELSE event_id % 10 END",
}
_TRIP_RULES = [
    ("schema_version_known", "event_id % 43 = 0"),
    ("trip_id_length", "event_id % 47 = 0"),
    ("pickup_zone_id_range", "event_id % 67 = 0"),
    ("dropoff_zone_id_range", "event_id % 71 = 0"),
    ("trip_distance_miles_not_negative", "event_id % 59 = 0"),
    ("passenger_count_range", "event_id % 11 <> 0 AND event_id % 53 = 0"),
    ("unknown_passengers_need_1_1", "event_id % 11 = 0 AND event_id % 43 <> 0 AND event_id % 4 = 0"),
]
_ID = f"CASE WHEN event_id % 37 = 0 THEN 'no-uuid' ELSE {UUID} END"
_WINDOW_SECONDS = "CASE WHEN event_id % 2 = 0 THEN 900 ELSE 3600 END"
_EMPTY = "event_id % 5 = 0"

CASES = {
    "contract_request": (
        "eta-request-v1.1",
        {**_TRIP, "pickup_time": f"CASE WHEN event_id % 61 = 0 THEN CAST(ts AS STRING) ELSE {ISO.format('ts')} END"},
        "trip_id",
        "pickup_zone_id",
        [("pickup_time_aware", "event_id % 61 = 0"), *_TRIP_RULES],
    ),
    "contract_started": (
        "trip-started-v1.1",
        {"event_id": _ID, "event_time": ISO.format("ts"), **_TRIP},
        "event_time",
        "passenger_count",
        [("event_id_uuid", "event_id % 37 = 0"), *_TRIP_RULES],
    ),
    "contract_completed": (
        "trip-completed-v1",
        {
            "event_id": _ID,
            "event_time": ISO.format("ts"),
            "trip_id": "'e:' || event_id",
            "actual_duration_seconds": "CASE WHEN event_id % 31 = 0 THEN 0 WHEN event_id % 29 = 0 THEN 10801 ELSE 60 + event_id % 10741 END",
            "fare_amount": "CASE WHEN event_id % 41 = 0 THEN -0.01D ELSE value END",
        },
        "trip_id",
        "fare_amount",
        [
            ("event_id_uuid", "event_id % 37 = 0"),
            ("duration_range", "event_id % 31 = 0 OR event_id % 29 = 0"),
            ("fare_amount_not_negative", "event_id % 41 = 0"),
        ],
    ),
    "contract_prediction": (
        "prediction-v1",
        {
            "prediction_id": UUID,
            "trip_id": "'e:' || event_id",
            "model_version": "CASE WHEN event_id % 23 = 0 THEN '' ELSE 'm1' END",
            "features_used": "map('trip_distance_miles', value, 'passenger_count', CASE WHEN event_id % 11 = 0 THEN NULL ELSE 1D END)",
            "feature_timestamps": f"map('pu_zone_trips_15m', CASE WHEN event_id % 19 = 0 THEN CAST(ts AS STRING) ELSE {ISO.format('ts')} END)",
            "feature_fallback": "event_id % 3 = 0",
            "estimated_duration_seconds": "CASE WHEN event_id % 17 = 0 THEN 0D ELSE value + 60 END",
            "served_at": ISO.format("ts"),
            "schema_version": "CASE WHEN event_id % 4 = 0 THEN '1.0' ELSE '1.1' END",
        },
        "served_at",
        "estimated_duration_seconds",
        [
            ("model_version_length", "event_id % 23 = 0"),
            ("estimate_positive", "event_id % 17 = 0"),
            ("null_features_need_1_1", "event_id % 11 = 0 AND event_id % 4 = 0"),
            ("feature_timestamps_aware", "event_id % 19 = 0"),
        ],
    ),
    "contract_ground_truth": (
        "ground-truth-v1",
        {
            "prediction_id": UUID,
            "actual_duration_seconds": "CASE WHEN event_id % 31 = 0 THEN 0 ELSE 60 + event_id % 10741 END",
            "absolute_error_seconds": "CASE WHEN event_id % 29 = 0 THEN -1D ELSE value END",
            "joined_at": ISO.format("ts"),
            "join_latency_seconds": "CASE WHEN event_id % 23 = 0 THEN -0.5D ELSE value END",
        },
        "joined_at",
        "join_latency_seconds",
        [
            ("duration_positive", "event_id % 31 = 0"),
            ("absolute_error_seconds_not_negative", "event_id % 29 = 0"),
            ("join_latency_seconds_not_negative", "event_id % 23 = 0"),
        ],
    ),
    "contract_window": (
        "online-zone-window-features-v2",
        {
            "zone_id": "user_id % 20 + 1",
            "window_kind": "CASE WHEN event_id % 2 = 0 THEN '15m' ELSE '60m' END",
            "window_start": ISO.format("ts"),
            "window_end": ISO.format(LATER.format(f"{_WINDOW_SECONDS} + CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END")),
            "trip_count": f"CASE WHEN {_EMPTY} THEN 0 ELSE event_id % 50 + 1 END",
            "mean_duration_seconds": f"CASE WHEN {_EMPTY} AND event_id % 29 <> 0 THEN 0D ELSE 600D END",
            "mean_speed_mph": f"CASE WHEN {_EMPTY} THEN 0D WHEN event_id % 23 = 0 THEN -1D ELSE 12D END",
            "mean_distance_miles": f"CASE WHEN {_EMPTY} THEN 0D ELSE 2D END",
            "computed_at": ISO.format(LATER.format("CASE WHEN event_id % 19 = 0 THEN 10 ELSE 3700 END")),
            "schema_version": "'1.0'",
            "zone_role": "CASE WHEN event_id % 17 = 0 THEN 'both' ELSE 'pickup' END",
            "feature_model_version": "'gold-features-v2'",
            "source_max_event_time": f"CASE WHEN {_EMPTY} THEN NULL WHEN event_id % 13 = 0 THEN {ISO.format(LATER.format('4000'))} ELSE {ISO.format(LATER.format('30'))} END",
        },
        "zone_id",
        "trip_count",
        [
            ("mean_speed_mph_not_negative", f"NOT ({_EMPTY}) AND event_id % 23 = 0"),
            ("computed_after_end", "event_id % 19 = 0"),
            ("zone_role_known", "event_id % 17 = 0"),
            ("window_length", "event_id % 31 = 0"),
            ("empty_window_is_blank", f"{_EMPTY} AND event_id % 29 = 0"),
            ("source_inside_window", f"NOT ({_EMPTY}) AND event_id % 13 = 0"),
        ],
    ),
    "contract_quality": (
        "quality-check-result-v1.1",
        {
            "partition": "'2024-01'",
            "rule": "CASE WHEN event_id % 31 = 0 THEN '' ELSE 'duration_range' END",
            "violations": "event_id % 13",
            "total_rows": "CASE WHEN event_id % 13 = 0 THEN 0 ELSE 10 END",
            "threshold": "CASE WHEN event_id % 29 = 0 THEN 1.5D ELSE 0.2D END",
            "passed": "event_id % 13 <= 2",
            "contract_version": "'1.1'",
        },
        "rule",
        "violations",
        [
            ("rule_named", "event_id % 31 = 0"),
            ("threshold_range", "event_id % 29 = 0"),
            ("violations_within_total", "event_id % 13 > 10"),
            ("passed_agrees", "event_id % 29 = 0 AND event_id % 13 > 2"),
        ],
    ),
    "contract_promotion": (
        "promotion-decision-v1",
        {
            "candidate_version": "'c' || event_id",
            "candidate_metrics": "struct(CASE WHEN event_id % 31 = 0 THEN -1D ELSE 80D END AS mae_seconds, 90D AS rmse_seconds, 10D AS mape_pct, 1D AS inference_p95_ms)",
            "baseline_metrics": "struct(100D AS mae_seconds, 120D AS rmse_seconds, 20D AS mape_pct, 1D AS inference_p95_ms)",
            "gate_results": "CASE WHEN event_id % 23 = 0 THEN from_json('[]', 'array<struct<rule:string,observed:double,threshold:double,passed:boolean>>')"
            " ELSE array(struct('mae' AS rule, 20D AS observed, 15D AS threshold, true AS passed),"
            " struct('p95' AS rule, 1D AS observed, 5D AS threshold, event_id % 3 <> 0 AS passed)) END",
            "outcome": "CASE WHEN event_id % 29 = 0 THEN 'maybe' WHEN event_id % 2 = 0 THEN 'promote' ELSE 'reject' END",
            "decided_at": ISO.format("ts"),
        },
        "decided_at",
        "candidate_metrics",
        [
            ("outcome_known", "event_id % 29 = 0"),
            ("metrics_not_negative", "event_id % 31 = 0"),
            (
                "outcome_agrees",
                "(event_id % 29 <> 0 AND event_id % 2 = 0) <> (event_id % 23 <> 0 AND event_id % 3 <> 0)",
            ),
        ],
    ),
    "contract_drift": (
        "drift-report-v1",
        {
            "window_start": ISO.format("ts"),
            "window_end": ISO.format(LATER.format("CASE WHEN event_id % 31 = 0 THEN 0 ELSE 3600 END")),
            "feature_statistics": "map('trip_distance_miles', struct(value / 1000 AS statistic, 0.2D AS threshold, value > 200 AS drifted))",
            "action": "CASE WHEN event_id % 29 = 0 THEN 'panic' WHEN value > 200 THEN 'alert' ELSE 'none' END",
            "created_at": f"CASE WHEN event_id % 23 = 0 THEN CAST(ts AS STRING) ELSE {ISO.format('ts')} END",
        },
        "action",
        "feature_statistics",
        [
            ("created_at_aware", "event_id % 23 = 0"),
            ("action_known", "event_id % 29 = 0"),
            ("window_ordered", "event_id % 31 = 0"),
        ],
    ),
}


def request_messages(spark, folder):
    _, fields, required, typed, _ = CASES["contract_request"]
    return _messages(spark, folder, fields, required, typed)


def _query(case):
    contract, fields, required, typed, _ = case

    def run(spark, folder):
        # Messages may have a field event_id of their own.
        rows = _messages(spark, folder, fields, required, typed).withColumnRenamed("event_id", "_key")
        return validate_contract(rows, contract).selectExpr(
            "_key AS event_id", "array_join(failed_rules, ',') AS failed_rules", "is_valid"
        )

    return run


QUERIES = {name: _query(case) for name, case in CASES.items()}
ORACLES = {name: _expected(case[2], case[3], case[4]) for name, case in CASES.items()}
