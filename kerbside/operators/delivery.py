"""Reconciling published predictions with what clients recorded."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import digests

# --- fixed values ---
UNSURE_OUTCOMES = ("http_error", "timeout", "transport_error")
# --- end of fixed values ---


def kafka_envelope(predictions: DataFrame, payload: list[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows for the Kafka sink: key, JSON value and headers, next to the columns in ``keep``."""
    return predictions.selectExpr(
        *keep,
        "CAST(trip_id AS BINARY) AS key",
        f"CAST({digests.canonical_json(payload)} AS BINARY) AS value",
        "array("
        "named_struct('key', 'content-type', 'value', CAST('application/json' AS BINARY)),"
        "named_struct('key', 'schema-version', 'value', CAST(schema_version AS BINARY)),"
        "named_struct('key', 'prediction-id', 'value', CAST(prediction_id AS BINARY))"
        ") AS headers",
    )


def delivery_reconcile(published: DataFrame, samples: DataFrame) -> DataFrame:
    """Verdict per published prediction identity, and missing successes.

    ``published`` has prediction_id, trip_id, model_version, feature_fallback,
    payload_sha256, envelope_ok and is_valid; ``samples`` one row per trip. Equal
    records are counted before the join, so copies of one message do not pile up
    on a join key. A verdict is per distinct record; ``records`` says how often it
    was read and ``duplicate`` whether records of its identity that belong to a
    sample were read more than once. A record that breaks its contract, or has no
    identity, is ``unreadable``; no record is left out.
    """
    unsure = ", ".join(f"'{name}'" for name in UNSURE_OUTCOMES)
    fields = ["prediction_id", "trip_id", "model_version", "feature_fallback", "payload_sha256", "envelope_ok"]
    distinct = published.groupBy(*fields, "is_valid").agg(F.expr("count(1) AS records"))
    taken = samples.selectExpr(
        "trip_id",
        "prediction_id AS _id",
        "model_version AS _model",
        "feature_fallback AS _fallback",
        "prediction_sha256 AS _digest",
        "outcome AS _outcome",
    )
    # A success counts as received when any of its records matches.
    judged = distinct.join(taken, "trip_id", "left").selectExpr(
        "prediction_id",
        "trip_id",
        "records",
        # Records without an identity are told apart by their payload, so they are no hot group.
        "coalesce(sum(CASE WHEN _outcome IS NOT NULL AND prediction_id IS NOT NULL THEN records END)"
        " OVER (PARTITION BY coalesce(prediction_id, concat('payload:', payload_sha256))) > 1, false) AS duplicate",
        "CASE WHEN prediction_id IS NULL OR NOT coalesce(is_valid, false) THEN 'unreadable'"
        " WHEN _outcome IS NULL THEN 'unrelated'"
        " WHEN NOT envelope_ok THEN 'mismatched'"
        " WHEN _outcome = 'success' AND _id = prediction_id AND _model = model_version"
        " AND _fallback = feature_fallback AND _digest = payload_sha256 THEN 'matched'"
        f" WHEN _outcome IN ({unsure}) THEN 'ambiguous'"
        " ELSE 'mismatched' END AS verdict",
    )
    received = judged.where("verdict = 'matched'").selectExpr("prediction_id AS _id")
    missing = (
        taken.where("_outcome = 'success'")
        .join(received, "_id", "left_anti")
        .selectExpr(
            "_id AS prediction_id", "trip_id", "0L AS records", "false AS duplicate", "'missing' AS verdict"
        )
    )
    return judged.unionByName(missing)


def delivery_summary(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg(
        F.expr("count_if(verdict = 'matched') AS matched"),
        F.expr("count_if(verdict = 'mismatched') AS mismatched"),
        F.expr("count_if(verdict = 'ambiguous') AS ambiguous"),
        F.expr("count_if(verdict = 'unrelated') AS unrelated"),
        F.expr("count_if(verdict = 'unreadable') AS unreadable"),
        F.expr("count_if(verdict = 'missing') AS missing"),
        F.expr("count_if(duplicate AND verdict <> 'unrelated') AS duplicated"),
    )


def missing_ids(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected keys nobody found."""
    return expected.select(key).distinct().join(found.select(key), key, "left_anti")


def ground_truth(
    predictions: DataFrame, completed: DataFrame, wait_seconds: int
) -> DataFrame:
    """Predictions with the completion of their trip within a bounded wait, or marked unjoined.

    ``predictions`` has prediction_id, trip_id, served_at and
    estimated_duration_seconds; ``completed`` has trip_id, event_time and
    actual_duration_seconds. The first completion of a trip counts, so repeated
    events do not multiply predictions.
    """
    facts = (
        completed.groupBy("trip_id")
        .agg(F.expr("min(struct(event_time, actual_duration_seconds)) AS _first"))
        .selectExpr("trip_id", "_first.event_time AS joined_at", "_first.actual_duration_seconds")
    )
    joined = predictions.alias("p").join(
        facts.alias("c"),
        F.expr(
            "p.trip_id = c.trip_id AND c.joined_at >= p.served_at"
            f" AND c.joined_at <= p.served_at + make_dt_interval(0, 0, 0, {wait_seconds})"
        ),
        "left",
    )
    return joined.selectExpr(
        "p.prediction_id",
        "p.trip_id",
        "p.served_at",
        "p.estimated_duration_seconds",
        "c.actual_duration_seconds",
        "abs(p.estimated_duration_seconds - c.actual_duration_seconds) AS absolute_error_seconds",
        "c.joined_at",
        "(unix_micros(CAST(c.joined_at AS TIMESTAMP)) - unix_micros(CAST(p.served_at AS TIMESTAMP)))"
        " / 1e6D AS join_latency_seconds",
        "c.trip_id IS NOT NULL AS joined",
    )


def live_error(truths: DataFrame, seconds: int) -> DataFrame:
    """MAE, coverage and mean join latency per window of serving time."""
    return (
        truths.groupBy(F.expr(f"window(served_at, '{seconds} seconds') AS _window"))
        .agg(
            F.expr("count(1) AS predictions"),
            F.expr("count_if(joined) AS joined_predictions"),
            F.expr("count_if(joined) / count(1) AS coverage"),
            F.expr("avg(absolute_error_seconds) AS mae_seconds"),
            F.expr("avg(join_latency_seconds) AS mean_join_latency_seconds"),
        )
        .selectExpr(
            "_window.start AS window_start",
            "predictions",
            "joined_predictions",
            "coverage",
            "mae_seconds",
            "mean_join_latency_seconds",
        )
    )
