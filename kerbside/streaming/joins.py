"""Stream joins and duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.operators.delivery import live_error


def _truths(predictions: DataFrame, completed: DataFrame, wait_seconds: int, lateness_seconds: int) -> DataFrame:
    """Predictions with the first completion within the wait; ``served_at`` keeps its watermark for operators that follow."""
    left = (
        predictions.withColumn("served_at", F.col("served_at").cast("timestamp"))
        .withWatermark("served_at", f"{lateness_seconds} seconds")
        .alias("p")
    )
    right = (
        completed.selectExpr(
            "trip_id", "CAST(event_time AS TIMESTAMP) AS joined_at", "actual_duration_seconds"
        )
        .withWatermark("joined_at", f"{lateness_seconds} seconds")
        .dropDuplicatesWithinWatermark(["trip_id"])
        .alias("c")
    )
    joined = left.join(
        right,
        F.expr(
            "p.trip_id = c.trip_id AND c.joined_at >= p.served_at"
            f" AND c.joined_at <= p.served_at + INTERVAL {wait_seconds} SECONDS"
        ),
        "leftOuter",
    )
    return joined.selectExpr(
        "p.prediction_id",
        "p.trip_id",
        "p.served_at",
        "p.estimated_duration_seconds",
        "c.actual_duration_seconds",
        "abs(p.estimated_duration_seconds - c.actual_duration_seconds) AS absolute_error_seconds",
        "c.joined_at",
        "(unix_micros(c.joined_at) - unix_micros(p.served_at)) / 1e6D AS join_latency_seconds",
        "c.trip_id IS NOT NULL AS joined",
    )


def stream_ground_truth(
    predictions: DataFrame,
    completed: DataFrame,
    wait_seconds: int,
    lateness_seconds: int = 300,
) -> DataFrame:
    """Predictions joined with the first completion of their trip, or alone once the wait is over.

    Completions that repeat a trip within the allowed lateness are dropped first. Both watermarks and the time bound let the state of old predictions go.
    """
    return _truths(predictions, completed, wait_seconds, lateness_seconds).selectExpr(
        "prediction_id",
        "trip_id",
        "CAST(served_at AS TIMESTAMP_NTZ) AS served_at",
        "estimated_duration_seconds",
        "actual_duration_seconds",
        "absolute_error_seconds",
        "CAST(joined_at AS TIMESTAMP_NTZ) AS joined_at",
        "joined",
    )


def stream_live_error(
    predictions: DataFrame,
    completed: DataFrame,
    wait_seconds: int,
    seconds: int,
    lateness_seconds: int = 300,
) -> DataFrame:
    """MAE, coverage and mean join latency per window of serving time, once the truth of the whole window is known.

    The outer join holds a prediction until the wait is over, and its watermark
    lags by that wait, so a window closes only after its last prediction has
    left the join, joined or alone. ``delivery.live_error`` is the batch twin.
    """
    truths = _truths(predictions, completed, wait_seconds, lateness_seconds)
    return live_error(truths, seconds).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


def without_duplicates(events: DataFrame, identity: str, at: str, lateness_seconds: int = 300) -> DataFrame:
    """The first of each identity within the allowed lateness."""
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    kept = timed.withWatermark(at, f"{lateness_seconds} seconds").dropDuplicatesWithinWatermark([identity])
    return kept.withColumn(at, F.col(at).cast("timestamp_ntz"))
