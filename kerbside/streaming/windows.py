"""Sliding zone windows over completed trips, for streams and for tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError
from kerbside.functions import numbers
from kerbside.operators.pointintime import trailing_features
from kerbside.operators.ranking import percentiles

# --- fixed values ---
LATENESS_SECONDS = 300
WINDOW_SECONDS = {"15m": schemas.SHORT_WINDOW_SECONDS, "60m": schemas.LONG_WINDOW_SECONDS}
# --- end of fixed values ---
SLIDE_SECONDS = 60


def zone_completions(trips: DataFrame) -> DataFrame:
    """Each completed trip once for its pickup zone and once for its dropoff zone."""
    speed = numbers.speed_mph("trip_distance_miles", "actual_duration_seconds")
    return trips.selectExpr(
        "inline(array(struct('pickup' AS zone_role, pickup_zone_id AS zone_id),"
        " struct('dropoff' AS zone_role, dropoff_zone_id AS zone_id)))",
        "dropoff_datetime AS event_time",
        "CAST(actual_duration_seconds AS BIGINT) AS duration",
        f"{speed} AS speed",
        "trip_distance_miles AS distance",
    )


def zone_windows(
    completions: DataFrame,
    *,
    slide_seconds: int = SLIDE_SECONDS,
    lateness_seconds: int = LATENESS_SECONDS,
) -> DataFrame:
    """Count and means per end-exclusive sliding window of both lengths, role and zone.

    Events are first reduced to panes as long as the slide, so an event is
    touched once however many windows it falls into. Long windows then add
    panes, and the short window with the same end adds those of its part. On a
    stream both steps close by the same watermark (append mode).
    """
    if schemas.SHORT_WINDOW_SECONDS % slide_seconds:
        raise DataContractError("the slide must divide the short window")
    slide = f"{slide_seconds} seconds"
    panes = (
        # Watermarks need an absolute time; with a UTC session wall clocks keep their digits.
        completions.withColumn("event_time", F.col("event_time").cast("timestamp"))
        .withWatermark("event_time", f"{lateness_seconds} seconds")
        .groupBy(F.window("event_time", slide).alias("pane"), "zone_role", "zone_id")
        .agg(
            F.expr("count(1) AS n"),
            F.expr("sum(duration) AS duration"),
            F.expr("sum(speed) AS speed"),
            F.expr("sum(distance) AS distance"),
            F.expr("max(event_time) AS newest"),
        )
    )
    placed = panes.withColumn(
        "span", F.window(F.window_time("pane"), f"{schemas.LONG_WINDOW_SECONDS} seconds", slide)
    )
    totals = []
    for kind, seconds in WINDOW_SECONDS.items():
        inside = f"pane.start >= span.end - INTERVAL {seconds} SECONDS"
        for name in ("n", "duration", "speed", "distance"):
            totals.append(F.expr(f"sum(CASE WHEN {inside} THEN {name} END) AS {name}_{kind}"))
        totals.append(F.expr(f"max(CASE WHEN {inside} THEN newest END) AS newest_{kind}"))
    rows = ", ".join(
        f"'{kind}', span.end - INTERVAL {seconds} SECONDS, n_{kind}, duration_{kind}, speed_{kind},"
        f" distance_{kind}, newest_{kind}"
        for kind, seconds in WINDOW_SECONDS.items()
    )
    return (
        placed.groupBy("span", "zone_role", "zone_id")
        .agg(*totals)
        .selectExpr(
            "zone_role",
            "zone_id",
            "span.end AS window_end",
            f"stack({len(WINDOW_SECONDS)}, {rows}) AS (window_kind, window_start, trip_count,"
            " duration, speed, distance, newest)",
        )
        .where("trip_count > 0")
        .selectExpr(
            "zone_role",
            "zone_id",
            "window_kind",
            "CAST(window_start AS TIMESTAMP_NTZ) AS window_start",
            "CAST(window_end AS TIMESTAMP_NTZ) AS window_end",
            "trip_count",
            "duration / trip_count AS mean_duration_seconds",
            "speed / trip_count AS mean_speed_mph",
            "distance / trip_count AS mean_distance_miles",
            "CAST(newest AS TIMESTAMP_NTZ) AS source_max_event_time",
        )
    )


def snapshots_at(trips: DataFrame, end: str, feature_model_version: str) -> DataFrame:
    """The snapshot per role, zone and window that ends at ``end``; zones without trips get zeros."""
    rows = zone_completions(trips)
    parts = []
    for kind, seconds in WINDOW_SECONDS.items():
        inside = (
            f"event_time >= {end} - make_dt_interval(0, 0, 0, {seconds}) AND event_time < {end}"
        )
        parts.append(F.expr(f"count_if({inside}) AS n_{kind}"))
        for name in ("duration", "speed", "distance"):
            parts.append(
                F.expr(f"coalesce(avg(CASE WHEN {inside} THEN {name} END), 0D) AS {name}_{kind}")
            )
        parts.append(F.expr(f"max(CASE WHEN {inside} THEN event_time END) AS newest_{kind}"))
    stacked = ", ".join(
        f"'{kind}', {end} - make_dt_interval(0, 0, 0, {seconds}), n_{kind}, duration_{kind},"
        f" speed_{kind}, distance_{kind}, newest_{kind}"
        for kind, seconds in WINDOW_SECONDS.items()
    )
    return (
        rows.groupBy("zone_role", "zone_id")
        .agg(*parts)
        .selectExpr(
            "zone_role",
            "zone_id",
            f"stack({len(WINDOW_SECONDS)}, {stacked}) AS (window_kind, window_start, trip_count,"
            " mean_duration_seconds, mean_speed_mph, mean_distance_miles, source_max_event_time)",
        )
        .selectExpr(
            "*",
            f"{end} AS window_end",
            f"{end} + make_dt_interval(0, 0, 0, 1) AS computed_at",
            f"'{feature_model_version}' AS feature_model_version",
            "'1.0' AS schema_version",
        )
    )


def late_events(arrivals: DataFrame, lateness_seconds: int = LATENESS_SECONDS) -> DataFrame:
    """Events whose time had already passed the watermark when their batch arrived.

    ``arrivals`` has ``batch`` and ``event_time``. The watermark of a batch is
    the newest event time of all earlier batches minus the allowed lateness:
    one row per batch, so it may be broadcast.
    """
    newest = arrivals.groupBy("batch").agg(F.expr("max(event_time) AS _newest"))
    marks = newest.selectExpr(
        "batch",
        "max(_newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        f" - make_dt_interval(0, 0, 0, {lateness_seconds}) AS watermark",
    )
    return arrivals.join(F.broadcast(marks), "batch").selectExpr(
        *arrivals.columns, "watermark", "coalesce(event_time < watermark, false) AS is_late"
    )


def freshness(snapshots: DataFrame, written_at: str = "written_at") -> DataFrame:
    """p95 seconds from the newest event of a snapshot to its write."""
    return percentiles(
        snapshots.where("source_max_event_time IS NOT NULL").selectExpr(
            f"(unix_micros(CAST({written_at} AS TIMESTAMP))"
            " - unix_micros(CAST(source_max_event_time AS TIMESTAMP))) / 1e6D AS seconds"
        ),
        "seconds",
        (95,),
    )


def feature_parity(
    snapshots: DataFrame, trips: DataFrame, tolerance: float = 1e-6
) -> DataFrame:
    """Stream windows against batch features at the same cutoffs, per role and window.

    The batch side looks back from each window end with the point-in-time
    operator, so both sides see ``[end - W, end)``.
    """
    facts = zone_completions(trips).selectExpr(
        "struct(zone_role, zone_id) AS zone", "event_time AS window_end", "duration", "speed", "distance"
    )
    # One ledger answers all windows; each snapshot takes those of its own kind.
    looked = trailing_features(
        snapshots.selectExpr("struct(zone_role, zone_id) AS zone", "*"),
        facts,
        key="zone",
        at="window_end",
        windows=WINDOW_SECONDS,
        means=["duration", "speed", "distance"],
    )

    def own(name: str) -> str:
        cases = " ".join(f"WHEN '{kind}' THEN {name}_{kind}" for kind in WINDOW_SECONDS)
        return f"CASE window_kind {cases} END"

    compared = looked.where(F.col("window_kind").isin(*WINDOW_SECONDS)).selectExpr(
        "zone_role",
        "window_kind",
        f"trip_count <=> CAST({own('count')} AS BIGINT) AS same_count",
        f"greatest(abs(mean_duration_seconds - {own('mean_duration')}), abs(mean_speed_mph - {own('mean_speed')}),"
        f" abs(mean_distance_miles - {own('mean_distance')})) AS difference",
    )
    bad = f"NOT same_count OR difference IS NULL OR difference > {tolerance!r}D"
    return compared.groupBy("zone_role", "window_kind").agg(
        F.expr("count(1) AS compared"),
        F.expr(f"count_if({bad}) AS mismatched"),
        F.expr(f"count_if({bad}) / count(1) AS mismatch_rate"),
        F.expr("max(difference) AS max_abs_difference"),
    )
