"""Trips as the two events a live feed would carry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.operators.contracts import validate_contract


def replay_events(trips: DataFrame) -> DataFrame:
    """A started event at pickup and a completed event at dropoff, in event-time order.

    The sort is range-partitioned; both events come from one scan.
    """
    shared = "pickup_zone_id, dropoff_zone_id, trip_distance_miles, passenger_count"
    return trips.selectExpr(
        f"""inline(array(
            struct('trip.started' AS event_kind, trip_id, pickup_datetime AS event_time, {shared},
                   CAST(NULL AS INT) AS actual_duration_seconds, CAST(NULL AS DOUBLE) AS fare_amount),
            struct('trip.completed' AS event_kind, trip_id, dropoff_datetime AS event_time, {shared},
                   actual_duration_seconds, fare_amount)))"""
    ).orderBy("event_time", "trip_id", "event_kind")


def write_events(events: DataFrame, path: str) -> None:
    """Replay events as JSON lines in message form; wall clocks are taken as UTC."""
    started = """named_struct(
        'event_id', uuid, 'event_time', at, 'trip_id', trip_id, 'pickup_zone_id', pickup_zone_id,
        'dropoff_zone_id', dropoff_zone_id, 'trip_distance_miles', trip_distance_miles,
        'passenger_count', passenger_count, 'schema_version', '1.1')"""
    completed = """named_struct(
        'event_id', uuid, 'event_time', at, 'trip_id', trip_id,
        'actual_duration_seconds', actual_duration_seconds, 'fare_amount', fare_amount,
        'schema_version', '1.0')"""
    keep_nulls = "map('ignoreNullFields', 'false')"
    # The identity follows from the content, so a replay repeats it.
    identity = (
        "regexp_replace(md5(concat(event_kind, trip_id)),"
        " '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '$1-$2-$3-$4-$5')"
    )
    events.selectExpr(
        "*",
        f"{identity} AS uuid",
        "date_format(event_time, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || 'Z' AS at",
    ).selectExpr(
        "event_kind",
        f"CASE WHEN event_kind = 'trip.started' THEN to_json({started}, {keep_nulls})"
        f" ELSE to_json({completed}, {keep_nulls}) END AS payload",
    ).selectExpr("to_json(struct(event_kind, payload)) AS value").write.text(path)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A stream of validated events from a directory of message lines."""
    lines = spark.readStream.text(path).selectExpr(
        "from_json(value, 'event_kind string, payload string') AS message"
    )
    messages = lines.selectExpr("message.event_kind", "message.payload")
    common = ["event_kind", "trip_id", "event_time", "pickup_zone_id", "dropoff_zone_id"]
    common += ["trip_distance_miles", "passenger_count", "actual_duration_seconds", "fare_amount"]
    started = validate_contract(messages.where("event_kind = 'trip.started'"), "trip-started-v1.1")
    completed = validate_contract(messages.where("event_kind = 'trip.completed'"), "trip-completed-v1")
    parsed = started.unionByName(completed, allowMissingColumns=True)
    return parsed.selectExpr(
        *[
            "CAST(try_to_timestamp(event_time) AS TIMESTAMP_NTZ) AS event_time"
            if name == "event_time"
            else name
            for name in common
        ],
        "is_valid",
        "failed_rules",
    )
