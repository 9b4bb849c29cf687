"""Queries over snapshots and streams."""

from __future__ import annotations

from kerbside.catalog.inputs import SPLIT, _definitions, SPARK, ctes, frame, rounded, snapped
from kerbside.functions import clock
from kerbside.operators import online
from kerbside.sources.files import scratch_path
from kerbside.streaming import jobs, joins, windows
from kerbside.streaming.replay import read_events, replay_events, write_events

END = clock.naive(SPLIT)
SLIDE = 900
WAIT_SECONDS = 5400
ERROR_SECONDS = 3600


def _trip_stream(spark, folder):
    events = jobs.stream_table(spark, folder, "events.parquet")
    return events.selectExpr(*_definitions(SPARK)["trips"][1])


def _store(spark, folder):
    """Stored snapshots with planted damage: lost, outdated, shifted, impossible."""
    base = windows.snapshots_at(frame(spark, folder, "trips"), END, "gold-features-v1")
    keyed = base.selectExpr(
        "*",
        "'gold-features-v1' AS key_version",
        "zone_role AS key_role",
        "zone_id AS key_zone",
        "window_kind AS key_window",
        "zone_id = 18 AND zone_role = 'dropoff' AS shifted",
        "sum(CASE WHEN window_kind = '60m' THEN trip_count END) OVER (PARTITION BY zone_role, zone_id) AS long_count",
    )
    # Zones 12 to 15 look busy, so that fresh lookups occur at every scale.
    busy = "zone_id BETWEEN 8 AND 15"
    return keyed.where("NOT (zone_id = 20 AND zone_role = 'pickup' AND window_kind = '15m')").selectExpr(
        "key_version", "key_role", "key_zone", "key_window", "zone_role", "zone_id", "window_kind",
        "CASE WHEN shifted THEN window_start - INTERVAL 1 SECOND ELSE window_start END AS window_start",
        "CASE WHEN shifted THEN window_end - INTERVAL 1 SECOND ELSE window_end END AS window_end",
        "computed_at",
        f"CASE WHEN {busy} THEN {END} - INTERVAL 2 SECONDS ELSE source_max_event_time END AS source_max_event_time",
        f"CASE WHEN {busy} THEN long_count + 3 + CASE WHEN zone_id = 14 AND window_kind = '15m' THEN 5 ELSE 0 END ELSE trip_count END AS trip_count",
        f"CASE WHEN zone_id = 13 AND window_kind = '60m' THEN -1D WHEN {busy} THEN 12.5D ELSE mean_speed_mph END AS mean_speed_mph",
        f"CASE WHEN {busy} THEN 600D ELSE mean_duration_seconds END AS mean_duration_seconds",
        f"CASE WHEN {busy} THEN 2D ELSE mean_distance_miles END AS mean_distance_miles",
        "CASE WHEN zone_id = 12 THEN 'gold-features-v2' ELSE feature_model_version END AS feature_model_version",
        "schema_version",
    )


def _lookup(spark, folder):
    return online.feature_lookup(frame(spark, folder, "requests"), _store(spark, folder))


def _feature_lookup(spark, folder):
    return rounded(
        _lookup(spark, folder).select(
            "trip_id", "outcome", "pu_zone_trips_15m", "pu_zone_mean_speed_15m", "pu_zone_mean_duration_60m",
            "do_zone_trips_60m", "features_as_of", "age_seconds",
        )
    )


def _score_select(spark, folder):
    chosen = online.score_select(_lookup(spark, folder), static_version="s1", rolling_version="r1")
    return rounded(
        chosen.select(
            "trip_id", "outcome", "model_version", "feature_fallback", "estimated_duration_seconds", "rejection", "schema_version"
        )
    )


def _prediction_messages(spark, folder):
    chosen = online.score_select(
        _lookup(spark, folder), static_version="s1", rolling_version="r1", feature_model_version="gold-features-v2"
    )
    at = online.request_features(frame(spark, folder, "requests")).select("trip_id", "pickup_hour_of_week")
    made = online.prediction_messages(chosen.join(at, "trip_id"), "pickup_time + INTERVAL 1 SECOND")
    return rounded(
        made.selectExpr(
            "trip_id", "model_version", "feature_fallback", "size(features_used) AS features",
            "size(feature_timestamps) AS timestamps", "features_used['pickup_hour_of_week'] AS hour_feature",
            "estimated_duration_seconds", "CAST(served_at AS TIMESTAMP_NTZ) AS served_at", "schema_version",
        )
    )


def _windows(completions):
    return windows.zone_windows(completions, slide_seconds=SLIDE)


def _streamed_windows(spark, folder):
    stream = _windows(windows.zone_completions(_trip_stream(spark, folder)))
    return jobs.drain(stream)[0]


def _latest(spark, folder):
    """Closed windows of the stream merged into a store, batch by batch; what has outlived its time by the stream's last time is gone."""
    stream = _windows(windows.zone_completions(_trip_stream(spark, folder))).selectExpr(
        "*",
        "window_end + INTERVAL 1 SECOND AS computed_at",
        "'gold-features-v1' AS feature_model_version",
    )
    store = jobs.feed_store(stream, jobs.SnapshotStore(spark, scratch_path(spark, "store")))
    return rounded(
        store.read().select(
            "zone_role", "zone_id", "window_kind", "window_start", "window_end", "trip_count", "mean_duration_seconds",
            "source_max_event_time",
        )
    )


def _late(spark, folder):
    """Arrival in daily batches; every 50th event comes two days late."""
    arrivals = frame(spark, folder, "events").selectExpr(
        "event_id",
        "ts AS event_time",
        "CAST(day(ts) + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END AS INT) AS batch",
    )
    return windows.late_events(arrivals).select("event_id", "batch", "watermark", "is_late")


def _freshness(spark, folder):
    log = _windows(windows.zone_completions(frame(spark, folder, "trips"))).selectExpr(
        "source_max_event_time", "window_end + make_dt_interval(0, 0, 0, zone_id * 0.25) AS written_at"
    )
    return rounded(windows.freshness(log))


def _parity(spark, folder):
    snapshots = _streamed_windows(spark, folder)
    return rounded(windows.feature_parity(snapshots, frame(spark, folder, "trips")))


def _stream_events(spark, folder):
    path = scratch_path(spark, "feed")
    write_events(replay_events(frame(spark, folder, "trips")), path)
    return jobs.drain(read_events(spark, path))[0].select("event_kind", "trip_id", "event_time", "is_valid")


def _stream_dedup(spark, folder):
    events = jobs.stream_table(spark, folder, "events.parquet").selectExpr(
        "event_id", "ts", "explode(sequence(1, CASE WHEN event_id % 10 = 0 THEN 3 ELSE 1 END)) AS delivery"
    )
    return jobs.drain(joins.without_duplicates(events, "event_id", "ts"))[0].select("event_id", "ts")


def _served(spark, folder):
    """Streams of served predictions and of completions, of which some never come."""
    predictions = _trip_stream(spark, folder).selectExpr(
        "'p:' || source_row_number AS prediction_id", "trip_id", "pickup_datetime AS served_at",
        "actual_duration_seconds * 0.9e0 + source_row_number % 200 AS estimated_duration_seconds",
    )
    completed = _trip_stream(spark, folder).where("source_row_number % 17 <> 0").selectExpr(
        "trip_id", "dropoff_datetime AS event_time", "actual_duration_seconds"
    )
    return predictions, completed


def _stream_truth(spark, folder):
    return rounded(jobs.drain(joins.stream_ground_truth(*_served(spark, folder), WAIT_SECONDS))[0])


def _stream_live_error(spark, folder):
    return rounded(jobs.drain(joins.stream_live_error(*_served(spark, folder), WAIT_SECONDS, ERROR_SECONDS))[0])


QUERIES = {
    "feature_lookup": _feature_lookup,
    "request_features": lambda s, d: online.request_features(frame(s, d, "requests")),
    "score_select": _score_select,
    "prediction_messages": _prediction_messages,
    "zone_windows": lambda s, d: rounded(_streamed_windows(s, d)),
    "latest_snapshot": _latest,
    "late_events": _late,
    "freshness": _freshness,
    "feature_parity": _parity,
    "stream_events": _stream_events,
    "stream_dedup": _stream_dedup,
    "stream_ground_truth": _stream_truth,
    "stream_live_error": _stream_live_error,
}

_T = ctes("trips")
_COMPLETIONS = """completions AS (
  SELECT 'pickup' AS zone_role, pickup_zone_id AS zone_id, dropoff_datetime AS t, actual_duration_seconds AS d,
    trip_distance_miles / (actual_duration_seconds / 3600e0) AS s, trip_distance_miles AS m FROM trips
  UNION ALL SELECT 'dropoff', dropoff_zone_id, dropoff_datetime, actual_duration_seconds,
    trip_distance_miles / (actual_duration_seconds / 3600e0), trip_distance_miles FROM trips)"""
_WINDOWS = f"""{_T}, {_COMPLETIONS}, spread AS (
  SELECT *, '15m' AS window_kind, 900 AS len, unnest(range(1, 2)) AS k FROM completions
  UNION ALL SELECT *, '60m', 3600, unnest(range(1, 5)) FROM completions),
 ends AS (SELECT *, make_timestamp((epoch_us(t) // 900000000 + k) * 900000000) AS window_end FROM spread),
 w AS (SELECT zone_role, zone_id, window_kind, window_end - to_seconds(len) AS window_start, window_end, count(*) AS trip_count,
   avg(d) AS mean_duration_seconds, avg(s) AS mean_speed_mph, avg(m) AS mean_distance_miles, max(t) AS source_max_event_time
   FROM ends GROUP BY zone_role, zone_id, window_kind, len, window_end),
 closed AS (SELECT * FROM w WHERE window_end <= date_trunc('millisecond', (SELECT max(t) FROM completions)) - INTERVAL 300 SECONDS) """
_SNAP_COLUMNS = "zone_role, zone_id, window_kind, window_start, window_end, trip_count"
_STORE = ctes("trips", "requests") + f""", {_COMPLETIONS}, slots AS (SELECT zone_role AS r, zone_id AS z, k, len,
   count(*) FILTER (WHERE t >= TIMESTAMP '2024-01-15' - to_seconds(len) AND t < TIMESTAMP '2024-01-15') AS n,
   avg(s) FILTER (WHERE t >= TIMESTAMP '2024-01-15' - to_seconds(len) AND t < TIMESTAMP '2024-01-15') AS s,
   avg(d) FILTER (WHERE t >= TIMESTAMP '2024-01-15' - to_seconds(len) AND t < TIMESTAMP '2024-01-15') AS d
   FROM completions, (VALUES ('15m', 900), ('60m', 3600)) v(k, len) GROUP BY ALL),
 busy AS (SELECT r, z, k, z BETWEEN 8 AND 15 AS b, n, max(n) OVER (PARTITION BY r, z) AS ln, s, d FROM slots),
 store AS (SELECT r, z, k, CASE WHEN b THEN ln + 3 + CASE WHEN z = 14 AND k = '15m' THEN 5 ELSE 0 END ELSE n END AS n,
   CASE WHEN b THEN 12.5e0 ELSE coalesce(s, 0) END AS s, CASE WHEN b THEN 600e0 ELSE coalesce(d, 0) END AS d,
   z = 13 AND k = '60m' AS broken, z = 12 AS other_version, z = 18 AND r = 'dropoff' AS shifted FROM busy
   WHERE NOT (z = 20 AND r = 'pickup' AND k = '15m')),
 looked AS (SELECT q.*, a.n AS an, a.s AS asp, l.n AS ln, l.d AS ld, o.n AS oc,
   epoch_us(q.pickup_time) / 1e6 - epoch_us(TIMESTAMP '2024-01-15') / 1e6 AS age,
   CASE WHEN a.z IS NULL OR l.z IS NULL OR o.z IS NULL THEN 'missing'
     WHEN a.broken OR l.broken OR o.broken THEN 'invalid'
     WHEN a.other_version THEN 'invalid'
     WHEN q.pickup_time < TIMESTAMP '2024-01-15' THEN 'future' WHEN q.pickup_time > TIMESTAMP '2024-01-15 00:10:00' THEN 'stale'
     WHEN o.other_version THEN 'invalid'
     WHEN o.shifted AND q.pickup_time > TIMESTAMP '2024-01-15 00:09:59' THEN 'stale'
     WHEN o.shifted THEN 'inconsistent' WHEN a.n > l.n THEN 'invalid' WHEN a.n = 0 OR l.n = 0 THEN 'empty' ELSE 'fresh' END AS outcome
   FROM requests q LEFT JOIN store a ON a.r = 'pickup' AND a.k = '15m' AND a.z = q.pickup_zone_id
   LEFT JOIN store l ON l.r = 'pickup' AND l.k = '60m' AND l.z = q.pickup_zone_id
   LEFT JOIN store o ON o.r = 'dropoff' AND o.k = '60m' AND o.z = q.dropoff_zone_id) """
# The wait of a prediction is over one millisecond after the watermark, the least of both streams.
_SERVED = f"""{_T}, p AS (SELECT 'p:' || source_row_number AS prediction_id, trip_id, pickup_datetime AS served_at,
   actual_duration_seconds * 0.9e0 + source_row_number % 200 AS estimate FROM trips),
 c AS (SELECT trip_id, dropoff_datetime AS joined_at, actual_duration_seconds AS actual FROM trips WHERE source_row_number % 17 <> 0),
 over AS (SELECT date_trunc('millisecond', least((SELECT max(served_at) FROM p), (SELECT max(joined_at) FROM c)))
   - INTERVAL 300 SECONDS - INTERVAL {WAIT_SECONDS} SECONDS - INTERVAL 1 MILLISECOND AS until),
 truths AS (SELECT p.*, c.actual, c.joined_at, c.trip_id IS NOT NULL AS joined, abs(estimate - actual) AS error, until
   FROM p LEFT JOIN c ON p.trip_id = c.trip_id AND joined_at BETWEEN served_at AND served_at + INTERVAL {WAIT_SECONDS} SECONDS, over) """
_SCORED = _STORE + """, chosen AS (SELECT *, outcome <> 'fresh' AS fallback, CASE WHEN outcome = 'fresh' THEN rolling_score ELSE static_score END AS score FROM looked) """

ORACLES = {
    "feature_lookup": f"""{_STORE} SELECT trip_id, outcome, CASE WHEN outcome = 'fresh' THEN CAST(an AS BIGINT) END AS pu_zone_trips_15m,
  snap(CASE WHEN outcome = 'fresh' THEN asp END) AS pu_zone_mean_speed_15m, snap(CASE WHEN outcome = 'fresh' THEN ld END) AS pu_zone_mean_duration_60m,
  CASE WHEN outcome = 'fresh' THEN CAST(oc AS BIGINT) END AS do_zone_trips_60m,
  CASE WHEN outcome = 'fresh' THEN TIMESTAMP '2024-01-15' END AS features_as_of, snap(CASE WHEN outcome = 'fresh' THEN age END) AS age_seconds FROM looked""",
    "request_features": ctes("requests") + """ SELECT trip_id, pickup_zone_id, dropoff_zone_id, CAST(dayofweek(pickup_time - INTERVAL 5 HOURS) * 24
  + hour(pickup_time - INTERVAL 5 HOURS) AS SMALLINT) AS pickup_hour_of_week, trip_distance_miles, passenger_count FROM requests""",
    "score_select": f"""{_SCORED} SELECT trip_id, outcome, CASE WHEN fallback THEN 's1' ELSE 'r1' END AS model_version, fallback AS feature_fallback,
  snap(CASE WHEN passenger_count IS NOT NULL AND score > 0 THEN score END) AS estimated_duration_seconds,
  CASE WHEN passenger_count IS NULL THEN 'unknown_passenger_count' WHEN score <= 0 THEN 'invalid_estimate' END AS rejection, '1.0' AS schema_version FROM chosen""",
    "prediction_messages": f"""{_SCORED} SELECT trip_id, CASE WHEN fallback THEN 's1' ELSE 'r1' END AS model_version, fallback AS feature_fallback,
  CAST(CASE WHEN fallback THEN 5 ELSE 9 END AS INTEGER) AS features, CAST(CASE WHEN fallback THEN 0 ELSE 4 END AS INTEGER) AS timestamps,
  snap(CAST(dayofweek(pickup_time - INTERVAL 5 HOURS) * 24 + hour(pickup_time - INTERVAL 5 HOURS) AS DOUBLE)) AS hour_feature,
  snap(score) AS estimated_duration_seconds, pickup_time + INTERVAL 1 SECOND AS served_at, '1.1' AS schema_version FROM chosen WHERE score > 0""",
    "zone_windows": f"""{_WINDOWS} SELECT {_SNAP_COLUMNS}, snap(mean_duration_seconds) AS mean_duration_seconds, snap(mean_speed_mph) AS mean_speed_mph,
  snap(mean_distance_miles) AS mean_distance_miles, source_max_event_time FROM closed""",
    "latest_snapshot": f"""{_WINDOWS} SELECT {_SNAP_COLUMNS}, snap(mean_duration_seconds) AS mean_duration_seconds, source_max_event_time
  FROM closed WHERE window_end > (SELECT max(window_end) FROM closed) - INTERVAL {online.SNAPSHOT_TTL_SECONDS} SECONDS
  QUALIFY row_number() OVER (PARTITION BY zone_role, zone_id, window_kind ORDER BY window_end DESC) = 1""",
    "late_events": """WITH a AS (SELECT event_id, ts, CAST(day(ts) + CASE WHEN event_id % 50 = 0 THEN 2 ELSE 0 END AS INTEGER) AS batch FROM events),
 b AS (SELECT batch, max(ts) AS newest FROM a GROUP BY 1),
 m AS (SELECT batch, max(newest) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 300 SECONDS AS watermark FROM b)
SELECT event_id, batch, watermark, coalesce(ts < watermark, false) AS is_late FROM a JOIN m USING (batch)""",
    "freshness": f"""{_WINDOWS} SELECT snap(quantile_disc((epoch_us(window_end + to_microseconds(zone_id * 250000)) - epoch_us(source_max_event_time)) / 1e6, 0.95)) AS p95 FROM w""",
    "feature_parity": f"""{_WINDOWS} SELECT zone_role, window_kind, count(*) AS compared, CAST(0 AS BIGINT) AS mismatched, 0e0 AS mismatch_rate, 0e0 AS max_abs_difference
  FROM closed GROUP BY ALL""",
    "stream_ground_truth": f"""{_SERVED} SELECT prediction_id, trip_id, served_at, snap(estimate) AS estimated_duration_seconds, actual AS actual_duration_seconds,
  snap(error) AS absolute_error_seconds, joined_at, joined FROM truths WHERE joined OR served_at <= until""",
    "stream_live_error": f"""{_SERVED} SELECT make_timestamp(epoch_us(served_at) // {ERROR_SECONDS * 1_000_000} * {ERROR_SECONDS * 1_000_000}) AS window_start,
  count(*) AS predictions, count(*) FILTER (WHERE joined) AS joined_predictions, snap(count(*) FILTER (WHERE joined) / count(*)) AS coverage,
  snap(avg(error)) AS mae_seconds, snap(avg((epoch_us(joined_at) - epoch_us(served_at)) / 1e6)) AS mean_join_latency_seconds
  FROM truths GROUP BY 1, until HAVING make_timestamp((epoch_us(min(served_at)) // {ERROR_SECONDS * 1_000_000} + 1) * {ERROR_SECONDS * 1_000_000}) <= until""",
    "stream_dedup": "SELECT event_id, ts FROM events",
    "stream_events": f"""{_T} SELECT 'trip.started' AS event_kind, trip_id, pickup_datetime AS event_time, true AS is_valid FROM trips
  UNION ALL SELECT 'trip.completed', trip_id, dropoff_datetime, true FROM trips""",
}
ORACLES = {name: snapped(sql) for name, sql in ORACLES.items()}
