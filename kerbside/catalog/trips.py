"""Queries over silver and gold trips."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.catalog.inputs import MONTH, SPLIT, ctes, frame, rounded, snapped
from kerbside.functions import clock, numbers
from kerbside.operators import distributions, pointintime as pit, quality, ranking

DAY_AFTER = datetime(2024, 1, 20)
V2 = schemas.FEATURES_BY_CONTRACT["1.1"]


def gold(spark, folder):
    return pit.gold_features(frame(spark, folder, "trips"), MONTH.start, MONTH.end, V2)


def _gold_rounded(spark, folder):
    return rounded(gold(spark, folder))


def _history(role, windows, means):
    def query(spark, folder):
        trips = frame(spark, folder, "trips")
        probes = trips.select("trip_id", "pickup_datetime", f"{role}_zone_id")
        return rounded(pit.zone_history(probes, trips, role, windows=windows, means=means))

    return query


def _drift_scores(spark, folder):
    """Drift of the dimensions, of the target and of a prediction."""
    scored = frame(spark, folder, "holdout")
    old, recent = (scored.where(f"pickup_datetime {side} {clock.naive(DAY_AFTER)}") for side in ("<", ">="))
    return rounded(distributions.drift_report(old, recent, 0.05, measures=["actual_duration_seconds", "rolling"]))


def _range_pit(spark, folder):
    """The same operator between two different frames: page views against earlier purchases."""
    events = frame(spark, folder, "events")
    probes = events.where("event_type = 'view'").select("event_id", "user_id", "ts")
    facts = events.where("event_type = 'purchase'").select("user_id", "ts", "value")
    return rounded(
        pit.trailing_features(
            probes,
            facts,
            key="user_id",
            at="ts",
            windows={"1d": 86_400, "7d": 7 * 86_400},
            means=["value"],
        )
    )


def _replay(spark, folder):
    from kerbside.streaming.replay import replay_events

    return replay_events(frame(spark, folder, "trips"))


def _dst(spark, folder):
    events = frame(spark, folder, "events")
    shifted = events.selectExpr(
        "event_id",
        "explode(array(60, 290)) AS days",
        "ts",
    ).selectExpr("event_id", "days", "ts + make_dt_interval(days, 0, 0, 0) AS pickup_datetime")
    return distributions.local_time_flags(shifted, "pickup_datetime")


def _version_gate(spark, folder):
    inputs = frame(spark, folder, "events").selectExpr(
        "event_type AS input",
        "CASE WHEN event_type = 'error' AND event_id % 500 = 3 THEN NULL"
        " WHEN event_type = 'view' AND event_id % 7 = 0 THEN '1.0'"
        " WHEN event_type = 'signup' THEN '2.0' ELSE '1.1' END AS contract_version",
    )
    return quality.version_gate(inputs, schemas.FEATURES_BY_CONTRACT)


def _policies(spark, folder):
    """Contract and feature version each event falls under, by its policy."""
    events = frame(spark, folder, "events")
    contract = "CASE policy " + " ".join(
        f"WHEN '{p}' THEN '{c}'" for p, c in schemas.CONTRACT_BY_POLICY.items()
    )
    features = "CASE contract_version " + " ".join(
        f"WHEN '{c}' THEN '{v}'" for c, v in schemas.FEATURES_BY_CONTRACT.items()
    )
    return (
        events.selectExpr(
            "CASE WHEN event_id % 4 = 0 THEN 'required' ELSE 'allow_unknown' END AS policy"
        )
        .selectExpr("policy", f"{contract} END AS contract_version")
        .selectExpr("policy", "contract_version", f"{features} END AS feature_model_version")
        .groupBy("policy", "contract_version", "feature_model_version")
        .agg(F.expr("count(1) AS rows"))
    )


def _damaged_gold(spark, folder):
    """Gold-like rows with planted defects, one rule at a time."""
    return frame(spark, folder, "trips").selectExpr(
        "CASE WHEN source_row_number % 501 = 5 THEN 'e:1' ELSE trip_id END AS trip_id",
        "CASE WHEN source_row_number % 601 = 6 THEN NULL ELSE pickup_datetime END AS pickup_datetime",
        "pickup_zone_id",
        "CASE WHEN source_row_number % 701 = 7 THEN NULL ELSE dropoff_zone_id END AS dropoff_zone_id",
        "actual_duration_seconds",
        "CAST(CASE WHEN source_row_number % 811 = 8 THEN 12 WHEN source_row_number % 821 = 9 THEN -1"
        " ELSE passenger_count END AS SMALLINT) AS passenger_count",
        "CAST(source_row_number % 50 - CASE WHEN source_row_number % 901 = 0 THEN 1 ELSE 0 END AS INT) AS pu_zone_trips_15m",
        "CAST(source_row_number % 90 AS INT) AS pu_zone_trips_60m",
        "CAST(source_row_number % 80 AS INT) AS do_zone_trips_60m",
        "CASE WHEN source_row_number % 401 = 4 THEN pickup_datetime"
        " ELSE pickup_datetime - make_dt_interval(0, 0, 0, 1) END AS pu_zone_features_15m_as_of",
        "CASE WHEN source_row_number % 5 = 0 THEN NULL"
        " ELSE pickup_datetime - make_dt_interval(0, 0, 0, 2) END AS pu_zone_features_60m_as_of",
        "CASE WHEN source_row_number % 409 = 4 THEN dropoff_datetime"
        " ELSE pickup_datetime - make_dt_interval(0, 0, 0, 3) END AS do_zone_features_60m_as_of",
        "CASE WHEN source_row_number % 10 = 3 THEN '1.0' ELSE contract_version END AS contract_version",
        "CASE WHEN source_row_number % 303 = 1 THEN 'gold-features-v9'"
        " WHEN source_row_number % 10 = 3 THEN 'gold-features-v1' ELSE 'gold-features-v2' END AS feature_model_version",
    )


def _on_damaged(check):
    return lambda spark, folder: check(_damaged_gold(spark, folder))


def _zone_semi(spark, folder):
    zones = frame(spark, folder, "nation").selectExpr("CAST(n_nationkey AS SMALLINT) AS zone_id").where("zone_id % 3 <> 0")
    return quality.known_zone_rows(frame(spark, folder, "trips"), zones, "pickup_zone_id").select(
        "trip_id", "pickup_zone_id"
    )


def _scalars(spark, folder):
    trips = frame(spark, folder, "trips")
    return rounded(
        trips.selectExpr(
            "trip_id",
            f"{clock.HOUR_OF_WEEK_SUNDAY.format('pickup_datetime')} AS hour_of_week_sunday",
            f"{clock.HOUR_OF_WEEK_MONDAY.format('pickup_datetime')} AS hour_of_week_monday",
            f"{numbers.speed_mph('trip_distance_miles', 'actual_duration_seconds')} AS speed_mph",
            f"{clock.SECONDS_BETWEEN.format('pickup_datetime', 'dropoff_datetime')} AS duration_seconds",
            "date_format(pickup_datetime, 'yyyy-MM') AS month",
            "date_format(add_months(trunc(CAST(pickup_datetime AS DATE), 'MM'), -1), 'yyyy-MM') AS previous_month",
            "coalesce(CAST(passenger_count AS STRING), 'unknown') AS passenger_label",
            f"{numbers.is_finite('trip_distance_miles')} AS is_finite",
            numbers.mae_improvement_pct(
                "CAST(source_row_number % 3 AS DOUBLE)", "CAST(source_row_number % 2 AS DOUBLE)"
            )
            + " AS improvement_pct",
        )
    )


def _union_by_name(spark, folder):
    """Two months with different columns: the second lacks fares."""
    trips = frame(spark, folder, "trips")
    first = trips.where(f"pickup_datetime < {clock.naive(SPLIT)}").select(
        "trip_id", "fare_amount", "contract_version"
    )
    second = trips.where(f"pickup_datetime >= {clock.naive(SPLIT)}").select(
        "contract_version", "trip_id", "passenger_count"
    )
    return first.unionByName(second, allowMissingColumns=True)


QUERIES = {
    "gold_features": _gold_rounded,
    "event_ledger": lambda s, d: rounded(pit.event_ledger(frame(s, d, "trips"), "pickup")),
    "pit_pickup_zone": _history("pickup", pit.WINDOWS, ("duration", "speed", "distance")),
    "pit_dropoff_zone": _history("dropoff", {"60m": 3600}, ()),
    "pit_ledger": _history("pickup", pit.WINDOWS, ("duration",)),
    "range_join_pit": _range_pit,
    "staging_cast": lambda s, d: pit.stage_trips(
        frame(s, d, "trips").selectExpr(
            "trip_id", "CAST(pickup_datetime AS STRING) AS pickup_datetime", "dropoff_datetime",
            "CAST(pickup_zone_id AS BIGINT) AS pickup_zone_id", "CAST(dropoff_zone_id AS DOUBLE) AS dropoff_zone_id",
            "CAST(trip_distance_miles AS STRING) AS trip_distance_miles", "CAST(passenger_count AS DOUBLE) AS passenger_count",
            "fare_amount", "CAST(actual_duration_seconds AS BIGINT) AS actual_duration_seconds",
            "CAST(source_row_number AS STRING) AS source_row_number", "contract_version",
        )
    ),
    "lookback_prune": lambda s, d: pit.prune_lookback(
        frame(s, d, "trips"), SPLIT, DAY_AFTER, 3600
    ).select("trip_id", "pickup_datetime", "dropoff_datetime"),
    "union_by_name": _union_by_name,
    "dst_exclusion": _dst,
    "version_gate": _version_gate,
    "policy_versions": _policies,
    "gold_passenger_check": _on_damaged(
        lambda g: quality.passenger_violations(g).select("trip_id", "passenger_count", "feature_model_version")
    ),
    "dt_not_null": _on_damaged(quality.null_counts),
    "dt_unique": _on_damaged(lambda g: quality.duplicates(g, "trip_id")),
    "dt_accepted": _on_damaged(
        lambda g: quality.outside_values(
            g, "feature_model_version", schemas.FEATURES_BY_CONTRACT.values()
        ).select("trip_id", "feature_model_version")
    ),
    "dt_nonneg": _on_damaged(
        lambda g: quality.negative_counts(g).select("trip_id", "pu_zone_trips_15m")
    ),
    "dt_no_leak": _on_damaged(
        lambda g: quality.leaking_rows(g).select("trip_id", "pickup_datetime")
    ),
    "dt_contract": _on_damaged(lambda g: quality.contract_disagreements(g).select("trip_id")),
    "known_zone_semi": _zone_semi,
    "scalar_features": _scalars,
    "replay_events": _replay,
    "marginal_histograms": lambda s, d: distributions.marginal_histograms(frame(s, d, "trips")),
    "histogram_tvd": lambda s, d: rounded(
        distributions.histogram_distances(
            distributions.marginal_histograms(frame(s, d, "trips")),
            distributions.marginal_histograms(
                ranking.hash_sample(frame(s, d, "trips"), "trip_id", 200, 42)
            ),
        )
    ),
    "hash_sample": lambda s, d: ranking.hash_sample(frame(s, d, "trips"), "trip_id", 200, 42).select(
        "trip_id", "sample_key"
    ),
    "even_sample": lambda s, d: ranking.even_sample(
        frame(s, d, "trips").select("trip_id", "pickup_datetime"), 500, ["pickup_datetime", "trip_id"]
    ),
    "drift_report": lambda s, d: rounded(
        distributions.drift_report(
            frame(s, d, "trips").where(f"pickup_datetime < {clock.naive(SPLIT)}"),
            frame(s, d, "trips").where(f"pickup_datetime >= {clock.naive(SPLIT)}"),
            0.05,
        )
    ),
    "drift_scores": _drift_scores,
}

_PICKUP_WINDOWS = """pickup_ledger AS (
  SELECT trip_id, pickup_zone_id AS z, pickup_datetime AS t, NULL AS d, NULL AS s, NULL AS m, true AS probe FROM trips
  UNION ALL
  SELECT NULL, pickup_zone_id, dropoff_datetime, actual_duration_seconds,
         trip_distance_miles / (actual_duration_seconds / 3600e0), trip_distance_miles, false FROM trips
), pickup_history AS (
  SELECT trip_id, probe,
    count(d) OVER short AS n15, avg(d) OVER short AS d15, avg(s) OVER short AS s15, avg(m) OVER short AS m15,
    max(CASE WHEN NOT probe THEN t END) OVER short AS at15,
    count(d) OVER long AS n60, avg(d) OVER long AS d60, avg(s) OVER long AS s60, avg(m) OVER long AS m60,
    max(CASE WHEN NOT probe THEN t END) OVER long AS at60
  FROM pickup_ledger
  WINDOW short AS (PARTITION BY z ORDER BY t RANGE BETWEEN INTERVAL 900 SECONDS PRECEDING AND CURRENT ROW EXCLUDE GROUP),
         long AS (PARTITION BY z ORDER BY t RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW EXCLUDE GROUP)
)"""
_DROPOFF_WINDOWS = """dropoff_ledger AS (
  SELECT trip_id, dropoff_zone_id AS z, pickup_datetime AS t, NULL AS d, true AS probe FROM trips
  UNION ALL
  SELECT NULL, dropoff_zone_id, dropoff_datetime, actual_duration_seconds, false FROM trips
), dropoff_history AS (
  SELECT trip_id, probe, count(d) OVER long AS n60, max(CASE WHEN NOT probe THEN t END) OVER long AS at60
  FROM dropoff_ledger
  WINDOW long AS (PARTITION BY z ORDER BY t RANGE BETWEEN INTERVAL 3600 SECONDS PRECEDING AND CURRENT ROW EXCLUDE GROUP)
)"""
_TRIPS = ctes("trips")
_DAMAGED = _TRIPS + """, gold AS (SELECT
  CASE WHEN source_row_number % 501 = 5 THEN 'e:1' ELSE trip_id END AS trip_id,
  CASE WHEN source_row_number % 601 = 6 THEN NULL ELSE pickup_datetime END AS pickup_datetime,
  pickup_zone_id,
  CASE WHEN source_row_number % 701 = 7 THEN NULL ELSE dropoff_zone_id END AS dropoff_zone_id,
  actual_duration_seconds,
  CAST(CASE WHEN source_row_number % 811 = 8 THEN 12 WHEN source_row_number % 821 = 9 THEN -1 ELSE passenger_count END AS SMALLINT) AS passenger_count,
  CAST(source_row_number % 50 - CASE WHEN source_row_number % 901 = 0 THEN 1 ELSE 0 END AS INTEGER) AS pu_zone_trips_15m,
  CAST(source_row_number % 90 AS INTEGER) AS pu_zone_trips_60m,
  CAST(source_row_number % 80 AS INTEGER) AS do_zone_trips_60m,
  CASE WHEN source_row_number % 401 = 4 THEN pickup_datetime ELSE pickup_datetime - INTERVAL 1 SECOND END AS a15,
  CASE WHEN source_row_number % 5 = 0 THEN NULL ELSE pickup_datetime - INTERVAL 2 SECONDS END AS a60,
  CASE WHEN source_row_number % 409 = 4 THEN dropoff_datetime ELSE pickup_datetime - INTERVAL 3 SECONDS END AS d60,
  CASE WHEN source_row_number % 10 = 3 THEN '1.0' ELSE contract_version END AS contract_version,
  CASE WHEN source_row_number % 303 = 1 THEN 'gold-features-v9' WHEN source_row_number % 10 = 3 THEN 'gold-features-v1' ELSE 'gold-features-v2' END AS feature_model_version
  FROM trips) """
_PROFILE = """ SELECT 'pickup_hour_of_week' AS dimension, CAST((isodow(pickup_datetime) - 1) * 24 + hour(pickup_datetime) AS VARCHAR) AS key FROM {0}
  UNION ALL SELECT 'pickup_zone', CAST(pickup_zone_id AS VARCHAR) FROM {0}
  UNION ALL SELECT 'dropoff_zone', CAST(dropoff_zone_id AS VARCHAR) FROM {0}
  UNION ALL SELECT 'distance', CASE WHEN trip_distance_miles < 1 THEN '[0,1)' WHEN trip_distance_miles < 3 THEN '[1,3)'
      WHEN trip_distance_miles < 10 THEN '[3,10)' ELSE '[10,inf)' END FROM {0}
  UNION ALL SELECT 'passengers', coalesce(CAST(passenger_count AS VARCHAR), 'unknown') FROM {0} """
_TVD = """, hp AS (SELECT dimension, key, count(*) AS n FROM (""" + _PROFILE + """) GROUP BY ALL),
 hq AS (SELECT dimension, key, count(*) AS n FROM ({1}) GROUP BY ALL),
 pp AS (SELECT dimension, key, n / sum(n) OVER (PARTITION BY dimension) AS p FROM hp),
 qq AS (SELECT dimension, key, n / sum(n) OVER (PARTITION BY dimension) AS q FROM hq),
 tvd AS (SELECT coalesce(pp.dimension, qq.dimension) AS dimension, 0.5 * sum(abs(coalesce(p, 0) - coalesce(q, 0))) AS tvd
   FROM pp FULL JOIN qq ON pp.dimension = qq.dimension AND pp.key = qq.key GROUP BY 1) """
_SAMPLE = ", drawn AS (SELECT *, md5('42:' || trip_id) AS sample_key FROM trips ORDER BY sample_key, trip_id LIMIT 200)"

ORACLES = {
    "gold_features": f"""{_TRIPS}, {_PICKUP_WINDOWS}, {_DROPOFF_WINDOWS}
SELECT t.trip_id, t.pickup_datetime, t.dropoff_datetime, t.pickup_zone_id, t.dropoff_zone_id,
  CAST(dayofweek(t.pickup_datetime) * 24 + hour(t.pickup_datetime) AS SMALLINT) AS pickup_hour_of_week,
  snap(t.trip_distance_miles) AS trip_distance_miles, t.passenger_count, t.actual_duration_seconds,
  CAST(p.n15 AS INTEGER) AS pu_zone_trips_15m, snap(p.d15) AS pu_zone_mean_duration_15m,
  snap(p.s15) AS pu_zone_mean_speed_15m, snap(p.m15) AS pu_zone_mean_distance_15m,
  CAST(p.n60 AS INTEGER) AS pu_zone_trips_60m, snap(p.d60) AS pu_zone_mean_duration_60m,
  snap(p.s60) AS pu_zone_mean_speed_60m, snap(p.m60) AS pu_zone_mean_distance_60m,
  CAST(d.n60 AS INTEGER) AS do_zone_trips_60m,
  p.at15 AS pu_zone_features_15m_as_of, p.at60 AS pu_zone_features_60m_as_of, d.at60 AS do_zone_features_60m_as_of,
  t.contract_version, 'gold-features-v2' AS feature_model_version
FROM trips t JOIN pickup_history p ON t.trip_id = p.trip_id JOIN dropoff_history d ON t.trip_id = d.trip_id
WHERE p.probe AND d.probe AND t.pickup_datetime >= TIMESTAMP '2024-01-01' AND t.pickup_datetime < TIMESTAMP '2024-02-01'""",
    "event_ledger": f"""{_TRIPS}
SELECT pickup_zone_id AS zone_id, CAST(NULL AS VARCHAR) AS trip_id, dropoff_datetime AS event_time, 'completion' AS event_kind,
  actual_duration_seconds, snap(trip_distance_miles) AS trip_distance_miles,
  snap(trip_distance_miles / (actual_duration_seconds / 3600e0)) AS speed_mph FROM trips
UNION ALL SELECT pickup_zone_id, trip_id, pickup_datetime, 'pickup', NULL, NULL, NULL FROM trips""",
    "pit_pickup_zone": f"""{_TRIPS}, {_PICKUP_WINDOWS}
SELECT t.trip_id, t.pickup_datetime, t.pickup_zone_id, CAST(n15 AS INTEGER) AS count_15m, snap(d15) AS mean_duration_15m,
  snap(s15) AS mean_speed_15m, snap(m15) AS mean_distance_15m, at15 AS as_of_15m,
  CAST(n60 AS INTEGER) AS count_60m, snap(d60) AS mean_duration_60m, snap(s60) AS mean_speed_60m,
  snap(m60) AS mean_distance_60m, at60 AS as_of_60m
FROM trips t JOIN pickup_history p ON t.trip_id = p.trip_id WHERE p.probe""",
    "pit_dropoff_zone": f"""{_TRIPS}, {_DROPOFF_WINDOWS}
SELECT t.trip_id, t.pickup_datetime, t.dropoff_zone_id, CAST(n60 AS INTEGER) AS count_60m, at60 AS as_of_60m
FROM trips t JOIN dropoff_history d ON t.trip_id = d.trip_id WHERE d.probe""",
    "pit_ledger": f"""{_TRIPS}, {_PICKUP_WINDOWS}
SELECT t.trip_id, t.pickup_datetime, t.pickup_zone_id, CAST(n15 AS INTEGER) AS count_15m, snap(d15) AS mean_duration_15m,
  at15 AS as_of_15m, CAST(n60 AS INTEGER) AS count_60m, snap(d60) AS mean_duration_60m, at60 AS as_of_60m
FROM trips t JOIN pickup_history p ON t.trip_id = p.trip_id WHERE p.probe""",
    "range_join_pit": """SELECT p.event_id, p.user_id, p.ts,
  CAST(count(f.ts) FILTER (WHERE f.ts >= p.ts - INTERVAL 1 DAY) AS INTEGER) AS count_1d,
  snap(avg(f.value) FILTER (WHERE f.ts >= p.ts - INTERVAL 1 DAY)) AS mean_value_1d,
  max(f.ts) FILTER (WHERE f.ts >= p.ts - INTERVAL 1 DAY) AS as_of_1d,
  CAST(count(f.ts) AS INTEGER) AS count_7d, snap(avg(f.value)) AS mean_value_7d, max(f.ts) AS as_of_7d
FROM events p LEFT JOIN events f ON f.user_id = p.user_id AND f.event_type = 'purchase'
  AND f.ts < p.ts AND f.ts >= p.ts - INTERVAL 7 DAYS
WHERE p.event_type = 'view' GROUP BY ALL""",
    "staging_cast": f"{_TRIPS} SELECT * FROM trips",
    "lookback_prune": f"""{_TRIPS} SELECT trip_id, pickup_datetime, dropoff_datetime FROM trips
WHERE (pickup_datetime >= TIMESTAMP '2024-01-15' AND pickup_datetime < TIMESTAMP '2024-01-20')
   OR (dropoff_datetime >= TIMESTAMP '2024-01-14 23:00:00' AND dropoff_datetime < TIMESTAMP '2024-01-20')""",
    "union_by_name": f"""{_TRIPS}
SELECT trip_id, fare_amount, contract_version, CAST(NULL AS SMALLINT) AS passenger_count FROM trips WHERE pickup_datetime < TIMESTAMP '2024-01-15'
UNION ALL SELECT trip_id, NULL, contract_version, passenger_count FROM trips WHERE pickup_datetime >= TIMESTAMP '2024-01-15'""",
    "dst_exclusion": """WITH shifted AS (SELECT event_id, days, ts + to_days(days) AS pickup_datetime
  FROM events, (SELECT CAST(unnest([60, 290]) AS INTEGER) AS days))
SELECT event_id, days, pickup_datetime,
  pickup_datetime >= TIMESTAMP '2024-03-10 02:00:00' AND pickup_datetime < TIMESTAMP '2024-03-10 03:00:00' AS is_nonexistent,
  pickup_datetime >= TIMESTAMP '2024-11-03 01:00:00' AND pickup_datetime < TIMESTAMP '2024-11-03 02:00:00' AS is_ambiguous
FROM shifted""",
    "version_gate": """WITH i AS (SELECT event_type AS input,
  CASE WHEN event_type = 'error' AND event_id % 500 = 3 THEN NULL WHEN event_type = 'view' AND event_id % 7 = 0 THEN '1.0'
  WHEN event_type = 'signup' THEN '2.0' ELSE '1.1' END AS v FROM events),
 g AS (SELECT input, count(DISTINCT v) AS versions, count(*) FILTER (WHERE v IS NULL) AS null_versions,
   count(*) FILTER (WHERE v NOT IN ('1.0', '1.1')) AS unsupported_rows FROM i GROUP BY input)
SELECT input, versions, null_versions, unsupported_rows,
  versions = 1 AND null_versions = 0 AND unsupported_rows = 0 AS single_supported,
  (SELECT min(v) = max(v) FROM i) AS versions_agree FROM g""",
    "policy_versions": """SELECT CASE WHEN event_id % 4 = 0 THEN 'required' ELSE 'allow_unknown' END AS policy,
  CASE WHEN event_id % 4 = 0 THEN '1.0' ELSE '1.1' END AS contract_version,
  CASE WHEN event_id % 4 = 0 THEN 'gold-features-v1' ELSE 'gold-features-v2' END AS feature_model_version,
  count(*) AS rows FROM events GROUP BY ALL""",
    "gold_passenger_check": f"""{_DAMAGED} SELECT trip_id, passenger_count, feature_model_version FROM gold
WHERE (feature_model_version = 'gold-features-v1' AND passenger_count IS NULL) OR passenger_count < 0 OR passenger_count > 9""",
    "dt_not_null": _DAMAGED + " UNION ALL ".join(
        [f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_rows FROM gold" for c in quality.GOLD_NOT_NULL]
    ),
    "dt_unique": f"{_DAMAGED} SELECT trip_id, count(*) AS copies FROM gold GROUP BY trip_id HAVING count(*) > 1",
    "dt_accepted": f"{_DAMAGED} SELECT trip_id, feature_model_version FROM gold WHERE feature_model_version NOT IN ('gold-features-v1', 'gold-features-v2')",
    "dt_nonneg": f"{_DAMAGED} SELECT trip_id, pu_zone_trips_15m FROM gold WHERE pu_zone_trips_15m < 0 OR pu_zone_trips_60m < 0 OR do_zone_trips_60m < 0",
    "dt_no_leak": f"{_DAMAGED} SELECT trip_id, pickup_datetime FROM gold WHERE a15 >= pickup_datetime OR a60 >= pickup_datetime OR d60 >= pickup_datetime",
    "dt_contract": f"""{_DAMAGED} SELECT trip_id FROM gold WHERE (contract_version = '1.0' AND passenger_count IS NULL)
  OR passenger_count < 0 OR passenger_count > 9
  OR feature_model_version <> CASE contract_version WHEN '1.0' THEN 'gold-features-v1' WHEN '1.1' THEN 'gold-features-v2' END""",
    "known_zone_semi": f"""{_TRIPS} SELECT trip_id, pickup_zone_id FROM trips
WHERE pickup_zone_id IN (SELECT n_nationkey FROM nation WHERE n_nationkey % 3 <> 0)""",
    "scalar_features": f"""{_TRIPS} SELECT trip_id,
  CAST(dayofweek(pickup_datetime) * 24 + hour(pickup_datetime) AS SMALLINT) AS hour_of_week_sunday,
  CAST((isodow(pickup_datetime) - 1) * 24 + hour(pickup_datetime) AS SMALLINT) AS hour_of_week_monday,
  snap(trip_distance_miles / (actual_duration_seconds / 3600e0)) AS speed_mph,
  CAST(epoch_us(dropoff_datetime) // 1000000 - epoch_us(pickup_datetime) // 1000000 AS INTEGER) AS duration_seconds,
  strftime(pickup_datetime, '%Y-%m') AS month,
  strftime(date_trunc('month', pickup_datetime) - INTERVAL 1 MONTH, '%Y-%m') AS previous_month,
  coalesce(CAST(passenger_count AS VARCHAR), 'unknown') AS passenger_label, isfinite(trip_distance_miles) AS is_finite,
  CASE WHEN source_row_number % 2 = 0 THEN CASE WHEN source_row_number % 3 = 0 THEN 0e0 ELSE -100e0 END
    ELSE (1e0 - source_row_number % 3) / 1e0 * 100 END AS improvement_pct FROM trips""",
    "replay_events": f"""{_TRIPS}
SELECT 'trip.started' AS event_kind, trip_id, pickup_datetime AS event_time, pickup_zone_id, dropoff_zone_id, trip_distance_miles,
  passenger_count, CAST(NULL AS INTEGER) AS actual_duration_seconds, CAST(NULL AS DOUBLE) AS fare_amount FROM trips
UNION ALL SELECT 'trip.completed', trip_id, dropoff_datetime, pickup_zone_id, dropoff_zone_id, trip_distance_miles,
  passenger_count, actual_duration_seconds, fare_amount FROM trips""",
    "marginal_histograms": f"{_TRIPS} SELECT dimension, key, count(*) AS rows FROM ({_PROFILE.format('trips')}) GROUP BY ALL",
    "histogram_tvd": f"{_TRIPS}{_SAMPLE}{_TVD.format('trips', _PROFILE.format('drawn'))} SELECT dimension, snap(tvd) AS total_variation_distance FROM tvd",
    "hash_sample": f"{_TRIPS}{_SAMPLE} SELECT trip_id, sample_key FROM drawn",
    "even_sample": f"""{_TRIPS}, placed AS (SELECT trip_id, pickup_datetime,
  row_number() OVER (ORDER BY pickup_datetime, trip_id) - 1 AS position, count(*) OVER () AS total FROM trips),
 picks AS (SELECT i AS pick, i * (total - 1) // (least(500, total) - 1) AS position
   FROM (SELECT max(total) AS total FROM placed), range(500) r(i) WHERE i < total)
SELECT trip_id, pickup_datetime, position, pick FROM placed JOIN picks USING (position)""",
    "drift_report": f"""{_TRIPS}, old AS (SELECT * FROM trips WHERE pickup_datetime < TIMESTAMP '2024-01-15'),
 recent AS (SELECT * FROM trips WHERE pickup_datetime >= TIMESTAMP '2024-01-15')
 {_TVD.format('old', _PROFILE.format('recent'))}
SELECT dimension AS feature, snap(tvd) AS statistic, 0.05e0 AS threshold, tvd > 0.05 AS drifted,
  CASE WHEN count(*) FILTER (WHERE tvd > 0.05) OVER () >= 2 THEN 'retrain'
       WHEN count(*) FILTER (WHERE tvd > 0.05) OVER () > 0 THEN 'alert' ELSE 'none' END AS action FROM tvd""",
    "drift_scores": f"""{ctes('holdout')}, old AS (SELECT * FROM holdout WHERE pickup_datetime < TIMESTAMP '2024-01-20'),
 recent AS (SELECT * FROM holdout WHERE pickup_datetime >= TIMESTAMP '2024-01-20')
 {_TVD.format('old', _PROFILE.format('recent'))},
 measured AS (SELECT 'actual_duration_seconds' AS feature, CAST(actual_duration_seconds AS DOUBLE) AS value, pickup_datetime < TIMESTAMP '2024-01-20' AS before FROM holdout
   UNION ALL SELECT 'rolling', rolling, pickup_datetime < TIMESTAMP '2024-01-20' FROM holdout),
 counted AS (SELECT feature, value, count(*) FILTER (WHERE before) AS p, count(*) FILTER (WHERE NOT before) AS q FROM measured GROUP BY feature, value),
 gaps AS (SELECT feature, abs(sum(p) OVER w / CAST(sum(p) OVER (PARTITION BY feature) AS DOUBLE) - sum(q) OVER w / CAST(sum(q) OVER (PARTITION BY feature) AS DOUBLE)) AS gap
   FROM counted WINDOW w AS (PARTITION BY feature ORDER BY value)),
 judged AS (SELECT dimension AS feature, tvd AS statistic FROM tvd UNION ALL SELECT feature, max(gap) FROM gaps GROUP BY feature)
SELECT feature, snap(statistic) AS statistic, 0.05e0 AS threshold, statistic > 0.05 AS drifted,
  CASE WHEN count(*) FILTER (WHERE statistic > 0.05) OVER () >= 2 THEN 'retrain'
       WHEN count(*) FILTER (WHERE statistic > 0.05) OVER () > 0 THEN 'alert' ELSE 'none' END AS action FROM judged""",
}
ORACLES = {name: snapped(sql) for name, sql in ORACLES.items()}
