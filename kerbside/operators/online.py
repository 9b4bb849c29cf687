"""Online zone snapshots: lookup outcomes, and choosing between two scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.functions import clock, numbers

# --- fixed values ---
STALENESS_SECONDS = 600
SNAPSHOT_TTL_SECONDS = 7200
SCHEMA_VERSION = "1.0"
# --- end of fixed values ---

UUID_PARTS = "^(.{8})(.{4})(.{4})(.{4})(.{12})$"

# The three snapshots a request needs, in the order they are judged.
SNAPSHOT_SLOTS = (
    ("short", "pickup", "15m", "pickup_zone_id"),
    ("long", "pickup", "60m", "pickup_zone_id"),
    ("dropoff", "dropoff", "60m", "dropoff_zone_id"),
)


def snapshot_is_valid(prefix: str = "") -> str:
    """SQL test of the online snapshot contract for columns under ``prefix``."""

    def c(name: str) -> str:
        return f"{prefix}{name}"

    start, end = clock.MICROS_OF.format(c("window_start")), clock.MICROS_OF.format(c("window_end"))
    source = clock.MICROS_OF.format(c("source_max_event_time"))
    means = [c(n) for n in ("mean_duration_seconds", "mean_speed_mph", "mean_distance_miles")]
    finite = " AND ".join(f"{m} IS NOT NULL AND {numbers.is_finite(m)} AND {m} >= 0" for m in means)
    length = (
        f"CASE {c('window_kind')} WHEN '15m' THEN {schemas.SHORT_WINDOW_SECONDS}L"
        f" WHEN '60m' THEN {schemas.LONG_WINDOW_SECONDS}L END * {clock.MICROS}"
    )
    versions = ", ".join(f"'{v}'" for v in schemas.FEATURES_BY_CONTRACT.values())
    zeros = " AND ".join(f"{m} = 0" for m in means)
    return (
        "coalesce("
        f"{c('zone_role')} IN ('pickup', 'dropoff')"
        f" AND {c('zone_id')} BETWEEN {schemas.ZONE_MIN} AND {schemas.ZONE_MAX}"
        f" AND {c('trip_count')} >= 0 AND {finite}"
        f" AND {end} - {start} = {length}"
        f" AND {clock.MICROS_OF.format(c('computed_at'))} >= {end}"
        f" AND {c('schema_version')} = '{SCHEMA_VERSION}'"
        f" AND {c('feature_model_version')} IN ({versions})"
        f" AND CASE WHEN {c('trip_count')} = 0"
        f" THEN {c('source_max_event_time')} IS NULL AND {zeros}"
        f" ELSE {c('source_max_event_time')} IS NOT NULL AND {source} >= {start} AND {source} < {end} END"
        ", false)"
    )


def latest_snapshots(
    snapshots: DataFrame,
    keys: Sequence[str] = ("feature_model_version", "zone_role", "zone_id", "window_kind"),
) -> DataFrame:
    """Newest window per key; on equal windows the one computed last.

    ``max_by`` combines before the shuffle, so a key with many versions sends
    one row per task.
    """
    rest = [name for name in snapshots.columns if name not in keys]
    return (
        snapshots.groupBy(*keys)
        .agg(
            F.expr(
                f"max_by(struct({', '.join(rest)}), struct(window_end, computed_at)) AS _newest"
            )
        )
        .selectExpr(*keys, "_newest.*")
    )


def unexpired(snapshots: DataFrame, now: str, ttl_seconds: int = SNAPSHOT_TTL_SECONDS) -> DataFrame:
    return snapshots.where(
        f"{clock.MICROS_OF.format(now)} < {clock.MICROS_OF.format('computed_at')}"
        f" + {ttl_seconds * clock.MICROS}"
    )


def feature_lookup(
    requests: DataFrame,
    snapshots: DataFrame,
    feature_model_version: str = "gold-features-v1",
    staleness_seconds: int = STALENESS_SECONDS,
) -> DataFrame:
    """Join each request with its three snapshots and name the outcome.

    ``snapshots`` holds one row per stored key: ``key_version``, ``key_role``,
    ``key_zone`` and ``key_window`` say where it is stored, the other columns
    what it claims. Of several the one with the latest window counts, so a side
    has at most one row per zone number (65,536) and is broadcast.
    """
    kept = snapshots.where(f"key_version = '{feature_model_version}'")
    joined = requests
    for slot, role, window, zone in SNAPSHOT_SLOTS:
        side = kept.where(f"key_role = '{role}' AND key_window = '{window}'").selectExpr(
            f"key_zone AS {zone}",
            f"struct(zone_role, zone_id, window_kind, window_start, window_end, computed_at,"
            " source_max_event_time, trip_count, mean_speed_mph, mean_duration_seconds,"
            f" mean_distance_miles, feature_model_version, schema_version) AS {slot}",
            f"{snapshot_is_valid()} AS {slot}_valid",
            "window_end IS NOT NULL AS _dated",
            "window_end AS _end",
            "computed_at AS _made",
        )
        side = (
            side.groupBy(zone)
            .agg(F.expr(f"max_by(struct({slot}, {slot}_valid), struct(_dated, _end, _made)) AS _latest"))
            .selectExpr(zone, f"_latest.{slot}", f"_latest.{slot}_valid")
        )
        joined = joined.join(F.broadcast(side), zone, "left")

    slots = [slot for slot, *_ in SNAPSHOT_SLOTS]
    missing = " OR ".join(f"{slot} IS NULL" for slot in slots)
    broken = " OR ".join(f"NOT {slot}_valid" for slot in slots)
    judged = []
    for slot, role, window, zone in SNAPSHOT_SLOTS:
        age = (
            f"({clock.MICROS_OF.format('pickup_time')}"
            f" - {clock.MICROS_OF.format(slot + '.window_end')})"
        )
        judged += [
            f"WHEN {slot}.feature_model_version <> '{feature_model_version}'"
            f" OR {slot}.zone_role <> '{role}' OR {slot}.zone_id <> {zone}"
            f" OR {slot}.window_kind <> '{window}' THEN 'invalid'",
            f"WHEN {age} < 0 THEN 'future'",
            f"WHEN {age} > {staleness_seconds * clock.MICROS} THEN 'stale'",
        ]
    outcome = (
        f"CASE WHEN {missing} THEN 'missing' WHEN {broken} THEN 'invalid' {' '.join(judged)}"
        " WHEN short.window_end <> long.window_end OR short.window_end <> dropoff.window_end"
        " THEN 'inconsistent'"
        " WHEN short.trip_count > long.trip_count THEN 'invalid'"
        " WHEN short.trip_count = 0 OR long.trip_count = 0 THEN 'empty'"
        " ELSE 'fresh' END AS outcome"
    )
    named = joined.selectExpr(*requests.columns, *slots, outcome)
    fresh = "CASE WHEN outcome = 'fresh' THEN {} END"
    return named.selectExpr(
        *requests.columns,
        "outcome",
        fresh.format("CAST(short.trip_count AS BIGINT)") + " AS pu_zone_trips_15m",
        fresh.format("short.mean_speed_mph") + " AS pu_zone_mean_speed_15m",
        fresh.format("long.mean_duration_seconds") + " AS pu_zone_mean_duration_60m",
        fresh.format("CAST(dropoff.trip_count AS BIGINT)") + " AS do_zone_trips_60m",
        fresh.format("short.window_end") + " AS features_as_of",
        fresh.format(
            f"({clock.MICROS_OF.format('pickup_time')}"
            f" - {clock.MICROS_OF.format('short.window_end')}) / 1e6D"
        )
        + " AS age_seconds",
    )


def request_features(requests: DataFrame, zone: str = clock.LOCAL_ZONE) -> DataFrame:
    """The five static features of a request; ``pickup_time`` is a UTC wall clock."""
    local = clock.to_local("pickup_time", zone)
    return requests.selectExpr(
        "trip_id",
        "pickup_zone_id",
        "dropoff_zone_id",
        f"{clock.HOUR_OF_WEEK_SUNDAY.format(local)} AS pickup_hour_of_week",
        "trip_distance_miles",
        "passenger_count",
    )


def score_select(
    looked_up: DataFrame,
    *,
    static_score: str = "static_score",
    rolling_score: str = "rolling_score",
    static_version: str,
    rolling_version: str,
    static_primary: bool = False,
    feature_model_version: str = "gold-features-v1",
) -> DataFrame:
    """Use the rolling score where the lookup is fresh, else fall back and say so.

    A rejected row has no estimate and a ``rejection``.
    """
    rolling = "false" if static_primary else "outcome = 'fresh'"
    version_two = "true" if feature_model_version == "gold-features-v2" else "false"
    chosen = looked_up.selectExpr(
        "*",
        f"{rolling} AS _rolling",
        f"CAST(CASE WHEN {rolling} THEN {rolling_score} ELSE {static_score} END AS DOUBLE) AS _score",
    )
    rejection = (
        f"CASE WHEN passenger_count IS NULL AND NOT {version_two} THEN 'unknown_passenger_count'"
        f" WHEN _score IS NULL OR NOT {numbers.is_finite('_score')} OR _score <= 0"
        " THEN 'invalid_estimate' END"
    )
    return chosen.selectExpr(
        *looked_up.columns,
        f"CASE WHEN _rolling THEN '{rolling_version}' ELSE '{static_version}' END AS model_version",
        "NOT _rolling AS feature_fallback",
        f"CASE WHEN {rejection} IS NULL THEN _score END AS estimated_duration_seconds",
        f"{rejection} AS rejection",
        "'" + ("1.1" if feature_model_version == "gold-features-v2" else "1.0") + "' AS schema_version",
    )


def prediction_messages(scored: DataFrame, served_at: str) -> DataFrame:
    """Accepted scores as prediction messages with the features they used.

    ``served_at`` and ``features_as_of`` are UTC wall clocks; messages carry them
    with their offset. The identity has the shape of a UUID and names trip, model
    and time, so that a repeated message has the same one.
    """
    static = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in schemas.STATIC_FEATURES)
    rolling = ", ".join(f"'{n}', CAST({n} AS DOUBLE)" for n in schemas.ROLLING_FEATURES)
    times = ", ".join(f"'{n}', CAST(features_as_of AS TIMESTAMP)" for n in schemas.ROLLING_FEATURES)
    digest = f"sha2(concat_ws(':', trip_id, model_version, {clock.MICROS_OF.format(served_at)}), 256)"
    return scored.where("rejection IS NULL").selectExpr(
        f"regexp_replace(substring({digest}, 1, 32), '{UUID_PARTS}', '$1-$2-$3-$4-$5') AS prediction_id",
        "trip_id",
        "model_version",
        f"CASE WHEN feature_fallback THEN map({static}) ELSE map({static}, {rolling}) END"
        " AS features_used",
        f"map_filter(map({times}), (k, v) -> v IS NOT NULL) AS feature_timestamps",
        "feature_fallback",
        "estimated_duration_seconds",
        f"CAST({served_at} AS TIMESTAMP) AS served_at",
        "schema_version",
    )
