"""Trips, samples, messages and logs derived from the given tables.

Every adapter is a list of column expressions over one table or over another
adapter. The text is shared by Spark and by the SQL the results are checked
against; only the few functions in ``Dialect`` differ.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from kerbside.functions.clock import Month

MONTH = Month.parse("2024-01")
SPLIT = datetime(2024, 1, 15)
SECONDS = "(60 + (event_id * 7919) % 10741)"


@dataclass(frozen=True)
class Dialect:
    name: str

    def later(self, ts: str, seconds: str) -> str:
        if self.name == "spark":
            return f"{ts} + make_dt_interval(0, 0, 0, {seconds})"
        return f"{ts} + to_seconds({seconds})"

    def sha256(self, text: str) -> str:
        return f"sha2({text}, 256)" if self.name == "spark" else f"sha256({text})"

    def stamp(self, text: str) -> str:
        kind = "TIMESTAMP_NTZ" if self.name == "spark" else "TIMESTAMP"
        return f"{kind}'{text}'"

    def repeat(self, count: str) -> str:
        """A column that yields ``count`` rows numbered from 0."""
        if self.name == "spark":
            return f"explode(sequence(0, CAST({count} AS INT) - 1))"
        return f"CAST(unnest(range({count})) AS INTEGER)"


SPARK, DUCK = Dialect("spark"), Dialect("duckdb")


def _definitions(d: Dialect) -> dict[str, tuple[str, list[str], str | None]]:
    """name -> (source, column expressions, filter over the source)."""
    success = "outcome = 'success'"
    definitions: dict[str, tuple[str, list[str], str | None]] = {}
    definitions["trips"] = (
        "events",
        [
            "'e:' || event_id AS trip_id",
            "ts AS pickup_datetime",
            f"{d.later('ts', SECONDS)} AS dropoff_datetime",
            "CAST(user_id % 20 + 1 AS SMALLINT) AS pickup_zone_id",
            "CAST(event_id * 31 % 20 + 1 AS SMALLINT) AS dropoff_zone_id",
            "value / 10e0 AS trip_distance_miles",
            "CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 10 END AS SMALLINT) AS passenger_count",
            "value AS fare_amount",
            f"CAST({SECONDS} AS INTEGER) AS actual_duration_seconds",
            "event_id AS source_row_number",
            "'1.1' AS contract_version",
        ],
        None,
    )
    # Rows that break each rule, lack each field, or belong to another month.
    moved = "CASE WHEN event_id % 353 = 0 THEN ts - INTERVAL 40 DAYS ELSE ts END"
    definitions["raw_trips"] = (
        "events",
        [
            f"CASE WHEN event_id % 307 = 0 THEN NULL ELSE {moved} END AS tpep_pickup_datetime",
            f"CASE WHEN event_id % 311 = 0 THEN NULL WHEN event_id % 79 = 0 THEN {moved}"
            f" ELSE {d.later(f'({moved})', SECONDS)} END AS tpep_dropoff_datetime",
            "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 73 = 0 THEN 1.5e0"
            " ELSE CAST(event_id % 10 AS DOUBLE) END AS passenger_count",
            "CASE WHEN event_id % 313 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 101e0 ELSE value / 10e0 END AS trip_distance",
            "CASE WHEN event_id % 317 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST(0 AS BIGINT)"
            " ELSE user_id % 20 + 1 END AS PULocationID",
            "CASE WHEN event_id % 331 = 0 THEN NULL WHEN event_id % 337 = 0 THEN CAST(0 AS BIGINT)"
            " WHEN event_id % 347 = 0 THEN CAST(266 AS BIGINT) ELSE event_id * 31 % 20 + 1 END AS DOLocationID",
            "CASE WHEN event_id % 359 = 0 THEN NULL WHEN event_id % 83 = 0 THEN -1e0 ELSE value END AS fare_amount",
            "event_id AS source_row_number",
        ],
        None,
    )
    # The same with numbers that are none.
    definitions["unreal_trips"] = (
        "raw_trips",
        [
            "tpep_pickup_datetime",
            "tpep_dropoff_datetime",
            "CASE WHEN source_row_number % 367 = 0 THEN CAST('NaN' AS DOUBLE) ELSE passenger_count END AS passenger_count",
            "CASE WHEN source_row_number % 373 = 0 THEN CAST('NaN' AS DOUBLE) ELSE trip_distance END AS trip_distance",
            "PULocationID",
            "DOLocationID",
            "CASE WHEN source_row_number % 349 = 0 THEN CAST('NaN' AS DOUBLE)"
            " WHEN source_row_number % 379 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE fare_amount END AS fare_amount",
            "source_row_number",
        ],
        None,
    )
    definitions["holdout"] = (
        "events",
        [
            "'e:' || event_id AS trip_id",
            "event_id",
            "ts AS pickup_datetime",
            "CAST(user_id % 20 + 1 AS SMALLINT) AS pickup_zone_id",
            "CAST(event_id * 31 % 20 + 1 AS SMALLINT) AS dropoff_zone_id",
            "value / 10e0 AS trip_distance_miles",
            "CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 10 END AS SMALLINT) AS passenger_count",
            f"CAST({SECONDS} AS INTEGER) AS actual_duration_seconds",
            "CAST(900 + event_id * 13 % 4000 AS DOUBLE) AS baseline",
            f"{SECONDS} * 0.9e0 + event_id % 200 AS static",
            f"{SECONDS} * 0.95e0 + event_id % 100 AS rolling",
        ],
        f"ts >= {d.stamp(str(SPLIT))}",
    )
    definitions["samples"] = (
        "events",
        [
            "event_id AS sequence",
            "'e:' || event_id AS trip_id",
            "event_id / 100e0 AS scheduled_offset_seconds",
            "event_id % 7 * 0.25e0 AS dispatch_lag_ms",
            "CASE WHEN event_id % 101 = 0 THEN NULL ELSE value END AS latency_ms",
            "CASE WHEN event_id % 101 = 0 THEN NULL ELSE value * 0.9e0 END AS http_latency_ms",
            "CAST(CASE WHEN event_id % 101 = 0 OR event_id % 59 = 0 THEN NULL"
            " WHEN event_type = 'error' THEN 503 ELSE 200 END AS INTEGER) AS status_code",
            "CASE WHEN event_id % 101 = 0 THEN 'load_generator_overflow'"
            " WHEN event_id % 59 = 0 THEN 'timeout'"
            " WHEN event_type = 'error' THEN 'http_error' ELSE 'success' END AS outcome",
        ],
        None,
    )
    definitions["answered"] = (
        "samples",
        [
            "*",
            f"CASE WHEN {success} THEN sequence % 3 = 0 END AS feature_fallback",
            f"CASE WHEN {success} THEN CASE WHEN sequence % 3 = 0 THEN 'm-static' ELSE 'm-rolling' END END AS model_version",
            f"CASE WHEN {success} THEN 'p:' || sequence END AS prediction_id",
            f"CASE WHEN {success} THEN " + d.sha256("'payload:' || sequence") + " END AS prediction_sha256",
            f"CASE WHEN {success} THEN 'acknowledged' WHEN outcome = 'http_error' THEN 'unconfirmed' END AS publication",
        ],
        None,
    )
    # What a broker holds: some messages lost, doubled, altered, misaddressed or foreign.
    definitions["published"] = (
        "samples",
        [
            # some records cannot be read at all, others break their contract
            "CASE WHEN sequence % 53 = 0 THEN NULL ELSE 'p:' || sequence END AS prediction_id",
            "CASE WHEN sequence % 53 = 0 THEN NULL WHEN sequence % 43 = 0 THEN 'x:' || sequence ELSE trip_id END AS trip_id",
            "CASE WHEN sequence % 3 = 0 THEN 'm-static' ELSE 'm-rolling' END AS model_version",
            "sequence % 3 = 0 AS feature_fallback",
            d.sha256("CASE WHEN sequence % 41 = 0 THEN 'altered:' ELSE 'payload:' END || sequence")
            + " AS payload_sha256",
            "sequence % 47 <> 0 AS envelope_ok",
            "sequence % 53 <> 0 AND sequence % 29 <> 0 AS is_valid",
            d.repeat("CASE WHEN sequence % 37 = 0 THEN 2 ELSE 1 END") + " AS copy",
        ],
        f"({success} AND sequence % 31 <> 0) OR (outcome = 'http_error' AND sequence % 5 = 0)",
    )
    # ETA requests around the end of the 14th, some before it, some long after.
    definitions["requests"] = (
        "events",
        [
            "'e:' || event_id AS trip_id",
            "event_id",
            "CAST(user_id % 20 + 1 AS SMALLINT) AS pickup_zone_id",
            "CAST(event_id * 31 % 20 + 1 AS SMALLINT) AS dropoff_zone_id",
            f"{d.later(d.stamp(str(SPLIT)), '(event_id * 17 % 900 - 100)')} AS pickup_time",
            "value / 10e0 AS trip_distance_miles",
            "CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 10 END AS SMALLINT) AS passenger_count",
            f"CASE WHEN event_id % 61 = 0 THEN -5e0 ELSE {SECONDS} * 0.9e0 END AS static_score",
            f"{SECONDS} * 0.95e0 AS rolling_score",
        ],
        None,
    )
    return definitions


def frame(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A given table, or an adapter over one, as a DataFrame."""
    definitions = _definitions(SPARK)
    if name not in definitions:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    source, columns, condition = definitions[name]
    rows = frame(spark, folder, source)
    if condition:
        rows = rows.where(condition)
    return rows.selectExpr(*columns)


def ctes(*names: str) -> str:
    """``WITH`` text that defines the named adapters and what they build on."""
    definitions = _definitions(DUCK)
    needed: list[str] = []

    def visit(name: str) -> None:
        if name in definitions and name not in needed:
            visit(definitions[name][0])
            needed.append(name)

    for name in names:
        visit(name)
    parts = []
    for name in needed:
        source, columns, condition = definitions[name]
        where = f" WHERE {condition}" if condition else ""
        parts.append(f"{name} AS (SELECT {', '.join(columns)} FROM {source}{where})")
    return "WITH " + ",\n".join(parts)


# Engines disagree on decimal ties, so doubles are cut to millionths at an offset no tie has.
SNAP = "floor(({0}) * 1e6 + 0.3137e0) / 1e6"


def rounded(rows: DataFrame) -> DataFrame:
    """Doubles cut to millionths, so that summation order cannot show."""
    return rows.selectExpr(
        *[
            f"{SNAP.format(f'`{name}`')} AS `{name}`" if kind == "double" else f"`{name}`"
            for name, kind in rows.dtypes
        ]
    )


def snapped(sql: str) -> str:
    """Spell every ``snap(...)`` of an oracle out the same way."""
    while "snap(" in sql:
        start = sql.index("snap(")
        depth, end = 1, start + 5
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = sql[:start] + SNAP.format(sql[start + 5 : end - 1]) + sql[end:]
    return sql
