"""Row rules, the partition gate, and data tests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError, MissingColumns
from kerbside.functions import clock
from kerbside.functions.clock import Month

# --- fixed values: rule names in report order, and their bounds ---
RULES = (
    "required_fields",
    "pickup_before_dropoff",
    "duration_range",
    "distance_range",
    "passenger_count_range",
    "known_pickup_zone",
    "known_dropoff_zone",
    "non_negative_fare",
    "timestamps_in_partition",
)
ANY_RULE = "any_contract_violation"
DURATION_SECONDS = (60, 10_800)
DISTANCE_MILES = (0.0, 100.0)
PASSENGERS = (0.0, 9.0)
DEFAULT_THRESHOLD = 0.10
# --- end of fixed values ---

DEFAULT_ZONES = range(schemas.ZONE_MIN, schemas.ZONE_MAX + 1)


def require_columns(frame: DataFrame, wanted: Iterable[str]) -> DataFrame:
    missing = sorted(set(wanted) - set(frame.columns))
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return frame


def contract_for(policy: str) -> str:
    if policy not in schemas.CONTRACT_BY_POLICY:
        raise DataContractError(f"unknown passenger count policy: {policy}")
    return schemas.CONTRACT_BY_POLICY[policy]


def _unless_null(condition: str, *inputs: str) -> str:
    """A rule about missing inputs passes: missing values are counted once, elsewhere."""
    missing = " OR ".join(f"{name} IS NULL" for name in inputs)
    return f"({missing} OR coalesce({condition}, false))"


def rule_expressions(
    month: Month, policy: str = "required", zones: Iterable[int] = DEFAULT_ZONES
) -> dict[str, str]:
    """One boolean SQL expression per rule, true when the row passes."""
    contract_for(policy)
    pickup, dropoff = "tpep_pickup_datetime", "tpep_dropoff_datetime"
    passengers, miles, fare = "passenger_count", "trip_distance", "fare_amount"
    needed = [
        name
        for name in schemas.BRONZE_COLUMNS
        if not (name == passengers and policy == "allow_unknown")
    ]
    micros = f"({clock.MICROS_OF.format(dropoff)} - {clock.MICROS_OF.format(pickup)})"
    shortest, longest = (seconds * clock.MICROS for seconds in DURATION_SECONDS)
    known = sorted({int(zone) for zone in zones})

    def in_zones(column: str) -> str:
        if known and known[-1] - known[0] == len(known) - 1:
            return f"{column} BETWEEN {known[0]} AND {known[-1]}"
        return f"{column} IN ({', '.join(map(str, known)) or 'NULL'})"

    # NaN compares above every number, so upper bounds reject it; the fare has none.
    return {
        "required_fields": "(" + " AND ".join(f"{name} IS NOT NULL" for name in needed) + ")",
        "pickup_before_dropoff": _unless_null(f"{pickup} < {dropoff}", pickup, dropoff),
        "duration_range": _unless_null(f"{micros} BETWEEN {shortest} AND {longest}", pickup, dropoff),
        "distance_range": _unless_null(
            f"CAST({miles} AS DOUBLE) BETWEEN {DISTANCE_MILES[0]}D AND {DISTANCE_MILES[1]}D", miles
        ),
        "passenger_count_range": _unless_null(
            f"CAST({passengers} AS DOUBLE) BETWEEN {PASSENGERS[0]}D AND {PASSENGERS[1]}D"
            f" AND CAST({passengers} AS DOUBLE) % 1 = 0",
            passengers,
        ),
        "known_pickup_zone": _unless_null(in_zones("PULocationID"), "PULocationID"),
        "known_dropoff_zone": _unless_null(in_zones("DOLocationID"), "DOLocationID"),
        "non_negative_fare": _unless_null(
            f"NOT isnan(CAST({fare} AS DOUBLE)) AND CAST({fare} AS DOUBLE) >= 0", fare
        ),
        "timestamps_in_partition": _unless_null(
            f"{clock.within(pickup, month.start, month.end)}"
            f" AND {clock.within(dropoff, month.start, month.end)}",
            pickup,
            dropoff,
        ),
    }


def rule_masks(
    bronze: DataFrame,
    month: Month,
    policy: str = "required",
    zones: Iterable[int] = DEFAULT_ZONES,
) -> DataFrame:
    """``bronze`` with one boolean ``passes_<rule>`` per rule and ``row_valid``."""
    require_columns(bronze, schemas.BRONZE_COLUMNS)
    rules = rule_expressions(month, policy, zones)
    masked = bronze.selectExpr("*", *[f"{test} AS passes_{rule}" for rule, test in rules.items()])
    return masked.selectExpr("*", " AND ".join(f"passes_{r}" for r in RULES) + " AS row_valid")


def silver_rows(masked: DataFrame, month: Month, policy: str = "required") -> DataFrame:
    """Valid rows under the fixed silver schema."""
    seconds = clock.SECONDS_BETWEEN.format("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return masked.where("row_valid").selectExpr(
        f"concat_ws(':', '{schemas.FLEET}', '{month}', source_row_number) AS trip_id",
        "CAST(tpep_pickup_datetime AS TIMESTAMP_NTZ) AS pickup_datetime",
        "CAST(tpep_dropoff_datetime AS TIMESTAMP_NTZ) AS dropoff_datetime",
        "CAST(PULocationID AS SMALLINT) AS pickup_zone_id",
        "CAST(DOLocationID AS SMALLINT) AS dropoff_zone_id",
        "CAST(trip_distance AS DOUBLE) AS trip_distance_miles",
        "CAST(passenger_count AS SMALLINT) AS passenger_count",
        "CAST(fare_amount AS DOUBLE) AS fare_amount",
        f"{seconds} AS actual_duration_seconds",
        "CAST(source_row_number AS BIGINT) AS source_row_number",
        f"'{contract_for(policy)}' AS contract_version",
    )


def invalid_rows(masked: DataFrame) -> DataFrame:
    """Rejected rows with one ``violates_<rule>`` flag per rule."""
    return masked.where("NOT row_valid").selectExpr(
        *schemas.BRONZE_COLUMNS,
        "source_row_number",
        *[f"NOT passes_{rule} AS violates_{rule}" for rule in RULES],
    )


def violation_counts(masked: DataFrame) -> DataFrame:
    """One row with all counts of a partition; combined before the only shuffle."""
    return masked.agg(*violation_measures())


def violation_measures() -> list[Column]:
    """The counts of a partition as aggregates over its masked rows."""
    return [
        F.expr("count(1) AS total_rows"),
        F.expr("count_if(row_valid) AS valid_rows"),
        F.expr(f"count_if(NOT row_valid) AS {ANY_RULE}"),
        F.expr("count_if(passenger_count IS NULL) AS missing_passenger_rows"),
        F.expr("count_if(passenger_count IS NULL AND row_valid) AS valid_missing_passenger_rows"),
        *[F.expr(f"count_if(NOT passes_{rule}) AS {rule}") for rule in RULES],
    ]


def _check_threshold(threshold: float) -> float:
    if not 0 <= threshold <= 1:
        raise DataContractError("the violation threshold lies between 0 and 1")
    return float(threshold)


def partition_gate(counts: DataFrame, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Totals, violation rate and decision of a partition; an empty one is quarantined."""
    limit = _check_threshold(threshold)
    rate = f"CASE WHEN total_rows > 0 THEN {ANY_RULE} / total_rows ELSE 0D END"
    return counts.selectExpr(
        "total_rows",
        "valid_rows",
        f"{ANY_RULE} AS invalid_rows",
        f"{rate} AS violation_rate",
        f"{limit!r}D AS max_violation_rate",
        f"CASE WHEN total_rows > 0 AND {rate} <= {limit!r}D THEN 'accepted'"
        " ELSE 'quarantined' END AS status",
    )


def missing_counts(counts: DataFrame) -> DataFrame:
    return counts.select("total_rows", "missing_passenger_rows", "valid_missing_passenger_rows")


def quality_checks(
    counts: DataFrame, month: Month, policy: str = "required", threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """One row per rule, and one for rows that break any rule."""
    limit = _check_threshold(threshold)
    names = (ANY_RULE, *RULES)
    pairs = ", ".join(f"'{name}', {name}" for name in names)
    return counts.selectExpr(
        f"stack({len(names)}, {pairs}) AS (rule, violations)", "total_rows"
    ).selectExpr(
        f"'{month}' AS `partition`",
        "rule",
        "violations",
        "total_rows",
        f"{limit!r}D AS threshold",
        "CASE WHEN total_rows > 0 THEN violations / total_rows ELSE 0D END"
        f" <= {limit!r}D AS passed",
        f"'{contract_for(policy)}' AS contract_version",
    )


def partition_report(
    counts: DataFrame,
    month: Month,
    source: str,
    policy: str = "required",
    threshold: float = DEFAULT_THRESHOLD,
) -> DataFrame:
    """The whole report of a partition as one row, its checks nested."""
    limit = f"{_check_threshold(threshold)!r}D"

    def rate(count: str) -> str:
        return f"CASE WHEN total_rows > 0 THEN {count} / total_rows ELSE 0D END"

    checks = ", ".join(
        f"struct('{name}' AS rule, {name} AS violations, {limit} AS threshold,"
        f" {rate(name)} <= {limit} AS passed)"
        for name in (ANY_RULE, *RULES)
    )
    return counts.selectExpr(
        f"'{month}' AS month",
        f"'{contract_for(policy)}' AS contract_version",
        f"CASE WHEN total_rows > 0 AND {rate(ANY_RULE)} <= {limit} THEN 'accepted'"
        " ELSE 'quarantined' END AS status",
        "total_rows",
        "valid_rows",
        f"{ANY_RULE} AS invalid_rows",
        f"{rate(ANY_RULE)} AS violation_rate",
        f"{limit} AS max_violation_rate",
        "missing_passenger_rows",
        "valid_missing_passenger_rows",
        f"array({checks}) AS checks",
        "current_timestamp() AS evaluated_at",
    ).withColumn("source_path", F.lit(source))


def report_consistency(reports: DataFrame) -> DataFrame:
    """Boolean columns telling which internal rules each partition report keeps."""
    rate = "CASE WHEN total_rows > 0 THEN invalid_rows / total_rows ELSE 0D END"
    checks = {
        "missing_supplied_together": (
            "(missing_passenger_rows IS NULL) = (valid_missing_passenger_rows IS NULL)"
        ),
        "missing_within_total": "coalesce(missing_passenger_rows <= total_rows, true)",
        "valid_missing_within_counts": (
            "coalesce(valid_missing_passenger_rows <= least(missing_passenger_rows, valid_rows), true)"
        ),
        "strict_has_no_unknown": (
            "NOT (contract_version = '1.0' AND coalesce(valid_missing_passenger_rows, 0) <> 0)"
        ),
        "counts_add_up": "valid_rows + invalid_rows = total_rows",
        "rate_agrees": f"abs(violation_rate - {rate}) <= 1e-12D",
        "status_agrees": (
            f"(status = 'accepted') = (total_rows > 0 AND {rate} <= max_violation_rate)"
        ),
    }
    judged = reports.selectExpr("*", *[f"{test} AS {name}" for name, test in checks.items()])
    return judged.selectExpr("*", " AND ".join(checks) + " AS consistent")


# --- fixed values: gold columns that may not be NULL ---
GOLD_NOT_NULL = (
    "trip_id",
    "pickup_datetime",
    "pickup_zone_id",
    "dropoff_zone_id",
    "actual_duration_seconds",
    "pu_zone_trips_15m",
    "pu_zone_trips_60m",
    "do_zone_trips_60m",
    "contract_version",
    "feature_model_version",
)
# --- end of fixed values ---


def null_counts(frame: DataFrame, columns: Iterable[str] = GOLD_NOT_NULL) -> DataFrame:
    """Long form: NULLs per column, from one aggregate."""
    columns = list(columns)
    one = frame.agg(*[F.expr(f"count_if({name} IS NULL) AS {name}") for name in columns])
    pairs = ", ".join(f"'{name}', {name}" for name in columns)
    return one.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, null_rows)")


def duplicates(frame: DataFrame, column: str) -> DataFrame:
    return (
        frame.groupBy(column).agg(F.expr("count(1) AS copies")).where("copies > 1")
    )


def outside_values(frame: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    return frame.where(outside(column, values))


def outside(column: str, values: Iterable[str]) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return f"{column} NOT IN ({listed})"


NEGATIVE_COUNTS = "pu_zone_trips_15m < 0 OR pu_zone_trips_60m < 0 OR do_zone_trips_60m < 0"
LEAKING = " OR ".join(
    f"{name} >= pickup_datetime"
    for name in ("pu_zone_features_15m_as_of", "pu_zone_features_60m_as_of", "do_zone_features_60m_as_of")
)


def negative_counts(gold: DataFrame) -> DataFrame:
    return gold.where(NEGATIVE_COUNTS)


def leaking_rows(gold: DataFrame) -> DataFrame:
    """Rows whose features saw the pickup instant or later."""
    return gold.where(LEAKING)


def contract_disagreements(gold: DataFrame) -> DataFrame:
    return gold.where(contract_disagreement())


def contract_disagreement() -> str:
    versions = " OR ".join(
        f"(contract_version = '{contract}' AND feature_model_version <> '{features}')"
        for contract, features in schemas.FEATURES_BY_CONTRACT.items()
    )
    known = ", ".join(f"'{name}'" for name in schemas.FEATURES_BY_CONTRACT)
    return (
        "(contract_version = '1.0' AND passenger_count IS NULL)"
        " OR passenger_count < 0 OR passenger_count > 9"
        f" OR {versions} OR contract_version NOT IN ({known})"
    )


def passenger_violations(gold: DataFrame) -> DataFrame:
    """Gold rows a model may not be trained on."""
    return gold.where(
        "(feature_model_version = 'gold-features-v1' AND passenger_count IS NULL)"
        " OR NOT coalesce(passenger_count BETWEEN 0 AND 9 AND passenger_count % 1 = 0, true)"
    )


def version_gate(
    inputs: DataFrame, supported: Iterable[str], column: str = "contract_version", by: str = "input"
) -> DataFrame:
    """Per input: distinct versions, and whether exactly one supported one is present.

    ``versions_agree`` compares all inputs. Sets hold distinct values only and
    are combined before the shuffle.
    """
    listed = ", ".join(f"'{name}'" for name in supported)
    per_input = inputs.groupBy(by).agg(
        F.expr(f"count(DISTINCT {column}) AS versions"),
        F.expr(f"count_if({column} IS NULL) AS null_versions"),
        F.expr(f"count_if({column} NOT IN ({listed})) AS unsupported_rows"),
        F.expr(f"min({column}) AS lowest"),
        F.expr(f"max({column}) AS highest"),
    )
    return per_input.selectExpr(
        by,
        "versions",
        "null_versions",
        "unsupported_rows",
        "versions = 1 AND null_versions = 0 AND unsupported_rows = 0 AS single_supported",
        # One row per input: there are as many as months.
        "min(lowest) OVER () = max(highest) OVER () AS versions_agree",
    )


def known_zone_rows(trips: DataFrame, zones: DataFrame, column: str) -> DataFrame:
    """Trips whose zone is in a zone dimension.

    The dimension is joined by size: Spark broadcasts it when it is small.
    """
    return trips.join(zones, trips[column] == zones["zone_id"], "left_semi")

