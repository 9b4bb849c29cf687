"""Queries over raw trips: rules, gate, reports, identities, lineage."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog import messages
from kerbside.catalog.inputs import MONTH, ctes, frame, rounded, snapped
from kerbside.functions import digests
from kerbside.operators import contracts, lineage, quality
from kerbside.sources import files

ALLOW = "allow_unknown"


def _masked(spark, folder, policy=ALLOW):
    return quality.rule_masks(frame(spark, folder, "raw_trips"), MONTH, policy)


def _counts(spark, folder, policy=ALLOW):
    return quality.violation_counts(_masked(spark, folder, policy))


def _rule_masks(spark, folder):
    masked = quality.rule_masks(frame(spark, folder, "unreal_trips"), MONTH, ALLOW)
    return masked.select(
        "source_row_number", *[f"passes_{rule}" for rule in quality.RULES], "row_valid"
    )


def _valid_split(spark, folder):
    both = [
        _masked(spark, folder, policy)
        .groupBy("row_valid")
        .agg(F.expr("count(1) AS rows"), F.expr("CAST(sum(source_row_number) AS BIGINT) AS row_number_sum"))
        .selectExpr(f"'{policy}' AS policy", "*")
        for policy in ("required", ALLOW)
    ]
    return both[0].unionByName(both[1])


def _gates(spark, folder):
    gates = [
        quality.partition_gate(_counts(spark, folder, policy)).selectExpr(f"'{policy}' AS policy", "*")
        for policy in ("required", ALLOW)
    ]
    return rounded(gates[0].unionByName(gates[1]))


def _reports(spark, folder):
    """One partition report per user, some with a planted inconsistency."""
    return frame(spark, folder, "events").groupBy("user_id").agg(*_report_columns()).selectExpr(
        "*",
        "CASE WHEN user_id % 9 = 4 THEN violation_rate + 1e-9 ELSE violation_rate END AS rate_",
    ).drop("violation_rate").withColumnRenamed("rate_", "violation_rate")


def _report_columns():
    invalid = "count_if(event_id % 7 = 0)"
    return [
        F.expr("count(1) AS total_rows"),
        F.expr(f"count(1) - {invalid} + CASE WHEN user_id % 13 = 1 THEN 1 ELSE 0 END AS valid_rows"),
        F.expr(f"{invalid} AS invalid_rows"),
        F.expr(f"{invalid} / count(1) AS violation_rate"),
        F.expr("0.15D AS max_violation_rate"),
        F.expr(
            "CASE WHEN user_id % 5 = 0 THEN NULL ELSE count_if(event_id % 11 = 0) END AS missing_passenger_rows"
        ),
        F.expr(
            "CASE WHEN user_id % 5 = 0 AND user_id % 10 <> 0 THEN NULL"
            " ELSE count_if(event_id % 11 = 0 AND event_id % 7 <> 0) END AS valid_missing_passenger_rows"
        ),
        F.expr("CASE WHEN user_id % 17 = 3 THEN '1.0' ELSE '1.1' END AS contract_version"),
        F.expr(
            f"CASE WHEN user_id % 19 = 5 THEN 'accepted' WHEN {invalid} / count(1) <= 0.15D"
            " THEN 'accepted' ELSE 'quarantined' END AS status"
        ),
    ]


def _report_consistency(spark, folder):
    return quality.report_consistency(_reports(spark, folder)).select(
        "user_id",
        "missing_supplied_together",
        "missing_within_total",
        "valid_missing_within_counts",
        "strict_has_no_unknown",
        "counts_add_up",
        "rate_agrees",
        "status_agrees",
        "consistent",
    )


def _run_log(spark, folder):
    """Lifecycle records per event: every run starts, most end once, some break the rules."""
    return frame(spark, folder, "events").selectExpr(
        "'r:' || event_id AS run_id",
        """inline(filter(array(
            CASE WHEN event_id % 29 <> 0 THEN struct(1 AS seq, 'running' AS status, ts AS at,
                 CAST(NULL AS BIGINT) AS total_rows) END,
            CASE WHEN event_id % 4 <> 3 THEN struct(2 AS seq,
                 CASE event_id % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN 'quarantined' ELSE 'failed' END AS status,
                 ts + make_dt_interval(0, 0, 0, 8) AS at, event_id AS total_rows) END,
            CASE WHEN event_id % 37 = 0 THEN struct(3 AS seq, 'failed' AS status,
                 ts + make_dt_interval(0, 0, 0, 9) AS at, CAST(NULL AS BIGINT) AS total_rows) END
        ), x -> x IS NOT NULL))""",
    )


def _run_checks(spark, folder):
    events = frame(spark, folder, "events")
    runs = events.selectExpr("'r:' || event_id AS run_id", "'2024-01' AS partition_key")
    # A fiftieth of the checks names a run that nobody started.
    checks = events.selectExpr(
        "CASE WHEN event_id % 50 = 7 THEN 'unknown:' || event_id ELSE 'r:' || (event_id - event_id % 5) END AS run_id",
        "'rule_' || (event_id % 5) AS rule",
        "event_id % 13 AS violations",
        "100L AS total_rows",
        "0.1D AS threshold",
        "event_id % 13 <= 10 AS passed",
        "'1.1' AS contract_version",
    )
    return lineage.run_checks(runs, checks)


def _contract_lineage(spark, folder):
    runs = frame(spark, folder, "events").selectExpr(
        "event_id",
        "CASE event_id % 6 WHEN 0 THEN 'running' WHEN 1 THEN 'accepted' WHEN 2 THEN 'quarantined'"
        " WHEN 3 THEN 'failed' WHEN 4 THEN 'accepted' ELSE CASE WHEN event_id % 41 = 0 THEN 'lost' ELSE 'failed' END END AS status",
        "CASE WHEN event_id % 6 = 0 AND event_id % 5 <> 0 THEN NULL WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS finished_at",
        "CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS total_rows",
        "event_id - event_id % 4 AS valid_rows",
        "event_id % 4 + CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END AS invalid_rows",
        "CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 103 / 100D END AS violation_rate",
    )
    return contracts.lineage_violations(runs).selectExpr(
        "event_id", "array_join(failed_rules, ',') AS failed_rules"
    )


def _file_manifest(spark, folder):
    return files.file_manifest(spark, f"{folder}/*.parquet").select(
        "file_name", "size_bytes", "sha256", "is_parquet"
    )


def _digest_check(spark, folder):
    """Manifests that claim the digests of the given files, one of them wrongly."""
    found = files.file_manifest(spark, f"{folder}/*.parquet")
    claimed = found.selectExpr(
        "path",
        "size_bytes",
        "CASE WHEN file_name = 'labels.parquet' THEN sha2(file_name, 256) ELSE sha256 END AS sha256",
    )
    return files.verify_manifest(claimed, found).selectExpr(
        "element_at(split(path, '/'), -1) AS file_name", "verified"
    )


def _lineage_chain(spark, folder):
    """A run per event on the gold month of its user, with mix-ups of month, gold and silver."""
    events = frame(spark, folder, "events")
    users = events.select("user_id").distinct()
    training = events.selectExpr(
        "event_id AS run_id",
        "'month-' || user_id AS holdout_month",
        "CASE WHEN event_id % 13 = 0 THEN 'other' ELSE 'gold-' || user_id END AS holdout_sha256",
    )
    gold = users.selectExpr("'month-' || user_id AS month", "'gold-' || user_id AS output_sha256")
    gold_inputs = users.selectExpr(
        "'month-' || user_id AS month",
        "explode(array('month-' || user_id, 'before-' || user_id)) AS input_month",
    ).selectExpr("month", "input_month", "'silver-' || input_month AS sha256")
    workloads = events.where("event_id % 17 <> 0").selectExpr(
        "event_id AS run_id",
        "CASE WHEN event_id % 11 = 0 THEN 'month-x' ELSE 'month-' || user_id END AS month",
        "CASE WHEN event_id % 7 = 0 THEN 'silver-before-' || user_id ELSE 'silver-month-' || user_id END AS silver_sha256",
    )
    return lineage.lineage_chain(training, gold, gold_inputs, workloads)


def _source_row_ids(spark, folder):
    return files.with_source_rows(spark, [f"{folder}/events.parquet"]).selectExpr(
        "event_id", "source_row_number", f"concat_ws(':', 'yellow', '{MONTH}', source_row_number) AS trip_id"
    )


def _source_rows_of_files(spark, folder):
    """Row numbers over several files, a folder of events each."""
    path = files.scratch_path(spark, "events")
    events = frame(spark, folder, "events").selectExpr("event_id", "lpad(event_id % 13, 2, '0') AS part")
    events.repartition(13, "part").sortWithinPartitions("part", "event_id").write.partitionBy("part").parquet(path)
    return files.with_source_rows(spark, [path]).select("event_id", "source_row_number")


def _to_jsonl(spark, folder):
    columns = ["trip_id", "pickup_datetime", "pickup_zone_id", "dropoff_zone_id", "trip_distance_miles", "passenger_count"]
    text = digests.canonical_json(columns)
    return (
        frame(spark, folder, "trips")
        .selectExpr("trip_id", f"{text} AS line", f"{digests.payload_digest(text)} AS line_sha256")
        .selectExpr(
            "trip_id",
            "line_sha256 = sha2(line, 256) AND line = to_json(from_json(line, 'trip_id string, pickup_datetime string,"
            " pickup_zone_id smallint, dropoff_zone_id smallint, trip_distance_miles double, passenger_count smallint'),"
            " map('ignoreNullFields', 'false')) AS round_trip",
            "sha2(concat_ws('|', get_json_object(line, '$.trip_id'), get_json_object(line, '$.pickup_datetime'),"
            " get_json_object(line, '$.pickup_zone_id'), coalesce(get_json_object(line, '$.passenger_count'), '?')), 256) AS fields_sha256",
            "from_json(line, 'trip_id string, pickup_datetime string, pickup_zone_id smallint,"
            " dropoff_zone_id smallint, trip_distance_miles double, passenger_count smallint') AS back",
        )
        .selectExpr(
            "trip_id", "round_trip", "fields_sha256", "back.pickup_datetime", "back.pickup_zone_id", "back.dropoff_zone_id",
            "back.trip_distance_miles", "back.passenger_count",
        )
    )


def _jsonl_requests(spark, folder):
    """Requests written as lines, with blank ones in between, and read back."""
    lines = messages.request_messages(spark, folder).selectExpr(
        "explode(array(payload, '')) AS value"
    )
    path = files.scratch_path(spark, "requests")
    lines.write.text(path)
    return files.read_requests(spark, path, max_rows=None).selectExpr(
        "is_valid", "CASE WHEN is_valid THEN trip_id END AS trip_id",
        "CASE WHEN is_valid THEN pickup_zone_id END AS pickup_zone_id", "CASE WHEN is_valid THEN passenger_count END AS passenger_count",
    )


QUERIES = {
    "rule_masks": _rule_masks,
    "valid_split": _valid_split,
    "silver_rows": lambda s, d: quality.silver_rows(_masked(s, d), MONTH, ALLOW),
    "invalid_rows": lambda s, d: quality.invalid_rows(_masked(s, d)),
    "partition_gate": _gates,
    "quality_checks": lambda s, d: rounded(quality.quality_checks(_counts(s, d), MONTH, ALLOW)),
    "missing_counts": lambda s, d: quality.missing_counts(_counts(s, d)),
    "report_consistency": _report_consistency,
    "lineage_state": lambda s, d: lineage.lineage_state(_run_log(s, d)),
    "run_checks": _run_checks,
    "contract_lineage": _contract_lineage,
    "source_row_ids": _source_row_ids,
    "source_rows_of_files": _source_rows_of_files,
    "file_manifest": _file_manifest,
    "lineage_digest_check": _digest_check,
    "lineage_chain": _lineage_chain,
    "to_jsonl": _to_jsonl,
    "jsonl_requests": _jsonl_requests,
}


def _masks(policy: str, source: str = "raw_trips") -> str:
    passenger = "" if policy == ALLOW else " AND passenger_count IS NOT NULL"
    return f"""masked AS (SELECT *, {' AND '.join('passes_' + rule for rule in quality.RULES)} AS row_valid FROM (SELECT *,
  tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND trip_distance IS NOT NULL
    AND PULocationID IS NOT NULL AND DOLocationID IS NOT NULL AND fare_amount IS NOT NULL{passenger} AS passes_required_fields,
  coalesce(tpep_pickup_datetime < tpep_dropoff_datetime, true) AS passes_pickup_before_dropoff,
  coalesce(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime) BETWEEN 60000000 AND 10800000000, true) AS passes_duration_range,
  coalesce(trip_distance >= 0 AND trip_distance <= 100, true) AS passes_distance_range,
  coalesce(passenger_count >= 0 AND passenger_count <= 9 AND passenger_count = floor(passenger_count), true) AS passes_passenger_count_range,
  coalesce(PULocationID BETWEEN 1 AND 265, true) AS passes_known_pickup_zone,
  coalesce(DOLocationID BETWEEN 1 AND 265, true) AS passes_known_dropoff_zone,
  coalesce(NOT isnan(fare_amount) AND fare_amount >= 0, true) AS passes_non_negative_fare,
  coalesce(tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-02-01'
    AND tpep_dropoff_datetime >= TIMESTAMP '2024-01-01' AND tpep_dropoff_datetime < TIMESTAMP '2024-02-01', true) AS passes_timestamps_in_partition
  FROM {source}))"""


_RAW = ctes("raw_trips")
_M = f"{_RAW}, {_masks(ALLOW)}"
_STRICT = f"{_RAW}, {_masks('required')}"
_RULES = quality.RULES
_GATE = """SELECT '{0}' AS policy, count(*) AS total_rows, count(*) FILTER (WHERE row_valid) AS valid_rows,
  count(*) FILTER (WHERE NOT row_valid) AS invalid_rows,
  snap(count(*) FILTER (WHERE NOT row_valid) / count(*)) AS violation_rate, snap(0.1e0) AS max_violation_rate,
  CASE WHEN count(*) FILTER (WHERE NOT row_valid) / count(*) <= 0.1e0 THEN 'accepted' ELSE 'quarantined' END AS status FROM {1}"""


def _renamed(policy: str, name: str) -> str:
    return _masks(policy).replace("masked AS (", f"{name} AS (", 1)


ORACLES = {
    "source_row_ids": """SELECT event_id, row_number() OVER () - 1 AS source_row_number, 'yellow:2024-01:' || (row_number() OVER () - 1) AS trip_id FROM events""",
    "source_rows_of_files": "SELECT event_id, row_number() OVER (ORDER BY event_id % 13, event_id) - 1 AS source_row_number FROM events",
    "to_jsonl": ctes("trips") + """ SELECT trip_id, true AS round_trip, sha256(concat_ws('|', trip_id, strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.%f'),
  CAST(pickup_zone_id AS VARCHAR), coalesce(CAST(passenger_count AS VARCHAR), '?'))) AS fields_sha256, strftime(pickup_datetime, '%Y-%m-%dT%H:%M:%S.%f') AS pickup_datetime,
  pickup_zone_id, dropoff_zone_id, trip_distance_miles, passenger_count FROM trips""",
    "jsonl_requests": f"""WITH valid AS ({messages.ORACLES['contract_request']})
SELECT v.is_valid, CASE WHEN v.is_valid THEN 'e:' || e.event_id END AS trip_id,
  CASE WHEN v.is_valid THEN CAST(user_id % 20 + 1 AS INTEGER) END AS pickup_zone_id,
  CASE WHEN v.is_valid AND e.event_id % 11 <> 0 THEN CAST(e.event_id % 10 AS INTEGER) END AS passenger_count
FROM valid v JOIN events e ON v.event_id = e.event_id""",
    "rule_masks": f"{ctes('unreal_trips')}, {_masks(ALLOW, 'unreal_trips')} SELECT source_row_number, {', '.join('passes_' + r for r in _RULES)}, row_valid FROM masked",
    "valid_split": f"""{_RAW}, {_renamed('required', 'strict')}, {_renamed(ALLOW, 'lenient')}
SELECT 'required' AS policy, row_valid, count(*) AS rows, CAST(sum(source_row_number) AS BIGINT) AS row_number_sum FROM strict GROUP BY row_valid
UNION ALL SELECT 'allow_unknown', row_valid, count(*), CAST(sum(source_row_number) AS BIGINT) FROM lenient GROUP BY row_valid""",
    "silver_rows": f"""{_M} SELECT 'yellow:2024-01:' || source_row_number AS trip_id, tpep_pickup_datetime AS pickup_datetime,
  tpep_dropoff_datetime AS dropoff_datetime, CAST(PULocationID AS SMALLINT) AS pickup_zone_id, CAST(DOLocationID AS SMALLINT) AS dropoff_zone_id,
  trip_distance AS trip_distance_miles, CAST(passenger_count AS SMALLINT) AS passenger_count, fare_amount,
  CAST((epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) // 1000000 AS INTEGER) AS actual_duration_seconds,
  source_row_number, '1.1' AS contract_version FROM masked WHERE row_valid""",
    "invalid_rows": f"""{_M} SELECT tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, PULocationID, DOLocationID,
  fare_amount, source_row_number, {', '.join(f'NOT passes_{r} AS violates_{r}' for r in _RULES)} FROM masked WHERE NOT row_valid""",
    "partition_gate": snapped(f"""{_RAW}, {_renamed('required', 'strict')}, {_renamed(ALLOW, 'lenient')}
{_GATE.format('required', 'strict')} UNION ALL {_GATE.format('allow_unknown', 'lenient')}"""),
    "quality_checks": snapped(_M + " UNION ALL ".join(
        f""" SELECT '2024-01' AS "partition", '{r}' AS rule, count(*) FILTER (WHERE NOT {c}) AS violations, count(*) AS total_rows,
  snap(0.1e0) AS threshold, count(*) FILTER (WHERE NOT {c}) / count(*) <= 0.1e0 AS passed, '1.1' AS contract_version FROM masked"""
        for r, c in [("any_contract_violation", "row_valid"), *[(r, f"passes_{r}") for r in _RULES]]
    )),
    "missing_counts": f"""{_M} SELECT count(*) AS total_rows, count(*) FILTER (WHERE passenger_count IS NULL) AS missing_passenger_rows,
  count(*) FILTER (WHERE passenger_count IS NULL AND row_valid) AS valid_missing_passenger_rows FROM masked""",
    "report_consistency": """WITH g AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE event_id % 7 = 0) AS bad,
   count(*) FILTER (WHERE event_id % 11 = 0) AS m, count(*) FILTER (WHERE event_id % 11 = 0 AND event_id % 7 <> 0) AS vm FROM events GROUP BY 1),
 r AS (SELECT user_id, n, bad, n - bad + CASE WHEN user_id % 13 = 1 THEN 1 ELSE 0 END AS valid,
   CASE WHEN user_id % 5 = 0 THEN NULL ELSE m END AS m, CASE WHEN user_id % 5 = 0 AND user_id % 10 <> 0 THEN NULL ELSE vm END AS vm,
   user_id % 17 = 3 AS strict, user_id % 19 = 5 OR bad / n <= 0.15e0 AS accepted, user_id % 9 = 4 AS rate_off FROM g),
 j AS (SELECT user_id, (m IS NULL) = (vm IS NULL) AS missing_supplied_together, coalesce(m <= n, true) AS missing_within_total,
   CASE WHEN vm IS NULL THEN true WHEN m IS NULL THEN vm <= valid ELSE vm <= m AND vm <= valid END AS valid_missing_within_counts,
   NOT (strict AND coalesce(vm, 0) <> 0) AS strict_has_no_unknown, valid + bad = n AS counts_add_up, NOT rate_off AS rate_agrees,
   accepted = (bad / n <= 0.15e0) AS status_agrees FROM r)
SELECT *, missing_supplied_together AND missing_within_total AND valid_missing_within_counts AND strict_has_no_unknown
  AND counts_add_up AND rate_agrees AND status_agrees AS consistent FROM j""",
    "lineage_state": """SELECT 'r:' || event_id AS run_id,
  CASE WHEN event_id % 4 = 0 THEN 'accepted' WHEN event_id % 4 = 1 THEN 'quarantined' WHEN event_id % 4 = 2 THEN 'failed'
       WHEN event_id % 37 = 0 THEN 'failed' ELSE 'running' END AS status,
  CASE WHEN event_id % 4 <> 3 THEN ts + INTERVAL 8 SECONDS WHEN event_id % 37 = 0 THEN ts + INTERVAL 9 SECONDS ELSE ts END AS at,
  CASE WHEN event_id % 4 <> 3 THEN event_id END AS total_rows,
  CAST((event_id % 4 <> 3)::INT + (event_id % 37 = 0)::INT AS BIGINT) AS terminal_records,
  event_id % 29 = 0 OR (event_id % 4 <> 3 AND event_id % 37 = 0) AS illegal_transition
FROM events WHERE event_id % 29 <> 0 OR event_id % 4 <> 3 OR event_id % 37 = 0""",
    "run_checks": """SELECT 'r:' || (event_id - event_id % 5) AS run_id, '2024-01' AS "partition", 'rule_' || (event_id % 5) AS rule,
  event_id % 13 AS violations, CAST(100 AS BIGINT) AS total_rows, 0.1e0 AS threshold, event_id % 13 <= 10 AS passed, '1.1' AS contract_version
FROM events WHERE event_id % 50 <> 7 AND (event_id - event_id % 5) IN (SELECT event_id FROM events)""",
    "lineage_chain": """WITH r AS (SELECT event_id AS run_id, event_id % 11 <> 0 AND event_id % 17 <> 0 AS m, event_id % 13 <> 0 AS g,
  event_id % 7 <> 0 AND event_id % 17 <> 0 AS s FROM events)
SELECT run_id, m AS workload_month_matches, g AS gold_digest_matches, s AS silver_is_gold_input, m AND g AND s AS verified FROM r""",
    "contract_lineage": """WITH r AS (SELECT event_id,
  CASE event_id % 6 WHEN 0 THEN 'running' WHEN 1 THEN 'accepted' WHEN 2 THEN 'quarantined' WHEN 3 THEN 'failed' WHEN 4 THEN 'accepted'
    ELSE CASE WHEN event_id % 41 = 0 THEN 'lost' ELSE 'failed' END END AS status,
  CASE WHEN event_id % 6 = 0 AND event_id % 5 <> 0 THEN NULL WHEN event_id % 23 = 0 THEN NULL ELSE ts END AS f,
  CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id END AS total, event_id - event_id % 4 AS v,
  event_id % 4 + CASE WHEN event_id % 31 = 0 THEN 1 ELSE 0 END AS i,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE event_id % 103 / 100e0 END AS rate FROM events)
SELECT event_id, concat_ws(',', CASE WHEN status = 'lost' THEN 'status_known' END, CASE WHEN total <> v + i THEN 'counts_add_up' END,
  CASE WHEN rate > 1 THEN 'rate_range' END, CASE WHEN (status = 'running') <> (f IS NULL) THEN 'finished_iff_not_running' END) AS failed_rules FROM r""",
}
