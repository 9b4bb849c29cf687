"""Queries over load samples, counters, deliveries and ground truth."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.catalog.inputs import ctes, frame, rounded, snapped
from kerbside.functions import digests
from kerbside.operators import delivery, loadtest
from kerbside.operators.ranking import percentiles
from kerbside.sources import kafka

MODEL = "m-static"
# --- fixed values: histogram edges of the request duration panel, in seconds ---
DURATION_EDGES = (0.001, 0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 1, 5)
# --- end of fixed values ---
WAIT_SECONDS = 5400
UUID_OF = (
    "regexp_replace(md5(CAST({0} AS STRING)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '$1-$2-$3-$4-$5')"
)


def _samples(spark, folder):
    return frame(spark, folder, "answered")


def _summary(spark, folder):
    last = "max(scheduled_offset_seconds) AS last_offset"
    return loadtest.load_summary(_samples(spark, folder), "recorded + 3", "last_offset + 1", [last])


def _gates(spark, folder):
    p95 = percentiles(_samples(spark, folder).where("outcome = 'success'"), "latency_ms", (50, 95, 99))
    return loadtest.load_gates(_summary(spark, folder), p95, 0.25, 150.0)


def _responses(spark, folder):
    """Raw responses to requests, with identity, publication and mode mix-ups."""
    return frame(spark, folder, "events").selectExpr(
        "event_id",
        "'e:' || event_id AS request_trip_id",
        "CASE WHEN event_id % 101 = 0 THEN 'overflow' WHEN event_id % 59 = 0 THEN 'timeout'"
        " WHEN event_id % 53 = 0 THEN 'error' ELSE 'ok' END AS transport",
        "CASE WHEN event_type = 'error' THEN 503 ELSE 200 END AS status_code",
        "event_id % 43 <> 0 AS prediction_valid",
        "CASE WHEN event_id % 41 = 0 THEN 'e:0' ELSE 'e:' || event_id END AS trip_id",
        "CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 31 = 0 THEN 'unconfirmed' ELSE 'acknowledged' END AS publication",
        "event_id % 3 <> 0 AS feature_fallback",
    )


def _phased(spark, folder):
    """Samples in three phases; the middle one is an outage where every request fails."""
    return frame(spark, folder, "answered").selectExpr(
        "sequence",
        "CASE WHEN sequence % 10 < 4 THEN 'healthy' WHEN sequence % 10 < 7 THEN 'outage' ELSE 'recovered' END AS phase",
        "outcome", "status_code", "model_version", "publication", "feature_fallback",
    ).selectExpr(
        "phase",
        "CASE WHEN phase = 'outage' THEN 'http_error' WHEN phase = 'healthy' THEN 'success' ELSE outcome END AS outcome",
        "CASE WHEN phase = 'outage' THEN 503 WHEN phase = 'healthy' THEN 200 ELSE status_code END AS status_code",
        f"CASE WHEN phase = 'healthy' THEN '{MODEL}' WHEN phase = 'recovered' THEN model_version END AS model_version",
        "CASE WHEN phase = 'outage' THEN 'unconfirmed' WHEN phase = 'healthy' THEN 'acknowledged' ELSE publication END AS publication",
        "CASE WHEN phase = 'healthy' THEN true WHEN phase = 'recovered' THEN feature_fallback END AS feature_fallback",
        "sequence % 50 >= 40 AS is_warmup",
    )


def _phase_checks(spark, folder):
    rows = _phased(spark, folder)
    phases = rows.groupBy("phase").agg(
        F.expr("count_if(NOT is_warmup) AS scheduled"), F.expr("count_if(is_warmup) AS warmups")
    ).selectExpr(
        "phase", "phase = 'outage' AS outage", "scheduled", "warmups", "phase = 'healthy' AS objectives_met"
    )
    return loadtest.phase_checks(rows, phases, MODEL)


def _counter_delta(spark, folder):
    events = frame(spark, folder, "events").selectExpr("concat(event_type, ':', user_id % 50) AS label", "event_id")
    before = events.where("event_id % 2 = 0").groupBy("label").agg(F.expr("count(1) AS value"))
    after = events.where("event_id % 2 = 0 OR event_id % 501 = 1").groupBy("label").agg(F.expr("count(1) AS value"))
    return loadtest.counter_delta(before, after)


def _first_per_cohort(spark, folder):
    return loadtest.first_per_cohort(
        frame(spark, folder, "trips").select("source_row_number", "trip_id", "passenger_count"), "source_row_number"
    )


def _verdicts(spark, folder):
    return delivery.delivery_reconcile(frame(spark, folder, "published"), _samples(spark, folder))


def _missing_ids(spark, folder):
    return delivery.missing_ids(
        _samples(spark, folder).where("outcome = 'success'").select("prediction_id"),
        frame(spark, folder, "published").select("prediction_id"),
        "prediction_id",
    )


def _predictions(spark, folder):
    return frame(spark, folder, "trips").selectExpr(
        "'p:' || source_row_number AS prediction_id",
        "trip_id",
        "pickup_datetime AS served_at",
        "actual_duration_seconds * 0.9e0 + source_row_number % 200 AS estimated_duration_seconds",
    )


def _truths(spark, folder):
    # Every fifth completion is reported twice, the second time a minute later.
    completed = frame(spark, folder, "trips").where("source_row_number % 17 <> 0").selectExpr(
        "trip_id",
        "explode(CASE WHEN source_row_number % 5 = 0 THEN array(dropoff_datetime, dropoff_datetime + INTERVAL 60 SECONDS)"
        " ELSE array(dropoff_datetime) END) AS event_time",
        "actual_duration_seconds",
    )
    return delivery.ground_truth(_predictions(spark, folder), completed, WAIT_SECONDS)


def _envelope(spark, folder):
    rows = frame(spark, folder, "requests").selectExpr(
        "trip_id", "sha2(trip_id, 256) AS prediction_id", "static_score AS estimated_duration_seconds",
        "pickup_time AS served_at", "'1.1' AS schema_version",
    )
    return delivery.kafka_envelope(
        rows, ["prediction_id", "trip_id", "estimated_duration_seconds", "served_at", "schema_version"]
    ).selectExpr(
        "CAST(key AS STRING) AS key",
        "from_json(CAST(value AS STRING), 'prediction_id string, trip_id string,"
        " estimated_duration_seconds double, served_at string, schema_version string') AS message",
        "array_join(transform(headers, h -> h.key || '=' || CAST(h.value AS STRING)), ';') AS headers",
    ).selectExpr("key", "headers", "message.*")


def _readback(spark, folder):
    """Envelopes as a topic would hold them, read back up to captured end offsets and reconciled."""
    rows = frame(spark, folder, "answered").where("outcome = 'success'").selectExpr(
        "sequence",
        f"{UUID_OF.format('sequence')} AS prediction_id",
        "trip_id",
        "model_version",
        "map('trip_distance_miles', 1D) AS features_used",
        "map_from_arrays(CAST(array() AS ARRAY<STRING>), CAST(array() AS ARRAY<STRING>)) AS feature_timestamps",
        "feature_fallback",
        "600D + sequence AS estimated_duration_seconds",
        "'2024-01-15T00:00:00Z' AS served_at",
        "'1.1' AS schema_version",
    )
    fields = [name for name in rows.columns if name != "sequence"]
    # The last tenth of every partition lies past the captured end.
    records = delivery.kafka_envelope(rows, fields, keep=["sequence"]).selectExpr(
        "key", "value", "headers", "CAST(sequence % 3 AS INT) AS partition", "sequence div 3 AS offset"
    )
    ends = {row.partition: row.end_offset * 9 // 10 for row in kafka.end_offsets(records).collect()}
    published = kafka.published_predictions(kafka.up_to(records, ends))
    samples = rows.selectExpr(
        "trip_id", "prediction_id", "model_version", "feature_fallback", "'success' AS outcome",
        f"{digests.payload_digest(digests.canonical_json(fields))} AS prediction_sha256",
    )
    return delivery.delivery_reconcile(published, samples).groupBy("verdict").agg(F.expr("count(1) AS predictions"))


QUERIES = {
    "topic_readback": _readback,
    "sample_outcome": lambda s, d: loadtest.sample_outcomes(_responses(s, d), "acknowledged", "static").select("event_id", "outcome"),
    "outcome_counts": lambda s, d: loadtest.outcome_counts(_samples(s, d)),
    "load_percentiles": lambda s, d: rounded(loadtest.load_percentiles(_samples(s, d))),
    "latency_p95": lambda s, d: rounded(percentiles(frame(s, d, "events"), "value", (95,), interpolate=True)),
    "load_summary": lambda s, d: rounded(_summary(s, d)),
    "load_gates": _gates,
    "binned_percentiles": lambda s, d: rounded(loadtest.binned_percentiles(_samples(s, d))),
    "phase_checks": _phase_checks,
    "counter_delta": _counter_delta,
    "event_rate": lambda s, d: rounded(
        loadtest.event_rate(frame(s, d, "events"), "ts", "event_type", 3600)
    ),
    "histogram_quantile": lambda s, d: rounded(
        loadtest.histogram_quantiles(
            frame(s, d, "events").selectExpr("value / 100e0 AS seconds"), "seconds", DURATION_EDGES, (0.5, 0.95, 0.99)
        )
    ),
    "error_fraction": lambda s, d: rounded(loadtest.error_fractions(_samples(s, d))),
    "first_per_cohort": _first_per_cohort,
    "delivery_reconcile": _verdicts,
    "delivery_summary": lambda s, d: delivery.delivery_summary(_verdicts(s, d)),
    "missing_ids": _missing_ids,
    "ground_truth_join": lambda s, d: rounded(_truths(s, d)),
    "live_error": lambda s, d: rounded(delivery.live_error(_truths(s, d), 86_400)),
    "kafka_envelope": _envelope,
}

_S = ctes("answered")
_PCT = "SELECT '{0}' AS metric, snap(quantile_disc({1}, 0.5)) AS p50, snap(quantile_disc({1}, 0.95)) AS p95, snap(quantile_disc({1}, 0.99)) AS p99 FROM answered{2}"
_PHASED = _S + f""", phased AS (SELECT CASE WHEN sequence % 10 < 4 THEN 'healthy' WHEN sequence % 10 < 7 THEN 'outage' ELSE 'recovered' END AS phase, * FROM answered),
 c AS (SELECT count(*) AS n, count(*) FILTER (WHERE outcome = 'success') AS ok, count(*) FILTER (WHERE outcome = 'load_generator_overflow') AS dropped,
   count(*) FILTER (WHERE model_version = '{MODEL}') AS approved, count(model_version) AS modelled,
   count(*) FILTER (WHERE publication = 'acknowledged') AS acked, count(*) FILTER (WHERE outcome = 'success' AND feature_fallback) AS static FROM phased WHERE phase = 'recovered' AND sequence % 50 < 40),
 u AS (SELECT count(*) AS n, count(*) FILTER (WHERE outcome = 'success') AS ok FROM phased WHERE phase = 'recovered' AND sequence % 50 >= 40) """
_DELIVERY = ctes("answered", "published") + """, records AS (SELECT prediction_id, trip_id, model_version, feature_fallback, payload_sha256, envelope_ok, is_valid, count(*) AS records
   FROM published GROUP BY ALL),
 seen AS (SELECT p.prediction_id, count(*) > 1 AS duplicate FROM published p JOIN answered USING (trip_id) GROUP BY 1),
 judged AS (SELECT r.prediction_id, r.trip_id, r.records, coalesce(s.duplicate, false) AS duplicate,
   CASE WHEN r.prediction_id IS NULL OR NOT r.is_valid THEN 'unreadable' WHEN a.trip_id IS NULL THEN 'unrelated' WHEN NOT r.envelope_ok THEN 'mismatched'
     WHEN a.outcome = 'success' AND a.prediction_id = r.prediction_id AND a.model_version = r.model_version
       AND a.feature_fallback = r.feature_fallback AND a.prediction_sha256 = r.payload_sha256 THEN 'matched'
     WHEN a.outcome IN ('http_error', 'timeout', 'transport_error') THEN 'ambiguous' ELSE 'mismatched' END AS verdict
   FROM records r LEFT JOIN seen s USING (prediction_id) LEFT JOIN answered a ON a.trip_id = r.trip_id),
 verdicts AS (SELECT * FROM judged UNION ALL SELECT prediction_id, trip_id, 0, false, 'missing' FROM answered
   WHERE outcome = 'success' AND prediction_id NOT IN (SELECT prediction_id FROM judged WHERE verdict = 'matched')) """
_TRUTHS = ctes("trips") + f""", p AS (SELECT 'p:' || source_row_number AS prediction_id, trip_id, pickup_datetime AS served_at,
   actual_duration_seconds * 0.9e0 + source_row_number % 200 AS estimate, source_row_number % 17 <> 0
     AND actual_duration_seconds <= {WAIT_SECONDS} AS joined, dropoff_datetime, actual_duration_seconds AS actual FROM trips),
 truths AS (SELECT prediction_id, trip_id, served_at, estimate AS estimated_duration_seconds, CASE WHEN joined THEN actual END AS actual_duration_seconds,
   CASE WHEN joined THEN abs(estimate - actual) END AS absolute_error_seconds, CASE WHEN joined THEN dropoff_datetime END AS joined_at,
   CASE WHEN joined THEN CAST(actual AS DOUBLE) END AS join_latency_seconds, joined FROM p) """

ORACLES = {
    "topic_readback": f"""{_S}, s AS (SELECT sequence % 3 AS p, sequence // 3 AS o FROM answered WHERE outcome = 'success'),
 e AS (SELECT p, (max(o) + 1) * 9 // 10 AS stop FROM s GROUP BY 1)
SELECT CASE WHEN o < stop THEN 'matched' ELSE 'missing' END AS verdict, count(*) AS predictions FROM s JOIN e USING (p) GROUP BY 1""",
    "sample_outcome": """SELECT event_id, CASE WHEN event_id % 101 = 0 THEN 'load_generator_overflow' WHEN event_id % 59 = 0 THEN 'timeout'
  WHEN event_id % 53 = 0 THEN 'transport_error' WHEN event_type = 'error' THEN 'http_error' WHEN event_id % 43 = 0 THEN 'invalid_prediction'
  WHEN event_id % 41 = 0 AND event_id <> 0 THEN 'trip_id_mismatch' WHEN event_id % 37 = 0 OR event_id % 31 = 0 THEN 'publication_mismatch'
  WHEN event_id % 3 = 0 THEN 'feature_mode_mismatch' ELSE 'success' END AS outcome FROM events""",
    "outcome_counts": f"""{_S} SELECT 'outcome' AS kind, outcome AS key, count(*) AS samples FROM answered GROUP BY ALL
UNION ALL SELECT 'http_status', CAST(status_code AS VARCHAR), count(*) FROM answered WHERE status_code IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'model_version', model_version, count(*) FROM answered WHERE model_version IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'publication', publication, count(*) FROM answered WHERE publication IS NOT NULL GROUP BY ALL""",
    "load_percentiles": f"{_S} " + " UNION ALL ".join([
        _PCT.format("successful_latency_ms", "latency_ms", " WHERE outcome = 'success'"),
        _PCT.format("all_attempted_latency_ms", "latency_ms", ""),
        _PCT.format("http_latency_ms", "http_latency_ms", ""),
        _PCT.format("dispatch_lag_ms", "dispatch_lag_ms", ""),
    ]),
    "latency_p95": "SELECT snap(quantile_cont(value, 0.95)) AS p95 FROM events",
    "load_summary": f"""{_S}, c AS (SELECT count(*) AS n, max(scheduled_offset_seconds) + 1 AS elapsed, count(*) FILTER (WHERE outcome = 'success') AS ok,
   count(*) FILTER (WHERE outcome = 'load_generator_overflow') AS dropped, count(*) FILTER (WHERE outcome = 'success' AND feature_fallback) AS f FROM answered)
SELECT n + 3 AS scheduled_requests, n AS recorded_samples, ok AS successful_requests, dropped AS overflowed_requests,
  snap((n + 3 - ok) / (n + 3)) AS error_rate, snap(ok / elapsed) AS successful_requests_per_second, snap(f / ok) AS fallback_rate_among_successes FROM c""",
    "load_gates": f"""{_S}, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE outcome = 'success') AS ok, count(*) FILTER (WHERE outcome = 'load_generator_overflow') AS dropped,
   quantile_disc(latency_ms, 0.95) FILTER (WHERE outcome = 'success') AS p95 FROM answered),
 g AS (SELECT n = n + 3 AS a, ok > 0 AS b, (n + 3 - ok) / (n + 3) <= 0.25e0 AS e, dropped = 0 AS o, coalesce(p95 < 150, false) AS l FROM c)
SELECT a AS all_arrivals_accounted_for, b AS successful_predictions, e AS error_rate, o AS no_load_generator_overflow, l AS p95_latency,
  a AND b AND e AND o AND l AS passed FROM g""",
    "binned_percentiles": f"""{_S} SELECT CAST(floor(scheduled_offset_seconds) AS BIGINT) AS second, snap(quantile_disc(latency_ms, 0.95)) AS p95,
  snap(quantile_disc(latency_ms, 0.99)) AS p99 FROM answered WHERE outcome = 'success' GROUP BY 1""",
    "phase_checks": _PHASED + " UNION ALL ".join(
        [f" SELECT '{p}' AS phase, '{n}' AS check_name, true AS passed" for p, names in {
            "healthy": ("all_arrivals_accounted_for", "no_dropped_arrivals", "benchmark_objectives", "approved_model_only", "all_successes_acknowledged", "all_static", "warmup_successful"),
            "outage": ("all_arrivals_accounted_for", "no_dropped_arrivals", "all_requests_fail_explicitly", "all_http_503", "all_publication_unconfirmed"),
        }.items() for n in names]
        + [f" SELECT 'recovered', '{n}', {t} FROM c" for n, t in {
            "all_arrivals_accounted_for": "true", "no_dropped_arrivals": "dropped = 0", "benchmark_objectives": "false",
            "approved_model_only": "approved = ok AND modelled = ok AND ok > 0", "all_successes_acknowledged": "acked = ok", "all_static": "ok > 0 AND static = ok",
            "warmup_successful": "(SELECT u.n = u.ok FROM u)",
        }.items()]
    ),
    "counter_delta": """WITH e AS (SELECT event_type || ':' || (user_id % 50) AS label, event_id FROM events),
 b AS (SELECT label, count(*) AS v FROM e WHERE event_id % 2 = 0 GROUP BY 1), a AS (SELECT label, count(*) AS v FROM e WHERE event_id % 2 = 0 OR event_id % 501 = 1 GROUP BY 1)
SELECT a.label, a.v - coalesce(b.v, 0) AS delta FROM a LEFT JOIN b ON a.label = b.label WHERE a.v <> coalesce(b.v, 0)""",
    "event_rate": "SELECT date_trunc('hour', ts) AS window_start, event_type, snap(count(*) / 3600e0) AS per_second FROM events GROUP BY 1, 2",
    "histogram_quantile": f"""WITH v AS (SELECT value / 100e0 AS s FROM events), e AS (SELECT le, row_number() OVER (ORDER BY le) AS i FROM
   (SELECT unnest([{', '.join(f'{float(x)!r}e0' if 'e' not in repr(float(x)) else repr(float(x)) for x in DURATION_EDGES)}]) AS le)),
 c AS (SELECT le, i, (SELECT count(*) FROM v WHERE s <= le) AS cum, coalesce(lag(le) OVER (ORDER BY i), 0) AS prev,
   (SELECT count(*) FROM v) AS total FROM e),
 d AS (SELECT *, coalesce(lag(cum) OVER (ORDER BY i), 0) AS below FROM c), q(quantile) AS (VALUES (0.5e0), (0.95e0), (0.99e0)),
 hit AS (SELECT quantile, min(i) AS i FROM q, d WHERE cum >= quantile * total GROUP BY 1)
SELECT snap(q.quantile) AS quantile, (SELECT count(*) FROM v) AS total,
  snap(CASE WHEN h.i IS NULL THEN 5e0 ELSE prev + (le - prev) * (q.quantile * total - below) / (cum - below) END) AS estimate
FROM q LEFT JOIN hit h USING (quantile) LEFT JOIN d ON d.i = h.i""",
    "kafka_envelope": ctes("requests") + """ SELECT trip_id AS key, 'content-type=application/json;schema-version=1.1;prediction-id=' || sha256(trip_id) AS headers,
  sha256(trip_id) AS prediction_id, trip_id, static_score AS estimated_duration_seconds,
  strftime(pickup_time, '%Y-%m-%dT%H:%M:%S.%f') AS served_at, '1.1' AS schema_version FROM requests""",
    "error_fraction": f"""{_S} SELECT snap(count(*) FILTER (WHERE status_code >= 500) / count(status_code)) AS error_fraction,
  snap(count(*) FILTER (WHERE feature_fallback) / count(*) FILTER (WHERE status_code = 200)) AS fallback_fraction FROM answered""",
    "first_per_cohort": ctes("trips") + """ SELECT cohort, source_row_number, trip_id, passenger_count FROM (SELECT *,
  row_number() OVER (PARTITION BY cohort ORDER BY source_row_number) AS k FROM (SELECT *, CASE WHEN passenger_count IS NULL THEN 'unknown'
  WHEN passenger_count = 0 THEN 'zero' ELSE 'known_positive' END AS cohort FROM trips)) WHERE k = 1""",
    "delivery_reconcile": f"{_DELIVERY} SELECT * FROM verdicts",
    "delivery_summary": _DELIVERY + " SELECT " + ", ".join(
        f"count(*) FILTER (WHERE verdict = '{v}') AS {v}" for v in ("matched", "mismatched", "ambiguous", "unrelated", "unreadable", "missing")
    ) + ", count(*) FILTER (WHERE duplicate AND verdict <> 'unrelated') AS duplicated FROM verdicts",
    "missing_ids": ctes("answered", "published") + " SELECT prediction_id FROM answered WHERE outcome = 'success' EXCEPT SELECT prediction_id FROM published",
    "ground_truth_join": f"""{_TRUTHS} SELECT prediction_id, trip_id, served_at, snap(estimated_duration_seconds) AS estimated_duration_seconds, actual_duration_seconds,
  snap(absolute_error_seconds) AS absolute_error_seconds, joined_at, snap(join_latency_seconds) AS join_latency_seconds, joined FROM truths""",
    "live_error": f"""{_TRUTHS} SELECT date_trunc('day', served_at)::TIMESTAMP AS window_start, count(*) AS predictions, count(*) FILTER (WHERE joined) AS joined_predictions,
  snap(count(*) FILTER (WHERE joined) / count(*)) AS coverage, snap(avg(absolute_error_seconds)) AS mae_seconds,
  snap(avg(join_latency_seconds)) AS mean_join_latency_seconds FROM truths GROUP BY 1""",
}
ORACLES = {name: snapped(sql) for name, sql in ORACLES.items()}
