"""Analysis of load samples and request counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.errors import DataContractError
from kerbside.operators.ranking import percentiles

PERCENTS = (50, 95, 99)
_SUCCESS = "outcome = 'success'"


def sample_outcomes(responses: DataFrame, expected_publication: str, expected_features: str = "any") -> DataFrame:
    """Name the outcome of each response, first reason first.

    ``responses`` has request_trip_id, transport ('ok', 'timeout', 'error' or
    'overflow'), status_code, prediction_valid, trip_id, publication and
    feature_fallback.
    """
    mode = (
        "false"
        if expected_features == "any"
        else f"feature_fallback <> {'true' if expected_features == 'static' else 'false'}"
    )
    return responses.selectExpr(
        "*",
        "CASE transport WHEN 'overflow' THEN 'load_generator_overflow'"
        " WHEN 'timeout' THEN 'timeout' WHEN 'error' THEN 'transport_error' ELSE"
        " CASE WHEN status_code <> 200 THEN 'http_error'"
        " WHEN NOT prediction_valid THEN 'invalid_prediction'"
        " WHEN trip_id <> request_trip_id THEN 'trip_id_mismatch'"
        f" WHEN NOT (publication <=> '{expected_publication}') THEN 'publication_mismatch'"
        f" WHEN {mode} THEN 'feature_mode_mismatch' ELSE 'success' END END AS outcome",
    )


def outcome_counts(samples: DataFrame) -> DataFrame:
    """Samples per outcome, status, model and publication mode; blank keys are left out."""
    return (
        samples.selectExpr(
            "inline(array("
            "struct('outcome' AS kind, outcome AS key),"
            "struct('http_status' AS kind, CAST(nullif(status_code, 0) AS STRING) AS key),"
            "struct('model_version' AS kind, nullif(model_version, '') AS key),"
            "struct('publication' AS kind, nullif(publication, '') AS key)))"
        )
        .where("key IS NOT NULL")
        .groupBy("kind", "key")
        .agg(F.expr("count(1) AS samples"))
    )


def load_percentiles(samples: DataFrame) -> DataFrame:
    """Nearest-rank p50, p95 and p99 of the four timings; NULLs where nothing was measured."""
    long = samples.selectExpr(
        "inline(array("
        f"struct('successful_latency_ms' AS metric, CASE WHEN {_SUCCESS} THEN latency_ms END AS ms),"
        "struct('all_attempted_latency_ms' AS metric, latency_ms AS ms),"
        "struct('http_latency_ms' AS metric, http_latency_ms AS ms),"
        "struct('dispatch_lag_ms' AS metric, dispatch_lag_ms AS ms)))"
    )
    metrics = samples.sparkSession.createDataFrame(
        [("successful_latency_ms",), ("all_attempted_latency_ms",), ("http_latency_ms",), ("dispatch_lag_ms",)],
        "metric string",
    )
    # Four rows on either side.
    found = percentiles(long, "ms", PERCENTS, ["metric"], few_groups=True)
    return metrics.join(F.broadcast(found), "metric", "left")


def load_summary(
    samples: DataFrame, scheduled: int | str, elapsed: float | str, extra: Sequence[str] = ()
) -> DataFrame:
    """One row of totals and rates; the error rate counts every scheduled request.

    ``scheduled`` and ``elapsed`` may be expressions over the totals and over the
    aggregates named in ``extra``.
    """
    counts = samples.agg(
        *[F.expr(text) for text in extra],
        F.expr("count(1) AS recorded"),
        F.expr(f"count_if({_SUCCESS}) AS successful"),
        F.expr("count_if(outcome = 'load_generator_overflow') AS overflowed"),
        F.expr(f"count_if({_SUCCESS} AND feature_fallback) AS fallbacks"),
    )
    return counts.selectExpr(
        f"CAST({scheduled} AS BIGINT) AS scheduled_requests",
        "recorded AS recorded_samples",
        "successful AS successful_requests",
        "overflowed AS overflowed_requests",
        f"(({scheduled}) - successful) / ({scheduled}) AS error_rate",
        f"successful / CAST({elapsed} AS DOUBLE) AS successful_requests_per_second",
        "try_divide(fallbacks, successful) AS fallback_rate_among_successes",
    )


def load_gates(summary: DataFrame, p95: DataFrame, max_error_rate: float, p95_objective_ms: float) -> DataFrame:
    """Five gates and whether all hold; ``p95`` is one row of successful latency percentiles."""
    # fixed values: the names of the gates
    gates = {
        "all_arrivals_accounted_for": "recorded_samples = scheduled_requests",
        "successful_predictions": "successful_requests > 0",
        "error_rate": f"error_rate <= {float(max_error_rate)!r}D",
        "no_load_generator_overflow": "overflowed_requests = 0",
        "p95_latency": f"coalesce(p95 < {float(p95_objective_ms)!r}D, false)",
    }
    one = summary.withColumn("p95", p95.select("p95").scalar())
    judged = one.selectExpr(*[f"({test}) AS {name}" for name, test in gates.items()])
    return judged.selectExpr("*", " AND ".join(gates) + " AS passed")


def binned_percentiles(samples: DataFrame) -> DataFrame:
    """p95 and p99 of successful latency per second of scheduled time."""
    bins = samples.where(_SUCCESS).selectExpr(
        "CAST(floor(scheduled_offset_seconds) AS BIGINT) AS second", "latency_ms"
    )
    return percentiles(bins, "latency_ms", (95, 99), ["second"])


def phase_checks(samples: DataFrame, phases: DataFrame, approved_model: str) -> DataFrame:
    """Checks per test phase.

    ``phases`` has phase, outage, scheduled, warmups, objectives_met and is one
    row per phase; ``is_warmup`` tells warm-up samples from measured ones. An
    outage phase must fail every request explicitly; a healthy one must serve
    the approved static model, acknowledge every success and warm up cleanly.
    """
    warmups = samples.groupBy("phase").agg(
        F.expr("count_if(is_warmup) AS warmed"),
        F.expr(f"count_if(is_warmup AND {_SUCCESS}) AS warmed_well"),
    )
    counts = samples.where("NOT is_warmup").groupBy("phase").agg(
        F.expr("count(1) AS recorded"),
        F.expr(f"count_if({_SUCCESS}) AS successful"),
        F.expr("count_if(outcome = 'load_generator_overflow') AS overflowed"),
        F.expr("count_if(outcome = 'http_error') AS http_errors"),
        F.expr("count_if(status_code = 503) AS unavailable"),
        F.expr("count_if(status_code IS NOT NULL) AS answered"),
        F.expr("count_if(publication = 'unconfirmed') AS unconfirmed"),
        F.expr("count_if(publication IS NOT NULL) AS published"),
        F.expr("count_if(publication = 'acknowledged') AS acknowledged"),
        F.expr(f"count_if(model_version = '{approved_model}') AS approved"),
        F.expr("count_if(model_version IS NOT NULL) AS modelled"),
        F.expr(f"count_if({_SUCCESS} AND feature_fallback) AS static_successes"),
    )
    joined = phases.join(counts, "phase", "left").join(warmups, "phase", "left").na.fill(0)
    checks = {
        "all_arrivals_accounted_for": ("recorded = scheduled", "true"),
        "no_dropped_arrivals": ("overflowed = 0", "true"),
        "all_requests_fail_explicitly": ("recorded = scheduled AND http_errors = scheduled", "outage"),
        "all_http_503": ("unavailable = scheduled AND answered = scheduled", "outage"),
        "all_publication_unconfirmed": ("unconfirmed = scheduled AND published = scheduled", "outage"),
        "benchmark_objectives": ("objectives_met", "NOT outage"),
        "approved_model_only": ("approved = successful AND modelled = successful AND successful > 0", "NOT outage"),
        "all_successes_acknowledged": ("acknowledged = successful", "NOT outage"),
        "all_static": ("successful > 0 AND static_successes = successful", "NOT outage"),
        "warmup_successful": ("warmed = warmups AND warmed_well = warmups", "NOT outage"),
    }
    rows = ", ".join(f"'{n}', {test}, {applies}" for n, (test, applies) in checks.items())
    return joined.selectExpr(
        "phase", f"stack({len(checks)}, {rows}) AS (check_name, passed, applies)"
    ).where("applies").select("phase", "check_name", "passed")


def counter_delta(before: DataFrame, after: DataFrame, label: str = "label") -> DataFrame:
    """Change per label between two counter snapshots; unchanged labels are dropped."""
    old = before.selectExpr(label, "value AS _before")
    return (
        after.join(old, label, "left")
        .selectExpr(label, "value - coalesce(_before, 0) AS delta")
        .where("delta <> 0")
    )


def event_rate(events: DataFrame, at: str, label: str, seconds: int) -> DataFrame:
    """Events per second, per window of ``seconds`` and label."""
    return (
        events.groupBy(F.expr(f"window({at}, '{seconds} seconds') AS _window"), label)
        .agg(F.expr(f"count(1) / {seconds}D AS per_second"))
        .selectExpr("_window.start AS window_start", label, "per_second")
    )


def histogram_quantiles(
    values: DataFrame, value: str, edges: Sequence[float], quantiles: Sequence[float]
) -> DataFrame:
    """Quantiles estimated from cumulative bucket counts, linear inside a bucket.

    A quantile in the open last bucket is the highest edge. Counting each
    bucket takes one aggregate; the rest works on one row per edge.
    """
    numeric = f"CAST({value} AS DOUBLE)"
    listed = ", ".join(f"{float(edge)!r}D" for edge in edges)
    counted = values.where(f"{value} IS NOT NULL").agg(
        F.expr("count(1) AS total"),
        F.expr(
            "array("
            + ", ".join(f"count_if({numeric} <= {float(edge)!r}D)" for edge in edges)
            + ") AS cumulative"
        ),
    )
    asked = ", ".join(f"{float(q)!r}D" for q in quantiles)
    placed = counted.selectExpr(
        "total", "cumulative", f"array({listed}) AS edges", f"explode(array({asked})) AS quantile"
    ).selectExpr(
        "*",
        "quantile * total AS _rank",
        "array_position(transform(cumulative, c -> c >= quantile * total), true) AS _at",
    ).selectExpr(
        "*",
        "CASE WHEN _at > 1 THEN get(cumulative, CAST(_at - 2 AS INT)) ELSE 0 END AS _below",
        # The first bucket starts at zero when its edge is positive, else it has no width.
        "CASE WHEN _at > 1 THEN get(edges, CAST(_at - 2 AS INT))"
        " ELSE least(0D, edges[0]) END AS _from",
        "CASE WHEN _at > 0 THEN get(edges, CAST(_at - 1 AS INT)) END AS _to",
        "CASE WHEN _at > 0 THEN get(cumulative, CAST(_at - 1 AS INT)) END AS _upto",
    )
    return placed.selectExpr(
        "quantile",
        "total",
        "CASE WHEN total = 0 THEN NULL WHEN _at = 0 THEN element_at(edges, -1)"
        " WHEN _at = 1 AND edges[0] <= 0 THEN edges[0]"
        " ELSE _from + (_to - _from) * coalesce(try_divide(_rank - _below, _upto - _below), 1D) END"
        " AS estimate",
    )


def error_fractions(samples: DataFrame) -> DataFrame:
    """Share of 5xx answers (0 when there are none) and of fallbacks among 200 answers."""
    return samples.agg(
        F.expr("try_divide(count_if(status_code BETWEEN 500 AND 599), count(status_code)) AS error_fraction"),
        F.expr("try_divide(count_if(feature_fallback), count_if(status_code = 200)) AS fallback_fraction"),
    )


def first_per_cohort(requests: DataFrame, order: str) -> DataFrame:
    """The first request with unknown, zero and positive passenger count."""
    cohort = (
        "CASE WHEN passenger_count IS NULL THEN 'unknown' WHEN passenger_count = 0 THEN 'zero'"
        " ELSE 'known_positive' END AS cohort"
    )
    rest = requests.columns
    return (
        requests.selectExpr("*", cohort)
        .groupBy("cohort")
        .agg(F.expr(f"min_by(struct({', '.join(rest)}), {order}) AS _first"))
        .selectExpr("cohort", "_first.*")
    )


def require_cohorts(first: DataFrame) -> DataFrame:
    """All three cohorts, or an error; there are at most three rows."""
    found = {row.cohort for row in first.select("cohort").collect()}
    absent = sorted({"unknown", "zero", "known_positive"} - found)
    if absent:
        raise DataContractError(f"the workload lacks cohorts: {', '.join(absent)}")
    return first
