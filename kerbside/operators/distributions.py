"""Workload eligibility, marginal histograms and their distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import clock
from kerbside.operators.ranking import running_totals

# --- fixed values: profile dimensions and distance edges ---
DIMENSIONS = ("pickup_hour_of_week", "pickup_zone", "dropoff_zone", "distance", "passengers")
# --- end of fixed values ---


def local_time_flags(frame: DataFrame, column: str, zone: str = clock.LOCAL_ZONE) -> DataFrame:
    """Mark wall clocks that name no instant, or two.

    Only rows within a day of an offset change pay for the full test.
    """
    tests = {
        "is_nonexistent": clock.is_nonexistent_local(column, zone),
        "is_ambiguous": clock.is_ambiguous_local(column, zone),
    }
    near = frame.selectExpr("*", f"{clock.near_offset_change(column, zone)} AS _near_change")
    return near.selectExpr(
        *[f"`{name}`" for name in frame.columns],
        *[f"CASE WHEN _near_change THEN {test} ELSE _near_change END AS {name}" for name, test in tests.items()],
    )


def unambiguous_rows(frame: DataFrame, column: str, zone: str = clock.LOCAL_ZONE) -> DataFrame:
    return frame.where(clock.names_one_instant(column, zone))


def eligibility(silver: DataFrame, start, end, contract_version: str) -> DataFrame:
    """Counts a workload build must look at: rows that may not exist, and rows it leaves out."""
    flagged = local_time_flags(silver, "pickup_datetime")
    return flagged.agg(
        F.expr("count(1) AS scanned_rows"),
        F.expr("count_if(NOT is_nonexistent AND NOT is_ambiguous) AS eligible_rows"),
        F.expr("count_if(is_nonexistent OR is_ambiguous) AS excluded_rows"),
        F.expr(
            f"count_if(NOT coalesce({clock.within('pickup_datetime', start, end)}, false))"
            " AS outside_month_rows"
        ),
        F.expr(
            f"count_if(NOT (contract_version <=> '{contract_version}')) AS other_contract_rows"
        ),
    )


def profile_labels() -> str:
    """The five ``(dimension, key)`` pairs of a trip, as one array expression."""
    # Only trips of 0 miles or more exist in silver; lower values join the first bucket.
    distance = (
        "CASE WHEN trip_distance_miles < 1 THEN '[0,1)' WHEN trip_distance_miles < 3 THEN '[1,3)'"
        " WHEN trip_distance_miles < 10 THEN '[3,10)' ELSE '[10,inf)' END"
    )
    keys = (
        f"CAST({clock.HOUR_OF_WEEK_MONDAY.format('pickup_datetime')} AS STRING)",
        "CAST(pickup_zone_id AS STRING)",
        "CAST(dropoff_zone_id AS STRING)",
        distance,
        "coalesce(CAST(passenger_count AS STRING), 'unknown')",
    )
    pairs = ", ".join(
        f"struct('{dimension}' AS dimension, {key} AS key)"
        for dimension, key in zip(DIMENSIONS, keys)
    )
    return f"array({pairs})"


def marginal_histograms(trips: DataFrame) -> DataFrame:
    """Rows per dimension and key; five labels per trip are counted before the shuffle."""
    return (
        trips.selectExpr(f"inline({profile_labels()})")
        .groupBy("dimension", "key")
        .agg(F.expr("count(1) AS rows"))
    )


def histogram_distances(left: DataFrame, right: DataFrame) -> DataFrame:
    """Total variation distance per dimension: half the sum of |p - q| over all keys."""

    def shares(histogram: DataFrame, name: str) -> DataFrame:
        return histogram.selectExpr(
            "dimension", "key", f"rows / sum(rows) OVER (PARTITION BY dimension) AS {name}"
        )

    joined = shares(left, "_p").join(shares(right, "_q"), ["dimension", "key"], "full_outer")
    return joined.groupBy("dimension").agg(
        F.expr("0.5D * sum(abs(coalesce(_p, 0D) - coalesce(_q, 0D))) AS total_variation_distance")
    )


def cumulative_distances(left: DataFrame, right: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov distance per measure: the largest gap between its cumulative shares.

    Exact, over the distinct values of both sides: their counts are sorted by
    range and summed up across partitions. NULLs are left out; NaN is the
    largest value. A measure without values on one side has a NULL distance,
    one without any has no row.
    """
    values = ", ".join(f"struct('{name}' AS feature, CAST({name} AS DOUBLE) AS value)" for name in measures)
    both = left.selectExpr(f"inline(array({values}))", "1L AS _p", "0L AS _q").unionByName(
        right.selectExpr(f"inline(array({values}))", "0L AS _p", "1L AS _q")
    )
    counts = both.where("value IS NOT NULL").groupBy("feature", "value").agg(F.expr("sum(_p) AS _p"), F.expr("sum(_q) AS _q"))
    placed = running_totals(counts, ["feature", "value"], ["_p", "_q"])
    totals = placed.groupBy("feature").agg(
        *[F.expr(text) for side in ("_p", "_q") for text in (f"sum({side}) AS {side}_all", f"min({side}_before) AS {side}_first")]
    )
    shares = [f"({side}_before - {side}_first + {side}) / nullif({side}_all, 0)" for side in ("_p", "_q")]
    return (
        placed.join(F.broadcast(totals), "feature")  # one row per measure
        .groupBy("feature")
        .agg(F.expr(f"max(abs({shares[0]} - {shares[1]})) AS cumulative_distance"))
    )


def drift_report(
    reference: DataFrame, recent: DataFrame, threshold: float, retrain_at: int = 2, measures: Sequence[str] = ()
) -> DataFrame:
    """Distance per dimension against a threshold, and what the whole report asks for.

    ``measures`` are columns of numbers, such as a target and its prediction,
    judged by the distance of their cumulative distributions. A measure without
    a distance has not drifted.
    """
    distances = histogram_distances(
        marginal_histograms(reference), marginal_histograms(recent)
    ).selectExpr("dimension AS feature", "total_variation_distance AS statistic")
    if measures:
        distances = distances.unionByName(
            cumulative_distances(reference, recent, measures).withColumnRenamed("cumulative_distance", "statistic")
        )
    judged = distances.selectExpr(
        "*",
        f"{float(threshold)!r}D AS threshold",
        f"coalesce(statistic > {float(threshold)!r}D, false) AS drifted",
    )
    drifted = "count_if(drifted) OVER ()"
    return judged.selectExpr(
        "*",
        f"CASE WHEN {drifted} >= {retrain_at} THEN 'retrain'"
        f" WHEN {drifted} > 0 THEN 'alert' ELSE 'none' END AS action",
    )
