"""Point-in-time zone features: what was known strictly before each pickup.

A trailing window ``[t - W, t)`` over completions is computed without a range
join and without a sliding frame, whose cost grows with rows times window
population. Time is cut into slices that divide every window. A window is then

    slices between its edges   (totals, one small row per zone and slice)
  + its own slice before t     (rows, running sum)
  - the edge slice before t-W  (the same rows moved forward by W, running sum)

so all three terms become signed rows of one ledger per (zone, slice), and one
running sum per ledger answers every window at once. Work is linear in rows
after one sort, a busy zone is spread over its slices, and rows of one slice
are folded to one per instant before they are copied.

Coarse and fine parts of each measure are summed apart: the coarse part is a
whole number and cancels exactly, so subtracting leaves no rounding noise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError
from kerbside.functions import clock, numbers
from kerbside.functions.clock import MICROS
from kerbside.operators.skew import ROWS_PER_GROUP, copied_rows, crowded, spread_rows, timed_parts

SPEED_MPH = numbers.speed_mph("trip_distance_miles", "actual_duration_seconds")
WINDOWS = {"15m": schemas.SHORT_WINDOW_SECONDS, "60m": schemas.LONG_WINDOW_SECONDS}


def event_ledger(trips: DataFrame, role: str) -> DataFrame:
    """One completion row and one pickup row per trip for the zone of ``role``.

    Completion rows carry the measures, pickup rows the trip identity; the
    other columns are typed NULLs. One scan, no shuffle.
    """
    return trips.selectExpr(
        f"{role}_zone_id AS zone_id",
        f"""explode(array(
            named_struct(
                'trip_id', CAST(NULL AS STRING),
                'event_time', dropoff_datetime,
                'event_kind', 'completion',
                'actual_duration_seconds', CAST(actual_duration_seconds AS INT),
                'trip_distance_miles', CAST(trip_distance_miles AS DOUBLE),
                'speed_mph', {SPEED_MPH}),
            named_struct(
                'trip_id', trip_id,
                'event_time', pickup_datetime,
                'event_kind', 'pickup',
                'actual_duration_seconds', CAST(NULL AS INT),
                'trip_distance_miles', CAST(NULL AS DOUBLE),
                'speed_mph', CAST(NULL AS DOUBLE)))) AS event""",
    ).selectExpr("zone_id", "event.*")


def trailing_features(
    probes: DataFrame,
    facts: DataFrame,
    *,
    key: str,
    at: str,
    windows: Mapping[str, int],
    means: Sequence[str] = (),
    slice_seconds: int | None = None,
    density_of: DataFrame | None = None,
    rows_per_group: int = ROWS_PER_GROUP,
    dense_facts: bool = True,
    finite: bool = False,
) -> DataFrame:
    """Add, per window ``w``, ``count_w``, ``mean_<measure>_w`` and ``as_of_w`` to ``probes``.

    ``facts`` has the columns ``key``, ``at`` and the measures named in
    ``means``, none of them NULL. Only facts with ``t - W <= at < t`` count.
    Means and as-of are NULL for an empty window and counts are 0. The probes
    travel through with all their columns and every probe comes back once.
    Dense data wants short slices; ``slice_seconds`` must divide every window.

    A (key, slice) with more than ``rows_per_group`` probes and facts is cut by
    time into parts of their own tasks: each part holds its own facts and one row
    of totals per window for those before, so no fact is copied. ``density_of``
    may name a cheaper frame with the same ``key`` and ``at`` values to count the
    probes on. A measure that is not finite makes its windows NaN, not later ones.

    Callers who know more save work: without ``dense_facts`` a slice holds few
    instants of facts (they are folded to one row each), and probes alone are
    spread, each part with a copy of them; ``finite`` measures need no watch.
    """
    spans = {label: seconds * MICROS for label, seconds in windows.items()}
    width = (slice_seconds * MICROS) if slice_seconds else reduce(gcd, spans.values())
    if any(span % width for span in spans.values()):
        raise DataContractError("slice_seconds must divide every window")

    kinds = dict(facts.dtypes)
    # What is not finite would stay in running sums for good, so it is counted apart.
    broken = [] if finite else [name for name in means if kinds[name] in ("float", "double")]
    whole = {name for name in means if kinds[name] in ("tinyint", "smallint", "int", "bigint")}
    sums = {"_n": "count(1)"}
    for name in means:
        if name in whole:
            sums[f"_{name}"] = f"sum({name})"
        else:
            coarse, fine = numbers.coarse_part(name), numbers.fine_part(name)
            if name in broken:
                usable = numbers.is_finite(name)
                coarse, fine = f"CASE WHEN {usable} THEN {coarse} ELSE 0L END", f"CASE WHEN {usable} THEN {fine} ELSE 0D END"
                sums[f"_{name}_odd"] = f"count_if(NOT {usable})"
            sums[f"_{name}"] = f"sum({coarse})"
            sums[f"_{name}_fine"] = f"sum({fine})"
    folded = _fold_instants(facts, key, at, sums, width)
    ledger = _ledger_rows(folded, spans, width, list(sums))

    group = ["_key", "_slice"]
    us = clock.MICROS_OF.format(at)
    place = [f"{key} AS _key", f"{us} div {width} AS _slice"]
    counted = density_of if density_of is not None else probes
    asked = counted.selectExpr(*place).groupBy(*group).agg(F.expr("count(1) AS _rows"))
    moves = ", ".join(str(n) for n in (0, *(span // width for span in spans.values())))
    facing = (
        facts.selectExpr(*place)
        .groupBy(*group)
        .agg(F.expr("count(1) AS _rows"))
        .selectExpr("_key", f"explode(transform(array({moves}), move -> _slice + move)) AS _slice", "_rows")
    )
    hot = crowded(asked.unionByName(facing) if dense_facts else asked, group, rows_per_group)
    # Probe columns travel as one struct: in ledger rows it is a single NULL.
    asking = probes.selectExpr(*place, f"{us} AS _us", "struct(*) AS _probe")
    if dense_facts:
        asking = timed_parts(asking, hot, group, width).drop("_parts")
        cut = timed_parts(ledger, hot, group, width)
        answering = cut.drop("_parts").unionByName(_earlier_parts(cut, hot, spans, width, list(sums)))
    else:
        asking = spread_rows(asking, hot, group, ["_probe"])
        answering = copied_rows(ledger, hot, group)
    both = asking.unionByName(answering, allowMissingColumns=True)

    # Strictly before t: the frame ends one microsecond earlier. The hash comes first
    # because a sort compares the first column much faster than the rest.
    before = (
        "OVER (PARTITION BY _cell, _key, _slice, _part ORDER BY _us "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    )
    running = [f"max(_last_us) {before} AS _latest_us"]
    for index, (label, span) in enumerate(spans.items()):
        sign = (
            f"CASE WHEN _kind = {-1 - index} THEN -1"
            f" WHEN _kind BETWEEN 0 AND {span // width} OR _kind = {CARRIED - index} THEN 1 ELSE 0 END"
        )
        for name in sums:
            running.append(f"coalesce(sum({name} * ({sign})) {before}, 0) AS {name}_{label}")
    # Probes are picked only after the window has seen the ledger rows.
    known = (
        both.selectExpr("*", "xxhash64(_key, _slice, _part) AS _cell")
        .selectExpr("_us", "_probe", *running)
        .where("_probe IS NOT NULL")
    )

    features = []
    for label, span in spans.items():
        features.append(f"CAST(_n_{label} AS INT) AS count_{label}")
        for name in means:
            total = (
                f"_{name}_{label}"
                if name in whole
                else numbers.join_parts(f"_{name}_{label}", f"_{name}_fine_{label}")
            )
            if name in broken:
                total = f"CASE WHEN _{name}_odd_{label} > 0 THEN double('NaN') ELSE {total} END"
            features.append(
                f"CASE WHEN _n_{label} > 0 THEN {total} / _n_{label} END AS mean_{name}_{label}"
            )
        features.append(
            f"CASE WHEN _latest_us >= _us - {span} "
            f"THEN {clock.FROM_MICROS.format('_latest_us')} END AS as_of_{label}"
        )
    return known.selectExpr("_probe.*", *features)


def _fold_instants(
    facts: DataFrame, key: str, at: str, sums: Mapping[str, str], width: int
) -> DataFrame:
    """One row per key and instant; copies of an instant never travel apart."""
    return (
        facts.selectExpr("*", f"{key} AS _key", f"{clock.MICROS_OF.format(at)} AS _us")
        .groupBy("_key", "_us")
        .agg(*[F.expr(f"{total} AS {name}") for name, total in sums.items()])
        .selectExpr("*", f"_us div {width} AS _slice")
    )


# Kind of the totals of earlier parts for the first window, one less for each next one.
CARRIED = -1000


def _earlier_parts(
    ledger: DataFrame, hot: DataFrame, spans: Mapping[str, int], width: int, measures: list[str]
) -> DataFrame:
    """For every part of a hot cell and every window, the signed totals of the parts before it.

    Small: a row per part and window, and a cell has its rows / rows_per_group parts.
    """
    signed = []
    for index, span in enumerate(spans.values()):
        sign = f"CASE WHEN _kind = {-1 - index} THEN -1 WHEN _kind BETWEEN 0 AND {span // width} THEN 1 ELSE 0 END"
        signed += [F.expr(f"sum({name} * ({sign})) AS {name}_{index}") for name in measures]
    totals = (
        ledger.where("_parts IS NOT NULL")
        .groupBy("_key", "_slice", "_part", "_parts")
        .agg(F.max("_last_us").alias("_last_us"), *signed)
    )
    grid = hot.selectExpr("_key", "_slice", "explode(sequence(0, _parts - 1)) AS _part", "_parts")
    columns = [f"{name}_{index}" for index in range(len(spans)) for name in measures]
    before = "OVER (PARTITION BY _key, _slice ORDER BY _part RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    rows = ", ".join(
        f"named_struct('_kind', {CARRIED - index}, "
        + ", ".join(f"'{name}', coalesce({name}_{index}, 0)" for name in measures)
        + ")"
        for index in range(len(spans))
    )
    return (
        totals.unionByName(grid, allowMissingColumns=True)
        .selectExpr(
            "_key", "_slice", "_part", "_parts", f"max(_last_us) {before} AS _last_us",
            *[f"sum({name}) {before} AS {name}" for name in columns],
        )
        .groupBy("_key", "_slice", "_part", "_parts")
        .agg(F.max("_last_us").alias("_last_us"), *[F.first(name, ignorenulls=True).alias(name) for name in columns])
        .where("_part > 0")
        .selectExpr(
            "_key",
            "_slice",
            f"_slice * {width} + CAST(ceil(_part * {width}D / _parts) AS BIGINT) - 1 AS _us",
            "_last_us",
            "_part",
            f"explode(array({rows})) AS _row",
        )
        .selectExpr("_key", "_slice", "_us", "_last_us", "_part", "_row.*")
    )


def _ledger_rows(
    folded: DataFrame, spans: Mapping[str, int], width: int, measures: list[str]
) -> DataFrame:
    """Ledger rows whose signed running sum before t is the content of every window at t.

    ``_kind`` says what a row is: 0 an instant in its own slice, -1, -2, ... the
    same instant moved forward by the first, second, ... window, which it then
    leaves, and k > 0 the totals of the slice k slices back.
    """

    def row(slice_: str, us: str, last: str, kind: int) -> str:
        return (
            f"named_struct('_slice', {slice_}, '_us', {us},"
            f" '_last_us', CAST({last} AS BIGINT), '_kind', {kind})"
        )

    rows = [row("_slice", "_us", "_us", 0)]
    for index, span in enumerate(spans.values()):
        rows.append(row(f"_slice + {span // width}", f"_us + {span}", "NULL", -1 - index))
    instants = folded.selectExpr(
        "_key", *measures, f"explode(array({', '.join(rows)})) AS _row"
    ).selectExpr("_key", *measures, "_row.*")

    reach = max(spans.values()) // width
    carried = (
        folded.groupBy("_key", "_slice")
        .agg(F.max("_us").alias("_last_us"), *[F.sum(name).alias(name) for name in measures])
        .selectExpr("*", f"explode(sequence(1, {reach})) AS _kind")
        .selectExpr(
            "_key",
            *measures,
            "_slice + _kind AS _slice",
            f"(_slice + _kind) * {width} - 1 AS _us",
            "_last_us",
            "_kind",
        )
    )
    return instants.unionByName(carried)


def completions(trips: DataFrame, role: str, at: str = "completed_at") -> DataFrame:
    """Trips as facts at their completion time, keyed by the zone of ``role``."""
    return trips.selectExpr(
        f"{role}_zone_id",
        f"dropoff_datetime AS {at}",
        "actual_duration_seconds AS duration",
        f"{SPEED_MPH} AS speed",
        "trip_distance_miles AS distance",
    )


def zone_history(
    probes: DataFrame,
    trips: DataFrame,
    role: str,
    *,
    windows: Mapping[str, int] = WINDOWS,
    means: Sequence[str] = ("duration", "speed", "distance"),
    **options,
) -> DataFrame:
    """Trailing completions of the zone of ``role`` at each probe's ``pickup_datetime``."""
    return trailing_features(
        probes,
        completions(trips, role, at="pickup_datetime"),
        key=f"{role}_zone_id",
        at="pickup_datetime",
        windows=windows,
        means=means,
        **options,
    )


def stage_trips(silver: DataFrame) -> DataFrame:
    """Cast silver columns to their fixed types; a value that does not fit raises."""
    return silver.selectExpr(
        *[f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schemas.SILVER]
    )


def prune_lookback(
    trips: DataFrame, start: datetime, end: datetime, window_seconds: int
) -> DataFrame:
    """Pickups of ``[start, end)`` and completions one window before it or inside it.

    Older pickups that complete inside the lookback are kept: the rule looks at
    completion times. Both branches are plain ranges, so they reach the scan.
    """
    first = start - timedelta(seconds=window_seconds)
    return trips.where(
        f"({clock.within('pickup_datetime', start, end)})"
        f" OR ({clock.within('dropoff_datetime', first, end)})"
    )


def gold_features(
    trips: DataFrame, start: datetime, end: datetime, feature_version: str, **options
) -> DataFrame:
    """Feature rows for the pickups of ``[start, end)``.

    The trips travel through both zone ledgers with their columns, so no join
    back on the trip identity is needed: two shuffles of trips in all. A zone
    completes few trips in a slice, and silver measures are finite.
    """
    options = {"dense_facts": False, "finite": True, **options}
    known = prune_lookback(trips, start, end, max(WINDOWS.values()))
    probes = known.where(clock.within("pickup_datetime", start, end)).select(
        "trip_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_zone_id",
        "dropoff_zone_id",
        "trip_distance_miles",
        "passenger_count",
        "actual_duration_seconds",
        "contract_version",
    )
    at_pickup = zone_history(probes, known, "pickup", **options).selectExpr(
        *probes.columns,
        *[
            f"{ours}_{window} AS pu_zone_{theirs}_{window}"
            for window in WINDOWS
            for ours, theirs in (
                ("count", "trips"),
                ("mean_duration", "mean_duration"),
                ("mean_speed", "mean_speed"),
                ("mean_distance", "mean_distance"),
            )
        ],
        *[f"as_of_{window} AS pu_zone_features_{window}_as_of" for window in WINDOWS],
    )
    both = zone_history(
        at_pickup,
        known,
        "dropoff",
        windows={"60m": WINDOWS["60m"]},
        means=(),
        density_of=probes,
        **options,
    )
    return both.selectExpr(
        "trip_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pickup_zone_id",
        "dropoff_zone_id",
        f"{clock.HOUR_OF_WEEK_SUNDAY.format('pickup_datetime')} AS pickup_hour_of_week",
        "trip_distance_miles",
        "passenger_count",
        "actual_duration_seconds",
        *[
            f"pu_zone_{measure}_{window}"
            for window in WINDOWS
            for measure in ("trips", "mean_duration", "mean_speed", "mean_distance")
        ],
        "count_60m AS do_zone_trips_60m",
        "pu_zone_features_15m_as_of",
        "pu_zone_features_60m_as_of",
        "as_of_60m AS do_zone_features_60m_as_of",
        "contract_version",
        f"'{feature_version}' AS feature_model_version",
    )
