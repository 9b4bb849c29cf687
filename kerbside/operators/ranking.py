"""Exact percentiles and positions without one task that sees every row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.functions import digests
from kerbside.session import reliable_checkpoint

# --- fixed values of the 64-bit floating point format ---
LEAST_EXPONENT, MOST_EXPONENT, FRACTION = -1022, 1023, 1 << 52
INFINITE_KEY = 2047 * FRACTION
# --- end of fixed values ---

RANGES = 1 << 16


def ordered_keys(frame: DataFrame, value: str) -> DataFrame:
    """``frame`` with ``_k``, 64-bit keys that order like a double column: the bits of its absolute value, with its sign.

    The exponent is estimated and then corrected; dividing by a power of two is
    exact. Zeros share a key; NaN comes last.
    """
    regular = "_a > 0 AND _a < double('infinity')"
    split = frame.selectExpr("*", f"abs({value}) AS _a").selectExpr(
        "*", f"CASE WHEN {regular} THEN CAST(greatest(least(floor(log2(_a)), {MOST_EXPONENT}), {LEAST_EXPONENT}) AS INT) ELSE 0 END AS _e"
    )
    scaled = split.selectExpr("*", f"CASE WHEN {regular} THEN _a / pow(2D, _e) ELSE 1D END AS _m")
    low = f"_m < 1 AND _e > {LEAST_EXPONENT}"
    fitted = scaled.selectExpr(
        *[name for name in scaled.columns if name not in ("_e", "_m")],
        f"CASE WHEN _m >= 2 THEN _e + 1 WHEN {low} THEN _e - 1 ELSE _e END AS _e",
        f"CASE WHEN _m >= 2 THEN _m / 2 WHEN {low} THEN _m * 2 ELSE _m END AS _m",
    )
    size = (
        f"CASE WHEN isnan(_a) THEN {INFINITE_KEY + 1}L WHEN _a = 0 THEN 0L WHEN _a = double('infinity') THEN {INFINITE_KEY}L"
        f" ELSE (_e - {LEAST_EXPONENT}) * {FRACTION}L + CAST(_m * {FRACTION}D AS BIGINT) END"
    )
    return fitted.selectExpr(*frame.columns, f"CASE WHEN {value} < 0 THEN -({size}) ELSE {size} END AS _k")


def percentiles(
    frame: DataFrame,
    value: str,
    percents: Sequence[int],
    by: Sequence[str] = (),
    interpolate: bool = False,
    few_groups: bool = False,
) -> DataFrame:
    """``p<percent>`` columns over the non-NULL values, per group, exactly.

    The nearest rank ``ceil(percent * rows / 100)`` is used, or linear
    interpolation between neighbours. Values become ordered 64-bit keys, and a
    rank is followed through them sixteen bits at a time: the rows below the
    prefix it has reached are counted by their next sixteen bits, and running
    sums over at most 65,536 counts tell where it goes on. Four rounds end at
    one value. Rows stay where they are; what moves are counts.

    Without ``by`` there is one row, NULL when empty. The places that ranks have
    reached are broadcast where their number is bounded: without ``by``, and
    with ``few_groups`` (a bounded number of groups). With any number of groups
    the distinct values of each are counted first, and Spark joins these counts
    as their size allows.
    """
    keys = list(by) or ["_all"]
    named = frame.selectExpr(*(by or ["0 AS _all"]), f"CAST({value} AS DOUBLE) AS _v").where(" AND ".join(["_v IS NOT NULL", *[f"{key} IS NOT NULL" for key in keys if few_groups]]))
    rows = ordered_keys(named, "_v").selectExpr(*keys, "_k", "_v", "1L AS _n")
    bounded = few_groups or not by
    if not bounded:
        rows = rows.groupBy(*keys, "_k").agg(F.expr("min(_v) AS _v"), F.expr("sum(_n) AS _n"))

    ranks = []  # 1-based, of _total rows
    for percent in percents:
        if interpolate:
            lower = f"floor((_total - 1) * {percent} / 100) + 1"
            ranks += [lower, f"least({lower} + 1, _total)"]
        else:
            ranks.append(f"greatest(ceil(_total * {percent} / 100), 1)")
    listed = ", ".join(f"struct({n} AS _id, CAST({rank} AS BIGINT) AS _need)" for n, rank in enumerate(ranks))

    def running(counts: DataFrame, within: str) -> DataFrame:
        return counts.selectExpr("*", f"sum(_n) OVER (PARTITION BY {within} ORDER BY _to ROWS UNBOUNDED PRECEDING) AS _upto")

    of_group = ", ".join(keys)
    first = rows.groupBy(*keys, F.expr("shiftright(_k, 48) AS _to")).agg(F.expr("sum(_n) AS _n"), F.expr("min(_v) AS _v"))
    placed = running(first.selectExpr("*", f"sum(_n) OVER (PARTITION BY {of_group}) AS _total"), of_group)
    reached = placed.selectExpr(*keys, "_total", f"inline(transform(filter(array({listed}), r -> r._need > _upto - _n AND r._need <= _upto), r -> struct(r._id AS _id, r._need - (_upto - _n) AS _need))) AS (_id, _need)", "_to", "_v")
    for shift in (32, 16, 0):
        places = reached.selectExpr(*keys, "_total", "_id", "_need", "_to AS _from")
        own = rows.selectExpr(*keys, "_n", "_v", f"shiftright(_k, {shift + 16}) AS _from", f"shiftright(_k, {shift}) AS _to")
        below = own.join(F.broadcast(places) if bounded else places, [*keys, "_from"])
        counts = below.groupBy(*keys, "_id", "_need", "_total", "_to").agg(F.expr("sum(_n) AS _n"), F.expr("min(_v) AS _v"))
        found = running(counts, f"{of_group}, _id")
        reached = found.where("_need > _upto - _n AND _need <= _upto").selectExpr(*keys, "_total", "_id", "_need - (_upto - _n) AS _need", "_to", "_v")

    def at(n: int) -> str:
        return f"max(CASE WHEN _id = {n} THEN _v END)"

    columns = []
    for n, percent in enumerate(percents):
        if interpolate:
            place = f"(max(_total) - 1) * {percent} / 100"
            weight = f"({place} - floor({place}))"
            low, high = at(2 * n), at(2 * n + 1)
            text = f"CASE WHEN {weight} > 0 THEN {low} + ({high} - {low}) * {weight} ELSE {low} END"
        else:
            text = at(n)
        columns.append(F.expr(f"{text} AS p{percent}"))
    return reached.groupBy(*by).agg(*columns) if by else reached.agg(*columns)


def with_positions(frame: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """``frame`` with its 0-based ``position`` in a total order, and ``total_rows``.

    ``order_by`` must identify rows. The sort is range-partitioned; positions
    inside its partitions are kept in a reliable checkpoint, so both reads see
    the same layout, and partition offsets are one row per partition.
    """
    ordered = frame.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id())
    saved = reliable_checkpoint(ordered)
    offsets = (
        saved.groupBy(F.expr("shiftright(_place, 33) AS _part"))
        .agg(F.expr("count(1) AS _rows"))
        .selectExpr(
            "_part",
            "sum(_rows) OVER (ORDER BY _part) - _rows AS _offset",
            "sum(_rows) OVER () AS total_rows",
        )
    )
    return (
        saved.withColumn("_part", F.expr("shiftright(_place, 33)"))
        .join(F.broadcast(offsets), "_part")
        .selectExpr(*frame.columns, "_offset + (_place & 8589934591) AS position", "total_rows")
    )


def running_totals(frame: DataFrame, order_by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``frame`` with ``<value>_before``: the sum of a whole-number column over all rows before, in a total order.

    Sums are taken inside the partitions of a range-partitioned sort, kept in a
    reliable checkpoint, and over one total per partition; no task sees all rows.
    """
    saved = reliable_checkpoint(frame.orderBy(*order_by).withColumn("_place", F.monotonically_increasing_id()))
    parted = saved.selectExpr("*", "shiftright(_place, 33) AS _part")
    totals = parted.groupBy("_part").agg(*[F.expr(f"sum({name}) AS `_all_{name}`") for name in values])
    offsets = totals.selectExpr("_part", *[f"sum(`_all_{name}`) OVER (ORDER BY _part) - `_all_{name}` AS `_offset_{name}`" for name in values])
    within = "OVER (PARTITION BY _part ORDER BY _place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    summed = parted.selectExpr("*", *[f"coalesce(sum({name}) {within}, 0L) AS `_within_{name}`" for name in values])
    return summed.join(F.broadcast(offsets), "_part").selectExpr(
        *frame.columns, *[f"`_offset_{name}` + `_within_{name}` AS `{name}_before`" for name in values]
    )


def range_number(kind: T.DataType, column: str) -> str | None:
    """A double that never falls where the column rises, or None where there is none."""
    if isinstance(kind, T.NumericType):
        return f"CAST({column} AS DOUBLE)"
    if isinstance(kind, T.TimestampType):
        return f"CAST(unix_micros({column}) AS DOUBLE)"
    day = f"unix_date(CAST({column} AS DATE)) * 86400D"
    if isinstance(kind, T.DateType):
        return day
    if isinstance(kind, T.TimestampNTZType):
        return f"{day} + hour({column}) * 3600D + minute({column}) * 60D + CAST(second({column}) AS DOUBLE)"
    return None


def near_picks(keys: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """The keys that can be evenly spaced picks, with ``position`` among all keys and ``total_rows``.

    Counts in at most ``RANGES`` + 1 ranges of the first key tell which ranges
    hold a pick. Only their keys are sorted, over partitions of the whole key,
    so that a first key which many rows share is split. Keys of a kind without
    ranges (text) are sorted whole.
    """
    number = range_number(keys.schema[order_by[0]].dataType, order_by[0])
    if number is None:
        return with_positions(keys, order_by)
    finite = "_n > double('-infinity') AND _n < double('infinity')"
    ends = keys.selectExpr(f"{number} AS _n").agg(
        F.expr(f"min(CASE WHEN {finite} THEN _n END) AS low"), F.expr(f"max(CASE WHEN {finite} THEN _n END) AS high")
    ).first()
    low, high = ends["low"] or 0.0, ends["high"] or 0.0
    # NULLs sort first; NaN is the greatest number, so it ends in the last range with infinity
    share = f"(_n - ({low!r}D)) / ({(high - low) or 1.0!r}D)" if high - low < float("inf") else "0D"
    ranged = keys.selectExpr("*", f"{number} AS _n").selectExpr(
        *order_by, f"CASE WHEN _n IS NULL THEN -1 ELSE CAST(floor(least(greatest({share}, 0D), 1D) * {RANGES - 1}) AS INT) END AS _range"
    )
    counts = ranged.groupBy("_range").agg(F.expr("count(1) AS _rows"))
    placed = counts.selectExpr(
        "*", "sum(_rows) OVER (ORDER BY _range) - _rows AS _before", "sum(_rows) OVER () AS _total"
    ).selectExpr("*", f"least({rows}, _total) AS _picks")
    first = "(_before * (_picks - 1) + _total - 2) div (_total - 1)"  # the first pick not before the range
    holds = (
        "CASE WHEN _picks < 2 OR _total < 2 THEN _before = 0"
        f" ELSE {first} < _picks AND ({first} * (_total - 1)) div (_picks - 1) < _before + _rows END"
    )
    near = placed.where(holds).selectExpr("_range", "_total", "_before - (sum(_rows) OVER (ORDER BY _range) - _rows) AS _shift")
    kept = ranged.join(F.broadcast(near), "_range").drop("_range")
    return with_positions(kept, order_by).selectExpr(*order_by, "position + _shift AS position", "_total AS total_rows")


def even_sample(frame: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """``rows`` evenly spaced rows from first to last in the given order, or all if fewer.

    The i-th pick sits at floor(i * (total - 1) / (picks - 1)). A key knows from
    its position alone whether it is a pick. Only the columns in ``order_by``,
    which must identify rows, are looked at, and only ranges of them that hold a
    pick are sorted; the picks, at most ``rows``, then find their rows.
    """
    keys = frame.select(*order_by)
    placed = near_picks(keys, rows, order_by).selectExpr("*", f"least({rows}, total_rows) AS _picks")
    index = "CASE WHEN _picks < 2 OR total_rows < 2 THEN 0L ELSE CAST(ceil(position * (_picks - 1) / (total_rows - 1)) AS BIGINT) END"
    picks = (
        placed.selectExpr("*", f"{index} AS pick")
        .where(
            "CASE WHEN _picks < 2 THEN position = 0"
            " ELSE (pick * (total_rows - 1)) div (_picks - 1) = position END"
        )
        .selectExpr(*[f"{name} AS _key_{n}" for n, name in enumerate(order_by)], "position", "pick")
    )
    same = " AND ".join(f"{name} <=> _key_{n}" for n, name in enumerate(order_by))
    return frame.join(F.broadcast(picks), F.expr(same)).selectExpr(*frame.columns, "position", "pick")


def hash_sample(frame: DataFrame, identifier: str, rows: int, seed: int = 42) -> DataFrame:
    """``rows`` rows drawn uniformly without replacement, in random order.

    Rows are ordered by a seeded hash of their identity, so the draw does not
    depend on file or partition layout. Counts per hash prefix (at most 65,536
    of them) tell which prefixes can hold the first ``rows``; only those rows
    are ordered.
    """
    keyed = frame.selectExpr("*", f"{digests.sampling_key(seed, identifier)} AS sample_key")
    prefixes = keyed.groupBy(F.expr("substring(sample_key, 1, 4) AS _prefix")).agg(
        F.expr("count(1) AS _rows")
    )
    cutoff = prefixes.selectExpr(
        "_prefix", "sum(_rows) OVER (ORDER BY _prefix) AS _upto"
    ).agg(F.expr(f"coalesce(min(CASE WHEN _upto >= {rows} THEN _prefix END), max(_prefix))"))
    near = keyed.where(F.substring("sample_key", 1, 4) <= cutoff.scalar())
    return near.orderBy("sample_key", identifier).limit(rows)
