"""Splitting groups that hold too many rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_GROUP = 4_000_000


def crowded(counts: DataFrame, keys: list[str], rows_per_group: int = ROWS_PER_GROUP) -> DataFrame:
    """Keys with more than ``rows_per_group`` rows and the number of parts to cut them into.

    ``counts`` has partial counts in ``_rows``. At most rows / rows_per_group keys
    can qualify, so the result stays small enough to broadcast whatever the size
    of the data; counting is combined before the shuffle.
    """
    return (
        counts.groupBy(*keys)
        .agg(F.expr("sum(_rows) AS _rows"))
        .where(f"_rows > {rows_per_group}")
        .selectExpr(*keys, f"CAST(ceil(_rows / {rows_per_group}) AS INT) AS _parts")
    )


def timed_parts(frame: DataFrame, hot: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Rows of a hot slice with the number ``_part`` of their even share of its time; others have part 0.

    ``_us`` lies in the slice, ``width`` long, or just before it. ``_parts`` is NULL where the slice is not hot.
    """
    return frame.join(F.broadcast(hot), keys, "left").selectExpr(
        *frame.columns,
        f"CAST(coalesce(greatest(((_us - _slice * {width}) * _parts) div {width}, 0), 0) AS INT) AS _part",
        "_parts",
    )


def spread_rows(frame: DataFrame, hot: DataFrame, keys: list[str], by: Sequence[str]) -> DataFrame:
    """Rows of a hot key with a part by the hash of ``by``; others have part 0."""
    return frame.join(F.broadcast(hot), keys, "left").selectExpr(
        *frame.columns, f"CAST(coalesce(pmod(xxhash64({', '.join(by)}), _parts), 0) AS INT) AS _part"
    )


def copied_rows(frame: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Every row once for each part of its key."""
    return frame.join(F.broadcast(hot), keys, "left").selectExpr(
        *frame.columns, "explode(sequence(0, coalesce(_parts, 1) - 1)) AS _part"
    )
