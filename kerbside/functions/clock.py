"""Time expressions as Spark SQL text, and calendar months.

Expressions are templates: ``HOUR_OF_WEEK_SUNDAY.format("pickup_datetime")``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime

from kerbside.errors import DataContractError

MICROS = 1_000_000
LOCAL_ZONE = "America/New_York"


@dataclass(frozen=True, order=True)
class Month:
    """A calendar month between 2009 and 2100."""

    year: int
    number: int

    def __post_init__(self) -> None:
        if not (2009 <= self.year <= 2100 and 1 <= self.number <= 12):
            raise DataContractError(f"no such month: {self.year}-{self.number}")

    @classmethod
    def parse(cls, text: str) -> "Month":
        found = re.fullmatch(r"([0-9]{4})-([0-9]{2})", text)
        if found is None:
            raise DataContractError(f"expected YYYY-MM, got {text!r}")
        return cls(int(found[1]), int(found[2]))

    def shift(self, months: int) -> "Month":
        years, index = divmod(self.number - 1 + months, 12)
        return Month(self.year + years, index + 1)

    @property
    def start(self) -> datetime:
        return datetime(self.year, self.number, 1)

    @property
    def end(self) -> datetime:
        return datetime(self.year + self.number // 12, self.number % 12 + 1, 1)

    def __str__(self) -> str:
        return f"{self.year:04d}-{self.number:02d}"


# Microseconds since 1970 of a wall-clock or absolute timestamp (session zone UTC), and back.
MICROS_OF = "unix_micros(CAST({0} AS TIMESTAMP))"
FROM_MICROS = "CAST(timestamp_micros({0}) AS TIMESTAMP_NTZ)"

# Whole seconds, truncated toward zero.
SECONDS_BETWEEN = (
    "CAST((unix_micros(CAST({1} AS TIMESTAMP)) - unix_micros(CAST({0} AS TIMESTAMP)))"
    " div 1000000 AS INT)"
)

# 0..167 from Sunday midnight: the convention of features and requests.
HOUR_OF_WEEK_SUNDAY = "CAST((dayofweek({0}) - 1) * 24 + hour({0}) AS SMALLINT)"

# 0..167 from Monday midnight: the convention of workload profiles.
HOUR_OF_WEEK_MONDAY = "CAST(weekday({0}) * 24 + hour({0}) AS SMALLINT)"


def naive(moment: datetime) -> str:
    """A wall-clock literal without a zone."""
    return f"TIMESTAMP_NTZ'{moment.isoformat(sep=' ')}'"


def within(column: str, start: datetime, end: datetime) -> str:
    """Half-open range test."""
    return f"{column} >= {naive(start)} AND {column} < {naive(end)}"


def to_local(utc: str, zone: str = LOCAL_ZONE) -> str:
    """Wall clock in ``zone`` of a UTC wall clock."""
    return f"convert_timezone('UTC', '{zone}', {utc})"


def to_utc(local: str, zone: str = LOCAL_ZONE) -> str:
    return f"convert_timezone('{zone}', 'UTC', {local})"


def near_offset_change(local: str, zone: str = LOCAL_ZONE) -> str:
    """True when the offset differs between a day before and a day after: a cheap first test."""
    before = to_local(f"{local} - INTERVAL 1 DAY", zone)
    after = to_local(f"{local} + INTERVAL 1 DAY", zone)
    return f"({before} + INTERVAL 2 DAYS <> {after})"


def is_nonexistent_local(local: str, zone: str = LOCAL_ZONE) -> str:
    """True inside the hour a spring change skips: the round trip lands elsewhere."""
    return f"({to_local(to_utc(local, zone), zone)} <> {local})"


def is_ambiguous_local(local: str, zone: str = LOCAL_ZONE) -> str:
    """True when two instants share the wall clock, whichever of them the engine picks."""
    later = to_local(f"{to_utc(local, zone)} + INTERVAL 1 HOUR", zone)
    earlier = to_local(f"{to_utc(local, zone)} - INTERVAL 1 HOUR", zone)
    return (
        f"(NOT {is_nonexistent_local(local, zone)}"
        f" AND ({later} = {local} OR {earlier} = {local}))"
    )


def names_one_instant(local: str, zone: str = LOCAL_ZONE) -> str:
    """True for wall clocks that are neither skipped nor repeated; stops early far from a change."""
    instant = to_utc(local, zone)
    twin = " OR ".join(
        f"{to_local(f'{instant} {sign} INTERVAL 1 HOUR', zone)} = {local}" for sign in "+-"
    )
    return (
        f"NOT ({near_offset_change(local, zone)}"
        f" AND ({to_local(instant, zone)} <> {local} OR {twin}))"
    )
