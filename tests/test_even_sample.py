"""Evenly spaced rows against a plain sort."""

import math
import random
from datetime import datetime, timedelta

import pytest

from kerbside.operators.ranking import even_sample, near_picks

make = random.Random(8)
START = datetime(2024, 3, 9)
FIRST = {
    "long": ("long", [make.randrange(10**15) for _ in range(900)]),
    "hot": ("long", [7] * 400 + [make.randrange(1000) for _ in range(500)]),
    "one": ("int", [5] * 300),
    "clock": ("timestamp_ntz", [START + timedelta(seconds=make.randrange(200_000)) for _ in range(900)]),
    "instant": ("timestamp", [START + timedelta(microseconds=make.randrange(10**9)) for _ in range(500)]),
    "day": ("date", [(START + timedelta(days=make.randrange(30))).date() for _ in range(500)]),
    "double": ("double", [make.gauss(0, 1e9) for _ in range(500)] + [math.inf, -math.inf, math.nan, None, None, -0.0]),
    "wide": ("double", [-1.7e308, 1.7e308, 0.0, 5.0]),
    "text": ("string", [f"{make.randrange(10**6)}" for _ in range(300)]),
    "single": ("long", [3]),
    "none": ("long", [None, None, None]),
}


def rank(value):
    if value is None:
        return (0, 0)
    if isinstance(value, float) and math.isnan(value):
        return (2, 0)
    return (1, value)


@pytest.mark.parametrize("name", list(FIRST))
def test_against_a_plain_sort(spark, name):
    kind, values = FIRST[name]
    rows = [(value, f"k{n:04d}") for n, value in enumerate(values)]
    frame = spark.createDataFrame(make.sample(rows, len(rows)), f"a {kind}, b string").repartition(5)
    ordered = [b for _, b in sorted(rows, key=lambda row: (rank(row[0]), row[1]))]
    for wanted in (1, 7, 5000):
        found = {r["pick"]: (r["position"], r["b"]) for r in even_sample(frame, wanted, ["a", "b"]).collect()}
        picks = min(wanted, len(rows))
        places = [0] if picks == 1 else [i * (len(rows) - 1) // (picks - 1) for i in range(picks)]
        assert found == {i: (place, ordered[place]) for i, place in enumerate(places)}
    assert even_sample(frame.limit(0), 3, ["a", "b"]).collect() == []


def test_only_ranges_with_a_pick_are_sorted(spark):
    frame = spark.range(100_000).selectExpr("id * 37 % 100000 AS a", "id AS b")
    assert near_picks(frame, 50, ["a", "b"]).count() <= 50 * 2
