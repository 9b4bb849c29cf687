"""Running totals and cumulative distances against plain walks."""

import math
import random

from kerbside.operators.distributions import cumulative_distances, drift_report
from kerbside.operators.ranking import running_totals


def test_running_totals_over_many_partitions(spark):
    make = random.Random(4)
    rows = [(f"f{n:05d}", make.randrange(0, 50), n % 3) for n in range(3000)]
    shuffled = make.sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "name string, n long, m long").repartition(7)
    found = {r["name"]: (r["n_before"], r["m_before"]) for r in running_totals(frame, ["name"], ["n", "m"]).collect()}
    n_before = m_before = 0
    for name, n, m in rows:
        assert found.pop(name) == (n_before, m_before)
        n_before, m_before = n_before + n, m_before + m
    assert not found
    assert running_totals(frame.limit(0), ["name"], ["n"]).collect() == []


def plain_distance(left, right):
    values = {v for v in [*left, *right] if not math.isnan(v)}
    return max(abs(sum(x <= v for x in left) / len(left) - sum(x <= v for x in right) / len(right)) for v in values)


def test_cumulative_distances(spark):
    make = random.Random(5)
    left = [(make.gauss(0, 1), float(make.randrange(4)), 1.0) for _ in range(300)] + [(None, 7.0, 1.0), (0.5, -0.0, 1.0)]
    right = [(make.gauss(0.7, 2), float(make.randrange(6)), None) for _ in range(200)] + [(math.nan, 0.0, None)]
    schema = "a double, b double, c double"
    frames = [spark.createDataFrame(rows, schema) for rows in (left, right)]
    found = {r["feature"]: r["cumulative_distance"] for r in cumulative_distances(*frames, ["a", "b", "c"]).collect()}
    for at, name in enumerate("ab"):
        sides = [[row[at] for row in rows if row[at] is not None] for rows in (left, right)]
        assert math.isclose(found[name], plain_distance(*sides), abs_tol=1e-12)
    assert found["c"] is None
    assert cumulative_distances(frames[0].limit(0), frames[1].limit(0), ["a"]).collect() == []


def test_equal_measures_do_not_drift(spark):
    trips = spark.sql(
        "SELECT TIMESTAMP_NTZ'2024-01-02 03:00:00' AS pickup_datetime, 1S AS pickup_zone_id, 2S AS dropoff_zone_id,"
        " 2D AS trip_distance_miles, CAST(NULL AS SMALLINT) AS passenger_count, id * 1.5D AS score FROM range(50)"
    )
    rows = drift_report(trips, trips, 0.01, measures=["score"]).collect()
    assert {r["feature"] for r in rows} >= {"score", "distance"}
    assert all(r["statistic"] == 0 and not r["drifted"] and r["action"] == "none" for r in rows)
    moved = drift_report(trips, trips.withColumn("score", trips.score + 1000), 0.01, measures=["score"]).collect()
    assert {r["feature"] for r in moved if r["drifted"]} == {"score"} and {r["action"] for r in moved} == {"alert"}
