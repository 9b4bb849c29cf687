"""Plans that must hold at any size: no cross joins, no Python, pruned scans, few shuffles."""

import re
from datetime import datetime

import pytest

from kerbside import catalog
from kerbside.catalog.inputs import frame
from kerbside.operators import pointintime as pit

FOLDER = "/root/testdata/sf0.001"
# These run jobs of their own while they are built.
EAGER = {
    "zone_windows", "latest_snapshot", "feature_parity", "stream_events", "stream_dedup",
    "stream_ground_truth", "jsonl_requests", "gbt_scores", "even_sample", "topic_readback",
}


def plan_of(frame_):
    return frame_._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in EAGER])
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(catalog.queries()[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert operator not in plan


def test_lookback_reaches_the_scan(spark, tmp_path):
    frame(spark, FOLDER, "trips").write.parquet(str(tmp_path / "trips"))
    trips = spark.read.parquet(str(tmp_path / "trips"))
    pruned = pit.prune_lookback(trips, datetime(2024, 1, 15), datetime(2024, 1, 20), 3600).select("trip_id")
    plan = plan_of(pruned)
    assert "PushedFilters: [Or(And(" in plan
    assert "fare_amount" not in re.search(r"ReadSchema: \S+", plan)[0]


def test_gold_moves_trips_twice_and_joins_none(spark):
    plan = plan_of(
        pit.gold_features(frame(spark, FOLDER, "trips"), datetime(2024, 1, 1), datetime(2024, 2, 1), "v")
    )
    ledgers = re.findall(r"Exchange hashpartitioning\(_cell", plan)
    assert len(ledgers) == 2
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert len(re.findall(r"\bWindow \[.*\[_cell", plan)) == 2
