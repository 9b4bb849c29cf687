"""Streams against their batch twins, restarts, lateness and the snapshot store."""

from datetime import datetime, timedelta

import pytest

from kerbside import schemas
from kerbside.errors import PublishConflict
from kerbside.operators import delivery
from kerbside.streaming import jobs, joins, windows

START = datetime(2024, 1, 5)


def trips(spark, minutes, first=0):
    rows = [
        (f"t{first + n}", START + timedelta(minutes=m), START + timedelta(minutes=m + 1), 1 + n % 2, 3, 2.0, 1, 5.0, 60, n, "1.0")
        for n, m in enumerate(minutes)
    ]
    return spark.createDataFrame(rows, schemas.SILVER)


def feed(spark, folder):
    return spark.readStream.schema(schemas.SILVER).option("maxFilesPerTrigger", 1).parquet(folder)


def closed(frame, newest, lateness=300):
    return frame.where(f"window_end <= TIMESTAMP_NTZ'{newest - timedelta(seconds=lateness)}'")


def test_windows_equal_batch_over_restarts(spark, tmp_path):
    folder, out, check = (str(tmp_path / name) for name in ("in", "out", "check"))
    trips(spark, range(0, 90, 3)).coalesce(1).write.mode("append").parquet(folder)
    stream = windows.zone_windows(windows.zone_completions(feed(spark, folder)), slide_seconds=300)
    jobs.drain(stream, out, check)
    trips(spark, range(90, 200, 3), first=500).coalesce(1).write.mode("append").parquet(folder)
    stream = windows.zone_windows(windows.zone_completions(feed(spark, folder)), slide_seconds=300)
    got, _ = jobs.drain(stream, out, check)
    batch = windows.zone_windows(windows.zone_completions(spark.read.parquet(folder)), slide_seconds=300)
    expected = closed(batch, START + timedelta(minutes=199))
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, expected.collect())) and len(rows) > 100
    assert got.where("source_max_event_time >= window_end OR source_max_event_time < window_start").count() == 0


def test_late_events_never_change_closed_windows(spark, tmp_path):
    folder = str(tmp_path / "in")
    # Rows are dropped by the watermark of the batch before, so one lies in between.
    for first, minutes in ((0, [0, 1, 2, 120]), (100, [121]), (200, [3, 122])):
        trips(spark, minutes, first).coalesce(1).write.mode("append").parquet(folder)
    stream = windows.zone_windows(windows.zone_completions(feed(spark, folder)), slide_seconds=300)
    rows, progress = jobs.drain(stream)
    first = rows.where(f"zone_role = 'dropoff' AND window_kind = '60m' AND window_end = TIMESTAMP_NTZ'{START + timedelta(minutes=60)}'")
    assert first.first().trip_count == 3
    assert sum(op.numRowsDroppedByWatermark for p in progress for op in p.stateOperators) > 0
    arrivals = trips(spark, [0, 1, 2, 120]).selectExpr("1 AS batch", "dropoff_datetime AS event_time").unionByName(
        trips(spark, [3, 121]).selectExpr("2 AS batch", "dropoff_datetime AS event_time")
    )
    assert windows.late_events(arrivals).where("is_late").count() == 1


def snapshots(spark, *rows):
    """(zone, minute the window ends, trips), computed when the window ends."""
    columns = "feature_model_version string, zone_role string, zone_id int, window_kind string, window_end timestamp_ntz, computed_at timestamp_ntz, trip_count int"
    made = [("v", "pickup", zone, "15m", START + timedelta(minutes=m), START + timedelta(minutes=m), n) for zone, m, n in rows]
    return spark.createDataFrame(made, columns)


def held(store, **options):
    return {(r.zone_id, r.trip_count) for r in store.read(**options).collect()}


def test_store_keeps_newest_and_survives_replay(spark, tmp_path):
    store = jobs.SnapshotStore(spark, str(tmp_path / "store"))
    assert store.read() is None
    store.merge(snapshots(spark, (1, 10, 1), (1, 5, 2), (2, 5, 3)), 0)
    store.merge(snapshots(spark, (1, 7, 4), (2, 9, 5)), 1)
    store.merge(snapshots(spark, (1, 7, 4), (2, 9, 5)), 1)  # the same batch again
    assert held(store) == {(1, 1), (2, 5)}
    assert store.state()["buckets"] == {}  # nothing is compacted yet


def test_compaction_touches_its_buckets_and_drops_what_has_expired(spark, tmp_path):
    store = jobs.SnapshotStore(spark, str(tmp_path / "store"), buckets=4, pending=2, ttl_seconds=600)
    expected, due = {}, set()
    for batch in range(9):
        zones = range(1, 30) if batch == 0 else (1, 2)  # most keys change once
        store.merge(snapshots(spark, *[(zone, batch, 100 * batch + zone) for zone in zones]), batch)
        expected |= {zone: 100 * batch + zone for zone in zones}
        due = set(map(int, store.state()["buckets"]))
        assert held(store) == set(expected.items())
    changing = {int(p.name[7:]) for p in (tmp_path / "store/log/batch=8").glob("bucket=*")}
    assert changing and due <= changing and len(due) < 4
    written = [sum(f.stat().st_size for f in (tmp_path / f"store/log/batch={b}").rglob("*.parquet")) for b in (8,)]
    whole = sum(f.stat().st_size for f in (tmp_path / "store").rglob("*.parquet"))
    assert written[0] < whole / 2
    # ten minutes later most snapshots have outlived their time
    store.merge(snapshots(spark, (1, 17, 7)), 9)
    assert held(store) == {(1, 7), (2, 802)}
    assert len(held(store, now="TIMESTAMP_NTZ '2000-01-01 00:00:00'")) == 29
    assert store.compact(9, pending=0)
    assert held(store) == {(1, 7), (2, 802)}
    stored = held(store, now="TIMESTAMP_NTZ '2000-01-01 00:00:00'")
    assert {(1, 7), (2, 802)} <= stored and len(stored) < 29  # compacted buckets no longer hold what has expired
    assert store.compact(9, pending=0) == []


def test_of_two_compactions_one_is_refused(spark, tmp_path, monkeypatch):
    store = jobs.SnapshotStore(spark, str(tmp_path / "store"), buckets=2, pending=50)
    for batch in range(3):
        store.merge(snapshots(spark, (1, batch, batch), (2, batch, batch)), batch)
    other, put = jobs.SnapshotStore(spark, store.path, buckets=2), jobs.storage.put_if_absent
    once = []

    def meanwhile(*values):
        if not once:
            once.append(1)
            other.compact(2, pending=0)
        return put(*values)

    monkeypatch.setattr(jobs.storage, "put_if_absent", meanwhile)
    with pytest.raises(PublishConflict):
        store.compact(2, pending=0)
    assert held(store) == {(1, 2), (2, 2)}


def test_duplicates_go(spark, tmp_path):
    folder = str(tmp_path / "in")
    trips(spark, [0, 1]).coalesce(1).write.mode("append").parquet(folder)
    trips(spark, [0, 1]).coalesce(1).write.mode("append").parquet(folder)
    kept, _ = jobs.drain(joins.without_duplicates(feed(spark, folder), "trip_id", "pickup_datetime"))
    assert kept.count() == 2


def test_unmatched_predictions_come_out_after_the_wait(spark, tmp_path):
    folder = str(tmp_path / "in")
    trips(spark, [0, 10, 600]).coalesce(1).write.parquet(folder)
    predictions = feed(spark, folder).selectExpr(
        "concat('p', trip_id) AS prediction_id", "trip_id", "pickup_datetime AS served_at", "50D AS estimated_duration_seconds"
    )
    completed = feed(spark, folder).where("trip_id <> 't1'").selectExpr(
        "trip_id", "dropoff_datetime AS event_time", "actual_duration_seconds"
    )
    rows, _ = jobs.drain(joins.stream_ground_truth(predictions, completed, 3600))
    got = {r.trip_id: (r.joined, r.absolute_error_seconds) for r in rows.collect()}
    assert got == {"t0": (True, 10.0), "t1": (False, None), "t2": (True, 10.0)}


def served(spark, folder, source=None):
    """Predictions and completions of a folder of trips, one completion of seven lost."""
    rows = source or feed(spark, folder)
    predictions = rows.selectExpr(
        "concat('p', trip_id) AS prediction_id", "trip_id", "pickup_datetime AS served_at", "50D + source_row_number AS estimated_duration_seconds"
    )
    completed = rows.where("source_row_number % 7 <> 3").selectExpr("trip_id", "dropoff_datetime AS event_time", "actual_duration_seconds")
    return predictions, completed


def test_live_error_equals_its_batch_over_restarts(spark, tmp_path):
    folder, out, check = (str(tmp_path / name) for name in ("in", "out", "check"))
    for first, minutes in ((0, range(0, 90, 2)), (500, range(90, 200, 2)), (900, range(200, 330, 2))):
        trips(spark, minutes, first).coalesce(1).write.mode("append").parquet(folder)
        stream = joins.stream_live_error(*served(spark, folder), 1800, 600)
        got, _ = jobs.drain(stream, out, check)
    batch = delivery.live_error(delivery.ground_truth(*served(spark, folder, spark.read.parquet(folder)), 1800), 600)
    newest = START + timedelta(minutes=328)
    over = newest - timedelta(seconds=300 + 1800)
    expected = batch.where(f"window_start + INTERVAL 600 SECONDS < TIMESTAMP_NTZ'{over}'")
    rows = sorted(map(str, got.collect()))
    assert rows == sorted(map(str, expected.collect())) and len(rows) == 29
    assert 0 < got.agg({"coverage": "min"}).first()[0] < got.agg({"coverage": "max"}).first()[0] <= 1


def test_live_error_waits_for_the_last_completion_of_a_window(spark, tmp_path):
    folder = str(tmp_path / "in")
    # The window is long over, but the wait of its prediction is not.
    trips(spark, [0, 40]).coalesce(1).write.mode("append").parquet(folder)
    assert jobs.drain(joins.stream_live_error(*served(spark, folder), 3600, 600))[0].count() == 0
    trips(spark, [120], first=9).coalesce(1).write.mode("append").parquet(folder)
    rows = jobs.drain(joins.stream_live_error(*served(spark, folder), 3600, 600))[0].orderBy("window_start").collect()
    assert [(r.window_start, r.predictions, r.joined_predictions) for r in rows] == [
        (START, 1, 1), (START + timedelta(minutes=40), 1, 1)
    ]
