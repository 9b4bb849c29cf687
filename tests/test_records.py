"""What the pipelines write about themselves, read by the lineage operators."""

import threading
from datetime import datetime, timedelta

import pytest
from pyspark.ml import PipelineModel

from kerbside.errors import DataContractError, PublishRefused
from kerbside.functions.clock import Month
from kerbside.operators import lineage
from kerbside.plans.gold import build_gold
from kerbside.plans.ingest import ingest_month
from kerbside.plans.training import train_month
from kerbside.plans.workload import build_workload, manifest_path
from kerbside.sources import runlog, storage
from tests.test_pipeline import raw, source


def trips(first, count):
    return [raw(pickup=first + timedelta(minutes=37 * n), pu=1 + n % 4, do=5 + n % 3, miles=1.0 + n % 9) for n in range(count)]


def test_runs_are_logged(spark, tmp_path):
    lake = str(tmp_path / "lake")
    good = ingest_month(spark, source(spark, tmp_path, [raw()] * 4, "good"), "2024-01", lake)
    bad = ingest_month(spark, source(spark, tmp_path, [raw(), raw(pu=0)], "bad"), "2024-02", lake)
    assert good.accepted and not bad.accepted
    with pytest.raises(PublishRefused):
        ingest_month(spark, source(spark, tmp_path, [raw(pu=0)], "none"), "2024-03", lake, threshold=1)
    states = lineage.lineage_state(runlog.records(spark, lake)).collect()
    assert sorted((s.partition_key, s.status, s.illegal_transition) for s in states) == [
        ("2024-01", "accepted", False), ("2024-02", "quarantined", False), ("2024-03", "failed", False),
    ]
    assert {s.error for s in states if s.status == "failed"} == {"PublishRefused"}
    found = lineage.run_checks(runlog.records(spark, lake).where("seq = 1"), runlog.checks(spark, lake)).collect()
    assert len(found) == 20 and {r.partition for r in found} == {"2024-01", "2024-02"}
    run = next(s.run_id for s in states if s.status == "accepted")
    with pytest.raises(DataContractError, match="not running"):
        runlog.finish_run(spark, lake, run, "failed")
    with pytest.raises(DataContractError, match="started"):
        runlog.start_run(spark, lake, run, "x")


def test_of_two_that_finish_a_run_one_is_refused(spark, tmp_path):
    lake = str(tmp_path / "lake")
    runlog.start_run(spark, lake, "r1", "2024-01")
    start, outcome = threading.Barrier(2), []

    def finish(status):
        start.wait()
        try:
            runlog.finish_run(spark, lake, "r1", status)
            outcome.append(status)
        except DataContractError:
            outcome.append("refused")

    threads = [threading.Thread(target=finish, args=(status,)) for status in ("accepted", "failed")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert outcome.count("refused") == 1
    written = runlog.records(spark, lake).where("seq = 2").collect()
    assert [r.status for r in written] == [s for s in outcome if s != "refused"]
    assert written[0].at.year >= 2024 and written[0].total_rows is None


def test_from_source_to_training(spark, tmp_path):
    lake = str(tmp_path / "lake")
    for month, day in (("2024-01", datetime(2024, 1, 2)), ("2024-02", datetime(2024, 2, 2))):
        ingest_month(spark, source(spark, tmp_path, trips(day, 60), month), month, lake)
        build_gold(spark, month, lake)
    build_workload(spark, "2024-02", lake, str(tmp_path / "requests"), rows=10)
    options = {"inference_p95_ms": 1.0, "min_train": 10, "min_holdout": 10, "trees": 2, "depth": 2}
    path = train_month(spark, lake, ["2024-01"], "2024-02", **options)
    PipelineModel.load(f"{path}/models/rolling")
    before = spark.read.json(f"{path}/manifest").first()
    assert train_month(spark, lake, ["2024-01"], "2024-02", **options) == path
    assert train_month(spark, lake, ["2024-01"], "2024-02", **{**options, "trees": 3}) != path

    training = spark.read.json(f"{path}/manifest").select("run_id", "holdout_month", "holdout_sha256")
    gold = storage.read_report(spark, storage.Layers(lake, Month.parse("2024-02")).gold_manifest())
    inputs = gold.selectExpr("month", "inline(inputs)").selectExpr("month", "input AS input_month", "sha256")
    workload = spark.read.json(manifest_path(str(tmp_path / "requests"))).selectExpr(f"'{before.run_id}' AS run_id", "month", "silver_sha256")
    chain = lineage.lineage_chain(training, gold.select("month", "output_sha256"), inputs, workload).first()
    assert chain.verified and chain.run_id == before.run_id

    # files that no longer are what their manifest says
    layers = storage.Layers(lake, Month.parse("2024-02"))
    storage.read(spark, layers.silver()).limit(5).write.mode("append").parquet(storage.location(spark, layers.silver()))
    with pytest.raises(DataContractError, match="differs from its report"):
        build_gold(spark, "2024-02", lake)
    storage.read(spark, layers.gold()).limit(5).write.mode("append").parquet(storage.location(spark, layers.gold()))
    with pytest.raises(DataContractError, match="differs from its manifest"):
        train_month(spark, lake, ["2024-01"], "2024-02", **options)
