"""Bronze month to gated silver."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError, PublishRefused
from kerbside.functions.clock import Month
from kerbside.operators import quality
from kerbside.sources import runlog, storage
from kerbside.sources.files import table_digest, with_source_rows
from kerbside.sources.storage import Layers


@dataclass(frozen=True)
class IngestResult:
    accepted: bool
    counts: Row
    layers: Layers


def ingest_month(
    spark: SparkSession,
    source: str,
    month: str,
    root: str,
    *,
    threshold: float = quality.DEFAULT_THRESHOLD,
    policy: str = "required",
    zones: Iterable[int] = quality.DEFAULT_ZONES,
) -> IngestResult:
    """Judge every row, then publish silver or quarantine the source.

    One pass stages silver and observes the counts of all rows on the way. They
    decide whether the staged table is published or discarded; a rejected month
    keeps the silver it had. Only a month with invalid rows is read once more.
    """
    when = Month.parse(month)
    layers = Layers(root.rstrip("/"), when)
    zones = list(zones)
    quality.contract_for(policy)
    bronze = with_source_rows(spark, [source])
    quality.require_columns(bronze, schemas.BRONZE_COLUMNS)
    narrow = bronze.select(*schemas.BRONZE_COLUMNS, "source_row_number")
    masked = quality.rule_masks(narrow, when, policy, zones)
    source_digest = table_digest(spark, source)
    run_id = uuid.uuid4().hex
    runlog.start_run(spark, layers.root, run_id, str(when))
    try:
        accepted, counted = _publish(spark, source, masked, layers, threshold, policy)
        counts = spark.createDataFrame([counted])
        silver = storage.digest(spark, layers.silver()) if accepted else None
        report = quality.partition_report(counts, when, source, policy, threshold).withColumns(
            {
                "run_id": F.lit(run_id),
                "source_sha256": F.lit(source_digest.sha256),
                "source_bytes": F.lit(source_digest.size_bytes),
                "silver_path": F.lit(layers.silver() if accepted else None).cast("string"),
                "silver_sha256": F.lit(silver.sha256 if silver else None).cast("string"),
                "rejected_source_path": F.lit(None if accepted else layers.rejected_source()).cast("string"),
                "invalid_rows_path": F.lit(
                    layers.invalid_rows() if counted.valid_rows < counted.total_rows else None
                ).cast("string"),
            }
        )
        storage.publish_report(report, layers.quality_report())
        checks = quality.quality_checks(counts, when, policy, threshold)
    except Exception as error:
        runlog.finish_run(spark, layers.root, run_id, "failed", error=type(error).__name__, source_sha256=source_digest.sha256)
        raise
    runlog.finish_run(
        spark, layers.root, run_id, "accepted" if accepted else "quarantined", checks,
        total_rows=counted.total_rows, valid_rows=counted.valid_rows,
        invalid_rows=counted.total_rows - counted.valid_rows, source_sha256=source_digest.sha256,
    )
    return IngestResult(accepted, counted, layers)


def _publish(
    spark: SparkSession, source: str, masked: DataFrame, layers: Layers, threshold: float, policy: str
) -> tuple[bool, Row]:
    """Stage, gate, and publish or quarantine; whether the month was accepted, and its counts."""
    when = layers.month
    seen = Observation()
    observed = masked.observe(seen, *quality.violation_measures())
    silver = storage.stage(quality.silver_rows(observed, when, policy), layers.silver())
    accepted = False
    try:
        counted = Row(**seen.get)
        counts = spark.createDataFrame([counted])
        accepted = quality.partition_gate(counts, threshold).first().status == "accepted"
        if accepted and counted.valid_rows == 0:
            accepted = False
            raise PublishRefused("an accepted month must hold at least one valid row")
    finally:
        if not accepted:
            storage.discard(spark, silver)
    if accepted:
        storage.publish(spark, silver)
        storage.retract(spark, layers.rejected_source())
    else:
        storage.publish(spark, storage.stage(spark.read.parquet(source), layers.rejected_source()))
    if counted.valid_rows < counted.total_rows:
        storage.publish(spark, storage.stage(quality.invalid_rows(masked), layers.invalid_rows()))
    else:
        storage.retract(spark, layers.invalid_rows())
    return accepted, counted


def require_published(spark: SparkSession, layers: Layers, month: Month | None = None) -> Row:
    """The accepted report of a month whose silver is still what the report describes."""
    month = month or layers.month
    if not (storage.published(spark, layers.silver(month)) and storage.published(spark, layers.quality_report(month))):
        raise DataContractError(f"no accepted silver for {month}")
    report = storage.read_report(spark, layers.quality_report(month)).first().asDict()
    # A later month that was rejected leaves the silver of the accepted one, whose digest the run log keeps.
    found = storage.digest(spark, layers.silver(month)).sha256
    if report["status"] == "accepted" and report.get("silver_sha256") != found:
        raise DataContractError(f"silver of {month} differs from its report")
    return Row(**(report | {"found_sha256": found}))
