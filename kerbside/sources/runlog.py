"""The run log: lifecycle records and checks, appended and never changed.

A record is a file of its own, named by run and sequence number and put only
where there is none, so of two writers of the same record the second is refused.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.errors import DataContractError
from kerbside.operators.lineage import TERMINAL, lineage_state
from kerbside.sources import storage

RECORD = (
    "run_id string, seq int, status string, at timestamp, partition_key string, total_rows bigint,"
    " valid_rows bigint, invalid_rows bigint, source_sha256 string, error string"
)
CHECK = (
    "run_id string, rule string, violations bigint, total_rows bigint, threshold double, passed boolean,"
    " contract_version string"
)


def _path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/lineage/{table}"


def _append(spark: SparkSession, root: str, **values) -> None:
    names = [field.split()[0] for field in RECORD.split(", ")]
    record = {name: values.get(name) for name in names} | {"at": values["at"].isoformat()}
    path = f"{_path(root, 'runs')}/{values['run_id']}-{values['seq']}.json"
    if not storage.put_if_absent(spark, path, json.dumps(record)):
        raise DataContractError(f"record {values['seq']} of run {values['run_id']} is written already")


def records(spark: SparkSession, root: str) -> DataFrame:
    """All lifecycle records; none before the first run."""
    path = _path(root, "runs")
    if not storage.exists(spark, path):
        return spark.createDataFrame([], RECORD)
    return spark.read.schema(RECORD).option("pathGlobFilter", "*.json").json(path)


def checks(spark: SparkSession, root: str) -> DataFrame:
    path = _path(root, "checks")
    if not storage.exists(spark, path):
        return spark.createDataFrame([], CHECK)
    return spark.read.schema(CHECK).parquet(path)


def start_run(spark: SparkSession, root: str, run_id: str, partition_key: str) -> None:
    if not records(spark, root).where(F.col("run_id") == run_id).isEmpty():
        raise DataContractError(f"run {run_id} has started before")
    _append(spark, root, run_id=run_id, seq=1, status="running", at=datetime.now(UTC), partition_key=partition_key)


def finish_run(spark: SparkSession, root: str, run_id: str, status: str, found: DataFrame | None = None, **values) -> None:
    """End a running run, with the checks it made; any other run is refused."""
    if status not in TERMINAL:
        raise DataContractError(f"{status} does not end a run")
    state = lineage_state(records(spark, root).where(F.col("run_id") == run_id)).first()
    if state is None or state.status != "running":
        raise DataContractError(f"run {run_id} is not running")
    _append(spark, root, run_id=run_id, seq=2, status=status, at=datetime.now(UTC), partition_key=state.partition_key, **values)
    # only the one whose record stands adds its checks
    if found is not None:
        made = found.selectExpr(f"'{run_id}' AS run_id", "rule", "CAST(violations AS BIGINT) AS violations", "total_rows", "threshold", "passed", "contract_version")
        made.coalesce(1).write.mode("append").parquet(_path(root, "checks"))
