"""Run history kept as appended lifecycle records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values ---
TERMINAL = ("accepted", "quarantined", "failed")
# --- end of fixed values ---


def lineage_state(log: DataFrame) -> DataFrame:
    """Current state per run from records ``(run_id, seq, status, ...)``.

    A run ends once and only after it started; anything else is illegal. The
    first terminal record decides, as later ones find no running run.
    """
    ended = "status IN (" + ", ".join(f"'{s}'" for s in TERMINAL) + ")"
    rest = [name for name in log.columns if name not in ("run_id", "seq")]
    record = f"struct({', '.join(rest)})"
    return (
        log.groupBy("run_id")
        .agg(
            F.expr(f"min_by({record}, seq) FILTER (WHERE {ended}) AS _end"),
            F.expr(f"min_by({record}, seq) FILTER (WHERE status = 'running') AS _start"),
            F.expr(f"count_if({ended}) AS terminal_records"),
            F.expr("count_if(status = 'running') AS start_records"),
            F.expr(f"min(CASE WHEN {ended} THEN seq END) AS _end_seq"),
            F.expr("min(CASE WHEN status = 'running' THEN seq END) AS _start_seq"),
        )
        .selectExpr("*", "coalesce(_end, _start) AS _state")
        .selectExpr(
            "run_id",
            "_state.*",
            "terminal_records",
            "NOT (start_records = 1 AND terminal_records <= 1"
            " AND coalesce(_end_seq > _start_seq, true)) AS illegal_transition",
        )
    )


def lineage_chain(
    training: DataFrame, gold: DataFrame, gold_inputs: DataFrame, workloads: DataFrame
) -> DataFrame:
    """Whether each workload, gold month and holdout rest on the same files.

    ``training`` has run_id, holdout_month and holdout_sha256; ``gold`` month
    and output_sha256; ``gold_inputs`` month, input_month and sha256;
    ``workloads`` run_id, month and silver_sha256. One row per run.
    """
    used = gold_inputs.where("input_month = month").selectExpr("month", "sha256 AS _silver").distinct()
    made = gold.selectExpr("month", "output_sha256 AS _gold")
    joined = (
        training.join(workloads.selectExpr("run_id", "month AS _workload_month", "silver_sha256"), "run_id", "left")
        .withColumnRenamed("holdout_month", "month")
        .join(made, "month", "left")
        .join(used.withColumnRenamed("_silver", "silver_sha256").withColumn("_used", F.lit(True)), ["month", "silver_sha256"], "left")
    )
    checks = {
        "workload_month_matches": "_workload_month = month",
        "gold_digest_matches": "_gold = holdout_sha256",
        "silver_is_gold_input": "_used",
    }
    judged = joined.selectExpr("run_id", *[f"coalesce({t}, false) AS {n}" for n, t in checks.items()])
    return judged.selectExpr("*", " AND ".join(checks) + " AS verified")


def run_checks(runs: DataFrame, checks: DataFrame) -> DataFrame:
    """Quality checks of known runs in rule order."""
    return (
        checks.join(runs.selectExpr("run_id", "partition_key AS `partition`"), "run_id")
        .select("run_id", "partition", "rule", "violations", "total_rows", "threshold", "passed", "contract_version")
        .orderBy("run_id", "rule")
    )
