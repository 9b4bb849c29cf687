"""Silver months to one tested gold month."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError, PublishRefused
from kerbside.functions.clock import Month
from kerbside.operators import pointintime, quality
from kerbside.plans.ingest import require_published
from kerbside.sources import storage
from kerbside.sources.storage import Layers


def failed_data_tests(gold: DataFrame) -> dict[str, int]:
    """Violations per data test, from one aggregate over the staged table and one for duplicates."""
    return {name: count for name, count in _measured(gold).items() if count and name != "rows"}


def _measured(gold: DataFrame) -> dict[str, int]:
    tests = {
        "accepted_values": quality.outside(
            "feature_model_version", schemas.FEATURES_BY_CONTRACT.values()
        ),
        "non_negative_counts": quality.NEGATIVE_COUNTS,
        "no_leakage": quality.LEAKING,
        "contract_agreement": quality.contract_disagreement(),
    }
    nulls = " + ".join(f"CAST(count_if({name} IS NULL) > 0 AS BIGINT)" for name in quality.GOLD_NOT_NULL)
    one = gold.agg(
        F.expr("count(1) AS rows"),
        F.expr(f"{nulls} AS not_null"),
        *[F.expr(f"count_if({test}) AS {name}") for name, test in tests.items()],
    ).first()
    return one.asDict() | {"unique": quality.duplicates(gold, "trip_id").count()}


def build_gold(spark: SparkSession, month: str, root: str, **options) -> DataFrame:
    """Read the month and, if there, the one before; write, test and publish features."""
    when = Month.parse(month)
    layers = Layers(root.rstrip("/"), when)
    own = require_published(spark, layers)
    months = [m for m in (when.shift(-1), when) if storage.published(spark, layers.silver(m))]
    parts = [
        storage.read(spark, layers.silver(m)).withColumn("input", F.lit(str(m))) for m in months
    ]
    silver = parts[0]
    for part in parts[1:]:
        silver = silver.unionByName(part, allowMissingColumns=True)

    gate = quality.version_gate(silver, schemas.FEATURES_BY_CONTRACT).collect()
    if not all(row.single_supported and row.versions_agree for row in gate):
        raise DataContractError("inputs need one supported and equal contract version")
    version = parts[-1].select("contract_version").first().contract_version

    features = pointintime.gold_features(
        pointintime.stage_trips(silver),
        when.start,
        when.end,
        schemas.FEATURES_BY_CONTRACT[version],
        **options,
    )
    staged = storage.stage(features, layers.gold(), compression="zstd")
    measured = _measured(spark.read.parquet(staged.folder))
    failures = {name: count for name, count in measured.items() if count and name != "rows"}
    if failures:
        storage.discard(spark, staged)
        raise PublishRefused(f"data tests failed: {failures}")
    storage.publish(spark, staged)

    published = storage.read(spark, layers.gold())
    output = storage.digest(spark, layers.gold())
    digests = {str(m): (own if m == when else require_published(spark, layers, m)).found_sha256 for m in months}
    settings = json.dumps({"windows": pointintime.WINDOWS, **{k: str(v) for k, v in options.items()}}, sort_keys=True)
    known = spark.createDataFrame(list(digests.items()), "input string, sha256 string")
    inputs = silver.groupBy("input").agg(F.expr("count(1) AS rows")).join(known, "input")
    manifest = inputs.agg(
        F.expr("sum(rows) AS input_rows"),
        F.expr("sort_array(collect_list(struct(input, rows, sha256))) AS inputs"),
    ).withColumns(
        {
            "row_count": F.lit(measured["rows"]).cast("long"),
            "month": F.lit(month),
            "output_path": F.lit(layers.gold()),
            "output_sha256": F.lit(output.sha256),
            "output_bytes": F.lit(output.size_bytes),
            "output_files": F.lit(output.files),
            "settings": F.lit(settings),
            "settings_sha256": F.sha2(F.lit(settings), 256),
            "contract_version": F.lit(version),
            "feature_model_version": F.lit(schemas.FEATURES_BY_CONTRACT[version]),
            "built_at": F.current_timestamp(),
        }
    )
    storage.publish_report(manifest, layers.gold_manifest())
    return published
