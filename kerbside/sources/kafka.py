"""Predictions on a Kafka topic, written and read back as bounded tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.contracts import validate_contract


def write_topic(envelopes: DataFrame, servers: str, topic: str) -> None:
    """Send key, value and headers; the serving time stays inside the value."""
    (
        envelopes.select("key", "value", "headers")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .option("topic", topic)
        .save()
    )


def read_topic(spark: SparkSession, servers: str, topic: str, ending_offsets: str = "latest") -> DataFrame:
    """Everything from the first offset to the given end, as one finite table."""
    return (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("includeHeaders", "true")
        .option("startingOffsets", "earliest")
        .option("endingOffsets", ending_offsets)
        .load()
    )


def up_to(records: DataFrame, ends: Mapping[int, int]) -> DataFrame:
    """Records before the captured end offset of their partition."""
    tests = [f"(partition = {int(p)} AND offset < {int(end)})" for p, end in ends.items()]
    return records.where(" OR ".join(tests) or "false")


def published_predictions(records: DataFrame) -> DataFrame:
    """Topic records as what delivery reconciliation reads.

    ``envelope_ok`` compares key and headers with the message; the digest is
    that of the message text.
    """
    texts = records.selectExpr(
        "partition",
        "offset",
        "CAST(key AS STRING) AS _key",
        "CAST(value AS STRING) AS payload",
        "transform(headers, h -> struct(h.key AS key, CAST(h.value AS STRING) AS value)) AS _headers",
    )
    parsed = validate_contract(texts, "prediction-v1.1")

    def header(name: str) -> str:
        return f"element_at(filter(_headers, h -> h.key = '{name}'), -1).value"

    return parsed.selectExpr(
        "partition",
        "offset",
        "prediction_id",
        "trip_id",
        "model_version",
        "feature_fallback",
        "sha2(payload, 256) AS payload_sha256",
        f"coalesce(_key = trip_id AND {header('prediction-id')} = prediction_id"
        f" AND {header('schema-version')} = schema_version, false) AS envelope_ok",
        "is_valid",
    )


def end_offsets(records: DataFrame) -> DataFrame:
    return records.groupBy("partition").agg(F.expr("max(offset) + 1 AS end_offset"))
