"""A reproducible sample of requests from one accepted silver month."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kerbside.errors import DataContractError
from kerbside.functions import clock
from kerbside.functions.clock import Month
from kerbside.operators import distributions, ranking
from kerbside.session import reliable_checkpoint
from kerbside.plans.ingest import require_published
from kerbside.sources import storage
from kerbside.sources.files import MAX_REQUESTS, table_digest, write_lines
from kerbside.sources.storage import Layers

REQUEST_COLUMNS = (
    "trip_id",
    "pickup_time",
    "pickup_zone_id",
    "dropoff_zone_id",
    "trip_distance_miles",
    "passenger_count",
    "schema_version",
)


def requests_from(silver: DataFrame) -> DataFrame:
    """Trips as request messages: naive New York pickups become absolute times."""
    utc = clock.to_utc("pickup_datetime")
    return silver.selectExpr(
        "*",
        f"date_format({utc}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\") || 'Z' AS pickup_time",
        "contract_version AS schema_version",
    )


def sample_workload(
    silver: DataFrame, month: Month, contract_version: str, rows: int, seed: int = 42
) -> DataFrame:
    """``rows`` eligible trips in random order; fails when the input or the size is wrong."""
    if not 1 <= rows <= MAX_REQUESTS:
        raise DataContractError(f"a sample has 1 to {MAX_REQUESTS} rows")
    counts = distributions.eligibility(silver, month.start, month.end, contract_version).first()
    if counts.other_contract_rows:
        raise DataContractError("silver rows follow another contract version")
    if counts.outside_month_rows:
        raise DataContractError("silver rows lie outside the month")
    if counts.eligible_rows < rows:
        raise DataContractError(f"only {counts.eligible_rows} trips are eligible")
    return ranking.hash_sample(
        distributions.unambiguous_rows(silver, "pickup_datetime"), "trip_id", rows, seed
    )


def manifest_path(output: str) -> str:
    """Where the manifest of a workload lies: next to its lines."""
    return f"{output.rstrip('/')}-manifest"


def build_workload(
    spark: SparkSession, month: str, root: str, output: str, *, rows: int = 10_000, seed: int = 42
) -> DataFrame:
    """Write the sampled requests as lines; give the distance of sample and population."""
    when = Month.parse(month)
    layers = Layers(root.rstrip("/"), when)
    report = require_published(spark, layers)
    if report.status != "accepted" or report.month != month:
        raise DataContractError("a workload needs the matching accepted quality report")
    silver = storage.read(spark, layers.silver())
    if silver.count() != report.valid_rows:
        raise DataContractError("silver rows differ from the accepted quality report")
    if storage.exists(spark, output):
        raise DataContractError(f"{output} already exists")
    # At most MAX_REQUESTS rows, read by the writer and by the comparison.
    sample = reliable_checkpoint(sample_workload(silver, when, report.contract_version, rows, seed))
    fields = ", ".join(REQUEST_COLUMNS)
    write_lines(
        requests_from(sample), f"to_json(struct({fields}), map('ignoreNullFields', 'false'))", output
    )
    fixture = table_digest(spark, output)
    manifest = distributions.eligibility(silver, when.start, when.end, report.contract_version).selectExpr(
        f"'{month}' AS month",
        f"'{report.contract_version}' AS contract_version",
        f"{int(seed)} AS seed",
        f"{int(rows)} AS sampled_rows",
        "*",
        f"'{report.found_sha256}' AS silver_sha256",
        f"'{fixture.sha256}' AS fixture_sha256",
        f"{fixture.size_bytes} AS fixture_bytes",
    )
    storage.write_report(manifest, manifest_path(output))
    return distributions.histogram_distances(
        distributions.marginal_histograms(distributions.unambiguous_rows(silver, "pickup_datetime")),
        distributions.marginal_histograms(sample),
    )
