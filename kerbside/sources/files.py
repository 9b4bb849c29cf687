"""Reading and checking files, and scratch space for written tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kerbside.errors import DataContractError
from kerbside.operators.contracts import validate_contract
from kerbside.operators.ranking import running_totals
from kerbside.session import shared_folder

# --- fixed values ---
PARQUET_MAGIC = "50415231"  # PAR1 as hex
MAX_REQUESTS = 100_000
# --- end of fixed values ---


# Files up to this size are values of a row; longer ones are streamed, with the same result.
ONE_VALUE_BYTES = 1 << 28
CHUNK_BYTES = 1 << 22


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of the cluster."""
    return f"{shared_folder(spark).rstrip('/')}/kerbside-{name}-{uuid.uuid4().hex}"


def with_source_rows(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Rows with a 0-based ``source_row_number``, unique over all files.

    The reader numbers the rows of each file without a shuffle. With several
    files, in path order, each starts where the one before ended; counting
    them reads no data column, and what files hold before each other is a
    running total over partitions of the list.
    """
    read = spark.read.parquet(*paths)
    if len(read.inputFiles()) <= 1:
        return read.selectExpr("*", "_metadata.row_index AS source_row_number")
    files = (
        read.selectExpr("_metadata.file_path AS _file")
        .groupBy("_file")
        .agg(F.expr("count(1) AS _rows"))
    )
    first = running_totals(files, ["_file"], ["_rows"])
    placed = read.selectExpr("*", "_metadata.file_path AS _file", "_metadata.row_index AS _row")
    # Spark broadcasts the list if it is small.
    return placed.join(first, "_file").selectExpr(
        *read.columns, "_rows_before + _row AS source_row_number"
    )


def _opened(path: str):
    """A file of any store pyarrow knows, as a stream."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_stream(name)


def _streamed(batches):
    """Digest and magic bytes of each file, in chunks of a fixed size."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        for path, size in zip(batch.column("path").to_pylist(), batch.column("size_bytes").to_pylist(), strict=True):
            digest, first, last = hashlib.sha256(), b"", b""
            with _opened(path) as stream:
                while chunk := stream.read(CHUNK_BYTES):
                    digest.update(chunk)
                    first, last = (first + chunk[:4])[:4], (last + chunk[-4:])[-4:]
            magic = bytes.fromhex(PARQUET_MAGIC)
            yield pa.RecordBatch.from_pydict(
                {
                    "path": [path],
                    "file_name": [path.rsplit("/", 1)[-1]],
                    "size_bytes": pa.array([size], pa.int64()),
                    "sha256": [digest.hexdigest()],
                    "is_parquet": [size > 8 and first == last == magic],
                }
            )


def file_manifest(spark: SparkSession, pattern: str | Sequence[str], one_value: int = ONE_VALUE_BYTES) -> DataFrame:
    """Path, size, SHA-256 and magic-byte check of every file, whatever its size.

    Files of at most ``one_value`` bytes are read as values by Spark. Longer ones
    are listed without their content and streamed, each in a task of its own.
    Spark lists no empty files.
    """
    listed = spark.read.format("binaryFile").load(pattern if isinstance(pattern, str) else list(pattern))
    fields = ["path", "element_at(split(path, '/'), -1) AS file_name", "length AS size_bytes"]
    small = listed.where(f"length <= {one_value}").selectExpr(
        *fields,
        "sha2(content, 256) AS sha256",
        f"length > 8 AND hex(substring(content, 1, 4)) = '{PARQUET_MAGIC}'"
        f" AND hex(substring(content, -4, 4)) = '{PARQUET_MAGIC}' AS is_parquet",
    )
    long = listed.where(f"length > {one_value}").selectExpr("path", "length AS size_bytes")
    streamed = long.repartition("path").mapInArrow(
        _streamed, "path string, file_name string, size_bytes bigint, sha256 string, is_parquet boolean"
    )
    return small.unionByName(streamed)


def table_digest(spark: SparkSession, path: str) -> Row:
    """sha256, size_bytes and files of a file, or of a folder by the digests of its files."""
    return combined(file_manifest(spark, path)).first()


def combined(files: DataFrame) -> DataFrame:
    """One digest of many files: that of their sorted digests, or that of the only one."""
    return files.agg(
        F.expr("CASE WHEN count(1) = 1 THEN max(sha256) ELSE sha2(array_join(array_sort(collect_list(sha256)), ','), 256) END AS sha256"),
        F.expr("coalesce(sum(size_bytes), 0) AS size_bytes"),
        F.expr("count(1) AS files"),
    )


def verify_manifest(claimed: DataFrame, found: DataFrame) -> DataFrame:
    """Claims about files next to what is there; ``verified`` only if all agree."""
    actual = found.selectExpr("path", "size_bytes AS _size", "sha256 AS _sha256", "is_parquet AS _parquet")
    return claimed.join(actual, "path", "left").selectExpr(
        *claimed.columns,
        "coalesce(size_bytes = _size AND sha256 = _sha256 AND _parquet, false) AS verified",
    )


def read_requests(spark: SparkSession, path: str, max_rows: int | None = MAX_REQUESTS) -> DataFrame:
    """Request lines as validated rows, blank lines skipped.

    The lines are counted first, no further than needed: there must be at least
    one and no more than ``max_rows``; None is no upper bound.
    """
    lines = spark.read.text(path).where("trim(value) <> ''").withColumnRenamed("value", "payload")
    count = lines.limit((max_rows or 0) + 1).count()
    if count == 0:
        raise DataContractError("no requests in the fixture")
    if max_rows is not None and count > max_rows:
        raise DataContractError(f"more than {max_rows} requests in the fixture")
    return validate_contract(lines, "eta-request")


def write_lines(rows: DataFrame, text: str, path: str) -> None:
    """One JSON text per line."""
    rows.select(F.expr(text).alias("value")).write.mode("errorifexists").text(path)
