"""Helpers the training-data operators share.

Nulls, everywhere in this package: a null text is an empty text, a null id is
kept as it is. Operators never use a column name of their input for their own
columns (``fresh``), so clashing extra columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows in one Arrow batch: documents reach a few hundred kilobytes, and a Python
# worker must hold a batch next to its working arrays.
BATCH_ROWS = 1000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the given folder, in Arrow batches a worker can hold."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "0") or 0) not in range(1, BATCH_ROWS + 1):
        spark.conf.set(key, str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(frame: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of the frame has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def shuffled(frame: DataFrame) -> DataFrame:
    """The frame for joins by shuffle and sort alone, for tables with a row per document or more.

    Spark sizes an exploded table as the one before the explode, and a stored one by its compressed
    files, and broadcasts through the driver what it takes for small.
    """
    return frame.hint("merge")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder for a table that later jobs read, where every executor reaches it."""
    import uuid

    from kerbside.session import shared_folder

    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as a table in the shared folder and read again."""
    spark = frame.sparkSession
    path = scratch(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)
