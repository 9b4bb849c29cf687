"""Paths of the layers, and tables that are replaced as a whole.

A table is a folder of versions that never change, ``_v<number>-<token>``, and
of small pointers, ``_pointers/<number>``, each naming one of them. The pointer
with the highest number is what readers follow, so they see a whole old table
or a whole new one. A pointer is put only where none of its number is: of two
writers that started from the same version the second is refused. Old versions
are removed once two newer pointers exist; pointers stay, so that a number is
never used twice.

Next to a version lies the list of its files with sizes, times and digests.
Later checks read the bytes only of files whose size or time has changed.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from kerbside import schemas
from kerbside.errors import DataContractError, PublishConflict
from kerbside.functions.clock import Month


@dataclass(frozen=True)
class Layers:
    """Where the tables of one month live below a root that all executors can reach."""

    root: str
    month: Month

    def _partition(self, table: str, month: Month | None = None) -> str:
        return f"{table_path(self.root, table)}/month={month or self.month}"

    def silver(self, month: Month | None = None) -> str:
        return self._partition("silver", month)

    def invalid_rows(self) -> str:
        return self._partition("quarantine/invalid_rows")

    def rejected_source(self) -> str:
        return self._partition("quarantine/source")

    def quality_report(self, month: Month | None = None) -> str:
        return self._partition("quality", month)

    def gold(self, month: Month | None = None) -> str:
        return self._partition("gold", month)

    def gold_manifest(self) -> str:
        return self._partition("gold_manifests")


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}/{schemas.FLEET}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    files, target = _file_system(spark, path)
    files.delete(target, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, in order; nothing if there is none."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file at once and whole, unless there is one; whether it was written.

    Local files are linked into place, elsewhere a finished file is renamed: the
    store must refuse to rename onto an existing file, as HDFS does.
    """
    folder, name = path.rsplit("/", 1)
    files, made = _file_system(spark, f"{folder}/_writing-{uuid.uuid4().hex}")
    _, target = _file_system(spark, path)
    files.mkdirs(made.getParent())
    stream = files.create(made, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    try:
        if files.getUri().getScheme() != "file":
            return not files.exists(target) and files.rename(made, target)
        os.link(made.toUri().getPath(), target.toUri().getPath())
        return True
    except FileExistsError:
        return False
    finally:
        files.delete(made, False)


def get_text(spark: SparkSession, path: str) -> str:
    files, target = _file_system(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@dataclass(frozen=True)
class Version:
    """A version of a table; ``folder`` is empty where the table was withdrawn."""

    number: int
    folder: str


NOTHING = Version(0, "")


def _pointers(path: str) -> str:
    return f"{path}/_pointers"


def current(spark: SparkSession, path: str) -> Version:
    """What the newest pointer names; ``NOTHING`` before the first."""
    numbers = [int(name) for name in names(spark, _pointers(path)) if name.isdigit()]
    if not numbers:
        return NOTHING
    folder = get_text(spark, f"{_pointers(path)}/{max(numbers):08d}")
    return Version(max(numbers), f"{path}/{folder}" if folder else "")


def published(spark: SparkSession, path: str) -> bool:
    return bool(current(spark, path).folder)


def location(spark: SparkSession, path: str) -> str:
    """The folder of the current version."""
    folder = current(spark, path).folder
    if not folder:
        raise DataContractError(f"no table at {path}")
    return folder


def read(spark: SparkSession, path: str) -> DataFrame:
    """The current version; what is read stays there until two newer ones are published."""
    return spark.read.parquet(location(spark, path))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The current versions of all months of a table, with their ``month`` column; filters on it prune files."""
    top = table_path(root, table)
    months = [f"{top}/{name}" for name in names(spark, top) if name.startswith("month=")]
    folders = [folder for month in months if (folder := current(spark, month).folder)]
    if not folders:
        raise DataContractError(f"no table at {top}")
    return spark.read.option("basePath", top).parquet(*folders)


@dataclass(frozen=True)
class Staged:
    """A written version that no pointer names yet, and the version it is to replace."""

    path: str
    folder: str
    replaces: int


def stage(frame: DataFrame, path: str, **options: str) -> Staged:
    """Write a version of the table at ``path``; readers do not see it."""
    spark = frame.sparkSession
    replaces = current(spark, path).number
    staged = Staged(path, f"{path}/_v{replaces + 1:08d}-{uuid.uuid4().hex}", replaces)
    writer = frame.write
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.parquet(staged.folder)
    return staged


def discard(spark: SparkSession, staged: Staged) -> None:
    """Remove a version that was not published."""
    remove(spark, staged.folder)
    remove(spark, _listing(staged.folder))


def _point(spark: SparkSession, path: str, replaces: int, folder: str) -> bool:
    """Put the pointer behind ``replaces``; false if another one is there."""
    return put_if_absent(spark, f"{_pointers(path)}/{replaces + 1:08d}", folder)


def publish(spark: SparkSession, staged: Staged, keep: int = 2) -> None:
    """Make a staged version the current one, if none came since it was staged.

    Its files are listed with their digests first, so a table that readers see
    has its list. The version before stays for those who read it.
    """
    files, folder = _file_system(spark, staged.folder)
    if not files.exists(folder):
        raise OSError(f"nothing staged at {staged.folder}")
    _list_files(spark, staged.folder)
    if not _point(spark, staged.path, staged.replaces, staged.folder.rsplit("/", 1)[1]):
        discard(spark, staged)
        raise PublishConflict(f"another version of {staged.path} was published since {staged.replaces}")
    expire(spark, staged.path, keep)


def retract(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Withdraw a table: its newest pointer names nothing."""
    now = current(spark, path)
    if now.folder:
        if not _point(spark, path, now.number, ""):
            raise PublishConflict(f"another version of {path} was published since {now.number}")
        expire(spark, path, keep)


def expire(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove the versions that all but the newest ``keep`` pointers name."""
    numbers = [name for name in names(spark, _pointers(path)) if name.isdigit()]
    there = set(names(spark, path))
    for number in numbers[:-keep]:
        folders = [name for name in there if name.startswith(f"_v{number}-")]
        for name in folders:
            remove(spark, f"{path}/{name}")
            remove(spark, _listing(f"{path}/{name}"))


def _listing(folder: str) -> str:
    top, name = folder.rsplit("/", 1)
    return f"{top}/_files-{name}"


LISTED = "path string, size_bytes bigint, modified timestamp, sha256 string"


def _found(spark: SparkSession, folder: str) -> DataFrame:
    """Path, size and time of the files of a folder, without their bytes."""
    return spark.read.format("binaryFile").load(folder).selectExpr("path", "length AS size_bytes", "modificationTime AS modified")


def _list_files(spark: SparkSession, folder: str) -> None:
    from kerbside.sources.files import file_manifest

    digests = file_manifest(spark, folder).select("path", "sha256")
    _found(spark, folder).join(digests, "path").selectExpr("path", "size_bytes", "modified", "sha256").coalesce(1).write.mode("overwrite").parquet(_listing(folder))


def digest(spark: SparkSession, path: str) -> Row:
    """sha256, size_bytes and files of the current version, from its list.

    Only files whose size or time differs from the list are read. The digest of
    the table is that of the sorted digests of its files, or of its one file.
    """
    from kerbside.sources.files import combined, file_manifest

    folder = location(spark, path)
    listed = spark.read.schema(LISTED).parquet(_listing(folder))
    known = listed.selectExpr("path", "size_bytes AS _size", "modified AS _time", "sha256")
    found = _found(spark, folder).join(known, "path", "left")
    same = "_size <=> size_bytes AND _time <=> modified"
    kept = found.where(same).select("path", "size_bytes", "sha256")
    changed = [row.path for row in found.where(f"NOT ({same})").select("path").collect()]
    if changed:
        kept = kept.unionByName(file_manifest(spark, changed).select("path", "size_bytes", "sha256"))
    return combined(kept).first()


def write_report(frame: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    frame.write.mode("overwrite").json(path)


def publish_report(frame: DataFrame, path: str) -> None:
    """A one-row report as a version of its own, so readers always find a whole one."""
    spark = frame.sparkSession
    now = current(spark, path)
    name = f"_v{now.number + 1:08d}-{uuid.uuid4().hex}"
    put_if_absent(spark, f"{path}/{name}/report.json", frame.toJSON().first())
    if not _point(spark, path, now.number, name):
        remove(spark, f"{path}/{name}")
        raise PublishConflict(f"another report was published at {path}")
    expire(spark, path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """The current report of ``publish_report``."""
    return spark.read.json(location(spark, path))
