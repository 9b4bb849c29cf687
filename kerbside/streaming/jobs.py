"""Running streams to the end of what is available, and the snapshot store."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.errors import PublishConflict
from kerbside.operators.online import SNAPSHOT_TTL_SECONDS, latest_snapshots, unexpired
from kerbside.sources import storage
from kerbside.sources.files import scratch_path

# State of large streams belongs on local disk with checkpoints in shared storage.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
}


def stream_table(spark: SparkSession, folder: str, file_name: str, **options: str) -> DataFrame:
    """A parquet file, or directory of them, as a file stream with its stored schema."""
    schema = spark.read.parquet(f"{folder}/{file_name}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", file_name)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.parquet(folder)


def drain(
    stream: DataFrame, path: str | None = None, checkpoint: str | None = None
) -> tuple[DataFrame, list]:
    """Process all available input in append mode into parquet; give the rows and the progress.

    Output and checkpoint live in the shared folder; calling again with the
    same two paths continues where the last run stopped.
    """
    spark = stream.sparkSession
    path = path or scratch_path(spark, "stream")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint or f"{path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path), list(query.recentProgress)


KEYS = ("feature_model_version", "zone_role", "zone_id", "window_kind")


class SnapshotStore:
    """Newest snapshot per key: a log of changed keys per micro-batch, by bucket of the key, and compacted buckets.

    A batch writes the newest snapshot of each key it has, and nothing else, so
    its bytes follow the batch. Replaying it writes the same folder again.
    Readers take the compacted part of each bucket and the batches after it.
    A bucket with more than ``pending`` batches in the log is compacted, alone:
    newest per key, without what has outlived its time. Which compacted folder
    is valid up to which batch is a small state file, put as a whole and only if
    nobody else put that number; folders of the state before the last stay for
    its readers.

    Time is the stream's own: the newest ``computed_at`` seen. A snapshot of an
    older window never replaces a newer one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, pending: int = 8, ttl_seconds: int = SNAPSHOT_TTL_SECONDS) -> None:
        self.spark, self.path = spark, path
        self.buckets, self.pending, self.ttl_seconds = buckets, pending, ttl_seconds

    def _states(self) -> list[str]:
        return [name for name in storage.names(self.spark, f"{self.path}/state") if name.isdigit()]

    def state(self, number: str | None = None) -> dict:
        """Compacted folder and last batch of each bucket, and the time of the stream then."""
        names = self._states()
        if not names:
            return {"buckets": {}, "now": None}
        return json.loads(storage.get_text(self.spark, f"{self.path}/state/{number or names[-1]}"))

    def _log(self) -> dict[int, list[int]]:
        """The finished batches of each bucket that the log holds."""
        found: dict[int, list[int]] = {}
        for batch in storage.names(self.spark, f"{self.path}/log"):
            names = storage.names(self.spark, f"{self.path}/log/{batch}")
            if "_SUCCESS" in names:
                for name in names:
                    if name.startswith("bucket="):
                        found.setdefault(int(name[7:]), []).append(int(batch.split("=")[1]))
        return found

    def _paths(self, state: dict, buckets: Iterable[int] | None = None) -> list[str]:
        """What readers of the buckets read: at most a compacted folder and the batches after it."""
        log = self._log()
        known = {int(bucket): made for bucket, made in state["buckets"].items()}
        paths = []
        for bucket in sorted(known.keys() | log.keys()) if buckets is None else buckets:
            folder, upto = known.get(bucket, (None, -1))
            paths += [f"{self.path}/{folder}"] * bool(folder)
            paths += [f"{self.path}/log/batch={batch}/bucket={bucket}" for batch in sorted(log.get(bucket, [])) if batch > upto]
        return paths

    def _newest(self, paths: list[str]) -> DataFrame | None:
        return latest_snapshots(self.spark.read.parquet(*paths), KEYS) if paths else None

    def read(self, now: str | None = None) -> DataFrame | None:
        """The newest snapshot of each key that has not outlived its time, by the stream's last time or by ``now``, an SQL time."""
        kept = self._newest(self._paths(self.state()))
        if kept is None or now:
            return kept if kept is None else unexpired(kept, now, self.ttl_seconds)
        timed = kept.withColumn("_now", kept.agg(F.max("computed_at")).scalar())
        return unexpired(timed, "_now", self.ttl_seconds).drop("_now")

    def merge(self, batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int")
        changed = latest_snapshots(batch, KEYS).withColumn("bucket", bucket).repartition("bucket")
        changed.write.partitionBy("bucket").mode("overwrite").parquet(f"{self.path}/log/batch={batch_id}")
        self.compact(batch_id)

    def compact(self, upto: int, pending: int | None = None) -> list[int]:
        """Compact the buckets with more than ``pending`` batches in the log, up to a batch; which they were."""
        pending = self.pending if pending is None else pending
        numbers, state = self._states(), self.state()
        last = {int(bucket): batch for bucket, (_, batch) in state["buckets"].items()}
        due = [b for b, batches in sorted(self._log().items()) if sum(last.get(b, -1) < x <= upto for x in batches) > pending]
        if not due:
            return []
        number = int(numbers[-1]) + 1 if numbers else 1
        kept = self._newest(self._paths(state, due)).withColumn("bucket", F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int"))
        newest = self._newest(self._paths(state)).agg(F.expr("CAST(max(computed_at) AS STRING)")).first()[0]
        folder = f"compacted/{number:08d}-{uuid.uuid4().hex}"
        alive = unexpired(kept, f"TIMESTAMP_NTZ '{newest}'", self.ttl_seconds).repartition("bucket")
        alive.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        left = set(storage.names(self.spark, f"{self.path}/{folder}"))
        made = {str(b): (f"{folder}/bucket={b}" if f"bucket={b}" in left else None, upto) for b in due}
        now = {"buckets": state["buckets"] | made, "now": newest}
        if not storage.put_if_absent(self.spark, f"{self.path}/state/{number:08d}", json.dumps(now)):
            storage.remove(self.spark, f"{self.path}/{folder}")
            raise PublishConflict(f"another writer compacted {self.path}")
        self._expire(numbers[-1:], now)
        return due

    def _expire(self, before: list[str], now: dict) -> None:
        """Remove what neither the new state nor the one before reads."""
        states = [now, *[self.state(number) for number in before]]
        used = {folder.split("/")[1] for state in states for folder, _ in state["buckets"].values() if folder}
        for name in storage.names(self.spark, f"{self.path}/compacted"):
            if name not in used:
                storage.remove(self.spark, f"{self.path}/compacted/{name}")
        for bucket, batches in self._log().items():
            known = [state["buckets"].get(str(bucket), (None, -1))[1] for state in states]
            for batch in batches:
                if before and batch <= min(known):
                    storage.remove(self.spark, f"{self.path}/log/batch={batch}/bucket={bucket}")


def feed_store(
    snapshots: DataFrame, store: SnapshotStore, checkpoint: str | None = None
) -> SnapshotStore:
    """Merge every closed window of a stream into the store."""
    merge: Callable[[DataFrame, int], None] = store.merge
    query = (
        snapshots.writeStream.outputMode("append")
        .foreachBatch(merge)
        .option("checkpointLocation", checkpoint or f"{store.path}-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return store
