"""Counts of 64-bit fingerprints over all blocks of a corpus, returned to the blocks that hold them.

Texts lie in blocks of bounded size. Each block lists the fingerprints it holds
once, cut to as many leading bits as the corpus needs to tell them apart, in
sorted order, as differences packed by range (``packed``). Ranges are summed in
tasks of their own, and every block gets back the fingerprints whose total
reaches a least number, with their totals (``totals``). A row of the shuffle is
a range of a block, so a fingerprint costs bits, not a row.

Totals are upper bounds: fingerprints that agree in the kept bits are counted
together. Callers either count what is left exactly or need no more than an
order all blocks agree on.

Blocks and ranges grow with the corpus up to a bound, so that a task holds
megabytes whatever the input. Beyond some tens of terabytes a range of a block
holds few fingerprints, and a row costs what a plain row would.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST_BLOCK, MOST_BLOCK = 1 << 20, 16 << 20  # bytes of text
BLOCK_GROWTH = 256  # times the square root of the corpus: blocks and rows between them and ranges grow alike
RANGE = 1 << 20  # fingerprints a range holds on average, at most
PACKED = "bucket int, block long, packed binary"
FOUND = "block long, bucket int, packed binary"


@dataclass(frozen=True)
class Plan:
    """Number of blocks, leading bits of a fingerprint that count, leading bits that name its range."""

    blocks: int
    bits: int
    range_bits: int

    def cut(self, fingerprints: np.ndarray) -> np.ndarray:
        return fingerprints >> np.uint64(64 - self.bits)


def plan(texts: DataFrame, text: str = "text", per_byte: float = 1.0) -> Plan:
    """For texts with about ``per_byte`` fingerprints a byte at most; one pass over their lengths."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("n")).first()["n"]
    block = min(MOST_BLOCK, max(LEAST_BLOCK, BLOCK_GROWTH * math.isqrt(size)))
    expected = max(1, int(size * per_byte))
    return Plan(
        blocks=max(1, -(-size // block)),
        bits=min(60, max(20, expected.bit_length())),
        range_bits=min(30, (expected // RANGE).bit_length()),
    )


def block_of(key: Column, how: Plan) -> Column:
    """The block of a row by a 64-bit key that is its own and stays the same."""
    return F.pmod(key, F.lit(how.blocks)).cast("long").alias("block")


def _planes(values: np.ndarray) -> bytes:
    """Bytes of 64-bit values, the lowest bytes of all first; high planes compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def pack(keys: np.ndarray, counts: np.ndarray, compress: zstandard.ZstdCompressor | None = None) -> bytes:
    """Sorted distinct keys and their counts in few bytes."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return (compress or zstandard.ZstdCompressor(level=1)).compress(_planes(steps) + _planes(counts))


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(2, 8, -1)
    steps, counts = (np.ascontiguousarray(half.T).view("<u8").ravel() for half in raw)
    return np.cumsum(steps, dtype=np.uint64), counts.astype(np.int64)


def packed(fingerprints: np.ndarray, block: int, how: Plan) -> pa.Table:
    """The rows of one block: its cut fingerprints and how often it has each, by range."""
    keys, counts = np.unique(how.cut(fingerprints), return_counts=True)
    return ranges(keys, counts, block, how)


def ranges(keys: np.ndarray, counts: np.ndarray, block: int, how: Plan) -> pa.Table:
    """Sorted distinct keys with counts, a row for each range that has any."""
    place = keys >> np.uint64(how.bits - how.range_bits)
    starts = np.flatnonzero(np.diff(place, prepend=place[:1] - np.uint64(1))) if len(keys) else np.zeros(0, np.int64)
    ends = np.append(starts[1:], len(keys))
    compress = zstandard.ZstdCompressor(level=1)
    return pa.table(
        {
            "bucket": pa.array(place[starts].astype(np.int32)),
            "block": pa.array(np.full(len(starts), block, np.int64)),
            "packed": pa.array([pack(keys[a:b], counts[a:b], compress) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
        }
    )


def _summed(least: int, exact: bool = True) -> Callable[[pa.Table], pa.Table]:
    def total(rows: pa.Table) -> pa.Table:
        parts = [unpack(data) for data in rows.column("packed").to_pylist()]
        keys = np.concatenate([k for k, _ in parts])
        distinct, place = np.unique(keys, return_inverse=True)
        sums = np.zeros(len(distinct), np.int64)
        np.add.at(sums, place, np.concatenate([n for _, n in parts]))
        compress, out, low = zstandard.ZstdCompressor(level=1), [], 0
        for own, _ in parts:
            mine = sums[place[low : low + len(own)]]
            low += len(own)
            enough = mine >= least
            out.append(pack(own[enough], mine[enough] if exact else np.full(int(enough.sum()), least), compress))
        return pa.table({"block": rows.column("block"), "bucket": rows.column("bucket"), "packed": pa.array(out, pa.binary())})

    return total


def totals(rows: DataFrame, least: int, exact: bool = True) -> DataFrame:
    """From ``packed`` rows, per block and range: its keys whose total is at least ``least``, with totals.

    If they need not be ``exact``, ``least`` stands for all of them.
    """
    return rows.groupBy("bucket").applyInArrow(_summed(least, exact), FOUND)


class Totals:
    """The totals a block got back, to be looked up by fingerprint."""

    def __init__(self, rows: pa.Table, how: Plan) -> None:
        self.how = how
        order = np.argsort(rows.column("bucket").to_numpy(), kind="stable")
        data = rows.column("packed").to_pylist()
        parts = [unpack(data[i]) for i in order.tolist()]
        self.keys = np.concatenate([np.zeros(0, np.uint64), *[k for k, _ in parts]])
        self.sums = np.concatenate([np.zeros(0, np.int64), *[n for _, n in parts]])

    def of(self, fingerprints: np.ndarray) -> np.ndarray:
        """The total of each, 0 where it is below the least."""
        if not len(self.keys):
            return np.zeros(len(fingerprints), np.int64)
        keys = self.how.cut(fingerprints)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.sums[at], 0)


def counted(blocks: DataFrame, listed: Callable[[pa.Table, Plan], pa.Table], use: Callable[[pa.Table, Totals], pa.Table], how: Plan, least: int, schema: str, exact: bool = True) -> DataFrame:
    """Rows that ``use`` makes of each block and the totals of its fingerprints.

    ``blocks`` has the column ``block``; ``listed`` gives the packed rows of a
    block. Both read one shuffle of the blocks.
    """
    grouped = blocks.groupBy("block")
    found = totals(grouped.applyInArrow(lambda rows: listed(rows, how), PACKED), least, exact)

    def with_totals(rows: pa.Table, known: pa.Table) -> pa.Table:
        return use(rows, Totals(known, how))

    return grouped.cogroup(found.groupBy("block")).applyInArrow(with_totals, schema)


@F.arrow_udf(T.BinaryType())
def shrunk(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Texts in fewer bytes, for a shuffle; nulls stay."""
    compress = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        yield pa.array([None if text is None else compress.compress(text) for text in batch.cast(pa.binary()).to_pylist()], pa.binary())


def grown(column: pa.Array) -> pa.Array:
    """The texts of ``shrunk``."""
    decompress = zstandard.ZstdDecompressor()
    return pa.array([None if data is None else decompress.decompress(data) for data in column.to_pylist()], pa.large_binary())


def address() -> Column:
    """A 64-bit key of each row of a table that was read from files: its file and its place in it."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))

