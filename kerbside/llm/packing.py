"""Best-fit packing by the configuration linear program.

A configuration is a multiset of lengths that fits one sequence. The program
asks for the fewest configurations that cover the histogram of lengths. Its
fractional form is solved by multiplicative weights: the price of a length is its
size, times a weight that falls with what is covered of it. In each round one
knapsack by dynamic programming finds, for each length that is behind, the
configuration of the highest value with it; those near the best of all are used
as far as the length is behind. Prices over the best value solve the dual, so
each round gives a lower bound on sequences. The fractions are rounded up, as far
as pieces are left; the rest goes by the same pricing in whole steps, fullest
sequences first (``SPARES`` is the part they may leave unused), and in the end by
best fit, longest first, whole groups of equal sequences at a time. Where whole
steps from the start, or best fit alone, take fewer sequences, they are the plan.

Only the histogram reaches the driver, at most ``limit`` counts, and the plan it
makes has a bounded number of configurations whatever the number of documents.
Pieces find their place by their rank among pieces of their length; ranks are
counted per partition first, so a length that most pieces share is no bottleneck.

Defined results: a null or empty text is one piece, the end token alone. Only
texts longer than a sequence are cut; their first piece takes what the whole
pieces leave. An empty table has no pieces. Equal texts get pieces of their own.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import bpe, common, flat

LIMIT = 2048
ROUNDS = 200
RATE = 1.0
NEAR = 0.02  # how far below the best a configuration of a round may be
UNEVEN = 0.01
SPARES = (0.0, 0.0005, 0.0015, 0.005)
END = 0  # the id that ends every document
PIECE = pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64())])
PIECES = T.ArrayType(
    T.StructType(
        [
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("crc", T.LongType()),
        ]
    )
)


def cuts(total: int, limit: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document."""
    first = total % limit or min(total, limit)
    return [(0, first), *((start, limit) for start in range(first, total, limit))]


def pieces(name: str = bpe.TOKENIZER, limit: int = LIMIT):
    """A column function: text to its pieces (piece, start, length, crc of the ids)."""

    @F.arrow_udf(PIECES)
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = bpe.encoder(name)
        for batch in batches:
            rows = []
            for data, offsets in flat.chunks(batch):
                ids, places = own.encode(data, offsets)
                for low, high in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                    mine = np.append(ids[low:high], END).astype("<u4")
                    rows.append(
                        [
                            {"piece": k, "start": s, "length": n, "crc": zlib.crc32(mine[s : s + n].tobytes())}
                            for k, (s, n) in enumerate(cuts(len(mine), limit))
                        ]
                    )
            yield pa.array(rows, pa.list_(PIECE))

    return cut


def knapsack(sizes: np.ndarray, values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to the limit the highest value of a multiset of sizes (ascending) and the size it ends with, or -1."""
    best, choice = np.zeros(limit + 1), np.full(limit + 1, -1)
    fits = np.searchsorted(sizes, np.arange(limit + 1), "right")
    for room in range(int(sizes[0]), limit + 1):
        k = fits[room]
        found = best[room - sizes[:k]] + values[:k]
        at = int(found.argmax())
        best[room], choice[room] = (found[at], at) if found[at] > best[room - 1] else (best[room - 1], -1)
    return best, choice


def configuration(first: int, sizes: np.ndarray, left: np.ndarray, choice: np.ndarray, limit: int) -> tuple[dict[int, int], int]:
    """The best one with length ``first`` that takes no more of a length than there is, and the room it leaves unused."""
    taken, room, unused = {first: 1}, limit - int(sizes[first]), 0
    while room > 0:
        at = int(choice[room])
        if at < 0 or left[at] <= taken.get(at, 0):
            room, unused = room - 1, unused + 1
        else:
            taken[at] = taken.get(at, 0) + 1
            room -= int(sizes[at])
    return taken, unused


def fractional(sizes: np.ndarray, counts: np.ndarray, limit: int, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float]:
    """How often each configuration (length place, times) is used, as fractions, and a lower bound on all sequences.

    After round t each length should be covered t times. Prices divided by the
    value of the best configuration are a solution of the dual, so the pieces
    valued at them are a bound in every round; the highest is returned.
    """
    covered, bound = np.zeros(len(sizes)), 0.0
    used: dict[tuple, float] = defaultdict(float)
    make = np.random.default_rng(1)  # uneven prices, so that equal values do not always choose the same lengths
    for t in range(1, rounds + 1):
        uneven = 1 + UNEVEN / t * make.random(len(sizes)) * (t > 1)
        prices = sizes / limit * np.exp(-RATE / np.sqrt(t) * (covered - covered.min())) * uneven
        best, choice = knapsack(sizes, prices, limit)
        bound = max(bound, float(counts @ prices) / best[limit])
        values = prices + best[limit - sizes]
        for first in np.argsort(covered, kind="stable").tolist():
            if covered[first] >= t or values[first] < (1 - NEAR) * best[limit]:
                continue
            taken, _ = configuration(first, sizes, counts, choice, limit)
            # what covers the length, but no length more than once at a time
            amount = min((t - covered[first]) * counts[first] / taken[first], *(counts[at] / times for at, times in taken.items()))
            for at, times in taken.items():
                covered[at] += amount * times / counts[at]
            used[tuple(sorted(taken.items()))] += amount
    scale = max(covered.min(), 1.0)
    return {key: amount / scale for key, amount in used.items()}, bound


def rounded(used: dict[tuple, float], sizes: np.ndarray, counts: np.ndarray, limit: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """The fractions rounded up, fullest configurations first and then the most used, each as far as what is left allows; and the rest."""
    left, found = counts.copy(), []

    def order(entry: tuple[tuple, float]) -> tuple:
        key, amount = entry
        return limit - sum(int(sizes[at]) * times for at, times in key), -amount, key

    for key, amount in sorted(used.items(), key=order):
        number = min(int(np.ceil(amount)), *(int(left[at]) // times for at, times in key))
        if number > 0:
            for at, times in key:
                left[at] -= number * times
            found.append((dict(key), number))
    return found, left


def whole_steps(sizes: np.ndarray, counts: np.ndarray, limit: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """Configurations used as often as what is left allows, priced anew each round; and the counts they leave."""
    left = counts.copy()
    used: dict[tuple, int] = defaultdict(int)
    make, level = np.random.default_rng(1), 0
    for _ in range(limit + len(SPARES)):  # a round covers a length or raises the spare part
        here = np.flatnonzero(left)
        if not len(here):
            break
        own, rest = sizes[here], left[here]
        prices = own / limit * np.exp(-RATE * (1 - rest / counts[here])) * (1 + UNEVEN * make.random(len(here)))
        best, choice = knapsack(own, prices, limit)
        progress = False
        for first in np.argsort(-(prices + best[limit - own]), kind="stable").tolist():
            if not rest[first]:
                continue
            taken, unused = configuration(first, own, rest, choice, limit)
            if unused > SPARES[level] * limit:
                continue
            number = min(int(rest[at]) // times for at, times in taken.items())
            for at, times in taken.items():
                rest[at] -= number * times
            used[tuple(sorted((int(here[at]), times) for at, times in taken.items()))] += number
            progress = True
        left[here] = rest
        level += not progress
        if level == len(SPARES):
            break
    return [(dict(key), number) for key, number in used.items()], left


def best_fit(sizes: np.ndarray, left: np.ndarray, limit: int) -> list[tuple[dict[int, int], int]]:
    """Best fit, longest first, for counts of each size; equal sequences are one group.

    Each place puts as many of a size as fit into a whole group, which is what
    best fit does with equal items one at a time.
    """
    groups: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for at in range(len(sizes) - 1, -1, -1):
        size, rest = int(sizes[at]), int(left[at])
        while rest:
            room = min((room for room in groups if room >= size and groups[room]), default=limit)
            content, number = groups[room].pop() if groups.get(room) else ({}, rest)
            each = room // size
            whole = min(number, rest // each)
            if number > whole and content:
                groups[room].append((content, number - whole))
            if whole:
                groups[room - each * size].append(({**content, at: each}, whole))
                rest -= whole * each
            if rest and whole < number:  # fewer than a sequence takes are left
                if content:
                    content, number = groups[room].pop()
                    if number > 1:
                        groups[room].append((content, number - 1))
                groups[room - rest * size].append(({**content, at: rest}, 1))
                rest = 0
    return [group for found in groups.values() for group in found]


def sequences_of(found: list[tuple[dict[int, int], int]]) -> int:
    return sum(number for _, number in found)


def program(sizes: np.ndarray, counts: np.ndarray, limit: int, rounds: int) -> tuple[list[tuple[dict[int, int], int]], np.ndarray]:
    """Configurations and how often each is used: the rounded fractions, then whole steps over the rest; and the counts they leave."""
    used, _ = fractional(sizes, counts, limit, rounds)
    found, rest = rounded(used, sizes, counts, limit)
    more, left = whole_steps(sizes, rest, limit)
    return found + more, left


def plan(histogram: dict[int, int], limit: int = LIMIT, rounds: int = ROUNDS) -> list[tuple[dict[int, int], int]]:
    """(length: pieces of it in a sequence, number of such sequences); covers the histogram exactly.

    The rounded program, or what takes fewer sequences: whole steps from the start, or best fit alone.
    """
    if not histogram:
        return []
    sizes = np.array(sorted(histogram))
    counts = np.array([histogram[int(s)] for s in sizes], np.int64)
    ways = []
    for found, left in (program(sizes, counts, limit, rounds), whole_steps(sizes, counts, limit), ([], counts)):
        ways.append(found + best_fit(sizes, left, limit))
    best = min(ways, key=sequences_of)
    return [({int(sizes[at]): times for at, times in found.items()}, number) for found, number in best]


class Places:
    """Where the piece of a given length and rank goes."""

    def __init__(self, configurations: list[tuple[dict[int, int], int]]) -> None:
        entries, base = [], 0
        for found, number in configurations:
            offset = 0
            for length in sorted(found, reverse=True):
                entries.append((length, base, found[length], offset, found[length] * number))
                offset += length * found[length]
            base += number
        self.sequences = base
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, 5)
        self.length, self.base, self.times, self.offset = table[:, :4].T
        ends = np.cumsum(table[:, 4])
        self.start = ends - table[:, 4]
        lengths, first = np.unique(self.length, return_index=True)
        self.lengths, self.first = lengths, self.start[first]

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset)"""
        place = self.first[np.searchsorted(self.lengths, length)] + rank
        at = np.searchsorted(self.start, place, "right") - 1
        within = place - self.start[at]
        return self.base[at] + within // self.times[at], self.offset[at] + within % self.times[at] * length


def ranked(rows: DataFrame) -> DataFrame:
    """The rows with ``rank``, from 0 among rows of one ``length``.

    ``rows`` is a stored table with part and row, its place in the writing job.
    """
    within = rows.withColumn("w", F.row_number().over(W.partitionBy("length", "part").orderBy("row")))
    counts = rows.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = counts.select(
        "length", "part", (F.sum("n").over(W.partitionBy("length").orderBy("part")) - F.col("n")).alias("before")
    )
    return within.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("w") - 1).drop("w", "before", "part", "row")


def pack(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Rows with a ``length`` of at most ``limit``, and the sequence and offset each gets."""
    numbered = rows.withColumns({"part": F.spark_partition_id(), "row": F.monotonically_increasing_id()})
    kept = common.stored(numbered, "pieces")
    histogram = {r["length"]: r["n"] for r in kept.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = rows.sparkSession.sparkContext.broadcast(Places(plan(histogram, limit)))
    kind = pa.struct([("sequence_id", pa.int64()), ("offset", pa.int64())])

    @F.arrow_udf(T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        sequence, offset = places.value.find(length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False))
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], fields=list(kind))

    return ranked(kept).withColumn("place", place("length", "rank")).select("*", "place.sequence_id", "place.offset").drop("rank", "place")


def packed_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """The pieces of all documents and their places."""
    cut = documents.select(F.col(key).alias("doc_id"), F.explode(pieces(limit=limit)(F.col(text))).alias("p"))
    rows = cut.select("doc_id", "p.piece", "p.start", "p.length", F.col("p.crc").alias("ids_crc32"))
    return pack(rows, limit).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def sequences(placed: DataFrame) -> DataFrame:
    """Training sequences from placed pieces with their ``ids``: one row of at most ``LIMIT`` ids each."""
    part = F.struct("offset", "ids")
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(part)), lambda p: p["ids"])).alias("ids"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    return packed_documents(common.table(spark, folder, "documents"))
