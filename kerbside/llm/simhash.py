"""Near duplicates by SimHash with pivot distance tables.

A fingerprint has a bit set where over half the XXH64 hashes of a text's
four-word shingles have it. Exact copies share a fingerprint and are one row
from then on. Every distinct fingerprint gets its row of the pivot table: its
Hamming distances to ``PIVOTS`` fixed reference fingerprints. Linked
fingerprints differ in at most ``LIMIT`` bits, so by the triangle inequality
none of their coordinates differ by more; pairs beyond that are discarded
before their bits are compared.

Pairs meet without a cross join: the bits form seven blocks, four differing
bits leave three blocks alike, and rows join on each choice of three. A pair is
reported at the first choice it agrees on. Where more than ``DENSE`` distinct
fingerprints share such a key, comparing them all would cost the square; they
are linked through midpoints instead: two fingerprints within four bits both
lie within two of some third one that agrees with their key, so each emits its
neighbours within two bits and those that meet are linked to the least. That
is exact, too, and linear in the fingerprints.

Defined results: a null or empty text has fingerprint zero and links like any
other; a null id counts after all others. Rows with one id and one fingerprint
are one document. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import common
from kerbside.llm.components import roots

SEED, SHINGLE, LIMIT = 42, 4, 4
PIVOTS = 16
DENSE = 2000
WIDTHS = (10, 9, 9, 9, 9, 9, 9)
STARTS = tuple(accumulate(WIDTHS, initial=0))[:-1]
AT_ONCE = 1 << 16  # shingles whose bits are counted together


def fingerprint(text: bytes) -> int:
    """The fingerprint of UTF-8 text; bytes split at exactly the white space that parts words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = min(SHINGLE, len(words)) - 1
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), len(words) - last
    for low in range(0, n, AT_ONCE):
        high = min(n, low + AT_ONCE)
        spans = zip(starts[low:high].tolist(), ends[low + last : high + last].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


@F.arrow_udf(T.LongType())
def _fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([fingerprint(text.as_py() or b"") for text in batch.cast(pa.binary())], pa.int64())


def fingerprints(text: str = "text") -> Column:
    """The signed 64-bit fingerprint of a text column."""
    return _fingerprint(F.col(text))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def references() -> list[int]:
    """The reference fingerprints: a fixed pseudo-random sequence."""
    return [xxhash.xxh64_intdigest(i.to_bytes(8, "little"), SEED) for i in range(PIVOTS)]


def _packed(fp: Column, pivots: list[int]) -> Column:
    """Eight distances, a byte each."""
    out = F.lit(0).cast("long")
    for place, pivot in enumerate(pivots):
        distance = F.bit_count(fp.bitwiseXOR(F.lit(_signed(pivot)))).cast("long")
        out = out.bitwiseOR(F.shiftleft(distance, 8 * place))
    return out


def pivot_table(distinct: DataFrame) -> DataFrame:
    """Distinct fingerprints ``fp`` with their distances to the references, packed in t0 and t1."""
    pivots = references()
    return distinct.select("fp", _packed(F.col("fp"), pivots[:8]).alias("t0"), _packed(F.col("fp"), pivots[8:]).alias("t1"))


def _near_by_table(left: str, right: str) -> Column:
    """No coordinate of the two rows differs by more than the limit."""
    kept = F.lit(True)
    for column in ("t0", "t1"):
        for place in range(8):
            a = F.shiftrightunsigned(F.col(f"{left}.{column}"), 8 * place).bitwiseAND(F.lit(255))
            b = F.shiftrightunsigned(F.col(f"{right}.{column}"), 8 * place).bitwiseAND(F.lit(255))
            kept = kept & (F.abs(a - b) <= LIMIT)
    return kept


def _choices() -> list[tuple[int, int]]:
    """(blocks as a bit set, mask of their bits) for every choice of three blocks."""
    masks = [((1 << w) - 1) << s for w, s in zip(WIDTHS, STARTS, strict=True)]
    return [(sum(1 << b for b in c), _signed(sum(masks[b] for b in c))) for c in combinations(range(len(WIDTHS)), len(WIDTHS) - LIMIT)]


def _first_choice(difference: Column) -> Column:
    """The bit set of the first three blocks without a differing bit."""
    same = F.lit(0)
    for block, (width, start) in enumerate(zip(WIDTHS, STARTS, strict=True)):
        mask = _signed(((1 << width) - 1) << start)
        same = same + F.when(difference.bitwiseAND(F.lit(mask)) == 0, 1 << block).otherwise(0)
    # lowest three set bits: clear the lowest bit three times, the rest is what does not belong
    rest = same
    for _ in range(len(WIDTHS) - LIMIT):
        rest = rest.bitwiseAND(rest - 1)
    return same - rest


def links(table: DataFrame, dense: int = DENSE) -> DataFrame:
    """Edges (u, v) between fingerprints of a pivot table that connect all within the limit, and no others.

    Every pair within the limit is an edge, except inside dense keys, where a
    pair may be connected through others.
    """
    choices = F.array(*[F.struct(F.lit(c).alias("c"), F.lit(m).alias("m")) for c, m in _choices()])
    keyed = table.select("*", F.explode(choices).alias("x")).select(
        "fp", "t0", "t1", F.col("x.c").alias("c"), F.col("fp").bitwiseAND(F.col("x.m")).alias("k")
    )
    crowded = common.stored(keyed.groupBy("c", "k").count().where(F.col("count") > dense).select("c", "k"), "dense")
    some = not crowded.isEmpty()
    sparse = keyed.join(crowded, ["c", "k"], "left_anti") if some else keyed
    a, b = common.shuffled(sparse.alias("a")), sparse.alias("b")
    difference = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    pairs = a.join(
        b,
        (F.col("a.c") == F.col("b.c"))
        & (F.col("a.k") == F.col("b.k"))
        & (F.col("a.fp") < F.col("b.fp"))
        & _near_by_table("a", "b")
        & (F.bit_count(difference) <= LIMIT)
        & ((_first_choice(difference) == F.col("a.c")) if not some else F.lit(True)),
    ).select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v"))
    if not some:
        return pairs
    inside = keyed.join(crowded, ["c", "k"], "left_semi").select("fp", "c", "k")
    return pairs.union(_midpoint_links(inside)).distinct()


def _midpoint_links(rows: DataFrame) -> DataFrame:
    """Edges of dense keys: to the least of those within two bits of a common point that has the key."""
    free = {c: [bit for bit in range(64) if not (m >> bit) & 1] for c, m in _choices()}
    steps = F.create_map(
        *[
            item
            for c, bits in free.items()
            for item in (
                F.lit(c),
                F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << x)) for x in bits]),
            )
        ]
    )
    moves = rows.withColumn("s", steps[F.col("c")])
    # flips of one bit twice meet at the start, so x ^ y over both lists covers none, one and two flips
    points = moves.select("fp", "c", "s", F.posexplode("s").alias("i", "x")).select("fp", "c", F.col("x"), F.explode(F.slice("s", F.col("i") + 1, 64)).alias("y"))
    met = (
        points.select("fp", "c", F.col("fp").bitwiseXOR(F.col("x")).bitwiseXOR(F.col("y")).alias("p"))
        .groupBy("c", "p")
        .agg(F.collect_set("fp").alias("all"))  # at most 704 by construction
        .where(F.size("all") > 1)
    )
    return met.select(F.array_min("all").alias("u"), F.explode("all").alias("v")).where("u <> v").distinct()


def components(rows: DataFrame, dense: int = DENSE) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``rows`` that has a link."""
    table = common.stored(pivot_table(rows.select("fp").distinct()), "pivots")
    return roots(links(table, dense))


def classes(rows: DataFrame, dense: int = DENSE) -> DataFrame:
    """(fp, component_id, owner): the least id of each fingerprint's component and its fingerprint.

    ``rows`` has doc_id and fp.
    """
    first = rows.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", F.col("fp").alias("own"))).alias("least"))
    rooted = common.shuffled(first).join(components(rows, dense).withColumnRenamed("node", "fp"), ["fp"], "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("all_least"))
    return rooted.join(least, ["root"]).select(
        "fp", F.col("all_least.doc_id").alias("component_id"), F.col("all_least.own").alias("owner")
    )


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    documents = common.table(spark, folder, "documents")
    rows = common.stored(documents.select("doc_id", fingerprints("text").alias("fp")), "simhash")
    return common.shuffled(rows).join(classes(rows), ["fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
