"""Jaccard join of word n-gram sets by rare-first prefix filtering.

Texts with the same words are one text from then on. Distinct texts lie in
blocks; a census of the hashes of their four-word shingles returns document
frequencies to the blocks, and every text orders its shingles rarest first
(ties by hash, so the order is one for all texts). Two sets with a Jaccard
similarity of ``SHARE`` percent share one of the first ``n - ceil(SHARE * n / 100) + 1``
shingles; of these prefixes only those that a second text has at all leave the
block. Texts meet in a join on prefix shingles, each pair at the first it has
in common (later ones are passed over where one of the rarest ``BEFORE`` was
common; the others bring the same pair again), and must pass three filters:

* length: neither set is too large for the other;
* position: with what lies behind the shared shingle there can still be enough;
* suffix: the shingles behind it, counted in ``PARTS`` ranges of the hash, can
  still share enough, a pair of ranges at most the lesser of its counts.

What passes is verified once per pair on the whole sets.

A group of near copies would meet in all its pairs, though a component needs
only a spanning tree. So texts first meet one member of each group, the one
whose shingles are the most frequent, which is the nearest to what all have in
common. Only pairs of texts that these links leave
in different components are joined in full, those outside the largest component
of a group with all of it. That loses no link between components.

Defined results: a null or empty text, or one of white space alone, has the
empty set and is linked with nothing, not even with its like. A null id counts
after all others. Rows with one id and the same words are copies. Shingles are
told apart by 64-bit hashes, texts by 128-bit hashes. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import census, common, flat
from kerbside.llm.components import roots

SHINGLE, SHARE = 4, 85
PARTS = 32  # ranges of the suffix filter
BEFORE = 16  # earlier prefix shingles that a row carries, so that a pair meets once; a longer list would only save more repeats
MOST = 32_767  # a range that holds so many shingles excludes nothing
DISTINCT = pa.schema([("key", pa.int64()), ("copy", pa.string()), ("text", pa.binary())])
TEXTS = "copy string, n long, typical float, shingles array<long>, gram long, pos int, before array<long>, rest array<short>"


def words_of(text: bytes) -> bytes:
    """The words in lower case with single spaces; bytes split at exactly the white space that parts words."""
    return b" ".join(text.lower().split())


def copy_of(words: bytes) -> str | None:
    return xxhash.xxh3_128_hexdigest(words) if words else None


@F.arrow_udf(T.StringType())
def _copies(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([copy_of(words_of(text.as_py() or b"")) for text in batch.cast(pa.binary())], pa.string())


def copies(text: str = "text") -> Column:
    """What texts with the same words have in common; null without a word."""
    return _copies(F.col(text))


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text of a task once: large groups of copies shrink before the shuffle."""
    seen: set[str] = set()
    compress = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        keys, names, texts = [], [], []
        for text in batch.column("text").cast(pa.binary()):
            words = words_of(text.as_py() or b"")
            copy = copy_of(words)
            if copy and copy not in seen:
                seen.add(copy)
                keys.append(int(copy[:15], 16))
                names.append(copy)
                texts.append(compress.compress(words))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.binary())], schema=DISTINCT)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, hash) of the distinct shingles of texts, in that order; with fewer words the whole text is one."""
    _, _, hashes, first = flat.words(data, offsets)
    words = np.diff(first)
    made = np.where(words >= SHINGLE, words - SHINGLE + 1, words > 0)
    owner = np.repeat(np.arange(len(words)), made)
    at, end = flat.ranges(first[:-1], made), np.repeat(first[1:], made)
    total = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        inside = at + k < end
        part = hashes[np.minimum(at + k, len(hashes) - 1)] if len(hashes) else total
        total = np.where(inside, flat.mixed(total * flat.MULTIPLIER + part + np.uint64(k + 1)), total)
    order = np.lexsort((total, owner))
    owner, total = owner[order], total[order]
    fresh = np.ones(len(total), bool)
    fresh[1:] = (owner[1:] != owner[:-1]) | (total[1:] != total[:-1])
    return owner[fresh], total[fresh]


def _of_block(rows: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(copies, text of each shingle, shingle) of the distinct texts of a block."""
    names = rows.column("copy").to_pylist()
    first = {name: at for at, name in reversed(list(enumerate(names)))}
    kept = sorted(first.values(), key=names.__getitem__)
    texts = census.grown(rows.column("text").take(pa.array(kept, pa.int64())))
    data, offsets = next(iter(flat.chunks(texts, 1 << 40)))
    return [names[at] for at in kept], *shingle_sets(data, offsets)


def _listed(rows: pa.Table, how: census.Plan) -> pa.Table:
    _, _, hashes = _of_block(rows)
    return census.packed(hashes, rows.column("block")[0].as_py(), how)


def prefix_length(n: np.ndarray) -> np.ndarray:
    return n + (-SHARE * n // 100) + 1


def _prefixes(rows: pa.Table, totals: census.Totals) -> pa.Table:
    """A row for each text, and one for each shingle of its prefix that another text has."""
    names, owner, hashes = _of_block(rows)
    sizes = np.bincount(owner, minlength=len(names))
    starts = np.cumsum(sizes) - sizes
    frequency = totals.of(hashes)  # 0 if no other text has it
    order = np.lexsort((hashes, frequency, owner))
    position = np.arange(len(order)) - starts[owner]
    part = (hashes[order] >> np.uint64(59)).astype(np.int64)
    inside = position < prefix_length(sizes)[owner]
    at = np.flatnonzero(inside & (frequency[order] > 0))
    # shingles behind each place, by range: those of the text less those up to here
    whole = np.bincount(owner * PARTS + part, minlength=len(names) * PARTS).reshape(-1, PARTS)
    prefix = np.flatnonzero(inside)
    lead = np.zeros((len(prefix) + 1, PARTS), np.int32)
    lead[np.arange(1, len(prefix) + 1), part[prefix]] = 1
    lead = np.cumsum(lead, axis=0)
    place = np.searchsorted(prefix, at)
    rest = whole[owner[at]] - (lead[place + 1] - lead[np.searchsorted(prefix, starts[owner[at]])])
    # the rarest prefix shingles of the text before each place
    lead_of = np.searchsorted(at, starts)[owner[at]]
    earlier = np.minimum(np.arange(len(at)) - lead_of, BEFORE)
    grams = hashes[order][at].view(np.int64)
    before = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(earlier))), pa.int32()), pa.array(grams[flat.ranges(lead_of, earlier)]))
    typical = np.bincount(owner, weights=np.log2(np.maximum(frequency, 1)), minlength=len(names)) / np.maximum(sizes, 1)
    met = np.zeros(len(names), bool)
    met[owner[at]] = True
    sets = np.where(met, sizes, 0)
    kept = hashes[flat.ranges(starts, sets)].view(np.int64)
    ends = np.concatenate(([0], np.cumsum(sets)))
    shingles = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(kept), mask=pa.array(~met))
    none = len(at)
    copy = pa.array(names, pa.string())
    return pa.table(
        {
            "copy": pa.concat_arrays([copy, copy.take(pa.array(owner[at]))]),
            "n": pa.array(np.concatenate((sizes, sizes[owner[at]])), pa.int64()),
            "typical": pa.array(np.concatenate((typical, typical[owner[at]])).astype(np.float32)),
            "shingles": pa.concat_arrays([shingles, pa.nulls(none, pa.list_(pa.int64()))]),
            "gram": pa.concat_arrays([pa.nulls(len(names), pa.int64()), pa.array(grams)]),
            "pos": pa.concat_arrays([pa.nulls(len(names), pa.int32()), pa.array(position[at].astype(np.int32))]),
            "before": pa.concat_arrays([pa.nulls(len(names), pa.list_(pa.int64())), before]),
            "rest": pa.concat_arrays(
                [
                    pa.nulls(len(names), pa.list_(pa.int16())),
                    pa.ListArray.from_arrays(pa.array(np.arange(none + 1) * PARTS, pa.int32()), pa.array(np.minimum(rest.ravel(), MOST).astype(np.int16))),
                ]
            ),
        }
    )


def prefixes(documents: DataFrame) -> DataFrame:
    """Every distinct text with its set's size (and the set, if it can have a link), and the prefix rows (``gram`` not null)."""
    rows = documents.select(common.text_of().alias("text"))
    how = census.plan(rows, per_byte=0.25)
    texts = rows.mapInArrow(_distinct, "key long, copy string, text binary")
    blocks = texts.select(census.block_of(F.col("key"), how), "copy", "text")
    return census.counted(blocks, _listed, _prefixes, how, 2, TEXTS)


def _can_link(a: str, b: str) -> Column:
    """Length, positional and suffix filter of two prefix rows with the same shingle, the first they share."""
    need = f"({SHARE} * ({a}.n + {b}.n) + {99 + SHARE}) div {100 + SHARE}"
    return F.expr(
        f"100 * least({a}.n, {b}.n) >= {SHARE} * greatest({a}.n, {b}.n)"
        f" AND least({a}.n - {a}.pos, {b}.n - {b}.pos) >= {need}"
        f" AND NOT arrays_overlap({a}.before, {b}.before)"
        f" AND 1 + aggregate(zip_with({a}.rest, {b}.rest, (x, y) -> least(x, y)), 0, (s, x) -> s + if(x = {MOST}, 1000000000, int(x))) >= {need}"
    )


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) with ``linked``, by the whole sets."""
    both = pairs.join(sets.toDF("u", "left"), ["u"]).join(sets.toDF("v", "right"), ["v"])
    shared = F.size(F.array_intersect("left", "right"))
    return both.select("u", "v", (100 * shared >= SHARE * (F.size("left") + F.size("right") - shared)).alias("linked"))


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(f"{a}.copy", f"{b}.copy").alias("u"), F.greatest(f"{a}.copy", f"{b}.copy").alias("v")]


def _labelled(rows: DataFrame, rooted: DataFrame) -> DataFrame:
    named = rooted.withColumnRenamed("node", "copy")
    return rows.join(named, ["copy"], "left").withColumn("root", F.coalesce("root", "copy"))


def links(texts: DataFrame) -> DataFrame:
    """Links (u, v) that connect all texts of stored ``prefixes`` that the similarity connects, and no others."""
    sets = texts.where("gram IS NULL AND shingles IS NOT NULL").select("copy", "shingles")
    rows = texts.where("gram IS NOT NULL").select("gram", "copy", "n", "typical", "pos", "before", "rest")
    hubs = rows.groupBy("gram").agg(F.max(F.struct("typical", "copy", "n", "pos", "before", "rest")).alias("h")).select("gram", "h.copy", "h.n", "h.pos", "h.before", "h.rest")
    met = rows.alias("a").join(hubs.alias("b"), (F.col("a.gram") == F.col("b.gram")) & (F.col("a.copy") != F.col("b.copy")) & _can_link("a", "b"))
    tested = common.stored(_verified(met.select(*_ordered("a", "b")).distinct(), sets), "verified")
    rooted = roots(tested.where("linked").select("u", "v"))
    largest = (
        _labelled(rows.select("gram", "copy"), rooted).groupBy("gram", "root").agg(F.count("*").alias("m"))
        .groupBy("gram").agg(F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("parts"))
        .where("parts > 1").select("gram", F.col("top.root").alias("top"))
    )
    open_ = _labelled(rows.join(largest, ["gram"]), rooted)
    a, b = open_.where("root <> top").alias("a"), open_.alias("b")
    meets = (F.col("a.gram") == F.col("b.gram")) & (F.col("a.root") != F.col("b.root")) & ((F.col("b.root") == F.col("b.top")) | (F.col("a.copy") < F.col("b.copy")))
    pairs = a.join(b, meets & _can_link("a", "b")).select(*_ordered("a", "b")).distinct().join(tested, ["u", "v"], "left_anti")
    rest = common.stored(_verified(pairs, sets), "verified")
    return tested.union(rest).where("linked").select("u", "v")


def components(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    texts = common.stored(prefixes(documents), "jaccard")
    rooted = roots(links(texts))
    marks = common.stored(documents.select("doc_id", copies("text").alias("copy")), "copies")
    first = marks.where("copy IS NOT NULL").groupBy("copy").agg(F.min("doc_id").alias("least"))
    named = _labelled(texts.where("gram IS NULL").select("copy", "n").join(first, ["copy"]), rooted)
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    known = named.join(least, ["root"]).select("copy", "n", "component")
    return marks.join(known, ["copy"], "left").select(
        "doc_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_shingles"),
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
    )


def op12_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Size of the set and component of every document."""
    return components(common.table(spark, folder, "documents"))


OP12_SQL = f"""
WITH RECURSIVE lists AS (
  SELECT row_number() OVER () AS t, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT t, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(generate_series(1, len(w) - {SHINGLE - 1}), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' '))) END AS s
  FROM lists),
grams AS (SELECT t, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.t AS u, b.t AS v FROM grams a JOIN grams b ON a.g = b.g AND a.t < b.t
  GROUP BY a.t, b.t, a.n, b.n HAVING 100 * count(*) >= {SHARE} * (a.n + b.n - count(*))),
edges AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(t, r) AS (SELECT t, t FROM sets UNION SELECT reach.t, edges.v FROM reach JOIN edges ON edges.u = reach.r)
SELECT a.doc_id, len(a.s)::BIGINT AS n_shingles, min(b.doc_id) AS component_id
FROM reach JOIN sets a ON a.t = reach.t JOIN sets b ON b.t = reach.r GROUP BY a.t, a.doc_id, len(a.s)
"""
