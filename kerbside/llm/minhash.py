"""Document fingerprints by MinHash.

The shingles of a batch of texts (five words; the whole sequence where a text
has fewer) are hashed in flat numpy arrays; each of ``PERMUTATIONS`` universal
hash functions a * h + b modulo 2^64 permutes them, and the least value of each
text, cut to 16 bits, is one coordinate of its fingerprint. The share of equal
coordinates estimates the Jaccard similarity of the shingle sets.

``classes`` joins signature bands in Spark and verifies the Jaccard similarity
of the texts that meet: first of each text with the hub of its band, the text
whose bands are shared most, then of texts of a band that are not yet connected.
Near copies of one text so cost rows and not pairs. Where more than ``MANY`` texts
of a band are not all connected, as with a passage that many different texts share,
they meet by shingles instead: a prefix join, rarest shingles first with a filter by
place, finds every similar pair among them, again by the hub of a shingle first. Pairs whose signatures agree in less than ``FAR`` of the coordinates,
over four standard deviations under ``SIMILAR``, are not compared. Bands of
``WIDTH`` coordinates miss a pair of similarity 0.8 with a chance of 1.5 %.
``near_duplicates`` counts every link as well, and so compares all pairs of a
band. ``neighbours`` walks documents in the order of their ids, which is what
``op3_minhash`` compares along; its texts travel compressed.

Defined results: null counts as empty; texts without a word share the
fingerprint of all ones and are near equal texts only. Equal texts have equal
fingerprints and one class, texts being told apart by 64-bit hashes. A class is
named by its least id; without any id it is null. Null ids come after all
others, and ties are ordered by the hash of the text. A single document is its
own next one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import common, flat
from kerbside.llm.components import roots

PERMUTATIONS = 128
SHINGLE = 5
BANDS, ROWS = 25, 5
SIMILAR = 0.8
# Coordinates of a band of ``classes``, and the share of equal ones below which a pair is not compared.
WIDTH, FAR = 7, 0.65
# Texts of a band up to which all its open pairs are compared; those of others meet by rare shingles.
MANY = 32
SLACK = 1e-6  # of a filter in floating point, so that it drops no pair
# Rows that may be broadcast; more are joined by a shuffle.
LIGHT = 1 << 22
# Documents in a run of consecutive ids, and runs at most.
RUN, RUNS = 500, 10_000


@cache
def universal() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and summands of the permutations."""
    made = flat.mixed(np.arange(1, 2 * PERMUTATIONS + 1, dtype=np.uint64) * flat.MULTIPLIER)
    return made[:PERMUTATIONS] | np.uint64(1), made[PERMUTATIONS:]


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, hashes of each text) of the shingles of texts that lie behind each other."""
    _, _, words, first = flat.words(data, offsets)
    counts = np.diff(first)
    made = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    at = flat.ranges(first[:-1], made)
    end = np.repeat(first[1:], made)
    padded = np.concatenate((words, np.zeros(SHINGLE, np.uint64)))
    total = np.zeros(len(at), np.uint64)
    for k in range(SHINGLE):
        part = np.where(at + k < end, padded[at + k], np.uint64(0))
        total = flat.mixed(total * flat.MULTIPLIER + part + np.uint64(k + 1))
    return total, made


def signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of coordinates for each text."""
    hashes, counts = shingles(data, offsets)
    out = np.full((len(counts), PERMUTATIONS), 0xFFFF, np.uint16)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        for k, (a, b) in enumerate(zip(*universal(), strict=True)):
            out[some, k] = np.minimum.reduceat(hashes * a + b, starts) >> np.uint64(48)
    return out


def written(row: np.ndarray) -> str:
    return row.astype(">u2").tobytes().hex()


@F.arrow_udf(T.StringType())
def _fingerprint(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([written(row) for part in flat.chunks(batch) for row in signatures(*part)], pa.string())


def fingerprints(text: str = "text") -> Column:
    """The fingerprint of a text column, four hex digits for each coordinate."""
    return _fingerprint(F.col(text))


@F.arrow_udf(T.ArrayType(T.LongType()))
def _shingle_sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        sets = []
        for data, offsets in flat.chunks(batch):
            hashes, counts = shingles(data, offsets)
            ends = np.cumsum(counts)
            sets += [np.unique(hashes[e - n : e]).view(np.int64) for e, n in zip(ends, counts, strict=True)]
        yield pa.array(sets, pa.list_(pa.int64()))


def near_duplicates(documents: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, class_id, n_links) of every document.

    Exact copies are one text. Different texts that share a band of their
    signatures meet once in a join, and are linked if the Jaccard similarity of
    their shingle sets is at least ``similar``; links are counted between texts.
    """
    rows = common.stored(
        documents.select("doc_id", F.sha2(common.text_of(), 256).alias("copy"), fingerprints("text").alias("fp"), _shingle_sets(F.col("text")).alias("set")),
        "minhash",
    )
    texts = rows.groupBy("copy").agg(F.min("doc_id").alias("least"), F.first("fp").alias("fp"), F.first("set").alias("set")).where(F.size("set") > 0)
    band = 4 * ROWS
    keys = F.array(*[F.xxhash64(F.lit(b), F.substring("fp", b * band + 1, band)) for b in range(BANDS)])
    banded = texts.select("copy", F.explode(F.array_distinct(keys)).alias("key"))
    a, b = banded.alias("a"), banded.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.copy") < F.col("b.copy"))).select(F.col("a.copy").alias("u"), F.col("b.copy").alias("v")).distinct()
    sets = texts.select("copy", "set")
    both = met.join(sets.toDF("u", "left"), ["u"]).join(sets.toDF("v", "right"), ["v"])
    shared = F.size(F.array_intersect("left", "right"))
    links = common.stored(both.where(shared >= similar * (F.size("left") + F.size("right") - shared)).select("u", "v"), "links")
    degree = links.select(F.explode(F.array("u", "v")).alias("copy")).groupBy("copy").agg(F.count("*").alias("n_links"))
    named = (
        rows.groupBy("copy").agg(F.min("doc_id").alias("least"))
        .join(roots(links).withColumnRenamed("node", "copy"), ["copy"], "left")
        .join(degree, ["copy"], "left")
        .withColumns({"root": F.coalesce("root", "copy"), "n_links": F.coalesce("n_links", F.lit(0))})
    )
    classes = named.groupBy("root").agg(F.min("least").alias("class_id"))
    return rows.select("doc_id", "copy").join(named.join(classes, ["root"]), ["copy"]).select("doc_id", "class_id", "n_links")


@F.arrow_udf(T.BinaryType())
def _signature(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Signatures; null for texts without a word."""
    for batch in batches:
        rows = [row for part in flat.chunks(batch) for row in signatures(*part)]
        yield pa.array([None if (row == 0xFFFF).all() else row.tobytes() for row in rows], pa.binary())


@F.arrow_udf(T.DoubleType())
def _likeness(left: pa.Array, right: pa.Array) -> pa.Array:
    """The share of equal coordinates of two signatures."""
    a, b = (np.frombuffer(b"".join(side.to_pylist()), np.uint16).reshape(-1, PERMUTATIONS) for side in (left, right))
    return pa.array((a == b).mean(axis=1))


@F.arrow_udf(T.BinaryType())
def _packed(texts: pa.Array) -> pa.Array:
    compressor = zstandard.ZstdCompressor(level=3)
    return pa.array([compressor.compress(text) for text in texts.cast(pa.large_binary()).to_pylist()], pa.binary())


def _unpacked(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


@lru_cache(64)
def _set(packed: bytes) -> np.ndarray:
    return np.unique(shingles(*_joined([_unpacked(packed)]))[0])


@F.arrow_udf(T.ArrayType(T.LongType()))
def _shingle_set(packed: pa.Array) -> pa.Array:
    return pa.array([_set(text.as_py()).view(np.int64) for text in packed], pa.list_(pa.int64()))


@F.arrow_udf(T.DoubleType())
def _jaccard(left: pa.Array, right: pa.Array) -> pa.Array:
    """The similarity of two texts by their whole shingle sets; one pair is held at a time."""
    found = []
    for a, b in zip(left, right, strict=True):
        one, two = _set(a.as_py()), _set(b.as_py())
        shared = len(np.intersect1d(one, two, assume_unique=True))
        found.append(shared / (len(one) + len(two) - shared))
    return pa.array(found, pa.float64())


def _copy(text: str = "text") -> Column:
    return F.xxhash64(common.text_of(text))


def _light(rows: DataFrame) -> DataFrame:
    """Stored rows of a few numbers, to be broadcast if there are at most ``LIGHT``."""
    return F.broadcast(rows) if rows.limit(LIGHT + 1).count() <= LIGHT else rows


def _verified(pairs: DataFrame, sketches: DataFrame, packed: DataFrame) -> DataFrame:
    """Those of the pairs (u, v) of texts that are similar."""
    by_sketch = pairs.join(sketches.toDF("u", "left"), ["u"]).join(sketches.toDF("v", "right"), ["v"])
    near = by_sketch.where(_likeness("left", "right") >= FAR).select("u", "v")
    by_text = near.join(packed.toDF("u", "left"), ["u"]).join(packed.toDF("v", "right"), ["v"])
    return common.stored(by_text.where(_jaccard("left", "right") >= SIMILAR).select("u", "v"), "links")


def _labelled(met: DataFrame, links: DataFrame) -> DataFrame:
    return met.join(roots(links).withColumnRenamed("node", "copy"), ["copy"], "left").withColumn("root", F.coalesce("root", "copy"))


def _open(met: DataFrame, links: DataFrame) -> DataFrame:
    """Rows of the keys whose texts are in several components: with their root, the largest one (``top``) and the number of texts."""
    labelled = _labelled(met, links)
    sizes = labelled.groupBy("key", "root").agg(F.count("*").alias("m")).groupBy("key")
    several = sizes.agg(F.max(F.struct("m", "root")).alias("top"), F.count("*").alias("parts"), F.sum("m").alias("texts")).where("parts > 1")
    return common.stored(labelled.join(several.select("key", F.col("top.root").alias("top"), "texts"), ["key"]), "bands")


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("u"), F.greatest(a, b).alias("v")]


def _apart(rows: DataFrame, alike: Column) -> DataFrame:
    """Pairs of texts of a key that are in different components, those outside the largest with all of it."""
    a, b = rows.where("root <> top").alias("a"), rows.alias("b")
    once = (F.col("b.root") == F.col("b.top")) | (F.col("a.copy") < F.col("b.copy"))
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & once & alike)
    return met.select(*_pair("a.copy", "b.copy")).distinct()


def _prefixes(packed: DataFrame) -> DataFrame:
    """Rows (key, copy, n, pos, typical): the shingles of a text that a similar one must share, if another text has them.

    Each text orders its ``n`` shingles rarest first, ties by hash; a set that is
    similar shares one of those at places (``pos``) below n - ceil(SIMILAR * n) + 1.
    """
    sets = common.stored(packed.select("copy", _shingle_set("packed").alias("set")), "sets")
    grams = sets.select("copy", F.size("set").alias("n"), F.explode("set").alias("key"))
    often = grams.groupBy("key").agg(F.count("*").alias("often")).where("often > 1")
    own = Window.partitionBy("copy")
    place = F.col("n") - F.count("*").over(own) + F.row_number().over(own.orderBy("often", "key")) - 1
    ranked = grams.join(often, ["key"]).withColumns({"pos": place, "typical": F.sum(F.log2("often")).over(own) / F.col("n")})
    return common.stored(ranked.where(F.col("pos") < F.col("n") - F.ceil(SIMILAR * F.col("n") - SLACK) + 1).drop("often"), "prefixes")


def _can_link(a: str, b: str) -> Column:
    """Whether two sets can be similar by their sizes and by what lies behind a shingle they share."""
    n, m, p, q = (F.col(c) for c in (f"{a}.n", f"{b}.n", f"{a}.pos", f"{b}.pos"))
    need = SIMILAR / (1 + SIMILAR) * (n + m) - SLACK
    return (F.least(n, m) >= SIMILAR * F.greatest(n, m) - SLACK) & (F.least(n - p, m - q) >= need)


def _by_shingles(crowded: DataFrame, packed: DataFrame, links: DataFrame, known: DataFrame, verified) -> DataFrame:
    """Links that connect all similar ones of the texts (copy, root) that ``links`` leave apart; pairs in ``known`` were compared."""
    rows = _prefixes(packed.join(crowded, ["copy"], "left_semi")).join(crowded, ["copy"])
    hubs = rows.groupBy("key").agg(F.max(F.struct("typical", "copy", "n", "pos", "key", "root")).alias("hub")).select("hub.*")
    a, b = rows.alias("a"), hubs.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.root") != F.col("b.root")) & _can_link("a", "b"))
    stars = common.stored(met.select(*_pair("a.copy", "b.copy")).distinct().join(known, ["u", "v"], "left_anti"), "stars")
    found = verified(stars)
    rest = _apart(_open(rows.drop("root"), links.union(found)), _can_link("a", "b"))
    return found.union(verified(rest.join(known.union(stars), ["u", "v"], "left_anti")))


def _links(met: DataFrame, packed: DataFrame, verified) -> DataFrame:
    """Links that connect all similar texts among those that meet: ``met`` has key, copy and the hub of the key."""
    stars = common.stored(met.where("copy <> hub").select(*_pair("hub", "copy")).distinct(), "stars")
    links = verified(stars)
    open_ = _open(met.select("key", "copy"), links)
    pairs = common.stored(_apart(open_.where(F.col("texts") <= MANY), F.lit(True)).join(stars, ["u", "v"], "left_anti"), "pairs")
    links = common.stored(links.union(verified(pairs)), "links")
    crowded = common.stored(open_.where(F.col("texts") > MANY).select("copy", "root").distinct(), "crowded")
    if crowded.isEmpty():
        return links
    return links.union(_by_shingles(crowded, packed, links, stars.union(pairs), verified))


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, copy, class_id) of the documents whose class is not named by their own id.

    Similar texts that share a band are in one class, and so are those connected
    through others; a class may hold texts less similar to each other.
    """
    rows = documents.select(F.col(key).alias("id"), common.text_of(text).alias("text")).withColumn("copy", _copy())
    sketched = rows.select("id", "copy", _signature("text").alias("sketch"))
    texts = common.stored(sketched.groupBy("copy").agg(F.min("id").alias("least"), F.first("sketch").alias("sketch")), "minhash")
    width = 2 * WIDTH
    keys = [F.xxhash64(F.lit(b), F.substring("sketch", b * width + 1, width)) for b in range(PERMUTATIONS // WIDTH)]
    banded = texts.where("sketch IS NOT NULL").select("copy", F.explode(F.array(*keys)).alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    rows_of = common.stored(banded.join(_light(common.stored(shared, "shared")), ["key"]), "bands")
    typical = rows_of.groupBy("copy").agg(F.sum(F.log2("n")).alias("typical"))
    hubs = rows_of.join(typical, ["copy"]).groupBy("key").agg(F.max(F.struct("typical", "copy")).alias("hub"))
    met = common.stored(rows_of.join(hubs.select("key", F.col("hub.copy").alias("hub")), ["key"]).select("key", "copy", "hub"), "bands")
    meeting = _light(common.stored(met.select("copy").distinct(), "meeting"))
    sketches = texts.join(meeting, ["copy"], "left_semi").select("copy", "sketch")
    chosen = rows.select("copy", "text").join(meeting, ["copy"], "left_semi").select("copy", _packed("text").alias("packed"))
    packed = common.stored(chosen.groupBy("copy").agg(F.first("packed").alias("packed")), "texts")
    links = common.stored(_links(met, packed, lambda pairs: _verified(pairs, sketches, packed)), "links")
    rooted = _labelled(texts.select("copy", "least"), links)
    names = rooted.groupBy("root").agg(F.min("least").alias("class_id"))
    named = rooted.join(names, ["root"]).select("copy", "class_id")
    return rows.select("id", "copy").join(named, ["copy"]).where(~F.col("class_id").eqNullSafe(F.col("id")))


def neighbours(documents: DataFrame, key: str = "doc_id", text: str = "text", marks: DataFrame | None = None) -> DataFrame:
    """Rows (run, tail, id, copy, packed, class_id), partitioned and sorted so that each run lists its
    documents in the order of their ids and then, flagged ``tail``, the one after.
    A row of ``marks`` (see ``classes``) comes without a text, before the documents it is about.

    Runs are ranges of ids between actual ids (at most ``RUNS``, quantiles from a
    pass over the ids alone), so the texts are shuffled once; only the first
    document of each run is sent twice.
    """
    ids = documents.select(F.col(key).alias("id"))
    number, least = ids.agg(F.count("*"), F.min("id")).first()
    runs = min(RUNS, max(1, number // RUN))
    shares = [k / runs for k in range(1, runs)]
    found = ids.agg(F.percentile_approx("id", shares, 100 * runs).alias("q")).first()["q"] if shares else []
    bounds = np.array(sorted(set(found or ()) - {least}), np.int64)

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def homes(column: pa.Array) -> pa.Array:
        """Own run; then the run before, if this is the first of a run."""
        known = column.is_valid().to_numpy(zero_copy_only=False)
        values = column.fill_null(0).to_numpy(zero_copy_only=False)
        own = np.where(known, np.searchsorted(bounds, values, "right"), len(bounds))
        first = known & (own > 0) & (bounds[np.maximum(own - 1, 0)] == values) if len(bounds) else np.zeros(len(own), bool)
        wraps = known & (values == least) if least is not None else ~known
        other = np.where(wraps, len(bounds), own - 1)
        sizes = 1 + (first | wraps)
        places = np.repeat(own, sizes)
        places[np.cumsum(sizes)[sizes == 2] - 1] = other[sizes == 2]
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(places, pa.int32()))

    rows = documents.select(F.col(key).alias("id"), common.text_of(text).alias("text"))
    placed = rows.select("id", _copy().alias("copy"), _packed("text").alias("packed"), homes("id").alias("h"))
    none = F.lit(None).cast("long").alias("class_id")
    spread = placed.select(F.posexplode("h").alias("tail", "run"), "id", "copy", "packed", none)
    if marks is not None:
        own = F.element_at(homes("id"), 1)
        spread = spread.union(marks.select(F.lit(0), own, "id", "copy", F.lit(None).cast("binary"), "class_id"))
    return spread.repartition("run").sortWithinPartitions("run", "tail", F.col("id").isNull(), "id", "copy", F.col("packed").isNotNull())


def edited(text: str, following: str) -> str:
    """The last half replaced by as much of the beginning of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])


COMPARED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, class_id long"
KIND = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
        ("class_id", pa.int64()),
    ]
)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (run, tail, id, text, class) in lists of about a chunk of text; each list starts with the last row of the one before."""
    held: list[tuple] = []
    size, marked = 0, None
    for batch in batches:
        for run, tail, id_, copy, packed, name in zip(*(batch.column(c) for c in ("run", "tail", "id", "copy", "packed", "class_id")), strict=True):
            at = id_.as_py(), copy.as_py()
            if not packed.is_valid:
                marked = at, name.as_py()
                continue
            own = marked[1] if marked and marked[0] == at else at[0]
            row = (run.as_py(), tail.as_py(), at[0], _unpacked(packed.as_py()).decode(), own)
            held.append(row)
            size += len(row[3])
            if size > flat.CHUNK and len(held) > 1:
                yield held
                held, size = [row], 0
    if len(held) > 1:
        yield held


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches):
        texts = [row[3].encode() for row in rows]
        # a document and the row after it, within a run
        pairs = [k for k in range(len(rows) - 1) if not rows[k][1] and rows[k][0] == rows[k + 1][0]]
        if not pairs:
            continue
        changed = [edited(rows[k][3], rows[k + 1][3]).encode() for k in pairs]
        own, other = signatures(*_joined(texts)), signatures(*_joined(changed))
        at = np.array(pairs)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([rows[k][2] for k in pairs], pa.int64()),
                pa.array([len(rows[k][3]) for k in pairs], pa.int64()),
                pa.array([hashlib.sha256(text).hexdigest() for text in changed]),
                pa.array([written(own[k]) for k in pairs]),
                pa.array([written(row) for row in other]),
                pa.array((own[at] == other).mean(axis=1)),
                pa.array((own[at] == own[at + 1]).mean(axis=1)),
                pa.array([rows[k][4] for k in pairs], pa.int64()),
            ],
            schema=KIND,
        )


def op3_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, their likeness, and the class of near duplicates."""
    documents = common.table(spark, folder, "documents")
    return neighbours(documents, marks=classes(documents)).mapInArrow(_compare, COMPARED)
