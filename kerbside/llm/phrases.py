"""Phrase collocations by Rabin-Karp fingerprints.

Texts lie in blocks. In a block the words become 64-bit hashes, prefix sums of
their polynomial give the fingerprint of every n-gram of one to four words by
one subtraction, and the language is mixed in. A census of the fingerprints
over all blocks tells each block which of its n-grams can be frequent. Only
those are followed from their occurrences back to the text: all occurrences of
a fingerprint are compared, word by word and byte by byte, with the first, what
differs is counted apart, and the phrase is spelled once per block. Phrases are
then counted by their text, so a collision costs time and changes nothing.

Cuts and longer phrases are joins between frequent phrases; every part of a
frequent phrase is frequent itself.

Defined results: a null text is empty and has no words; a null language is
``und``, together with rows that say so. A language without a candidate has no
row. An empty table gives an empty result. Repeated rows count as often as they
are there.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kerbside.llm import census, common, flat

LONGEST, LEAST, KEPT, SHARE = 4, 30, 2000, 80
SCALE = 2_000_000
UNKNOWN = "und"
FOUND = "lang string, phrase string, f long"

# What parts words, and what parts pieces.
BLANKS, MARKS = b"\x20\x09", b".,;:!?\x0a\x0b\x0c\x0d"
KIND = np.zeros(256, np.uint8)
KIND[list(BLANKS)] = 1
KIND[list(MARKS)] = 2
# Upper case to lower case, and whatever parts words to a space.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER[KIND > 0] = 32

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def prefixes(hashes: np.ndarray) -> np.ndarray:
    """Sums of hashes times powers of the base, before each word and after the last."""
    return np.concatenate((np.zeros(1, np.uint64), np.cumsum(hashes * _powers(BASE, len(hashes)))))


class Words:
    """The words of a block: spelled behind each other with a space after each, in pieces."""

    def __init__(self, rows: pa.Table) -> None:
        texts = census.grown(rows.column("text"))
        langs = rows.column("lang").combine_chunks().fill_null(UNKNOWN).dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        parts = list(flat.chunks(texts, 1 << 40))
        data, offsets = parts[0] if parts else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        plain = LOWER[data]
        starts, self.lengths, self.hashes, first = flat.words(plain, offsets)
        marks = KIND[data] == 2
        parted = marks.astype(np.int32)
        parted[offsets[:-1][offsets[1:] > offsets[:-1]]] += 1
        self.piece = np.cumsum(parted, dtype=np.int32)[starts]
        self.lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(first))
        ends = np.cumsum(self.lengths + 1)
        self.places = ends - self.lengths - 1
        self.spelled = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        self.spelled[flat.ranges(self.places, self.lengths)] = plain[flat.ranges(starts, self.lengths)]

    def fingerprints(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first word) of every n-gram of ``size`` words."""
        at = np.arange(max(0, len(self.hashes) - size + 1))
        if size > 1:
            at = at[self.piece[at] == self.piece[at + size - 1]]
        sums = prefixes(self.hashes)
        seeds = np.array([xxhash.xxh64_intdigest(lang.encode(), size) for lang in self.langs], np.uint64)
        grams = (sums[at + size] - sums[at]) * _powers(INVERSE, len(self.hashes))[at]
        return flat.mixed(grams + seeds[self.lang[at]]) if len(at) else np.zeros(0, np.uint64), at

    def numbers(self) -> np.ndarray:
        """A number for each word, the same for the same bytes and for no others."""
        _, first, number = np.unique(self.hashes, return_index=True, return_inverse=True)
        model = first[number]
        odd = self.lengths != self.lengths[model]
        same = np.flatnonzero(~odd)
        here, there = flat.ranges(self.places[same], self.lengths[same]), flat.ranges(self.places[model[same]], self.lengths[same])
        wrong = self.spelled[here] != self.spelled[there]
        odd[same] = np.logical_or.reduceat(wrong, np.cumsum(self.lengths[same]) - self.lengths[same]) if len(same) else False
        known: dict[bytes, int] = {}
        for at in np.flatnonzero(odd).tolist():  # hashes that met by chance
            word = self.spelled[self.places[at] : self.places[at] + self.lengths[at]].tobytes()
            number[at] = known.setdefault(word, len(first) + len(known))
        return number

    def texts(self, at: np.ndarray, size: int) -> pa.Array:
        """The n-grams of ``size`` words that start at the given words, spelled with single spaces."""
        lengths = self.places[at + size - 1] + self.lengths[at + size - 1] - self.places[at]
        offsets = np.concatenate(([0], np.cumsum(lengths)))
        data = self.spelled[flat.ranges(self.places[at], lengths)]
        return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)).cast(pa.string())


def _listed(rows: pa.Table, how: census.Plan) -> pa.Table:
    words = Words(rows)
    block = rows.column("block")[0].as_py()
    return census.packed(np.concatenate([words.fingerprints(size)[0] for size in range(1, LONGEST + 1)]), block, how)


FOUND_ROWS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])


def _frequent(rows: pa.Table, totals: census.Totals) -> pa.Table:
    """(lang, phrase, f) of a block's phrases that can be frequent; the empty phrase counts its words."""
    words = Words(rows)
    numbers, langs = words.numbers(), pa.array(words.langs, pa.string())
    everything = np.bincount(words.lang, minlength=len(words.langs))
    out = [pa.table([langs, pa.array([""] * len(langs)), pa.array(everything, pa.int64())], schema=FOUND_ROWS)]

    def add(at: np.ndarray, size: int, n: np.ndarray) -> None:
        columns = [langs.take(pa.array(words.lang[at])), words.texts(at, size), pa.array(n, pa.int64())]
        out.append(pa.table(columns, schema=FOUND_ROWS))

    for size in range(1, LONGEST + 1):
        found, at = words.fingerprints(size)
        kept = totals.of(found) > 0
        found, at = found[kept], at[kept]
        if not len(at):
            continue
        _, first, group, own = np.unique(found, return_index=True, return_inverse=True, return_counts=True)
        model = at[first][group]
        wrong = words.lang[at] != words.lang[model]
        for k in range(size):
            wrong |= numbers[at + k] != numbers[model + k]
        add(at[first], size, own - np.bincount(group[wrong], minlength=len(first)))
        if wrong.any():  # fingerprints that met by chance: counted one by one
            add(at[wrong], size, np.ones(int(wrong.sum()), np.int64))
    return pa.concat_tables(out)


def phrase_counts(documents: DataFrame, key: Column, least: int = LEAST) -> DataFrame:
    """(lang, size, phrase, f) of all phrases of one to four words with f at least ``least``; size 0 has each language's words.

    ``key`` is a 64-bit expression that deals rows into blocks: it must stay the
    same when a row is read again, and no value may have too large a share.
    """
    rows = documents.select(key.alias("key"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), common.text_of().alias("text"))
    how = census.plan(rows, per_byte=0.6)
    blocks = rows.select(census.block_of(F.col("key"), how), "lang", census.shrunk(F.col("text")).alias("text"))
    found = census.counted(blocks, _listed, _frequent, how, least, FOUND, exact=False)
    size = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " "))).alias("size")
    kept = found.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where((F.col("f") >= least) | (F.col("phrase") == ""))
    return kept.select("lang", size, "phrase", "f")


def collocations(counts: DataFrame, kept: int = KEPT) -> DataFrame:
    """The best phrases of every language from stored phrase counts."""
    words = counts.where("size > 0").select("lang", "phrase", "f")
    long = counts.where("size > 1")
    parts = long.select("lang", "size", "phrase", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        F.expr("substring_index(phrase, ' ', k)").alias("first"),
        F.expr("substring_index(phrase, ' ', k - size)").alias("rest"),
    )
    cuts = parts.join(words.toDF("lang", "first", "l"), ["lang", "first"]).join(words.toDF("lang", "rest", "r"), ["lang", "rest"])
    score = F.expr(f"CAST(CAST(a AS DECIMAL(20, 0)) * {SCALE} div (CAST(l AS DECIMAL(20, 0)) + r) AS BIGINT)")
    scored = (
        cuts.groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = long.where("size > 2").select(
        "lang", F.col("f").alias("whole"),
        F.expr(
            "explode(transform(flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), i -> struct(n, i)))),"
            " x -> array_join(slice(split(phrase, ' '), x.i, x.n), ' ')))"
        ).alias("phrase"),
    )
    around = inner.groupBy("lang", "phrase").agg(F.max("whole").alias("whole"))
    free = scored.join(around, ["lang", "phrase"], "left").where("whole IS NULL OR CAST(whole AS DECIMAL(20, 0)) * 100 < CAST(a AS DECIMAL(20, 0)) * " + str(SHARE))
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = free.withColumn("rank", place).where(F.col("rank") <= kept)
    totals = counts.where("size = 0").select("lang", F.col("f").alias("n"))
    return best.join(totals, ["lang"]).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_phrases(spark: SparkSession, folder: str) -> DataFrame:
    """The best collocations of every language, over whole texts."""
    documents = common.table(spark, folder, "documents")
    return collocations(common.stored(phrase_counts(documents, census.address()), "phrases"))


OP11_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, doc_id, row_number() OVER () AS t,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
pieces AS (SELECT lang, t, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
lists AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, size, list_aggregate(list_slice(w, i, i + size - 1), 'string_agg', ' ') AS phrase
  FROM lists, (VALUES (1), (2), (3), (4)) s(size), LATERAL (SELECT unnest(generate_series(1, len(w) - size + 1)) AS i)),
counts AS (SELECT lang, size, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {LEAST}),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM lists GROUP BY lang),
parts AS (
  SELECT lang, phrase, f AS a, k,
         array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS first,
         array_to_string(list_slice(string_split(phrase, ' '), k + 1, size), ' ') AS rest
  FROM counts, LATERAL (SELECT unnest(generate_series(1, size - 1)) AS k) WHERE size > 1),
cuts AS (
  SELECT p.lang, p.phrase, a, k, x.f AS l, y.f AS r, (a::HUGEINT * {SCALE} // (x.f + y.f))::BIGINT AS score
  FROM parts p JOIN counts x ON x.lang = p.lang AND x.phrase = p.first JOIN counts y ON y.lang = p.lang AND y.phrase = p.rest),
scored AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, f AS whole, array_to_string(list_slice(string_split(phrase, ' '), i, i + m - 1), ' ') AS phrase
  FROM counts, (VALUES (2), (3)) s(m), LATERAL (SELECT unnest(generate_series(1, size - m + 1)) AS i) WHERE size > m),
around AS (SELECT lang, phrase, max(whole) AS whole FROM inside GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, encode(s.phrase)) AS rank
  FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
  WHERE o.whole IS NULL OR 100 * o.whole::HUGEINT < {SHARE} * a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= {KEPT}
"""
