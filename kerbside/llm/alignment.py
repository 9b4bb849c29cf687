"""Alignment of two tokenizers by inverted pair bitmaps.

Every text is cut by both tokenizers; the byte offsets where a token of each
ends part it into groups, and inside a group every token of the one is linked
with every token of the other. Links are kept inverted, as in a search index: a
posting holds, for a pair of ids and a block of documents, the compressed
bitmap of the documents that have the pair linked (a list of places, or plain
bits where those are shorter), and bit planes of how many links of the pair
each document has beyond the first. Chunks of a block are merged by OR; the
containers of different blocks have no document in common, so their popcounts
add up to the number of documents of a pair, whatever their number.

Postings meet the counts of their pairs in a join and go back to their blocks,
where each plane adds its weight times the count to the documents it names. So
rows of the shuffles are pairs of a block, not links.

Defined results: a null or empty text, and one that a tokenizer does not give
back byte by byte, has zeros and an empty digest. Equal rows are documents of
their own. Strings of special tokens are plain text. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import bpe, common, flat

BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"
B_BITS = 15  # an id pair is a << B_BITS | b; the vocabularies have 50,257 and 32,000 ids
BLOCK_LINKS, BLOCK_DOCUMENTS = 3_000_000, 1 << 15
WIDE = 4096  # links of a group above which ids are counted first
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class PieceTokens:
    """The tokenizer with byte fallback, and the bytes of its ids."""

    def __init__(self, name: str = PIECES) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path(name))
        spelled = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            spelled.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode())
        self.lengths = np.array([len(x) for x in spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of ids)."""
        found = self.library.encode(texts, num_threads=1)
        sizes = [len(ids) for ids in found]
        out = np.fromiter((i for ids in found for i in ids), np.int64, sum(sizes))
        return out, np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


@cache
def _pieces() -> PieceTokens:
    return PieceTokens()


@cache
def _decimals(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Digits of 0, 1, ... with room for a mark behind them, and how many each has."""
    width = len(str(size - 1)) + 1
    lengths = np.array([len(str(i)) for i in range(size)])
    return np.array([f"{i:<{width}}".encode() for i in range(size)], f"S{width}").view(np.uint8).reshape(size, width), lengths


class Groups:
    """Tokens of texts by both tokenizers and the groups they form.

    ``ok`` tells which texts have tokens at all; the others have none here.
    """

    def __init__(self, texts: list[str]) -> None:
        raw = [b" " + text.encode() for text in texts]
        self.ok = np.array([len(text) > 1 for text in raw], bool)
        a, b = bpe.encoder(BYTES), _pieces()
        data, offsets = self._laid(raw)
        ids_a, at_a = a.plain(data, offsets)
        ids_b, at_b = b.encode(texts)
        spelled_a = a.merges.token_bytes[flat.ranges(a.merges.token_starts[ids_a], a.merges.token_lengths[ids_a])]
        spelled_b = b.bytes[flat.ranges(b.starts[ids_b], b.lengths[ids_b])]
        ends_a = np.concatenate(([0], np.cumsum(a.merges.token_lengths[ids_a])))[at_a]
        ends_b = np.concatenate(([0], np.cumsum(b.lengths[ids_b])))[at_b]
        for i, text in enumerate(raw):
            same_a = spelled_a[ends_a[i] : ends_a[i + 1]].tobytes() == text
            self.ok[i] &= same_a and spelled_b[ends_b[i] : ends_b[i + 1]].tobytes() == text
        kept_a, kept_b = np.repeat(self.ok, np.diff(at_a)), np.repeat(self.ok, np.diff(at_b))
        self.a, self.b = ids_a[kept_a].astype(np.int64), ids_b[kept_b]
        self.n_a, self.n_b = np.diff(at_a) * self.ok, np.diff(at_b) * self.ok
        end_a, end_b = np.cumsum(a.merges.token_lengths[self.a]), np.cumsum(b.lengths[self.b])
        size = int(end_a[-1]) + 1 if len(end_a) else 1
        cut = np.zeros(size, bool)
        cut[end_a] = True
        other = np.zeros(size, bool)
        other[end_b] = True
        cut &= other
        before = np.cumsum(cut)
        self.group_a, self.group_b = before[end_a] - cut[end_a], before[end_b] - cut[end_b]
        self.groups = int(before[-1]) if size > 1 else 0
        self.size_a, self.size_b = np.bincount(self.group_a, minlength=self.groups), np.bincount(self.group_b, minlength=self.groups)
        owner = np.repeat(np.arange(len(texts)), self.n_a)
        self.owner = owner[np.cumsum(self.size_a) - 1] if self.groups else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.owner, minlength=len(texts))

    @staticmethod
    def _laid(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))).astype(np.int64)

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups in decimal ids; empty without tokens."""
        total = len(self.a) + len(self.b)
        if not total:
            return [""] * len(self.ok)
        first_a, first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        place_a = np.arange(len(self.a)) + first_b[self.group_a]
        place_b = np.arange(len(self.b)) + (first_a + self.size_a)[self.group_b]
        ids, marks = np.empty(total, np.int64), np.full(total, ord(","), np.uint8)
        ids[place_a], ids[place_b] = self.a, self.b
        marks[place_a[first_a + self.size_a - 1]] = ord("|")
        marks[place_b[first_b + self.size_b - 1]] = ord(";")
        digits, lengths = _decimals(1 << 16)
        out = digits[ids]
        size = lengths[ids]
        out[np.arange(total), size] = marks
        written = out[np.arange(out.shape[1]) <= size[:, None]]
        ends = np.concatenate(([0], np.cumsum(size + 1)))[np.concatenate(([0], np.cumsum(self.n_a + self.n_b)))]
        whole = memoryview(written)
        return [hashlib.sha256(whole[low : high - 1]).hexdigest() if high > low else "" for low, high in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, number of links), each pair of a text once, in that order."""
        number = self.size_a * self.size_b
        first_a, first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        few = np.flatnonzero(number <= WIDE)
        at = flat.ranges(np.zeros(len(few), np.int64), number[few])
        group = np.repeat(few, number[few])
        left = self.a[first_a[group] + at // self.size_b[group]]
        right = self.b[first_b[group] + at % self.size_b[group]]
        keys = [self.owner[group] << 32 | left << B_BITS | right]
        weights = [np.ones(len(at), np.int64)]
        for g in np.flatnonzero(number > WIDE).tolist():
            own_a, times_a = np.unique(self.a[first_a[g] : first_a[g] + self.size_a[g]], return_counts=True)
            own_b, times_b = np.unique(self.b[first_b[g] : first_b[g] + self.size_b[g]], return_counts=True)
            keys.append((self.owner[g] << 32 | (own_a << B_BITS)[:, None] | own_b).ravel())
            weights.append((times_a[:, None] * times_b).ravel())
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        times = np.zeros(len(found), np.int64)
        np.add.at(times, place, np.concatenate(weights))
        return found >> 32, found & 0xFFFFFFFF, times


def containers(group: np.ndarray, place: np.ndarray, groups: int, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of one bitmap for each group: sorted places below ``documents``, given in the order of their groups.

    The first byte tells lists of two-byte places (0) from plain bits (1). A
    group without a place has no bytes.
    """
    counts = np.bincount(group, minlength=groups)
    plain = 1 + (documents + 7) // 8
    dense = 1 + 2 * counts > plain
    sizes = np.where(counts == 0, 0, np.where(dense, plain, 1 + 2 * counts))
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    out = np.zeros(int(offsets[-1]), np.uint8)
    listed = ~dense[group]
    few = np.where(dense, 0, counts)
    at = flat.ranges(offsets[:-1] + 1, 2 * few)
    out[at] = np.ascontiguousarray(place[listed].astype("<u2")).view(np.uint8)
    first = np.cumsum(counts) - counts
    for g in np.flatnonzero(dense).tolist():
        bits = np.zeros(documents, bool)
        bits[place[first[g] : first[g] + counts[g]]] = True
        out[offsets[g]] = 1
        out[offsets[g] + 1 : offsets[g + 1]] = np.packbits(bits)
    return out, offsets


def places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(group, place) of every document in the bitmaps, each group's places in order."""
    sizes = np.diff(offsets)
    some = np.flatnonzero(sizes > 0)
    dense = np.zeros(len(sizes), bool)
    dense[some] = data[offsets[some]] == 1
    few = np.where(dense | (sizes == 0), 0, sizes - 1)
    listed = data[flat.ranges(offsets[:-1] + 1, few)]
    groups, found = [np.repeat(np.arange(len(sizes)), few // 2)], [np.ascontiguousarray(listed).view("<u2").astype(np.int64)]
    for g in np.flatnonzero(dense).tolist():
        bits = np.flatnonzero(np.unpackbits(data[offsets[g] + 1 : offsets[g + 1]]))
        groups.append(np.full(len(bits), g))
        found.append(bits)
    return np.concatenate(groups), np.concatenate(found)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def _raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), ends


def postings(place: np.ndarray, pair: np.ndarray, times: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray, pa.Array, pa.Array]:
    """(pair, documents, bitmap, planes) of a block; planes are null where every document has one link of the pair."""
    order = np.lexsort((place, pair))
    place, pair, times = place[order], pair[order], times[order]
    fresh = np.concatenate(([True], pair[1:] != pair[:-1])) if len(pair) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    groups = int(group[-1]) + 1 if len(group) else 0
    more = times - 1
    top = np.zeros(groups, np.int64)
    level = np.where(more > 0, np.floor(np.log2(np.maximum(more, 1))).astype(np.int64) + 1, 0)
    np.maximum.at(top, group, level)
    base = np.concatenate(([0], np.cumsum(top)))
    keys, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(int(top.max()) if groups else 0):
        has = np.flatnonzero(more >> k & 1)
        keys.append(base[group[has]] + k)
        at.append(place[has])
    key, spot = np.concatenate(keys), np.concatenate(at)
    order = np.lexsort((spot, key))
    planes = pa.ListArray.from_arrays(pa.array(base, pa.int32()), _binary(*containers(key[order], spot[order], int(base[-1]), documents)), mask=pa.array(top == 0))
    return pair[fresh], np.bincount(group, minlength=groups), _binary(*containers(group, place, groups, documents)), planes


def _schema(key: T.DataType) -> T.StructType:
    fields = [("block", T.LongType()), ("pair", T.IntegerType()), ("documents", T.IntegerType()), ("bits", T.BinaryType()), ("planes", T.ArrayType(T.BinaryType()))]
    fields += [("place", T.IntegerType()), ("doc_id", key), *[(name, T.LongType()) for name in COUNTS], ("groups_sha256", T.StringType())]
    return T.StructType([T.StructField(*field) for field in fields])


class Block:
    """Documents and links of a block while it fills."""

    def __init__(self, number: int, key: pa.DataType) -> None:
        self.number, self.key = number, key
        self.ids: list[pa.Array] = []
        self.size = self.held = 0
        self.counts: list[np.ndarray] = []
        self.digests: list[str] = []
        self.links: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, ids: pa.Array, texts: list[str]) -> None:
        groups = Groups(texts)
        text, pair, times = groups.links()
        sums = np.zeros(len(texts), np.int64)
        np.add.at(sums, text, times)
        self.ids.append(ids)
        self.counts.append(np.stack((groups.n_a, groups.n_b, groups.n_groups, sums)))
        self.digests += groups.digests()
        self.links.append((text + self.size, pair, times))
        self.size += len(texts)
        self.held += len(pair)

    def batches(self) -> Iterator[pa.RecordBatch]:
        place, pair, times = (np.concatenate(parts) for parts in zip(*self.links, strict=True))
        pairs, documents, bits, planes = postings(place, pair, times, self.size)
        n, m = len(pairs), self.size
        counts = np.concatenate(self.counts, axis=1)
        columns = {
            "block": pa.array(np.full(n + m, self.number, np.int64)),
            "pair": pa.concat_arrays([pa.array(pairs.astype(np.int32)), pa.nulls(m, pa.int32())]),
            "documents": pa.concat_arrays([pa.array(documents.astype(np.int32)), pa.nulls(m, pa.int32())]),
            "bits": pa.concat_arrays([bits, pa.nulls(m, pa.binary())]),
            "planes": pa.concat_arrays([planes, pa.nulls(m, pa.list_(pa.binary()))]),
            "place": pa.concat_arrays([pa.nulls(n, pa.int32()), pa.array(np.arange(m, dtype=np.int32))]),
            "doc_id": pa.concat_arrays([pa.nulls(n, self.key), *self.ids]),
        }
        for k, name in enumerate(COUNTS):
            columns[name] = pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(counts[k])])
        columns["groups_sha256"] = pa.concat_arrays([pa.nulls(n, pa.string()), pa.array(self.digests, pa.string())])
        yield from pa.table(columns).to_batches(max_chunksize=50_000)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = TaskContext.get().partitionId() << 32
    block = None
    for batch in batches:
        ids, texts = batch.column("doc_id"), batch.column("text")
        low = 0
        while low < len(batch):
            size, high = 0, low
            while high < len(batch) and (high == low or size < flat.CHUNK):
                size += len(texts[high].as_py() or "")
                high += 1
            block = block or Block(first, ids.type)
            block.add(ids.slice(low, high - low), [text or "" for text in texts.slice(low, high - low).to_pylist()])
            low = high
            if block.held >= BLOCK_LINKS or block.size + common.BATCH_ROWS > BLOCK_DOCUMENTS:
                yield from block.batches()
                first += 1
                block = None
    if block:
        yield from block.batches()


def inverted(documents: DataFrame) -> DataFrame:
    """Rows of two kinds by block: postings (``pair`` not null) and documents (``place`` not null)."""
    kind = _schema(documents.schema["doc_id"].dataType)
    return documents.select("doc_id", common.text_of().alias("text")).mapInArrow(_blocks, kind)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best): the documents of each pair, and whether its left id has no pair with more."""
    counts = rows.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("documents").alias("n"))
    # at most the right vocabulary in a group
    most = F.max("n").over(W.partitionBy(F.shiftright("pair", B_BITS)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def _scored(rows: pa.Table) -> pa.Table:
    """The documents of a block with ``n_best`` and ``count_sum``, from its postings with counts."""
    rows = rows.combine_chunks()
    known = rows.filter(pc.is_valid(rows.column("place"))).sort_by("place")
    found = rows.filter(pc.is_valid(rows.column("pair")))
    n = found.column("n").to_numpy()
    best = found.column("best").to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((2, len(known)), np.int64)

    def add(posting: np.ndarray, place: np.ndarray, weight: np.ndarray | int) -> None:
        np.add.at(out[0], place, best[posting] * weight)
        np.add.at(out[1], place, n[posting] * weight)

    if len(found):
        group, place = places(*_raw(found.column("bits").combine_chunks()))
        add(group, place, 1)
        planes = found.column("planes").combine_chunks()
        sizes = pc.list_value_length(planes).fill_null(0).to_numpy()
        group, place = places(*_raw(planes.flatten()))
        posting, level = np.repeat(np.arange(len(sizes)), sizes), flat.ranges(np.zeros(len(sizes), np.int64), sizes.astype(np.int64))
        add(posting[group], place, np.left_shift(1, level[group]))
    kept = known.select(["doc_id", *COUNTS, "groups_sha256"])
    return kept.append_column("n_best", pa.array(out[0])).append_column("count_sum", pa.array(out[1]))


def aligned(documents: DataFrame) -> DataFrame:
    """Counts, best links, sums of counts and the digest of the groups of every document."""
    rows = common.stored(inverted(documents), "alignment")
    scores = pair_counts(rows)
    postings_ = rows.where("pair IS NOT NULL").select("block", "pair", "bits", "planes").join(scores, ["pair"])
    own = rows.where("place IS NOT NULL").select("block", "place", "doc_id", *COUNTS, "groups_sha256")
    kind = ", ".join(["doc_id " + documents.schema["doc_id"].dataType.simpleString(), *[f"{name} long" for name in COUNTS], "groups_sha256 string, n_best long, count_sum long"])
    return own.unionByName(postings_, allowMissingColumns=True).groupBy("block").applyInArrow(_scored, kind)


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Both tokenizers' alignment in every document, scored by corpus-wide pair counts."""
    found = aligned(common.table(spark, folder, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
