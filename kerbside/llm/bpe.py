"""Byte-level BPE in batched numpy merge rounds.

The pieces of a batch are found with array operations, each distinct piece is
encoded once, and a bounded table of known pieces answers the rest. New pieces
are encoded together: their symbols lie in one flat array; in each round the
lowest-ranked pair of every piece is merged at all its places. Ranks come from
binary search over the sorted pair keys, and only pairs next to a merge are
looked up again.

Defined results: a null or empty text has no ids. Strings of special tokens
inside texts become their ids, as the tokenizer file's library does by default.
Ids do not depend on batches or on the table. Pieces are told apart by 64-bit
hashes.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import common, flat

TOKENIZER = "byte_bpe_50k.json"
KNOWN = 1_000_000  # pieces a worker remembers at most
NONE = np.int64(1 << 62)


def vocabulary_path(name: str) -> str:
    """Where the public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Merges:
    """Sorted pair keys with ranks and merged ids, and the bytes of every id."""

    def __init__(self, name: str = TOKENIZER) -> None:
        with open(vocabulary_path(name), encoding="utf-8") as file:
            content = json.load(file)
        vocabulary = content["model"]["vocab"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in content["model"]["merges"]]
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.byte_ids = np.array([vocabulary[letter] for letter in letters], np.int64)
        keys = np.array([vocabulary[a] << 32 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocabulary[a + b] for a, b in pairs], np.int64)  # by rank
        self.special = {t["content"].encode(): t["id"] for t in content["added_tokens"]}
        spelled = {i: bytes(byte_of[c] for c in token) for token, i in vocabulary.items() if all(c in byte_of for c in token)}
        spelled |= {i: token for token, i in self.special.items()}
        self.tokens = [spelled.get(i, b"") for i in range(max(spelled) + 1)]
        self.token_lengths = np.array([len(t) for t in self.tokens], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(self.tokens), np.uint8)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids of each piece) of pieces, at least a byte each, that lie behind each other in ``data``."""
        symbols = self.byte_ids[data]
        piece = np.repeat(np.arange(len(lengths)), lengths)
        ranks = np.full(len(symbols), NONE)
        inner = np.flatnonzero(piece[:-1] == piece[1:])
        ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
        done_symbols, done_pieces = [], []
        while len(symbols):
            edge = np.flatnonzero(np.concatenate(([True], piece[1:] != piece[:-1])))
            sizes = np.diff(np.concatenate((edge, [len(piece)])))
            least = np.repeat(np.minimum.reduceat(ranks, edge), sizes)
            over = least == NONE
            if over.any():
                done_symbols.append(symbols[over])
                done_pieces.append(piece[over])
                on = ~over
                symbols, piece, ranks, least = symbols[on], piece[on], ranks[on], least[on]
                if not len(symbols):
                    break
            at = np.flatnonzero(ranks == least)
            # of neighbouring places of one pair (a a a) every second is taken, from the left
            fresh = np.concatenate(([True], at[1:] != at[:-1] + 1))
            run = np.flatnonzero(fresh)
            within = np.arange(len(at)) - np.repeat(run, np.diff(np.concatenate((run, [len(at)]))))
            at = at[within % 2 == 0]
            symbols[at] = self.merged[ranks[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            symbols, piece, ranks = symbols[keep], piece[keep], ranks[keep]
            for left in (place, place[place > 0] - 1):
                inside = left[left + 1 < len(symbols)]
                joined = piece[inside] == piece[inside + 1]
                ranks[left] = np.where(left + 1 < len(symbols), ranks[left], NONE)
                ranks[inside[~joined]] = NONE
                inside = inside[joined]
                ranks[inside] = self.rank(symbols[inside], symbols[inside + 1])
        if not done_symbols:
            return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
        pieces = np.concatenate(done_pieces)
        order = np.argsort(pieces, kind="stable")
        return np.concatenate(done_symbols)[order].astype(np.int32), np.bincount(pieces, minlength=len(lengths))

    def decode(self, ids: np.ndarray) -> str:
        spelled = self.token_bytes[flat.ranges(self.token_starts[ids], self.token_lengths[ids])]
        return spelled.tobytes().decode("utf-8", "replace")


class Encoder:
    """Texts to ids with a table of known pieces."""

    def __init__(self, name: str = TOKENIZER, known: int = KNOWN) -> None:
        self.merges = Merges(name)
        self.known = known
        self._forget()

    def _forget(self) -> None:
        self.numbers = flat.Numbering()
        self.starts = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def _learn(self, data: np.ndarray, hashes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> None:
        if self.numbers.size + len(hashes) > self.known:
            self._forget()
        ids, counts = self.merges.encode(data[flat.ranges(starts, lengths)], lengths)
        self.numbers.add(hashes)
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))
        self.counts = np.concatenate((self.counts, counts))
        self.ids = np.concatenate((self.ids, ids))

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of ids) of texts without special tokens."""
        if not len(data):
            return np.zeros(0, np.int32), np.zeros(len(offsets), np.int64)
        at, code = flat.characters(data)
        filled = offsets[:-1][offsets[1:] > offsets[:-1]]
        starts = at[flat.piece_starts(code, np.searchsorted(at, filled))]
        lengths = np.diff(np.concatenate((starts, [len(data)])))
        hashes = flat.word_hashes(data, starts, lengths)
        words = self.numbers.find(hashes)
        new = np.flatnonzero(words < 0)
        if len(new):
            unseen, first = np.unique(hashes[new], return_index=True)
            forgets = self.numbers.size + len(unseen) > self.known
            if forgets:  # the table starts anew with the pieces of this chunk
                unseen, first = np.unique(hashes, return_index=True)
                new = np.arange(len(hashes))
            self._learn(data, unseen, starts[new[first]], lengths[new[first]])
            words[new] = self.numbers.find(hashes[new])
        counts = self.counts[words]
        ids = self.ids[flat.ranges(self.starts[words], counts)]
        total = np.concatenate(([0], np.cumsum(counts)))
        return ids, total[np.searchsorted(starts, offsets)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets of ids) of texts."""
        whole = data.tobytes()
        if not any(token in whole for token in self.merges.special):
            return self.plain(data, offsets)
        parts, sizes = [], []
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            ids = self._around(whole[low:high])
            parts.append(ids)
            sizes.append(len(ids))
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))

    def _around(self, text: bytes) -> np.ndarray:
        """Ids of one text that may hold special tokens."""
        found, low = [], 0
        while True:
            places = [(text.find(token, low), token) for token in self.merges.special]
            at, token = min(((p, t) for p, t in places if p >= 0), default=(len(text), b""))
            part = np.frombuffer(text[low:at], np.uint8)
            found.append(self.plain(part, np.array([0, len(part)]))[0])
            if not token:
                return np.concatenate(found)
            found.append(np.array([self.merges.special[token]], np.int32))
            low = at + len(token)


_encoders: dict[str, Encoder] = {}


def encoder(name: str = TOKENIZER) -> Encoder:
    """The encoder of this worker; it lives on between tasks."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def encoded(name: str = TOKENIZER) -> Column:
    """A column function: text to its ids."""

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(name)
        for batch in batches:
            found = [own.encode(data, offsets) for data, offsets in flat.chunks(batch)]
            yield pa.concat_arrays([pa.ListArray.from_arrays(pa.array(o, pa.int32()), pa.array(i, pa.int32())) for i, o in found]) if found else pa.array([], pa.list_(pa.int32()))

    return ids


def round_trip(name: str = TOKENIZER) -> Column:
    """A column function: text to (number of ids, digest of ids, digest of the decoded text)."""
    kind = pa.struct([("n_tokens", pa.int64()), ("ids", pa.string()), ("decoded", pa.string())])

    @F.arrow_udf(T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("decoded", T.StringType())]))
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = encoder(name)
        for batch in batches:
            rows = []
            for data, offsets in flat.chunks(batch):
                ids, places = own.encode(data, offsets)
                for low, high in zip(places[:-1].tolist(), places[1:].tolist(), strict=True):
                    mine = ids[low:high]
                    text = own.merges.decode(mine)
                    rows.append(
                        {
                            "n_tokens": high - low,
                            "ids": hashlib.sha256(mine.astype("<u4").tobytes()).hexdigest(),
                            "decoded": hashlib.sha256(text.encode("utf-8")).hexdigest(),
                        }
                    )
            yield pa.array(rows, kind)

    return both


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    documents = common.table(spark, folder, "documents")
    return documents.select("doc_id", round_trip()(F.col("text")).alias("r")).select(
        "doc_id",
        F.col("r.n_tokens").alias("n_tokens"),
        F.col("r.ids").alias("ids_sha256"),
        F.col("r.decoded").alias("decoded_sha256"),
    )
