"""Token counts by a tokenizer compiled to finite-state transducers.

Two deterministic transducers in a row. The first reads classes of characters
and marks where pieces of the byte-level pattern start. Texts lie behind each
other and are cut into equal chunks; a chunk's map from entry state to exit
state is computed for all states at once, the maps are composed by a parallel
prefix scan, and with the entry states known every chunk writes its marks.

The second reads the bytes of a piece and counts its tokens. Its transitions
carry how the number of tokens of the text so far changes, which may be a
negative number when tokens merge. What it has to remember: at which earlier
positions a token may still start, that position's place in the vocabulary
trie, the token before it, and the tokens since. A token sequence is what BPE
makes exactly if each neighbouring pair is, so of the tokens that could end at
a byte exactly one fits the token before it. States and transitions are
compiled when first met and kept, up to a bound, by the worker, which also
remembers the counts of pieces it has read.

Defined results: a null or empty text has 0 tokens; special tokens inside texts
count as one, as the library has it by default.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.llm import bpe, common, flat

CHUNK_CHARACTERS = 256
MERGED_AFTER = 16
STATES = 200_000  # compiled states a worker keeps at most
KNOWN = 1_000_000  # pieces whose counts a worker remembers at most
LONG = 512  # pieces of more bytes take the scalar loop

BLANK, WHITE, MARK, STMD, R, V, ELL, E, LETTER, NUMBER, OTHER, STOP = range(12)
(START, IN_LETTERS, IN_NUMBERS, IN_OTHERS, ONE_BLANK, ONE_WHITE, MANY_BLANK, MANY_WHITE, AT_MARK, SHORT, MARK_R, MARK_V, MARK_L) = range(13)
NAMES = 13
HERE, BEFORE = 1, 2  # a piece starts at this character, at the one before


def _after(state: int, symbol: int) -> tuple[int, int]:
    """(next state, marks) of the piece transducer."""
    pending = state in (MARK_R, MARK_V, MARK_L)
    if symbol == STOP:
        return START, BEFORE if pending else 0
    letter = STMD <= symbol <= LETTER
    run = {MARK: AT_MARK, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, BLANK: ONE_BLANK, WHITE: ONE_WHITE}.get(symbol, IN_LETTERS)
    if pending:
        if symbol == (ELL if state == MARK_L else E):
            return SHORT, 0
        return (IN_LETTERS, BEFORE) if letter else (run, BEFORE | HERE)
    if state == AT_MARK:
        if letter:
            return {STMD: (SHORT, 0), R: (MARK_R, 0), V: (MARK_V, 0), ELL: (MARK_L, 0)}.get(symbol, (IN_LETTERS, HERE))
        return (IN_OTHERS, 0) if symbol in (MARK, OTHER) else (run, HERE)
    if state in (ONE_BLANK, ONE_WHITE, MANY_BLANK, MANY_WHITE):
        if symbol in (BLANK, WHITE):
            return (MANY_BLANK if symbol == BLANK else MANY_WHITE), 0
        earlier = BEFORE if state in (MANY_BLANK, MANY_WHITE) else 0
        if state in (ONE_BLANK, MANY_BLANK):  # the space leads what follows
            return (IN_OTHERS if symbol == MARK else run), earlier
        return run, earlier | HERE
    if state == IN_LETTERS and letter or state == IN_NUMBERS and symbol == NUMBER:
        return state, 0
    if state == IN_OTHERS and symbol in (MARK, OTHER):
        return state, 0
    return run, HERE


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Next states and marks, indexed by symbol * NAMES + state."""
    found = [_after(state, symbol) for symbol in range(12) for state in range(NAMES)]
    return np.array([x[0] for x in found], np.intp), np.array([x[1] for x in found], np.uint8)


@cache
def _symbols() -> np.ndarray:
    """The symbol of every code point."""
    out = np.array([LETTER, NUMBER, OTHER, WHITE], np.uint8)[flat.classes()]
    for letters, symbol in ((" ", BLANK), ("'", MARK), ("stmd", STMD), ("r", R), ("v", V), ("l", ELL), ("e", E)):
        out[[ord(c) for c in letters]] = symbol
    return out


def chunk_maps(chunks: np.ndarray) -> np.ndarray:
    """Exit state by entry state of each row of symbols."""
    following, _ = _tables()
    maps = np.tile(np.arange(NAMES), (len(chunks), 1))
    for at in range(min(MERGED_AFTER, chunks.shape[1])):
        maps = following[chunks[:, at, None].astype(np.intp) * NAMES + maps]
    same = (maps == maps[:, :1]).all(axis=1)
    one, rest = maps[same, 0], maps[~same]
    for at in range(MERGED_AFTER, chunks.shape[1]):
        column = chunks[:, at].astype(np.intp) * NAMES
        one = following[column[same] + one]
        rest = following[column[~same, None] + rest]
    maps[same] = one[:, None]
    maps[~same] = rest
    return maps


def scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive prefix composition: row i maps an entry state of row 0 to the exit state of row i."""
    out, step = maps.copy(), 1
    while step < len(out):
        out[step:] = np.take_along_axis(out[step:], out[:-step], axis=1)
        step *= 2
    return out


def marks(symbols: np.ndarray) -> np.ndarray:
    """A flag for every symbol that starts a piece, by chunk maps and a prefix scan."""
    n = len(symbols)
    width = CHUNK_CHARACTERS
    padded = np.full(-(-n // width) * width, STOP, np.uint8)
    padded[:n] = symbols
    chunks = padded.reshape(-1, width)
    exits = scan(chunk_maps(chunks))
    state = np.concatenate(([START], exits[:-1, START]))
    following, written = _tables()
    out = np.empty(chunks.shape, np.uint8)
    for at in range(width):
        key = chunks[:, at].astype(np.intp) * NAMES + state
        out[:, at] = written[key]
        state = following[key]
    codes = out.reshape(-1)
    starts = (codes[:n] & HERE).astype(bool)
    starts[: n - 1] |= (codes[1:n] & BEFORE).astype(bool)
    return starts


class PieceTransducer:
    """Counts the BPE tokens of pieces; compiled as far as pieces have led it."""

    def __init__(self, merges: bpe.Merges, states: int = STATES) -> None:
        self.limit = states
        tokens = merges.tokens
        special = set(merges.special.values())
        spelled = [i for i, t in enumerate(tokens) if t and i not in special]
        data = np.frombuffer(b"".join(tokens[i] for i in spelled), np.uint8)
        _, parts = merges.encode(data, np.array([len(tokens[i]) for i in spelled]))
        # tokens that BPE would spell otherwise never come up
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: list[bool] = [False]
        for token, n in zip(spelled, parts.tolist(), strict=True):
            if n == 1:
                node = 0
                for byte in tokens[token]:
                    self.inner[node] = True
                    key = node << 8 | byte
                    if key not in self.child:
                        self.child[key] = len(self.token)
                        self.token.append(-1)
                        self.inner.append(False)
                    node = self.child[key]
                self.token[node] = token
        made: dict[int, tuple[int, int, int]] = {}
        for key, rank in zip(merges.keys.tolist(), merges.ranks.tolist(), strict=True):
            made[int(merges.merged[rank])] = (rank, key >> 32, key & 0xFFFFFFFF)
        if any(max(made.get(a, (-1,))[0], made.get(b, (-1,))[0]) >= rank for rank, a, b in made.values()):
            raise ValueError("a merge comes before its parts")
        self.rank_of = dict(zip(merges.keys.tolist(), merges.ranks.tolist(), strict=True))
        self.made = made
        self.edges: dict[tuple[int, int], list[tuple[int, int]]] = {}
        self.fits: dict[int, bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.states: dict[tuple, int] = {}
        self.contents: list[tuple] = []
        self.numbers = flat.Numbering(16)
        self.next = np.zeros(1 << 16, np.int32)
        self.change = np.zeros(1 << 16, np.int32)
        self._state(((), -1))
        self.fits = {}

    def _state(self, content: tuple) -> int:
        found = self.states.get(content)
        if found is None:
            found = self.states[content] = len(self.contents)
            self.contents.append(content)
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols at one end of a token while it forms, each with the rank of the merge that takes it."""
        key = (token, side)
        if key not in self.edges:
            out, taken = [], 1 << 40
            while True:
                out.append((token, taken))
                if token not in self.made:
                    break
                taken, left, right = self.made[token]
                token = right if side else left
            self.edges[key] = out
        return self.edges[key]

    def _fits(self, left: int, right: int) -> bool:
        """Whether BPE leaves the two tokens side by side: no pair across the border merges before its parts are taken."""
        found, rank_of, others = True, self.rank_of, self._edge(right, 0)
        for a, a_taken in self._edge(left, 1):
            for b, b_taken in others:
                rank = rank_of.get(a << 32 | b)
                if rank is not None and rank < a_taken and rank <= b_taken:
                    found = False
        self.fits[left << 32 | right] = found
        return found

    def compile(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, change of the count) of one transition."""
        places, last = self.contents[state]
        child, tokens, inner, fits = self.child, self.token, self.inner, self.fits
        reached, change, ended = [], None, -1
        for node, before, since in (*places, (0, last, 0)):
            to = child.get(node << 8 | byte)
            if to is None:
                continue
            token = tokens[to]
            if token >= 0 and change is None:  # exactly one fits
                fit = before < 0 or fits.get(before << 32 | token)
                if fit is None:
                    fit = self._fits(before, token)
                if fit:
                    change, ended = 1 - since, token
            if inner[to]:
                reached.append((to, before, since))
        if change is None:
            raise ValueError("no token ends here")
        return self._state((tuple((to, before, since + change) for to, before, since in reached), ended)), change

    def step(self, states: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and changes of many transitions; those not met before are compiled."""
        keys = states.astype(np.uint64) << np.uint64(8) | data
        hashes = flat.mixed(keys + np.uint64(1))
        found = self.numbers.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unseen, first = np.unique(keys[new], return_index=True)
            made = [self.compile(int(key >> 8), int(key & 255)) for key in unseen.tolist()]
            low, high = self.numbers.size, self.numbers.size + len(made)
            if high > len(self.next):
                self.next = np.resize(self.next, 2 * high)
                self.change = np.resize(self.change, 2 * high)
            self.next[low:high] = [m[0] for m in made]
            self.change[low:high] = [m[1] for m in made]
            self.numbers.add(hashes[new[first]])
            found[new] = self.numbers.find(hashes[new])
        return self.next[found], self.change[found]

    def _long(self, piece: bytes) -> int:
        state, total, known = 0, 0, {}
        for byte in piece:
            key = state << 8 | byte
            if key not in known:
                known[key] = self.compile(state, byte)
            state, change = known[key]
            total += change
        return total

    def counts(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Tokens of each piece."""
        if len(self.contents) > self.limit:
            self._forget()
        out = np.zeros(len(starts), np.int64)
        order = np.argsort(-lengths, kind="stable")
        long = int(np.searchsorted(-lengths[order], -LONG, "left"))
        for at in order[:long].tolist():
            out[at] = self._long(data[starts[at] : starts[at] + lengths[at]].tobytes())
        order = order[long:]
        begin, sizes = starts[order], lengths[order]
        states, totals = np.zeros(len(order), np.int32), np.zeros(len(order), np.int64)
        alive = len(order)
        for at in range(int(sizes[0]) if alive else 0):
            alive = int(np.searchsorted(-sizes, -at, "left"))
            states[:alive], change = self.step(states[:alive], data[begin[:alive] + at])
            totals[:alive] += change
        out[order] = totals
        return out


class Counter:
    """Tokens of texts."""

    def __init__(self, name: str = bpe.TOKENIZER, states: int = STATES) -> None:
        merges = bpe.Merges(name)
        self.special = list(merges.special)
        self.pieces = PieceTransducer(merges, states)
        self._forget()

    def plain(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of texts without special tokens."""
        texts = len(offsets) - 1
        if not len(data):
            return np.zeros(texts, np.int64)
        at, code = flat.characters(data)
        cut = np.searchsorted(at, offsets)
        symbols = np.full(len(code) + texts, STOP, np.uint8)
        place = np.arange(len(code)) + np.repeat(np.arange(texts), np.diff(cut))
        symbols[place] = _symbols()[code]
        starts = at[marks(symbols)[place]]
        counts = self._counted(data, starts)
        total = np.concatenate(([0], np.cumsum(counts)))
        return np.diff(total[np.searchsorted(starts, offsets)])

    def _counted(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Tokens of each piece; the transducer reads those that are not remembered."""
        lengths = np.diff(np.concatenate((starts, [len(data)])))
        hashes = flat.word_hashes(data, starts, lengths)
        found = self.known.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unseen, first = np.unique(hashes[new], return_index=True)
            if self.known.size + len(unseen) > KNOWN:
                self._forget()
                unseen, first = np.unique(hashes, return_index=True)
                new = np.arange(len(hashes))
            counts = self.pieces.counts(data, starts[new[first]], lengths[new[first]])
            self.tokens = np.concatenate((self.tokens, counts.astype(np.int32)))
            self.known.add(unseen)
            found[new] = self.known.find(hashes[new])
        return self.tokens[found].astype(np.int64)

    def _forget(self) -> None:
        self.known = flat.Numbering()
        self.tokens = np.zeros(0, np.int32)

    def count(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        whole = data.tobytes()
        if not any(token in whole for token in self.special):
            return self.plain(data, offsets)
        out = []
        for low, high in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            parts, extra = [whole[low:high]], 0
            for token in self.special:
                split = [part.split(token) for part in parts]
                extra += sum(len(s) - 1 for s in split)
                parts = [part for s in split for part in s]
            joined = np.frombuffer(b"".join(parts), np.uint8)
            out.append(extra + int(self.plain(joined, np.cumsum([0, *map(len, parts)])).sum()))
        return np.array(out, np.int64)


_counters: dict[str, Counter] = {}


def token_counts(name: str = bpe.TOKENIZER):
    """A column function: text to its number of tokens."""

    @F.arrow_udf(T.LongType())
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        if name not in _counters:
            _counters[name] = Counter(name)
        for batch in batches:
            found = [_counters[name].count(data, offsets) for data, offsets in flat.chunks(batch)]
            yield pa.array(np.concatenate(found) if found else [], pa.int64())

    return count


def op9_tokens(spark: SparkSession, folder: str, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of every document, and which have more than 1024 tokens."""
    documents = common.table(spark, folder, "documents")
    counted = documents.select(
        "doc_id", F.octet_length(common.text_of()).cast("long").alias("n_bytes"), token_counts()(F.col("text")).alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
