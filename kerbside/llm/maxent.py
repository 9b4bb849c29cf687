"""Language-model scores by a hashed maximum-entropy model.

P(word | context) = P(class | context) * P(member | class, context) * P(word | member).
The end of a text and the most frequent words are classes of their own; other
words share a class by their last two letters. Within such a class the
``OWN_WORDS`` most frequent words are members of their own, other words share a
member by their hash. Class and member are softmaxes over hashed features of the
context: the word before, the word before that (a skip feature), and both
together; those of the member are hashed together with the class. The rows of
both softmaxes follow the number of distinct words, without a bound. Within a shared member a word has its
smoothed frequency, and words never seen are one more word, so the probabilities
of all words sum to one.

Training is rounds of distributed gradient updates over all training documents:
in every round tasks sum the feature counts that the model expects, Spark adds
the sums by blocks of features, and the step divides the gradient (observed less
expected counts) by the larger of the two counts (a diagonal curvature).
Observed counts are the same in every round and are summed in the first.

Word counts are exact over all training texts and stay in Spark. Tasks know the
``FREQUENT`` most frequent words; other words of a text are joined with the
counts by Spark, and since frequent words are out of that join it has no hot key.

Defined results: a null or empty text has one token, its end. A null id is not
trained on. With nothing to train on, every class is as likely as any other.
Equal texts have equal scores. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import common, flat

FREQUENT = 1 << 18
OWN, ENDINGS = 31, 32
CLASSES = 1 + OWN + ENDINGS  # the end, frequent words, endings
END_CLASS, FIRST_ENDING = 0, 1 + OWN
FEATURES, BUCKETS = 3, 1 << 12  # rows of each feature of the class, at least
BLOCK = 1 << 15  # weights in a row of gradients
ROUNDS = 4
STEP, PRIOR = 1.5 / FEATURES, 4.0
# Members of a class of several words, and the distinct words for which a factor has one more row of each feature.
OWN_WORDS, SHARED = 24, 8
MEMBERS = OWN_WORDS + SHARED
CLASS_TYPES_A_ROW, TYPES_A_ROW, FEWEST = 1 << 9, 1 << 10, 1 << 10
LIMIT = 20.0  # of a weight, so that exponentials stay finite
TOKENS_AT_ONCE, SUMMED = 1 << 12, 1 << 18
BEFORE_TEXT = np.uint64(0x5851F42D4C957F2D)
END_HASH = np.uint64(0x14057B7EF767814F)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@dataclass
class Tokens:
    """Tokens of texts: words and, after each text's words, its end."""

    hashes: np.ndarray
    endings: np.ndarray  # class by ending; END_CLASS for ends
    first: np.ndarray  # where each text starts, and the number of tokens


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    lowered = LOWER[data]
    starts, lengths, hashes, first = flat.words(lowered, offsets)
    last = lowered[starts + lengths - 1].astype(np.uint64)
    before = np.where(lengths > 1, lowered[np.maximum(starts + lengths - 2, 0)], 0).astype(np.uint64)
    ending = FIRST_ENDING + (flat.mixed(last << np.uint64(8) | before) % np.uint64(ENDINGS)).astype(np.int64)
    places = np.arange(len(hashes)) + np.repeat(np.arange(len(first) - 1), np.diff(first))
    all_hashes = np.full(len(hashes) + len(first) - 1, END_HASH)
    all_endings = np.full(len(all_hashes), END_CLASS)
    all_hashes[places], all_endings[places] = hashes, ending
    return Tokens(all_hashes, all_endings, first + np.arange(len(first)))


def contexts(found: Tokens) -> list[np.ndarray]:
    """Hashes of the features of each token's context."""
    n = len(found.hashes)
    one, two = np.full(n, BEFORE_TEXT), np.full(n, BEFORE_TEXT)
    one[1:] = found.hashes[:-1]
    two[2:] = found.hashes[:-2]
    one[found.first[:-1]] = BEFORE_TEXT
    two[found.first[:-1]] = BEFORE_TEXT
    second = found.first[:-1][np.diff(found.first) > 1] + 1
    two[second] = BEFORE_TEXT
    return [flat.mixed(one), flat.mixed(two), flat.mixed(one * flat.MULTIPLIER + two)]


def _rows(hashes: list[np.ndarray], buckets: int) -> np.ndarray:
    bits = np.uint64(64 - buckets.bit_length() + 1)
    return np.stack([(h >> bits) + np.uint64(k * buckets) for k, h in enumerate(hashes)], axis=1).astype(np.int64)


def features(found: Tokens, buckets: int = BUCKETS) -> np.ndarray:
    """Rows of the weight table for each token, one for each feature."""
    return _rows(contexts(found), buckets)


def word_features(hashes: list[np.ndarray], classes: np.ndarray, buckets: int) -> np.ndarray:
    """Rows of the word factor's table for tokens of these contexts and classes."""
    of_class = classes.astype(np.uint64) * flat.MULTIPLIER
    return _rows([flat.mixed(h + of_class) for h in hashes], buckets)


def buckets_for(types: int, types_a_row: int, fewest: int) -> int:
    """Rows of one feature for so many distinct words: a power of two, so many that none stands for more than ``types_a_row``."""
    return max(fewest, 1 << (types // types_a_row).bit_length())


@dataclass
class Model:
    """What tasks need: FREQUENT words at most, and weights that grow with the distinct words, two to four bytes for each."""

    hashes: np.ndarray  # of frequent words, the most frequent first
    counts: np.ndarray
    n_tokens: int
    n_types: int
    ends: int
    class_counts: np.ndarray  # tokens of each class
    class_types: np.ndarray  # distinct words of each class
    own: np.ndarray  # the member of each frequent word that is one of its own, else -1
    member_counts: np.ndarray  # tokens of each member of each ending, and distinct words
    member_types: np.ndarray
    weights: np.ndarray | None = None
    word_weights: np.ndarray | None = None

    def __post_init__(self) -> None:
        if self.weights is None:
            self.weights = np.zeros((FEATURES * buckets_for(self.n_types, CLASS_TYPES_A_ROW, BUCKETS), CLASSES), np.float32)
        if self.word_weights is None:
            self.word_weights = np.zeros((FEATURES * buckets_for(self.n_types, TYPES_A_ROW, FEWEST), MEMBERS), np.float32)
        self.bias = np.log((self.class_counts + 1.0) / (self.class_counts.sum() + CLASSES)).astype(np.float32)
        whole = self.member_counts.sum(axis=1, keepdims=True)
        self.word_bias = np.log((self.member_counts + 1.0) / (whole + MEMBERS)).astype(np.float32)
        self.base_total = np.log10(self.n_tokens + 0.5 * (self.n_types + 1))
        self.class_total = np.log10(self.class_counts + 0.5 * (self.class_types + 1))
        self.member_total = np.log10(self.member_counts + 0.5 * (self.member_types + 1))

    @property
    def class_buckets(self) -> int:
        return len(self.weights) // FEATURES

    @property
    def buckets(self) -> int:
        return len(self.word_weights) // FEATURES

    def numbering(self) -> flat.Numbering:
        found = flat.Numbering()
        if len(self.hashes):
            found.add(self.hashes)
        return found


def _logits(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    table = np.take(weights, rows[:, 0], axis=0)
    for k in range(1, FEATURES):
        table += np.take(weights, rows[:, k], axis=0)
    table += bias
    return table


def _shares(powers: np.ndarray, rows: np.ndarray, bias: np.ndarray | None = None, times: np.ndarray | float = 1.0) -> np.ndarray:
    """The softmax of tokens with these features, as products of the exponentials of weights and bias, so many ``times``.

    ``powers`` holds those of the weights, ``bias`` of each token. Weights have a limit, so no product is too large,
    and that of the outcome with the largest bias is never too small.
    """
    table = np.take(powers, rows[:, 0], axis=0)
    factor = np.empty_like(table)
    for k in range(1, FEATURES):
        table *= np.take(powers, rows[:, k], axis=0, out=factor, mode="clip")
    if bias is not None:
        table *= bias
    table *= (times / np.einsum("ij->i", table)).astype(np.float32)[:, None]
    return table


def _log_share_of(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray, truth: np.ndarray) -> np.ndarray:
    """The natural logarithm of the share of one outcome of each token."""
    table = _logits(weights, rows, bias)
    own = table[np.arange(len(table)), truth]
    np.exp(table, out=table)
    return own - np.log(np.einsum("ij->i", table))


def log_shares(model: Model, rows: np.ndarray) -> np.ndarray:
    """Natural logarithms of the class probabilities of tokens with these features."""
    table = _logits(model.weights, rows, model.bias)
    return table - np.log(np.exp(table).sum(axis=1, keepdims=True))


def log_member_shares(model: Model, rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """The same of the members of these classes, all of several words."""
    table = _logits(model.word_weights, rows, model.word_bias[classes - FIRST_ENDING])
    return table - np.log(np.exp(table).sum(axis=1, keepdims=True))


def members_of(hashes: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The member of words; ``own``: -1, or that of a word that is one of its own."""
    return np.where(own >= 0, own, OWN_WORDS + (hashes >> np.uint64(40) & np.uint64(SHARED - 1)).astype(np.int64))


def classes_of(found: Tokens, numbers: np.ndarray) -> np.ndarray:
    """The class of each token, given its number among the frequent words."""
    return np.where((numbers >= 0) & (numbers < OWN), numbers + 1, found.endings)


def _parts(batches: Iterator[pa.RecordBatch], size: int = 8 << 20) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        low = 0
        for data, offsets in flat.chunks(batch.column("text"), size):
            yield batch.slice(low, len(offsets) - 1), data, offsets
            low += len(offsets) - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words, their ending and count, combined over as many texts as a worker holds."""
    held, size = [], 0

    def combined() -> pa.RecordBatch:
        hashes, endings = np.concatenate([h for h, _ in held]), np.concatenate([e for _, e in held])
        words, first, counts = np.unique(hashes, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(words.view(np.int64)), pa.array(endings[first]), pa.array(counts)], ["word", "ending", "n"]
        )

    for _, data, offsets in _parts(batches):
        found = tokens(data, offsets)
        held.append((found.hashes, found.endings))
        size += len(found.hashes)
        if size >= 1 << 21:
            yield combined()
            held, size = [], 0
    if held:
        yield combined()


def counted(training: DataFrame) -> DataFrame:
    """(word, ending, n): exact counts of the tokens of the training texts; the end is one of the words."""
    parts = training.select("text").mapInArrow(_count, "word long, ending long, n long")
    return common.stored(parts.groupBy("word").agg(F.max("ending").alias("ending"), F.sum("n").alias("n")), "vocabulary")


def _spread(total: np.ndarray, rows: np.ndarray, shares: np.ndarray) -> None:
    """Adds the shares of each token to the rows of ``total`` that its features name; two shares at a time, as one complex number."""
    width = shares.shape[1] // 2
    pairs, added = total.view(np.complex64).ravel(), shares.view(np.complex64).ravel()
    columns, places = np.arange(width), np.empty((len(rows), width), np.intp)
    for k in range(FEATURES):
        np.add((rows[:, k] * width)[:, None], columns, out=places)
        np.add.at(pairs, places.ravel(), added)


def _alike(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of one of each of the keys, by their order, and how many there are of it."""
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(keys)), bool), ordered[1:] != ordered[:-1])))
    return order[first], np.diff(first, append=len(keys))


def _expect(total: np.ndarray, powers: np.ndarray, rows: np.ndarray, times: np.ndarray, bias: np.ndarray | None = None, biased: np.ndarray | None = None) -> None:
    """Adds the expected counts of contexts found so many ``times``; the sums of ``SUMMED`` of them are short floats, so that none outgrows its digits."""
    for start in range(0, len(rows), SUMMED):
        sums = np.zeros(total.shape, np.float32)
        for low in range(start, min(start + SUMMED, len(rows)), TOKENS_AT_ONCE):
            part = slice(low, low + TOKENS_AT_ONCE)
            own = None if bias is None else np.take(bias, biased[part], axis=0)
            _spread(sums, rows[part], _shares(powers, rows[part], own, times[part]))
        total += sums


def _counted_rows(total: np.ndarray, rows: np.ndarray, truth: np.ndarray) -> None:
    size, buckets = total.shape[1], len(total) // FEATURES
    for k in range(FEATURES):
        part = total[k * buckets : (k + 1) * buckets]
        part += np.bincount((rows[:, k] - k * buckets) * size + truth, minlength=part.size).reshape(part.shape)


def _flat_sums(parts: list[np.ndarray]) -> np.ndarray:
    """The sums of both factors behind each other, filled to whole blocks."""
    sums = np.concatenate([part.ravel() for part in parts])
    return np.concatenate((sums, np.zeros(-len(sums) % BLOCK))).astype("<f4")


def _gradients(model, observing: bool):
    """A task: expected counts of its texts, a row for each block of features; when ``observing``, observed counts as further blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        named = np.union1d(np.arange(min(OWN, len(own.hashes))), np.flatnonzero(own.own >= 0))
        numbering = flat.Numbering(12)
        if len(named):
            numbering.add(own.hashes[named])
        member = np.concatenate((own.own[named], [-1]))  # the last stands for words without a number
        powers, word_powers, word_bias = np.exp(own.weights), np.exp(own.word_weights), np.exp(own.word_bias)
        powers[: own.class_buckets] *= np.exp(own.bias)  # every token has one row of them
        shapes = [own.weights.shape, own.word_weights.shape]
        expected, observed = ([np.zeros(shape) for shape in shapes] for _ in range(2))
        some = False
        for _, data, offsets in _parts(batches):
            some = True
            found = tokens(data, offsets)
            hashes, numbers = contexts(found), numbering.find(found.hashes)
            truth = classes_of(found, numbers)
            several = np.flatnonzero(truth >= FIRST_ENDING)
            if observing:
                _counted_rows(observed[0], _rows(hashes, own.class_buckets), truth)
                inner = word_features([h[several] for h in hashes], truth[several], own.buckets)
                _counted_rows(observed[1], inner, members_of(found.hashes[several], member[numbers[several]]))
            # tokens of one context expect the same; ordered, the rows of both words lie behind each other
            at, times = _alike(hashes[-1])
            _expect(expected[0], powers, _rows([h[at] for h in hashes], own.class_buckets), times)
            at, times = _alike(flat.mixed(hashes[-1][several] + truth[several].astype(np.uint64) * flat.MULTIPLIER))
            at = several[at]
            inner = word_features([h[at] for h in hashes], truth[at], own.buckets)
            _expect(expected[1], word_powers, inner, times, word_bias, truth[at] - FIRST_ENDING)
        if some:
            whole = np.concatenate([_flat_sums(expected)] + [_flat_sums(observed)] * observing).reshape(-1, BLOCK)
            blocks = np.flatnonzero(whole.any(axis=1))
            for at in np.array_split(blocks, -(-len(blocks) // 16)):
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array([whole[b].tobytes() for b in at], pa.binary())], ["block", "sums"])

    return run


def _added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the rows of one block."""
    total = np.zeros(BLOCK)
    for batch in batches:
        for sums in batch.column("sums"):
            total += np.frombuffer(sums.as_py(), "<f4")
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.astype("<f4").tobytes()], pa.binary())], ["block", "sums"])


def updated(weights: np.ndarray, observed: np.ndarray, expected: np.ndarray) -> np.ndarray:
    """Weights after a step along the gradient; a change is at most STEP."""
    stepped = weights + STEP * (observed - expected) / (np.maximum(observed, expected) + PRIOR)
    return np.clip(stepped, -LIMIT, LIMIT).astype(np.float32)


def _most_frequent(words: DataFrame, frequent: int) -> pa.Table:
    """At most ``frequent`` words, the most frequent first.

    A histogram of counts on a log scale tells from which count on there are no
    more than that, so no task orders the vocabulary.
    """
    level = F.floor(50 * F.log("n"))
    sizes = {r["level"]: r["words"] for r in words.groupBy(level.alias("level")).agg(F.count("*").alias("words")).collect()}
    total, least = 0, None
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > frequent:
            break
        least = at
    chosen = words.where(level >= least) if least is not None else words.limit(0)
    return chosen.select("word", "ending", "n").toArrow().sort_by([("n", "descending"), ("word", "ascending")])


def train(training: DataFrame, vocabulary: DataFrame, rounds: int = ROUNDS, frequent: int = FREQUENT) -> Model:
    """The model of the training texts with their counts."""
    spark = training.sparkSession
    context = spark.sparkContext
    end = int(END_HASH.view(np.int64))
    words = vocabulary.where(F.col("word") != end)
    top = _most_frequent(words, frequent)
    hashes = top["word"].to_numpy().view(np.uint64)
    counts, endings = top["n"].to_numpy(), top["ending"].to_numpy()
    class_counts, class_types = np.zeros(CLASSES), np.zeros(CLASSES)
    member_counts, member_types = np.zeros((ENDINGS, MEMBERS)), np.zeros((ENDINGS, MEMBERS))
    shared = F.shiftrightunsigned("word", 40).bitwiseAND(F.lit(SHARED - 1).cast("long")).alias("shared")
    for r in vocabulary.groupBy("ending", shared).agg(F.sum("n").alias("n"), F.count("*").alias("types")).collect():
        class_counts[r["ending"]] += r["n"]
        class_types[r["ending"]] += r["types"]
        if r["ending"] >= FIRST_ENDING:
            member_counts[r["ending"] - FIRST_ENDING, OWN_WORDS + r["shared"]] = r["n"]
            member_types[r["ending"] - FIRST_ENDING, OWN_WORDS + r["shared"]] = r["types"]
    n_tokens, n_types, ends = int(class_counts.sum()), int(class_types.sum()), int(class_counts[END_CLASS])
    groups = members_of(hashes, np.full(len(hashes), -1))
    own = np.full(len(hashes), -1)
    for k in range(min(OWN, len(hashes))):
        class_counts[1 + k], class_types[1 + k] = counts[k], 1
        class_counts[endings[k]] -= counts[k]
        class_types[endings[k]] -= 1
        member_counts[endings[k] - FIRST_ENDING, groups[k]] -= counts[k]
        member_types[endings[k] - FIRST_ENDING, groups[k]] -= 1
    for ending in range(ENDINGS):
        first = OWN + np.flatnonzero(endings[OWN:] == FIRST_ENDING + ending)[:OWN_WORDS]
        own[first] = np.arange(len(first))
        member_counts[ending, : len(first)] = counts[first]
        member_types[ending, : len(first)] = 1
        np.subtract.at(member_counts[ending], groups[first], counts[first])
        np.subtract.at(member_types[ending], groups[first], 1)
    model = Model(hashes, counts, n_tokens, n_types, ends, class_counts, class_types, own, member_counts, member_types)
    sizes = model.weights.size, model.word_weights.size
    blocks = -(-sum(sizes) // BLOCK)
    sums = np.zeros((2 * blocks, BLOCK), np.float32)  # expected, observed
    for at in range(rounds):
        shared = context.broadcast(model)
        # a gradient per task, so no more tasks than keep the cluster busy
        parts = training.select("text").coalesce(2 * context.defaultParallelism).mapInArrow(_gradients(shared, at == 0), "block int, sums binary")
        sums[:blocks] = 0
        for row in parts.groupBy("block").applyInArrow(_added, "block int, sums binary").toLocalIterator():
            sums[row["block"]] = np.frombuffer(row["sums"], "<f4")
        expected, observed = (part.ravel()[: sum(sizes)] for part in (sums[:blocks], sums[blocks:]))
        weights = [
            updated(old, seen.reshape(old.shape), due.reshape(old.shape))
            for old, seen, due in zip((model.weights, model.word_weights), np.split(observed, sizes[:1]), np.split(expected, sizes[:1]), strict=True)
        ]
        model = replace(model, weights=weights[0], word_weights=weights[1])
        shared.unpersist()
    return model


SUMS = pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())])
SCORED = "rid long, word long, sums struct<doc_id:long,n_tokens:long,n_known:long,base:double,score:double>"


def _score(model):
    """A task: for each text a row of sums over what the task knows, and a row for each other word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        numbering = own.numbering()
        counts = np.log10(np.concatenate((own.counts, [0])) + 0.5)  # the last stands for words not known here
        members = np.concatenate((own.own, [-1]))
        for batch, data, offsets in _parts(batches, flat.CHUNK):
            found = tokens(data, offsets)
            numbers = numbering.find(found.hashes)
            hashes, truth = contexts(found), classes_of(found, numbers)
            rows = _rows(hashes, own.class_buckets)
            shares = np.empty(len(rows))
            for low in range(0, len(rows), TOKENS_AT_ONCE):
                part = slice(low, low + TOKENS_AT_ONCE)
                shares[part] = _log_share_of(own.weights, rows[part], own.bias, truth[part])
            several = np.flatnonzero(truth >= FIRST_ENDING)
            classes = truth[several]
            member = members_of(found.hashes[several], members[numbers[several]])
            inner = word_features([h[several] for h in hashes], classes, own.buckets)
            for low in range(0, len(inner), TOKENS_AT_ONCE):
                part = slice(low, low + TOKENS_AT_ONCE)
                shares[several[part]] += _log_share_of(own.word_weights, inner[part], own.word_bias[classes[part] - FIRST_ENDING], member[part])
            end, frequent = truth == END_CLASS, numbers >= 0
            part = np.where(frequent, counts[numbers], 0.0)
            base = part + end * np.log10(own.ends + 0.5) - own.base_total
            score = shares / np.log(10.0)
            grouped = member >= OWN_WORDS
            inside = several[grouped]
            score[inside] += part[inside] - own.member_total[classes[grouped] - FIRST_ENDING, member[grouped]]
            starts = found.first[:-1]
            rids = batch.column("rid").to_numpy()
            known = frequent | (end & (own.ends > 0))
            sums = pa.StructArray.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(found.first)),
                    pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(score, starts)),
                ],
                fields=list(SUMS),
            )
            names = ["rid", "word", "sums"]
            # the word of a row of sums is no word; it only spreads the rows
            yield pa.RecordBatch.from_arrays([pa.array(rids), pa.array(flat.mixed(rids.astype(np.uint64)).view(np.int64)), sums], names)
            rare = np.flatnonzero(~frequent & ~end)
            text = np.searchsorted(found.first, rare, "right") - 1
            yield pa.RecordBatch.from_arrays([pa.array(rids[text]), pa.array(found.hashes[rare].view(np.int64)), pa.nulls(len(rare), SUMS)], names)

    return run


def scores(documents: DataFrame, model: Model, vocabulary: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of every row of the documents."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), common.text_of().alias("text"))
    parts = rows.mapInArrow(_score(shared), SCORED)
    joined = parts.join(vocabulary.select("word", "n"), ["word"], "left")
    rare = F.col("sums").isNull()
    seen = F.coalesce("n", F.lit(0))
    words = F.sum(F.when(rare, F.log10(seen + 0.5)).otherwise(0.0))
    summed = joined.groupBy("rid").agg(
        F.max("sums").alias("s"), words.alias("words"), F.sum((rare & (seen > 0)).cast("long")).alias("known")
    )
    return summed.select(
        F.col("s.doc_id").alias("doc_id"),
        F.col("s.n_tokens").alias("n_tokens"),
        (F.col("s.n_known") + F.col("known")).alias("n_known"),
        (F.col("s.base") + F.col("words")).alias("base_score"),
        (F.col("s.score") + F.col("words")).alias("score"),
    )


def op5_maxent(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of every document under a model of the documents outside fold 1 of 5."""
    documents = common.table(spark, folder, "documents")
    training = documents.where(common.fold(5) != 1)
    vocabulary = counted(training)
    model = train(training, vocabulary)
    found = scores(documents, model, vocabulary)
    return found.select(
        "doc_id",
        F.coalesce(common.fold(5) == 1, F.lit(True)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.n_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
