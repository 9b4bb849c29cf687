"""Counts and base scores against plain Python; the model's probabilities sum to one and beat the base."""

import math
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from kerbside.llm import maxent

FOLDER = "/root/testdata/sf0.001"


def plain_tokens(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


@pytest.fixture(scope="module")
def result(spark):
    return {r["doc_id"]: r for r in maxent.op5_maxent(spark, FOLDER).collect()}


@pytest.mark.parametrize("frequent", [None, 100])
def test_base_scores(spark, result, frequent):
    rows = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    counts = Counter(t for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 != 1 for t in plain_tokens(r["text"]))
    total, types = sum(counts.values()), len(counts)
    if frequent:
        docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
        training = docs.where(maxent.common.fold(5) != 1)
        vocabulary = maxent.counted(training)
        model = maxent.train(training, vocabulary, frequent=frequent, rounds=1)
        result = {r["doc_id"]: r for r in maxent.scores(docs, model, vocabulary).collect()}
    assert len(result) == len(rows)
    for r in rows:
        mine, found = plain_tokens(r["text"]), result[r["doc_id"]]
        assert found["n_tokens"] == len(mine)
        assert found["n_known"] == sum(counts[t] > 0 for t in mine)
        expected = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (types + 1))) for t in mine)
        assert found["base_score"] == pytest.approx(expected, rel=1e-9)
        if not frequent:
            assert found["train_tokens"] == total


def test_model_beats_the_base_on_held_out_texts(result):
    held = [r for r in result.values() if r["held_out"]]
    assert len(held) > 20
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_probabilities_sum_to_one(spark):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a c", "b a d", "a a", None, "b c e f g"])], "doc_id long, text string")
    vocabulary = maxent.counted(frame)
    model = maxent.train(frame, vocabulary)
    words = ["a", "b", "c", "d", "e", "f", "g"]
    assert {w: n for w, n in zip(words, [4, 3, 2, 1, 1, 1, 1], strict=True)}
    context = "b a"
    # the score of context + word, less the score of the context alone, over all words, one unseen word for each class, and the end
    texts = [f"{context} {w}" for w in words]
    found = maxent.tokens(*_flat([f"{t} x" for t in texts] + [context]))
    shares = np.exp(maxent.log_shares(model, maxent.features(found)))
    assert np.allclose(shares.sum(axis=1), 1.0, atol=1e-5)
    inside = Counter()
    own = maxent.tokens(*_flat(words))
    numbers = model.numbering().find(own.hashes)
    truth = maxent.classes_of(own, numbers)
    counts = {"a": 4, "b": 2 + 1, "c": 2, "d": 1, "e": 1, "f": 1, "g": 1}
    for w, at in zip(words, truth[own.endings != maxent.END_CLASS], strict=True):
        inside[at] += 1.0 if at < maxent.FIRST_ENDING else (counts[w] + 0.5) / 10 ** model.class_total[at]
    assert all(v <= 1.0 + 1e-9 for v in inside.values())


def _flat(texts):
    from kerbside.llm.minhash import _joined

    return _joined([t.encode() for t in texts])


def test_nulls_repeats_untrained_and_empty(spark):
    frame = spark.createDataFrame([(1, None, "w"), (1, None, "w"), (2, "x y", "w"), (None, "x", "w")], "doc_id long, text string, word string")
    for training in (frame, frame.limit(0)):
        vocabulary = maxent.counted(training)
        out = maxent.scores(frame, maxent.train(training, vocabulary, rounds=2), vocabulary).collect()
        assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in out) == [(0, 2), (1, 1), (1, 1), (2, 3)]
        assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in out)
    assert maxent.scores(frame.limit(0), maxent.train(frame, maxent.counted(frame), rounds=1), maxent.counted(frame)).collect() == []


def test_every_factor_is_trained_on_every_document(spark, monkeypatch):
    """A word of a shared class is learned from its context, and each round sums the counts of all documents."""
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}ing" for k in range(60)]
    texts = [f"say{k % 60} {words[k % 60]}" for k in range(1200)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocabulary = maxent.counted(frame)
    seen = []
    plain = maxent.updated

    def kept(weights, observed, expected):
        seen.append((observed.sum(dtype=float), expected.sum(dtype=float)))
        return plain(weights, observed, expected)

    monkeypatch.setattr(maxent, "updated", kept)
    model = maxent.train(frame, vocabulary, rounds=3)
    tokens = 3 * len(texts)
    inside = sum(t in words for text in texts for t in text.split()) + sum(t.startswith("say") for text in texts for t in text.split())
    assert len(seen) == 6
    for observed, expected in seen[0::2]:
        assert observed == pytest.approx(3 * tokens, rel=1e-5) and expected == pytest.approx(3 * tokens, rel=1e-4)
    for observed, expected in seen[1::2]:  # the word factor counts the words of shared classes alone
        assert 0 < observed <= 3 * inside and expected == pytest.approx(observed, rel=1e-4)
    # words of one ending and frequency: only the word before tells which one comes
    own = maxent.tokens(*_flat(words))
    numbers = model.numbering().find(own.hashes)
    at = [k for k, end in enumerate(own.endings) if end != maxent.END_CLASS and numbers[k] >= maxent.OWN and model.own[numbers[k]] >= 0]
    right = next(words[k // 2] for k in at if k % 2 == 0)
    k = words.index(right)
    other = next(words[x // 2] for x in at if words[x // 2] != right)
    pairs = spark.createDataFrame([(0, f"say{k} {right}"), (1, f"say{k} {other}")], "doc_id long, text string")
    found = {r["doc_id"]: r["score"] for r in maxent.scores(pairs, model, vocabulary).collect()}
    assert found[0] > found[1] + 0.3


@pytest.mark.parametrize("frequent", [1 << 18, 40])
def test_words_of_a_context_sum_to_one(spark, frequent):
    make = np.random.default_rng(3)
    words = [f"{a}{b}{c}" for a in "bcd" for b in "aeiou" for c in "nrst"] + ["Ünal", "é"]
    texts = [" ".join(make.choice(words[:-2], make.integers(3, 30))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    vocabulary = maxent.counted(frame)
    model = maxent.train(frame, vocabulary, rounds=2, frequent=frequent)
    before = "ban bar"
    rows = [(0, before), *((1 + k, f"{before} {w}") for k, w in enumerate(words[:-2]))]
    found = {r["doc_id"]: r["score"] for r in maxent.scores(spark.createDataFrame(rows, "doc_id long, text string"), model, vocabulary).collect()}
    # score(before w) = score of before without its end + log P(w) + log P(end | w); the ends are taken off with the model's class shares
    texts = [text for _, text in rows]
    tokens = maxent.tokens(*_flat(texts))
    ends = maxent.log_shares(model, maxent.features(tokens))[tokens.first[1:] - 1, maxent.END_CLASS] / math.log(10)
    start = found[0] - ends[0]
    known = sum(10 ** (found[1 + k] - ends[1 + k] - start) for k in range(len(words) - 2))
    # what is left: the end, and in every member the words never seen
    shares = np.exp(maxent.log_shares(model, maxent.features(tokens)))[tokens.first[1] - 1]
    context = [h[tokens.first[1] - 1 : tokens.first[1]] for h in maxent.contexts(tokens)]
    left = shares[maxent.END_CLASS] + sum(shares[1 + k] for k in range(min(maxent.OWN, len(model.hashes)), maxent.OWN))
    for at in range(maxent.FIRST_ENDING, maxent.CLASSES):
        inner = np.exp(maxent.log_member_shares(model, maxent.word_features(context, np.array([at]), model.buckets), np.array([at])))[0]
        unseen = 0.5 / 10 ** model.member_total[at - maxent.FIRST_ENDING]
        unseen[: maxent.OWN_WORDS] = np.where(model.member_types[at - maxent.FIRST_ENDING, : maxent.OWN_WORDS] > 0, 0.0, 1.0)
        left += shares[at] * (inner * unseen).sum()
    assert known + left == pytest.approx(1.0, abs=1e-4)


def test_a_round_sums_expected_counts_without_a_loop_over_features():
    """The sums equal plain ones for rare and frequent rows, in a number of calls that follows blocks of tokens, not rows."""
    make = np.random.default_rng(5)
    n, buckets, width = 3 * maxent.TOKENS_AT_ONCE, 512, maxent.MEMBERS
    rows = np.minimum(make.zipf(1.2, (n, maxent.FEATURES)) - 1, buckets - 1) + buckets * np.arange(maxent.FEATURES)
    weights = make.normal(0, 1, (maxent.FEATURES * buckets, width)).astype(np.float32)
    weights[0], weights[buckets], weights[2 * buckets] = (np.where(np.arange(width) % 2, maxent.LIMIT, -maxent.LIMIT) for _ in range(3))
    bias = np.log(make.dirichlet(np.ones(width), n)).astype(np.float32)
    logits = sum(weights[rows[:, k]].astype(float) for k in range(maxent.FEATURES)) + bias
    plain = np.exp(logits - logits.max(axis=1, keepdims=True))
    plain /= plain.sum(axis=1, keepdims=True)
    wanted = np.zeros(weights.shape)
    for k in range(maxent.FEATURES):
        np.add.at(wanted, rows[:, k], plain)
    shares = maxent._shares(np.exp(weights), rows, np.exp(bias))
    assert np.allclose(shares, plain, atol=1e-5)
    calls = 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    total = np.zeros(weights.shape, np.float32)
    sys.setprofile(count)
    try:
        maxent._spread(total, rows, shares)
    finally:
        sys.setprofile(None)
    assert np.allclose(total, wanted, rtol=1e-3, atol=1e-3)
    assert calls < 100


def test_rows_of_both_factors_follow_the_words(spark, monkeypatch):
    """No row of a table stands for more words at any size, and a table of another size is trained and read alike."""
    none = np.zeros(0, np.int64)
    for types in (1_000, 3_000_000, 50_000_000):
        inner = np.zeros((maxent.ENDINGS, maxent.MEMBERS))
        model = maxent.Model(none.view(np.uint64), none, 10, types, 1, np.zeros(maxent.CLASSES), np.zeros(maxent.CLASSES), none, inner, inner)
        for weights, most in ((model.weights, maxent.CLASS_TYPES_A_ROW), (model.word_weights, maxent.TYPES_A_ROW)):
            assert types <= most * len(weights) // maxent.FEATURES
    monkeypatch.setattr(maxent, "CLASS_TYPES_A_ROW", 1)
    monkeypatch.setattr(maxent, "BUCKETS", 4)
    words = [f"{a}{b}" for a in "bcdfghklmn" for b in ("ar", "et", "is", "on")]
    frame = spark.createDataFrame([(k, f"{words[k % 40]} {words[k * 7 % 40]} {words[k * 3 % 40]}") for k in range(400)], "doc_id long, text string")
    vocabulary = maxent.counted(frame)
    sums, plain = [], maxent.updated

    def kept(weights, observed, expected):
        sums.append((weights.shape, observed.sum(dtype=float), expected.sum(dtype=float)))
        return plain(weights, observed, expected)

    monkeypatch.setattr(maxent, "updated", kept)
    model = maxent.train(frame, vocabulary, rounds=2)
    assert model.class_buckets == 64 and (model.weights[-64:] != 0).any()
    for shape, observed, expected in sums[0::2]:
        assert shape == (3 * 64, maxent.CLASSES)
        assert observed == pytest.approx(3 * 1600, rel=1e-5) and expected == pytest.approx(3 * 1600, rel=1e-4)
    found = maxent.scores(frame, model, vocabulary).collect()
    assert sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    # score of a text: its classes by the table's own rows, and the same as before within a class
    one = maxent.tokens(*_flat(["bar"]))
    shares = np.exp(maxent.log_shares(model, maxent.features(one, model.class_buckets)))
    assert np.allclose(shares.sum(axis=1), 1.0, atol=1e-5)
