"""MinHash against plain shingle sets and a plain walk over documents."""

import hashlib
import random

import numpy as np
import pytest

from kerbside.llm import minhash


def plain_set(text):
    words = text.encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = plain_set(a), plain_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def prose(make, n):
    return " ".join(make.choice(["the", "of", "é", "word", "and\n", "x"]) + str(make.randrange(60)) for _ in range(n))


def test_shingles_are_the_plain_sets():
    make = random.Random(1)
    texts = ["", " ", "a", " a b ", "a b c d", "a b c d e", "a b c d e f", "\x1fa\x0bb"] + [prose(make, make.randrange(1, 40)) for _ in range(100)]
    hashes, counts = minhash.shingles(*minhash._joined([t.encode() for t in texts]))
    ends = np.cumsum(counts)
    found = {}
    for text, end, n in zip(texts, ends, counts, strict=True):
        words = text.encode().split()
        assert n == (max(1, len(words) - 4) if words else 0)
        for i, h in enumerate(hashes[end - n : end].tolist()):
            found.setdefault(tuple(words[i : i + 5]), set()).add(h)
    assert all(len(h) == 1 for h in found.values())
    assert len({next(iter(h)) for h in found.values()}) == len(found)


def test_likeness_estimates_jaccard():
    make = random.Random(2)
    errors = []
    for _ in range(60):
        a = prose(make, 200)
        words = a.split(" ")
        for at in range(make.randrange(1, 6)):
            words[make.randrange(len(words))] = f"new{at}"
        rows = minhash.signatures(*minhash._joined([a.encode(), " ".join(words).encode(), a.encode()]))
        assert (rows[0] == rows[2]).all()
        errors.append((rows[0] == rows[1]).mean() - jaccard(a, " ".join(words)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


@pytest.mark.parametrize("run", [1, 7, 500])
def test_walk_over_documents(spark, monkeypatch, run):
    monkeypatch.setattr(minhash, "RUN", run)
    make = random.Random(3)
    texts = {i * 7 % 1009: prose(make, make.randrange(0, 50)) for i in range(60)}
    texts[5000] = ""
    frame = spark.createDataFrame([(i, t or None, "r") for i, t in texts.items()], "doc_id long, text string, run string")
    out = {r["doc_id"]: r for r in minhash.neighbours(frame.repartition(5)).mapInArrow(minhash._compare, minhash.COMPARED).collect()}
    order = sorted(texts)
    assert sorted(out) == order
    for here, after in zip(order, [*order[1:], order[0]], strict=True):
        text, following, row = texts[here], texts[after], out[here]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        own, new, other = minhash.signatures(*minhash._joined([x.encode() for x in (text, changed, following)]))
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert row["fingerprint"] == minhash.written(own) and row["edited_fingerprint"] == minhash.written(new)
        assert row["near_edited"] == (own == new).mean() and row["near_next"] == (own == other).mean()


def test_null_ids_repeats_single_and_empty(spark):
    def run(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        return minhash.neighbours(frame).mapInArrow(minhash._compare, minhash.COMPARED).collect()

    assert len(run([(1, "a"), (1, "a"), (None, "b"), (None, None), (2, "c")])) == 5
    single = run([(1, "a b c d e f")])
    assert len(single) == 1 and single[0]["near_next"] == 1.0
    assert len(run([(None, "x")])) == 1
    assert run([]) == []


def test_near_duplicates_equal_brute_force(spark):
    make = random.Random(5)
    texts = [prose(make, 120) for _ in range(25)]
    for text in texts[:15]:
        words = text.split(" ")
        for _ in range(make.randrange(0, 6)):
            words[make.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [texts[0], "", "short one", "short one"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in minhash.near_duplicates(frame).collect()}
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if texts[a] == texts[b] or (plain_set(texts[a]) and jaccard(texts[a], texts[b]) >= 0.8):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    assert {i: out[i]["class_id"] for i in out} == dict(enumerate(label))
    for a in range(len(texts)):
        others = {t for t in texts if t != texts[a] and plain_set(t) and jaccard(t, texts[a]) >= 0.8}
        assert out[a]["n_links"] == len(others)


def groups(texts):
    """The least place reachable from each text by equality or similarity."""
    label = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if texts[a] == texts[b] or (plain_set(texts[a]) and plain_set(texts[b]) and jaccard(texts[a], texts[b]) >= 0.8):
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize(("width", "light"), [(7, 1 << 22), (1, 0)])
def test_classes_equal_brute_force(spark, monkeypatch, width, light):
    # Bands of one coordinate are shared by texts that are not alike, so the least of a band seldom is.
    monkeypatch.setattr(minhash, "WIDTH", width)
    monkeypatch.setattr(minhash, "LIGHT", light)
    make = random.Random(11)
    texts = [prose(make, 120) for _ in range(8)]
    for text in texts[:6]:
        for _ in range(5):
            words = text.split(" ")
            for _ in range(make.randrange(0, 5)):
                words[make.randrange(len(words))] = f"new{make.randrange(9)}"
            texts.append(" ".join(words))
    common_half = prose(make, 70)
    texts += [f"{common_half} {prose(make, 50)}" for _ in range(5)]
    texts += [texts[0], "", "", " ", "short one", "short one", None]
    frame = spark.createDataFrame([(i, t, "r", 1) for i, t in enumerate(texts)], "doc_id long, text string, copy string, class_id int")
    expected = groups([t or "" for t in texts])
    moved = {r["id"]: r["class_id"] for r in minhash.classes(frame).collect()}
    assert [moved.get(i, i) for i in range(len(texts))] == expected
    walked = minhash.neighbours(frame, marks=minhash.classes(frame)).mapInArrow(minhash._compare, minhash.COMPARED).collect()
    assert {r["doc_id"]: r["class_id"] for r in walked} == dict(enumerate(expected))
    assert len(set(expected)) < len(texts) - 20


def test_classes_without_ids_repeats_and_empty(spark):
    def run(rows):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        out = minhash.neighbours(frame, marks=minhash.classes(frame)).mapInArrow(minhash._compare, minhash.COMPARED).collect()
        return sorted((r["doc_id"] or -1, r["class_id"] or -1) for r in out)

    assert run([(1, "a"), (1, "a"), (1, "b"), (2, "b"), (None, "b"), (None, "c"), (3, "a")]) == [(-1, -1), (-1, 1), (1, 1), (1, 1), (1, 1), (2, 1), (3, 1)]
    assert run([]) == []


@pytest.mark.parametrize("many", [32, 2])
def test_texts_with_a_common_passage_cost_rows_not_pairs(spark, monkeypatch, many):
    monkeypatch.setattr(minhash, "MANY", many)
    make = random.Random(17)
    passage = prose(make, 170)
    texts = [f"{passage} {prose(make, 30)}" for _ in range(240)]
    for text in texts[:40]:  # near copies of some, apart from what most of a band is alike with
        for _ in range(2):
            words = text.split(" ")
            words[make.randrange(len(words))] = f"new{make.randrange(9)}"
            texts.append(" ".join(words))
    compared, plain = [], minhash._verified

    def counted(pairs, sketches, packed):
        compared.append(pairs.count())
        return plain(pairs, sketches, packed)

    monkeypatch.setattr(minhash, "_verified", counted)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    moved = {r["id"]: r["class_id"] for r in minhash.classes(frame).collect()}
    expected = groups(texts)
    assert [moved.get(i, i) for i in range(len(texts))] == expected
    assert 200 <= len(set(expected)) <= 240
    assert sum(compared) < 30 * len(texts)
