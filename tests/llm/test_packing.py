"""Packing: valid, complete, close to the bound; ids against the library."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import pytest

from kerbside.llm import bpe, packing


def covered(configurations):
    total = Counter()
    for found, number in configurations:
        assert number > 0
        for length, times in found.items():
            total[length] += times * number
    return total


def plain_best_fit(items, limit):
    rooms = []
    for size in sorted(items, reverse=True):
        fits = [(room, at) for at, room in enumerate(rooms) if room >= size]
        if fits:
            rooms[min(fits)[1]] -= size
        else:
            rooms.append(limit - size)
    return len(rooms)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_is_exact_and_fits(histogram):
    found = packing.plan(histogram, 40, 60)
    assert covered(found) == Counter(histogram)
    assert all(sum(s * n for s, n in c.items()) <= 40 for c, _ in found)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 12), min_size=1, max_size=10))
def test_grouped_best_fit_equals_one_at_a_time(histogram):
    sizes = np.array(sorted(histogram))
    found = packing.best_fit(sizes, np.array([histogram[s] for s in sizes]), 40)
    items = [s for s, n in histogram.items() for _ in range(n)]
    assert sum(number for _, number in found) == plain_best_fit(items, 40)


def test_plan_is_near_the_bound():
    make = random.Random(1)
    items = [min(2048, int(make.lognormvariate(6, 1))) + 1 for _ in range(100_000)]
    histogram = Counter(min(x, 2048) for x in items)
    found = packing.plan(histogram)
    bound = sum(s * n for s, n in histogram.items()) / 2048
    assert sum(n for _, n in found) <= 1.001 * bound + 1


def test_most_sequences_come_from_the_program():
    make = random.Random(3)
    for number in (10_000, 100_000):
        histogram = Counter(min(2048, int(make.lognormvariate(6, 1)) + 1) for _ in range(number))
        sizes = np.array(sorted(histogram))
        counts = np.array([histogram[s] for s in sizes])
        used, left = packing.program(sizes, counts, 2048, packing.ROUNDS)
        taken = np.zeros_like(counts)
        for found, times in used:
            assert times > 0 and sum(int(sizes[at]) * n for at, n in found.items()) <= 2048
            for at, n in found.items():
                taken[at] += n * times
        assert (taken + left == counts).all() and (left >= 0).all()
        assert (left * sizes).sum() <= 0.02 * (counts * sizes).sum()
        assert (taken == 0).mean() <= 0.02
        bound = -(-int((sizes * counts).sum()) // 2048)
        assert sum(n for _, n in packing.plan(histogram)) <= bound + 1


def test_documents(spark):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    make = random.Random(2)
    texts = [None, "", "x", "word " * 5000, "a b " * 1023 + "c", "same text", "same text"] + ["w " * make.randrange(1, 900) for _ in range(150)]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    rows = packing.packed_documents(frame).collect()
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert sorted(by_document) == list(range(len(texts)))
    for at, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(by_document[at], key=lambda r: r["piece"])
        assert [r["piece"] for r in mine] == list(range(len(mine)))
        start = 0
        for k, r in enumerate(mine):
            assert r["start"] == start and (k == 0 or r["length"] == 2048)
            assert r["ids_crc32"] == zlib.crc32(ids[start : start + r["length"]].tobytes())
            start += r["length"]
        assert start == len(ids) and (len(mine) == 1) == (len(ids) <= 2048)
    for mine in by_sequence.values():
        end = 0
        for r in sorted(mine, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= 2048
    assert packing.packed_documents(frame.limit(0)).collect() == []


def test_sequences(spark):
    placed = spark.createDataFrame([(0, 2, [3]), (0, 0, [1, 2]), (1, 0, [9])], "sequence_id long, offset long, ids array<int>")
    assert {r["sequence_id"]: r["ids"] for r in packing.sequences(placed).collect()} == {0: [1, 2, 3], 1: [9]}


@pytest.mark.parametrize(
    ("histogram", "limit"),
    [
        ({501: 300, 251: 300, 249: 300, 252: 300, 248: 300}, 1000),
        ({size: 1000 for size in range(1, 65)}, 64),
        ({size: 7 + size % 5 for size in range(1, 129)}, 128),
        ({6: 10, 4: 10, 3: 20, 7: 5}, 10),
    ],
)
def test_never_worse_than_best_fit(histogram, limit):
    import numpy as np

    made = packing.plan(histogram, limit)
    covered: dict[int, int] = {}
    for found, number in made:
        assert sum(size * times for size, times in found.items()) <= limit
        for size, times in found.items():
            covered[size] = covered.get(size, 0) + times * number
    assert covered == histogram
    sizes = np.array(sorted(histogram))
    plain = packing.best_fit(sizes, np.array([histogram[int(s)] for s in sizes], np.int64), limit)
    assert sum(number for _, number in made) <= sum(number for _, number in plain)


@pytest.mark.parametrize(
    ("histogram", "limit"),
    [
        ({501: 300, 251: 300, 249: 300, 252: 300, 248: 300}, 1000),
        ({size: 1000 for size in range(1, 65)}, 64),
        (Counter(min(2048, int(random.Random(n).lognormvariate(6, 1)) + 1) for n in range(20_000)), 2048),
    ],
)
def test_gap_to_the_dual_bound(histogram, limit):
    sizes = np.array(sorted(histogram))
    counts = np.array([histogram[int(s)] for s in sizes], np.int64)
    used, bound = packing.fractional(sizes, counts, limit)
    assert bound >= (sizes * counts).sum() / limit - 1e-6
    cover = np.zeros(len(sizes))
    for key, amount in used.items():
        assert sum(int(sizes[at]) * n for at, n in key) <= limit and amount > 0
        for at, n in key:
            cover[at] += amount * n
    assert (cover >= counts * (1 - 1e-9)).all()
    made = packing.plan(histogram, limit)
    assert covered(made) == Counter(histogram)
    assert bound - 1e-6 <= packing.sequences_of(made) <= 1.01 * bound + 1


def fewest(items, limit):
    """By trying every place for every item."""
    best = len(items)

    def put(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(items):
            best = len(rooms)
            return
        for k in {room: k for k, room in enumerate(rooms) if room >= items[at]}.values():
            put(at + 1, [room - items[at] * (j == k) for j, room in enumerate(rooms)])
        put(at + 1, [*rooms, limit - items[at]])

    put(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_and_plan_against_all_packings(items):
    histogram = Counter(items)
    sizes = np.array(sorted(histogram))
    counts = np.array([histogram[int(s)] for s in sizes], np.int64)
    least = fewest(sorted(items, reverse=True), 20)
    assert packing.fractional(sizes, counts, 20, 40)[1] <= least + 1e-6
    assert least <= packing.sequences_of(packing.plan(histogram, 20, 40)) <= least + 1
