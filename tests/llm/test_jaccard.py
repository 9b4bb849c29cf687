"""Jaccard join against all pairs."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from kerbside.llm import census, jaccard

SCHEMA = "doc_id long, text string"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def plain(rows):
    """(doc_id, size of the set, component) by comparing all pairs."""
    sets = []
    for _, text in rows:
        own = words(text)
        sets.append({tuple(own[i : i + 4]) for i in range(max(1, len(own) - 3))} if own else set())
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 85 * len(sets[a] | sets[b]):
                label[find(a)] = find(b)
    least = {}
    for at, (key, _) in enumerate(rows):
        known = least.get(find(at))
        least[find(at)] = key if known is None else known if key is None else min(key, known)
    return sorted(((key, len(sets[at]), least[find(at)]) for at, (key, _) in enumerate(rows)), key=str)


def found(spark, rows, schema=SCHEMA):
    return sorted(map(tuple, jaccard.components(spark.createDataFrame(rows, schema)).collect()), key=str)


def families():
    make = random.Random(21)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(30)]
    rows = []
    for _ in range(25):
        base = make.choices(vocabulary, k=make.choice([3, 4, 8, 25, 60, 150, 300]))
        for _ in range(make.randrange(3, 12)):
            text = list(base)
            for _ in range(make.randrange(0, 2 + len(text) // 60)):
                text[make.randrange(len(text))] = make.choice(vocabulary)
            base = text if make.random() < 0.5 else base  # chains drift away from where they began
            rows.append(" ".join(text))
    rows += [" ".join(make.choices(vocabulary, k=20) + passage) for _ in range(12)]
    rows += ["", None, " \n", "A", "a", "a a a a a", "a a a a a a a", "É b c d", "é b c d", "x\x0by z", "X Y  z\n", "one two three", "one two three four"]
    make.shuffle(rows)
    return [(i * 3, text) for i, text in enumerate(rows)]


def test_equals_all_pairs(spark):
    rows = families()
    rows += [(None, rows[0][1]), (rows[1][0], rows[1][1]), (rows[2][0], "another text with this id"), (None, "lonely text of a row without id")]
    assert found(spark, rows) == plain(rows)


def test_many_blocks_give_the_same(spark, monkeypatch):
    rows = families()
    monkeypatch.setattr(census, "LEAST_BLOCK", 2000)
    monkeypatch.setattr(census, "MOST_BLOCK", 2000)
    monkeypatch.setattr(census, "RANGE", 500)
    assert found(spark, rows) == plain(rows)


def test_large_group_of_near_copies_meets_in_few_pairs(spark, monkeypatch):
    """Near copies of one text, and texts that share only its frequent part: no link lost, few pairs verified."""
    make = random.Random(8)
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(300):
        text = list(base)
        text[make.randrange(200)] = f"x{make.randrange(200)}"
        rows.append((i, " ".join(text)))
    rows += [(400 + i, " ".join(base[:40] + [f"y{make.randrange(30)}" for _ in range(8)])) for i in range(40)]
    verified = []
    own = jaccard._verified

    def counting(pairs, sets):
        verified.append(pairs.count())
        return own(pairs, sets)

    monkeypatch.setattr(jaccard, "_verified", counting)
    assert found(spark, rows) == plain(rows)
    assert sum(verified) < 12 * 300  # all pairs: 44,850 in the first group alone


def test_prefix_length():
    for n in range(1, 500):
        assert jaccard.prefix_length(np.array([n]))[0] == n - -(-85 * n // 100) + 1


def test_filters_never_lose_a_link(spark):
    """Every pair above the similarity passes the filters at every shingle that both prefixes share."""
    rows = [r for r in families() if r[1]]
    texts = jaccard.prefixes(spark.createDataFrame(rows, SCHEMA)).collect()
    sets = {r.copy: set(r.shingles) for r in texts if r.gram is None and r.shingles is not None}
    prefix = {}
    for r in texts:
        if r.gram is not None:
            prefix.setdefault(r.copy, {})[r.gram] = r
    linked = 0
    for u in sets:
        for v in sets:
            shared = len(sets[u] & sets[v])
            if u < v and 100 * shared >= 85 * len(sets[u] | sets[v]):
                common = prefix[u].keys() & prefix[v].keys()
                assert common
                linked += 1
                need = -(-85 * (len(sets[u]) + len(sets[v])) // 185)
                for gram in common:
                    a, b = prefix[u][gram], prefix[v][gram]
                    assert min(a.pos, b.pos) + 1 + sum(map(min, a.rest, b.rest)) >= need
                    assert sum(a.rest) == a.n - a.pos - 1
                first = [g for g in common if not set(prefix[u][g].before) & set(prefix[v][g].before)]
                earliest = min(first, key=lambda g: prefix[u][g].pos)
                assert all(len(prefix[u][g].before) <= jaccard.BEFORE for g in common)
                a, b = prefix[u][earliest], prefix[v][earliest]
                assert min(a.n - a.pos, b.n - b.pos) >= need and 1 + sum(map(min, a.rest, b.rest)) >= need
    assert linked > 20


def test_sets_of_a_chunk():
    texts = [b"a b c d e a b c d", b"", b"a b c", b"b c d e", b"a b c d a b c d a b c d"]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    owner, hashes = jaccard.shingle_sets(data, offsets)
    assert np.bincount(owner, minlength=5).tolist() == [5, 0, 1, 1, 4]
    by_text = [set(hashes[owner == i].tolist()) for i in range(5)]
    assert by_text[0] & by_text[3] == by_text[3] and not by_text[2] & by_text[0] and len(by_text[0] & by_text[4]) == 1


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]
    frame = spark.createDataFrame([(5, "a b c d e"), (3, "A b c D e"), (4, "q")], SCHEMA)
    frame = frame.selectExpr("*", *[f"7 AS {name}" for name in ("copy", "n", "gram", "pos", "rest", "root", "block", "component_id", "u", "v", "key")])
    assert sorted(map(tuple, jaccard.components(frame).collect())) == [(3, 2, 3), (4, 1, 4), (5, 2, 3)]


def test_long_text(spark):
    text = " ".join(str(i) for i in range(60_000))
    rows = [(1, text), (2, text + " tail"), (3, text[: len(text) // 2])]
    assert found(spark, rows) == [(1, 59_997, 1), (2, 59_998, 1), (3, len(words(rows[2][1])) - 3, 3)]


@pytest.mark.parametrize("size", [0, 3])
def test_a_task_sends_each_text_once(size):
    batch = pa.RecordBatch.from_pydict({"text": ["a b", "A  b", None, "", "c"] * size})
    assert [b.num_rows for b in jaccard._distinct([batch, batch])] == ([2, 0] if size else [0, 0])
