"""Phrase collocations against brute force, also with fingerprints that collide, and against SQL."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from kerbside.llm import census, flat, phrases

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string"


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows, least, kept):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything in dictionaries."""
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    found = []
    for (lang, words), a in candidates.items():
        if any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a and any(longer[i : i + len(words)] == words for i in range(len(longer)))
            for (other, longer), b in candidates.items()
        ):
            continue
        cuts = []
        for k in range(1, len(words)):
            l, r = f[lang, words[:k]], f[lang, words[k:]]
            cuts.append((2_000_000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        found.append((lang, " ".join(words), a, l, r, n[lang], score))
    out = []
    for lang in n:
        mine = sorted((x for x in found if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:kept]
        out += [(lang, rank, *x[1:]) for rank, x in enumerate(mine, 1)]
    return sorted(out)


def odd_rows():
    make = random.Random(5)
    words = ["a", "B", "b", "É", "é", "x\x0by", "cc", "\x1c", "日本", "d'e", "zz-z", "and", "AND"]
    gaps = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", ";", "! ", "\x0c", "?"]
    rows = [(i, "".join(make.choice(words[: make.choice([3, 13])]) + make.choice(gaps) for _ in range(make.randrange(40))), make.choice(["en", "de", None, "und"])) for i in range(150)]
    rows += [(None, "one two three four one two three four " * 9, None), (7, None, "en"), (7, "", "fr"), (8, " .. ", "fr"), (9, "k " * 3000, "es"), (9, "k " * 3000, "es")]
    return rows


def found(frame, least, kept=2000):
    counts = phrases.phrase_counts(frame, F.xxhash64("doc_id", "text"), least)
    return sorted(tuple(row) for row in phrases.collocations(counts, kept).collect())


@pytest.mark.parametrize("least", [2, 5, 30])
def test_equals_brute_force(spark, least):
    rows = odd_rows()
    assert found(spark.createDataFrame(rows, SCHEMA), least) == plain(rows, least, 2000)


def test_ranks_are_cut_after_the_order(spark):
    rows = odd_rows()
    assert found(spark.createDataFrame(rows, SCHEMA), 3, 4) == plain(rows, 3, 4)


def test_many_blocks_give_the_same(spark, monkeypatch):
    rows = odd_rows()
    monkeypatch.setattr(census, "LEAST_BLOCK", 500)
    monkeypatch.setattr(census, "MOST_BLOCK", 500)
    monkeypatch.setattr(census, "RANGE", 300)
    assert found(spark.createDataFrame(rows, SCHEMA), 4) == plain(rows, 4, 2000)


def block_of(rows):
    return pa.table({"block": pa.array([3] * len(rows), pa.int64()), "text": [zstandard.compress((r[1] or "").encode()) for r in rows], "lang": pa.array([r[2] for r in rows], pa.string())})


@pytest.mark.parametrize("bits", [1, 4, 64])
def test_colliding_fingerprints_are_told_apart(bits, monkeypatch):
    """With fingerprints and word hashes of few bits, counts stay exact."""
    rows = odd_rows()
    grams, words = phrases.Words.fingerprints, flat.words

    def few(self, size):
        values, at = grams(self, size)
        return values >> np.uint64(64 - bits), at

    def few_words(data, offsets):
        starts, lengths, hashes, first = words(data, offsets)
        return starts, lengths, hashes >> np.uint64(64 - bits), first

    monkeypatch.setattr(phrases.Words, "fingerprints", few)
    monkeypatch.setattr(flat, "words", few_words)
    how = census.Plan(1, 20, 0)

    class Everything:
        def of(self, values):
            return np.ones(len(values), np.int64)

    assert phrases._listed(block_of(rows), how).num_rows == 1
    counted = Counter()
    for row in phrases._frequent(block_of(rows), Everything()).to_pylist():
        counted[row["lang"], len(row["phrase"].split(" ")) if row["phrase"] else 0, row["phrase"]] += row["f"]
    expected = Counter()
    for _, text, lang in rows:
        expected[lang or "und", 0, ""] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            own = re.findall(r"[^\x20\x09]+", piece)
            expected[lang or "und", 0, ""] += len(own)
            for size in range(1, 5):
                for i in range(len(own) - size + 1):
                    expected[lang or "und", size, " ".join(own[i : i + size])] += 1
    assert {k: n for k, n in counted.items() if n} == {k: n for k, n in expected.items() if n}


def test_census_returns_totals_to_every_block(spark):
    make = np.random.default_rng(4)
    how = census.Plan(blocks=5, bits=30, range_bits=3)
    blocks = {b: make.integers(0, 1 << 63, 400, np.uint64) for b in range(5)}
    shared = make.integers(0, 1 << 63, 50, np.uint64)
    blocks = {b: np.concatenate((own, shared[: 10 * b], shared[:3])) for b, own in blocks.items()}
    rows = pa.concat_tables([census.packed(own, b, how) for b, own in blocks.items()])
    by_range: dict = {}
    for k in sorted(set(rows.column("bucket").to_pylist())):
        part = rows.filter(pa.compute.equal(rows.column("bucket"), k))
        by_range[k] = census._summed(2)(part)
    back = pa.concat_tables(by_range.values())
    counts = Counter(int(x) >> 34 for own in blocks.values() for x in own)
    for b, own in blocks.items():
        known = census.Totals(back.filter(pa.compute.equal(back.column("block"), b)), how)
        assert known.of(own).tolist() == [n if (n := counts[int(x) >> 34]) >= 2 else 0 for x in own]


def test_packed_keys_come_back():
    keys = np.array([0, 1, 5, 1 << 40, (1 << 60) - 1], np.uint64)
    counts = np.array([1, 2, 3, 1 << 40, 7])
    back, numbers = census.unpack(census.pack(keys, counts))
    assert back.tolist() == keys.tolist() and numbers.tolist() == counts.tolist()
    assert [len(x) for x in census.unpack(census.pack(keys[:0], counts[:0]))] == [0, 0]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found(empty, 2) == []
    rows = [(i, "big red dog", "en") for i in range(40)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS block", "2 AS size", "3 AS f", "4 AS phrase", "5 AS key", "6 AS rank")
    assert found(frame, 30) == plain(rows, 30, 2000)


def test_query_equals_sql(spark):
    frame = phrases.op11_phrases(spark, FOLDER)
    database = duckdb.connect()
    database.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    result = database.execute(phrases.OP11_SQL)
    names = [x[0] for x in result.description]
    expected = sorted(tuple(dict(zip(names, row, strict=True))[c] for c in frame.columns) for row in result.fetchall())
    assert sorted(map(tuple, frame.collect())) == expected and expected
