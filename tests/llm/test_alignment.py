"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from tokenizers import Tokenizer

from kerbside.llm import alignment, bpe

SCHEMA = "doc_id long, text string"


def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTES))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))


def plain(rows):
    """The result by loops over groups and links."""
    a, b = tokenizers()
    byte_of = {letter: byte for byte, letter in enumerate(bpe.byte_letters())}
    found, corpus = [], Counter()
    for key, text in rows:
        raw = b" " + (text or "").encode()
        left = a.encode(" " + (text or ""), add_special_tokens=False).ids
        right = b.encode(text or "")
        spelled_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in left]
        spelled_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in right)]
        groups = []
        if text and b"".join(spelled_a) == raw == b"".join(spelled_b):
            i = j = p = q = 0
            mine_a, mine_b = [], []
            while i < len(left) or j < len(right):
                if p <= q:
                    mine_a.append(left[i])
                    p += len(spelled_a[i])
                    i += 1
                else:
                    mine_b.append(right[j])
                    q += len(spelled_b[j])
                    j += 1
                if p == q:
                    groups.append((mine_a, mine_b))
                    mine_a, mine_b = [], []
        links = Counter((x, y) for xs, ys in groups for x in xs for y in ys)
        corpus.update(links.keys())
        found.append((key, groups, links))
    best = Counter()
    for (x, _), n in corpus.items():
        best[x] = max(best[x], n)
    out = []
    for key, groups, links in found:
        written = ";".join("|".join(",".join(map(str, ids)) for ids in group) for group in groups)
        out.append(
            (
                key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(links.values()),
                sum(n for (x, y), n in links.items() if corpus[x, y] == best[x]), sum(n * corpus[pair] for pair, n in links.items()),
                hashlib.sha256(written.encode()).hexdigest() if groups else "",
            )
        )
    return sorted(out, key=str)


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(spark, rows, schema=SCHEMA):
    return sorted(map(tuple, alignment.aligned(spark.createDataFrame(rows, schema)).select(NAMES).collect()), key=str)


def odd_rows():
    make = random.Random(9)
    texts = [None, "", " ", "  ", "a", " a", "a ", "a▁b", "▁", "<|endoftext|> x", "<s>a</s><unk>", "<0x41>", "\n\n\n", "a\tb\r\nc", "日本語のテキスト", "🙂🙂 🙂", "é" * 40, "\x00\x01", "x" * 3000, " " * 500 + "y", "ﬁ Ａ ①", "́á", "12345 67,8.90"]
    parts = ["the ", "of", " ", "  ", "\n", "é", "日", "ing", "Straße ", "🙂", "123", ".", "    ", "\t", " ", "don't "]
    texts += ["".join(make.choices(parts, k=make.randrange(1, 40))) for _ in range(120)]
    texts += pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:60]
    return [*enumerate(texts), (None, "the cat"), (5, "the cat"), (5, "the cat"), (5, None)]


def test_equals_plain_loops(spark):
    rows = odd_rows()
    expected = plain(rows)
    assert sum(row[3] > 0 for row in expected) > 150 and sum(row[3] == 0 for row in expected) > 4
    assert found(spark, rows) == expected


def test_many_blocks_give_the_same(spark):
    rows = odd_rows()
    expected = plain(rows)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert sorted(map(tuple, alignment.aligned(frame).select(NAMES).collect()), key=str) == expected


def test_blocks_end_at_their_bound(monkeypatch):
    import pyarrow as pa

    class Here:
        def partitionId(self):
            return 3

    monkeypatch.setattr(alignment.TaskContext, "get", staticmethod(Here))
    monkeypatch.setattr(alignment, "BLOCK_LINKS", 5)
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": ["a big word list here", "b", "the rest of the words", ""]})
    monkeypatch.setattr(alignment.flat, "CHUNK", 1)
    made = pa.Table.from_batches(alignment._blocks([batch, batch]))
    blocks = Counter(made.filter(pa.compute.is_valid(made["place"]))["block"].to_pylist())
    assert len(blocks) >= 3 and sum(blocks.values()) == 8 and min(blocks) == 3 << 32


@pytest.mark.parametrize("documents", [1, 8, 40, 5000])
def test_bitmaps_come_back(documents):
    make = np.random.default_rng(documents)
    groups = [np.sort(make.choice(documents, min(documents, n), replace=False)) for n in (1, 0, 3, documents, 2, documents // 2, 0, 5)]
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    data, offsets = alignment.containers(group, np.concatenate(groups), len(groups), documents)
    back, place = alignment.places(data, offsets)
    assert [sorted(place[back == g].tolist()) for g in range(len(groups))] == [g.tolist() for g in groups]
    assert offsets[-1] <= sum(min(1 + 2 * len(g), 1 + (documents + 7) // 8) for g in groups)


def test_planes_add_up():
    make = np.random.default_rng(2)
    pair, place = np.divmod(make.choice(30 * 200, 900, replace=False), 200)
    times = np.where(make.random(900) < 0.6, 1, make.integers(1, 3000, 900))
    pairs, documents, bits, planes = alignment.postings(place, pair, times, 200)
    assert pairs.tolist() == sorted(set(pair.tolist())) and documents.tolist() == [int((pair == p).sum()) for p in pairs]
    back = Counter()
    for p, own, levels in zip(pairs.tolist(), bits.to_pylist(), planes.to_pylist(), strict=True):
        for weight, data in [(1, own), *[(1 << k, x) for k, x in enumerate(levels or [])]]:
            _, at = alignment.places(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            for place_ in at.tolist():
                back[p, place_] += weight
    assert back == {(p, q): t for p, q, t in zip(pair.tolist(), place.tolist(), times.tolist(), strict=True)}


def test_wide_groups_are_counted_by_ids(monkeypatch):
    texts = ["x" * 400 + " " + "é" * 300, "日本語" * 50, "the cat"]
    wide = alignment.Groups(texts).links()
    monkeypatch.setattr(alignment, "WIDE", 0)
    assert all((x == y).all() for x, y in zip(wide, alignment.Groups(texts).links(), strict=True))


def test_empty_table_and_clashing_columns(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]
    frame = spark.createDataFrame([(1, "the cat"), (2, "the dog")], SCHEMA)
    clash = frame.selectExpr("*", *[f"'x' AS {name}" for name in ("block", "pair", "n", "best", "place", "n_a", "planes")])
    assert sorted(map(tuple, alignment.aligned(clash).select(NAMES).collect())) == plain([(1, "the cat"), (2, "the dog")])
