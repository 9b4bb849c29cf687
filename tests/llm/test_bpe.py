"""Numpy BPE against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import regex
from tokenizers import Tokenizer

from kerbside.llm import bpe, flat

PATTERN = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))


def odd_texts():
    make = random.Random(2)
    yield from ["", " ", "  ", "\n", " \n a", "a  b", "a \n", "'s", "it's 'store 'll x''re 're", " 's", "\n's", "'", "a'", "'lle", "'r", "'v e", "a<|endoftext|>b", "<|endoftext|>", "<|endoftext|><|endoftext|> x<|endoftext", "aaaaaaaaaaaaaaaaaaaaaaaaa", "日本語 text ２３ ⅷ", " x  y", "　　z", "\x1c a\x85b", "é" * 50, "🙂🙂 🙂", "x" * 5000, " " * 3000 + "y", "́á", "ﬀ١٢"]
    pieces = ["'", "s", "t", "re", "ve", "ll", "d", " ", "  ", "\n", "\t", "1", "é", "日", "!", "<|", "the", " ", "🙂", "_"]
    for _ in range(1500):
        yield "".join(make.choices(pieces, k=make.randrange(1, 14)))


def arrays(texts):
    return list(flat.chunks(pa.array(texts, pa.string()), 5000))


def test_pieces_equal_the_pattern():
    for text in odd_texts():
        if not text:
            continue
        data = np.frombuffer(text.encode(), np.uint8)
        at, code = flat.characters(data)
        starts = flat.piece_starts(code, np.array([0]))
        cuts = [*np.flatnonzero(starts).tolist(), len(text)]
        assert [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] == PATTERN.findall(text), repr(text)


@pytest.mark.parametrize("known", [bpe.KNOWN, 300])
def test_ids_equal_the_library(library, known):
    texts = [*odd_texts()]
    texts += pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    own, at = bpe.Encoder(known=known), 0
    for data, offsets in arrays(texts):
        ids, places = own.encode(data, offsets)
        for low, high in zip(places[:-1], places[1:], strict=True):
            expected = library.encode(texts[at], add_special_tokens=False).ids
            assert ids[low:high].tolist() == expected, repr(texts[at][:80])
            assert own.merges.decode(ids[low:high]) == library.decode(expected, skip_special_tokens=False) == texts[at]
            at += 1
    assert at == len(texts)


def test_bytes_that_are_not_text_decode_as_the_library_does(library):
    own = bpe.Merges()
    make = random.Random(4)
    for _ in range(300):
        ids = [make.randrange(50257) for _ in range(make.randrange(6))]
        assert own.decode(np.array(ids, np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_query_on_nulls_and_repeats(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (3, "a b")], "doc_id long, text string")
    out = frame.select("doc_id", bpe.round_trip()("text").alias("r"), bpe.encoded()("text").alias("ids")).collect()
    assert [r["r"]["n_tokens"] for r in out] == [0, 0, 2, 2]
    assert out[2]["ids"] == out[3]["ids"] and len(out[2]["ids"]) == 2
    assert frame.limit(0).select(bpe.round_trip()("text")).collect() == []
