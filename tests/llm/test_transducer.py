"""Transducer counts against the tokenizers library; chunk maps against one state after the other."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from kerbside.llm import bpe, flat, transducer
from tests.llm.test_bpe import odd_texts


@pytest.mark.parametrize("states", [transducer.STATES, 2000])
def test_counts_equal_the_library(states):
    library = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    texts = [*odd_texts(), "a" * 3000, "ab" * 700 + " é" * 400]
    texts += pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()
    own, at = transducer.Counter(states=states), 0
    for data, offsets in flat.chunks(pa.array(texts, pa.string()), 20_000):
        for n in own.count(data, offsets).tolist():
            assert n == len(library.encode(texts[at], add_special_tokens=False).ids), repr(texts[at][:80])
            at += 1
    assert at == len(texts)


def test_chunk_maps_and_scan():
    make = np.random.default_rng(3)
    following, _ = transducer._tables()
    for size in (1, 255, 256, 257, 5000):
        symbols = make.choice(12, size, p=[0.1, 0.02, 0.4, 0.05, 0.1, 0.05, 0.05, 0.1, 0.03, 0.04, 0.04, 0.02]).astype(np.uint8)
        state, codes = transducer.START, []
        for symbol in symbols:
            state, code = transducer._after(state, int(symbol))
            codes.append(code)
        expected = [bool(c & transducer.HERE) for c in codes]
        for i, c in enumerate(codes[1:]):
            expected[i] |= bool(c & transducer.BEFORE)
        assert transducer.marks(symbols).tolist() == expected


def test_query_on_nulls_and_repeats(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "x " * 200_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    out = frame.select("doc_id", transducer.token_counts()("text").alias("n")).collect()
    assert [r["n"] for r in out][:4] == [0, 0, 2, 2]
    assert frame.limit(0).select(transducer.token_counts()("text")).collect() == []
