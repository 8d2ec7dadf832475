"""Packing against the tokenizer, an exact round trip, and best fit by hand."""

import struct
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemill.llm import packing

SCHEMA = "doc_id long, text string, bin int, item string, offset int, length int"
ODD = [None, "", " ", "  ", "a", "a ", " a", "a  b", "a   b", "x\n  y", "x \n y", "tab\t b",
       "don't  we'll 've", "é  ü  x", "<|endoftext|> and <|endoftext|>", "😀 😀",
       "one two " * 3000, "a" * 5000, "\n" * 3000, "x" + " " * 4000 + "y", "12 345 6789 !!",
       "\x1c \x85 a"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def check(rows, got, tokenizer, capacity=1024):
    want = defaultdict(list)
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc].append((k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    have = defaultdict(list)
    places = defaultdict(list)
    for r in got:
        have[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        places[r.sequence_id].append((r.offset, r.length))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(places), sum(r.length for r in got)


def test_odd_texts_and_rows(spark, tokenizer):
    rows = list(enumerate(ODD)) + [(4, "again"), (4, "again"), (None, "no id"), (None, "no id")]
    docs = spark.createDataFrame([(*r, 1, "i", 2, 3) for r in rows], SCHEMA)
    packed = packing.pack_documents(docs.repartition(3))
    got = packed.collect()
    check(rows, got, tokenizer)
    for r in got:  # the ids themselves
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


@pytest.mark.parametrize("task_items", [250_000, 150])
def test_table_is_packed_tightly(spark, tokenizer, monkeypatch, task_items):
    monkeypatch.setattr(packing, "TASK_ITEMS", task_items)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = packing.pack_documents(docs, with_ids=False).collect()
    used, tokens = check(rows, got, tokenizer)
    assert used <= (1.005 if task_items > 1000 else 1.04) * tokens / 1024 + 1


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA)).collect() == []


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.best_fit(np.array([6, 5, 4, 3, 2]), 10)
    assert fills.tolist() == [10, 10] and bins[0] == bins[2] != bins[1]
    assert offsets.tolist() == [0, 0, 6, 5, 8]
    assert packing.best_fit(np.zeros(0, np.int64), 10)[2].tolist() == []
