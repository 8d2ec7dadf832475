"""Token counts against the tokenizer library."""

import random

import public_tokenizers
import pytest
import sentencepiece

from tidemill.llm.tokencount import Counts, count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_random_texts_count_as_the_library_counts_them(library):
    counts, rng = Counts(MODEL), random.Random(11)
    signs = " " * 6 + "aeiount" * 4 + "ABCxyz0123456789.,;<>/s▁\n\t\r\x00é́漢字ﬁ①🙂　 "
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randint(0, 60)))
        assert counts.of(text) == len(library.encode(text)), text


def test_special_names_spaces_and_long_words(library):
    counts = Counts(MODEL)
    for text in ["", " ", "  \n ", "\n\n", "<s>", "a</s> b <unk>", "<0x0A>", "▁a▁▁b", "ab" * 50_000,
                 "x" * 99 + " " * 99, "é" * 7]:
        assert counts.of(text) == len(library.encode(text)), text[:20]
    assert counts.of(None) == 0


def test_remembered_chunks_stay_bounded(monkeypatch):
    from tidemill.llm import tokencount

    monkeypatch.setattr(tokencount, "CACHE", 10)
    counts = Counts(MODEL)
    for k in range(200):
        counts.of(f"word{k} " + "y" * 100)
    assert len(counts) <= 10 and all(len(c) <= tokencount.CACHED_CHARS for c in counts)


def test_rows_nulls_repeats_and_other_columns(spark, library):
    rows = [(1, "two words", 5, "a"), (None, None, 6, "b"), (2, "", 7, "c"), (2, "", 7, "c"),
            (3, "ü" * 5000, 8, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long, n_bytes string")
    out = count_tokens(docs)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    want = [(i, len((t or "").encode()), len(library.encode(t or "")),
             len(library.encode(t or "")) > 4096) for i, t, _, _ in rows]
    assert got == sorted(want, key=repr)
    assert any(r[3] for r in got) and not all(r[3] for r in got)


def test_empty_table(spark):
    assert count_tokens(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_the_limit_is_a_parameter(spark):
    docs = spark.createDataFrame([(1, "one two three")], "doc_id long, text string")
    n = count_tokens(docs).first()["n_tokens"]
    assert count_tokens(docs, limit=n - 1).first()["over_limit"]
    assert not count_tokens(docs, limit=n).first()["over_limit"]
