"""Messages against enumeration, words in switched text, and held-out accuracy."""

import itertools
import zlib

import numpy as np
import pytest

from tidemill.llm import langid
from tidemill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return langid.fit(langid.sample(docs))


def test_forward_backward_equals_enumeration(monkeypatch):
    monkeypatch.setattr(langid, "STEP", 4)
    rng = np.random.default_rng(3)
    lengths, k = [1, 7, 2, 5], 3
    n = sum(lengths)
    scores, moves, start = rng.normal(size=(n, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    first = np.zeros(n, bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    chain = langid.Chain(scores, first, moves, start)
    want, pairs, at = np.zeros((n, k)), np.zeros((k, k)), 0
    for length in lengths:
        own = scores[at:at + length]
        paths = list(itertools.product(range(k), repeat=length))
        weight = np.array([np.exp(start[p[0]] + sum(own[i, s] for i, s in enumerate(p))
                                  + sum(moves[a, b] for a, b in zip(p, p[1:]))) for p in paths])
        for p, w in zip(paths, weight / weight.sum()):
            for i, s in enumerate(p):
                want[at + i, s] += w
            for a, b in zip(p, p[1:]):
                pairs[a, b] += w
        at += length
    assert np.allclose(chain.posteriors(), want)
    assert np.allclose(chain.pair_counts(), pairs)


def test_held_out_accuracy_and_columns(spark):
    truth = {r.doc_id: r.lang for r in
             spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op4_language_id"](spark, FOLDER).collect()
    assert len(got) == len(truth)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.97


def test_held_out_rows_are_not_learned_from(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    begin = lambda t: t.encode()[:langid.SAMPLE_BYTES].decode("utf-8", "ignore")
    held = {(r.lang, begin(r.text or "")) for r in docs.collect()
            if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    rest = {(r.lang, begin(r.text or "")) for r in docs.collect()
            if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    rows = langid.sample(docs)
    assert 0 < len(rows) <= langid.SAMPLE_DOCS and set(rows) <= rest
    assert not set(rows) & (held - rest)
    assert langid.sample(docs) == rows


def test_words_of_switched_text(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    take = {lang: [" ".join(r.text.split()[:25]) for r in docs if r.lang == lang
                   and len(r.text) > 400 and r.text.replace("\n", " ").isprintable()
                   and not any(c in r.text for c in "!#%&$*=@")][:6] for lang in model.langs}
    rows, truth = [], []
    for k in range(6):
        own = [take[lang][k % len(take[lang])] for lang in model.langs]
        rows.append((k, " ".join(own)))
        truth.append([s for s, part in enumerate(own)
                      for _ in range(langid.words_of([part]).counts[0])])
    got = langid.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    right = total = 0
    for r in got:
        labels = [model.langs.index(s.lang) for s in r.segments for _ in range(s.words)]
        assert len(labels) == len(truth[r.doc_id])
        assert [s.first for s in r.segments] == [
            sum(x.words for x in r.segments[:i]) for i in range(len(r.segments))]
        right += sum(a == b for a, b in zip(labels, truth[r.doc_id]))
        total += len(labels)
    assert right / total > 0.9


def test_odd_texts(spark, model):
    long_text = "the of and this " * 300_000
    rows = [(1, None), (2, ""), (3, "12 -- !!"), (4, "…"), (5, "日本語"), (6, "é"), (7, "A"),
            (8, long_text), (None, "of the"), (9, "of the"), (9, "of the"), (10, "x" * 2_000_000)]
    docs = spark.createDataFrame([(*r, "l", 1.0, "s") for r in rows],
                                 "doc_id long, text string, lang_pred string, score double, "
                                 "segments string")
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 4)] == ["und"] * 4
    assert all(got[k].score == 0 for k in (1, 2, 3, 4))
    assert all(got[k].lang_pred in model.langs for k in (5, 6, 7, 8, 9, 10))
    assert got[8].lang_pred == "en" and got[8].score > 0.9
    whole = langid.Model.posteriors(model, langid.words_of(["of the and"] * 700))
    assert np.allclose(whole[:3], whole[-3:])


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "of the", None), (2, None, "en")],
                                 "doc_id long, text string, lang string")
    rows = langid.sample(docs)
    assert rows == []
    got = langid.predict(docs, langid.fit(rows)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * 2
    assert langid.predict(docs.limit(0), langid.fit(rows)).count() == 0


def test_every_language_is_learned_however_many_and_long(spark):
    rng = np.random.default_rng(1)
    names = [f"l{k:02d}" for k in range(70)]
    stems = {n: ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(12)]
             for n in names}
    rows = []
    for k in range(560):
        n = names[k % 70]
        size = 30 if n != "l69" else 9000  # all texts of one language pass the sample's bytes
        rows.append((k, " ".join(rng.choice(stems[n], size)), n))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taken = langid.sample(docs, most=300, text_bytes=2000)
    assert {lang for lang, _ in taken} == set(names) and len(taken) <= 300
    assert max(len(t) for _, t in taken) == 2000
    assert {lang for lang, _ in langid.sample(docs, most=10)} == set(names)
    model = langid.fit(taken)
    assert model.fewer == 1 and len(model.langs) == 70
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) / len(rows) > 0.9


def test_the_lexicon_tells_words_apart_that_share_both_ends():
    words = langid.words_of(["underwriting underwrxting underwriting a b a"])
    entry = langid.Features(words, 0, len(words.begin)).entry
    assert entry[0] == entry[2] != entry[1] and entry[3] == entry[5] != entry[4]
