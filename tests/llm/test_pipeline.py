"""Each pipeline stage against a plain version of what it must do, on the smallest tables."""

import re

import numpy as np

import corpus_pipeline as pipeline
from tests.llm.test_linededup import plain as plain_lines
from tests.llm.test_simhash import all_pairs, plain_print
from tidemill.llm import packing

FOLDER = "/root/testdata/sf0.001"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def windows(text):
    words = WORD.findall((text or "").translate(LOW))
    return {tuple(words[k:k + 10]) for k in range(max(1, len(words) - 9))} if words else set()


def contaminated(text, tests):
    words = WORD.findall((text or "").translate(LOW))
    sizes = {len(w) for w in tests}
    return any(tuple(words[k:k + n]) in tests for n in sizes for k in range(len(words) - n + 1))


def through(spark, docs, tests):
    """(rows after each stage) for given documents."""
    out = []
    for _, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, FOLDER), "stage")
        out.append(docs)
    return out


def verify(spark, docs):
    tests = set().union(*(windows(r.text) for r in
                          spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()))
    stages = through(spark, docs, tests)
    for df in stages[:-1]:
        assert df.columns == docs.columns
    raw, known, lined, single, clean = (
        [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
        for df in (docs, *stages[:4]))
    gone = [t for d, t in raw if (d, t) not in set(known)]
    assert not any(t and len(WORD.findall(t)) > 30 for t in gone)
    assert sorted(lined, key=repr) == sorted(
        ((d, t) for d, _, _, t in plain_lines(known)), key=repr)
    labels = all_pairs([plain_print(t) for _, t in lined]) if lined else []
    first = {}
    for (d, _), label in zip(lined, labels):
        if d is not None:
            first[label] = min(d, first.get(label, d))
    assert sorted(single, key=repr) == sorted(
        ((d, t) for (d, t), label in zip(lined, labels)
         if d is None or d == first[label]), key=repr)
    assert sorted(clean, key=repr) == sorted(
        ((d, t) for d, t in single if not contaminated(t, tests)), key=repr)
    packed = stages[4].collect()
    encoder = packing.Encoder()
    got = {}
    for r in packed:
        got.setdefault(r.doc_id, []).append(r)
    for doc, text in clean:
        if sum(d == doc for d, _ in clean) == 1:
            ids = [*np.frombuffer(encoder.encode(text or ""), "<u4").tolist(), 2]
            own = sorted(got[doc], key=lambda r: r.piece)
            assert [x for r in own for x in r.ids] == ids
    return raw, known, clean, packed


def test_smallest_tables(spark):
    raw, known, clean, packed = verify(spark, spark.read.parquet(f"{FOLDER}/documents.parquet"))
    assert len(known) == len(raw) and len(clean) > 150


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    line = "a line that is held by very many documents, word for word"
    odd = [(None, "Of the and was this for that with from they", None), (10_001, None, "en"),
           (10_002, "", None), (10_003, "12 !!", "fr"), (10_004, "é", "fr"),
           *[(10_010 + k, f"{line}\nOf that {k} and this {k} were", "en") for k in range(6)]]
    rows = spark.createDataFrame([(d, t, lang, "s", 1) for d, t, lang in odd],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")
    extra = docs.limit(60).unionByName(rows)
    _, known, _, _ = verify(spark, extra)
    ids = {d for d, _ in known}
    assert not ids & {10_001, 10_002, 10_003} and 10_012 in ids


def test_even_mixtures_of_languages_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    parts = {}
    for r in docs.orderBy("doc_id").collect():
        if r.lang and len(WORD.findall(r.text or "")) >= 60:
            parts.setdefault(r.lang, " ".join(WORD.findall(r.text)[:40]))
    langs = sorted(parts)[:4]
    assert len(langs) == 4
    mixed = [(20_000_003, " ".join(parts[x] for x in langs[:3])),
             (20_000_004, " ".join(parts[x] for x in langs))]
    rows = spark.createDataFrame([(d, t, None, "s", len(t)) for d, t in mixed],
                                 "doc_id long, text string, lang string, source string, "
                                 "n_chars long")
    known = pipeline.language_id(spark, docs.unionByName(rows), FOLDER)
    assert {r.doc_id for r in known.where("doc_id > 20000000").collect()} == {
        20_000_003, 20_000_004}


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for df in through(spark, docs, set()):
        assert df.count() == 0


def test_run_gives_the_rows_of_the_stages(spark):
    got = pipeline.run(spark, FOLDER)
    assert got.count() == through(
        spark, spark.read.parquet(f"{FOLDER}/documents.parquet"), set())[-1].count()
