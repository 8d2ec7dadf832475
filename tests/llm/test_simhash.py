"""Ball hashing against all pairs, fingerprints against a plain version."""

import re

import numpy as np
import pytest
import xxhash

from tidemill.llm import simhash
from tidemill.llm.components import connected_components

SCHEMA = "doc_id long, text string, fp string, component_id string, node int"


def plain_print(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << k for k in range(64)
               if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def all_pairs(prints):
    values = np.array(prints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    return simhash.local_components(len(values), *np.nonzero(np.triu(near, 1)))


def test_documents(spark):
    base = "the quick brown fox jumps over the lazy dog while many other animals look on " * 6
    rows = [(5, base), (3, base + "x"), (9, base.upper()), (4, None), (2, ""), (11, "\t \n"),
            (8, "one"), (8, "one"), (7, "One two three"), (None, base), (12, "é É " * 30),
            (13, "z " * 60_000)] + [(k, f"own words {k} of text {k * 7} here {k * 13}")
                                    for k in range(20, 60)]
    docs = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], SCHEMA)
    got = [(r.doc_id, r.fp & (2**64 - 1), r.component_id)
           for r in simhash.near_groups(docs.repartition(3)).collect()]
    prints = [plain_print(t) for _, t in rows]
    labels = all_pairs(prints)
    first = {}
    for (doc, _), label in zip(rows, labels):
        if doc is not None:
            first[label] = min(doc, first.get(label, doc))
    want = [(d, p, first[lab]) for (d, _), p, lab in zip(rows, prints, labels)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = simhash.keep_one(docs).select("doc_id").collect()
    assert sorted((r[0] for r in kept), key=repr) == sorted(
        (d for d, _, c in want if d is None or d == c), key=repr)


def test_an_id_on_two_texts_loses_only_the_repeated_one(spark):
    a, b = "one two three four five six seven " * 4, "other words of a wholly different text " * 5
    rows = [(5, a), (5, b), (3, b)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows],
                                 "doc_id long, text string, gone int, GONE_hash int")
    kept = simhash.keep_one(docs)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(3, b), (5, a)]
    assert kept.columns == docs.columns


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert simhash.near_groups(docs).collect() == []
    assert simhash.keep_one(docs).columns == docs.columns


@pytest.mark.parametrize("how", [{}, {"hot_prefix": 20}, {"hot_prefix": 3, "bits": 8}])
def test_dense_clusters(spark, how, monkeypatch):
    monkeypatch.setattr(simhash, "AT_ONCE", 20_000)  # also takes the in-task cuts
    rng = np.random.default_rng(5)
    prints = set()
    for center in rng.integers(0, 2**63, 12, dtype=np.uint64).tolist() + [0, 2**64 - 1]:
        for _ in range(60):
            value = center
            for bit in rng.integers(0, 64, rng.integers(0, 7)).tolist():
                value ^= 1 << bit
            prints.add(value)
    values = sorted(prints)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long"), **how)
    root = {r.node: r.component for r in connected_components(links).collect()}
    named = {}
    for v, label in zip(signed, all_pairs(values).tolist()):
        assert named.setdefault(label, root.get(v, v)) == root.get(v, v)
    assert len(set(named.values())) == len(named)


def test_components_of_stars_chains_and_loops(spark):
    edges = [(0, k) for k in range(1, 200)] + [(k, k + 1) for k in range(1000, 1100)]
    edges += [(2000, 2000), (5, 5), (7, 0), (None, 3), (3000, 3001), (3001, 3000)]
    got = {r.node: r.component for r in connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(200)}, **{k: 1000 for k in range(1000, 1101)},
                   3000: 3000, 3001: 3000}
