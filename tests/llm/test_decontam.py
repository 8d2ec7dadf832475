"""Suffix arrays against plain window search."""

import hashlib
import random
import re

import pytest

from tidemill.llm import decontam

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def plain(docs, items):
    windows = {}
    for name, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(name)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if own := windows.get(tuple(w[k:k + n])):
                    hit.update(range(k, k + n))
                    found |= own
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names),
                    hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def frames(spark, docs, items):
    return (spark.createDataFrame([(*r, 1, "s", "w") for r in docs],
                                  "doc_id long, text string, n_words int, items string, "
                                  "spans string").repartition(3),
            spark.createDataFrame([(*r, 5) for r in items], "item_id long, text string, doc_id int"))


def random_case(seed):
    rng = random.Random(seed)
    letters = ["a", "b", "É", "c9", "D"]
    text = lambda n: " ".join(rng.choice(letters) for _ in range(n))
    items = [(k, text(rng.choice([1, 3, 9, 10, 11, 14, 40]))) for k in range(1, 9)]
    docs = [(k, text(rng.choice([0, 2, 30, 400]))) for k in range(40)]
    for k in range(40, 60):
        name, passage = rng.choice(items)
        docs.append((k, f"x {text(5)}, {passage.upper()}! {text(3)}"))
    return docs, items


LONG = "It was a bright cold day in April, and the clocks were striking thirteen; nobody moved."
ODD = (
    [(1, LONG), (1, LONG), (2, None), (3, ""), (None, f"é {LONG}"), (4, "??"), (5, "short item"),
     (6, LONG.upper().replace(" ", "\n--")), (7, " ".join(LONG.split()[:9])),
     (8, " ".join(LONG.split()[2:12])), (9, f"{LONG} " * 3000), (10, "w " * 200_000 + LONG)],
    [(10, LONG), (9, LONG), (9, LONG), (None, LONG), (100, None), (101, ""), (102, "short item"),
     (103, "a bright cold day in april and the clocks were striking SEVEN")],
)


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 40])
@pytest.mark.parametrize("case", [ODD, random_case(1), random_case(2), (ODD[0], []), ([], ODD[1])])
def test_equals_plain(spark, monkeypatch, case, block_bytes):
    monkeypatch.setattr(decontam, "SHARD_WORDS", 5000)
    docs, items = frames(spark, *case)
    got = decontam.report(decontam.mark(docs, items, block_bytes=block_bytes)).collect()
    want = plain(*case)
    assert sorted(map(tuple, got), key=repr) == want
    clean = decontam.keep_clean(docs, items)
    assert clean.columns == docs.columns
    hit = {r[0] for r in want if r[5]}
    assert sorted((r.doc_id for r in clean.collect()), key=repr) == sorted(
        (r[0] for r in want if r[0] not in hit), key=repr)


def maximal(docs, items):
    """All maximal matches, place by place."""
    out = []
    for doc, text in docs:
        d = words(text)
        for name, item in items:
            w = words(item)
            for p in range(len(d)):
                for k in range(len(w)):
                    if d[p] != w[k] or p and k and d[p - 1] == w[k - 1]:
                        continue
                    n = 0
                    while p + n < len(d) and k + n < len(w) and d[p + n] == w[k + n]:
                        n += 1
                    if n >= min(10, len(w)):
                        out.append((doc, p, n, None if name is None else str(name), k))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [decontam.BLOCK_BYTES, 40])
@pytest.mark.parametrize("seed", [3, 4])
def test_matches_are_maximal_and_complete(spark, monkeypatch, seed, block_bytes):
    monkeypatch.setattr(decontam, "SHARD_WORDS", 500)
    monkeypatch.setattr(decontam, "_PAIRS_AT_ONCE", 3)
    docs, items = random_case(seed)
    items += [(None, items[0][1]), (77, items[5][1]), (78, "a b " * 12)]
    docs += [(99, "a b " * 30), (98, "b " + items[6][1])]
    marked = decontam.mark(*frames(spark, docs, items), block_bytes=block_bytes)
    got = [(r.doc_id, m.word, m.length, m.item, m.item_word)
           for r in marked.collect() for m in r.matches]
    assert sorted(got, key=repr) == maximal(docs, items)
    for r in marked.collect():
        hit = {p for m in r.matches for p in range(m.word, m.word + m.length)}
        assert hit == {p for s in r.spans for p in range(s.start, s.stop)}
        assert all(a.stop < b.start for a, b in zip(r.spans, r.spans[1:]))


def test_longest_matches(spark):
    w = words(LONG)
    docs = [(1, " ".join(w[2:14])), (2, "x y " + " ".join(w[1:15]) + " z"), (3, "nothing"),
            (4, " ".join(w[:9]))]
    marked = decontam.mark(*frames(spark, docs, [(1, LONG), (2, "no such words here at all")]))
    got = [tuple(r) for r in decontam.longest_matches(marked).collect()]
    assert got == [("1", 1, 14, 2, 2)]
