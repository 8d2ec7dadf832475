"""License scan against exact containment in every window."""

import json
import re
import struct

import xxhash

from tidemill.llm.licenses import CONTAINED, TABLE, TEMPLATES, scan, shingles, template_words

SCHEMA = "doc_id long, text string, words string, matches int"


def plain(text):
    """All windows, no anchors, no bands."""
    found = shingles(template_words(text or ""))
    out = {}
    for name, t in TEMPLATES.items():
        want = set(shingles(template_words(t)))
        size = len(template_words(t)) - 4
        stride = max(1, size // 2)
        best = max((len(want & set(found[s:s + size + stride - 1])) / len(want)
                    for s in range(0, len(found), stride)), default=0)
        if best >= CONTAINED:
            out[name] = round(best, 9)
    return out


def run(spark, rows):
    docs = spark.createDataFrame([(k, t, "w", 1) for k, t in enumerate(rows)], SCHEMA)
    return {r.doc_id: {m.license: round(m.containment, 9) for m in r.matches}
            for r in scan(docs.repartition(3)).collect()}


def test_planted_texts(spark):
    noise = "é the of and quick words that mean nothing at all " * 40
    rows = [None, "", "license", noise, *TEMPLATES.values()]
    for text in TEMPLATES.values():
        words = text.split()
        rows += [noise + text.upper() + noise, "\n* ".join(words),
                 noise + " ".join(words[:len(words) * 9 // 10]) + noise,
                 noise + " ".join(words[:len(words) // 2]),
                 " ".join(w + ("x" if k == len(words) // 2 else "") for k, w in enumerate(words)),
                 noise * 100 + text, (text + " " + noise) * 20]
    rows.append(" ".join(TEMPLATES.values()))
    rows.append(" ".join(TEMPLATES.values()))
    got = run(spark, rows)
    assert {k: plain(t) for k, t in enumerate(rows)} == got
    assert len(got[len(rows) - 1]) == len(TEMPLATES)


def test_table_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: {m.license: round(m.containment, 9) for m in r.matches}
           for r in scan(docs).collect()}
    rows = docs.select("doc_id", "text").collect()
    assert got == {r.doc_id: plain(r.text) for r in rows}
    assert sum(map(bool, got.values())) >= sum(
        bool(re.search("Released under the MIT License", r.text or "")) for r in rows) > 0
    assert run(spark, []) == {}


def test_whole_texts_and_notices_of_many_licenses(spark):
    table = {r["license"]: r["text"] for r in map(json.loads, open(TABLE, encoding="utf-8"))}
    assert len(table) > 60 and not set(table) & set(TEMPLATES)
    noise = "words that mean nothing at all " * 50
    names = sorted(table)
    rows = [f"{noise}{table[n]} {noise}".replace(" ", "\n") for n in names]
    whole = template_words(table["epl-2.0-notice"])
    rows += [" ".join(whole[:len(whole) // 2]), noise]
    got = run(spark, rows)
    assert all(got[k][n] == 1 for k, n in enumerate(names))
    assert got[len(names)] == got[len(names) + 1] == {}
    assert set(got[names.index("isc-text")]) == {"isc-text", "0bsd-text"}
    assert set(got[names.index("agpl-3.0-header")]) == {"agpl-3.0-header"}
    assert set(got[names.index("gpl-3.0-header")]) == {"gpl-3.0-header"}
    assert set(got[names.index("cc-by-sa-4.0-notice")]) == {"cc-by-sa-4.0-notice"}


def test_templates_given_as_a_table(spark):
    given = spark.createDataFrame([("own", "one two three four five six")],
                                  "license string, text string")
    docs = spark.createDataFrame([(1, "x one two three four five six y", "w", 1), (1, None, "w", 1),
                                  (None, "one two three four five", "w", 1)], SCHEMA)
    got = [(r.doc_id, [tuple(m) for m in r.matches]) for r in scan(docs, given).collect()]
    assert sorted(got, key=repr) == [(1, [("own", 1.0)]), (1, []), (None, [])]


def _signed(value):
    return value - 2 ** 64 if value >= 2 ** 63 else value


def _shingle_hash(part):
    seed = 42
    for word in part.split(" "):
        seed = xxhash.xxh64_intdigest(word.encode(), seed)
    return _signed(seed)


def _minima(parts, bands):
    hashes = [struct.pack("<q", _shingle_hash(p)) for p in parts]
    starts = [xxhash.xxh64_intdigest(struct.pack("<i", b), 42) for b in range(bands)]
    return [min(_signed(xxhash.xxh64_intdigest(h, s)) for h in hashes) for s in starts]


def banded(text, templates, bands):
    """Every window with its minima; only those with a common one are scored."""
    found = shingles(template_words(text or ""))
    out = {}
    for name, t in templates.items():
        want, size = set(shingles(template_words(t))), len(template_words(t)) - 4
        stride, sign = max(1, size // 2), _minima(want, bands)
        for start in range(0, len(found), stride):
            held = set(found[start:start + size + stride - 1])
            share = len(want & held) / len(want)
            if share >= CONTAINED and any(map(int.__eq__, sign, _minima(held, bands))):
                out[name] = max(out.get(name, 0), round(share, 9))
    return out


def test_minima_choose_the_windows(spark):
    text, other = (TEMPLATES[n] for n in ("mit", "bsd"))
    rows = [None, "", text, other, f"{text} {text} {other}"]
    for k in range(60):  # copies in other surroundings, with a word changed here and there
        words = f"{text} {other}".split()
        words[k % len(words)] = f"x{k}"
        words[(k * 7 + 30) % len(words)] = f"y{k}"
        rows.append(" ".join(f"z{k}{n}" for n in range(k)) + " " + " ".join(words))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3)
    given = {n: TEMPLATES[n] for n in ("mit", "bsd", "mit-notice")}
    missed = {}
    for bands in (1, 2, 24):
        got = {r.doc_id: {m.license: round(m.containment, 9) for m in r.matches}
               for r in scan(docs, given, bands=bands).collect()}
        assert got == {k: banded(t, given, bands) for k, t in enumerate(rows)}
        missed[bands] = sum(len(plain(t).keys() & given.keys() - got[k].keys())
                            for k, t in enumerate(rows))
    assert missed[1] > 0 == missed[24]


def test_templates_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(TEMPLATES.values())],
                                 "doc_id long, text string")
    whole = sorted(map(repr, scan(docs).collect()))
    monkeypatch.setattr("tidemill.llm.licenses.SENT_TEMPLATES", 30)
    monkeypatch.setattr("tidemill.llm.licenses.SENT_PARTS", 10)
    assert sorted(map(repr, scan(docs).collect())) == whole
