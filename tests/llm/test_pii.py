"""Personal data against Python's matcher and checksums."""

import hashlib
import re

import pytest

from tidemill.llm import pii

BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def right(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "phone":
        return 9 <= len(digits) <= 15
    return True


def base_spans(text):
    return [(kind, m.start(), m.end()) for kind, p in BASE.items()
            for m in p.finditer(text or "") if right(kind, m[0])]


HARD = [
    None, "", "no data", "a@b.c_d@e.f", "x@y", "é a.b@c.d.e. ü@x.y", "..@a.b,%@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000000001.2.3.004 1.2.3", "1.2.3.4" * 3,
    "4111 1111 1111 1111", "4111-1111-1111-1111 and 4111111111111112", "1  2 3-4--5",
    "+1 (212) 555-0100 x", "+1", "+1 2", "+12 345 678 90+12 345 678 90", "+4.......................",
    "call +1 (212) 555-0100, mail a@b.cd or 10.0.0.1", "😀 a@b.cd 😀 10.0.0.1",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, bad DE89370400440532013001",
    "ssn 123-45-6789; code 123-45-6789; SSN: 000-12-3456",
    "a" * 3000, "7" * 3000, "1 " * 3000, "+1" + " " * 3000, "9.9.9.9 " * 3000,
    "x@y.z " * 5000, ("4111 1111 1111 1111, " * 2000), "." * 3000 + "@", "1." * 3000,
]
#: No base span in these, and no long way to that answer.
LONG = ["a" * 3_000_000, "7" * 1_000_000, "1 " * 1_000_000, "+1" + " " * 1_000_000,
        "." * 2_000_000 + "@", "1." * 1_000 + "x", "+1" * 500_000]


@pytest.mark.parametrize("source", ["hard", "table"])
def test_base_spans_equal_python(spark, source):
    if source == "hard":
        docs = spark.createDataFrame([(k, t) for k, t in enumerate(HARD)], "doc_id long, text string")
    else:
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in pii.report(pii.find(docs)).collect()}
    assert got.keys() == texts.keys()
    for k, text in texts.items():
        want = base_spans(text)
        row = got[k]
        assert row.base_sha256 == hashlib.sha256(
            ",".join(f"{a}:{b}:{c}" for a, b, c in want).encode()).hexdigest(), (k, row.spans[:200])
        for kind in BASE:
            assert row[f"n_{kind}"] == sum(w[0] == kind for w in want)
        have = [s for s in row.spans.split(",") if s.split(":")[0] in BASE]
        assert have == [f"{a}:{b}:{c}" for a, b, c in want]


def test_very_long_runs_end_soon(spark):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(LONG)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(pii.find(docs)).collect()}
    assert [got[k] for k in (0, 1, 2, 3, 4, 6)] == [""] * 6
    assert got[5].startswith("ip:0:7,ip:8:15")


def test_added_kinds_need_checksum_or_context(spark):
    texts = [HARD[19], HARD[20]]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    cut = {k: [(s.kind, texts[k][s.start:s.stop]) for s in v] for k, v in spans.items()}
    assert [x for x in cut[0] if x[0] == "iban"] == [
        ("iban", "DE89 3704 0044 0532 0130 00"), ("iban", "GB82WEST12345698765432")]
    assert [x for x in cut[1] if x[0] == "ssn"] == [("ssn", "123-45-6789")] * 2
    scores = [s.score for s in spans[1] if s.kind == "ssn"]
    assert all(0.6 <= s <= 1 for s in scores)


def test_an_iban_ends_where_its_country_ends_it(spark):
    ibans = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT611904300234573201",
             "PL61 1090 1014 0000 0712 1981 2874", "NO93 8601 1117 947",
             "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432",
             "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "FR1420041010050500013M02606"]
    after = ["", " BIC CAIXESBBXXX", " EUR 500", " PLN", " CAIX ESBB", " A", " " + ibans[0], "."]
    texts = [f"to {i}{a}" for i in ibans for a in after] + [f"to {i}0" for i in ibans]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r.doc_id: [texts[r.doc_id][s.start:s.stop] for s in r.spans if s.kind == "iban"]
             for r in pii.find(docs).collect()}
    want = [[i] + ([ibans[0]] if ibans[0] in a else []) for i in ibans for a in after]
    assert [spans[k] for k in range(len(want))] == want
    assert not any(spans[k] for k in range(len(want), len(texts)))


def test_empty_table_clashing_columns_and_repeated_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, spans int, email int, start int")
    assert pii.report(pii.find(docs)).count() == 0
    rows = [(1, "a@b.cd", 1, 2, 3)] * 2 + [(None, "a@b.cd", None, None, None)]
    got = pii.report(pii.find(spark.createDataFrame(rows, docs.schema))).collect()
    assert [r.spans for r in got] == ["email:0:6"] * 3
