"""Line dedup against a plain version, with odd rows and very many lines."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tidemill.llm.linededup import dedup_lines, first_occurrences

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, h1 int, pos string, marked_ID int"


def plain(rows):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOW)

    holders = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5
                or doc == max(d for d in holders[key(x)] if d is not None)]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def run(spark, rows):
    docs = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], SCHEMA)
    got = dedup_lines(docs).select("doc_id", "__n_lines", "__n_dropped", "__kept").collect()
    return sorted(map(tuple, got), key=repr)


def test_small_cases(spark):
    common, other = "The Common Line that is Long Enough, é, to count", "y" * 39
    wide = "ÉÉ " + "z" * 40
    rows = [(k, f"head {k}\n  {common}\t\n{other}\ntail") for k in range(1, 7)]
    rows += [(3, common.upper().replace("É", "é")), (7, common + "\n" + common), (7, "own"),
             (None, common), (None, None), (8, None), (9, ""), (10, "\n\n"), (11, common + "\r"),
             (12, f"{common}\n" * 3), (12, f"{common}\n" * 3)]
    rows += [(k, wide) for k in range(20, 24)] + [(24, wide.lower()), (25, wide + "x" * 100_000)]
    assert run(spark, rows) == plain(rows)


def test_many_lines_and_far_bits(spark):
    shared = [f"a line that many documents hold, number {k:06d}" for k in range(0, 3000, 7)]
    own = [f"{k}" for k in range(3000)]
    rows = []
    for d in range(6):
        lines = own.copy()
        for k, line in enumerate(shared):
            lines[(k * 7 + d) % 3000] = line
        rows.append((d, "\n".join(lines)))
    assert run(spark, rows) == plain(rows)


def test_ranges_stay_sorted_and_are_read_as_they_are(spark):
    lines = spark.createDataFrame(
        [(k % 3, 0, k % 4, 0, 9 - k % 10) for k in range(60)],
        "h1 long, h2 long, doc_id long, text_hash long, pos int")
    firsts = first_occurrences(lines)
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    assert "Sort [h1" in plan and "Window" in plan
    want = {(h, d): min(9 - k % 10 for k in range(60) if (k % 3, k % 4) == (h, d))
            for h in range(3) for d in range(4)}
    assert {(r.h1, r.doc_id): r.pos for r in firsts.collect()} == want


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "a\nb", 5, "k")],
                                 "doc_id long, text string, __id int, __kept string")
    out = dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "__id", "__kept", "__n_lines", "__n_dropped",
                           "___kept"]
    assert tuple(out.first()) == (1, "a\nb", 5, "k", 2, 0, "a\nb")


def test_empty_table(spark):
    assert run(spark, []) == []


def test_digest_of_the_query(spark):
    from tidemill.llm.queries import QUERIES

    row = QUERIES["op6_line_dedup"](spark, "/root/testdata/sf0.001").where("n_dropped = 0").first()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where(
        F.col("doc_id") == row.doc_id).first().text
    assert row.kept_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
