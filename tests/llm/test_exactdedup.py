"""Stateful exact dedup against a plain version, over several batches and restarts."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tidemill.llm import exactdedup
from tidemill.session import work_dir

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, digest int, stays string, _metadata int, file string, size long"


def written(spark, rows, files=1):
    path = f"{work_dir(spark, 'input')}/documents.parquet"
    spark.createDataFrame([(*r, 1, "s", 2, "f", 3) for r in rows], SCHEMA).repartition(
        files).write.parquet(path)
    return path


def plain(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(LOW), []).append(doc)
    out = []
    for doc, text in rows:
        norm = (text or "").translate(LOW)
        ids = groups[norm]
        keep = max((d for d in ids if d is not None), default=None)
        out.append((doc, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, path, **more):
    got = exactdedup.dedup(spark, path, **more).collect()
    kept = {}
    for r in got:
        kept[r.digest] = kept.get(r.digest, 0) + r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) <= {1}
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.digest) for r in got), key=repr)


ROWS = [(1, "Same É"), (2, "sAME É"), (3, "same é"), (4, None), (5, ""), (None, "same É"),
        (None, None), (None, "alone"), (7, "x" * 300_000), (8, "X" * 300_000), (9, " same É"),
        (9, "same É"), (9, "same É"), (10, "a\nb"), (11, "A\nB")] + [
            (k, "a third of all") for k in range(100, 160)]


@pytest.mark.parametrize("files, more", [(1, {}), (6, {}), (6, {"files_per_batch": 2}),
                                         (6, {"batch_bytes": 1})])
def test_equals_plain(spark, files, more):
    assert run(spark, written(spark, ROWS, files), **more) == plain(ROWS)


def test_empty_table(spark):
    assert run(spark, written(spark, [])) == []


def test_single_file_path(spark):
    path = "/root/testdata/sf0.001/documents.parquet"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(path).collect()]
    assert run(spark, path) == plain(rows)


def test_state_goes_on_over_restarts(spark):
    path, work = written(spark, ROWS[:9], 2), work_dir(spark, "state")
    exactdedup.digest_stream(spark, path, f"{work}/log", f"{work}/checkpoint")
    more = [(20, "SAME é"), (21, "new")]
    spark.createDataFrame([(*r, 1, "s", 2, "f", 3) for r in more], SCHEMA).coalesce(1).write.mode(
        "append").parquet(path)
    exactdedup.digest_stream(spark, path, f"{work}/log", f"{work}/checkpoint")
    got = {r.digest: (r.stays.doc_id, r["size"])
           for r in exactdedup.states(spark, f"{work}/log").collect()}
    want = {d: (keep, n) for _, keep, n, d in plain(ROWS[:9] + more)}
    assert got == want
    # the second batch holds only what it changed
    last = spark.read.parquet(f"{work}/log").where("batch = 1").count()
    assert last == 2


def test_a_durable_folder_streams_only_what_is_new(spark):
    path, work = written(spark, ROWS[:9], 2), work_dir(spark, "durable")
    assert run(spark, path, work=work) == plain(ROWS[:9])
    more = [(20, "SAME é"), (21, "new")]
    spark.createDataFrame([(*r, 1, "s", 2, "f", 3) for r in more], SCHEMA).coalesce(1).write.mode(
        "append").parquet(path)
    assert run(spark, path, work=work) == plain(ROWS[:9] + more)
    last = spark.read.parquet(f"{work}/log").where("batch = 1")
    # the known text was found in the state: its group counts the row of the first run
    assert sorted(r["size"] for r in last.collect()) == [1, 2]


def test_shared_digest_of_different_texts_is_split(spark, monkeypatch):
    monkeypatch.setattr(F, "sha2", lambda c, n: F.lit("one"))
    got = exactdedup.dedup(spark, written(spark, ROWS)).collect()
    monkeypatch.undo()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in got), key=repr) == sorted(
        (x[:3] for x in plain(ROWS)), key=repr)
