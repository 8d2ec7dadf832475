"""Jobs that run on: caches, publishing, marks, idle inputs, counters."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_streams import Feed, at
from tidemill.plans.streams import tumble
from tidemill.session import make_active, qualified
from tidemill.sources.marked import MarkedReader, MarkedSource
from tidemill.streaming.counters import LoadJob
from tidemill.streaming.idle import POLICY, merge_inputs
from tidemill.streaming.lookup import LookupCache, ParquetLookup, cached_lookup
from tidemill.streaming.published import Fenced, PublishedLog
from tidemill.streaming.runner import run_batches, run_to_files, run_until_quiet

NAME = T.StructType([T.StructField("name", T.StringType())])


def test_cache_is_bounded_and_forgets():
    now = [0.0]
    cache = LookupCache(2, 10, clock=lambda: now[0])
    cache.put("a", ("A",))
    cache.put("b", None)
    assert cache.get("a") == (True, ("A",)) and cache.get("b") == (True, None)
    cache.get("a")
    cache.put("c", ("C",))  # b is the least recently used
    assert cache.get("b") == (False, None) and cache.get("a")[0] and len(cache) == 2
    now[0] = 10.0
    assert cache.get("a") == (False, None) and cache.get("c") == (False, None) and len(cache) == 0
    with pytest.raises(ValueError):
        LookupCache(0, 1)


def test_lookup_counts_its_questions(spark, folder):
    """Arrow batches of two rows, room for two keys: which row asks is known exactly."""
    keys = [1, 2, 2, 3, 1, None, 9, 9, 9, 1]
    rows = spark.createDataFrame(list(enumerate(keys)), "i int, k int").coalesce(1).sortWithinPartitions("i")
    table = f"{folder}/t"
    spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "k int, name string").write.parquet(table)
    ask = ParquetLookup(qualified(spark, table), "k", ["name"])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        got = {r["i"]: (r["name"], r["hit"]) for r in cached_lookup(
            rows, "k", NAME, ask, max_rows=2, ttl_s=60, name=folder, hit="hit").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    names = {1: "one", 2: "two", 3: "three"}
    assert [got[i][0] for i in range(10)] == [names.get(k) for k in keys]
    # 1 2 | 2 3 (1 goes) | 1 (2 goes) null | 9 9 (3 goes; no row, remembered) | 9 1
    assert [got[i][1] for i in range(10)] == [
        False, False, True, False, False, None, False, True, True, True]


def test_lookup_refuses_taken_names_and_takes_empty_input(spark, folder):
    rows = spark.createDataFrame([], "k int, name string")
    with pytest.raises(ValueError):
        cached_lookup(rows, "k", NAME, dict, 2, 60, folder)
    assert cached_lookup(rows.drop("name"), "k", NAME, dict, 2, 60, folder).collect() == []


def test_crash_before_and_after_publishing(spark, folder):
    feed = Feed(spark, folder, "v int")
    feed.add([(1,), (2,)])
    feed.add([(3,)])
    root, checkpoint = f"{folder}/out", f"{folder}/c"

    def producer():
        log = PublishedLog(spark, root, checkpoint)
        log.begin()
        return log

    def values(log):
        return sorted(r["v"] for r in log.rows("v int").collect())

    def crash(log, publish):
        def handle(batch, batch_id):
            staged = log.stage(batch, batch_id)
            if publish:
                log.publish(staged)
            raise RuntimeError("crash")

        with pytest.raises(StreamingQueryException):
            run_batches(feed.stream(), handle, "p", checkpoint=checkpoint)

    old = producer()
    crash(old, publish=False)
    assert values(old) == [] and old.unpublished() == []  # its epoch may still publish
    crash(old, publish=True)
    assert values(old) == [1, 2]
    new = producer()
    run_batches(feed.stream(), new.process, "p", checkpoint=checkpoint)
    assert values(new) == [1, 2, 3]
    assert [(m["batch"], m["epoch"]) for m in new.manifests()] == [(0, 1), (1, 2)]
    assert [m["offsets"] for m in new.manifests()] == [[{"logOffset": 0}], [{"logOffset": 1}]]
    assert len(new.unpublished()) == 1
    with pytest.raises(Fenced):
        old.publish(old.manifest(0))
    # the race between check and move: equal offsets are done, others are refused
    assert new.publish(new.manifest(0)) is False
    with pytest.raises(Fenced):
        new.publish({**new.manifest(0), "offsets": [{"logOffset": 5}]})
    assert values(new) == [1, 2, 3]


def _marked(spark, folder, every):
    make_active(spark)
    spark.dataSource.register(MarkedSource)
    return (spark.readStream.format("tidemill_marked").schema("ts timestamp, n int")
            .option("mark_every", every).option("progress", qualified(spark, f"{folder}/p"))
            .load(qualified(spark, f"{folder}/log")))


def _append(spark, folder, name, rows):
    """One file with a chosen name, in row groups of four."""
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    path = qualified(spark, f"{folder}/log").removeprefix("file://")
    os.makedirs(path, exist_ok=True)
    table = pa.table({"ts": pa.array([t for t, _ in rows], pa.timestamp("us", "UTC")),
                      "n": pa.array([n for _, n in rows], pa.int32())})
    pq.write_table(table, f"{path}/{name}.parquet", row_group_size=4)


def test_marks_end_batches_over_files_and_restarts(spark, folder):
    _append(spark, folder, "a", [(at(i), i) for i in range(7)])
    _append(spark, folder, "b", [(at(i), i) for i in range(7, 9)])
    seen = {}

    def run(fail=None):
        def handle(batch, batch_id):
            if batch_id == fail:
                raise RuntimeError("crash")
            seen.setdefault(batch_id, []).append(sorted(r["n"] for r in batch.collect()))

        query = (_marked(spark, folder, 5).writeStream.foreachBatch(handle)
                 .option("checkpointLocation", f"{folder}/c").start())
        try:
            query.processAllAvailable()
        finally:
            query.stop()

    with pytest.raises(StreamingQueryException):
        run(fail=1)
    run()
    _append(spark, folder, "c", [(at(i), i) for i in range(9, 15)])
    run()
    run()
    assert seen == {0: [list(range(5))], 1: [[5, 6, 7, 8]], 2: [list(range(9, 14))], 3: [[14]]}


def test_watermark_moves_at_marks(spark, folder):
    """Spark's late filter takes the watermark of the mark before the last: 5 is in time, 8 late."""
    rows = [(at(0), 1), (at(200), 2), (at(10), 3), (at(400), 4), (at(15), 5), (at(600), 6),
            (at(700), 7), (at(20), 8), (at(720), 9)]
    _append(spark, folder, "a", rows)
    out = tumble(_marked(spark, folder, 3), "1 minute", [], [F.sum("n").alias("n")], "30 seconds")
    got = {r["window"]["start"]: r["n"] for r in run_until_quiet(
        out, "m", checkpoint=f"{folder}/c", out=f"{folder}/o").collect()}
    assert got == {at(0): 9, at(180): 2, at(360): 4, at(600): 6}


def test_marked_offsets(spark, folder):
    reader = MarkedReader(qualified(spark, f"{folder}/log"), ["n"], 5, qualified(spark, f"{folder}/p"))
    _append(spark, folder, "a", [(at(i), i) for i in range(7)])
    start, end = reader.initialOffset(), reader.latestOffset()
    splits = reader.partitions(start, end)
    assert [(s.group, s.start, s.stop) for s in splits] == [(0, 0, 4), (1, 0, 1)]
    got = [b.column(0).to_pylist() for s in splits for b in reader.read(s)]
    assert got == [[0, 1, 2, 3], [4]]
    again = MarkedReader(reader.uri, ["n"], 5, reader.progress)
    assert again.latestOffset()["row"] == 7 and again.latestOffset()["row"] == 7
    reader.commit(end)
    assert json.dumps(end)


def test_silent_input_holds_nothing_back(spark, folder):
    busy, quiet = (Feed(spark, f"{folder}/{n}", "ts timestamp, k string") for n in ("b", "q"))
    busy.add([(at(i), "b") for i in range(0, 300, 10)])
    quiet.add([(at(1), "q")])

    def run(idle, n):
        rows = merge_inputs([busy.stream(), quiet.stream()], "ts", idle, "30 seconds")
        out = rows.groupBy(F.window("ts", "1 minute"), "k").agg(F.count("*").alias("n"))
        return {(r["window"]["start"], r["k"]): r["n"] for r in run_to_files(
            out, "q", checkpoint=f"{folder}/c{n}", out=f"{folder}/o{n}", **POLICY).collect()}

    # newest 290, less 20 of silence and 30 of disorder: what ends by 240 is closed, beats are out
    assert run("20 seconds", 1) == {
        (at(60 * i), "b"): 6 for i in range(4)} | {(at(0), "q"): 1}
    # with an hour to wait the silent input stands at its only row
    assert run("1 hour", 2) == {}


def test_paused_load_resumes_at_its_batch(spark, folder):
    feed = Feed(spark, folder, "v int, bad boolean")
    for rows in ([(1, False)], [(2, True), (3, True)], [(4, False)], [(5, None), (6, False)]):
        feed.add(rows)
    loaded = []
    counts = {"n": F.count(F.lit(1)), "bad": F.count_if("bad")}

    def handle(batch, batch_id):
        rows = [r["v"] for r in batch.collect()]
        if batch_id == 3 and not broken:
            broken.append(True)
            raise RuntimeError("store is away")
        loaded.append((batch_id, sorted(rows)))

    broken = []
    job = LoadJob(spark, f"job-{folder[-8:]}", feed.stream(), counts, handle, f"{folder}/c",
                  pause_when=lambda c: c["bad"] > 1)
    assert job.run() == "PAUSED" and "batch 1" in job.reason
    assert loaded == [(0, [1]), (1, [2, 3])]
    assert job.run() == "PAUSED" and "store is away" in job.reason
    assert job.run() == "FINISHED"
    assert loaded == [(0, [1]), (1, [2, 3]), (2, [4]), (3, [5, 6])]
    assert [tuple(r) for r in job.report().orderBy("batch_id").collect()] == [
        (0, 1, 0), (1, 2, 2), (2, 1, 0), (3, 2, 0)]
    assert job.run() == "FINISHED" and len(loaded) == 4
