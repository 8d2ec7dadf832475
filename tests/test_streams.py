"""Streams over several micro-batches: late rows, restarts, state, replay."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from tidemill.operators.joining import interval_join
from tidemill.plans.streams import first_in_time, tumble
from tidemill.session import managed_database, qualified
from tidemill.streaming import state
from tidemill.streaming.enrich import async_enrich
from tidemill.streaming.follow import snapshot_then_follow
from tidemill.streaming.keyvalue import KeyValueSink, KeyValueWriter, PartWritten, live_values
from tidemill.streaming.runner import run_batches, run_to_files, stream_settings
from tidemill.streaming.timers import late_windows, stream_asof_join
from tidemill.streaming.sinks import (
    BatchLog, BudgetedLoad, LateSplitter, PartitionCommitter, UpsertLog, reloading_lookup,
)

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


class Feed:
    """A folder that grows by one file per call, read one file per batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.path, self.schema, self.n = spark, f"{folder}/in", schema, 0

    def add(self, rows):
        self.n += 1
        df = self.spark.createDataFrame(rows, self.schema).coalesce(1)
        df.write.parquet(f"{self.path}/f={self.n}")

    def stream(self):
        schema = self.spark.createDataFrame([], self.schema).schema
        return (self.spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
                .option("recursiveFileLookup", True).parquet(self.path))


def test_windows_over_batches_and_restart_equal_batch(spark, folder):
    feed = Feed(spark, folder, "ts timestamp, k string")
    rows = [(at(i * 7 % 300), "ab"[i % 2]) for i in range(100)]
    feed.add(rows[:50])
    end = [(at(100000), "end")]

    def run():
        out = tumble(feed.stream(), "1 minute", ["k"], [F.count("*").alias("n")], "10 minutes")
        return run_to_files(out, "w", checkpoint=f"{folder}/c", out=f"{folder}/o")

    run()
    feed.add(rows[50:])
    feed.add(end)
    got = {(r["window"]["start"], r["k"]): r["n"] for r in run().collect()}
    want = {}
    for ts, k in rows:
        key = (ts.replace(second=0), k)
        want[key] = want.get(key, 0) + 1
    assert got == want


def test_late_row_is_dropped_by_windows_and_kept_on_the_side(spark, folder):
    feed = Feed(spark, folder, "ts timestamp, k string")
    feed.add([(at(30), "A"), (at(31), "C")])
    feed.add([(at(40), "D")])
    feed.add([(at(6), "B")])  # Spark drops by the watermark known a batch earlier
    out = tumble(feed.stream(), "3 seconds", ["k"], [F.count("*").alias("n")], "2 seconds")
    keys = {r["k"] for r in run_to_files(out, "late").collect()}
    assert "B" not in keys and "A" in keys
    split = LateSplitter(spark, f"{folder}/split", "ts", "3 seconds", "2 seconds")
    run_batches(feed.stream(), split.process, "split", checkpoint=f"{folder}/sc")
    assert {(r["k"], bool(r["late"])) for r in split.rows().collect()} == {
        ("A", False), ("C", False), ("B", True), ("D", False)}


def test_left_interval_join_emits_null_after_the_watermark(spark, folder):
    orders = Feed(spark, f"{folder}/o", "ots timestamp, oid int")
    ships = Feed(spark, f"{folder}/s", "sts timestamp, sid int")

    def run():
        j = interval_join(
            orders.stream().withWatermark("ots", "30 seconds"),
            ships.stream().withWatermark("sts", "30 seconds"),
            [("oid", "sid")], "ots", "sts", 0, 3600, "left").select("oid", "sid")
        return run_to_files(j, "left", checkpoint=f"{folder}/c", out=f"{folder}/out")

    orders.add([(at(0), 1), (at(10), 2)])
    ships.add([(at(100), 1)])
    assert [tuple(r) for r in run().collect()] == [(1, 1)]
    orders.add([(at(90000), 8)])
    ships.add([(at(90000), 9)])
    run()
    orders.add([(at(90001), 8)])
    ships.add([(at(90001), 9)])
    assert set(map(tuple, run().collect())) >= {(1, 1), (2, None)}


def test_slow_input_holds_time_back_unless_policy_is_max(spark, folder):
    results = {}
    for policy in ("min", "max"):
        a = Feed(spark, f"{folder}/a{policy}", "ts timestamp, k string")
        b = Feed(spark, f"{folder}/b{policy}", "ts timestamp, k string")
        a.add([(at(i), "A") for i in range(0, 100, 10)])
        b.add([(at(9), "B")])
        both = a.stream().withWatermark("ts", "0 seconds").unionByName(
            b.stream().withWatermark("ts", "0 seconds"))
        out = both.groupBy(F.window("ts", "30 seconds")).agg(F.count("*").alias("n"))
        results[policy] = run_to_files(
            out, "idle", spark__sql__streaming__multipleWatermarkPolicy=policy).count()
    assert results == {"min": 0, "max": 3}


def test_deals_wait_for_their_price_across_batches(spark, folder):
    feed = Feed(spark, folder, "kind string, item long, seq long, x double")
    feed.add([("deal", 1, 10, 2.0), ("deal", 2, 11, 1.0), ("price", 3, 0, 5.0)])
    feed.add([("price", 1, 1, 20.0), ("deal", 3, 12, 4.0)])
    feed.add([("deal", 1, 13, 0.5)])

    def part(kind, name):
        return feed.stream().filter(F.col("kind") == kind).select(
            "item", "seq", F.col("x").alias(name))

    for salts in (1, 3):
        out = run_to_files(state.priced_deals(part("price", "price"), part("deal", "qty"), salts),
                           "deals", rocksdb=True)
        got = sorted((r["item"], r["deal_id"], r["qty"] * r["price"]) for r in out.collect())
        assert got == [(1, 10, 40.0), (1, 13, 10.0), (3, 12, 20.0)]


def test_header_goes_out_alone_and_releases_waiting_packages(spark, folder):
    feed = Feed(spark, folder, "kind string, code long, seq long, package long, info string")
    feed.add([("header", 1, 1, None, "h1"), ("package", 2, 2, 21, None)])
    feed.add([("package", 1, 3, 11, None), ("header", 2, 4, None, "h2")])
    headers = feed.stream().filter("kind = 'header'").select("code", "seq", "info")
    packages = feed.stream().filter("kind = 'package'").select("code", "seq", "package")
    out = run_to_files(state.header_packages(headers, packages), "hp", rocksdb=True)
    got = sorted((r["code"], r["package"] or 0, r["info"]) for r in out.collect())
    assert got == [(1, 0, "h1"), (1, 11, "h1"), (2, 21, "h2")]


def test_state_is_kept_or_forgotten(spark, folder):
    import time

    def totals(ttl, name):
        feed = Feed(spark, f"{folder}/{name}", "key long, id long, kind string")
        log = BatchLog(spark, f"{folder}/{name}/log")

        def run():
            run_batches(state.keyed_totals(feed.stream(), ttl), log.write, name, mode="update",
                        checkpoint=f"{folder}/{name}/c", rocksdb=True,
                        spark__sql__streaming__noDataMicroBatches__enabled="false")

        feed.add([(1, 1, "a"), (1, 2, "b")])
        run()
        time.sleep(1.5)
        feed.add([(1, 3, "a")])
        run()
        return [(r["first"], sorted(r.ids), r.n, r.kinds) for r in log.rows().orderBy(
            "batch_id").collect()]

    begin = (0, [1, 2], 2, "a=1,b=1")
    assert totals(None, "keep") == [begin, (2, [3], 3, "a=2,b=1")]
    assert totals(1000, "ttl") == [begin, (0, [3], 1, "a=1")]


def test_hot_keys_are_shared_by_salts(spark, folder):
    feed = Feed(spark, folder, "key long, id long, kind string")
    log = BatchLog(spark, f"{folder}/log")

    def run():
        run_batches(state.keyed_totals(feed.stream(), salts=3), log.write, "salts", mode="update",
                    checkpoint=f"{folder}/c", rocksdb=True)

    feed.add([(1, i, "a" if i % 2 else "b,=") for i in range(5000)] + [(2, 9, None)])
    run()
    feed.add([(1, i, "a") for i in range(5000, 5100)])
    run()
    parts = log.rows().cache()
    assert parts.filter("key = 1").select("salt").distinct().count() == 3
    assert all(len(r.ids) <= state.PART_IDS and len(r.last) <= state.LAST_IDS
               for r in parts.collect())
    ids = [i for r in parts.filter("key = 1").collect() for i in r.ids]
    assert sorted(ids) == list(range(5100))
    got = {r.key: (r.n, r.listed, r.id_total, r.kinds) for r in state.merged_totals(
        parts).collect()}
    assert got == {1: (5100, 5100, sum(range(5100)), "a=2600,b,==2500"), 2: (1, 1, 9, None)}


def test_packages_of_one_header_are_shared_by_salts(spark, folder):
    headers = Feed(spark, f"{folder}/h", "code long, seq long, info string")
    packages = Feed(spark, f"{folder}/p", "code long, seq long, package long")
    out = f"{folder}/out"

    def run():
        run_to_files(state.header_packages(headers.stream(), packages.stream(), 3), "hot",
                     checkpoint=f"{folder}/c", out=out, rocksdb=True)
        return sorted((r["code"], -1 if r["package"] is None else r["package"], r["info"])
                      for r in spark.read.parquet(out).collect())

    headers.add([(3, 0, "h3")])
    packages.add([(1, 0, k) for k in range(50)] * 2)
    assert run() == [(3, -1, "h3")]
    headers.add([(1, 0, "h1"), (1, 0, "again"), (2, 0, "h2")])
    packages.add([(1, 0, 50), (2, 0, 7)])
    both = [(1, k, "h1") for k in range(51)] + [(2, 7, "h2"), (3, -1, "h3")]
    assert run() == both
    packages.add([(3, 0, 5)])
    headers.add([(4, 0, "h4")])
    assert run() == sorted([*both, (3, 5, "h3"), (4, -1, "h4")])


def test_budget_pauses_and_resumes_from_the_checkpoint(spark, folder):
    feed = Feed(spark, folder, "id int")
    feed.add([(1,), (None,)])
    feed.add([(2,), (None,), (None,)])

    def run(limit):
        load = BudgetedLoad(spark, f"{folder}/load", F.col("id").isNull(), max_errors=limit)
        run_batches(feed.stream(), load.process, "b", checkpoint=f"{folder}/c")
        return load

    with pytest.raises(Exception, match="bad rows, limit 2"):
        run(2)
    load = run(3)
    assert sorted(r["id"] for r in load.rows().collect()) == [1, 2]
    assert load.report.rows().agg(F.max("filtered_so_far")).first()[0] == 3


def test_replayed_and_aborted_batches(spark, folder):
    log = BatchLog(spark, f"{folder}/log")
    df = spark.createDataFrame([(1,), (2,)], "v int")
    log.write(df, 0)
    log.write(df, 0)
    spark.createDataFrame([(9,)], "v int").write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        f"{folder}/log/batch_id=1")
    assert sorted(r["v"] for r in log.rows().collect()) == [1, 2]


def test_day_is_announced_by_a_later_batch_and_takes_late_rows(spark, folder):
    table = f"{managed_database(spark, 'pc')}.t"
    spark.sql(f"CREATE TABLE {table} (id INT, ts TIMESTAMP, dt STRING, batch_id INT) USING parquet "
              f"PARTITIONED BY (dt, batch_id) LOCATION '{folder}/data'")
    sink = PartitionCommitter(spark, table, f"{folder}/data", f"{folder}/log", "dt", "ts",
                              "30 SECOND", "24 HOUR")

    def deliver(n, *days):
        rows = [(i, dt.datetime(2024, 1, d, 12), f"2024-01-{d:02d}") for i, d in enumerate(days)]
        sink.process(spark.createDataFrame(rows, "id int, ts timestamp, dt string"), n)

    def ids():
        spark.catalog.refreshTable(table)
        return sorted((r["dt"], r["batch_id"]) for r in spark.table(table).collect())

    deliver(0, 1)
    assert sink.announced() == [] and ids() == []
    deliver(1, 2)
    assert sink.announced() == ["2024-01-01"] and ids() == [("2024-01-01", 0)]
    deliver(2, 1)
    deliver(2, 1)  # replay
    assert ids() == [("2024-01-01", 0), ("2024-01-01", 2)]


def test_upsert_log_compaction_keeps_the_table(spark, folder):
    log = UpsertLog(spark, folder, ["k"], seq=["s"], op="op")
    schema = "k int, v string, s int, op string"
    log.upsert(spark.createDataFrame([(1, "a", 1, "+I"), (2, "b", 2, "+I")], schema), 0)
    log.upsert(spark.createDataFrame([(1, "a2", 3, "+U"), (2, "b", 4, "-D")], schema), 1)
    before = log.current().collect()
    log.compact()
    assert log.current().collect() == before
    log.purge()
    assert log.current().collect() == before and log.committed() == []
    log.upsert(spark.createDataFrame([(2, "c", 5, "+I")], schema), 2)
    assert sorted((r["k"], r["v"]) for r in log.current().collect()) == [(1, "a2"), (2, "c")]


def test_dimension_is_read_again_after_its_time_to_live(spark, folder):
    loads, now, seen = [], [0.0], []

    def load():
        loads.append(now[0])
        return spark.createDataFrame([(1, f"v{len(loads)}")], "k int, name string")

    handle = reloading_lookup(
        load, lambda b, d: b.join(d, "k"), lambda df, i: seen.append(df.first()["name"]),
        ttl_s=10, clock=lambda: now[0])
    batch = spark.createDataFrame([(1,)], "k int")
    for t in (0.0, 5.0, 11.0):
        now[0] = t
        handle(batch, 0)
    assert seen == ["v1", "v1", "v2"] and loads == [0.0, 11.0]


def test_async_enrich_times_out_to_the_fallback(spark):
    def client():
        import time

        def lookup(k):
            if k == 3:
                time.sleep(3)
            return f"v{k}"

        return lookup

    df = spark.range(6).coalesce(1)
    out = async_enrich(df, "id", "v", client, timeout_s=0.5, fallback="late").collect()
    assert [(r["id"], r["v"]) for r in out] == [
        (i, "late" if i == 3 else f"v{i}") for i in range(6)]
    loose = async_enrich(df, "id", "v", client, timeout_s=0.5, fallback="late", ordered=False,
                         chunk=1)
    got = [r["id"] for r in loose.collect()]
    assert sorted(got) == list(range(6)) and got[-1] == 3
    assert async_enrich(df, "id", "v", client, timeout_s=0.5).where("v is null").count() == 1


def test_async_enrich_ends_in_time_and_follows_the_error_policy(spark):
    def hung():
        import time

        return lambda k: time.sleep(60)

    begin = time.monotonic()
    df = spark.range(4).coalesce(1)
    assert async_enrich(df, "id", "v", hung, timeout_s=2).where("v is null").count() == 4
    assert time.monotonic() - begin < 4 + 2

    def failing():
        return lambda k: str(10 // k)

    out = async_enrich(df, "id", "v", failing, fallback="bad", on_error="fallback").collect()
    assert [r["v"] for r in out] == ["bad", "10", "5", "3"]
    with pytest.raises(Exception, match="division"):
        async_enrich(df, "id", "v", failing).collect()


def test_older_sequence_in_a_later_batch_loses_and_an_empty_log_is_empty(spark, folder):
    log = UpsertLog(spark, f"{folder}/seq", ["k"], seq=["s"], schema="k int, s int, v string")
    assert log.current().collect() == []
    log.upsert(spark.createDataFrame([(1, 5, "new")], "k int, s int, v string"), 0)
    log.upsert(spark.createDataFrame([(1, 3, "old"), (2, 1, "x")], "k int, s int, v string"), 1)
    assert sorted((r.k, r.v) for r in log.current().collect()) == [(1, "new"), (2, "x")]
    log.compact()
    log.purge()
    log.upsert(spark.createDataFrame([(1, 5, "same")], "k int, s int, v string"), 2)
    assert sorted((r.k, r.v) for r in log.current().collect()) == [(1, "same"), (2, "x")]


def test_twenty_batches_keep_two_log_rows(spark, folder):
    split = LateSplitter(spark, f"{folder}/split20", "ts", "3 seconds", "2 seconds")
    start = dt.datetime(2024, 1, 1)
    for n in range(20):
        ts = start + dt.timedelta(seconds=n if n != 7 else 100)
        split.process(spark.createDataFrame([(ts,)], "ts timestamp"), n)
    assert len(split.progress.committed()) == 2
    assert sorted(r.batch_id for r in split.rows().where("late").collect()) == list(range(8, 20))


def test_timed_join_needs_both_sides_in_time(spark, folder):
    feed = Feed(spark, folder, "side string, k int, v int")
    feed.add([("l", 1, 10), ("r", 2, 20), ("l", 9, 90)])
    feed.add([("r", 1, 11), ("l", 2, 21), ("l", 1, 12)])
    rows = feed.stream()
    left = rows.filter("side = 'l'").select("k", F.col("v").alias("lv"))
    right = rows.filter("side = 'r'").select("k", F.col("v").alias("rv"))
    for ttl, want in (("1 HOUR", [(10, 11), (12, 11), (21, 20)]), ("0 SECOND", [(12, 11)])):
        out = run_to_files(state.timed_join(left, right, "k", ttl, "lv"), f"tj{ttl[0]}")
        assert sorted((r.lv, r.rv) for r in out.collect()) == want


def test_key_value_entries_expire_and_uncommitted_parts_are_ignored(spark, folder):
    spark.dataSource.register(KeyValueSink)
    feed = Feed(spark, folder, "key string, value string, seq long, ttl long")
    feed.add([("a", "1", 1, 10), ("b", "2", 2, None)])
    feed.add([("a", "3", 3, 100)])
    store = qualified(spark, f"{folder}/store")
    q = (feed.stream().writeStream.format("tidemill_kv").option("now_ms", "1000")
         .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(store))
    q.awaitTermination()
    writer = KeyValueWriter({"path": store, "flush_rows": "2", "now_ms": "1000"})
    part = writer.write(iter([{"key": "z", "value": "0", "seq": 9, "ttl": None}] * 5))
    assert isinstance(part, PartWritten) and (part.rows, part.flushes) == (5, 3)
    live = {r["key"]: r["value"] for r in live_values(spark, store, 50_000).collect()}
    assert live == {"a": "3", "b": "2"}
    assert {r["key"] for r in live_values(spark, store, 200_000).collect()} == {"b"}


def test_restart_loses_no_change_between_runs(spark, folder):
    kind = "k int, op string, c int, s int, v string"
    first = spark.createDataFrame([(1, "+I", 1, 1, "a"), (1, "+U", 2, 2, "b")], kind)
    first.coalesce(1).write.parquet(f"{folder}/log")
    log = BatchLog(spark, f"{folder}/out")

    def run(at):
        changes = spark.read.schema(first.schema).parquet(f"{folder}/log")
        stream = spark.readStream.schema(first.schema).parquet(f"{folder}/log")
        got = snapshot_then_follow(changes, stream, ["k"], "op", "c", ["s"], F.lit(at), ["v"], log,
                                   "restart")
        return sorted((r.op, r.v) for r in got.collect())

    assert run(2) == [("+I", "b")]
    spark.createDataFrame([(1, "+U", 3, 3, "c")], kind).coalesce(1).write.mode("append").parquet(
        f"{folder}/log")
    # the restart is told commit 3 is the latest; the change of commit 3 must still come
    assert run(3) == [("+I", "b"), ("+U", "c")]
    assert run(9) == [("+I", "b"), ("+U", "c")]


def test_a_refused_move_is_no_load(spark, folder, monkeypatch):
    load = BudgetedLoad(spark, folder, F.lit(False))
    monkeypatch.setattr(load, "forget", lambda _: None)
    rows = spark.range(3)
    rows.write.parquet(f"{load.root}/batch_id=4/batch_id=4")  # in the way: the move nests or fails
    rows.write.parquet(f"{load.root}/pending-9")
    with pytest.raises(Exception):
        load._publish(f"{load.root}/missing", f"{load.root}/batch_id=9")
    load._publish(f"{load.root}/pending-9", f"{load.root}/batch_id=9")
    assert load.committed() == [9] and load.only(9).count() == 3


def test_key_value_sink_with_another_session_active(spark, tables):
    from tidemill.catalog import load_all
    from tidemill.session import make_active

    wanted = sorted(map(tuple, load_all()["b16_key_value_sink"].build(tables).collect()))
    make_active(spark.newSession())
    try:
        got = sorted(map(tuple, load_all()["b16_key_value_sink"].build(tables).collect()))
        make_active(spark.newSession())
        assert load_all()["a25_enumerated_source"].build(tables).count() > 0
    finally:
        make_active(spark)
    assert got == wanted


def test_late_rows_fire_again_across_restarts(spark, folder):
    feed = Feed(spark, folder, "k string, ts timestamp, a int")

    def run():
        rows = late_windows(feed.stream(), "k", "ts", "a", 10_000, 2_000)
        got = run_to_files(rows, "late", f"{folder}/ck", f"{folder}/out", rocksdb=True)
        return sorted((r.key, r.window_ms - ms, r.kind, r.firing, r.n, r.total)
                      for r in got.collect())

    ms = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    feed.add([("a", at(1), 1), ("a", at(3), 2), ("b", at(4), 5), ("x", at(10), 0)])
    assert run() == [("a", 0, "fired", 1, 2, 3), ("b", 0, "fired", 1, 1, 5)]
    # the watermark is at 10: two late rows of a, the first row of c's window
    feed.add([("a", at(2), 10), ("a", at(9), 20), ("c", at(5), 7), ("x", at(11), 0)])
    second = run()
    assert second[:3] == [("a", 0, "fired", 1, 2, 3), ("a", 0, "fired", 2, 3, 13),
                          ("a", 0, "fired", 3, 4, 33)]
    assert ("c", 0, "fired", 1, 1, 7) in second
    feed.add([("x", at(13), 0)])  # 12 is passed: the windows are cleared
    run()
    feed.add([("a", at(8), 40), ("a", at(8), 2), ("x", at(14), 0)])
    last = run()
    assert ("a", 0, "late", 0, 2, 42) in last
    assert len([r for r in last if r[0] == "a"]) == 4
    held = (spark.read.format("statestore").option("stateVarName", "held").load(f"{folder}/ck"))
    assert {r["key"]["key"] for r in held.collect()} == {"x"}


def test_versions_wait_meet_and_go(spark, folder):
    left = Feed(spark, f"{folder}/l", "k string, ts timestamp, id long")
    right = Feed(spark, f"{folder}/r", "k string, ts timestamp, id long, v string")

    def run():
        rows = stream_asof_join(left.stream(), right.stream(), "k", "ts", "id", "id", F.col("v"),
                                "5 seconds", salts=1)
        got = run_to_files(rows, "asof", f"{folder}/ck", f"{folder}/out", rocksdb=True)
        return sorted((r.id, r.version, r.value) for r in got.collect())

    def stored(name):
        return (spark.read.format("statestore").option("stateVarName", name)
                .load(f"{folder}/ck").count())

    left.add([("a", at(3), 1), ("a", at(8), 2), ("b", at(4), 3), ("a", at(12), 4)])
    right.add([("a", at(7), 12, "second"), ("a", at(1), 11, "first"), ("b", at(9), 13, "later"),
               ("a", at(10), 15, "fourth")])
    # both inputs have passed 5: rows before are answered, out-of-order versions in time order
    assert run() == [(1, 11, "first"), (3, None, None)]
    right.add([("a", at(8), 14, "third"), ("a", at(30), 16, "far")])
    left.add([("a", at(40), 5)])
    assert run() == [(1, 11, "first"), (2, 14, "third"), (3, None, None), (4, 15, "fourth")]
    # of a's versions up to 25 the newest stays, and the one to come
    kept = (spark.read.format("statestore").option("stateVarName", "versions")
            .load(f"{folder}/ck").where("key.key = 'a'").count())
    assert stored("waiting") == 1 and kept == 2
    many = [("a", at(30 + k / 10), 100 + k, f"v{k}") for k in range(50)]
    right.add(many)
    right.add([("a", at(60), 200, "end")])
    left.add([("a", at(61), 6), ("a", at(2), 7)])  # the second is late
    assert run()[-1] == (5, 149, "v49")
    right.add([("a", at(90), 201, "after")])
    left.add([("a", at(91), 8)])
    assert run()[-1] == (6, 200, "end") and len(run()) == 6
    assert stored("versions") <= 5


def test_first_of_a_key_is_kept_while_its_time_lasts(spark, folder):
    feed = Feed(spark, folder, "k string, ts timestamp, id long")

    def run():
        rows = first_in_time(feed.stream(), ["k"], "ts", "10 seconds")
        return sorted(r.id for r in run_to_files(
            rows, "first", f"{folder}/ck", f"{folder}/out").collect())

    feed.add([("a", at(1), 1), ("b", at(2), 2)])
    feed.add([("a", at(5), 3), ("b", at(7), 4), ("c", at(8), 5)])
    assert run() == [1, 2, 5]
    feed.add([("z", at(60), 6)])
    run()
    feed.add([("a", at(61), 7), ("a", at(62), 8)])  # the time of the first a is over
    got = run()
    assert got[:4] == [1, 2, 5, 6] and len(got) == 5
    kept = spark.read.format("statestore").load(f"{folder}/ck").count()
    assert kept == 2  # z and the new a; b and c are gone


def test_settings_are_given_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with stream_settings(spark, rocksdb=True, spark__sql__streaming__multipleWatermarkPolicy="max"):
        assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "max"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
