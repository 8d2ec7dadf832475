"""States of buckets of keys, lookups by bucket, and frames that end with their group."""

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.test_streams import Feed, at
from tidemill.operators import ordered
from tidemill.session import qualified
from tidemill.streaming import state
from tidemill.streaming.lookup import ParquetLookup, cached_lookup
from tidemill.streaming.runner import run_batches, run_to_files
from tidemill.streaming.sinks import BatchLog
from tidemill.streaming.timers import stream_asof_join

BIG = 2**60 + 1


def test_a_frame_to_the_end_of_its_group_runs_backwards(spark):
    rows = spark.createDataFrame([(k % 3, None if k == 5 else k // 2, k) for k in range(40)],
                                 "g int, o int, id int")
    by = [F.col("o").desc(), F.col("id")]
    plain = ordered.running(rows, ["g"], by, None, {"s": ("sum", F.col("id"))}, reverse=True)
    hot = ordered.running(rows, ["g"], by, None, {"s": ("sum", F.col("id"))}, reverse=True,
                          hot_rows=5)
    for df in (plain, hot):
        text = df._jdf.queryExecution().executedPlan().toString().lower()
        assert "unboundedfollowing" not in text and "currentrow$()" in text
        for g in range(3):
            own = [r for r in df.collect() if r.g == g]
            own.sort(key=lambda r: (r.o is None, -(r.o or 0), r.id))
            left = 0
            for r in reversed(own):
                left += r.id
                assert r.s == left


def test_deals_of_many_items_wait_in_few_states(spark, folder):
    feed = Feed(spark, folder, "kind string, item long, seq long, x double")
    feed.add([("deal", i, 1000 + i, 1.0) for i in range(50)]
             + [("deal", None, BIG, 3.0), ("deal", BIG, None, 2.0)])
    feed.add([("price", i, 0, float(i)) for i in range(0, 50, 2)] + [("price", BIG, 0, 5.0)])
    feed.add([("price", None, 0, 7.0), ("price", 1, 1, None), ("price", 2, 2, 9.0)])
    feed.add([("deal", 2, 3000, 1.0), ("deal", 3, 3001, 1.0)])

    def part(kind, name):
        return feed.stream().filter(F.col("kind") == kind).select(
            "item", "seq", F.col("x").alias(name))

    ck = f"{folder}/ck"
    out = run_to_files(state.priced_deals(part("price", "price"), part("deal", "qty"), 2, 3),
                       "deals", checkpoint=ck, rocksdb=True)
    got = {(r["item"], r.deal_id, r.qty, r.price) for r in out.collect()}
    assert got == {(i, 1000 + i, 1.0, float(i)) for i in range(0, 50, 2)} | {
        (BIG, None, 2.0, 5.0), (None, BIG, 3.0, 7.0), (1, 1001, 1.0, None), (2, 3000, 1.0, 9.0)}
    keys = spark.read.format("statestore").option("stateVarName", "prices").load(ck)
    assert keys.select("key").distinct().count() <= 3


def test_packages_of_many_codes_wait_in_few_states(spark, folder):
    headers = Feed(spark, f"{folder}/h", "code long, seq long, info string")
    packages = Feed(spark, f"{folder}/p", "code long, seq long, package long")
    headers.add([(c, 0, f"h{c}") for c in range(0, 20, 2)])
    packages.add([(c, 0, p) for c in range(10) for p in (1, BIG)] * 2)
    headers.add([(c, 0, f"h{c}") for c in range(20)] + [(None, 0, None)])
    packages.add([(c, 0, 3) for c in range(10, 15)] + [(BIG, 0, None), (None, 0, 9)])
    out = run_to_files(state.header_packages(headers.stream(), packages.stream(), 2, buckets=3),
                       "hp", checkpoint=f"{folder}/ck", rocksdb=True)
    got = sorted(((r.code, r.package, r.info) for r in out.collect()), key=str)
    want = [(c, p, f"h{c}") for c in range(10) for p in (1, BIG)]
    want += [(c, 3, f"h{c}") for c in range(10, 15)] + [(None, 9, None)]
    # alone: even codes from 10 on in the first batch, then odd ones without packages
    want += [(c, None, f"h{c}") for c in (10, 12, 14, 15, 16, 17, 18, 19)]
    assert got == sorted(want, key=str)


def test_totals_in_one_state_expire_one_by_one(spark, folder):
    feed = Feed(spark, folder, "key long, id long, kind string")
    log = BatchLog(spark, f"{folder}/log")

    def run():
        run_batches(state.keyed_totals(feed.stream(), 20_000, buckets=1), log.write, "one",
                    mode="update", checkpoint=f"{folder}/c", rocksdb=True,
                    spark__sql__streaming__noDataMicroBatches__enabled="false")

    feed.add([(1, 1, "a"), (2, BIG, None), (None, 5, "b")])
    run()
    begin = time.monotonic()
    feed.add([(1, 2, "b")])
    run()
    assert time.monotonic() - begin < 20
    time.sleep(max(0, 21 - (time.monotonic() - begin)))  # key 2 is over; key 1 may be or not
    feed.add([(2, 6, "a")])
    run()
    got = {(r.batch_id, r.key, tuple(r.ids), r.n, r.kinds) for r in log.rows().collect()}
    assert got == {(0, 1, (1,), 1, "a=1"), (0, 2, (BIG,), 1, ""), (0, None, (5,), 1, "b=1"),
                   (1, 1, (2,), 2, "a=1,b=1"), (2, 2, (6,), 1, "a=1")}


def test_versions_of_many_keys_share_a_state(spark, folder):
    left = Feed(spark, f"{folder}/l", "k long, ts timestamp, id long")
    right = Feed(spark, f"{folder}/r", "k long, ts timestamp, id long, v string")
    left.add([(k, at(10 + k), k) for k in range(20)])
    right.add([(k, at(5 + k), 100 + k, f"v{k}") for k in range(0, 20, 2)] + [(3, None, 1, "x")])
    left.add([(99, at(500), 99)])
    right.add([(0, at(9), 200, "newer"), (98, at(500), 98, "end")])
    got = run_to_files(stream_asof_join(left.stream(), right.stream(), "k", "ts", "id", "id",
                                        F.col("v"), "60 seconds", salts=2, buckets=2),
                       "asof", f"{folder}/ck", rocksdb=True)
    want = {(str(k), k, 100 + k, f"v{k}") if k % 2 == 0 else (str(k), k, None, None)
            for k in range(20)} - {("0", 0, 100, "v0")} | {("0", 0, 200, "newer")}
    assert {tuple(r) for r in got.select("key", "id", "version", "value").collect()} == want
    held = spark.read.format("statestore").option("stateVarName", "versions").load(f"{folder}/ck")
    assert held.select("key.key").distinct().count() <= 2


def test_a_question_opens_the_files_of_its_keys(spark, folder):
    table = f"{folder}/t"
    rows = [(k, f"n{k}") for k in range(200)] + [(7, "again"), (None, "none")]
    spark.createDataFrame(rows, "k int, name string").coalesce(1).write.parquet(table)
    ask = ParquetLookup.laid_out(spark.read.parquet(table), "k", ["name"], f"{folder}/by-key", 10)
    assert ask.buckets == 21 and len(ask._table([7]).files) == 1
    assert ask([7, 150, 999]) == {7: ("n7",), 150: ("n150",)} and ask([]) == {}
    asked = spark.createDataFrame([(i, i % 250 if i % 9 else None) for i in range(1000)],
                                  "i int, k int")
    name = T.StructType([T.StructField("name", T.StringType())])
    got = cached_lookup(ask.near(asked, "k", ["i"]), "k", name, ask, max_rows=5, ttl_s=60,
                        name=folder, hit="hit").collect()
    assert {(r.i, r.k, r.name) for r in got} == {
        (i, k, f"n{k}" if k is not None and k < 200 else None)
        for i in range(1000) for k in [i % 250 if i % 9 else None]}
    assert qualified(spark, folder) in ask.uri


def test_timed_join_in_one_store(spark, folder):
    feed = Feed(spark, folder, "side string, k int, v int")
    feed.add([("l", 1, 10), ("r", 2, 20), ("l", None, 90)])
    feed.add([("r", 1, 11), ("l", 2, 21), ("r", None, 12)])
    rows = feed.stream()
    out = run_to_files(state.timed_join(
        rows.filter("side = 'l'").select("k", F.col("v").alias("lv")),
        rows.filter("side = 'r'").select("k", F.col("v").alias("rv")), "k", "1 HOUR", "lv"),
        "one", checkpoint=f"{folder}/ck", rocksdb=True, **state.ONE_STORE)
    assert sorted((r.lv, r.rv) for r in out.collect()) == [(10, 11), (21, 20)]
