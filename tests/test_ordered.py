"""Chunked paths of the ordered operators against plain Python, with a hot key."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators import ordered
from tidemill.operators.distinct import list_parts
from tidemill.operators.joining import asof_join, interval_join


def make_rows(n=400, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None])
        rows.append((key, rnd.randrange(60), i, rnd.choice([None, rnd.randrange(100)])))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    rows = make_rows()
    return rows, spark.createDataFrame(rows, "k string, t int, id int, v int")


def by_key(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    return {k: sorted(g, key=lambda r: (r[1], r[2])) for k, g in groups.items()}


CHUNKS = ["expr", "range"]


def order():
    return [F.col("t"), F.col("id")]


def chunks(kind):
    return [F.floor(F.col("t") / 7)] if kind == "expr" else None


@pytest.mark.parametrize("chunk", CHUNKS)
@pytest.mark.parametrize("hot_rows", [50, 10**6])
def test_row_numbers(data, chunk, hot_rows):
    rows, df = data
    out = ordered.row_numbers(df, ["k"], order(), chunks(chunk), hot_rows=hot_rows)
    got = {r["id"]: r["row_num"] for r in out.collect()}
    want = {r[2]: i + 1 for g in by_key(rows).values() for i, r in enumerate(g)}
    assert got == want


def test_row_numbers_without_keys(data):
    rows, df = data
    out = ordered.row_numbers(df, [], order())
    got = {r["id"]: r["row_num"] for r in out.collect()}
    assert got == {r[2]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}


@pytest.mark.parametrize("chunk", CHUNKS)
def test_running(data, chunk):
    rows, df = data
    v = F.col("v")
    out = ordered.running(
        df, ["k"], order(), chunks(chunk),
        {"s": ("sum", v), "c": ("count", v), "lo": ("min", v), "hi": ("max", v),
         "last": ("last_value", v)}, hot_rows=50)
    got = {r["id"]: (r["s"], r["c"], r["lo"], r["hi"], r["last"]) for r in out.collect()}
    want = {}
    for g in by_key(rows).values():
        seen = []
        for r in g:
            if r[3] is not None:
                seen.append(r[3])
            want[r[2]] = (
                (sum(seen), len(seen), min(seen), max(seen), seen[-1]) if seen
                else (None, 0, None, None, None))
    assert got == want


def test_running_reverse(data):
    rows, df = data
    out = ordered.running(df, ["k"], order(), None, {"s": ("sum", F.col("id"))}, reverse=True,
                          hot_rows=50)
    got = {r["id"]: r["s"] for r in out.collect()}
    want = {}
    for g in by_key(rows).values():
        for i, r in enumerate(g):
            want[r[2]] = sum(x[2] for x in g[i:])
    assert got == want


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("block_rows", [5, 1000])
def test_framed(data, keys, block_rows):
    rows, df = data
    out = ordered.framed(
        df, keys, order(), None, 2, 3,
        lambda w, f: {"s": F.sum("id").over(f), "prev": F.lag("id").over(w),
                      "next": F.lead("id").over(w)},
        block_rows=block_rows, hot_rows=50)
    got = {r["id"]: (r["s"], r["prev"], r["next"]) for r in out.collect()}
    groups = by_key(rows).values() if keys else [sorted(rows, key=lambda r: (r[1], r[2]))]
    want = {}
    for g in groups:
        ids = [r[2] for r in g]
        for i, x in enumerate(ids):
            want[x] = (sum(ids[max(0, i - 2): i + 4]), ids[i - 1] if i else None,
                       ids[i + 1] if i + 1 < len(ids) else None)
    assert got == want and len(got) == len(rows)


def test_framed_rejects_wide_frames(data):
    with pytest.raises(ValueError):
        ordered.framed(data[1], [], order(), None, 10, 0, lambda w, f: {}, block_rows=5)


def test_ranks_with_ties(data):
    rows, df = data
    out = ordered.ranks(df, ["k"], "t", hot_rows=10)
    got = {r["id"]: (r["rnk"], r["dense_rnk"]) for r in out.collect()}
    want = {}
    for g in by_key(rows).values():
        values = [r[1] for r in g]
        for r in g:
            want[r[2]] = (sum(v < r[1] for v in values) + 1, len({v for v in values if v < r[1]}) + 1)
    assert got == want


def test_list_parts_keeps_every_value(data):
    rows, df = data
    out = list_parts(df, ["k"], "id", [F.col("id")], [F.floor(F.col("id") / 10)], "ids", size=16)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (str(r["k"]), r["part"])):
        assert r["n"] <= 16
        got.setdefault(r["k"], []).extend(int(x) for x in r["ids"].split(","))
    want = {}
    for r in sorted(rows, key=lambda r: r[2]):
        want.setdefault(r[0], []).append(r[2])
    assert got == want


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join_against_loops(spark, how):
    rnd = random.Random(9)
    left = [(i, rnd.choice("ab"), rnd.randrange(0, 4000)) for i in range(60)]
    right = [(i, rnd.choice("ab"), rnd.randrange(0, 4000)) for i in range(60)]
    ts = F.timestamp_seconds("s")
    ldf = spark.createDataFrame(left, "lid int, lk string, s int").withColumn("lts", ts).drop("s")
    rdf = spark.createDataFrame(right, "rid int, rk string, s int").withColumn("rts", ts).drop("s")
    out = interval_join(ldf, rdf, [("lk", "rk")], "lts", "rts", -120, 300, how)
    got = sorted((r["lid"], -1 if r["rid"] is None else r["rid"]) for r in out.collect())
    want = []
    for lid, lk, lt in left:
        hits = [rid for rid, rk, rt in right if rk == lk and -120 <= rt - lt <= 300]
        want += [(lid, r) for r in hits]
        if how == "left" and not hits:
            want.append((lid, -1))
    assert got == sorted(want)


def test_asof_join_takes_version_at_same_instant(spark):
    left = spark.createDataFrame([("a", 5, 1), ("a", 10, 2), ("b", 1, 3)], "k string, t int, id int")
    versions = spark.createDataFrame([("a", 5, "x"), ("a", 9, "y")], "k string, t int, name string")
    out = asof_join(left, versions, ["k"], "t", ["name"], chunk=lambda c: [F.floor(c / 3)])
    assert {r["id"]: r["name"] for r in out.collect()} == {1: "x", 2: "y", 3: None}


def test_a_key_hot_within_one_hour(spark):
    """Thousands of rows in one second of one key; fixed chunks would not cut them."""
    rows = spark.range(3000).select(
        F.lit("k").alias("k"), F.col("id"), F.lit(0).alias("t"))
    hour = [F.floor(F.col("t") / 3600)]
    out = ordered.row_numbers(rows, ["k"], [F.col("t"), F.col("id")], hour, hot_rows=100)
    got = out.select("id", "row_num").collect()
    assert all(r["row_num"] == r["id"] + 1 for r in got) and len(got) == 3000
    total = ordered.running(rows, ["k"], [F.col("t"), F.col("id")], hour,
                            {"s": ("sum", F.col("id"))}, hot_rows=100)
    assert all(r["s"] == r["id"] * (r["id"] + 1) // 2 for r in total.collect())


def test_interval_join_refuses_right_outer_forms(spark):
    side = spark.createDataFrame([(1, 0)], "k int, t int")
    for how in ("right", "full"):
        with pytest.raises(ValueError, match="inner or left"):
            interval_join(side, side, [("k", "k")], "t", "t", 0, 5, how)
