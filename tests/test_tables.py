"""Small cases for table models, change data, cells, refresh and load rules."""

import time

import pytest
from pyspark.sql import functions as F

from tidemill.functions.columns import (
    bucketed_key, ceil_to, java_hash, level_of, round_up_decimal, slot_last_minute, time_slice,
)
from tidemill.operators import cells as cell
from tidemill.operators import tables as tbl
from tidemill.operators.distinct import (
    bitmap_counts, bitmap_ids, bitmap_intersect, bitmap_rows, bitmap_union, extend_dictionary,
)
from tidemill.operators.joining import dict_mapping
from tidemill.operators.ledger import LabelUsed, LoadLedger
from tidemill.operators.partitions import RangeMismatch, committable, swap_partition
from tidemill.operators.refresh import DerivedTable, InactiveView
from tidemill.session import managed_database


def rows(df, *cols):
    return sorted(tuple(r[c] for c in (cols or df.columns)) for r in df.collect())


def test_sequence_field_older_row_loses_and_ties_go_to_later_arrival(spark):
    df = spark.createDataFrame(
        [("W1", 5, "a", 1), ("W1", 3, "b", 2), ("W3", 2, "c", 3), ("W3", 2, "d", 4)],
        "code string, ts long, site string, arrival int")
    out = tbl.latest_per_key(df, ["code"], ["ts", "arrival"])
    assert rows(out, "code", "site") == [("W1", "a"), ("W3", "d")]


def test_op_rows_with_delete_of_missing_key(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    changes = spark.createDataFrame(
        [(1, "a", "-U", 1), (1, "a2", "+U", 2), (9, "x", "-D", 3), (3, "c", "+I", 4),
         (2, "b", "-D", 5)], "id int, name string, op string, seq int")
    assert rows(tbl.apply_ops(current, changes, ["id"], "op", ["seq"])) == [(1, "a2"), (3, "c")]


def test_partial_update_keeps_non_null(spark):
    df = spark.createDataFrame(
        [(1, "n", None, 1), (1, None, 20, 2), (1, None, None, 3), (2, None, None, 4)],
        "id int, name string, age int, seq int")
    out = tbl.partial_update(df, ["id"], ["seq"], ["name", "age"])
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, "n", 20), (2, None, None)]


def test_insert_of_some_columns(spark):
    current = spark.createDataFrame(
        [(1001, "zhang", "m"), (1002, "li", "f")], "id int, name string, sex string")
    incoming = spark.createDataFrame([(1001, "z2"), (1020, "wu")], "id int, name string")
    out = tbl.insert_columns(current, incoming, ["id"], ["name"]).orderBy("id").collect()
    assert [tuple(r) for r in out] == [(1001, "z2", "m"), (1002, "li", "f"), (1020, "wu", None)]


def test_aggregate_key_values(spark):
    df = spark.createDataFrame(
        [("1-1", 1, 10, 10), ("1-1", 1, 11, 11), ("1-1", 1, 12, 12), ("2-2", 1, 19, 19),
         ("2-2", None, 6, 6)], "room string, cnt int, hi int, lo int")
    out = tbl.aggregate_merge([df], ["room"], {"cnt": "sum", "hi": "max", "lo": "min"})
    assert rows(out) == [("1-1", 3, 12, 10), ("2-2", 1, 19, 6)]


def test_replace_if_not_null_prefers_later_part(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    new = spark.createDataFrame([(1, None), (2, "c")], "id int, name string")
    out = tbl.aggregate_merge([old, new], ["id"], {"name": "replace_if_not_null"})
    assert rows(out) == [(1, "a"), (2, "c")]


def test_changelog_is_null_safe(spark):
    old = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "id int, v string")
    new = spark.createDataFrame([(1, None), (2, None), (4, "d")], "id int, v string")
    got = sorted(tuple(r) for r in tbl.changelog(old, new, ["id"]).fillna("-").collect())
    assert got == [("+I", 4, "d"), ("+U", 2, "-"), ("-D", 3, "c"), ("-U", 2, "b")]


@pytest.mark.parametrize("ages, dropped", [
    ([50, 40, 30, 4, 3], [1, 2, 3]),      # first young commit is 4
    ([50, 40, 30, 20, 10], [1, 2, 3, 4]),  # none young: keep the newest only
    ([1, 1, 1, 1, 1], [1, 2]),            # all young: the maximum number decides
])
def test_expired_commits(spark, ages, dropped):
    now = F.lit("2024-01-01 12:00:00").cast("timestamp")
    commits = spark.createDataFrame(list(enumerate(ages, 1)), "id int, age int").withColumn(
        "ts", now - F.make_dt_interval(mins=F.col("age")))
    out = tbl.expired_commits(commits, "id", "ts", 1, 3, "INTERVAL '5' MINUTE", now)
    assert [r["id"] for r in out.orderBy("id").collect()] == dropped


def test_ranges_and_rejects(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-02-05",), ("2025-01-01",)], "d string")
    out = tbl.route_ranges(df, F.col("d"), [("p1", "2024-01-01", "2024-02-01"),
                                            ("p2", "2024-02-01", "2024-03-01")], "p")
    assert [r["p"] for r in out.orderBy("d").collect()] == ["p1", "p2", None]


def test_load_gate_allows_exactly_the_ratio(spark):
    df = spark.createDataFrame([(None if i == 0 else i,) for i in range(10)], "k int")
    assert tbl.load_gate(df, F.col("k").isNull(), 0.1)["filtered_rows"] == 1
    with pytest.raises(tbl.LoadRejected):
        tbl.load_gate(df, F.col("k").isNull(), 0.0)


def test_label_of_failed_load_can_be_used_again(spark, folder):
    ledger = LoadLedger(spark, folder)
    with pytest.raises(ZeroDivisionError):
        ledger.run("a", lambda _: 1 / 0)
    assert ledger.rows() is None

    def load(out):
        spark.range(3).write.mode("overwrite").parquet(out)
        return {"scan_rows": 3, "sink_rows": 3}

    assert ledger.run("a", load)["sink_rows"] == 3
    with pytest.raises(LabelUsed):
        ledger.run("a", load)
    assert sorted((r.id, r.label) for r in ledger.rows().collect()) == [
        (0, "a"), (1, "a"), (2, "a")]
    assert sorted(r.state for r in ledger.entries().collect()) == ["CANCELLED", "FINISHED"]


def test_crash_between_load_and_record_doubles_nothing(spark, folder):
    ledger = LoadLedger(spark, folder)

    def load(out):
        spark.range(3).write.mode("overwrite").parquet(out)
        return {"sink_rows": 3}

    def crash(*_):
        raise KeyboardInterrupt  # neither finished nor failed

    ledger._record = crash
    with pytest.raises(KeyboardInterrupt):
        ledger.run("b", load)
    again = LoadLedger(spark, folder)
    assert again.rows() is None
    with pytest.raises(LabelUsed):  # the claim is still fresh
        again.run("b", load)
    late = LoadLedger(spark, folder, stale_s=0)
    late.run("b", load)
    assert late.rows().count() == 3
    with pytest.raises(LabelUsed):
        late.run("b", load)


def test_two_callers_of_a_stale_claim_are_not_both_owners(spark, folder):
    dead = LoadLedger(spark, folder)
    assert dead._claim("c") == 1
    one, two = (LoadLedger(spark, folder, stale_s=0) for _ in range(2))
    seen = two._attempts("c")
    assert one._claim("c") == 2
    two._attempts = lambda label: seen  # as listed before the other's claim
    with pytest.raises(LabelUsed):
        two._claim("c")


def test_a_long_load_keeps_its_claim_and_a_lost_one_does_not_count(spark, folder):
    mine, other = (LoadLedger(spark, folder, stale_s=2) for _ in range(2))

    def load(out):
        time.sleep(3)
        with pytest.raises(LabelUsed):  # over stale_s old, but renewed
            other.run("d", lambda _: {})
        spark.range(2).write.mode("overwrite").parquet(out)
        return {"sink_rows": 2}

    mine.run("d", load)
    assert mine.rows().count() == 2

    def overtaken(out):
        spark.range(5).write.parquet(out)
        LoadLedger(spark, folder, stale_s=-10).run("e", lambda o: (
            spark.range(1).write.mode("overwrite").parquet(o), {"sink_rows": 1})[1])
        return {"sink_rows": 5}

    with pytest.raises(LabelUsed):
        mine.run("e", overtaken)
    assert mine.rows().where("label = 'e'").count() == 1


def test_bitmap_ids_over_one_bucket(spark):
    df = spark.createDataFrame(
        [("p1", i) for i in (1, 2, 32769, 32769)] + [("p2", i) for i in (2, 32769, 70000)],
        "page string, uid long")
    bits = bitmap_rows(df, ["page"], "uid")
    assert rows(bitmap_counts(bits, ["page"], "n")) == [("p1", 3), ("p2", 3)]
    assert bitmap_counts(bitmap_union(bits, []), [], "n").first()["n"] == 4
    both = bitmap_intersect(bits, []).filter("groups = 2")
    assert bitmap_counts(both, [], "n").first()["n"] == 2


def test_bitmaps_of_any_density(spark):
    """Sorted offsets, bits and mixtures of both against sets."""
    import random

    rng = random.Random(4)
    sets = {
        ("a", 1): {1, 2, 64, 65, 32768, 32769, 0, -5, -40000, 10**12},
        ("a", 2): set(range(1, 32769)), ("a", 3): {5},
        ("b", 1): set(rng.sample(range(1, 32769), 2047)),
        ("b", 2): set(rng.sample(range(1, 32769), 2048)),
        ("b", 3): set(rng.sample(range(1, 70000), 9000)),
        ("c", 1): {k for k in range(1, 5000)}, ("c", 2): {k for k in range(4990, 9000)},
    }
    data = [(k, n, i) for (k, n), ids in sets.items() for i in ids] + [("a", 3, None), ("a", 3, 5)]
    bits = bitmap_rows(spark.createDataFrame(data, "k string, n int, id long"), ["k", "n"], "id")
    bits.cache()

    def back(df, keys):
        out = {}
        for r in bitmap_ids(df, keys, "id").collect():
            out.setdefault(tuple(r[c] for c in keys), set()).add(r["id"])
        return out

    assert back(bits, ["k", "n"]) == sets
    sizes = {(r.k, r.n, r.bucket): len(r.bits) for r in bits.collect()}
    assert sizes[("a", 3, 1)] == 2 and sizes[("b", 1, 1)] == 4094 and sizes[("b", 2, 1)] == 4096
    union = {}
    for (k, _), ids in sets.items():
        union.setdefault((k,), set()).update(ids)
    merged = bitmap_union(bits, ["k"])
    assert back(merged, ["k"]) == union
    assert {(r.k,): r.c for r in bitmap_counts(merged, ["k"], "c").collect()} == {
        k: len(v) for k, v in union.items()}
    both = bitmap_intersect(bits.where("n < 3"), ["k"]).filter("groups = 2")
    assert back(both, ["k"]) == {
        (k,): sets[k, 1] & sets[k, 2] for k in "abc" if sets[k, 1] & sets[k, 2]}


def test_dictionary_ids_are_dense_and_stable(spark):
    first = extend_dictionary(
        spark.createDataFrame([], "k string, id long"),
        spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "k string"), "k", "id")
    old = {r["k"]: r["id"] for r in first.collect()}
    assert sorted(old.values()) == [1, 2]
    second = extend_dictionary(
        first, spark.createDataFrame([("a",), ("c",), ("d",)], "k string"), "k", "id")
    new = {r["k"]: r["id"] for r in second.collect()}
    assert {k: new[k] for k in old} == old and sorted(new.values()) == [1, 2, 3, 4]


def test_dictionary_mapping_fails_on_missing_key(spark):
    words = spark.createDataFrame([(1, "x", "one")], "a int, b string, name string")
    df = spark.createDataFrame([(1, "x"), (1, "y")], "a int, b string")
    keys = [("a", "a"), ("b", "b")]
    assert rows(dict_mapping(df, words, keys, "name", "n").fillna("-"), "b", "n") == [
        ("x", "one"), ("y", "-")]
    with pytest.raises(Exception, match="not in dictionary"):
        dict_mapping(df, words, keys, "name", "n", null_if_missing=False).collect()


def test_java_hash_known_values(spark):
    # values of the published 32-bit string hash
    known = {"dept_14": 1554582109, "": 0, "a": 97, "hello": 99162322, "\U0001F600": 1772899}
    df = spark.createDataFrame([(k,) for k in known] + [(None,)], "s string")
    got = {r["s"]: r["h"] for r in df.select("s", java_hash("s").alias("h")).collect()}
    assert got == {**known, None: None}


def test_bucketed_key_and_level(spark):
    row = spark.range(1).select(
        bucketed_key(F.lit("dept_14"), F.lit("emp_1")).alias("k"),
        *[level_of(F.lit(y)).alias(f"l{i}") for i, y in enumerate((-1, 3, 4, 18, 19))]).first()
    assert tuple(row) == ("09_dept_14_emp_1", "-", "F", "E", "A", "S")


def test_time_rounding(spark):
    ts = F.lit("2024-01-01 02:00:00").cast("timestamp")
    row = spark.range(1).select(
        (ceil_to("hour", ts) == ts).alias("aligned"),
        F.date_format(ceil_to("hour", ts + F.expr("INTERVAL '1' SECOND")), "HH").alias("up"),
        slot_last_minute(ts, 15).alias("m"),
        F.date_format(time_slice(ts, 7 * 86400, "2023-12-28 00:00:00"), "MM-dd").alias("s"),
    ).first()
    assert tuple(row) == (True, "03", 14, "12-28")


def test_round_up_decimal(spark):
    cases = {"1.231": "1.24", "-1.231": "-1.24", "1.20": "1.20", "999.991": None, "x": None,
             "1234.56": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r["s"]: None if r["d"] is None else str(r["d"])
           for r in df.select("s", round_up_decimal("s").alias("d")).collect()}
    assert got == cases


CELLS = [("r", "info", "name", 10, "a"), ("r", "info", "name", 20, "b"),
         ("r", "info", "name", 30, "c"), ("r", "info", "age", 20, "7"), ("r", "x", "q", 5, "z")]


@pytest.mark.parametrize("marker, left", [
    (("info", "name", 20, "column"), {("name", 30), ("age", 20), ("q", 5)}),
    (("info", "name", 20, "version"), {("name", 10), ("name", 30), ("age", 20), ("q", 5)}),
    (("info", None, 20, "family"), {("name", 30), ("q", 5)}),
])
def test_cell_deletes(spark, marker, left):
    cells = spark.createDataFrame(
        CELLS, "rowkey string, family string, qualifier string, ts long, value string")
    marks = spark.createDataFrame(
        [("r", *marker)], "rowkey string, family string, qualifier string, ts long, kind string")
    out = cell.apply_deletes(cells, marks)
    assert {(r["qualifier"], r["ts"]) for r in out.collect()} == left


def test_same_version_last_write_wins_and_versions_are_cut(spark):
    cells = spark.createDataFrame(
        [("r", "f", "q", 1, "hello", 1), ("r", "f", "q", 1, "world", 2), ("r", "f", "q", 2, "x", 3)],
        "rowkey string, family string, qualifier string, ts long, value string, arrival int")
    out = cell.dedup_writes(cells, "arrival")
    assert rows(out, "ts", "value") == [(1, "world"), (2, "x")]
    assert rows(cell.newest_versions(out, 1), "ts", "value") == [(2, "x")]


def test_cell_lines_round_trip(spark):
    cells = spark.createDataFrame(
        CELLS, "rowkey string, family string, qualifier string, ts long, value string")
    assert rows(cell.parse_cells(cell.cell_lines(cells))) == sorted(CELLS)


def test_swap_rejects_rows_of_other_partitions(spark):
    name = f"{managed_database(spark, 'swapt')}.t"
    spark.sql(f"CREATE TABLE {name} (id INT, dt STRING) USING parquet PARTITIONED BY (dt)")
    staged = spark.createDataFrame([(1, "a"), (2, "b")], "id int, dt string")
    with pytest.raises(RangeMismatch):
        swap_partition(staged, name, "dt", "a")
    swap_partition(staged.filter("dt = 'a'"), name, "dt", "a")
    assert rows(spark.table(name)) == [(1, "a")]


def test_partition_commit_rules(spark):
    parts = spark.createDataFrame([("a", 0, 0), ("b", 100, 50)], "dt string, t int, c int").select(
        "dt", F.timestamp_seconds("t").alias("pt"), F.timestamp_seconds("c").alias("created"))
    by_time = committable(parts, F.timestamp_seconds(F.lit(60)), "INTERVAL '30' SECOND", "pt")
    assert [r["dt"] for r in by_time.collect()] == ["a"]
    at_once = committable(parts, None, "INTERVAL '0' SECOND", "pt",
                          now=F.timestamp_seconds(F.lit(50)), created="created")
    assert sorted(r["dt"] for r in at_once.collect()) == ["a", "b"]


def derived(spark, label, **kw):
    return DerivedTable(
        spark, f"{managed_database(spark, label)}.mv", "dt", F.col("dt"),
        lambda b, d: b.join(d["sex"], "sex", "left").groupBy("dt", "sex_name").agg(
            F.count("*").alias("n")), **kw)


def test_refresh_rules(spark):
    base = spark.createDataFrame(
        [("07-28", 3), ("07-29", 2), ("07-30", 1), ("07-30", 1)], "dt string, sex int")
    sex = spark.createDataFrame([(1, "m"), (2, "f"), (3, "m1")], "sex int, sex_name string")
    mv = derived(spark, "mvrules")
    assert mv.refresh(base, {"sex": sex})["partitions"] == ["07-28", "07-29", "07-30"]
    assert mv.refresh(base, {"sex": sex})["state"] == "unchanged"
    more = base.unionByName(spark.createDataFrame([("07-29", 1)], base.schema))
    assert mv.refresh(more, {"sex": sex})["partitions"] == ["07-29"]
    gone = more.filter("dt <> '07-28'")
    assert mv.refresh(gone, {"sex": sex})["partitions"] == ["07-28"]
    spark.catalog.refreshTable(mv.table)
    assert rows(mv.read(), "dt", "sex_name", "n") == [
        ("07-29", "f", 1), ("07-29", "m", 1), ("07-30", "m", 2)]
    mv.limit = 1
    other = sex.withColumn("sex_name", F.upper("sex_name"))
    assert mv.refresh(gone, {"sex": other}) == {
        "state": "refreshed", "partitions": ["07-30"], "skipped": ["07-29"]}
    mv.active = False
    with pytest.raises(InactiveView):
        mv.refresh(gone, {"sex": other})
    assert mv.read().count() == 3


def test_limit_leaves_the_rest_stale(spark):
    base = spark.createDataFrame([(f"d{k}", 1) for k in range(9)], "dt string, sex int")
    one, two = (spark.createDataFrame([(1, x)], "sex int, sex_name string") for x in "ab")
    mv = derived(spark, "mvlimits", limit=2)
    mv.refresh(base, {"sex": one})
    for k in (7, 5, 3, 1):
        assert mv.refresh(base, {"sex": two})["partitions"] == [f"d{k}", f"d{k + 1}"]
    mv.limit = None
    assert mv.refresh(base, {"sex": two})["partitions"] == ["d0"]
    assert mv.refresh(base, {"sex": two})["state"] == "unchanged"
    assert {r.sex_name for r in mv.read().collect()} == {"b"}


def test_emptied_null_and_vanished_partitions_and_a_second_object(spark):
    sex = spark.createDataFrame([(1, "m"), (2, "f")], "sex int, sex_name string")
    schema = "dt string, sex int"
    build = lambda b, d: b.where("sex > 0").groupBy("dt").agg(F.count("*").alias("n"))
    name = f"{managed_database(spark, 'mvodd')}.mv"
    mv = DerivedTable(spark, name, "dt", F.col("dt"), build)
    mv.refresh(spark.createDataFrame([("a", 1), ("b", 1), (None, 1), ("c", 1)], schema), {"s": sex})
    assert sorted(map(tuple, mv.read().select("dt", "n").collect()), key=repr) == [
        ("a", 1), ("b", 1), ("c", 1), (None, 1)]
    again = DerivedTable(spark, name, "dt", F.col("dt"), build)
    changed = spark.createDataFrame([("a", 1), ("b", 0), (None, 0)], schema)
    assert again.refresh(changed, {"s": sex})["partitions"] == [
        "__HIVE_DEFAULT_PARTITION__", "b", "c"]
    assert [tuple(r) for r in again.read().select("dt", "n").collect()] == [("a", 1)]
    assert again.refresh(changed, {"s": sex})["state"] == "unchanged"
    assert mv.refresh(changed, {"s": sex})["state"] == "unchanged"


def test_delete_update_and_empty_stage(spark):
    name = f"{managed_database(spark, 'dmlcases')}.t"
    spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "it's")],
                          "id int, dt string").write.partitionBy("dt").saveAsTable(name)
    tbl.delete_where(spark, name, F.col("dt") == "a")
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 4, 5]
    tbl.delete_where(spark, name, F.col("id") == 4)
    tbl.update_where(spark, name, F.col("id") == 5, {"id": F.lit(50)})
    assert sorted(r.id for r in spark.table(name).collect()) == [3, 50]
    swap_partition(spark.table(name).filter("false"), name, "dt", "b")
    assert [r.id for r in spark.table(name).collect()] == [50]
    tbl.delete_where(spark, name, F.lit(True))
    assert spark.table(name).count() == 0
