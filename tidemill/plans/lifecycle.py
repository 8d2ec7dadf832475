"""Table models, change data and table life cycle (K)."""

from pyspark.sql import functions as F

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import day_text, exact_sum, money
from tidemill.operators import cells as cell
from tidemill.operators import tables as tbl
from tidemill.operators.distinct import (
    bitmap_counts, bitmap_rows, bitmap_union, extend_dictionary,
)
from tidemill.operators.ledger import LabelUsed, LoadLedger
from tidemill.operators.refresh import DerivedTable, overwrite_mode, overwrite_partitions
from tidemill.operators.spread import rebalanced
from tidemill.session import managed_database, work_dir

SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format
STATUS_TOTALS = f"""
SELECT o_orderstatus, count(*) AS n, {SUM('o_totalprice')} AS total FROM orders
GROUP BY o_orderstatus"""

CHANGES_SQL = """ch AS (SELECT user_id, event_type, value, event_id, ts,
  CASE event_type WHEN 'signup' THEN '+I' WHEN 'error' THEN '-D' ELSE '+U' END AS op,
  date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS commit_id FROM events)"""
STATE_SQL = """(SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM ch WHERE {0}) WHERE rn = 1
  AND op <> '-D')""".format


def changes(t):
    """Change rows: sign-ups insert, errors delete, all else updates; one commit a day."""
    kind = F.col("event_type")
    return t.events.select(
        "user_id", "event_type", "value", "event_id", "ts",
        F.when(kind == "signup", "+I").when(kind == "error", "-D").otherwise("+U").alias("op"),
        (F.datediff("ts", F.lit("2024-01-01").cast("date")) + 1).cast("bigint")
        .alias("commit_id"),
    )


def totals(orders):
    return orders.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), exact_sum("o_totalprice").alias("total")
    )


@query("k01_append", STATUS_TOTALS)
def append(t):
    out = work_dir(t.spark, "append")
    cols = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    t.orders.filter("o_orderstatus = 'F'").select(*cols).write.mode("append").parquet(out)
    t.orders.filter("o_orderstatus <> 'F'").select(*cols).write.mode("append").parquet(out)
    return totals(t.spark.read.parquet(out))


@query("k02_aggregate_key", """
SELECT user_id, count(*) AS cnt, min(value) AS low, max(value) AS high,
  arg_max(event_type, event_id) FILTER (event_type <> 'view') AS last_type
FROM events GROUP BY user_id""")
def aggregate_key(t):
    rows = changes(t).select(
        "user_id", "event_id", "commit_id", F.lit(1).cast("bigint").alias("cnt"),
        F.col("value").alias("low"), F.col("value").alias("high"),
        F.nullif(F.col("event_type"), F.lit("view")).alias("last_type"),
    )
    return tbl.aggregate_merge(
        [rows.filter("commit_id <= 15"), rows.filter("commit_id > 15")], ["user_id"],
        {"cnt": "sum", "low": "min", "high": "max", "last_type": "replace_if_not_null"},
        "event_id",
    )


@query("k02_bitmap_union", """
SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type""")
def bitmap_union_load(t):
    rows = changes(t)
    stored = bitmap_rows(rows.filter("commit_id <= 15"), ["event_type"], "user_id")
    loaded = bitmap_rows(rows.filter("commit_id > 15"), ["event_type"], "user_id")
    merged = bitmap_union(stored.unionByName(loaded), ["event_type"])
    return bitmap_counts(merged, ["event_type"], "users")


@query("k03_primary_key_merge", f"""
WITH {CHANGES_SQL} SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY event_id DESC) rn FROM ch) WHERE rn = 1""")
def primary_key_merge(t):
    rows = changes(t).select("user_id", "event_type", "value", "event_id")
    return tbl.latest_per_key(rows, ["user_id"], ["event_id"]).drop("event_id")


@query("k04_sequence_field", f"""
WITH {CHANGES_SQL} SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY value DESC, event_id DESC) rn FROM ch) WHERE rn = 1""")
def sequence_field(t):
    """The largest ``value`` wins whenever it arrived; equal ones by arrival."""
    rows = changes(t).select("user_id", "event_id", "value")
    return tbl.latest_per_key(rows, ["user_id"], ["value", "event_id"])


@query("k05_op_merge", f"WITH {CHANGES_SQL} SELECT * FROM {STATE_SQL('true')}")
def op_merge(t):
    rows = changes(t)
    cols = ["user_id", "event_type", "value"]
    empty = rows.select(*cols).filter("false")
    base = tbl.apply_ops(empty, rows.filter("commit_id <= 12"), ["user_id"], "op", ["event_id"])
    return tbl.apply_ops(base, rows.filter("commit_id > 12"), ["user_id"], "op", ["event_id"])


@query("k06_partial_update", """
SELECT user_id, arg_max(value, event_id) FILTER (event_type = 'purchase') AS paid,
  arg_max(event_type, event_id) FILTER (event_type <> 'purchase') AS state FROM events
GROUP BY user_id""")
def partial_update(t):
    rows = t.events.select(
        "user_id", "event_id",
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("paid"),
        F.nullif(F.col("event_type"), F.lit("purchase")).alias("state"),
    )
    return tbl.partial_update(rows, ["user_id"], ["event_id"], ["paid", "state"])


@query("k07_column_insert", """
WITH cur AS (SELECT c_custkey id, c_name nm, c_acctbal bal FROM customer WHERE c_acctbal > 0),
inc AS (SELECT c_custkey id, c_acctbal * 2 bal FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT coalesce(cur.id, inc.id) AS id, cur.nm AS nm,
  CASE WHEN inc.id IS NOT NULL THEN inc.bal ELSE cur.bal END AS bal
FROM cur FULL JOIN inc ON cur.id = inc.id""")
def column_insert(t):
    current = t.customer.filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nm"), F.col("c_acctbal").alias("bal")
    )
    incoming = t.customer.filter("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("id"), (F.col("c_acctbal") * 2).alias("bal")
    )
    return tbl.insert_columns(current, incoming, ["id"], ["bal"])


@query("k08_update_delete", f"""
SELECT o_orderstatus, count(*) AS n, {SUM('p')} AS total FROM (SELECT o_orderstatus,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN o_totalprice * 2
    ELSE o_totalprice END AS p FROM orders
  WHERE NOT (o_orderstatus = 'O' AND o_totalprice < 50000)) GROUP BY o_orderstatus""")
def update_delete(t):
    """UPDATE and DELETE rewrite the partitions they touch and no other."""
    name = f"{managed_database(t.spark, 'dml')}.orders_t"
    t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice", "o_orderstatus").write.option(
        "compression", "snappy").partitionBy("o_orderstatus").saveAsTable(name)
    tbl.update_where(
        t.spark, name,
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT"),
        {"o_totalprice": F.col("o_totalprice") * 2})
    tbl.delete_where(
        t.spark, name, (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") < 50000))
    return totals(t.spark.table(name))


@query("k08_delete_partition", f"""
SELECT o_orderstatus, count(*) AS n, {SUM('o_totalprice')} AS total FROM orders
WHERE o_orderstatus <> 'O' GROUP BY o_orderstatus""")
def delete_partition(t):
    """A DELETE that takes every row of a partition leaves it empty."""
    name = f"{managed_database(t.spark, 'dmlall')}.orders_t"
    t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").write.partitionBy(
        "o_orderstatus").saveAsTable(name)
    tbl.delete_where(t.spark, name, F.col("o_orderstatus") == "O")
    return totals(t.spark.table(name))


@query("k09_as_of_commit", f"WITH {CHANGES_SQL} SELECT * FROM {STATE_SQL('commit_id <= 9')}")
def as_of_commit(t):
    return tbl.as_of(
        changes(t), ["user_id"], "op", "commit_id", ["event_id"], F.lit(9), ["event_type", "value"])


@query("k09_as_of_time", f"""WITH {CHANGES_SQL}
SELECT * FROM {STATE_SQL("commit_id <= 14")}""")
def as_of_time(t):
    """The commit is the last one finished by the asked time (a day's last change)."""
    rows = changes(t)
    commits = rows.groupBy("commit_id").agg(F.max("ts").alias("done"))
    at = tbl.commit_at(
        commits, "commit_id", "done", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    )
    return tbl.as_of(
        rows, ["user_id"], "op", "commit_id", ["event_id"], at, ["event_type", "value"])


@query("k10_incremental", f"""
WITH {CHANGES_SQL} SELECT 'open' AS rule, commit_id, op, count(*) AS n FROM ch
WHERE commit_id > 5 AND commit_id <= 8 GROUP BY commit_id, op
UNION ALL SELECT 'closed', commit_id, op, count(*) FROM ch
WHERE commit_id BETWEEN 5 AND 8 GROUP BY commit_id, op""")
def incremental(t):
    rows = changes(t)

    def part(label, include):
        found = tbl.between_commits(rows, "commit_id", F.lit(5), F.lit(8), include)
        return found.groupBy(F.lit(label).alias("rule"), "commit_id", "op").agg(
            F.count("*").alias("n"))

    return part("open", False).unionByName(part("closed", True))


CHANGELOG_SQL = """
WITH {ch}, a AS (SELECT * FROM {old}), b AS (SELECT * FROM {new})
SELECT '+I' AS op, b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = b.user_id)
UNION ALL SELECT '-D', a.* FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.user_id = b.user_id)
UNION ALL SELECT '-U', a.* FROM a JOIN b USING (user_id)
  WHERE a.event_type <> b.event_type OR a.value <> b.value
UNION ALL SELECT '+U', b.* FROM b JOIN a USING (user_id)
  WHERE a.event_type <> b.event_type OR a.value <> b.value"""


@query("k11_changelog", CHANGELOG_SQL.format(
    ch=CHANGES_SQL, old=STATE_SQL("commit_id <= 9"), new=STATE_SQL("commit_id <= 10")))
def changelog(t):
    rows = changes(t)

    def state(v):
        return tbl.as_of(rows, ["user_id"], "op", "commit_id", ["event_id"], F.lit(v),
                         ["event_type", "value"])

    return tbl.changelog(state(9), state(10), ["user_id"])


@query("k12_audit_commits", f"""
WITH {CHANGES_SQL} SELECT commit_id, count(*) AS n, count(*) FILTER (op = '-D') AS deletes,
  min(event_id) AS first_id FROM ch GROUP BY commit_id""")
def audit_commits(t):
    return changes(t).groupBy("commit_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("op") == "-D").alias("deletes"),
        F.min("event_id").alias("first_id"),
    )


@query("k13_expired_commits", f"""
WITH {CHANGES_SQL}, c AS (SELECT commit_id, max(ts) AS done FROM ch GROUP BY commit_id),
m AS (SELECT max(commit_id) AS latest FROM c),
y AS (SELECT min(commit_id) AS x FROM c, m WHERE commit_id BETWEEN latest - 9 AND latest - 2
  AND TIMESTAMP '2024-01-31 00:00:00' - done <= INTERVAL 120 HOUR)
SELECT commit_id FROM c, m, y WHERE commit_id < coalesce(x, latest - 1)""")
def expired_commits(t):
    commits = changes(t).groupBy("commit_id").agg(F.max("ts").alias("done"))
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return tbl.expired_commits(
        commits, "commit_id", "done", 2, 10, "INTERVAL '5' DAY", now
    ).select("commit_id")


@query("k13_expired_partitions", """
SELECT day FROM (SELECT day, row_number() OVER (ORDER BY day DESC) rn FROM (
  SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM events))
WHERE rn > 20 OR date_diff('day', CAST(day AS DATE), DATE '2024-02-05') > 18""")
def expired_partitions(t):
    days = t.events.select(day_text("ts").alias("day")).distinct()
    return tbl.expired_partitions(days, "day", F.lit("2024-02-05").cast("date"), 18, 20)


@query("k14_dictionary", """
WITH old AS (SELECT DISTINCT p_name k FROM part WHERE p_size <= 10),
o AS (SELECT k, row_number() OVER (ORDER BY substr(md5(k), 1, 4), k) AS id FROM old),
f AS (SELECT DISTINCT p_name k FROM part WHERE p_name NOT IN (SELECT k FROM old))
SELECT k AS p_name, id AS name_id FROM o UNION ALL
SELECT k, row_number() OVER (ORDER BY substr(md5(k), 1, 4), k) + (SELECT count(*) FROM o) FROM f""")
def dictionary(t):
    """A second load adds ids after the first one's; known keys keep theirs."""
    empty = t.part.select("p_name", F.lit(0).cast("bigint").alias("name_id")).filter("false")
    first = extend_dictionary(empty, t.part.filter("p_size <= 10"), "p_name", "name_id")
    return extend_dictionary(first, t.part, "p_name", "name_id")


def _daily(base, dims):
    names = dims["kinds"]
    return base.join(names, "event_type", "left").groupBy("dt", "label").agg(
        F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("total")
    )


def _kinds(t, suffix=""):
    return t.events.select("event_type").distinct().withColumn(
        "label", F.concat(F.upper("event_type"), F.lit(suffix)))


DAILY_SQL = f"""
SELECT strftime(ts, '%Y-%m-%d') AS dt, upper(event_type) AS label, count(*) AS n,
  {SUM('value')} AS total FROM (SELECT * FROM events
  UNION ALL SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-07')
GROUP BY 1, 2"""


@query("k15_full_refresh", DAILY_SQL)
def full_refresh(t):
    base = t.events.withColumn("dt", day_text("ts"))
    base = base.unionByName(base.filter("dt = '2024-01-07'"))
    mv = DerivedTable(t.spark, f"{managed_database(t.spark, 'mvfull')}.daily", "dt",
                      F.col("dt"), _daily)
    mv.refresh(base, {"kinds": _kinds(t)})
    assert mv.refresh(base, {"kinds": _kinds(t)})["state"] == "unchanged"
    return mv.read()


def _base_table(t, rows, label, part):
    """A managed base table partitioned by ``part``."""
    name = f"{managed_database(t.spark, label)}.base"
    rebalanced(rows, part).write.partitionBy(part).saveAsTable(name)
    return name


def _folder(t, table):
    rows = t.spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return rows.where("col_name = 'Location'").first()["data_type"]


def _refresh_twice(t, mv, base, extra, part, expected):
    """Refresh, append to one partition, refresh again: only that one is rewritten."""
    mv.refresh(t.spark.table(base), {"kinds": _kinds(t)})
    extra.select(*t.spark.table(base).columns).write.mode("append").insertInto(base)
    t.spark.catalog.refreshTable(base)
    status = mv.refresh(t.spark.table(base), {"kinds": _kinds(t)})
    if not set(status["partitions"]) <= {expected}:
        raise AssertionError(f"refreshed {status['partitions']}")
    t.spark.catalog.refreshTable(mv.table)
    return mv.read()


@query("k16_partition_refresh", DAILY_SQL)
def partition_refresh(t):
    """One changed day rewrites one day; changes are found from the files."""
    rows = t.events.select("event_type", "value", day_text("ts").alias("dt"))
    base = _base_table(t, rows, "mvpart", "dt")
    mv = DerivedTable(t.spark, base.replace(".base", ".daily"), "dt", F.col("dt"), _daily,
                      files=_folder(t, base))
    return _refresh_twice(t, mv, base, rows.filter("dt = '2024-01-07'"), "dt", "2024-01-07")


@query("k17_rollup_refresh", f"""
SELECT strftime(ts, '%Y-%m') AS month, event_type, count(*) AS n, {SUM('value')} AS total
FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-07')
GROUP BY 1, 2""")
def rollup_refresh(t):
    """A changed day refreshes the month it belongs to."""
    rows = t.events.select("event_type", "value", day_text("ts").alias("dt"))
    base = _base_table(t, rows, "mvmonth", "dt")
    month = F.substring("dt", 1, 7)
    mv = DerivedTable(
        t.spark, base.replace(".base", ".monthly"), "month", month,
        lambda b, _: b.groupBy("event_type", month.alias("month")).agg(
            F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("total")),
        files=_folder(t, base))
    return _refresh_twice(t, mv, base, rows.filter("dt = '2024-01-07'"), "month", "2024-01")


@query("k18_limited_refresh", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, upper(event_type) || CASE WHEN CAST(ts AS DATE) >=
  (SELECT max(CAST(ts AS DATE)) - 2 FROM events) THEN '!' ELSE '' END AS label, count(*) AS n
FROM events GROUP BY 1, 2""")
def limited_refresh(t):
    """A changed dimension would refresh all days; the limit takes the newest three."""
    base = t.events.withColumn("dt", day_text("ts"))
    mv = DerivedTable(t.spark, f"{managed_database(t.spark, 'mvlimit')}.daily", "dt",
                      F.col("dt"), _daily, limit=3)
    mv.refresh(base, {"kinds": _kinds(t)})
    mv.refresh(base, {"kinds": _kinds(t, "!")})
    t.spark.catalog.refreshTable(mv.table)
    return mv.read().select("dt", "label", "n")


@query("k18_limit_then_rest", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, upper(event_type) || '!' AS label, count(*) AS n
FROM events GROUP BY 1, 2""")
def limit_then_rest(t):
    """Days left out by the limit stay stale; a refresh without limit takes them."""
    base = t.events.withColumn("dt", day_text("ts"))
    mv = DerivedTable(t.spark, f"{managed_database(t.spark, 'mvrest')}.daily", "dt",
                      F.col("dt"), _daily, limit=3)
    mv.refresh(base, {"kinds": _kinds(t)})
    left_out = mv.refresh(base, {"kinds": _kinds(t, "!")})["skipped"]
    mv.limit = None
    if mv.refresh(base, {"kinds": _kinds(t, "!")})["partitions"] != left_out:
        raise AssertionError("the days left out were not refreshed")
    return mv.read().select("dt", "label", "n")


@query("k16_emptied_day", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, upper(event_type) AS label, count(*) AS n
FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-07' GROUP BY 1, 2""")
def emptied_day(t):
    """A changed day of which nothing is left in the result loses its rows."""
    base = t.events.withColumn("dt", day_text("ts"))
    name = f"{managed_database(t.spark, 'mvempty')}.daily"
    mv = DerivedTable(t.spark, name, "dt", F.col("dt"),
                      lambda b, d: _daily(b.filter("value is not null"), d))
    mv.refresh(base, {"kinds": _kinds(t)})
    day = F.col("dt") == "2024-01-07"
    changed = base.withColumn("value", F.when(~day, F.col("value")))
    mv.refresh(changed, {"kinds": _kinds(t)})
    return mv.read().select("dt", "label", "n")


@query("k15_second_session", DAILY_SQL)
def second_session(t):
    """A new object on the same table knows what the first one has done."""
    base = t.events.withColumn("dt", day_text("ts"))
    name = f"{managed_database(t.spark, 'mvsecond')}.daily"
    DerivedTable(t.spark, name, "dt", F.col("dt"), _daily).refresh(base, {"kinds": _kinds(t)})
    more = base.unionByName(base.filter("dt = '2024-01-07'"))
    second = DerivedTable(t.spark, name, "dt", F.col("dt"), _daily)
    if not set(second.refresh(more, {"kinds": _kinds(t)})["partitions"]) <= {"2024-01-07"}:
        raise AssertionError("the second object started anew")
    return second.read()


@query("k19_load_labels", """
SELECT 'FINISHED' AS state, 'load_a' AS label, (SELECT count(*) FROM orders) AS scan_rows,
  (SELECT count(*) FROM orders WHERE o_totalprice < 1000) AS filtered_rows,
  (SELECT count(*) FROM orders WHERE NOT o_totalprice < 1000) AS sink_rows
UNION ALL SELECT 'CANCELLED', 'load_a', 0, 0, 0""")
def load_labels(t):
    """First try fails on its error budget, the second succeeds, a third is refused."""
    root = work_dir(t.spark, "labels")
    ledger = LoadLedger(t.spark, f"{root}/ledger")
    bad = F.col("o_totalprice") < 1000

    def load(ratio):
        def run(folder):
            report = tbl.load_gate(t.orders, bad, ratio)
            good, _ = tbl.split_rejects(t.orders, bad)
            good.write.mode("overwrite").parquet(folder)
            return report
        return run

    for ratio in (-1.0, 1.0, 1.0):
        try:
            ledger.run("load_a", load(ratio))
        except (tbl.LoadRejected, LabelUsed):
            continue
    return ledger.entries().select("state", "label", "scan_rows", "filtered_rows", "sink_rows")


@query("k20_quality_gate", """
SELECT CASE WHEN event_type = 'error' THEN 'rejected' ELSE 'loaded' END AS side, count(*) AS n,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1""")
def quality_gate(t):
    """Rows without a key are rejected and kept in a reject log."""
    rows = t.events.withColumn(
        "key", F.when(F.col("event_type") != "error", F.col("event_id")))
    bad = F.col("key").isNull()
    tbl.load_gate(rows, bad, 0.5)
    good, rejected = tbl.split_rejects(rows, bad)
    root = work_dir(t.spark, "gate")
    good.write.parquet(f"{root}/side=loaded")
    rejected.write.parquet(f"{root}/side=rejected")
    return t.spark.read.parquet(root).groupBy("side").agg(
        F.count("*").alias("n"), exact_sum("value").alias("total"))


@query("k21_load_aggregate", """
SELECT strftime(ts, '%Y-%m-%d') AS dt, CAST(json_extract_string(props, '$.k') AS INT) AS k,
  count(*) AS cnt FROM events GROUP BY 1, 2""")
def load_aggregate(t):
    rows = t.events.select(
        day_text("ts").alias("dt"), F.from_json("props", "k int")["k"].alias("k"),
        F.lit(1).cast("bigint").alias("cnt"),
    )
    return tbl.aggregate_merge([rows], ["dt", "k"], {"cnt": "sum"})


@query("k22_partition_ddl", """
SELECT event_type, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'view')
GROUP BY event_type""")
def partition_ddl(t):
    """Add, truncate, drop and repair partitions of a managed table."""
    name = f"{managed_database(t.spark, 'ddl')}.ev"
    sql = t.spark.sql
    sql(f"CREATE TABLE {name} (event_id BIGINT, event_type STRING) USING parquet "
        "PARTITIONED BY (event_type)")
    sql(f"ALTER TABLE {name} ADD PARTITION (event_type='none')")
    overwrite_partitions(t.events.select("event_id", "event_type"), name)
    sql(f"MSCK REPAIR TABLE {name}")
    sql(f"TRUNCATE TABLE {name} PARTITION (event_type='error')")
    sql(f"ALTER TABLE {name} DROP PARTITION (event_type='view')")
    shown = {r[0] for r in sql(f"SHOW PARTITIONS {name}").collect()}
    if "event_type=none" not in shown or "event_type=view" in shown:
        raise AssertionError(sorted(shown))
    return t.spark.table(name).groupBy("event_type").agg(F.count("*").alias("n"))


@query("k23_create_as", STATUS_TOTALS)
def create_as(t):
    """CTAS in another format, LIKE, a path table, and drop."""
    db = managed_database(t.spark, "ctas")
    sql = t.spark.sql
    sql(f"CREATE TABLE {db}.a USING orc PARTITIONED BY (o_orderstatus) AS "
        "SELECT o_orderkey, o_totalprice, o_orderstatus FROM {orders}", orders=t.orders)
    sql(f"CREATE TABLE {db}.b LIKE {db}.a")
    with overwrite_mode(t.spark, "dynamic"):
        sql(f"INSERT INTO {db}.b SELECT * FROM {db}.a")
    sql(f"DROP TABLE {db}.a")
    out = work_dir(t.spark, "external")
    sql(f"CREATE TABLE {db}.c USING parquet LOCATION '{out}' AS SELECT * FROM {db}.b")
    sql(f"DROP TABLE {db}.c")
    return totals(t.spark.read.parquet(out))


@query("k24_schema_change", """
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END
  AS priority FROM orders""")
def schema_change(t):
    """A column added later is null in older files; a rename is a select."""
    name = f"{managed_database(t.spark, 'evolve')}.orders_t"
    t.spark.sql(f"CREATE TABLE {name} (o_orderkey BIGINT, o_orderstatus STRING) USING parquet")
    t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus").write.insertInto(
        name)
    t.spark.sql(f"ALTER TABLE {name} ADD COLUMNS (o_orderpriority STRING)")
    t.orders.filter("o_orderstatus <> 'F'").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority").write.insertInto(name)
    return t.spark.table(name).withColumnRenamed("o_orderpriority", "priority")


@query("k25_text_to_orc", f"""
SELECT dept_no, count(*) AS n, {SUM('salary')} AS total FROM {EMPLOYEES_SQL} GROUP BY dept_no""")
def text_to_orc(t):
    root = work_dir(t.spark, "convert")
    t.employees.select("emp_no", "emp_name", "salary", "dept_no").write.option("sep", ",").csv(
        f"{root}/text")
    schema = "emp_no BIGINT, emp_name STRING, salary DOUBLE, dept_no INT"
    t.spark.read.schema(schema).csv(f"{root}/text").write.partitionBy("dept_no").orc(f"{root}/orc")
    return t.spark.read.orc(f"{root}/orc").groupBy("dept_no").agg(
        F.count("*").alias("n"), exact_sum("salary").alias("total"))


@query("k26_partition_routing", """
SELECT coalesce(CASE WHEN o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'
    THEN 'p96' WHEN o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '2000-01-01'
    THEN 'p98' END, 'rejected') AS range_part,
  coalesce(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pHigh'
    WHEN o_orderpriority IN ('3-MEDIUM', '5-LOW') THEN 'pLow' END, 'rejected') AS list_part,
  count(*) AS n FROM orders GROUP BY 1, 2""")
def partition_routing(t):
    rows = tbl.route_ranges(
        t.orders, F.date_format("o_orderdate", "yyyy-MM-dd"),
        [("p96", "1996-01-01", "1998-01-01"), ("p98", "1998-01-01", "2000-01-01")], "rp")
    rows = tbl.route_list(
        rows, F.col("o_orderpriority"),
        {"pHigh": ["1-URGENT", "2-HIGH"], "pLow": ["3-MEDIUM", "5-LOW"]}, "lp")
    return rows.groupBy(
        F.coalesce("rp", F.lit("rejected")).alias("range_part"),
        F.coalesce("lp", F.lit("rejected")).alias("list_part"),
    ).agg(F.count("*").alias("n"))


CELLS_SQL = """c AS (SELECT CAST(user_id AS VARCHAR) AS rowkey, 'info' AS family,
  event_type AS qualifier, epoch_ms(date_trunc('hour', ts)) AS ts, CAST(value AS VARCHAR) AS value,
  event_id FROM events)"""


def event_cells(t):
    """Each event writes one cell; the hour is its version, so versions collide."""
    return t.events_ts.select(
        F.col("user_id").cast("string").alias("rowkey"), F.lit("info").alias("family"),
        F.col("event_type").alias("qualifier"),
        F.unix_millis(F.date_trunc("hour", "ts")).alias("ts"),
        F.col("value").cast("string").alias("value"), "event_id",
    )


@query("k27_cell_versions", f"""
WITH {CELLS_SQL}, d AS (SELECT rowkey, family, qualifier, ts, arg_max(value, event_id) AS value
  FROM c GROUP BY ALL)
SELECT rowkey, qualifier, ts, value FROM (SELECT *, row_number() OVER (
  PARTITION BY rowkey, family, qualifier ORDER BY ts DESC) rn FROM d
  WHERE ts > 1706659200000 - 1296000000) WHERE rn <= 3""".replace(
    "GROUP BY ALL", "GROUP BY rowkey, family, qualifier, ts"))
def cell_versions(t):
    """Three versions, fifteen days to live, last write of a version survives."""
    cells = cell.dedup_writes(event_cells(t), "event_id")
    live = cell.unexpired(cells, F.lit(1706659200000), 15 * 86400 * 1000)
    return cell.newest_versions(live, 3).select("rowkey", "qualifier", "ts", "value")


@query("k27_cell_deletes", f"""
WITH {CELLS_SQL}, d AS (SELECT rowkey, family, qualifier, ts, arg_max(value, event_id) AS value
  FROM c GROUP BY rowkey, family, qualifier, ts),
s AS (SELECT rowkey, max(ts) AS ts FROM d WHERE qualifier = 'signup' GROUP BY rowkey),
v AS (SELECT rowkey, max(ts) - 864000000 AS ts FROM d WHERE qualifier = 'view' GROUP BY rowkey),
f AS (SELECT rowkey, max(ts) - 1728000000 AS ts FROM d GROUP BY rowkey)
SELECT d.rowkey, d.qualifier, d.ts, d.value FROM d
LEFT JOIN s ON d.rowkey = s.rowkey AND d.qualifier = 'signup' AND d.ts = s.ts
LEFT JOIN v ON d.rowkey = v.rowkey AND d.qualifier = 'view' AND d.ts <= v.ts
LEFT JOIN f ON d.rowkey = f.rowkey AND d.ts <= f.ts
WHERE s.ts IS NULL AND v.ts IS NULL AND f.ts IS NULL""")
def cell_deletes(t):
    """One version, all versions of a column, and a whole family are deleted per row."""
    cells = cell.dedup_writes(event_cells(t), "event_id")

    def marker(kind, only, back):
        rows = cells.filter(F.col("qualifier") == only) if only else cells
        return rows.groupBy("rowkey", "family", *(["qualifier"] if only else [])).agg(
            (F.max("ts") - back).alias("ts")
        ).select("rowkey", "family", F.lit(only).alias("qualifier"), "ts", F.lit(kind).alias("kind"))

    markers = (
        marker("version", "signup", 0)
        .unionByName(marker("column", "view", 864000000))
        .unionByName(marker("family", None, 1728000000))
    )
    return cell.apply_deletes(cells, markers).select("rowkey", "qualifier", "ts", "value")


@query("k28_skipping_layout", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_partkey BETWEEN 100 AND 140 AND l_suppkey = 7""")
def skipping_layout(t):
    """Sorted by the filter column so row-group min/max skip; bloom filter on the other."""
    out = work_dir(t.spark, "layout")
    (t.lineitem.repartitionByRange("l_partkey", "l_orderkey")
     .sortWithinPartitions("l_partkey", "l_suppkey")
     .write.option("parquet.bloom.filter.enabled#l_suppkey", "true").parquet(out))
    return t.spark.read.parquet(out).filter(
        F.col("l_partkey").between(100, 140) & (F.col("l_suppkey") == 7)
    ).select("l_orderkey", "l_linenumber", "l_partkey")
