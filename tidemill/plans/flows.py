"""Compositions of the operators (L)."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import exact_avg, ts_text
from tidemill.operators import tables as tbl
from tidemill.operators.distinct import extend_dictionary
from tidemill.operators.joining import dict_mapping
from tidemill.operators.ordered import running, with_group_stats
from tidemill.plans.lifecycle import CHANGELOG_SQL, CHANGES_SQL, STATE_SQL
from tidemill.session import checkpointed, work_dir
from tidemill.sources import changes as chg
from tidemill.sources import jsonio
from tidemill.sources import text as txt
from tidemill.streaming.runner import run_batches
from tidemill.streaming.sinks import BudgetedLoad, UpsertLog

SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')".format


@query("l01_window_to_keyed_sink", f"""
WITH e AS (SELECT *, time_bucket(INTERVAL 10 SECOND, ts, TIMESTAMP '1970-01-01') AS w FROM events)
SELECT user_id, {TS('w')} AS window_start, count(*) AS n,
  string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM e
WHERE w + INTERVAL 10 SECOND <= (SELECT max(ts) FROM events) - INTERVAL 30 SECOND
GROUP BY user_id, w""")
def window_to_keyed_sink(t):
    rows = (
        t.events_stream.withWatermark("ts", "30 seconds")
        .groupBy(F.window("ts", "10 seconds"), "user_id")
        .agg(F.count("*").alias("n"),
             F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types"))
        .select("user_id", ts_text("window.start").alias("window_start"), "n", "types")
    )
    log = UpsertLog(t.spark, work_dir(t.spark, "l01"), ["user_id", "window_start"])
    run_batches(rows, log.upsert, "l01")
    return log.current()


@query("l02_route_sites", """
WITH s AS (SELECT p_partkey, string_split(p_name, ' ') AS a FROM part),
x AS (SELECT p_partkey, a, unnest(range(1, len(a) + 1)) AS i FROM s),
y AS (SELECT p_partkey, i - 1 AS pos, a[i] AS site, len(a) AS cnt,
  CASE WHEN i > 1 THEN a[i - 1] END AS upstream, CASE WHEN i < len(a) THEN a[i + 1] END AS downstream
  FROM x)
SELECT p_partkey, CAST(pos AS INT) AS pos, site, upstream, downstream, CAST(cnt AS INT) AS cnt,
  count(*) OVER (PARTITION BY site) AS site_cnt FROM y""")
def route_sites(t):
    """Neighbours come from the array itself, so only the per-site count shuffles."""
    sites = F.split("p_name", " ")
    rows = t.part.select("p_partkey", sites.alias("sites"), F.posexplode(sites).alias("pos", "site"))
    rows = rows.select(
        "p_partkey", "pos", "site",
        F.when(F.col("pos") > 0, F.get("sites", F.col("pos") - 1)).alias("upstream"),
        F.get("sites", F.col("pos") + 1).alias("downstream"), F.size("sites").alias("cnt"))
    return with_group_stats(rows, ["site"], [F.count("*").alias("site_cnt")])


@query("l03_department_levels", f"""
SELECT dept_no, dept_name, 'L' || CAST(floor(avg_salary / 1000) AS BIGINT) AS level FROM (
  SELECT dept_no, dept_name, {SUM('salary')} / count(*) AS avg_salary FROM {EMPLOYEES_SQL}
  GROUP BY dept_no, dept_name)""")
def department_levels(t):
    means = t.employees.groupBy("dept_no", "dept_name").agg(exact_avg("salary").alias("m"))
    level = F.concat(F.lit("L"), F.floor(F.col("m") / 1000).cast("string"))
    return means.select("dept_no", "dept_name", level.alias("level"))


@query("l04_backfill_per_window", f"""
WITH e AS (SELECT *, CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE value END AS v FROM events),
h AS (SELECT user_id, ts, event_id, coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id
  ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) AS filled FROM e)
SELECT user_id, {TS("date_trunc('day', ts)")} AS window_start,
  arg_max(filled, event_id) FILTER (filled IS NOT NULL) AS last_filled
FROM h GROUP BY user_id, date_trunc('day', ts)""")
def backfill_per_window(t):
    rows = t.events_ts.withColumn(
        "v", F.when(~F.col("event_type").isin("view", "error"), F.col("value")))
    rows = running(
        rows, ["user_id"], [F.col("ts"), F.col("event_id")], [F.date_trunc("hour", F.col("ts"))],
        {"hist": ("last_value", F.col("v"))},
    ).withColumn("filled", F.coalesce("v", "hist"))
    return rows.groupBy("user_id", F.window("ts", "1 day").alias("w")).agg(
        F.max_by("filled", F.when(F.col("filled").isNotNull(), F.col("event_id")))
        .alias("last_filled")
    ).select("user_id", ts_text("w.start").alias("window_start"), "last_filled")


@query("l05_exact_distinct", """
SELECT lang, count(DISTINCT source) AS plain, count(DISTINCT source) AS through_bitmap
FROM documents GROUP BY lang""")
def exact_distinct(t):
    """Dictionary, mapping and bitmap count next to the plain distinct count.

    The dictionary is written once and the rows are encoded once; both counts come from the encoded
    rows. Ids and sources match one to one, so distinct sources add up over the id buckets.
    """
    docs = t.documents.select("lang", "source")
    empty = docs.select("source", F.lit(0).cast("bigint").alias("sid")).filter("false")
    words = checkpointed(extend_dictionary(empty, docs, "source", "sid"))
    coded = dict_mapping(docs, words, [("source", "source")], "sid", "id", null_if_missing=False)
    parts = coded.groupBy("lang", F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"),
        F.count_distinct("source").alias("n"))
    return parts.groupBy("lang").agg(
        F.sum("n").alias("plain"), F.sum(F.bitmap_count("bits")).alias("through_bitmap"))


@query("l06_log_load", """
SELECT user_id AS erp, strftime(ts, '%Y-%m-%d') AS dt, count(*) AS cnt,
  max(CAST(json_extract_string(props, '$.k') AS INT)) AS top_k
FROM events WHERE event_type <> 'error' GROUP BY 1, 2""")
def log_load(t):
    """Log lines with nested parameters; broken lines count against the budget."""
    doc = F.to_json(F.struct(
        F.col("user_id").alias("erp"), ts_text("ts").alias("invoke_tm"),
        F.from_json("props", "k int").alias("params")))
    broken = F.when(F.col("event_type") == "error", F.substring(doc, 1, 10)).otherwise(doc)
    lines = t.events_stream.select(broken.alias("doc"))
    fields = jsonio.json_columns(lines, "doc", {
        "erp": ("$.erp", "bigint"), "invoke_tm": ("$.invoke_tm", "string"),
        "k": ("$.params.k", "int")}).drop("doc")
    load = BudgetedLoad(t.spark, work_dir(t.spark, "l06"), F.col("invoke_tm").isNull(),
                        max_ratio=0.5)
    run_batches(fields, load.process, "l06")
    rows = load.rows().select(
        "erp", F.substring("invoke_tm", 1, 10).alias("dt"), F.lit(1).cast("bigint").alias("cnt"),
        F.col("k").alias("top_k"))
    return tbl.aggregate_merge([rows], ["erp", "dt"], {"cnt": "sum", "top_k": "max"})


@query("l07_change_join_summary", f"""
WITH o AS (SELECT o_custkey AS id, count(*) AS n, {SUM('o_totalprice')} AS total FROM orders
  WHERE o_orderstatus <> 'P' GROUP BY 1)
SELECT coalesce(c.c_mktsegment, 'none') AS segment, count(*) AS rows_n, count(o.id) AS with_orders,
  CAST(sum(coalesce(o.n, 0)) AS BIGINT) AS orders FROM customer c
FULL JOIN o ON c.c_custkey = o.id GROUP BY 1""")
def change_join_summary(t):
    """Two change streams decoded to current rows, fully joined and summarised.

    Orders in state ``P`` have been inserted and deleted again.
    """
    row = F.struct(F.col("o_orderkey").cast("string").alias("id"),
                   F.col("o_custkey").cast("string").alias("cust"))
    record = F.to_json(F.struct(F.lit("INSERT").alias("type"), F.array(row).alias("data")))
    removal = F.to_json(F.struct(F.lit("DELETE").alias("type"), F.array(row).alias("data")))
    docs = t.orders.select(F.col("o_orderkey").alias("at"), record.alias("doc")).unionByName(
        t.orders.filter("o_orderstatus = 'P'").select(
            (F.col("o_orderkey") + 10**12).alias("at"), removal.alias("doc")))
    ops = chg.decode_row_images(docs, "doc", "id BIGINT, cust BIGINT", "at")
    empty = ops.select("id", "cust").filter("false")
    orders = tbl.apply_ops(empty, ops, ["id"], "op", ["seq"])
    per_cust = orders.groupBy("cust").agg(F.count("*").alias("n"))
    both = t.customer.join(per_cust, F.col("c_custkey") == F.col("cust"), "full")
    return both.groupBy(F.coalesce("c_mktsegment", F.lit("none")).alias("segment")).agg(
        F.count("*").alias("rows_n"), F.count("cust").alias("with_orders"),
        F.sum(F.coalesce("n", F.lit(0))).alias("orders"))


@query("l08_employee_families", f"""
WITH e AS (SELECT * FROM {EMPLOYEES_SQL}), s AS (SELECT dept_name, count(*) AS n,
  {SUM('salary')} / count(*) AS avg_salary FROM e GROUP BY dept_name),
r AS (SELECT dept_name, emp_no, row_number() OVER (PARTITION BY dept_name ORDER BY salary DESC, emp_no)
  AS rn FROM e)
SELECT dept_name, n, avg_salary, rn, emp_no FROM s JOIN r USING (dept_name) WHERE rn <= 3""")
def employee_families(t):
    """File to family structs, then count, mean and the top three per department."""
    out = work_dir(t.spark, "l08")
    t.employees.select("emp_no", "emp_name", "dept_no", "dept_name", "salary").write.csv(out)
    rows = txt.delimited(
        t.spark, out,
        "emp_no BIGINT, emp_name STRING, dept_no INT, dept_name STRING, salary DOUBLE")
    wide = rows.select(
        F.struct("emp_no", "emp_name").alias("base"), F.struct("dept_no", "dept_name").alias("dept"),
        F.struct(F.col("salary").cast("string").alias("salary")).alias("info"))
    flat = wide.select("base.emp_no", "dept.dept_name",
                       F.col("info.salary").cast("double").alias("salary"))
    summary = flat.groupBy("dept_name").agg(
        F.count("*").alias("n"), exact_avg("salary").alias("avg_salary"))
    w = Window.partitionBy("dept_name").orderBy(F.desc("salary"), "emp_no")
    top = flat.withColumn("rn", F.row_number().over(w)).filter("rn <= 3").select(
        "dept_name", "emp_no", F.col("rn").cast("bigint").alias("rn"))
    return summary.join(top, "dept_name")


@query("l09_state_and_changelog", f"SELECT * FROM ({CHANGELOG_SQL.format(ch=CHANGES_SQL, old=STATE_SQL('commit_id <= 20'), new=STATE_SQL('commit_id <= 22'))})")
def state_and_changelog(t):
    """Change stream to a keyed table; its log gives two states and their difference."""
    rows = t.events_stream
    kind = F.col("event_type")
    stream = rows.select(
        "user_id", "event_type", "value", "event_id",
        F.when(kind == "signup", "+I").when(kind == "error", "-D").otherwise("+U").alias("op"),
        (F.datediff("ts", F.lit("2024-01-01").cast("date")) + 1).cast("bigint")
        .alias("commit_id"))
    log = UpsertLog(t.spark, work_dir(t.spark, "l09"), ["user_id", "commit_id"], seq=["event_id"])
    run_batches(stream, log.upsert, "l09")
    stored = log.current()

    def state(at):
        return tbl.as_of(stored, ["user_id"], "op", "commit_id", ["event_id"], F.lit(at),
                         ["event_type", "value"])

    return tbl.changelog(state(20), state(22), ["user_id"])
