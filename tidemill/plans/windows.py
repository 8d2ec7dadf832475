"""Window queries (F), written so that a hot key does not land in one task."""

from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import exact_avg, exact_sum, money
from tidemill.operators.ordered import framed, ranks, row_numbers, running, with_group_stats


def hour():
    return [F.date_trunc("hour", F.col("ts"))]


def by_time():
    return [F.col("ts"), F.col("event_id")]


@query("f01_row_number", """
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_num
FROM events""")
def row_number(t):
    return row_numbers(t.events, ["user_id"], by_time(), hour()).select("event_id", "row_num")


@query("f02_rank", """
SELECT l_orderkey, l_linenumber, l_partkey,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS rnk,
  dense_rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS dense_rnk FROM lineitem""")
def rank(t):
    """Ranks are placed on the distinct quantities and joined back."""
    return ranks(t.lineitem, ["l_returnflag"], "l_quantity").select("l_orderkey", "l_linenumber", "l_partkey", "rnk", "dense_rnk")


@query("f03_lead_lag", """
SELECT event_id, lead(event_type) OVER w AS next_type, lag(event_type) OVER w AS prev_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lead_lag(t):
    return framed(
        t.events, ["user_id"], by_time(), hour(), 1, 1,
        lambda w, _: {
            "next_type": F.lead("event_type").over(w),
            "prev_type": F.lag("event_type").over(w),
        },
    ).select("event_id", "next_type", "prev_type")


MONEY_OVER = "CAST(sum(CAST({0} AS DECIMAL(18,2))) OVER ({1}) AS DOUBLE)".format


@query("f04_sum_over", f"""
SELECT emp_no, {MONEY_OVER('salary', '')} AS all_sum,
  {MONEY_OVER('salary', 'PARTITION BY dept_no')} AS dept_sum,
  {MONEY_OVER('salary', 'ORDER BY salary, emp_no ROWS UNBOUNDED PRECEDING')} AS run_sum,
  {MONEY_OVER('salary', 'PARTITION BY dept_no ORDER BY salary, emp_no ROWS UNBOUNDED PRECEDING')}
    AS dept_run_sum
FROM {EMPLOYEES_SQL}""")
def sum_over(t):
    """Whole table, partition, order, and both; the whole-table sum is a scalar."""
    order = [F.col("salary"), F.col("emp_no")]
    pay = money("salary")
    rows = with_group_stats(t.employees, ["dept_no"], [exact_sum("salary").alias("dept_sum")])
    rows = running(rows, [], order, None, {"run_sum": ("sum", pay)})
    rows = running(rows, ["dept_no"], order, None, {"dept_run_sum": ("sum", pay)})
    total = t.employees.agg(exact_sum("salary")).scalar()
    return rows.select(
        "emp_no", total.alias("all_sum"), "dept_sum",
        F.col("run_sum").cast("double").alias("run_sum"),
        F.col("dept_run_sum").cast("double").alias("dept_run_sum"),
    )


@query("f05_rows_frames", f"""
SELECT o_orderkey,
  {MONEY_OVER('o_totalprice', 'ORDER BY o_totalprice, o_orderkey ROWS BETWEEN 2 PRECEDING AND 3 FOLLOWING')} AS near_sum,
  {MONEY_OVER('o_totalprice', 'PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING')} AS rest_sum
FROM orders""")
def rows_frames(t):
    order = [F.col("o_totalprice"), F.col("o_orderkey")]
    price = money("o_totalprice")
    rows = framed(
        t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), [], order, None,
        2, 3, lambda _, f: {"near_sum": F.sum(price).over(f).cast("double")},
    )
    rows = running(rows, ["o_orderstatus"], order, None, {"rest": ("sum", price)},
                   reverse=True)
    return rows.select("o_orderkey", "near_sum", F.col("rest").cast("double").alias("rest_sum"))


@query("f06_avg_min_count_over", """
SELECT event_id, count(*) OVER (PARTITION BY user_id) AS user_n,
  min(value) OVER w AS min_so_far, count(value) OVER w AS n_so_far,
  CAST(sum(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type) AS DOUBLE)
    / count(value) OVER (PARTITION BY event_type) AS type_avg
FROM events
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)""")
def avg_min_count_over(t):
    rows = running(
        t.events, ["user_id"], by_time(), hour(),
        {"min_so_far": ("min", F.col("value")), "n_so_far": ("count", F.col("value"))},
    )
    rows = with_group_stats(rows, ["user_id"], [F.count("*").alias("user_n")])
    rows = with_group_stats(rows, ["event_type"], [exact_avg("value").alias("type_avg")])
    return rows.select("event_id", "user_n", "min_so_far", "n_so_far", "type_avg")


@query("f07_running_last_value", """
WITH e AS (SELECT *, CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE value END AS v
  FROM events)
SELECT event_id, coalesce(v, last_value(v IGNORE NULLS) OVER (PARTITION BY user_id
  ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)) AS filled FROM e""")
def running_last_value(t):
    """Null values take the latest earlier value of the same key."""
    rows = t.events.withColumn(
        "v", F.when(~F.col("event_type").isin("view", "error"), F.col("value"))
    )
    rows = running(rows, ["user_id"], by_time(), hour(), {"hist": ("last_value", F.col("v"))})
    return rows.select("event_id", F.coalesce("v", "hist").alias("filled"))


@query("f08_running_list", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, string_agg(l_partkey, ',') OVER (
  PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice
  ROWS UNBOUNDED PRECEDING) AS elements FROM lineitem""")
def running_list(t):
    """All values so far. The list of a row is as long as its group, here the lines of an order."""
    lines = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"
    ).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.array_join(
            F.collect_list(F.col("l_partkey").cast("string")).over(lines), ",").alias("elements"))


NEWEST = """
SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY ts {0}, event_id {0}) AS rn FROM events) WHERE rn = 1""".format


@query("f09_newest_per_key", NEWEST("DESC"))
def newest_per_key(t):
    """The rank limit is applied before the shuffle as well (window group limit)."""
    w = Window.partitionBy("user_id").orderBy(F.desc("ts"), F.desc("event_id"))
    return (t.events.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
            .select("event_id", "user_id", "event_type"))


@query("f09_first_per_key", NEWEST("ASC"))
def first_per_key(t):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return (t.events.withColumn("rn", F.row_number().over(w)).filter("rn = 1")
            .select("event_id", "user_id", "event_type"))


@query("f10_top_n", f"""
SELECT dept_name, emp_no, rn FROM (SELECT dept_name, emp_no, row_number() OVER (
  PARTITION BY dept_name ORDER BY salary DESC, emp_no) AS rn FROM {EMPLOYEES_SQL}) WHERE rn <= 3""")
def top_n(t):
    w = Window.partitionBy("dept_name").orderBy(F.desc("salary"), "emp_no")
    return (t.employees.withColumn("rn", F.row_number().over(w)).filter("rn <= 3")
            .select("dept_name", "emp_no", F.col("rn").cast("bigint").alias("rn")))


@query("f11_row_vs_mean", f"""
SELECT emp_no, CASE WHEN salary > avg_salary THEN '1' ELSE '0' END AS above FROM (
  SELECT *, CAST(sum(CAST(salary AS DECIMAL(18,2))) OVER (PARTITION BY dept_no) AS DOUBLE)
    / count(*) OVER (PARTITION BY dept_no) AS avg_salary FROM {EMPLOYEES_SQL})""")
def row_vs_mean(t):
    rows = with_group_stats(t.employees, ["dept_no"], [exact_avg("salary").alias("avg_salary")])
    return rows.select(
        "emp_no", F.when(F.col("salary") > F.col("avg_salary"), "1").otherwise("0").alias("above")
    )
