"""Join queries (D); stream forms are in :mod:`tidemill.plans.streams`."""

from pyspark.sql import functions as F

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import exact_avg, exact_sum, money, ts_text
from tidemill.operators.joining import asof_join, dict_mapping, interval_join
from tidemill.operators.ordered import with_group_stats

SIX_HOURS = 6 * 3600


@query("d01_inner_join", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey""")
def inner_join(t):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_name", "c_mktsegment"
    )


@query("d02_self_join", """
SELECT a.o_orderkey, b.o_orderkey AS next_key, b.o_orderstatus AS next_status
FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey - 1""")
def self_join(t):
    a = t.orders.select("o_orderkey")
    b = t.orders.select(
        F.col("o_orderkey").alias("next_key"), F.col("o_orderstatus").alias("next_status")
    )
    return a.join(b, F.col("o_orderkey") == F.col("next_key") - 1)


@query("d03_left_join", """
SELECT c_custkey, c_name, o_orderkey FROM customer
LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'F'""")
def left_join(t):
    done = t.orders.filter(F.col("o_orderstatus") == "F")
    return t.customer.join(done, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", "o_orderkey"
    )


@query("d04_full_join", """
WITH c AS (SELECT c_nationkey k, count(*) n FROM customer WHERE c_acctbal < -900 GROUP BY 1),
s AS (SELECT s_nationkey k, count(*) n FROM supplier WHERE s_acctbal > 8000 GROUP BY 1)
SELECT coalesce(c.k, s.k) AS nationkey, c.n AS debtors, s.n AS rich_suppliers
FROM c FULL JOIN s ON c.k = s.k""")
def full_join(t):
    c = (t.customer.filter(F.col("c_acctbal") < -900)
         .groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("debtors")))
    s = (t.supplier.filter(F.col("s_acctbal") > 8000)
         .groupBy(F.col("s_nationkey").alias("nationkey"))
         .agg(F.count("*").alias("rich_suppliers")))
    return c.join(s, "nationkey", "full")


@query("d05_comma_join", """
SELECT o_orderkey, c_name, n_name FROM orders, customer, nation
WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND o_totalprice > c_acctbal * 50""")
def comma_join(t):
    return t.spark.sql(
        """SELECT o_orderkey, c_name, n_name FROM {o}, {c}, {n}
           WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey
             AND o_totalprice > c_acctbal * 50""",
        o=t.orders, c=t.customer, n=t.nation,
    )


@query("d06_join_aggregate", f"""
SELECT e.emp_no, d.avg_salary, CASE WHEN salary > d.avg_salary THEN '1' ELSE '0' END AS above
FROM {EMPLOYEES_SQL} e LEFT JOIN (SELECT dept_no,
  CAST(sum(CAST(salary AS DECIMAL(18,2))) AS DOUBLE) / count(*) avg_salary
  FROM {EMPLOYEES_SQL} GROUP BY dept_no) d ON e.dept_no = d.dept_no""")
def join_aggregate(t):
    out = with_group_stats(t.employees, ["dept_no"], [exact_avg("salary").alias("avg_salary")])
    return out.select(
        "emp_no", "avg_salary",
        F.when(F.col("salary") > F.col("avg_salary"), "1").otherwise("0").alias("above"),
    )


def clicks_and_views(events):
    """Two event streams of the same users."""
    clicks = events.filter(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), F.col("user_id").alias("click_user"),
        F.col("ts").alias("click_ts"),
    )
    views = events.filter(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), F.col("user_id").alias("view_user"),
        F.col("ts").alias("view_ts"),
    )
    return clicks, views


INTERVAL_SQL = """
SELECT c.event_id AS click_id, v.event_id AS view_id
FROM (SELECT * FROM events WHERE event_type = 'click') c
{how} JOIN (SELECT * FROM events WHERE event_type = 'view') v
ON c.user_id = v.user_id AND c.ts BETWEEN v.ts - INTERVAL 6 HOUR AND v.ts"""


@query("d07_interval_join", INTERVAL_SQL.format(how=""))
def interval_inner(t):
    clicks, views = clicks_and_views(t.events_ts)
    return interval_join(
        clicks, views, [("click_user", "view_user")], "click_ts", "view_ts", 0, SIX_HOURS
    ).select("click_id", "view_id")


@query("d08_interval_left_join", INTERVAL_SQL.format(how="LEFT"))
def interval_left(t):
    clicks, views = clicks_and_views(t.events_ts)
    return interval_join(
        clicks, views, [("click_user", "view_user")], "click_ts", "view_ts", 0, SIX_HOURS, "left"
    ).select("click_id", "view_id")


@query("d08_orders_shipments", """
SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem
ON o_orderkey = l_orderkey AND o_orderdate BETWEEN l_shipdate - INTERVAL 1440 HOUR AND l_shipdate""")
def orders_shipments(t):
    return interval_join(
        t.orders.select("o_orderkey", "o_orderdate"),
        t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate"),
        [("o_orderkey", "l_orderkey")], "o_orderdate", "l_shipdate", 0, 1440 * 3600, "left",
    ).select("o_orderkey", "l_linenumber")


@query("d09_unbounded_join", """
SELECT c.event_id AS click_id, u.first_signup FROM (SELECT * FROM events WHERE event_type = 'click') c
LEFT JOIN (SELECT user_id, min(event_id) first_signup FROM events WHERE event_type = 'signup'
  GROUP BY user_id) u ON c.user_id = u.user_id""")
def unbounded_join(t):
    """Batch form of the stream join without a time bound."""
    clicks, _ = clicks_and_views(t.events_ts)
    first = (t.events.filter(F.col("event_type") == "signup").groupBy("user_id")
             .agg(F.min("event_id").alias("first_signup")))
    return clicks.join(first, F.col("click_user") == F.col("user_id"), "left").select(
        "click_id", "first_signup"
    )


@query("d10_window_join", """
SELECT c.event_id AS click_id, v.event_id AS view_id,
  strftime(date_trunc('hour', c.ts), '%Y-%m-%d %H:%M:%S') AS window_start
FROM (SELECT * FROM events WHERE event_type = 'click') c
LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
ON c.user_id = v.user_id AND date_trunc('hour', c.ts) = date_trunc('hour', v.ts)""")
def window_join(t):
    clicks, views = clicks_and_views(t.events_ts)
    c = clicks.withColumn("cw", F.window("click_ts", "1 hour"))
    v = views.withColumn("vw", F.window("view_ts", "1 hour"))
    return c.join(
        v, (F.col("click_user") == F.col("view_user")) & (F.col("cw") == F.col("vw")), "left"
    ).select("click_id", "view_id", ts_text(F.col("cw.start")).alias("window_start"))


@query("d11_temporal_join", """
SELECT p.event_id, v.event_id AS view_id, v.value AS view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
ON p.user_id = v.user_id AND p.ts >= v.ts""")
def temporal_join(t):
    events = t.events_ts
    left = events.filter(F.col("event_type") == "purchase").select("user_id", "ts", "event_id")
    versions = events.filter(F.col("event_type") == "view").select(
        "user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    return asof_join(
        left, versions, ["user_id"], "ts", ["view_id", "view_value"],
        chunk=lambda ts: [F.date_trunc("hour", ts)],
    ).select("event_id", "view_id", "view_value")


@query("d12_lookup_join", """
SELECT l_orderkey, l_linenumber, alias FROM lineitem LEFT JOIN (
  SELECT p_partkey id, 1 AS version, p_size size, p_name alias FROM part
  UNION ALL SELECT p_partkey, 2, p_size, upper(p_name) FROM part) d
ON l_partkey = d.id AND l_quantity = d.size AND d.version = 2""")
def lookup_join(t):
    """Lookup on two keys and a constant predicate; a missing key gives null."""
    dim = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_size").alias("size"),
        F.inline(F.array(
            F.struct(F.lit(1).alias("version"), F.col("p_name").alias("alias")),
            F.struct(F.lit(2).alias("version"), F.upper("p_name").alias("alias")),
        )),
    )
    cond = (
        (F.col("l_partkey") == F.col("id")) & (F.col("l_quantity") == F.col("size"))
    )
    return t.lineitem.join(dim.filter("version = 2"), cond, "left").select(
        "l_orderkey", "l_linenumber", "alias"
    )


@query("d15_lateral_inner", """
SELECT p_partkey, word, length(word) AS word_length FROM (SELECT p_partkey,
  unnest(string_split(p_name, ' ')) word FROM part WHERE p_size > 25)""")
def lateral_inner(t):
    """Rows whose table function yields nothing (null text here) are dropped."""
    return t.spark.sql(
        """SELECT p_partkey, word, cast(length(word) AS bigint) AS word_length
           FROM {part} p, LATERAL explode(split(if(p_size > 25, p_name, null), ' ')) AS w(word)""",
        part=t.part,
    )


@query("d16_lateral_left", """
SELECT p_partkey, word FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) word FROM part
  WHERE p_size > 25) UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size <= 25""")
def lateral_left(t):
    words = F.when(F.col("p_size") > 25, F.split("p_name", " "))
    return t.part.select("p_partkey", F.explode_outer(words).alias("word"))


@query("d17_priced_deals", """
SELECT p_partkey, count(*) AS deals, CAST(sum(
  CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS DECIMAL(10,2)), 2)
    AS DECIMAL(18,2))) AS DOUBLE) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_partkey""")
def priced_deals(t):
    """Batch form of the price-broadcast join; ``round`` is half-up."""
    price = F.round(
        F.col("p_retailprice").cast("decimal(10,2)") * F.col("l_quantity").cast("decimal(10,2)"), 2
    )
    return (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_partkey")
        .agg(F.count("*").alias("deals"),
             F.sum(price.cast("decimal(18,2)")).cast("double").alias("amount"))
    )


@query("d19_header_packages", """
SELECT o_orderkey, l_linenumber AS package FROM orders LEFT JOIN
(SELECT * FROM lineitem WHERE l_returnflag = 'R') ON o_orderkey = l_orderkey""")
def header_packages(t):
    """Headers with their packages; a header without packages stands alone."""
    packages = t.lineitem.filter(F.col("l_returnflag") == "R").select(
        "l_orderkey", F.col("l_linenumber").alias("package")
    )
    return t.orders.select("o_orderkey").join(
        packages, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    ).select("o_orderkey", "package")


GROUP_SUMMARY_SQL = f"""
SELECT dept_name, count(*) AS n, string_agg(DISTINCT grp, ',' ORDER BY grp) AS groups
FROM {EMPLOYEES_SQL} GROUP BY dept_name"""


@query("d20_grouped_join", GROUP_SUMMARY_SQL)
def grouped_join(t):
    """Two grouped results on one key need one grouping: counted per pair, then per key."""
    pairs = t.employees.groupBy("dept_name", "grp").agg(F.count("*").alias("n"))
    return pairs.groupBy("dept_name").agg(
        F.sum("n").alias("n"),
        F.array_join(F.array_sort(F.collect_list("grp")), ",").alias("groups"))


@query("d21_dictionary_map", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' END AS state
FROM orders""")
def dictionary_map(t):
    """A fixed small dictionary as a map literal inside the generated code."""
    names = F.create_map(F.lit("F"), F.lit("finished"), F.lit("O"), F.lit("open"))
    return t.orders.select(
        "o_orderkey", F.try_element_at(names, F.col("o_orderstatus")).alias("state")
    )


@query("d22_dict_mapping", """
SELECT c_custkey, n_name AS nation, r.r_name AS region FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = c_custkey % 5
LEFT JOIN region r ON r.r_regionkey = c_custkey % 5""")
def dictionary_lookup(t):
    """Composite key with null for unknown, then a single key that must exist."""
    rows = t.customer.withColumn("rk", (F.col("c_custkey") % 5).cast("int"))
    rows = dict_mapping(
        rows, t.nation, [("c_nationkey", "n_nationkey"), ("rk", "n_regionkey")], "n_name", "nation"
    )
    rows = dict_mapping(
        rows, t.region, [("rk", "r_regionkey")], "r_name", "region", null_if_missing=False
    )
    return rows.select("c_custkey", "nation", "region")


@query("d23_connected_inputs", """
SELECT src, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS total FROM (
  SELECT 'order' AS src, o_totalprice AS amount FROM orders
  UNION ALL SELECT 'line', l_extendedprice FROM lineitem) GROUP BY src""")
def connected_inputs(t):
    both = t.orders.select(F.lit("order").alias("src"), money("o_totalprice").alias("amount")
                           ).unionByName(
        t.lineitem.select(F.lit("line").alias("src"), money("l_extendedprice").alias("amount"))
    )
    return both.groupBy("src").agg(F.count("*").alias("n"), exact_sum("amount").alias("total"))
