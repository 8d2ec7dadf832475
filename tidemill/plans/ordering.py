"""Sort, limit, distribution and reuse queries (G)."""

from pyspark.sql import functions as F

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import bucketed_key, exact_sum, money
from tidemill.operators.spread import cluster_by, distribute_sort, salted, two_phase
from tidemill.session import checkpointed, work_dir


@query("g01_global_order", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey""")
def global_order(t):
    """The unique last column lets the range partitioner split a hot value."""
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice").orderBy(
        "o_orderstatus", F.desc("o_totalprice"), "o_orderkey"
    )


@query("g02_distribute_sort", f"""
SELECT dept_no, count(*) AS n, 0 AS out_of_order FROM {EMPLOYEES_SQL} GROUP BY dept_no""")
def distribute_by_sort_by(t):
    """Written sorted by department and salary; the row numbers of the written
    order show that salaries never fall within a department."""
    out = work_dir(t.spark, "sorted")
    distribute_sort(
        t.employees, ["dept_no"], [F.col("dept_no"), F.col("salary")]
    ).select(
        "dept_no", "salary", F.monotonically_increasing_id().alias("pos")
    ).write.parquet(out)
    rows = t.spark.read.parquet(out)
    by_pos = rows.groupBy("dept_no").agg(F.count("*").alias("n"))
    worse = _falling(rows)
    return by_pos.join(worse, "dept_no", "left").select(
        "dept_no", "n", F.coalesce("bad", F.lit(0)).cast("int").alias("out_of_order")
    )


def _falling(rows):
    from tidemill.operators.ordered import framed

    pairs = framed(
        rows, ["dept_no"], [F.col("pos")], [F.floor(F.col("pos") / 100000)], 1, 0,
        lambda w, _: {"before": F.lag("salary").over(w)},
    )
    return pairs.filter("before > salary").groupBy("dept_no").agg(F.count("*").alias("bad"))


@query("g02_cluster_by", """
SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus""")
def cluster(t):
    """A status is contiguous but may cross partitions, so one hot status is shared."""
    rows = cluster_by(
        t.orders.select("o_orderstatus", "o_orderkey"), ["o_orderstatus"], ["o_orderkey"]
    )
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("g03_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 30")
def limit(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(30)


@query("g04_top_k", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def top_k(t):
    """Each task keeps ten rows, one task merges them (take ordered)."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), "o_orderkey"
    ).limit(10)


@query("g05_repartition", """
SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority""")
def repartition(t):
    spread = t.orders.select("o_orderpriority").repartition(6)
    return spread.groupBy("o_orderpriority").agg(F.count("*").alias("n")).coalesce(2)


USER_SQL = """
SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events GROUP BY user_id"""


@query("g06_salted_spread", USER_SQL)
def salted_spread(t):
    spread = salted(t.events, ["user_id"], ["event_id"], 16)
    return spread.groupBy("user_id").agg(F.count("*").alias("n"), exact_sum("value").alias("total"))


@query("g06_two_phase", USER_SQL)
def two_phase_sum(t):
    return two_phase(
        t.events, ["user_id"], ["event_id"], 16,
        [F.count("*").alias("c"), F.sum(money("value")).alias("s")],
        [F.sum("c").alias("n"), F.sum("s").cast("double").alias("total")],
    )


@query("g06_own_partitioner", """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '1%' THEN 0 ELSE 1 + o_custkey % 3 END AS place
FROM orders""")
def own_partitioner(t):
    """Urgent orders have a partition of their own, the others go by customer; a column decides."""
    place = F.when(F.col("o_orderpriority").startswith("1"), 0).otherwise(
        1 + F.col("o_custkey") % 3).cast("int")
    rows = t.orders.select("o_orderkey", place.alias("id")).repartitionById(4, "id")
    return rows.select("o_orderkey", F.spark_partition_id().cast("long").alias("place"))


@query("g07_bucketed_key", """
WITH h AS (SELECT c_custkey, c_mktsegment d, list_reduce(
    list_prepend(0::BIGINT, list_transform(string_split(c_mktsegment, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: (a * 31 + c) & 4294967295) AS u FROM customer)
SELECT c_custkey, lpad(CAST(abs(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END) % 10
  AS VARCHAR), 2, '0') || '_' || d || '_' || c_custkey AS rowkey FROM h""")
def bucketed_keys(t):
    key = bucketed_key(F.col("c_mktsegment"), F.col("c_custkey").cast("string"))
    return t.customer.select("c_custkey", key.alias("rowkey"))


@query("g07_point_lookup", """
SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey =
  (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def point_lookup(t):
    """The wanted row key is recomputed from its parts."""
    first = t.customer.filter("c_mktsegment = 'BUILDING'").agg(F.min("c_custkey")).scalar()
    wanted = bucketed_key(F.lit("BUILDING"), first.cast("string"))
    rows = t.customer.withColumn(
        "rowkey", bucketed_key(F.col("c_mktsegment"), F.col("c_custkey").cast("string"))
    )
    return rows.filter(F.col("rowkey") == wanted).select("c_custkey", "c_name")


@query("g08_reuse", """
SELECT o_orderstatus, n, n * 100 // (SELECT count(*) FROM orders) AS pct
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""")
def reuse(t):
    """The grouped result feeds two uses; it is checkpointed in the shared folder."""
    counts = checkpointed(
        t.orders.groupBy("o_orderstatus")
        .agg(F.count("*").alias("n"))
    )
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(
        "o_orderstatus", "n", F.floor(F.col("n") * 100 / total).cast("bigint").alias("pct")
    )
