"""Projection, filter and predicate queries (C)."""

from pyspark.sql import functions as F

from tidemill.catalog import query
from tidemill.functions.columns import exact_sum, money
from tidemill.session import managed_database, work_dir


@query("c01_projection", """
SELECT *, 'crm' AS src, c_acctbal * 2 AS doubled, c_custkey AS id FROM customer""")
def projection(t):
    return t.customer.select(
        "*",
        F.lit("crm").alias("src"),
        (F.col("c_acctbal") * 2).alias("doubled"),
        F.col("c_custkey").alias("id"),
    )


@query("c02_filters", """
SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders
WHERE (o_orderstatus IN ('F', 'P') AND o_totalprice BETWEEN 1000 AND 250000)
   OR (o_orderpriority BETWEEN '2' AND '3-Z' AND o_custkey > 100)""")
def filters(t):
    return t.orders.filter(
        (F.col("o_orderstatus").isin("F", "P") & F.col("o_totalprice").between(1000, 250000))
        | (F.col("o_orderpriority").between("2", "3-Z") & (F.col("o_custkey") > 100))
    ).select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")


@query("c03_null_tests", """
WITH e AS (SELECT event_id, event_type,
  CASE WHEN event_type <> 'error' THEN value END v,
  CASE WHEN event_type = 'view' THEN NULL ELSE value > 50 END big FROM events)
SELECT event_id, v IS NULL AS no_value, v IS NOT NULL AS has_value,
  coalesce(big, false) AS is_big, big IS NOT DISTINCT FROM NULL AS unknown,
  NOT (NULLIF(event_type, 'view') IS NOT NULL AND event_type <> '') AS blank
FROM e""")
def null_tests(t):
    e = t.events.select(
        "event_id", "event_type",
        F.when(F.col("event_type") != "error", F.col("value")).alias("v"),
        F.when(F.col("event_type") != "view", F.col("value") > 50).alias("big"),
    )
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    return e.select(
        "event_id",
        F.col("v").isNull().alias("no_value"),
        F.col("v").isNotNull().alias("has_value"),
        F.col("big").eqNullSafe(True).alias("is_big"),
        F.col("big").eqNullSafe(None).alias("unknown"),
        (~(kind.isNotNull() & (F.col("event_type") != ""))).alias("blank"),
    )


@query("c04_like_regex", """
SELECT p_partkey, p_name FROM part
WHERE p_name LIKE '%ring%' OR regexp_matches(p_name, '^[a-h]+ (g|w)')""")
def like_regex(t):
    return t.part.filter(
        F.col("p_name").like("%ring%") | F.col("p_name").rlike("^[a-h]+ (g|w)")
    ).select("p_partkey", "p_name")


@query("c05_conditionals", """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE 'other' END AS state,
  CASE WHEN o_totalprice > 100000
       THEN CASE WHEN o_custkey % 2 = 0 THEN 'even' ELSE 'odd' END END AS parity,
  CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END AS big,
  coalesce(NULLIF(o_orderstatus, 'P'), 'none') AS status_or_none
FROM orders""")
def conditionals(t):
    status = F.col("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        F.when(status == "F", "done").when(status == "O", "open").otherwise("other")
        .alias("state"),
        F.when(
            F.col("o_totalprice") > 100000,
            F.when(F.col("o_custkey") % 2 == 0, "even").otherwise("odd"),
        ).alias("parity"),
        F.expr("if(o_totalprice > 200000, 1, 0)").alias("big"),
        F.coalesce(F.nullif(status, F.lit("P")), F.lit("none")).alias("status_or_none"),
    )


@query("c06_struct_access", """
SELECT c_custkey AS emp_no, c_name AS emp_name, c_mktsegment AS grp,
  c_custkey % 2 = 0 AND c_acctbal > 0 AS flag FROM customer""")
def struct_access(t):
    rows = t.customer.select(
        F.struct(F.col("c_custkey").alias("emp_no"), F.col("c_name").alias("emp_name"))
        .alias("base"),
        F.struct(F.col("c_mktsegment").alias("grp"), F.col("c_acctbal").alias("salary"))
        .alias("info"),
    )
    return rows.select(
        "base.emp_no", "base.emp_name", "info.grp",
        ((F.col("base.emp_no") % 2 == 0) & (F.col("info.salary") > 0)).alias("flag"),
    )


@query("c07_arrays", """
SELECT p_partkey, p_size + CAST(replace(p_brand, 'Brand#', '') AS INT) AS total,
  'a,b,' || p_type AS tags FROM part""")
def arrays(t):
    texts = F.array(
        F.col("p_size").cast("string"), F.regexp_replace("p_brand", "Brand#", "")
    )
    return t.part.select(
        "p_partkey",
        F.aggregate(texts.cast("array<int>"), F.lit(0), lambda a, x: a + x).alias("total"),
        F.array_join(F.array(F.lit("a"), F.lit("b"), F.col("p_type")), ",").alias("tags"),
    )


@query("c08_lenient_cast", """
SELECT o_orderkey,
  TRY_CAST(substr(o_orderpriority, 1, 1) || CASE WHEN o_custkey % 3 = 0 THEN 'a' ELSE '' END
    AS INT) AS level,
  TRY_CAST(substr(o_orderpriority, 1, 1) || CASE WHEN o_custkey % 3 = 0 THEN 'a' ELSE '' END
    AS INT) IS NULL AS bad
FROM orders""")
def lenient_cast(t):
    text = F.concat(
        F.substring("o_orderpriority", 1, 1),
        F.when(F.col("o_custkey") % 3 == 0, "a").otherwise(""),
    )
    level = text.try_cast("int")
    return t.orders.select("o_orderkey", level.alias("level"), level.isNull().alias("bad"))


@query("c09_views", """
WITH per_cust AS (SELECT o_custkey, count(*) n,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) total
  FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey)
SELECT n, count(*) AS customers, CAST(sum(CAST(total AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM per_cust GROUP BY n""")
def views(t):
    settled = t.orders.filter(F.col("o_orderstatus") != "P")
    return t.spark.sql(
        """
        WITH per_cust AS (
          SELECT o_custkey, count(*) n, sum(cast(o_totalprice AS decimal(18,2))) total
          FROM {settled} GROUP BY o_custkey)
        SELECT n, count(*) AS customers, cast(sum(total) AS double) AS total
        FROM (SELECT * FROM per_cust) GROUP BY n
        """,
        settled=settled,
    )


@query("c10_not_exists", """
SELECT c_custkey, c_name FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'F')""")
def not_exists(t):
    done = t.orders.filter(F.col("o_orderstatus") == "F").select("o_custkey").distinct()
    return t.customer.join(
        done, F.col("c_custkey") == F.col("o_custkey"), "left_anti"
    ).select("c_custkey", "c_name")


@query("c11_computed_column", """
SELECT event_id, value * 10 AS scaled, true AS stamped FROM events""")
def computed_column(t):
    return (
        t.events.withColumn("scaled", F.col("value") * 10)
        .withColumn("proc_time", F.current_timestamp())
        .select("event_id", "scaled", F.col("proc_time").isNotNull().alias("stamped"))
    )


@query("c12_session_variables", """
SELECT o_orderstatus, count(*) AS n FROM orders
WHERE o_totalprice >= 50000 AND o_orderdate >= TIMESTAMP '1996-01-01' GROUP BY o_orderstatus""")
def session_variables(t):
    t.spark.sql("DECLARE OR REPLACE VARIABLE tidemill_floor DOUBLE DEFAULT 0")
    t.spark.sql("SET VAR tidemill_floor = 50000")
    out = t.spark.sql(
        """SELECT o_orderstatus, count(*) AS n FROM {orders}
           WHERE o_totalprice >= tidemill_floor AND o_orderdate >= :since
           GROUP BY o_orderstatus""",
        args={"since": "1996-01-01"},
        orders=t.orders,
    )
    return out


@query("c13_qualified_names", """
SELECT o_orderstatus, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_orderstatus""")
def qualified_names(t):
    db = managed_database(t.spark, "names")
    t.orders.select("o_orderstatus", "o_totalprice").write.saveAsTable(f"{db}.orders_copy")
    return (
        t.spark.table(f"spark_catalog.{db}.orders_copy")
        .groupBy("o_orderstatus")
        .agg(F.count("*").alias("n"), exact_sum("o_totalprice").alias("total"))
    )


@query("c14_one_partition", """
SELECT user_id, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events WHERE event_type = 'purchase' GROUP BY user_id""")
def one_partition(t):
    """The filter becomes a partition filter: other folders are never listed."""
    out = work_dir(t.spark, "by-type")
    t.events.select("event_type", "user_id", "value").write.partitionBy("event_type").parquet(out)
    return (
        t.spark.read.parquet(out)
        .filter(F.col("event_type") == "purchase")
        .groupBy("user_id")
        .agg(F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("total"))
    )
