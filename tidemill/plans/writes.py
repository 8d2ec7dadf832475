"""Sink and write queries (B); stream sinks are in :mod:`tidemill.plans.streams`."""

from pyspark.sql import functions as F

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import day_text, exact_sum
from tidemill.operators import cells as cell
from tidemill.operators.partitions import swap_partition
from tidemill.operators.refresh import clear_partition, overwrite_mode, overwrite_partitions
from tidemill.operators.spread import rebalanced
from tidemill.plans.scans import customer_cells, emp_sums
from tidemill.session import managed_database, work_dir
from tidemill.sources import broker

SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format
EMP_SUMS = f"""
SELECT dept_no, count(*) AS n, {SUM('salary')} AS total FROM {EMPLOYEES_SQL} GROUP BY dept_no"""
EMP_SCHEMA = "emp_no BIGINT, emp_name STRING, dept_no INT, salary DOUBLE"
EMP_COLS = ["emp_no", "emp_name", "dept_no", "salary"]


def daily_table(t, label):
    """``events`` as a managed table partitioned by day."""
    name = f"{managed_database(t.spark, label)}.ev"
    t.spark.sql(f"CREATE TABLE {name} (event_id BIGINT, value DOUBLE, dt STRING) USING parquet "
                "PARTITIONED BY (dt)")
    return name


def daily_rows(t):
    return t.events.select("event_id", "value", day_text("ts").alias("dt"))


def by_day(df):
    return df.groupBy("dt").agg(F.count("*").alias("n"), exact_sum("value").alias("total"))


def day_sql(rows, value="value"):
    return f"""
SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, {SUM(value)} AS total FROM {rows} GROUP BY 1"""


@query("b01_append_named", """
SELECT o_orderkey AS id, o_orderstatus AS status, NULL::DOUBLE AS price FROM orders
WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM orders
WHERE o_orderstatus <> 'F'""")
def append_named(t):
    """Columns not named by an insert are null."""
    name = f"{managed_database(t.spark, 'append')}.o"
    t.spark.sql(f"CREATE TABLE {name} (id BIGINT, status STRING, price DOUBLE) USING parquet")
    t.spark.sql(f"INSERT INTO {name} (status, id) SELECT o_orderstatus, o_orderkey FROM {{o}} "
                "WHERE o_orderstatus = 'F'", o=t.orders)
    rest = t.orders.filter("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))
    shape = t.spark.table(name).filter("false")
    shape.unionByName(rest, allowMissingColumns=True).write.insertInto(name)
    return t.spark.table(name)


@query("b02_static_partition", day_sql(
    "(SELECT * FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-05')"))
def static_partition(t):
    name = daily_table(t, "static")
    t.spark.sql(f"INSERT INTO {name} PARTITION (dt='2024-01-05') "
                "SELECT event_id, value FROM {r} WHERE dt = '2024-01-05'", r=daily_rows(t))
    return by_day(t.spark.table(name))


@query("b03_dynamic_partition", day_sql("events"))
def dynamic_partition(t):
    name = daily_table(t, "dynamic")
    rebalanced(daily_rows(t), "dt").write.insertInto(name)
    return by_day(t.spark.table(name))


@query("b04_overwrite_table", day_sql(
    "(SELECT * FROM events WHERE event_type = 'view')"))
def overwrite_table(t):
    """With the static mode every partition is replaced."""
    name = daily_table(t, "full")
    rebalanced(daily_rows(t), "dt").write.insertInto(name)
    views = t.events.filter("event_type = 'view'").select(
        "event_id", "value", day_text("ts").alias("dt"))
    with overwrite_mode(t.spark, "static"):
        rebalanced(views, "dt").write.mode("overwrite").insertInto(name)
    return by_day(t.spark.table(name))


@query("b05_overwrite_touched", day_sql("""(SELECT ts, value FROM events
  WHERE CAST(ts AS DATE) <> DATE '2024-01-05' UNION ALL SELECT ts, value * 3 FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-05')"""))
def overwrite_touched(t):
    name = daily_table(t, "touched")
    rebalanced(daily_rows(t), "dt").write.insertInto(name)
    day = daily_rows(t).filter("dt = '2024-01-05'").withColumn("value", F.col("value") * 3)
    overwrite_partitions(day, name)
    return by_day(t.spark.table(name))


@query("b06_clear_partition", day_sql(
    "(SELECT * FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-05')"))
def cleared_partition(t):
    name = daily_table(t, "clear")
    rebalanced(daily_rows(t), "dt").write.insertInto(name)
    clear_partition(t.spark, name, {"dt": "2024-01-05"})
    return by_day(t.spark.table(name))


@query("b07_staged_swap", day_sql("""(SELECT ts, value FROM events
  WHERE CAST(ts AS DATE) <> DATE '2024-01-09' UNION ALL SELECT ts, value + 1 FROM events
  WHERE CAST(ts AS DATE) = DATE '2024-01-09')"""))
def staged_swap(t):
    """Rows are staged first, checked against the partition, then swapped in."""
    name = daily_table(t, "swap")
    rebalanced(daily_rows(t), "dt").write.insertInto(name)
    stage = work_dir(t.spark, "stage")
    daily_rows(t).filter("dt = '2024-01-09'").withColumn("value", F.col("value") + 1).write.parquet(
        stage)
    swap_partition(t.spark.read.parquet(stage), name, "dt", "2024-01-09")
    return by_day(t.spark.table(name))


@query("b07_empty_stage", day_sql(
    "(SELECT * FROM events WHERE CAST(ts AS DATE) <> DATE '2024-01-09')"))
def empty_stage(t):
    """A stage without rows leaves the partition empty."""
    name = daily_table(t, "swapempty")
    rebalanced(daily_rows(t), "dt").write.insertInto(name)
    swap_partition(daily_rows(t).filter("false"), name, "dt", "2024-01-09")
    return by_day(t.spark.table(name))


@query("b09_file_sizing", f"""
SELECT o_orderstatus, count(*) AS n, {SUM('o_totalprice')} AS total, true AS rolled FROM orders
GROUP BY 1""")
def file_sizing(t):
    """Three sorted writers, files cut at a row count."""
    out = work_dir(t.spark, "sized")
    (t.orders.repartitionByRange(3, "o_orderkey").sortWithinPartitions("o_orderkey")
     .write.option("maxRecordsPerFile", 200000).parquet(out))
    per_file = (t.spark.read.parquet(out).groupBy(F.col("_metadata.file_path").alias("f"))
                .agg(F.count("*").alias("n")))
    rolled = per_file.agg(F.max("n") <= 200000).scalar()
    return t.spark.read.parquet(out).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), exact_sum("o_totalprice").alias("total")
    ).withColumn("rolled", rolled)


@query("b10_text_json_csv", """
SELECT kind, count(*) AS n FROM orders, (VALUES ('text'), ('json'), ('csv')) AS v(kind)
GROUP BY kind""")
def text_json_csv(t):
    """``key<TAB>value`` lines, JSON and CSV hold the same rows."""
    root = work_dir(t.spark, "formats")
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    rows.select(F.concat_ws("\t", F.col("o_orderkey").cast("string"), "o_orderstatus")
                ).write.text(f"{root}/text")
    rows.write.json(f"{root}/json")
    rows.write.csv(f"{root}/csv")
    schema = "o_orderkey BIGINT, o_orderstatus STRING"
    parts = {
        "text": t.spark.read.schema(schema).option("sep", "\t").csv(f"{root}/text"),
        "json": t.spark.read.schema(schema).json(f"{root}/json"),
        "csv": t.spark.read.schema(schema).csv(f"{root}/csv"),
    }
    out = None
    for kind, df in parts.items():
        part = df.filter("o_orderstatus IS NOT NULL").select(F.lit(kind).alias("kind"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("kind").agg(F.count("*").alias("n"))


CODECS = {  # format -> codecs written by the scripts
    "csv": ["gzip", "deflate", "bzip2", "lz4"],
    "orc": ["none", "zlib"],
    "parquet": ["none", "gzip"],
}


@query("b11_compression", f"""
SELECT f || '-' || c AS kind, (SELECT count(*) FROM {EMPLOYEES_SQL}) AS n,
  (SELECT {SUM('salary')} FROM {EMPLOYEES_SQL}) AS total FROM (VALUES ('csv', 'gzip'),
  ('csv', 'deflate'), ('csv', 'bzip2'), ('csv', 'lz4'), ('orc', 'none'), ('orc', 'zlib'),
  ('parquet', 'none'), ('parquet', 'gzip')) AS v(f, c)""")
def compression(t):
    root = work_dir(t.spark, "codecs")
    rows = t.employees.select(*EMP_COLS)
    out = None
    for fmt, codecs in CODECS.items():
        for codec in codecs:
            path = f"{root}/{fmt}-{codec}"
            rows.write.format(fmt).option("compression", codec).save(path)
            part = t.spark.read.schema(EMP_SCHEMA).format(fmt).load(path).agg(
                F.lit(f"{fmt}-{codec}").alias("kind"), F.count("*").alias("n"),
                exact_sum("salary").alias("total"))
            out = part if out is None else out.unionByName(part)
    return out


@query("b12_partitioned_export", day_sql("events"))
def partitioned_export(t):
    out = work_dir(t.spark, "export")
    rebalanced(daily_rows(t), "dt").write.partitionBy("dt").option("compression", "lz4").parquet(out)
    rows = t.spark.read.parquet(out).withColumn("dt", F.col("dt").cast("string"))
    return by_day(rows)


@query("b13_delimited_export", EMP_SUMS)
def delimited_export(t):
    """Files under ``<folder>/<prefix>`` with chosen column and line separators."""
    out = f"{work_dir(t.spark, 'export')}/emp_"
    t.employees.select(*EMP_COLS).write.options(sep="|", lineSep="\n").csv(out)
    return emp_sums(t.spark.read.schema(EMP_SCHEMA).option("sep", "|").csv(out))


@query("b14_json_print", """
SELECT '{"id":' || n_nationkey || ',"name":"' || n_name || '"}' AS line FROM nation""")
def json_print(t):
    return t.nation.select(
        F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))
        .alias("line"))


@query("b19_message_encoding", """
SELECT CAST(c_custkey AS VARCHAR) AS key,
  '{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' AS value FROM customer""")
def message_encoding(t):
    return broker.encode(t.customer, "c_custkey", ["c_name", "c_mktsegment"])


@query("b20_rows_to_cells", """
SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'base' AS family, 'c_name' AS qualifier, 1000 AS ts,
  c_name AS value FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'info', 'c_mktsegment', 1000, c_mktsegment FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'info', 'c_acctbal', 1000,
  CAST(c_acctbal AS VARCHAR) FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'base', 'c_name', c_custkey + 2000, upper(c_name)
  FROM customer""")
def rows_to_cells(t):
    return customer_cells(t)


@query("b20_text_to_cells", """
SELECT CAST(o_orderkey AS VARCHAR) AS rowkey, 'info' AS family, 'status' AS qualifier,
  o_custkey AS ts, o_orderstatus AS value FROM orders WHERE o_orderstatus <> 'P'""")
def text_to_cells(t):
    """``rowkey,family,qualifier,value,ts`` lines; short lines are skipped."""
    key, ts = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    line = F.when(
        F.col("o_orderstatus") != "P",
        F.concat_ws(",", key, F.lit("info"), F.lit("status"), "o_orderstatus", ts),
    ).otherwise(F.concat_ws(",", key, F.lit("info")))
    return cell.parse_cells(t.orders.select(line.alias("value")))


@query("b21_cells_to_text", """
SELECT CAST(c_custkey AS VARCHAR) || ',base,c_name,' || upper(c_name) || ',' || (c_custkey + 2000)
  AS value FROM customer
UNION ALL SELECT CAST(c_custkey AS VARCHAR) || ',base,c_name,' || c_name || ',1000' FROM customer""")
def cells_to_text(t):
    """One family is copied, three versions at most, and written as lines."""
    copied = cell.newest_versions(cell.scan(customer_cells(t), families=["base"]), 3)
    return cell.cell_lines(copied)
