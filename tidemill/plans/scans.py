"""Scan and source queries (A)."""

from pyspark.sql import functions as F

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import day_text, exact_sum, money
from tidemill.operators import cells as cell
from tidemill.operators.refresh import overwrite_partitions
from tidemill.operators.spread import rebalanced
from tidemill.session import managed_database, qualified, work_dir
from tidemill.sources import broker, changes, generator, jsonio
from tidemill.sources import text as txt
from tidemill.sources.rowgroups import RowGroupSource

SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format
EMP_SUMS = f"""
SELECT dept_no, count(*) AS n, {SUM('salary')} AS total FROM {EMPLOYEES_SQL} GROUP BY dept_no"""
EMP_SCHEMA = "emp_no BIGINT, emp_name STRING, dept_no INT, dept_name STRING, salary DOUBLE"
EMP_COLS = ["emp_no", "emp_name", "dept_no", "dept_name", "salary"]


def emp_sums(df):
    return df.groupBy("dept_no").agg(F.count("*").alias("n"), exact_sum("salary").alias("total"))


@query("a01_delimited_text", EMP_SUMS)
def delimited_text(t):
    out = work_dir(t.spark, "text")
    t.employees.select(*EMP_COLS).write.options(sep="#", lineSep="\n").csv(out)
    return emp_sums(txt.delimited(t.spark, out, EMP_SCHEMA, "#", "\n"))


@query("a02_lines", """
SELECT length(line) AS line_length, count(*) AS n FROM (
  SELECT unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY 1""")
def lines(t):
    out = work_dir(t.spark, "lines")
    t.documents.select("text").write.option("lineSep", "\n").text(out)
    rows = txt.lines(t.spark, out, min_partitions=6)
    return rows.groupBy(F.length("value").cast("bigint").alias("line_length")).agg(
        F.count("*").alias("n"))


@query("a03_parse_lines", """
SELECT p_name AS name, CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_size END AS age, count(*) AS n
FROM part WHERE p_type NOT IN ('ECONOMY', 'LARGE') GROUP BY 1, 2""")
def parse_lines(t):
    """Lines from parts: blank, too short, with a bad number, and good ones."""
    kind = F.col("p_type")
    size = F.col("p_size").cast("string")
    line = (
        F.when(kind == "ECONOMY", "  ").when(kind == "LARGE", F.col("p_name"))
        .when(kind == "SMALL", F.concat("p_name", F.lit(",x"), size))
        .otherwise(F.concat(F.lit(" "), "p_name", F.lit(", "), size, F.lit(" ")))
    )
    rows = txt.parse_lines(
        t.part.select(line.alias("value")), "value", {"name": "string", "age": "int"})
    return rows.groupBy("name", "age").agg(F.count("*").alias("n"))


@query("a04_quoted_csv", EMP_SUMS)
def quoted_csv(t):
    """Header, quotes, padded values, and file columns the table does not have."""
    out = work_dir(t.spark, "csv")
    t.employees.select(
        "emp_no", F.concat(F.lit("  "), "emp_name", F.lit(", x ")).alias("emp_name"), "dept_no",
        "salary", F.lit("unused").alias("extra"),
    ).write.options(header=True, quoteAll=True, ignoreLeadingWhiteSpace=False,
                    ignoreTrailingWhiteSpace=False).csv(out)
    rows = txt.quoted_csv(
        t.spark, out, "emp_no BIGINT, emp_name STRING, dept_no INT, salary DOUBLE, extra STRING",
        ["emp_no", "emp_name", "dept_no", "salary"])
    return emp_sums(rows.filter(F.col("emp_name").endswith(", x")))


@query("a05_json_lines", EMP_SUMS)
def json_lines(t):
    out = work_dir(t.spark, "json")
    t.employees.select(*EMP_COLS).write.json(out)
    return emp_sums(t.spark.read.schema(EMP_SCHEMA).json(out))


@query("a06_json_array", EMP_SUMS)
def json_array(t):
    """Each file holds one array of at most 50,000 rows; all files lie in one folder."""
    out = work_dir(t.spark, "jsonarray")
    (t.employees.groupBy(F.floor(F.col("emp_no") / 50_000).alias("doc"))
     .agg(F.to_json(F.collect_list(F.struct(*EMP_COLS))).alias("value")).select("value")
     .write.option("maxRecordsPerFile", 1).text(out))
    return emp_sums(t.spark.read.schema(EMP_SCHEMA).option("multiLine", True).json(out))


@query("a07_json_paths", """
SELECT event_id AS id, CAST(json_extract_string(props, '$.k') AS INT) AS code, user_id AS erp
FROM events""")
def json_paths(t):
    """Nested fields picked and renamed by path."""
    doc = F.to_json(F.struct(
        "event_id", F.struct("user_id", F.from_json("props", "k int").alias("props")).alias("params")
    ))
    return jsonio.json_columns(t.events.select(doc.alias("doc")), "doc", {
        "id": ("$.event_id", "bigint"), "code": ("$.params.props.k", "int"),
        "erp": ("$.params.user_id", "bigint"),
    }).drop("doc")


@query("a08_lenient_json", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(NULL AS VARCHAR) AS extra
FROM events WHERE event_type <> 'error'""")
def lenient_json(t):
    rows = t.events.select(
        "event_id",
        F.when(F.col("event_type") == "error", F.expr("substr(props, 1, length(props) - 1)"))
        .otherwise(F.col("props")).alias("doc"),
    )
    return jsonio.lenient_json(rows, "doc", "k INT, extra STRING").drop("doc")


@query("a09_columnar_files", EMP_SUMS)
def columnar_files(t):
    root = work_dir(t.spark, "columnar")
    t.employees.select(*EMP_COLS).write.orc(f"{root}/orc")
    t.spark.read.orc(f"{root}/orc").write.parquet(f"{root}/parquet")
    return emp_sums(t.spark.read.parquet(f"{root}/parquet"))


@query("a10_sequence_file", EMP_SUMS)
def sequence_file(t):
    out = work_dir(t.spark, "sequence")
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in EMP_COLS])
    txt.write_sequence_values(t.employees.select(line.alias("value")), out)
    rows = txt.sequence_values(t.spark, out).select(
        F.from_csv("value", EMP_SCHEMA).alias("r")).select("r.*")
    return emp_sums(rows)


@query("a11_direct_files", """
SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""")
def direct_files(t):
    return t.spark.sql(
        f"SELECT o_orderpriority, count(*) AS n FROM parquet.`{t.path('orders')}` "
        "WHERE o_orderstatus = 'F' GROUP BY 1"
    )


@query("a12_glob_and_path_columns", f"""
SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS n, {SUM('value')} AS total FROM events
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""")
def glob_and_path_columns(t):
    """``dt=2024-01-1?`` with the day taken from the folder name."""
    out = work_dir(t.spark, "days")
    rebalanced(t.events.withColumn("dt", day_text("ts")), "dt").write.partitionBy("dt").parquet(out)
    rows = t.spark.read.option("basePath", out).parquet(f"{out}/dt=2024-01-1?")
    day = F.regexp_extract(F.col("_metadata.file_path"), r"dt=(\d{4}-\d{2}-\d{2})", 1)
    return rows.select(day.alias("dt"), "value").groupBy("dt").agg(
        F.count("*").alias("n"), exact_sum("value").alias("total"))


@query("a13_load_columns", f"""
SELECT strftime(ts, '%Y-%m') AS month, count(*) AS n, {SUM('value * 2')} AS doubled FROM events
WHERE event_type <> 'error' GROUP BY 1""")
def load_columns(t):
    rows = txt.load_columns(
        t.events,
        {"month": F.date_format("ts", "yyyy-MM"), "doubled": F.col("value") * 2},
        F.col("event_type") != "error", "month", ["2023-12", "2024-01"],
    )
    out = work_dir(t.spark, "load")
    rows.select("month", "doubled").write.partitionBy("month").parquet(out)
    return t.spark.read.parquet(out).groupBy(F.col("month").cast("string").alias("month")).agg(
        F.count("*").alias("n"), exact_sum("doubled").alias("doubled"))


@query("a14_load_data", EMP_SUMS)
def load_data(t):
    """Files of a landing folder loaded into one partition of a table."""
    db = managed_database(t.spark, "landing")
    out = work_dir(t.spark, "landing")
    t.employees.select(*EMP_COLS).write.csv(out)
    t.spark.sql(f"CREATE TABLE {db}.emp ({EMP_SCHEMA}, dt STRING) USING parquet PARTITIONED BY (dt)")
    rows = txt.delimited(t.spark, out, EMP_SCHEMA)
    overwrite_partitions(rows.withColumn("dt", F.lit("2022-09-09")), f"{db}.emp")
    return emp_sums(t.spark.table(f"{db}.emp").filter("dt = '2022-09-09'"))


@query("a15_inline_values", """
SELECT event_id, label, weight FROM events JOIN (VALUES ('click', 'touch', 1),
  ('view', CAST(NULL AS VARCHAR), 2), ('error', 'fault', CAST(NULL AS INT))) AS v(kind, label, weight)
ON event_type = kind""")
def inline_values(t):
    return t.spark.sql(
        """SELECT event_id, label, weight FROM {events} JOIN (
             VALUES ('click', 'touch', 1), ('view', CAST(NULL AS STRING), 2),
                    ('error', 'fault', CAST(NULL AS INT))) AS v(kind, label, weight)
           ON event_type = kind""",
        events=t.events,
    )


@query("a16_generated_packages", """
WITH p AS (SELECT o_orderkey AS w, unnest([1, 2, 3, 4, 5]) AS n FROM orders),
q AS (SELECT *, w || '-' || n AS pid FROM p)
SELECT w AS waybill_code, n AS package_no, pid AS package_code,
  CAST(('0x' || substr(md5('site:' || pid), 1, 8)) AS BIGINT) % 500 + 1 AS site_code,
  ['sorted', 'loaded', 'sent', 'delivered'][
    CAST(('0x' || substr(md5('state:' || pid), 1, 8)) AS BIGINT) % 4 + 1] AS state FROM q""")
def generated_packages(t):
    return generator.packages(t.orders, "o_orderkey")


LAYOUT = {"base": ["c_name"], "info": ["c_mktsegment", "c_acctbal"]}


def customer_cells(t):
    """Two versions per column; the second holds upper-case text."""
    first = cell.to_cells(t.customer, F.col("c_custkey"), LAYOUT, F.lit(1000))
    second = cell.to_cells(
        t.customer.withColumn("c_name", F.upper("c_name")), F.col("c_custkey"),
        {"base": ["c_name"]}, F.col("c_custkey") + 2000)
    return first.unionByName(second)


@query("a17_flat_wide_table", """
SELECT CAST(c_custkey AS VARCHAR) AS rowkey, upper(c_name) AS name, c_mktsegment AS segment,
  c_custkey + 2000 AS ts FROM customer""")
def flat_wide_table(t):
    rows = cell.row_view(customer_cells(t), LAYOUT)
    return rows.select(
        "rowkey", F.col("base.c_name").alias("name"), F.col("info.c_mktsegment").alias("segment"),
        "ts")


def event_messages(t):
    """Events as messages: partition by user, offset in time order."""
    rows = t.events_ts.select(
        "event_id", "event_type", "value", "user_id", "ts", F.lit("events").alias("topic"))
    return rows.select(
        F.col("user_id").cast("string").alias("key"),
        F.to_json(F.struct("event_id", "event_type", "value")).alias("value"),
        "topic", F.pmod("user_id", F.lit(3)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )


@query("a18_decode_messages", """
SELECT CAST(user_id AS VARCHAR) AS id, event_id, event_type, value, 'events' AS topic,
  CAST(user_id % 3 AS INT) AS event_partition, event_id AS event_offset FROM events""")
def decode_messages(t):
    rows = broker.decode(
        event_messages(t), "event_id BIGINT, event_type STRING, value DOUBLE", "json", "id")
    return rows.drop("event_time")


@query("a19_start_positions", """
WITH m AS (SELECT *, CAST(user_id % 3 AS INT) AS p FROM events),
s AS (SELECT p, min(event_id) AS o FROM m WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' GROUP BY p)
SELECT m.p AS partition, min(event_id) AS first_offset, count(*) AS n FROM m JOIN s ON m.p = s.p
WHERE event_id >= s.o GROUP BY m.p""")
def start_positions(t):
    messages = event_messages(t)
    starts = broker.first_offsets(messages, F.lit("2024-01-20 12:00:00").cast("timestamp"))
    return broker.from_offsets(messages, starts).groupBy("partition").agg(
        F.min("offset").alias("first_offset"), F.count("*").alias("n"))


CHANGE_SQL = """
SELECT '+I' AS op, event_id AS seq, user_id AS id, value AS amount FROM events WHERE event_type = 'signup'
UNION ALL SELECT '-D', event_id, user_id, value FROM events WHERE event_type = 'error'
UNION ALL SELECT '+U', event_id, user_id, value FROM events WHERE event_type NOT IN ('signup', 'error')
UNION ALL SELECT '-U', event_id, user_id, 0.5 FROM events WHERE event_type NOT IN ('signup', 'error')"""


@query("a20_row_image_changes", CHANGE_SQL)
def row_image_changes(t):
    """Update records list only the changed field in ``old``."""
    kind = (F.when(F.col("event_type") == "signup", "INSERT")
            .when(F.col("event_type") == "error", "DELETE").otherwise("UPDATE"))
    data = F.array(F.struct(F.col("user_id").cast("string").alias("id"),
                            F.col("value").cast("string").alias("amount")))
    old = F.when(kind == "UPDATE", F.array(F.struct(F.lit("0.5").alias("amount"))))
    doc = F.to_json(F.struct(kind.alias("type"), data.alias("data"), old.alias("old")))
    return changes.decode_row_images(
        t.events.select("event_id", doc.alias("doc")), "doc", "id BIGINT, amount DOUBLE", "event_id")


@query("a20_before_after_changes", CHANGE_SQL)
def before_after_changes(t):
    kind = (F.when(F.col("event_type") == "signup", "c")
            .when(F.col("event_type") == "error", "d").otherwise("u"))
    now = F.struct(F.col("user_id").alias("id"), F.col("value").alias("amount"))
    was = F.struct(F.col("user_id").alias("id"), F.lit(0.5).alias("amount"))
    before = F.when(kind == "d", now).when(kind == "u", was)
    after = F.when(kind != "d", now)
    doc = F.to_json(F.struct(kind.alias("op"), before.alias("before"), after.alias("after")))
    return changes.decode_before_after(
        t.events.select("event_id", doc.alias("doc")), "doc", "id BIGINT, amount DOUBLE", "event_id")


@query("a24_latest_partition", """
SELECT event_id, user_id FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def latest_partition(t):
    """The newest partition value is a scalar, applied as a partition filter."""
    out = work_dir(t.spark, "dim")
    rebalanced(t.events.withColumn("dt", day_text("ts")), "dt").select(
        "event_id", "user_id", "dt").write.partitionBy("dt").parquet(out)
    rows = t.spark.read.parquet(out)
    newest = rows.agg(F.max("dt")).scalar()
    return rows.filter(F.col("dt") == newest).select("event_id", "user_id")


@query("a25_enumerated_source", f"""
SELECT o_orderstatus, count(*) AS n, {SUM('o_totalprice')} AS total FROM orders GROUP BY 1""")
def enumerated_source(t):
    t.spark.dataSource.register(RowGroupSource)
    rows = (t.spark.read.format("tidemill_rowgroups")
            .schema("o_orderstatus STRING, o_totalprice DOUBLE").load(qualified(t.spark, t.path("orders"))))
    return rows.groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(money("o_totalprice")).cast("double").alias("total"))


@query("a26_wide_scan", """
SELECT CAST(c_custkey AS VARCHAR) AS rowkey, c_mktsegment AS segment, CAST(c_acctbal AS VARCHAR) AS bal
FROM customer WHERE CAST(c_custkey AS VARCHAR) >= '5'""")
def wide_scan(t):
    """One family from a start row on; other families are never grouped."""
    part = cell.scan(customer_cells(t), start_row="5", families=["info"])
    rows = cell.row_view(part, {"info": LAYOUT["info"]})
    return rows.select("rowkey", F.col("info.c_mktsegment").alias("segment"),
                       F.col("info.c_acctbal").alias("bal"))


@query("a27_scan_filters", """
SELECT CAST(c_custkey AS VARCHAR) AS rowkey, 'c_name' AS qualifier FROM customer
WHERE regexp_matches(CAST(c_custkey AS VARCHAR), '^1[0-4]')""")
def scan_filters(t):
    part = cell.scan(customer_cells(t), row_regex="^1[0-4]", family_regex="^ba")
    return part.select("rowkey", "qualifier").distinct()
