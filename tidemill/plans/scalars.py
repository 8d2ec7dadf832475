"""Set operations and scalar functions (H)."""

from pyspark.sql import functions as F

from tidemill.catalog import query
from tidemill.functions.columns import (
    ceil_to, day_text, java_hash, round_up_decimal, slot_last_minute, slot_text, time_slice,
    ts_text,
)

TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')".format


@query("h01_union_distinct", """
SELECT c_nationkey AS k, 'n' || c_nationkey AS v FROM customer
UNION SELECT s_nationkey, CAST(NULL AS VARCHAR) FROM supplier""")
def union_distinct(t):
    a = t.customer.select(
        F.col("c_nationkey").alias("k"),
        F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("v"),
    )
    b = t.supplier.select(F.col("s_nationkey").alias("k"), F.lit(None).cast("string").alias("v"))
    return a.distinct().unionByName(b.distinct()).distinct()


@query("h02_union_all", """
SELECT o_orderkey AS k, 'order' AS src FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT l_orderkey, 'line' FROM lineitem WHERE l_returnflag = 'R'""")
def union_all(t):
    a = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("k"), F.lit("order").alias("src")
    )
    b = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("k"), F.lit("line").alias("src")
    )
    return a.unionByName(b)


@query("h03_text", """
SELECT p_partkey, p_brand || '/' || p_type AS joined, concat_ws('-', p_brand, p_name) AS dashed,
  upper(p_name) AS up, lower(p_type) AS low, trim('  ' || p_name || ' ') AS trimmed,
  substr(p_name, 2, 3) AS part, lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded FROM part""")
def text(t):
    return t.part.select(
        "p_partkey",
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.concat_ws("-", "p_brand", "p_name").alias("dashed"),
        F.upper("p_name").alias("up"),
        F.lower("p_type").alias("low"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"),
        F.substring("p_name", 2, 3).alias("part"),
        F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"),
    )


@query("h04_split", """
SELECT p_partkey, len(string_split(p_name, ' ')) AS words, string_split(p_name, ' ')[1] AS first,
  length(p_name) AS chars FROM part""")
def split(t):
    words = F.split("p_name", " ")
    chars = F.filter(F.split("p_name", ""), lambda c: c != "")
    return t.part.select(
        "p_partkey", F.size(words).cast("bigint").alias("words"), words[0].alias("first"),
        F.size(chars).cast("bigint").alias("chars"),
    )


@query("h05_regex", """
SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+')) AS words,
  regexp_full_match(source, 'src1[0-9]*') AS src1 FROM documents""")
def regex(t):
    return t.documents.select(
        "doc_id",
        F.size(F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))).cast("bigint")
        .alias("words"),
        F.col("source").rlike("^(?:src1[0-9]*)$").alias("src1"),
    )


@query("h06_hash_code", """
WITH s AS (SELECT p_partkey, p_name || '_' || p_partkey AS x FROM part),
h AS (SELECT p_partkey, list_reduce(list_prepend(0::BIGINT,
  list_transform(string_split(x, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, c: (a * 31 + c) & 4294967295) AS u FROM s)
SELECT p_partkey, CAST(CASE WHEN u >= 2147483648 THEN u - 4294967296 ELSE u END AS INT) AS code
FROM h""")
def hash_code(t):
    key = F.concat("p_name", F.lit("_"), F.col("p_partkey").cast("string"))
    return t.part.select("p_partkey", java_hash(key).alias("code"))


@query("h07_unix_time", f"""
SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS secs,
  {TS("date_trunc('second', ts)")} AS from_secs,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events""")
def unix_time(t):
    secs = F.unix_timestamp("ts")
    return t.events_ts.select(
        "event_id", secs.alias("secs"), F.from_unixtime(secs).alias("from_secs"),
        F.date_format(F.timestamp_seconds(secs), "yyyy-MM-dd'T'HH:mm:ss").alias("iso"),
    )


@query("h08_dates", """
SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day,
  date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-03-08') AS days,
  CAST(date_diff('day', o_orderdate, TIMESTAMP '2002-03-08 00:00:00') AS BIGINT) AS ts_days
FROM orders""")
def dates(t):
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey", day_text(day).alias("day"),
        F.datediff(F.lit("2002-03-08").cast("date"), day).cast("bigint").alias("days"),
        F.timestamp_diff("DAY", "o_orderdate", F.lit("2002-03-08 00:00:00").cast("timestamp_ntz"))
        .alias("ts_days"),
    )


@query("h09_current_time", """
SELECT event_id, true AS in_past, 0 AS day_gap FROM events""")
def current_time(t):
    """``now`` family; only relations that hold at any time are returned."""
    gap = F.datediff(F.to_date(F.current_timestamp()), F.curdate()).cast("int")
    return t.events_ts.select(
        "event_id", (F.col("ts") < F.now()).alias("in_past"), gap.alias("day_gap")
    )


@query("h10_intervals", f"""
SELECT o_orderkey, {TS('o_orderdate + INTERVAL 36 HOUR')} AS later,
  {TS('o_orderdate - INTERVAL 2 YEAR')} AS two_years, {TS('o_orderdate - INTERVAL 9 DAY')} AS days,
  {TS('o_orderdate + INTERVAL 1 MONTH')} AS next_month FROM orders""")
def intervals(t):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        ts_text(day + F.expr("INTERVAL '36' HOUR")).alias("later"),
        ts_text(day - F.expr("INTERVAL '2' YEAR")).alias("two_years"),
        ts_text(F.date_sub(day, 9)).alias("days"),
        ts_text(F.add_months(F.to_date(day), 1)).alias("next_month"),
    )


@query("h11_floor_ceil_slots", f"""
SELECT event_id, {TS("date_trunc('hour', ts)")} AS floor_hour,
  {TS("CASE WHEN date_trunc('hour', ts) = ts THEN ts ELSE date_trunc('hour', ts) + INTERVAL 1 HOUR END")}
    AS ceil_hour,
  {TS("date_trunc('month', ts) + INTERVAL 1 MONTH")} AS ceil_month,
  lpad(CAST(hour(ts) AS VARCHAR), 2, '0') || lpad(CAST(minute(ts) // 20 * 20 AS VARCHAR), 2, '0')
    AS slot20, CAST((minute(ts) // 15 + 1) * 15 - 1 AS INT) AS slot15_last,
  CAST(hour(ts) AS INT) AS hour FROM events""")
def floor_ceil_slots(t):
    return t.events_ts.select(
        "event_id",
        ts_text(F.date_trunc("hour", "ts")).alias("floor_hour"),
        ts_text(ceil_to("hour", "ts")).alias("ceil_hour"),
        ts_text(ceil_to("month", "ts")).alias("ceil_month"),
        slot_text("ts", 20).alias("slot20"),
        slot_last_minute("ts", 15).alias("slot15_last"),
        F.hour("ts").alias("hour"),
    )


@query("h12_time_slice", f"""
SELECT event_id, {TS("date_trunc('month', ts)")} AS month, {TS("date_trunc('week', ts)")} AS week,
  {TS("time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01')")} AS slice7,
  {TS("time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '2023-01-03')")} AS slice7_from FROM events""")
def slices(t):
    week = 7 * 86400
    return t.events_ts.select(
        "event_id", ts_text(F.date_trunc("month", "ts")).alias("month"),
        ts_text(F.date_trunc("week", "ts")).alias("week"),
        ts_text(time_slice("ts", week)).alias("slice7"),
        ts_text(time_slice("ts", week, "2023-01-03 00:00:00")).alias("slice7_from"),
    )


@query("h13_date_format", f"""
SELECT event_id, strftime(ts, '%Y%m%d') AS compact,
  {TS("date_trunc('minute', ts)")} AS parsed FROM events""")
def date_formats(t):
    us_text = F.date_format("ts", "MM/dd/yyyy HH:mm")
    return t.events_ts.select(
        "event_id", F.date_format("ts", "yyyyMMdd").alias("compact"),
        ts_text(F.to_timestamp(us_text, "MM/dd/yyyy HH:mm")).alias("parsed"),
    )


@query("h14_numbers", """
SELECT c_custkey, CAST(floor(c_acctbal / 1000) AS BIGINT) AS level,
  CAST(round(CAST(c_acctbal AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded, abs(c_acctbal) AS size,
  c_custkey % 7 AS rest, true AS rand_ok FROM customer""")
def numbers(t):
    """Random integers are seeded; only their range is returned."""
    pick = F.floor(F.rand(7) * 10)
    return t.customer.select(
        "c_custkey", F.floor(F.col("c_acctbal") / 1000).alias("level"),
        F.round(F.col("c_acctbal").cast("decimal(18,2)"), 1).cast("double").alias("rounded"),
        F.abs("c_acctbal").alias("size"), F.pmod("c_custkey", F.lit(7)).alias("rest"),
        pick.between(0, 9).alias("rand_ok"),
    )


@query("h15_json_value", """
SELECT event_id, json_extract_string(props, '$.k') AS k, false AS empty_has_b FROM events""")
def json_value(t):
    blank = F.get_json_object(F.lit(""), "$.b")
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").alias("k"),
        F.coalesce(blank != "", F.lit(False)).alias("empty_has_b"),
    )


@query("h16_decimal_round_up", """
WITH d AS (SELECT event_id, CASE WHEN event_type = 'view' THEN 'n/a'
  ELSE CAST(CAST(CAST(value AS DECIMAL(18,2)) * 7 AS DECIMAL(18,2)) AS VARCHAR) || '1' END x
  FROM events),
n AS (SELECT event_id, TRY_CAST(x AS DECIMAL(28,10)) v FROM d)
SELECT event_id, CAST(CASE WHEN ceil(v * 100) / 100 < 1000 THEN ceil(v * 100) / 100 END AS DOUBLE)
  AS score FROM n""")
def decimal_round_up(t):
    """Two digits away from zero; five digits at most, else null."""
    exact = (F.col("value").cast("decimal(18,2)") * 7).cast("decimal(18,2)").cast("string")
    text = F.when(F.col("event_type") == "view", "n/a").otherwise(F.concat(exact, F.lit("1")))
    return t.events.select("event_id", round_up_decimal(text).cast("double").alias("score"))


@query("h17_json_objects", """
SELECT n_nationkey, '{"id":' || n_nationkey || ',"name":"' || n_name || '"}' AS doc,
  n_name AS name_back FROM nation""")
def json_objects(t):
    doc = F.to_json(F.struct(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")))
    back = F.from_json(doc, "id int, name string")
    return t.nation.select("n_nationkey", doc.alias("doc"), back["name"].alias("name_back"))
