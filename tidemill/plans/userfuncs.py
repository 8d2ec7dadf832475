"""User function queries (J)."""

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions import tablefuncs as tf
from tidemill.functions.columns import round_up_decimal
from tidemill.operators.distinct import list_parts


@query("j01_registered_function", """
SELECT c_custkey, upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS title
FROM customer""")
def registered_function(t):
    """An Arrow-batched function registered by name and called from SQL."""

    def title(s: pd.Series) -> pd.Series:
        return s.str.capitalize()

    t.spark.udf.register("tidemill_title", F.pandas_udf(title, T.StringType()))
    return t.spark.sql(
        "SELECT c_custkey, tidemill_title(c_mktsegment) AS title FROM {c}", c=t.customer)


@query("j01_registered_table_function", """
SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part""")
def registered_table_function(t):
    """A table function over Arrow batches of a whole table argument, registered by name."""

    class Words:
        def eval(self, rows: pa.RecordBatch):
            split = pc.split_pattern(pc.fill_null(rows.column("p_name"), ""), " ")
            words = pa.table({
                "p_partkey": rows.column("p_partkey").take(pc.list_parent_indices(split)),
                "word": pc.list_flatten(split)})
            yield words.filter(pc.not_equal(words["word"], ""))

    t.spark.udtf.register(
        "tidemill_words", F.arrow_udtf(Words, returnType="p_partkey bigint, word string"))
    return t.spark.sql(
        "SELECT p_partkey, word FROM tidemill_words(TABLE({p}))",
        p=t.part.select(F.col("p_partkey").cast("bigint"), "p_name"))


@query("j02_scalar_overloads", """
SELECT event_id, CAST(ceil(CAST(value AS DECIMAL(28,10)) * 100) / 100 AS DOUBLE) AS score,
  'num:' || user_id AS num_text, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS shown FROM events""")
def scalar_overloads(t):
    """Decimal and row results, and one name for several input types."""
    pair = F.struct(
        round_up_decimal(F.col("value").cast("string")).cast("double").alias("score"),
        F.concat(F.lit("num:"), F.col("user_id").cast("string")).alias("num_text"))
    return t.events_ts.select(
        "event_id", pair.alias("r"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("shown")
    ).select("event_id", "r.score", "r.num_text", "shown")


def score_store(t):
    """Key-value pairs: scores of some names, and of all ids."""
    by_name = t.part.filter("p_size > 30").groupBy("p_name").agg(
        F.max("p_retailprice").alias("v")
    ).select(F.concat(F.lit("num_"), "p_name").alias("key"), (F.col("v") / 7).cast("decimal(18,4)")
             .cast("string").alias("value"))
    by_id = t.supplier.select(
        F.concat(F.lit("num_byid_"), F.col("s_suppkey").cast("string")).alias("key"),
        F.col("s_suppkey").cast("string").alias("value"))
    return by_name.unionByName(by_id)


@query("j03_external_lookup", """
WITH n AS (SELECT p_name, CAST(max(p_retailprice) / 7 AS DECIMAL(18,4)) v FROM part
  WHERE p_size > 30 GROUP BY p_name),
r AS (SELECT p_partkey, CAST(ceil(v * 100) / 100 AS DOUBLE) a, CAST(s_suppkey AS DOUBLE) b FROM part
  LEFT JOIN n USING (p_name) LEFT JOIN supplier ON s_suppkey = p_partkey)
SELECT p_partkey, CASE WHEN a < 1000 THEN 'useName' ELSE 'useId' END AS use_which,
  coalesce(CASE WHEN a < 1000 THEN a END, b) AS score FROM r""")
def external_lookup(t):
    rows = tf.score_lookup(t.part, score_store(t), "p_name", "p_partkey")
    return rows.select("p_partkey", "use_which", F.col("score").cast("double").alias("score"))


@query("j03_alias_search", """
SELECT p_partkey, 'alias_' || p_partkey AS key, s_name AS value FROM part
JOIN supplier ON s_suppkey = p_partkey""")
def alias_search(t):
    store = t.supplier.select(
        F.concat(F.lit("alias_"), F.col("s_suppkey").cast("string")).alias("key"),
        F.col("s_name").alias("value"))
    return tf.alias_search(t.part, store, "p_partkey").select("p_partkey", "key", "value")


@query("j04_explode_csv", """
SELECT p_partkey, unnest(string_split(replace(p_name, ' ', ','), ',')) AS part FROM part
WHERE p_size > 10""")
def explode_csv(t):
    text = F.when(F.col("p_size") > 10, F.regexp_replace("p_name", " ", ",")).otherwise("  ")
    return t.part.select("p_partkey", tf.explode_csv(text).alias("part"))


@query("j05_length_words", """
SELECT id, word, CAST(length(word) AS INT) AS length FROM (
  SELECT p_partkey AS id, p_name AS word FROM part
  UNION ALL SELECT p_partkey, 'num:' || p_partkey FROM part WHERE p_partkey >= 5
  UNION ALL SELECT p_partkey, 'obj:' || (p_size > 10) FROM part
  UNION ALL SELECT p_partkey, 'nums sum:' || CAST(p_size * 0.5::DOUBLE AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'nums sum:' || CAST(p_size * 0.75::DOUBLE AS VARCHAR) FROM part)""")
def length_words(t):
    """The overloads for text, whole numbers, a double, many doubles and other types."""
    rows = t.part.select(
        F.col("p_partkey").alias("id"), "p_name", (F.col("p_size") > 10).alias("big"),
        (F.col("p_size") * F.lit(0.5)).alias("half"),
        (F.col("p_size") * F.lit(0.25)).alias("quarter"))
    out = rows.select("id", F.inline(tf.length_words_sum(F.col("half"), F.col("quarter"))))
    for col in ("p_name", "id", "big", "half"):
        out = out.unionByName(rows.select("id", F.inline(tf.length_words(rows, col))))
    return out


@query("j06_generate_rows", """
SELECT l_orderkey, id, name, 'one' AS param1, 'two' AS param2 FROM (
  SELECT l_orderkey, unnest([l_linenumber, l_linenumber + 10]) AS id,
    unnest([l_returnflag, l_linestatus]) AS name FROM lineitem)""")
def generate_rows(t):
    rows = tf.generate_rows(
        F.array(F.col("l_linenumber"), F.col("l_linenumber") + 10),
        F.array("l_returnflag", "l_linestatus"), {"param1": "one", "param2": "two"})
    return t.lineitem.select("l_orderkey", F.inline(rows))


@query("j06_generate_numbered", """
SELECT p_partkey, id, p_brand || '-' || id AS name, 'one' AS param1 FROM (
  SELECT p_partkey, p_brand, unnest(range(1, p_size % 4 + 1))::INT AS id FROM part)
UNION ALL SELECT p_partkey, id, CAST(id AS VARCHAR), 'one' FROM (
  SELECT p_partkey, unnest(range(1, 11))::INT AS id FROM part)""")
def generate_numbered(t):
    """The form with a number and a prefix, taken from columns, and the form with neither."""
    rows = t.part.select("p_partkey", F.inline(tf.generate_numbered(
        F.col("p_size") % 4, F.concat("p_brand", F.lit("-")), {"param1": "one"})))
    return rows.unionByName(t.part.select("p_partkey", F.inline(tf.generate_numbered(
        F.lit(10), F.lit(""), {"param1": "one"}))))


@query("j07_unique_strings", """
SELECT user_id, string_agg(DISTINCT x, ',' ORDER BY x) AS joined, count(DISTINCT x) AS n,
  string_agg(DISTINCT y, ',' ORDER BY y) AS pairs FROM (SELECT user_id, event_type AS x,
  event_type || '-' || CASE WHEN value > 50 THEN 'hi' ELSE 'lo' END AS y FROM events)
GROUP BY user_id""")
def unique_strings(t):
    level = F.when(F.col("value") > 50, "hi").otherwise("lo")
    both = tf.unique_strings(t.events, ["user_id"], F.col("event_type"),
                             two=(F.col("event_type"), level))
    return both.select(
        "user_id", "uniq.joined", F.size("uniq.items").cast("bigint").alias("n"),
        F.col("two.joined").alias("pairs"))


@query("j07_unique_strings_retract", """
WITH ch AS (SELECT user_id, event_type AS x, CASE WHEN event_id % 3 = 0 THEN -1 ELSE 1 END AS s
  FROM events), held AS (SELECT user_id, x FROM ch GROUP BY 1, 2 HAVING sum(s) > 0)
SELECT user_id, string_agg(x, ',' ORDER BY x) AS joined FROM held GROUP BY user_id""")
def unique_strings_retract(t):
    """Every third row takes its text back; a text is listed while some row still holds it."""
    rows = t.events.withColumn("op", F.when(F.col("event_id") % 3 == 0, "-D").otherwise("+I"))
    return tf.unique_strings_with_retract(
        rows, ["user_id"], F.col("event_type"), "op").select("user_id", "uniq.joined")


@query("j08_alias_list", """
WITH r AS (SELECT n_name, s_suppkey || '_' || s_name AS x, s_suppkey,
  row_number() OVER (PARTITION BY n_name ORDER BY s_suppkey) rn
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT n_name, CAST((rn - 1) // 1000 + 1 AS BIGINT) AS part,
  string_agg(x, ',' ORDER BY s_suppkey) AS aliases, count(*) AS n FROM r GROUP BY n_name, (rn - 1) // 1000""")
def alias_list(t):
    """Members with their looked-up alias, listed per group in bounded parts."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "n_name", "s_suppkey",
        F.concat_ws("_", F.col("s_suppkey").cast("string"), "s_name").alias("x"))
    return list_parts(rows, ["n_name"], "x", [F.col("s_suppkey")],
                      [F.floor(F.col("s_suppkey") / 65536)], "aliases")


@query("j09_any_type_array", f"""
SELECT dept_no, string_agg(DISTINCT x, ',' ORDER BY x) AS items FROM (
  SELECT dept_no, CAST(CAST(floor(salary / 1000) AS BIGINT) AS VARCHAR) AS x FROM {EMPLOYEES_SQL})
GROUP BY dept_no""")
def any_type_array(t):
    """Distinct values of any type as text; nulls are skipped."""
    rows = tf.unique_strings(t.employees, ["dept_no"], F.floor(F.col("salary") / 1000))
    return rows.select("dept_no", F.col("uniq.joined").alias("items"))


@query("j10_job_parameters", """
SELECT o_orderkey, 'demo' AS my_param, o_totalprice > 200000 AS big FROM orders""")
def job_parameters(t):
    """Job-wide parameters travel in the session settings."""
    t.spark.conf.set("tidemill.job.my-param", "demo")
    t.spark.conf.set("tidemill.job.limit", "200000")
    limit = float(t.spark.conf.get("tidemill.job.limit"))
    return t.orders.select(
        "o_orderkey", F.lit(t.spark.conf.get("tidemill.job.my-param")).alias("my_param"),
        (F.col("o_totalprice") > limit).alias("big"))


@query("j11_counters", """
SELECT count(*) AS seen, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem""")
def counters(t):
    """Counts taken on the side while the rows are used for something else."""
    from pyspark.sql import Observation

    seen = Observation()
    rows = t.lineitem.observe(
        seen, F.count("*").alias("seen"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))
    rows.select("l_orderkey").write.format("noop").mode("overwrite").save()
    return t.spark.range(1).select(
        F.lit(seen.get["seen"]).cast("bigint").alias("seen"),
        F.lit(seen.get["returned"]).cast("bigint").alias("returned"))
