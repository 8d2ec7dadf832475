"""Aggregation queries (E)."""

from pyspark.sql import functions as F

from tidemill.catalog import EMPLOYEES_SQL, query
from tidemill.functions.columns import exact_avg, exact_sum, level_of, money
from tidemill.operators.distinct import (
    bitmap_counts, bitmap_ids, bitmap_intersect, bitmap_rows, bitmap_union, distinct_list,
    extend_dictionary, list_parts,
)

SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format
AVG = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE) / count({0})".format


@query("e01_group_by", f"""
SELECT l_returnflag, l_linestatus, count(*) AS n, {SUM('l_quantity')} AS sum_qty,
  {AVG('l_extendedprice')} AS avg_price, min(l_discount) AS min_disc, max(l_tax) AS max_tax
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_by(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"),
        exact_sum("l_quantity").alias("sum_qty"),
        exact_avg("l_extendedprice").alias("avg_price"),
        F.min("l_discount").alias("min_disc"),
        F.max("l_tax").alias("max_tax"),
    )


@query("e02_global_aggregate", f"""
SELECT count(*) AS n, {SUM('o_totalprice')} AS total, min(o_totalprice) AS low FROM orders""")
def global_aggregate(t):
    return t.orders.agg(
        F.count("*").alias("n"), exact_sum("o_totalprice").alias("total"),
        F.min("o_totalprice").alias("low"),
    )


@query("e03_having", """
SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_partkey HAVING count(*) > 1""")
def having(t):
    """Duplicate-key check."""
    return t.lineitem.groupBy("l_orderkey", "l_partkey").agg(
        F.count("*").alias("n")
    ).filter("n > 1")


DISTINCT_SQL = """
SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type"""


@query("e04_count_distinct", DISTINCT_SQL)
def count_distinct(t):
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"))


@query("e05_bitmap_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY l_returnflag""")
def bitmap_distinct(t):
    """Exact distinct from bitmaps per 32768-id bucket; order keys are dense ids."""
    bits = bitmap_rows(t.lineitem, ["l_returnflag"], "l_orderkey")
    return bitmap_counts(bits, ["l_returnflag"], "orders")


@query("e05_dictionary_distinct", """
SELECT p_size, count(DISTINCT p_name) AS names FROM part GROUP BY p_size""")
def dictionary_distinct(t):
    """Encode the text through a dictionary, then count bits per size."""
    empty = t.part.select("p_name", F.lit(0).cast("bigint").alias("name_id")).filter("false")
    words = extend_dictionary(empty, t.part, "p_name", "name_id")
    coded = t.part.select("p_size", "p_name").join(words, "p_name")
    return bitmap_counts(bitmap_rows(coded, ["p_size"], "name_id"), ["p_size"], "names")


@query("e06_bitmap_union_intersect", """
WITH u AS (SELECT DISTINCT event_type, user_id FROM events
  WHERE event_type IN ('purchase', 'error'))
SELECT (SELECT count(DISTINCT user_id) FROM u) AS any_type,
  (SELECT count(*) FROM (SELECT user_id FROM u GROUP BY user_id HAVING count(*) = 2))
    AS both_types""")
def bitmap_union_intersect(t):
    rows = t.events.filter(F.col("event_type").isin("purchase", "error"))
    bits = bitmap_rows(rows, ["event_type"], "user_id")
    union = bitmap_counts(bitmap_union(bits, []), [], "any_type")
    both = bitmap_counts(
        bitmap_intersect(bits, []).filter("groups = 2"), [], "both_types"
    )
    return union.withColumn(
        "both_types", F.coalesce(both.scalar(), F.lit(0)).cast("bigint")
    )


@query("e06_bitmap_to_string", """
SELECT user_id, string_agg(DISTINCT k, ',' ORDER BY k) AS types, count(DISTINCT k) AS n FROM (
  SELECT user_id, CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
    WHEN 'signup' THEN 4 ELSE 5 END AS k FROM events) GROUP BY user_id""")
def bitmap_to_string(t):
    """Set bits as text: ids of a small code table, at most five per user."""
    code = (F.when(F.col("event_type") == "click", 1).when(F.col("event_type") == "error", 2)
            .when(F.col("event_type") == "purchase", 3).when(F.col("event_type") == "signup", 4)
            .otherwise(5))
    bits = bitmap_rows(t.events.select("user_id", code.alias("k")), ["user_id"], "k")
    return bitmap_ids(bits, ["user_id"], "k").groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_list("k")).cast("array<string>"), ",").alias("types"),
        F.count("*").alias("n"),
    )


@query("e07_distinct", "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def distinct(t):
    return t.orders.select("o_orderstatus", "o_orderpriority").distinct()


@query("e08_listagg", """
SELECT user_id, string_agg(DISTINCT event_type || '-seen', ',' ORDER BY event_type || '-seen')
  AS types, count(*) AS n FROM events GROUP BY user_id""")
def listagg(t):
    """Counted per type first; the list and the total come from those few rows."""
    kinds = t.events.groupBy("user_id", F.concat("event_type", F.lit("-seen")).alias("k")).agg(
        F.count("*").alias("n"))
    return kinds.groupBy("user_id").agg(
        F.array_join(F.array_sort(F.collect_list("k")), ",").alias("types"),
        F.sum("n").alias("n"))


@query("e08_listagg_ordered", """
WITH r AS (SELECT dept_name, emp_name, row_number() OVER (PARTITION BY dept_name ORDER BY emp_no) rn,
  emp_no FROM """ + EMPLOYEES_SQL + """)
SELECT dept_name, CAST((rn - 1) // 1000 + 1 AS BIGINT) AS part,
  string_agg(emp_name, ',' ORDER BY emp_no) AS names, count(*) AS n
FROM r GROUP BY dept_name, (rn - 1) // 1000""")
def listagg_ordered(t):
    """Every name in key order; a list longer than 1000 continues in the next part."""
    return list_parts(
        t.employees, ["dept_name"], "emp_name", [F.col("emp_no")],
        [F.floor(F.col("emp_no") / 65536)], "names",
    )


@query("e09_collect", """
WITH c AS (SELECT user_id, event_type, count(*) n FROM events GROUP BY user_id, event_type)
SELECT user_id, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS multiset,
  string_agg(event_type, ',' ORDER BY event_type) AS types FROM c GROUP BY user_id""")
def collect(t):
    """Multiset as value=count pairs, and the set; both bounded by the value domain."""
    counts = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    pairs = F.array_sort(F.collect_list(F.struct("event_type", "n")))
    return counts.groupBy("user_id").agg(pairs.alias("l")).select(
        "user_id",
        F.array_join(
            F.transform("l", lambda x: F.concat(x["event_type"], F.lit("="), x["n"])), ","
        ).alias("multiset"),
        F.array_join(F.col("l.event_type"), ",").alias("types"),
    )


@query("e10_last_value", """
SELECT user_id, arg_max(value, event_id) FILTER (event_type <> 'error') AS last_ok,
  arg_max(event_type, event_id) AS last_type FROM events GROUP BY user_id""")
def last_value(t):
    """Latest non-null value by sequence."""
    ok = F.col("event_type") != "error"
    return t.events.groupBy("user_id").agg(
        F.max_by(F.when(ok, F.col("value")), F.when(ok, F.col("event_id"))).alias("last_ok"),
        F.max_by("event_type", "event_id").alias("last_type"),
    )


@query("e11_bool_max", """
SELECT user_id, coalesce(bool_or(CASE WHEN event_type <> 'view' THEN value > 400 END), false)
  AS ever_high FROM events GROUP BY user_id""")
def bool_max(t):
    high = F.when(F.col("event_type") != "view", F.col("value") > 400)
    return t.events.groupBy("user_id").agg(
        F.max(high).eqNullSafe(True).alias("ever_high")
    )


def _grouping(kind):
    return f"""
SELECT dept_name, grp, count(*) AS n, CAST(grouping(dept_name) * 2 + grouping(grp) AS BIGINT) AS gid
FROM {EMPLOYEES_SQL} GROUP BY {kind}"""


@query("e12_grouping_sets", _grouping("GROUPING SETS ((dept_name), (grp), (dept_name, grp), ())"))
def grouping_sets(t):
    return t.spark.sql(
        """SELECT dept_name, grp, count(*) AS n, grouping_id(dept_name, grp) AS gid FROM {e}
           GROUP BY GROUPING SETS ((dept_name), (grp), (dept_name, grp), ())
           ORDER BY grouping_id(dept_name, grp)""",
        e=t.employees,
    )


@query("e12_rollup", _grouping("ROLLUP (dept_name, grp)"))
def rollup(t):
    return t.employees.rollup("dept_name", "grp").agg(
        F.count("*").alias("n"), F.grouping_id("dept_name", "grp").alias("gid")
    )


@query("e12_cube", _grouping("CUBE (dept_name, grp)"))
def cube(t):
    return t.employees.cube("dept_name", "grp").agg(
        F.count("*").alias("n"), F.grouping_id("dept_name", "grp").alias("gid")
    )


@query("e13_unpivot_count", """
SELECT site, sum(d) AS delivered, sum(r) AS rejected FROM (
  SELECT 'F' || l_linenumber AS site, 1 AS d, 0 AS r FROM lineitem WHERE l_linestatus = 'F'
  UNION ALL SELECT 'R' || l_suppkey % 7, 0, 1 FROM lineitem WHERE l_returnflag = 'R')
GROUP BY site""".replace("sum(d)", "CAST(sum(d) AS BIGINT)").replace(
    "sum(r)", "CAST(sum(r) AS BIGINT)"))
def unpivot_count(t):
    """Two site columns of one row, counted per site in one pass."""
    rows = t.lineitem.select(
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("F"), "l_linenumber")).alias("succ"),
        F.when(F.col("l_returnflag") == "R",
               F.concat(F.lit("R"), (F.col("l_suppkey") % 7).cast("string"))).alias("rej"),
    )
    sites = rows.select(F.inline(F.array(
        F.struct(F.col("succ").alias("site"), F.lit(1).alias("d"), F.lit(0).alias("r")),
        F.struct(F.col("rej").alias("site"), F.lit(0).alias("d"), F.lit(1).alias("r")),
    ))).filter("site IS NOT NULL")
    return sites.groupBy("site").agg(
        F.sum("d").alias("delivered"), F.sum("r").alias("rejected")
    )


@query("e14_aggregate_of_latest", """
SELECT last_type, count(*) AS users FROM (
  SELECT user_id, arg_max(event_type, event_id) AS last_type FROM events GROUP BY user_id)
GROUP BY last_type""")
def aggregate_of_latest(t):
    return (
        t.events.groupBy("user_id").agg(F.max_by("event_type", "event_id").alias("last_type"))
        .groupBy("last_type").agg(F.count("*").alias("users"))
    )


@query("e15_partial_final", f"""
SELECT l_suppkey, {SUM('l_quantity')} AS qty, count(*) AS n FROM lineitem GROUP BY l_suppkey""")
def partial_final(t):
    """Map-side combine then final merge is what one ``groupBy`` plans."""
    return t.lineitem.groupBy("l_suppkey").agg(
        exact_sum("l_quantity").alias("qty"), F.count("*").alias("n")
    )


@query("e16_composite_key", """
WITH c AS (SELECT o_orderstatus || '_' || o_orderpriority AS k, count(*) n FROM orders GROUP BY 1)
SELECT split_part(k, '_', 1) AS status,
  string_agg(split_part(k, '_', 2) || ':' || n, ',' ORDER BY split_part(k, '_', 2)) AS levels,
  CAST(sum(n) AS BIGINT) AS total FROM c GROUP BY 1""")
def composite_key(t):
    counts = t.orders.groupBy(
        F.concat_ws("_", "o_orderstatus", "o_orderpriority").alias("k")
    ).agg(F.count("*").alias("n"))
    parts = F.split("k", "_")
    entry = F.struct(parts[1].alias("p"), F.concat(parts[1], F.lit(":"), "n").alias("t"))
    return counts.groupBy(parts[0].alias("status")).agg(
        F.array_join(F.array_sort(F.collect_list(entry))["t"], ",").alias("levels"),
        F.sum("n").alias("total"),
    )


@query("e17_members_per_dept", """
WITH r AS (SELECT s_nationkey, s_name, s_suppkey,
  row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) rn FROM supplier)
SELECT s_nationkey, CAST((rn - 1) // 1000 + 1 AS BIGINT) AS part,
  string_agg(s_name, ',' ORDER BY s_suppkey) AS names, count(*) AS n
FROM r GROUP BY s_nationkey, (rn - 1) // 1000""")
def members_per_dept(t):
    return list_parts(
        t.supplier, ["s_nationkey"], "s_name", [F.col("s_suppkey")],
        [F.floor(F.col("s_suppkey") / 65536)], "names",
    )


@query("e17_count_per_dept", f"SELECT dept_no, count(*) AS n FROM {EMPLOYEES_SQL} GROUP BY dept_no")
def count_per_dept(t):
    return t.employees.groupBy("dept_no").agg(F.count("*").alias("n"))


WORDS = "(SELECT unnest(string_split_regex(text, '[ \\t\\n\\r\\f]+')) AS word FROM documents)"


def _spaced_words(t):
    """Words between blanks; splitting at one fixed character needs no regex."""
    text = F.translate("text", "\t\n\r\f", "    ")
    return t.documents.select(F.explode(F.split(text, " ")).alias("word")).filter("word <> ''")


@query("e18_word_count", f"""
SELECT word, count(*) AS n FROM {WORDS} WHERE word <> '' GROUP BY word HAVING count(*) >= 10""")
def word_count(t):
    return _spaced_words(t).groupBy("word").agg(F.count("*").alias("n")).filter("n >= 10")


@query("e18_top_words", f"""
SELECT word, count(*) AS n FROM {WORDS} WHERE word <> '' GROUP BY word
ORDER BY n DESC, word LIMIT 10""")
def top_words(t):
    return (_spaced_words(t).groupBy("word").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "word").limit(10))


@query("e19_char_count", """
SELECT ch, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS ch FROM documents) WHERE ch <> '' GROUP BY ch HAVING count(*) > 10 ORDER BY n DESC, ch LIMIT 10""")
def char_count(t):
    chars = t.documents.select(F.explode(F.split("text", "")).alias("ch"))
    return (chars.filter("ch <> ''").groupBy("ch").agg(F.count("*").alias("n")).filter("n > 10")
            .orderBy(F.desc("n"), "ch").limit(10))


LATIN = "(SELECT lower(unnest(regexp_extract_all(text, '[A-Za-z]+'))) AS word FROM documents)"


def _latin_words(t):
    found = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    return t.documents.select(F.explode(found).alias("w")).select(F.lower("w").alias("word"))


@query("e20_prefix_words", f"""
SELECT word, count(*) AS n FROM {LATIN} WHERE starts_with(word, 'th') GROUP BY word
ORDER BY n DESC, word LIMIT 5""")
def prefix_words(t):
    return (_latin_words(t).filter(F.col("word").startswith("th"))
            .groupBy("word").agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "word").limit(5))


@query("e21_words_by_frequency", f"""
WITH c AS (SELECT word, count(*) n FROM {LATIN} GROUP BY word),
r AS (SELECT *, row_number() OVER (PARTITION BY n ORDER BY word) rn,
  count(*) OVER (PARTITION BY n) words FROM c WHERE n >= 20)
SELECT n AS freq, words, CAST((rn - 1) // 1000 + 1 AS BIGINT) AS part,
  string_agg(word, ',' ORDER BY word) AS list FROM r WHERE words >= 5
GROUP BY n, words, (rn - 1) // 1000""")
def words_by_frequency(t):
    """Frequencies of 20 and more shared by at least 5 words, with the words."""
    counts = _latin_words(t).groupBy("word").agg(F.count("*").alias("freq")).filter("freq >= 20")
    sizes = counts.groupBy("freq").agg(F.count("*").alias("words")).filter("words >= 5")
    parts = list_parts(
        counts, ["freq"], "word", [F.col("word")], [F.substring("word", 1, 2)], "list"
    )
    return parts.drop("n").join(sizes, "freq")


@query("e22_message_after_mark", """
SELECT msg, count(*) AS n FROM (SELECT trim(string_split(line, '---')[2]) AS msg FROM (
  SELECT o_orderkey || '---' || o_orderpriority || ' ' || o_orderstatus AS line FROM orders
  WHERE o_custkey > 10 UNION ALL SELECT o_orderpriority FROM orders WHERE o_custkey <= 10)
  WHERE len(string_split(line, '---')) >= 2) GROUP BY msg ORDER BY n DESC, msg LIMIT 3""")
def message_after_mark(t):
    """Log lines built from orders; lines without the mark are skipped."""
    line = F.when(
        F.col("o_custkey") > 10,
        F.concat(F.col("o_orderkey").cast("string"), F.lit("---"), "o_orderpriority",
                 F.lit(" "), "o_orderstatus"),
    ).otherwise(F.col("o_orderpriority"))
    parts = F.split(line, "---")
    return (t.orders.filter(F.size(parts) >= 2).select(F.trim(parts[1]).alias("msg"))
            .groupBy("msg").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "msg").limit(3))


@query("e23_share_of_total", """
WITH b AS (SELECT CAST(round(CAST(p_retailprice AS DECIMAL(18,2)) / 100, 0) AS INT) AS bucket
  FROM part), c AS (SELECT bucket, count(*) n FROM b GROUP BY bucket)
SELECT bucket, n, CAST(floor(CAST(n AS DOUBLE) / (SELECT count(*) FROM part) * 100 + 0.5) AS INT)
  AS pct FROM c""")
def share_of_total(t):
    """Share in whole percent per half-up rounded bucket; the total is a scalar."""
    bucket = F.round(money("p_retailprice") / 100, 0).cast("int").alias("bucket")
    total = t.part.agg(F.count("*")).scalar()
    return t.part.groupBy(bucket).agg(F.count("*").alias("n")).withColumn(
        "pct", F.floor(F.col("n").cast("double") / total * 100 + 0.5).cast("int")
    )


@query("e24_levels", """
WITH p AS (SELECT p_partkey, p_size * 0.45 - 1.2 AS years FROM part),
l AS (SELECT p_partkey, CAST(round(years) AS INT) y FROM p)
SELECT CASE WHEN y < 0 THEN '-' WHEN y <= 3 THEN 'F' WHEN y <= 6 THEN 'E' WHEN y <= 9 THEN 'D'
  WHEN y <= 12 THEN 'C' WHEN y <= 15 THEN 'B' WHEN y <= 18 THEN 'A' ELSE 'S' END AS level,
  count(*) AS n, string_agg(DISTINCT y, ',' ORDER BY y) AS years FROM l GROUP BY 1""")
def levels(t):
    """Level letter per rounded number of years, with the distinct years of each."""
    years = F.round(F.col("p_size") * F.lit(0.45).cast("decimal(4,2)")
                    - F.lit(1.2).cast("decimal(4,2)")).cast("int")
    counts = t.part.select(years.alias("y")).groupBy("y").agg(F.count("*").alias("n"))
    return counts.groupBy(level_of(F.col("y")).alias("level")).agg(
        F.sum("n").alias("n"),
        F.array_join(F.array_sort(F.collect_list("y")).cast("array<string>"), ",").alias("years"),
    )


@query("e25_decade_report", """
SELECT p_size - p_size % 10 AS decade,
  count(*) FILTER (p_type = 'SMALL') AS small_n, count(*) FILTER (p_type <> 'SMALL') AS other_n,
  count(*) AS n, min(p_size) AS low, max(p_size) AS high,
  floor(count(*) FILTER (p_type = 'SMALL') * 1000.0 / count(*) + 0.5) / 10 AS small_pct
FROM part GROUP BY 1""")
def decade_report(t):
    small = F.count_if(F.col("p_type") == "SMALL")
    rate = F.floor(small * F.lit(1000.0) / F.count("*") + 0.5) / 10
    return t.part.groupBy((F.col("p_size") - F.col("p_size") % 10).alias("decade")).agg(
        small.alias("small_n"), F.count_if(F.col("p_type") != "SMALL").alias("other_n"),
        F.count("*").alias("n"), F.min("p_size").alias("low"), F.max("p_size").alias("high"),
        rate.alias("small_pct"),
    )


@query("e26_slow_report", """
SELECT event_type, count(*) AS n, min(value) AS low, max(value) AS high,
  floor(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*) + 0.5) AS avg_value
FROM events WHERE value > 100
  AND ts >= (SELECT max(ts) FROM events) - INTERVAL 5 DAY GROUP BY event_type""")
def slow_report(t):
    """Statements slower than a bound in the five days before the newest entry."""
    newest = t.events.agg(F.max("ts")).scalar()
    return (
        t.events.filter((F.col("value") > 100)
                        & (F.col("ts") >= newest - F.expr("INTERVAL '5' DAY")))
        .groupBy("event_type")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"),
             F.floor(exact_avg("value") + 0.5).cast("double").alias("avg_value"))
        .orderBy(F.desc("n"))
    )


@query("e27_site_count", """
SELECT site, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS site FROM part)
GROUP BY site""")
def site_count(t):
    return (t.part.select(F.explode(F.split("p_name", " ")).alias("site"))
            .groupBy("site").agg(F.count("*").alias("n")))
