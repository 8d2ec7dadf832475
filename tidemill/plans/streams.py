"""Streaming queries (I), and the stream forms of joins, sinks and sources.

Every query runs a real stream over the given table with an available-now
trigger and reads back what it wrote. Append-mode windows close when the
watermark passes their end, which the check SQL repeats as a filter.
"""

import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.catalog import query
from tidemill.functions.columns import day_text, exact_sum, money, ts_text
from tidemill.operators.joining import interval_join
from tidemill.operators.spread import rebalanced
from tidemill.operators.tables import between_commits
from tidemill.plans.joins import (
    INTERVAL_SQL, SIX_HOURS, clicks_and_views,
)
from tidemill.plans.lifecycle import CHANGES_SQL, STATE_SQL, changes
from tidemill.session import make_active, managed_database, qualified, work_dir
from tidemill.sources import broker
from tidemill.streaming import state
from tidemill.streaming.enrich import async_enrich
from tidemill.streaming.follow import snapshot_then_follow
from tidemill.streaming.keyvalue import KeyValueSink, live_values
from tidemill.streaming.runner import run_batches, run_to_files
from tidemill.streaming.timers import late_windows, stream_asof_join
from tidemill.streaming.sinks import (
    BatchLog, BudgetedLoad, LateSplitter, PartitionCommitter, UpsertLog, fan_out,
    reloading_lookup,
)

SUM = "CAST(sum(CAST({0} AS DECIMAL(18,2))) AS DOUBLE)".format
TS = "strftime({0}, '%Y-%m-%d %H:%M:%S')".format


def windowed_sql(unit, keys, aggs, delay="30 SECOND", source="events"):
    """Closed tumbling windows of ``unit`` (interval text) by keys."""
    key_list = f"{keys}, " if keys else ""
    group = f"w, {keys}" if keys else "w"
    return f"""
WITH e AS (SELECT *, time_bucket(INTERVAL {unit}, ts, TIMESTAMP '1970-01-01') AS w FROM {source})
SELECT {TS('w')} AS window_start, {TS(f'w + INTERVAL {unit}')} AS window_end, {key_list}{aggs}
FROM e WHERE w + INTERVAL {unit} <= (SELECT max(ts) FROM {source}) - INTERVAL {delay}
GROUP BY {group}"""


def flat(df):
    """Window columns as text."""
    return df.select(
        ts_text(F.col("window.start")).alias("window_start"),
        ts_text(F.col("window.end")).alias("window_end"),
        *[c for c in df.columns if c != "window"],
    )


def tumble(df, size, keys, aggs, delay="30 seconds"):
    """One function for batch and stream frames; a batch ignores the watermark."""
    return df.withWatermark("ts", delay).groupBy(F.window("ts", size), *keys).agg(*aggs)


@query("i01_watermark", windowed_sql("1 DAY", "user_id", "count(*) AS n", "2 HOUR"))
def watermark(t):
    rows = tumble(t.events_stream, "1 day", ["user_id"], [F.count("*").alias("n")], "2 hours")
    return flat(run_to_files(rows, "i01"))


@query("i02_monotonous", windowed_sql("1 HOUR", "", "count(*) AS n", "0 SECOND"))
def monotonous(t):
    rows = tumble(t.events_stream, "1 hour", [], [F.count("*").alias("n")], "0 seconds")
    return flat(run_to_files(rows, "i02"))


@query("i03_source_event_time", windowed_sql("4 HOUR", "event_type", "count(*) AS n", "5 MINUTE"))
def source_event_time(t):
    """Event time travels inside the record, as the source set it.

    Spark moves the watermark between micro-batches; a source cannot emit one
    after every n-th record. The closed windows are the same.
    """
    records = t.events_stream.select(
        F.to_json(F.struct(F.unix_micros("ts").alias("at"), "event_type")).alias("doc"))
    rows = records.select(F.from_json("doc", "at BIGINT, event_type STRING").alias("r")).select(
        F.timestamp_micros("r.at").alias("ts"), "r.event_type")
    out = tumble(rows, "4 hours", ["event_type"], [F.count("*").alias("n")], "5 minutes")
    return flat(run_to_files(out, "i03"))


@query("i04_minimum_watermark", INTERVAL_SQL.format(how=""))
def minimum_watermark(t):
    """Two inputs with their own watermark; time follows the slower one."""
    clicks, views = clicks_and_views(t.events_stream)
    rows = interval_join(
        clicks.withWatermark("click_ts", "30 seconds"), views.withWatermark("view_ts", "30 seconds"),
        [("click_user", "view_user")], "click_ts", "view_ts", 0, SIX_HOURS,
    ).select("click_id", "view_id")
    return run_to_files(
        rows, "i04", spark__sql__streaming__multipleWatermarkPolicy="min")


@query("i05_idle_input", windowed_sql("6 HOUR", "", "count(*) AS n", source="""(SELECT ts FROM events
  WHERE event_type <> 'signup' UNION ALL SELECT ts FROM events WHERE event_type = 'signup'
  AND user_id < 0)"""))
def idle_input(t):
    """An input without rows does not hold time back: union first, then watermark."""
    active = t.events_stream.filter("event_type <> 'signup'").select("ts")
    idle = t.events_stream.filter("event_type = 'signup' AND user_id < 0").select("ts")
    rows = tumble(active.unionByName(idle), "6 hours", [], [F.count("*").alias("n")])
    return flat(run_to_files(rows, "i05"))


@query("i06_processing_time", """
SELECT event_type, CASE event_type WHEN 'error' THEN 2 ELSE 1 END AS arrival, count(*) AS n,
  true AS stamped FROM events GROUP BY event_type""")
def processing_time(t):
    """Windows on the time of arrival: errors come in a second batch, so in later windows."""
    rows = two_files(t, "i06-files", t.events, F.col("event_type") == "error").withColumn(
        "proc_time", F.current_timestamp())
    windows = rows.groupBy(F.window("proc_time", "1 millisecond"), "event_type").agg(
        F.count("*").alias("n"))
    log = UpsertLog(t.spark, work_dir(t.spark, "i06"), ["window", "event_type"])
    run_batches(windows, log.upsert, "i06", mode="update")
    seen = log.current()
    # one row per window, thus per micro-batch
    starts = seen.select(F.col("window.start").alias("start")).distinct()
    order = starts.agg(F.array_sort(F.collect_list("start"))).scalar()
    return seen.select(
        "event_type", F.array_position(order, F.col("window.start")).cast("int").alias("arrival"),
        "n", F.col("window.start").isNotNull().alias("stamped"))


@query("i07_tumbling_window", windowed_sql("1 DAY", "event_type", f"""count(*) AS n,
  {SUM('value')} AS total, max(value) AS high, arg_max(user_id, ts) AS last_user"""))
def tumbling_window(t):
    rows = tumble(t.events_stream, "1 day", ["event_type"], [
        F.count("*").alias("n"), exact_sum("value").alias("total"), F.max("value").alias("high"),
        F.max_by("user_id", "ts").alias("last_user"),
    ])
    return flat(run_to_files(rows, "i07"))


@query("i08_subsecond_window", """
SELECT w AS window_ms, count(*) AS n FROM (SELECT epoch_ms(time_bucket(INTERVAL 300 MILLISECOND, ts,
  TIMESTAMP '1970-01-01')) AS w FROM events) WHERE w + 300 <= (SELECT epoch_ms(max(ts)) FROM events)
GROUP BY w""")
def subsecond_window(t):
    rows = tumble(t.events_stream, "300 milliseconds", [], [F.count("*").alias("n")], "0 seconds")
    out = run_to_files(rows, "i08")
    return out.select(F.unix_millis("window.start").alias("window_ms"), "n")


@query("i09_window_list", windowed_sql(
    "1 DAY", "user_id", "string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types"))
def window_list(t):
    """The elements of each keyed window, as the set of a bounded domain."""
    rows = tumble(t.events_stream, "1 day", ["user_id"],
                  [F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("types")])
    return flat(run_to_files(rows, "i09"))


@query("i10_incremental_window", windowed_sql(
    "12 HOUR", "user_id", f"""count(*) AS n, {SUM('value')} / count(*) AS mean,
  'user ' || user_id AS label""").replace("GROUP BY w, user_id", "GROUP BY w, user_id"))
def incremental_window(t):
    rows = tumble(t.events_stream, "12 hours", ["user_id"],
                  [F.count("*").alias("n"), F.sum(money("value")).alias("s")])
    named = rows.select(
        "window", "user_id", "n", (F.col("s").cast("double") / F.col("n")).alias("mean"),
        F.concat(F.lit("user "), F.col("user_id").cast("string")).alias("label"))
    return flat(run_to_files(named, "i10"))


@query("i11_global_window", windowed_sql("6 HOUR", "", f"count(*) AS n, {SUM('value')} AS total"))
def global_window(t):
    rows = tumble(t.events_stream, "6 hours", [],
                  [F.count("*").alias("n"), exact_sum("value").alias("total")])
    return flat(run_to_files(rows, "i11"))


def first_in_time(rows, keys, ts, delay):
    """Rows of a stream without those whose key came less than ``delay`` before."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def two_files(t, label, rows, second):
    """Stream of ``rows`` in two files, those under ``second`` in the later one."""
    out = work_dir(t.spark, label)
    rows.filter(~second).coalesce(1).write.parquet(out)
    rows.filter(second).coalesce(1).write.mode("append").parquet(out)
    return t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(out)


@query("i12_late_side_output", """
WITH m AS (SELECT max(ts) - INTERVAL 30 MINUTE AS wm FROM events WHERE event_type <> 'error')
SELECT event_type, event_type = 'error' AND time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '1970-01-01')
  + INTERVAL 1 HOUR <= wm AS late, count(*) AS n FROM events, m GROUP BY 1, 2""")
def late_side_output(t):
    """Errors come in a second batch; those of closed windows are the late side."""
    split = LateSplitter(t.spark, work_dir(t.spark, "i12"), "ts", "1 hour", "30 minutes")
    rows = two_files(t, "i12-files", t.events_ts, F.col("event_type") == "error")
    run_batches(rows, split.process, "i12")
    return split.rows().groupBy("event_type", "late").agg(F.count("*").alias("n"))


@query("i12_second_firing", """
WITH e AS (SELECT CAST(user_id % 7 AS VARCHAR) AS key, time_bucket(INTERVAL 1 DAY, ts) AS w, ts, event_id,
  CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 3 ELSE 1 END AS b FROM events),
m AS (SELECT max(ts) FILTER (b = 1) AS m1, max(ts) FILTER (b < 3) AS m2, max(ts) AS m3 FROM e),
r AS (SELECT *, w + INTERVAL 1 DAY AS e, CASE b WHEN 2 THEN m1 WHEN 3 THEN m2 END AS mark FROM e, m),
k AS (SELECT *, coalesce(mark >= e + INTERVAL 10 DAY, false) AS gone,
  coalesce(mark >= e, false) AS again FROM r),
c AS (SELECT key, w, e, m3, count(*) FILTER (NOT again) AS n0, count(*) FILTER (again) AS n1
  FROM k WHERE NOT gone GROUP BY ALL)
SELECT key, epoch_ms(w) AS window_ms, 'fired' AS kind, 1 AS firing, n0 AS n FROM c
  WHERE n0 > 0 AND e <= m3
UNION ALL SELECT key, epoch_ms(w), 'fired', CAST((n0 > 0)::INT + j AS INT), n0 + j
  FROM (SELECT *, unnest(range(1, n1 + 1)) AS j FROM c)
UNION ALL SELECT key, epoch_ms(w), 'late', 0, count(*) FROM k WHERE gone GROUP BY key, w""")
def second_firing(t):
    """Days by key over three batches: errors and signups come after most days have fired.

    A day takes late rows for ten days more and fires for each of them; older days send theirs to
    the side.
    """
    turn = (F.when(F.col("event_type") == "error", 1).when(F.col("event_type") == "signup", 2)
            .otherwise(0))
    rows = t.events_ts.select("ts", "event_id", F.pmod("user_id", F.lit(7)).alias("key"),
                              turn.alias("turn"))
    out = work_dir(t.spark, "i12-turns")
    for k in range(3):
        rows.filter(F.col("turn") == k).coalesce(1).write.mode("append").parquet(out)
    stream = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(out)
    day = 86_400_000
    fired = run_to_files(late_windows(stream, "key", "ts", "event_id", day, 10 * day), "i12",
                         rocksdb=True)
    return fired.groupBy("key", "window_ms", "kind", "firing").agg(F.sum("n").alias("n"))


RUNNING_SQL = f"""
SELECT user_id, count(*) AS n, {SUM('value')} AS total FROM events GROUP BY user_id"""


@query("i13_running_aggregate", RUNNING_SQL)
def running_aggregate(t):
    """Update mode: each batch stores its changed totals, the newest per key counts."""
    rows = t.events_stream.groupBy("user_id").agg(
        F.count("*").alias("n"), exact_sum("value").alias("total"))
    log = UpsertLog(t.spark, work_dir(t.spark, "i13"), ["user_id"])
    run_batches(rows, log.upsert, "i13", mode="update")
    return log.current()


KEYED_SQL = """
WITH c AS (SELECT user_id AS key, event_type, count(*) k, sum(event_id) s FROM events
  WHERE {} GROUP BY 1, 2)
SELECT key, sum(k)::BIGINT AS n, sum(k)::BIGINT AS listed, sum(s)::BIGINT AS id_total,
  string_agg(event_type || '=' || k, ',' ORDER BY event_type) AS kinds FROM c GROUP BY key""".format


def _keyed(df):
    return df.select(F.col("user_id").alias("key"), F.col("event_id").alias("id"),
                     F.col("event_type").alias("kind"))


@query("i14_keyed_state", KEYED_SQL("true"))
def keyed_state(t):
    """Value, list and map state per user and salt, kept in the state store over two batches."""
    log = BatchLog(t.spark, work_dir(t.spark, "i14"))
    rows = two_files(t, "i14-files", t.events, F.col("event_id") % 2 == 1)
    run_batches(state.keyed_totals(_keyed(rows), salts=4), log.write, "i14", mode="update",
                rocksdb=True)
    return state.merged_totals(log.rows())


@query("i16_state_ttl", KEYED_SQL("event_id % 2 = 1"))
def state_ttl(t):
    """The second batch comes after the state of the first has expired and starts anew."""
    log = BatchLog(t.spark, work_dir(t.spark, "i16"))
    rows = two_files(t, "i16-files", t.events, F.col("event_id") % 2 == 1)

    def slow(batch, batch_id):
        log.write(batch, batch_id)
        time.sleep(1.5)

    run_batches(
        state.keyed_totals(_keyed(rows), ttl_ms=1000), slow, "i16", mode="update",
        rocksdb=True, spark__sql__streaming__noDataMicroBatches__enabled="false")
    return state.merged_totals(log.only(1))


@query("i15_running_sum_in_sink", f"SELECT {SUM('value')} AS total FROM events")
def running_sum_in_sink(t):
    """Each batch adds one partial sum to the log; the total is their sum."""
    log = BatchLog(t.spark, work_dir(t.spark, "i15"))
    run_batches(
        t.events_stream,
        lambda b, i: log.write(b.agg(F.sum(money("value")).alias("s")).coalesce(1), i), "i15")
    return log.rows().agg(F.sum("s").cast("double").alias("total"))


@query("i17_async_enrich", """
SELECT event_id, 'user-' || user_id AS label FROM events""")
def async_lookup(t):
    def client():
        return lambda k: f"user-{k}"

    rows = async_enrich(t.events_stream.select("event_id", "user_id"), "user_id", "label", client)
    return run_to_files(rows.select("event_id", "label"), "i17")


@query("i18_feedback_loop", """
SELECT p_partkey, p_size + 2 * s AS v FROM part, (VALUES (1), (2), (3), (4), (5)) AS x(s)
WHERE p_size + 2 * s <= 10""")
def feedback_loop(t):
    """``v + 2`` is fed back while it is at most 10, as one recursive query.

    Values only grow, so the rounds end; the level bounds them should the rule ever change.
    """
    return t.spark.sql("""
        WITH RECURSIVE fed(p_partkey, v) MAX RECURSION LEVEL 20 AS (
          SELECT p_partkey, p_size + 2 FROM {p} WHERE p_size + 2 <= 10
          UNION ALL SELECT p_partkey, v + 2 FROM fed WHERE v + 2 <= 10)
        SELECT p_partkey, v FROM fed""", p=t.part)


@query("i19_map_filter_flatmap", """
SELECT event_id, unnest([event_type, upper(event_type)]) AS tag FROM events WHERE value > 20""")
def map_filter_flatmap(t):
    rows = t.events_stream.filter("value > 20").select(
        "event_id", F.explode(F.array("event_type", F.upper("event_type"))).alias("tag"))
    return run_to_files(rows, "i19")


@query("i20_record_rewrite", """
SELECT 'new-' || user_id AS key, 'new-' || event_type AS value FROM events""")
def record_rewrite(t):
    rows = t.events_stream.select(
        F.concat(F.lit("new-"), F.col("user_id").cast("string")).alias("key"),
        F.concat(F.lit("new-"), "event_type").alias("value"))
    return run_to_files(rows, "i20")


def priced(df):
    """The same transformation for both kinds of reader."""
    return df.filter("event_type = 'purchase'").select(
        "event_id", F.round(F.col("value").cast("decimal(18,2)") * 2, 1).cast("double").alias("p"))


@query("i21_batch_stream_switch", """
SELECT m AS mode, event_id, CAST(round(CAST(value AS DECIMAL(18,2)) * 2, 1) AS DOUBLE) AS p
FROM events, (VALUES ('batch'), ('stream')) AS v(m) WHERE event_type = 'purchase'""")
def batch_stream_switch(t):
    stream = run_to_files(priced(t.events_stream), "i21").withColumn("mode", F.lit("stream"))
    return priced(t.events_ts).withColumn("mode", F.lit("batch")).unionByName(stream)


@query("i22_start_commit", f"""
WITH {CHANGES_SQL} SELECT event_id, op, commit_id FROM ch WHERE commit_id >= 20""")
def start_commit(t):
    """A stream of commit-tagged rows from a start commit on."""
    out = work_dir(t.spark, "i22")
    rebalanced(changes(t).select("event_id", "op", "commit_id"), "commit_id").write.partitionBy(
        "commit_id").parquet(out)
    rows = t.spark.readStream.schema("event_id BIGINT, op STRING, commit_id BIGINT").parquet(out)
    return run_to_files(
        between_commits(rows, "commit_id", F.lit(20), include_start=True), "i22")


@query("i22_snapshot_then_follow", f"""
WITH {CHANGES_SQL}
SELECT 'latest' AS rule, user_id, '+I' AS op, event_type, value FROM {STATE_SQL('true')}
UNION ALL SELECT 'chosen', user_id, '+I', event_type, value FROM {STATE_SQL('commit_id <= 9')}
UNION ALL SELECT 'chosen', user_id, op, event_type, value FROM ch WHERE commit_id > 9
UNION ALL SELECT 'compacted', user_id, '+I', event_type, value FROM {STATE_SQL(
    'commit_id <= (SELECT max(commit_id) // 7 * 7 FROM ch)')}
UNION ALL SELECT 'compacted', user_id, op, event_type, value FROM ch
  WHERE commit_id > (SELECT max(commit_id) // 7 * 7 FROM ch)""")
def follow_from_state(t):
    """State first, then changes: from the latest commit, a chosen one, the last compacted one."""
    rows = changes(t).select("user_id", "op", "commit_id", "event_id", "event_type", "value")
    path = work_dir(t.spark, "i22-log")
    rebalanced(rows, "commit_id").write.partitionBy("commit_id").parquet(path)
    kept = t.spark.read.schema(rows.schema).parquet(path)
    newest = kept.agg(F.max("commit_id")).first()[0] or 0
    out = None
    for rule, at in (("latest", newest), ("chosen", 9), ("compacted", newest // 7 * 7)):
        log = BatchLog(t.spark, work_dir(t.spark, f"i22-{rule}"))
        # run twice: a restart that is given a later commit goes on where the first run began
        for begin in (at, newest):
            got = snapshot_then_follow(
                kept, t.spark.readStream.schema(rows.schema).parquet(path), ["user_id"], "op",
                "commit_id", ["event_id"], F.lit(begin), ["event_type", "value"], log,
                f"i22{rule}")
        got = got.select(F.lit(rule).alias("rule"), "user_id", "op", "event_type", "value")
        out = got if out is None else out.unionByName(got)
    return out


@query("i23_error_budget", """
SELECT count(*) AS scan_rows, count(*) FILTER (event_type = 'error') AS filtered_rows,
  count(*) FILTER (event_type <> 'error') AS sink_rows, count(*) FILTER (event_type <> 'error')
  AS stored FROM events""")
def error_budget(t):
    load = BudgetedLoad(t.spark, work_dir(t.spark, "i23"), F.col("event_type") == "error",
                        max_ratio=0.5)
    run_batches(t.events_stream, load.process, "i23")
    stored = load.rows().agg(F.count("*")).scalar()
    return load.report.rows().select("scan_rows", "filtered_rows", "sink_rows").agg(
        *[F.sum(c).alias(c) for c in ("scan_rows", "filtered_rows", "sink_rows")]
    ).withColumn("stored", stored)


# --- joins on streams -------------------------------------------------------


@query("d08_stream_left_join", f"""
WITH p AS ({INTERVAL_SQL.format(how='LEFT')}),
w AS (SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'view'))
  - INTERVAL 30 SECOND - INTERVAL 6 HOUR AS closed FROM events)
SELECT click_id, view_id FROM p JOIN events ON event_id = click_id, w
WHERE view_id IS NOT NULL OR ts < closed""")
def stream_left_join(t):
    """Unmatched clicks appear once both watermarks are past their interval."""
    clicks, views = clicks_and_views(t.events_stream)
    rows = interval_join(
        clicks.withWatermark("click_ts", "30 seconds"), views.withWatermark("view_ts", "30 seconds"),
        [("click_user", "view_user")], "click_ts", "view_ts", 0, SIX_HOURS, "left",
    ).select("click_id", "view_id")
    return run_to_files(rows, "d08", spark__sql__streaming__multipleWatermarkPolicy="min")


@query("d10_stream_window_join", """
SELECT c.event_id AS click_id, v.event_id AS view_id
FROM (SELECT * FROM events WHERE event_type = 'click') c
JOIN (SELECT * FROM events WHERE event_type = 'view') v
ON c.user_id = v.user_id AND date_trunc('hour', c.ts) = date_trunc('hour', v.ts)""")
def stream_window_join(t):
    clicks, views = clicks_and_views(t.events_stream)
    c = clicks.withWatermark("click_ts", "1 minute").withColumn("cw", F.window("click_ts", "1 hour"))
    v = views.withWatermark("view_ts", "1 minute").withColumn("vw", F.window("view_ts", "1 hour"))
    rows = c.join(v, (F.col("click_user") == F.col("view_user")) & (F.col("cw") == F.col("vw")))
    return run_to_files(rows.select("click_id", "view_id"), "d10")


@query("f09_stream_first", """
SELECT DISTINCT user_id, event_type FROM events""")
def stream_first(t):
    """The first arrival of a key over two batches; state of a key goes when its time is over."""
    rows = two_files(t, "f09-files", t.events_ts.select("user_id", "event_type", "ts", "event_id"),
                     F.col("event_id") % 3 == 0)
    return run_to_files(first_in_time(rows, ["user_id", "event_type"], "ts", "40 days").select(
        "user_id", "event_type"), "f09")


@query("d11_stream_temporal", """
WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'),
v AS (SELECT * FROM events WHERE event_type = 'view'),
m AS (SELECT least((SELECT max(ts) FROM p), (SELECT max(ts) FROM v)) - INTERVAL 3 DAY AS mark)
SELECT p.event_id, v.event_id AS view_id, v.value AS view_value
FROM (SELECT p.* FROM p, m WHERE epoch_us(ts) < epoch_ms(mark) * 1000) p
ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def stream_temporal(t):
    """The newest view of a purchase's user at its time; views come in two batches.

    The second brings views up to two days older than the newest of the first, within the delay.
    """
    views = t.events_ts.filter("event_type = 'view'").select("user_id", "ts", "event_id", "value")
    day, odd = F.dayofmonth("ts"), F.col("event_id") % 2 == 1
    late = two_files(t, "d11-views", views, (day >= 16) | (day >= 14) & odd)
    sales = t.events_stream.filter("event_type = 'purchase'").select("user_id", "ts", "event_id")
    out = run_to_files(
        stream_asof_join(sales, late, "user_id", "ts", "event_id", "event_id", F.col("value"),
                         delay="3 days", salts=2, buckets=256), "d11", rocksdb=True)
    return out.select(F.col("id").alias("event_id"), F.col("version").alias("view_id"),
                      F.col("value").cast("double").alias("view_value"))


@query("d12_stream_lookup", """
SELECT l_orderkey, l_linenumber, p_name AS alias FROM lineitem
LEFT JOIN part ON l_partkey = p_partkey AND p_brand = 'Brand#2'""")
def stream_lookup(t):
    dim = t.part.filter("p_brand = 'Brand#2'").select("p_partkey", F.col("p_name").alias("alias"))
    rows = t.stream("lineitem").join(dim, F.col("l_partkey") == F.col("p_partkey"), "left")
    return run_to_files(rows.select("l_orderkey", "l_linenumber", "alias"), "d12")


@query("d13_lookup_reload", """
SELECT o_orderkey, c_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def lookup_reload(t):
    """The dimension is read again by the first batch after its time to live."""
    log = BatchLog(t.spark, work_dir(t.spark, "d13"))
    handle = reloading_lookup(
        lambda: t.read("customer").select("c_custkey", "c_name"),
        lambda b, d: b.join(d, F.col("o_custkey") == F.col("c_custkey"), "left").select(
            "o_orderkey", "c_name"),
        log.write, ttl_s=600, clock=time.monotonic)
    run_batches(t.stream("orders"), handle, "d13")
    return log.rows().drop("batch_id")


@query("d14_growing_table_join", """
WITH e AS (SELECT *, user_id % 30 AS nk FROM events),
closed AS (SELECT max(ts) - INTERVAL 30 SECOND AS wm FROM events)
SELECT event_id, n_name FROM e LEFT JOIN nation ON n_nationkey = nk, closed
WHERE n_name IS NOT NULL OR ts < wm""")
def growing_table_join(t):
    """Both sides are streams; an event without partner goes out alone.

    A table row serves the events of a year from its load time. That bounds the state of the table
    side, and the watermark that of the events: unmatched ones go out when it has passed them.
    """
    loaded = F.lit("2023-12-31").cast("timestamp")
    left = t.events_stream.select(
        "event_id", "ts", F.pmod("user_id", F.lit(30)).cast("int").alias("nk")
    ).withWatermark("ts", "30 seconds")
    right = t.stream("nation").select("n_nationkey", "n_name", loaded.alias("loaded")).withWatermark(
        "loaded", "0 seconds")
    rows = left.join(right, (F.col("nk") == F.col("n_nationkey")) & (F.col("ts") >= F.col("loaded"))
                     & (F.col("ts") <= F.col("loaded") + F.expr("INTERVAL 366 DAYS")), "left")
    return run_to_files(rows.select("event_id", "n_name"), "d14",
                        spark__sql__streaming__multipleWatermarkPolicy="max")


@query("d09_stream_join", """
SELECT l_orderkey AS key, count(*) AS n, sum(l_linenumber)::BIGINT AS total
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def stream_join(t):
    """No bound in event time: each side is remembered for an hour of processing time."""
    lines = t.stream("lineitem").select(
        F.col("l_orderkey").alias("key"), F.col("l_linenumber").cast("long").alias("line"))
    orders = t.stream("orders").select(F.col("o_orderkey").alias("key"))
    pairs = run_to_files(state.timed_join(lines, orders, "key", "1 HOUR", "line"), "d09",
                         rocksdb=True, **state.ONE_STORE)
    return pairs.groupBy("key").agg(F.count("*").alias("n"), F.sum("line").alias("total"))


DEALS_SQL = """
SELECT l_partkey AS item, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS deal_id, CAST(round(
  CAST(p_retailprice AS DECIMAL(10,2)) * CAST(l_quantity AS DECIMAL(10,2)), 2) AS DOUBLE) AS amount
FROM lineitem JOIN part ON l_partkey = p_partkey"""


def _deals(t, salts, label):
    prices = t.stream("part").select(
        F.col("p_partkey").alias("item"), F.lit(0).cast("bigint").alias("seq"),
        F.col("p_retailprice").alias("price"))
    deals = t.stream("lineitem").select(
        F.col("l_partkey").alias("item"), (F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .alias("seq"), F.col("l_quantity").alias("qty"))
    out = run_to_files(state.priced_deals(prices, deals, salts), label, rocksdb=True)
    amount = F.round(F.col("price").cast("decimal(10,2)") * F.col("qty").cast("decimal(10,2)"), 2)
    return out.select("item", "deal_id", amount.cast("double").alias("amount"))


@query("d17_stream_priced_deals", DEALS_SQL)
def stream_priced_deals(t):
    """Prices go to all salts of an item, deals to one: a hot item is shared."""
    return _deals(t, 2, "d17")


@query("d18_buffered_join", DEALS_SQL)
def buffered_join(t):
    """Deals arrive before all prices: the buffer of every key is filled, then released.

    Two batches over two files; each item's deals are buffered in several salted states.
    """
    price = t.part.select(
        F.col("p_partkey").alias("item"), F.lit(0).cast("bigint").alias("seq"),
        F.lit("price").alias("kind"), F.col("p_retailprice").alias("price"),
        F.lit(None).cast("double").alias("qty"))
    deal = t.lineitem.select(
        F.col("l_partkey").alias("item"), (F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .alias("seq"), F.lit("deal").alias("kind"), F.lit(None).cast("double").alias("price"),
        F.col("l_quantity").cast("double").alias("qty"))
    rows = two_files(t, "d18-files", price.unionByName(deal), F.col("kind") == "price")
    out = run_to_files(state.priced_deals(
        rows.filter("kind = 'price'"), rows.filter("kind = 'deal'"), 2), "d18", rocksdb=True)
    amount = F.round(F.col("price").cast("decimal(10,2)") * F.col("qty").cast("decimal(10,2)"), 2)
    return out.select("item", "deal_id", amount.cast("double").alias("amount"))


@query("d19_stream_header_packages", """
SELECT l_orderkey AS code, CAST(l_linenumber AS BIGINT) AS package, o_orderstatus AS info
FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) JOIN orders ON o_orderkey = l_orderkey
UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def stream_header_packages(t):
    """Headers release the packages that came before them.

    What is emitted depends on arrival order (a header may go out alone before
    its packages), so the rows are read as a keyed result: repeats once, and a
    lone header only where no package ever came.
    """
    headers = t.stream("orders").select(
        F.col("o_orderkey").alias("code"), F.lit(2).cast("bigint").alias("seq"),
        F.col("o_orderstatus").alias("info"))
    packages = t.stream("lineitem").select(
        F.col("l_orderkey").alias("code"), F.lit(1).cast("bigint").alias("seq"),
        F.col("l_linenumber").alias("package"))
    rows = run_to_files(state.header_packages(headers, packages, salts=2), "d19", rocksdb=True).distinct()
    joined = rows.filter("package IS NOT NULL")
    alone = rows.filter("package IS NULL").join(joined.select("code"), "code", "left_anti")
    return joined.unionByName(alone)


# --- stream sinks and sources -----------------------------------------------


@query("b08_partition_commit", """
SELECT strftime(d, '%Y-%m-%d') AS dt, n, true AS marked FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n
  FROM events GROUP BY 1) WHERE (SELECT max(ts) FROM events) - INTERVAL 30 SECOND > d + INTERVAL 25 HOUR""")
def partition_commit(t):
    """Days are announced once the watermark is an hour past their end."""
    spark = t.spark
    table = f"{managed_database(spark, 'commit')}.ev"
    root = work_dir(spark, "commit-data")
    spark.sql(f"CREATE TABLE {table} (event_id BIGINT, ts TIMESTAMP, dt STRING, batch_id INT) "
              f"USING parquet PARTITIONED BY (dt, batch_id) LOCATION '{root}'")
    sink = PartitionCommitter(spark, table, root, work_dir(spark, "commit-log"), "dt", "ts",
                              "30 SECOND", "25 HOUR")
    run_batches(t.events_stream.select("event_id", "ts", day_text("ts").alias("dt")),
                sink.process, "b08")
    marked = F.col("dt").isin(*sink.announced())
    return spark.table(table).groupBy("dt").agg(F.count("*").alias("n")).withColumn(
        "marked", marked)


@query("b15_upsert_sink", """
SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def upsert_sink(t):
    log = UpsertLog(t.spark, work_dir(t.spark, "b15"), ["user_id"], seq=["event_id"])
    run_batches(t.events_stream.select("user_id", "event_type", "value", "event_id"),
                log.upsert, "b15")
    return log.current().drop("event_id")


@query("b16_key_value_sink", """
SELECT CAST(user_id AS VARCHAR) AS key, event_type AS value, CASE WHEN event_type = 'click' THEN NULL
  WHEN event_type = 'view' THEN 1000000060000 ELSE 1000000600000 END AS expire_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
WHERE rn = 1 AND event_type <> 'view'""")
def key_value_sink(t):
    """Time to live comes from a column; views have expired when read."""
    spark = t.spark
    make_active(spark)
    spark.dataSource.register(KeyValueSink)
    out = qualified(spark, work_dir(spark, "b16"))
    kind = F.col("event_type")
    rows = t.events_stream.select(
        F.col("user_id").cast("string").alias("key"), kind.alias("value"),
        F.col("event_id").alias("seq"),
        F.when(kind == "view", 60).when(kind != "click", 600).alias("ttl"))
    q = (rows.writeStream.format("tidemill_kv").option("flush_rows", 10)
         .option("flush_seconds", 30).option("now_ms", "1000000000000")
         .option("checkpointLocation", f"{out}/checkpoint")
         .trigger(availableNow=True).start(f"{out}/store"))
    q.awaitTermination()
    return live_values(spark, f"{out}/store", 1000000000000 + 120000)


@query("b17_fan_out", """
SELECT 'latest' AS sink, count(DISTINCT user_id) AS n FROM events
UNION ALL SELECT 'errors', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'all', count(*) FROM events""")
def fan_out_sinks(t):
    root = work_dir(t.spark, "b17")
    latest = UpsertLog(t.spark, f"{root}/latest", ["user_id"], seq=["event_id"])
    errors, everything = BatchLog(t.spark, f"{root}/errors"), BatchLog(t.spark, f"{root}/all")
    run_batches(t.events_stream.select("user_id", "event_id", "event_type"), fan_out([
        latest.upsert,
        lambda b, i: errors.write(b.filter("event_type = 'error'"), i),
        everything.write,
    ]), "b17")
    out = None
    for name, df in (("latest", latest.current()), ("errors", errors.rows()),
                     ("all", everything.rows())):
        part = df.agg(F.lit(name).alias("sink"), F.count("*").alias("n"))
        out = part if out is None else out.unionByName(part)
    return out


@query("b18_exactly_once", """
SELECT 'value#' || event_type AS value, count(*) AS n FROM events GROUP BY 1""")
def exactly_once(t):
    """Each batch is delivered twice on purpose; it still counts once."""
    log = BatchLog(t.spark, work_dir(t.spark, "b18"))

    def handle(batch, batch_id):
        out = batch.select(F.concat(F.lit("value#"), "event_type").alias("value"))
        log.write(out, batch_id)
        log.write(out, batch_id)

    run_batches(t.events_stream.select("event_type"), handle, "b18")
    return log.rows().groupBy("value").agg(F.count("*").alias("n"))


@query("a18_stream_decode", """
SELECT event_type, count(*) AS n FROM events GROUP BY event_type""")
def stream_decode(t):
    """Messages are encoded and decoded on the stream as a broker would carry them."""
    messages = broker.encode(
        t.events_stream, "user_id", ["event_id", "event_type"]
    ).withColumns({
        "topic": F.lit("events"), "partition": F.lit(0), "offset": F.lit(0).cast("bigint"),
        "timestamp": F.current_timestamp()})
    rows = broker.decode(messages, "event_id BIGINT, event_type STRING", "json", "id")
    return run_to_files(rows, "a18").groupBy("event_type").agg(F.count("*").alias("n"))


@query("a22_change_sync", f"""
WITH {CHANGES_SQL} SELECT s.*, (SELECT strftime(max(ts), '%Y-%m-%d') FROM ch
  WHERE ch.user_id = s.user_id) AS dt FROM {STATE_SQL('true')} s""")
def change_sync(t):
    """A change stream kept as a keyed table with a computed partition column."""
    rows = changes_stream(t)
    log = UpsertLog(t.spark, work_dir(t.spark, "a22"), ["user_id"], seq=["event_id"], op="op")
    run_batches(rows, log.upsert, "a22")
    return log.current().select("user_id", "event_type", "value", "dt")


def changes_stream(t):
    kind = F.col("event_type")
    return t.events_stream.select(
        "user_id", "event_type", "value", "event_id",
        F.when(kind == "signup", "+I").when(kind == "error", "-D").otherwise("+U").alias("op"),
        day_text("ts").alias("dt"))


@query("a23_partition_stream", """
SELECT rule, event_id FROM events, (VALUES ('name'), ('time'), ('created')) AS v(rule)
WHERE CASE rule WHEN 'name' THEN CAST(hour(ts) AS VARCHAR) >= '5' WHEN 'time' THEN hour(ts) >= 5
  ELSE hour(ts) < 5 END""")
def partition_stream(t):
    """A partitioned folder read as a stream from a start partition on.

    By name the order is that of text, where '9' comes after '11'; by time it
    is that of the number; by creation it is that of the files' times.
    """
    root = work_dir(t.spark, "a23")
    hours = t.events.select("event_id", F.hour("ts").alias("h"))
    rebalanced(hours.filter("h >= 5"), "h").write.partitionBy("h").parquet(root)
    first = t.spark.read.parquet(root).agg(F.max("_metadata.file_modification_time")).first()[0]
    time.sleep(1.1)  # some stores keep whole seconds
    rebalanced(hours.filter("h < 5"), "h").write.mode("append").partitionBy("h").parquet(root)
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("h", T.StringType())])
    rows = t.spark.readStream.schema(schema).parquet(root)
    by_name = run_to_files(rows.filter(F.col("h") >= "5").select("event_id"), "a23n")
    by_time = run_to_files(rows.filter(F.col("h").cast("int") >= 5).select("event_id"), "a23t")
    created = run_to_files(rows.filter(
        F.col("_metadata.file_modification_time") > F.lit(first)).select("event_id"), "a23c")
    return by_name.withColumn("rule", F.lit("name")).unionByName(
        by_time.withColumn("rule", F.lit("time"))).unionByName(
        created.withColumn("rule", F.lit("created")))
