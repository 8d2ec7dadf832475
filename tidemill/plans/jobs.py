"""Streams as jobs that run on: sources that set time, idle inputs, caches, commits, counters."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.catalog import query
from tidemill.plans.streams import flat, tumble, two_files, windowed_sql
from tidemill.session import make_active, qualified, work_dir
from tidemill.sources.marked import MarkedSource
from tidemill.streaming.counters import LoadJob
from tidemill.streaming.idle import POLICY, heartbeat, merge_inputs
from tidemill.streaming.lookup import ParquetLookup, cached_lookup
from tidemill.streaming.published import Fenced, PublishedLog
from tidemill.streaming.sinks import BatchLog
from tidemill.streaming.runner import run_batches, run_to_files, run_until_quiet


@query("i03_marked_source", windowed_sql("4 HOUR", "event_type", "count(*) AS n", "5 MINUTE"))
def marked_source(t):
    """A source that sets event time itself and ends a batch at every n-th record.

    The events are laid down in time order first, as a log holds them; a row out of order by more
    than the delay would be late.
    """
    spark = t.spark
    make_active(spark)
    spark.dataSource.register(MarkedSource)
    log, root = work_dir(spark, "i03-log"), work_dir(spark, "i03-stream")
    t.events_ts.repartitionByRange("ts").sortWithinPartitions("ts").select(
        F.unix_micros("ts").alias("at"), "event_type").write.parquet(log)
    marks = max(t.events.count() // 5, 1)
    rows = (spark.readStream.format("tidemill_marked").schema("at BIGINT, event_type STRING")
            .option("mark_every", marks).option("progress", qualified(spark, f"{root}/progress"))
            .load(qualified(spark, log)))
    rows = rows.select(F.timestamp_micros("at").alias("ts"), "event_type")
    out = tumble(rows, "4 hours", ["event_type"], [F.count("*").alias("n")], "5 minutes")
    return flat(run_until_quiet(out, "i03", checkpoint=f"{root}/checkpoint", out=f"{root}/data"))


@query("i05_silent_input", windowed_sql("6 HOUR", "event_type", "count(*) AS n", "50 SECOND", """(
  SELECT ts, event_type FROM events WHERE event_type <> 'signup' UNION ALL
  (SELECT ts, event_type FROM events WHERE event_type = 'signup' ORDER BY ts, event_id LIMIT 1))"""))
def silent_input(t):
    """One input has a single early row and is silent then; 20 s later it holds nothing back."""
    kind = F.col("event_type")
    first = t.events_ts.filter(kind == "signup").agg(
        F.min(F.struct("ts", "event_id"))["event_id"]).scalar()
    busy = t.events_stream.filter(kind != "signup").select("ts", "event_type")
    silent = t.events_stream.join(
        t.spark.range(1).select(first.alias("event_id")), "event_id", "left_semi"
    ).select("ts", "event_type")
    rows = merge_inputs([busy, silent], "ts", "20 seconds", "30 seconds")
    out = rows.groupBy(F.window("ts", "6 hours"), "event_type").agg(F.count("*").alias("n"))
    return flat(run_to_files(out, "i05s", **POLICY))


@query("d13_lookup_cache", """
SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def lookup_cache(t):
    """Customers are asked for by key; each worker remembers 10,000 of them for ten minutes.

    The table is laid out by key once, and the orders of a batch are put in the same order, so that a
    question opens the few files it needs and a key is asked once or twice.
    """
    ask = ParquetLookup.laid_out(t.customer, "c_custkey", ["c_name", "c_mktsegment"],
                                 work_dir(t.spark, "d13c-table"))
    fields = T.StructType([T.StructField("c_name", T.StringType()),
                           T.StructField("c_mktsegment", T.StringType())])
    log = BatchLog(t.spark, work_dir(t.spark, "d13c"))

    def handle(batch, batch_id):
        rows = cached_lookup(ask.near(batch, "o_custkey", ["o_orderkey"]), "o_custkey", fields, ask,
                             max_rows=10_000, ttl_s=600, name=f"customers of {ask.uri}")
        log.write(rows.drop("o_custkey"), batch_id)

    run_batches(t.stream("orders").select("o_orderkey", "o_custkey"), handle, "d13c")
    return log.rows().drop("batch_id")


@query("d14_late_table_rows", """
WITH n AS (SELECT *, CASE WHEN n_nationkey < 13 THEN TIMESTAMP '2023-12-31'
  ELSE TIMESTAMP '2024-01-10' END AS loaded FROM nation),
e AS (SELECT *, user_id % 30 AS nk FROM events),
closed AS (SELECT least(max(ts) - INTERVAL 30 SECOND, greatest(max(ts) - INTERVAL 25 DAY,
  (SELECT max(loaded) FROM n))) AS wm FROM events)
SELECT event_id, n_name FROM e LEFT JOIN n ON n_nationkey = nk AND ts >= loaded, closed
WHERE n_name IS NOT NULL OR ts < wm""")
def late_table_rows(t):
    """The table grows after the events are in; its new rows serve the events since their arrival.

    Events wait for the table's time, which is that of its newest row and trails the events by 25
    days at most, so a table that stops growing does not keep unmatched events for ever.
    """
    loaded = F.when(F.col("n_nationkey") < 13, F.lit("2023-12-31")).otherwise(
        F.lit("2024-01-10")).cast("timestamp")
    table = two_files(t, "d14-table", t.nation.select("n_nationkey", "n_name", loaded.alias("loaded")),
                      F.col("n_nationkey") >= 13)
    left = t.events_stream.select(
        "event_id", "ts", F.pmod("user_id", F.lit(30)).cast("int").alias("nk")
    ).withWatermark("ts", "30 seconds")
    right = heartbeat(table, t.events_stream.select(F.col("ts").alias("loaded")), "loaded",
                      "25 days", "0 seconds")
    rows = left.join(right, (F.col("nk") == F.col("n_nationkey")) & (F.col("ts") >= F.col("loaded"))
                     & (F.col("ts") <= F.col("loaded") + F.expr("INTERVAL 366 DAYS")), "left")
    return run_to_files(rows.select("event_id", "n_name"), "d14g", **POLICY)


class _Crash(RuntimeError):
    pass


@query("b18_published_batches", """
SELECT 'value#' || event_type AS value, count(*) AS n FROM events GROUP BY 1""")
def published_batches(t):
    """Offsets and output are published as one; three producers, two of which crash.

    The first stops with the part files of batch 0 written and not published, the second right
    after publishing batch 0, the third goes on. The first wakes up again and is refused.
    """
    spark = t.spark
    root = work_dir(spark, "b18p")
    rows = two_files(t, "b18-files", t.events.select("event_id", "event_type"),
                     F.col("event_id") % 3 == 0)
    rows = rows.select(F.concat(F.lit("value#"), "event_type").alias("value"))
    staged = []

    def producer():
        log = PublishedLog(spark, f"{root}/out", f"{root}/checkpoint")
        log.begin()
        return log

    def run(handle):
        run_batches(rows, handle, "b18p", checkpoint=f"{root}/checkpoint")

    first = producer()

    def before(batch, batch_id):
        staged.append(first.stage(batch, batch_id))
        raise _Crash

    second = producer_after(run, before, producer)

    def after(batch, batch_id):
        second.process(batch, batch_id)
        raise _Crash

    third = producer_after(run, after, producer)
    run(third.process)
    try:
        first.publish(staged[0])
    except Fenced:
        pass
    else:
        raise AssertionError("an older producer published")
    return third.rows("value STRING").groupBy("value").agg(F.count("*").alias("n"))


def producer_after(run, handle, producer):
    """A new producer once the run with ``handle`` has crashed."""
    from pyspark.errors import StreamingQueryException

    try:
        run(handle)
    except StreamingQueryException as exc:
        if "_Crash" not in str(exc):
            raise
    return producer()


@query("j11_stream_counters", """
SELECT CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END::BIGINT AS batch_id, count(*) AS scan_rows,
  count(*) FILTER (event_type = 'error') AS filtered_rows, 2::BIGINT AS runs
FROM events GROUP BY 1""")
def stream_counters(t):
    """Counters of a running load; its errors pause it after a batch, it is resumed, and goes on."""
    spark = t.spark
    rows = two_files(t, "j11-files", t.events.select("event_id", "event_type"),
                     F.col("event_id") % 3 == 0)
    root = work_dir(spark, "j11")

    def handle(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{root}/rows/batch_id={batch_id}")

    job = LoadJob(spark, f"load-{root[-12:]}", rows, {
        "scan_rows": F.count(F.lit(1)), "filtered_rows": F.count_if(F.col("event_type") == "error"),
    }, handle, f"{root}/checkpoint", pause_when=lambda counts: counts["filtered_rows"] > 0)
    runs = 1
    while job.run() == "PAUSED":
        runs += 1
        if runs > 3:
            raise RuntimeError(job.reason)
    return job.report().withColumn("runs", F.lit(runs).cast("bigint"))
