"""Readers, decoders, generators and option builders."""

import json

import pytest
from pyspark.sql import functions as F

from tidemill.functions import tablefuncs as tf
from tidemill.sources import broker, changes, generator, jsonio, relational
from tidemill.sources import text as txt


def test_reader_options():
    o = broker.reader_options("b:9092", "t", start="latest", group="g")
    assert o["subscribe"] == "t" and o["startingOffsets"] == "latest"
    assert o["kafka.group.id"] == "g"
    o = broker.reader_options("b:9092", "t", offsets={0: 5, 1: -2}, partitions=[0, 1],
                              end="latest")
    assert json.loads(o["startingOffsets"]) == {"t": {"0": 5, "1": -2}}
    assert json.loads(o["assign"]) == {"t": [0, 1]} and o["endingOffsets"] == "latest"
    assert broker.reader_options("b:9092", "t", since_ms=7)["startingTimestamp"] == "7"


def test_table_options():
    o = relational.table_options("jdbc:x", "t", "u", "p", split_on="id", low=1, high=9, splits=4)
    assert o["numPartitions"] == "4" and o["partitionColumn"] == "id"
    with pytest.raises(ValueError):
        relational.table_options("jdbc:x", "t", "u", "p", split_on="id")


def test_decode_raw_and_csv(spark):
    msgs = spark.createDataFrame(
        [("k", "1,a", "t", 0, 3)], "key string, value string, topic string, partition int, offset long"
    ).withColumn("timestamp", F.current_timestamp())
    assert broker.decode(msgs, "", "raw").first()["doc"] == "1,a"
    row = broker.decode(msgs, "id INT, name STRING", "csv", "k2").first()
    assert (row["id"], row["name"], row["k2"], row["event_offset"]) == (1, "a", "k", 3)


def test_row_images_with_several_rows_and_null_old_value(spark):
    doc = json.dumps({
        "type": "UPDATE", "data": [{"id": "1", "n": "5"}, {"id": "2", "n": "7"}],
        "old": [{"n": None}, {"id": "3"}]})
    df = spark.createDataFrame([(doc, 4)], "doc string, seq long")
    out = changes.decode_row_images(df, "doc", "id INT, n INT", "seq")
    assert [tuple(r) for r in out.collect()] == [
        ("-U", 4, 1, None), ("+U", 4, 1, 5), ("-U", 4, 3, 7), ("+U", 4, 2, 7)]


def test_json_paths_with_missing_fields(spark):
    df = spark.createDataFrame([('{"a":{"b":2}}',), ("{}",), ("nope",)], "doc string")
    out = jsonio.json_columns(df, "doc", {"x": ("$.a.b", "int"), "y": ("$.c", "string")})
    assert [(r["x"], r["y"]) for r in out.collect()] == [(2, None), (None, None), (None, None)]
    assert jsonio.lenient_json(df, "doc", "a STRUCT<b: INT>").count() == 2


def test_named_partitions_only(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "dt string, v int")
    with pytest.raises(Exception, match="outside the named partitions"):
        txt.load_columns(df, {}, None, "dt", ["a"]).collect()
    assert txt.load_columns(df, {}, F.col("v") == 1, "dt", ["a"]).count() == 1


def test_generated_rows_depend_on_seed_only(spark):
    fields = lambda s: {"n": generator.number(F.col("id"), s, 1, 9),
                        "t": generator.text(F.col("id"), s, 6)}
    a = generator.batch_rows(spark, 50, fields("x")).collect()
    b = generator.batch_rows(spark, 20, fields("x"), start=30).collect()
    c = generator.batch_rows(spark, 50, fields("y")).collect()
    assert a[30:] == b and a != c
    assert all(1 <= r["n"] <= 9 and len(r["t"]) == 6 for r in a)


def test_generated_stream_has_the_batch_rows(spark, folder):
    fields = {"n": generator.number(F.col("id"), "x", 1, 9)}
    rows = generator.stream_rows(spark, 200, fields, rows=40)
    q = (rows.writeStream.format("parquet").option("path", f"{folder}/d")
         .option("checkpointLocation", f"{folder}/c").trigger(processingTime="500 milliseconds")
         .start())
    try:
        for _ in range(60):
            q.awaitTermination(1)
            if q.recentProgress and sum(p["numInputRows"] for p in q.recentProgress) >= 60:
                break
    finally:
        q.stop()
    got = {(r["id"], r["n"]) for r in spark.read.parquet(f"{folder}/d").collect()}
    want = {(r["id"], r["n"]) for r in generator.batch_rows(spark, 40, fields).collect()}
    assert got <= want and got


def test_table_functions(spark):
    df = spark.createDataFrame([(4, "ab", 1.5), (5, None, 2.0)], "n long, s string, d double")
    found = df.select(
        tf.length_words(df, "n").alias("a"), tf.length_words(df, "s").alias("b"),
        tf.length_words_sum(F.col("d"), F.lit(1.0)).alias("c")).collect()
    flat = [[(w["word"], w["length"]) for w in col] for r in found for col in r]
    assert flat == [[], [("ab", 2)], [("nums sum:2.5", 12)], [("num:5", 5)], [],
                    [("nums sum:3.0", 12)]]
    assert spark.range(1).select(tf.explode_csv(F.lit(" "))).count() == 0
    assert tf.numbered_rows(spark, 3, "test-", {"param1": "p"}).collect()[2]["name"] == "test-3"
