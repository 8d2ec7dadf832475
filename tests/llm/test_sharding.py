"""Shards by prefix sums against a plain version."""

import zlib

import pytest

from tidemill.llm.sharding import shard


def plain(rows, shards=8):
    data = sorted(((d, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1)
                   for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    total, at, slots, out = sum(r[2] for r in data), 0, {}, []
    for doc, crc, size in data:
        k = min(shards - 1, (at * 2 + size) * shards // (2 * total))
        out.append((doc, size, crc, k, slots.get(k, 0)))
        slots[k] = slots.get(k, 0) + 1
        at += size
    return sorted(out, key=repr)


def run(spark, rows, shards=8):
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows],
                                 "doc_id long, text string, size int, shard int, part int")
    return sorted(map(tuple, shard(docs.repartition(5), shards).collect()), key=repr)


@pytest.mark.parametrize("rows", [
    [], [(1, None)], [(None, "é" * 50), (None, "é" * 50), (2, ""), (1, "x" * 10_000)],
    [(7, "same")] * 500 + [(k, "t" * (k % 90)) for k in range(1500)],
    [(k, "") for k in range(100)],
])
def test_equals_plain(spark, rows):
    assert run(spark, rows) == plain(rows)


def test_table_is_balanced(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = shard(docs).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, got), key=repr) == plain(rows)
    sums = [sum(r.size for r in got if r.shard == k) for k in range(8)]
    assert max(sums) - min(sums) <= 2 * max(r.size for r in got)
