"""Phrases against a plain count of all n-grams."""

import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tidemill.llm import phrases
from tidemill.llm.common import stored
from tidemill.llm.phrases import Marks, MisraGries, phrase_counts, top_phrases

KIND = "doc_id long, text string, lang string"


def plain(rows, threshold, keep=2000, longest=5):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n["und" if lang is None else lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f["und" if lang is None else lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        known = {p: a for p, a in counts.items() if a >= threshold and len(p) > 1}
        inside = Counter()
        for p, a in known.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i:i + k]] = max(inside[p[i:i + k]], a)
        rows_out = []
        for p, a in known.items():
            if 100 * inside[p] >= 100 * a:
                continue
            score, _, l, r = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k,
                                  counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows_out.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows_out)[:keep], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, docs=150, lang=("en", "de", None)):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(30)] + ["É", "Zoë", "字"]
    stock = ["alpha beta gamma delta eps", "New\tYork  city", "a a a a", "one. two, three"]
    out = []
    for i in range(docs):
        parts = [rng.choice(stock) if rng.random() < 0.3 else rng.choice(words).title()
                 for _ in range(rng.randint(0, 40))]
        out.append((i, rng.choice([" ", "  ", "\t"]).join(parts) + rng.choice(["", ".", "\n"]),
                    rng.choice(lang)))
    return out


@pytest.mark.parametrize("seed,threshold", [(1, 5), (2, 12), (3, 40)])
def test_rows_equal_a_plain_count(spark, seed, threshold):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, KIND).repartition(5)
    want = plain(rows, threshold)
    assert want and result(top_phrases(docs, threshold)) == want


def test_only_the_best_are_kept_with_ties_by_phrase(spark):
    rows = corpus(4, lang=("en",))
    got = result(top_phrases(spark.createDataFrame(rows, KIND), 3, keep=7))
    assert got == plain(rows, 3, keep=7) and len(got) == 7


def test_small_slices_blocks_and_tables_change_nothing(spark, monkeypatch):
    rows = corpus(6)
    rows.append((900, " ".join(["alpha beta gamma"] * 700), "en"))
    # workers read the constants from closures made here
    monkeypatch.setattr(phrases, "LEAST_BITS", 8)
    monkeypatch.setattr(phrases, "MOST_BITS", 9)
    assert result(top_phrases(spark.createDataFrame(rows, KIND).repartition(3), 6)) == plain(rows, 6)


def test_slices_of_long_texts_keep_phrases_whole(monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 7)
    for text in ["alpha beta. gamma delta eps zeta", "x" * 50, "", " ", "ab\ncd " * 9, "a" * 8 + " b"]:
        numbers = phrases._Numbers()
        parts = np.concatenate(list(phrases._words(text, numbers)))
        names = list(numbers)
        got = [[names[k].decode() for k in run] for run in
               np.split(parts, np.nonzero(parts == 0)[0])]
        got = [w for w in ([x for x in g if x != "."] for g in got) if w]
        assert got == [w for w in (re.findall("[^ \t]+", p) for p in
                                   re.split("[.,;:!?\n-\r]", text)) if w]


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    made = phrases.blocks
    seen = []

    def clash(docs, seed, *rest):
        seen.append(seed)
        df = made(docs, seed, *rest)
        if seed:
            return df
        from pyspark.sql import functions as F

        return df.withColumn("hashes", F.transform("hashes", lambda h: h % 3))

    monkeypatch.setattr(phrases, "blocks", clash)
    rows = corpus(7, docs=40)
    assert result(top_phrases(spark.createDataFrame(rows, KIND), 5)) == plain(rows, 5)
    assert seen == [0, 1]


def test_nulls_repeats_empty_and_clashing_columns(spark):
    rows = [(1, "red fox ran", None), (1, "red fox ran", None), (2, None, "en"), (None, "", "en"),
            (3, "red fox. ran", "en"), (4, "red fox", "")] * 2
    table = spark.createDataFrame([(*r, 1, 2) for r in rows], KIND + ", ids int, rank int")
    assert result(top_phrases(table, 2)) == plain(rows, 2)
    empty = spark.createDataFrame([], KIND)
    assert top_phrases(empty).collect() == []
    assert top_phrases(spark.createDataFrame([(1, None, None)], KIND), 1).collect() == []


def test_all_frequent_phrases_have_exact_counts(spark):
    rows = corpus(9, lang=("en",))
    counts, words, totals = phrase_counts(spark.createDataFrame(rows, KIND).repartition(4), 8)
    name = {r.id: r.word for r in words.collect()}
    got = {" ".join(name[i] for i in r.ids): r.a for r in counts.collect()}
    want = Counter()
    for _, text, _ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = re.findall("[^ \t]+", piece)
            want.update(" ".join(w[i:i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    assert got == {p: a for p, a in want.items() if a >= 8}


def test_summaries_keep_every_frequent_key_and_merge():
    rng = np.random.default_rng(1)
    stream = np.concatenate([rng.integers(0, 1 << 40, 60_000), np.repeat(np.arange(5), 900)])
    rng.shuffle(stream)
    stream = stream.astype(np.uint64)
    capacity = len(stream) // 100 + 1
    halves = []
    for part in np.array_split(stream, 2):
        summary = MisraGries(capacity)
        for chunk in np.array_split(part, 9):
            summary.add(*np.unique(chunk, return_counts=True))
            summary.cut()
            assert len(summary.keys) <= capacity
        halves.append(summary)
    halves[0].merge(halves[1])
    assert halves[0].short < 100 and len(halves[0].keys) <= capacity
    found = halves[0].frequent(100)
    assert set(range(5)) <= set(found.tolist())
    one = MisraGries(capacity)
    one.add(*np.unique(stream, return_counts=True))
    one.cut()
    for key, count in zip(one.keys.tolist(), one.counts.tolist()):
        true = int((stream == key).sum())
        assert true - one.short <= count <= true


def test_a_summary_that_falls_short_is_made_again(spark, monkeypatch):
    monkeypatch.setattr(phrases.MisraGries, "__init__", _short_at_first)
    rows = corpus(12, docs=30)
    assert result(top_phrases(spark.createDataFrame(rows, KIND), 5)) == plain(rows, 5)


def _short_at_first(self, capacity):
    self.capacity, self.short = capacity, 0 if capacity > 300 else 10
    self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    self.waiting, self.size = [], 0


def test_marks_hold_what_was_put_and_few_strangers():
    keys = np.random.default_rng(4).integers(0, 1 << 63, 6000).astype(np.uint64) * np.uint64(2)
    marks = Marks(16, 8)
    put, others = keys[:1000], keys[1000:]
    for part in range(8):
        marks.put(part, marks.packed(put[put >> np.uint64(61) == part], part))
    assert marks.holds(put).all() and marks.holds(others).mean() < 0.01


def _large_block(words, seed):
    """One stored row: ``words`` word numbers with breaks, of 50,000 different words."""
    rng = np.random.default_rng(seed)
    hashes = rng.integers(-2**63, 2**63 - 1, 50_000, dtype=np.int64)
    sequence = np.minimum(rng.zipf(1.3, words) - 1, len(hashes)).astype("<u4")
    return pa.RecordBatch.from_arrays([
        pa.array(["en"]), pa.array([hashes], pa.list_(pa.int64())),
        pa.array([sequence.tobytes()], pa.binary())], ["lang", "hashes", "sequence"])


def test_memory_for_the_places_of_a_block_does_not_grow_with_the_block():
    batch = _large_block(2_000_000, 1)
    tables = [Marks(20, 8) for _ in range(3)]
    for table in tables:
        table.table[:] = 255
    tracemalloc.start()
    try:
        for block in phrases._read(batch):
            for n, keys, places in block.levels(tables, 4):
                assert len(keys) == len(places)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 40e6


def test_n_grams_across_stretches_of_places_are_counted_once(monkeypatch):
    [block] = phrases._read(_large_block(3_000, 2))
    numbers = block.sequence.tolist()
    tables = [Marks(20, 8) for _ in range(4)]
    for table in tables:
        table.table[:] = 255
    for places in (1, 2, 7, 1000, 5000):
        monkeypatch.setattr(phrases, "PLACES", places)
        found = defaultdict(list)
        for n, _, at in block.levels(tables, 5):
            found[n].extend(at.tolist())
        for n in range(1, 6):
            want = [p for p in range(len(numbers) - n + 1) if all(numbers[p:p + n])]
            assert found[n] == want
            keys, counts = block.counted(tables, n)
            assert (keys[1:] > keys[:-1]).all()
            assert sorted(counts.tolist()) == sorted(
                Counter(tuple(numbers[p:p + n]) for p in want).values())


def test_row_sums_add_up_however_often_they_are_merged():
    rng = np.random.default_rng(3)
    sums, want = phrases.RowSums(), Counter()
    for _ in range(5):
        rows = rng.integers(0, 9, (400, 3)).astype(np.uint64)
        sums.add(rows, np.ones(len(rows), np.int64))
        want.update(map(tuple, rows.tolist()))
        sums.merged()
        rows, counts = sums.merged()
        assert dict(zip(map(tuple, rows.tolist()), counts.tolist())) == want


LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_blocks_come_and_lie_a_few_at_a_time(spark):
    long = spark.range(0, 24, 1, 1).selectExpr(
        "id", "cast(array_join(transform(sequence(1, 32768), i -> md5(cast(id * i as string))), '')"
        " as binary) as sequence")
    rows = stored(long, "long", **phrases.SHORT_PAGES | {"parquet.block.size": 4 << 20})
    for path in rows.inputFiles():
        groups = pq.ParquetFile(path.removeprefix("file://")).metadata
        assert groups.num_rows == 24
        assert all(groups.row_group(i).num_rows <= 6 for i in range(groups.num_row_groups))

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    with phrases._short_batches(spark):
        counts = [r.n for r in rows.coalesce(1).mapInArrow(seen, "n long").collect()]
    assert sum(counts) == 24 and max(counts) <= 5


def test_a_limit_of_the_session_is_kept_and_ours_goes(spark):
    assert spark.conf.get(LIMIT, None) is None
    with pytest.raises(ZeroDivisionError), phrases._short_batches(spark):
        assert spark.conf.get(LIMIT) == str(phrases.BATCH_BYTES)
        1 / 0
    assert spark.conf.get(LIMIT, None) is None
    spark.conf.set(LIMIT, "1m")
    try:
        with phrases._short_batches(spark):
            assert spark.conf.get(LIMIT) == "1m"
        assert spark.conf.get(LIMIT) == "1m"
    finally:
        spark.conf.unset(LIMIT)


def test_phrases_are_counted_over_short_batches_and_bounded_groups(spark, monkeypatch):
    seen = []

    def level(spoken, *rest, made=phrases._level):
        seen.append((spark.conf.get(LIMIT, None), spoken.inputFiles()))
        return made(spoken, *rest)

    monkeypatch.setattr(phrases, "_level", level)
    monkeypatch.setitem(phrases.SHORT_PAGES, "parquet.block.size", 1)
    rows = corpus(21)
    assert result(top_phrases(spark.createDataFrame(rows, KIND).coalesce(2), 5)) == plain(rows, 5)
    assert spark.conf.get(LIMIT, None) is None and len(seen) == 4
    for limit, files in seen:
        assert limit == str(phrases.BATCH_BYTES)
        for path in files:
            groups = pq.ParquetFile(path.removeprefix("file://")).metadata
            assert groups.num_row_groups == groups.num_rows > 1


def test_shares_are_whole_and_come_in_short_lists(monkeypatch):
    monkeypatch.setattr(phrases, "BATCH_BYTES", 100)
    rng = np.random.default_rng(5)
    for size in (0, 1, 7, 400):
        part = np.sort(rng.integers(0, 40, size))
        lists = list(phrases._shares(part, 9))
        flat = [x for own in lists for x in own]
        assert [p for p, a, b in flat for _ in range(a, b)] == part.tolist()
        assert [p for p, _, _ in flat] == sorted(set(part.tolist()))
        assert all((own[-1][1] - own[0][1]) * 9 < 100 for own in lists)
    assert len(lists) > 10
