"""Phrases that are found more often than their parts suggest, with exact counts.

Counting every n-gram would move the whole text several times over, so frequent ones are found
first. Occurrences of one length are dealt to hash partitions, where a Misra-Gries summary of more
counters than ``mass / threshold`` meets them as a stream: each counter runs low by less than the
threshold, so every frequent n-gram is still there at the end. A longer n-gram is only dealt if
both n-grams one word shorter survived. Survivors are marked by two bits each in a table of bounded
size, in which a stranger may find both its bits marked; a second pass over the text counts all
marked phrases exactly, by their words, and drops what is not frequent.

Texts are read once: words become 64-bit hashes, checked to be different for different words, and
sequences of numbers in stored blocks. Per-language figures are counts and cut-offs only.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemill.llm.common import UPPER, stored

THRESHOLD = 100
LONGEST = 5
KEEP = 2000
UNKNOWN = "und"
#: Words of one block, and characters of a text split at a time.
BLOCK_WORDS = 2_000_000
SLICE = 4_000_000
#: Places of a block whose n-grams a task has in hand at a time.
PLACES = 250_000
#: Bytes of rows that go to a Python worker, or come from it, at a time; a longer row goes alone.
BATCH_BYTES = 4 << 20
#: Stored blocks lie in bounded row groups and in short pages, as a reader holds such a group and
#: a writer such a page. Sizes are looked at after each row, not each hundred: rows are long. Groups
#: are not smaller, as a file's groups go to several tasks, which then sum up less before they deal.
SHORT_PAGES = {"parquet.block.size": 64 << 20, "parquet.page.size.row.check.min": 1,
               "parquet.page.size.row.check.max": 1}
#: Rows of word hashes that a task holds in the exact pass, and those made at a time.
HELD_ROWS, MADE_ROWS = 600_000, 200_000
#: Bits of a table of survivors, smallest and largest: 128 KB to 16 MB.
LEAST_BITS, MOST_BITS = 20, 27
#: Hash partitions, largest number.
MOST_PARTS = 1 << 16
#: Counters of a summary as a multiple of ``mass / threshold``: how far below the threshold what
#: survives may lie is the threshold's share of this.
COUNTERS = 8
#: Rows of a per-language table up to which it is broadcast.
FEW = 100_000

_BREAK = b"."
_TABLE = bytearray(range(256))
for _c in UPPER.encode():
    _TABLE[_c] = _c + 32
for _c in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_c] = _BREAK[0]
_TABLE = bytes(_TABLE)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Numbers(dict):
    """Number of a word in the block, from 1; the break between pieces is 0."""

    def __init__(self):
        super().__init__({_BREAK: 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _words(text: str, numbers: _Numbers) -> Iterator[np.ndarray]:
    """Word numbers of ``text`` with breaks, then a break. Slices are cut before a blank."""
    at = 0
    while at < len(text):
        end = at + SLICE
        if end < len(text):
            end = max(text.rfind(" ", at + 1, end), text.rfind("\n", at + 1, end))
            if end <= at:
                blanks = [p for p in (text.find(" ", at + 1), text.find("\n", at + 1)) if p > 0]
                end = min(blanks, default=len(text))
        data = text[at:end].encode("utf-8", "surrogatepass").translate(_TABLE)
        found = data.replace(_BREAK, b" . ").split()
        yield np.fromiter(map(numbers.__getitem__, found), np.uint32, len(found))
        at = end
    yield np.zeros(1, np.uint32)


def blocks(docs: DataFrame, seed: int, text_col: str = "text",
           lang_col: str = "lang") -> DataFrame:
    """``lang, words, hashes, counts, sequence``: texts of one language as word numbers.

    Number k of the sequence (little-endian 32 bits) is the k-th word of the block, 0 a break.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        held: dict[str, tuple[_Numbers, list[np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            while held:
                lang = next(iter(held))
                numbers, parts = held.pop(lang)
                sequence = np.concatenate(parts)
                words = list(numbers)[1:]
                hashes = np.fromiter((xxh64_intdigest(w, seed) for w in words),
                                     np.uint64, len(words))
                counts = np.bincount(sequence, minlength=len(words) + 1)[1:]
                del numbers, parts
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang], pa.string()),
                    pa.array([[w.decode("utf-8", "surrogatepass") for w in words]],
                             pa.list_(pa.string())),
                    pa.array([hashes.view(np.int64)], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([sequence.astype("<u4", copy=False).tobytes()], pa.binary()),
                ], ["lang", "words", "hashes", "counts", "sequence"])
            size = 0

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                numbers, parts = held.setdefault(lang.as_py(), (_Numbers(), []))
                for part in _words(text.as_py(), numbers):
                    parts.append(part)
                    size += len(part)
                if size >= BLOCK_WORDS:
                    numbers = parts = None
                    yield from flush()
        yield from flush()

    return docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).mapInArrow(run, "lang string, words array<string>, hashes array<bigint>, "
                      "counts array<bigint>, sequence binary")


class _Block:
    """Hashes of the words of a block and, by length, keys of the n-grams at each place.

    Places are taken ``PLACES`` at a time, so memory does not grow with the block; the last words
    of n-grams at the end of such a stretch are read beyond it.
    """

    def __init__(self, lang: str, hashes: np.ndarray, sequence: bytes | pa.Buffer):
        from xxhash import xxh64_intdigest

        self.lang = lang
        self.hashes = np.concatenate((np.zeros(1, np.int64), hashes)).view(np.uint64)
        self.sequence = np.frombuffer(sequence, "<u4")
        own = np.uint64(xxh64_intdigest(lang.encode("utf-8", "surrogatepass"), 0))
        #: Key of each word number.
        self.words = self._mixed(self.hashes ^ own)

    @staticmethod
    def _mixed(key: np.ndarray) -> np.ndarray:
        key = (key ^ (key >> np.uint64(30))) * _MIX
        return key ^ (key >> np.uint64(31))

    def levels(self, tables: list[Marks], last: int) -> Iterator[tuple]:
        """``(n, keys, places)`` of n-grams all of whose shorter parts are marked in ``tables``.

        Each length comes once for each stretch of places.
        """
        for at in range(0, len(self.sequence), PLACES):
            sequence = self.sequence[at:at + PLACES + last - 1]
            word = self.words[sequence]
            key, fits = word, sequence > 0
            for n in range(1, last + 1):
                if n > 1:
                    key = self._mixed(key[:-1] * _ODD + word[n - 1:])
                    fits = fits[:-1] & fits[1:]
                places = np.nonzero(fits)[0]
                keys = key[places]
                own = np.searchsorted(places, PLACES)
                yield n, keys[:own], at + places[:own]
                if n <= len(tables):
                    places = places[tables[n - 1].holds(keys)]
                    fits = np.zeros(len(key), bool)
                    fits[places] = True

    def counted(self, tables: list[Marks], n: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the n-grams of length ``n`` in rising order, and how often each occurs."""
        parts = [np.unique(keys, return_counts=True)
                 for m, keys, _ in self.levels(tables, n) if m == n]
        return summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))


def _read(batch: pa.RecordBatch) -> Iterator[_Block]:
    for lang, hashes, sequence in zip(*(batch.column(k) for k in range(3))):
        yield _Block(lang.as_py(), hashes.values.to_numpy(), sequence.as_buffer())


class Marks:
    """Bit table of keys: two bits each, both in the stretch of the key's partition."""

    def __init__(self, bits: int, parts: int):
        self.bits, self.parts = bits, parts
        self.table = np.zeros((1 << bits) // 8, np.uint8)

    @property
    def stretch(self) -> int:
        return (1 << self.bits) // self.parts

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.uint64(self.stretch - 1)
        first = keys >> np.uint64(64 - self.bits)
        return first, (first & ~low) | (keys & low)

    def packed(self, keys: np.ndarray, part: int) -> bytes:
        """The stretch of ``part`` with the bits of ``keys``, which all belong there."""
        flags = np.zeros(self.stretch, bool)
        for places in self.places(keys):
            flags[places.astype(np.int64) - part * self.stretch] = True
        return np.packbits(flags, bitorder="little").tobytes()

    def put(self, part: int, data: bytes) -> None:
        size = self.stretch // 8
        self.table[part * size:(part + 1) * size] = np.frombuffer(data, np.uint8)

    def holds(self, keys: np.ndarray) -> np.ndarray:
        out = np.ones(len(keys), bool)
        for at in self.places(keys):
            out &= (self.table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


def _table(mass: int, threshold: int, parts: int) -> Marks:
    bits = max((16 * mass // threshold).bit_length(), LEAST_BITS)
    return Marks(max(min(bits, MOST_BITS), parts.bit_length() + 2), parts)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.nonzero(np.concatenate(([True], keys[1:] != keys[:-1])))[0] if len(keys) else []
    return (keys[first], np.add.reduceat(counts, first)) if len(keys) else (keys, counts)


class MisraGries:
    """At most ``capacity`` counters; ``short`` is the most that any count may be low by.

    Taking the (capacity + 1)-th largest counter off all removes over ``capacity`` times as much
    mass, so ``short`` stays under mass / capacity. Summaries merge by adding and cutting again.
    """

    def __init__(self, capacity: int):
        self.capacity, self.short = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.size += len(keys)
        if self.size >= max(self.capacity, 500_000):
            self.cut()

    def cut(self) -> None:
        parts = [(self.keys, self.counts), *self.waiting]
        self.waiting, self.size = [], 0
        keys, counts = summed(np.concatenate([k for k, _ in parts]),
                              np.concatenate([c for _, c in parts]))
        if len(keys) > self.capacity:
            least = int(np.partition(counts, len(counts) - self.capacity - 1)[
                len(counts) - self.capacity - 1])
            self.short += least
            counts = counts - least
            keys, counts = keys[counts > 0], counts[counts > 0]
        self.keys, self.counts = keys, counts

    def merge(self, other: MisraGries) -> None:
        other.cut()
        self.short += other.short
        self.add(other.keys, other.counts)
        self.cut()

    def frequent(self, threshold: int) -> np.ndarray:
        """Keys that may have ``threshold`` occurrences: all that do, if ``short`` is under it."""
        self.cut()
        return self.keys[self.counts + self.short >= threshold]


@contextmanager
def _short_batches(spark: SparkSession) -> Iterator[None]:
    """Python workers get ``BATCH_BYTES`` at a time, unless the session has a limit of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(name)


def _shares(part: np.ndarray, width: int) -> Iterator[list[tuple[int, int, int]]]:
    """``(part, start, end)`` of each value of sorted ``part``.

    They come in lists of about ``BATCH_BYTES``, a row being ``width`` bytes wide.
    """
    starts = np.nonzero(np.concatenate(([True], part[1:] != part[:-1])))[0] if len(part) else []
    batch = np.array(starts, np.int64) * width // BATCH_BYTES
    shares = list(zip(part[starts].tolist(), starts, [*starts[1:], len(part)])) if len(part) else []
    ends = np.nonzero(batch[1:] != batch[:-1])[0] + 1
    for at, end in zip([0, *ends], [*ends, len(shares)]):
        if end > at:
            yield shares[at:end]


def _level(spoken: DataFrame, n: int, tables: list[Marks], mass: int, parts: int,
           threshold: int) -> Marks:
    """Marks of the n-grams that survive; ``tables`` are those of the shorter lengths."""
    shift = np.uint64(64 - (parts.bit_length() - 1))
    marks = _table(mass, threshold, parts)
    shape = (marks.bits, parts)
    given = spoken.sparkSession.sparkContext.broadcast(tables)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in _read(batch):
                keys, counts = block.counted(given.value, n)
                part = (keys >> shift).astype(np.int64)
                for own in _shares(part, 9):
                    yield pa.RecordBatch.from_arrays([
                        pa.array([p for p, _, _ in own], pa.int32()),
                        pa.array([keys[a:b].tobytes() for _, a, b in own], pa.binary()),
                        pa.array([_narrow(counts[a:b]) for _, a, b in own], pa.binary()),
                    ], ["part", "keys", "counts"])

    def summaries(capacity: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kept: dict[int, MisraGries] = {}
            for batch in batches:
                for part, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
                    keys = np.frombuffer(keys, np.uint64)
                    kept.setdefault(part, MisraGries(capacity)).add(
                        keys, _widened(counts, len(keys)))
            for part, summary in kept.items():
                found = summary.frequent(threshold)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([summary.short], pa.int64()),
                    pa.array([Marks(*shape).packed(found, part)], pa.binary())],
                    ["part", "short", "marks"])

        return run

    dealt = spoken.select("lang", "hashes", "sequence").mapInArrow(
        deal, "part int, keys binary, counts binary").repartitionById(parts, F.col("part"))
    # a multiple of the even share; a partition whose share is larger yet is found by its own bound
    capacity = COUNTERS * (mass // (threshold * parts) + 1)
    while True:
        rows = dealt.mapInArrow(
            summaries(capacity), "part int, short bigint, marks binary").collect()
        if all(r["short"] < threshold for r in rows):
            break
        capacity *= 2
    given.unpersist()
    for r in rows:
        marks.put(r["part"], r["marks"])
    return marks


def _narrow(counts: np.ndarray) -> bytes:
    return counts.astype(np.uint8 if counts.max() < 256 else np.int64).tobytes()


def _widened(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8 if len(data) == n else np.int64).astype(np.int64)


class RowSums:
    """Counts by rows of word hashes, all of one length."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = self.size = 0

    def add(self, rows: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((rows, counts))
        self.size += len(rows)
        if self.size >= 2 * self.held + MADE_ROWS:
            self.merged()

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if self.size == self.held:
            return self.parts[0]
        rows = np.concatenate([r for r, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.lexsort(rows.T[::-1])
        rows, counts = rows[order], counts[order]
        first = np.nonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1))))[0]
        rows, counts = rows[first], np.add.reduceat(counts, first)
        self.parts, self.held, self.size = [(rows, counts)], len(rows), len(rows)
        return rows, counts


def _exact(spoken: DataFrame, tables: list[Marks], longest: int, parts: int,
           threshold: int) -> DataFrame:
    """``lang, ids, a`` of all phrases of 2 words and more found ``threshold`` times or more.

    Marked phrases are counted by their words. Tasks sum what they read and deal packed sums to
    hash partitions; a partition holds the marked phrases of its share, which the summaries'
    capacity bounds but for the few strangers.
    """
    given = spoken.sparkSession.sparkContext.broadcast(tables)
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def packed(sums: dict[tuple[str, int], RowSums]) -> Iterator[pa.RecordBatch]:
        while sums:
            (lang, n), own = sums.popitem()
            rows, counts = own.merged()
            del own
            key = np.zeros(len(rows), np.uint64)
            for k in range(n):
                key = _Block._mixed(key * _ODD + rows[:, k])
            part = (key >> shift).astype(np.int64)
            order = np.argsort(part, kind="stable")
            rows, counts, part = rows[order], counts[order], part[order]
            for used in _shares(part, 8 * n + 1):
                yield pa.RecordBatch.from_arrays([
                    pa.array([p for p, _, _ in used], pa.int32()),
                    pa.array([lang] * len(used), pa.string()),
                    pa.array([n] * len(used), pa.int32()),
                    pa.array([rows[a:b].tobytes() for _, a, b in used], pa.binary()),
                    pa.array([_narrow(counts[a:b]) for _, a, b in used], pa.binary()),
                ], ["part", "lang", "n", "rows", "counts"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], RowSums] = {}
        for batch in batches:
            for block in _read(batch):
                for n, keys, places in block.levels(given.value, longest):
                    if n == 1:
                        continue
                    places = places[given.value[n - 1].holds(keys)]
                    for at in range(0, len(places), MADE_ROWS):
                        own = places[at:at + MADE_ROWS]
                        numbers = np.stack([block.sequence[own + k] for k in range(n)], axis=1)
                        sums.setdefault((block.lang, n), RowSums()).add(
                            block.hashes[numbers], np.ones(len(numbers), np.int64))
                    if sum(s.size for s in sums.values()) >= HELD_ROWS:
                        # repeats of different stretches sum up, which may leave little to deal
                        for own in sums.values():
                            own.merged()
                        if sum(s.size for s in sums.values()) >= HELD_ROWS * 2 // 3:
                            yield from packed(sums)
        yield from packed(sums)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], RowSums] = {}
        for batch in batches:
            for lang, n, rows, counts in zip(*(c.to_pylist() for c in batch.columns[1:])):
                rows = np.frombuffer(rows, np.uint64).reshape(-1, n)
                sums.setdefault((lang, n), RowSums()).add(rows, _widened(counts, len(rows)))
        for (lang, n), own in sums.items():
            rows, counts = own.merged()
            rows, counts = rows[counts >= threshold].view(np.int64), counts[counts >= threshold]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(rows), pa.string()),
                pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, n), pa.int32()),
                                         pa.array(rows.ravel())),
                pa.array(counts)], ["lang", "ids", "a"])

    return spoken.select("lang", "hashes", "sequence").mapInArrow(
        deal, "part int, lang string, n int, rows binary, counts binary"
    ).repartitionById(parts, F.col("part")).mapInArrow(
        total, "lang string, ids array<bigint>, a bigint")


def _few(df: DataFrame) -> DataFrame:
    """A per-language table, broadcast if it is as short as such tables are."""
    return F.broadcast(df) if df.count() <= FEW else df


def _power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def phrase_counts(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                  text_col: str = "text",
                  lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(counts, words, totals)``, stored.

    ``counts(lang, ids, a)``: exact counts of all phrases of 1 to ``longest`` words found
    ``threshold`` times or more, ``ids`` the hashes of their words; ``words(lang, id, word, a)``:
    the frequent words; ``totals(lang, n)``: word occurrences.
    """
    with _short_batches(docs.sparkSession):
        return _phrase_counts(docs, threshold, longest, text_col, lang_col)


def _phrase_counts(docs: DataFrame, threshold: int, longest: int, text_col: str,
                   lang_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    for seed in range(8):
        spoken = stored(blocks(docs, seed, text_col, lang_col), "spoken", **SHORT_PAGES)
        every = stored(
            spoken.select("lang", F.explode(F.arrays_zip("words", "hashes", "counts")).alias("w"))
            .select("lang", F.col("w.hashes").alias("id"), F.col("w.words").alias("word"),
                    F.col("w.counts").alias("a"))
            .groupBy("lang", "id").agg(F.min("word").alias("word"), F.max("word").alias("other"),
                                       F.sum("a").alias("a")), "words")
        if every.where("word <> other").isEmpty():
            break
    else:
        raise RuntimeError("different words share a hash under every seed")
    totals = stored(every.groupBy("lang").agg(F.sum("a").alias("n")), "totals")
    words = every.where(F.col("a") >= threshold).select("lang", "id", "word", "a")
    mass = int(totals.agg(F.sum("n")).first()[0] or 0)
    single = words.select("lang", F.array("id").alias("ids"), "a")
    if longest < 2 or mass < threshold:
        return single, words, totals
    parts = min(MOST_PARTS, _power_of_two(max(docs.rdd.getNumPartitions(), 8)))
    tables = [_word_table(words, mass, parts, threshold)]
    for n in range(2, longest + 1):
        tables.append(_level(spoken, n, tables, mass, parts, threshold))
    long = _exact(spoken, tables, longest, parts, threshold)
    return stored(single.union(long), "counts"), words, totals


def _word_table(words: DataFrame, mass: int, parts: int, threshold: int) -> Marks:
    """Marks of the frequent words; a stretch of the table is made in one task."""
    marks = _table(mass, threshold, parts)
    shape = (marks.bits, parts)
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[int]] = {}
            for lang, id_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(id_)
            for lang, ids in by_lang.items():
                key = _Block(lang, np.array(ids, np.int64), b"").words[1:]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((key >> shift).astype(np.int32)), pa.array(key.view(np.int64))],
                    ["part", "key"])

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        keys = table.column("key").to_numpy().view(np.uint64)
        return pa.table({"part": pa.array([part], pa.int32()),
                         "marks": pa.array([Marks(*shape).packed(keys, part)], pa.binary())})

    for r in (words.select("lang", "id").mapInArrow(keyed, "part int, key bigint")
              .groupBy("part").applyInArrow(packed, "part int, marks binary").collect()):
        marks.put(r["part"], r["marks"])
    return marks


def _whole(n: int | Column) -> Column:
    return (F.lit(n) if isinstance(n, int) else n).cast("decimal(38,0)")


def scored(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """``lang, ids, a, l, r, n, score`` of the phrases that no longer one holds as often.

    A phrase inside a longer one of equal count lies, one word longer, in a phrase between them
    that is as frequent, so phrases longer by one word decide.
    """
    size = F.size("ids")
    longer = counts.where(size > 2)
    holders = longer.select("lang", F.col("a").alias("held"), F.explode(F.array(
        F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids")
    ).groupBy("lang", "ids").agg(F.max("held").alias("held"))
    free = counts.where(size > 1).join(holders, ["lang", "ids"], "left").where(
        F.col("held").isNull() | (F.col("held") < F.col("a"))).select("lang", "ids", "a")
    cuts = free.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "ids", "a", "k", F.expr("slice(ids, 1, k)").alias("first"),
                       F.expr("slice(ids, k + 1, size(ids) - k)").alias("rest"))
    known = counts.select(F.col("lang").alias("in"), F.col("ids").alias("part"),
                          F.col("a").alias("f"))
    cuts = cuts.join(known, (F.col("lang") == F.col("in")) & (F.col("first") == F.col("part"))) \
        .select("lang", "ids", "a", "k", "rest", F.col("f").alias("l"))
    cuts = cuts.join(known, (F.col("lang") == F.col("in")) & (F.col("rest") == F.col("part"))) \
        .select("lang", "ids", "a", "k", "l", F.col("f").alias("r"))
    cuts = cuts.join(_few(totals), "lang")
    over = _whole(1000) * F.col("a").cast("decimal(16,0)") * F.col("n").cast("decimal(16,0)")
    under = F.col("l").cast("decimal(18,0)") * F.col("r").cast("decimal(18,0)")
    cuts = cuts.withColumn("over", over.cast("decimal(38,0)")).withColumn(
        "under", under.cast("decimal(38,0)")).withColumn("score", F.expr("over div under"))
    best = cuts.groupBy("lang", "ids", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "ids", "a", "best.l", "best.r", "n", "best.score")


def top_phrases(docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST,
                keep: int = KEEP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``keep`` best phrases.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends, and split at blanks and tabs.
    A null language is ``und``, a null text empty. Repeated rows count again; equal scores fall
    back on the count and the phrase, so ranks do not depend on the run. Other columns are not
    read. A table without phrases as frequent as ``threshold`` gives no rows.
    """
    counts, words, totals = phrase_counts(docs, threshold, longest, text_col, lang_col)
    phrases = stored(scored(counts, totals), "scored")
    # coarse steps of the score say from where on the first `keep` lie; ties come along
    step = F.floor(F.log2(F.col("score") + 1) * 16)
    steps = phrases.groupBy("lang", step.alias("step")).agg(F.count("*").alias("n_step"))
    above = F.sum("n_step").over(W.partitionBy("lang").orderBy(F.desc("step")).rowsBetween(
        W.unboundedPreceding, -1))
    floors = stored(steps.withColumn("above", F.coalesce(above, F.lit(0))).where(
        F.col("above") < keep).groupBy("lang").agg(F.min("step").alias("least")), "floors")
    near = phrases.join(_few(floors), "lang").where(step >= F.col("least")).drop("least")
    spelled = near.select("*", F.posexplode("ids").alias("at", "id")).join(
        words.select("lang", "id", "word"), ["lang", "id"]).groupBy(
        "lang", "ids", "a", "l", "r", "n", "score").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))),
                                 lambda w: w["word"]), " ").alias("phrase"))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return spelled.withColumn("rank", F.row_number().over(order).cast("long")).where(
        F.col("rank") <= keep).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
