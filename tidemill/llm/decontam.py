"""Benchmark decontamination with suffix arrays over the training text.

The documents of a task form shards. A shard's words become numbers of the test vocabulary, its
suffixes are sorted, and every suffix of every test item is looked up by binary search for as many
words as a match needs. Places found one word further in both the item and the document belong to
one verbatim match, so they join to maximal matches: item, place in the item, place in the document
and length. Hit words and removal follow from the matches. Suffixes of the training text that
cannot open a match (the run of words known from the tests is too short) are left out of the array,
which changes no result; equal beginnings of test suffixes are looked up once. Test items are sent to the tasks in blocks of bounded size; more
blocks mean more passes over a document inside the same task, never a larger broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 10
#: Words in a shard (one document may exceed it) and UTF-8 bytes of test text in a block.
SHARD_WORDS = 1_000_000
BLOCK_BYTES = 32 << 20
_AT_ONCE = 50_000
#: Pairs of a place and a test suffix held at once; one run of places may have more.
_PAIRS_AT_ONCE = 4_000_000

#: Byte to byte: a-z, 0-9 and all of UTF-8 beyond ASCII stay, A-Z go to a-z, the rest is blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class TestBlock:
    """Items of a block: vocabulary, words as numbers, and by length what their suffixes begin with."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        self.ids: list[str | None] = []
        self.vocabulary: dict[bytes, int] = {}
        rows: list[np.ndarray] = []
        for name, text in items:
            found = words(text)
            if found:
                self.ids.append(name)
                rows.append(np.array(
                    [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found], np.int32))
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.tokens = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        #: length -> (matrix of beginnings; of row k the item and the word in it of each suffix,
        #: items[bounds[k]:bounds[k + 1]] and words[...])
        self.windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        short = np.minimum(self.lengths, window)
        for w in np.unique(short).tolist():
            own = np.nonzero(short == w)[0]
            n = self.lengths[own] - w + 1
            item = np.repeat(own, n)
            word = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = word + self.starts[item]
            matrix, kind = np.unique(
                self.tokens[at[:, None] + np.arange(w)], axis=0, return_inverse=True)
            order = np.argsort(kind.ravel(), kind="stable")
            bounds = np.searchsorted(kind.ravel()[order], np.arange(len(matrix) + 1))
            self.windows[w] = matrix, item[order], word[order], bounds

    @property
    def shortest(self) -> int:
        return min(self.windows, default=1)

    @property
    def longest(self) -> int:
        return int(self.lengths.max(initial=1))


class SuffixArray:
    """Suffixes of a shard's words in order; -1 is a word unknown to the tests or an end."""

    def __init__(self, tokens: np.ndarray, block: TestBlock):
        n = len(tokens)
        known = tokens >= 0
        place = np.arange(n)
        end = np.minimum.accumulate(np.where(known, n, place)[::-1])[::-1]
        begin = np.maximum.accumulate(np.where(known, -1, place))
        kept = np.nonzero(known & (end - begin - 1 >= block.shortest))[0]
        # the kept runs, with one end mark before each and enough of them at the end
        jump = np.concatenate(([True], np.diff(kept) > 1)) if len(kept) else np.zeros(0, bool)
        slot = np.arange(len(kept)) + np.cumsum(jump)
        size = int(slot[-1]) + 1 if len(kept) else 0
        self.words = np.full(size + block.longest + 1, -1, np.int32)
        self.words[slot] = tokens[kept]
        self.origin = np.full(size, -1, np.int64)
        self.origin[slot] = kept
        rank = self.words[:size].astype(np.int64) + 1
        step = 1
        while step < block.longest and size:
            after = np.concatenate((rank[step:], np.zeros(min(step, size), np.int64)))[:size]
            keys, rank = np.unique(rank * (int(rank.max()) + 1 + size) + after, return_inverse=True)
            if len(keys) == size:
                break
            step *= 2
        order = np.argsort(rank, kind="stable")
        self.order = order[self.origin[order] >= 0]

    def find(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of the suffixes that begin with each row of ``patterns``."""
        return self._bound(patterns, False), self._bound(patterns, True)

    def _bound(self, patterns: np.ndarray, after: bool) -> np.ndarray:
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.order), np.int64)
        column = np.arange(patterns.shape[1])
        while (active := np.nonzero(low < high)[0]).size:
            middle = (low[active] + high[active]) // 2
            have = self.words[self.order[middle][:, None] + column]
            differs = have != patterns[active]
            first = differs.argmax(axis=1)
            row = np.arange(len(active))
            less = np.where(differs[row, first], have[row, first] < patterns[active, first], after)
            low[active[less]] = middle[less] + 1
            high[active[~less]] = middle[~less]
        return low

    def occurrences(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row of patterns, word position in the shard) of every occurrence."""
        which, where = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(patterns), _AT_ONCE):
            low, high = self.find(patterns[at:at + _AT_ONCE])
            n = high - low
            row = np.repeat(np.arange(len(n)), n)
            slot = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[row]
            which.append(row + at)
            where.append(self.origin[self.order[slot]])
        return np.concatenate(which), np.concatenate(where)

    def matches(self, block: TestBlock) -> Iterator[np.ndarray]:
        """Rows (place in the shard, length, item, word in the item) of all maximal matches.

        Places of one item whose difference to the word in the item is the same and which follow
        one another are one match. A match lies within one document, so a chunk of documents at a
        time is looked through.
        """
        for w, (matrix, items, words_in, bounds) in block.windows.items():
            which, where = self.occurrences(matrix)
            order = np.argsort(where, kind="stable")
            which, where = which[order], where[order]
            n = bounds[which + 1] - bounds[which]
            # matches of one place run on to neighbouring places only
            breaks = np.concatenate(([True], np.diff(where) > 1)) if len(where) else []
            run = np.cumsum(breaks) - 1 if len(where) else np.zeros(0, np.int64)
            load = np.cumsum(np.bincount(run, n)) if len(where) else np.zeros(0)
            chunk = (load[run] // _PAIRS_AT_ONCE).astype(np.int64) if len(where) else run
            for c in np.unique(chunk).tolist():
                own = chunk == c
                kinds, places, count = which[own], where[own], n[own]
                row = np.repeat(np.arange(len(count)), count)
                slot = (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                        + bounds[kinds][row])
                item, word, place = items[slot], words_in[slot], places[row]
                order = np.lexsort((place, place - word, item))
                item, word, place = item[order], word[order], place[order]
                first = np.concatenate(([True], (item[1:] != item[:-1])
                                        | (place[1:] - word[1:] != place[:-1] - word[:-1])
                                        | (place[1:] != place[:-1] + 1)))
                begin = np.nonzero(first)[0]
                length = np.diff(np.append(begin, len(item))) + w - 1
                yield np.stack([place[begin], length, item[begin], word[begin]], axis=1)


def blocks_of(benchmark: DataFrame, id_col: str, text_col: str, window: int,
              block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[TestBlock, bool]]:
    """Test items in blocks of about ``block_bytes``, and whether it is the last block."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("name"),
                            F.col(text_col).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-total // block_bytes) or 1
    for k in range(count):
        own = rows.where(F.pmod(F.xxhash64("name", "text"), F.lit(count)) == k)
        yield TestBlock([tuple(r) for r in own.collect()], window), k == count - 1


def _shards(batches: Iterator[pa.RecordBatch], column: int, vocabulary: dict[bytes, int]):
    """(rows of a shard, word counts, starts, tokens with an end mark after each document)."""
    for batch in batches:
        at, n = 0, batch.num_rows
        while at < n:
            first, counts, parts, size = at, [], [], 0
            while at < n and size < SHARD_WORDS:
                found = words(batch.column(column)[at].as_py())
                parts.append(np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int32,
                                         len(found)))
                parts.append(np.array([-1], np.int32))
                counts.append(len(found))
                size += len(found) + 1
                at += 1
            count = np.array(counts, np.int64)
            yield (batch.slice(first, at - first), count, np.cumsum(count + 1) - count - 1,
                   np.concatenate(parts))


def _judged(batches: Iterator[pa.RecordBatch], column: int, block: TestBlock):
    """(rows of a shard, word counts, {row: matches (word, length, item, word in the item)})."""
    for rows, counts, starts, tokens in _shards(batches, column, block.vocabulary):
        found: dict[int, list[tuple]] = {}
        for part in SuffixArray(tokens, block).matches(block):
            row = np.searchsorted(starts, part[:, 0], side="right") - 1
            part[:, 0] -= starts[row]
            for d, match in zip(row.tolist(), part.tolist()):
                found.setdefault(d, []).append(tuple(match))
        yield rows, counts, found


_MATCH = [("word", pa.int64()), ("length", pa.int64()), ("item", pa.string()),
          ("item_word", pa.int64())]
_MATCHES = pa.list_(pa.struct(_MATCH))
_MATCH_SQL = "array<struct<word:bigint,length:bigint,item:string,item_word:bigint>>"


def mark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, n_words, matches, items, spans`` for every row of ``docs``.

    ``matches``: every maximal verbatim match of ``window`` words or more, or of a whole item if it
    has fewer, as ``word`` (place in the document), ``length``, ``item`` (its id as text) and
    ``item_word`` (place in the item), sorted. ``items``: sorted ids of the matched items;
    ``spans``: word ranges of the document inside matches, merged. Null and empty texts have no
    words, on either side. Equal items are found each; rows repeated under one item id count once
    in ``items``; a match of an item with a null id has a null ``item``. Rows repeated in ``docs``
    are judged each. An empty benchmark marks nothing.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, matches {_MATCH_SQL}"
    marked = docs.select(
        F.col(id_col).alias("doc_id"), F.lit(0).cast("bigint").alias("n_words"),
        F.array().cast(_MATCH_SQL).alias("matches"), F.col(text_col).cast("string").alias("text"))

    for block, last in blocks_of(benchmark, item_col, item_text_col, window, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block=block,
                last=last) -> Iterator[pa.RecordBatch]:
            for rows, counts, found in _judged(batches, 3, block):
                matches = rows.column(2).to_pylist()
                for d, got in found.items():
                    matches[d] = matches[d] + [
                        {"word": p, "length": n, "item": block.ids[i], "item_word": k}
                        for p, n, i, k in got]
                columns = [rows.column(0), pa.array(counts), pa.array(matches, _MATCHES)]
                names = ["doc_id", "n_words", "matches"]
                if not last:
                    columns, names = [*columns, rows.column(3)], [*names, "text"]
                yield pa.RecordBatch.from_arrays(columns, names)

        marked = marked.mapInArrow(run, schema + ("" if last else ", text string"))
    matches = F.array_sort("matches")
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")

    def joined(spans: Column, match: Column) -> Column:
        """Matches come by their first word: one either goes on in the last span or opens one."""
        last = F.element_at(spans, -1)
        stop = match["word"] + match["length"]
        opened = F.struct(match["word"].alias("start"), stop.alias("stop"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], stop).alias("stop"))
        return F.when((F.size(spans) == 0) | (match["word"] > last["stop"]),
                      F.concat(spans, F.array(opened))).otherwise(
            F.concat(F.slice(spans, F.lit(1), F.size(spans) - 1), F.array(longer)))

    ids = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"])))
    return marked.select("doc_id", "n_words", matches.alias("matches")).select(
        "*", F.filter(ids, lambda i: i.isNotNull()).alias("items"),
        F.when(F.size("matches") == 0, none).otherwise(
            F.aggregate("matches", none, joined)).alias("spans"))


def report(marked: DataFrame) -> DataFrame:
    """Counts and a digest per document from ``mark``."""
    hits = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.stop - s.start)
    return marked.select(
        "doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


def longest_matches(marked: DataFrame) -> DataFrame:
    """``item_id, item_word, length, doc_id, doc_word``: the longest match of each matched item.

    ``marked`` comes from ``mark``. Equal lengths: the largest (document, word, item word).
    """
    rows = marked.select("doc_id", F.explode("matches").alias("m"))
    best = F.max(F.struct("m.length", "doc_id", F.col("m.word").alias("doc_word"),
                          "m.item_word")).alias("best")
    return rows.groupBy(F.col("m.item").alias("item_id")).agg(best).select(
        "item_id", "best.item_word", "best.length", "best.doc_id", "best.doc_word")


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
               text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """Documents without a match, all columns kept.

    Each block of test items removes what it hits in one pass over the rows, without a shuffle.
    """
    column = docs.columns.index(text_col)
    for block, _ in blocks_of(benchmark, item_col, item_text_col, WINDOW):

        def run(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for rows, counts, found in _judged(batches, column, block):
                keep = np.ones(len(counts), bool)
                keep[list(found)] = False
                yield rows.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
