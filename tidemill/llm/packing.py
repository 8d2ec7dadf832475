"""Pack tokenised documents into fixed-length sequences by hierarchical best fit.

Each task packs its own items best fit, longest first, and closes bins that are nearly full. Bins
with room left go on as items of the next, narrower round, until one task has seen what is left or
a round no longer joins bins. A task holds lengths and ids only, at most ``TASK_ITEMS`` at a time.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored

CAPACITY = 1024
END_ID = 2
#: A bin with this much room or less is closed.
ROOM_LEFT = 4
#: Items one task packs at a time, and tasks whose rests meet in one task of the next round.
TASK_ITEMS = 250_000
FAN_IN = 8
#: Words whose ids a worker remembers, and bytes of ids in one batch of pieces.
CACHE = 200_000
BATCH_BYTES = 1 << 21

_SPLIT_UNSAFE = re.compile(r"\s ")
_SPECIAL = "<|endoftext|>"


class Encoder(dict):
    """Ids of a text as little-endian 32-bit bytes.

    Maps a word to the ids of the word with a space before it. Text may be cut before a space
    between two other characters without changing its ids, so most words come from this memory.
    The rank file holds the vocabulary of the tokenizer file; texts holding a special token's name
    go to the tokenizer itself.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        super().__init__()
        import base64

        import public_tokenizers
        import tiktoken

        self._json = public_tokenizers.path(f"{name}.json")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self._encode = tiktoken.Encoding(
            "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self._whole = None

    def _bytes(self, text: str) -> bytes:
        return np.array(self._encode(text), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self._bytes(" " + word)
        if len(self) >= CACHE:
            self.clear()
        if len(word) <= 40:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _SPECIAL in text:
            if self._whole is None:
                from tokenizers import Tokenizer

                self._whole = Tokenizer.from_file(self._json)
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if _SPLIT_UNSAFE.search(text):
            return self._bytes(text)
        first, *rest = text.split(" ")
        return self._bytes(first) + b"".join(map(self.__getitem__, rest))


def pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, item`` and, if asked, ``ids`` (array of int).

    A document is its ids and the end id; a null text is the end id alone. Longer ones than
    ``capacity`` are cut into full pieces from the end, so only piece 0 may be shorter. ``item``
    is a number of the piece, unique in the result once it is stored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, item = Encoder(), TaskContext.get().partitionId() << 36
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                rows, size = [], 0
                while at < batch.num_rows and size < BATCH_BYTES:
                    ids = encoder.encode(batch.column(1)[at].as_py() or "") + end
                    n = len(ids) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        part = ids[4 * a:4 * b]
                        rows.append((at, k, a, b - a, zlib.crc32(part), item,
                                     part if with_ids else None))
                        item += 1
                    size += len(ids)
                    at += 1
                row, k, a, n, crc, number, part = zip(*rows)
                columns = [batch.column(0).take(pa.array(row)), pa.array(k, pa.int32()),
                           *(pa.array(x, pa.int64()) for x in (a, n, crc, number))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "item"]
                if with_ids:
                    names.append("ids")
                    columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32)
                                             for p in part], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = (f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, "
              "item bigint" + (", ids array<int>" if with_ids else ""))
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and the fill of each bin; longest items first.

    ``rooms`` has bit r set if some open bin has room r, so the tightest fit is one bit search.
    """
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms, open_bins, fills = 0, [[] for _ in range(capacity + 1)], []
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        fits = rooms >> need
        if fits:
            room = need + (fits & -fits).bit_length() - 1
            bin_ = open_bins[room].pop()
            if not open_bins[room]:
                rooms ^= 1 << room
        else:
            room, bin_ = capacity, len(fills)
            fills.append(0)
        bins[i], offsets[i] = bin_, capacity - room
        fills[bin_] += need
        if room > need:
            open_bins[room - need].append(bin_)
            rooms |= 1 << (room - need)
    return bins, offsets, np.array(fills, np.int64)


def _round(items: DataFrame, number: int, tasks: int, capacity: int) -> DataFrame:
    """``item, bin, offset, fill`` of one round; items are ``(item, length)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_bin = (number << 56) | (TaskContext.get().partitionId() << 32)
        held: list[pa.RecordBatch] = []

        def pack() -> pa.RecordBatch:
            nonlocal next_bin, held
            item = np.concatenate([b.column(0).to_numpy() for b in held])
            bins, offsets, fills = best_fit(
                np.concatenate([b.column(1).to_numpy() for b in held]), capacity)
            out = pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (item, bins + next_bin, offsets, fills[bins])],
                ["item", "bin", "offset", "fill"])
            next_bin, held = next_bin + len(fills), []
            return out

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= TASK_ITEMS:
                yield pack()
        if held:
            yield pack()

    return items.select("item", "length").coalesce(tasks).mapInArrow(
        run, "item bigint, bin bigint, offset bigint, fill bigint")


def place(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored ``pieces`` with ``sequence_id`` and ``offset``; other columns are kept.

    Full pieces are sequences of their own (odd numbers); bins have even numbers.
    """
    items = made.where(F.col("length") < capacity).select("item", "length")
    left = items.count()
    tasks = max(1, -(-left // TASK_ITEMS))
    placed = None
    for number in range(1, 32):
        packed = stored(_round(items, number, tasks, capacity), f"round{number}")
        if placed is None:
            placed = packed.select("item", "bin", "offset")
        else:
            moved = packed.select(F.col("item").alias("__bin"), F.col("bin").alias("__to"),
                                  F.col("offset").alias("__by"))
            placed = placed.join(moved, F.col("bin") == F.col("__bin"), "left").select(
                "item", F.coalesce("__to", "bin").alias("bin"),
                (F.col("offset") + F.coalesce("__by", F.lit(0))).alias("offset"))
        items = packed.where((F.col("offset") == 0) & (F.col("fill") < capacity - ROOM_LEFT)).select(
            F.col("bin").alias("item"), F.col("fill").alias("length"))
        before, left = left, items.count()
        # joined bins lower the count; closed ones do too, and are no reason to stop
        if tasks == 1 or left < 2 or number > 1 and left > 0.999 * before:
            break
        tasks = max(1, -(-left // TASK_ITEMS), tasks // FAN_IN)
    placed = placed.select(F.col("item").alias("__item"), F.col("bin").alias("__in"),
                           F.col("offset").alias("__at"))
    full = F.col("__in").isNull()
    return made.join(placed, F.col("item") == F.col("__item"), "left").select(
        *[c for c in made.columns if c != "item"],
        F.when(full, F.col("item") * 2 + 1).otherwise(F.col("__in") * 2).alias("sequence_id"),
        F.when(full, F.lit(0)).otherwise(F.col("__at")).cast("long").alias("offset"))


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row per piece with its sequence and place there; see ``pieces`` and ``place``.

    Null and empty texts are one end id. Repeated rows, ties and null ids are packed as rows of
    their own. An empty table gives no rows. Lengths tie in the order read.
    """
    return place(stored(pieces(docs, id_col, text_col, capacity, with_ids), "pieces"), capacity)
