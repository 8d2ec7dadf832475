"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints differ in at most ``2r`` bits exactly when some third value lies within ``r``
bits of both. Every fingerprint therefore owns all variants within ``r`` flipped bits, and
fingerprints that own a common variant are linked. Variants are shuffled by their leading bits:
a fingerprint is sent once to each leading part that one of its variants has, and the variants
with that part are spelled out in the task that received it. All owners of a variant are tied to
one of them after a check of the bit distance, so a group of n near copies gives n - 1 links and
not n² pairs; the connected components are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import own_names, stored
from tidemill.llm.components import connected_components

SEED = 42
WORDS = 4
RADIUS = 2
#: Fingerprints under one leading part from which the part is cut further, and the bits by which.
HOT_PREFIX = 2000
CUT_BITS = 12
#: Variants spelled out at once in a task.
AT_ONCE = 2_000_000


def shingle_hashes(text: str, words: int = WORDS) -> np.ndarray:
    """XXH64 of every run of ``words`` words, repeats included."""
    from xxhash import xxh64_intdigest

    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-words] + 1)).tolist()
    return np.array(
        [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())],
        np.uint64,
    )


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half of the hashes; no hashes: 0."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at:at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0]) if len(hashes) else 0


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, fp)``, fp the 64 bits as a signed long; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(shingle_hashes(t)) if t else 0 for t in
                 (x.as_py() for x in batch.column(2))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                ["doc_id", "text_hash", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).alias("text"),
    ).mapInArrow(run, f"doc_id {kind}, text_hash bigint, fp bigint")


def flips(bits: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """All values of ``bits`` bits with at most ``radius`` ones, and how many ones each has."""
    values = [sum(1 << k for k in c) for r in range(radius + 1)
              for c in combinations(range(bits), r)]
    sizes = [r for r in range(radius + 1) for _ in combinations(range(bits), r)]
    return np.array(values, np.uint64), np.array(sizes, np.int8)


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of 0..n-1 over the links a-b."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while not np.array_equal(up := label[label], label):
            label = up


class _Bucket:
    """Links among the fingerprints that share a leading part of some variant."""

    def __init__(self, fps: np.ndarray):
        self.fps, self.label = fps, np.arange(len(fps))

    def solve(self, who: np.ndarray, rest: np.ndarray, left: np.ndarray, bits: int) -> None:
        """who: indexes; rest: their trailing bits; left: flips that each may still do there."""
        sizes = {r: len(flips(bits, r)[0]) for r in range(int(left.max(initial=0)) + 1)}
        if len(who) < 2:
            return
        if sum(int((left == r).sum()) * n for r, n in sizes.items()) > AT_ONCE and bits > 4:
            head = rest >> np.uint64(bits - 4)
            low = rest & np.uint64((1 << (bits - 4)) - 1)
            for part in range(16):
                off = np.bitwise_count(head ^ np.uint64(part)).astype(np.int8)
                own = off <= left
                self.solve(who[own], low[own], (left - off)[own], bits - 4)
            return
        keys, owners = [], []
        for r in sizes:
            own = left == r
            keys.append((rest[own][:, None] ^ flips(bits, r)[0][None, :]).ravel())
            owners.append(np.repeat(who[own], sizes[r]))
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        head = owner[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]
        a, b = head[~first], owner[~first]
        near = np.bitwise_count(self.fps[a] ^ self.fps[b]) <= 2 * RADIUS
        a, b = a[near], b[near]
        self.label = local_components(len(self.fps), self.label[a], self.label[b])[self.label]


def _prefix(bits: int) -> Column:
    return F.shiftrightunsigned("fp", 64 - bits)


def near_links(fps: DataFrame, hot_prefix: int = HOT_PREFIX, bits: int | None = None) -> DataFrame:
    """``(a, b)`` links that connect all distinct ``fp`` within 4 bits of each other.

    The number of leading bits follows the number of fingerprints (about 500 for each leading
    part). Parts holding more than ``hot_prefix`` are cut by further bits, so that their work goes
    to many tasks; the list of these parts has at most rows / ``hot_prefix`` entries.
    """
    if bits is None:
        total = fps.count()
        bits = next((b for b in (8, 10, 12, 16, 20, 24) if total >> b <= 512), 24)
    hot = sorted(
        r[0] for r in fps.groupBy(_prefix(bits).alias("p")).count()
        .where(F.col("count") > hot_prefix).select("p").collect()
    )

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks, used = flips(bits, RADIUS)
        more = [flips(CUT_BITS, r)[0] for r in range(RADIUS + 1)]
        dense = np.array(hot, np.uint64)
        for batch in batches:
            whole = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(whole), 20_000):
                fp = whole[at:at + 20_000]
                part = (fp >> np.uint64(64 - bits))[:, None] ^ masks[None, :]
                is_hot = np.isin(part, dense)
                row, col = np.nonzero(~is_hot)
                out = [(part[row, col], np.full(len(row), bits, np.int32), fp[row])]
                row, col = np.nonzero(is_hot)
                for r in range(RADIUS + 1):
                    own = used[col] == RADIUS - r
                    src = fp[row[own]]
                    tail = (src >> np.uint64(64 - bits - CUT_BITS)) & np.uint64(2**CUT_BITS - 1)
                    deep = ((part[row[own], col[own]] << np.uint64(CUT_BITS))[:, None]
                            | (tail[:, None] ^ more[r][None, :])).ravel()
                    out.append((deep, np.full(len(deep), bits + CUT_BITS, np.int32),
                                np.repeat(src, len(more[r]))))
                for p, b, f in out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(p.view(np.int64)), pa.array(b), pa.array(f.view(np.int64))],
                        ["part", "bits", "fp"])

    def link(key: tuple, table: pa.Table) -> pa.Table:
        part, depth = np.uint64(key[0].as_py()), key[1].as_py()
        fp = np.unique(table.column("fp").to_numpy().view(np.uint64))
        left = RADIUS - np.bitwise_count((fp >> np.uint64(64 - depth)) ^ part).astype(np.int8)
        bucket = _Bucket(fp)
        rest = 64 - depth
        bucket.solve(np.arange(len(fp)), fp & np.uint64((1 << rest) - 1), left, rest)
        own = np.nonzero(bucket.label != np.arange(len(fp)))[0]
        return pa.table({"a": fp[own].view(np.int64), "b": fp[bucket.label[own]].view(np.int64)})

    sent = fps.select("fp").mapInArrow(send, "part bigint, bits int, fp bigint")
    return sent.groupBy("part", "bits").applyInArrow(link, "a bigint, b bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text_hash, fp, component_id`` (smallest doc_id reachable).

    Equal fingerprints are one node, so thousands of exact copies cost one row in the search.
    Null texts and texts without words have fingerprint 0 and are linked like any other. Repeated
    rows stay repeated. Null ids are linked but never name a group; a group of null ids only has a
    null ``component_id``. An empty table gives no rows.
    """
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    comps = stored(connected_components(near_links(nodes)), "components")
    rooted = nodes.join(comps, nodes.fp == comps.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("root"))
    names = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "names")
    named = stored(rooted.join(names, "root").select("fp", "component_id"), "named")
    return fps.join(named, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents of ``docs`` with one kept per near-duplicate group: the one naming the group.

    Rows with a null id stay. Rows repeated under the naming id are one document; all its rows in
    the group stay. A row goes for its own text: an id that stands on texts of two groups may lose
    its row in one and name the other.
    """
    groups = near_groups(docs, id_col, text_col)
    lost, hashed = own_names(docs, "gone", "gone_hash")
    gone = stored(
        groups.where("doc_id <> component_id").select(
            F.col("doc_id").alias(lost), F.col("text_hash").alias(hashed)).distinct(), "gone")
    return docs.join(gone, (F.col(id_col) == F.col(lost))
                     & (F.xxhash64(text_col) == F.col(hashed)), "left_anti")
