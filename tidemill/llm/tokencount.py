"""Token counts by byte-pair merging over a heap and a linked list, without any token ids.

A text's symbols are its characters; the adjacent pair whose joined piece ranks lowest is popped
from a heap and joined until no pair is a piece. The count is the number of first symbols less
the number of joins. No piece holds a space after another character or a character that is no
piece itself, so a text may be cut before each run of spaces and at such characters, and most
chunks are words whose count the worker remembers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 4096
SPACE = "▁"
#: Chunks whose counts a worker remembers, and the longest of them.
CACHE = 500_000
CACHED_CHARS = 64

_CHUNK = re.compile(r" *[^ \n]+| +")


class Counts(dict):
    """Count of a chunk, computed when first asked for; ``of`` counts a whole text."""

    def __init__(self, model: str):
        super().__init__()
        from sentencepiece import SentencePieceProcessor

        known = SentencePieceProcessor(model_file=model)
        pieces = [
            (known.id_to_piece(i), known.get_score(i)) for i in range(known.get_piece_size())
            if not (known.is_byte(i) or known.is_control(i) or known.is_unknown(i))
        ]
        places = {s: k for k, s in enumerate(sorted({s for _, s in pieces}, reverse=True))}
        self.ranks = {piece: places[score] for piece, score in pieces}
        single = {piece for piece in self.ranks if len(piece) == 1}
        for piece in self.ranks:
            if SPACE in piece.lstrip(SPACE) or not single.issuperset(piece):
                raise ValueError(f"texts cannot be cut where piece {piece!r} may lie")
        self.single = frozenset(single)
        self.break_cost = self._symbols("\n")

    def _symbols(self, char: str) -> int:
        """A character that is no piece counts as its bytes."""
        return 1 if char in self.single else len(char.encode("utf-8", "surrogatepass"))

    def __missing__(self, chunk: str) -> int:
        n = self.merged(chunk.replace(" ", SPACE))
        if len(self) >= CACHE:
            self.clear()
        if len(chunk) <= CACHED_CHARS:
            self[chunk] = n
        return n

    def merged(self, chunk: str) -> int:
        """First symbols of ``chunk`` less the joins; equal ranks join from the left."""
        n, ranks = len(chunk), self.ranks
        total = n if self.single.issuperset(chunk) else sum(map(self._symbols, chunk))
        size = [1] * n + [0]
        before = list(range(-1, n))
        heap = [(r, i, 2) for i in range(n - 1)
                if (r := ranks.get(chunk[i:i + 2])) is not None]
        heapify(heap)
        while heap:
            _, at, length = heappop(heap)
            right = at + size[at]
            # a joined symbol has size 0, a longer neighbour another length
            if not size[at] or right >= n or size[at] + size[right] != length:
                continue
            size[at], size[right] = length, 0
            total -= 1
            after = at + length
            before[after] = at
            if after < n:
                wide = length + size[after]
                if (r := ranks.get(chunk[at:at + wide])) is not None:
                    heappush(heap, (r, at, wide))
            if (left := before[at]) >= 0:
                wide = size[left] + length
                if (r := ranks.get(chunk[left:left + wide])) is not None:
                    heappush(heap, (r, left, wide))
        return total

    def of(self, text: str | None) -> int:
        """A text is read with a space before it; an empty one has no tokens."""
        if not text:
            return 0
        text = " " + text.replace(SPACE, " ")
        return (sum(map(self.__getitem__, _CHUNK.findall(text)))
                + text.count("\n") * self.break_cost)


def count_tokens(docs: DataFrame, model: str | None = None, limit: int = LIMIT,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit``.

    ``model`` is the path of a byte-pair piece model as every executor sees it. Null and empty
    texts have no bytes and no tokens. Names of special tokens inside a text are ordinary text.
    Null ids, repeated rows and ties are rows like any other; other columns are not read. An empty
    table gives no rows. Very long texts need memory in proportion to the longest one.
    """
    if model is None:
        import public_tokenizers

        model = public_tokenizers.path("piece_bpe_32k.model")
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counts(model)
        for batch in batches:
            n = pa.array([counts.of(t.as_py()) for t in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), n], ["doc_id", "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col).alias("doc_id"),
                          F.octet_length(text).cast("long").alias("n_bytes"),
                          text.alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
