"""State of many keys in one: the rows of a bucket of keys, packed as Arrow.

Every call of a Python processor for its state is a message to the executor and back, so a state per
key costs several messages per key and batch. Here a state belongs to a bucket of keys: it is read
and written in a few messages, and its rows are joined to the batch's rows by columns. A null key is a
value of its own; longs that may be null travel as a long and a flag, as pandas would make floats of
them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Buckets of keys; a bucket's state is in memory while its rows are worked on.
BUCKETS = 1024


def bucket_of(*keys: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def flagged(name: str) -> list[Column]:
    """A long column as a value and a flag ``no_<name>`` that says it is null."""
    return [F.coalesce(F.col(name).cast("bigint"), F.lit(0)).alias(name),
            F.col(name).isNull().alias(f"no_{name}")]


def longs(values: pd.Series, none: pd.Series) -> pd.array:
    """The column that :func:`flagged` took apart."""
    return pd.arrays.IntegerArray(values.to_numpy(np.int64).copy(), none.to_numpy(bool).copy())


class Packed:
    """Rows of a bucket in list state, one Arrow part per addition.

    With ``unique`` columns the rows are merged by them now and then, the first staying, so that rows
    added again leave no more than about as many rows as there are different ones.
    """

    def __init__(self, handle, name: str, schema: pa.Schema, unique: list[str] | None = None,
                 ttl_ms: int | None = None):
        self.schema, self.unique = schema, unique
        self.parts = handle.getListState(name, "part binary", ttlDurationMs=ttl_ms)
        self.sizes = handle.getValueState(f"{name}_sizes", "rows long, merged long") if (
            unique) else None

    def _bytes(self, rows: pd.DataFrame) -> bytes:
        table = pa.Table.from_pandas(rows, self.schema, preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, self.schema) as out:
            out.write_table(table)
        return sink.getvalue().to_pybytes()

    def each(self) -> Iterator[pd.DataFrame]:
        """The parts, in the order of their addition."""
        for part in [p[0] for p in self.parts.get()]:
            with pa.ipc.open_stream(part) as stream:
                yield stream.read_all().to_pandas()

    def read(self) -> pd.DataFrame:
        rows = list(self.each())
        if not rows:
            return self.schema.empty_table().to_pandas()
        out = rows[0] if len(rows) == 1 else pd.concat(rows, ignore_index=True)
        return out if self.unique is None else out.drop_duplicates(self.unique)

    def add(self, rows: pd.DataFrame) -> None:
        if not len(rows):
            return
        self.parts.appendValue((self._bytes(rows),))
        if self.unique is not None:
            held = self.sizes.get()
            n, merged = held if held is not None else (0, 0)
            n += len(rows)
            if n > 2 * merged + 10_000:
                self.put(self.read())
            else:
                self.sizes.update((n, merged))

    def put(self, rows: pd.DataFrame) -> None:
        self.parts.clear()
        if len(rows):
            self.parts.appendValue((self._bytes(rows),))
        if self.unique is not None:
            self.sizes.update((len(rows), len(rows)))


def known(rows: pd.DataFrame, others: pd.DataFrame, on: list[str]) -> np.ndarray:
    """Whether a row's key is among the others."""
    return rows[on].merge(others[on].drop_duplicates().assign(known=True), on=on, how="left")[
        "known"].notna().to_numpy()
