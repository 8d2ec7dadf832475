"""Lookup of keys in an outside table through a bounded cache in every worker."""

from __future__ import annotations

import time
import zlib
from collections import OrderedDict
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.session import qualified

_KEPT: dict[str, "LookupCache"] = {}


class LookupCache:
    """At most ``max_rows`` keys, the least recently used one goes first; a key lives ``ttl_s``."""

    def __init__(self, max_rows: int, ttl_s: float, clock: Callable[[], float] = time.monotonic):
        if max_rows < 1:
            raise ValueError("max_rows must be at least 1")
        self.max_rows, self.ttl_s, self.clock = max_rows, ttl_s, clock
        self._rows: OrderedDict = OrderedDict()

    def __len__(self) -> int:
        return len(self._rows)

    def get(self, key) -> tuple[bool, tuple | None]:
        """(known, row); a key known to be absent has no row."""
        entry = self._rows.get(key)
        if entry is None:
            return False, None
        if entry[0] <= self.clock():
            del self._rows[key]
            return False, None
        self._rows.move_to_end(key)
        return True, entry[1]

    def put(self, key, row: tuple | None) -> None:
        self._rows[key] = (self.clock() + self.ttl_s, row)
        self._rows.move_to_end(key)
        while len(self._rows) > self.max_rows:
            self._rows.popitem(last=False)


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.crc32(F.col(key).cast("string")), F.lit(buckets))


class ParquetLookup:
    """Answers keys from a Parquet table; statistics rule out row groups without any of them.

    ``uri`` needs a scheme (``tidemill.session.qualified``). Of several rows of a key the first
    read counts. A table of :meth:`laid_out` has a folder per bucket of keys, of which only those of
    the asked keys are opened.
    """

    def __init__(self, uri: str, key: str, columns: list[str], buckets: int | None = None):
        self.uri, self.key, self.columns, self.buckets = uri, key, columns, buckets

    @classmethod
    def laid_out(cls, table: DataFrame, key: str, columns: list[str], path: str,
                 bucket_rows: int = 1000) -> ParquetLookup:
        """Copies a table of files to ``path`` by buckets of about ``bucket_rows`` keys.

        Keys are whole numbers or text. The rows of a key keep the order they have in the files.
        """
        buckets = max(1, -(-table.count() // bucket_rows))
        rows = table.select(key, *columns, F.col("_metadata.file_path").alias("__file"),
                            F.col("_metadata.file_block_start").alias("__block"),
                            F.monotonically_increasing_id().alias("__row"))
        rows.where(F.col(key).isNotNull()).withColumn("__bucket", _bucket(key, buckets)).repartition(
            "__bucket").sortWithinPartitions("__bucket", "__file", "__block", "__row").drop(
                "__file", "__block", "__row").write.partitionBy("__bucket").parquet(path)
        return cls(qualified(table.sparkSession, path), key, columns, buckets)

    def near(self, rows: DataFrame, key: str, tie: list[str]) -> DataFrame:
        """``rows`` of a batch so that those of a bucket lie together, a hot key in several tasks."""
        by = [_bucket(key, self.buckets), F.col(key), *[F.col(c) for c in tie]]
        return rows.repartitionByRange(*by).sortWithinPartitions(*by)

    def _table(self, keys: list):
        import pyarrow.dataset as ds
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(self.uri)
        if self.buckets is None:
            return ds.dataset(path, filesystem=system, format="parquet")
        wanted = {zlib.crc32(str(k).encode()) % self.buckets for k in keys}
        files = [f.path for b in sorted(wanted) for f in sorted(system.get_file_info(
            fs.FileSelector(f"{path}/__bucket={b}", allow_not_found=True)), key=lambda f: f.path)
            if f.path.endswith(".parquet")]
        return ds.dataset(files, filesystem=system, format="parquet") if files else None

    def __call__(self, keys: list) -> dict:
        import pyarrow.dataset as ds

        table = self._table(keys)
        found: dict = {}
        if table is None:
            return found
        for batch in table.to_batches(columns=[self.key, *self.columns],
                                      filter=ds.field(self.key).isin(keys)):
            names, *values = (c.to_pylist() for c in batch.columns)
            for name, *row in zip(names, *values):
                found.setdefault(name, tuple(row))
        return found


def cached_lookup(df: DataFrame, key: str, fields: T.StructType, ask: Callable[[list], dict],
                  max_rows: int, ttl_s: float, name: str, chunk: int = 1000,
                  keep_absent: bool = True, hit: str | None = None) -> DataFrame:
    """Left lookup join: adds ``fields`` as ``ask(keys) -> {key: row}`` answers.

    Each worker process keeps one cache per ``name``, through all tasks and micro-batches it runs.
    A key is asked once per Arrow batch at most, ``chunk`` keys a request; so memory is bounded by
    the cache and one Arrow batch. Keys without a row give nulls and are remembered too unless
    ``keep_absent`` is off; a null key gives nulls and is never asked. ``hit`` names a column that
    says whether the row's key came from the cache or an earlier row of its batch; the rows where it
    is false count the questions. Added names may not be names of ``df``.
    """
    clash = {f.name for f in fields.fields} | ({hit} if hit else set())
    if clash & set(df.columns):
        raise ValueError(f"names taken: {sorted(clash & set(df.columns))}")
    names = [f.name for f in fields.fields]

    def answers(keys: list, cache: LookupCache) -> tuple[dict, set]:
        found, asked = {}, []
        for k in keys:
            known, row = cache.get(k)
            if known:
                found[k] = row
            else:
                asked.append(k)
        for i in range(0, len(asked), chunk):
            part = asked[i:i + chunk]
            got = ask(part)
            for k in part:
                found[k] = got.get(k)
                if found[k] is not None or keep_absent:
                    cache.put(k, found[k])
        return found, set(asked)

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = _KEPT.get(name)
        if cache is None or (cache.max_rows, cache.ttl_s) != (max_rows, ttl_s):
            cache = _KEPT[name] = LookupCache(max_rows, ttl_s)
        empty = (None,) * len(names)
        for pdf in batches:
            present = pdf[key].notna()
            # plain Python values, as a client expects them
            keys = [k.item() if hasattr(k, "item") else k for k in pdf.loc[present, key].unique()]
            found, asked = answers(keys, cache)
            rows = [(found.get(k) if p else None) or empty for k, p in zip(pdf[key], present)]
            out = pdf.copy()
            for i, column in enumerate(names):
                out[column] = pd.Series([r[i] for r in rows], index=pdf.index, dtype=object)
            if hit:
                first = ~pdf[key].duplicated()
                out[hit] = ~(first & pdf[key].isin(asked)) & present
                out.loc[~present, hit] = None
            yield out

    extra = [T.StructField(hit, T.BooleanType())] if hit else []
    return df.mapInPandas(look_up, T.StructType([*df.schema.fields, *fields.fields, *extra]))
