"""Asynchronous enrichment through an external lookup, batch by batch."""

from __future__ import annotations

import queue
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _answers(keys: list, lookup: Callable, timeout_s: float, threads: int,
             fallback: str | None, on_error: str) -> Iterator[tuple]:
    """(key, value) as the answers come in; at most ``threads`` requests wait at a time.

    A key's time runs from its own request. Requests run in daemon threads, so one that never ends
    holds up neither the others nor the task.
    """
    done: queue.SimpleQueue = queue.SimpleQueue()
    todo, deadline = deque(keys), {}

    def ask(key) -> None:
        try:
            done.put((key, lookup(key), None))
        except Exception as exc:  # handed to the caller, which decides
            done.put((key, None, exc))

    while todo or deadline:
        while todo and len(deadline) < threads:
            key = todo.popleft()
            deadline[key] = time.monotonic() + timeout_s
            threading.Thread(target=ask, args=(key,), daemon=True).start()
        try:
            key, value, error = done.get(timeout=max(0.0, min(deadline.values()) - time.monotonic()))
        except queue.Empty:
            now = time.monotonic()
            for key in [k for k, t in deadline.items() if t <= now]:
                del deadline[key]
                yield key, fallback
            continue
        if deadline.pop(key, None) is None:
            continue  # answered after its time
        if error is not None and on_error == "fail":
            raise error
        yield key, fallback if error is not None else value


def async_enrich(df: DataFrame, key: str, out: str, make_client: Callable[[], Callable],
                 timeout_s: float = 2.0, fallback: str | None = None, threads: int = 16,
                 ordered: bool = True, on_error: str = "fail", chunk: int = 256) -> DataFrame:
    """Add ``out`` = ``lookup(key)`` with up to ``threads`` requests in flight per task.

    ``make_client`` runs once per task and returns the lookup function. Repeated keys of an Arrow
    batch are asked once; a null key gives null. A lookup over ``timeout_s`` gives ``fallback``; one
    that raises fails the task, or gives ``fallback`` with ``on_error="fallback"``. Input order is
    kept with ``ordered``; without, rows go out as soon as ``chunk`` keys are answered.
    """
    if on_error not in ("fail", "fallback"):
        raise ValueError(f"on_error must be fail or fallback, not {on_error}")

    def values(keys: pd.Series, found: dict) -> pd.Series:
        return pd.Series([found.get(k) for k in keys], index=keys.index, dtype=object)

    def enrich(batches):
        lookup = make_client()
        for pdf in batches:
            keys = pdf[key].dropna().unique().tolist()
            found: dict = {}
            left = pdf
            for asked, value in _answers(keys, lookup, timeout_s, threads, fallback, on_error):
                found[asked] = value
                if not ordered and len(found) >= chunk:
                    ready = left[key].isin(list(found))
                    rows = left[ready]
                    yield rows.assign(**{out: values(rows[key], found)})
                    left, found = left[~ready], {}
            yield left.assign(**{out: values(left[key], found)})

    schema = T.StructType([*(f for f in df.schema.fields if f.name != out),
                           T.StructField(out, T.StringType(), True)])
    return df.mapInPandas(enrich, schema)
