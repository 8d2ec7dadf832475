"""Event-time timers: windows that fire again for late rows, and joins with versions.

The processors see the event time as a plain number, so that Spark's own filter does not drop rows
for their time before the processor has judged them by their window or version.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemill.streaming.packed import bucket_of
from tidemill.streaming.state import _salted


class LateWindow(StatefulProcessor):
    """One key's window: fires at its end, again for each late row, and is cleared in the end.

    A row is late once the watermark has reached the window's end. Until ``lateness`` after it the
    window takes the row and fires again with what it then holds; afterwards the row goes to the
    side, marked ``late``, and changes nothing.
    """

    def __init__(self, size_ms: int, lateness_ms: int):
        self.size_ms, self.lateness_ms = size_ms, lateness_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "n long, total long, firings int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        end = key[1] + self.size_ms
        mark = timerValues.getCurrentWatermarkInMs()
        amounts = [int(a) for pdf in rows for a in pdf.amount]
        if mark >= end + self.lateness_ms:
            yield self._rows(key, "late", [(0, len(amounts), sum(amounts))])
            return
        stored = self.held.get()
        n, total, firings = stored if stored is not None else (0, 0, 0)
        if stored is None:
            if mark < end:
                self.handle.registerTimer(end)
            self.handle.registerTimer(end + self.lateness_ms)
        out = []
        if mark < end:
            n, total = n + len(amounts), total + sum(amounts)
        else:
            if n and not firings:  # the end has passed, its timer comes after the rows
                firings = 1
                out.append((1, n, total))
            for amount in amounts:
                n, total, firings = n + 1, total + amount, firings + 1
                out.append((firings, n, total))
        self.held.update((n, total, firings))
        if out:
            yield self._rows(key, "fired", out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = key[1] + self.size_ms
        stored = self.held.get()
        if stored is not None and not stored[2]:
            self.held.update((stored[0], stored[1], 1))
            yield self._rows(key, "fired", [(1, stored[0], stored[1])])
        if expiredTimerInfo.getExpiryTimeInMs() >= end + self.lateness_ms:
            self.held.clear()

    @staticmethod
    def _rows(key, kind: str, found: list[tuple]) -> pd.DataFrame:
        firing, n, total = zip(*found)
        return pd.DataFrame({"key": key[0], "window_ms": key[1], "kind": kind, "firing": firing,
                             "n": n, "total": total})

    def close(self) -> None:
        pass


def late_windows(rows: DataFrame, key: str, ts: str, amount: str, size_ms: int, lateness_ms: int,
                 delay: str = "0 seconds") -> DataFrame:
    """``key, window_ms, kind, firing, n, total`` of tumbling windows with allowed lateness.

    ``kind`` is ``fired`` (``firing`` 1 at the window's end, then 2, 3 ... for late rows) or
    ``late`` (``n`` rows came too late). State is one row per key and window, spread by both, and is
    cleared when the watermark is ``lateness_ms`` past the window's end.
    """
    at = F.unix_millis(ts)
    plain = rows.withWatermark(ts, delay).select(
        F.col(key).cast("string").alias("key"), (at - F.pmod(at, F.lit(size_ms))).alias("window_ms"),
        F.col(amount).cast("long").alias("amount"))
    return plain.groupBy("key", "window_ms").transformWithStateInPandas(
        LateWindow(size_ms, lateness_ms),
        "key string, window_ms long, kind string, firing int, n long, total long",
        "append", "EventTime")


def _whole(ids: pd.Series) -> list[int | None]:
    """Ids, which travel as text so that nulls do not make floats of them."""
    return [None if i is None else int(i) for i in ids]


def _place(at_and_id: tuple) -> tuple:
    at, id_ = at_and_id
    return at, id_ is not None, id_ or 0


class VersionedJoin(StatefulProcessor):
    """Left rows wait until the watermark has passed them, then meet the version valid at their time.

    Versions may come in any order. Once the watermark stands at m, every left row up to m has been
    answered, so of the versions up to m only the newest is still needed; the others go. Left rows
    behind the watermark are late and dropped. One timer stands at the earliest waiting row or the
    next version, so that versions go although no left row comes. A state holds one key, or the keys
    of a bucket, in lists that are read and written as a whole.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.versions = handle.getListState(
            "versions", "own string, at long, seq long, value string")
        self.waiting = handle.getListState("waiting", "own string, at long, id long")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark, wanted = timerValues.getCurrentWatermarkInMs() * 1000, None
        for pdf in rows:
            is_version = pdf.side == "version"
            new, left = pdf[is_version], pdf[~is_version & (pdf["at"] >= mark)]
            if len(new):
                self.versions.appendList(list(zip(
                    new.own.tolist(), new["at"].tolist(), _whole(new.id), new.value.tolist())))
            if len(left):
                self.waiting.appendList(list(zip(
                    left.own.tolist(), left["at"].tolist(), _whole(left.id))))
            times = [*left["at"], *new["at"][new["at"] >= mark], *([] if wanted is None else [wanted])]
            wanted = min(times, default=None)
        if wanted is not None:
            held, wanted = self.timer.get(), int(wanted) // 1000 + 1
            if held is None or wanted < held[0]:
                if held is not None:
                    self.handle.deleteTimer(held[0])
                self._set_timer(wanted)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs() * 1000
        by_key: dict = {}
        for own, at, seq, value in self.versions.get():
            by_key.setdefault(own, ({}, set()))[0][(at, seq)] = value
        for own, at, id_ in self.waiting.get():
            by_key.setdefault(own, ({}, set()))[1].add((at, id_))
        out, versions, waiting = [], [], []
        for own, (held, asked) in by_key.items():
            order, which = sorted(held, key=_place), -1
            for at, id_ in sorted(asked, key=_place):
                if at >= mark:
                    waiting.append((own, at, id_))
                    continue
                while which + 1 < len(order) and order[which + 1][0] <= at:
                    which += 1
                out.append((own, id_, *((order[which][1], held[order[which]]) if which >= 0
                                        else (None, None))))
            passed = sum(k[0] < mark for k in order)
            versions += [(own, *k, held[k]) for k in order[max(passed - 1, 0):]]
        for state, kept in ((self.versions, versions), (self.waiting, waiting)):
            state.put(kept) if kept else state.clear()
        times = [at for _, at, _ in waiting] + [v[1] for v in versions if v[1] >= mark]
        self._set_timer(min(times) // 1000 + 1 if times else None)
        if out:
            owns, ids, seqs, values = zip(*out)
            yield pd.DataFrame({"key": pd.array(owns, "string"), "id": pd.array(ids, "Int64"),
                                "version": pd.array(seqs, "Int64"),
                                "value": pd.array(values, "string")})

    def _set_timer(self, wanted: int | None) -> None:
        """At the first millisecond by which a waiting row is passed or a version takes over."""
        if wanted is None:
            self.timer.clear()
        else:
            self.timer.update((wanted,))
            self.handle.registerTimer(wanted)

    def close(self) -> None:
        pass


def stream_asof_join(left: DataFrame, versions: DataFrame, key: str, ts: str, left_id: str,
                     version_id: str, value: Column, delay: str = "0 seconds",
                     salts: int = 4, buckets: int | None = None) -> DataFrame:
    """``key, id, version, value``: each left row with the version valid at its time, or nulls.

    Two streams with event time ``ts`` (microseconds count); a row goes out once the slower
    input's watermark has passed it. Of versions of one time the largest ``version_id`` is valid.
    Left rows of a hot key are spread over ``salts``; versions go to all of them. With many small
    keys name a number of ``buckets``: each state then holds the keys of one. Rows without a time
    are left out.
    """
    own = F.col(key).cast("string")
    group = own if buckets is None else bucket_of(key, buckets=buckets).cast("string")

    def side(df: DataFrame, name: str, id_: str, value: Column) -> DataFrame:
        return df.withWatermark(ts, delay).where(F.col(ts).isNotNull()).select(
            group.alias("key"), own.alias("own"), F.lit(name).alias("side"),
            F.unix_micros(ts).alias("at"), F.col(id_).cast("long").cast("string").alias("id"),
            value.cast("string").alias("value"))

    wide, narrow = _salted(side(left, "left", left_id, F.lit(None)),
                           side(versions, "version", version_id, value), "id", salts)
    return wide.unionByName(narrow).groupBy("key", "salt").transformWithStateInPandas(
        VersionedJoin(), "key string, id long, version long, value string", "append", "EventTime")
