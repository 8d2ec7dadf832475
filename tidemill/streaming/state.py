"""Keyed state processors; rows come and go as Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tidemill.streaming.packed import BUCKETS, Packed, bucket_of, flagged, known, longs

#: Ids in one numbered part of an emitted list.
PART_IDS = 1000
#: Ids of a key that stay in state.
LAST_IDS = 10


def _salted(wide: DataFrame, narrow: DataFrame, by, salts: int) -> tuple[DataFrame, DataFrame]:
    """``narrow`` rows copied to every salt, ``wide`` rows to the salt of column ``by``.

    The rows of a hot key on the wide side are shared by ``salts`` state partitions.
    """
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return (wide.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int")),
            narrow.withColumn("salt", copies))


_ITEM = ["item", "no_item"]
_PRICES = pa.schema([("item", pa.int64()), ("no_item", pa.bool_()), ("price", pa.float64())])
_DEALS = pa.schema([("item", pa.int64()), ("no_item", pa.bool_()), ("seq", pa.int64()),
                    ("no_seq", pa.bool_()), ("qty", pa.float64())])


class PricedDeals(StatefulProcessor):
    """Deals wait until the price of their item is known; a price releases them.

    A key is a bucket of items. Within a part of a micro-batch, prices take effect before the deals
    that come with them.
    """

    def init(self, handle) -> None:
        self.prices = Packed(handle, "prices", _PRICES)
        self.waiting = Packed(handle, "waiting", _DEALS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        prices, changed = self.prices.read(), False
        for pdf in rows:
            fresh = pdf[pdf.kind == "price"]
            if len(fresh):
                fresh = fresh.sort_values(["no_seq", "seq"]).drop_duplicates(_ITEM, keep="last")
                fresh = fresh[[*_ITEM, "price"]]
                prices = fresh if prices.empty else pd.concat([prices, fresh]).drop_duplicates(
                    _ITEM, keep="last")
                changed = True
                yield from self._release(fresh)
            deals = pdf.loc[pdf.kind == "deal", _DEALS.names]
            if len(deals):
                has = known(deals, prices, _ITEM)
                self.waiting.add(deals[~has])
                if has.any():
                    yield self._priced(deals[has], prices)
        if changed:
            self.prices.put(prices)

    def _release(self, fresh: pd.DataFrame) -> Iterator[pd.DataFrame]:
        left, some = [], False
        for held in self.waiting.each():
            has = known(held, fresh, _ITEM)
            left.append(held[~has])
            if has.any():
                some = True
                yield self._priced(held[has], fresh)
        if some:
            self.waiting.put(pd.concat(left, ignore_index=True))

    @staticmethod
    def _priced(deals: pd.DataFrame, prices: pd.DataFrame) -> pd.DataFrame:
        out = deals.merge(prices, on=_ITEM)
        return pd.DataFrame({"item": longs(out["item"], out.no_item),
                             "deal_id": longs(out.seq, out.no_seq), "qty": out.qty,
                             "price": out.price})

    def close(self) -> None:
        pass


def priced_deals(prices: DataFrame, deals: DataFrame, salts: int = 4,
                 buckets: int = BUCKETS) -> DataFrame:
    """``prices(item, seq, price)`` with ``deals(item, seq, qty)``; the price goes to all salts."""
    p = prices.select("item", "seq", F.lit("price").alias("kind"),
                      F.col("price").cast("double"), F.lit(None).cast("double").alias("qty"))
    d = deals.select("item", "seq", F.lit("deal").alias("kind"),
                     F.lit(None).cast("double").alias("price"), F.col("qty").cast("double"))
    d, p = _salted(d, p, "seq", salts)
    rows = p.unionByName(d).select(
        bucket_of("item", "salt", buckets=buckets).alias("bucket"), *flagged("item"),
        *flagged("seq"), "kind", "price", "qty")
    return rows.groupBy("bucket").transformWithStateInPandas(
        PricedDeals(), "item long, deal_id long, qty double, price double", "append", "none")


_CODE = ["code", "no_code"]
_PACKAGE = [*_CODE, "package", "no_package"]
_CODES = pa.schema([("code", pa.int64()), ("no_code", pa.bool_())])
_HEADERS = pa.schema([*_CODES, ("info", pa.string())])
_PACKAGES = pa.schema([*_CODES, ("package", pa.int64()), ("no_package", pa.bool_())])


class HeaderPackages(StatefulProcessor):
    """Packages before their header wait; a header without packages goes out alone.

    Keys are buckets of (code, salt). Each salt joins its share of the packages. Buckets marked
    ``alone`` get the headers and a sign of the first packages, and let a header out if there was no
    sign yet.
    """

    def init(self, handle) -> None:
        self.headers = Packed(handle, "headers", _HEADERS)
        self.packages = Packed(handle, "packages", _PACKAGES, unique=_PACKAGE)
        self.seen = Packed(handle, "seen", _CODES)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[1]:
            yield from self._alone(rows)
            return
        headers = self.headers.read()
        for pdf in rows:
            fresh = pdf.loc[pdf.kind == "header", _HEADERS.names].drop_duplicates(_CODE)
            if len(fresh):
                fresh = fresh[~known(fresh, headers, _CODE)]
            if len(fresh):
                self.headers.add(fresh)
                headers = fresh if headers.empty else pd.concat([headers, fresh])
                held = self.packages.read()
                has = known(held, fresh, _CODE)
                if has.any():
                    self.packages.put(held[~has])
            packages = pdf.loc[pdf.kind == "package", _PACKAGE].drop_duplicates()
            has = known(packages, headers, _CODE)
            self.packages.add(packages[~has])
            ready = packages[has]
            if len(fresh):
                ready = pd.concat([held[known(held, fresh, _CODE)], ready]).drop_duplicates()
            if len(ready):
                yield self._rows(ready.merge(headers, on=_CODE))

    def _alone(self, rows) -> Iterator[pd.DataFrame]:
        infos, signs = [], []
        for pdf in rows:  # a sign may come in a later part of the batch than the header
            infos.append(pdf.loc[pdf.kind == "header", _HEADERS.names].drop_duplicates(_CODE))
            signs.append(pdf.loc[pdf.kind == "sign", _CODE].drop_duplicates())
        infos = pd.concat(infos).drop_duplicates(_CODE)
        signs = pd.concat(signs).drop_duplicates()
        seen = self.seen.read()
        signs = signs[~known(signs, seen, _CODE)]
        self.seen.add(signs)
        if not len(infos):
            return
        fresh = infos[~known(infos, self.headers.read(), _CODE)]
        self.headers.add(fresh)
        lone = fresh[~known(fresh, pd.concat([seen, signs]), _CODE)]
        if len(lone):
            yield self._rows(lone.assign(package=0, no_package=True))

    @staticmethod
    def _rows(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"code": longs(rows.code, rows.no_code),
                             "package": longs(rows.package, rows.no_package),
                             "info": rows["info"].array})

    def close(self) -> None:
        pass


def header_packages(headers: DataFrame, packages: DataFrame, salts: int = 4,
                    buckets: int = BUCKETS) -> DataFrame:
    """``headers(code, seq, info)`` and ``packages(code, seq, package)`` joined in state.

    The packages of a code are shared by ``salts`` states, the header goes to all of them. The
    packages are read twice: once as they are, once for one sign per code and salt.
    """
    h = headers.select("code", F.lit("header").alias("kind"),
                       F.lit(None).cast("bigint").alias("package"), "info")
    p = packages.select("code", F.lit("package").alias("kind"),
                        F.col("package").cast("bigint"), F.lit(None).cast("string").alias("info"))
    p, h = _salted(p, h, "package", salts)
    signs = p.select("code", "salt", F.lit("sign").alias("kind")).dropDuplicates(["code", "salt"])
    signs = signs.select("code", "kind", F.lit(None).cast("bigint").alias("package"),
                         F.lit(None).cast("string").alias("info"))
    first = h.filter("salt = 0").select("code", "kind", "package", "info")

    def placed(rows: DataFrame, alone: bool, *keys: str) -> DataFrame:
        return rows.select(bucket_of(*keys, buckets=buckets).alias("bucket"),
                           F.lit(alone).alias("alone"), "kind", *flagged("code"),
                           *flagged("package"), "info")

    rows = placed(p.unionByName(h), False, "code", "salt").unionByName(
        placed(signs.unionByName(first), True, "code"))
    return rows.groupBy("bucket", "alone").transformWithStateInPandas(
        HeaderPackages(), "code long, package long, info string", "append", "none")


_KEY = ["key", "no_key", "salt"]
_COUNTS = pa.schema([("key", pa.int64()), ("no_key", pa.bool_()), ("salt", pa.int32()),
                     ("n", pa.int64()), ("until", pa.int64())])
_LAST = pa.schema([*list(_COUNTS)[:3], ("id", pa.int64()), ("no_id", pa.bool_()),
                   ("until", pa.int64())])
_KINDS = pa.schema([*list(_COUNTS)[:3], ("kind", pa.string()), ("n", pa.int64()),
                    ("until", pa.int64())])


class KeyedTotals(StatefulProcessor):
    """Row count, last ids and count per kind of each key, or of its salts, in a bucket of them.

    The list of all ids lies in what goes out, not in state: its new stretch goes out in numbered
    parts, so that neither state nor an output row grows with the rows of a key. With a TTL every
    row of state has its own end; Spark's TTL takes what is left of buckets that nothing reaches.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle) -> None:
        self.counts = Packed(handle, "counts", _COUNTS, ttl_ms=self.ttl_ms)
        self.last = Packed(handle, "last", _LAST, ttl_ms=self.ttl_ms)
        self.kinds = Packed(handle, "kinds", _KINDS, ttl_ms=self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = until = 0
        if self.ttl_ms is not None:
            now = timerValues.getCurrentProcessingTimeInMs()
            until = now + self.ttl_ms
        counts, last, kinds = (
            s if self.ttl_ms is None else s[s.until > now]
            for s in (self.counts.read(), self.last.read(), self.kinds.read()))
        for pdf in rows:
            at = pdf.groupby(_KEY, sort=False).ngroup()
            firsts = pdf.loc[~at.duplicated().to_numpy(), _KEY]
            before = firsts.merge(counts, on=_KEY, how="left").n.fillna(0).astype("int64")
            added = np.bincount(at, minlength=len(firsts))
            new = firsts.assign(n=before.to_numpy() + added, until=until)
            counts = pd.concat([counts, new]).drop_duplicates(_KEY, keep="last")
            last = pd.concat([last, pdf[[*_KEY, "id", "no_id"]].assign(until=until)])
            last = last[last.groupby(_KEY, sort=False).cumcount(ascending=False) < LAST_IDS]
            # a list lives as a whole from its last addition on
            last.loc[known(last, firsts, _KEY), "until"] = until
            more = pdf[pdf.kind.notna()].groupby([*_KEY, "kind"], sort=False).size()
            kinds = pd.concat([kinds, more.reset_index(name="n").assign(until=until)])
            kinds = kinds.groupby([*_KEY, "kind"], sort=False, as_index=False).agg(
                {"n": "sum", "until": "max"})
            yield self._parts(pdf, at, firsts.reset_index(drop=True), before, new, last, kinds)
        self.counts.put(counts)
        self.last.put(last)
        self.kinds.put(kinds)

    @staticmethod
    def _parts(pdf, at, firsts, before, new, last, kinds) -> pd.DataFrame:
        """The ids of a part of a batch as numbered lists, with what their keys hold by now."""

        def lists(held: pd.DataFrame, *columns: str) -> list[list]:
            """The values of the held rows of each key, by its place in ``firsts``."""
            own = held.merge(firsts.assign(at=range(len(firsts))), on=_KEY)
            by = own["at"].to_numpy().argsort(kind="stable")
            ends = np.cumsum(np.bincount(own["at"], minlength=len(firsts)))[:-1]
            out = []
            for c in columns:
                values = own[c].to_numpy(dtype=object)[by]
                if f"no_{c}" in own:
                    values[own[f"no_{c}"].to_numpy()[by]] = None
                out.append([v.tolist() for v in np.split(values, ends)])
            return out

        (ids,) = lists(pdf[[*_KEY, "id", "no_id"]], "id")
        (kept,) = lists(last, "id")
        names, sums = lists(kinds.sort_values("kind"), "kind", "n")
        out = []
        for i, (key, none, salt) in enumerate(firsts.itertuples(index=False)):
            text = ",".join(f"{k}={v}" for k, v in zip(names[i], sums[i]))
            for a in range(0, len(ids[i]), PART_IDS):
                out.append((None if none else key, salt, before[i] + a, ids[i][a:a + PART_IDS],
                            new.n.iat[i], text, names[i], sums[i], kept[i]))
        parts = pd.DataFrame(out, columns=["key", "salt", "first", "ids", "n", "kinds", "names",
                                           "counts", "last"])
        return parts.assign(key=pd.array([p[0] for p in out], "Int64"))

    def close(self) -> None:
        pass


def keyed_totals(rows: DataFrame, ttl_ms: int | None = None, salts: int = 1,
                 buckets: int = BUCKETS) -> DataFrame:
    """``rows(key, id, kind)`` summarised per key; state older than the TTL is forgotten.

    With more ``salts`` the rows of a key are shared by that many states, by id;
    :func:`merged_totals` puts the results together.

    A TTL is processing time, for which Spark plans batches without data for
    ever; an available-now run therefore has to switch no-data batches off.
    """
    mode = "none" if ttl_ms is None else "processingTime"
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt")
    rows = rows.select("key", "id", "kind", salt).select(
        bucket_of("key", "salt", buckets=buckets).alias("bucket"), "salt", *flagged("key"),
        *flagged("id"), "kind")
    return rows.groupBy("bucket").transformWithStateInPandas(
        KeyedTotals(ttl_ms), "key long, salt int, first long, ids array<long>, n long, "
        "kinds string, names array<string>, counts array<long>, last array<long>", "update", mode)


def merged_totals(parts: DataFrame) -> DataFrame:
    """``key, n, listed, id_total, kinds`` of all that :func:`keyed_totals` gave out.

    ``listed`` and ``id_total``: number and sum of the ids in the numbered parts.
    """
    salted = parts.groupBy("key", "salt").agg(
        F.max("n").alias("n"), F.sum(F.size("ids")).alias("listed"),
        F.sum(F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("id_total"),
        F.max_by(F.arrays_zip("names", "counts"), "n").alias("pairs"))
    sums = salted.groupBy("key").agg(*[F.sum(c).alias(c) for c in ("n", "listed", "id_total")])
    kinds = salted.select("key", F.inline("pairs")).groupBy("key", "names").agg(
        F.sum("counts").alias("k")).groupBy("key").agg(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("names", "k"))),
            lambda p: F.concat_ws("=", p["names"], p["k"].cast("string"))), ",").alias("kinds"))
    return sums.join(kinds, "key", "left")


#: Settings of a stream that joins in state, with RocksDB: both sides in one store on disk instead of
#: four in memory, of which a batch stores the changes and no row is looked up to be counted.
ONE_STORE = {
    "spark__sql__streaming__stateStore__rocksdb__trackTotalNumberOfRows": "false",
    "spark__sql__streaming__join__stateFormatVersion": "3",
    "spark__sql__streaming__stateStore__rocksdb__changelogCheckpointing__enabled": "true",
}


def timed_join(left: DataFrame, right: DataFrame, key: str, ttl: str, spread: str,
               how: str = "inner", salts: int = 4) -> DataFrame:
    """Join of two streams on ``key`` without a bound in event time.

    The TTL (interval text, in processing time) is required: a row meets partners that come within
    ``ttl`` of it and leaves the state afterwards, so state is bounded by what arrives in that time.
    Arrival is the time of the micro-batch. Left rows of a hot key are spread over ``salts`` by the
    column ``spread``; right rows go to all of them. With ``how="left"`` a row without partner goes out when its time is over.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    wide, narrow = _salted(
        left.withColumn("__l_at", F.current_timestamp()),
        right.withColumnRenamed(key, "__r_key").withColumn("__r_at", F.current_timestamp()),
        spread, salts)
    span = F.expr(f"INTERVAL {ttl}")
    wide = wide.withColumnRenamed("salt", "__l_salt").withWatermark("__l_at", "0 seconds")
    narrow = narrow.withColumnRenamed("salt", "__r_salt").withWatermark("__r_at", "0 seconds")
    return wide.join(
        narrow, (F.col(key) == F.col("__r_key")) & (F.col("__l_salt") == F.col("__r_salt"))
        & (F.col("__r_at") >= F.col("__l_at") - span) & (F.col("__r_at") <= F.col("__l_at") + span),
        how).drop("__l_at", "__r_at", "__l_salt", "__r_salt", "__r_key")
