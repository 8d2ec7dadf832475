"""Ordered (window-like) operators that never put a hot key in one task.

A plain ``Window.partitionBy(key).orderBy(ts)`` sorts all rows of a key in one
task. That is the best plan while a key is small, and the end of the job when
one key holds a third of the rows. So each operator splits its input:

* keys of at most ``hot_rows`` rows take the plain window;
* larger keys are cut into *chunks* along the order. The window runs inside
  ``(key, chunk)`` and a one-row summary per chunk is carried forward, so only
  the summaries of a key ever meet in one task.

Keys are counted once, when the plan is built and from the key columns alone;
if none is hot, the plan is the plain window over one scan. The chunks of hot
keys are range partitions of ``keys + order``, cut by measured size however
dense the rows of an hour are, and checkpointed so that both uses see the same
cut. ``chunk``, a list of columns monotone in ``order``, gives the chunks of
windows without keys instead. ``order`` has to be unique within a key for
repeatable results, and plain doubles may round differently on the two ways:
sum decimals.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import checkpointed

HOT_ROWS = 5_000_000
_CHUNK = "__chunk"


def _same(pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs])


def _renamed(df: DataFrame, on: list[str]) -> DataFrame:
    return df.select(
        *[F.col(c).alias(f"__r_{c}") for c in on], *[F.col(c) for c in df.columns if c not in on]
    )


def join_back(df: DataFrame, side: DataFrame, on: list[str]) -> DataFrame:
    """Left-join columns of ``side``, unique on ``on``, treating null keys as equal."""
    return df.join(_renamed(side, on), _same([(c, f"__r_{c}") for c in on]), "left").drop(
        *[f"__r_{c}" for c in on]
    )


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int) -> DataFrame | None:
    """Keys with more than ``hot_rows`` rows, stored in the shared folder; None without any.

    At most ``rows / hot_rows`` keys can be hot, which bounds the list (200,000 keys for a
    trillion rows).
    """
    counts = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = checkpointed(counts.filter(F.col("__n") > hot_rows).select(*keys))
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, keys: list[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(cold, hot)`` rows; the list is broadcast and every row is flagged once."""
    listed = F.broadcast(_renamed(hot, keys).withColumn("__hot", F.lit(True)))
    flagged = df.join(listed, _same([(c, f"__r_{c}") for c in keys]), "left").drop(
        *[f"__r_{c}" for c in keys])
    is_hot = F.col("__hot").isNotNull()
    return flagged.filter(~is_hot).drop("__hot"), flagged.filter(is_hot).drop("__hot")


def _chunked(df: DataFrame, keys: list[str], order: list[Column],
             chunk: list[Column] | None) -> DataFrame:
    if chunk is not None:
        return df.withColumn(
            _CHUNK, F.struct(*[c.alias(f"c{i}") for i, c in enumerate(chunk)])
        )
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    return checkpointed(ranged.withColumn(_CHUNK, F.spark_partition_id()))


def _by_size(df, keys, order, chunk, hot_rows, plain, chunked) -> DataFrame:
    """Plain window for small keys, chunks for large ones or for no keys at all."""
    if not keys:
        return chunked(_chunked(df, keys, order, chunk)).drop(_CHUNK)
    listed = hot_keys(df, keys, hot_rows)
    if listed is None:
        return plain(df)
    cold, hot = split_hot(df, keys, listed)
    return plain(cold).unionByName(chunked(_chunked(hot, keys, order, None)).drop(_CHUNK))


def _preceding(keys: list[str], descending: bool = False):
    order = F.col(_CHUNK).desc() if descending else F.col(_CHUNK).asc()
    return (
        Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )


def row_numbers(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    chunk: list[Column] | None = None,
    name: str = "row_num",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``row_number() over (partition by keys order by order)``."""

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumn(name, F.row_number().over(w).cast("bigint"))

    return _by_size(df, keys, order, chunk, hot_rows, plain,
                    lambda rows: _numbered(rows, keys, order, name))


def _numbered(rows: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Row numbers within ``keys`` of rows cut into chunks."""
    on = [*keys, _CHUNK]
    before = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).withColumn(
        "__before", F.coalesce(F.sum("__n").over(_preceding(keys)), F.lit(0))
    ).drop("__n")
    w = Window.partitionBy(*on).orderBy(*order)
    local = rows.withColumn("__rn", F.row_number().over(w))
    return join_back(local, before, on).withColumn(
        name, (F.col("__rn") + F.col("__before")).cast("bigint")
    ).drop("__rn", "__before")


def _merge(kind: str, before: Column, here: Column) -> Column:
    """Running value of a row from the carry of earlier chunks and its own chunk."""
    if kind == "sum":
        return F.when(before.isNull(), here).when(here.isNull(), before).otherwise(before + here)
    if kind == "count":
        return F.coalesce(before, F.lit(0)) + here
    if kind == "last_value":
        return F.coalesce(here, before)
    return F.least(before, here) if kind == "min" else F.greatest(before, here)


_PLAIN = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def running(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    chunk: list[Column] | None,
    aggs: dict[str, tuple[str, Column]],
    reverse: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Running aggregates over ROWS unbounded preceding .. current row.

    ``aggs`` maps the output name to ``(kind, column)`` with kind one of ``sum``,
    ``count``, ``min``, ``max``, ``last_value`` (latest non-null, for which
    ``order`` must be plain ascending columns). With ``reverse`` the frame is
    current row .. unbounded following for sum, count, min and max.
    """
    unknown = {k for k, _ in aggs.values()} - {*_PLAIN, "last_value"}
    if unknown:
        raise ValueError(f"unknown running aggregates {sorted(unknown)}")

    def framed_rows(rows: DataFrame, by: list[str]):
        """Rows and their frame. Spark sums a frame that ends with its group anew for every row,
        which is quadratic; from the last row backwards the same frame is a running one."""
        w = Window.partitionBy(*by).orderBy(*order)
        if reverse:
            rows = rows.withColumn("__place", F.row_number().over(w))
            w = Window.partitionBy(*by).orderBy(F.col("__place").desc())
        return rows, w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def local(kind: str, col: Column, w) -> Column:
        return _PLAIN[kind](col).over(w) if kind in _PLAIN else F.last(col, True).over(w)

    def plain(rows: DataFrame) -> DataFrame:
        rows, w = framed_rows(rows, keys)
        return rows.withColumns({n: local(k, c, w) for n, (k, c) in aggs.items()}).drop("__place")

    def chunked(rows: DataFrame) -> DataFrame:
        on = [*keys, _CHUNK]
        over = _preceding(keys, descending=reverse)
        totals, carries, merged = [], [], {}
        for name, (kind, col) in aggs.items():
            total, carry, here = f"__t_{name}", f"__c_{name}", F.col(f"__l_{name}")
            if kind in _PLAIN:
                totals.append(_PLAIN[kind](col).alias(total))
                merge = F.sum if kind == "count" else _PLAIN[kind]
                carries.append(merge(total).over(over).alias(carry))
            else:
                seq = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
                some = col.isNotNull()
                totals.append(F.max_by(F.when(some, F.struct(col.alias("v"))),
                                       F.when(some, seq)).alias(total))
                carries.append(F.last(total, True).over(over)["v"].alias(carry))
            merged[name] = _merge(kind, F.col(carry), here)
        carry = rows.groupBy(*on).agg(*totals).select(*on, *carries)
        rows, w = framed_rows(rows, on)
        inside = rows.withColumns({f"__l_{n}": local(k, c, w) for n, (k, c) in aggs.items()})
        out = join_back(inside, carry, on).withColumns(merged)
        return out.drop("__place", *[f"__{p}_{n}" for n in aggs for p in ("c", "l")])

    return _by_size(df, keys, order, chunk, hot_rows, plain, chunked)


def framed(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    chunk: list[Column] | None,
    before: int,
    after: int,
    columns,
    block_rows: int = 1 << 20,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Functions over ROWS ``before`` preceding .. ``after`` following, and lead/lag.

    Rows of a large key get their number within the key, are cut into blocks of
    ``block_rows``, and the edge rows a neighbouring block needs are copied to
    it, so that each block is complete on its own. ``columns(ordered, frame)``
    returns the new columns by name; ``ordered`` serves lead/lag, ``frame`` the
    aggregates.
    """
    if max(before, after) >= block_rows:
        raise ValueError("frame is wider than a block")

    def plain(rows: DataFrame) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(*order)
        return rows.withColumns(columns(w, w.rowsBetween(-before, after)))

    def blocks(rows: DataFrame) -> DataFrame:
        cut = _chunked(rows, keys, order, None if keys else chunk)
        ranked = _numbered(cut, keys, order, "__pos").drop(_CHUNK).withColumn(
            "__pos", F.col("__pos") - 1
        )
        home = F.floor(F.col("__pos") / block_rows)
        offset = F.col("__pos") % block_rows
        copies = [F.struct(home.alias("b"), F.lit(False).alias("halo"))]
        if before:
            copies.append(F.when(
                offset >= block_rows - before,
                F.struct((home + 1).alias("b"), F.lit(True).alias("halo"))))
        if after:
            copies.append(F.when(
                (offset < after) & (home > 0),
                F.struct((home - 1).alias("b"), F.lit(True).alias("halo"))))
        spread = ranked.withColumn(
            "__copy", F.explode(F.array_compact(F.array(*copies)))
        ).withColumn("__block", F.col("__copy.b"))
        ordered = Window.partitionBy(*keys, "__block").orderBy("__pos")
        out = spread.withColumns(columns(ordered, ordered.rowsBetween(-before, after)))
        return out.filter(~F.col("__copy.halo")).drop("__copy", "__block", "__pos")

    if not keys:
        return blocks(df)
    listed = hot_keys(df, keys, hot_rows)
    if listed is None:
        return plain(df)
    cold, hot = split_hot(df, keys, listed)
    return plain(cold).unionByName(blocks(hot))


def ranks(
    df: DataFrame,
    keys: list[str],
    value: str,
    chunk: list[Column] | None = None,
    rank: str = "rnk",
    dense: str = "dense_rnk",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """``rank`` and ``dense_rank`` of ``value`` within ``keys``.

    Works on the distinct values, so a value shared by very many rows counts
    once; ``chunk`` must be monotone in ``value``.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    placed = running(
        counts, keys, [F.col(value)], chunk,
        {rank: ("sum", F.col("__n")), dense: ("count", F.lit(1))}, hot_rows=hot_rows,
    ).withColumn(rank, F.col(rank) - F.col("__n") + 1).drop("__n")
    return join_back(df, placed, [*keys, value])


def with_group_stats(df: DataFrame, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates of the whole group on every row (``agg over (partition by keys)``).

    The aggregate is computed with map-side combine and joined back; adaptive
    execution broadcasts it when its measured size allows and splits hot keys
    of the sort-merge join otherwise.
    """
    return join_back(df, df.groupBy(*keys).agg(*aggs), keys)
