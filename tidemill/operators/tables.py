"""Keyed table models and change data as pure ``DataFrame -> DataFrame`` steps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.refresh import overwrite_partitions, partition_columns

UPSERTS = ("+I", "+U")
IGNORED = ("-U",)


def _same(keys: list[str], left: str, right: str) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    )


def latest_per_key(df: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``seq`` (later columns break ties)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(*seq)).alias("__row")
    ).select(*keys, "__row.*").select(*df.columns)


def apply_ops(current: DataFrame, changes: DataFrame, keys: list[str], op: str,
              seq: list[str]) -> DataFrame:
    """Current rows after the change rows; the last op of a key decides.

    Ops are ``+I -U +U -D``; ``-U`` carries old values and is skipped. Deleting
    a missing key does nothing. ``current`` has one row per key.
    """
    needed = list(dict.fromkeys([*current.columns, op, *seq]))
    live = changes.filter(~F.col(op).isin(*IGNORED)).select(*needed)
    last = latest_per_key(live, keys, seq)
    touched = last.select(*keys)
    kept = current.alias("c").join(
        touched.alias("t"), _same(keys, "c", "t"), "left_anti"
    ).select(*current.columns)
    return kept.unionByName(last.filter(F.col(op).isin(*UPSERTS)).select(*current.columns))


def partial_update(changes: DataFrame, keys: list[str], seq: list[str],
                   columns: list[str]) -> DataFrame:
    """Per column the latest non-null value; a null never overwrites."""
    order = F.struct(*seq)
    return changes.groupBy(*keys).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns
    ])


def insert_columns(current: DataFrame, incoming: DataFrame, keys: list[str],
                   columns: list[str]) -> DataFrame:
    """Write only ``columns`` by key: other columns stay, and are null for new keys."""
    joined = current.alias("c").join(
        incoming.withColumn("__new", F.lit(True)).alias("n"), _same(keys, "c", "n"), "full"
    )
    new = F.col("n.__new").isNotNull()
    out = []
    for c in current.columns:
        if c in keys:
            out.append(F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"c.{c}")).alias(c))
        elif c in columns:
            out.append(F.when(new, F.col(f"n.{c}")).otherwise(F.col(f"c.{c}")).alias(c))
        else:
            out.append(F.col(f"c.{c}"))
    return joined.select(*out)


def aggregate_merge(parts: list[DataFrame], keys: list[str], spec: dict[str, str],
                    seq: str | None = None) -> DataFrame:
    """Merge loads of an aggregate-key table, oldest part first.

    ``spec`` maps value columns to ``sum``, ``min``, ``max`` or
    ``replace_if_not_null`` (latest part, then largest ``seq``, wins). Nulls
    never change a value; a column that is null everywhere stays null.
    """
    tagged = [
        p.select(*keys, *spec, F.lit(i).alias("__part"),
                 (F.col(seq) if seq else F.lit(0)).alias("__seq"))
        for i, p in enumerate(parts)
    ]
    rows = reduce(lambda a, b: a.unionByName(b), tagged)
    order = F.struct("__part", "__seq")
    kinds = {
        "sum": lambda c: F.sum(c),
        "min": lambda c: F.min(c),
        "max": lambda c: F.max(c),
        "replace_if_not_null": lambda c: F.max_by(
            F.col(c), F.when(F.col(c).isNotNull(), order)
        ),
    }
    return rows.groupBy(*keys).agg(*[kinds[k](c).alias(c) for c, k in spec.items()])


def as_of(changes: DataFrame, keys: list[str], op: str, commit: str, seq: list[str],
          at: Column, columns: list[str]) -> DataFrame:
    """Keys and ``columns`` of the table after all commits up to ``at``."""
    seen = changes.filter((F.col(commit) <= at) & ~F.col(op).isin(*IGNORED)).select(
        *dict.fromkeys([*keys, *columns, op, commit, *seq]))
    return latest_per_key(seen, keys, [commit, *seq]).filter(
        F.col(op).isin(*UPSERTS)).select(*keys, *columns)


def commit_at(commits: DataFrame, commit: str, ts: str, at: Column) -> Column:
    """Largest commit whose time is not after ``at``, as a scalar."""
    return commits.filter(F.col(ts) <= at).agg(F.max(commit)).scalar()


def between_commits(changes: DataFrame, commit: str, start: Column, end: Column | None = None,
                    include_start: bool = False) -> DataFrame:
    """Changes of ``(start, end]``, or ``[start, end]`` with ``include_start``."""
    low = F.col(commit) >= start if include_start else F.col(commit) > start
    rows = changes.filter(low)
    return rows if end is None else rows.filter(F.col(commit) <= end)


def changelog(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Op rows between two states with unique keys; equal rows give nothing."""
    rest = [c for c in old.columns if c not in keys]
    o = old.select(F.struct(*old.columns).alias("o"), *[F.col(k).alias(f"__ok_{k}") for k in keys])
    n = new.select(F.struct(*old.columns).alias("n"), *[F.col(k).alias(f"__nk_{k}") for k in keys])
    cond = reduce(
        lambda a, b: a & b, [F.col(f"__ok_{k}").eqNullSafe(F.col(f"__nk_{k}")) for k in keys]
    )
    equal = reduce(
        lambda a, b: a & b, [F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in rest], F.lit(True)
    )
    ops = (
        F.when(F.col("o").isNull(), F.array(_op("+I", "n")))
        .when(F.col("n").isNull(), F.array(_op("-D", "o")))
        .when(~equal, F.array(_op("-U", "o"), _op("+U", "n")))
    )
    return (
        o.join(n, cond, "full").select(F.explode(ops).alias("c")).select("c.op", "c.row.*")
    )


def _op(kind: str, side: str) -> Column:
    return F.struct(F.lit(kind).alias("op"), F.col(side).alias("row"))


def expired_commits(commits: DataFrame, commit: str, ts: str, keep_min: int, keep_max: int,
                    max_age: str, now: Column) -> DataFrame:
    """Commits to drop; ids are consecutive.

    Looking from ``latest-keep_max+1`` to ``latest-keep_min``, the first commit
    young enough and everything after it stays; when none is young enough only
    the newest ``keep_min`` stay.
    """
    latest = commits.agg(F.max(commit)).scalar()
    young = commits.filter(
        F.col(commit).between(latest - keep_max + 1, latest - keep_min)
        & (now - F.col(ts) <= F.expr(max_age))
    ).agg(F.min(commit)).scalar()
    return commits.filter(F.col(commit) < F.coalesce(young, latest - keep_min + 1))


def expired_partitions(partitions: DataFrame, day: str, now: Column, max_days: int | None = None,
                       live_number: int | None = None) -> DataFrame:
    """Partition days to drop: older than ``max_days`` and/or beyond the newest N.

    ``partitions`` holds one row per partition, so ranking it is cheap.
    """
    drop = F.lit(False)
    if max_days is not None:
        drop = drop | (F.datediff(now, F.to_date(day)) > max_days)
    rows = partitions
    if live_number is not None:
        from pyspark.sql import Window

        rows = rows.withColumn("__rn", F.row_number().over(Window.orderBy(F.desc(day))))
        drop = drop | (F.col("__rn") > live_number)
    return rows.filter(drop).select(*partitions.columns)


def route_ranges(df: DataFrame, value: Column, ranges: list[tuple], name: str) -> DataFrame:
    """Partition name by half-open ranges ``(name, low, high)``; null when outside all."""
    out = F.lit(None).cast("string")
    for label, low, high in reversed(ranges):
        out = F.when((value >= low) & (value < high), label).otherwise(out)
    return df.withColumn(name, out)


def route_list(df: DataFrame, value: Column, groups: dict[str, list], name: str) -> DataFrame:
    out = F.lit(None).cast("string")
    for label, members in groups.items():
        out = F.when(value.isin(*members), label).otherwise(out)
    return df.withColumn(name, out)


class LoadRejected(RuntimeError):
    """The share of bad rows is over the limit; nothing was loaded."""


def split_rejects(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``; an undecided test counts as bad."""
    flag = F.coalesce(bad, F.lit(True))
    return df.filter(~flag), df.filter(flag)


def load_gate(df: DataFrame, bad: Column, max_filter_ratio: float = 0.0) -> dict:
    """Row counts of a load in one pass; raises when too many rows are bad."""
    flag = F.coalesce(bad, F.lit(True))
    total, filtered = df.agg(F.count("*"), F.count_if(flag)).first()
    if total and filtered / total > max_filter_ratio:
        raise LoadRejected(f"{filtered} of {total} rows are bad, limit {max_filter_ratio}")
    return {"scan_rows": total, "filtered_rows": filtered, "sink_rows": total - filtered}


def _rewrite(spark: SparkSession, table: str, cond: Column, change) -> None:
    """Rewrite the partitions that hold rows under ``cond`` by ``change(rows)``."""
    parts = partition_columns(spark, table)
    rows = spark.table(table)
    touched = [r.asDict() for r in rows.filter(cond).select(*parts).distinct().collect()]
    if not touched:
        return
    here = reduce(lambda a, b: a | b, [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in t.items()])
        for t in touched])
    overwrite_partitions(change(rows.filter(here)).select(*rows.columns), table, touched)


def delete_where(spark: SparkSession, table: str, cond: Column) -> None:
    """``DELETE FROM table WHERE cond``; rows for which ``cond`` is null stay."""
    _rewrite(spark, table, cond, lambda rows: rows.filter(~F.coalesce(cond, F.lit(False))))


def update_where(spark: SparkSession, table: str, cond: Column, sets: dict[str, Column]) -> None:
    """``UPDATE table SET ... WHERE cond``; partition columns cannot be set."""
    _rewrite(spark, table, cond, lambda rows: rows.withColumns(
        {c: F.when(cond, v).otherwise(F.col(c)) for c, v in sets.items()}))
