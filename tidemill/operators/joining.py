"""Time-aware and lookup joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.ordered import running


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[tuple[str, str]],
    left_ts: str,
    right_ts: str,
    lower_s: int,
    upper_s: int,
    how: str = "inner",
) -> DataFrame:
    """Pairs with equal keys and ``right_ts`` in ``[left_ts+lower, left_ts+upper]``.

    Both sides are also matched on a time bucket as wide as the interval: a left
    row has one bucket, a right row is copied to the (at most two) buckets its
    partners can be in. A hot key is so spread over its time range instead of
    meeting in one task, and no left row can match the same right row twice, so
    ``left`` outer joins stay exact. ``right`` and ``full`` would repeat an unmatched right row
    in each of its buckets and are refused. Works on streams with watermarks too.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"inner or left, not {how}")
    width = max(upper_s - lower_s, 1) * 1_000_000
    lts, rts = F.col(left_ts), F.col(right_ts)
    left_b = left.withColumn("__lb", F.floor(_micros(lts) / width))
    first = F.floor((_micros(rts) - upper_s * 1_000_000) / width)
    last = F.floor((_micros(rts) - lower_s * 1_000_000) / width)
    right_b = right.withColumn("__rb", F.explode(F.sequence(first, last)))
    cond = reduce(lambda a, b: a & b, [F.col(a) == F.col(b) for a, b in keys])
    cond = (
        cond
        & (F.col("__lb") == F.col("__rb"))
        & (rts >= lts + F.expr(f"INTERVAL '{lower_s}' SECOND"))
        & (rts <= lts + F.expr(f"INTERVAL '{upper_s}' SECOND"))
    )
    return left_b.join(right_b, cond, how).drop("__lb", "__rb")


def asof_join(
    left: DataFrame,
    versions: DataFrame,
    keys: list[str],
    ts: str,
    columns: list[str],
    chunk,
    tie: list[Column] | None = None,
) -> DataFrame:
    """Left rows with the version of each key valid at their time.

    Union of both sides, then a running latest version by time. ``chunk`` maps
    the time column to the chunk columns of :mod:`tidemill.operators.ordered`.
    A version at the same instant counts as valid.
    """
    rest = [c for c in left.columns if c not in (*keys, ts)]
    payload = F.struct(*columns)
    tagged_left = left.select(
        *keys, ts, F.lit(1).alias("__side"), F.struct(*rest).alias("__left"),
        F.lit(None).cast(versions.select(payload.alias("p")).schema["p"].dataType).alias("__v"),
    )
    tagged_right = versions.select(
        *keys, ts, F.lit(0).alias("__side"),
        F.lit(None).cast(tagged_left.schema["__left"].dataType).alias("__left"),
        payload.alias("__v"),
    )
    both = tagged_left.unionByName(tagged_right)
    valid = running(
        both, keys, [F.col(ts), F.col("__side"), *(tie or [])], chunk(F.col(ts)),
        {"__valid": ("last_value", F.col("__v"))},
    ).filter(F.col("__side") == 1)
    return valid.select(
        *keys, ts, "__left.*", *[F.col(f"__valid.{c}").alias(c) for c in columns]
    )


def dict_mapping(
    df: DataFrame,
    dictionary: DataFrame,
    keys: list[tuple[str, str]],
    value: str,
    name: str,
    null_if_missing: bool = True,
) -> DataFrame:
    """Map a (composite) key through a dictionary with unique keys.

    Spark broadcasts the dictionary only when its size is under the configured
    limit. Without ``null_if_missing`` an unknown key fails the query.
    """
    side = dictionary.select(
        *[F.col(d).alias(f"__d_{i}") for i, (_, d) in enumerate(keys)],
        F.col(value).alias("__value"), F.lit(True).alias("__hit"),
    )
    cond = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(f"__d_{i}") for i, (c, _) in enumerate(keys)]
    )
    out = df.join(side, cond, "left")
    mapped = F.col("__value")
    if not null_if_missing:
        shown = F.concat_ws(",", *[F.col(c).cast("string") for c, _ in keys])
        mapped = F.when(F.col("__hit"), mapped).otherwise(
            F.raise_error(F.concat(F.lit("key not in dictionary: "), shown))
        )
    return out.withColumn(name, mapped).drop(
        "__value", "__hit", *[f"__d_{i}" for i in range(len(keys))]
    )
