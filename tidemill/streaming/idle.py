"""Inputs that fall silent: heartbeat rows move their watermark on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICY = {"spark__sql__streaming__multipleWatermarkPolicy": "min"}


def heartbeat(source: DataFrame, pulse: DataFrame, ts: str, idle: str, delay: str) -> DataFrame:
    """``source`` with its own watermark, which trails ``pulse`` by ``idle`` at most.

    ``pulse`` is any stream with a column ``ts`` that tells how far time has gone: another input,
    or a clock (``rate``). Each of its rows becomes a heartbeat at ``ts - idle``, counted by the
    watermark and then taken out; rows without a time pass. While the source keeps up its own rows decide; once it is silent
    for ``idle``, the heartbeats do. Rows that come after a longer silence are late like others.
    """
    beat = "__beat"
    while beat in source.columns:
        beat += "_"
    names = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != ts
             else (F.col(ts) - F.expr(f"INTERVAL {idle}")).alias(ts) for f in source.schema.fields]
    beats = pulse.filter(F.col(ts).isNotNull()).select(*names, F.lit(True).alias(beat))
    both = source.withColumn(beat, F.lit(False)).unionByName(beats).withWatermark(ts, delay)
    # one condition that names the event time stays above the watermark, which has to see all rows
    return both.filter(F.col(ts).isNull() | ~F.col(beat)).drop(beat)


def merge_inputs(sources: list[DataFrame], ts: str, idle: str, delay: str,
                 pulses: list[DataFrame] | None = None) -> DataFrame:
    """Union of inputs under the slowest one's time, idle ones left behind by ``idle`` at most.

    Every input is paced by the other ones, or by ``pulses``. Run the query with :data:`POLICY`.
    """
    def pace(i: int) -> DataFrame:
        others = pulses or [s for j, s in enumerate(sources) if j != i]
        return reduce(DataFrame.unionByName, [o.select(ts) for o in others])

    if len(sources) < 2 and not pulses:
        return sources[0].withWatermark(ts, delay)
    parts = [heartbeat(s, pace(i), ts, idle, delay) for i, s in enumerate(sources)]
    return reduce(DataFrame.unionByName, parts)
