"""Wide-column cells ``(rowkey, family, qualifier, ts, value)``: write, read, delete."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

COLUMN = ["rowkey", "family", "qualifier"]


def to_cells(df: DataFrame, rowkey: Column, layout: dict[str, list[str]], ts: Column) -> DataFrame:
    """One cell per non-null listed column; ``layout`` maps family to columns."""
    cells = [
        F.struct(
            F.lit(family).alias("family"), F.lit(c).alias("qualifier"),
            F.col(c).cast("string").alias("value"),
        )
        for family, columns in layout.items() for c in columns
    ]
    return (
        df.select(rowkey.cast("string").alias("rowkey"), ts.cast("bigint").alias("ts"),
                  F.inline(F.array(*cells)))
        .filter("value IS NOT NULL")
        .select("rowkey", "family", "qualifier", "ts", "value")
    )


def parse_cells(lines: DataFrame, text: str = "value") -> DataFrame:
    """``rowkey,family,qualifier,value,ts`` lines; lines of another shape are skipped."""
    p = F.split(text, ",")
    return lines.filter(F.size(p) == 5).select(
        p[0].alias("rowkey"), p[1].alias("family"), p[2].alias("qualifier"),
        p[4].try_cast("bigint").alias("ts"), p[3].alias("value"),
    ).filter("ts IS NOT NULL")


def cell_lines(cells: DataFrame) -> DataFrame:
    """Text form of cells, the reverse of :func:`parse_cells`."""
    return cells.select(
        F.concat_ws(",", "rowkey", "family", "qualifier", "value", F.col("ts").cast("string"))
        .alias("value")
    )


def dedup_writes(cells: DataFrame, arrival: str) -> DataFrame:
    """Equal (column, ts): the write that arrived last survives."""
    return cells.groupBy(*COLUMN, "ts").agg(F.max_by("value", arrival).alias("value"))


def newest_versions(cells: DataFrame, versions: int) -> DataFrame:
    """At most ``versions`` cells per column; the cut is applied before the shuffle too."""
    w = Window.partitionBy(*COLUMN).orderBy(F.desc("ts"))
    return (
        cells.withColumn("__v", F.row_number().over(w)).filter(F.col("__v") <= versions)
        .drop("__v")
    )


def unexpired(cells: DataFrame, now: Column, ttl_ms: int) -> DataFrame:
    return cells.filter(F.col("ts") > now - ttl_ms)


def apply_deletes(cells: DataFrame, markers: DataFrame) -> DataFrame:
    """Cells left after delete markers ``(rowkey, family, qualifier, ts, kind)``.

    ``family`` hides the whole family up to ``ts``, ``column`` all versions of
    one column up to ``ts``, ``version`` exactly the cell at ``ts``. Markers are
    first reduced to one row per target.
    """
    fam = markers.filter("kind = 'family'").groupBy("rowkey", "family").agg(
        F.max("ts").alias("__upto")
    )
    col = markers.filter("kind = 'column'").groupBy(*COLUMN).agg(F.max("ts").alias("__upto"))
    one = markers.filter("kind = 'version'").select(*COLUMN, "ts").distinct()
    out = cells
    for marks, on in ((fam, ["rowkey", "family"]), (col, COLUMN)):
        out = out.join(marks, on, "left").filter(
            F.col("__upto").isNull() | (F.col("ts") > F.col("__upto"))
        ).drop("__upto")
    return out.join(one, [*COLUMN, "ts"], "left_anti").select(*cells.columns)


def row_view(cells: DataFrame, layout: dict[str, list[str]]) -> DataFrame:
    """Latest value per column as one struct per family, plus the newest ts of the row."""
    latest = cells.groupBy(*COLUMN).agg(
        F.max_by("value", "ts").alias("value"), F.max("ts").alias("ts")
    )
    aggs = [F.max("ts").alias("ts")]
    for family, columns in layout.items():
        aggs.append(F.struct(*[
            F.max(F.when(
                (F.col("family") == family) & (F.col("qualifier") == c), F.col("value")
            )).alias(c) for c in columns
        ]).alias(family))
    return latest.groupBy("rowkey").agg(*aggs)


def scan(cells: DataFrame, start_row: str | None = None, row_regex: str | None = None,
         family_regex: str | None = None, families: list[str] | None = None) -> DataFrame:
    """Cell filters, all of which must hold."""
    out = cells
    if start_row is not None:
        out = out.filter(F.col("rowkey") >= start_row)
    if row_regex is not None:
        out = out.filter(F.col("rowkey").rlike(row_regex))
    if family_regex is not None:
        out = out.filter(F.col("family").rlike(family_regex))
    if families is not None:
        out = out.filter(F.col("family").isin(*families))
    return out
