"""JSON text columns: typed access by path list, and lenient parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _tree(paths: dict[str, tuple[str, str]]) -> T.StructType:
    """Schema holding every ``$.a.b`` path, so that the text is parsed once."""
    root: dict = {}
    for path, dtype in paths.values():
        steps = path.removeprefix("$.").split(".")
        node = root
        for step in steps[:-1]:
            node = node.setdefault(step, {})
        node[steps[-1]] = dtype

    def build(node: dict) -> T.StructType:
        return T.StructType([
            T.StructField(k, build(v) if isinstance(v, dict) else T._parse_datatype_string(v))
            for k, v in node.items()
        ])

    return build(root)


def json_columns(df: DataFrame, text: str, paths: dict[str, tuple[str, str]]) -> DataFrame:
    """Add ``name`` per ``name -> (path, type)``; missing fields are null."""
    parsed = df.withColumn("__j", F.from_json(text, _tree(paths)))
    fields = {
        name: F.col("__j." + path.removeprefix("$.")) for name, (path, _) in paths.items()
    }
    return parsed.withColumns(fields).drop("__j")


def lenient_json(df: DataFrame, text: str, schema: str) -> DataFrame:
    """Columns of ``schema`` from each readable text; unreadable rows are dropped."""
    parsed = df.withColumn(
        "__j", F.from_json(text, f"{schema}, _corrupt_record STRING",
                           {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    )
    return (
        parsed.filter(F.col("__j").isNotNull() & F.col("__j._corrupt_record").isNull())
        .select(*df.columns, "__j.*").drop("_corrupt_record")
    )
