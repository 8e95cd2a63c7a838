"""Rule tables written in code, as local relations whose size the planner knows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _text(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "array(" + ", ".join(_text(x) for x in v) + ")"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def fixed(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A literal table: ``schema`` is ``name type, ...``; no Python worker is started to read it."""
    fields = [f.strip().split(" ", 1) for f in schema.split(",")]
    body = ", ".join("(" + ", ".join(_text(v) for v in r) + ")" for r in rows)
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    cols = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(fields))
    return spark.sql(f"SELECT {cols} FROM VALUES {body} AS t({names})")
