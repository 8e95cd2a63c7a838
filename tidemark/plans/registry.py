"""Named queries over the given tables, each with the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.tables import CTES, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def finish(df: DataFrame) -> DataFrame:
    """Plain output types: bigint, double rounded to six places, and ISO text for dates."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6) + F.lit(0.0)
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register ``fn(Tables) -> DataFrame``. ``sql`` may use any shared fixture as a table name."""

    def deco(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return finish(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_fixtures(sql)
        return fn

    return deco


def with_fixtures(body: str) -> str:
    """Prefix the fixtures a statement mentions, and the ones those mention, as WITH clauses."""
    import re

    need: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in need and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in need:
                    need.append(name)

    visit(body)
    if not need:
        return body.strip()
    head = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in need)
    body = body.strip()
    if body[:4].upper() == "WITH":
        rest = body[4:].lstrip()
        if rest[:9].upper() == "RECURSIVE":
            return f"WITH RECURSIVE {head},\n{rest[9:].lstrip()}"
        return f"WITH {head},\n{rest}"
    return f"WITH {head}\n{body}"
