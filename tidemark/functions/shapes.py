"""Reusable DataFrame patterns that stay whole when one key holds much of the data.

* ``pick_row``: one row per key, cut before the shuffle so that a hot key shrinks where it lies.
* ``neighbours``: previous and next row of a series, in time slabs instead of one long window.
* ``exact_percentiles``: exact interpolated percentiles through value bins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = True) -> DataFrame:
    """The row that is last (or first) per key in a total order.

    The planner cuts each key to one row before the shuffle as well as after it (a window group
    limit), so a key that holds much of the data is reduced where it lies. Null keys form one group;
    ties beyond ``order`` are settled by the remaining columns, so the answer is the same every run."""
    rest = [F.col(c) for c in df.columns if c not in keys]
    way = (lambda c: c.desc_nulls_last()) if last else (lambda c: c.asc_nulls_first())
    w = Window.partitionBy(*keys).orderBy(*[way(c) for c in (*order, *rest)])
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def neighbours(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
               slab: Column | None = None) -> DataFrame:
    """Add ``prev_<v>`` and ``next_<v>`` per series for each named column.

    Rows are windowed within (series, slab), where a slab is a calendar day unless given. The first
    and last rows of each slab form a small edge table, one row per slab, whose own window supplies
    the values across slab borders. No task therefore holds a whole series of readings. Rows of one
    instant follow the named values, in the windows and in the edge table alike."""
    slab = F.to_date(F.col(order)) if slab is None else slab
    cut = df.withColumn("_slab", slab)
    inner = Window.partitionBy(*keys, "_slab").orderBy(order, *values)
    place = F.struct(F.col(order), *[F.col(v) for v in values])
    pack = F.struct(*[F.col(v) for v in values])
    within = (cut.withColumn("_p", F.lag(pack).over(inner))
                 .withColumn("_n", F.lead(pack).over(inner)))
    edges = cut.groupBy(*keys, "_slab").agg(F.min_by(pack, place).alias("_head"),
                                           F.max_by(pack, place).alias("_tail"))
    across = Window.partitionBy(*keys).orderBy("_slab")
    borders = edges.select(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], F.col("_slab").alias("_eslab"),
                           F.lag("_tail").over(across).alias("_before"), F.lead("_head").over(across).alias("_after"))
    on = [F.col(k).eqNullSafe(F.col(f"_e{i}")) for i, k in enumerate(keys)] + [F.col("_slab") == F.col("_eslab")]
    joined = within.join(borders, on, "left")
    prev = F.coalesce(F.col("_p"), F.col("_before"))
    nxt = F.coalesce(F.col("_n"), F.col("_after"))
    return joined.select(*df.columns,
                         *[prev[v].alias(f"prev_{v}") for v in values],
                         *[nxt[v].alias(f"next_{v}") for v in values])


def _value_bin(v: Column, steps: int = 4096) -> Column:
    """Monotone bin of a number: binary exponent plus ``steps`` divisions of the mantissa."""
    size = F.abs(v)
    exponent = F.floor(F.log2(size))
    mantissa = F.floor((size / F.pow(F.lit(2.0), exponent) - 1) * steps)
    code = (exponent + 1100) * steps + mantissa + 1
    return (F.when(v > 0, code).when(v < 0, -code).otherwise(F.lit(0))).cast("bigint")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                      points: dict[str, float]) -> DataFrame:
    """Exact percentiles with linear interpolation, plus ``n``, for groups of any size.

    Values are first counted (a combinable aggregate), then counted per bin; a window over the bins
    finds which bins hold the wanted ranks, and only those bins are ordered."""
    counts = (df.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v"))
                .agg(F.count("*").alias("_c")).withColumn("_b", _value_bin(F.col("_v"))))
    bins = counts.groupBy(*keys, "_b").agg(F.sum("_c").alias("_c"))
    by_key = Window.partitionBy(*keys)
    upto = by_key.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    bins = (bins.withColumn("_cum", F.sum("_c").over(upto)).withColumn("_n", F.sum("_c").over(by_key)))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"),
                                ((F.col("_n") - 1) * F.lit(float(p))).alias("pos"))
                       for name, p in points.items()])
    ranks = bins.select(*keys, "_b", "_n", (F.col("_cum") - F.col("_c")).alias("_start"), "_cum",
                        F.explode(wanted).alias("w"))
    need = ranks.where((F.floor(F.col("w.pos")) < F.col("_cum")) & (F.ceil(F.col("w.pos")) >= F.col("_start")))
    need = need.groupBy(*[F.col(k).alias(f"_e{i}") for i, k in enumerate(keys)], F.col("_b").alias("_eb"), "_n", "_start").agg(
        F.collect_set("w").alias("w"))
    on = [F.col(k).eqNullSafe(F.col(f"_e{i}")) for i, k in enumerate(keys)] + [F.col("_b") == F.col("_eb")]
    part = counts.join(need, on).select(*keys, "_b", "_v", "_c", "_n", "_start", "w")
    run = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = part.withColumn("_hi", F.col("_start") + F.sum("_c").over(run)).withColumn("_lo", F.col("_hi") - F.col("_c"))
    hit = part.select(*keys, "_v", "_lo", "_hi", "_n", F.explode("w").alias("w"))
    at = lambda pos: (F.col("_lo") <= pos) & (pos < F.col("_hi"))
    lo, hi = F.floor("w.pos"), F.ceil("w.pos")
    ends = hit.groupBy(*keys, F.col("w.name").alias("_name"), F.col("w.pos").alias("_pos")).agg(
        F.max(F.when(at(lo), F.col("_v"))).alias("_a"), F.max(F.when(at(hi), F.col("_v"))).alias("_z"),
        F.max("_n").alias("_n"))
    # the same convex form the built-in percentile uses
    frac = F.col("_pos") - F.floor("_pos")
    value_at = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise(
        (F.ceil("_pos") - F.col("_pos")) * F.col("_a") + frac * F.col("_z"))
    ends = ends.withColumn("_x", value_at)
    return ends.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == name, F.col("_x"))).alias(name) for name in points],
        F.max("_n").alias("n"))


def calendar(bounds: DataFrame, first: str, last: str, day: str = "date") -> DataFrame:
    """One row per day for each row's span."""
    keep = [c for c in bounds.columns if c not in (first, last)]
    return bounds.select(*keep, F.explode(F.sequence(F.col(first), F.col(last))).alias(day))
